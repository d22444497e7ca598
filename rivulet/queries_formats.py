"""Registered queries of the classic NetCDF source and sink, of cycles that arrive, and of folds with kept state, with SQL."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from rivulet.functions import crs
from rivulet.model import from_table
from rivulet.operators import alignment, grid, nearest, states, tiles
from rivulet.plans.profile import Profile, one_identity
from rivulet.queries import _cells, _t, query
from rivulet.sources import netcdf, scan, sinks
from rivulet.streaming import arrivals, folds


def _event_files(spark, d, pack_values=False):
    """Events as NetCDF files, one an event type."""
    folder = sinks.scratch_folder(spark)
    df = _t(spark, d, "events").select("event_id", "ts", "user_id", "event_type", F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("value"))
    data = from_table(df, ("event_id",), attrs={"title": "events"}, var_attrs={"value": {"units": "m3 s-1"}})
    netcdf.write_files(data, folder, "nwm_{event_type}.nc", pack_values=pack_values)
    return folder


@query("SELECT event_id, ts, user_id, CASE WHEN event_id % 7 <> 0 THEN value END AS value, 'nwm_' || event_type || '.nc' AS file FROM events")
def netcdf_round_trip(spark, d):
    """Written as one file a target, all files read again: whole numbers, times, missing values."""
    back = netcdf.read_netcdf(spark, _event_files(spark, d), slab_bytes=1 << 16)
    return back.select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "user_id", "value", "file")


@query("SELECT event_id, round(value, 2) AS value FROM events WHERE event_id % 7 <> 0 AND event_type <> 'view'")
def netcdf_packed_values(spark, d):
    """Values packed as whole hundredths, and scaled when read; a list of files."""
    folder = _event_files(spark, d, pack_values=True)
    files = ",".join(f for f in netcdf.list_files(folder) if not f.endswith("nwm_view.nc"))
    return netcdf.read_netcdf(spark, files, ["value"]).where("value is not null").select("event_id", F.round("value", 4).alias("value"))


@query("SELECT CAST(vec_id AS BIGINT) AS y, i - 1 AS x, CAST(embedding[i] AS FLOAT) AS value FROM embeddings, range(1, 65) t(i) WHERE vec_id BETWEEN 100 AND 299 AND i - 1 < 16")
def netcdf_variable_range(spark, d):
    """One variable of a grid, a range of each dimension: partitions are slabs of this range only."""
    folder = sinks.scratch_folder(spark)
    cells = _cells(spark, d).select("y", "x", "value", (F.col("value") * 2).alias("twice"))
    netcdf.write_files(from_table(cells, ("y", "x")), folder, "grid.nc")
    read = netcdf.read_netcdf(spark, f"{folder}/grid.nc", ["value"], slab_bytes=1 << 12)
    return read.where("y between 100 and 299 and x < 16").select("y", "x", "value")


@query("SELECT 'nwm_' || event_type || '.nc' AS file, 'value' AS variable, CAST(count(*) AS INTEGER) AS cells, 'double' AS type, 'm3 s-1' AS units FROM events GROUP BY event_type")
def netcdf_headers(spark, d):
    """What the files' headers say of a variable; no values are read."""
    found = netcdf.read_headers(spark, _event_files(spark, d)).where("variable = 'value'")
    return found.select("file", "variable", F.col("shape")[0].alias("cells"), "type", F.col("attrs")["units"].alias("units"))


@query("SELECT event_id, value, 3600 * (1 + event_id % 3) AS lead_seconds, 'alaska.aprfc' AS region FROM events WHERE user_id % 2 = 0")
def netcdf_cycle(spark, d):
    """A cycle of one region and its centre, among files of the region alone, read as NetCDF."""
    folder = sinks.scratch_folder(spark)
    place = F.when(F.col("user_id") % 2 == 0, "alaska.aprfc").otherwise("alaska")
    rows = _t(spark, d, "events").select("event_id", "value", (1 + F.col("event_id") % 3).alias("hour"), place.alias("place"))
    netcdf.write_files(from_table(rows, ("event_id",)), folder, "nwm.t06z.short_range.land.f00{hour}.{place}.nc")
    read = scan.read_cycle(spark, folder, "06", "short_range", "land", "alaska.aprfc", expected=3, form="netcdf")
    return read.select("event_id", "value", "lead_seconds", "region")


_REGIONS = "(VALUES (0, 'conus'), (1, 'hawaii'), (2, 'puertorico'), (3, 'alaska'), (4, 'alaska.aprfc'), (5, 'x9')) r(k, region)"


@query(f"SELECT o_orderkey, CASE WHEN k < 5 THEN lpad(CAST(o_custkey % 24 AS VARCHAR), 2, '0') END AS cycle, CASE WHEN k < 5 THEN region END AS region FROM orders JOIN {_REGIONS} ON o_orderkey % 6 = k")
def parse_regions(spark, d):
    """Names of all regions, one with its centre; a name of none is null throughout."""
    from rivulet.functions.text import parse_file_name

    regions = F.array(*map(F.lit, ("conus", "hawaii", "puertorico", "alaska", "alaska.aprfc", "x9")))
    name = F.format_string("nwm.t%02dz.short_range.land.f001.%s.nc", F.col("o_custkey") % 24, F.get(regions, (F.col("o_orderkey") % 6).cast("int")))
    parts = parse_file_name(name)
    return _t(spark, d, "orders").select("o_orderkey", parts["cycle"].alias("cycle"), parts["region"].alias("region"))


@query("SELECT 'file' || (o_orderkey % 50) || '.nc' AS file, count(*) AS n FROM orders WHERE o_orderkey % 2 = 1 GROUP BY 1")
def unknown_file_names(spark, d):
    """Names that no part of the engine would pick, counted."""
    good = F.lit("nwm.t00z.short_range.land.f001.conus.nc")
    name = F.when(F.col("o_orderkey") % 2 == 0, good).otherwise(F.format_string("file%d.nc", F.col("o_orderkey") % 50))
    return scan.unknown_names(_t(spark, d, "orders").select(name.alias("file")))


_FRAMES = ("f001", "f002", "f003", "f004")


@query(
    """
WITH a AS (
  SELECT CAST(ts AS DATE) AS day, user_id % 3 AS cycle, 'f00' || (event_id % 5 + 1) AS frame, min(ts) AS t0
  FROM events WHERE event_id % 5 < 4 GROUP BY ALL
), c AS (
  SELECT day, cycle, min(t0) AS first, min(t0) + INTERVAL 8 HOUR AS deadline, count(*) AS n, max(t0) AS last FROM a GROUP BY ALL
), e AS (SELECT max(ts) - INTERVAL 1 HOUR AS passed FROM events WHERE event_id % 5 < 4)
SELECT day, CAST(cycle AS BIGINT) AS cycle, CASE WHEN n = 4 AND last <= deadline THEN 'complete' ELSE 'timed out' END AS status,
  CAST(count(*) FILTER (t0 <= deadline) AS INTEGER) AS n_files,
  coalesce((SELECT string_agg(f, ',' ORDER BY f) FROM (VALUES ('f001'), ('f002'), ('f003'), ('f004')) t(f) WHERE f NOT IN (SELECT frame FROM a x WHERE x.day = c.day AND x.cycle = c.cycle AND x.t0 <= c.deadline)), '') AS missing,
  CASE WHEN n = 4 AND last <= deadline THEN last ELSE deadline END AS decided
FROM c JOIN a USING (day, cycle), e WHERE n = 4 AND last <= deadline OR deadline < passed
GROUP BY day, cycle, n, last, deadline"""
)
def cycle_completion(spark, d):
    """Files that arrive in three lots, the query stopped and started again between them: complete and timed-out cycles."""
    folder = sinks.scratch_folder(spark)
    rows = _t(spark, d, "events").where("event_id % 5 < 4")
    files = rows.select(F.col("ts").cast("date").alias("day"), (F.col("user_id") % 3).alias("cycle"), F.format_string("f00%d", F.col("event_id") % 5 + 1).alias("frame"), F.col("ts").cast("timestamp").alias("arrived"))
    lots = [F.col("day") < "2024-01-10", F.col("day").between("2024-01-10", "2024-01-19"), F.col("day") > "2024-01-19"]
    for lot in lots:
        files.where(lot).write.mode("append").parquet(f"{folder}/in")
        stream = folds.read_stream(spark, f"{folder}/in", files.schema)
        done = arrivals.complete_cycles(stream, ["day", "cycle"], list(_FRAMES), timedelta(hours=8), timedelta(days=400))
        folds.write_stream(done, f"{folder}/out", f"{folder}/state").awaitTermination()
    return spark.read.parquet(f"{folder}/out").withColumn("decided", F.col("decided").cast("timestamp_ntz"))


@query("SELECT '06' AS cycle, 'short_range' AS configuration, 'channel_rt' AS output_type, '3' AS member, 'conus' AS region, count(*) AS n_files FROM orders")
def manifest_identity(spark, d):
    """What all files of a manifest share, from their names; their number."""
    name = F.format_string("nwm.t06z.short_range.channel_rt_3.f%03d.conus.nc", F.col("o_orderkey") % 18 + 1)
    files = scan.with_identity(_t(spark, d, "orders"), name)
    same = {k: v for k, v in one_identity(files).items() if k != "frame"}
    return files.agg(*[F.lit(same[k]).cast("string").alias(k) for k in ("cycle", "configuration", "output_type", "member", "region")], F.count(F.lit(1)).alias("n_files"))


_KEPT = [("value", op, op) for op in ("count", "sum", "min", "max", "mean", "variance", "std", "variance_sample")]


def _kept_lots(spark, d):
    """Events in three lots, as files of a stream."""
    folder = sinks.scratch_folder(spark)
    e = _t(spark, d, "events").select("user_id", "event_id", F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("value"))
    for k in range(3):
        e.where(F.col("event_id") % 3 == k).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        yield folder, e, k


@query(
    """SELECT user_id, count(v) AS count, round(sum(v) + 1e-9, 4) AS sum, min(v) AS min, max(v) AS max, round(avg(v) + 1e-9, 6) AS mean, round(CASE WHEN count(v) > 1 THEN var_pop(v) END + 1e-9, 4) AS variance,
 round(CASE WHEN count(v) > 1 THEN stddev_pop(v) END + 1e-9, 6) AS std, round(var_samp(v) + 1e-9, 4) AS variance_sample FROM (SELECT user_id, CASE WHEN event_id % 7 <> 0 THEN value END AS v FROM events) GROUP BY user_id"""
)
def kept_state_folds(spark, d):
    """Three lots of files, each folded into the kept state when it comes, equal one pass over all."""
    store = None
    for folder, e, _ in _kept_lots(spark, d):
        store = store or states.StateStore(spark, f"{folder}/store", ["user_id"], _KEPT)
        states.fold_stream(folds.read_stream(spark, f"{folder}/in", e.schema), store, f"{folder}/checkpoint").awaitTermination()
    digits = {"sum": 4, "mean": 6, "variance": 4, "std": 6, "variance_sample": 4}
    return store.result().select("user_id", *[F.round(F.col(o) + 1e-9, digits[o]).alias(o) if o in digits else o for _, _, o in _KEPT])


@query("SELECT event_type, count(value) AS count, TRUE AS within FROM events WHERE event_id % 7 <> 0 GROUP BY event_type")
def kept_state_median(spark, d):
    """The median of a kept state, merged from three lots: its rank is within the sketch's stated error of the middle."""
    e = _t(spark, d, "events").where("event_id % 7 <> 0").select("event_type", "event_id", "value")
    wanted = [("value", "count", "count"), ("value", "median", "median")]
    lots = [states.fold_state(e.where(F.col("event_id") % 3 == k), ["event_type"], wanted) for k in range(3)]
    found = states.finish(states.merge_states(lots, ["event_type"], wanted), ["event_type"], wanted)
    below = e.join(found, "event_type").groupBy("event_type", "count").agg(F.count_if(F.col("value") < F.col("median")).alias("less"), F.count_if(F.col("value") <= F.col("median")).alias("most"))
    error = states.SKETCH_ERROR * F.col("count") + 1
    return below.select("event_type", "count", ((F.col("less") <= F.col("count") / 2 + error) & (F.col("most") >= F.col("count") / 2 - error)).alias("within"))


# Uneven axes


@query("SELECT c_custkey, (SELECT min_by(s_acctbal, struct_pack(d := abs(s_acctbal - c_acctbal), v := s_acctbal)) FROM supplier) AS nearest FROM customer")
def nearest_on_uneven_axis(spark, d):
    """Each customer's balance on the axis that the suppliers' balances make."""
    axis = _t(spark, d, "supplier").select("s_acctbal")
    return nearest.nearest_on_axis(_t(spark, d, "customer"), axis, "c_acctbal", "s_acctbal").select("c_custkey", "nearest")


@query(
    """WITH q AS (SELECT p_partkey, (p_size - 25) / 50.0 AS x, (p_retailprice - 1400) / 1000 AS y FROM part), s AS (SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y FROM embeddings)
SELECT p_partkey, min_by(vec_id, struct_pack(d := (q.x - s.x) * (q.x - s.x) + (q.y - s.y) * (q.y - s.y), v := vec_id)) AS nearest FROM q, s GROUP BY p_partkey"""
)
def nearest_place(spark, d):
    """Scattered places, some outside the others' box, each with the nearest of scattered sources."""
    places = _t(spark, d, "part").select("p_partkey", ((F.col("p_size") - 25) / 50.0).alias("x"), ((F.col("p_retailprice") - 1400) / 1000).alias("y"))
    sources = _t(spark, d, "embeddings").select("vec_id", F.col("embedding")[0].alias("sx"), F.col("embedding")[1].alias("sy"))
    return nearest.nearest_places(places, sources, ("x", "y"), ("sx", "sy"), "vec_id").select("p_partkey", "nearest")


# Between coordinate systems, and polygons

_SPHERE = 'GEOGCS["g",DATUM["d",SPHEROID["s",6370000.0,0.0]],PRIMEM["Greenwich",0.0],UNIT["Degree",0.0174532925199433]]'
_CONIC = f'PROJCS["c",{_SPHERE},PROJECTION["Lambert_Conformal_Conic"],PARAMETER["central_meridian",-97.0],PARAMETER["standard_parallel_1",30.0],PARAMETER["standard_parallel_2",60.0],PARAMETER["latitude_of_origin",40.0],UNIT["Meter",1.0]]'


@query(
    """
WITH k AS (SELECT ln(cos(radians(30)) / cos(radians(60))) / ln(tan(pi() / 4 + radians(60) / 2) / tan(pi() / 4 + radians(30) / 2)) AS n),
f AS (SELECT n, 6370000 * cos(radians(30)) * pow(tan(pi() / 4 + radians(30) / 2), n) / n AS f FROM k),
o AS (SELECT n, f, f / pow(tan(pi() / 4 + radians(40) / 2), n) AS rho0 FROM f),
t AS (SELECT -1500000.0::DOUBLE + 31000.0 * (i % 80) AS x, -1400000.0::DOUBLE + 27000.0 * (i // 80) AS y FROM range(0, 8000) r(i)),
p AS (SELECT x, y, degrees(2 * atan(pow(f / sqrt(x * x + (rho0 - y) * (rho0 - y)), 1 / n)) - pi() / 2) AS lat, degrees(atan2(x, rho0 - y) / n) - 97 AS lon FROM t, o),
g AS (SELECT vec_id AS r, unnest(range(0, len(embedding))) AS c, unnest(embedding) AS value FROM embeddings)
SELECT y, x, value FROM p LEFT JOIN g ON r = CAST(floor((lat - 24.99) / 0.02) AS BIGINT) AND c = CAST(floor((lon + 115.25) / 0.5) AS BIGINT)"""
)
def grid_between_systems(spark, d):
    """A grid of degrees on a conic one, as both systems' texts say: projections are columns, no Python runs."""
    cells = _cells(spark, d).select((F.col("y") * 0.02 + 25).alias("y"), (F.col("x") * 0.5 - 115).alias("x"), "value")
    rows = _t(spark, d, "embeddings").count()
    source = grid.Grid(grid.Axis(-115.0, 0.5, 64), grid.Axis(25.0, 0.02, rows), _SPHERE)
    target = grid.Grid(grid.Axis(-1500000.0, 31000.0, 80), grid.Axis(-1400000.0, 27000.0, 100), _CONIC)
    return grid.reproject(from_table(cells, ("y", "x")), source, target, ["value"]).df


@query(
    """
WITH s AS (SELECT s_suppkey, s_suppkey % 37 + 3.3 AS cx, s_nationkey * 1.5 + 4.2 AS cy, 2.37 + s_suppkey % 3 AS r FROM supplier)
SELECT s_suppkey AS label, CAST(j AS INTEGER) AS row, CAST(i AS INTEGER) AS col FROM s, range(0, 50) a(i), range(0, 50) b(j)
WHERE abs(i + 0.5 - cx) + abs(j + 0.5 - cy) < r AND NOT (abs(i + 0.5 - cx) < 0.77 AND abs(j + 0.5 - cy) < 0.77) OR (i + 0.5 > cx + 5 AND i + 0.5 < cx + 7 AND j + 0.5 > cy - 1 AND j + 0.5 < cy + 1)"""
)
def rasterize_rings(spark, d):
    """A diamond with a square hole and a rectangle apart for each supplier: polygons of several rings, by scanlines."""
    s = _t(spark, d, "supplier").select("s_suppkey", (F.col("s_suppkey") % 37 + 3.3).alias("cx"), (F.col("s_nationkey") * 1.5 + 4.2).alias("cy"), (2.37 + F.col("s_suppkey") % 3).alias("r"))
    ring = lambda *at: F.array(*[F.struct((F.col("cx") + x).alias("x"), (F.col("cy") + y).alias("y")) for x, y in at])
    r = F.col("r")
    outer = ring((r, 0.0), (0.0, r), (-r, 0.0), (0.0, -r))
    hole = ring((-0.77, -0.77), (0.77, -0.77), (0.77, 0.77), (-0.77, 0.77))
    apart = ring((5.0, -1.0), (7.0, -1.0), (7.0, 1.0), (5.0, 1.0))
    rings = s.select(F.col("s_suppkey").alias("label"), F.explode(F.array(outer, hole, apart)).alias("ring"))
    own = grid.Grid(grid.Axis(0.5, 1.0, 50), grid.Axis(0.5, 1.0, 50))
    return grid.rasterize_rings(rings, own, all_touched=False)


# Alignment by coordinates


def _two_files(spark, d, odd):
    """Events in two files that share some cells: each with a variable of its own, and one that both have."""
    e = _t(spark, d, "events").select("event_id", "user_id", "value", odd.alias("both"))
    a = e.where("event_id % 2 = 0 or event_id % 3 = 0").select("event_id", "value", "both", F.lit("a").alias("file"))
    b = e.where("event_id % 2 = 1 or event_id % 3 = 0").select("event_id", "user_id", (F.col("both") + F.when(F.col("event_id") % 30 == 0, 1.0).otherwise(0.0)).alias("both"), F.lit("b").alias("file"))
    return from_table(a.unionByName(b, allowMissingColumns=True), ("event_id",), file_key=("file",))


@query("SELECT event_id, CASE WHEN event_id % 2 = 0 OR event_id % 3 = 0 THEN value END AS value, CASE WHEN event_id % 6 = 0 AND event_id % 30 = 0 THEN value + 1 ELSE value END AS both, CASE WHEN event_id % 2 = 1 OR event_id % 3 = 0 THEN user_id END AS user_id FROM events")
def merge_by_coordinates(spark, d):
    """Two overlapping files as one, each cell once; of values that disagree the greater."""
    merge = {"operation": "merge", "by_coordinates": True, "conflicts": "most"}
    return Profile.from_dict({"operations": [merge]}).run(_two_files(spark, d, F.col("value"))).df


@query("SELECT event_id, 'both' AS variable, CAST(event_id AS VARCHAR) AS least, CAST(event_id + 1 AS VARCHAR) AS most, 2 AS n_files FROM events WHERE event_id % 30 = 0")
def merge_conflicts(spark, d):
    """Cells of which two files say different things."""
    found = alignment.conflicting_cells(_two_files(spark, d, F.col("event_id").cast("double")))
    whole = lambda c: F.col(c).cast("double").cast("long").cast("string").alias(c)
    return found.select("event_id", "variable", whole("least"), whole("most"), "n_files")


@query(
    """WITH f AS (SELECT user_id % 2 AS grp, CAST(o AS VARCHAR) AS file, min(event_id) AS first, max(event_id) AS last FROM (SELECT user_id, event_id, event_id // 97 + CASE WHEN event_id % 89 = 0 THEN 1 ELSE 0 END AS o FROM events) GROUP BY ALL),
g AS (SELECT *, max(struct_pack(l := last, o := file)) OVER (PARTITION BY grp ORDER BY first, last, file ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM f)
SELECT grp, file, b.o AS other, first, b.l AS last_before FROM g WHERE first <= b.l"""
)
def overlapping_files(spark, d):
    """Files of consecutive ids, some of which reach into the one before, in two groups."""
    name = (F.floor(F.col("event_id") / 97) + F.when(F.col("event_id") % 89 == 0, 1).otherwise(0)).cast("long").cast("string")
    rows = _t(spark, d, "events").select("event_id", "value", (F.col("user_id") % 2).alias("grp"), name.alias("file"))
    ranges = alignment.coordinate_ranges(from_table(rows, ("event_id",), file_key=("grp", "file")), "event_id")
    return alignment.overlapping_ranges(ranges, ["grp", "file"], ["grp"])


# Tiled arrays


@query("SELECT CAST(i - 1 AS INTEGER) AS x, CAST(0 AS INTEGER) AS t, CAST(vec_id AS INTEGER) AS y, CAST(embedding[i] AS FLOAT) AS value FROM embeddings, range(1, 65) s(i) WHERE vec_id >= 64 OR i > 32")
def tiled_transpose(spark, d):
    """A grid in tiles, with a new dimension, transposed, and as rows again: cells without a row stay missing."""
    cells = _cells(spark, d)
    n = cells.agg(F.max("y")).first()[0] + 1
    held = cells.where("y >= 64 or x >= 32")
    tiled = tiles.to_tiles(held, ["y", "x"], [n, 64], "value", [64, 48])
    return tiled.expand("t").transpose("x", "t", "y").rows().where("value is not null")


@query("SELECT CAST(vec_id AS INTEGER) AS y, CAST(i - 1 AS INTEGER) AS x, CAST(embedding[i] AS FLOAT) AS value FROM embeddings, range(1, 65) s(i) WHERE vec_id // 32 IN (2, 3) AND (i - 1) // 16 = 1")
def tiled_block(spark, d):
    """The tiles that a block of places touches, whole."""
    cells = _cells(spark, d)
    n = cells.agg(F.max("y")).first()[0] + 1
    return tiles.to_tiles(cells, ["y", "x"], [n, 64], "value", [32, 16]).block(y=(70, 100), x=(17, 20)).rows()


# Files of networks, projections and masks


@query('SELECT c_custkey AS link, CASE WHEN c_custkey % 4 = 0 THEN -1 ELSE c_custkey // 4 END AS "to" FROM customer')
def netcdf_river_links(spark, d):
    """A river network in a NetCDF file: each link and where it flows."""
    folder = sinks.scratch_folder(spark)
    to = F.when(F.col("c_custkey") % 4 == 0, -1).otherwise(F.floor(F.col("c_custkey") / 4)).cast("long")
    rows = _t(spark, d, "customer").select(F.col("c_custkey").alias("link"), to.alias("to"))
    netcdf.write_files(from_table(rows, ("link",)), folder, "routelink.nc")
    return scan.read_links(spark, f"{folder}/routelink.nc", "netcdf")


@query("SELECT vec_id AS y, i - 1 AS x, CAST(embedding[i] AS FLOAT) AS value, round((25 + 0.02 * vec_id)::DOUBLE, 6) AS lat, (-115 + 0.5 * (i - 1))::DOUBLE AS lon FROM embeddings, range(1, 65) t(i)")
def projection_file(spark, d):
    """A grid and its coordinate system from a file's coordinates and attributes; each cell's place by it, in degrees."""
    folder = sinks.scratch_folder(spark)
    cells = _cells(spark, d).select((F.col("y") * 0.02 + 25).alias("lat"), (F.col("x") * 0.5 - 115).alias("lon"), "value")
    data = from_table(cells, ("lat", "lon"), scalars={"crs": 0}, var_attrs={"crs": {"spatial_ref": _SPHERE}, "value": {"grid_mapping": "crs"}})
    netcdf.write_files(data, folder, "projection.nc")
    own = netcdf.file_grid(f"{folder}/projection.nc")
    lon, lat = crs.system_of(own.crs).inverse(own.x.centre(F.col("x")), own.y.centre(F.col("y")))
    return _cells(spark, d).select("y", "x", "value", F.round(lat, 6).alias("lat"), F.round(lon, 6).alias("lon"))


@query(
    """WITH s AS (SELECT s_nationkey AS label, s_suppkey, s_suppkey % 37 + 3.3 AS cx, s_nationkey * 1.5 + 4.2 AS cy FROM supplier WHERE s_suppkey IN (SELECT min(s_suppkey) FROM supplier GROUP BY s_nationkey))
SELECT 'mask_' || label || '.nc' AS file, j + 0.5 AS y, i + 0.5 AS x FROM s, range(0, 50) a(i), range(0, 50) b(j) WHERE abs(i + 0.5 - cx) < 2.1 AND abs(j + 0.5 - cy) < 1.1"""
)
def mask_files(spark, d):
    """A polygon a nation (about its first supplier) as mask files, and their cells read again."""
    folder = sinks.scratch_folder(spark)
    s = _t(spark, d, "supplier").groupBy("s_nationkey").agg(F.min("s_suppkey").alias("k"))
    cx, cy = F.col("k") % 37 + 3.3, F.col("s_nationkey") * 1.5 + 4.2
    ring = F.array(*[F.struct((cx + a).alias("x"), (cy + b).alias("y")) for a, b in ((-2.1, -1.1), (2.1, -1.1), (2.1, 1.1), (-2.1, 1.1))])
    own = grid.Grid(grid.Axis(0.5, 1.0, 50), grid.Axis(0.5, 1.0, 50), _SPHERE)
    netcdf.write_masks(s.select(F.col("s_nationkey").alias("label"), ring.alias("ring")), own, folder, all_touched=False)
    return netcdf.read_netcdf(spark, folder, ["mask"]).where("mask = 1").select("file", "y", "x")


@query(
    """WITH g AS (SELECT vec_id AS y, unnest(range(0, len(embedding))) AS x, unnest(embedding) AS v, label FROM embeddings),
t AS (SELECT CAST(i // 20 AS INTEGER) - 4 AS y, 4 * CAST(i % 20 AS INTEGER) - 8 AS x FROM range(0, (SELECT 20 * (count(*) + 8) FROM embeddings)) r(i))
SELECT CAST(t.y AS DOUBLE) AS y, CAST(t.x AS DOUBLE) AS x, v AS value, coalesce(label, -2147483647) AS label, coalesce(label % 2 = 0, FALSE) AS even FROM t LEFT JOIN g ON g.y = t.y AND g.x = t.x"""
)
def grid_fill_by_type(spark, d):
    """A wider grid, all rows of it: cells without a value get what stands for none in their variable's type."""
    e = _t(spark, d, "embeddings")
    cells = e.select(F.col("vec_id").alias("y"), F.posexplode("embedding").alias("x", "value"), "label", (F.col("label") % 2 == 0).alias("even"))
    source = grid.grid_of(cells)
    target = grid.Grid(grid.Axis(-8.0, 4.0, 20), grid.Axis(-4.0, 1.0, source.y.size + 8))
    return grid.reproject_group(from_table(cells, ("y", "x")), source, target, fill="by_type").df
