"""Registered queries of the time-series engine: each an operator over whole tables, with SQL that says the same.

The tables stand in for forecast files: ``events`` is a vector series (feature = user_id, time = ts), ``customer`` a
river network (a customer flows into customer div 4) and a set of features, ``nation`` and ``region`` its masks,
``embeddings`` a grid (y = vec_id, x = position), ``orders`` files by month. Real aggregates are rounded on both sides,
since the order of additions differs.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.functions import calendar, text, units
from rivulet.model import Dataset, from_table
from rivulet.operators import aggregates, grid, masks, projections
from rivulet.plans.operations import Context
from rivulet.plans.profile import Profile, select_profile
from rivulet.sources import scan, sinks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
START = "2024-01-01"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _series(spark: SparkSession, d: str) -> Dataset:
    """events as a vector series with leads from the reference time."""
    df = _t(spark, d, "events").select(F.col("user_id").alias("feature_id"), F.col("ts").alias("time"), F.col("value").alias("streamflow"), "event_id", "event_type")
    df = df.withColumn("lead_seconds", calendar.elapsed_seconds(F.lit(START).cast("timestamp_ntz"), F.col("time")))
    return from_table(df, ("feature_id", "time"), ("event_id", "event_type", "lead_seconds"), var_attrs={"streamflow": {"units": "m3 s-1", "long_name": "River Flow"}})


def _cells(spark: SparkSession, d: str) -> DataFrame:
    return grid.explode_rows(_t(spark, d, "embeddings").withColumnRenamed("vec_id", "y"), "embedding", "y")


def _rounded(name: str, digits: int = 4):
    """Rounded off the ties, which the last bits of a sum would decide one way or the other."""
    return F.round(F.col(name) + 1e-9, digits)


SECONDS = f"date_sub('second', TIMESTAMP '{START}', ts)"
BUCKET = f"CAST(greatest(ceil({SECONDS} / 86400.0), 1) AS BIGINT)"


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def drop_exclude(spark, d):
    return projections.drop(from_table(_t(spark, d, "lineitem"), ("l_orderkey", "l_linenumber")), ["l_orderkey", "l_linenumber", "l_quantity"], exclude=True).df


@query("SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_returnflag, l_shipdate FROM lineitem")
def drop_fields(spark, d):
    gone = ["l_partkey", "l_suppkey", "l_extendedprice", "l_tax", "l_linestatus", "not_there"]
    return projections.drop(from_table(_t(spark, d, "lineitem"), ("l_orderkey", "l_linenumber")), gone).df


@query("SELECT DISTINCT l_orderkey, CAST(1 AS INTEGER) AS one FROM lineitem")
def drop_dimension(spark, d):
    data = from_table(_t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity").withColumn("one", F.lit(1)), ("l_orderkey", "l_linenumber"), var_dims={"one": ("l_orderkey",)})
    return projections.drop_dimensions(data, ["l_linenumber"]).df


@query("SELECT o_orderkey AS feature_id, o_totalprice AS streamflow, o_orderdate AS time FROM orders")
def rename_variables(spark, d):
    data = from_table(_t(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderdate"), ("o_orderkey",))
    return projections.rename(data, {"o_orderkey": "feature_id", "o_totalprice": "streamflow", "o_orderdate": "time"}).df


@query(
    """
WITH p AS (SELECT event_id, event_type AS title, CASE WHEN user_id % 2 = 0 THEN 'm' END AS units FROM events)
SELECT event_id,
  title || '+x' AS append_title, coalesce(units || 'x', 'x') AS append_units,
  coalesce(units, 'c') AS create_units, title AS create_title,
  CAST(NULL AS VARCHAR) AS delete_title,
  CASE WHEN units IS NOT NULL THEN 'mod' END AS modify_units,
  units || 'n' AS if_exists_units, 'o' AS overwrite_units, 'p' || title AS prepend_title
FROM p"""
)
def attribute_modes(spark, d):
    m = F.map_filter(F.create_map(F.lit("title"), F.col("event_type"), F.lit("units"), F.when(F.col("user_id") % 2 == 0, "m")), lambda _, v: v.isNotNull())
    df = _t(spark, d, "events").select("event_id", m.alias("m"))
    edit = lambda name, value, mode: F.try_element_at(projections.attribute_map(F.col("m"), name, value, mode), F.lit(name))
    return df.select(
        "event_id", edit("title", "+x", "append").alias("append_title"), edit("units", "x", "append").alias("append_units"), edit("units", "c", "create").alias("create_units"), edit("title", "c", "create").alias("create_title"),
        edit("title", "", "delete").alias("delete_title"), edit("units", "mod", "modify").alias("modify_units"), edit("units", "n", "append_if_exists").alias("if_exists_units"), edit("units", "o", "overwrite").alias("overwrite_units"), edit("title", "p", "prepend").alias("prepend_title"),
    )


@query("SELECT event_id, round(value * 35.3146667, 3) AS cfs, round(value - 273.15, 3) AS celsius, round(value - 272.15, 3) AS celsius_compat, round(value / 25.4, 3) AS inches, round(value * 25.4, 3) AS mm FROM events")
def unit_conversions(spark, d):
    v, find = F.col("value"), units.find_conversion
    out = {"cfs": find("M3 S-1", "cfs"), "celsius": find("K", "C"), "celsius_compat": find("K", "C", compat=True), "inches": find("mm", "in"), "mm": find("in", "mm")}
    return _t(spark, d, "events").select("event_id", *[F.round(c(v), 3).alias(n) for n, c in out.items()])


@query("SELECT event_id, CAST(value * 3600.0 AS FLOAT) AS total FROM events")
def total_over_time(spark, d):
    return projections.total_over_time(_series(spark, d), "streamflow", "total").df.select("event_id", "total")


@query("SELECT user_id AS feature_id, min(ts) - INTERVAL 1 HOUR AS lower_bound, max(ts) AS upper_bound FROM events GROUP BY user_id")
def time_bounds(spark, d):
    return aggregates.bounds(_series(spark, d).df, "time", 3600, ["feature_id"])


@query("SELECT l_orderkey, l_linenumber, [l_quantity, l_discount, l_tax] AS stacked FROM lineitem")
def combine_to_array(spark, d):
    data = from_table(_t(spark, d, "lineitem"), ("l_orderkey", "l_linenumber"))
    return projections.combine(data, ["l_quantity", "l_discount", "l_tax"], "stacked", "band").df.select("l_orderkey", "l_linenumber", "stacked")


@query("SELECT o_orderkey, (SELECT CASE WHEN min(o_orderstatus) = max(o_orderstatus) THEN 'scalar' ELSE 'variable' END FROM orders) AS status_is, 'scalar' AS constant_is, CAST(7 AS INTEGER) AS constant FROM orders")
def uniform_collapse(spark, d):
    data = from_table(_t(spark, d, "orders").select("o_orderkey", "o_orderstatus").withColumn("constant", F.lit(7)), ("o_orderkey",))
    out = projections.uniform_collapse(data, ["o_orderstatus", "constant"])
    kind = lambda n: F.lit("scalar" if n in out.scalars else "variable")
    return out.df.select("o_orderkey", kind("o_orderstatus").alias("status_is"), kind("constant").alias("constant_is"), F.lit(out.scalars["constant"]).cast("int").alias("constant"))


@query("SELECT l_orderkey, l_linenumber, CAST(round_even(l_extendedprice / 0.01, 0) AS INTEGER) AS packed, round(round_even(l_extendedprice / 0.01, 0) * 0.01, 4) AS unpacked FROM lineitem")
def pack_and_unpack(spark, d):
    p = units.pack(F.col("l_extendedprice"))
    return _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", p.alias("packed"), F.round(units.unpack(p), 4).alias("unpacked"))


@query("SELECT event_id, user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS INTEGER) AS day FROM events")
def day_coordinate(spark, d):
    return scan.day_coordinate(_t(spark, d, "events").select("event_id", "user_id"), "event_id", ["user_id"])


@query("SELECT c_custkey, c_acctbal, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def extract_by_mask(spark, d):
    c = _t(spark, d, "customer")
    mask = c.join(_t(spark, d, "nation"), c.c_nationkey == F.col("n_nationkey")).join(_t(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("c_custkey", "r_name")
    return masks.extract(c.select("c_custkey", "c_acctbal"), mask, "c_custkey", names=["r_name"])


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def extract_single_mask(spark, d):
    mask = _t(spark, d, "orders").where("o_orderstatus = 'F'").select("o_custkey")
    return masks.extract(_t(spark, d, "customer").select("c_custkey", "c_name"), mask, "c_custkey", mask_id="o_custkey")


@query("SELECT DISTINCT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def missing_mask_ids(spark, d):
    return masks.missing_ids(_t(spark, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey")), _t(spark, d, "customer"), "c_custkey")


@query("SELECT c_custkey FROM customer INTERSECT SELECT o_custkey FROM orders")
def mask_intersection(spark, d):
    return masks.shared_ids(_t(spark, d, "customer"), _t(spark, d, "orders"), "c_custkey", "o_custkey")


@query(
    """
WITH g AS (SELECT vec_id AS y, unnest(range(0, len(embedding))) AS x, unnest(embedding) AS value, label FROM embeddings)
SELECT y, CAST(x AS INTEGER) AS x, CASE WHEN label % 2 = 1 AND x < 32 THEN value END AS value FROM g"""
)
def subset_grid_mask(spark, d):
    cells = _cells(spark, d)
    labels = _t(spark, d, "embeddings").select(F.col("vec_id").alias("y"), "label", F.explode(F.sequence(F.lit(0), F.size("embedding") - 1)).alias("x"))
    mask = labels.select("y", "x", ((F.col("label") % 2 == 1) & (F.col("x") < 32)).alias("keep"))
    return masks.subset(from_table(cells, ("y", "x")), mask, ["y", "x"]).df


@query("SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate < TIMESTAMP '1996-01-01'")
def label_slice_half_open(spark, d):
    bound = lambda x: F.lit(x).cast("timestamp_ntz")
    return _t(spark, d, "orders").select("o_orderkey", "o_orderdate").where(masks.half_open("o_orderdate", bound("1995-01-01"), bound("1996-01-01")))


@query("SELECT user_id, arg_min(event_id, (abs(value - 50.0), value, event_id)) AS event_id, arg_min(value, (abs(value - 50.0), value, event_id)) AS value FROM events GROUP BY user_id")
def nearest_label(spark, d):
    return masks.nearest(_t(spark, d, "events").select("user_id", "event_id", "value"), "value", 50.0, ["user_id"])


@query("SELECT o_orderkey, o_orderpriority FROM orders WHERE (o_orderstatus IS NULL OR o_orderstatus = 'O') AND (o_orderpriority IS NULL OR o_orderpriority = '1-URGENT')")
def include_conditions(spark, d):
    df = _t(spark, d, "orders").where(masks.include_conditions({"o_orderstatus": "O", "o_orderpriority": "1-URGENT"}))
    return df.select("o_orderkey", "o_orderpriority")


@query("SELECT event_id FROM events WHERE (user_id > 3 AND user_id <= 12 AND event_type <> 'click') OR event_type IN ('view', 'purchase') OR contains(event_type, 'art')")
def file_filter_and_or(spark, d):
    c = lambda f, o, v: {"field": f, "operator": o, "value": v}
    spec = {"or": [{"and": [c("user_id", ">", 3), c("user_id", "<=", 12), c("event_type", "!=", "click")]}, c("event_type", "in", ["view", "purchase"]), c("event_type", "contains", "art")]}
    return _t(spark, d, "events").where(masks.condition(spec)).select("event_id")


def _network(spark, d):
    c = _t(spark, d, "customer")
    to = F.when(F.col("c_custkey") % 4 == 0, F.lit(-1)).otherwise(F.floor(F.col("c_custkey") / 4)).cast("long")
    return c, c.select(F.col("c_custkey").alias("link"), to.alias("to"))


@query(
    """
SELECT a.c_custkey AS feature_id, CAST(round(u.s, 2) AS FLOAT) AS upstream_flow FROM customer a LEFT JOIN (
  SELECT c_custkey // 4 AS t, sum(CAST(c_acctbal AS DECIMAL(18, 2))) AS s FROM customer WHERE c_custkey % 4 <> 0 GROUP BY 1
) u ON a.c_custkey = u.t"""
)
def upstream_flow(spark, d):
    c, links = _network(spark, d)
    flow = c.select(F.col("c_custkey").alias("feature_id"), F.col("c_acctbal").cast("decimal(18,2)").alias("streamflow"))
    return masks.upstream_sum(flow, links, "streamflow", "upstream_flow").select("feature_id", "upstream_flow")


@query(
    """
SELECT a.c_custkey AS feature_id, CAST(u.s AS FLOAT) AS upstream_flow FROM customer a LEFT JOIN (
  SELECT c_custkey // 4 AS t, CASE WHEN count(*) = count(v) THEN sum(v) END AS s
  FROM (SELECT c_custkey, CASE WHEN c_custkey % 5 <> 0 THEN CAST(c_acctbal AS DECIMAL(18, 2)) END AS v FROM customer)
  WHERE c_custkey % 4 <> 0 GROUP BY 1
) u ON a.c_custkey = u.t"""
)
def upstream_null_propagation(spark, d):
    c, links = _network(spark, d)
    flow = c.select(F.col("c_custkey").alias("feature_id"), F.when(F.col("c_custkey") % 5 != 0, F.col("c_acctbal").cast("decimal(18,2)")).alias("streamflow"))
    return masks.upstream_sum(flow, links, "streamflow", "upstream_flow").select("feature_id", "upstream_flow")


@query("SELECT c_custkey // 4 AS \"to\", count(*) AS n_inbound FROM customer WHERE c_custkey % 4 <> 0 GROUP BY 1")
def inbound_edges(spark, d):
    return masks.inbound_edges(_network(spark, d)[1])


@query("SELECT c_custkey, coalesce(min(o_orderkey), -1) AS first_order FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey")
def reindex_fill(spark, d):
    orders = _t(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderkey").alias("first_order"))
    return masks.reindex(orders, _t(spark, d, "customer"), "c_custkey", {"first_order": -1})


@query("SELECT user_id AS feature_id, round(sum(value), 4) AS v_sum, min(value) AS v_min, max(value) AS v_max, round(avg(value) + 1e-9, 4) AS v_mean FROM events GROUP BY user_id")
def online_sum_min_max_mean(spark, d):
    out = aggregates.stream_fold(_series(spark, d), [{"variable": "streamflow", "operation": o, "output_variable": f"v_{o}"} for o in ("sum", "min", "max", "mean")], ["feature_id"])
    return out.df.withColumns({"v_sum": F.round("v_sum", 4), "v_mean": _rounded("v_mean")})


@query(
    """SELECT user_id AS feature_id, round(var_pop(value) + 1e-9, 4) AS v, round(stddev_pop(value) + 1e-9, 4) AS s, round(var_samp(value) + 1e-9, 4) AS vs,
  round(sum(value * value) / (count(value) + 1) - (sum(value) / (count(value) + 1)) * (sum(value) / (count(value) + 1)) + 1e-9, 4) AS vc
FROM events GROUP BY user_id HAVING count(value) > 1"""
)
def online_variance(spark, d):
    folds = [("streamflow", "variance", "v"), ("streamflow", "std", "s"), ("streamflow", "variance_sample", "vs"), ("streamflow", "variance_compat", "vc")]
    out = aggregates.fold_cells(_series(spark, d).df, ["feature_id"], folds).where("v is not null")
    return out.select("feature_id", *[_rounded(o).alias(o) for _, _, o in folds])


@query("SELECT user_id AS feature_id, round(median(value), 6) AS v FROM events GROUP BY user_id")
def online_median(spark, d):
    return aggregates.fold_cells(_series(spark, d).df, ["feature_id"], [("streamflow", "median", "v")]).select("feature_id", F.round("v", 6).alias("v"))


@query("SELECT l_orderkey, l_suppkey, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_ids(spark, d):
    return aggregates.duplicate_ids(_t(spark, d, "lineitem"), "l_orderkey", "l_suppkey")


@query(
    """SELECT event_type, user_id, max(value) AS max_duration, min(value) AS min_duration, count(value) AS calls, round(avg(value) + 1e-9, 4) AS mean_duration, round(sum(value), 4) AS total_duration
FROM events GROUP BY 1, 2 HAVING min(value) >= 1 ORDER BY max(value) DESC, avg(value) DESC, event_type, user_id LIMIT 15"""
)
def timing_stats_topk(spark, d):
    out = aggregates.timing_statistics(_t(spark, d, "events"), ["event_type", "user_id"], "value", 1.0)
    return out.withColumns({"mean_duration": _rounded("mean_duration"), "total_duration": F.round("total_duration", 4)})


@query(
    f"""
WITH e AS (SELECT user_id, value, ts, {SECONDS} AS lead, {BUCKET} AS bucket FROM events),
b AS (SELECT bucket, max(lead) AS last, min(ts) - INTERVAL 1 HOUR AS bound_low, max(ts) AS bound_high FROM e GROUP BY 1)
SELECT e.bucket, e.user_id AS feature_id, round(avg(value) + 1e-9, 4) AS mean_flow, any_value(bound_high) AS bound_high,
  any_value(CASE WHEN last >= 86400 AND last % 86400 = 0 THEN 'day' || (last // 86400) ELSE (last // 3600) || 'hours' END) AS "group", any_value(bound_low) AS bound_low
FROM e JOIN b USING (bucket) GROUP BY 1, 2"""
)
def group_by_lead_mean(spark, d):
    out = aggregates.group_by_lead(_series(spark, d).df, "lead_seconds", 86400, ["feature_id"], [("streamflow", "mean", "mean_flow")], "time")
    return out.withColumn("mean_flow", _rounded("mean_flow"))


@query("SELECT o_orderkey, CAST(dayofyear(o_orderdate) + CASE WHEN dayofyear(o_orderdate) > 59 AND NOT ((year(o_orderdate) % 4 = 0 AND year(o_orderdate) % 100 <> 0) OR year(o_orderdate) % 400 = 0) THEN 1 ELSE 0 END AS INTEGER) AS day FROM orders")
def universal_day_of_year(spark, d):
    return _t(spark, d, "orders").select("o_orderkey", calendar.universal_day(F.col("o_orderdate")).alias("day"))


@query("SELECT event_id, round(value - lag(value) OVER (PARTITION BY user_id ORDER BY event_id), 6) AS diff FROM events")
def first_difference(spark, d):
    df = _t(spark, d, "events").select("event_id", "user_id", "value")
    return masks.first_difference(df, "value", "event_id", ["user_id"]).select("event_id", F.round("diff", 6).alias("diff"))


_CLIMATE = "SELECT user_id, quantile_cont(value, 0.05) AS p05, quantile_cont(value, 0.25) AS p25, quantile_cont(value, 0.75) AS p75, quantile_cont(value, 0.95) AS p95 FROM events GROUP BY user_id"


@query(f"SELECT event_id, CAST(CASE WHEN value < round(p05, 6) THEN -5 WHEN value < round(p25, 6) THEN -3 WHEN value < round(p75, 6) THEN 0 WHEN value < round(p95, 6) THEN 1.5 ELSE 3 END AS FLOAT) AS anomaly FROM events JOIN ({_CLIMATE}) USING (user_id)")
def anomaly_scores(spark, d):
    data = _series(spark, d)
    cols = {f"p{int(p * 100):02d}": p for p in (0.05, 0.25, 0.75, 0.95)}
    climate = data.df.groupBy("feature_id").agg(*[F.round(F.percentile("streamflow", F.lit(p)), 6).alias(c) for c, p in cols.items()])
    return masks.anomaly(data, "streamflow", climate, {"p05": -5, "p25": -3, "p75": 0, "p95": 1.5}, 3, ["feature_id"], "anomaly").df.select("event_id", "anomaly")


@query(f"SELECT user_id AS feature_id, round(p05, 6) AS p05, round(p25, 6) AS p25, round(p75, 6) AS p75, round(p95, 6) AS p95 FROM ({_CLIMATE})")
def climatology_quantiles(spark, d):
    cols = {f"p{int(p * 100):02d}": p for p in (0.05, 0.25, 0.75, 0.95)}
    out = aggregates.quantiles(_series(spark, d).df, "streamflow", cols, ["feature_id"])
    return out.select("feature_id", *[F.round(c, 6).alias(c) for c in cols])


@query("SELECT vec_id AS y, CAST(unnest(range(0, len(embedding))) AS INTEGER) AS x, unnest(embedding) AS value FROM embeddings")
def grid_explode(spark, d):
    return _cells(spark, d)


@query(
    """
WITH g AS (SELECT vec_id AS y, unnest(range(0, len(embedding))) AS x, unnest(embedding) AS value FROM embeddings),
n AS (SELECT CAST(count(DISTINCT y) AS BIGINT) AS h FROM g),
t AS (SELECT CAST(floor(i // 32) AS INTEGER) AS ty, CAST(i % 32 AS INTEGER) AS tx FROM range(0, (SELECT (h // 4) * 32 FROM n)) r(i))
SELECT 1.5 + 4.0 * ty AS y, 0.5 + 2.0 * tx AS x, g.value FROM t LEFT JOIN g ON g.y = CAST(floor(1.5 + 4.0 * ty + 0.5) AS BIGINT) AND g.x = CAST(floor(0.5 + 2.0 * tx + 0.5) AS BIGINT)"""
)
def grid_reproject_nearest(spark, d):
    cells = _cells(spark, d)
    source = grid.grid_of(cells)
    target = grid.Grid(grid.Axis(0.5, 2.0, 32), grid.Axis(1.5, 4.0, source.y.size // 4))
    return grid.reproject(from_table(cells, ("y", "x")), source, target, ["value"]).df


@query("SELECT vec_id AS y, CAST(unnest(range(0, len(embedding))) AS INTEGER) AS x, unnest(embedding) AS value FROM embeddings")
def grid_identity_reproject(spark, d):
    cells = _cells(spark, d)
    own = grid.grid_of(cells)
    return grid.reproject(from_table(cells, ("y", "x")), own, grid.grid_of(cells), ["value"]).df


@query(
    """
WITH g AS (SELECT vec_id AS y, unnest(range(0, len(embedding))) AS x FROM embeddings),
s AS (SELECT (max(x) - min(x)) / (count(DISTINCT x) - 1) AS a, (max(y) - min(y)) / (count(DISTINCT y) - 1) AS e, min(x) AS x0, min(y) AS y0 FROM g)
SELECT CAST(a AS DOUBLE) AS a, CAST(x0 - a / 2 AS DOUBLE) AS c, CAST(e AS DOUBLE) AS e, CAST(y0 - e / 2 AS DOUBLE) AS f FROM s"""
)
def affine_from_axes(spark, d):
    a, _, c, _, e, f = grid.grid_of(_cells(spark, d)).affine()
    return spark.createDataFrame([(a, c, e, f)], "a double, c double, e double, f double")


@query("SELECT user_id AS feature_id, ts AS time, CAST(value AS FLOAT) AS streamflow FROM events UNION ALL SELECT o_custkey, o_orderdate, CAST(o_totalprice AS FLOAT) FROM orders")
def merge_union(spark, d):
    e = _t(spark, d, "events").select(F.col("user_id").alias("feature_id"), F.col("ts").alias("time"), F.col("value").alias("streamflow"))
    o = _t(spark, d, "orders").select(F.col("o_orderdate").alias("time"), F.col("o_totalprice").alias("streamflow"), F.col("o_custkey").alias("feature_id"))
    files = e.withColumn("file", F.lit("events")).unionByName(o.withColumn("file", F.lit("orders")), allowMissingColumns=True)
    data = from_table(files, ("feature_id", "time"), file_key=("file",))
    return Profile.from_dict({"operations": [{"operation": "merge", "narrow": True}]}).run(data).df


@query("SELECT user_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY user_id")
def merge_metadata_last_wins(spark, d):
    return masks.last_wins(_t(spark, d, "events"), "user_id", "event_type", "event_id")


@query(
    """SELECT 'high' AS branch, event_id, round(value * 35.3146667, 6) AS streamflow FROM events WHERE value > 50
UNION ALL SELECT 'low', event_id, value FROM events WHERE value <= 50"""
)
def branch_union(spark, d):
    data = _series(spark, d)
    c = lambda o: {"operation": "file_filter", "on": {"field": "streamflow", "operator": o, "value": 50}}
    profile = Profile.from_dict({"operations": [{"operation": "branch", "persist": False, "branches": {"high": [c(">"), {"operation": "unit_conversion", "conversions": [{"variable_name": "streamflow", "target_unit": "cfs"}]}], "low": [c("<=")]}}]})
    out = profile.run(data).df
    return out.select("branch", "event_id", F.when(F.col("branch") == "high", F.round("streamflow", 6)).otherwise(F.col("streamflow")).alias("streamflow"))


@query("SELECT date_trunc('month', o_orderdate) AS file, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1")
def on_each_file(spark, d):
    df = _t(spark, d, "orders").select(F.date_trunc("month", "o_orderdate").cast("timestamp_ntz").alias("file"), F.col("o_totalprice").alias("price"))
    profile = Profile.from_dict({"operations": [{"operation": "on_each", "on_each": [{"operation": "function", "function": "per_file"}]}]})

    def per_file(data: Dataset, context: Context) -> Dataset:
        return data.with_df(aggregates.fold_cells(data.df, list(data.file_key), [("price", "count", "n"), ("price", "sum", "total")]))

    out = profile.run(from_table(df, (), file_key=("file",)), Context(functions={"per_file": per_file})).df
    return out.select("file", "n", F.round("total", 2).alias("total"))


@query("SELECT user_id AS feature_id, round(sum(value * 2), 4) AS doubled FROM events GROUP BY user_id")
def function_registry(spark, d):
    def double(data: Dataset, context: Context, variable: str) -> Dataset:
        return data.with_columns({variable: F.col(variable) * 2})

    ops = [{"operation": "function", "function": "double", "kwargs": {"variable": "{name}"}}, {"operation": "stream", "operations": [{"variable": "streamflow", "operation": "sum", "output_variable": "doubled"}]}]
    out = Profile.from_dict({"operations": ops}).run(_series(spark, d), Context(functions={"double": double}, values={"name": "streamflow"})).df
    return out.select("feature_id", F.round("doubled", 4).alias("doubled"))


@query("SELECT DISTINCT o_orderstatus, o_orderpriority, o_orderstatus || '/' || o_orderpriority || '.out' AS target FROM orders WHERE o_orderstatus IS NULL OR o_orderstatus = 'F'")
def save_targets(spark, d):
    return sinks.save_targets(_t(spark, d, "orders"), "{o_orderstatus}/{o_orderpriority}.out", {"o_orderstatus": "F"})


@query("SELECT o_orderstatus || '.out' AS target, count(*) AS n FROM (SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders) GROUP BY 1 HAVING count(*) > 1")
def save_duplicate_targets(spark, d):
    return sinks.duplicate_targets(sinks.save_targets(_t(spark, d, "orders"), "{o_orderstatus}.out", keys=["o_orderpriority"]))


_NAME = "printf('nwm.t%02dz.short_range.channel_rt%s.%s.conus.nc', o_orderkey % 24, CASE WHEN o_orderkey % 3 = 0 THEN '_' || (o_orderkey % 7 + 1) ELSE '' END, CASE WHEN o_orderkey % 5 = 0 THEN printf('tm%02d', o_orderkey % 28) ELSE printf('f%03d', o_orderkey % 241) END)"


def _names(spark, d):
    k = F.col("o_orderkey")
    member = F.when(k % 3 == 0, F.concat(F.lit("_"), (k % 7 + 1).cast("string"))).otherwise("")
    frame = F.when(k % 5 == 0, F.format_string("tm%02d", k % 28)).otherwise(F.format_string("f%03d", k % 241))
    return _t(spark, d, "orders").select(k, F.format_string("nwm.t%02dz.short_range.channel_rt%s.%s.conus.nc", k % 24, member, frame).alias("name"))


@query(
    f"""
WITH n AS (SELECT o_orderkey, {_NAME} AS name FROM orders),
p AS (SELECT o_orderkey, regexp_extract(name, '\\.t(\\d+)z\\.', 1) AS cycle, nullif(regexp_extract(name, 'channel_rt_(\\d+)', 1), '') AS member, regexp_extract(name, '\\.(f\\d+|tm\\d+)\\.', 1) AS frame FROM n)
SELECT o_orderkey, cycle, 'short_range' AS configuration, 'channel_rt' AS output_type, member, frame, 'conus' AS region,
  CASE WHEN frame LIKE 'tm%' THEN -3600 * CAST(substr(frame, 3) AS BIGINT) ELSE 3600 * CAST(substr(frame, 2) AS BIGINT) END AS lead_seconds FROM p"""
)
def parse_filename(spark, d):
    return scan.with_identity(_names(spark, d), F.col("name")).drop("name")


@query(f"SELECT o_orderkey, {_NAME} AS name FROM orders")
def render_filename(spark, d):
    p = scan.with_identity(_names(spark, d), F.col("name"))
    name = text.render_file_name(F.col("cycle"), F.col("configuration"), F.col("output_type"), F.col("member"), F.col("lead_seconds"), F.col("region"))
    return p.select("o_orderkey", F.when(F.col("frame") == "tm00", F.regexp_replace(name, "f000", "tm00")).otherwise(name).alias("name"))


@query("SELECT event_id, CAST((event_id % 40) * 86400 + (event_id % 24) * 3600 + (event_id % 60) * 60 + event_id % 50 AS DOUBLE) AS seconds, printf('P%02dDT%02dH%02dM%02dS', event_id % 40, event_id % 24, event_id % 60, event_id % 50) AS again FROM events")
def parse_iso_duration(spark, d):
    k = F.col("event_id")
    iso = F.format_string("P%dDT%dH%dM%dS", k % 40, k % 24, k % 60, k % 50)
    df = _t(spark, d, "events").select("event_id", calendar.duration_seconds(iso).alias("seconds"))
    return df.withColumn("again", calendar.format_duration(F.col("seconds")))


@query("SELECT event_id, strftime(ts, '%Y%m%d') AS time__date, strftime(ts, '%H') AS time__hour, strftime(ts, '%M') AS time__minute, strftime(ts, '%S') AS time__second, strftime(ts, '%d') AS time__day, strftime(ts, '%m') AS time__month, strftime(ts, '%Y') AS time__year FROM events")
def date_parts(spark, d):
    return _t(spark, d, "events").select("event_id", *[c.alias(n) for n, c in calendar.date_parts("time", F.col("ts")).items()])


@query("SELECT DISTINCT p_type, list_aggregate([upper(w[1]) || lower(w[2:]) FOR w IN string_split(p_type, ' ')], 'string_agg', ' ') AS title FROM part")
def title_case(spark, d):
    return _t(spark, d, "part").select("p_type", text.titled(F.regexp_replace(F.lower("p_type"), " ", "_")).alias("title")).distinct()


@query("SELECT n_nationkey, CASE n_nationkey % 3 WHEN 0 THEN 'NWRFC' WHEN 1 THEN 'OHRFC' END AS code, CASE n_nationkey % 3 WHEN 0 THEN 'Northwest River Forecast Center' WHEN 1 THEN 'Ohio River Valley River Forecast Center' END AS long_name FROM nation")
def center_lookup(spark, d):
    given = F.when(F.col("n_nationkey") % 3 == 0, "nwrfc").when(F.col("n_nationkey") % 3 == 1, "ohio river valley river forecast center").otherwise("nowhere")
    return _t(spark, d, "nation").select("n_nationkey", text.center_code(given).alias("code")).withColumn("long_name", text.center_name(F.col("code")))


@query("SELECT o_orderkey, format('{:,.2f}', o_totalprice) AS price, format('{:,}', o_orderkey) AS key, strftime(o_orderdate, '%Y-%m-%d %H:%M') AS day FROM orders")
def format_value(spark, d):
    f = text.format_value
    return _t(spark, d, "orders").select("o_orderkey", f(F.col("o_totalprice"), "double").alias("price"), f(F.col("o_orderkey"), "long").alias("key"), f(F.col("o_orderdate"), "timestamp").alias("day"))


@query(
    """
WITH j AS (SELECT event_id, event_type AS a, CASE WHEN event_id % 2 = 0 THEN CAST(user_id AS VARCHAR) ELSE '' END AS b, CASE WHEN event_id % 3 = 0 THEN ' x ' END AS c FROM events)
SELECT event_id, a AS item FROM j UNION ALL SELECT event_id, b FROM j WHERE b <> '' UNION ALL SELECT event_id, trim(c) FROM j WHERE c IS NOT NULL"""
)
def unpivot_jagged(spark, d):
    k = F.col("event_id")
    df = _t(spark, d, "events").select("event_id", F.col("event_type").alias("a"), F.when(k % 2 == 0, F.col("user_id").cast("string")).otherwise("").alias("b"), F.when(k % 3 == 0, " x ").alias("c"))
    return scan.unpivot_jagged(df, ["event_id"], ["a", "b", "c"], "item")


@query("SELECT ts AS time, value AS streamflow FROM events WHERE user_id = 7")
def point_series(spark, d):
    return scan.point_series(_series(spark, d), "feature_id", 7, ["streamflow"])


@query("SELECT event_id, event_type, value * 2 AS value FROM events WHERE event_type = 'click'")
def profile_selection(spark, d):
    """Of several profiles the one for the files at hand, run on them."""
    keep = lambda kind, times: [{"operation": "file_filter", "on": {"field": "event_type", "operator": "==", "value": kind}}, {"operation": "expression", "expressions": {"value": f"value * {times}"}}]
    base = {"region": "conus", "configuration": "short_range", "output_type": "channel_rt"}
    specs = [base | {"operations": keep("click", 2)}, base | {"region": "hawaii", "operations": keep("view", 3)}, base | {"output_type": "land", "operations": keep("view", 4)}, base | {"configuration": "medium_range", "member": "1", "operations": keep("click", 5)}]
    profiles = {str(k): Profile.from_json(json.dumps(s)) for k, s in enumerate(specs)}
    data = from_table(_t(spark, d, "events").select("event_id", "event_type", "value"), ("event_id",))
    return select_profile(profiles, "conus", "short_range", "channel_rt").run(data).df


@query("SELECT event_id, event_type, value FROM events WHERE event_type IN ('view', 'click') AND user_id = 3")
def select_labels(spark, d):
    return scan.select_label(_t(spark, d, "events"), {"event_type": ["view", "click"], "user_id": 3}, ["event_id", "event_type", "value"])


@query("SELECT event_id, CASE WHEN user_id % 4 = 0 THEN 'int' WHEN user_id % 4 = 1 THEN 'int64' WHEN user_id % 4 = 2 THEN 'double' ELSE 'char' END AS kind FROM events")
def literal_types(spark, d):
    k = F.col("user_id") % 4
    lit = F.when(k == 0, F.lit("12")).when(k == 1, F.lit("99999999999")).when(k == 2, F.lit("1.5e3")).otherwise(F.lit('"12"'))
    return _t(spark, d, "events").select("event_id", text.literal_type(lit).alias("kind"))


@query("SELECT s_suppkey, CASE WHEN s_suppkey * 1234567 < 1000 THEN printf('%.2f B', s_suppkey * 1234567.0) WHEN s_suppkey * 1234567 < 1000000 THEN printf('%.2f KB', s_suppkey * 1234567 / 1e3) WHEN s_suppkey * 1234567 < 1000000000 THEN printf('%.2f MB', s_suppkey * 1234567 / 1e6) ELSE printf('%.2f GB', s_suppkey * 1234567 / 1e9) END AS size FROM supplier")
def human_sizes(spark, d):
    return _t(spark, d, "supplier").select("s_suppkey", text.human_bytes(F.col("s_suppkey") * 1234567).alias("size"))


@query("SELECT p_partkey, CASE WHEN p_size % 10 <> 0 THEN p_retailprice / (p_size % 10) END AS ratio FROM part")
def masked_divide(spark, d):
    return _t(spark, d, "part").select("p_partkey", units.masked_divide(F.col("p_retailprice"), (F.col("p_size") % 10).cast("double")).alias("ratio"))


@query(
    f"""
WITH e AS (SELECT user_id, value, {SECONDS} AS lead, {BUCKET} AS bucket FROM events),
b AS (SELECT bucket, max(lead) AS last FROM e GROUP BY 1)
SELECT e.user_id AS feature_id, round(avg(value * 35.3146667) + 1e-9, 4) AS mean_flow,
  CASE WHEN last >= 86400 AND last % 86400 = 0 THEN 'day' || (last // 86400) ELSE (last // 3600) || 'hours' END AS "group"
FROM e JOIN b USING (bucket) GROUP BY 1, 3"""
)
def flagship_forecast_profile(spark, d):
    """A whole profile: keep what is needed, convert units, group by lead day, average each group's files."""
    profile = Profile.from_dict(
        {
            "operations": [
                {"operation": "drop", "fields": ["feature_id", "time", "streamflow", "lead_seconds"], "exclude": True},
                {"operation": "unit_conversion", "conversions": [{"variable_name": "streamflow", "target_unit": "cfs"}]},
                {"operation": "group_by", "amount_of_time": 1, "time_unit": "days", "on_each": [{"operation": "stream", "operations": [{"variable": "streamflow", "operation": "mean", "output_variable": "mean_flow"}]}]},
            ]
        }
    )
    out = profile.run(_series(spark, d)).df
    return out.select("feature_id", "group", _rounded("mean_flow").alias("mean_flow"))


from rivulet import queries_files, queries_formats  # noqa: E402, F401  registers the queries of sources, sinks, profiles, formats and streams
