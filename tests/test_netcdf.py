"""The classic format: bytes written by hand against the reader, partitions against filters, all-or-nothing writes."""

import os
import struct
from datetime import datetime, timezone

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual, LessThan

from rivulet.model import from_table
from rivulet.plans.operations import Context
from rivulet.plans.profile import Profile
from rivulet.sources import netcdf as nc


def named(text):
    data = text.encode()
    return struct.pack(">i", len(data)) + data.ljust((len(data) + 3) // 4 * 4, b"\0")


def by_hand(path, version=1):
    """Records of three times, each with a packed value a place and one odd byte; written out field by field."""
    offset = (lambda x: struct.pack(">i", x)) if version == 1 else (lambda x: struct.pack(">q", x))
    units = b"minutes since 2024-01-01 06:00"
    text_attr = lambda n, v: named(n) + struct.pack(">ii", 2, len(v)) + v.ljust((len(v) + 3) // 4 * 4, b"\0")
    head = b"CDF" + bytes([version]) + struct.pack(">i", 3)
    head += struct.pack(">ii", 10, 2) + named("time") + struct.pack(">i", 0) + named("x") + struct.pack(">i", 5)
    head += struct.pack(">ii", 12, 1) + text_attr("title", b"by hand")
    fields = [
        ("time", [0], struct.pack(">ii", 12, 1) + text_attr("units", units), 4, 4),
        ("flow", [0, 1], struct.pack(">ii", 12, 2) + named("scale_factor") + struct.pack(">iid", 6, 1, 0.5) + named("_FillValue") + struct.pack(">iih", 3, 1, -9) + b"\0\0", 3, 12),
        ("flag", [0, 1], struct.pack(">ii", 0, 0), 1, 8),
        ("x", [1], struct.pack(">ii", 0, 0), 5, 20),
    ]
    size = len(head) + 8 + sum(len(named(n)) + 4 + 4 * len(d) + len(a) + 8 + len(offset(0)) for n, d, a, _, _ in fields)
    at = {"x": size, "time": size + 20, "flow": size + 24, "flag": size + 36}
    head += struct.pack(">ii", 11, 4)
    for n, d, a, code, vsize in fields:
        head += named(n) + struct.pack(f">i{len(d)}i", len(d), *d) + a + struct.pack(">ii", code, vsize) + offset(at[n])
    assert len(head) == size
    body = struct.pack(">5f", *[10.0, 20.0, 40.0, 80.0, 160.0])
    for t in range(3):
        body += struct.pack(">i", 60 * t) + struct.pack(">5h", *[10 * t + k if k != 2 else -9 for k in range(5)]) + b"\0\0" + struct.pack(">5b", *range(t, t + 5)) + b"\0\0\0"
    with open(path, "wb") as f:
        f.write(head + body)


@pytest.mark.parametrize("version", [1, 2])
@pytest.mark.parametrize("slab_bytes", [6, 20, 1 << 20])
def test_file_by_hand(spark, tmp_path, version, slab_bytes):
    by_hand(f"{tmp_path}/a.nc", version)
    rows = nc.read_netcdf(spark, f"{tmp_path}/a.nc", slab_bytes=slab_bytes).orderBy("time", "x").collect()
    assert [(r.time.astimezone(timezone.utc).hour, r.x, r.flow, r.flag, r.file) for r in rows] == [(6 + t, 10.0 * 2**k, None if k == 2 else (10 * t + k) / 2, t + k, "a.nc") for t in range(3) for k in range(5)]
    raw = nc.read_netcdf(spark, f"{tmp_path}/a.nc", ["flow"], decode=False, slab_bytes=slab_bytes)
    assert dict(raw.dtypes)["flow"] == "smallint" and raw.where("flow = -9").count() == 3
    data = nc.netcdf_dataset(spark, str(tmp_path), ["flow"])
    assert data.attrs == {"title": "by hand"} and data.encoding["flow"] == {"scale_factor": 0.5, "_FillValue": -9} and data.dims == ("time", "x")


def test_slabs_follow_filters(tmp_path):
    by_hand(f"{tmp_path}/a.nc")
    reader = nc.NetcdfReader({"path": f"{tmp_path}/a.nc", "variables": "flow", "slab_bytes": "4"})
    tests = [GreaterThanOrEqual(("x",), 20.0), LessThan(("x",), 100.0), EqualTo(("time",), datetime(2024, 1, 1, 7, tzinfo=timezone.utc))]
    assert list(reader.pushFilters(tests)) == tests
    boxes = [s.box for s in reader.partitions()]
    assert sorted(boxes) == [[(1, 2), (1, 3)], [(1, 2), (3, 4)]]
    nothing = nc.NetcdfReader({"path": f"{tmp_path}/a.nc", "variables": "flow"})
    list(nothing.pushFilters([EqualTo(("x",), 11.0)]))
    assert [s.path for s in nothing.partitions()] == [""]


def test_one_header_for_all_files(spark, tmp_path):
    for k in range(3):
        by_hand(f"{tmp_path}/{k}.nc")
    read = nc.read_netcdf(spark, f"{tmp_path}/*.nc", ["flag"], same_layout=True).where("x between 20 and 40")
    assert read.count() == 18 and read.where("flag = 6").count() == 0
    by_hand(f"{tmp_path}/9.nc", 2)
    with pytest.raises(Exception, match="another layout"):
        nc.read_netcdf(spark, str(tmp_path), ["flag"], same_layout=True).count()


def test_boxes_of_any_shape(tmp_path):
    rng = np.random.default_rng(3)
    a = rng.integers(-1000, 1000, (4, 5, 6)).astype(np.int16)
    with open(f"{tmp_path}/a.nc", "wb") as f:
        f.write(b"".join(nc.file_bytes({"t": 4, "y": 5, "x": 6}, [("v", ("t", "y", "x"), a, {}), ("n", ("y",), np.arange(5), {"k": [1, 2]})], {"title": "é"})))
    with nc.open_file(f"{tmp_path}/a.nc") as f:
        h = nc.read_header(f)
        assert h.version == 5 and h.attrs == {"title": "é"} and h.variables["n"].attrs == {"k": [1, 2]}
        assert nc.read_box(f, h, h.variables["n"], [(1, 4)]).tolist() == [1, 2, 3]
        for _ in range(100):
            box = [tuple(sorted(rng.choice(n + 1, 2, replace=False).tolist())) for n in a.shape]
            assert (nc.read_box(f, h, h.variables["v"], box) == a[tuple(slice(*b) for b in box)]).all()
            pieces = list(nc._slabs(box, 2, int(rng.integers(2, 60))))
            seen = np.zeros(a.shape, int)
            for p in pieces:
                seen[tuple(slice(*b) for b in p)] += 1
            want = np.zeros(a.shape, int)
            want[tuple(slice(*b) for b in box)] = 1
            assert (seen == want).all()


def cells(spark, extra=None):
    rows = [(k % 3, float(y), "abc"[:y], None if (k + y) % 4 == 0 else k + y / 10, datetime(2024, 1, 1 + y)) for k in range(7) for y in range(3)]
    return spark.createDataFrame([(k, *r) for k, r in zip([k for k in range(7) for _ in range(3)], rows)], "x int, part int, y double, word string, v double, at timestamp")


def test_missing_cells_texts_and_types(spark, tmp_path):
    df = cells(spark).where("not (x = 3 and y = 1)")
    data = from_table(df, ("x", "y"), attrs={"n": 3}, var_attrs={"v": {"units": "m"}})
    targets = nc.write_files(data, str(tmp_path / "out"), "sub/p_{part}.nc")
    assert sorted(r.target for r in targets.collect()) == ["sub/p_0.nc", "sub/p_1.nc", "sub/p_2.nc"]
    back = nc.read_netcdf(spark, f"{tmp_path}/out/sub")
    have = {(r.x, r.y): (r.word or "", r.v, r.at) for r in back.collect()}
    want = {(r.x, r.y): (r.word, r.v, r.at) for r in df.collect()}
    assert {k: v for k, v in have.items() if k in want} == want
    assert set(have) - set(want) == {(3, 1.0)} and have[3, 1.0] == ("", None, None)


def test_all_or_nothing(spark, tmp_path):
    out = str(tmp_path / "out")
    good = from_table(cells(spark).drop("word"), ("x", "y"))
    nc.write_files(good, out, "p_{part}.nc")
    before = {f: os.path.getmtime(f"{out}/{f}") for f in os.listdir(out)}
    more = good.with_df(good.df.withColumn("part", F.col("part") + 2))
    with pytest.raises(Exception, match="not written: p_2.nc"):
        nc.write_files(more, out, "p_{part}.nc")
    assert {f: os.path.getmtime(f"{out}/{f}") for f in os.listdir(out)} == before
    # A task that fails, here over two rows of one cell, leaves nothing of the others either.
    twice = good.with_df(good.df.unionByName(good.df.where("x = 1 and y = 1")).withColumn("part", F.col("part") + 10))
    with pytest.raises(Exception, match="one cell"):
        nc.write_files(twice, out, "p_{part}.nc")
    assert {f: os.path.getmtime(f"{out}/{f}") for f in os.listdir(out)} == before
    shared = from_table(good.df.withColumn("file", F.concat(F.lit("f"), F.col("x"))), ("x", "y"), file_key=("file",))
    with pytest.raises(FileExistsError, match="several files"):
        nc.write_files(shared, out, "q_{part}.nc")


def test_profile_saves_netcdf(spark, tmp_path):
    data = from_table(cells(spark).select("x", "y", "v", "part"), ("x", "y"))
    profile = Profile.from_dict({"operations": [{"operation": "save", "directory": str(tmp_path / "o"), "filename_pattern": "{run}_{part}.nc", "file_format": "netcdf", "pack_values": True}]})
    context = Context(values={"run": "r1"})
    profile.run(data, context)
    assert [p.rpartition("/")[2] for p in context.saved] == ["r1_0.nc", "r1_1.nc", "r1_2.nc"]
    back = nc.netcdf_dataset(spark, str(tmp_path / "o"))
    assert back.encoding["v"]["scale_factor"] == 0.01
    assert {(r.x, r.y): r.v for r in back.df.collect() if r.v is not None} == {(r.x, r.y): pytest.approx(r.v) for r in data.df.collect() if r.v is not None}


def test_refusals(spark, tmp_path):
    with open(f"{tmp_path}/no.nc", "wb") as f:
        f.write(b"\x89HDF....")
    with pytest.raises(Exception, match="no classic NetCDF"):
        nc.read_netcdf(spark, f"{tmp_path}/no.nc").count()
    by_hand(f"{tmp_path}/a.nc")
    with pytest.raises(Exception, match="no variable gone"):
        nc.read_netcdf(spark, f"{tmp_path}/a.nc", ["gone"])
    with pytest.raises(Exception, match="different tables"):
        nc.read_netcdf(spark, f"{tmp_path}/a.nc", ["flow", "time"])
    assert nc.list_files(f"{tmp_path}/a*") == [f"{tmp_path}/a.nc"]


def test_unsigned_and_wide_types():
    a = pa.table({"k": pa.array([1, 2], pa.int64()), "u": pa.array([200, None], pa.uint8()), "b": pa.array([True, False]), "s": pa.array(["é", None])})
    data = b"".join(nc.target_file(a, ["k"], {}, {}, {}))
    h = nc.read_header(pa.BufferReader(data))
    assert h.version == 5 and {v.name: v.code for v in h.variables.values()} == {"k": 10, "u": 7, "b": 1, "s": 2}


def test_grid_of_a_projection_file(spark, tmp_path):
    from rivulet.operators.grid import Axis, Grid

    rows = spark.createDataFrame([(float(y), x * 0.5, 1.0) for y in (3, 2, 1) for x in range(4)], "lat double, lon double, v double")
    data = from_table(rows, ("lat", "lon"), scalars={"crs": 0}, var_attrs={"crs": {"esri_pe_string": "GEOGCS[...]"}, "lat": {"units": "degrees"}})
    nc.write_files(data, str(tmp_path), "p.nc")
    assert nc.file_grid(f"{tmp_path}/p.nc") == Grid(Axis(0.0, 0.5, 4), Axis(1.0, 1.0, 3), "GEOGCS[...]")
    with pytest.raises(KeyError, match="no coordinate x"):
        nc.file_grid(f"{tmp_path}/p.nc", x="x")
    by_hand(f"{tmp_path}/a.nc")
    with pytest.raises(ValueError, match="x are uneven"):
        nc.file_grid(f"{tmp_path}/a.nc", y="time")


def test_masks_with_their_system(spark, tmp_path):
    from rivulet.operators.grid import Axis, Grid

    ring = spark.createDataFrame([(7, [(0.2, 0.2), (2.8, 0.2), (2.8, 1.8), (0.2, 1.8)])], "label int, ring array<struct<x:double,y:double>>")
    nc.write_masks(ring, Grid(Axis(0.5, 1.0, 5), Axis(0.5, 1.0, 5), "SYSTEM"), str(tmp_path / "m"))
    assert nc.read_netcdf(spark, f"{tmp_path}/m/mask_7.nc", ["mask"]).where("mask = 1").count() == 6
    found = {r.variable: r.attrs for r in nc.read_headers(spark, f"{tmp_path}/m").collect()}
    assert found["mask"]["grid_mapping"] == "crs" and found["crs"]["spatial_ref"] == "SYSTEM"


def test_fill_by_type_and_outputs_once(spark, tmp_path):
    from rivulet.operators.grid import Axis, Grid, reproject_group

    rows = spark.createDataFrame([(0, 0, 1.5, 3, 4, True)], "y int, x int, v double, n int, u smallint, b boolean")
    data = from_table(rows, ("y", "x"), var_attrs={"u": {"unsigned": True}})
    out = reproject_group(data, Grid(Axis(0.0, 1.0, 1), Axis(0.0, 1.0, 1)), Grid(Axis(0.0, 1.0, 2), Axis(0.0, 1.0, 1)), fill="by_type")
    assert sorted(tuple(r)[1:] for r in out.df.collect()) == [(0.0, 1.5, 3, 4, True), (1.0, None, -(2**31) + 1, 0, False)]
    save = {"operation": "save", "directory": str(tmp_path / "o"), "filename_pattern": "same", "mode": "overwrite"}
    context = Context()
    Profile.from_dict({"operations": [{"operation": "branch", "branches": {"a": [save], "b": [save]}}]}).run(from_table(rows, ("y", "x")), context)
    assert context.saved == [f"{tmp_path}/o/same"]


def test_paths_of_file_systems(spark, tmp_path):
    by_hand(f"{tmp_path}/a.nc")
    by_hand(f"{tmp_path}/b.nc")
    (tmp_path / "c.nc.incomplete").write_bytes(b"")
    for base in ("file://", "file:", ""):
        want = [f"{base}{tmp_path}/{n}.nc" for n in "ab"]
        assert nc.list_files(f"{base}{tmp_path}") == nc.list_files(f"{base}{tmp_path}/") == nc.list_files(f"{base}{tmp_path}/*.nc") == want
        assert nc.list_files(",".join(want)) == want
        assert nc.read_netcdf(spark, f"{base}{tmp_path}/*.nc", ["flag"]).count() == 30
    with pytest.raises(FileNotFoundError):
        nc.list_files(f"{tmp_path}/gone.nc")


@pytest.mark.parametrize("dims", [["a"], ["a", "b"]])
def test_spooled_file_is_that_of_the_whole_table_and_holds_a_batch(monkeypatch, dims):
    monkeypatch.setattr(nc, "PIECE_CELLS", 5)
    rows = [(a, b, None if (a + len(b)) % 3 == 0 else a / 7, None if a % 4 == 0 else b * a) for a in range(20) for b in ("x", "yy", "é") if (a * 7 + len(b)) % 5 and (len(dims) > 1 or b == "x")]
    table = pa.table({"a": [r[0] for r in rows], "v": [r[2] for r in rows], "b": [r[1] for r in rows], "s": [r[3] for r in rows]})
    about = ({"title": "t"}, {"v": {"units": "K"}}, {}, {"crs": 0})
    spool = nc.Spool(table.schema, dims)
    for batch in table.to_batches(max_chunksize=4):
        spool.add(batch)
    spool.close()
    assert spool.sorted and all(b.num_rows <= 4 for b in spool.batches(["v"]))
    whole = b"".join(nc.target_file(table, dims, *about))
    monkeypatch.setattr(nc, "target_file", None)
    assert b"".join(nc.spooled_file(spool, *about)) == whole


def test_rows_in_another_order_are_made_from_the_whole_table():
    table = pa.table({"a": [3, 1, 2], "v": [1.0, 2.0, 3.0]})
    spool = nc.Spool(table.schema, ["a"])
    spool.add(table.to_batches()[0])
    spool.close()
    assert b"".join(nc.spooled_file(spool, {}, {}, {})) == b"".join(nc.target_file(table, ["a"], {}, {}, {}))
