"""Profiles and operations: parsing, checks, control flow, and attributes, with hand-made values."""

import json
from datetime import datetime

import pytest

from rivulet.model import MissingVariable, from_table
from rivulet.operators import aggregates, grid, masks, projections
from rivulet.plans.operations import REGISTRY, Context, PlanError, load_operation, register
from rivulet.plans.profile import Profile, find_invalid, load_profiles, one_identity, select_profile

NAN = float("nan")


@pytest.fixture
def series(spark):
    rows = [(f, datetime(2024, 1, 1, h), float(f * 10 + h) if (f, h) != (2, 1) else NAN, h * 3600) for f in (1, 2, 3) for h in (0, 1, 2)]
    df = spark.createDataFrame(rows, "feature_id long, time timestamp, flow double, lead_seconds long")
    return from_table(df, ("feature_id", "time"), ("lead_seconds",), attrs={"title": "flow"}, var_attrs={"flow": {"units": "cms", "long_name": "Flow"}})


def run(data, *ops, **context):
    return Profile.from_dict({"operations": list(ops)}).run(data, Context(**context))


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_registry_knows_every_operation():
    assert set(REGISTRY) >= set("extract subset merge drop rename attribute save branch function load echo raise on_each anomaly peek reproject unit_conversion total_over_time adjust_dimensions calculate_time_bound group_by stream combine file_filter".split())
    with pytest.raises(KeyError):
        register("drop")(object)
    for bad in ({"operation": "write"}, {"operation": "nothing"}, {"operation": "rename"}, {"operation": "attribute", "attribute_name": "a", "mode": "x"}, {"operation": "stream", "operations": [{"variable": "v", "operation": "mode"}]}, {"operation": "file_filter", "on": {"or": [{"field": "a", "operator": "~", "value": 1}]}}):
        with pytest.raises(PlanError):
            load_operation(bad)


def test_nan_is_null(series):
    assert series.df.where("flow is null").count() == 1
    out = run(series, {"operation": "stream", "operations": [{"variable": "flow", "operation": o, "output_variable": o} for o in ("sum", "mean", "max", "variance", "count")]})
    assert rows(out.df.where("feature_id = 2"), "sum", "mean", "max", "variance", "count") == [(42.0, 21.0, 22.0, 1.0, 2)]
    assert out.var_attrs["mean"]["cell_methods"] == "feature_id: mean"


def test_variance_with_zero(spark):
    df = spark.createDataFrame([(1, 3.0), (1, 5.0), (1, 9.0), (2, 4.0), (3, None)], "k long, v double")
    out = {r.k: r for r in aggregates.fold_cells(df, ["k"], [("v", "variance_compat", "c"), ("v", "variance", "v")]).collect()}
    assert out[1].c == pytest.approx(10.6875) and out[1].v == pytest.approx(6.2222, abs=1e-4)
    assert out[2].v is None and out[3].c is None
    with pytest.raises(KeyError):
        aggregates.register_fold("sum", None)


def test_units_and_attributes(series):
    out = run(series, {"operation": "unit_conversion", "conversions": [{"variable_name": "flow", "target_unit": "cfs"}]}, {"operation": "attribute", "attribute_name": "note", "attribute_value": "of {title}"}, {"operation": "attribute", "field": "flow", "attribute_name": "long_name", "attribute_value": "River ", "mode": "prepend"})
    assert out.var_attrs["flow"] == {"units": "cfs", "long_name": "River Flow"} and out.attrs["note"] == "of flow"
    assert rows(out.df.where("feature_id = 1"), "flow")[0][0] == pytest.approx(353.146667)
    for conversions, error in (([{"variable_name": "flow", "target_unit": "kg"}], KeyError), ([{"variable_name": "none", "target_unit": "cfs"}], MissingVariable), ([{"variable_name": "lead_seconds", "target_unit": "cfs"}], ValueError)):
        with pytest.raises(error):
            run(series, {"operation": "unit_conversion", "conversions": conversions})
    e = projections.edit_attribute
    assert e({"a": 1}, "a", 2, "append") == {"a": [1, 2]} and e({}, "a", 2, "modify") == {} and e({"a": "x"}, "a", "y", "c") == {"a": "x"} and e({}, "a", "y", "n") == {} and e({"a": 1}, "a", None, "delete") == {}


def test_rename_drop_combine_adjust(series):
    out = run(series, {"operation": "rename", "mapping": {"flow": "streamflow"}})
    assert out.attrs["title"] == "streamflow" and "streamflow" in out.var_attrs
    with pytest.raises(ValueError):
        run(series, {"operation": "rename", "mapping": {"flow": "time"}})
    out = run(series, {"operation": "drop", "fields": ["feature_id", "flow"], "exclude": True})
    assert out.df.columns == ["feature_id", "flow"] and out.dims == ("feature_id",)
    out = run(series, {"operation": "combine", "variables": ["flow", "flow"], "name": "both", "new_dimension": "n"}, {"operation": "adjust_dimensions", "mapping": {"both": ["time"], "gone": ["time"]}})
    assert out.dims_of("both") == ("feature_id", "time", "n")
    with pytest.raises(MissingVariable):
        run(series, {"operation": "adjust_dimensions", "mapping": {"flow": ["z"]}})
    out = run(series, {"operation": "total_over_time", "rate_variable_name": "flow", "total_variable_name": "volume", "amount_of_time": 2})
    assert out.var_attrs["volume"]["long_name"] == "Accumulated Flow" and rows(out.df.where("feature_id=1"), "volume")[0] == (72000.0,)


def test_merge_collapses_uniform_variables(series):
    from pyspark.sql import functions as F

    data = series.with_columns({"a": F.lit(5), "b": F.lit(None).cast("double")})
    out = run(data, {"operation": "merge", "collapse": ["a", "b", "flow"]})
    assert out.scalars == {"a": 5, "b": None} and "flow" in out.df.columns


def test_group_by_buckets_are_closed_on_the_right(series):
    out = run(series, {"operation": "group_by", "amount_of_time": 1, "include_time_bounds": True, "on_each": [{"operation": "stream", "operations": [{"variable": "flow", "operation": "sum"}]}]})
    assert rows(out.df.where("feature_id = 1"), "group", "flow") == [("1hours", 21.0), ("2hours", 12.0)]
    bounds = {r.group: r.time_bounds for r in out.df.collect()}
    assert bounds["1hours"] == [datetime(2023, 12, 31, 23), datetime(2024, 1, 1, 1)]


def test_masks_upstream_and_scores(spark, series):
    mask = spark.createDataFrame([("A", 1), ("A", 2), ("B", 3), ("B", 9), ("A", 1)], "rfc string, feature_id long")
    out = run(series, {"operation": "extract", "masks": ["rfcs"], "identifiers": ["rfc"]}, tables={"rfcs": mask})
    assert out.df.count() == 9 and out.file_key == ("rfc",)
    assert rows(masks.missing_ids(series.df, mask, "feature_id"), "feature_id") == [(9,)]
    links = spark.createDataFrame([(1, 3), (2, 3), (3, -1)], "link long, to long")
    out = run(series, {"operation": "function", "function": "calculate_upstream_flow_binned", "kwargs": {"variable": "flow"}}, tables={"routelink": links})
    assert [r.upstream_flow for r in out.df.where("feature_id = 3").orderBy("time").collect()] == [30.0, None, 34.0]
    climate = spark.createDataFrame([(1, 11.0, 11.5), (2, 100.0, 200.0)], "feature_id long, lo double, hi double")
    op = {"operation": "anomaly", "variable_name": "flow", "default_score": 3, "on": ["feature_id"], "thresholds": [{"variable": "hi", "level": 1.5}, {"variable": "lo", "level": -5}]}
    out = run(series, op, tables={"thresholds": climate})
    assert [r.streamflow_anomaly for r in out.df.where("feature_id = 1").orderBy("time").collect()] == [-5.0, 1.5, 3.0]
    assert [r.streamflow_anomaly for r in out.df.where("feature_id = 3").collect()] == [3.0] * 3
    assert out.var_attrs["streamflow_anomaly"]["long_name"] == "Flow Anomaly"
    with pytest.raises(PlanError):
        load_operation(op | {"thresholds": [{"variable": "a", "level": 1}, {"variable": "b", "level": 1}]})


def test_subset_keeps_cells(spark):
    cells = from_table(spark.createDataFrame([(0, 0, 1.0), (0, 1, 2.0), (1, 0, 3.0), (1, 1, 4.0)], "y int, x int, v double"), ("y", "x"), var_attrs={"v": {"units": "K"}})
    mask = spark.createDataFrame([(0, 0, True), (0, 1, False), (1, 0, False), (1, 1, True)], "y int, x int, keep boolean")
    out = run(cells, {"operation": "subset", "masks": ["m"]}, tables={"m": mask})
    assert [(r.y, r.x, r.v) for r in out.df.orderBy("y", "x").collect()] == [(0, 0, 1.0), (0, 1, None), (1, 0, None), (1, 1, 4.0)]
    assert out.var_attrs == cells.var_attrs


def test_grids(spark):
    a = grid.Axis(10.0, 2.0, 5)
    g = grid.Grid(a, grid.Axis(8.0, -2.0, 5), "p")
    assert g.affine() == (2.0, 0.0, 9.0, 0.0, -2.0, 9.0) and g.matches(g) and not g.matches(grid.Grid(a, a, "p"))
    cells = from_table(spark.createDataFrame([(t, float(y), float(x), float(100 * t + y * 10 + x)) for t in (0, 1) for y in range(4) for x in range(4)], "time int, y double, x double, v double"), ("time", "y", "x"))
    own = grid.grid_of(cells.df)
    target = grid.Grid(grid.Axis(0.4, 2.0, 3), grid.Axis(3.0, -3.0, 2))
    out = grid.reproject(cells, own, target, ["v"], by=["time"])
    assert rows(out.df.where("time = 1"), "y", "x", "v") == [(0.0, 0.4, 100.0), (0.0, 2.4, 102.0), (0.0, 4.4, None), (3.0, 0.4, 130.0), (3.0, 2.4, 132.0), (3.0, 4.4, None)]
    with pytest.raises(ValueError):
        grid.reproject(cells, own, grid.Grid(target.x, target.y, "other"), ["v"])
    moved = grid.reproject(cells, own, grid.Grid(target.x, target.y, "other"), ["v"], by=["time"], reproject_points=lambda x, y: (x + 1, y))
    assert (0.0, 0.4, 101.0) in rows(moved.df, "y", "x", "v")
    square = spark.createDataFrame([("s", [(0.6, 0.6), (2.4, 0.6), (2.4, 2.4), (0.6, 2.4)])], "label string, ring array<struct<x:double,y:double>>")
    assert len(rows(grid.rasterize(square, own), "row", "col")) == 4 and (1, 1) in rows(grid.rasterize(square, own), "row", "col")
    small = spark.createDataFrame([("t", [(0.6, 0.6), (0.9, 0.6), (0.9, 0.9)])], square.schema)
    assert rows(grid.rasterize(small, own), "row", "col") == [(1, 1)] and rows(grid.rasterize(small, own, all_touched=False), "row", "col") == []


def test_branch_function_echo_raise_disable(series):
    half = {"operation": "file_filter", "on": {"field": "feature_id", "operator": "<=", "value": 1}}
    out = run(series, {"operation": "branch", "branches": {"a": [half], "b": []}})
    assert out.df.count() == 12 and {r.branch for r in out.df.collect()} == {"a", "b"}
    context = Context(values={"who": "me"})
    Profile.from_dict({"operations": [{"operation": "echo", "message": "hello {who} {title}"}, {"operation": "peek"}]}).run(series, context)
    assert context.messages[0] == "hello me flow" and "flow(feature_id, time): double [cms]" in context.messages[1]
    for ops, error in (([{"operation": "echo", "message": "{gone}"}], ValueError), ([{"operation": "raise", "message": "stop {title}"}], RuntimeError), ([{"operation": "function", "function": "os.system"}], PlanError), ([{"operation": "branch", "branches": {"x": [half | {"disable": True}]}}], PlanError)):
        with pytest.raises(error):
            run(series, *ops)
    p = Profile.from_dict({"operations": [half | {"disable": True}, {"operation": "on_each", "on_each": [half, half]}]})
    assert p.run(series, debug=True).df.count() == 3 and [o.operation_id for o in p.operations[1].walk()] == ["2", "2.1", "2.2"]
    assert "1 file_filter (disabled)" in p.summary()
    done = Profile.from_dict({"operations": [half]}).run(series, on_complete=[lambda d: None, lambda d: d.pipe(lambda x: x.limit(1))])
    assert done.df.count() == 1


def test_save(spark, series, tmp_path):
    from pyspark.sql import functions as F

    context = Context(output=str(tmp_path), values={"cfg": "short"})
    Profile.from_dict({"operations": [{"operation": "save", "directory": "out", "filename_pattern": "{cfg}.{feature_id}.nc", "include_conditions": {"feature_id": 1}}, {"operation": "save", "directory": "all", "filename_pattern": "{cfg}.nc", "pack_values": True}]}).run(series, context)
    assert context.saved[0].endswith("target=short.1.nc") and spark.read.parquet(str(tmp_path / "out")).count() == 3
    back = spark.read.parquet(context.saved[1])
    assert back.where("flow = -99900").count() == 1 and back.agg(F.max("flow")).first()[0] == 3200
    keyed = series.with_df(series.df, file_key=("feature_id",))
    with pytest.raises(FileExistsError):
        Profile.from_dict({"operations": [{"operation": "save", "directory": "d", "filename_pattern": "{lead_seconds}.nc"}]}).run(keyed, Context(output=str(tmp_path)))


def test_profiles_from_files(spark, tmp_path):
    good = {"name": "p", "region": "conus", "configuration": "short_range", "model_output_type": "channel_rt", "operations": [{"operation": "drop", "fields": ["a"]}]}
    (tmp_path / "a.json").write_text(json.dumps(good))
    (tmp_path / "b.json").write_text(json.dumps(good | {"region": "hawaii", "member": 2}))
    (tmp_path / "bad.json").write_text("{")
    (tmp_path / "bad2.json").write_text(json.dumps(good | {"operations": []}))
    assert len(find_invalid(spark, str(tmp_path))) == 2
    ps = load_profiles(spark, str(tmp_path))
    assert select_profile(ps, "hawaii", "short_range", "channel_rt", "2").member == 2
    with pytest.raises(KeyError):
        select_profile(ps, "hawaii", "short_range", "channel_rt", "3")
    ids = spark.createDataFrame([("conus", "a", "b", None, "00"), ("conus", "a", "b", None, "00")], "region string, configuration string, output_type string, member string, cycle string")
    assert one_identity(ids)["cycle"] == "00"
    with pytest.raises(ValueError):
        one_identity(ids.unionAll(spark.createDataFrame([("x", "a", "b", None, "00")], ids.schema)))
