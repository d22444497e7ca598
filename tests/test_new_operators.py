import json

import pytest
from pyspark.sql import functions as F

from rivulet.functions import text
from rivulet.model import from_table
from rivulet.operators import aggregates, grid, masks, projections
from rivulet.plans.operations import Context, load_operation
from rivulet.plans.profile import Profile
from rivulet.sources import sinks


@pytest.fixture
def data(spark):
    df = spark.createDataFrame([(1, 1.5, 2.0), (2, None, 4.0)], "id long, a double, b double")
    return from_table(df, ("id",))


def test_expressions_see_earlier_ones_and_spare_coordinates(data):
    out = projections.compute(data, {"c": "a + b", "d": "c * 2"}, {"d": {"units": "x"}})
    assert [tuple(r) for r in out.df.orderBy("id").collect()] == [(1, 1.5, 2.0, 3.5, 7.0), (2, None, 4.0, None, None)] and out.var_attrs["d"] == {"units": "x"}
    with pytest.raises(ValueError):
        projections.compute(data, {"id": "1"})
    assert load_operation({"operation": "expression", "expressions": {"c": "1"}}).expressions == {"c": "1"}


def test_narrow_merge(data):
    out = Profile.from_dict({"operations": [{"operation": "merge", "narrow": True}]}).run(data)
    assert dict(out.df.dtypes) == {"id": "bigint", "a": "float", "b": "float"}


def test_flatten(spark):
    df = spark.createDataFrame([(1, [[3, 1], [3]]), (2, [])], "id int, v array<array<int>>")
    assert [r.v for r in projections.flatten_values(df, "v").orderBy("id").collect()] == [[3, 1, 3], []]
    assert projections.flatten_values(df, "v", unique=True, where=lambda x: x > 1).orderBy("id").first().v == [3]


def test_first_and_last_rows_that_pass(spark):
    df = spark.createDataFrame([(1, 1, 5), (1, 2, 9), (1, 3, 9), (2, 1, 0)], "g int, k int, v int")
    assert [tuple(r) for r in masks.first_row(df, ["k"], ["g"], F.col("v") > 5).collect()] == [(1, 2, 9)]
    assert sorted(map(tuple, masks.first_row(df, ["k"], ["g"], last=True).collect())) == [(1, 3, 9), (2, 1, 0)]


def test_days_quantiles_intervals(spark):
    df = spark.sql("SELECT * FROM VALUES (1, TIMESTAMP '2023-03-01', 1.0D), (1, TIMESTAMP '2024-02-29', 2.0D) t(g, t, v)")
    assert tuple(aggregates.day_range(df, "t").first()) == (60, 61)
    assert aggregates.quantiles(df, "v", {"q": 0.5}, ["g"]).first().q == 1.5
    i = df.select(aggregates.lead_interval(F.lit(7200), 3600).alias("i"), aggregates.lead_interval(F.lit(-5), 3600).alias("j")).first()
    assert tuple(i.i) == (3600.0, 7200.0) and tuple(i.j) == (0.0, 3600.0)


def test_names(spark):
    names = ["nwm.t2024010106z.short_range.channel_rt_3.f001.conus.nc", "nwm.t06z.analysis.land.alaska.csv", "x"]
    rows = spark.createDataFrame([(n,) for n in names], "n string").select("*", *[c.alias(k) for k, c in text.parse_output_name(F.col("n")).items()]).collect()
    assert tuple(rows[0])[1:] == ("nwm", "20240101", "06", "short_range", "channel_rt", "3", "f001", "conus", "nc")
    assert tuple(rows[1])[1:] == ("nwm", None, "06", "analysis", "land", None, None, "alaska", "csv") and not any(tuple(rows[2])[1:])
    r = spark.range(1).select(text.described(F.lit("conus_channel_rt")).alias("a"), text.one_of(F.lit("b"), ["a"]).alias("b"), text.find_one_of(F.lit("x.b.a"), ["a", "b"]).alias("c")).first()
    assert tuple(r) == ("CONUS Channel Routing", None, "b")


def test_json_and_grids_by_key(spark):
    df = spark.createDataFrame([(1, "a", None)], "id int, s string, z string")
    assert json.loads(sinks.as_json(df).first().json) == {"id": 1, "s": "a"}
    cells = spark.sql("SELECT CAST(t AS INT) t, CAST(y AS INT) y, CAST(x AS INT) x, 10D * y + x + 100 * t AS v FROM (SELECT explode(sequence(0, 2)) t) a, (SELECT explode(sequence(0, 3)) y) b, (SELECT explode(sequence(0, 3)) x) c")
    own = grid.grid_of(cells)
    target = grid.Grid(grid.Axis(1.0, 2.0, 2), grid.Axis(0.0, 3.0, 3))
    out = grid.reproject(from_table(cells, ("t", "y", "x")), own, target, ["v"], by=["t"])
    want = {(t, y, x): 10.0 * y + x + 100 * t if y < 4 else None for t in range(3) for y in (0.0, 3.0, 6.0) for x in (1.0, 3.0)}
    assert {(r.t, r.y, r.x): r.v for r in out.df.collect()} == want
    filled = grid.reproject_group(from_table(cells, ("t", "y", "x")), own, target, by=["t"], fill={"v": -1.0})
    assert {(r.t, r.y, r.x): r.v for r in filled.df.collect()} == {k: -1.0 if v is None else v for k, v in want.items()}


def test_kept_data_are_let_go(data):
    context = Context()
    ops = [{"operation": "branch", "persist": True, "branches": {"a": [{"operation": "load"}], "b": [{"operation": "load"}]}}]
    out = Profile.from_dict({"operations": ops}).run(data, context)
    assert out.df.count() == 4 and len(context.kept) == 1 and context.kept[0].is_cached
    kept = context.kept[0]
    context.release()
    assert not kept.is_cached and not context.kept
