"""Nearest on uneven axes and in the plane against all pairs, and plans without all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from rivulet.operators import nearest
from rivulet.operators.grid import axis_of


def plan_of(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))


@pytest.mark.parametrize("seed", range(2))
def test_axis_against_all_pairs(spark, seed):
    rng = random.Random(seed)
    axis = [rng.choice([float(rng.randrange(20)), rng.gauss(0, 1), 10 ** rng.uniform(-3, 6)]) for _ in range(60)] + [None, float("nan")]
    values = [rng.choice([rng.choice(axis[:60]), rng.gauss(5, 10), 10 ** rng.uniform(-3, 7), -1e9]) for _ in range(300)] + [None, float("nan"), 7.5, 7.5, 7.5]
    df = spark.createDataFrame(list(enumerate(values)), "k int, v double")
    out = nearest.nearest_on_axis(df, spark.createDataFrame([(a,) for a in axis], "a double"), "v", "a")
    assert "CartesianProduct" not in plan_of(out) and "BroadcastNestedLoopJoin" not in plan_of(out)
    have = {r.k: r.nearest for r in out.collect()}
    assert len(have) == len(values)
    for k, v in enumerate(values):
        want = None if v is None or v != v else min(axis[:60], key=lambda a: (abs(a - v), a))
        assert have[k] == want, (v, have[k], want)


def test_axis_edges(spark):
    df = spark.createDataFrame([(1, 2.0)], "k int, v double")
    one = lambda rows: nearest.nearest_on_axis(df, spark.createDataFrame(rows, "a double"), "v", "a").first().nearest
    assert one([]) is None and one([(9.0,)]) == 9.0 and one([(1.0,), (3.0,)]) == 1.0
    assert nearest.nearest_on_axis(df.limit(0), spark.createDataFrame([(1.0,)], "a double"), "v", "a").collect() == []


def brute(q, sources):
    return min(sources, key=lambda s: ((q[0] - s[1]) * (q[0] - s[1]) + (q[1] - s[2]) * (q[1] - s[2]), s[0]))[0]


@pytest.mark.parametrize("kind", ["even", "clustered", "copies"])
def test_places_against_all_pairs(spark, kind):
    rng = random.Random(kind)
    place = {
        "even": lambda: (rng.uniform(0, 10), rng.uniform(0, 10)),
        "clustered": lambda: (rng.choice([0, 100]) + rng.gauss(0, 1e-2), rng.choice([0, 50]) + rng.gauss(0, 1e-2)),
        "line": lambda: (float(rng.randrange(50)), 3.0),
        "one": lambda: (1.0, 2.0),
        "copies": lambda: (float(rng.randrange(3)), float(rng.randrange(3))),
    }[kind]
    sources = [(k, *place()) for k in range(1 if kind == "one" else 300)]
    queries = [rng.choice([place(), (rng.uniform(-5, 15), rng.uniform(-5, 15)), (rng.uniform(-1e4, 1e4), 1e4)]) for _ in range(150)]
    df = spark.createDataFrame([(k, *q) for k, q in enumerate(queries)] + [(900, None, 1.0), (901, 1.0, float("nan"))], "k int, x double, y double")
    out = nearest.nearest_places(df, spark.createDataFrame([*sources, (None, None, 1.0)], "id int, a double, b double"), ("x", "y"), ("a", "b"), "id", distance="far")
    assert "CartesianProduct" not in plan_of(out) and "BroadcastNestedLoopJoin" not in plan_of(out)
    have = {r.k: (r.nearest, r.far) for r in out.collect()}
    assert len(have) == len(queries) + 2 and have[900] == have[901] == (None, None)
    by = {s[0]: s for s in sources}
    for k, q in enumerate(queries):
        want = brute(q, sources)
        assert have[k][0] == want
        assert have[k][1] == pytest.approx(((q[0] - by[want][1]) ** 2 + (q[1] - by[want][2]) ** 2) ** 0.5)


def test_no_sources(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0)], "k int, x double, y double")
    out = nearest.nearest_places(df, spark.createDataFrame([], "id long, a double, b double"), ("x", "y"), ("a", "b"), "id", distance="far").first()
    assert out.nearest is None and out.far is None


def test_uneven_axes_are_refused(spark):
    even = spark.createDataFrame([(k * 0.1,) for k in range(20)] * 2, "y double")
    assert axis_of(even, "y").size == 20
    with pytest.raises(ValueError, match="the steps of y are uneven"):
        axis_of(spark.createDataFrame([(0.0,), (1.0,), (2.0,), (5.0,)], "y double"), "y")
    single = even.withColumn("v", F.col("y").cast("float"))
    assert axis_of(single, "v").size == 20


def test_places_outside_the_box_need_no_large_cells(spark, monkeypatch, tmp_path):
    """Places along a dense box meet the sources of a strip, not those of cells that grow until their border proves the nearest."""
    monkeypatch.setattr(nearest, "scratch_folder", lambda _: str(tmp_path))
    rng = random.Random(4)
    sources = [(k, rng.random(), rng.random()) for k in range(3000)]
    places = [(k / 40, y) for k in range(40) for y in (-0.3, 1.2, 0.5)]
    df = spark.createDataFrame(places, "x double, y double")
    out = nearest.nearest_places(df, spark.createDataFrame(sources, "id int, a double, b double"), ("x", "y"), ("a", "b"), "id").collect()
    assert {(r.x, r.y): r.nearest for r in out} == {(x, y): min(((x - a) * (x - a) + (y - b) * (y - b), i) for i, a, b in sources)[1] for x, y in places}
    assert not (tmp_path / "2").exists()
