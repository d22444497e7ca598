"""Tiled arrays against numpy: transposes, new and dropped dimensions, holes, ragged edges."""

from itertools import permutations

import numpy as np
import pytest

from rivulet.operators.tiles import to_tiles


def rows_of(spark, a, names, holes=()):
    rows = [(*map(int, at), float(a[at])) for at in np.ndindex(a.shape) if at not in holes]
    return spark.createDataFrame(rows, ", ".join(f"{n} int" for n in names) + ", v double")


def array_of(tiled):
    out = np.full(tiled.sizes, np.nan)
    for r in tiled.rows("v").collect():
        out[tuple(r[d] for d in tiled.dims)] = np.nan if r.v is None else r.v
    return out


def test_transposes_of_three_dimensions(spark):
    a = np.random.default_rng(1).normal(size=(5, 7, 4))
    holes = {(0, 0, 0), (4, 6, 3), (2, 3, 1)}
    tiled = to_tiles(rows_of(spark, a, "tyx", holes), ["t", "y", "x"], [5, 7, 4], "v", [2, 3, 4])
    for h in holes:
        a[h] = np.nan
    assert np.array_equal(array_of(tiled), a, equal_nan=True)
    for order in permutations(range(3)):
        turned = tiled.transpose(*["tyx"[k] for k in order])
        assert np.array_equal(array_of(turned), a.transpose(order), equal_nan=True)
    twice = tiled.transpose("x", "t", "y").transpose("y", "x", "t")
    assert np.array_equal(array_of(twice), a.transpose(1, 2, 0), equal_nan=True)
    plan = tiled.transpose("x", "y", "t").df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == tiled.df._jdf.queryExecution().executedPlan().toString().count("Exchange")


def test_dimensions_come_and_go(spark):
    a = np.arange(12.0).reshape(3, 4)
    tiled = to_tiles(rows_of(spark, a, "yx"), ["y", "x"], [3, 4], "v", [2, 2])
    for at in range(3):
        wide = tiled.expand("t", at)
        assert wide.sizes[at] == 1 and np.array_equal(array_of(wide), np.expand_dims(a, at))
        assert np.array_equal(array_of(wide.squeeze("t")), a)
    assert np.array_equal(array_of(tiled.expand("t").transpose("x", "t", "y").squeeze("t")), a.T)
    assert {r.t_y for r in tiled.block(y=(2, 3)).df.collect()} == {1} and tiled.block(x=(1, 1)).df.count() == 0
    with pytest.raises(ValueError, match="has 3 places"):
        tiled.squeeze("y")
    with pytest.raises(ValueError, match="is a dimension already"):
        tiled.expand("x")
    with pytest.raises(ValueError, match="no order"):
        tiled.transpose("x", "x")


def test_rows_that_do_not_fit(spark):
    twice = spark.createDataFrame([(0, 0, 1.0), (0, 0, 2.0)], "y int, x int, v double")
    with pytest.raises(Exception, match="one cell"):
        to_tiles(twice, ["y", "x"], [2, 2], "v").df.collect()
    for place in ((2, 0), (0, 5), (-1, 0)):
        with pytest.raises(Exception, match="outside the array"):
            to_tiles(spark.createDataFrame([(*place, 1.0)], "y int, x int, v double"), ["y", "x"], [2, 3], "v").df.collect()
    assert to_tiles(twice.limit(0), ["y", "x"], [2, 2], "v").rows().collect() == []
