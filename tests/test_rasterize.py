"""Scanlines against a plain crossing test of every cell, holes and parts, touched cells, and masks as files."""

import random

import pytest
from pyspark.sql import functions as F

from rivulet.model import from_table
from rivulet.operators.grid import Axis, Grid, mask_cells, rasterize_rings
from rivulet.sources import netcdf as nc

GRID = Grid(Axis(100.5, 1.0, 30), Axis(19.0, -1.0, 20))


def edges_of(rings):
    for r in rings:
        yield from zip(r, r[1:] + r[:1])


def within(rings, px, py):
    """An odd number of edges to the right."""
    n = 0
    for (x0, y0), (x1, y1) in edges_of(rings):
        if (y0 > py) != (y1 > py) and px < x0 + (x1 - x0) * ((py - y0) / (y1 - y0)):
            n += 1
    return n % 2 == 1


def touches(rings, c, r):
    """Some edge has a point inside the cell: the edge cut to the cell's box has a length."""
    for (x0, y0), (x1, y1) in edges_of(rings):
        lo, hi = 0.0, 1.0
        for a, b, k in ((x0, x1, c), (y0, y1, r)):
            if a == b:
                if not k < a < k + 1:
                    lo, hi = 1.0, 0.0
            else:
                s, t = sorted(((k - a) / (b - a), (k + 1 - a) / (b - a)))
                lo, hi = max(lo, s), min(hi, t)
        if lo < hi:
            return True
    return False


def blob(rng, cx, cy, r):
    import math

    n = rng.randint(3, 12)
    turns = sorted(rng.uniform(0, 2 * math.pi) for _ in range(n))
    return [(cx + r * rng.uniform(0.3, 1) * math.cos(t), cy + r * rng.uniform(0.3, 1) * math.sin(t)) for t in turns]


@pytest.mark.parametrize("all_touched", [False, True])
def test_random_rings_with_holes_and_parts(spark, all_touched):
    rng = random.Random(6)
    polygons = {}
    for label in range(25):
        cx, cy = rng.uniform(-3, 33), rng.uniform(-3, 23)
        polygons[label] = [blob(rng, cx, cy, 8), blob(rng, cx, cy, 2)[::-1], blob(rng, cx + 12, cy - 3, 4)]
    # From cells to coordinates: y runs down.
    rows = [(k, [(100 + x, 19.5 - y) for x, y in ring]) for k, rings in polygons.items() for ring in rings]
    rows += [(99, [(100.0, 5.0), (101.0, 6.0)]), (98, None), (97, [])]
    rings = spark.createDataFrame(rows, "label int, ring array<struct<x:double,y:double>>")
    out = rasterize_rings(rings, GRID, all_touched=all_touched)
    have = [(r.label, r.row, r.col) for r in out.collect()]
    want = {(k, r, c) for k, rings in polygons.items() for r in range(20) for c in range(30) if within(rings, c + 0.5, r + 0.5) or all_touched and touches(rings, c, r)}
    assert len(have) == len(set(have)) and set(have) == want and len(want) > 500


def test_rows_of_a_polygon_go_to_many_tasks(spark):
    ring = F.transform(F.sequence(F.lit(0), F.lit(4999)), lambda k: F.struct((115 + 10 * F.cos(k / 5000 * 6.283185307179586)).alias("x"), (10 + 8 * F.sin(k / 5000 * 6.283185307179586)).alias("y")))
    out = rasterize_rings(spark.range(1).select(F.col("id").alias("label"), ring.alias("ring")), GRID, all_touched=False)
    cells = {(r.row, r.col) for r in out.collect()}
    assert cells == {(r, c) for r in range(20) for c in range(30) if ((100.5 + c - 115) / 10) ** 2 + ((19 - r - 10) / 8) ** 2 < 1}
    many = rasterize_rings(spark.range(2).select("id", ring.alias("ring")), GRID, label="id", all_touched=False)
    plan = many._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.splitlines() if "hashpartitioning" in line]
    assert "Pandas" not in plan and "Window" in plan and all("row#" in line for line in dealt)


def test_masks_as_files(spark, tmp_path):
    rows = [("a", [(102.0, 18.2), (106.0, 18.2), (106.0, 14.2), (102.0, 14.2)]), ("b", [(110.2, 10.2), (112.4, 10.2), (112.4, 8.1)])]
    rings = spark.createDataFrame(rows, "label string, ring array<struct<x:double,y:double>>")
    masks = mask_cells(rings, GRID, all_touched=False)
    nc.write_files(from_table(masks, ("y", "x")), str(tmp_path / "m"), "mask_{label}.nc")
    back = nc.read_netcdf(spark, f"{tmp_path}/m/mask_a.nc").where("mask = 1")
    assert {(r.y, r.x) for r in back.collect()} == {(y + 0.0, x + 0.5) for y in range(15, 19) for x in range(102, 106)}
