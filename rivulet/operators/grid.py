"""Grids: geometry from axes, nearest-neighbour regridding as an equality join, rasterising of polygons."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.functions.crs import UnknownSystem, between
from rivulet.model import Dataset

#: Names under which axes and coordinate systems are looked for, in this order.
X_NAMES, Y_NAMES, CRS_NAMES, WKT_NAMES = ("lon", "x"), ("lat", "y"), ("crs", "CRS", "mercator"), ("esri_pe_string", "spatial_ref")


def find_name(data: Dataset, names: tuple[str, ...]) -> str:
    for n in names:
        if n in data.df.columns or n in data.scalars:
            return n
    raise KeyError(f"none of {', '.join(names)}")


@dataclass(frozen=True)
class Axis:
    """Evenly spaced cell centres: ``origin`` is the first one, ``step`` may be negative, ``size`` cells."""

    origin: float
    step: float
    size: int

    @property
    def edge(self) -> float:
        return self.origin - self.step / 2

    def index(self, value: Column) -> Column:
        """Number of the cell that holds a coordinate; outside the axis below 0 or from ``size`` on."""
        return F.floor((value - F.lit(self.edge)) / F.lit(self.step)).cast("int")

    def centre(self, index: Column) -> Column:
        return F.lit(self.origin) + index * F.lit(self.step)


@dataclass(frozen=True)
class Grid:
    """Two axes and their coordinate system. Rows run along y, columns along x."""

    x: Axis
    y: Axis
    crs: str = ""

    def affine(self) -> tuple[float, float, float, float, float, float]:
        """(a, b, c, d, e, f): x = a * column + c and y = e * row + f at the cells' outer corner."""
        return (self.x.step, 0.0, self.x.edge, 0.0, self.y.step, self.y.edge)

    def matches(self, other: Grid, tolerance: float = 1e-9) -> bool:
        near = lambda a, b: abs(a.origin - b.origin) <= tolerance and abs(a.step - b.step) <= tolerance and a.size == b.size
        return self.crs == other.crs and near(self.x, other.x) and near(self.y, other.y)


EVEN = 0.01  # of a step that a coordinate may be off its place


def _axes(df: DataFrame, columns: list[str]) -> list[Axis]:
    """Axes of coordinate columns, by two jobs: step = (max - min) / (distinct values - 1), and whether all values are in
    their places. ValueError names a column whose steps are uneven; ``operators.nearest`` is for those."""
    found = None
    for c in columns:  # values first lose their copies; what is left to sort out is as long as an axis
        one = df.select(F.col(c).cast("double").alias("v")).distinct().agg(F.lit(c).alias("c"), F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("v").alias("n"))
        found = one if found is None else found.unionByName(one)
    rows = {r["c"]: r for r in found.collect()}
    out = []
    for c in columns:
        r = rows[c]
        if not r["n"]:
            raise ValueError(f"{c} has no values")
        out.append(Axis(r["lo"], (r["hi"] - r["lo"]) / (r["n"] - 1) if r["n"] > 1 else 1.0, r["n"]))
    off = [F.max(F.abs((F.col(c) - a.origin) / a.step - F.rint((F.col(c) - a.origin) / a.step))).alias(f"off{k}") for k, (c, a) in enumerate(zip(columns, out, strict=True))]
    far = df.select(*[F.col(c).cast("double").alias(c) for c in dict.fromkeys(columns)]).agg(*off).first()
    uneven = [c for k, c in enumerate(columns) if far[k] > EVEN]
    if uneven:
        raise ValueError(f"the steps of {', '.join(uneven)} are uneven")
    return out


def axis_of(df: DataFrame, column: str, north_up: bool = False) -> Axis:
    """The axis of a coordinate column."""
    a = _axes(df, [column])[0]
    return Axis(a.origin + a.step * (a.size - 1), -a.step, a.size) if north_up else a


def grid_of(df: DataFrame, x: str = "x", y: str = "y", crs: str = "") -> Grid:
    return Grid(*_axes(df, [x, y]), crs)


def explode_rows(df: DataFrame, values: str, row: str, column: str = "x", value: str = "value") -> DataFrame:
    """Dense rows held as arrays become one row a cell."""
    return df.select(row, F.posexplode(values).alias(column, value))


def target_cells(df: DataFrame, source: Grid, target: Grid, keys: DataFrame | None = None) -> DataFrame:
    """All cells of the target grid, with the source cell (row, col) under each one's centre, for each row of ``keys``
    or once; no data is read."""
    n = target.x.size * target.y.size
    by = keys.columns if keys is not None else []
    cells = df.sparkSession.range(n) if keys is None else keys.select(*by, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))).alias("id"))
    cells = cells.select(*by, (F.col("id") % target.x.size).cast("int").alias("tx"), F.floor(F.col("id") / target.x.size).cast("int").alias("ty"))
    x, y = target.x.centre(F.col("tx")), target.y.centre(F.col("ty"))
    return cells.select(*by, x.alias("__x"), y.alias("__y"), source.y.index(y).alias("__row"), source.x.index(x).alias("__col"))


def reproject(data: Dataset, source: Grid, target: Grid, variables: list[str], x: str = "x", y: str = "y", by: list[str] | None = None, reproject_points=None) -> Dataset:
    """Variables on the target grid, each cell with the value of the source cell that holds its centre, or null.

    Equal grids change attributes only. Where the systems differ, target coordinates go to the source's one by column
    expressions, as both texts say; ``reproject_points(xs, ys) -> (xs, ys)`` takes their place for other systems, on whole
    arrays inside tasks. ``by`` are further keys, such as time: the target's cells are made for each of their values.
    """
    data.need(*variables)
    attrs = {**data.attrs, "grid_mapping": target.crs} if target.crs else data.attrs
    if source.matches(target):
        return replace(data, attrs=attrs)
    moving = source.crs != target.crs
    way = None
    if moving and reproject_points is None:
        try:
            way = between(target.crs, source.crs)
        except UnknownSystem as e:
            raise ValueError(f"the grids' coordinate systems differ, and there is no way between them: {e}") from e
    by = by or []
    values = data.df.select(*by, source.y.index(F.col(y)).alias("__row"), source.x.index(F.col(x)).alias("__col"), *variables)
    cells = target_cells(data.df, source, target, values.select(*by).distinct() if by else None)
    if way is not None:
        sx, sy = way(F.col("__x"), F.col("__y"))
        cells = cells.withColumns({"__row": source.y.index(sy), "__col": source.x.index(sx)})
    elif moving:

        def moved(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                sx, sy = reproject_points(b["__x"].to_numpy(), b["__y"].to_numpy())
                yield b.assign(__row=np.floor((sy - source.y.edge) / source.y.step).astype("int32"), __col=np.floor((sx - source.x.edge) / source.x.step).astype("int32"))

        cells = cells.mapInPandas(moved, cells.schema)
    out = cells.join(values, [*by, "__row", "__col"], "left").select(*by, F.col("__y").alias(y), F.col("__x").alias(x), *variables)
    return replace(data, df=out, attrs=attrs)


def reproject_group(data: Dataset, source: Grid, target: Grid, x: str = "x", y: str = "y", by: list[str] | None = None, fill: dict[str, object] | str | None = None) -> Dataset:
    """All variables over both axes on the target grid; the others stay as scalars or attributes say. ``fill`` gives
    values, by variable, for cells without one, or is "by_type" (``type_fill``); else they are null."""
    spatial = [v for v in data.variables if {x, y} <= set(data.dims_of(v))]
    out = reproject(data, source, target, spatial, x, y, by)
    if fill == "by_type":
        kinds = dict(out.df.dtypes)
        values = {v: type_fill(kinds[v], bool(data.var_attrs.get(v, {}).get("unsigned"))) for v in spatial}
        return out.with_df(out.df.withColumns({v: F.coalesce(F.col(v), x.cast(kinds[v])) for v, x in values.items() if x is not None}))
    return out.pipe(lambda df: df.fillna({k: v for k, v in fill.items() if k in spatial})) if fill else out


def type_fill(kind: str, unsigned: bool = False) -> Column | None:
    """What stands for no value in a variable of a type: 0 if unsigned, else the least whole number but one; false; the empty
    text. None for real numbers, whose missing values are null here (and NaN in files)."""
    bits = {"tinyint": 8, "smallint": 16, "int": 32, "bigint": 64}
    if kind in bits:
        return F.lit(0 if unsigned else -(2 ** (bits[kind] - 1)) + 1)
    return {"boolean": F.lit(False), "string": F.lit("")}.get(kind)


def update_references(data: Dataset, variables: list[str], crs_name: str, attributes: dict) -> Dataset:
    """Names a coordinate system in the variables' attributes; nothing else changes."""
    var_attrs = {**data.var_attrs, crs_name: dict(attributes)}
    for v in variables:
        var_attrs[v] = {**var_attrs.get(v, {}), "grid_mapping": crs_name}
    return replace(data, var_attrs=var_attrs, scalars={**data.scalars, crs_name: data.scalars.get(crs_name, "")})


def rasterize(polygons: DataFrame, grid: Grid, label: str = "label", ring: str = "ring", all_touched: bool = True) -> DataFrame:
    """Cells (label, row, col) of each polygon (a ring of struct x, y): touched ones, or those whose centre lies within.

    Rows of one label are one polygon: further rings are parts apart, or holes.
    """
    return rasterize_rings(polygons, grid, label, ring, all_touched)


def ring_edges(rings: DataFrame, grid: Grid, label: str = "label", ring: str = "ring") -> DataFrame:
    """Edges (label, x0, y0, x1, y1) of rings of at least three points, in cells: places on the grid from its outer corner."""
    place = lambda p: F.struct(((p["x"] - grid.x.edge) / grid.x.step).cast("double").alias("x"), ((p["y"] - grid.y.edge) / grid.y.step).cast("double").alias("y"))
    placed = rings.where(F.size(ring) >= 3).select(label, F.transform(ring, place).alias("p"))
    turned = F.concat(F.slice("p", 2, F.size("p") - 1), F.slice("p", 1, 1))
    edges = placed.select(label, F.explode(F.arrays_zip(F.col("p").alias("a"), turned.alias("b"))).alias("e"))
    return edges.select(label, F.col("e.a.x").alias("x0"), F.col("e.a.y").alias("y0"), F.col("e.b.x").alias("x1"), F.col("e.b.y").alias("y1"))


def ring_spans(edges: DataFrame, grid: Grid, label: str = "label") -> DataFrame:
    """Spans (label, row, first, last) of cells whose centres lie within, by scanlines.

    Each edge is met by the rows whose centre lines cross it; a row's crossings are ordered, and cells between the first and
    the second, the third and the fourth, ... are within. Work and rows are dealt by label and row, so a polygon of any
    number of points is no single task's.
    """
    low, high = F.least("y0", "y1"), F.greatest("y0", "y1")
    first = F.greatest(F.ceil(low - 0.5), F.lit(0)).cast("int")
    last = F.least(F.ceil(high - 0.5) - 1, F.lit(grid.y.size - 1)).cast("int")
    rows = edges.withColumns({"first": first, "last": last}).where("first <= last").withColumn("row", F.explode(F.sequence("first", "last")))
    at = F.col("x0") + (F.col("x1") - F.col("x0")) * ((F.col("row") + 0.5 - F.col("y0")) / (F.col("y1") - F.col("y0")))
    crossings = rows.select(label, "row", at.alias("at"))
    along = Window.partitionBy(label, "row").orderBy("at")
    pairs = crossings.select(label, "row", "at", F.lead("at").over(along).alias("to"), F.row_number().over(along).alias("k")).where("k % 2 = 1")
    first = F.greatest(F.ceil(F.col("at") - 0.5), F.lit(0)).cast("int")
    last = F.least(F.ceil(F.col("to") - 0.5) - 1, F.lit(grid.x.size - 1)).cast("int")
    return pairs.select(label, "row", first.alias("first"), last.alias("last")).where("first <= last")


def touched_spans(edges: DataFrame, grid: Grid, label: str = "label") -> DataFrame:
    """Spans (label, row, first, last) of cells that edges run through: of each edge, the part within each row."""
    low, high = F.least("y0", "y1"), F.greatest("y0", "y1")
    first = F.greatest(F.floor(low), F.lit(0)).cast("int")
    last = F.least(F.floor(high), F.lit(grid.y.size - 1)).cast("int")
    rows = edges.withColumns({"lo": low, "hi": high, "first": first, "last": last}).where("first <= last").withColumn("row", F.explode(F.sequence("first", "last")))
    at = lambda y: F.col("x0") + (F.col("x1") - F.col("x0")) * ((y - F.col("y0")) / (F.col("y1") - F.col("y0")))
    top, bottom = at(F.greatest("lo", F.col("row").cast("double"))), at(F.least("hi", F.col("row") + 1.0))
    flat = F.col("lo") == F.col("hi")
    a = F.when(flat, F.least("x0", "x1")).otherwise(F.least(top, bottom))
    b = F.when(flat, F.greatest("x0", "x1")).otherwise(F.greatest(top, bottom))
    spans = rows.select(label, "row", F.floor(a).alias("first"), F.greatest(F.floor(a), F.ceil(b) - 1).alias("last"))
    spans = spans.select(label, "row", F.greatest("first", F.lit(0)).cast("int").alias("first"), F.least("last", F.lit(grid.x.size - 1)).cast("int").alias("last"))
    return spans.where("first <= last")


def rasterize_rings(rings: DataFrame, grid: Grid, label: str = "label", ring: str = "ring", all_touched: bool = True) -> DataFrame:
    """Cells (label, row, col) of polygons given as rings, one row a ring: outer rings, parts apart and holes, in any order and
    direction. Those whose centre lies within, and with ``all_touched`` those that an edge runs through."""
    edges = ring_edges(rings, grid, label, ring)
    spans = ring_spans(edges, grid, label)
    spread = lambda s: s.select(label, "row", F.explode(F.sequence("first", "last")).alias("col"))
    if not all_touched:
        return spread(spans)
    return spread(spans.unionByName(touched_spans(edges, grid, label))).distinct()


def mask_cells(rings: DataFrame, grid: Grid, label: str = "label", ring: str = "ring", all_touched: bool = True, x: str = "x", y: str = "y") -> DataFrame:
    """Masks as rows: each polygon's cells (label, y, x, mask = 1), by the coordinates of their centres. As a file, one a label
    (``netcdf.write_files``), cells between them that it lacks are missing."""
    cells = rasterize_rings(rings, grid, label, ring, all_touched)
    return cells.select(label, grid.y.centre(F.col("row")).alias(y), grid.x.centre(F.col("col")).alias(x), F.lit(1).cast("tinyint").alias("mask"))
