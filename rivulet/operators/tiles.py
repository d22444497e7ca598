"""Arrays in tiles: a chunked layout of grids, with transposes, new and dropped dimensions, and the way back to rows.

A tile is one row: its number along each dimension, its shape, and its values in one array, the last dimension fastest. An array
of any size is as many rows, so nothing holds it whole. Transposing permutes the tiles' numbers and, within each, its values;
rows stay where they are, and no shuffle is needed. Cells that rows lack are null.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from math import prod

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TILE = 64  # cells along a dimension, unless said otherwise


@dataclass(frozen=True)
class TiledArray:
    """Tiles (``t_<dim>`` for each dimension, shape, values), the array's sizes and the tiles' ones, in the order of dimensions."""

    df: DataFrame
    dims: tuple[str, ...]
    sizes: tuple[int, ...]
    tile: tuple[int, ...]

    def __post_init__(self):
        if not len(self.dims) == len(self.sizes) == len(self.tile) == len(set(self.dims)):
            raise ValueError("dimensions, sizes and tiles do not match")

    @property
    def keys(self) -> list[str]:
        return [f"t_{d}" for d in self.dims]

    def transpose(self, *order: str) -> TiledArray:
        """The same array with its dimensions in another order: only values within tiles move."""
        if sorted(order) != sorted(self.dims):
            raise ValueError(f"{', '.join(order)} is no order of {', '.join(self.dims)}")
        at = [self.dims.index(d) for d in order]
        shape = [F.get("shape", F.lit(k)) for k in at]
        # Where the value at a place of the new order was: its number along each dimension, times that dimension's stride.
        strides = []
        for k in at:
            s = F.lit(1)
            for j in range(k + 1, len(self.dims)):
                s = s * F.get("shape", F.lit(j))
            strides.append(s)

        def source(i):
            out, below = F.lit(0), F.lit(1)
            for k in range(len(at) - 1, -1, -1):
                out = out + F.floor(i / below).cast("int") % shape[k] * strides[k]
                below = below * shape[k]
            return out

        n = F.size("values")
        values = F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get("values", source(i)))).otherwise(F.col("values"))
        # Values first: within one select, names in their lambda would mean the new shape.
        df = self.df.select(*[f"t_{d}" for d in order], "shape", values.alias("values")).withColumn("shape", F.array(*shape))
        return replace(self, df=df, dims=tuple(order), sizes=tuple(self.sizes[k] for k in at), tile=tuple(self.tile[k] for k in at))

    def expand(self, dim: str, at: int = 0) -> TiledArray:
        """With one more dimension of one place; values stay as they are."""
        if dim in self.dims:
            raise ValueError(f"{dim} is a dimension already")
        put = lambda xs, x: (*xs[:at], x, *xs[at:])
        shape = F.concat(F.slice("shape", 1, at), F.array(F.lit(1)), F.slice("shape", at + 1, len(self.dims) - at)) if at else F.concat(F.array(F.lit(1)), F.col("shape"))
        dims = put(self.dims, dim)
        df = self.df.withColumns({f"t_{dim}": F.lit(0), "shape": shape}).select(*[f"t_{d}" for d in dims], "shape", "values")
        return replace(self, df=df, dims=dims, sizes=put(self.sizes, 1), tile=put(self.tile, 1))

    def squeeze(self, dim: str) -> TiledArray:
        """Without a dimension that has one place."""
        k = self.dims.index(dim)
        if self.sizes[k] != 1:
            raise ValueError(f"{dim} has {self.sizes[k]} places")
        cut = lambda xs: (*xs[:k], *xs[k + 1 :])
        shape = F.filter("shape", lambda _, i: i != k)
        df = self.df.withColumn("shape", shape).select(*[f"t_{d}" for d in cut(self.dims)], "shape", "values")
        return replace(self, df=df, dims=cut(self.dims), sizes=cut(self.sizes), tile=cut(self.tile))

    def rows(self, value: str = "value") -> DataFrame:
        """One row a cell: its place along each dimension, and its value."""
        cells = self.df.select(*self.keys, "shape", F.posexplode("values").alias("at", value))
        out, below = {}, F.lit(1)
        for k in range(len(self.dims) - 1, -1, -1):
            inside = F.floor(F.col("at") / below).cast("int") % F.get("shape", F.lit(k))
            out[self.dims[k]] = (F.col(self.keys[k]) * self.tile[k] + inside).cast("int")
            below = below * F.get("shape", F.lit(k))
        return cells.select(*[out[d].alias(d) for d in self.dims], value)

    def block(self, **ranges: tuple[int, int]) -> TiledArray:
        """The tiles that hold some place of the ranges (from, behind the last); a filter on the tiles' numbers."""
        df = self.df
        for d, (a, b) in ranges.items():
            size = self.tile[self.dims.index(d)]
            df = df.where(F.col(f"t_{d}").between(a // size, (b - 1) // size) if b > a else F.lit(False))
        return replace(self, df=df)


def to_tiles(df: DataFrame, dims: list[str], sizes: list[int], value: str, tile: list[int] | None = None) -> TiledArray:
    """Rows (places along dimensions, value) as tiles, by one shuffle. ValueError for a place that two rows have, or outside.

    A tile is put together in its task, from at most as many rows as it has cells.
    """
    tile = tuple(tile or [TILE] * len(dims))
    sizes_, keys = tuple(sizes), [f"t_{d}" for d in dims]

    def gathered(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        shape = [min(t, s - int(k) * t) for k, t, s in zip(key, tile, sizes_, strict=True)]
        if any(s <= 0 for s in shape) or min(key) < 0:
            raise ValueError(f"rows lie outside the array, in tile {tuple(map(int, key))}")
        at = [pdf[d].to_numpy() - int(k) * t for d, k, t in zip(dims, key, tile, strict=True)]
        if any((a >= s).any() for a, s in zip(at, shape, strict=True)):
            raise ValueError(f"rows lie outside the array, in tile {tuple(map(int, key))}")
        place = np.ravel_multi_index([a.astype(np.int64) for a in at], shape)
        if len(np.unique(place)) < len(place):
            raise ValueError(f"several rows are one cell, in tile {tuple(map(int, key))}")
        values = np.full(prod(shape), None, object)
        values[place] = pdf["__v"].astype(object).where(pdf["__v"].notna(), None).to_numpy()
        return pd.DataFrame({**{k: [int(x)] for k, x in zip(keys, key, strict=True)}, "shape": [shape], "values": [list(values)]})

    kind = dict(df.dtypes)[value]
    numbered = df.select(*[F.floor(F.col(d) / t).cast("int").alias(k) for d, t, k in zip(dims, tile, keys, strict=True)], *[F.col(d).cast("int").alias(d) for d in dims], F.col(value).alias("__v"))
    schema = ", ".join(f"{k} int" for k in keys) + f", shape array<int>, values array<{kind}>"
    return TiledArray(numbered.groupBy(*keys).applyInPandas(gathered, schema), tuple(dims), sizes_, tile)
