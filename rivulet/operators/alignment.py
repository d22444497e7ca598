"""Files as one by their coordinates, with checks: which ranges they cover, whether these overlap, and what disagrees.

Files of different times lie one behind the other; what else they share is aligned cell by cell, each variable taking the value
that some file has. Two files with different values for one cell are a conflict, named by cell.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rivulet.model import Dataset


class Misaligned(ValueError):
    """Files whose ranges overlap or whose values disagree."""


def coordinate_ranges(data: Dataset, dim: str) -> DataFrame:
    """(file key, first, last, n): what each file covers of a dimension, in the order of its first value; one row a file."""
    data.need(dim, *data.file_key)
    c = F.col(dim)
    return data.df.groupBy(*data.file_key).agg(F.min(c).alias("first"), F.max(c).alias("last"), F.count_distinct(c).alias("n"))


def overlapping_ranges(ranges: DataFrame, keys: list[str], within: list[str] | None = None) -> DataFrame:
    """(key..., other, first, last_before): files that begin before one with an earlier start has ended, with that one.

    ``within`` are keys that part files into groups (regions, members) where each is looked at alone. Windows run over one
    row a file.
    """
    own = [k for k in keys if k not in (within or [])]
    name = F.concat_ws(".", *[F.col(k).cast("string") for k in own])
    order = Window.partitionBy(*(within or [F.lit(0)])).orderBy("first", "last", name)
    so_far = order.rowsBetween(Window.unboundedPreceding, -1)
    # The one before that ends last.
    before = F.max(F.struct(F.col("last").alias("last"), name.alias("other"))).over(so_far)
    found = ranges.withColumn("before", before).where(F.col("first") <= F.col("before.last"))
    return found.select(*keys, F.col("before.other").alias("other"), "first", F.col("before.last").alias("last_before"))


def conflicting_cells(data: Dataset, variables: list[str] | None = None) -> DataFrame:
    """(dimensions..., variable, least, most, n_files): cells for which files have different values; one aggregate."""
    chosen = variables or data.variables
    keys = list(data.dims)
    asked = [x for k, v in enumerate(chosen) for x in (F.min(v).alias(f"a{k}"), F.max(v).alias(f"b{k}"), F.count(v).alias(f"n{k}"))]
    cells = data.df.groupBy(*keys).agg(*asked)
    rows = F.array(*[F.struct(F.lit(v).alias("variable"), F.col(f"a{k}").cast("string").alias("least"), F.col(f"b{k}").cast("string").alias("most"), F.col(f"n{k}").alias("n_files"), (~F.col(f"a{k}").eqNullSafe(F.col(f"b{k}"))).alias("differ")) for k, v in enumerate(chosen)])
    return cells.select(*keys, F.inline(rows)).where("differ").drop("differ")


def align(data: Dataset, along: str | None = None, conflicts: str = "raise") -> Dataset:
    """All files as one, each cell once: a full outer alignment, each variable with the value that some file has.

    ``along``: the dimension on which files must follow each other; Misaligned names two that overlap. ``conflicts``: "raise"
    (Misaligned names some cells; a job of its own), or "least" or "most", which pick one of the values.
    """
    if conflicts not in ("raise", "least", "most"):
        raise ValueError(f"conflicts can be raise, least or most, not {conflicts}")
    if along is not None and data.file_key:
        for r in overlapping_ranges(coordinate_ranges(data, along), list(data.file_key)).limit(1).collect():
            mine = ".".join(str(r[k]) for k in data.file_key)
            raise Misaligned(f"{mine} begins at {r['first']}, before {r['other']} ends at {r['last_before']}")
    if conflicts == "raise":
        some = conflicting_cells(data).limit(3).collect()
        if some:
            raise Misaligned("files disagree: " + "; ".join(f"{r['variable']} at {', '.join(f'{d}={r[d]}' for d in data.dims)}: {r['least']} and {r['most']}" for r in some))
    pick = F.max if conflicts == "most" else F.min
    held = [c for c in data.df.columns if c not in data.dims and c not in data.file_key]
    df = data.df.groupBy(*data.dims).agg(*[pick(c).alias(c) for c in held])
    return replace(data, df=df.select(*[c for c in data.df.columns if c in df.columns]), file_key=())
