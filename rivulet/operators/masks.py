"""Filters and joins by masks, ranges and conditions; upstream sums; reindexing; threshold scores."""

from __future__ import annotations

import operator
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.model import Dataset
from rivulet.operators.projections import derived_name


def extract(df: DataFrame, masks: DataFrame, on: str, mask_id: str | None = None, names: list[str] | None = None) -> DataFrame:
    """Rows whose id a mask holds. With ``names`` (the masks' identifier columns) one join serves all masks at once.

    Whether the masks are broadcast is left to the optimizer, which knows their size.
    """
    right = masks.withColumnRenamed(mask_id, on) if mask_id and mask_id != on else masks
    if not names:
        return df.join(right.select(on).distinct(), on, "left_semi")
    return df.join(right.select(on, *names).distinct(), on)


def missing_ids(df: DataFrame, mask: DataFrame, on: str, limit: int | None = None) -> DataFrame:
    """Ids of the mask that the data lack; with a limit, the first of them in order, for a report."""
    gone = mask.select(on).distinct().join(df.select(on), on, "left_anti")
    return gone.orderBy(on).limit(limit) if limit else gone


def shared_ids(df: DataFrame, mask: DataFrame, on: str, mask_id: str | None = None) -> DataFrame:
    """Ids that both hold, each once."""
    return mask.select(F.col(mask_id or on).alias(on)).distinct().join(df.select(on), on, "left_semi")


def first_row(df: DataFrame, order: list[str], by: list[str], where: Column | None = None, last: bool = False) -> DataFrame:
    """Of each group the first (or last) row in order that passes a test; groups without any have no row."""
    rows = df.where(where) if where is not None else df
    other = [c for c in df.columns if c not in by]
    pick = F.max_by if last else F.min_by
    return rows.groupBy(*by).agg(pick(F.struct(*other), F.struct(*order, *other)).alias("r")).select(*by, "r.*")


def subset(data: Dataset, mask: DataFrame, on: list[str], keep: str = "keep", variables: list[str] | None = None) -> Dataset:
    """Variables become null outside a grid mask; no cell goes. A cell that the mask lacks is outside."""
    chosen = variables or [v for v in data.variables if set(on) <= set(data.dims_of(v))]
    data.need(*chosen, *on)
    joined = data.df.join(mask.select(*on, F.col(keep).cast("boolean").alias("__keep")), on, "left")
    held = joined.withColumns({v: F.when(F.col("__keep"), F.col(v)) for v in chosen})
    return data.with_df(held.drop("__keep").select(*data.df.columns))


def grid_mask(df: DataFrame, on: list[str], variable: str) -> DataFrame:
    """A mask from a variable: any value but zero keeps the cell."""
    return df.select(*on, F.coalesce(F.col(variable) != 0, F.lit(False)).alias("keep"))


def half_open(column: str, start, stop) -> Column:
    """A label slice: from start, up to but not including stop; None leaves a side open."""
    tests = ([F.col(column) >= F.lit(start)] if start is not None else []) + ([F.col(column) < F.lit(stop)] if stop is not None else [])
    return reduce(operator.and_, tests, F.lit(True))


def nearest(df: DataFrame, column: str, value, by: list[str] | None = None) -> DataFrame:
    """For each group the row nearest to a label, ties to the smaller one, then to the other columns.

    One aggregate by group; as whole rows are compared, each task sorts its rows by group first."""
    other = [c for c in df.columns if c not in (by or [])]
    best = F.min_by(F.struct(*other), F.struct(F.abs(F.col(column) - F.lit(value)), F.col(column), *other)).alias("r")
    rows = df.groupBy(*by).agg(best) if by else df.agg(best)
    return rows.select(*(by or []), "r.*")


OPERATORS = {
    ">": operator.gt, ">=": operator.ge, "<": operator.lt, "<=": operator.le, "==": operator.eq, "=": operator.eq, "!=": operator.ne,
    "in": lambda a, b: a.isin(*b), "contains": lambda a, b: a.contains(b),
}


def condition(spec: dict) -> Column:
    """A condition on file fields: {field, operator, value}, or {and: [...]} or {or: [...]}."""
    if "and" in spec or "or" in spec:
        key = "and" if "and" in spec else "or"
        parts = [condition(s) for s in spec[key]]
        if not parts:
            return F.lit(key == "and")
        return reduce(operator.and_ if key == "and" else operator.or_, parts)
    if spec["operator"] not in OPERATORS:
        raise ValueError(f"no such operator: {spec['operator']}")
    return OPERATORS[spec["operator"]](F.col(spec["field"]), spec["value"])


def include_conditions(conditions: dict[str, object]) -> Column:
    """All fields equal their values; a field that is missing passes."""
    return reduce(operator.and_, [F.col(k).isNull() | (F.col(k) == F.lit(v)) for k, v in conditions.items()], F.lit(True))


def partition(df: DataFrame, test: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that pass, and the rest (those with an unknown result too)."""
    ok = F.coalesce(test, F.lit(False))
    return df.where(ok), df.where(~ok)


def upstream_sum(df: DataFrame, links: DataFrame, value: str, output: str, feature: str = "feature_id", link: str = "link", to: str = "to", by: list[str] | None = None) -> DataFrame:
    """For each feature the sum over features that flow into it; null if none does, or if any of them has no value.

    ``by`` are further keys, such as time. The sums are combined before their shuffle; a feature that the links lack
    flows nowhere.
    """
    by = by or []
    flow = df.select(F.col(feature).alias("__from"), *by, F.col(value).alias("__v"))
    edges = links.where(F.col(to).isNotNull() & (F.col(to) >= 0)).select(F.col(link).alias("__from"), F.col(to).alias("__to"))
    into = flow.join(edges, "__from").groupBy("__to", *by).agg(F.count(F.lit(1)).alias("__all"), F.count("__v").alias("__n"), F.sum("__v").alias("__s"))
    total = into.select(F.col("__to").alias(feature), *by, F.when(F.col("__all") == F.col("__n"), F.col("__s")).cast("float").alias(output))
    return df.join(total, [feature, *by], "left")


def inbound_edges(links: DataFrame, to: str = "to") -> DataFrame:
    return links.where(F.col(to) >= 0).groupBy(to).agg(F.count(F.lit(1)).alias("n_inbound"))


def reindex(df: DataFrame, reference: DataFrame, on: str, fill: dict[str, object], order: str | None = None) -> DataFrame:
    """A row for each id of the reference, in place of the data's rows; ids repeat no more, and missing values are filled.

    Of rows with one id the smallest by ``order`` (or by all columns) stays.
    """
    other = [c for c in df.columns if c != on]
    first = df.groupBy(on).agg(F.min_by(F.struct(*other), F.struct(*([order] if order else other))).alias("__r"))
    joined = reference.select(on).distinct().join(first, on, "left")
    return joined.select(on, *[F.coalesce(F.col(f"__r.{c}"), F.lit(fill[c])).alias(c) if c in fill else F.col(f"__r.{c}").alias(c) for c in other])


def score(value: Column, thresholds: list[tuple[Column, float]], default: float, closed: bool = False) -> Column:
    """The lowest level whose threshold is above the value, or the default; missing values and thresholds are passed over.

    With ``closed``, a threshold that equals the value counts as above it.
    """
    levels = [level for _, level in thresholds]
    if len(set(levels)) != len(levels):
        raise ValueError("levels repeat")
    out = None
    for t, level in sorted(thresholds, key=lambda x: x[1]):
        test = value <= t if closed else value < t
        out = F.when(test, F.lit(float(level))) if out is None else out.when(test, F.lit(float(level)))
    return (F.lit(float(default)) if out is None else out.otherwise(F.lit(float(default)))).cast("float")


def anomaly(data: Dataset, variable: str, climate: DataFrame, levels: dict[str, float], default: float, on: list[str], output: str = "streamflow_anomaly", closed: bool = False) -> Dataset:
    """Scores each value by its thresholds (one column for each level) for the same keys, such as feature and day of year.

    A left join: the thresholds are as large as the features, so both sides are dealt by key unless one proves small.
    """
    data.need(variable)
    joined = data.df.join(climate.select(*on, *levels), on, "left")
    scored = joined.withColumn(output, score(F.col(variable), [(F.col(c), v) for c, v in levels.items()], default, closed))
    out = data.with_df(scored.drop(*[c for c in levels if c not in data.df.columns]))
    name = str(data.var_attrs.get(variable, {}).get("long_name") or variable)
    return replace(out, var_attrs={**out.var_attrs, output: {"long_name": derived_name(name.replace(" ", "_"), "anomaly"), "units": "-"}})


def first_difference(df: DataFrame, value: str, order: str, by: list[str], output: str = "diff") -> DataFrame:
    return df.withColumn(output, F.col(value) - F.lag(value).over(Window.partitionBy(*by).orderBy(order)))


def last_wins(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """One value for each key: that of the last row in order."""
    return df.groupBy(key).agg(F.max_by(value, order).alias(value))
