"""Cell-wise aggregates over files, groups by lead time, and time bounds: one partial and one final aggregate each."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.functions.calendar import universal_day
from rivulet.model import Dataset

#: How each operation folds a variable; nulls are skipped, and a cell without a value stays null.
FOLDS: dict[str, Callable[[Column], Column]] = {
    "sum": F.sum,
    "min": F.min,
    "max": F.max,
    "mean": F.avg,
    "median": lambda v: F.percentile(v, F.lit(0.5)),
    "variance": lambda v: F.when(F.count(v) > 1, F.var_pop(v)),
    "std": lambda v: F.when(F.count(v) > 1, F.stddev_pop(v)),
    "variance_sample": F.var_samp,
    "count": F.count,
}


def exact_mean(name: str) -> Column:
    """The mean of doubles as the nearest double, whatever the rows' order: sums of 18 decimal places are exact.

    A mean of doubles depends on the order in which they are added, which decides when a value equals it. Where decimals
    do not hold the values (more places, too large, not finite), it is the plain mean.
    """
    v = F.col(name)
    places = v.try_cast("decimal(38,18)")
    return F.coalesce(F.when(F.count_if(places.cast("double") == v) == F.count(v), F.try_avg(places).cast("double")), F.avg(v))


def register_fold(name: str, fold: Callable[[Column], Column]) -> None:
    """Adds an aggregate under a new name; KeyError if the name is taken."""
    if name in FOLDS:
        raise KeyError(f"{name} is there already")
    FOLDS[name] = fold


def variance_with_zero(v: Column) -> Column:
    """Population variance of the values and one more observation of zero, as older products report it."""
    n = F.count(v) + 1
    return F.when(F.count(v) > 1, F.sum(v * v) / n - (F.sum(v) / n) * (F.sum(v) / n))


def std_with_zero(v: Column) -> Column:
    return F.sqrt(F.greatest(variance_with_zero(v), F.lit(0.0)))


FOLDS |= {"variance_compat": variance_with_zero, "std_compat": std_with_zero}


def fold_cells(df: DataFrame, keys: list[str], folds: list[tuple[str, str, str]]) -> DataFrame:
    """Rows of (variable, operation, output) folded by the cells' keys."""
    unknown = [op for _, op, _ in folds if op not in FOLDS]
    if unknown:
        raise KeyError(f"no such operation: {', '.join(unknown)}")
    return df.groupBy(*keys).agg(*[FOLDS[op](F.col(v)).alias(out) for v, op, out in folds])


def stream_fold(data: Dataset, operations: list[dict], by: list[str] | None = None) -> Dataset:
    """Folds variables over the files: one row a cell. Each operation has variable, operation and maybe output_variable.

    ``by`` (or the dimensions other than time) are the cell's keys. Coordinates keep their last value in time.
    """
    folds = [(o["variable"], o["operation"], o.get("output_variable") or o["variable"]) for o in operations]
    data.need(*[f[0] for f in folds])
    keys = by if by is not None else [d for d in data.dims if d != "time"]
    out = fold_cells(data.df, keys, folds)
    first = (data.dims or ("time",))[0]
    attrs = {o: {**data.var_attrs.get(v, {}), "cell_methods": f"{first}: {op}"} for v, op, o in folds}
    return replace(data, df=out, dims=tuple(k for k in data.dims if k in keys), coords=(), file_key=tuple(k for k in keys if k in data.file_key), var_attrs={**data.var_attrs, **attrs})


def lead_bucket(lead_s: Column, duration_s: float) -> Column:
    """Number of the bucket (k * d, (k + 1) * d], from 1; leads up to one duration, negative ones too, are in the first."""
    return F.greatest(F.ceil(lead_s / F.lit(float(duration_s))), F.lit(1)).cast("long")


def bucket_name(last_lead_s: Column, duration_s: float) -> Column:
    """day<N> for whole days in buckets of a day, else the hours of the last lead."""
    hours = F.floor(last_lead_s / 3600)
    whole_day = F.lit(duration_s == 86400) & (last_lead_s >= 86400) & (last_lead_s % 86400 == 0)
    return F.when(whole_day, F.concat(F.lit("day"), F.floor(last_lead_s / 86400).cast("string"))).otherwise(F.concat(hours.cast("string"), F.lit("hours")))


def group_by_lead(df: DataFrame, lead: str, duration_s: float, keys: list[str], folds: list[tuple[str, str, str]], time: str | None = None, period_s: float = 3600) -> DataFrame:
    """Folds by lead bucket and cell, with the bucket's name by its last lead anywhere, and maybe its time bounds.

    Names and bounds come from a few numbers for each bucket, so they join back as a small table.
    """
    placed = df.withColumn("bucket", lead_bucket(F.col(lead), duration_s))
    folded = fold_cells(placed, ["bucket", *keys], folds)
    about = [F.max(lead).alias("last_lead")]
    if time:
        about += [F.min(time).alias("first_time"), F.max(time).alias("bound_high")]
    buckets = placed.groupBy("bucket").agg(*about).withColumn("group", bucket_name(F.col("last_lead"), duration_s))
    if time:
        buckets = buckets.withColumn("bound_low", F.col("first_time") - F.make_dt_interval(secs=F.lit(period_s))).drop("first_time")
    return folded.join(buckets.drop("last_lead"), "bucket")


def lead_interval(lead_s: Column, duration_s: float) -> Column:
    """The bucket of a lead as (floor, maximum], in seconds; that of the first bucket begins at 0."""
    bucket = lead_bucket(lead_s, duration_s)
    return F.struct(((bucket - 1) * duration_s).cast("double").alias("floor"), (bucket * duration_s).cast("double").alias("maximum"))


def bounds(df: DataFrame, time: str, seconds: float, keys: list[str], low: str = "lower_bound", high: str = "upper_bound") -> DataFrame:
    """(earliest time - duration, latest time) of each file: one row a file."""
    return df.groupBy(*keys).agg((F.min(time) - F.make_dt_interval(secs=F.lit(seconds))).alias(low), F.max(time).alias(high))


def day_range(df: DataFrame, time: str, keys: list[str] | None = None) -> DataFrame:
    """The first and last universal day of the year: min_day, max_day."""
    day = universal_day(F.col(time))
    asked = [F.min(day).alias("min_day"), F.max(day).alias("max_day")]
    return df.groupBy(*keys).agg(*asked) if keys else df.agg(*asked)


def quantiles(df: DataFrame, variable: str, levels: dict[str, float], keys: list[str]) -> DataFrame:
    """Exact quantiles by linear interpolation: one column a level."""
    return df.groupBy(*keys).agg(*[F.percentile(variable, F.lit(p)).alias(n) for n, p in levels.items()])


def time_bounds(data: Dataset, time: str = "time", amount: float = 1.0, unit: str = "hours", output: str = "time_bounds", dimension: str = "nv") -> Dataset:
    """[earliest time - duration, latest time] of each file, beside its cells."""
    data.need(time)
    seconds = amount * {"seconds": 1, "minutes": 60, "hours": 3600, "days": 86400}[unit.lower()]
    keys = list(data.file_key)
    step = F.make_dt_interval(secs=F.lit(seconds))
    bounds = F.array(F.min(time) - step, F.max(time)).alias(output)
    if keys:
        out = data.df.join(data.df.groupBy(*keys).agg(bounds), keys)
        return replace(data, df=out, var_dims={**data.var_dims, output: ("time", dimension)})
    row = data.df.agg(bounds).first()
    return replace(data, scalars={**data.scalars, output: row[0]}, var_dims={**data.var_dims, output: ("time", dimension)})


def duplicate_ids(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def timing_statistics(df: DataFrame, keys: list[str], duration: str, least: float, top: int = 15) -> DataFrame:
    """Duration statistics by keys; the ``top`` slowest of those that never ran under ``least``."""
    d = F.col(duration)
    stats = df.groupBy(*keys).agg(F.max(d).alias("max_duration"), F.min(d).alias("min_duration"), F.count(d).alias("calls"), F.avg(d).alias("mean_duration"), F.sum(d).alias("total_duration"))
    return stats.where(F.col("min_duration") >= least).orderBy(F.desc("max_duration"), F.desc("mean_duration"), *keys).limit(top)
