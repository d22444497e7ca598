"""Scans: cycles of files, single variables and labels, tables of text, and what describes them."""

from __future__ import annotations

import re
from collections.abc import Callable
from string import Formatter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.functions.calendar import date_parts, lead_seconds
from rivulet.functions.text import FILE_PATTERN, parse_file_name
from rivulet.model import Dataset, from_table

#: A line of the timing log, its fields in order.
TIMING_FIELDS = ("date", "path", "line", "code_path", "function", "call", "status", "duration", "pid")


def read_table(spark: SparkSession, paths: str | list[str], form: str = "parquet", **options) -> DataFrame:
    """One or many paths, aligned by column name; columns that some files lack are null for these."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    if form == "netcdf":
        from rivulet.sources.netcdf import read_netcdf

        return read_netcdf(spark, ",".join(paths), **options)
    reader = spark.read.format(form).options(**options)
    if form == "parquet" and len(paths) > 1:
        reader = reader.option("mergeSchema", "true")
    return reader.load(paths)


def with_identity(df: DataFrame, name: Column | None = None) -> DataFrame:
    """Adds what a file's name says: cycle, configuration, output_type, member, frame, region and lead_seconds."""
    # A file <name>.parquet, or a part in a folder of that name.
    file = name if name is not None else F.regexp_extract("_metadata.file_path", r"([^/]+\.nc)(?:\.parquet)?(?:/[^/]*)?$", 1)
    out = df.withColumn("__file", file).withColumns(parse_file_name(F.col("__file")))
    return out.withColumn("lead_seconds", lead_seconds(F.col("frame"))).drop("__file")


def read_cycle(spark: SparkSession, folder: str, cycle: str, configuration: str, output_type: str, region: str, member: str | None = None, expected: int | None = None, form: str = "parquet", **options) -> DataFrame:
    """All files of one cycle in a folder, picked by name before anything is read: <file name>.parquet folders or files, or
    NetCDF files themselves. A region may name its centre (alaska.aprfc)."""
    kind = output_type if member is None else f"{output_type}_{member}"
    pattern = f"{folder.rstrip('/')}/nwm.t{cycle}z.{configuration}.{kind}.*.{region}.nc"
    if form == "netcdf":
        from rivulet.sources.netcdf import read_netcdf

        df = with_identity(read_netcdf(spark, pattern, **options), F.col("file"))
    else:
        df = with_identity(spark.read.parquet(f"{pattern}*"))
    df = df.where(F.col("output_type") == output_type)  # the pattern's star may stand for more of a dotted type
    if expected is not None and (n := df.select("frame").distinct().count()) != expected:
        raise ValueError(f"{n} files of this cycle, not {expected}")
    return df


def unknown_names(files: DataFrame, name: str = "file") -> DataFrame:
    """(name, n): names that are no forecast file's, so that nothing goes unseen."""
    return files.where(~F.col(name).rlike(FILE_PATTERN)).groupBy(name).agg(F.count(F.lit(1)).alias("n"))


def select_label(df: DataFrame, criteria: dict[str, object], columns: list[str] | None = None) -> DataFrame:
    """Rows with given labels (values or lists of them), and maybe single columns: filters reach the files."""
    missing = [c for c in criteria if c not in df.columns]
    if missing:
        raise KeyError(f"no {', '.join(missing)}")
    for c, v in criteria.items():
        df = df.where(F.col(c).isin(*v) if isinstance(v, (list, tuple, set)) else F.col(c) == F.lit(v))
    return df.select(*columns) if columns else df


def transform_variable(df: DataFrame, variable: str, function: Callable[[Column], Column], where: Column | None = None, keys: list[str] | None = None) -> DataFrame:
    """One variable through a column function, after a filter; nothing else is read."""
    rows = df.where(where) if where is not None else df
    return rows.select(*(keys or []), function(F.col(variable)).alias(variable))


def load_metadata(data: Dataset, times: list[str] | None = None) -> dict[str, object]:
    """Template variables: attributes, <variable>.<attribute>, scalars, and the parts of times that have one value."""
    out = dict(data.attrs) | {f"{v}.{a}": x for v, attrs in data.var_attrs.items() for a, x in attrs.items()} | dict(data.scalars)
    if times:
        asked = [x for t in times for x in (F.min(t).alias(t), F.max(t).alias(f"{t}__max"))]
        row = data.df.agg(*asked).first()
        single = [t for t in times if row[t] is not None and row[t] == row[f"{t}__max"]]
        if single:
            parts = {n: c for t in single for n, c in date_parts(t, F.lit(row[t])).items()}
            out |= {t: row[t] for t in single} | data.df.sparkSession.range(1).select(*[c.alias(n) for n, c in parts.items()]).first().asDict()
    return out


def expand_paths(paths: list[str], values: dict[str, object]) -> list[str]:
    """Paths with their braces filled; globs stay for the reader, which knows the file system."""
    out = []
    for p in paths:
        names = [f for _, f, _, _ in Formatter().parse(p) if f]
        gone = [n for n in names if n not in values]
        if gone:
            raise ValueError(f"nothing fills {', '.join(gone)} in '{p}'")
        out.append(p.format(**values))
    return out


def similar_names(name: str, there: list[str], most: int = 5) -> list[str]:
    """Names that end like the missing one, for error messages."""
    parts = name.split(".")
    ranked = sorted(there, key=lambda n: (-sum(a == b for a, b in zip(reversed(n.split(".")), reversed(parts))), n))
    return ranked[:most]


def similar_in(there: DataFrame, column: str, name: str, most: int = 5) -> DataFrame:
    """(name, alike): of a table's names those that end most like the missing one, by equal parts counted from the end."""
    parts = F.array(*[F.lit(p) for p in reversed(name.split("."))])
    own = F.slice(F.reverse(F.split(column, r"\.")), 1, len(name.split(".")))
    alike = F.size(F.filter(F.zip_with(own, parts, lambda a, b: F.coalesce(a == b, F.lit(False))), lambda x: x))
    return there.select(F.col(column).alias("name"), alike.alias("alike")).distinct().orderBy(F.desc("alike"), "name").limit(most)


def read_links(spark: SparkSession, path: str, form: str = "parquet", link: str = "link", to: str = "to") -> DataFrame:
    """Edges of a river network: (link, to), each link once."""
    df = read_table(spark, path, form, **({"header": "true"} if form == "csv" else {}))
    return df.select(F.col(link).cast("long").alias("link"), F.col(to).cast("long").alias("to")).groupBy("link").agg(F.min("to").alias("to"))


def read_mask(df: DataFrame, on: list[str], variable: str | None = None) -> DataFrame:
    """Ids of a mask, each once; or cells of a grid mask with whether they are kept."""
    if variable is None:
        return df.select(*on).distinct()
    return df.select(*on, F.coalesce(F.col(variable) != 0, F.lit(False)).alias("keep"))


def daily_thresholds(df: DataFrame, variable: str, first: int, last: int, keys: tuple[str, ...] = ("feature_id", "day")) -> DataFrame:
    """Thresholds of a range of days, which may run over the end of the year; the filter reaches the files."""
    day = F.col(keys[-1])
    within = day.between(first, last) if first <= last else (day >= first) | (day <= last)
    return df.where(within).select(*keys, F.col(variable).cast("float").alias(variable))


def read_timing_log(spark: SparkSession, path: str) -> DataFrame:
    """Lines of fields between bars, the last of them (a process id) optional; other lines are passed over."""
    pattern = r"^\s*" + r"\s*\|\s*".join([r"([^|]*?)"] * 8) + r"(?:\s*\|\s*([^|]*?))?\s*$"
    lines = spark.read.text(path).where(F.col("value").rlike(pattern))
    out = lines.select(*[F.nullif(F.regexp_extract("value", pattern, k), F.lit("")).alias(n) for k, n in enumerate(TIMING_FIELDS, 1)])
    return out.withColumns({"date": F.try_to_timestamp("date"), "line": F.col("line").try_cast("int"), "duration": F.col("duration").try_cast("double"), "pid": F.col("pid").try_cast("int")})


def unpivot_jagged(df: DataFrame, keys: list[str], tails: list[str], output: str) -> DataFrame:
    """Rows whose last columns hold any number of values: one row a value, empty ones gone."""
    values = F.array_compact(F.array(*[F.nullif(F.trim(F.col(c).cast("string")), F.lit("")) for c in tails]))
    return df.select(*keys, F.explode(values).alias(output))


def point_series(data: Dataset, feature: str, value: object, variables: list[str], time: str = "time") -> DataFrame:
    """One feature's values over time."""
    data.need(feature, time, *variables)
    return data.df.where(F.col(feature) == F.lit(value)).select(time, *variables)


def day_coordinate(df: DataFrame, order: str, by: list[str], output: str = "day") -> DataFrame:
    """Numbers rows from 1 within each feature: the day of the year where a file lacks it."""
    from pyspark.sql import Window

    return df.withColumn(output, F.row_number().over(Window.partitionBy(*by).orderBy(order)).cast("int"))


def read_layer(spark: SparkSession, path: str, form: str, query: str | None, dims: list[str], variables: list[str]) -> Dataset:
    """A layer of features: maybe filtered by an expression, as variables over its dimensions."""
    df = read_table(spark, path, form)
    return from_table((df.where(query) if query else df).select(*dims, *variables), dims)


def is_netcdf(content: Column) -> Column:
    """Whether bytes begin as NetCDF files do."""
    head = F.hex(F.substring(content, 1, 4))
    return head.isin("43444601", "43444602", "89484446")


def header_schema(df: DataFrame) -> DataFrame:
    """(name, type) of each column, as a table."""
    return df.sparkSession.createDataFrame([(n, t) for n, t in df.dtypes], "name string, type string")


def header_counts(df: DataFrame) -> DataFrame:
    """(name, type, n): each column, its type and how many values it has; one scan."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"c{k}") for k, c in enumerate(df.columns)])
    rows = F.array(*[F.struct(F.lit(c).alias("name"), F.lit(t).alias("type"), F.col(f"c{k}").alias("n")) for k, (c, t) in enumerate(df.dtypes)])
    return counts.select(F.inline(rows))


def metadata_table(spark: SparkSession, metadata: dict[str, object]) -> DataFrame:
    """(name, value) of template variables, as a table."""
    return spark.createDataFrame([(k, str(v)) for k, v in metadata.items()], "name string, value string")


def recent_calls(log: DataFrame, since=None, without: list[str] | None = None, pid: int | None = None) -> DataFrame:
    """Lines of a timing log from a time on, without some functions, of one process."""
    tests = ([F.col("date") >= F.lit(since)] if since is not None else []) + ([~F.col("function").isin(*without)] if without else []) + ([F.col("pid") == pid] if pid is not None else [])
    for t in tests:
        log = log.where(t)
    return log


def glob_to_regex(glob: str) -> str:
    return "^" + re.escape(glob).replace(r"\*", ".*").replace(r"\?", ".") + "$"
