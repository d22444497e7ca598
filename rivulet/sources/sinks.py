"""Sinks: templated outputs, packed encodings, duplicate targets, reports."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.functions.text import fill_template, template_variables
from rivulet.functions.units import FILL, SCALE, pack
from rivulet.model import Dataset
from rivulet.operators.masks import include_conditions


def default_encoding(data: Dataset) -> dict[str, dict[str, object]]:
    """Encodings with the default for real variables that have none: whole numbers of 0.01, compressed."""
    real = [n for n, t in data.df.dtypes if t in ("float", "double") and n in data.variables]
    default = {"_FillValue": FILL, "scale_factor": SCALE, "dtype": "int32", "compression": "zstd"}
    return {n: {**default, **data.encoding.get(n, {})} for n in real} | {n: e for n, e in data.encoding.items() if n not in real}


def packed(data: Dataset) -> DataFrame:
    """The table with real variables packed as their encoding says."""
    enc = default_encoding(data)
    real = {n for n, t in data.df.dtypes if t in ("float", "double")}
    columns = {n: pack(F.col(n), float(e["scale_factor"]), int(e["_FillValue"]), float(e.get("add_offset", 0))) for n, e in enc.items() if n in real and e.get("dtype") == "int32"}
    return data.df.withColumns(columns) if columns else data.df


def target_name(template: str) -> Column:
    """A template whose variables are columns, for each row."""
    names = template_variables(template)
    pattern = template
    for n in names:
        pattern = pattern.replace("{" + n + "}", "%s")
    return F.format_string(pattern, *[F.col(n).cast("string") for n in names]) if names else F.lit(template)


def save_targets(df: DataFrame, template: str, conditions: dict[str, object] | None = None, keys: list[str] | None = None) -> DataFrame:
    """Where each file's rows go: one row a file (its keys) with ``target``; the conditions choose files."""
    rows = df.where(include_conditions(conditions)) if conditions else df
    names = list(dict.fromkeys([*(keys or []), *template_variables(template)]))
    return rows.select(*names).distinct().withColumn("target", target_name(template))


def duplicate_targets(targets: DataFrame) -> DataFrame:
    return targets.groupBy("target").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def save(data: Dataset, directory: str, template: str, values: dict[str, object] | None = None, conditions: dict[str, object] | None = None, pack_values: bool = False, mode: str = "errorifexists", keys: list[str] | None = None) -> list[str]:
    """Writes the files; returns their paths. One file's rows go to one folder, by a write partitioned by target.

    A template without columns makes one target. FileExistsError names targets that two files share.
    """
    names = template_variables(template)
    in_columns = [n for n in names if n in data.df.columns]
    if not in_columns:
        path = f"{directory.rstrip('/')}/{fill_template(template, values or {}, data.metadata, data.attrs)}"
        (packed(data) if pack_values else data.df).write.mode(mode).option("compression", "zstd").parquet(path)
        return [path]
    fixed = {n: fill_template("{" + n + "}", values or {}, data.metadata, data.attrs) for n in names if n not in in_columns}
    for n, v in fixed.items():
        template = template.replace("{" + n + "}", v)
    rows = data.with_df(data.df.where(include_conditions(conditions)) if conditions else data.df)
    targets = save_targets(rows.df, template, keys=keys or list(data.file_key))
    twice = [r["target"] for r in duplicate_targets(targets).limit(5).collect()]
    if twice:
        raise FileExistsError(f"several files would be {', '.join(twice)}")
    out = (packed(rows) if pack_values else rows.df).withColumn("target", target_name(template))
    # Rows of a target meet in few files, and a large target is spread over several tasks.
    out.hint("rebalance", "target").write.mode(mode).option("compression", "zstd").partitionBy("target").parquet(directory)
    return [f"{directory.rstrip('/')}/target={r['target']}" for r in targets.select("target").distinct().orderBy("target").toLocalIterator()]


def to_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def as_json(df: DataFrame, columns: list[str] | None = None, into: str = "json") -> DataFrame:
    """Adds each row, or some of its columns, as JSON; nulls are left out."""
    return df.withColumn(into, F.to_json(F.struct(*(columns or df.columns))))


def rewrite(data: Dataset, function, path: str, mode: str = "errorifexists") -> None:
    """A dataset through a function, and what comes of it written."""
    function(data).df.write.mode(mode).option("compression", "zstd").parquet(path)


def scratch_folder(spark) -> str:
    """A new folder below the shared one that spark.checkpoint.dir names; without it only a local session has one."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return f"{named.rstrip('/')}/scratch-{uuid.uuid4()}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir names no folder")
    return tempfile.mkdtemp(prefix="rivulet-scratch-")


def peek(data: Dataset, show: int = 5) -> str:
    """What a dataset is, for the log: its description and plan; ``show`` rows of it if any."""
    text = data.describe()
    return text + ("\n" + data.df._show_string(show, 40, False) if show else "")


def describe_values(data: Dataset) -> DataFrame:
    """One row a variable: name, dims, type, units, and of its values n, missing, least and most (as text); one scan."""
    names = [c for c in data.df.columns if c not in data.file_key]
    parts = [x for k, c in enumerate(names) for x in (F.count(c).alias(f"n{k}"), F.min(c).cast("string").alias(f"a{k}"), F.max(c).cast("string").alias(f"b{k}"))]
    kinds = dict(data.df.dtypes)

    def row(k: int, c: str) -> Column:
        units = data.var_attrs.get(c, {}).get("units")
        about = {"name": F.lit(c), "dims": F.lit(", ".join(data.dims_of(c))), "type": F.lit(kinds[c]), "units": F.lit(units).cast("string")}
        held = {"n": F.col(f"n{k}"), "missing": F.col("all") - F.col(f"n{k}"), "least": F.col(f"a{k}"), "most": F.col(f"b{k}")}
        return F.struct(*[v.alias(n) for n, v in (about | held).items()])

    return data.df.agg(F.count(F.lit(1)).alias("all"), *parts).select(F.inline(F.array(*[row(k, c) for k, c in enumerate(names)])))


def with_attributes(data: Dataset, names: list[str]) -> DataFrame:
    """Long rows (dimensions, variable, value, attrs): each cell's values beside what their variables' attributes say."""
    keys = [d for d in (*data.dims, *data.file_key) if d in data.df.columns]
    attrs = lambda v: F.create_map(*[F.lit(str(x)) for kv in data.var_attrs.get(v, {}).items() for x in kv]).cast("map<string,string>")
    rows = F.array(*[F.struct(F.lit(v).alias("variable"), F.col(v).cast("double").alias("value"), attrs(v).alias("attrs")) for v in names])
    return data.df.select(*keys, F.inline(rows))
