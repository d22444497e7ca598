"""Folds with kept state: what has been folded so far as a table, merged with new files, finished when asked for.

A state has one row a cell and a few numbers for each folded variable, whatever the number of files behind it: count, sum,
minimum, maximum, mean, the sum of squared deviations, and a quantile sketch for the median. States are made by one
aggregate, merge by another (deviations by the rule for two samples, in order of the states), and finish by plain columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Numbers that each operation needs; a fixed list.
NEEDS = {"count": (), "sum": ("sum",), "min": ("min",), "max": ("max",), "mean": ("mean", "m2"), "variance": ("mean", "m2"), "std": ("mean", "m2"), "variance_sample": ("mean", "m2"), "median": ("sketch",)}
#: Size parameter of the sketches; with it the median's rank is off by under SKETCH_ERROR of the count in 999 cases of 1000.
SKETCH_K = 1600
SKETCH_ERROR = 0.004


def _needed(folds: list[tuple[str, str, str]]) -> dict[str, list[str]]:
    unknown = [op for _, op, _ in folds if op not in NEEDS]
    if unknown:
        raise KeyError(f"no such operation with kept state: {', '.join(unknown)}")
    out: dict[str, list[str]] = {}
    for v, op, _ in folds:
        held = out.setdefault(v, ["n"])
        held += [x for x in NEEDS[op] if x not in held]
    return out


def fold_state(df: DataFrame, keys: list[str], folds: list[tuple[str, str, str]]) -> DataFrame:
    """The state of these rows for folds of (variable, operation, output): one row a cell, ``<variable>__<number>`` columns."""
    parts = {
        "n": F.count, "sum": lambda v: F.sum(v.cast("double")), "min": F.min, "max": F.max, "mean": lambda v: F.avg(v.cast("double")),
        "m2": lambda v: F.var_pop(v.cast("double")) * F.count(v), "sketch": lambda v: F.kll_sketch_agg_double(v.cast("double"), F.lit(SKETCH_K)),
    }
    asked = [parts[x](F.col(v)).alias(f"{v}__{x}") for v, held in _needed(folds).items() for x in held]
    out = df.groupBy(*keys).agg(*asked)
    # A sketch of no value is none; the sketch's aggregate gives an empty one.
    return out.withColumns({f"{v}__sketch": F.when(F.col(f"{v}__n") > 0, F.col(f"{v}__sketch")) for v, held in _needed(folds).items() if "sketch" in held})


def _moments(v: str, states: Column) -> Column:
    """(n, mean, m2) of several samples, one after the other."""
    none = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))

    def both(a: Column, b: Column) -> Column:
        n = a["n"] + b["n"]
        off = b["mean"] - a["mean"]
        mean = a["mean"] + off * b["n"] / n
        m2 = a["m2"] + b["m2"] + off * off * (a["n"] / n) * b["n"]
        return F.when(b["n"] == 0, a).when(a["n"] == 0, b).otherwise(F.struct(n.alias("n"), mean.alias("mean"), m2.alias("m2")))

    return F.reduce(states, none, both)


def merge_states(states: list[DataFrame], keys: list[str], folds: list[tuple[str, str, str]]) -> DataFrame:
    """One state of several: one aggregate by cell over all of them; a cell gathers at most one row a state."""
    rows = None
    for k, s in enumerate(states):
        one = s.withColumn("__order", F.lit(k))
        rows = one if rows is None else rows.unionByName(one)
    asked = []
    needed = _needed(folds)
    for v, held in needed.items():
        c = lambda x, v=v: F.col(f"{v}__{x}")
        if "mean" in held:
            sample = F.struct("__order", c("n").alias("n"), F.coalesce(c("mean"), F.lit(0.0)).alias("mean"), F.coalesce(c("m2"), F.lit(0.0)).alias("m2"))
            samples = F.transform(F.sort_array(F.collect_list(sample)), lambda s: F.struct(s["n"].alias("n"), s["mean"].alias("mean"), s["m2"].alias("m2")))
            asked.append(_moments(v, samples).alias(f"{v}__moments"))
        else:
            asked.append(F.sum(c("n")).alias(f"{v}__n"))
        asked += [f(c(x)).alias(f"{v}__{x}") for x, f in (("sum", F.sum), ("min", F.min), ("max", F.max)) if x in held]
        if "sketch" in held:
            asked.append(F.kll_merge_agg_double(c("sketch"), F.lit(SKETCH_K)).alias(f"{v}__sketch"))
    merged = rows.groupBy(*keys).agg(*asked)
    columns = [F.col(k) for k in keys]
    for v, held in needed.items():
        moments = F.col(f"{v}__moments") if "mean" in held else None
        n = moments["n"] if moments is not None else F.col(f"{v}__n")
        for x in held:
            value = n if x == "n" else moments[x] if x in ("mean", "m2") else F.col(f"{v}__{x}")
            columns.append((value if x == "n" else F.when(n > 0, value)).alias(f"{v}__{x}"))
    return merged.select(*columns)


def finish(state: DataFrame, keys: list[str], folds: list[tuple[str, str, str]]) -> DataFrame:
    """The folds' results, as ``fold_cells`` gives them; the median is a value of the cell whose rank is near the middle."""
    _needed(folds)

    def value(v: str, op: str) -> Column:
        n = F.col(f"{v}__n")
        if op == "count":
            return n
        if op in ("sum", "min", "max", "mean"):
            return F.col(f"{v}__{op}")
        if op == "median":
            return F.when(n > 0, F.kll_sketch_get_quantile_double(F.col(f"{v}__sketch"), F.lit(0.5)))
        m2 = F.greatest(F.col(f"{v}__m2"), F.lit(0.0))
        if op == "variance_sample":
            return F.when(n > 1, m2 / (n - 1))
        variance = F.when(n > 1, m2 / n)
        return variance if op == "variance" else F.sqrt(variance)

    return state.select(*keys, *[value(v, op).alias(out) for v, op, out in folds])


class StateStore:
    """States of one fold under a folder, one version a folder; a version is there when Spark has marked it as written.

    A version is named by who adds to it (a batch's number, say), so that adding the same again after a failure replaces it.
    """

    def __init__(self, spark, path: str, keys: list[str], folds: list[tuple[str, str, str]]):
        self.spark, self.path, self.keys, self.folds = spark, path.rstrip("/"), list(keys), list(folds)
        _needed(self.folds)

    def versions(self) -> list[int]:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        top = jvm.org.apache.hadoop.fs.Path(self.path)
        fs = top.getFileSystem(conf)
        if not fs.exists(top):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(top)]
        done = [n for n in names if n.startswith("v") and fs.exists(jvm.org.apache.hadoop.fs.Path(f"{self.path}/{n}/_SUCCESS"))]
        return sorted(int(n[1:]) for n in done)

    def read(self, version: int | None = None) -> DataFrame | None:
        """The newest state, or that of a version; None if there is none yet."""
        there = self.versions()
        if version is None and not there:
            return None
        return self.spark.read.parquet(f"{self.path}/v{version if version is not None else there[-1]:012d}")

    def add(self, df: DataFrame, version: int | None = None) -> int:
        """Folds rows into the newest state before ``version`` (by default a new one) and writes it; returns its number."""
        there = self.versions()
        version = (there[-1] + 1 if there else 1) if version is None else version
        new = fold_state(df, self.keys, self.folds)
        before = [v for v in there if v < version]
        if before:
            new = merge_states([self.read(before[-1]), new], self.keys, self.folds)
        new.write.mode("overwrite").parquet(f"{self.path}/v{version:012d}")
        return version

    def result(self) -> DataFrame | None:
        state = self.read()
        return None if state is None else finish(state, self.keys, self.folds)

    def expire(self, keep: int = 2) -> None:
        """Deletes all but the newest versions."""
        jvm = self.spark._jvm
        for v in self.versions()[:-keep] if keep > 0 else []:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/v{v:012d}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def fold_stream(stream: DataFrame, store: StateStore, checkpoint: str):
    """A query that folds each batch of a stream into the store and stops when all is read; median too. Batches that are
    run again after a failure replace what they had written."""

    def add(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            store.add(batch, number + 1)
            store.expire()

    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
