"""Helpers that every training-data operator shares: reading, cutting lineage, salted prefix sums."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that none of the frame's columns has, whatever their case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def use_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the session names in spark.checkpoint.dir; a local session without one gets a folder of our own."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return named or current.get()
    if not named and not sc.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir names no folder that executors share")
    folder = named or tempfile.mkdtemp(prefix="rivulet-checkpoints-")
    sc.setCheckpointDir(folder)
    return folder


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Texts reach Python ``rows`` at a time, so that a worker holds few of them at once; a smaller setting stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name, "10000")) <= rows:
        spark.conf.set(name, str(rows))


def bounded_batches(spark: SparkSession, size: int = 32 << 20) -> None:
    """As ``small_batches``, and no batch gets much larger than ``size`` bytes, however long texts are; smaller settings stay."""
    small_batches(spark)
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not 0 < int(spark.conf.get(name, str(2**31 - 1))) <= size:
        spark.conf.set(name, str(size))


def settle(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder; a lost executor loses nothing of it."""
    use_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Deletes a folder that an operator wrote to the shared folder and no longer needs."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def running_sum(df: DataFrame, keys: list[str], order: list[str], value: str, into: str, salt: Column, salts: int = 512) -> DataFrame:
    """Adds ``into``: the sum of ``value`` over the rows of the same keys that come before, by (salt bucket, order).

    A plain window would put a key with a third of all rows into one task. Here rows are dealt by (keys, bucket):
    a partial sum for each bucket, a window over these few sums, and a window within each bucket. ``salt`` must be
    a non-negative integer column; its buckets are ordered, so ``salt`` may carry the order itself (rows of bucket
    k come before those of k + 1).
    """
    bucketed = df.withColumn("__b", (salt % F.lit(salts)).cast("int"))
    sums = bucketed.groupBy(*keys, "__b").agg(F.sum(value).alias("__s"))
    before = Window.partitionBy(*keys).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("__base", F.coalesce(F.sum("__s").over(before), F.lit(0))).drop("__s")
    same = None
    left, right = bucketed.alias("l"), sums.alias("r")
    for k in [*keys, "__b"]:
        test = F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
        same = test if same is None else same & test
    joined = left.join(right, same, "inner").select("l.*", "r.__base")
    within = Window.partitionBy(*keys, "__b").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return joined.withColumn(into, F.col("__base") + F.coalesce(F.sum(value).over(within), F.lit(0))).drop("__b", "__base")
