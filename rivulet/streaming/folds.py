"""The cell-wise folds over unbounded input: the same expressions with event-time windows and watermarks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.operators.aggregates import FOLDS


def lead_windows(stream: DataFrame, time: str, duration: str, keys: list[str], folds: list[tuple[str, str, str]], late: str = "1 hour") -> DataFrame:
    """Folds by cell and tumbling window, closed on the right: (start, end], as lead buckets are.

    Windows are closed on the left, so they are taken of times one microsecond earlier. Rows later than ``late`` are
    dropped; a window is final when the watermark passes it.
    """
    unknown = [op for _, op, _ in folds if op not in FOLDS or op == "median"]
    if unknown:
        raise KeyError(f"no such operation on streams: {', '.join(unknown)}")
    ts = F.col(time).cast("timestamp") - F.expr("INTERVAL 1 MICROSECOND")
    placed = stream.withColumn("__ts", ts).withWatermark("__ts", late)
    grouped = placed.groupBy(F.window("__ts", duration).alias("w"), *keys)
    folded = grouped.agg(*[FOLDS[op](F.col(v)).alias(out) for v, op, out in folds])
    return folded.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, *[out for _, _, out in folds])


def read_stream(spark, path: str, schema, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader).parquet(path)


def write_stream(df: DataFrame, path: str, checkpoint: str, mode: str = "append"):
    """A query that writes all that is there and stops; started again it goes on where it stopped."""
    return df.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start(path)
