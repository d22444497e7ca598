"""Nearest values and places where coordinates are uneven: a sorted as-of join along an axis, growing cells in the plane.

Neither compares all with all. Equal coordinates are looked up once, so that a value that many rows share is one lookup.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.sources.sinks import scratch_folder

GROWTH = 4  # of the cells from level to level
BUCKETS = 256  # ranges along an axis, at most
CLOSING_CELLS = 1024  # of one size that a place looks through once it has a bound, at most
CELL_SOURCES = 64  # distinct places in a cell of the first level, at most (unless cells get too small to tell places apart)


def _bucket(value: Column, bounds: list[float]) -> Column:
    """How many of the sorted bounds are at most the value: a balanced tree of comparisons."""

    def tree(a: int, b: int) -> Column:
        if a == b:
            return F.lit(a)
        m = (a + b) // 2
        return F.when(value < F.lit(bounds[m]), tree(a, m)).otherwise(tree(m + 1, b))

    return tree(0, len(bounds))


def nearest_on_axis(df: DataFrame, axis: DataFrame, column: str, coordinate: str, into: str = "nearest") -> DataFrame:
    """Adds to each row the axis' value nearest to its own, ties to the smaller; null where either has none.

    Both sides' distinct values are dealt by ranges of about equal size, whose bounds are at most BUCKETS numbers. Within a
    range the last axis value at or before, and the first one after, are windows; what a range lacks comes from a table of
    the ranges' first and last values.
    """
    values = df.select(F.col(column).cast("double").alias("v")).where("v is not null and not isnan(v)").distinct()
    points = axis.select(F.col(coordinate).cast("double").alias("v")).where("v is not null and not isnan(v)").distinct()
    both = values.select("v", F.lit(None).cast("double").alias("a"), F.lit(True).alias("asked")).unionByName(points.select("v", F.col("v").alias("a"), F.lit(False).alias("asked")))
    n = both.sparkSession.conf.get("spark.sql.shuffle.partitions")
    parts = max(1, min(BUCKETS, int(n)))
    bounds = sorted(set(both.approxQuantile("v", [k / parts for k in range(1, parts)], 0.2 / parts))) if parts > 1 else []
    both = both.withColumn("bucket", _bucket(F.col("v"), bounds))
    ends = both.groupBy("bucket").agg(F.min("a").alias("first"), F.max("a").alias("last"))
    order = Window.orderBy("bucket")  # one row a range
    before = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1)).alias("before")
    after = F.min("first").over(order.rowsBetween(1, Window.unboundedFollowing)).alias("after")
    ends = ends.select("bucket", before, after)
    within = Window.partitionBy("bucket").orderBy("v", F.col("asked").asc())
    low = F.last("a", ignorenulls=True).over(within.rowsBetween(Window.unboundedPreceding, 0))
    high = F.first("a", ignorenulls=True).over(within.rowsBetween(0, Window.unboundedFollowing))
    found = both.select("bucket", "v", "asked", low.alias("low"), high.alias("high")).where("asked").join(ends, "bucket")
    low, high = F.coalesce("low", "before"), F.coalesce("high", "after")
    best = F.when(high.isNull() | (F.col("v") - low <= high - F.col("v")), low).otherwise(high)
    key = "__v"
    found = found.select(F.col("v").alias(key), F.coalesce(best, high).alias(into))
    return df.join(found, F.col(column).cast("double") == F.col(key), "left").drop(key)


def nearest_places(df: DataFrame, sources: DataFrame, at: tuple[str, str], of: tuple[str, str], id_: str, into: str = "nearest", distance: str | None = None) -> DataFrame:
    """Adds to each row the id of the source nearest in the plane, ties to the smaller id; null where a coordinate is missing.

    A place looks in its cell and the eight around it, first in cells so small that none holds more than CELL_SOURCES sources;
    places outside the sources' box look from the box's nearest point. The nearest source met there is a bound, and whatever is
    as near lies in the part of the box that the bound's circle covers. If that is CLOSING_CELLS cells at most, they say which
    source is nearest. Places without a bound, or with too many cells, go on with cells GROWTH times as large, fewer each
    time; each level is written to the shared folder, and stays there for the result to read.
    """
    x, y = (F.col(c).cast("double") for c in of)
    points = sources.select(x.alias("sx"), y.alias("sy"), F.col(id_).alias("id")).where("sx is not null and sy is not null and not isnan(sx) and not isnan(sy)")
    points = points.groupBy("sx", "sy").agg(F.min("id").alias("id"))
    box = points.agg(F.min("sx").alias("x0"), F.max("sx").alias("x1"), F.min("sy").alias("y0"), F.max("sy").alias("y1"), F.count(F.lit(1)).alias("n")).first()
    qx, qy = (F.col(c).cast("double") for c in at)
    asked = df.select(qx.alias("qx"), qy.alias("qy")).where("qx is not null and qy is not null and not isnan(qx) and not isnan(qy)").distinct()
    key = ["__qx", "__qy"]
    wanted = [F.col(key[0]), F.col(key[1]), F.col("id").alias(into)] + ([F.sqrt("d2").alias(distance)] if distance else [])
    on = (qx == F.col(key[0])) & (qy == F.col(key[1]))
    if not box["n"]:
        none = {into: F.lit(None).cast(sources.schema[id_].dataType)} | ({distance: F.lit(None).cast("double")} if distance else {})
        return df.withColumns(none)
    extent = max(box["x1"] - box["x0"], box["y1"] - box["y0"]) or 1.0
    cell = lambda c, low, size: F.floor((c - F.lit(low)) / F.lit(size)).cast("long")
    size = extent / max(1.0, box["n"] ** 0.5)
    while size > extent * 2.0**-40:
        most = points.groupBy(cell(F.col("sx"), box["x0"], size), cell(F.col("sy"), box["y0"], size)).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
        if most <= CELL_SOURCES:
            break
        size /= 2
    # The nearest point of the box.
    cx = F.greatest(F.lit(box["x0"]), F.least(F.lit(box["x1"]), F.col("qx")))
    cy = F.greatest(F.lit(box["y0"]), F.least(F.lit(box["y1"]), F.col("qy")))
    open_ = asked.select("qx", "qy", cx.alias("cx"), cy.alias("cy"))
    done: DataFrame | None = None
    folder, level = scratch_folder(df.sparkSession), 0
    while True:
        last = size >= extent  # nine such cells hold all sources
        here = open_.withColumns({"bx": cell(F.col("cx"), box["x0"], size), "by": cell(F.col("cy"), box["y0"], size)})
        steps = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (-1, 0, 1) for b in (-1, 0, 1)])
        near = here.withColumn("s", F.explode(steps)).select("qx", "qy", "cx", "cy", (F.col("bx") + F.col("s.a")).alias("kx"), (F.col("by") + F.col("s.b")).alias("ky"))
        placed = points.select("sx", "sy", "id", cell(F.col("sx"), box["x0"], size).alias("kx"), cell(F.col("sy"), box["y0"], size).alias("ky"))
        d2 = (F.col("qx") - F.col("sx")) * (F.col("qx") - F.col("sx")) + (F.col("qy") - F.col("sy")) * (F.col("qy") - F.col("sy"))
        met = near.join(placed, ["kx", "ky"], "left").withColumn("d2", d2)
        # A number's minimum is kept in a hash table; pairs are neither sorted nor held.
        bound = met.groupBy("qx", "qy", "cx", "cy").agg(F.min("d2").alias("bound"))
        level += 1
        # Written, not only kept in memory: the next level begins from rows, not from all levels' plans.
        bound.write.parquet(f"{folder}/{level}")
        bound = df.sparkSession.read.parquet(f"{folder}/{level}")
        # Sources within the bound lie in the box and in the circle: a strip, where the place is outside. One more cell each way for rounding.
        far = F.col("bound") * (1 + 1e-9)
        wide = F.sqrt(F.greatest(F.lit(0.0), far - (F.col("qy") - F.col("cy")) ** 2))
        high = F.sqrt(F.greatest(F.lit(0.0), far - (F.col("qx") - F.col("cx")) ** 2))
        ranges = {"a0": cell(F.greatest(F.lit(box["x0"]), F.col("qx") - wide), box["x0"], size) - 1, "a1": cell(F.least(F.lit(box["x1"]), F.col("qx") + wide), box["x0"], size) + 1}
        ranges |= {"b0": cell(F.greatest(F.lit(box["y0"]), F.col("qy") - high), box["y0"], size) - 1, "b1": cell(F.least(F.lit(box["y1"]), F.col("qy") + high), box["y0"], size) + 1}
        bound = bound.withColumns(ranges)
        few = (F.col("a1") - F.col("a0") + 1).cast("double") * (F.col("b1") - F.col("b0") + 1).cast("double") <= CLOSING_CELLS
        closing = F.lit(True) if last else F.coalesce(F.col("bound").isNotNull() & (F.col("bound") < float("inf")) & few, F.lit(False))
        strip = bound.where(closing).select("qx", "qy", "bound", F.explode(F.sequence("a0", "a1")).alias("kx"), "b0", "b1").withColumn("ky", F.explode(F.sequence("b0", "b1"))).drop("b0", "b1")
        ties = strip.join(placed, ["kx", "ky"]).withColumn("d2", d2).where("d2 <= bound")
        found = ties.groupBy(F.col("qx").alias(key[0]), F.col("qy").alias(key[1])).agg(F.min(F.struct("d2", "id")).alias("r")).select(*key, "r.d2", "r.id")
        found.write.parquet(f"{folder}/{level}-found")
        found = df.sparkSession.read.parquet(f"{folder}/{level}-found")
        done = found if done is None else done.unionByName(found)
        if last:
            break
        open_ = bound.where(~closing).select("qx", "qy", "cx", "cy")
        if open_.isEmpty():
            break
        size *= GROWTH
    return df.join(done.select(*wanted), on, "left").drop(*key)
