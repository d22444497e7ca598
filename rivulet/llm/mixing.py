"""Mixing sources to target weights in DataFrame functions only: a low-discrepancy schedule of equal-token blocks.

Each source's documents are shuffled by a hash and laid on a tape, at most ``most`` laps of it. The tape is cut at the
source's target, to the nearest word, and into blocks of ``block`` tokens, whatever the corpus, of which the last may be
shorter: a source below a block has one short block. A schedule has one slot a block of the whole mix. The points i * phi mod 1 (golden
ratio, in 32-bit whole numbers) of the slots i, ranked, are dealt to the sources in order, to each as many as it has
blocks. The r-th slot of a source takes its r-th block, so any stretch of the schedule has the sources near their shares.

Targets: a source's share of all tokens by its weight, stopped at ``most`` times its size, the excess shared again by
weight until none is above. Prefix sums are dealt by (source, hash bucket), so no task holds a whole source.

Edge cases: null text has size 0; texts without words get nothing; a null source is a source of its own, the last one;
repeated rows are taken each on its own, and rows with a null id like any others; an empty table, or one without words,
gives targets and takings of 0; extra columns are ignored, and ``resample`` keeps them, whatever their names. There,
rows that repeat an id share what they take. On its source's tape each document lies whole, lap by lap, but for the
one at the cut, so rounding to whole documents moves a source by half a document at most.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.llm.common import fresh, running_sum, settle

WEIGHTS = (5, 2, 1)
MOST = 3
BLOCK_TOKENS = 1 << 12
PHI32 = 2654435769  # 2**32 divided by the golden ratio: a fixed value
CELL = 1 << 10


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, sid, source_size, weight, target) from rows of (source, size); one row a source."""
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.col("sid") % len(weights)).cast("int") + 1)
    s = by_source.withColumn("sid", number.cast("int")).withColumn("weight", w).withColumn("cap", F.col("source_size") * most)
    s = s.withColumn("at", F.col("cap") / F.col("weight"))
    order = Window.orderBy("at", "sid")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    s = s.withColumn("level", left / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))))
    s = s.withColumn("level", F.min(F.when(F.col("level") <= F.col("at"), F.struct("at", "sid", "level"))).over(whole)["level"])
    target = F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight"))
    return s.select("source", "sid", "source_size", "weight", target.alias("target"))


def sized(docs: DataFrame) -> DataFrame:
    return settle(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), words(F.col("text").cast("string")).alias("size")))


def mix(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: int = 17, block: int = BLOCK_TOKENS) -> tuple[DataFrame, DataFrame]:
    """(targets, pieces) for rows of (doc_id, source, size).

    A piece is a run of a document's words in a slot: slot, sid, doc_id, size, begin (of the document on its source's
    tape, which tells repeated rows apart), start (word in the document), length. Ordered by slot it is the mix.
    """
    targets = settle(source_targets(sizes, weights, most))
    quotas = targets.withColumn("words", F.round("target").cast("long")).where("words > 0")
    quotas = quotas.withColumn("blocks", F.floor((F.col("words") + block - 1) / block))
    slots = quotas.agg(F.coalesce(F.sum("blocks"), F.lit(0)).alias("n")).first()["n"]

    cumulative = Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, 0)
    ranges = quotas.withColumn("hi", F.sum("blocks").over(cumulative)).withColumn("lo", F.col("hi") - F.col("blocks"))
    ranges = ranges.select("sid", "lo", "hi", F.explode(F.sequence(F.floor(F.col("lo") / CELL), F.floor((F.col("hi") - 1) / CELL))).alias("cell"))

    # Beyond 2**31 slots the points repeat, in slot order.
    point = (F.col("id") % F.lit(1 << 31) * F.lit(PHI32)) % F.lit(1 << 32)
    points = sizes.sparkSession.range(slots).select(F.col("id").alias("slot"), point.alias("point"), F.lit(1).alias("one"))
    points = running_sum(points, [], ["point", "slot"], "one", "rank", F.floor(F.col("point") / (1 << 23)))
    points = points.withColumn("cell", F.floor(F.col("rank") / CELL))
    schedule = points.join(ranges, "cell").where("rank >= lo and rank < hi").select("sid", "slot", "one")
    schedule = running_sum(schedule, ["sid"], ["slot"], "one", "block", F.floor(F.col("slot") / max(1, -(-slots // 512))))

    own = sizes.alias("d").join(quotas.alias("t"), F.col("d.source").eqNullSafe(F.col("t.source"))).where("d.size > 0")
    own = own.select("t.sid", "t.source_size", "t.words", "d.doc_id", "d.size", F.xxhash64(F.lit(seed), "d.doc_id").alias("h"))
    own = running_sum(own, ["sid"], ["h", "doc_id", "size"], "size", "begin", F.pmod("h", F.lit(512)))
    laps = own.select("*", F.explode(F.sequence(F.lit(0), F.lit(most - 1))).alias("lap"))
    laps = laps.withColumn("a", F.col("begin") + F.col("lap") * F.col("source_size")).where("a < words")
    laps = laps.withColumn("b", F.least(F.col("a") + F.col("size"), F.col("words")))
    cut = laps.select("*", F.explode(F.sequence(F.floor(F.col("a") / block), F.floor((F.col("b") - 1) / block))).alias("block"))
    start = F.greatest(F.col("a"), F.col("block") * block)
    cut = cut.select("sid", "block", "doc_id", "size", "begin", (start - F.col("a")).alias("start"), (F.least(F.col("b"), (F.col("block") + 1) * block) - start).alias("length"))
    pieces = cut.join(schedule.select("sid", "block", "slot"), ["sid", "block"]).select("slot", "sid", "doc_id", "size", "begin", "start", "length")
    return targets, pieces


def taken(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """One row a document: doc_id, size, source, source_size, target of its source, taken (words, repeats counted)."""
    sizes = sized(docs)
    targets, pieces = mix(sizes, weights, most)
    used = pieces.groupBy("sid", "begin", "doc_id", "size").agg(F.sum("length").alias("taken"))
    # Rows that share id and size are interchangeable: the k-th of them gets the k-th place on the tape.
    used = used.withColumn("copy", F.row_number().over(Window.partitionBy("sid", "doc_id", "size").orderBy("begin"))).drop("begin")
    rows = sizes.withColumn("copy", F.row_number().over(Window.partitionBy("source", "doc_id", "size").orderBy(F.lit(1))))
    rows = rows.alias("d").join(targets.alias("t"), F.col("d.source").eqNullSafe(F.col("t.source"))).select("d.*", "t.sid", "t.source_size", "t.target")
    same = [F.col(f"d.{c}").eqNullSafe(F.col(f"u.{c}")) for c in ("sid", "doc_id", "size", "copy")]
    joined = rows.alias("d").join(used.alias("u"), reduce(lambda a, b: a & b, same), "left")
    return joined.select("d.doc_id", "d.size", "source", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def resample(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """The mix in whole documents: each row as often as its taken words fill it, to the nearest number; same columns."""
    copies, lap = fresh(docs, "copies"), fresh(docs, "lap")
    times = F.round(F.sum("taken") / F.greatest(F.sum("size"), F.lit(1))).cast("int")
    t = taken(docs, weights, most).groupBy("doc_id").agg(times.alias(copies)).where(F.col(copies) > 0).alias("t")
    kept = docs.alias("d").join(t, F.col("d.doc_id").eqNullSafe(F.col("t.doc_id")))
    columns = [F.col(f"d.`{c}`") for c in docs.columns]
    return kept.select(*columns, F.explode(F.sequence(F.lit(1), F.col(f"t.{copies}"))).alias(lap)).drop(lap)
