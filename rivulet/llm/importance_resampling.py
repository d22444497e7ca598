"""Importance resampling towards a target: documents drawn by how much more likely the target's n-grams make them.

Features of a text are its runs of 1 to LONGEST words; a feature's bucket is its CRC-32 modulo BUCKETS. The rates of the
buckets in the target and in the corpus give each bucket a gain, a document's weight is the sum over its features, and
Gumbel noise from a hash of its id turns the highest scores into a sample without replacement.

Method, in tasks, on blocks of at most BLOCK_WORDS words (or one longer document):

1. Words become ids, and the block's suffixes are sorted by them, as deep as the longest feature goes and
   never across the end of a document: a suffix array cut at LONGEST words.
2. Neighbours' common prefixes, cut alike, give runs: all suffixes of a run begin with the same n-gram. Each run's n-gram is
   hashed once, from the CRCs of its words: that of a text and a word behind it is a linear map of the first one's, which
   tables hold by the word's length, and the second one's.
3. For the corpus' counts a run adds its length to its bucket. For scores the run's bucket goes back to the places of its
   suffixes, and gains are summed by document.

Texts are read twice, once to count and once to score, and never shuffled: keeping all bucket ids for the second pass would
write more than the corpus itself. What meets is one row a bucket and task, then BUCKETS gains. Ranks: scores are dealt by
ranges, ranges are counted, and only those that hold drawn documents are ordered within themselves.

Edge cases: null and empty texts have no words, no features, weight 0 and the score of their noise; they are never drawn if
``least_words`` is positive. A null doc_id hashes like an empty one and ranks behind its ties. Repeated rows count once each,
and get ranks one after the other. An empty corpus gives an empty result; an empty target leaves gains that only differ
by the corpus' counts. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rivulet.llm.common import bounded_batches, fresh, settle

BUCKETS = 10_000
LONGEST = 3  # words of a feature
BLOCK_WORDS = 1 << 19
BITS = 21  # of a word's id in a suffix' key
KNOWN_WORDS = 1 << 20  # a task forgets its words when it knows more
RANGE_ROWS = 200_000  # scores in a range, about

#: Letters in lower case and digits stay, and so does all that is not ASCII; the rest divides words.
TO_WORDS = bytes(b if chr(b).isdigit() or chr(b).islower() or b >= 128 else b + 32 if chr(b).isupper() else 32 for b in range(128)) + bytes(range(128, 256))


@lru_cache(maxsize=1)
def _shifts() -> list[np.ndarray]:
    """Tables that append zero bytes to a CRC, one for each of its four bytes: of 0 to 63 bytes first, then of 64, 128, ..."""
    one = np.array([zlib.crc32(bytes([v]), 0xFFFFFFFF) ^ 0xFF000000 for v in range(256)], np.uint32)
    zero = lambda c: (c >> np.uint32(8)) ^ one[c & np.uint32(255)]
    low = np.zeros((64, 4, 256), np.uint32)
    low[0] = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for n in range(1, 64):
        low[n] = zero(low[n - 1])
    tables = [low]
    double = lambda t: _through(t[None], np.zeros(t.shape, np.int64), t)
    at = zero(low[63])
    for _ in range(26):
        tables.append(at[None])
        at = double(at)
    return tables


def _through(tables: np.ndarray, which: np.ndarray, crc: np.ndarray) -> np.ndarray:
    byte = lambda k: (crc >> np.uint32(8 * k)) & np.uint32(255)
    return tables[which, 0, byte(0)] ^ tables[which, 1, byte(1)] ^ tables[which, 2, byte(2)] ^ tables[which, 3, byte(3)]


def joined_crc(first: np.ndarray, second: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRCs of texts made of a first and a second part, from those of the parts and the second parts' lengths in bytes."""
    tables = _shifts()
    out = _through(tables[0], length & 63, first)
    more = length >> 6
    bit = 1
    while more.any():
        odd = np.flatnonzero(more & 1)
        out[odd] = _through(tables[bit], np.zeros(len(odd), np.int64), out[odd])
        more = more >> 1
        bit += 1
    return out ^ second


class Vocabulary(dict):
    """Word ids of a task, from 1; a word that is looked up first gets the next one."""

    def __init__(self) -> None:
        super().__init__()
        self.crc = self.spaced = np.zeros(1, np.uint32)
        self.length = np.zeros(1, np.int64)

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self) + 1
        return n

    def hash(self) -> None:
        """CRCs of the words, of the words with a space behind, and lengths, by id."""
        new = list(islice(self, len(self.crc) - 1, None))
        crc = np.fromiter(map(zlib.crc32, new), np.uint32, len(new))
        self.crc = np.r_[self.crc, crc]
        space = np.full(len(new), zlib.crc32(b" "), np.uint32)
        self.spaced = np.r_[self.spaced, joined_crc(crc, space, np.ones(len(new), np.int64))]
        self.length = np.r_[self.length, np.fromiter(map(len, new), np.int64, len(new))]


class Suffixes:
    """The suffix array of a block of documents, as deep as features go, and its runs."""

    def __init__(self, docs: list[list[bytes]], vocabulary: Vocabulary, longest: int = LONGEST):
        self.sizes = np.array([len(d) for d in docs], np.int64)
        n = int(self.sizes.sum())
        ids = np.zeros(n + longest, np.int64)
        ids[:n] = np.fromiter(map(vocabulary.__getitem__, chain.from_iterable(docs)), np.int64, n)
        if len(vocabulary) >= 1 << BITS:
            raise ValueError("more different words in one block than a key holds")
        left = np.repeat(np.cumsum(self.sizes), self.sizes) - np.arange(n)
        key = np.zeros(n, np.int64)
        for k in range(longest):
            key = key << BITS | np.where(left > k, ids[k : n + k], 0)
        self.order = np.argsort(key)
        self.key = key[self.order]
        self.longest = longest
        vocabulary.hash()
        self.crc, self.spaced, self.length = vocabulary.crc, vocabulary.spaced, vocabulary.length

    def runs(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For features of 1, 2, ... words: the run of each suffix that has one, which suffixes these are (by their order), and the runs' buckets' CRCs."""
        before: np.ndarray | None = None
        mask = (1 << BITS) - 1
        for depth in range(1, self.longest + 1):
            prefix = self.key >> (BITS * (self.longest - depth))
            whole = np.flatnonzero(prefix & mask)
            prefix = prefix[whole]
            new = np.r_[True, prefix[1:] != prefix[:-1]] if len(prefix) else np.zeros(0, bool)
            run = np.cumsum(new) - 1
            first = prefix[new]
            last = first & mask
            if depth == 1:
                crc = self.crc[last]
                spaced = self.spaced[last]
            else:
                # The run of the shorter n-gram that all suffixes of this run are in, and its CRC with a space behind.
                shorter = before[whole[new]]
                crc = joined_crc(spaced[shorter], self.crc[last], self.length[last])
                spaced = joined_crc(spaced[shorter], self.spaced[last], self.length[last] + 1) if depth < self.longest else spaced
            before = np.full(len(self.key), -1, np.int64)
            before[whole] = run
            yield run, whole, crc


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int | None], list[list[bytes]]]]:
    ids: list[int | None] = []
    docs: list[list[bytes]] = []
    held = 0
    for batch in batches:
        texts = batch.column(1).cast(pa.large_binary())
        for k, doc_id in enumerate(batch.column(0).to_pylist()):
            words = (texts[k].as_py() or b"").translate(TO_WORDS).split()
            ids.append(doc_id)
            docs.append(words)
            held += len(words)
            if held >= BLOCK_WORDS:
                yield ids, docs
                ids, docs, held = [], [], 0
    if docs:
        yield ids, docs


def _arrays(docs: list[list[bytes]], longest: int, known: list[Vocabulary]) -> Suffixes:
    """The block's suffix array; ``known`` keeps the task's words for the next one."""
    if not known or len(known[0]) > KNOWN_WORDS:
        known[:] = [Vocabulary()]
    return Suffixes(docs, known[0], longest)


def _counted(buckets: int, longest: int):
    """A task's features by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        known: list[Vocabulary] = []
        for _, docs in _blocks(batches):
            for runs, _, crc in _arrays(docs, longest, known).runs():
                total += np.bincount(crc % np.uint32(buckets), np.bincount(runs, minlength=len(crc)), buckets).astype(np.int64)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["bucket", "n"])

    return run


def _noise(doc_id: int | None, seed: int) -> int:
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _weighed(gains: np.ndarray, longest: int, seed: int):
    """For each document its number of words and features, its weight and its score."""
    buckets = np.uint32(len(gains))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: list[Vocabulary] = []
        for ids, docs in _blocks(batches):
            suffixes = _arrays(docs, longest, known)
            n = int(suffixes.sizes.sum())
            at_place = np.zeros(n, np.int64)
            for runs, whole, crc in suffixes.runs():
                at_place[suffixes.order[whole]] += gains[crc % buckets][runs]
            sums = np.r_[0, np.cumsum(at_place)]
            ends = np.cumsum(suffixes.sizes)
            weight = sums[ends] - sums[ends - suffixes.sizes]
            features = sum(np.maximum(suffixes.sizes - k, 0) for k in range(longest))
            score = weight + np.array([_noise(x, seed) for x in ids], np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *map(pa.array, (suffixes.sizes, features, weight, score))], names=["doc_id", "n_words", "n_features", "weight", "score"])

    return run


def feature_counts(texts: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST) -> DataFrame:
    """(bucket, n): the features of all rows of ``text`` by bucket; buckets without any have no row."""
    bounded_batches(texts.sparkSession)
    read = texts.select(F.lit(None).cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    return read.mapInArrow(_counted(buckets, longest), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST) -> np.ndarray:
    """Each bucket's gain in thousandths: the smoothed log ratio of its rates in the target and in the corpus.

    ``buckets`` numbers come to the driver for each of both tables.
    """
    counts = []
    for table in (docs, target):
        n = [0] * buckets
        for r in feature_counts(table, buckets, longest).collect():
            n[r.bucket] = r.n
        counts.append(n)
    (s, t), (all_s, all_t) = counts, map(sum, counts)
    ratio = [((t[b] + 1) * (all_s + buckets)) / ((s[b] + 1) * (all_t + buckets)) for b in range(buckets)]
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], np.int64)


def weigh(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST, seed: int = 42) -> DataFrame:
    """One row a document: doc_id, n_words, n_features, weight and score."""
    bounded_batches(docs.sparkSession)
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return read.mapInArrow(_weighed(gains(docs, target, buckets, longest), longest, seed), "doc_id long, n_words long, n_features long, weight long, score long")


def draw(weighed: DataFrame, percent: int = 5, least_words: int = 20) -> DataFrame:
    """The rows of ``weigh`` with ``rank``: 1, 2, ... by falling score (ties: smaller doc_id) for the drawn share of all
    documents with at least ``least_words`` words, null for the others."""
    rows = settle(weighed)
    may = F.col("n_words") >= least_words
    n = rows.where(may).count()
    wanted = percent * n // 100
    by = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    # Which range a row is in must not change when an executor is lost, so ranges are settled.
    dealt = settle(rows.where(may).repartitionByRange(max(1, n // RANGE_ROWS, min(n // 1000, 64)), *by).withColumn("range", F.spark_partition_id()))
    # One row a range; a window over these few rows.
    ranges = dealt.groupBy("range").agg(F.count(F.lit(1)).alias("size"))
    ranges = ranges.withColumn("before", F.sum("size").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1))).fillna(0, ["before"])
    first = ranges.where(F.col("before") < wanted).select("range", "before")
    within = Window.partitionBy("range").orderBy(*by, "n_features", "n_words")
    place = F.row_number().over(within).cast("long") + F.col("before")
    top = dealt.join(first, "range").withColumn("rank", place)
    columns = [*rows.columns, "rank"]
    unranked = lambda df: df.withColumn("rank", F.lit(None).cast("long")).select(columns)
    top = top.withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank"))).select(columns)
    return top.unionByName(unranked(dealt.join(first, "range", "left_anti"))).unionByName(unranked(rows.where(~may)))


def importance_report(docs: DataFrame, target: DataFrame) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every document."""
    return draw(weigh(docs, target)).select("doc_id", "n_features", "weight", "score", "rank")


def resample(docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20) -> DataFrame:
    """The drawn documents, with all their columns. Rows that share a doc_id are drawn together if one of them is."""
    drawn = draw(weigh(docs, target), percent, least_words).where("rank is not null")
    key = fresh(docs, "drawn_id")
    drawn = drawn.select(F.col("doc_id").alias(key)).distinct()
    return docs.join(drawn, F.col("doc_id").cast("long").eqNullSafe(F.col(key)), "left_semi")
