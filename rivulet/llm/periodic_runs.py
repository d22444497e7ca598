"""Periodic runs: stretches of words that repeat with a period, found exactly, and texts with the repeats taken out.

A run is a stretch of consecutive words with smallest period q (words q apart are equal), at least ``LEAST_EXPONENT``
periods and ``LEAST_WORDS`` words long, that no neighbouring word extends keeping the period.

Method, on the word ids of many documents at once (numpy on a block of bounded size, in tasks):

1. Suffixes are sorted by prefix doubling. A name says of a place which group of equal words starts there, for 1, 2, 4,
   ... words; names of different documents differ, so suffixes of one document are compared only. Only tied places are
   sorted again. Two suffixes a period apart agree on ``LEAST_COMMON`` words in any run, so documents without such a tie
   have no run and are done after three rounds.
2. Neighbours in the suffix array get their longest common prefix from the names. Nearest smaller places on both sides
   with the least common prefix on the way give the longest previous factor (LPF) of each place and where it was.
3. LPF cuts each document into Lempel-Ziv blocks: each is the longest that began before, or one new word.
4. Boundary extensions after Main: around the boundary of two blocks, each period up to the length of the block to the
   right, and up to half of that to the left, is extended in both directions; all at once, by names. With four periods
   or more that finds every run that is not strictly inside a block: after a run's first period each block that starts
   inside it reaches to its end, so the boundary is followed by a block, or preceded by one, that is long enough.
5. A run strictly inside a block is a copy of one in the block's earlier place. Starts are kept in order, blocks go
   from left to right, and each block copies the runs that lie strictly inside its source, its own copies included.

Memory: about 100 bytes times the logarithm of the longest document for each word of a block; a block has BLOCK_WORDS
words, or one longer document. Nothing is shuffled, so a lost executor costs its tasks only.

Edge cases: null text is empty: no words, no runs, collapsed to the empty text; texts shorter than a run have none; repeated
rows, also of one doc_id, are each a document; a null doc_id stays null; an empty table gives an empty result; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import bounded_batches

LEAST_EXPONENT = 4
LEAST_WORDS = 6
LEAST_COMMON = 4  # words that places one period apart share in any run, at least (5, for period 1)
BLOCK_WORDS = 1 << 19
SPACE = r"[\x20\x09-\x0D]+"

RUN = "array<struct<start:long,length:long,period:long>>"


class Names:
    """Names of the words at each place, of the next 2, 4, ... words; equal names say equal words of one document.

    Names are ranks, so the last level is the inverse of the suffix array.
    """

    def __init__(self, ids: np.ndarray, sizes: np.ndarray):
        self.n = n = len(ids)
        self.sizes = sizes
        self.ends = np.cumsum(sizes)
        self.doc = np.repeat(np.arange(len(sizes)), sizes)
        key = self.doc * (int(ids.max(initial=0)) + 1) + ids
        order = np.argsort(key)
        rank = np.empty(n + 1, np.int32)
        rank[n] = -1  # behind the last document; equal to no name
        self.tied, self.places = self._name(key[order], order, np.arange(n), rank)
        self.levels = [rank]
        self.reach = 1

    @staticmethod
    def _name(key: np.ndarray, places: np.ndarray, slots: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Names sorted places by the slot of the first of their group; returns slots and places of those that are tied."""
        new = np.r_[True, key[1:] != key[:-1]] if len(key) else np.zeros(0, bool)
        rank[places] = slots[new][np.cumsum(new) - 1]
        tied = ~(new & np.r_[new[1:], True]) if len(key) else new
        return slots[tied], places[tied]

    def double(self) -> None:
        last = self.levels[-1]
        p = self.places
        q = p + self.reach
        further = np.where(q < self.ends[self.doc[p]], last[np.minimum(q, self.n)].astype(np.int64) + 1, 0)  # a document's end comes first
        key = last[p] * np.int64(self.n + 2) + further
        order = np.argsort(key)
        rank = last.copy()
        self.tied, self.places = self._name(key[order], p[order], self.tied, rank)
        self.levels.append(rank)
        self.reach *= 2

    def forward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words agree from a and from b on (a < b, of one document; b may be its end)."""
        off = np.zeros(len(a), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            level = self.levels[k]
            off += (level[a + off] == level[b + off]).astype(np.int64) << k
        return off

    def backward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words agree up to a and up to b, these included (a < b; a may be the place before the document)."""
        off = np.zeros(len(a), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            level = self.levels[k]
            i = a - off - (1 << k) + 1
            same = (i >= 0) & (level[np.maximum(i, 0)] == level[np.maximum(b - off - (1 << k) + 1, 0)])
            off += same.astype(np.int64) << k
        return off


def _nearest(places: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry of a suffix array the nearest one before it that starts earlier in the text, and their common prefix.

    ``common``: with the entry before. Entries jump over what is known to start later, all at once; those whose common
    prefix falls to nothing stop.
    """
    at = np.arange(len(places)) - 1
    least = common.copy()
    open_ = np.flatnonzero((least > 0) & (places[np.maximum(at, 0)] > places))
    while len(open_):
        over = at[open_]
        least[open_] = np.minimum(least[open_], least[over])
        at[open_] = at[over]
        open_ = open_[least[open_] > 0]
        open_ = open_[places[at[open_]] > places[open_]]
    return at, least


def previous_factors(names: Names) -> tuple[np.ndarray, np.ndarray]:
    """LPF of each place, and an earlier place where so many words began."""
    n = names.n
    order = np.empty(n, np.int64)
    order[names.levels[-1][:n]] = np.arange(n)
    common = np.zeros(n, np.int64)
    same = np.flatnonzero(names.doc[order[1:]] == names.doc[order[:-1]])
    a, b = order[same], order[same + 1]
    common[same + 1] = names.forward(np.minimum(a, b), np.maximum(a, b))
    before, common_before = _nearest(order, common)
    after, common_after = _nearest(order[::-1].copy(), np.r_[common[1:], 0][::-1].copy())
    after, common_after = (n - 1 - after)[::-1], common_after[::-1]
    left = common_before >= common_after
    lpf, source = np.zeros(n, np.int64), np.full(n, -1, np.int64)
    lpf[order] = np.where(left, common_before, common_after)
    source[order] = order[np.clip(np.where(left, before, after), 0, n - 1)]
    return lpf, source


def factors(lpf: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the Lempel-Ziv blocks of all documents."""
    step = np.maximum(lpf, 1).tolist()
    starts: list[int] = []
    i = 0
    for end in np.cumsum(sizes).tolist():
        while i < end:
            starts.append(i)
            i += step[i]
    at = np.array(starts, np.int64)
    return at, np.diff(np.r_[at, len(lpf)])


def _spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, number from 1) for each of the counts."""
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, np.arange(1, len(owner) + 1) - np.repeat(np.cumsum(counts) - counts, counts)


def _extended(names: Names, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Stretches (start, end, period) around the places a < b, as far as they keep the period b - a in both directions."""
    p = b - a
    need = np.maximum((LEAST_EXPONENT - 1) * p, LEAST_WORDS - p)
    # Of the words that agree, at least two are on one side of the places.
    pair = names.levels[1]
    some = (pair[a] == pair[b]) | ((a >= 2) & (pair[np.maximum(a - 2, 0)] == pair[np.maximum(b - 2, 0)]))
    a, b, p, need = a[some], b[some], p[some], need[some]
    ahead, back = names.forward(a, b), names.backward(a - 1, b - 1)
    long = ahead + back >= need
    return np.stack([(a - back)[long], (b + ahead)[long], p[long]])


def _at_boundaries(names: Names, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Runs that are not strictly inside a block, each with its smallest period: (start, end, period) by start."""
    owner, p = _spread(size)
    right = _extended(names, at[owner], at[owner] + p)
    owner, p = _spread(size // 2)
    left = _extended(names, at[owner] + size[owner] - p, at[owner] + size[owner])
    both = np.concatenate([right, left], axis=1)
    both = both[:, np.lexsort((both[2], both[1], both[0]))]
    new = np.ones(both.shape[1], bool)
    new[1:] = (both[0, 1:] != both[0, :-1]) | (both[1, 1:] != both[1, :-1])
    return both[:, new]


def _copied(runs: list[tuple[int, int, int]], blocks: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """A document's runs with those that lie strictly inside a block; blocks are (start, length, source) from left to right."""
    known = set(runs)
    for at, size, source in blocks:
        k = bisect.bisect_right(runs, (source + 1,))
        while k < len(runs) and runs[k][0] < source + size:
            start, end, period = runs[k]
            if end < source + size:
                copy = (start + at - source, end + at - source, period)
                if copy not in known:
                    known.add(copy)
                    bisect.insort(runs, copy)
            k += 1
    return runs


def runs_of(ids: np.ndarray, sizes: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """For each document its runs as (start, length, period), by start, then period."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in range(len(sizes))]
    names = Names(ids, sizes)
    while names.reach < LEAST_COMMON and len(names.places):
        names.double()
    if not len(names.places):
        return out
    # Only documents with a tie of so many words go on.
    some = np.zeros(len(sizes), bool)
    some[names.doc[names.places]] = True
    if not some.all():
        ids = ids[some[names.doc]]
        names = Names(ids, sizes[some])
    while len(names.places) or names.reach < LEAST_COMMON:
        names.double()
    lpf, source = previous_factors(names)
    at, size = factors(lpf, names.sizes)
    found = _at_boundaries(names, at, size)
    begins = names.ends - names.sizes
    long = np.flatnonzero((size >= LEAST_WORDS + 2) & (lpf[at] > 0))
    owner = names.doc[at[long]]
    of_run = names.doc[found[0]]
    for mine, k in enumerate(np.flatnonzero(some).tolist()):
        a, b = np.searchsorted(of_run, [mine, mine + 1])
        if a == b:
            continue
        c, d = np.searchsorted(owner, [mine, mine + 1])
        blocks = long[c:d]
        runs = _copied(list(zip(*found[:, a:b].tolist(), strict=True)), list(zip(at[blocks].tolist(), size[blocks].tolist(), source[at[blocks]].tolist(), strict=True)))
        begin = int(begins[mine])
        out[k] = sorted((s - begin, e - s, q) for s, e, q in runs)
        out[k].sort(key=lambda r: (r[0], r[2]))
    return out


def _kept(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """Words that no run contains after its first period."""
    if not runs:
        return words
    inside = np.zeros(len(words) + 1, np.int64)
    start, length, period = np.array(runs).T
    np.add.at(inside, start + period, 1)
    np.add.at(inside, start + length, -1)
    return [words[k] for k in np.flatnonzero(np.cumsum(inside[:-1]) == 0).tolist()]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int | None], list[list[bytes]]]]:
    """Documents with their words, BLOCK_WORDS words at a time."""
    ids: list[int | None] = []
    docs: list[list[bytes]] = []
    held = 0
    for batch in batches:
        texts = batch.column(1).cast(pa.large_binary())
        for k, doc_id in enumerate(batch.column(0).to_pylist()):
            words = (texts[k].as_py() or b"").split()
            ids.append(doc_id)
            docs.append(words)
            held += len(words)
            if held >= BLOCK_WORDS:
                yield ids, docs
                ids, docs, held = [], [], 0
    if docs:
        yield ids, docs


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    for ids, docs in _blocks(batches):
        vocabulary: dict[bytes, int] = {}
        for words in docs:
            vocabulary.update(dict.fromkeys(words, 0))
        for k, w in enumerate(vocabulary):
            vocabulary[w] = k
        sizes = np.array([len(w) for w in docs], np.int64)
        number = np.fromiter((vocabulary[w] for words in docs for w in words), np.int64, int(sizes.sum()))
        runs = runs_of(number, sizes)
        kept = [b" ".join(_kept(words, r)) for words, r in zip(docs, runs, strict=True)]
        bounds = np.r_[0, np.cumsum([len(r) for r in runs])].astype(np.int32)
        flat = np.array([x for r in runs for x in r], np.int64).reshape(-1, 3)
        struct = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(flat[:, k])) for k in range(3)], fields=list(kind.value_type))
        # Words are whole pieces of valid UTF-8, so what is left of them is valid too.
        columns = [pa.array(ids, pa.int64()), pa.array(sizes), pa.ListArray.from_arrays(pa.array(bounds), struct, type=kind), pa.array(kept, pa.binary()).cast(pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "runs", "collapsed"])


def find_runs(docs: DataFrame) -> DataFrame:
    """One row a document: doc_id, n_words, runs (start, length and period in words, by start, then period) and the
    collapsed text: the words that no run contains after its first period, joined by one space."""
    bounded_batches(docs.sparkSession)
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return read.mapInArrow(_found, f"doc_id long, n_words long, runs {RUN}, collapsed string")


def collapse(docs: DataFrame) -> DataFrame:
    """(doc_id, text) without periodic repeats."""
    return find_runs(docs).select("doc_id", F.col("collapsed").alias("text"))


def rewritten(docs: DataFrame) -> DataFrame:
    """(doc_id, text): of documents with crc32(doc_id) % 10 = 0 the words from a on become periodic, as the query's contract says.

    A null doc_id is no number: its text stays.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)
    words = F.filter(F.split("text", SPACE), lambda w: w != "")
    n = F.size("w")
    a = F.col("g") % n
    p = 1 + F.floor((n - a) / (3 + F.col("g") % 8))
    word = lambda i: F.get("w", F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = out.withColumn("g", F.when(h % 10 == 0, g)).withColumn("w", F.when(F.col("g").isNotNull() & F.col("text").isNotNull(), words))
    out = out.withColumn("a", F.when(n > 0, a)).withColumn("p", F.when(n > 0, p))
    periodic = F.array_join(F.transform(F.sequence(F.lit(0), n - 1), word), " ")
    return out.select("doc_id", F.when(F.col("p").isNotNull(), periodic).otherwise(F.col("text")).alias("text"))


def _strongest(runs: Column) -> Column:
    """Of an array of runs the one with the greatest length / period, exactly; the first of equal ones."""
    better = lambda best, r: best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
    return F.reduce(runs, F.lit(None).cast("struct<start:long,length:long,period:long>"), lambda best, r: F.when(better(best, r), r).otherwise(best))


def run_report(docs: DataFrame) -> DataFrame:
    """Digests of the runs and of the collapsed text, and the strongest run, for each document of the rewritten table."""
    line = lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string"))
    found = find_runs(rewritten(docs)).withColumn("top", _strongest(F.col("runs")))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("top.start").alias("start"),
        F.col("top.length").alias("length"),
        F.col("top.period").alias("period"),
        F.floor(1000 * F.col("top.length") / F.col("top.period")).cast("long").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
