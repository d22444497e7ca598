"""Harmonic packing of tokenised documents into fixed-capacity sequences.

A document's ids are cut: full sequences first, then the largest powers of two down to ``grain``, then a tail shorter
than ``grain``. A piece of length n belongs to the reciprocal-capacity class k = capacity // n, and a bin of class k
takes exactly k pieces, so a worker fills bins of a class by counting alone. Workers number their own pieces within
each class; a prefix sum over the workers' class counts (a few numbers a worker) makes these numbers global, and bin
and place follow from division. Only the last bin of each class can be short. Its pieces, a number that depends on the
capacity alone, are fitted together at the end.

Cuts at powers of two fill the bins of these classes exactly; the tails' classes waste less than 1 / (k + 1) of a bin,
with k at least capacity / grain.

Edge cases: null text is empty; every document, empty ones too, has its end id, hence at least one piece; repeated rows
are packed each on its own; very long texts are cut like others; an empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rivulet.llm.common import settle, small_batches

CAPACITY = 2048
GRAIN = 64
END_ID = 1
CACHED_WORDS = 450_000
SIGNS = ".,;:!?"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordIds:
    """Ids of texts as bytes, by their white-space separated strings.

    The vocabulary's splitting never crosses white space, and parts letters from signs, so a text's ids are those of its
    strings one after the other, and those of a word with signs behind it are the word's and the signs'. Ids of strings
    met before are looked up; new words go through the library many at a time, and are told apart by their last ids,
    which mark the ends of words. A text that holds an added token of the vocabulary, such as <|endoftext|>, goes
    through the library as a whole, which gives the token's own id.

    Kept are two lots of ``CACHED_WORDS`` strings: when one is full it becomes the older, the older one goes, and what is
    met again moves over. So common words stay, rare ones leave, and memory has a bound.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallel unit
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.known: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}

    def _learn(self, parts: list[str]) -> None:
        """Ids of strings without white space."""
        known = self.known
        words = [p for p in parts if p.isalpha()]
        for k in range(0, len(words), 2000):
            some = words[k : k + 2000]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) == len(some):
                data, begin = ids.tobytes(), 0
                for p, end in zip(some, (4 * ends).tolist(), strict=True):
                    known[p] = data[begin:end]
                    begin = end
        rest = [p for p in parts if p not in known]
        for p, e in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False), strict=True):
            known[p] = np.array(e.ids, "<u4").tobytes()

    def _new(self, words: set[str]) -> set[str]:
        """Those of the strings that are not known; those of the older lot move over."""
        new = words.difference(self.known)
        out = new.difference(self.older)
        for w in new - out:
            self.known[w] = self.older[w]
        return out

    def _some(self, texts: list[str]) -> list[bytes]:
        split = [t.replace("\n", " ").split(" ") for t in texts]
        if len(self.known) > CACHED_WORDS:
            self.older, self.known = self.known, {"": b""}
        known = self.known
        apart: dict[str, tuple[str, str]] = {}
        for w in self._new(set().union(*split)):
            low = w.lower()
            core = low.rstrip(SIGNS)
            apart[w] = (core, low[len(core) :]) if core.isalpha() and "Σ" not in w and len(low) == len(w) else (w, "")
        if apart:
            self._learn(list(self._new({p for both in apart.values() for p in both})))
            for w, (core, signs) in apart.items():
                known[w] = known[core] + known[signs]
        return [b"".join(map(known.__getitem__, words)) for words in split]

    def __call__(self, texts: list[str]) -> list[bytes]:
        out = [ids for k in range(0, len(texts), 128) for ids in self._some(texts[k : k + 128])]
        for k, text in enumerate(texts):
            if any(s in text for s in self.special):
                out[k] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return out


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    """One for each worker process, whatever number of tasks it runs."""
    return WordIds(path)


def cuts(n: int, capacity: int = CAPACITY, grain: int = GRAIN) -> list[int]:
    """Lengths of a document's pieces, in order."""
    out = [capacity] * (n // capacity)
    rest = n % capacity
    size = capacity
    while (size := size // 2) >= grain:
        if rest >= size:
            out.append(size)
            rest -= size
    if rest:
        out.append(rest)
    return out


def _cut(path: str, capacity: int, grain: int, end_id: int, with_ids: bool):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids_of = word_ids(path)
        worker = TaskContext.get().partitionId()
        placed: dict[int, int] = {}
        row = 0
        for pdf in batches:
            out: list[tuple] = []
            texts = [t if isinstance(t, str) else "" for t in pdf["text"]]
            all_ids = (ids for k in range(0, len(texts), 128) for ids in ids_of(texts[k : k + 128]))
            for doc_id, ids in zip(pdf["doc_id"].tolist(), all_ids, strict=True):
                ids += end
                n, start = len(ids) // 4, 0
                for size in cuts(n, capacity, grain):
                    piece = ids[4 * start : 4 * (start + size)]
                    k = capacity // size
                    at = placed.get(k, 0)
                    placed[k] = at + 1
                    out.append((doc_id, row, start, size, zlib.crc32(piece), n, worker, k, at, *([piece] if with_ids else [])))
                    start += size
                row += 1
            yield pd.DataFrame(out, columns=["doc_id", "row", "start", "length", "ids_crc32", "doc_tokens", "worker", "k", "at", *(["ids"] if with_ids else [])])

    return run


def _fit(capacity: int):
    """Places the few pieces of the classes' last bins: longest first, each into the fullest sequence that holds it."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "worker", "row", "start"], ascending=[False, True, True, True, True], kind="stable")
        held: list[int] = []
        bins, offsets = [], []
        for n in pdf["length"]:
            best = -1
            for b, h in enumerate(held):
                if h + n <= capacity and (best < 0 or h > held[best]):
                    best = b
            if best < 0:
                best = len(held)
                held.append(0)
            bins.append(best)
            offsets.append(held[best])
            held[best] += int(n)
        pdf["sequence_id"] = np.array(bins, np.int64) * (capacity + 1)
        pdf["offset"] = np.array(offsets, np.int64)
        return pdf

    return run


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, grain: int = GRAIN, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row a piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ``ids``, as bytes).

    Sequence ids: class plus (capacity + 1) times the bin's number, with class 0 for what is fitted at the end.
    """
    small_batches(docs.sparkSession)
    path = tokenizer or default_tokenizer()
    schema = "doc_id long, row long, start long, length long, ids_crc32 long, doc_tokens long, worker int, k int, at long" + (", ids binary" if with_ids else "")
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pieces = settle(read.mapInPandas(_cut(path, capacity, grain, end_id, with_ids), schema))
    counts = pieces.groupBy("k", "worker").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("k").orderBy("worker").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("k", "worker", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"), F.sum("n").over(Window.partitionBy("k")).alias("all"))
    ranked = pieces.join(base, ["k", "worker"]).withColumn("rank", F.col("base") + F.col("at"))
    ranked = ranked.withColumn("bin", F.floor(F.col("rank") / F.col("k")))
    full = ranked.where(F.col("bin") < F.floor(F.col("all") / F.col("k")))
    full = full.withColumn("sequence_id", F.col("k") + F.col("bin") * (capacity + 1))
    within = Window.partitionBy("sequence_id").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    full = full.withColumn("offset", F.coalesce(F.sum("length").over(within), F.lit(0)))
    last = ranked.where(F.col("bin") >= F.floor(F.col("all") / F.col("k")))
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *(["ids"] if with_ids else [])]
    own = "doc_id long, row long, start long, length long, ids_crc32 long, doc_tokens long, worker int" + (", ids binary" if with_ids else "")
    last = last.select(*[c.split()[0] for c in own.split(", ")]).groupBy(F.lit("all").alias("all")).applyInPandas(_fit(capacity), own + ", sequence_id long, offset long")
    return full.select(*columns).unionByName(last.select(*columns))
