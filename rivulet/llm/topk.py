"""Exact top-k inner-product search over an impact-ordered index, score at a time.

Vectors are turned into whole numbers (floor of ``scale`` times each component). An index block holds some thousands of
vectors as postings: each dimension's vectors by their number, cut into ``levels`` segments of equally many, whose
quantised impact is the largest absolute number in it. A query processes segments in descending order of
|query component| * impact, whatever the dimension, adding each posting's product to its vector's accumulator, and its
squares to what the vector has used of the two lengths. What a vector can still gain is at most the product of the
lengths that are left (Cauchy-Schwarz), and the best k found so far, scored exactly, give a threshold. Members whose
bound is below it are out for certain. Processing stops when this proof has left so few possible members that scoring
them costs less than ``WORTH`` of the postings that remain; these members are then rescored exactly. If no proof comes,
all segments are processed. The same rule holds for blocks of any size; no count of members stops it.

Index blocks and query blocks are numbered, and each pair of blocks is a task of bounded size: ``BLOCK`` vectors,
``QUERIES`` queries. Only the best k of each query and index block are shuffled again. The copies that are shuffled are
(queries / QUERIES) of each index block and (vectors / BLOCK) of each query block.

Random vectors of 64 dimensions leave little to prove: on blocks of the embeddings at hand about half of the segments
are processed on average (see the tests), and up to a quarter of the members rescored.

Edge cases: vectors that are null, or hold null or non-finite components, and rows without an id take no part, as query or
candidate; empty vectors and vectors of other lengths than the query's are no candidates of it; ties go to the smaller id; fewer than k
candidates give fewer rows; rows that repeat an id are candidates each (the query's own id is none), and of queries that
repeat an id the smallest vector is asked; numbers and scores beyond 64 bits are cut to the largest or smallest long;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rivulet.llm.common import settle

SCALE = 256
BLOCK = 4096
QUERIES = 512
LEVELS = 16
WORTH = 0.5
ROUNDS = 12  # checks of the proof over all segments
ROUNDED = 1e-12  # of a length, what a sum of squares in doubles may be off by
LONG = np.iinfo(np.int64)


def _whole(vectors: DataFrame, scale: int) -> DataFrame:
    read = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"))
    fine = F.col("e").isNotNull() & F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return read.where(F.col("vec_id").isNotNull() & fine & (F.size("e") > 0)).select("vec_id", F.transform("e", lambda x: F.floor(x * scale).cast("long")).alias("v"))


def _packed(size: int):
    """Rows into blocks of up to ``size`` vectors of one length: ids and numbers as bytes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, count = TaskContext.get().partitionId(), 0
        held: dict[int, list[tuple[int, np.ndarray]]] = {}

        def row(dims: int) -> pd.DataFrame:
            rows = held.pop(dims)
            ids, v = np.array([r[0] for r in rows], np.int64), np.stack([r[1] for r in rows]).astype(np.int64)
            return pd.DataFrame({"part": [part], "at": [count], "dims": [dims], "ids": [ids.tobytes()], "v": [v.tobytes()]})

        for pdf in batches:
            for i, v in zip(pdf["vec_id"].tolist(), pdf["v"], strict=True):
                held.setdefault(len(v), []).append((i, np.asarray(v)))
                if len(held[len(v)]) >= size:
                    yield row(len(v))
                    count += 1
        for dims in list(held):
            yield row(dims)
            count += 1

    return run


def _blocks(rows: DataFrame, size: int, name: str) -> tuple[DataFrame, int]:
    """Packed blocks, numbered from 0 without gaps in the column ``name``, and how many there are."""
    packed = settle(rows.mapInPandas(_packed(size), "part int, at int, dims int, ids binary, v binary"))
    counts = packed.groupBy("part").agg(F.count(F.lit(1)).alias("n"))  # one row a partition
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return packed.join(base, "part").select((F.col("base") + F.col("at")).cast("long").alias(name), "dims", "ids", "v"), packed.count()


class ImpactIndex:
    """Postings of one block: for each dimension, its vectors in segments of like impact."""

    def __init__(self, ids: np.ndarray, v: np.ndarray, levels: int = LEVELS):
        order = np.argsort(ids, kind="stable")
        self.ids, self.v = ids[order], v[order]
        n, dims = v.shape
        size = -(-n // levels)
        by = np.argsort(self.v, axis=0, kind="stable")
        rows, values = np.full((dims, levels * size), n), np.zeros((dims, levels * size), np.int64)  # row n is no vector
        rows[:, :n], values[:, :n] = by.T, np.take_along_axis(self.v, by, axis=0).T
        self.rows, self.values = rows.reshape(dims * levels, size), values.reshape(dims * levels, size).astype(np.float64)
        self.impacts = np.abs(self.values).max(axis=1)
        self.dims = np.repeat(np.arange(dims), levels)
        self.lengths = (self.v.astype(np.float64) ** 2).sum(axis=1)

    def search(self, q: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray, float]:
        """(rows, scores) of the best k without the query's own id, and the share of the segments processed."""
        n = len(self.ids)
        possible = np.flatnonzero(self.ids != own)
        size = np.abs(q.astype(np.float64))
        if (size.max() or 1.0) * (self.impacts.max() or 1.0) * len(q) >= 2.0**52:
            wide = self.v[possible].astype(object) @ q.astype(object)  # beyond what the accumulators hold exactly
            return *self._best(possible, np.array([min(max(s, LONG.min), LONG.max) for s in wide], np.int64), k), 1.0
        gains = size[self.dims] * self.impacts
        order = np.argsort(-gains, kind="stable")
        order = order[gains[order] > 0]
        acc, used_q, used_v = np.zeros(n + 1), np.zeros(n + 1), np.zeros(n + 1)
        whole, least = float(size @ size), -np.inf
        step = max(1, -(-len(order) // ROUNDS))
        done = 0
        while done < len(order) and len(possible) > k:
            todo = order[done : done + step]
            done += len(todo)
            rows, x = self.rows[todo].ravel(), self.values[todo]
            by = q[self.dims[todo]][:, None]
            acc += np.bincount(rows, weights=(x * by).ravel(), minlength=n + 1)
            used_v += np.bincount(rows, weights=(x * x).ravel(), minlength=n + 1)
            used_q += np.bincount(rows, weights=np.broadcast_to(by * by, x.shape).ravel(), minlength=n + 1)
            now = acc[possible]
            # What differences of rounded sums may lack is added: a huge component must not hide what others still give.
            rest_q = np.maximum(whole - used_q[possible], 0) + whole * ROUNDED
            rest_v = np.maximum(self.lengths[possible] - used_v[possible], 0) + self.lengths[possible] * ROUNDED
            left = rest_q * rest_v
            bound = now + np.sqrt(left) * (1 + 1e-9) + 1e-6
            top = possible[np.argpartition(-now, k - 1)[:k]]
            least = max(least, (self.v[top] @ q).min())  # k members reach this
            possible = possible[bound >= least]
            if len(possible) * len(q) <= WORTH * (len(order) - done) * self.rows.shape[1] and len(possible) * 2 <= n:
                break
        return *self._best(possible, self.v[possible] @ q, k), done / max(1, len(order))

    def _best(self, rows: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        best = np.lexsort((self.ids[rows], -scores.astype(object) if len(scores) and scores.min() == LONG.min else -scores))[:k]
        return rows[best], scores[best]


def _search(k: int):
    """One index block against one query block."""

    def run(key: tuple, blocks: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out: list[np.ndarray] = []
        for b in blocks.itertuples():
            asked = [r for r in queries.itertuples() if r.dims == b.dims]
            if not asked:
                continue
            ids = np.frombuffer(b.ids, np.int64)
            index = ImpactIndex(ids, np.frombuffer(b.v, np.int64).reshape(len(ids), -1))
            for r in asked:
                q_ids = np.frombuffer(r.ids, np.int64)
                for q_id, q in zip(q_ids.tolist(), np.frombuffer(r.v, np.int64).reshape(len(q_ids), -1), strict=True):
                    rows, scores, _ = index.search(q, q_id, k)
                    out.append(np.stack([np.full(len(rows), q_id), index.ids[rows], scores]))
        a = np.concatenate(out, axis=1) if out else np.zeros((3, 0), np.int64)
        return pd.DataFrame({"query_id": a[0], "vec_id": a[1], "score": a[2]})

    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, scale: int = SCALE) -> DataFrame:
    """For each row of ``queries`` (vec_id, embedding) its k best vectors: query_id, rank from 1, vec_id, score."""
    index, n_index = _blocks(_whole(vectors, scale), BLOCK, "x")
    asked, n_asked = _blocks(_whole(queries, scale).groupBy("vec_id").agg(F.min("v").alias("v")), QUERIES, "y")
    # Both sides' numbers are longs: a cogroup deals each side by its own keys' hashes, which differ between int and long.
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(max(n, 1) - 1).cast("long")))
    placed, sent = index.withColumn("y", upto(n_asked)), asked.withColumn("x", upto(n_index))
    best = placed.groupBy("x", "y").cogroup(sent.groupBy("x", "y")).applyInPandas(_search(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
