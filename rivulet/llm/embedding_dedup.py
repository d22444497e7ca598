"""Embedding near-duplicates by spherical-cap filters from structured random product codes.

Filter directions: the dimensions are dealt into ``parts`` groups, each group has ``code`` random unit vectors, and a
direction is one of each group, scaled to unit length: code ** parts directions from parts * code small vectors. A
vector is decoded to all directions whose inner product exceeds the threshold, group by group, dropping prefixes that no
completion can lift over it; vectors with fewer than ``least`` such directions take their best ones instead. Vectors
join on shared directions, and pairs are verified by cosine in double precision.

The number of directions grows with the number of vectors, so that a direction has about ``LOAD`` of them whatever the
size of the table, and with it the least number of directions of a vector, which keeps the recall. Equal vectors are one
with a weight, so copies make no pairs. A direction's vectors are cut into chunks, and chunks are paired; a task works
through a bundle of such pairs that has a bounded number of rows, whatever the directions' loads. A pair counts in the
first direction that both share only. A task returns counts and a spanning forest of its links, not the links, so its
output is as long as its input.

Recall against brute force on the tables at hand is above 0.99; on random pairs at cosine 0.9 exactly it is 0.98 or more
for 6 to 48 vectors a group, and 0.97 or more from 1 to 15 dimensions, where there are fewer groups (see the tests).

Edge cases: vectors that are null, empty, zero or hold null or non-finite components link with nothing and are
their own component; vectors of different lengths never link; rows that repeat a vec_id link with the others like
any rows and share its result, each row counting as a vector; an empty table gives an empty result; labels and extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import settle
from rivulet.llm.graph import connected_components

COSINE = 0.9
PARTS = 4
LOAD = 100  # vectors a direction, about
FEWEST, MOST = 6, 48  # vectors a group: beyond MOST**PARTS directions the load grows
CAP = 3.4  # threshold in standard deviations of a random unit vector's inner products
GROUP_DIMS = 4  # dimensions in a group, at least, or there are fewer groups
WIDE = 4096  # vectors in a group of the fewer ones, at most
LOW_TIMES = 4  # so many times as many directions a vector, at least, where there are fewer groups
EXTRA = 4  # a vector is filed under at least so many directions more than a group has vectors
CHUNK = 1024
BUNDLE = 16384  # rows in a task's bundle of chunk pairs, about
SEED = 99


def code_for(vectors: int) -> int:
    """Vectors a group for so many vectors, of which each has some twenty directions."""
    return int(min(max(round((20 * vectors / LOAD) ** (1 / PARTS)), FEWEST), MOST))


def layout(dims: int, code: int) -> tuple[int, int, int]:
    """(groups, vectors a group, least directions of a vector) for vectors of so many dimensions.

    A group needs some dimensions to have different vectors in: fewer than four a group leave copies of few directions. With
    fewer groups each has more vectors, so that there are as many directions (up to WIDE in one group). In a plane or on a
    line caps are wide for their directions' number, so a tenth of all is taken.
    """
    parts = min(PARTS, max(1, dims // GROUP_DIMS))
    if parts == PARTS:
        return PARTS, code, code + EXTRA
    own = min(WIDE, round(code ** (PARTS / parts)))
    return parts, own, max(LOW_TIMES * code + EXTRA, own // 10 if dims <= 2 else 0)


def directions(dims: int, parts: int, code: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each group its dimensions, shuffled, and its vectors, scaled so that a product has unit length."""
    rng = np.random.default_rng([SEED, dims, parts, code])
    order = rng.permutation(dims)
    out = []
    for k in range(parts):
        own = order[k::parts]
        v = rng.standard_normal((code, len(own)))
        norm = np.linalg.norm(v, axis=1, keepdims=True)
        out.append((own, v / np.where(norm == 0, 1, norm) / np.sqrt(parts)))
    return out


def decode(x: np.ndarray, parts: int, code: int, cap: float = CAP, least: int = 10) -> list[np.ndarray]:
    """For each unit vector (row), the sorted numbers of the directions that it is filed under."""
    n, dims = x.shape
    scores = [x[:, own] @ v.T for own, v in directions(dims, parts, code)]
    best_rest = np.zeros((parts + 1, n))
    for k in range(parts - 1, -1, -1):
        best_rest[k] = best_rest[k + 1] + scores[k].max(axis=1)
    limit = np.full(n, cap / np.sqrt(dims))
    lists: list[np.ndarray] = [np.zeros(0, np.int64)] * n
    todo = np.arange(n)
    while len(todo):
        owner, number, score = todo, np.zeros(len(todo), np.int64), np.zeros(len(todo))
        for k in range(parts):
            grown = score[:, None] + scores[k][owner]
            row, c = np.nonzero(grown + best_rest[k + 1][owner][:, None] >= limit[owner][:, None] - 1e-12)
            owner, number, score = owner[row], number[row] * code + c, grown[row, c]
        order = np.argsort(owner, kind="stable")
        owner, number, score = owner[order], number[order], score[order]
        bounds = np.searchsorted(owner, np.r_[todo, n])
        short = []
        for i, t in enumerate(todo.tolist()):
            a, b = bounds[i], bounds[i + 1] if i + 1 < len(todo) else len(owner)
            if b - a >= min(least, code**parts):
                keep = slice(a, b)
                lists[t] = np.sort(number[keep])
            else:
                short.append(t)
        todo = np.array(short, np.int64)
        limit[todo] -= 0.2 / np.sqrt(dims)
    return lists


def _units(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _filed(code: int):
    """Adds the directions; the vector goes along in single precision where that is exact, else in double."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ids = pdf["vec_id"].to_numpy()
            by_dims: dict[int, list[tuple[int, np.ndarray]]] = {}
            for i, e in enumerate(pdf["embedding"]):
                v = np.array(e, dtype=np.float64) if e is not None else np.zeros(0)
                if len(v) and np.isfinite(v).all() and v.any():
                    by_dims.setdefault(len(v), []).append((i, v))
            for dims, rows in by_dims.items():
                x = np.stack([v for _, v in rows])
                single = x.astype(np.float32)
                exact = (single == x).all(axis=1)
                raw = [(b"f" + s.tobytes()) if e else (b"d" + v.tobytes()) for e, s, v in zip(exact, single, x, strict=True)]
                parts, own, least = layout(dims, code)
                lists = decode(_units(x), parts, own, least=least)
                same = [hashlib.blake2b(r, digest_size=16).digest() for r in raw]
                yield pd.DataFrame({"vec_id": ids[[i for i, _ in rows]], "dims": np.int32(dims), "same": same, "vector": raw, "filed": [f.astype(np.int32) for f in lists]})

    return run


def _vectors(raw: list[bytes]) -> np.ndarray:
    """Unit vectors of one length from their bytes."""
    wide = [r[:1] == b"d" for r in raw]
    if not any(wide):
        return _units(np.frombuffer(b"".join([r[1:] for r in raw]), np.float32).reshape(len(raw), -1).astype(np.float64))
    return _units(np.stack([np.frombuffer(r, np.float64 if w else np.float32, offset=1).astype(np.float64) for r, w in zip(raw, wide, strict=True)]))


def _links(x: np.ndarray, weight: np.ndarray, chunk: np.ndarray, filed: list[np.ndarray], here: int, two: bool, link: float) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """(places, weights linked, smallest place reachable) of a chunk, or two, for links in their first shared direction."""
    near = x @ x.T >= link
    np.fill_diagonal(near, False)
    if two:
        near &= chunk[:, None] != chunk[None, :]
    rows = np.flatnonzero(near.any(axis=1))
    if not len(rows):
        return None
    near = near[np.ix_(rows, rows)]
    earlier = [filed[r][: np.searchsorted(filed[r], here)] for r in rows.tolist()]
    if any(len(f) for f in earlier):
        names, at = np.unique(np.concatenate(earlier), return_inverse=True)
        holds = np.zeros((len(rows), len(names)), np.float32)
        holds[np.repeat(np.arange(len(rows)), [len(f) for f in earlier]), at] = 1
        near &= holds @ holds.T == 0
    low = np.arange(len(rows))
    while True:  # components inside the task: the smallest place reachable
        new = np.where(near, low[None, :], len(rows)).min(axis=1)
        new = np.minimum(low, new)
        new = new[new]
        if (new == low).all():
            break
        low = new
    return rows, near @ weight[rows], rows[low]


def _linked(link: float):
    """A bundle of chunk pairs, one after the other."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out: list[np.ndarray] = []
        for (_, here, x_chunk, y_chunk), part in pdf.groupby(["dims", "direction", "x", "y"], sort=False):
            found = _links(_vectors(part["vector"].tolist()), part["weight"].to_numpy(), part["chunk"].to_numpy(), part["filed"].tolist(), here, x_chunk != y_chunk, link)
            if found is not None:
                rows, n, low = found
                some = (n > 0) | (low != rows)
                row, vec_id = part["row"].to_numpy(), part["vec_id"].to_numpy()
                out.append(np.stack([row[rows], vec_id[rows], n, vec_id[low]])[:, some])
        a = np.concatenate(out, axis=1) if out else np.zeros((4, 0), np.int64)
        return pd.DataFrame({"row": a[0], "vec_id": a[1], "n": a[2], "low": a[3]})

    return run


def near_vectors(vectors: DataFrame, link: float = COSINE) -> DataFrame:
    """One row a vector: vec_id, n_links, component_id (smallest vec_id reachable by links) and kept."""
    read = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    schema = "vec_id long, dims int, same binary, vector binary, filed array<int>"
    filed = settle(read.mapInPandas(_filed(code_for(read.count())), schema).withColumn("row", F.monotonically_increasing_id()))
    one = filed.groupBy("same").agg(F.min(F.struct("vec_id", "row")).alias("first"), F.count(F.lit(1)).alias("weight"))
    one = settle(one.select("same", F.col("first.vec_id").alias("first_id"), F.col("first.row").alias("row"), "weight"))
    reps = settle(filed.join(one.select("row", "weight"), "row"))

    entries = reps.select("row", "dims", F.explode("filed").alias("direction"))
    loads = entries.groupBy("dims", "direction").agg(F.count(F.lit(1)).alias("n")).where("n > 1").withColumn("chunks", F.ceil(F.col("n") / CHUNK).cast("int"))
    loads = settle(loads)
    rows = loads.agg(F.coalesce(F.sum(F.col("n") * F.col("chunks")), F.lit(0))).first()[0]
    placed = entries.join(loads, ["dims", "direction"]).withColumn("chunk", F.pmod(F.xxhash64("row"), F.col("chunks")).cast("int"))
    paired = placed.select("row", "dims", "direction", "chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
    paired = paired.withColumn("x", F.least("chunk", "other")).withColumn("y", F.greatest("chunk", "other")).drop("other")
    bundles = max(8, int(rows) // BUNDLE)
    paired = paired.withColumn("bundle", F.pmod(F.xxhash64("dims", "direction", "x", "y"), F.lit(bundles)))
    work = paired.join(reps.select("row", "vec_id", "vector", "filed", "weight"), "row").repartition(bundles, "bundle")
    links = settle(work.groupBy("bundle").applyInPandas(_linked(link), "row long, vec_id long, n long, low long"))

    per_row = links.groupBy("row").agg(F.sum("n").alias("n"))
    known = one.join(per_row, "row", "left").select("same", "first_id", (F.col("weight") - 1 + F.coalesce("n", F.lit(0))).alias("n"))
    each = settle(filed.select("vec_id", "same").join(known, "same").select("vec_id", "first_id", "n"))
    edges = links.select(F.col("vec_id").alias("a"), F.col("low").alias("b")).unionByName(each.select(F.col("vec_id").alias("a"), F.col("first_id").alias("b")))
    comps = connected_components(edges)
    counts = each.groupBy("vec_id").agg(F.sum("n").alias("n"))
    out = read.select("vec_id").join(counts, "vec_id", "left").join(comps.withColumnRenamed("node", "vec_id"), "vec_id", "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (component == F.col("vec_id")).alias("kept"))
