import math

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from rivulet.llm import topk
from rivulet.llm.topk import ImpactIndex, top_k

SCHEMA = "vec_id long, embedding array<double>, score long"


def brute(rows, queries, k=5):
    ok = lambda v: v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v)
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if ok(v)]
    out = []
    for i, q in {i: v for i, v in whole if i in queries}.items():
        best = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in whole if j != i and len(v) == len(q))[:k]
        out += [(i, n, j, -s) for n, (s, j) in enumerate(best, 1)]
    return sorted(out)


def got(df, asked):
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in top_k(df, asked).collect())


@pytest.mark.parametrize("block", [40, 8192])
def test_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "QUERIES", 7)
    rng = np.random.default_rng(3)
    v = np.r_[rng.standard_normal((200, 12)) / 3, np.repeat(rng.standard_normal((1, 12)), 30, axis=0), np.zeros((5, 12))]
    rows = [(int(i), x.tolist()) for i, x in enumerate(v)]
    df = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA).repartition(3)
    assert got(df, df.where("vec_id % 10 = 0")) == brute(rows, {i for i, _ in rows if i % 10 == 0})


def test_edges(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.5]), (1, None), (2, [nan, 1.0]), (3, [None, 1.0]), (4, []), (5, [float("inf"), 0.0]), (6, [0.1, -0.3]), (7, [0.1, -0.3]), (8, [1.0]), (9, [-2.0, 1e6])]
    df = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)
    assert got(df, df) == brute(rows, set(range(10)))
    assert top_k(df.where("false"), df).collect() == [] and top_k(df, df.where("false")).collect() == []


def test_real_vectors(spark, small):
    df = spark.read.parquet(f"{small}/embeddings.parquet").withColumn("embedding", F.col("embedding").cast("array<double>"))
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    assert got(df, df.where("vec_id % 50 = 0")) == brute(rows, {i for i, _ in rows if i % 50 == 0})


def test_repeated_rows_and_huge_numbers(spark):
    rows = [(1, [0.5, 0.25]), (1, [0.5, -0.25]), (2, [1.0, 1.0]), (2, [1.0, 1.0]), (50, [1e30, 1.0]), (51, [-1e30, 0.0]), (52, [1e12, 1e12])]
    df = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)
    lo, hi = -(2**63), 2**63 - 1
    whole = [(i, [min(max(math.floor(256 * x), lo), hi) for x in v]) for i, v in rows]
    asked = {i: min(v for j, v in whole if j == i) for i, _ in whole}
    want = []
    for i, q in asked.items():
        best = sorted((-min(max(sum(a * b for a, b in zip(q, v)), lo), hi), j) for j, v in whole if j != i)[:5]
        want += [(i, n, j, -s) for n, (s, j) in enumerate(best, 1)]
    assert got(df, df) == sorted(want)


def vectors(path):
    read = pq.read_table(path, columns=["embedding"]).column(0).to_pylist()
    return np.floor(256 * np.array([v for v in read if v is not None], float)).astype(np.int64)


@pytest.mark.parametrize("name, most", [("sf0.1", 0.5), ("sf0.01", 0.6)])
def test_proof_stops_on_real_vectors(name, most):
    v = vectors(f"/root/testdata/{name}/embeddings.parquet")[:4096]
    index = ImpactIndex(np.arange(len(v)), v)
    shares = []
    for q in range(0, len(v), 50):
        rows, scores, share = index.search(v[q], q, 5)
        want = sorted((-int(s), j) for j, s in enumerate(v @ v[q]) if j != q)[:5]
        assert [(-s, int(index.ids[r])) for r, s in zip(rows, scores)] == want
        shares.append(share)
    assert np.mean(shares) < most and max(shares) < 1


def test_without_proof_all_segments_are_processed():
    v = np.ones((300, 8), np.int64)
    rows, scores, share = ImpactIndex(np.arange(300), v).search(v[0], 0, 5)
    assert share == 1 and rows.tolist() == [1, 2, 3, 4, 5] and scores.tolist() == [8] * 5


def test_every_pair_of_blocks_meets(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 20)
    monkeypatch.setattr(topk, "QUERIES", 3)
    rows = [(i, v.tolist()) for i, v in enumerate(np.random.default_rng(8).standard_normal((200, 6)))]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as on tables too large for one partition
    try:
        df = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)
        assert got(df, df.where("vec_id % 10 = 0")) == brute(rows, set(range(0, 200, 10)))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_huge_component_hides_no_others():
    v = np.c_[np.full(199, 256 * 10**9), np.floor(256 * np.random.default_rng(5).standard_normal((199, 7)))].astype(np.int64)
    v = np.r_[np.full((1, 8), 256), v]
    rows, scores, _ = ImpactIndex(np.arange(200), v).search(v[0], 0, 5)
    want = sorted((-int(s), j) for j, s in enumerate(v @ v[0]) if j)[:5]
    assert [(-int(s), int(r)) for r, s in zip(rows, scores)] == want


def test_rows_without_an_id_take_no_part(spark):
    rows = [(i, [float(i), 1.0]) for i in range(5)]
    df = spark.createDataFrame([(*r, 0) for r in [*rows, (None, [9.0, 9.0])]], SCHEMA)
    assert got(df, df) == brute(rows, set(range(5)))
