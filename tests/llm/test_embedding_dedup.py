import numpy as np
import pytest

from rivulet.llm import embedding_dedup
from rivulet.llm.embedding_dedup import decode, directions, near_vectors

SCHEMA = "vec_id long, embedding array<float>, label int, unit string"


def brute(rows, link=0.9):
    good = [(i, np.array(v, np.float64)) for i, v in rows if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    n = {i: 0 for i, _ in rows}
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (a, x) in enumerate(good):
        for b, y in good[k + 1 :]:
            if len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= link:
                n[a] += 1
                n[b] += 1
                ra, rb = find(a), find(b)
                root[max(ra, rb)] = min(ra, rb)
    return {i: (n[i], find(i), i == find(i)) for i in n}


def got(df):
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_vectors(df).collect()}


def near_group(rng, n, dims, spread):
    base = rng.standard_normal(dims)
    return [base + spread * rng.standard_normal(dims) * np.linalg.norm(base) / np.sqrt(dims) for _ in range(n)]


@pytest.mark.parametrize("chunk", [16, 1024])
def test_against_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(embedding_dedup, "CHUNK", chunk)
    monkeypatch.setattr(embedding_dedup, "BUNDLE", 500)
    rng = np.random.default_rng(5)
    vs = [v for s in (0.05, 0.3, 0.33, 0.36) for _ in range(4) for v in near_group(rng, 25, 64, s)] + list(rng.standard_normal((200, 64)))
    rows = [(int(i) * 3, [float(np.float32(x)) for x in v]) for i, v in enumerate(vs)]
    df = spark.createDataFrame([(i, v, 1, "u") for i, v in rows], SCHEMA).repartition(4)
    want, have = brute(rows), got(df)
    assert set(want) == set(have)
    assert all(have[i][0] <= want[i][0] for i in want)
    assert sum(h[0] for h in have.values()) >= 0.97 * sum(w[0] for w in want.values()) > 1000
    assert sum(have[i][1] == want[i][1] for i in want) >= 0.97 * len(want)


def test_real_vectors(spark, small):
    df = spark.read.parquet(f"{small}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    want, have = brute(rows), got(df)
    assert sum(h[0] for h in have.values()) >= 0.97 * sum(w[0] for w in want.values())


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (9, [1.0, 0.0]), (8, [2.0, 0.1]), (7, [-1.0, 0.0]), (10, [1.0]), (11, [3.0]), (12, [1e-30, 0.0]), (13, [3e38, 3e37])]
    df = spark.createDataFrame([(i, v, None, None) for i, v in rows], SCHEMA)
    assert got(df) == brute(rows)
    assert near_vectors(df.where("false")).collect() == []


def test_repeated_rows_and_large_groups_of_copies(spark):
    rng = np.random.default_rng(8)
    a, b = rng.standard_normal(64), rng.standard_normal(64)
    near = a + 0.2 * rng.standard_normal(64)
    rows = [(k, a) for k in range(10, 400)] + [(500, near), (501, b), (3, b), (7, 2 * a), (600, near)]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    df = spark.createDataFrame([(i, v, 1, "u") for i, v in rows], SCHEMA).repartition(4)
    assert got(df) == brute(rows)
    # Rows that repeat an id share the result, each counting as a vector.
    twice = spark.createDataFrame([(1, [1.0, 0.0], 1, "u"), (1, [1.0, 0.0], 1, "u"), (2, [1.0, 0.1], 1, "u")], SCHEMA)
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in near_vectors(twice).collect()) == [(1, 4, 1), (1, 4, 1), (2, 2, 1)]


@pytest.mark.parametrize("code", [6, 10, 24, 48])
def test_recall_at_the_threshold(code):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((800, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = rng.standard_normal((800, 64))
    z -= (z * x).sum(axis=1, keepdims=True) * x
    y = 0.9 * x + np.sqrt(1 - 0.81) * z / np.linalg.norm(z, axis=1, keepdims=True)
    both = zip(decode(x, 4, code, least=code + embedding_dedup.EXTRA), decode(y, 4, code, least=code + embedding_dedup.EXTRA))
    assert np.mean([len(np.intersect1d(a, b)) > 0 for a, b in both]) >= 0.97


def test_directions_grow_with_the_vectors():
    assert [embedding_dedup.code_for(n) for n in (0, 2000, 51_282, 10**6, 10**9)] == [6, 6, 10, 21, 48]


def test_decode_is_complete():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((20, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    lists = decode(x, parts=2, code=6, cap=1.0, least=3)
    full = np.zeros((36, 16))
    (oa, va), (ob, vb) = directions(16, 2, 6)
    for a in range(6):
        for b in range(6):
            full[a * 6 + b, oa] = va[a]
            full[a * 6 + b, ob] = vb[b]
    assert np.allclose(np.linalg.norm(full, axis=1), 1)
    s = x @ full.T
    for i, have in enumerate(lists):
        over = set(np.flatnonzero(s[i] >= 0.25))
        assert over <= set(have.tolist()) and len(have) >= 3 and (len(over) >= 3) <= (set(have.tolist()) == over)


@pytest.mark.parametrize("code", [6, 12, 30])
@pytest.mark.parametrize("dims", range(1, 16))
def test_recall_in_few_dimensions(dims, code):
    """Random pairs at cosine 0.9 exactly (on a line: at 1), by the directions that both are filed under."""
    rng = np.random.default_rng(dims)
    a = rng.standard_normal((400, dims))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.standard_normal(a.shape)
    b -= (b * a).sum(axis=1, keepdims=True) * a
    b = a.copy() if dims == 1 else 0.9 * a + np.sqrt(0.19) * b / np.linalg.norm(b, axis=1, keepdims=True)
    parts, own, least = embedding_dedup.layout(dims, code)
    filed = [embedding_dedup.decode(x, parts, own, least=least) for x in (a, b)]
    assert np.mean([len(np.intersect1d(x, y)) > 0 for x, y in zip(*filed)]) >= 0.97


def test_few_dimensions_against_brute_force(spark):
    rng = np.random.default_rng(5)
    for dims in (2, 4, 6):
        x = rng.standard_normal((250, dims))
        u = x / np.linalg.norm(x, axis=1, keepdims=True)
        near = u @ u.T >= 0.9
        np.fill_diagonal(near, False)
        df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
        got = {r.vec_id: r.n_links for r in near_vectors(df).collect()}
        found = sum(got.values()) / near.sum()
        assert 0.97 <= found <= 1 and all(got[k] <= near[k].sum() for k in got)
