import random
import re

import numpy as np
import pytest

from rivulet.llm import minhash_dedup
from rivulet.llm.minhash_dedup import keep_one, near_duplicates, sketch

SCHEMA = "doc_id long, text string, key string"


def fold(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def brute(rows, width):
    sets = {}
    for d, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", fold(t))
        sets.setdefault(d, []).append({tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set())
    ids = sorted(sets)
    root = {d: d for d in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if any(x and y and 100 * len(x & y) >= 80 * len(x | y) for x in sets[a] for y in sets[b]):
                ra, rb = find(a), find(b)
                root[max(ra, rb)] = min(ra, rb)
    return sorted((d, len(s), find(d), d == find(d)) for d in ids for s in sets[d])


def got(df, width):
    return sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(df, width).collect())


@pytest.mark.parametrize("width", [2, 5])
def test_real_documents(spark, small, width):
    df = spark.read.parquet(f"{small}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    want = brute(rows, width)
    assert sum(not w[3] for w in want) > 5
    assert got(df, width) == want


def test_groups_near_the_threshold(spark, monkeypatch):
    monkeypatch.setattr(minhash_dedup, "CHUNK", 8)
    rng = random.Random(4)
    rows = []
    for g in range(6):
        base = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice([12, 40, 150]))]
        for _ in range(25):
            words = list(base)
            for _ in range(rng.randrange(0, max(2, len(words) // 7))):
                words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
            rows.append((rng.randrange(10**9), " ".join(words)))
    df = spark.createDataFrame([(*r, "k") for r in rows], SCHEMA).repartition(5)
    assert got(df, 2) == brute(rows, 2)


def test_edges(spark):
    rows = [(5, None), (6, ""), (7, " \t\x0b\n"), (8, "one"), (9, "ONE "), (10, "One two"), (11, "one\xa0two"), (3, "é É"), (4, "É é"), (12, "a b c"), (12, "a b c"), (13, "a  b\nc"), (14, "x y " * 50_000), (2, "x y x")]
    df = spark.createDataFrame([(*r, "k") for r in rows], SCHEMA)
    assert got(df, 2) == brute(rows, 2)
    assert near_duplicates(df.where("false")).collect() == []
    kept = keep_one(df, 2)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [r[0] for r in brute(rows, 2) if r[3]]


def test_sketch_estimates_and_fills():
    rng = np.random.default_rng(1)
    for n in (1, 2, 30, 5000):
        s = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        assert sketch(s).max() < np.iinfo(np.uint64).max
    agree = []
    for _ in range(40):
        x = rng.integers(0, 2**63, 300, dtype=np.uint64)
        y = np.r_[x[: -300 // 9 - 1], rng.integers(0, 2**63, 300 // 9 + 1, dtype=np.uint64)]
        agree.append((sketch(x) == sketch(y)).mean() - len(np.intersect1d(x, y)) / len(np.union1d(x, y)))
    assert abs(np.mean(agree)) < 0.02 and np.std(agree) < 0.06


def test_rows_that_repeat_an_id_with_other_texts(spark):
    base = [f"w{k}" for k in range(60)]
    other = [f"v{k}" for k in range(60)]
    rows = [(1, " ".join(base)), (1, " ".join(other)), (2, " ".join([*base[:-3], "x1", "x2", "x3"])), (3, " ".join([*other[:-3], "y1", "y2", "y3"])), (4, "alone it stands"), (1, " ".join(base))]
    df = spark.createDataFrame([(*r, "k") for r in rows], SCHEMA)
    assert got(df, 2) == brute(rows, 2)


def test_large_groups_of_copies(spark):
    rows = [(k, "one and the same text for all of these") for k in range(100, 1500)] + [(k, f"text number {k} is of its own kind {k * 7}") for k in range(60)]
    df = spark.createDataFrame([(*r, "k") for r in rows], SCHEMA).repartition(6)
    out = {r.doc_id: r.component_id for r in near_duplicates(df, 2).collect()}
    assert all(out[k] == 100 for k in range(100, 1500)) and all(out[k] == k for k in range(60))


def test_bundles_of_one_template(spark, monkeypatch):
    """Pages of one template, alike but no links: the rows that meet in a bundle stay near the intended number."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(minhash_dedup, "CHUNK", 16)
    monkeypatch.setattr(minhash_dedup, "TASK_ROWS", 256)
    rng = random.Random(8)
    template = [f"t{k}" for k in range(60)]
    pages = [(k, " ".join(template + [f"p{k}x{j}" for j in range(22)] + ["end"])) for k in range(400)] + [(1000 + k, " ".join(rng.choice(["a", "b", "c"]) for _ in range(30))) for k in range(20)]
    seen = {}
    real = minhash_dedup._chunk_pairs

    def counted(*a):
        chunks, rows = real(*a)
        tasks = max(8, 3 * int(rows) // (2 * minhash_dedup.TASK_ROWS))
        bundle = F.pmod(F.xxhash64("key", "g"), F.lit(tasks))
        seen["rows"], seen["dealt"] = rows, chunks.count()
        seen["most"] = chunks.groupBy(bundle.alias("b")).count().agg(F.max("count")).first()[0]
        return chunks, rows

    monkeypatch.setattr(minhash_dedup, "_chunk_pairs", counted)
    df = spark.createDataFrame(pages, "doc_id long, text string")
    assert got(df, 2) == brute(pages, 2)
    assert seen["rows"] == seen["dealt"] > 5 * len(pages) and seen["most"] <= 2 * minhash_dedup.TASK_ROWS, seen

