"""Runs against a plain search of all periods, and the query's digests against the contract written out in Python."""

import hashlib
import random
import re
import zlib

import numpy as np

from rivulet.llm.periodic_runs import collapse, find_runs, run_report, runs_of


def plain_runs(w):
    """Every maximal stretch of every period, the smallest period of each stretch."""
    out = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                out.setdefault((i, j + q), q)
            i = j + 1
    return sorted(((s, e - s, q) for (s, e), q in out.items()), key=lambda r: (r[0], r[2]))


def report(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w)
    drop = {k for s, m, q in runs for k in range(s + q, s + m)}
    top = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    milli = 1000 * top[1] // top[2] if runs else None
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    return (doc_id, len(runs), *top, milli, sha(lines), sha(" ".join(x for k, x in enumerate(w) if k not in drop)))


def some_words(rng):
    k = rng.choice([1, 2, 2, 3, 5])
    d = [rng.randrange(k) for _ in range(rng.randint(0, 60))]
    for _ in range(rng.randint(0, 4)):
        p = [rng.randrange(k) for _ in range(rng.randint(1, 5))]
        at = rng.randint(0, len(d))
        d[at:at] = (p * 9)[: rng.randint(3, 9 * len(p))]
    if d and rng.random() < 0.5:
        a = rng.randrange(len(d))
        b = rng.randint(a, len(d))
        d = d + d[a:b] + [rng.randrange(k)] + d[a:b]
    return d


def test_runs_against_all_periods():
    rng = random.Random(7)
    for _ in range(600):
        docs = [some_words(rng) for _ in range(rng.randint(1, 6))]
        ids = np.array([x for d in docs for x in d], np.int64)
        assert runs_of(ids, np.array([len(d) for d in docs], np.int64)) == [plain_runs(d) for d in docs]


def test_one_word_a_thousand_times_and_powers():
    docs = [[1] * 1000, [1, 2] * 500, list(range(250)) * 4, ([1] * 6 + [2]) * 40, []]
    ids = np.array([x for d in docs for x in d], np.int64)
    got = runs_of(ids, np.array([len(d) for d in docs], np.int64))
    assert got == [plain_runs(d) for d in docs]
    assert got[0] == [(0, 1000, 1)] and got[2] == [(0, 1000, 250)] and len(got[3]) == 41


def test_query_against_contract(spark):
    rng = random.Random(3)
    rows = [(k, " ".join(f"w{x}" for x in some_words(rng))) for k in range(300)]
    rows += [(300, None), (301, ""), (302, " \t\n "), (303, "one"), (304, "\x0bé  é\té é é é é\n"), (304, "é é"), (304, "é é"), (None, "a a a a a a a b"), (305, "a\x1ca\x1ca\x1ca b " * 8)]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, runs int, collapsed string")
    have = sorted(map(tuple, run_report(docs).collect()), key=str)
    assert have == sorted((report(i, t) for i, t in rows), key=str)


def test_real_texts_against_contract(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect() if len(r.text or "") < 8000]
    have = {r.doc_id: tuple(r) for r in run_report(docs).collect()}
    assert len(have) == docs.count()
    assert all(have[i] == report(i, t) for i, t in rows)


def test_real_outputs_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "x " + "go on " * 5 + "and stop"), (2, None)], "doc_id long, text string")
    found = {r.doc_id: r for r in find_runs(docs).collect()}
    assert [tuple(r) for r in found[1].runs] == [(1, 10, 2)] and found[1].n_words == 13 and found[2].runs == []
    assert {r.doc_id: r.text for r in collapse(docs).collect()} == {1: "x go on and stop", 2: ""}
    assert run_report(docs.limit(0)).collect() == []


def test_blocks_do_not_change_results(spark, monkeypatch):
    import rivulet.llm.periodic_runs as m

    rng = random.Random(5)
    docs = [[f"w{x}".encode() for x in some_words(rng)] for _ in range(40)]
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(range(40), pa.int64()), pa.array([b" ".join(d).decode() for d in docs])], names=["doc_id", "text"])
    whole = pa.Table.from_batches(m._found(iter([batch]))).to_pylist()
    monkeypatch.setattr(m, "BLOCK_WORDS", 50)
    assert pa.Table.from_batches(m._found(iter([batch]))).to_pylist() == whole
