"""Importance resampling against the contract written out in Python, on small tables with odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

import rivulet.llm.importance_resampling as m
from rivulet.llm.importance_resampling import draw, feature_counts, importance_report, joined_crc, resample, weigh

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return len(w), [" ".join(w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def bucket(f):
    return zlib.crc32(f.encode()) % 10000


def plain(docs, target):
    s, t = (Counter(bucket(f) for x in texts for f in features(x)[1]) for texts in ([x for _, x in docs], target))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log(((t[b] + 1) * (all_s + 10000)) / ((s[b] + 1) * (all_t + 10000))))
    rows = []
    for i, x in docs:
        n, f = features(x)
        weight = sum(gain(bucket(y)) for y in f)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    may = sorted((r for r in rows if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(may[: 5 * len(may) // 100]):
        r[4] = k + 1
    return [tuple(r[:5]) for r in rows]


def some_docs():
    rng = random.Random(11)
    words = [rng.choice(["the", "of", "Straße", "É", "naïve", "x", "42", "0b", " ", "日本"]) + rng.choice(["", "a", "BC", "ö"]) for _ in range(60)]
    text = lambda n: "".join(rng.choice(words) + rng.choice([" ", "\n", "-", "'s ", "; ", "\x7f"]) for _ in range(n))
    docs = [(k, text(rng.randint(0, 60))) for k in range(400)]
    docs += [(400, None), (401, ""), (402, "..."), (403, text(5000)), (404, "z" * 70000 + " y " + "q" * 200 + " y"), (405, docs[3][1]), (3, docs[3][1]), (None, docs[5][1])]
    return docs, [text(30) for _ in range(20)] + [None, ""]


def test_crc_of_joined_parts():
    rng = random.Random(1)
    data = lambda sizes: [rng.randbytes(rng.choice(sizes)) for _ in range(150)]
    a, b = data([0, 1, 5, 64, 5000]), data([0, 1, 5, 63, 64, 65, 127, 128, 200, 70000])
    crc = lambda xs: np.array([zlib.crc32(x) for x in xs], np.uint32)
    got = joined_crc(crc(a), crc(b), np.array([len(x) for x in b], np.int64))
    assert got.tolist() == [zlib.crc32(x + y) for x, y in zip(a, b, strict=True)]


def test_report_against_contract(spark):
    docs, target = some_docs()
    d = spark.createDataFrame([(i, x, 1, "s") for i, x in docs], "doc_id long, text string, rank int, range string").repartition(5)
    t = spark.createDataFrame([(x,) for x in target], "text string")
    assert sorted(map(tuple, importance_report(d, t).collect()), key=str) == sorted(plain(docs, target), key=str)


def test_real_tables_against_contract(spark, small):
    d, t = spark.read.parquet(f"{small}/documents.parquet"), spark.read.parquet(f"{small}/benchmark.parquet")
    want = plain([(r.doc_id, r.text) for r in d.collect()], [r.text for r in t.collect()])
    assert sorted(map(tuple, importance_report(d, t).collect()), key=str) == sorted(want, key=str)


def test_ranks_do_not_depend_on_ranges(spark, monkeypatch):
    docs, target = some_docs()
    d, t = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(x,) for x in target], "text string")
    w = weigh(d, t)
    monkeypatch.setattr(m, "RANGE_ROWS", 10)
    rows = [(r.score, r.doc_id, r["rank"]) for r in draw(w, percent=50).collect() if r["rank"]]
    rows.sort(key=lambda r: r[2])
    assert [r[2] for r in rows] == list(range(1, len(rows) + 1))
    assert rows == sorted(rows, key=lambda r: (-r[0], r[1] is None, r[1] or 0))


def test_blocks_do_not_change_counts(monkeypatch):
    docs, _ = some_docs()
    batch = pa.RecordBatch.from_arrays([pa.array([i for i, _ in docs]), pa.array([x for _, x in docs])], names=["a", "b"])
    count = lambda: next(m._counted(10000, 3)(iter([batch]))).to_pylist()
    whole = count()
    want = Counter(bucket(f) for _, x in docs for f in features(x)[1])
    assert {r["bucket"]: r["n"] for r in whole} == dict(want)
    monkeypatch.setattr(m, "BLOCK_WORDS", 40)
    monkeypatch.setattr(m, "KNOWN_WORDS", 10)
    assert count() == whole


def test_drawn_documents_and_empty_tables(spark):
    docs, target = some_docs()
    d, t = spark.createDataFrame([(i, x, 7) for i, x in docs], "doc_id long, text string, drawn_id int"), spark.createDataFrame([(x,) for x in target], "text string")
    ids = {r.doc_id for r in draw(weigh(d, t)).where("rank is not null").collect()}
    have = resample(d, t)
    assert have.columns == d.columns and {r.doc_id for r in have.collect()} == ids and len(ids) > 5
    assert importance_report(d.limit(0), t).collect() == []
    assert len(importance_report(d, t.limit(0)).collect()) == len(docs)
    assert feature_counts(d.limit(0)).collect() == []
