import re
from collections import Counter, defaultdict

import pytest

from rivulet.llm.mixing import mix, resample, sized, taken

SCHEMA = "doc_id long, text string, source string, size string"


def want_targets(rows):
    size = defaultdict(int)
    for _, t, s in rows:
        size[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    names = sorted([s for s in size if s is not None], key=lambda s: [ord(c) for c in s]) + [None] * (None in size)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    target, fixed, total = {}, set(), sum(size.values())
    while True:
        free = [s for s in names if s not in fixed]
        left = total - sum(3 * size[s] for s in fixed)
        target = {s: 3 * size[s] for s in fixed} | {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if target[s] > 3 * size[s] * (1 + 1e-12)}
        if not over:
            return size, target
        fixed |= over


def check(spark, rows, near):
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).repartition(3)
    size, target = want_targets(rows)
    out = taken(df).collect()
    assert sorted((r.doc_id, r.size) for r in out) == sorted((d, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for d, t, _ in rows)
    got = Counter()
    for r in out:
        assert r.source_size == size[r.source] and abs(r.target - target[r.source]) < 1e-6 * max(1, r.target)
        assert 0 <= r.taken <= 3 * r.size
        got[r.source] += r.taken
    for s in size:
        assert abs(got[s] - target[s]) <= near + 0.01 * target[s], (s, got[s], target[s])
    again = taken(df.repartition(2)).collect()
    assert Counter(map(tuple, out)) == Counter(map(tuple, again))


def test_shares_caps_nulls_and_repeats(spark):
    rows = [(i, "w " * (1 + i % 50), f"s{i % 4}") for i in range(300)]
    rows += [(1000 + i, "a\tb\x0bc é x", None) for i in range(40)]
    rows += [(5000, "hot " * 9000, "s0"), (5001, None, "s1"), (5002, "", "é"), (5003, " \n", "Z"), (7, "w w", "s3"), (7, "w w", "s3")]
    check(spark, rows, 8)


def test_tiny_and_empty(spark):
    check(spark, [(1, "one", "a"), (2, "two words", None)], 3)
    check(spark, [(1, "", "a"), (2, None, None)], 0)
    assert taken(spark.createDataFrame([], SCHEMA)).collect() == []


def test_real_documents_schedule_and_resample(spark, small):
    df = spark.read.parquet(f"{small}/documents.parquet")
    rows = [(r.doc_id, r.text, r.source) for r in df.collect()]
    check(spark, rows, 6)
    targets, pieces = mix(sized(df), block=16)
    share = {r.sid: r.target for r in targets.collect()}
    ps = sorted(pieces.collect(), key=lambda r: r.slot)
    half = Counter()
    for p in ps[: len(ps) // 2]:
        half[p.sid] += p.length
    done = sum(half.values())
    for s, t in share.items():
        assert abs(half[s] / done - t / sum(share.values())) < 0.01
    out = resample(df)
    assert out.columns == df.columns
    n = Counter(r.doc_id for r in out.collect())
    t = {r.doc_id: r for r in taken(df).collect()}
    assert all(n[d] == int(r.taken / max(1, r.size) + 0.5) for d, r in t.items())


@pytest.mark.parametrize("total", [80_000_000, 5_000_000_000])
def test_small_sources_meet_their_targets_in_large_corpora(spark, total):
    rows = [(k, f"s{k % 3}", total // 900) for k in range(900)]
    for k, n in enumerate((1, 7, 100, 500, 5000, 20_000)):
        rows += [(1000 + 10 * k + j, f"tiny{k}", m) for j, m in enumerate((n - n // 3, n // 3)) if m]
    targets, pieces = mix(spark.createDataFrame(rows, "doc_id long, source string, size long"))
    got = Counter({r.sid: r.n for r in pieces.groupBy("sid").agg({"length": "sum"}).withColumnRenamed("sum(length)", "n").collect()})
    for r in targets.collect():
        assert abs(got[r.sid] - r.target) <= 0.5, (r, got[r.sid])
    assert pieces.where("start < 0 or length < 1 or start + length > size").count() == 0
    slots = pieces.select("slot", "sid").distinct()
    assert slots.count() == slots.agg({"slot": "max"}).first()[0] + 1


def test_null_ids_and_clashing_names(spark):
    rows = [(None, "a b c", "s", 1, 2), (None, "d e", "s", 3, 4), (2, "x", None, 5, 6), (3, None, "t", 7, 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, copies int, lap int")
    size, target = want_targets([r[:3] for r in rows])
    got = Counter()
    for r in taken(df).collect():
        got[r.source] += r.taken
    assert all(abs(got[s] - target[s]) <= 1 for s in size)
    out = resample(df)
    assert out.columns == df.columns and {r.source for r in out.collect()} == {"s", None}
    assert sum(len(r.text.split()) for r in out.collect()) == 6


def test_resampled_sources_are_off_by_half_a_document_at_most(spark):
    rows = [(k, "w " * (1 + k * 37 % 90), f"s{k % 5}") for k in range(400)]
    size, target = want_targets(rows)
    got, longest = Counter(), Counter()
    for r in resample(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect():
        got[r.source] += len(r.text.split())
    for d, t, s in rows:
        longest[s] = max(longest[s], len(t.split()))
    assert all(abs(got[s] - target[s]) <= longest[s] / 2 + 1 for s in size)


def test_blocks_have_one_length_whatever_the_corpus(spark):
    for n in (50, 5000):
        rows = [(k, f"s{k % 2}", 100) for k in range(n)]
        _, pieces = mix(spark.createDataFrame(rows, "doc_id long, source string, size long"), block=256)
        by_slot = [r.n for r in pieces.groupBy("slot", "sid").agg({"length": "sum"}).withColumnRenamed("sum(length)", "n").collect()]
        assert max(by_slot) == 256 and sum(x < 256 for x in by_slot) <= 2
