import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from rivulet.llm import suffix_dedup
from rivulet.llm.suffix_dedup import COVERS, dedup_substrings

SCHEMA = "doc_id long, text string"


def brute(rows, length):
    seen, cover = set(), {}
    texts = [(d, (t or "").encode()) for d, t in sorted(rows, key=lambda r: r[0])]
    out = {}
    for d, b in texts:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            g = b[i : i + length]
            if g in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(g)
        kept = bytes(x for x, m in zip(b, gone) if not m)
        spans = sum(1 for i, m in enumerate(gone) if m and not (i and gone[i - 1]))
        out[d] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def got(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()}


def test_covers():
    for p, d in COVERS.items():
        assert {(a - b) % p for a in d for b in d} == set(range(p))


def test_real_documents(spark, small):
    df = spark.read.parquet(f"{small}/documents.parquet").repartition(7)
    rows = [(r.doc_id, r.text) for r in df.collect()]
    want = brute(rows, 100)
    assert sum(w[1] for w in want.values()) > 10_000
    assert got(dedup_substrings(df)) == want


@pytest.mark.parametrize("block", [300, 5000])
def test_small_blocks_ties_and_long_texts(spark, monkeypatch, block):
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", block)
    monkeypatch.setattr(suffix_dedup, "BUCKET_KEYS", 64)
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 400)
    base = "The quick brown fox jumps over the lazy dog while counting 0123456789 stars in the night sky, twice. "
    rows = [
        (9, base * 12),
        (3, "x" * 700),
        (4, None),
        (5, ""),
        (6, "short"),
        (7, base[:99]),
        (8, "é" * 130 + base),
        (1, base + "tail"),
        (2, "head" + base[1:] + "ü" * 60 + "x" * 150),
        (10, "a" + base * 3 + "b" + "é" * 80),
    ]
    df = spark.createDataFrame([(*r, "other") for r in rows], SCHEMA + ", bucket string").repartition(3)
    assert got(dedup_substrings(df)) == brute(rows, 100)


def test_kept_text_and_other_length(spark):
    rows = [(1, "abcdefghijklmnopqrstuvwxyz"), (2, "__efghijklmnopqrst__"), (3, "zz")]
    df = spark.createDataFrame(rows, SCHEMA)
    out = {r.doc_id: r for r in dedup_substrings(df, length=16, keep_text=True).collect()}
    assert bytes(out[2].kept) == b"____" and out[2].spans == "2:18" and out[1].n_removed == 0


def test_repeated_rows_and_empty_table(spark):
    text = "0123456789" * 11
    df = spark.createDataFrame([(1, text), (1, text)], SCHEMA)
    assert sorted(r.n_removed for r in dedup_substrings(df).collect()) == [100, 110]
    assert dedup_substrings(df.where("false")).collect() == []


def test_a_common_line_among_different_neighbours_is_spread(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 4000)
    rng = random.Random(3)
    line = "This line, of eighty bytes, is that of a licence which many of the documents hold."[:80]
    rows = [(k, "".join(rng.choices("abcdefgh ", k=150)) + line + "".join(rng.choices("abcdefgh ", k=150))) for k in range(400)]
    rows += [(1000 + k, "x" + rows[k][1][100:300] + "y") for k in range(20)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(8)

    def largest():
        starts = Counter()
        for r in suffix_dedup._dealt(*suffix_dedup._blocks(df), 8, 100)[1].collect():
            starts[r.bucket] += sum(np.frombuffer(r.starts, np.int64).reshape(4, -1)[3])
        return max(starts.values()) / sum(starts.values())

    assert largest() < 0.1
    assert got(dedup_substrings(df)) == brute(rows, 100)
    monkeypatch.setattr(suffix_dedup, "HOT", 1 << 40)  # without the count
    assert largest() > 0.2


def test_suffixes_are_in_order_of_their_bytes():
    rng = np.random.default_rng(7)
    texts = [rng.integers(0, k, n).astype(np.uint8) for k, n in ((1, 40), (2, 300), (2, 2000), (4, 3000), (256, 500), (1, 1000))]
    texts.append(np.frombuffer(b"banana split " * 60 + b"\0" * 30 + b"banana split " * 3, np.uint8))
    for buf in texts:
        whole = buf.tobytes()
        where = np.arange(len(buf) - 8)
        order, like = suffix_dedup.suffix_order(buf, where, len(buf))
        assert where[order].tolist() == sorted(where.tolist(), key=lambda p: whole[p:])
        assert like.tolist() == [k > 0 and whole[order[k] :][:8] == whole[order[k - 1] :][:8] for k in range(len(order))]
        some = rng.permutation(where)[: len(where) // 3]
        order, _ = suffix_dedup.suffix_order(buf, some, len(buf))
        assert some[order].tolist() == sorted(some.tolist(), key=lambda p: whole[p:])
        order, _ = suffix_dedup.suffix_order(buf, some[some < len(buf) - 20], 20)
        cut = [whole[p : p + 20] for p in some[some < len(buf) - 20][order]]
        assert cut == sorted(cut)
        # Ranks of the cover's positions, the last ones too, follow the order of their suffixes.
        words = np.ndarray((len(buf),), ">u8", np.r_[buf, np.zeros(8, np.uint8)], strides=(1,)).astype(np.uint64)
        ranks = suffix_dedup.cover_ranks(buf, words, len(buf))
        cover = [p for p in range(len(buf)) if p % 7 in COVERS[7]]
        assert sorted(cover, key=lambda p: ranks[p]) == sorted(cover, key=lambda p: whole[p:]) and len({ranks[p] for p in cover}) == len(cover)
