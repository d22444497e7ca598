import re
from collections import Counter, defaultdict

import duckdb
import pytest

import corpus_pipeline
from rivulet.llm import queries as llm_queries
from rivulet.llm.packing import WordIds, cuts, default_tokenizer
from rivulet.llm.quality import classify
from tests.llm.test_minhash_dedup import brute as near_brute
from tests.llm.test_mixing import want_targets
from tests.llm.test_secret_scan import base


def test_stages_against_brute_force(spark, small):
    """Each stage on what the one before it kept: quality by its own decisions, the rest by plain Python."""
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "secrets", "mixing", "packing"]
    docs = spark.read.parquet(f"{small}/documents.parquet")
    out, kept = [docs], docs
    for _, stage in corpus_pipeline.STAGES:
        kept = stage(spark, kept, small).cache()
        out.append(kept)
    assert all(o.columns == docs.columns for o in out[:-1])
    rows = [{r.doc_id: r for r in o.collect()} for o in out[:-1]]

    good = {r.doc_id for r in classify(docs, spark.read.parquet(f"{small}/labels.parquet")).where("kept").collect()}
    assert set(rows[1]) == good and all(rows[1][d] == rows[0][d] for d in good)
    assert set(rows[2]) == {d for d, _, c, k in near_brute([(d, r.text) for d, r in rows[1].items()], 5) if k}
    assert set(rows[3]) == set(rows[2])
    for d, r in rows[2].items():
        new = rows[3][d]
        if not base(r.text) and "[secret]" not in new.text:
            assert new == r
        else:
            assert new.n_chars == len(new.text) and (new.lang, new.source) == (r.lang, r.source)
            assert not [s for s in base(new.text) if s[2] != "assign"]
    size, target = want_targets([(d, r.text, r.source) for d, r in rows[3].items()])
    got = Counter()
    copies = Counter(r.doc_id for r in out[4].collect())
    for d, n in copies.items():
        assert n <= 3
        got[rows[3][d].source] += n * len(re.findall(r"[^\x20\x09-\x0D]+", rows[3][d].text or ""))
    longest = Counter()
    for r in rows[3].values():
        longest[r.source] = max(longest[r.source], len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")))
    assert all(abs(got[s] - target[s]) <= longest[s] / 2 + 1 for s in size)
    ids = WordIds(default_tokenizer())
    pieces = defaultdict(list)
    for r in out[5].collect():
        pieces[r.doc_id].append(r.length)
    for d, n in copies.items():
        assert sorted(pieces[d]) == sorted(cuts(len(ids([rows[3][d].text or ""])[0]) // 4 + 1) * n)
    assert set(pieces) == set(copies)


def test_run(spark, small):
    out = corpus_pipeline.run(spark, small)
    assert out.count() > 0 and out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] and out.count() > 100


def test_registered_queries_and_sql(spark, small):
    q = llm_queries.queries()
    assert {n.split("_")[0] for n in q} == {f"op{k}" for k in range(1, 11)} | {"pipeline"}
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels"):
        con.sql(f"create view {t} as select * from read_parquet('{small}/{t}.parquet')")
    for name, sql in llm_queries.oracle_sql().items():
        cur = con.execute(sql)
        names = [d[0] for d in cur.description]
        got = q[name](spark, small)
        assert sorted(got.columns) == sorted(names)
        assert sorted(tuple(r[c] for c in names) for r in got.collect()) == sorted(cur.fetchall())


@pytest.mark.parametrize("name", ["op1_secret_scan", "op4_mixing", "op7_sharding"])
def test_native_plans_have_no_python(spark, small, name):
    plan = llm_queries.queries()[name](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_stages_on_odd_rows_and_clashing_columns(spark, small):
    """Nulls in any column, empty texts, repeated rows and columns with the operators' own names."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, spans string, copies int, lap int, shard string, found string"
    words = " ".join(f"plain{k}" for k in range(40))
    rows = [(1, words, "en", "a", 10, "s", 1, 1, "x", "f"), (1, words, "en", "a", 10, "s", 1, 1, "x", "f"), (None, words + " more", None, None, None, None, None, None, None, None), (3, None, "en", "a", 0, "", 1, 1, "", ""), (4, "", None, "b", 0, "", 1, 1, "", ""), (5, words + " token=abcdef123", "en", "b", 5, "", 1, 1, "", "")]
    docs = spark.createDataFrame(rows, schema)
    for table_ in (docs, docs.where("false")):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, table_, small)
            n = out.count()
            assert name == "packing" or out.columns == docs.columns
            assert table_ is docs or n == 0
