"""Registered queries of the training-data operators, with production parameters over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.llm.common import table, use_checkpoint_dir
from rivulet.llm.embedding_dedup import near_vectors
from rivulet.llm.html_extract import extract
from rivulet.llm.importance_resampling import importance_report
from rivulet.llm.minhash_dedup import near_duplicates
from rivulet.llm.mixing import taken
from rivulet.llm.packing import pack
from rivulet.llm.periodic_runs import run_report
from rivulet.llm.quality import classify
from rivulet.llm.secret_scan import scan
from rivulet.llm.sharding import assignments, shard_documents
from rivulet.llm.suffix_dedup import dedup_substrings
from rivulet.llm.topk import top_k
from rivulet.llm.toxicity import score_toxicity


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_substrings(table(spark, sf_dir, "documents"))


def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), width=2)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taken(table(spark, sf_dir, "documents"))


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op6_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{use_checkpoint_dir(spark)}/shards-{uuid.uuid4()}"
    return assignments(shard_documents(table(spark, sf_dir, "documents"), path))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_report(table(spark, sf_dir, "documents"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    ops = (op1_secret_scan, op2_suffix_dedup, op3_minhash_dedup, op4_mixing, op5_embedding_dedup, op6_html_extract, op7_sharding, op8_packing, op9_topk, op10_quality, op11_periodic_runs, op12_toxicity, op13_importance_resampling)
    return {f.__name__: f for f in ops} | {"pipeline": corpus_pipeline.run}


_TOPK = """
WITH v AS (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
         CAST(list_sum([a.q[i] * b.q[i] FOR i IN range(1, len(a.q) + 1)]) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
  WHERE a.vec_id % 50 = 0
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


#: The table of CRC-32, by its rule, and one byte's step.
_CRC_TABLE = """(SELECT list(c ORDER BY b) FROM (
    SELECT b, list_reduce(list_prepend(b, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) t(b)))"""
_CRC_STEP = "lambda c, b: xor(c >> 8, tab[1 + (xor(c, b) & 255)])"

#: Runs: equal words at each distance, gaps and islands, the smallest period of each stretch.
_RUNS = f"""
WITH crc AS (SELECT {_CRC_TABLE} AS tab),
d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
         xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, [ascii(c)::BIGINT FOR c IN string_split(doc_id::VARCHAR, '')]), {_CRC_STEP})) AS h
  FROM documents, crc
), e AS (
  SELECT r, doc_id, w, len(w) AS n, h % 10 = 0 AND len(w) > 0 AS periodic, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a,
         3 + (h // 10) % 8 AS parts
  FROM d
), f AS (
  SELECT r, doc_id, n, CASE WHEN periodic THEN [w[CASE WHEN i < a THEN i + 1 ELSE a + (i - a) % (1 + (n - a) // parts) + 1 END] FOR i IN range(n)] ELSE w END AS w FROM e
), t AS (
  SELECT r, n, unnest(w) AS word, unnest(range(n)) AS i FROM f
), pairs AS (
  SELECT x.r, x.i, y.i - x.i AS q FROM t x JOIN t y ON x.r = y.r AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n
), islands AS (
  SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS g FROM pairs
), stretches AS (
  SELECT r, min(i) AS s, q + count(*) AS m, q FROM islands GROUP BY r, q, g HAVING q + count(*) >= greatest(6, 4 * q)
), runs AS (
  SELECT r, s, m, min(q) AS q FROM stretches GROUP BY r, s, m
), lines AS (
  SELECT r, count(*) AS n_runs, string_agg(s || ',' || m || ',' || q || chr(10), '' ORDER BY s, q) AS lines,
         list({{'s': s, 'm': m, 'q': q}} ORDER BY m / q DESC, s, q)[1] AS top
  FROM runs GROUP BY r
), dropped AS (
  SELECT DISTINCT r, unnest(range(s + q, s + m)) AS i FROM runs
), kept AS (
  SELECT t.r, string_agg(word, ' ' ORDER BY t.i) AS kept FROM t ANTI JOIN dropped ON t.r = dropped.r AND t.i = dropped.i GROUP BY t.r
)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, top.s::BIGINT AS start, top.m::BIGINT AS length, top.q::BIGINT AS period,
       (1000 * top.m // top.q)::BIGINT AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM f LEFT JOIN lines USING (r) LEFT JOIN kept USING (r)
"""


#: Importance: distinct n-grams get their CRC from that of the n-gram a word shorter.
_IMPORTANCE = f"""
WITH crc AS (SELECT {_CRC_TABLE} AS tab),
d AS (
  SELECT 'd' AS side, row_number() OVER () AS r, doc_id, text FROM documents UNION ALL SELECT 't', row_number() OVER (), NULL, text FROM benchmark
), e AS (
  SELECT side, r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM d
), t AS (
  SELECT side, r, unnest(w) AS a, unnest(range(len(w))) AS i FROM e
), o AS (
  SELECT side, r, a, lead(a) OVER p AS b, lead(a, 2) OVER p AS c FROM t WINDOW p AS (PARTITION BY side, r ORDER BY i)
), words AS (
  SELECT a AS w, hex(encode(a)) AS h FROM (SELECT DISTINCT a FROM o)
), bytes AS (
  SELECT w, [(16 * (instr('0123456789ABCDEF', substr(h, 2 * k + 1, 1)) - 1) + instr('0123456789ABCDEF', substr(h, 2 * k + 2, 1)) - 1)::BIGINT FOR k IN range(len(h) // 2)] AS y FROM words
), one AS (
  SELECT w AS a, list_reduce(list_prepend(4294967295::BIGINT, y), {_CRC_STEP}) AS st FROM bytes, crc
), two AS (
  SELECT g.a, g.b, list_reduce([one.st, 32::BIGINT] || y, {_CRC_STEP}) AS st
  FROM (SELECT DISTINCT a, b FROM o WHERE b IS NOT NULL) g JOIN one USING (a) JOIN bytes ON w = g.b, crc
), three AS (
  SELECT g.a, g.b, g.c, list_reduce([two.st, 32::BIGINT] || y, {_CRC_STEP}) AS st
  FROM (SELECT DISTINCT a, b, c FROM o WHERE c IS NOT NULL) g JOIN two USING (a, b) JOIN bytes ON w = g.c, crc
), f AS (
  SELECT side, r, st FROM o JOIN one USING (a) UNION ALL SELECT side, r, st FROM o JOIN two USING (a, b) UNION ALL SELECT side, r, st FROM o JOIN three USING (a, b, c)
), g AS (
  SELECT side, r, xor(st, 4294967295) % 10000 AS bucket FROM f
), n AS (
  SELECT bucket, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 't') AS t FROM g GROUP BY bucket
), gains AS (
  SELECT bucket, floor(1000 * ln(((t + 1) * (sum(s) OVER () + 10000))::DOUBLE / ((s + 1) * (sum(t) OVER () + 10000))::DOUBLE))::BIGINT AS gain FROM n
), weights AS (
  SELECT r, count(*) AS n_features, sum(gain)::BIGINT AS weight FROM g JOIN gains USING (bucket) WHERE side = 'd' GROUP BY r
), scored AS (
  SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
         coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM e LEFT JOIN weights USING (r) WHERE side = 'd'
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS LAST) AS k, count(*) FILTER (n_words >= 20) OVER () AS n FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND k <= 5 * n // 100 THEN k END AS rank FROM ranked
"""


def oracle_sql() -> dict[str, str]:
    import corpus_pipeline

    sql = {"op9_topk": _TOPK, "op11_periodic_runs": _RUNS, "op13_importance_resampling": _IMPORTANCE}
    if corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return sql
