"""The training-data pipeline: five stages from documents to packed sequences.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from rivulet.llm.common import drop_folder, table, use_checkpoint_dir
from rivulet.llm.minhash_dedup import keep_one
from rivulet.llm.mixing import resample
from rivulet.llm.packing import pack
from rivulet.llm.quality import keep_good
from rivulet.llm.secret_scan import redact


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five words, similarity 0.8 or more) one document stays."""
    return keep_one(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; the documents stay."""
    return redact(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeat, or go, until their sources have their target shares."""
    return resample(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row a piece: where in which sequence it lies."""
    return pack(docs)


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("secrets", secrets), ("mixing", mixing), ("packing", packing)]

#: Classifier, sketches and tokeniser have no SQL; tests/llm/test_pipeline.py compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; between stages the rows are written to the shared folder and read again.

    A stage's rows are deleted when the next one's are written; the last stage's stay, for the result to read. Null and
    empty texts, repeated rows, extra columns and empty tables are handled as each stage's module says.
    """
    folder = f"{use_checkpoint_dir(spark)}/pipeline-{uuid.uuid4()}"
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if k:
            drop_folder(spark, f"{folder}/{k - 1}-{STAGES[k - 1][0]}")
    return docs
