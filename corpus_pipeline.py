"""A corpus pipeline: quality, near-duplicates, repeated passages, personal data, packing.

Each stage takes the documents that the one before has kept, written as Parquet and read
again, and returns the same columns; the last returns packed pieces.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portfolio_ops.llm import minhash, packing, pii, quality, suffix
from portfolio_ops.llm.queries import BYTE_BPE, SURROGATE_KEY
from portfolio_ops.session import shared_dir
from portfolio_ops.sources.registry import read_table


def _measured(docs: DataFrame) -> DataFrame:
    """``n_chars`` follows a changed text."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) \
        if "n_chars" in docs.columns else docs


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score reaches 0.7; the model is fitted on labelled ones among ``docs``."""
    model = quality.train(docs, read_table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model, 0.7)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.keep_one(docs)


def repeated_passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _measured(suffix.remove_repeats_from_rows(docs))


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _measured(pii.scrub_rows(pii.checked(docs, SURROGATE_KEY), SURROGATE_KEY))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, BYTE_BPE, 1024)


STAGES = [
    ("quality classifier", quality_stage),
    ("near-duplicates", near_duplicate_stage),
    ("repeated passages", repeated_passage_stage),
    ("personal data", personal_data_stage),
    ("packing", packing_stage),
]
ORACLE_SQL = None  # scores, sketches, surrogates and tokens are not expressible in SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    folder = os.path.join(shared_dir(spark), "pipeline", uuid.uuid4().hex)
    for k, (_, stage) in enumerate(STAGES):
        path = os.path.join(folder, str(k))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
