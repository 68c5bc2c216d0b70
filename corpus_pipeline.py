"""From raw documents to packed training sequences, in five stages.

Each stage works on all rows that its predecessor kept and is written as Parquet before the
next one reads it. The first four return the columns of documents; the last returns one row
per packed piece.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from toolgauge.llm import exact_dedup, minhash, packing, rows, toxicity, weak_rules
from toolgauge.llm.queries import tokenizer_path
from toolgauge.session import noted_tables, remove_tables, shared_folder

# Tables in the shared folder behind the last stage's result, by session.
_behind: dict[str, list[str]] = {}


def _stage(stage):
    """A stage that removes what the one before it left in the shared folder.

    A stage is given its predecessor's result as it was written. Nothing reads the tables
    behind that any more, unless the documents given come from them; then they stay.
    """

    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        session = spark.sparkContext.applicationId
        left = _behind.pop(session, [])
        names = [path.rsplit("/", 1)[-1] for path in left]
        if left and not any(name in file for file in docs.inputFiles() for name in names):
            remove_tables(spark, left)
        with noted_tables() as paths:
            result = stage(spark, docs, sf_dir)
        _behind[session] = paths
        return result

    run_stage.__name__, run_stage.__doc__ = stage.__name__, stage.__doc__
    return run_stage


@_stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighed rules accept."""
    return weak_rules.keep_good(docs)


@_stage
def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, trained on those that came here, lets pass."""
    return toxicity.keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


@_stage
def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of equal texts."""
    return exact_dedup.keep_first(docs)


@_stage
def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: shingles of five words, 0.8 similar."""
    return minhash.keep_one(docs, percent=80, words=5)


@_stage
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents that are left, with their sequences."""
    return packing.pack_documents(rows.texts(docs), tokenizer_path("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("toxicity", without_toxic),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("packing", packed),
]

# Near-duplicate search, tokens and trained models are beyond SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline/{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
