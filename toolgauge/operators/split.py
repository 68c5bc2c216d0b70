"""Repeatable shuffle and exact train/eval split."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from toolgauge.operators.ranking import dense_positions

# Hex digits of the hash that name a bucket: 16^4 = 65,536 buckets.
BUCKET_DIGITS = 4


def shuffled_positions(examples: DataFrame, key: str, seed: int = 0) -> DataFrame:
    """Add the row's place `shuffled` in hash order and the number of rows, `_total`.

    `key` must be unique (a position, not an id: ids repeat), so the hash spreads
    rows evenly over the buckets whatever they contain, and retries agree.
    """
    hashed = examples.withColumn(
        "shuffle_hash", F.md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string")))
    ).withColumn("_bucket", F.left("shuffle_hash", F.lit(BUCKET_DIGITS)))
    placed = dense_positions(hashed, ["_bucket"], ["shuffle_hash", key], "shuffled", "_total")
    return placed.drop("_bucket", "shuffle_hash")


def split_examples(
    examples: DataFrame, key: str, ratio: float = 0.8, seed: int = 0
) -> DataFrame:
    """First floor(n * ratio) shuffled rows are 'train', the rest 'eval', with dense ids."""
    cut = F.floor(F.col("_total").cast("double") * F.lit(float(ratio)))
    return (
        shuffled_positions(examples.drop("id"), key, seed)
        .withColumn("_cut", cut)
        .withColumn("split", F.when(F.col("shuffled") < F.col("_cut"), "train").otherwise("eval"))
        .withColumn(
            "id",
            F.when(
                F.col("split") == "train",
                F.concat(F.lit("train_"), F.col("shuffled").cast("string")),
            ).otherwise(
                F.concat(F.lit("eval_"), (F.col("shuffled") - F.col("_cut")).cast("string"))
            ),
        )
        .drop("_cut", "_total", "shuffled")
    )
