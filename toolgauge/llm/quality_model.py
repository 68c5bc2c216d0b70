"""Quality: logistic regression over hashed word n-grams, trained by FTRL.

Besides words and word pairs there are n-grams of word shapes and the share of repeated
word pairs, both in buckets: they tell junk made of words that training never saw.

Defined results: as in the toxicity model.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from toolgauge.llm import ftrl, rows

THRESHOLD = 0.7
SETTINGS = ftrl.Settings(ftrl.Grams(lower=False, pairs=(1,), shapes=3, repeats=True), alpha=0.3, l1=2.0)


def fit(docs: DataFrame, labels: DataFrame) -> dict[int, float]:
    return ftrl.fit(rows.texts(docs), labels, "quality", ~ftrl.held_out(2, 4), SETTINGS)


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of `docs`: doc_id, held_out, score, predicted."""
    found = ftrl.scored(rows.texts(docs), fit(docs, labels), SETTINGS.grams)
    return found.select(
        "doc_id",
        ftrl.held_out(2, 4).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
