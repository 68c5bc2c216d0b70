"""Toxicity: FTRL-proximal logistic regression over hashed n-grams and skip-grams.

Defined results: null text is empty text and gets the score of the constant term, as does
a text without words. A null doc_id stays null and is not held out; labels without a
doc_id or value are left out, and of several for one doc_id the largest counts. Rows that
repeat get equal scores. Without a labelled row all scores are 0.5. An empty table gives an
empty result. Columns besides doc_id and text are not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from toolgauge.llm import ftrl, rows

THRESHOLD = 0.5
SETTINGS = ftrl.Settings(ftrl.Grams(lower=True, pairs=(1, 2, 3)), alpha=1.0, l1=10.0, balance=0.5, calibrate=5)


def fit(docs: DataFrame, labels: DataFrame) -> dict[int, float]:
    return ftrl.fit(rows.texts(docs), labels, "toxic", ~ftrl.held_out(0, 5), SETTINGS)


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of `docs`: doc_id, held_out, score, predicted."""
    found = ftrl.scored(rows.texts(docs), fit(docs, labels), SETTINGS.grams)
    return found.select(
        "doc_id",
        ftrl.held_out(0, 5).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs`, all columns, that are not predicted to be toxic; all without a model."""
    weights = fit(docs, labels)
    return ftrl.without(docs, weights, SETTINGS.grams, THRESHOLD) if weights else docs
