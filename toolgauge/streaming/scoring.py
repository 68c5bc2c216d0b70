"""Score predictions as they arrive.

Nothing here keeps state: examples are a table, predictions a stream, and scoring is
the same chain of columns as in batch. Where the results go is up to the caller.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from toolgauge.operators.scoring import score_calls


def score_stream(predictions: DataFrame, examples: DataFrame) -> DataFrame:
    """Scored rows of a stream of (ord, predicted) against the table of examples."""
    return score_calls(predictions.join(examples, "ord"))
