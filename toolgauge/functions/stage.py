"""Keep an expensive column from being computed more than once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def computed(rows: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that later filters and projections read but never re-evaluate.

    A plain `withColumn` is only a name: Catalyst pushes a filter on it below the
    projection by repeating its expression, and a parse may end up running many
    times per row. Generator output is not pushed through, so one-element arrays of
    structs pin the evaluation without a shuffle or a cache.
    """
    packed = F.array(F.struct(*[column.alias(name) for name, column in columns.items()]))
    return rows.select("*", F.inline_outer(packed))
