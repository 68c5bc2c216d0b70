"""Exact global positions and running aggregates without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from toolgauge.session import settle


def in_pieces(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows cut along a total order into pieces of about equal size, numbered `_piece`.

    Where the cuts fall depends on a sample, so the numbers are stored with the rows.
    """
    return settle(rows.repartitionByRange(*order).withColumn("_piece", F.spark_partition_id()))


def running(
    pieces: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    sums: dict[str, Column] | None = None,
    highest: dict[str, Column] | None = None,
    until: int = 0,
) -> DataFrame:
    """Add running sums and maxima along `order` within each group, up to the row `until`.

    A group of any size is spread over its pieces: rows run within theirs, and one row per
    piece carries what the earlier ones add. `until` is 0 (inclusive) or -1 (exclusive).
    """
    steps = [(F.sum, name, column) for name, column in (sums or {}).items()]
    steps += [(F.max, name, column) for name, column in (highest or {}).items()]
    inside = Window.partitionBy(*group, "_piece").orderBy(*order).rowsBetween(Window.unboundedPreceding, until)
    before = Window.partitionBy(*group).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    earlier = pieces.groupBy(*group, "_piece").agg(
        *[step(column).alias(f"_{name}") for step, name, column in steps]
    ).select(*group, "_piece", *[step(f"_{name}").over(before).alias(f"_{name}") for step, name, _ in steps])
    joined = pieces.select("*", *[step(column).over(inside).alias(name) for step, name, column in steps]).join(
        earlier, [*group, "_piece"]
    )
    for step, name, _ in steps:
        if step is F.sum:
            both = F.coalesce(name, F.lit(0)) + F.coalesce(f"_{name}", F.lit(0))
        else:
            both = F.greatest(name, f"_{name}")
        joined = joined.withColumn(name, both).drop(f"_{name}")
    return joined


def dense_positions(
    rows: DataFrame,
    bucket: Sequence[str],
    order: Sequence[str | Column],
    name: str,
    total: str | None = None,
) -> DataFrame:
    """Number all rows 0..n-1 in the order of (bucket, order).

    `bucket` must cut the order into groups of bounded size. Rows are ranked inside
    their bucket; only one count per bucket passes through the running sum that
    turns these ranks into global ones. The order inside a bucket must be total.
    `total` names a further column with the number of all rows.
    """
    bucket = list(bucket)
    sizes = rows.groupBy(*bucket).agg(F.count("*").alias("_size"))
    before = Window.orderBy(*bucket).rowsBetween(Window.unboundedPreceding, -1)
    totals = [] if total is None else [F.sum("_size").over(Window.partitionBy()).alias(total)]
    offsets = sizes.select(
        *bucket, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"), *totals
    )
    inside = Window.partitionBy(*bucket).orderBy(*order)
    return (
        rows.withColumn("_rank", F.row_number().over(inside))
        .join(offsets, bucket)
        .withColumn(name, F.col("_offset") + F.col("_rank") - 1)
        .drop("_rank", "_offset")
    )
