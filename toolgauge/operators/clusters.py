"""Summaries and labels of failure clusters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# The label of noise and of failure sets too small to cluster.
NOISE = -1
NOISE_LABEL = "noise_outliers"
GENERAL_LABEL = "general_failures"


def cluster_label(cluster_id: Column, dominant_error: Column) -> Column:
    return F.when(cluster_id == NOISE, NOISE_LABEL).otherwise(
        F.concat(F.lit("Cluster_"), cluster_id.cast("string"), F.lit("_"), dominant_error)
    )


def summarise(members: DataFrame, *keys: str) -> DataFrame:
    """One row per cluster: label, size and place of its first member.

    Membership stays long, so a noise cluster of any size is only ever counted. The
    most frequent error names the cluster; the lowest name wins a tie.
    """
    return (
        members.groupBy(*keys, "cluster_id")
        .agg(
            F.count("*").alias("size"),
            F.min("ord").alias("cluster_ord"),
            F.mode("error_type", deterministic=True).alias("dominant_error"),
        )
        .withColumn("label", cluster_label(F.col("cluster_id"), F.col("dominant_error")))
        .select(*keys, "cluster_id", "label", "size", "cluster_ord")
    )


def handled(summary: DataFrame, *keys: str) -> DataFrame:
    """Labels with the order in which clusters are patched: first appearance first.

    Kept as rows; there are as many clusters as the data has, so no single array.
    """
    return summary.select(*keys, "cluster_ord", "cluster_id", "label")
