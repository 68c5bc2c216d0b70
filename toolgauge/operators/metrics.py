"""Accuracy, run history, progress and the stop rule.

`keys` names the columns that identify one evaluation, e.g. ('run_id',
'iteration'); without keys the whole table is one evaluation. All aggregations
here have partial forms, so a hot tool or run costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from toolgauge.session import settle


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def overall_accuracy(scored: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Share of correct rows, 0.0 for an empty evaluation, with the failure count."""
    return (
        scored.groupBy(*keys)
        .agg(F.count("*").alias("total"), F.count_if("is_correct").alias("correct"))
        .select(
            *keys,
            "total",
            "correct",
            (F.col("total") - F.col("correct")).alias("failure_count"),
            _ratio(F.col("correct"), F.col("total")).alias("overall_accuracy"),
        )
    )


def tool_counts(scored: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return scored.groupBy(*keys, "tool").agg(
        F.count("*").alias("total"), F.count_if("is_correct").alias("correct")
    )


def per_tool_accuracy(scored: DataFrame, catalog: DataFrame) -> DataFrame:
    """One row per tool: catalog tools without rows report 0.0, others are added."""
    known = catalog.select(F.col("name").alias("tool")).distinct()
    return known.join(tool_counts(scored), "tool", "full").select(
        "tool",
        F.coalesce("total", F.lit(0)).alias("total"),
        F.coalesce("correct", F.lit(0)).alias("correct"),
        _ratio(F.col("correct"), F.col("total")).alias("accuracy"),
    )


def tool_history(
    scored: DataFrame, catalog: DataFrame, keys: Sequence[str] = ("run_id", "iteration")
) -> DataFrame:
    """`per_tool_accuracy` for every evaluation, one row per evaluation and tool.

    Kept long, like the run log. Rows are scored and counted once; all else reads the counts.
    """
    return history_of_counts(settle(tool_counts(scored, keys)), catalog, keys)


def history_of_counts(counts: DataFrame, catalog: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same from stored counts per evaluation and tool.

    Every evaluation pairs with every catalog tool, which is the result itself: the names
    are one value, generated next to each evaluation.
    """
    keys = list(keys)
    names = catalog.agg(F.collect_set("name").alias("names")).scalar()
    none = counts.select(*keys).distinct().select(
        *keys, F.explode(names).alias("tool"), F.lit(0).alias("total"), F.lit(0).alias("correct")
    )
    return (
        counts.unionByName(none)
        .groupBy(*keys, "tool")
        .agg(F.sum("total").alias("total"), F.sum("correct").alias("correct"))
        .withColumn("accuracy", _ratio(F.col("correct"), F.col("total")))
    )


def run_log(scored: DataFrame, catalog: DataFrame) -> DataFrame:
    """One row per run, iteration and tool, with the iteration's and the run's best accuracy."""
    keys = ["run_id", "iteration"]
    counts = settle(tool_counts(scored, keys))
    whole = counts.groupBy(*keys).agg(F.sum("total").alias("total"), F.sum("correct").alias("correct"))
    history = whole.withColumn("overall_accuracy", _ratio(F.col("correct"), F.col("total")))
    return history_of_counts(counts, catalog, keys).join(best_of_runs(history), keys).select(
        *keys, "overall_accuracy", "best_accuracy", "tool", "accuracy"
    )


def iteration_summary(
    scored: DataFrame, patch_rows: DataFrame, keys: Sequence[str] = ("run_id", "iteration")
) -> DataFrame:
    """One run-history row per evaluation, with the number of appended patch rows."""
    appended = patch_rows.groupBy(*keys).agg(F.count("*").alias("appended_rows"))
    return (
        overall_accuracy(scored, keys)
        .join(appended, list(keys), "left")
        .withColumn("appended_rows", F.coalesce("appended_rows", F.lit(0)))
    )


def with_checkpoint_name(history: DataFrame, model: str) -> DataFrame:
    """Name of the model trained in each iteration: slashes to dashes, then version."""
    return history.withColumn(
        "checkpoint",
        F.concat(
            F.replace(F.lit(model), F.lit("/"), F.lit("-")),
            F.lit("-v"),
            F.col("iteration").cast("string"),
        ),
    )


def _run_so_far() -> Window:
    # A run has at most `max_iterations` rows, so its window is always small.
    return (
        Window.partitionBy("run_id")
        .orderBy("iteration")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )


def run_progress(history: DataFrame) -> DataFrame:
    """Best accuracy up to each iteration, starting from 0.0, and whether it improved."""
    best = F.greatest(F.max("overall_accuracy").over(_run_so_far()), F.lit(0.0))
    before = F.coalesce(
        F.max("overall_accuracy").over(
            Window.partitionBy("run_id")
            .orderBy("iteration")
            .rowsBetween(Window.unboundedPreceding, -1)
        ),
        F.lit(0.0),
    )
    return history.select(
        "run_id",
        "iteration",
        "overall_accuracy",
        best.alias("best_accuracy"),
        (F.col("overall_accuracy") > before).alias("improved"),
    )


def best_of_runs(history: DataFrame) -> DataFrame:
    """Each iteration's accuracy with the best of its whole run, 0.0 at least."""
    best = history.groupBy("run_id").agg(
        F.greatest(F.max("overall_accuracy"), F.lit(0.0)).alias("best_accuracy")
    )
    return history.join(best, "run_id").select("run_id", "iteration", "overall_accuracy", "best_accuracy")


def stop_decision(history: DataFrame, target: float, max_iterations: int) -> DataFrame:
    """Iterations up to and including the first stop, with the reason to stop there.

    Tested in this order: target reached, iteration limit, nothing failed.
    """
    if not 0.0 <= target <= 1.0:
        raise ValueError(f"target accuracy must lie in [0, 1], got {target}")
    if max_iterations <= 0:
        raise ValueError(f"max_iterations must be positive, got {max_iterations}")
    reason = (
        F.when(F.col("overall_accuracy") >= F.lit(float(target)), "target_reached")
        .when(F.col("iteration") >= F.lit(max_iterations), "max_iterations")
        .when(F.col("failure_count") == 0, "no_failures")
    )
    earlier_stops = F.coalesce(
        F.count("stop_reason").over(
            Window.partitionBy("run_id")
            .orderBy("iteration")
            .rowsBetween(Window.unboundedPreceding, -1)
        ),
        F.lit(0),
    )
    return (
        history.filter(F.col("iteration") <= max_iterations)
        .select(
            "run_id",
            "iteration",
            "overall_accuracy",
            "failure_count",
            reason.alias("stop_reason"),
        )
        .withColumn("_earlier", earlier_stops)
        .filter(F.col("_earlier") == 0)
        .drop("_earlier")
        .withColumn("stop_reason", F.coalesce("stop_reason", F.lit("continue")))
    )
