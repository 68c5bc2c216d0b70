"""The registered queries: each takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from toolgauge.operators import (
    catalog,
    clusters,
    density,
    evaluation_clusters,
    metrics,
    neighbors,
    prompts,
    responses,
    scoring,
    split,
    vectors,
)
from toolgauge.operators.vector_index import Index
from toolgauge.plans import inputs
from toolgauge.session import settle, shared_folder
from toolgauge.sources import commits, jsonl

TARGET = 0.6
MAX_ITERATIONS = 8
PROMPT_COUNT = 30
MODEL = "maker/model-3b"
SEED = 7
# Small enough that the given vectors fill several blocks.
BLOCK_ROWS = 256


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = scoring.with_predictions(
        inputs.eval_examples(spark, sf_dir), inputs.predictions(spark, sf_dir)
    )
    return scoring.score_calls(pairs)


def _event_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.tool_catalog(inputs.event_tool_specs(spark, sf_dir))


def _part_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.tool_catalog(inputs.part_tool_specs(spark, sf_dir))


def scan_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jsonl.parse_example_lines(inputs.example_lines(spark, sf_dir)).select(
        "ord", "id", "user_query", "expected_tool_call"
    )


def tool_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog, one row per parameter (a tool without any keeps one row)."""
    return _part_catalog(spark, sf_dir).select(
        "tool_ord", "name", "description", F.posexplode_outer("parameters").alias("pos", "p")
    ).select(
        "tool_ord",
        "name",
        "description",
        "pos",
        F.col("p")["name"].alias("param"),
        F.col("p")["type"].alias("type"),
        F.col("p")["description"].alias("param_description"),
        F.col("p")["required"].alias("required"),
    )


def tool_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.tool_schema(_part_catalog(spark, sf_dir))


def datagen_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prompts.datagen_prompts(_part_catalog(spark, sf_dir), PROMPT_COUNT)


def _answers(spark: SparkSession, sf_dir: str, *origin: str) -> DataFrame:
    origins = inputs.prompt_origins(spark, sf_dir).select("prompt_id", *origin)
    return responses.with_origin(inputs.responses(spark, sf_dir), origins)


def ingest_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return responses.ingest_responses(_answers(spark, sf_dir, "tool")).drop("messages")


def response_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return responses.response_rejects(_answers(spark, sf_dir, "tool"))


def _patches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return responses.patch_rows(_answers(spark, sf_dir, "run_id", "iteration", "cluster_id"))


def patch_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _patches(spark, sf_dir).drop("messages")


def train_after_patch(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = split.split_examples(
        inputs.eval_examples(spark, sf_dir), "ord", seed=SEED
    ).filter(F.col("split") == "train")
    both = responses.train_after_patch(train, _patches(spark, sf_dir))
    return both.select(
        "id", F.get("messages", F.lit(0))["content"].alias("user_query"), "expected_tool_call"
    )


def split_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.split_examples(
        inputs.eval_examples(spark, sf_dir), "ord", seed=SEED
    ).select("ord", "split", "id", "user_query", "expected_tool_call")


def training_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of the training file, tools list included."""
    schemas = catalog.schema_list(_event_catalog(spark, sf_dir))
    examples = split.split_examples(inputs.eval_examples(spark, sf_dir), "ord", seed=SEED)
    return jsonl.example_lines(examples, schemas).select("split", "id", "line")


def score_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir).select("ord", "id", "tool", "is_correct", "error_type")


def overall_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.overall_accuracy(_scored(spark, sf_dir))


def per_tool_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.per_tool_accuracy(_scored(spark, sf_dir), _event_catalog(spark, sf_dir))


def failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.failures(_scored(spark, sf_dir))


def negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.negatives(inputs.eval_examples(spark, sf_dir)).select("ord", "id", "user_query")


def example_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.example_rejects(inputs.mixed_examples(spark, sf_dir)).select(
        "ord", "id", "expected_tool_call"
    )


def patch_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return responses.patch_rejects(_answers(spark, sf_dir, "run_id", "iteration", "cluster_id"))


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as rows: per run, iteration and tool, with the best accuracy of the run."""
    return metrics.run_log(_scored(spark, sf_dir), _event_catalog(spark, sf_dir))


def logged_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as it is read back after a write and a repeated write of the same evaluations."""
    rows = settle(run_log(spark, sf_dir))
    keys = ["run_id", "iteration"]
    tables = {
        "runs": rows.select(*keys, "overall_accuracy", "best_accuracy").distinct(),
        "tools": rows.select(*keys, "tool", "accuracy"),
    }
    folder = f"{shared_folder(spark)}/log/{uuid.uuid4().hex}"
    for _ in range(2):
        commits.append(spark, tables, folder, token="all runs")
    runs = commits.read(
        spark, folder, "runs", "run_id bigint, iteration bigint, overall_accuracy double, best_accuracy double"
    )
    tools = commits.read(spark, folder, "tools", "run_id bigint, iteration bigint, tool string, accuracy double")
    return runs.join(tools, ["commit", *keys]).drop("commit")


def failure_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prompts.failure_text(failures(spark, sf_dir)).select("ord", "failure_text")


def sft_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prompts.sft_text(inputs.eval_examples(spark, sf_dir)).select("ord", "text")


def eval_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prompts.eval_prompts(inputs.first_messages(spark, sf_dir)).select("conv_id", "prompt")


def tool_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.tool_history(_scored(spark, sf_dir), _event_catalog(spark, sf_dir))


def iteration_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = metrics.iteration_summary(_scored(spark, sf_dir), _patches(spark, sf_dir))
    return metrics.with_checkpoint_name(summary, MODEL)


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.overall_accuracy(_scored(spark, sf_dir), ["run_id", "iteration"])


def run_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.run_progress(_history(spark, sf_dir))


def stop_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.stop_decision(_history(spark, sf_dir), TARGET, MAX_ITERATIONS)


def _evaluated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole set of a run scored in each of its iterations, predicted or not."""
    grid = scoring.evaluation_grid(
        inputs.eval_examples(spark, sf_dir), inputs.evaluations(spark, sf_dir), ["run_id"], "iteration"
    )
    predictions = inputs.iteration_predictions(spark, sf_dir)
    return scoring.score_calls(scoring.with_predictions(grid, predictions, ["run_id", "iteration"]))


def evaluation_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy per tool of one set in several iterations; an absent prediction is a failure."""
    return metrics.tool_history(_evaluated(spark, sf_dir), _event_catalog(spark, sf_dir))


def evaluation_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy per iteration of one set, and how many of its examples were not answered."""
    scored = _evaluated(spark, sf_dir).withColumn("absent", F.col("predicted").isNull().cast("long"))
    keys = ["run_id", "iteration"]
    scored = settle(scored.select(*keys, "is_correct", "absent"))
    absent = scored.groupBy(*keys).agg(F.sum("absent").alias("absent"))
    return metrics.overall_accuracy(scored, keys).join(absent, keys)


def evaluation_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best accuracy so far over the iterations of one set."""
    return metrics.run_progress(metrics.overall_accuracy(_evaluated(spark, sf_dir), ["run_id", "iteration"]))


def clusters_over_iterations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters patched in each iteration, in order; a label may come again in a later one."""
    members = inputs.vector_failures(spark, sf_dir).withColumn("iteration", F.col("ord") % inputs.EVALUATIONS + 1)
    return clusters.handled(clusters.summarise(members, "iteration"), "iteration")


def cluster_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.summarise(inputs.vector_failures(spark, sf_dir))


def clusters_handled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels in the order in which their clusters get patched, repeats kept."""
    return clusters.handled(cluster_summary(spark, sf_dir))


def patch_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = inputs.vector_failures(spark, sf_dir).drop("embedding")
    return prompts.patch_prompts(members, clusters.summarise(members))


def failure_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of the failure texts of all scored events."""
    return vectors.embed_failures(failure_text(spark, sf_dir)).select("ord", "embedding")


def _index(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Index]:
    rows = inputs.vector_failures(spark, sf_dir).select("ord", "embedding")
    return rows, density.index_of(rows, density.min_cluster_size(rows.count()), BLOCK_ROWS)


def core_distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, index = _index(spark, sf_dir)
    cores = neighbors.core_distances(index, neighbors.nearest(index))
    named = index.points.select("pid", "vec").join(cores, "pid").select("vec", "core")
    return density.by_vector(rows, "embedding", named).select("ord", F.round("core", 6).alias("core_distance"))


def mutual_reachability(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, index = _index(spark, sf_dir)
    found = settle(neighbors.nearest(index))
    reach = density.mutual_reachability(found, neighbors.core_distances(index, found))
    return reach.select(
        F.col("pid").alias("ord"),
        "neighbor",
        F.round("dist", 6).alias("distance"),
        F.round("reachability", 6).alias("reachability"),
    )


def mst_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, index = _index(spark, sf_dir)
    return density.tree_of(index)[1].select("u", "v", F.round("w", 6).alias("reachability"))


def mst_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each weight occurs in the spanning tree: the same for every such tree."""
    return mst_edges(spark, sf_dir).groupBy("reachability").agg(F.count("*").alias("edges"))


def cluster_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.vector_failures(spark, sf_dir).drop("cluster_id")
    return density.cluster_members(rows, BLOCK_ROWS).drop("embedding")


def failure_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return density.failure_clusters(cluster_members(spark, sf_dir))


def _evaluation_members(spark: SparkSession, sf_dir: str, *needed: str) -> DataFrame:
    """Failures of every evaluation with `needed`, clustered by their vectors evaluation by evaluation."""
    keys = ["run_id", "iteration"]
    encoded = inputs.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("ord"), "embedding")
    failed = scoring.failures(_evaluated(spark, sf_dir), *keys).select(*keys, "ord", "error_type", *needed)
    return evaluation_clusters.cluster_sets(failed.join(encoded, "ord", "left"), keys, BLOCK_ROWS).drop("embedding")


def evaluation_clusters_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of each evaluation's failures, how many it has of them and of failures."""
    found = evaluation_clusters.set_clusters(_evaluation_members(spark, sf_dir), ["run_id", "iteration"])
    return found.select("run_id", "iteration", "cluster_id", "label", "size", "cluster_ord", "failures")


def evaluation_patch_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From scored evaluations to patch prompts: failures, vectors, clusters, prompts."""
    keys = ["run_id", "iteration"]
    members = _evaluation_members(spark, sf_dir, "id", "user_query", "expected", "predicted")
    found = settle(evaluation_clusters.set_clusters(members, keys))
    return prompts.patch_prompts(members, found, *keys)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        scan_examples,
        tool_catalog,
        tool_schema,
        datagen_prompts,
        ingest_responses,
        response_rejects,
        patch_rows,
        split_examples,
        training_lines,
        train_after_patch,
        score_calls,
        overall_accuracy,
        per_tool_accuracy,
        failures,
        negatives,
        example_rejects,
        patch_rejects,
        run_log,
        logged_runs,
        failure_text,
        sft_text,
        eval_prompts,
        tool_history,
        iteration_summary,
        run_progress,
        stop_decision,
        evaluation_history,
        evaluation_summary,
        evaluation_progress,
        cluster_summary,
        clusters_handled,
        clusters_over_iterations,
        patch_prompts,
        failure_vectors,
        core_distances,
        mutual_reachability,
        mst_edges,
        mst_weights,
        cluster_members,
        failure_clusters,
        evaluation_clusters_found,
        evaluation_patch_prompts,
    )
}
