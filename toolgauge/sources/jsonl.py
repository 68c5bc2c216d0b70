"""JSON-lines tables of examples, patch rows, failures and the run log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from toolgauge.functions import json_text as J
from toolgauge.functions.stage import computed
from toolgauge.operators.ranking import dense_positions
from toolgauge.sources import commits

MESSAGES = "array<struct<role:string,content:string>>"


def parse_example_lines(lines: DataFrame) -> DataFrame:
    """Parse the JSON column `line`; other columns stay. A broken line fails the job.

    The nested call stays JSON text: a struct over all tools would lose the
    difference between a missing argument and a null one. The tools list, equal on
    every line, is not read.
    """
    columns = [c for c in lines.columns if c != "line"]
    fields = J.parsed_object(F.col("_parsed"))
    parsed = computed(
        computed(lines, _parsed=J.parse_object(F.col("line"))),
        _fields=F.when(fields.isNotNull(), fields).otherwise(
            F.raise_error(F.concat(F.lit("not a JSON line: "), F.left("line", F.lit(200))))
        ),
    )
    messages = F.from_json(F.col("_fields")["messages"], MESSAGES, J.OPTIONS)
    return parsed.select(
        *columns,
        F.coalesce(F.col("_fields")["id"], F.lit("unknown")).alias("id"),
        messages.alias("messages"),
        F.col("_fields")["expected_tool_call"].alias("expected_tool_call"),
    ).withColumn("user_query", F.get("messages", F.lit(0))["content"])


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files with their position `ord`, 0-based over all files.

    Positions come from one count per file block plus the rank inside the block.
    """
    lines = spark.read.text(path).select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        # Grows in reading order within one block, which is all that is used of it.
        F.monotonically_increasing_id().alias("_seq"),
    )
    placed = dense_positions(lines, ["_file", "_block"], ["_seq"], "ord")
    return placed.select("ord", "line")


def read_examples(spark: SparkSession, path: str) -> DataFrame:
    """Examples of a JSON-lines file or folder, in file order."""
    return parse_example_lines(read_lines(spark, path))


def _raw(text: Column) -> Column:
    """JSON text as it is, any other text as JSON string, NULL as null."""
    return F.when(text.isNull(), F.lit("null")).when(J.is_json(text), text).otherwise(
        J.json_string(text)
    )


def example_lines(examples: DataFrame, schemas: Column) -> DataFrame:
    """Add `line`: the training-file line, built around the raw JSON texts.

    `schemas` is the tools list of `catalog.schema_list`; it joins the row only here,
    when the line is written.
    """
    return examples.withColumn(
        "line",
        F.concat(
            F.lit('{"tools": '),
            schemas,
            F.lit(', "messages": '),
            F.to_json("messages"),
            F.lit(', "expected_tool_call": '),
            _raw(F.col("expected_tool_call")),
            F.lit(', "id": '),
            J.json_string(F.col("id")),
            F.lit("}"),
        ),
    )


def write_split(examples: DataFrame, schemas: Column, path: str) -> None:
    """Write the folders split=train and split=eval, each holding iteration=0."""
    lines = example_lines(examples, schemas).select("split", F.lit(0).alias("iteration"), "line")
    lines.write.mode("overwrite").partitionBy("split", "iteration").text(path)


def append_patches(patches: DataFrame, schemas: Column, path: str, iteration: int) -> None:
    """Append the patch lines of one iteration to the training folder.

    Each iteration is a folder of its own and replaces itself, so a run that is
    repeated after a failure does not append its rows twice.
    """
    example_lines(patches, schemas).select("line").write.mode("overwrite").text(
        f"{path}/split=train/iteration={iteration}"
    )


def write_failures(failures: DataFrame, path: str, iteration: int) -> None:
    """Write the failures of one iteration, replacing that iteration only."""
    failures.write.mode("overwrite").json(f"{path}/iter={iteration}")


def train_exists(spark: SparkSession, path: str) -> bool:
    """True when training lines are there already, so generation can be skipped."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.exists(jvm_path) and not spark.read.text(path).isEmpty()


def append_run_log(
    spark: SparkSession, history: DataFrame, tools: DataFrame, path: str, token: str | None = None
) -> int:
    """Add one run to the log and return its number, the next free one.

    `history` has iteration, overall_accuracy, failure_count; `tools` has iteration,
    tool, accuracy and is kept as rows. Both appear at once. A run written again under its
    `token` keeps its number and its rows.
    """
    tables = {"runs": with_best(history), "tools": tools.select("iteration", "tool", "accuracy")}
    return commits.append(spark, tables, path, token)


def with_best(history: DataFrame) -> DataFrame:
    """Add the best accuracy of the whole run to each of its iterations."""
    best = history.agg(F.greatest(F.max("overall_accuracy"), F.lit(0.0))).scalar()
    return history.select("iteration", "overall_accuracy", "failure_count", best.alias("best_accuracy"))


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    """One row per run and iteration."""
    schema = "iteration bigint, overall_accuracy double, failure_count bigint, best_accuracy double"
    return commits.read(spark, path, "runs", schema).withColumnRenamed("commit", "run_id")


def read_tool_log(spark: SparkSession, path: str) -> DataFrame:
    """One row per run, iteration and tool."""
    schema = "iteration bigint, tool string, accuracy double"
    return commits.read(spark, path, "tools", schema).withColumnRenamed("commit", "run_id")
