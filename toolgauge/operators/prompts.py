"""Prompt and training texts, all as plain columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from toolgauge.functions import json_text as J
from toolgauge.functions.stage import computed

MAX_PATCH_ROWS = 20
PATCH_ROWS_PER_FAILURE = 3
SHOWN_FAILURES = 3

# ChatML turn marks, the default template of `sft_text` and `eval_prompts`.
CHATML = {"open": "<|im_start|>", "close": "<|im_end|>\n"}


# What the messages of a data generation prompt should differ in, unless the caller says so.
VOICES = (
    "a few keywords typed on a phone",
    "a story from which the wish has to be guessed",
    "a stiff letter",
    "a learner of the language",
    "someone who corrects a value halfway through",
    "someone who writes numbers and dates as words",
)
OFF_TOPIC = 0.1


def datagen_task(count: int, voices: Sequence[str] = VOICES, off_topic: float = OFF_TOPIC) -> str:
    """The part of a data generation prompt that is the same for all tools."""
    idle = round(count * off_topic)
    return (
        f"\nTASK\nInvent {count} messages to an assistant that has this tool."
        f"\nVoices to spread them over: {'; '.join(voices)}."
        f"\nLeave exactly {idle} of them without any use for the tool."
        "\nReply in JSON only: a list with one object per message, its text as"
        '\n"user_query" and the right call, or null without one, as "expected_tool_call"'
        '\n(keys "name" and "arguments").\n'
    )


def datagen_prompts(
    catalog: DataFrame, count: int, voices: Sequence[str] = VOICES, off_topic: float = OFF_TOPIC
) -> DataFrame:
    """One prompt per tool that asks for `count` queries with their expected calls."""
    lines = F.transform(
        F.col("parameters"),
        lambda p: F.concat(
            F.lit("  "),
            p["name"],
            F.lit(" ("),
            p["type"],
            F.when(p["required"], ", required) ").otherwise(", optional) "),
            p["description"],
            F.lit("\n"),
        ),
    )
    return catalog.select(
        "tool_ord",
        F.col("name").alias("tool"),
        F.concat(
            F.lit("TOOL "),
            F.col("name"),
            F.lit("\n"),
            F.col("description"),
            F.lit("\nIt takes:\n"),
            F.array_join(lines, ""),
            F.lit(datagen_task(count, voices, off_topic)),
        ).alias("prompt"),
    )


def failure_text(failures: DataFrame) -> DataFrame:
    """The text of a failure that gets embedded: the mistake, the wish, both calls."""
    call = J.parsed_object(F.col("_parsed"))
    return computed(
        computed(failures, _parsed=J.parse_object(F.col("expected"))),
        _call=J.unique_fields(F.coalesce(call, F.expr("CAST(map() AS MAP<STRING, STRING>)"))),
    ).select(
        *failures.columns,
        F.concat_ws(
            "\n",
            F.concat(F.lit("mistake: "), F.col("error_type")),
            F.concat(F.lit("asked: "), F.col("user_query")),
            F.concat(
                F.lit("wanted: "),
                F.coalesce(F.col("_call")["name"], F.lit("?")),
                F.lit(" "),
                F.when(~F.map_contains_key("_call", "arguments"), F.lit("{}")).otherwise(
                    F.coalesce(J.python_spacing(F.col("_call")["arguments"]), F.lit("null"))
                ),
            ),
            F.concat(F.lit("answered: "), F.coalesce("predicted", F.lit(""))),
        ).alias("failure_text"),
    )


def patch_prompts(members: DataFrame, clusters: DataFrame, *keys: str) -> DataFrame:
    """One prompt per cluster, showing its first members in input order.

    `members` holds failure columns and `cluster_id`, `clusters` label and size. Only
    the shown members are shuffled: the rank filter is applied before the exchange.
    """
    by = [*keys, "cluster_id"]
    first = Window.partitionBy(*by).orderBy("ord")
    line = F.concat(
        F.lit("* "),
        F.col("user_query"),
        F.lit("\n  should give "),
        J.python_spacing(F.col("expected")),
        F.lit("\n  but gave "),
        F.coalesce("predicted", F.lit("")),
    )
    shown = (
        members.withColumn("_rank", F.row_number().over(first))
        .filter(F.col("_rank") <= SHOWN_FAILURES)
        .groupBy(*by)
        .agg(F.array_sort(F.collect_list(F.struct("_rank", line.alias("line")))).alias("_lines"))
    )
    wanted = F.least(F.lit(MAX_PATCH_ROWS), F.col("size") * PATCH_ROWS_PER_FAILURE)
    return (
        clusters.join(shown, by, "left")
        .withColumn("requested", wanted.cast("int"))
        .select(
            *by,
            "label",
            "requested",
            F.concat(
                F.lit("WEAKNESS "),
                F.col("label"),
                F.lit("\nSeen in evaluation:\n"),
                F.coalesce(
                    F.array_join(F.transform("_lines", lambda x: x["line"]), "\n"), F.lit("")
                ),
                F.lit("\nTASK\nTeach the model otherwise with "),
                F.col("requested").cast("string"),
                F.lit(PATCH_TASK),
            ).alias("prompt"),
        )
    )


PATCH_TASK = (
    " further messages that invite the same mistake, each with the call that is right."
    '\nReply in JSON only: a list of objects with the text as "user_query" and, as'
    '\n"expected_tool_call", an object with "name" and "arguments".\n'
)


def _turn(role: str, content: Column, template: dict[str, str]) -> Column:
    return F.concat(
        F.lit(f"{template['open']}{role}\n"), content, F.lit(template["close"])
    )


def eval_prompts(chats: DataFrame, template: dict[str, str] = CHATML) -> DataFrame:
    """Inference prompt: the first message as user turn, whatever its role was."""
    first = F.get("messages", F.lit(0))["content"]
    return chats.withColumn(
        "prompt",
        F.concat(_turn("user", first, template), F.lit(f"{template['open']}assistant\n")),
    )


def sft_text(examples: DataFrame, template: dict[str, str] = CHATML) -> DataFrame:
    """Training text: the first message, then the expected call as valid JSON.

    Examples that expect no call have no training text and are left out.
    """
    first = F.get("messages", F.lit(0))["content"]
    call = F.col("_call")
    answer = F.concat(
        F.lit('{"name": '),
        J.json_string(call["name"]),
        F.lit(', "arguments": '),
        F.coalesce(call["arguments"], F.lit("{}")),
        F.lit("}"),
    )
    return (
        computed(
            computed(examples, _parsed=J.parse_object(F.col("expected_tool_call"))),
            _call=J.unique_fields(J.parsed_object(F.col("_parsed"))),
        )
        .filter(call["name"].isNotNull())
        .withColumn(
            "text",
            F.concat(_turn("user", first, template), _turn("assistant", answer, template)),
        )
        .drop("_call", "_parsed")
    )
