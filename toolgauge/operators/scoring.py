"""Score predicted tool calls against expected ones.

The scoring itself is a chain of columns: it adds no shuffle to whatever join
delivers prediction and expectation, and runs unchanged on a stream.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from toolgauge.functions import json_text as J
from toolgauge.functions.stage import computed
from toolgauge.functions.text import unfence_anywhere

# The error names.
MALFORMED_JSON = "malformed_json"
WRONG_TOOL = "wrong_tool"
MISSING_PARAM = "missing_param"
WRONG_PARAM_VALUE = "wrong_param_value"
HALLUCINATED_PARAM = "hallucinated_param"

# Name texts that a JSON number, boolean or nested value could also print as.
_MAYBE_NOT_A_STRING = r"^(-?[0-9]|true$|false$|NaN$|-?Infinity$|\[|\{)"


def expected_lanes(examples: DataFrame) -> DataFrame:
    """Add `tool` and `lane`: 'scored', 'negative' (no call expected) or 'reject'.

    A reject is an expectation that cannot be scored: no JSON object, or no name.
    """
    call = F.col("_expected_call")
    return (
        computed(examples, _expected_call=J.parse_call(F.col("expected_tool_call")))
        .withColumn("tool", J.call_value(call)["name"])
        .withColumn(
            "lane",
            F.when(
                F.col("expected_tool_call").isNull()
                | (F.trim("expected_tool_call") == "null"),
                F.lit("negative"),
            )
            .when(
                ~J.call_closed(call) | F.col("tool").isNull() | J.foreign_numbers(F.col("expected_tool_call")),
                F.lit("reject"),
            )
            .otherwise(F.lit("scored")),
        )
        .drop("_expected_call")
    )


def negatives(examples: DataFrame) -> DataFrame:
    """Examples that expect no call; they take no part in accuracy or training text."""
    return expected_lanes(examples).filter(F.col("lane") == "negative").drop("lane", "tool")


def example_rejects(examples: DataFrame) -> DataFrame:
    """Examples whose expectation cannot be scored; accuracy leaves them out."""
    return expected_lanes(examples).filter(F.col("lane") == "reject").drop("lane", "tool")


def evaluation_grid(examples: DataFrame, evaluations: DataFrame, shared: Sequence[str], key: str) -> DataFrame:
    """Each example once for every evaluation of the set it belongs to, under `key`.

    `shared` names the set (e.g. the run), `key` tells the evaluations of one set apart (e.g.
    the iteration). A set's evaluations are as many as the iteration limit allows, so they
    travel as one short list per set; the copies of an example are generated next to it and
    then meet their predictions by (shared, key, ord). Sets without an evaluation have no rows.
    """
    shared = list(shared)
    lists = evaluations.groupBy(*shared).agg(F.sort_array(F.collect_set(key)).alias("_keys"))
    return (
        examples.drop(key).join(lists, shared).withColumn(key, F.explode("_keys")).drop("_keys")
    )


def with_predictions(
    examples: DataFrame, predictions: DataFrame, keys: Sequence[str] = ()
) -> DataFrame:
    """Each example with its prediction, matched by position.

    `ord` is the key because ids repeat: every row without an id is called
    'unknown'. `keys` are further columns of both sides that tell evaluations apart,
    e.g. run and iteration; without a prediction in its own evaluation an example
    keeps a NULL `predicted`, whatever other evaluations have. Tables bucketed by the
    keys join without a shuffle.
    """
    return examples.join(predictions, [*keys, "ord"], "left")


def score_calls(pairs: DataFrame) -> DataFrame:
    """Add `tool`, `is_correct` and `error_type` ('' when correct) to scorable rows.

    Needs `expected_tool_call` and `predicted`. Negatives and rejects are left out.
    Each text is parsed once.
    """
    texts = computed(
        pairs.filter(F.col("expected_tool_call").isNotNull()),
        _text=unfence_anywhere(F.coalesce("predicted", F.lit(""))),
    )
    parsed = computed(
        texts,
        _p=J.parse_call(F.col("_text")),
        _e=J.parse_call(F.col("expected_tool_call")),
    )
    expected = J.call_value(F.col("_e"))
    predicted = J.call_value(F.col("_p"))
    entries = parsed.select(
        *pairs.columns,
        "_text",
        (J.call_closed(F.col("_p")) & ~J.foreign_numbers(F.col("_text"))).alias("_p_closed"),
        predicted["name"].alias("_p_name"),
        F.when(
            J.call_closed(F.col("_e")) & ~J.foreign_numbers(F.col("expected_tool_call")), expected["name"]
        ).alias("tool"),
        J.unique_fields(predicted["arguments"]).alias("_p_args"),
        J.unique_entries(expected["arguments"]).alias("_e_args"),
    )
    judged = computed(entries.filter(F.col("tool").isNotNull()), error_type=_error_type())
    return judged.select(
        *pairs.columns,
        "tool",
        (F.col("error_type") == "").alias("is_correct"),
        "error_type",
    )


def _error_type() -> Column:
    p_keys = "coalesce(map_keys(_p_args), CAST(array() AS ARRAY<STRING>))"
    # The earliest expected argument that is absent or differs decides.
    first_fault = F.expr(
        f"""get(filter(transform(_e_args, e -> CASE
              WHEN NOT coalesce(map_contains_key(_p_args, e.key), false) THEN '{MISSING_PARAM}'
              WHEN NOT {J.same_value("try_element_at(_p_args, e.key)", "e.value")} THEN '{WRONG_PARAM_VALUE}'
            END), fault -> fault IS NOT NULL), 0)"""
    )
    unexpected = F.expr(
        f"""size(array_except({p_keys},
              coalesce(transform(_e_args, e -> e.key), CAST(array() AS ARRAY<STRING>)))) > 0"""
    )
    same_name = (F.col("_p_name") == F.col("tool")) & F.when(
        F.col("tool").rlike(_MAYBE_NOT_A_STRING),
        J.field_type(F.col("_text"), "name")
        == J.field_type(F.col("expected_tool_call"), "name"),
    ).otherwise(F.lit(True))
    # `arguments` that is there but no object has no entries at all.
    not_an_object = F.when(
        F.col("_p_args").isNull(),
        J.object_fields(F.col("_text"))["arguments"].isNotNull(),
    ).otherwise(F.lit(False))

    return (
        # JSON whose root is no object also fails the one-pass parse.
        F.when(~F.col("_p_closed") & ~J.is_json(F.col("_text")), MALFORMED_JSON)
        .when(~F.col("_p_closed") | ~F.coalesce(same_name, F.lit(False)), WRONG_TOOL)
        .when(first_fault.isNotNull(), first_fault)
        .when(unexpected | not_an_object, HALLUCINATED_PARAM)
        .otherwise("")
    )


def failures(scored: DataFrame, *extra: str) -> DataFrame:
    """Wrong rows with what clustering and patching need; `extra` names more columns."""
    return scored.filter(~F.col("is_correct")).select(
        *extra,
        "ord",
        "id",
        "user_query",
        F.col("expected_tool_call").alias("expected"),
        "predicted",
        "error_type",
    )
