"""Model answers (text with a JSON array inside) into example rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from toolgauge.functions import json_text as J
from toolgauge.functions.stage import computed
from toolgauge.functions.text import strip, unfence_anchored, unfence_anywhere

INVALID_JSON = "invalid_json"
BAD_ITEM = "bad_item"
REJECT_HEAD = 200

_OBJECTS = "array<array<map<string,string>>>"
_TEXTS = "array<array<string>>"
_VARIANTS = "array<array<variant>>"


def _array_of(text: Column, schema: str, end_mark: str) -> Column:
    """Root array of a strict parse, NULL where the text is not one JSON array."""
    wrapped = F.concat(F.lit("["), text, F.lit(f",[{end_mark}]]"))
    return F.from_json(wrapped, schema, J.OPTIONS)


def _parse_items(cleaned: DataFrame) -> DataFrame:
    """Add `_items`: array of field maps, with NULL for an item that is no object.

    `_usable` counts the items before the first one that is no example. `_items`
    itself is NULL when the text is not a JSON array. One parse serves
    answers that hold objects only; anything else takes the slower way below.
    """
    text = F.col("_text")
    parsed = computed(cleaned, _objects=_array_of(text, _OBJECTS, f'{{"{J.END_KEY}":"1"}}'))
    closed = F.coalesce(
        (F.size("_objects") == 2)
        & F.map_contains_key(F.get(F.get("_objects", F.lit(1)), F.lit(0)), J.END_KEY),
        F.lit(False),
    )
    items = F.when(closed, F.get("_objects", F.lit(0))).when(
        F.startswith(F.ltrim(text), F.lit("[")) & J.is_json(text), _mixed_items(text)
    )
    return computed(
        computed(parsed, _items=items), _usable=_first_bad(F.col("_items")), _quoted=_quoted_calls(text)
    ).drop("_objects")


def _quoted_calls(text: Column) -> Column:
    """Per item, whether its call is a string (that may hold JSON) and no object.

    NULL where the text shows no such call, which spares the second parse.
    """
    variants = F.get(_array_of(text, _VARIANTS, '"1"'), F.lit(0))
    call = F.transform(variants, lambda item: F.try_variant_get(item, "$.expected_tool_call", "variant"))
    quoted = F.transform(call, lambda one: F.coalesce(F.schema_of_variant(one) == "STRING", F.lit(False)))
    return F.when(text.rlike(r'"expected_tool_call"\s*:\s*"'), quoted)


def _mixed_items(text: Column) -> Column:
    """Items of an array that also holds other things than objects."""
    texts = F.get(_array_of(text, _TEXTS, '"1"'), F.lit(0))
    variants = F.get(_array_of(text, _VARIANTS, '"1"'), F.lit(0))
    return F.transform(
        texts,
        lambda item, i: F.when(
            F.startswith(F.schema_of_variant(F.get(variants, i)), F.lit("OBJECT")),
            J.object_fields(item),
        ),
    )


def _is_bad(item: Column) -> Column:
    return (
        item.isNull()
        | ~F.map_contains_key(item, "user_query")
        | ~F.map_contains_key(item, "expected_tool_call")
    )


def _first_bad(items: Column) -> Column:
    """Number of items before the first unusable one."""
    flags = F.transform(items, lambda item: F.coalesce(_is_bad(item), F.lit(True)))
    at = F.array_position(flags, F.lit(True))
    return F.when(at > 0, at - 1).otherwise(F.size(items))


def _examples(kept: DataFrame, columns: list[str]) -> DataFrame:
    """One row per item: a single user message and the expected call."""
    rows = kept.select(*columns, "_quoted", F.posexplode("_items").alias("pos", "_fields")).withColumn(
        "_item", J.unique_fields(F.col("_fields"))
    )
    query = F.col("_item")["user_query"]
    call = F.col("_item")["expected_tool_call"]
    is_text = F.coalesce(F.get("_quoted", F.col("pos")), F.lit(False))
    return rows.select(
        *columns,
        "pos",
        F.array(F.struct(F.lit("user").alias("role"), query.alias("content"))).alias("messages"),
        query.alias("user_query"),
        # A call given as a string stays one: quoted text, and no call that could be scored.
        F.when(is_text, J.json_string(call)).otherwise(call).alias("expected_tool_call"),
    )


def base_lanes(responses: DataFrame) -> DataFrame:
    """Judge whole answers: `_items` of good ones, `reason` and `head` of the others."""
    opened = computed(responses, _open=unfence_anchored(F.col("raw")))
    parsed = _parse_items(computed(opened, _text=strip(F.col("_open"))))
    reason = F.when(F.col("_items").isNull() & ~J.is_json(F.col("_text")), INVALID_JSON).when(
        F.col("_items").isNull() | (F.col("_usable") < F.size("_items")), BAD_ITEM
    )
    return (
        computed(parsed, reason=reason)
        .withColumn("head", F.left("_open", F.lit(REJECT_HEAD)))
        .drop("_open", "_text")
    )


def ingest_responses(responses: DataFrame) -> DataFrame:
    """Example rows from the answers to datagen prompts; one bad item rejects its answer."""
    kept = base_lanes(responses).filter(F.col("reason").isNull())
    return _examples(kept, [c for c in responses.columns if c != "raw"])


def response_rejects(responses: DataFrame) -> DataFrame:
    """Rejected answers with the reason and the first characters of their text."""
    columns = [c for c in responses.columns if c != "raw"]
    return (
        base_lanes(responses)
        .filter(F.col("reason").isNotNull())
        .select(*columns, "reason", "head")
    )


def with_origin(responses: DataFrame, prompts: DataFrame, key: str = "prompt_id") -> DataFrame:
    """Attach what an answer was asked for; the size of `prompts` decides the join."""
    return responses.join(prompts, key)


def patch_rows(responses: DataFrame) -> DataFrame:
    """Example rows from the answers to patch prompts, with their ids.

    Items before the first unusable one are kept, so positions are dense and serve
    as numbers within (iteration, cluster_id): one answer per cluster, no window. Rows
    of several runs have a `run_id`, which then becomes part of the id.
    """
    run = [F.concat(F.lit("run"), F.col("run_id").cast("string"))] if "run_id" in responses.columns else []
    cleaned = computed(responses, _text=unfence_anywhere(F.col("raw")))
    kept = (
        _parse_items(cleaned)
        .filter(F.col("_items").isNotNull())
        .withColumn("_items", F.slice("_items", F.lit(1), F.col("_usable").cast("int")))
    )
    rows = _examples(kept, [c for c in responses.columns if c != "raw"])
    return rows.withColumn(
        "id",
        F.concat_ws(
            "_",
            *run,
            F.concat(F.lit("train_iter"), F.col("iteration").cast("string")),
            F.col("cluster_id").cast("string"),
            F.col("pos").cast("string"),
        ),
    )


def patch_rejects(responses: DataFrame) -> DataFrame:
    """Answers to patch prompts of which something was not used: the reason, and how many
    items came before it."""
    parsed = computed(
        _parse_items(computed(responses, _text=unfence_anywhere(F.col("raw")))),
        _json=J.is_json(F.col("_text")),
    )
    reason = F.when(F.col("_items").isNull() & ~F.col("_json"), INVALID_JSON).when(
        F.col("_items").isNull() | (F.col("_usable") < F.size("_items")), BAD_ITEM
    )
    columns = [c for c in responses.columns if c != "raw"]
    return (
        computed(parsed, reason=reason)
        .filter(F.col("reason").isNotNull())
        .select(*columns, "reason", F.coalesce("_usable", F.lit(0)).cast("int").alias("used"))
    )


def train_after_patch(train: DataFrame, patches: DataFrame) -> DataFrame:
    """Training rows with the patch rows appended; nothing is deduplicated."""
    columns = ["id", "messages", "expected_tool_call"]
    return train.select(*columns).unionByName(patches.select(*columns))
