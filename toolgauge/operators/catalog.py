"""Tool catalog: normalised definitions and the function schema models are shown."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from toolgauge.functions import json_text as J
from toolgauge.functions.stage import computed


# Texts that stand for a truth value.
TRUE_WORDS = ("true", "t", "yes", "y", "on", "1")
FALSE_WORDS = ("false", "f", "no", "n", "off", "0")


def tool_catalog(specs: DataFrame) -> DataFrame:
    """Normalise rows of (tool_ord, spec JSON) into the catalog.

    A parameter given as a bare string is its type: no description, required. One
    given as an object must name type and description; `required` defaults to true.
    A tool must have a name; description defaults to '' and parameters to none.
    Broken specs fail the job.
    """
    fields = F.col("_fields")
    strict = J.unique_fields(J.parsed_object(F.col("_parsed")))
    spec = computed(
        computed(specs, _parsed=J.parse_object(F.col("spec"))),
        _fields=_must(strict, F.concat(F.lit("no object at position "), F.col("tool_ord"))),
    )
    has_params = F.map_contains_key(fields, "parameters")
    split = computed(
        spec,
        name=_must(
            fields["name"],
            F.concat(F.lit("tool without a name at position "), F.col("tool_ord")),
        ),
        description=F.when(~F.map_contains_key(fields, "description"), F.lit("")).otherwise(
            _must(
                fields["description"],
                F.concat(F.lit("null description at position "), F.col("tool_ord")),
            )
        ),
        _given=J.object_fields(fields["parameters"]),
        _has_params=has_params,
    )
    # A bare value must be a string: 5 and true print as texts, too.
    kinds = F.map_entries(F.from_json("spec", "parameters map<string,variant>", J.OPTIONS)["parameters"])
    unquoted = F.exists(
        kinds, lambda e: ~F.schema_of_variant(e["value"]).rlike("^(STRING|OBJECT|ARRAY|VOID)")
    )
    params = F.when(
        F.col("_has_params") & F.coalesce(unquoted, F.lit(False)),
        F.raise_error(F.concat(F.lit("a parameter is a number or truth value in "), F.col("name"))),
    ).when(
        F.col("_has_params"),
        _must(
            J.unique_entries(F.col("_given")),
            F.concat(F.lit("parameters of "), F.col("name"), F.lit(" are no object")),
        ),
    ).otherwise(F.array().cast("array<struct<key:string,value:string>>"))
    return computed(split, parameters=F.transform(params, _parameter)).select(
        "tool_ord", "name", "description", "parameters"
    )


def _must(value: Column, message: Column) -> Column:
    return F.when(value.isNotNull(), value).otherwise(F.raise_error(message))


def _parameter(entry: Column) -> Column:
    given = F.from_json(
        entry["value"], "type string, description string, required string", J.OPTIONS
    )
    word = F.lower(given["required"])
    bare = ~F.startswith(F.coalesce(entry["value"], F.lit("")), F.lit("{"))
    listed = F.startswith(F.coalesce(entry["value"], F.lit("")), F.lit("["))
    is_list = F.concat(F.lit("parameter "), entry["key"], F.lit(" is no object but a list"))

    def field(name: str) -> Column:
        return _must(
            given[name],
            F.concat(F.lit("parameter "), entry["key"], F.lit(f" lacks its {name}")),
        )

    missing = F.concat(F.lit("parameter "), entry["key"], F.lit(" is null"))
    return F.struct(
        entry["key"].alias("name"),
        F.when(listed, F.raise_error(is_list))
        .when(bare, _must(entry["value"], missing))
        .otherwise(field("type"))
        .alias("type"),
        F.when(bare, F.lit("")).otherwise(field("description")).alias("description"),
        F.when(bare, F.lit(True))
        .otherwise(
            F.when(word.isNull() | word.isin(*TRUE_WORDS), True)
            .when(word.isin(*FALSE_WORDS), False)
            .otherwise(F.raise_error(F.concat(F.lit("unclear `required` of parameter "), entry["key"])))
        )
        .alias("required"),
    )


def tool_schema(catalog: DataFrame) -> DataFrame:
    """One row per tool with its function schema as JSON text."""
    params = F.col("parameters")
    names = F.transform(params, lambda p: p["name"])
    properties = F.map_from_arrays(
        names,
        F.transform(
            params, lambda p: F.struct(p["type"].alias("type"), p["description"].alias("description"))
        ),
    )
    required = F.transform(F.filter(params, lambda p: p["required"]), lambda p: p["name"])
    function = F.struct(
        F.lit("function").alias("type"),
        F.struct(
            F.col("name"),
            F.col("description"),
            F.struct(
                F.lit("object").alias("type"),
                properties.alias("properties"),
                required.alias("required"),
            ).alias("parameters"),
        ).alias("function"),
    )
    return catalog.select("tool_ord", "name", F.to_json(function).alias("schema"))


def schema_list(catalog: DataFrame) -> Column:
    """The schemas of all tools, in order, as one JSON array: a value for every row.

    A scalar subquery: evaluated once and read where lines are written.
    """
    ordered = F.array_sort(F.collect_list(F.struct("tool_ord", "schema")))
    texts = F.transform(ordered, lambda one: one["schema"])
    return (
        tool_schema(catalog)
        .agg(F.concat(F.lit("["), F.array_join(texts, ","), F.lit("]")).alias("schemas"))
        .scalar()
    )
