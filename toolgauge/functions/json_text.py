"""Strict JSON over string columns, built from native functions only.

`from_json` alone is lenient: it stops after the first value and ignores what
follows. Every strict parse here wraps the text as the first element of an array
whose second element is an end mark, and accepts only an array of exactly these
two. Anything that closes early, runs on, or holds two values fails that test.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The reader's own limits on one value are lifted: only memory bounds a text.
_NO_LIMIT = str(2**31 - 1)
OPTIONS = {
    "allowSingleQuotes": "false",
    "maxNestingDepth": _NO_LIMIT,
    "maxNumLen": _NO_LIMIT,
    "maxStringLen": _NO_LIMIT,
}

# Long and specific, so that no real text spells it by accident.
END_KEY = "__toolgauge_end_of_value_5f1c9e7a__"

CALL_SCHEMA = (
    f"array<struct<name:string,arguments:map<string,string>,`{END_KEY}`:string>>"
)


def _wrapped(text: Column, end_mark: str) -> Column:
    return F.concat(F.lit("["), text, F.lit("," + end_mark + "]"))


def foreign_numbers(text: Column) -> Column:
    """True where a word outside strings is a number to the reader but not to Python.

    The reader takes INF in all signs and +Infinity; Python only NaN and (-)Infinity.
    """
    bare = F.regexp_replace(text, '"[^"\\\\]*+(?:\\\\.[^"\\\\]*+)*+"', "")
    return F.when(text.contains("INF") | text.contains("+I"), bare.rlike("INF|[+]Infinity")).otherwise(
        F.lit(False)
    )


def is_json(text: Column) -> Column:
    """True where the whole text is one JSON value."""
    parts = F.from_json(_wrapped(text, f'"{END_KEY}"'), "array<string>", OPTIONS)
    return F.coalesce(
        (F.size(parts) == 2) & (F.get(parts, F.lit(1)) == END_KEY) & ~foreign_numbers(text),
        F.lit(False),
    )


def parse_object(text: Column) -> Column:
    """One-pass strict parse of an object; read the result with `parsed_object`."""
    return F.from_json(
        _wrapped(text, f'{{"{END_KEY}":"1"}}'), "array<map<string,string>>", OPTIONS
    )


def parsed_object(parsed: Column) -> Column:
    """The object as an ordered map of texts, NULL when the text is not one object."""
    closed = (F.size(parsed) == 2) & F.map_contains_key(F.get(parsed, F.lit(1)), END_KEY)
    return F.when(closed, F.get(parsed, F.lit(0)))


def parse_call(text: Column) -> Column:
    """One-pass strict parse of a tool call.

    Array of struct(name, arguments, end mark); test it with `call_closed` and read
    it with `call_value`. NULL when the text is not JSON or its root is no object.
    Numbers, booleans and nested values arrive as text, in key order.
    """
    return F.from_json(_wrapped(text, f'{{"{END_KEY}":"1"}}'), CALL_SCHEMA, OPTIONS)


def call_closed(parsed: Column) -> Column:
    return F.coalesce(
        (F.size(parsed) == 2) & (F.get(parsed, F.lit(1))[END_KEY] == "1"), F.lit(False)
    )


def call_value(parsed: Column) -> Column:
    return F.get(parsed, F.lit(0))


def object_fields(text: Column) -> Column:
    """Object as an ordered map of texts; a missing key and a null value differ."""
    return F.from_json(text, "map<string,string>", OPTIONS)


def field_type(text: Column, field: str) -> Column:
    """JSON type name of one top-level field, e.g. STRING or BIGINT."""
    return F.schema_of_variant(F.from_json(text, f"`{field}` variant", OPTIONS)[field])


def unique_entries(fields: Column) -> Column:
    """Map entries with repeated keys folded: first position, last value."""
    entries = F.map_entries(fields)
    keys = F.map_keys(fields)
    folded = F.transform(
        F.filter(entries, lambda e, i: F.array_position(keys, e["key"]) == i + 1),
        lambda e: F.struct(
            e["key"].alias("key"), last_value(entries, e["key"]).alias("value")
        ),
    )
    return F.when(F.size(F.array_distinct(keys)) < F.size(keys), folded).otherwise(entries)


def unique_fields(fields: Column) -> Column:
    """The map itself, or a folded copy when keys repeat."""
    keys = F.map_keys(fields)
    return F.when(
        F.size(F.array_distinct(keys)) < F.size(keys), F.map_from_entries(unique_entries(fields))
    ).otherwise(fields)


def last_value(entries: Column, key: Column) -> Column:
    """Value of the last entry with that key, NULL when there is none."""
    return F.get(F.reverse(F.filter(entries, lambda e: e["key"] == key)), F.lit(0))["value"]


def same_value(left: str, right: str) -> str:
    """SQL: case-insensitive equality of two JSON values as text; equal text costs no more."""
    return f"({left} <=> {right} OR {value_text(left)} = {value_text(right)})"


def value_text(value: str) -> str:
    """SQL: lower-cased text of a JSON value, written the way Python's str() writes it.

    The JSON reader prints floats in scientific form outside 10^-3 .. 10^7, Python
    outside 10^-4 .. 10^16; a quoted number in a prediction follows Python.
    """
    return f"""lower(CASE
        WHEN {value} IS NULL THEN 'none'
        WHEN {value} = 'Infinity' THEN 'inf'
        WHEN {value} = '-Infinity' THEN '-inf'
        WHEN {value} RLIKE '^-?[0-9][.][0-9]+E-?[0-9]+$' THEN {_python_float(value)}
        ELSE {value} END)"""


def _python_float(value: str) -> str:
    # Older JVMs print some doubles with more digits than tell them apart: the first of
    # 1, 15, 16 and 17 digits that reads back as the same number is what Python prints.
    number = f"try_cast({value} AS DOUBLE)"
    tried = [f"format_string('%.{digits}e', {number})" for digits in (0, 14, 15, 16)]
    shortest = "CASE " + " ".join(
        f"WHEN try_cast({text} AS DOUBLE) = {number} THEN {text}" for text in tried
    ) + f" ELSE replace({value}, 'E', 'e') END"
    mantissa = f"""regexp_replace(regexp_replace(
        split_part({shortest}, 'e', 1), '0+$', ''), '[.]$', '.0')"""
    power = f"try_cast(split_part({shortest}, 'e', 2) AS INT)"
    short = f"regexp_replace({mantissa}, '[.]0$', '')"
    # 18 digits before and 20 after the point hold every plain-form double here.
    plain = f"""regexp_replace(regexp_replace(CAST(
        try_cast(concat({mantissa}, 'E', {power}) AS DECIMAL(38, 20)) AS STRING), '0+$', ''), '[.]$', '.0')"""
    return f"""CASE
        WHEN {power} BETWEEN -4 AND 15 THEN {plain}
        WHEN {power} >= 16 THEN concat({short}, 'e+', {power})
        ELSE concat({short}, 'e-', if(abs({power}) < 10, '0', ''), abs({power})) END"""


def python_spacing(text: Column) -> Column:
    """Valid JSON text with Python's default separators: ', ' and ': '.

    Text between quotes stays as it is. Escaped quotes are hidden behind control
    characters, which valid JSON text cannot hold, so every other segment of a
    split at the quotes is structure.
    """
    hidden = F.replace(
        F.replace(text, F.lit("\\\\"), F.lit("\x01")), F.lit('\\"'), F.lit("\x02")
    )
    spaced = F.transform(
        F.split(hidden, '"'),
        lambda part, i: F.when(
            i % 2 == 0,
            F.replace(
                F.replace(
                    F.regexp_replace(part, r"[ \t\r\n]+", ""), F.lit(","), F.lit(", ")
                ),
                F.lit(":"),
                F.lit(": "),
            ),
        ).otherwise(part),
    )
    joined = F.array_join(spaced, '"')
    return F.replace(
        F.replace(joined, F.lit("\x02"), F.lit('\\"')), F.lit("\x01"), F.lit("\\\\")
    )


def json_string(text: Column) -> Column:
    """Text as a quoted JSON string; NULL as JSON null."""
    packed = F.to_json(F.array(text), {"ignoreNullFields": "false"})
    return packed.substr(F.lit(2), F.length(packed) - F.lit(2))
