"""Text helpers as Column expressions (no Python workers)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The characters that Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The fence marks a model may put around its JSON.
JSON_FENCE = "```json"
FENCE = "```"


def strip(text: Column) -> Column:
    """Trim Unicode white space on both ends, in linear time."""
    return F.btrim(text, F.lit(WHITESPACE))


def unfence_anchored(text: Column) -> Column:
    """Drop an opening JSON fence at the very start and a fence at the very end.

    White space outside the fences defeats the rule, because nothing is trimmed
    before the test. The result is not trimmed either; see `strip`.
    """
    opened = F.when(
        text.startswith(JSON_FENCE), text.substr(F.lit(len(JSON_FENCE) + 1), F.length(text))
    ).otherwise(text)
    return F.when(
        opened.endswith(FENCE),
        opened.substr(F.lit(1), F.length(opened) - F.lit(len(FENCE))),
    ).otherwise(opened)


def unfence_anywhere(text: Column) -> Column:
    """Text inside the first fenced block; text without a fence stays untouched.

    A JSON fence wins over a plain one that comes earlier. The block ends at the
    next fence of any kind, or at the end of the text.
    """

    def block(mark: str) -> Column:
        after = F.split_part(text, F.lit(mark), F.lit(2))
        return strip(F.split_part(after, F.lit(FENCE), F.lit(1)))

    return (
        F.when(text.contains(JSON_FENCE), block(JSON_FENCE))
        .when(text.contains(FENCE), block(FENCE))
        .otherwise(text)
    )
