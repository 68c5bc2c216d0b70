"""Telling rows apart, and bringing verdicts about rows back to them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from toolgauge.session import settle


def fresh(taken, name: str) -> str:
    """A column name that no given column has, whatever its case."""
    lower = {column.lower() for column in taken}
    while name.lower() in lower:
        name = f"_{name}"
    return name


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """Write the rows with a number each, under a name that is free, and go on from there.

    Rows may share a doc_id, a text, or everything. How a scan is cut into partitions
    depends on the cores registered when its job starts, so a place in it can differ from
    job to job; the numbers are therefore stored with the rows, once.
    """
    name = fresh(docs.columns, "_place")
    return settle(docs.withColumn(name, F.monotonically_increasing_id())), name


def only(docs: DataFrame, place: str, chosen: DataFrame) -> DataFrame:
    """The rows of a numbered table whose number is in `chosen` (one column, same name)."""
    return docs.join(chosen.select(place), place, "left_semi").drop(place)


def texts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, text) alone; a null text is an empty one."""
    return docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"),
    )


def parts(batches, column: str, size: int = 4 << 20):
    """Arrow batches cut into smaller ones, of about `size` bytes in a column each."""
    for batch in batches:
        step = max(1, int(batch.num_rows * size / max(batch.column(column).nbytes, 1)))
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)
