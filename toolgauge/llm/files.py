"""Binary files in the shared folder: written by tasks, listed and read by Spark."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from toolgauge.session import shared_folder


def new_folder(spark: SparkSession, kind: str) -> str:
    """A folder of its own for one set of files, as a URI."""
    folder = shared_folder(spark)
    if ":/" not in folder:
        folder = f"file://{folder}"
    return f"{folder}/{kind}/{uuid.uuid4().hex}"


def write(folder: str, name: str, data: bytes) -> None:
    """Put a file in place as a whole, from a task.

    A repeated or parallel attempt writes the same bytes under the same name, so it does
    not matter which of them comes last.
    """
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(folder)
    system.create_dir(path, recursive=True)
    part = f"{path}/_{uuid.uuid4().hex}.part"
    with system.open_output_stream(part) as out:
        out.write(data)
    try:
        system.move(part, f"{path}/{name}")
    except OSError:  # some stores do not replace a file
        system.delete_file(f"{path}/{name}")
        system.move(part, f"{path}/{name}")


def contents(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """path, content: one row per file. Files are of bounded size by their writers."""
    from pyarrow import fs

    # Without a single file written there is no folder; Spark wants one to read.
    system, path = fs.FileSystem.from_uri(folder)
    system.create_dir(path, recursive=True)
    return (
        spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
        .select("path", "content")
    )
