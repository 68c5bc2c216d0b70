"""Appends that readers see whole or not at all.

A writer puts its rows into a staging folder of its own, then publishes them by moving a small
manifest to the next free number. The move fails if the number is taken, as a rename without
overwriting does on HDFS; then the next one is tried. Readers list the manifests first and
take only what they name, so rows of a writer that died stay unseen. A token names what is
written: of several manifests with one token the lowest number counts, so a repeated or
doubled write adds nothing.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F


def _files(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _publish(spark: SparkSession, path: str, draft: str) -> int:
    """Move the draft of a manifest to the lowest number after those taken."""
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    folder, files = _files(spark, f"{path}/commits")
    files.mkdirs(folder)
    source, _ = _files(spark, draft)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        source.toUri() if source.toUri().getScheme() else files.getUri(), spark._jsc.hadoopConfiguration()
    )
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = gateway.new_array(rename, 1)
    options[0] = rename.NONE
    number = 1 + max((int(one.getPath().getName().split(".")[0]) for one in files.listStatus(folder)), default=0)
    while True:
        target, _ = _files(spark, f"{path}/commits/{number}.json")
        try:
            context.rename(source, target, options)
            return number
        except Py4JJavaError as error:
            if "FileAlreadyExists" not in error.java_exception.getClass().getName():
                raise
            number += 1


def commits(spark: SparkSession, path: str) -> DataFrame:
    """(commit, token, staged): published writes, one per token."""
    folder, files = _files(spark, f"{path}/commits")
    if not files.exists(folder):
        return spark.createDataFrame([], "commit bigint, token string, staged string")
    listed = spark.read.schema("token string, staged string").json(f"{path}/commits")
    number = F.regexp_extract("_metadata.file_name", r"(\d+)\.json$", 1).cast("bigint")
    listed = listed.select(number.alias("commit"), "token", "staged")
    first = F.min(F.struct("commit", "staged")).alias("first")
    return listed.groupBy("token").agg(first).select("first.commit", "token", "first.staged")


def append(spark: SparkSession, tables: dict[str, DataFrame], path: str, token: str | None = None) -> int:
    """Write rows of several tables and publish them together; returns the number given.

    A token that is published already is not written again; its number is returned.
    """
    token = token or uuid.uuid4().hex
    known = commits(spark, path).filter(F.col("token") == token).select("commit").first()
    if known:
        return known[0]
    staged = uuid.uuid4().hex
    for name, rows in tables.items():
        rows.write.json(f"{path}/{name}/staged={staged}", ignoreNullFields=False)
    draft, files = _files(spark, f"{path}/drafts/{staged}.json")
    out = files.create(draft)
    out.write(bytearray(json.dumps({"token": token, "staged": staged}).encode()))
    out.close()
    _publish(spark, path, f"{path}/drafts/{staged}.json")
    return commits(spark, path).filter(F.col("token") == token).first()["commit"]


def read(spark: SparkSession, path: str, name: str, schema: str) -> DataFrame:
    """Published rows of a table, with the number of their `commit`."""
    # Manifests come first: what they name was complete when they were listed.
    published = commits(spark, path)
    folder, files = _files(spark, f"{path}/{name}")
    if not files.exists(folder):
        return spark.createDataFrame([], f"commit bigint, {schema}")
    rows = spark.read.schema(f"{schema}, staged string").json(f"{path}/{name}")
    return rows.join(published.select("commit", "staged"), "staged").drop("staged")
