"""Session settings for local runs, and tables in the shared folder."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int = 8, name: str = "toolgauge") -> SparkSession:
    """A session for tests and the bench; on a cluster the launcher brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# Folders of local sessions that name none, by application.
_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; one of our own only in local mode."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir", "")
    folder = folder or spark.conf.get("spark.checkpoint.dir", "")
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        application = spark.sparkContext.applicationId
        if application not in _local_folders:
            _local_folders[application] = tempfile.mkdtemp(prefix="toolgauge-")
        folder = _local_folders[application]
    return folder


# Lists that note the tables settled while they are open.
_noting: list[list[str]] = []


@contextlib.contextmanager
def noted_tables():
    """The paths of all tables settled inside the block, as a list that grows."""
    paths: list[str] = []
    _noting.append(paths)
    try:
        yield paths
    finally:
        _noting.remove(paths)


def remove_tables(spark: SparkSession, paths: list[str]) -> None:
    """Remove settled tables that nothing will read again."""
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def settle(rows: DataFrame) -> DataFrame:
    """Write rows to a table in the shared folder and go on from there.

    Cuts lineage so that it survives lost executors, and, unlike a checkpoint, leaves
    neither old constraints (which multiply over rounds of self-joins) nor unknown
    sizes behind: later joins see how large the table really is.
    """
    path = f"{shared_folder(rows.sparkSession)}/tables/{uuid.uuid4().hex}"
    for paths in _noting:
        paths.append(path)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
