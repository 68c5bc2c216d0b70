"""Vectors in files of bounded size in the shared folder, which tasks read one after the other.

Where every chunk of vectors may have to meet every other one, shuffling a copy to each meeting
takes disk with the square of their number. Files are written once and read as often as needed:
disk stays in proportion to the vectors, and a task holds two chunks whatever their number.
"""

from __future__ import annotations

import io
import math
import uuid
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from toolgauge.operators import distance
from toolgauge.session import remove_tables, settle, shared_folder

ROWS = 2048


@dataclass(frozen=True)
class Chunks:
    folder: str
    heads: list[dict]  # chunk, middle, radius: one per chunk that is not empty
    places: DataFrame  # pid, chunk, at


def new_folder(spark: SparkSession) -> str:
    folder = shared_folder(spark)
    return f"{folder if ':/' in folder else f'file://{folder}'}/chunks/{uuid.uuid4().hex}"


def write(folder: str, chunk: int, **arrays: np.ndarray) -> None:
    """Put a file in place as a whole, from a task; a repeated attempt writes the same."""
    from pyarrow import fs

    data = io.BytesIO()
    np.savez(data, **arrays)
    system, path = fs.FileSystem.from_uri(folder)
    system.create_dir(path, recursive=True)
    part = f"{path}/_{uuid.uuid4().hex}.part"
    with system.open_output_stream(part) as out:
        out.write(data.getvalue())
    try:
        system.move(part, f"{path}/{chunk}")
    except OSError:  # some stores do not replace a file
        system.delete_file(f"{path}/{chunk}")
        system.move(part, f"{path}/{chunk}")


def read(folder: str, chunk: int) -> dict[str, np.ndarray]:
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(folder)
    with system.open_input_file(f"{path}/{chunk}") as file:
        return dict(np.load(io.BytesIO(file.read())))


def vectors(folder: str, chunk: int) -> dict[str, np.ndarray]:
    """A chunk with its vectors as 64-bit numbers."""
    found = read(folder, chunk)
    return found | {"vec": found["vec"].astype(np.float64)}


def remove(spark: SparkSession, folder: str) -> None:
    remove_tables(spark, [folder])


def store(points: DataFrame, rows: int | None = None) -> Chunks:
    """Points (pid, weight, vec, block) in files: blocks in order, so that near points meet.

    A file has the rows of each block next to each other (`starts`), with the centre and radius of
    every block. Ranges of (block, pid) can be cut anywhere, so no chunk gets large.
    """
    spark = points.sparkSession
    count = max(1, math.ceil(points.count() / (rows or ROWS)))
    folder = new_folder(spark)

    def put(batches):
        tables = [batch for batch in batches if batch.num_rows]
        table = pa.Table.from_batches(tables) if tables else None
        if table is None:
            return
        flat = pa.concat_arrays([c.flatten() for c in table.column("vec").chunks])
        vec = flat.to_numpy(zero_copy_only=False).astype(np.float32).reshape(table.num_rows, len(flat) // table.num_rows)
        pid = table.column("pid").to_numpy()
        _, starts = np.unique(np.asarray(table.column("block").to_pylist()), return_index=True)
        starts = np.sort(starts)
        ends = np.append(starts[1:], len(vec))
        x = vec.astype(np.float64)
        middles = np.stack([x[a:b].mean(axis=0) for a, b in zip(starts, ends)])
        radii = np.array([distance.direct(x[a:b], m).max() for a, b, m in zip(starts, ends, middles)])
        chunk, middle = TaskContext.get().partitionId(), x.mean(axis=0)
        write(
            folder, chunk, pid=pid, weight=table.column("weight").to_numpy(), vec=vec,
            starts=starts, middles=middles, radii=radii,
        )
        head = {"chunk": chunk, "middle": middle.tolist(), "radius": float(distance.direct(x, middle).max())}
        at = pa.array(np.arange(len(vec)))
        heads = pa.array([head] + [None] * (len(vec) - 1), pa.struct([("chunk", pa.int64()), ("middle", pa.list_(pa.float64())), ("radius", pa.float64())]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(pid), pa.array(np.full(len(vec), chunk, np.int64)), at, heads], names=["pid", "chunk", "at", "head"]
        )

    ranged = points.select("pid", "weight", "vec", "block").repartitionByRange(count, "block", "pid")
    schema = "pid long, chunk long, at long, head struct<chunk:long,middle:array<double>,radius:double>"
    places = settle(ranged.sortWithinPartitions("block", "pid").mapInArrow(put, schema))
    # One row per chunk.
    heads = [row.head.asDict() for row in places.filter("head IS NOT NULL").select("head").collect()]
    return Chunks(folder, sorted(heads, key=lambda h: h["chunk"]), places.drop("head"))


def store_facts(chunks: Chunks, facts: DataFrame) -> str:
    """Facts (pid, numbers) of the points, in files beside those of the vectors; their folder."""
    folder = new_folder(facts.sparkSession)
    names = [name for name in facts.columns if name != "pid"]

    def put(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("at")
        write(folder, int(key[0]), **{name: rows[name].to_numpy() for name in names})
        return pd.DataFrame({"rows": [len(rows)]})

    # Once only: a second run of the job would write the same files again.
    chunks.places.join(facts, "pid").groupBy("chunk").applyInPandas(put, "rows long").agg(F.sum("rows")).first()
    return folder


def for_each(spark: SparkSession, chunks: Chunks, task: Callable[[int], pd.DataFrame], schema: str) -> DataFrame:
    """What `task` returns for every chunk: one task of Spark for each."""
    numbers = [head["chunk"] for head in chunks.heads]

    def run(batches):
        for batch in batches:
            for number in batch.column("id").to_pylist():
                yield pa.RecordBatch.from_pandas(task(numbers[number]), preserve_index=False)

    count = max(1, len(numbers))
    return spark.range(0, len(numbers), 1, count).mapInArrow(run, schema)
