"""Packing token pieces into windows by non-negative least squares.

A document becomes its token ids and an end id, cut into full windows and a rest. Pieces
are counted by length, in units of UNIT tokens. All combinations of up to DEPTH lengths
that fill a window are enumerated; non-negative least squares finds how often each is
repeated so that together they use up the histogram. Counts are rounded down to what is
there, and what remains is packed greedily, longest first. All of this works on the
histogram, which has WINDOW / UNIT entries whatever the number of documents.

Piece number r of a length then looks up which window it belongs to; only rows of numbers
are shuffled, never ids. Ranks are taken inside salted groups, so a length that most
pieces share is no hot group.

Defined results: null text is empty text: one piece, the end id. Rows that repeat are
packed as often as they come; a null doc_id stays null. An empty table gives an empty
result. Columns besides doc_id and text are not looked at.
"""

from __future__ import annotations

import zlib
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from toolgauge.llm import rows, tokens
from toolgauge.operators.ranking import dense_positions
from toolgauge.session import settle

WINDOW = 2048
UNIT = 8
DEPTH = 3
END_ID = 1
# Rows of one salted group when all pieces have the same length.
GROUP_ROWS = 50_000
MIN_SALTS = 16


def pieces(docs: DataFrame, path: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """doc_id, text -> doc_id, start, length, ids_crc32, doc_tokens: windows and a rest."""

    def cut(batches):
        encode = tokens.library_encoder(path)
        for batch in rows.parts(batches, "text"):
            doc_ids = batch.column("doc_id").to_pylist()
            texts = batch.column("text").to_pylist()
            columns: list[list] = [[], [], [], [], []]
            for doc_id, ids in zip(doc_ids, encode(texts)):
                wide = np.append(ids, end_id).astype("<u4")
                for start in range(0, len(wide), window):
                    part = wide[start : start + window]
                    row = (doc_id, start, len(part), zlib.crc32(part.tobytes()), len(wide))
                    for column, value in zip(columns, row):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        cut, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    )


def _combinations(units: int, depth: int) -> list[tuple[int, ...]]:
    """Up to `depth` lengths that fill a window exactly, longest first."""
    found = []
    for k in range(1, depth + 1):
        for head in combinations_with_replacement(range(units, 0, -1), k - 1):
            last = units - sum(head)
            if last >= 1 and (not head or last <= head[-1]):
                found.append((*head, last))
    return found


def non_negative_least_squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """x >= 0 with the least |a x - b|, by active sets: few entries differ from 0."""
    x, active = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    tiny = 1e-9 * max(1.0, float(np.abs(b).max()))
    for _ in range(6 * a.shape[0]):
        slope = a.T @ (b - a @ x)
        slope[active] = -np.inf
        best = int(slope.argmax())
        if slope[best] <= tiny:
            break
        active[best] = True
        while True:
            at = np.flatnonzero(active)
            part = a[:, at]
            solved = np.linalg.solve(part.T @ part + 1e-10 * np.eye(len(at)), part.T @ b)
            if (solved > 0).all():
                break
            # Go towards the solution until the first entry reaches 0, and drop that one.
            low = solved <= 0
            with np.errstate(divide="ignore", invalid="ignore"):
                share = np.nanmin(x[at][low] / (x[at][low] - solved[low]))
            x[at] += share * (solved - x[at])
            gone = at[low & (x[at] <= tiny)]
            active[gone if len(gone) else at[low]] = False
            x[~active] = 0
        x[:] = 0
        x[at] = solved
    return x


def plan(counts: np.ndarray, depth: int = DEPTH) -> list[tuple[tuple[int, ...], int]]:
    """counts[u]: pieces of u units (u = 1 .. units) -> (units of each piece, repeats)."""
    units, left, out = len(counts) - 1, counts.astype(np.int64).copy(), []
    lone = int(left[units])
    if lone:  # a piece that fills a window needs no partner
        out.append(((units,), lone))
        left[units] = 0
    if left.any():
        fills = [c for c in _combinations(units, depth) if len(c) > 1 and all(left[u] for u in c)]
        if fills:
            a = np.zeros((units, len(fills)))
            for j, combination in enumerate(fills):
                for u in combination:
                    a[u - 1, j] += 1
            x = non_negative_least_squares(a, left[1:].astype(float))
            for j in np.argsort(-x, kind="stable"):
                if x[j] < 0.5:
                    break
                members, times = np.unique(fills[j], return_counts=True)
                repeats = int(min(round(x[j]), *(left[members] // times)))
                if repeats:
                    out.append((fills[j], repeats))
                    left[members] -= repeats * times
    while left.any():
        chosen, room, free = [], units, left.copy()
        while (fit := np.flatnonzero(free[: room + 1])).size:
            u = int(fit[-1])
            chosen.append(u)
            room -= u
            free[u] -= 1
        members, times = np.unique(chosen, return_counts=True)
        repeats = int((left[members] // times).min())
        out.append((tuple(chosen), repeats))
        left[members] -= repeats * times
    return out


def _slots(planned) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length: where runs of ranks begin, their first sequence, place in a sequence."""
    runs: dict[int, list] = {}
    taken: dict[int, int] = {}
    sequence = 0
    for combination, repeats in planned:
        for place, u in enumerate(combination):
            first = taken.get(u, 0)
            runs.setdefault(u, []).append((first, sequence, place))
            taken[u] = first + repeats
        sequence += repeats
    return {u: tuple(np.array(column, np.int64) for column in zip(*rows)) for u, rows in runs.items()}


def pack(cut: DataFrame, window: int = WINDOW, unit: int = UNIT, depth: int = DEPTH) -> DataFrame:
    """Pieces (settled) with `length` in 1 .. window -> the same with sequence_id and offset."""
    sized = cut.withColumn("_units", F.ceil(F.col("length") / unit).cast("int"))
    # At most window / unit rows.
    found = {r["_units"]: r["count"] for r in sized.groupBy("_units").count().collect()}
    counts = np.zeros(window // unit + 1, np.int64)
    for u, n in found.items():
        counts[u] = n
    slots = _slots(plan(counts, depth))
    before = np.cumsum(counts) - counts
    salts = max(MIN_SALTS, -(-int(counts.sum()) // GROUP_ROWS))
    names = [*cut.columns]
    salted = sized.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "start"), F.lit(salts)).cast("int"))
    ranked = dense_positions(salted, ["_units", "_salt"], ["doc_id", "start", "ids_crc32"], "_rank_all")

    def place(batches):
        for batch in batches:
            units = batch.column("_units").to_numpy(zero_copy_only=False).astype(np.int64)
            rank = batch.column("_rank_all").to_numpy(zero_copy_only=False) - before[units]
            sequence, order = np.zeros(len(units), np.int64), np.zeros(len(units), np.int64)
            for u in np.unique(units):
                at = np.flatnonzero(units == u)
                first, base, where = slots[int(u)]
                run = np.searchsorted(first, rank[at], side="right") - 1
                sequence[at] = base[run] + rank[at] - first[run]
                order[at] = where[run]
            arrays = [batch.column(name) for name in names]
            yield pa.RecordBatch.from_arrays(
                [*arrays, pa.array(sequence), pa.array(order)],
                names=[*names, "sequence_id", "_order"],
            )

    schema = ", ".join(f"`{name}` {kind}" for name, kind in cut.dtypes)
    placed = ranked.mapInArrow(place, f"{schema}, sequence_id long, _order long")
    earlier = Window.partitionBy("sequence_id").orderBy("_order").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(earlier), F.lit(0))).drop("_order")


def pack_documents(docs: DataFrame, path: str, window: int = WINDOW) -> DataFrame:
    """doc_id, text -> one row per piece: its span, checksum, sequence and offset there."""
    return pack(settle(pieces(docs, path, window)), window)
