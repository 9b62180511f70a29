"""Byte-level access to Arrow string columns, shared by the Arrow-batched operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Text bytes that one numpy step holds at once; a longer single text makes a step of its own.
STEP_BYTES = 2 << 20


def byte_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (n + 1, from 0) and UTF-8 bytes of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, starts, data = column.buffers()
    if starts is None or len(column) == 0:
        return np.zeros(len(column) + 1, np.int64), np.zeros(0, np.uint8)
    offsets = np.frombuffer(starts, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return offsets - offsets[0], raw[offsets[0] : offsets[-1]]


def row_ranges(offsets: np.ndarray, limit: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of at most ``limit`` bytes each, or a single longer row."""
    low, n = 0, len(offsets) - 1
    while low < n:
        high = int(np.searchsorted(offsets, offsets[low] + limit, side="right")) - 1
        high = min(n, max(low + 1, high))
        yield low, high
        low = high


def steps(column: pa.Array, limit: int = STEP_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row range, its offsets (from 0) and its bytes, step by step."""
    offsets, data = byte_view(column)
    for low, high in row_ranges(offsets, limit):
        yield low, high, offsets[low : high + 1] - offsets[low], data[offsets[low] : offsets[high]]


def whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, pa.Table]]:
    """Bounds of the groups and the rows, some whole groups at a time.

    Rows with equal numbers in the first column are a group and stand together in the input; what is held is
    a batch and the group that runs out of it.
    """

    def given(held: list[pa.RecordBatch]) -> tuple[np.ndarray, pa.Table]:
        table = pa.Table.from_batches(held).combine_chunks()
        keys = table.column(0).to_numpy()
        return np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]]), table

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(0).to_numpy()
        cuts = np.flatnonzero(keys[1:] != keys[:-1])
        last = int(cuts[-1]) + 1 if len(cuts) else 0
        if held and (last or held[-1].column(0)[-1].as_py() != keys[0]):
            yield given([*held, batch.slice(0, last)] if last else held)
            held = []
        elif last:
            yield given([batch.slice(0, last)])
        held.append(batch.slice(last))
    if held:
        yield given(held)


def read_table(spark, sf_dir: str, name: str):
    """One of the input tables, by Spark's reader."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
