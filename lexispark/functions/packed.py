"""Rows that go through a shuffle as compressed columns: each task puts the
rows for one partition together, Arrow batches in, Arrow batches out."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame

#: rows, and bytes of them, that are put together
HELD_ROWS, HELD_BYTES = 1_000_000, 64 << 20
#: the column of lists of ascending integers
LISTS = "positions"
#: a partition that gets so many times its share of these rows passes the others on
SURPLUS = 4


def _ipc(batch: pa.RecordBatch) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_batch(batch)
    return out.getvalue().to_pybytes()


def _from_ipc(said: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(said).read_next_batch()


def _steps(lists: pa.ListArray) -> pa.Array:
    """The lists' values one after the other, each as its step from the one before it in its list."""
    values = lists.flatten().to_numpy()
    steps = np.diff(values, prepend=values[:1])
    begins = _begins(pc.list_value_length(lists).to_numpy())
    begins = begins[begins < len(values)]
    steps[begins] = values[begins]
    return pa.array(steps)


def _begins(lengths: np.ndarray) -> np.ndarray:
    return np.cumsum(lengths) - lengths


def _lists(lengths: np.ndarray, steps: np.ndarray) -> pa.Array:
    upto = np.append(0, np.cumsum(steps, dtype=np.int64))
    begins = _begins(lengths.astype(np.int64))
    values = upto[1:] - np.repeat(upto[begins], lengths)
    return pa.ListArray.from_arrays(pa.array(np.append(begins, len(steps)).astype(np.int32)), pa.array(values.astype(np.int32)))


def _block(rows: pa.Table) -> tuple[bytes, bytes]:
    """Columns, with strings as codes and a column of lists as lengths; the lists' values."""
    columns, values = [], b""
    for name, c in zip(rows.column_names, rows.columns, strict=True):
        c = c.combine_chunks()
        if pa.types.is_string(c.type):
            c = c.dictionary_encode()
        elif name == LISTS:
            values = _ipc(pa.RecordBatch.from_arrays([_steps(c)], names=["steps"]))
            c = pc.list_value_length(c)
        columns.append(c)
    return _ipc(pa.RecordBatch.from_arrays(columns, names=rows.column_names)), values


def pack(batches: Iterator[pa.RecordBatch], n: int, spread: bool) -> Iterator[pa.RecordBatch]:
    """Rows whose last column is their partition -> ``part, rows, lists``."""
    turn = TaskContext.get().partitionId()

    def blocks(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nonlocal turn
        table = pa.Table.from_batches(held)
        part = table.column(table.num_columns - 1).to_numpy()
        by = np.argsort(part, kind="stable")
        part = part[by]
        table = table.select(table.column_names[:-1]).take(pa.array(by))
        cuts = np.append(np.flatnonzero(np.diff(part, prepend=-1)), len(part))
        most = max(10_000, SURPLUS * len(part) // n) if spread else len(part)
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            for at in range(lo, hi, most):
                to = int(part[lo])
                if at > lo:  # more than its share: to each partition in turn
                    turn += 1
                    to = turn % n
                columns, lists = _block(table.slice(at, min(most, hi - at)))
                yield pa.RecordBatch.from_arrays([pa.array([to], pa.int32()), pa.array([columns], pa.binary()), pa.array([lists], pa.binary())], names=["part", "rows", "lists"])

    held: list[pa.RecordBatch] = []
    n_rows = n_bytes = 0
    for batch in batches:
        held.append(batch)
        n_rows, n_bytes = n_rows + batch.num_rows, n_bytes + batch.nbytes
        if n_rows >= HELD_ROWS or n_bytes >= HELD_BYTES:
            yield from blocks(held)
            held, n_rows, n_bytes = [], 0, 0
    if n_rows:
        yield from blocks(held)


def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for columns, lists in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            own = _from_ipc(columns)
            steps = _from_ipc(lists).column(0).to_numpy() if lists else None
            shown = []
            for name, c in zip(own.schema.names, own.columns, strict=True):
                if pa.types.is_dictionary(c.type):
                    c = c.dictionary_decode()
                elif steps is not None and name == LISTS:
                    c = _lists(c.to_numpy(), steps)
                shown.append(c)
            yield from pa.table(shown, names=own.schema.names).to_batches(max_chunksize=10_000)


def dealt(rows: DataFrame, n: int, part: Column, spread: bool = False) -> DataFrame:
    """``rows`` in ``n`` partitions by ``part`` (0 to n - 1), shuffled as
    compressed columns. ``positions`` go as their
    steps; no other column may hold lists. With ``spread`` the rows above
    a partition's share go to others, so that no hot key fills one task."""
    held = rows.select("*", part.cast("int").alias("_part")).mapInArrow(partial(pack, n=n, spread=spread), "part int, rows binary, lists binary")
    return held.repartitionById(n, "part").select("rows", "lists").mapInArrow(unpack, rows.schema)
