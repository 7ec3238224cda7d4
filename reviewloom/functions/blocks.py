"""Numpy work on blocks of rows inside tasks.

Kept free of ML imports: Python workers load this module.
"""

from __future__ import annotations

from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK = 128  # matrix rows per shuffled piece
FAN_IN = 64  # pieces added per task and level
DIRECT_BYTES = 8 * 1024 * 1024  # partials up to this size go straight to the driver
BATCH_ROWS = 1000  # rows of many numbers sent to Python at a time

ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def small_batches(spark: SparkSession):
    """Arrow batches of at most BATCH_ROWS rows in the jobs run inside.

    A task holds a batch several times, on both sides of Python: Spark's default of 10,000
    rows is tens of megabytes each time for sparse rows of a few hundred entries.
    """
    before = spark.conf.get(ARROW_ROWS)
    if not 0 < int(before) <= BATCH_ROWS:
        spark.conf.set(ARROW_ROWS, str(BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(ARROW_ROWS, before)


def stack(arrays: pd.Series) -> np.ndarray:
    """A Series of equal-length arrays as one matrix."""
    if len(arrays) == 0:
        return np.empty((0, 0))
    return np.vstack(arrays.to_numpy()).astype(np.float64, copy=False)


def flatten_sparse(indices: pd.Series, values: pd.Series):
    """(row number, column, value) of all entries of a batch of sparse rows."""
    sizes = indices.map(len).to_numpy()
    if sizes.sum() == 0:
        none = np.empty(0, dtype=np.int64)
        return none, none, np.empty(0), sizes
    rows = np.repeat(np.arange(len(sizes)), sizes)
    return (
        rows,
        np.concatenate(indices.to_numpy()).astype(np.int64),
        np.concatenate(values.to_numpy()).astype(np.float64),
        sizes,
    )


def sum_by(keys: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sum rows of ``values`` that share a key into an (n, width) matrix."""
    out = np.zeros((n, values.shape[1]))
    if len(keys):
        order = np.argsort(keys, kind="stable")
        sorted_keys = keys[order]
        starts = np.flatnonzero(np.r_[True, sorted_keys[1:] != sorted_keys[:-1]])
        out[sorted_keys[starts]] = np.add.reduceat(values[order], starts, axis=0)
    return out


SLICE = 1 << 16  # entries of sparse rows worked on at a time


def flat_lists(first: pa.Array, second: pa.Array):
    """Entries of two list columns of equal lengths, and the end of each row's entries."""
    ends = np.cumsum(pc.fill_null(pc.list_value_length(first), 0).to_numpy(zero_copy_only=False))
    flat = [x.flatten().to_numpy(zero_copy_only=False) for x in (first, second)]
    return *flat, ends.astype(np.int64)


def row_slices(ends: np.ndarray):
    """(first entry, last entry + 1, row of each entry) of runs of whole rows with about
    SLICE entries, so what is worked out beside a batch does not grow with it."""
    start = 0
    while start < len(ends):
        first = int(ends[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, first + SLICE, side="right")))
        # Rows without entries that follow belong to the run.
        stop = int(np.searchsorted(ends, ends[stop - 1], side="right"))
        sizes = np.diff(ends[start:stop], prepend=first)
        yield first, int(ends[stop - 1]), np.repeat(np.arange(stop - start), sizes)
        start = stop


def lists_of(flat: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Flat entries as one list per row."""
    return pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), pa.array(flat))


CHUNK = 256  # sparse rows multiplied at a time
DENSE_ROWS = 1024  # dense rows measured against centroids at a time, if
CELLS = 1 << 21  # distances measured at a time allow so many


def _products(rows: np.ndarray, cols: np.ndarray, entries: np.ndarray, m: int, n: int):
    if len(rows) > 0.01 * m * n:
        dense = np.zeros((m, n))
        dense[rows, cols] = entries
        return m, dense.__matmul__, dense.T.__matmul__
    weights = entries[:, None]
    return (
        m,
        lambda q: sum_by(rows, weights * q[cols], m),
        lambda y: sum_by(cols, weights * y[rows], n),
    )


def sparse_chunks(indices: pd.Series, values: pd.Series, n: int):
    """(row count, forward, backward) per chunk of sparse rows.

    ``forward(q)`` is rows·q and ``backward(y)`` is rowsᵀ·y.  Rows filled above one
    percent go through a dense block, thinner ones through their entries.
    """
    for start in range(0, len(indices), CHUNK):
        rows, cols, entries, sizes = flatten_sparse(
            indices.iloc[start : start + CHUNK], values.iloc[start : start + CHUNK]
        )
        yield _products(rows, cols, entries, len(sizes), n)


def flat_chunks(ends: np.ndarray):
    """(first row, last row + 1, first entry, last entry + 1, row of each entry) of CHUNK
    rows at a time."""
    for start in range(0, len(ends), CHUNK):
        stop = min(start + CHUNK, len(ends))
        first = int(ends[start - 1]) if start else 0
        sizes = np.diff(ends[start:stop], prepend=first)
        yield start, stop, first, int(ends[stop - 1]), np.repeat(np.arange(stop - start), sizes)


def rows_times(rows: np.ndarray, cols: np.ndarray, entries: np.ndarray, m: int, q: np.ndarray) -> np.ndarray:
    """m sparse rows, given by their entries, times a matrix."""
    return _products(rows, cols, entries, m, len(q))[1](q)


def matrix_of(df: DataFrame, vector: str) -> np.ndarray:
    """An array column of a bounded table as one matrix."""
    column = df.select(vector).toArrow()[vector].combine_chunks()
    width = len(column[0]) if len(column) else 0
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), width)


def add_matrices(df: DataFrame, work, rows: int, width: int, parts: int) -> np.ndarray:
    """Sum over partitions of the (rows x width) matrix that ``work(batches)`` returns.

    The result itself must fit the driver (vocabulary x rank, or centroids x
    dimensions).  ``parts`` is the number of partitions; while the partial
    matrices together exceed DIRECT_BYTES they are added in a tree of at most
    FAN_IN pieces per task, so neither one task nor the driver sees them all.
    """

    def emit(batches):
        total = work(batches)
        if total is None:
            return
        part = TaskContext.get().partitionId()
        pieces = {b: total[b * BLOCK : (b + 1) * BLOCK] for b in range(-(-rows // BLOCK))}
        kept = {b: piece.tobytes() for b, piece in pieces.items() if piece.any()}
        yield pd.DataFrame({"part": part, "block": list(kept), "data": list(kept.values())})

    def add(key, group):
        pieces = np.frombuffer(b"".join(group["data"]), dtype=np.float64).reshape(len(group), -1)
        return pd.DataFrame({"part": [key[0]], "block": [key[1]], "data": [pieces.sum(axis=0).tobytes()]})

    schema = "part int, block int, data binary"
    partials = df.mapInPandas(emit, schema)
    while parts > 1 and parts * rows * width * 8 > DIRECT_BYTES:
        above = F.floor(F.col("part") / FAN_IN).cast("int").alias("part")
        partials = partials.groupBy(above, "block").applyInPandas(add, schema)
        parts = -(-parts // FAN_IN)
    out = np.zeros((rows, width))
    # At most DIRECT_BYTES, or one piece per block.
    with small_batches(df.sparkSession):
        found = partials.select("block", "data").toArrow()
    for block, data in zip(found["block"].to_pylist(), found["data"]):
        piece = np.frombuffer(data.as_buffer(), dtype=np.float64).reshape(-1, width)
        out[block * BLOCK : block * BLOCK + len(piece)] += piece
    return out


def size_of(df: DataFrame, weight=None) -> tuple[int, int, int]:
    """(rows, partitions, summed weight) of a cached table, in one job."""
    weight = F.lit(1) if weight is None else weight
    parts = df.select(F.spark_partition_id().alias("part"), weight.cast("bigint").alias("weight"))
    row = parts.agg(
        F.count(F.lit(1)).alias("n"), F.max("part").alias("last"), F.sum("weight").alias("w")
    ).first()
    return row["n"], (row["last"] or 0) + 1, row["w"] or 0


def fit_partitions(df: DataFrame, parts: int, work: float, per_task: float) -> tuple[DataFrame, int]:
    """Merge partitions for passes in which every task returns a matrix.

    There are at most as many tasks as slots, each of which adds up its partitions before
    it returns anything, so what a pass moves does not grow with the number of partitions.
    Less work than would keep the slots busy takes fewer tasks.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    wanted = max(1, min(parts, slots, int(work / per_task) + 1))
    return (df.coalesce(wanted) if wanted < parts else df), wanted
