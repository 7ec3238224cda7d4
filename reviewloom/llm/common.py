"""Shared by the corpus operators: reading tables, staging, words as numbers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.session import scratch_path

# A slice of a batch that Python works on at once; a longer text is a slice alone.
SLICE_BYTES = 3 << 19


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: computed once, lineage cut.

    The files lie below spark.checkpoint.dir, so they outlive lost executors.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def crc32_of(text: Column) -> Column:
    return F.crc32(text.cast("binary")).cast("bigint")


def held_out(doc_id: Column) -> Column:
    """True where crc32(doc_id as text) mod 5 is 0; a null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def slices(batch: pa.RecordBatch, column: str = "text") -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of at most SLICE_BYTES of text (one row at least)."""
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0)
    ends = np.cumsum(size.to_numpy(zero_copy_only=False))
    start = 0
    while start < len(ends):
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + SLICE_BYTES, side="right")))
        yield batch.slice(start, stop - start)
        start = stop
    # Workers live on between tasks; give back what the batch took.
    pa.default_memory_pool().release_unused()


class Words:
    """The words of some texts as numbers: ``index`` into ``unique``, ``offsets`` per text.

    Words are the runs of ``[^\\x20\\x09-\\x0D]``; a null text has none.
    """

    def __init__(self, texts: pa.Array):
        lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.fill_null(texts, "")))
        counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = pc.list_flatten(lists)
        empty = pc.binary_length(flat).to_numpy(zero_copy_only=False) == 0
        if empty.any():
            owner = np.repeat(np.arange(len(counts)), counts)[~empty]
            counts = np.bincount(owner, minlength=len(counts)).astype(np.int64)
            flat = flat.filter(pa.array(~empty))
        coded = flat.dictionary_encode()
        self.unique = coded.dictionary
        self.index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        self.flat = flat

    def hashed(self, seed: int) -> np.ndarray:
        """A 64-bit hash of each word occurrence."""
        import xxhash

        digest = xxhash.xxh64_intdigest
        own = np.fromiter(
            (digest(w, seed) for w in self.unique.to_pylist()), np.uint64, len(self.unique)
        )
        return own[self.index] if len(own) else np.zeros(0, np.uint64)
