"""Sharding by sampled splitters.

Records are ordered by (hash of the text, record number), so equal texts lie
side by side.  A size-weighted sample of these keys gives quantile boundaries;
every record goes to the range between two boundaries, and ranges that turn out
to hold too many bytes are subdivided by a finer sample taken inside them.  The
exact running bytes over the ranges then cut the order into shards.

Empty table: no rows.  Null text: size 8, checksum 0.  Null or repeated ids and
repeated rows are records of their own.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewloom.llm.common import crc32_of, read_table, staged, text_or_empty

SHARDS = 24
LEAST_RANGES = 384
RANGE_ROWS = 1_000_000  # records a range is meant to hold at most
SAMPLES_PER_RANGE = 20
OVERFULL = 2.0  # times the mean bytes of a range
ROUNDS = 4


def _sample(rows: DataFrame, per_byte: float) -> DataFrame:
    """Keys drawn with a chance in proportion to size, with the weight each stands for."""
    expected = F.col("size") * F.lit(float(per_byte))
    draw = F.pmod(F.xxhash64("key", "uid", F.lit(17)), F.lit(1 << 30)) / float(1 << 30)
    return rows.where(draw < expected).select(
        "key", "uid", F.greatest(expected, F.lit(1.0)).alias("w")
    )


def _boundaries(sample: DataFrame, pieces: int, by: list[str]) -> DataFrame:
    """The keys at the quantiles of the sampled weight; the sample is bounded."""
    order = Window.partitionBy(*by).orderBy("key", "uid")
    everything = Window.partitionBy(*by)
    step = F.floor(F.sum("w").over(order) * pieces / F.sum("w").over(everything))
    return (
        sample.withColumn("step", step)
        .withColumn("previous", F.coalesce(F.lag("step").over(order), F.lit(0)))
        .where((F.col("step") > F.col("previous")) & (F.col("step") < pieces))
        .select("key", "uid")
    )


def _ranged(rows: DataFrame, cuts: list[tuple[int, int]]) -> DataFrame:
    """``range``: how many boundaries (key, uid) lie at or below the record's key."""
    keys = np.array([c[0] for c in cuts], np.int64)
    uids = np.array([c[1] for c in cuts], np.int64)

    @F.pandas_udf("int")
    def locate(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for key, uid in batches:
            key, uid = key.to_numpy(np.int64), uid.to_numpy(np.int64)
            low = np.searchsorted(keys, key, side="left")
            high = np.searchsorted(keys, key, side="right")
            # Only keys that hold boundaries of their own need a look at the uid.
            for k in np.unique(key[high > low]):
                mine = key == k
                a, b = np.searchsorted(keys, k, "left"), np.searchsorted(keys, k, "right")
                low[mine] = a + np.searchsorted(uids[a:b], uid[mine], side="right")
            yield pd.Series(low.astype(np.int32))

    return rows.withColumn("range", locate("key", "uid"))


def splitters(rows: DataFrame, total: int, count: int) -> list[tuple[int, int]]:
    """Boundaries (key, uid) between ranges, none of which stays overfull by choice.

    Their number follows the record count (one per RANGE_ROWS), so the list is
    small: a few ten thousand pairs at 10^10 records.
    """
    ranges = max(LEAST_RANGES, -(-count // RANGE_ROWS))
    target = total / ranges
    sample = _sample(rows, SAMPLES_PER_RANGE / target)
    cuts = sorted((r.key, r.uid) for r in _boundaries(sample, ranges, []).collect())
    for _ in range(ROUNDS):
        held = _ranged(rows, cuts)
        overfull = [
            r.range
            for r in held.groupBy("range")
            .agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
            .where((F.col("bytes") > OVERFULL * target) & (F.col("n") > 1))
            .collect()
        ]
        inside = held.where(F.col("range").isin(overfull)) if overfull else None
        if inside is None:
            break
        finer = _sample(inside, 4 * SAMPLES_PER_RANGE / target)
        more = {(r.key, r.uid) for r in _boundaries(finer, 4 * len(overfull), []).collect()}
        if more <= set(cuts):
            break
        cuts = sorted(more | set(cuts))
    return cuts


def shard_by_bytes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS
) -> DataFrame:
    """(id, size, text_crc32, shard, slot): shards of nearly equal bytes.

    Shard sizes differ from the mean by less than two records.  The text is
    scanned once; everything after works on a narrow staged table.
    """
    text = text_or_empty(text_col)
    rows = staged(
        docs.select(
            F.col(id_col).alias("id"),
            (F.octet_length(text).cast("bigint") + 8).alias("size"),
            crc32_of(text).alias("text_crc32"),
            F.xxhash64(text).alias("key"),
            F.monotonically_increasing_id().alias("uid"),
        ),
        "records",
    )
    sums = rows.agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n")).first()
    total, count = int(sums.b or 0), int(sums.n)
    cuts = splitters(rows, total, count) if count else []
    held = _ranged(rows, cuts)
    per_range = staged(
        held.groupBy("range").agg(
            F.sum("size").alias("range_bytes"), F.count(F.lit(1)).alias("range_rows")
        ),
        "ranges",
    )
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_range.select(
        "range",
        F.coalesce(F.sum("range_bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("range_rows").over(before), F.lit(0)).alias("rows_before"),
    )
    inside = Window.partitionBy("range").orderBy("key", "uid")
    upto = F.col("bytes_before") + F.sum("size").over(inside)
    middle = 2 * upto - F.col("size")  # twice the record's midpoint
    placed = staged(
        held.join(F.broadcast(offsets), "range").select(
            "id",
            "size",
            "text_crc32",
            F.least(
                F.lit(shards - 1), F.expr(f"{shards}") * middle / F.lit(float(2 * max(total, 1)))
            )
            .cast("int")
            .alias("shard"),
            (F.col("rows_before") + F.row_number().over(inside) - 1).alias("rank"),
        ),
        "placed",
    )
    first = placed.groupBy("shard").agg(F.min("rank").alias("first"))
    return placed.join(F.broadcast(first), "shard").select(
        F.col("id").alias(id_col),
        "size",
        "text_crc32",
        "shard",
        (F.col("rank") - F.col("first")).alias("slot"),
    )


def write_shards(docs: DataFrame, placed: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """Write whole records as one folder per shard, in slot order (ids must be unique)."""
    clash = [c for c in ("shard", "slot") if c in docs.columns]
    (
        docs.drop(*clash)
        .join(placed.select(id_col, "shard", "slot"), id_col)
        .repartitionByRange("shard", "slot")
        .sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard")
        .parquet(path)
    )


def op1_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard_by_bytes(read_table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
