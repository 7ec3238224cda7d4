"""Exact substring dedup by seed and extend.

A window is ``length`` consecutive words of one document; it is a repeat when its
word sequence starts at another place too, in the same document or another.

Seed: winnowing picks the least of every ``length - SEED_WORDS + 1`` neighbouring
word runs as an anchor.  Two equal windows pick the same anchor at the same
offset, so a repeated window always holds an anchor that occurs twice.  Anchors
are joined by value and the single ones dropped.

Extend: around every remaining anchor the match is extended to both sides as far
as windows choose it, at once against all partners: windows of equal sequence
meet under their hash, so no pair of documents is ever listed.  Neighbouring
repeated windows merge into maximal repeats, none shorter than ``length``.

Copies of a whole text are represented by one of them, which counts double.  A
task that sees a sequence twice settles it on the spot and passes on one row, so
a passage in a third of all documents sends a row per task, not per document.

Sequences are compared by 96 bits of two independent hashes.

Null and empty texts have no words: nothing is removed, and the digest is that
of the empty string.  Null or repeated ids are told apart by 112 or 48 bits of their
text; repeated rows are copies of each other.  Empty table: no rows.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewloom.llm.common import Words, read_table, slices, staged

LENGTH = 35
SEED_WORDS = 12
FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
CHUNK = 400_000  # windows a task settles among themselves before passing them on


def _keys(id_col: str, text_col: str) -> list[Column]:
    """A document's own key: its id, or 64 bits of its text, and 48 other bits of the text."""
    text, unnamed = F.coalesce(F.col(text_col).cast("string"), F.lit("")), F.col(id_col).isNull()
    return [
        F.coalesce(F.col(id_col).cast("bigint"), F.xxhash64(text)).alias("k1"),
        F.shiftrightunsigned(F.xxhash64(F.lit(3), unnamed, text), 16).alias("k2"),
    ]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _runs(hashes: np.ndarray, words: int, factor: int) -> np.ndarray:
    """A hash of each run of ``words`` consecutive words."""
    out = np.zeros(max(len(hashes) - words + 1, 0), np.uint64)
    for j in range(words if len(out) else 0):
        out = out * np.uint64(factor) + hashes[j : j + len(out)]
    return _mixed(out)


class Windows:
    """The windows of some texts with the anchors they choose."""

    def __init__(self, texts: pa.Array, length: int, second: bool = False):
        words = Words(texts)
        self.offsets = words.offsets
        hashes = words.hashed(1)
        total = len(hashes)
        owner = np.repeat(np.arange(len(texts)), np.diff(words.offsets))
        starts = np.arange(max(total - length + 1, 0))
        inside = (
            owner[: len(starts)] == owner[length - 1 :] if len(starts) else np.zeros(0, bool)
        )
        self.start = starts[inside]
        self.owner = owner[self.start]
        self.anchor_hash = _runs(hashes, SEED_WORDS, FACTORS[0])
        choices = length - SEED_WORDS + 1
        self.anchor = np.zeros(0, np.int64)
        if len(self.start):
            view = np.lib.stride_tricks.sliding_window_view(self.anchor_hash, choices)
            least = np.argmin(view, axis=1)
            self.anchor = self.start + least[self.start]
        if second:
            self.first = _runs(hashes, length, FACTORS[1])
            self.second = _runs(words.hashed(2), length, FACTORS[0]) >> np.uint64(33)


SIGHTING = "h1 bigint, h2 int, k1 bigint, k2 bigint, start int, copies int"


class Settled:
    """Sightings (h1, h2, k1, k2, start, copies) of a task, settled where they meet.

    A row with copies 0 is a place whose sequence is known to repeat; any other
    asks for partners on behalf of that many places, its own the first.  A task
    sends one asking row per sequence and CHUNK, however often it saw it.
    """

    def __init__(self):
        self.held: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.held.append(columns)
        self.size += len(columns[0])
        if self.size >= CHUNK:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.size:
            return
        columns = [np.concatenate(x) for x in zip(*self.held, strict=True)]
        self.held, self.size = [], 0
        order = np.lexsort((columns[1], columns[0]))
        h1, h2, k1, k2, start, copies = (x[order] for x in columns)
        new = np.ones(len(h1), bool)
        new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        group = np.cumsum(new) - 1
        weight = np.bincount(group, copies).astype(np.int64)
        known = weight[group] > 1
        out = [
            np.concatenate([x[new], x[known]])
            for x in (h1.view(np.int64), h2.astype(np.int32), k1, k2, start.astype(np.int32))
        ]
        asks = np.minimum(weight, 2)
        out.append(np.concatenate([asks, np.zeros(known.sum(), np.int64)]).astype(np.int32))
        names = [c.split()[0] for c in SIGHTING.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], names)


def _numbers(part: pa.RecordBatch, name: str) -> np.ndarray:
    return part.column(name).to_numpy(zero_copy_only=False)


def _anchors(keyed: DataFrame, length: int) -> DataFrame:
    """Sightings of the winnowed anchors of all documents."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        settled = Settled()
        for batch in batches:
            for part in slices(batch):
                w = Windows(part.column("text"), length)
                pos, index = np.unique(w.anchor, return_index=True)
                owner = w.owner[index]
                yield from settled.add(
                    w.anchor_hash[pos],
                    np.zeros(len(pos), np.int64),
                    _numbers(part, "k1")[owner],
                    _numbers(part, "k2")[owner],
                    pos - w.offsets[owner],
                    np.ones(len(pos), np.int64),
                )
        yield from settled.flush()

    return keyed.mapInArrow(work, SIGHTING)


def _sightings(seeded: DataFrame, length: int) -> DataFrame:
    """Sightings of the windows around seeds; input (k1, k2, text, seeds, copies)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        settled = Settled()
        for batch in batches:
            for part in slices(batch):
                w = Windows(part.column("text"), length, second=True)
                seeds = part.column("seeds")
                many = pc.fill_null(pc.list_value_length(seeds), 0).to_numpy(zero_copy_only=False)
                marked = np.zeros(len(w.anchor_hash) + 1, bool)
                at = pc.list_flatten(seeds).to_numpy(zero_copy_only=False).astype(np.int64)
                marked[at + np.repeat(w.offsets[:-1], many)] = True
                chosen = marked[w.anchor]
                start, owner = w.start[chosen], w.owner[chosen]
                yield from settled.add(
                    w.first[start],
                    w.second[start],
                    _numbers(part, "k1")[owner],
                    _numbers(part, "k2")[owner],
                    start - w.offsets[owner],
                    _numbers(part, "copies")[owner],
                )
        yield from settled.flush()

    return seeded.select("k1", "k2", "text", "seeds", "copies").mapInArrow(work, SIGHTING)


def _repeats(sightings: DataFrame, name: str) -> DataFrame:
    """(k1, k2, name): the places of each document whose sequence is seen elsewhere too."""
    same = Window.partitionBy("h1", "h2")
    judged = sightings.withColumn(
        # A known place needs no partner; it is spread by itself.
        "h1",
        F.when(F.col("copies") == 0, F.xxhash64("k1", "k2", "start")).otherwise(F.col("h1")),
    ).withColumn("n", F.sum("copies").over(same))
    return (
        judged.where((F.col("copies") == 0) | (F.col("n") > 1))
        .groupBy("k1", "k2")
        .agg(F.collect_set("start").alias(name))
    )


def _kept(keyed: DataFrame, length: int, keep: list[str]) -> DataFrame:
    """Words left after removal; input (id, text, starts, copies) and the columns in ``keep``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                words = Words(part.column("text"))
                counts = np.diff(words.offsets)
                starts = part.column("starts")
                lengths = pc.fill_null(pc.list_value_length(starts), 0).to_numpy(
                    zero_copy_only=False
                )
                at = pc.list_flatten(starts).to_numpy(zero_copy_only=False).astype(np.int64)
                at = at + np.repeat(words.offsets[:-1], lengths)
                edge = np.zeros(len(words.flat) + 1, np.int64)
                np.add.at(edge, at, 1)
                np.add.at(edge, at + length, -1)
                gone = np.cumsum(edge[:-1]) > 0
                copied = part.column("copies").to_numpy(zero_copy_only=False) > 1
                gone |= np.repeat(copied & (counts >= length), counts)
                owner = np.repeat(np.arange(len(counts)), counts)
                left = np.bincount(owner[~gone], minlength=len(counts))
                flat = words.flat.filter(pa.array(~gone))
                ends = np.concatenate([[0], np.cumsum(left)])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        pa.array(counts),
                        pa.array(counts - left),
                        pc.binary_join(lists, " "),
                        *[part.column("text" if c == "given_text" else c) for c in keep],
                    ],
                    ["id", "n_words", "n_removed", "kept", *keep],
                )

    kinds = "".join(
        f", `{c}` "
        + keyed.schema["text" if c == "given_text" else c].dataType.simpleString()
        for c in keep
    )
    rest = [c for c in keep if c != "given_text"]
    return keyed.select("id", "text", "starts", "copies", *rest).mapInArrow(
        work, f"id bigint, n_words bigint, n_removed bigint, kept string{kinds}"
    )


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """(id, n_words, n_removed, kept): each text without words of repeated windows.

    ``kept`` is the remaining words joined by one space.  Columns named in ``keep``
    come along under the names given_<column>, the text as given_text.
    """
    given = ["given_text" if c == text_col else f"given_{c}" for c in keep]
    if length < SEED_WORDS:
        raise ValueError(f"length must be at least {SEED_WORDS}")
    keyed = docs.select(
        *_keys(id_col, text_col),
        F.col(id_col).cast("bigint").alias("id"),
        F.col(text_col).cast("string").alias("text"),
        *[F.col(f"`{c}`").alias(g) for c, g in zip(keep, given, strict=True) if c != text_col],
    )
    # Copies of a whole text, by two hashes of it; the first copy stands for all.
    whole = F.coalesce("text", F.lit(""))
    text_hash = [F.xxhash64(whole).alias("c1"), F.xxhash64(whole, F.lit(7)).alias("c2")]
    named = staged(keyed.select("k1", "k2", *text_hash), "names")
    classes = named.groupBy("c1", "c2").agg(
        F.count(F.lit(1)).alias("copies"), F.min(F.struct("k1", "k2")).alias("first")
    )
    copied = staged(classes.where("copies > 1"), "copies")
    members = (
        named.join(copied, ["c1", "c2"])
        .groupBy("k1", "k2")
        .agg(
            F.lit(2).alias("copies"),
            F.max(F.struct("k1", "k2") == F.col("first")).alias("stands"),
        )
    )
    members = staged(members, "members")
    anchors = _anchors(keyed.select("k1", "k2", "text"), length)
    seeds = staged(_repeats(anchors, "seeds"), "seeds")
    known = seeds.join(members, ["k1", "k2"], "left").where(
        F.coalesce("stands", F.lit(True))
    )
    known = known.select("k1", "k2", "seeds", F.coalesce("copies", F.lit(1)).alias("copies"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = keyed.repartition(parts, "k1", "k2")
    seeded = texts.join(known, ["k1", "k2"])  # the texts are dealt once for both joins
    repeats = staged(_repeats(_sightings(seeded, length), "starts"), "repeats")
    final = texts.join(repeats, ["k1", "k2"], "left").join(members, ["k1", "k2"], "left")
    kept = _kept(final.withColumn("copies", F.coalesce("copies", F.lit(1))), length, given)
    return kept.withColumnRenamed("id", id_col)


def digest(kept: DataFrame) -> DataFrame:
    return kept.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")


def op6_seed_extend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(remove_repeats(read_table(spark, sf_dir, "documents")))

