"""Near duplicates by SimHash, searched with BK-trees.

Every text gets a 64-bit fingerprint of its 3-word shingles.  Fingerprints that
differ in at most RADIUS bits are linked; linked fingerprints form components.

The search is exact.  Two fingerprints within 3 bits agree on at least one of
four 16-bit bands, so the distinct fingerprints are dealt to shards by (band,
value), and each shard is a BK-tree: a child hangs on the integer Hamming
distance to its parent, and a query follows only the edges from d - radius to
d + radius.  A shard with more than SHARD_LIMIT fingerprints is dealt again by
four 12-bit parts of the other 48 bits, by the same argument.  The trees travel
to the tasks that own their band instead of being broadcast, since all trees
together grow with the corpus.

Inside a shard only links that join two groups are kept, so a dense shard gives
one link less than it has fingerprints, not all its pairs.

Null and empty texts have fingerprint zero and are linked like any other.  Equal
texts share one fingerprint, searched once.  Null ids take no part in naming a
component; where a component has no other id its name is null.  Empty table: no
rows.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.llm.common import Words, read_table, slices, staged
from reviewloom.llm.components import components

RADIUS = 3
SEED = 42
BANDS = 4
SHARD_LIMIT = 20_000
WIDTH = 3  # words of a shingle
FRONTIER = 1 << 20  # (query, node) pairs looked at together


def _fold_bits(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Per text: bit i is set where over half of its hashes have it."""
    out = np.zeros(len(starts), np.uint64)
    for i, (a, b) in enumerate(zip(starts, ends, strict=True)):
        votes = np.zeros(64, np.int64)
        for c in range(a, b, 1 << 16):
            part = np.ascontiguousarray(hashes[c : min(b, c + (1 << 16))])
            bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            votes += bits.sum(axis=0, dtype=np.int64)
        if b > a:
            word = np.packbits(2 * votes > b - a, bitorder="little")
            out[i] = word.view(np.uint64)[0]
    return out


def _shingles(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the ``size``-word shingles of all texts; where those of each begin and end."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    lowered = pc.ascii_lower(pc.fill_null(texts, ""))
    words = Words(lowered)
    counts = np.diff(words.offsets)
    flat = words.flat
    # The words of all texts in one buffer, one space between them.
    joined = pa.concat_arrays([flat]) if flat.offset else flat
    sizes = pc.binary_length(joined).to_numpy(zero_copy_only=False).astype(np.int64)
    begin = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
    stop = begin + sizes
    whole = pc.binary_join(pa.ListArray.from_arrays([0, len(joined)], joined), " ")[0]
    data = memoryview(whole.as_buffer()) if len(joined) else memoryview(b"")
    width = np.minimum(size, counts)
    shingles = np.where(counts == 0, 0, counts - width + 1)
    ends = np.cumsum(shingles)
    starts = ends - shingles
    owner = np.repeat(np.arange(len(counts)), shingles)
    first = words.offsets[owner] + np.arange(len(owner)) - starts[owner]
    last = first + width[owner] - 1
    hashes = np.fromiter(
        (
            digest(data[a:b], SEED)
            for a, b in zip(begin[first].tolist(), stop[last].tolist(), strict=True)
        ),
        np.uint64,
        len(owner),
    )
    return hashes, starts, ends


def fingerprints_of(texts: pa.Array) -> np.ndarray:
    """Fingerprints (uint64) of a batch of texts."""
    return _fold_bits(*_shingles(texts, WIDTH))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp, text_hash): the fingerprint of each whole text as a signed bigint."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                fps = fingerprints_of(part.column("text")).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").cast(pa.int64()), pa.array(fps), part.column("text_hash")],
                    ["id", "fp", "text_hash"],
                )

    text = F.col(text_col).cast("string")
    chosen = docs.select(
        F.col(id_col).cast("bigint").alias("id"), text.alias("text"), text_hash(text).alias("text_hash")
    )
    return chosen.mapInArrow(work, "id bigint, fp bigint, text_hash bigint")


def text_hash(text: Column) -> Column:
    """Tells rows of one id apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).astype(np.int64)


class Forest:
    """BK-trees over several shards at once, held as arrays.

    ``fps`` is ordered by shard; the first fingerprint of a shard is its root.
    Children of a node are adjacent and ordered by their distance to it.
    """

    def __init__(self, fps: np.ndarray, roots: np.ndarray, root_of: np.ndarray):
        n = len(fps)
        self.fps, self.root_of = fps, root_of
        parent, edge = np.full(n, -1, np.int64), np.zeros(n, np.int64)
        # All fingerprints below one node move down a level together.
        at = root_of.copy()
        moving = np.setdiff1d(np.arange(n), roots, assume_unique=True)
        while len(moving):
            d = _popcount(fps[moving] ^ fps[at[moving]])
            slot = at[moving] * 65 + d
            taken, index = np.unique(slot, return_index=True)
            child = moving[index]
            parent[child], edge[child] = at[child], d[index]
            rest = np.ones(len(moving), bool)
            rest[index] = False
            at[moving[rest]] = child[np.searchsorted(taken, slot[rest])]
            moving = moving[rest]
        key = np.where(parent < 0, -1, parent * 65 + edge)
        self.children = np.argsort(key, kind="stable")
        self.keys = key[self.children]

    def links(self, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, node) pairs within the radius, node before query, in pieces."""
        todo = [(np.arange(len(self.fps)), self.root_of.copy())]
        while todo:
            query, node = todo.pop()
            if len(query) > FRONTIER:
                half = len(query) // 2
                todo += [(query[half:], node[half:]), (query[:half], node[:half])]
                continue
            d = _popcount(self.fps[query] ^ self.fps[node])
            near = (d <= radius) & (node < query)
            if near.any():
                yield query[near], node[near]
            low = np.searchsorted(self.keys, node * 65 + np.maximum(d - radius, 0), "left")
            high = np.searchsorted(self.keys, node * 65 + np.minimum(d + radius, 64), "right")
            many = high - low
            go = many > 0
            if go.any():
                q, n, lo = query[go], many[go], low[go]
                below = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
                todo.append((np.repeat(q, n), self.children[below]))


def _joined(n: int, found: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The least member of each member's group, links being folded in as they come."""
    label = np.arange(n)
    for a, b in found:
        while True:
            la, lb = label[a], label[b]
            apart = la != lb
            if not apart.any():
                break
            a, b = a[apart], b[apart]
            la, lb = la[apart], lb[apart]
            np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
            while True:
                jump = label[label]
                if (jump == label).all():
                    break
                label = jump
    return label


def shard_links(shards: DataFrame, radius: int) -> DataFrame:
    """(a, b): links of a spanning forest of each shard; input (shard, fp, node)."""

    def solve(shard: np.ndarray, fp: np.ndarray, node: np.ndarray) -> pa.RecordBatch:
        roots = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]]))
        root_of = roots[np.cumsum(np.isin(np.arange(len(shard)), roots)) - 1]
        forest = Forest(fp.view(np.uint64), roots, root_of)
        label = _joined(len(fp), forest.links(radius))
        own = np.flatnonzero(label != np.arange(len(label)))
        return pa.RecordBatch.from_arrays(
            [pa.array(node[own]), pa.array(node[label[own]])], ["a", "b"]
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            held.append(tuple(batch.column(i).to_numpy() for i in range(3)))
            shard, fp, node = (np.concatenate(x) for x in zip(*held, strict=True))
            if len(shard) < 20_000:
                held = [(shard, fp, node)]
                continue
            # The last shard may go on in the next batch.
            cut = int(np.searchsorted(shard, shard[-1], "left"))
            if cut:
                yield solve(shard[:cut], fp[:cut], node[:cut])
            held = [(shard[cut:], fp[cut:], node[cut:])]
        if held:
            shard, fp, node = (np.concatenate(x) for x in zip(*held, strict=True))
            if len(shard):
                yield solve(shard, fp, node)

    return (
        shards.repartition("shard")
        .sortWithinPartitions("shard", "fp")
        .mapInArrow(work, "a bigint, b bigint")
    )


def _band(fp, width: int, i: int):
    return F.shiftrightunsigned(fp, i * width).bitwiseAND(F.lit((1 << width) - 1))


def near_links(nodes: DataFrame, radius: int = RADIUS, limit: int = SHARD_LIMIT) -> DataFrame:
    """Links (a, b) that connect what lies within ``radius`` bits; input (fp, node).

    Exact for radius < 4, since four bands cannot all differ.
    """
    if not 0 <= radius < BANDS:
        raise ValueError(f"radius must be 0 to {BANDS - 1}")
    fp = F.col("fp")
    dealt = nodes.select(
        "fp",
        "node",
        F.explode(
            F.array(
                *[_band(fp, 16, i).bitwiseOR(F.lit(i << 16)).cast("int") for i in range(BANDS)]
            )
        ).alias("shard"),
    )
    # At most 262,144 shards exist, so their sizes are a bounded table.
    large = dealt.groupBy("shard").count().where(F.col("count") > limit).select("shard")
    large = staged(large, "large_shards")
    dealt_small = dealt.join(F.broadcast(large), "shard", "left_anti")
    crowded = dealt.join(F.broadcast(large), "shard")
    # The 48 bits beside the shard's own band, in four parts of 12.
    position = F.shiftright("shard", 16) * 16
    upper = F.when(position == 48, F.lit(0)).otherwise(
        F.expr("shiftrightunsigned(fp, (shiftright(shard, 16) * 16) + 16)")
    )
    lower = F.expr("fp & (shiftleft(1L, shiftright(shard, 16) * 16) - 1)")
    rest = lower.bitwiseOR(F.expr("shiftleft(__upper, shiftright(shard, 16) * 16)"))
    again = crowded.withColumn("__upper", upper).withColumn("__rest", rest)
    split = again.select(
        "fp",
        "node",
        F.explode(
            F.array(
                *[
                    F.col("shard").cast("bigint") * F.lit(1 << 14)
                    + _band(F.col("__rest"), 12, i)
                    + F.lit(i << 12)
                    + F.lit(1 << 40)
                    for i in range(BANDS)
                ]
            )
        ).alias("shard"),
    )
    shards = dealt_small.select(F.col("shard").cast("bigint").alias("shard"), "fp", "node")
    return shard_links(shards.unionByName(split.select("shard", "fp", "node")), radius)


def near_duplicate_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS
) -> DataFrame:
    """(id, fp, text_hash, root, component): component is the smallest id reachable over links.

    Two groups may share that id where it has several texts; ``root`` tells them apart.
    """
    prints = staged(fingerprints(docs, id_col, text_col), "fingerprints")
    known = prints.where(F.col("id").isNotNull())
    distinct = known.groupBy("fp").agg(F.min("id").alias("least"))
    unnamed = prints.where(F.col("id").isNull()).select("fp").distinct()
    # Nodes are numbered by fingerprint itself, so null or repeated ids do no harm.
    nodes = staged(
        distinct.join(unnamed, "fp", "full").select("fp", "least", F.col("fp").alias("node")),
        "nodes",
    )
    links = near_links(nodes.select("fp", "node"), radius)
    groups = components(links)
    member = nodes.join(groups, "node", "left").select(
        "fp", "least", F.coalesce("component", "node").alias("root")
    )
    named = member.groupBy("root").agg(F.min("least").alias("component"))
    by_print = member.join(named, "root").select("fp", "root", "component")
    return prints.join(by_print, "fp").select(F.col("id").alias(id_col), "fp", "text_hash", "root", "component")


def op7_simhash_bk_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_duplicate_groups(read_table(spark, sf_dir, "documents"))
    return groups.select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("component").alias("component_id"),
    )
