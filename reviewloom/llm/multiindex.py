"""Approximate nearest neighbours by an inverted multi-index.

Vectors are split into two halves.  Each half is quantised by its own centroids,
fitted on at most SAMPLE vectors; a pair of centroids is a cell of the index, and
every vector is in it.  A query walks the cells in the order of its summed scores
for the two centroids (a heap over the two sorted lists) until the cells hold as many
entries as the index was found to need, and all entries of those cells are reranked by
the exact inner product, in double precision.

How many entries that are is measured, at every size alike: for PROBES queries, a
bounded sample, the true neighbours among all entries are found by brute force, and
the walk goes so far that it meets AIM of them.  Vectors that lie in clusters need a
small share of the index, vectors without any structure most of it.

Entries are distinct vectors: of equal vectors at most k + 1 ids can be among any
k nearest, so an entry carries its k + 1 smallest ids, and a vector that very many
rows share costs one.  Queries of equal vectors are searched once.  Cells are dealt to
blocks of about BLOCK_ENTRIES entries, a large cell to several; queries meet a block in
groups of at most about QUERY_GROUP, so no task holds more than one block and one group.
Scores of the entries that may count are summed once more, correctly rounded, so they
and their ties do not depend on how the entries were dealt.

Vectors that are null, zero, or hold null or non-finite components take no part, nor
do rows with a null id; neither as query nor as candidate.  Vectors of different
lengths have no inner product: each length is searched by itself.  Rows repeated with
id and vector count once.  Ties go to the smaller id.  Fewer candidates than k: all of
them.  Empty table: no rows.  Other columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.llm.common import read_table, staged

K = 20
QUERY_STEP = 20  # ids divisible by it are queries
SAMPLE = 20_000  # vectors the centroids are fitted on
ROUNDS = 12
PROBES = 256  # queries by which the length of a walk is measured
AIM = 0.94  # share of their true neighbours that the walk has to meet
BLOCK_ENTRIES = 4_096
QUERY_GROUP = 4_096
QUERY_BLOCK = 512
MOST_CENTROIDS = 1_024  # of a half; about a million cells at most


def usable(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector) of the rows that take part."""
    v = F.col("vector")
    finite = F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    own = rows.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.col(vector_col).cast("array<double>").alias("vector"),
    ).where(F.col("id").isNotNull() & v.isNotNull())
    return own.where(finite & F.exists(v, lambda x: x != 0))


def fit_centroids(entries: DataFrame, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Centroids of the left and the right half, by Lloyd steps on a bounded sample."""
    share = min(1.0, SAMPLE / max(count, 1))
    draw = F.pmod(F.xxhash64("vector"), F.lit(1 << 30)) / float(1 << 30)
    rows = entries.where(draw < share).select("vector").limit(2 * SAMPLE).toArrow()
    x = np.array(rows.column("vector").to_pylist(), np.float64)
    number = int(min(MOST_CENTROIDS, max(2, round(math.sqrt(count) / 4)), len(x)))
    halves = np.split(x, [x.shape[1] // 2], axis=1)
    rng = np.random.default_rng(7)
    out = []
    for half in halves:
        centres = half[rng.choice(len(half), number, replace=False)]
        for _ in range(ROUNDS):
            far = (centres**2).sum(1) - 2 * half @ centres.T
            nearest = far.argmin(1)
            size = np.bincount(nearest, minlength=number)
            sums = np.zeros_like(centres)
            np.add.at(sums, nearest, half)
            centres = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], centres)
        out.append(centres)
    return out[0], out[1]


def _cells(vectors: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    half = left.shape[1]
    a = ((left**2).sum(1) - 2 * vectors[:, :half] @ left.T).argmin(1)
    b = ((right**2).sum(1) - 2 * vectors[:, half:] @ right.T).argmin(1)
    return a * len(right) + b


def walk(scores_left: np.ndarray, scores_right: np.ndarray) -> Iterator[int]:
    """Cells in descending order of the summed scores, by a heap over both orders."""
    a, b = np.argsort(-scores_left), np.argsort(-scores_right)
    sa, sb = scores_left[a], scores_right[b]
    heap, width = [(-(sa[0] + sb[0]), 0, 0)], len(b)
    while heap:
        _, i, j = heapq.heappop(heap)
        yield int(a[i]) * width + int(b[j])
        # Each pair has one predecessor: along the right list, or from its head.
        if j + 1 < width:
            heapq.heappush(heap, (-(sa[i] + sb[j + 1]), i, j + 1))
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (-(sa[i + 1] + sb[0]), i + 1, 0))


def exact(query: np.ndarray, entries: np.ndarray) -> list[float]:
    """Inner products, correctly rounded sums; of single-precision vectors exact but for that."""
    return [math.fsum(row) for row in (entries * query).tolist()]


def entries_needed(
    entries: DataFrame,
    queries: DataFrame,
    left: np.ndarray,
    right: np.ndarray,
    sizes: np.ndarray,
    k: int,
) -> int:
    """Entries a walk has to hold to meet AIM of the true neighbours of sampled queries."""
    order = F.xxhash64("vector")
    asked = np.array(
        [r["vector"] for r in queries.select("vector").orderBy(order).limit(PROBES).collect()]
    )
    if not len(asked):
        return int(sizes.sum())

    def best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The best of a task for each sampled query, with their cells."""
        score, cell = np.zeros((len(asked), 0)), np.zeros((len(asked), 0), np.int64)
        for pdf in batches:
            matrix = np.stack(pdf["vector"].to_numpy())
            score = np.hstack([score, asked @ matrix.T])
            cell = np.hstack([cell, np.tile(_cells(matrix, left, right), (len(asked), 1))])
            keep = np.argsort(-score, axis=1, kind="stable")[:, : k + 1]
            score = np.take_along_axis(score, keep, axis=1)
            cell = np.take_along_axis(cell, keep, axis=1)
        if score.shape[1]:
            number = np.repeat(np.arange(len(asked)), score.shape[1])
            yield pd.DataFrame({"query": number, "score": score.ravel(), "cell": cell.ravel()})

    found = entries.select("vector").mapInPandas(best, "query bigint, score double, cell bigint")
    # One row per sampled query: its k + 1 best of all tasks.
    top = found.groupBy("query").agg(
        F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "cell"))), 1, k + 1).alias("top")
    )
    half, needed = left.shape[1], []
    for r in top.collect():
        vector, wanted = asked[r["query"]], {x["cell"] for x in r["top"]}
        seen, at = 0, {}
        for cell in walk(left @ vector[:half], right @ vector[half:]):
            seen += int(sizes[cell])
            if cell in wanted:
                at[cell] = seen
                if len(at) == len(wanted):
                    break
        needed += [at[x["cell"]] for x in r["top"]]
    return int(np.quantile(needed, AIM, method="higher"))


def nearest(
    rows: DataFrame,
    k: int = K,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    query_step: int = QUERY_STEP,
) -> DataFrame:
    """(query_id, rank, id, score): the k nearest found of each query."""
    own = usable(rows, id_col, vector_col)
    lengths = sorted(r["n"] for r in own.select(F.size("vector").alias("n")).distinct().collect())
    found = [
        _nearest(own.where(F.size("vector") == n), k, query_step).withColumnRenamed("id", id_col)
        for n in lengths
    ]
    if not found:
        schema = f"query_id bigint, rank int, {id_col} bigint, score double"
        return rows.sparkSession.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, found)


def _nearest(own: DataFrame, k: int, query_step: int) -> DataFrame:
    """(query_id, rank, id, score) among vectors of one length."""
    # Partial aggregates keep k + 1 ids of a vector, whatever the number of its rows.
    some = own.distinct().withColumn("salt", F.pmod("id", F.lit(64)))
    least = F.slice(F.array_sort(F.collect_set("id")), 1, k + 1)
    parts = some.groupBy("vector", "salt").agg(least.alias("ids"))
    entries = staged(
        parts.groupBy("vector")
        .agg(F.slice(F.array_sort(F.flatten(F.collect_list("ids"))), 1, k + 1).alias("ids"))
        .select("vector", "ids"),
        "entries",
    )
    count = entries.count()
    left, right = fit_centroids(entries, count)
    half, cells = left.shape[1], len(left) * len(right)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf["cell"] = _cells(np.stack(pdf["vector"].to_numpy()), left, right)
            yield pdf

    index = staged(
        entries.mapInPandas(place, "vector array<double>, ids array<bigint>, cell int"), "index"
    )
    # At most MOST_CENTROIDS squared counts.
    sizes = np.zeros(cells, np.int64)
    for r in index.groupBy("cell").count().collect():
        sizes[r["cell"]] = r["count"]
    # Distinct query vectors, with the rows that ask for them.
    asking = own.where(F.col("id") % query_step == 0).distinct()
    queries = staged(
        asking.select("vector", "id").groupBy("vector").agg(F.min("id").alias("query")), "queries"
    )
    wanted = entries_needed(index, queries, left, right, sizes, k)
    # Neighbouring cells share a block; a large cell has several blocks of its own.
    blocks_of = np.maximum(1, -(-sizes // BLOCK_ENTRIES))
    small = blocks_of == 1
    shared = (np.cumsum(sizes * small) - sizes * small) // BLOCK_ENTRIES
    first_block = np.where(small, shared, shared.max(initial=0) + 1 + np.cumsum(blocks_of * ~small) - blocks_of)
    groups = max(1, math.ceil(queries.count() / QUERY_GROUP))

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for number, vector in zip(pdf["query"], pdf["vector"], strict=True):
                seen, found = 0, []
                for cell in walk(left @ vector[:half], right @ vector[half:]):
                    if sizes[cell]:
                        found.append(cell)
                        seen += sizes[cell]
                    if seen >= wanted:
                        break
                found = np.array(found)
                starts, many = first_block[found], blocks_of[found]
                cell = np.repeat(found, many)
                block = np.repeat(starts - (np.cumsum(many) - many), many) + np.arange(many.sum())
                by = np.argsort(block, kind="stable")
                cuts = np.flatnonzero(np.diff(block[by], prepend=-1))
                for inside, b in zip(np.split(cell[by], cuts[1:]), block[by][cuts], strict=True):
                    out.append((number, vector, int(b), inside.tolist()))
            yield pd.DataFrame(out, columns=["query", "vector", "block", "cells"])

    probes = queries.mapInPandas(
        probe, "query bigint, vector array<double>, block int, cells array<int>"
    ).withColumn("part", F.pmod(F.xxhash64("query"), F.lit(groups)))

    def to_block(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            cell = pdf["cell"].to_numpy()
            spread = pdf["spread"].to_numpy() % blocks_of[cell]
            yield pdf.drop(columns="spread").assign(block=(first_block[cell] + spread).astype(np.int32))

    dealt = index.withColumn("spread", F.pmod(F.xxhash64("vector"), F.lit(1 << 30))).mapInPandas(
        to_block, "vector array<double>, ids array<bigint>, cell int, block int"
    )
    blocks = dealt.withColumn("part", F.explode(F.sequence(*(F.lit(n).cast("bigint") for n in (0, groups - 1)))))

    def rerank(key, asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        columns = ["query", "ids", "scores"]
        if not len(asked) or not len(held):
            return pd.DataFrame([], columns=columns)
        matrix = np.stack(held["vector"].to_numpy())
        cell = held["cell"].to_numpy()
        ids = held["ids"].to_list()
        longest = np.sqrt((matrix**2).sum(1).max())
        out = []
        for a in range(0, len(asked), QUERY_BLOCK):
            part = asked.iloc[a : a + QUERY_BLOCK]
            vectors = np.stack(part["vector"].to_numpy())
            rough = vectors @ matrix.T
            # Rounding of a product of this block is far below this.
            slack = 1e-9 * longest * np.sqrt((vectors**2).sum(1))
            for q, row, off, number, cells_asked in zip(
                vectors, rough, slack, part["query"], part["cells"], strict=True
            ):
                at = np.flatnonzero(np.isin(cell, cells_asked))
                if len(at) > k + 1:
                    # All entries that may be as good as the k + 1st.
                    edge = np.partition(row[at], len(at) - k - 1)[len(at) - k - 1]
                    at = at[row[at] >= edge - off]
                score = exact(q, matrix[at])
                pairs = [(-s, i) for s, e in zip(score, at, strict=True) for i in ids[e]]
                # One place more, since the query itself may be among them.
                best = heapq.nsmallest(k + 1, pairs)
                out.append((number, [i for _, i in best], [-s for s, _ in best]))
        return pd.DataFrame(out, columns=columns)

    found = (
        probes.groupBy("block", "part")
        .cogroup(blocks.groupBy("block", "part"))
        .applyInPandas(rerank, "query bigint, ids array<bigint>, scores array<double>")
    )
    found = staged(found, "found")

    def best(pdf: pd.DataFrame) -> pd.DataFrame:
        ids = np.concatenate([np.asarray(x, np.int64) for x in pdf["ids"]])
        scores = np.concatenate([np.asarray(x, np.float64) for x in pdf["scores"]])
        order = np.lexsort((ids, -scores))[: k + 1]
        return pd.DataFrame(
            {"query": [pdf["query"].iloc[0]], "ids": [ids[order]], "scores": [scores[order]]}
        )

    merged = found.groupBy("query").applyInPandas(
        best, "query bigint, ids array<bigint>, scores array<double>"
    )
    answers = queries.join(merged, "query").select("vector", F.arrays_zip("ids", "scores").alias("near"))
    each = asking.join(answers, "vector").select(
        F.col("id").alias("query_id"),
        F.slice(F.filter("near", lambda x: x["ids"] != F.col("id")), 1, k).alias("near"),
    )
    return each.select("query_id", F.posexplode("near").alias("at", "x")).select(
        "query_id",
        (F.col("at") + 1).cast("int").alias("rank"),
        F.col("x.ids").alias("id"),
        F.col("x.scores").alias("score"),
    )


def op4_inverted_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read_table(spark, sf_dir, "embeddings"))
