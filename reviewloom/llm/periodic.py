"""Periodic runs of words, found by internal pattern matching.

A run is a stretch of words with smallest period q, at least max(6, 4 q) long, that no
neighbouring word extends.  Let b be the power of two with q <= b < 2 q (2 for q = 1).
A run holds a block of b words that starts at a multiple of b, and the block occurs again
q words later or earlier within the run.  All its occurrences in the 2 b words on one side
form one arithmetic progression, whose difference is q, as a smaller difference would be a
smaller period of the run; so the nearest occurrence on each side gives the only
candidates.  Each candidate is extended both ways as far as the period holds.

The words of many texts, a separator of its own after each text, share one index: suffixes
sorted by prefix doubling, whose rounds give the suffix-array interval of every block of
that length, and a wavelet matrix over the suffix array.  The occurrence next to a block is
a range successor (predecessor) query in the block's interval.  All queries of an index
descend the matrix together.

A null or empty text has no words and no runs; a row without id is read as it stands, as
no number can be drawn for it.  Repeated ids and repeated rows keep their rows.  Ties for
the greatest exponent go to the smallest start, then period.  Memory is linear in the
words of one slice of rows, or of one longer text.  Empty table: no rows.  Other columns
are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.llm.common import read_table, slices

LEAST_LENGTH, LEAST_EXPONENT = 6, 4
MOST_WORDS = 1 << 16  # words of an index, if no text alone has more


class WaveletMatrix:
    """Numbers below 2**bits in order of place; queries are arrays, answered together."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(values.max(initial=0)).bit_length())
        self.zeros, self.start = [], []
        for bit in range(self.bits - 1, -1, -1):
            one = (values >> bit & 1).astype(bool)
            before = np.zeros(len(values) + 1, np.int32)
            np.cumsum(~one, out=before[1:])
            self.zeros.append(before)
            self.start.append(int(before[-1]))
            values = np.concatenate([values[~one], values[one]])

    def below(self, low: np.ndarray, high: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """How many values at the places from low up to high are less than limit."""
        low, high, found = low.copy(), high.copy(), np.zeros(len(low), np.int64)
        for level, bit in enumerate(range(self.bits - 1, -1, -1)):
            before, start = self.zeros[level], self.start[level]
            a, b = before[low], before[high]
            one = (limit >> bit & 1).astype(bool)
            found += np.where(one, b - a, 0)
            low = np.where(one, low - a + start, a)
            high = np.where(one, high - b + start, b)
        return found

    def smallest(self, low: np.ndarray, high: np.ndarray, nth: np.ndarray) -> np.ndarray:
        """The value with nth smaller or equal ones before it, among places low to high."""
        low, high, nth = low.copy(), high.copy(), nth.copy()
        value = np.zeros(len(low), np.int64)
        for level, bit in enumerate(range(self.bits - 1, -1, -1)):
            before, start = self.zeros[level], self.start[level]
            a, b = before[low], before[high]
            one = nth >= b - a
            value |= one.astype(np.int64) << bit
            nth = np.where(one, nth - (b - a), nth)
            low = np.where(one, low - a + start, a)
            high = np.where(one, high - b + start, b)
        return value


def block_intervals(
    ids: np.ndarray, longest: int
) -> tuple[np.ndarray, list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]]:
    """Suffixes sorted as far as blocks of ``longest`` words tell them apart, and
    (block length, starts, interval from, interval to) of the dyadic blocks that occur
    more than once."""
    n = len(ids)
    order = np.argsort(ids, kind="stable")
    rank, stop = np.empty(n, np.int64), np.empty(n, np.int64)

    def settle(places: np.ndarray, keys: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Number groups of equal keys by their place in the order; groups of two or more."""
        new = np.concatenate([[True], keys[1:] != keys[:-1]])
        begin = np.flatnonzero(new)
        size = np.diff(np.append(begin, len(keys)))
        group = np.cumsum(new) - 1
        rank[places] = first[begin][group]
        stop[places] = (first[begin] + size)[group]
        return size[group] > 1

    many = settle(order, ids[order], np.arange(n))
    at = np.flatnonzero(many)  # places in the order that are not settled yet
    blocks, length = [], 1
    while len(at) and length * 2 <= longest:
        places = order[at]
        # A block at the end of the index has no second half; separators make it alone.
        after = np.where(places + length < n, rank[np.minimum(places + length, n - 1)], -1)
        keys = rank[places] * (n + 1) + after + 1
        by = np.argsort(keys, kind="stable")
        order[at] = places[by]
        many = settle(places[by], keys[by], at)
        at = at[many]
        length *= 2
        starts = order[at]
        starts = starts[starts % length == 0]
        blocks.append((length, starts, rank[starts], stop[starts]))
    return order, blocks


def candidates(ids: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, period): words at place and place + period may lie in a run of that period."""
    order, blocks = block_intervals(ids, longest)
    blocks = [b for b in blocks if len(b[1])]
    if not blocks:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    length = np.concatenate([np.full(len(s), b) for b, s, _, _ in blocks])
    start, low, high = (np.concatenate([b[i] for b in blocks]) for i in (1, 2, 3))
    matrix = WaveletMatrix(order)
    less = matrix.below(low, high, start)
    out = []
    has = np.flatnonzero(less + 1 < high - low)
    after = matrix.smallest(low[has], high[has], less[has] + 1)
    out.append((start[has], after - start[has], length[has]))
    has = np.flatnonzero(less > 0)
    before = matrix.smallest(low[has], high[has], less[has] - 1)
    out.append((before, start[has] - before, length[has]))
    place, period, length = (np.concatenate(x) for x in zip(*out, strict=True))
    # Shorter periods belong to shorter blocks.
    own = (period <= length) & (period > np.where(length == 2, 0, length // 2))
    return place[own], period[own]


def _stretch(ids: np.ndarray, place: int, period: int, step: int) -> int:
    """How many words from place on (or back) equal the word one period later."""
    total, size = 0, 32
    while True:
        if step > 0:
            a = ids[place + total : place + total + size]
            b = ids[place + total + period : place + total + period + size]
            equal = a[: len(b)] == b
        else:
            low = max(0, place - total - size)
            equal = (ids[low : place - total] == ids[low + period : place - total + period])[::-1]
        wrong = equal.argmin() if len(equal) else 0
        if not len(equal) or not equal[wrong]:
            return total + int(wrong)
        total, size = total + len(equal), size * 2


def runs_of(ids: np.ndarray, longest: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start, then period.

    ``ids`` numbers the words; every text ends with a number used once in all.
    ``longest`` is the number of words of the longest text.
    """
    place, period = candidates(ids, max(2, longest // 2))
    by = np.lexsort((place, period))
    found, done = [], (0, -1)
    for at, q in zip(place[by].tolist(), period[by].tolist(), strict=True):
        if done[0] == q and at < done[1]:
            continue  # inside the run before
        left = _stretch(ids, at, q, -1)
        right = _stretch(ids, at, q, 1)
        done = (q, at + right)
        length = left + right + q
        if length >= max(LEAST_LENGTH, LEAST_EXPONENT * q):
            found.append((at - left, length, q))
    found.sort(key=lambda x: (x[0], x[2]))
    return found


def altered(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words of a text as the contract of the query wants them read."""
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    cycle = words[a : a + p]
    return words[:a] + (cycle * ((n - a) // p + 1))[: n - a]


def describe(words: list[bytes], runs: list[tuple[int, int, int]]) -> tuple:
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    keep = words
    if runs:
        drop = np.zeros(len(words) + 1, np.int64)
        for start, length, period in runs:
            drop[start + period] += 1
            drop[start + length] -= 1
        kept = np.flatnonzero(np.cumsum(drop)[:-1] == 0)
        keep = [words[i] for i in kept.tolist()]
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()
    first = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (
        len(runs),
        *first,
        hashlib.sha256(listed).hexdigest(),
        hashlib.sha256(b" ".join(keep)).hexdigest(),
    )


def described(texts: list[list[bytes]]) -> Iterator[tuple]:
    """One row of results per text, from one index over all."""
    number: dict[bytes, int] = {}
    parts, ends, total = [], [], 0
    for words in texts:
        parts.append(np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64))
        parts.append(np.zeros(1, np.int64))
        total += len(words) + 1
        ends.append(total)
    if not texts:
        return
    ids = np.concatenate(parts)
    ids[np.array(ends) - 1] = len(number) + np.arange(len(ends))
    runs = runs_of(ids, max(map(len, texts)))
    owner = np.searchsorted(ends, [r[0] for r in runs], side="right")
    mine: list[list] = [[] for _ in texts]
    for k, (start, length, period) in zip(owner.tolist(), runs, strict=True):
        mine[k].append((start - (ends[k] - len(texts[k]) - 1), length, period))
    for words, own in zip(texts, mine, strict=True):
        yield describe(words, own)


SCHEMA = (
    "id bigint, n_runs bigint, start bigint, length bigint, period bigint, "
    "exponent_milli bigint, runs_sha256 string, collapsed_sha256 string"
)


def periodic_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", alter=None
) -> DataFrame:
    """Runs of each whole text: number, the one of greatest exponent, digests of all runs
    and of the text collapsed to the first period of each.

    ``alter(words, id)`` may rewrite the words first.  One scan, no shuffle.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("id", pa.int64()), *[(f, pa.int64()) for f in SCHEMA.split() if f in LONGS]]
            + [(f, pa.string()) for f in ("runs_sha256", "collapsed_sha256")]
        )
        for batch in batches:
            for part in slices(batch):
                ids, rows = part.column("id").to_pylist(), []
                waiting, n_waiting = [], 0
                for doc_id, text in zip(ids, part.column("text").to_pylist(), strict=True):
                    # Splits at \x20 and \x09 to \x0D, as bytes know no other white space.
                    words = text.encode().split()
                    words = alter(words, doc_id) if alter else words
                    if waiting and n_waiting + len(words) > MOST_WORDS:
                        rows.extend(described(waiting))
                        waiting, n_waiting = [], 0
                    waiting.append(words)
                    n_waiting += len(words)
                rows.extend(described(waiting))
                columns = [ids, *zip(*rows, strict=True)] if rows else [[] for _ in schema]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)],
                    schema=schema,
                )

    chosen = docs.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    return chosen.mapInArrow(work, SCHEMA).withColumnRenamed("id", id_col)


LONGS = ("n_runs", "start", "length", "period", "exponent_milli")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs(read_table(spark, sf_dir, "documents"), alter=altered)
