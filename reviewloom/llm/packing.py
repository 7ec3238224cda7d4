"""Bounded-space online packing of token sequences.

Each task reads its documents once, encodes them and packs as it goes.  It keeps
a fixed number of open windows.  Full windows of a long document leave at once;
the remainder goes to the window it fits best.  When none fits, the fullest
window is topped up with the head of the remainder (unless the gap is a sliver)
and emitted.  At the end of a task the open windows are merged into full ones, by
cutting, and one partial window is left.  The partial windows of all tasks are
merged in rounds of FAN_IN, until one is left in all.

Null text is an empty document of one token (the end mark).  Null or repeated ids
and repeated rows are documents of their own.  Empty table: no rows.  Other
columns are not read.
"""

from __future__ import annotations

import bisect
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.llm.common import read_table, slices, staged

WINDOW = 2048
OPEN_WINDOWS = 64
END_ID = 1
SLIVER = 16  # gaps below this many tokens are padded instead of filled by a cut
FAN_IN = 512
RUN = 2_000  # chunks encoded in one string

# Fixed value of byte-level vocabularies: how text is cut before the merges.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)

PIECE = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint"
)
PIECE_NAMES = [c.split()[0] for c in PIECE.split(", ")]


class Encoder:
    """Ids of whole texts by a tokenizer file, encoding every distinct chunk once.

    The vocabulary splits text before each space that a word follows, so the
    chunks between such spaces are encoded alone.  Texts with a space inside a
    longer run of white space are encoded whole.  Added tokens of the file, where a
    text spells them, are one id each and what lies between them is encoded alone.
    """

    EDGE = r"\A\z|\A[\s\pZ\x0b\x1c-\x1f\x{85}]|[\s\pZ\x0b\x1c-\x1f\x{85}]\z"
    INSIDE_RUN = r"[\s\pZ\x0b\x1c-\x1f\x{85}] (?:[\s\pZ\x0b\x1c-\x1f\x{85}]|\z)"

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        vocabulary = tokenizer.get_vocab()
        added = tokenizer.get_added_tokens_decoder()
        self.added = {token.content: i for i, token in added.items()}
        # The longest first, as one may begin another.
        names = sorted(self.added, key=len, reverse=True)
        self.any_added = "|".join(map(re.escape, names)) or r"\A\b\B"
        # Byte-level tokens are written with one character per byte: printable
        # bytes as themselves, the others from 256 on, in order.
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in printable]
        byte_of = {chr(b): b for b in printable}
        byte_of |= {chr(256 + n): b for n, b in enumerate(others)}
        ranks = {
            bytes(byte_of[c] for c in token): i
            for token, i in vocabulary.items()
            if all(c in byte_of for c in token) and token not in self.added
        }
        self.bytes_of = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, i in ranks.items():
            self.bytes_of[i] = len(token)
        # Merges rank by id in this vocabulary, so the faster encoder gives the same ids.
        self.encoder = tiktoken.Encoding(
            "byte_level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}
        )

    def _encoded(self, texts: list[str]) -> Iterator[np.ndarray]:
        for text in texts:
            yield np.array(self.encoder.encode_ordinary(text), np.uint32)

    def _whole(self, text: str) -> np.ndarray:
        """Ids of one text, added tokens included."""
        parts, at = [], 0
        for found in re.finditer(self.any_added, text):
            parts += [text[at : found.start()], found.group()]
            at = found.end()
        plain = list(self._encoded([*parts[::2], text[at:]]))
        out = [plain[0]]
        for name, ids in zip(parts[1::2], plain[1:], strict=True):
            out += [np.array([self.added[name]], np.uint32), ids]
        return np.concatenate(out)

    def _ids(self, chunks: pa.Array, alone: list[str]) -> tuple[np.ndarray, ...]:
        """The ids of " " + chunk for each chunk, then of the others as they are.

        Returns all ids in one array, where those of each begin and how many.
        Chunks between which white space cannot run together are encoded in
        long strings, whose ids are cut where the bytes of a chunk end.
        """
        apart = pc.match_substring_regex(chunks, self.EDGE).to_numpy(zero_copy_only=False)
        order = np.concatenate([np.flatnonzero(~apart), np.flatnonzero(apart)])
        size = np.zeros(len(chunks) + len(alone), np.int64)
        parts = [np.zeros(0, np.uint32)]
        joined = int((~apart).sum())
        ordered = chunks.take(pa.array(order))
        for a in range(0, joined, RUN):
            run = ordered.slice(a, min(RUN, joined - a))
            text = " " + " ".join(run.to_pylist())
            ids = next(self._encoded([text]))
            ends = np.cumsum(1 + pc.binary_length(run).to_numpy(zero_copy_only=False))
            stop = np.searchsorted(np.cumsum(self.bytes_of[ids]), ends) + 1
            size[order[a : a + len(run)]] = np.diff(stop, prepend=0)
            parts.append(ids)
        rest = [" " + c for c in ordered.slice(joined).to_pylist()] + alone
        where = np.concatenate([order[joined:], np.arange(len(chunks), len(size))])
        for i, ids in zip(where, self._encoded(rest), strict=True):
            size[i] = len(ids)
            parts.append(ids)
        sequence = np.concatenate([order[:joined], where])
        begin = np.zeros(len(size), np.int64)
        begin[sequence] = np.cumsum(size[sequence]) - size[sequence]
        return np.concatenate(parts), begin, size

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """One id array per text, in order."""
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring_regex(texts, self.INSIDE_RUN).to_numpy(zero_copy_only=False)
        for name in self.added:
            odd = odd | pc.match_substring(texts, name).to_numpy(zero_copy_only=False)
        # A mark in front of all but the first chunk brings its space back.
        lists = pc.split_pattern(texts, " ")
        counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(counts)
        first = ends - counts
        coded = pc.list_flatten(lists).dictionary_encode()
        index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        plain = coded.dictionary
        heads = np.zeros(len(index), bool)
        heads[first[counts > 0]] = True
        # Distinct chunks: with the space, and the few that begin a text without it.
        bare = np.unique(index[heads])
        flat, begin, sizes = self._ids(plain, plain.take(pa.array(bare)).to_pylist())
        alone = np.zeros(len(plain), np.int64)
        alone[bare] = len(plain) + np.arange(len(bare))
        slot = np.where(heads, alone[index], index)
        size = sizes[slot]
        stop = np.cumsum(size)
        where = np.repeat(begin[slot] - (stop - size), size) + np.arange(size.sum())
        ids = flat[where]
        stop = np.concatenate([[0], stop])
        for i in range(len(counts)):
            if odd[i]:
                yield self._whole(texts[i].as_py())
            else:
                yield ids[stop[first[i]] : stop[ends[i]]]


class Packer:
    """The open windows of one task."""

    def __init__(self, sequence: int):
        self.sequence = sequence  # number of the next window
        self.order: list[tuple[int, int]] = []  # (free, window), ascending
        self.open: dict[int, list] = {}  # window -> its pieces
        self.opened = 0
        self.done: list[tuple] = []

    def _emit(self, pieces: list) -> None:
        offset = 0
        for doc_id, start, ids, total in pieces:
            crc = zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())
            self.done.append((doc_id, start, len(ids), crc, total, self.sequence, offset))
            offset += len(ids)
        self.sequence += 1

    def _put(self, rank: int, piece: tuple) -> None:
        free, window = self.order.pop(rank)
        self.open[window].append(piece)
        bisect.insort(self.order, (free - len(piece[2]), window))

    def add(self, doc_id, start: int, ids: np.ndarray, total: int) -> None:
        at = 0
        while len(ids) - at >= WINDOW:
            self._emit([(doc_id, start + at, ids[at : at + WINDOW], total)])
            at += WINDOW
        if at == len(ids):
            return
        start, ids = start + at, ids[at:]
        while True:
            rank = bisect.bisect_left(self.order, (len(ids), -1))
            if rank < len(self.order):
                self._put(rank, (doc_id, start, ids, total))
                break
            if len(self.open) < OPEN_WINDOWS:
                self.opened += 1
                self.open[self.opened] = []
                bisect.insort(self.order, (WINDOW, self.opened))
                continue
            free, window = self.order.pop(0)
            pieces = self.open.pop(window)
            if free >= SLIVER:
                pieces.append((doc_id, start, ids[:free], total))
                start, ids = start + free, ids[free:]
            self._emit(pieces)
        if self.order and self.order[0][0] == 0:
            self._emit(self.open.pop(self.order.pop(0)[1]))

    def finish(self) -> list:
        """Merge what is open into full windows; the pieces of the partial rest."""
        fullest_first = [self.open[w] for _, w in self.order]
        self.order, self.open = [], {}
        rest: list = []
        room = WINDOW
        for piece in (p for pieces in fullest_first for p in pieces):
            doc_id, start, ids, total = piece
            while len(ids) >= room:
                rest.append((doc_id, start, ids[:room], total))
                self._emit(rest)
                start, ids, rest, room = start + room, ids[room:], [], WINDOW
            if len(ids):
                rest.append((doc_id, start, ids, total))
                room -= len(ids)
        return rest

    def rows(self, rest: list = ()) -> list[tuple]:
        """Finished pieces, and those of the rest with their ids and no sequence."""
        out = [(*row, None) for row in self.done]
        out += [(d, s, len(i), None, t, None, None, i.tolist()) for d, s, i, t in rest]
        self.done = []
        return out


def _batch(rows: list[tuple], part: int) -> pa.RecordBatch:
    kinds = [pa.int64()] * 7 + [pa.list_(pa.int64())]
    columns = list(zip(*rows, strict=True)) if rows else [()] * 8
    arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
    arrays.append(pa.array(np.full(len(rows), part, np.int64)))
    return pa.RecordBatch.from_arrays(arrays, [*PIECE_NAMES, "ids", "part"])


def _merge(rest: DataFrame, level: int) -> DataFrame:
    """One round: the partial windows of up to FAN_IN tasks become full ones and one rest."""

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        group = int(pdf["part"].iloc[0]) // FAN_IN
        packer = Packer((1 << 60) + (level << 54) + (group << 20))
        pdf = pdf.sort_values(["part", "nth"], kind="stable")
        for d, s, t, ids in zip(
            pdf["doc_id"], pdf["start"], pdf["doc_tokens"], pdf["ids"], strict=True
        ):
            own = None if pd.isna(d) else int(d)
            packer.open[len(packer.open)] = [(own, int(s), np.asarray(ids, np.uint32), int(t))]
            packer.order.append((0, len(packer.open) - 1))
        rows = packer.rows(packer.finish())
        out = pd.DataFrame(rows, columns=[*PIECE_NAMES, "ids"])
        for name in PIECE_NAMES:
            out[name] = out[name].astype("Int64")
        out["part"] = group
        out["nth"] = range(len(out))
        return out

    keyed = rest.withColumn("merge", F.expr(f"part div {FAN_IN}"))
    return keyed.groupBy("merge").applyInPandas(
        work, f"{PIECE}, ids array<bigint>, part bigint, nth bigint"
    )


def pack(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Pieces of all documents (schema PIECE), each id in exactly one piece."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        encoder, packer = None, Packer(part << 32)
        for batch in batches:
            # Tasks without rows need no encoder.
            if encoder is None and batch.num_rows:
                encoder = Encoder(tokenizer_path)
            for some in slices(batch):
                for doc_id, ids in zip(
                    some.column("id").to_pylist(), encoder.encode(some.column("text")), strict=True
                ):
                    ids = np.append(ids, np.uint32(END_ID))
                    packer.add(doc_id, 0, ids, len(ids))
                yield _batch(packer.rows(), part)
        yield _batch(packer.rows(packer.finish()), part)

    chosen = docs.select(
        F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text")
    )
    first = chosen.mapInArrow(work, f"{PIECE}, ids array<bigint>, part bigint")
    packed = staged(first, "pieces")
    finished = packed.where("sequence_id is not null").select(*PIECE_NAMES)
    rest = packed.where("sequence_id is null").withColumn("nth", F.col("start"))
    level = 0
    while True:
        level += 1
        merged = staged(_merge(rest, level), "merged")
        finished = finished.unionByName(
            merged.where("sequence_id is not null").select(*PIECE_NAMES)
        )
        rest = merged.where("sequence_id is null")
        # Groups go by number, so few but far apart parts may leave several windows.
        if rest.select("part").distinct().limit(2).count() <= 1:
            break
    # What is left is one window; a checksum is all it still lacks.
    last = rest.groupBy(F.lit(0).alias("merge")).applyInPandas(_close, PIECE)
    return finished.unionByName(last)


def _close(pdf: pd.DataFrame) -> pd.DataFrame:
    packer = Packer(1 << 61)
    pieces = [
        (None if pd.isna(d) else int(d), int(s), np.asarray(ids, np.uint32), int(t))
        for d, s, t, ids in zip(
            pdf["doc_id"], pdf["start"], pdf["doc_tokens"], pdf["ids"], strict=True
        )
    ]
    packer._emit(pieces)
    out = pd.DataFrame(packer.done, columns=PIECE_NAMES)
    for name in PIECE_NAMES:
        out[name] = out[name].astype("Int64")
    return out


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op5_bounded_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"), default_tokenizer())
