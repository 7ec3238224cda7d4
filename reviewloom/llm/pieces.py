"""SentencePiece encoding and decoding on a lattice of pieces.

The lattice of a word has an edge for every substring that is a piece.  It is built
as a relation inside each task: the distinct words of a slice, their substrings, and
an equi-join (by hash) to the piece table.  Edges are grouped by word and folded
into one segmentation.

The fold is the merge order of the model instead of a Viterbi pass: the public piece
model is a BPE model, whose scores are ranks, and the best sum of ranks is not the
segmentation SentencePiece gives.  All words of a slice take a merge at a time; words
over LONG characters merge from a heap, one by one.  ``viterbi_words`` keeps the
relational form, with Spark's own aggregate for the fold, for unigram models.

Characters without a piece become byte pieces; the mark SPACE in a text reads as a
space, as in the model's own encoder.  Null and empty texts have no ids.
Null or repeated ids and repeated rows keep their rows.  Empty table: no rows.  Other
columns are not read.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.llm.common import read_table, slices

SPACE = "▁"
LONG = 200  # characters
# Units that no piece reaches across: a run of spaces and what follows, line ends.
UNIT = re.compile(rf"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+")
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
NONE = np.iinfo(np.int64).max


class Pieces:
    """The piece table of a model: 32,000 rows or so, sent with the task."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.piece, self.score, self.byte, self.bytes = [], [], {}, {}
        normal = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            self.piece.append(piece)
            self.score.append(model.get_score(i))
            if model.is_byte(i):
                self.byte[int(piece[3:5], 16)] = i
                self.bytes[i] = bytes([int(piece[3:5], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                normal.append(i)
                self.bytes[i] = piece.replace(SPACE, " ").encode()
        self.longest = max(len(self.piece[i]) for i in normal)
        # Rank of each piece in the order of merging, and its id, by hash.
        ranked = sorted(normal, key=lambda i: (-self.score[i], i))
        codes = [np.frombuffer(self.piece[i].encode("utf-32-le"), np.uint32) for i in ranked]
        hashes = np.array(
            [
                sum((int(c) + 1) * pow(int(BASE), j, 1 << 64) for j, c in enumerate(x)) % (1 << 64)
                for x in codes
            ],
            np.uint64,
        )
        order = np.argsort(hashes)
        self.hashes, self.rank = hashes[order], order.astype(np.int64)
        self.id_of_rank = np.array(ranked, np.int64)
        self.some = np.zeros(1 << 20, bool)  # is there a piece whose hash begins so?
        self.some[self.hashes >> np.uint64(44)] = True
        self.bytes_by_id = [self.bytes.get(i, b"") for i in range(len(self.piece))]
        self.n_bytes = np.fromiter(map(len, self.bytes_by_id), np.int64, len(self.piece))
        self.byte_ids = np.array([self.byte.get(b, -1) for b in range(256)], np.int32)
        self.number = {self.piece[i]: i for i in normal}

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Rank of the piece with each hash, or NONE."""
        found = np.full(len(hashes), NONE)
        likely = np.flatnonzero(self.some[hashes >> np.uint64(44)])
        hashes = hashes[likely]
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        found[likely] = np.where(self.hashes[at] == hashes, self.rank[at], NONE)
        return found


def _merge_long(word: str, pieces: Pieces) -> list[str]:
    """Symbols of one long word, merging from a heap of adjacent pairs."""
    symbols, after = list(word), list(range(1, len(word) + 1))
    before = list(range(-1, len(word) - 1))
    heap: list[tuple] = []

    def offer(i: int) -> None:
        j = after[i]
        if i >= 0 and j < len(symbols):
            number = pieces.number.get(symbols[i] + symbols[j])
            if number is not None:
                heapq.heappush(heap, (-pieces.score[number], i, symbols[i], symbols[j]))

    for i in range(len(symbols) - 1):
        offer(i)
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = after[i]
        if symbols[i] != a or j >= len(symbols) or symbols[j] != b or not a:
            continue
        symbols[i], symbols[j] = a + b, ""
        after[i] = after[j]
        if after[i] < len(symbols):
            before[after[i]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    return [s for s in symbols if s]


def encode_words(words: list[str], pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words in a row, and how many each has (spaces already written as SPACE)."""
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size)
    total = len(codes)
    powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(total, BASE)]))
    inverse = np.cumprod(np.concatenate([[np.uint64(1)], np.full(total, INVERSE)]))
    prefix = np.concatenate(
        [[np.uint64(0)], np.cumsum((codes.astype(np.uint64) + 1) * powers[:-1], dtype=np.uint64)]
    )

    def edge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the piece that spans characters a to b, or NONE."""
        found = np.full(len(a), NONE)
        short = b - a <= pieces.longest
        found[short] = pieces.find((prefix[b[short]] - prefix[a[short]]) * inverse[a[short]])
        return found

    owner = np.repeat(np.arange(len(words)), size)
    limit = end[owner]  # where the symbol's word ends
    after = np.arange(1, total + 1)  # start of the next symbol
    before = np.arange(-1, total - 1)
    alive = np.ones(total, bool)
    best = np.full(total, NONE)  # rank of the symbol joined with the next
    inner = np.flatnonzero(after < limit)
    best[inner] = edge(inner, after[inner] + 1)
    active = np.flatnonzero((size > 1) & (size <= LONG))
    while len(active):
        starts = end[active] - size[active]
        spans = size[active]
        at = np.repeat(starts - (np.cumsum(spans) - spans), spans) + np.arange(spans.sum())
        low = np.minimum.reduceat(best[at], np.cumsum(spans) - spans)
        go = low < NONE
        active, starts, low, spans = active[go], starts[go], low[go], spans[go]
        if not len(active):
            break
        # The leftmost symbol that has the least rank of its word.
        at = np.repeat(starts - (np.cumsum(spans) - spans), spans) + np.arange(spans.sum())
        hit = best[at] == np.repeat(low, spans)
        word = np.repeat(np.arange(len(active)), spans)[hit]
        place = at[hit]
        first = np.concatenate([[True], word[1:] != word[:-1]])
        left = place[first]
        right = after[left]
        alive[right], best[right] = False, NONE
        after[left] = after[right]
        inside = after[left] < limit[left]
        before[after[left][inside]] = left[inside]
        best[left] = NONE
        if inside.any():
            a, nxt = left[inside], after[left][inside]
            best[a] = edge(a, after[nxt])
        prev = before[left]
        has = (prev >= 0) & (left > end[owner[left]] - size[owner[left]])
        if has.any():
            p = prev[has]
            best[p] = edge(p, after[left][has])
    symbol = np.flatnonzero(alive & (size[owner] <= LONG))
    rank = edge(symbol, after[symbol])
    known, code = rank < NONE, codes[symbol]
    # A character without a piece becomes the pieces of its bytes.
    width = np.where(known, 1, 1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF))
    short = np.empty(width.sum(), np.int32)
    whole = np.repeat(known, width)
    short[whole] = pieces.id_of_rank[rank[known]]
    raw = code[~known].tobytes().decode("utf-32-le").encode()
    short[~whole] = pieces.byte_ids[np.frombuffer(raw, np.uint8)]
    count = np.bincount(owner[symbol], width, minlength=len(words)).astype(np.int64)
    long_ids: list[int] = []
    for i in np.flatnonzero(size > LONG):
        before_it = len(long_ids)
        for s in _merge_long(words[i], pieces):
            number = pieces.number.get(s)
            long_ids += [number] if number is not None else [pieces.byte[b] for b in s.encode()]
        count[i] = len(long_ids) - before_it
    ids = np.empty(count.sum(), np.int32)
    of_long = np.repeat(size > LONG, count)
    ids[~of_long], ids[of_long] = short, long_ids
    return ids, count


def round_trips(
    words: list[str], ids: np.ndarray, count: np.ndarray, pieces: Pieces
) -> np.ndarray:
    """Whether the ids of each word decode to it."""
    got = b"".join(map(pieces.bytes_by_id.__getitem__, ids.tolist()))
    upto = np.concatenate([[0], np.cumsum(pieces.n_bytes[ids])])
    got_end = upto[np.cumsum(count)]
    plain = pc.replace_substring(pa.array(words, pa.string()), SPACE, " ")
    wanted = "".join(words).replace(SPACE, " ").encode()
    end = np.cumsum(pc.binary_length(plain).to_numpy(zero_copy_only=False).astype(np.int64))
    if got == wanted and (got_end == end).all():
        return np.ones(len(words), bool)
    pairs = zip(got_end.tolist(), np.diff(got_end, prepend=0).tolist(), plain, strict=True)
    return np.array([got[e - n : e] == w.as_py().encode() for e, n, w in pairs], bool)


def encode(
    docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, ids, round_trip): ids of each whole text; round_trip: decoding gives it back."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(model_path)
        for batch in batches:
            for part in slices(batch):
                counts, units = [], []
                for text in part.column("text").to_pylist():
                    found = UNIT.findall(SPACE + text.replace(" ", SPACE)) if text else []
                    counts.append(len(found))
                    units += found
                coded = pa.array(units, pa.string()).dictionary_encode()
                index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                plain = coded.dictionary.to_pylist()
                flat, size = encode_words(plain, pieces)
                same = round_trips(plain, flat, size, pieces)
                begin = np.cumsum(size) - size
                own = size[index]
                stop = np.cumsum(own)
                where = np.repeat(begin[index] - (stop - own), own) + np.arange(own.sum())
                ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
                cuts = np.concatenate([[0], stop])[ends]
                wrong = np.concatenate([[0], np.cumsum(~same[index])])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(flat[where])),
                        pa.array(np.diff(wrong[ends]) == 0),
                    ],
                    ["id", "ids", "round_trip"],
                )

    chosen = docs.select(
        F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text")
    )
    encoded = chosen.mapInArrow(work, "id bigint, ids array<int>, round_trip boolean")
    return encoded.withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, model_path: str, id_col: str = "doc_id") -> DataFrame:
    """(id, text) of a table (id, ids); null ids of a row give an empty text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(model_path)
        for batch in batches:
            texts = []
            for ids in batch.column("ids").to_pylist():
                raw = b"".join(pieces.bytes.get(i, b"") for i in ids or [])
                text = raw.decode("utf-8", "replace")
                texts.append(text[1:] if text[:1] == " " else text)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(texts, pa.string())], ["id", "text"]
            )

    chosen = encoded.select(F.col(id_col).cast("bigint").alias("id"), "ids")
    return chosen.mapInArrow(work, "id bigint, text string").withColumnRenamed("id", id_col)


def viterbi_words(words: DataFrame, table: DataFrame, longest: int) -> DataFrame:
    """(word, pieces): the segmentation of the best summed score, for unigram models.

    ``words`` has distinct non-null words, ``table`` (piece, score) at most as many
    rows as a vocabulary.  Substrings are exploded, joined to the table, grouped by
    word and folded by end.  Words that no path covers give null; ties go to the
    longer last piece.
    """
    size = F.length("word")
    starts = words.where(size > 0).select(
        "word", F.explode(F.sequence(F.lit(1), size)).alias("start")
    )
    spans = starts.select(
        "word",
        "start",
        F.explode(
            F.sequence(F.lit(1), F.least(F.lit(longest), size - F.col("start") + 1))
        ).alias("n"),
    ).withColumn("piece", F.expr("substring(word, start, n)"))
    edges = spans.join(F.broadcast(table), "piece")
    ordered = edges.groupBy("word").agg(
        F.array_sort(
            F.collect_list(
                F.struct(
                    (F.col("start") + F.col("n") - 1).alias("stop"), "start", "piece", "score"
                )
            )
        ).alias("edges")
    )
    # best[k]: score and pieces of the best way to cover the first k characters.
    kind = "array<struct<score:double,pieces:array<string>>>"
    first = F.expr(
        "transform(sequence(0, length(word)), k -> named_struct('score', "
        "if(k = 0, 0.0D, double('-infinity')), 'pieces', cast(array() as array<string>)))"
    ).cast(kind)

    def step(best, e):
        way = F.get(best, e["start"] - 1)
        reached = way["score"] + e["score"]
        better = reached > F.get(best, e["stop"])["score"]
        here = F.struct(
            reached.alias("score"), F.concat(way["pieces"], F.array(e["piece"])).alias("pieces")
        )
        return F.when(
            better, F.transform(best, lambda x, k: F.when(k == e["stop"], here).otherwise(x))
        ).otherwise(best)

    folded = ordered.select(
        "word", F.element_at(F.aggregate("edges", first, step), -1).alias("last")
    )
    return folded.select(
        "word",
        F.when(F.col("last.score") > F.lit(float("-inf")), F.col("last.pieces")).alias("pieces"),
    )


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op10_piece_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    @F.pandas_udf("bigint")
    def checksum(ids):
        return ids.map(lambda x: zlib.crc32(np.asarray(x, "<u4").tobytes()))

    encoded = encode(read_table(spark, sf_dir, "documents"), default_model())
    return encoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_pieces"),
        checksum("ids").alias("ids_crc32"),
        "round_trip",
    )
