"""Token counts by a compiled finite-state transducer.

The piece model is compiled to a deterministic transducer over characters.  After a
prefix of the text only those earlier places matter from which a piece may still
reach beyond the end: a state holds, for each of them, the last token of the prefix up
to there and the number of tokens, less the least of these numbers.  By that much the
least number grows, a transition emits tokens.  A token may follow another at a place
if the two, encoded together, stay apart; exactly one token fits at each place.
Transitions are compiled when they are first taken.

A text is cut into chunks.  The map of a chunk takes an entry state to the exit state
and the tokens emitted between; maps of neighbours compose, and a balanced tree of
compositions (a parallel prefix scan) gives the count of the text.  Maps are partial:
they begin with the entry state that the characters before the chunk suggest, and are
extended when the composition arrives with another one, so the count is exact.  Within
a chunk, spaces after other characters reset the transducer whenever no piece crosses
such a place; the path from one reset to the next is one compiled transition.

Null and empty texts have no tokens and, like all others, keep their row; so do null or
repeated ids and repeated rows.  Texts of any length are read whole, in memory linear in
one slice of rows.  Empty table: no rows.  Other columns are not read.
"""

from __future__ import annotations

import gc
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.llm.common import read_table, slices

SPACE = "▁"
CHUNK = 1 << 13  # characters of a chunk
LOOK_BACK = 64  # characters before a chunk that suggest its entry state
MOST_STATES = 1 << 18  # compiled states kept in a task, about 1 KB each
MOST_PATHS = 1 << 20  # paths from reset to reset kept in a task, about 150 bytes each
LIMIT = 4096  # tokens
NO = float("-inf")


class State:
    """``seen``: the longest end of the text that begins a piece.

    ``last`` and ``count`` run over the ends of ``seen`` that begin a piece, longest
    first, then the empty end: last token before it, and tokens in excess.
    """

    __slots__ = ("count", "last", "moves", "seen")

    def __init__(self, seen: str, last: tuple, count: tuple):
        self.seen, self.last, self.count = seen, last, count
        self.moves: dict[str, tuple[State, int]] = {}


class Transducer:
    """Compiled from a SentencePiece BPE model; built anew when it outgrows its bounds."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.score: dict[str, float] = {}
        for i in range(model.get_piece_size()):
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)):
                self.score[model.id_to_piece(i)] = model.get_score(i)
        self.begins = {p[:n] for p in self.score for n in range(1, len(p))}
        self.inside = {p[i : i + 2] for p in self.score for i in range(len(p) - 1)}
        # Does a space after another character always part two tokens?
        self.spaces_part = all(p[0] == SPACE for p in self.inside if p[1] == SPACE)
        self.whole: dict[str, bool] = {}
        self.apart: dict[tuple[str, str], bool] = {}
        self.states: dict[tuple, State] = {}
        self.clear()

    def clear(self) -> None:
        for state in self.states.values():
            state.moves.clear()  # states refer to each other
        self.start = State("", (None,), (0,))
        self.states = {("", (None,), (0,)): self.start}
        self.steps: dict[tuple[str, str], tuple] = {}
        self.paths = Paths(self)

    def merge(self, text: str) -> list[str]:
        """Tokens of a short text: the best-scored neighbours join first, leftmost on ties."""
        symbols = list(text)
        get = self.score.get
        while len(symbols) > 1:
            scores = [get(a + b, NO) for a, b in zip(symbols, symbols[1:], strict=False)]
            best = max(scores)
            if best == NO:
                break
            i = scores.index(best)
            symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
        return symbols

    def is_whole(self, token: str) -> bool:
        if token not in self.whole:
            self.whole[token] = self.merge(token) == [token]
        return self.whole[token]

    def fits(self, before: str | None, token: str) -> bool:
        """Whether ``token`` can be a token right after the token ``before``."""
        if before is None or before[-1] + token[0] not in self.inside:
            return True
        key = (before, token)
        found = self.apart.get(key)
        if found is None:
            if len(self.apart) > MOST_PATHS:
                self.apart.clear()
            found = self.apart[key] = self.merge(before + token) == [before, token]
        return found

    def open_ends(self, seen: str) -> list[int]:
        """Lengths of the ends of ``seen`` that begin a piece, longest first, then 0."""
        return [n for n in range(len(seen), 0, -1) if seen[-n:] in self.begins] + [0]

    def step(self, seen: str, char: str) -> tuple:
        """What a move means for all states that saw the same: candidates for the new last
        token as (place, token, tokens counted), the new ``seen``, the places it keeps."""
        text = seen + char
        place = {n: k for k, n in enumerate(self.open_ends(seen))}
        tokens = [text[-n:] for n in range(len(text), 0, -1) if n - 1 in place]
        fit = [
            # A character without a piece counts its bytes.
            (place[len(t) - 1], t, 1 if t in self.score else len(t.encode()))
            for t in tokens
            if len(t) == 1 or (t in self.score and self.is_whole(t))
        ]
        after = next((text[-n:] for n in range(len(text), 0, -1) if text[-n:] in self.begins), "")
        kept = [(place[n - 1], after[-n]) for n in self.open_ends(after) if n]
        return fit, after, kept

    def compile(self, state: State, char: str) -> tuple[State, int]:
        emitted = 0
        if state.seen and state.seen[-1] + char not in self.inside:
            # No piece crosses this place: all tokens before it are final.
            emitted, state = state.count[-1], self.start
        key = (state.seen, char)
        found = self.steps.get(key)
        if found is None:
            found = self.steps[key] = self.step(*key)
        candidates, seen, kept = found
        for k, token, own in candidates:
            if self.fits(state.last[k], token):
                break
        else:
            raise ValueError("the model is no BPE model")
        count = state.count[k] + own
        if not seen:
            return self.start, emitted + count
        # A last token matters only where a piece can cross its end.
        last = [
            state.last[k] if state.last[k] and state.last[k][-1] + c in self.inside else None
            for k, c in kept
        ]
        counts = [state.count[k] for k, _ in kept]
        least = min(*counts, count)
        key = (seen, (*last, token), (*[c - least for c in counts], count - least))
        out = self.states.get(key)
        if out is None:
            out = self.states[key] = State(*key)
        return out, emitted + least

    def run(self, state: State, text: str) -> tuple[State, int]:
        """Exit state and emitted tokens."""
        total = 0
        for char in text:
            move = state.moves.get(char)
            if move is None:
                move = state.moves[char] = self.compile(state, char)
            state, emitted = move
            total += emitted
        return state, total

    def chunk_map(self, chunk: str) -> Map:
        """The chunk between its first and last reset has one path for all entries."""
        first = RESET.search(chunk) if self.spaces_part else None
        if not first:
            return Map(lambda entry: self.run(entry, chunk))
        head, stop = chunk[: first.start() + 1], chunk.rindex(SPACE)
        while chunk[stop - 1] == SPACE:
            stop -= 1
        inner = sum(map(self.paths.__getitem__, UNIT.findall(chunk, len(head), stop)))
        exit_state, tail = self.run(self.start, chunk[stop:])

        def go(entry: State) -> tuple[State, int]:
            state, emitted = self.run(entry, head)
            return exit_state, emitted + state.count[-1] + inner + tail

        return Map(go)

    def count(self, text: str, size: int = CHUNK) -> int:
        """Tokens of a whole text."""
        if not text:
            return 0
        if len(self.states) > MOST_STATES:
            self.clear()
        if len(self.paths) > MOST_PATHS:
            self.paths.clear()
        text = SPACE + text.replace(" ", SPACE)
        maps = []
        for at in range(0, len(text), size):
            part = self.chunk_map(text[at : at + size])
            part(self.run(self.start, self.look_back(text, at))[0])
            maps.append(part)
        while len(maps) > 1:
            pairs = [composed(a, b) for a, b in zip(maps[::2], maps[1::2], strict=False)]
            maps = pairs + maps[len(pairs) * 2 :]
        state, total = maps[0](self.start)
        return total + state.count[-1]

    def look_back(self, text: str, at: int) -> str:
        """What stands before a place, from the last reset on if one is near."""
        near = text[max(0, at - LOOK_BACK) : at]
        resets = [m.end() for m in RESET.finditer(near)] if self.spaces_part else []
        return near[resets[-1] :] if resets else near


RESET = re.compile(f"[^{SPACE}](?={SPACE})")
UNIT = re.compile(f"{SPACE}+[^{SPACE}]*")


class Map:
    """A partial map from entry states to (exit state, tokens), extended when asked."""

    def __init__(self, go):
        self.go, self.known = go, {}

    def __call__(self, entry: State) -> tuple[State, int]:
        if entry not in self.known:
            self.known[entry] = self.go(entry)
        return self.known[entry]


def composed(first: Map, then: Map) -> Map:
    def go(entry: State) -> tuple[State, int]:
        middle, a = first(entry)
        last, b = then(middle)
        return last, a + b

    out = Map(go)
    for entry in first.known:
        out(entry)
    return out


class Paths(dict):
    """Tokens on the path from one reset to the next, by its characters."""

    def __init__(self, machine: Transducer):
        super().__init__()
        self.machine = machine

    def __missing__(self, unit: str) -> int:
        state, emitted = self.machine.run(self.machine.start, unit)
        self[unit] = emitted + state.count[-1]
        return self[unit]


def count_tokens(
    docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_bytes, n_tokens) of each whole text; one scan, no shuffle."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Transducer(model_path)
        gc.disable()  # states are many and live on; scanning them over and over costs most
        try:
            for batch in batches:
                for part in slices(batch):
                    texts = part.column("text")
                    tokens = [machine.count(t) for t in texts.to_pylist()]
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column("id"),
                            pc.cast(pc.binary_length(texts), pa.int64()),
                            pa.array(tokens, pa.int64()),
                        ],
                        ["id", "n_bytes", "n_tokens"],
                    )
        finally:
            machine.clear()
            gc.enable()

    chosen = docs.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    counted = chosen.mapInArrow(work, "id bigint, n_bytes bigint, n_tokens bigint")
    return counted.withColumnRenamed("id", id_col)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op12_token_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = count_tokens(read_table(spark, sf_dir, "documents"), default_model())
    return counted.withColumn("over_limit", F.col("n_tokens") > LIMIT)
