"""Toxicity by multiple-instance learning.

A document is a bag of sentences.  A logistic model scores each sentence from its
words and word beginnings; the document's score is the noisy-or of its sentences,
1 - prod(1 - p).  Only document labels are known, so the weights are fitted on the
noisy-or itself, which at the same time learns which sentences are to blame; the
operator returns those as word ranges.

The model is fitted on at most TRAIN_DOCS labelled documents (a uniform draw by
hash of the id), by full-gradient steps that each are one Spark job over the
staged sample.  Every document is scored, whole.

Null and empty texts have no sentence and score 0.  Null ids are held out, and
score like others.  Labels that are null or of unknown documents are left out; of
several labels of one id the highest counts.  Without labels of both kinds every
score is 0.  Repeated rows are scored alike.  Empty table: no rows.  Other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.llm.common import Words, held_out, read_table, slices, staged

TRAIN_DOCS = 8_000
LEAST_DOCS = 3  # a feature must occur in so many training documents
FEATURES = 60_000  # the most frequent ones are kept
STARTS = (3, 4, 5, 6)  # word beginnings, in characters
STEPS = 60
RATE = 2.0
PENALTY = 1e-5
TRAIN_PARTS = 6
LINE = "\x1e"

FLAGGED = "array<struct<sentence:int,first_word:int,end_word:int,score:double>>"


class Sentences:
    """The sentences of some texts with the features of their words.

    A sentence ends at a line end or after a word that closes with . ! or ?.
    Features are letters only, in lower case: the word, and its beginnings.
    """

    CLOSES = r"[.!?…。！？][^\pL\pN]*\z"

    def __init__(self, texts: pa.Array):
        marked = pc.replace_substring(pc.fill_null(texts, ""), "\n", f" {LINE} ")
        words = Words(marked)
        self.words = words
        counts = np.diff(words.offsets)
        ends = pc.or_(
            pc.match_substring_regex(words.unique, self.CLOSES), pc.equal(words.unique, LINE)
        ).to_numpy(zero_copy_only=False)
        total = len(words.index)
        new = np.zeros(total, bool)
        if total:
            new[1:] = ends[words.index[:-1]]
            new[words.offsets[:-1][counts > 0]] = True
        self.sentence = np.cumsum(new) - 1  # of each word
        self.count = int(new.sum())
        owner = np.repeat(np.arange(len(counts)), counts)
        self.document = owner[new]  # of each sentence
        letters = pc.replace_substring_regex(words.unique, r"[^\pL]+", "")
        lower = pc.utf8_lower(letters)
        size = pc.utf8_length(lower)
        self.kinds = [pc.if_else(pc.greater(size, 0), lower, None)]
        for n in STARTS:
            start = pc.utf8_slice_codeunits(lower, 0, n)
            self.kinds.append(pc.if_else(pc.greater(size, n), start, None))

    def word_ranges(self) -> tuple[np.ndarray, np.ndarray]:
        """First word and end of each sentence, counted within its document."""
        real = (
            pc.not_equal(self.words.unique, LINE).to_numpy(zero_copy_only=False)[self.words.index]
            if len(self.words.index)
            else np.zeros(0, bool)
        )
        upto = np.concatenate([[0], np.cumsum(real)])
        base = upto[self.words.offsets[:-1]]
        edge = np.flatnonzero(np.diff(self.sentence, prepend=-1))
        stop = np.concatenate([edge[1:], [len(self.sentence)]]) if len(edge) else edge
        own = base[self.document]
        return upto[edge] - own, upto[stop] - own


def _sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(label, text): the training documents."""
    chosen = (
        labels.where("toxic is not null and doc_id is not null")
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(TRAIN_DOCS)
        .select(F.col("doc_id").cast("bigint").alias("train_id"), "label")
    )
    own = docs.select(
        F.col(id_col).cast("bigint").alias("train_id"), F.col(text_col).cast("string").alias("text")
    )
    # At most TRAIN_DOCS ids are broadcast.
    return own.join(F.broadcast(chosen), "train_id").select(F.col("label").cast("int"), "text")


def _vocabulary(sample: DataFrame) -> list[pa.Array]:
    """The features of each kind, those of most training documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                s = Sentences(part.column("text"))
                owner = np.repeat(np.arange(len(part)), np.diff(s.words.offsets))
                pairs = np.unique(owner * len(s.words.unique) + s.words.index)
                for kind, values in enumerate(s.kinds):
                    coded = values.dictionary_encode()
                    own = coded.indices.fill_null(-1).to_numpy(zero_copy_only=False)
                    n = len(coded.dictionary)
                    if not n:
                        continue
                    at = own[pairs % len(s.words.unique)].astype(np.int64)
                    seen = np.unique((pairs // len(s.words.unique) * n + at)[at >= 0]) % n
                    docs = np.bincount(seen, minlength=n)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(n, kind, np.int32)),
                            coded.dictionary.cast(pa.string()),
                            pa.array(docs.astype(np.int64)),
                        ],
                        ["kind", "feature", "docs"],
                    )

    top = (
        sample.select("text")
        .mapInArrow(count, "kind int, feature string, docs bigint")
        .groupBy("kind", "feature")
        .agg(F.sum("docs").alias("docs"))
        .where(F.col("docs") >= LEAST_DOCS)
        .orderBy(F.desc("docs"), "kind", "feature")
        .limit(FEATURES)
        .select("kind", "feature")
        .toArrow()
    )
    kinds = top.column("kind").to_numpy()
    names = top.column("feature").combine_chunks()
    return [names.filter(pa.array(kinds == k)) for k in range(1 + len(STARTS))]


def _indexed(s: Sentences, vocabulary: list[pa.Array]) -> Iterator[np.ndarray]:
    """Per kind: the feature number of each distinct word, or -1."""
    base = 1  # feature 0 is the constant
    for values, known in zip(s.kinds, vocabulary, strict=True):
        found = pc.index_in(values, value_set=known)
        number = found.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        yield np.where(number >= 0, number + base, -1)
        base += len(known)


def _training_rows(sample: DataFrame, vocabulary: list[pa.Array]) -> DataFrame:
    """One row per training document: label, sentences, and (sentence, feature) pairs."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                s = Sentences(part.column("text"))
                word, sentence = s.words.index, s.sentence
                found = []
                for number in _indexed(s, vocabulary):
                    at = number[word]
                    found.append((sentence[at >= 0], at[at >= 0]))
                row = np.concatenate([f[0] for f in found])
                feature = np.concatenate([f[1] for f in found])
                order = np.argsort(row, kind="stable")
                row, feature = row[order], feature[order]
                sentences = np.bincount(s.document, minlength=len(part))
                first = np.cumsum(sentences) - sentences
                pairs = np.bincount(s.document[row], minlength=len(part)) if len(row) else (
                    np.zeros(len(part), np.int64)
                )
                ends = pa.array(np.concatenate([[0], np.cumsum(pairs)]), pa.int32())
                local = row - first[s.document[row]] if len(row) else row
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("label"),
                        pa.array(sentences.astype(np.int32)),
                        pa.ListArray.from_arrays(ends, pa.array(local.astype(np.int32))),
                        pa.ListArray.from_arrays(ends, pa.array(feature.astype(np.int32))),
                    ],
                    ["label", "sentences", "sentence", "feature"],
                )

    return sample.mapInArrow(
        work, "label int, sentences int, sentence array<int>, feature array<int>"
    )


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, z)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -60, 60)))


def _fit(rows: DataFrame, size: int) -> np.ndarray:
    """Weights by full-gradient steps of set length; every step is one pass over the sample.

    Weights and sums travel in single precision, and the broadcast of a step ends with
    it, so that the driver does not hold the weights of all steps.
    """

    def gradient(shipped: Broadcast) -> np.ndarray:
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            weights = shipped.value
            total, docs = np.zeros(size), 0
            for batch in batches:
                label = batch.column("label").to_numpy(zero_copy_only=False)
                count = batch.column("sentences").to_numpy(zero_copy_only=False).astype(np.int64)
                first = np.cumsum(count) - count
                pairs = pc.list_value_length(batch.column("feature")).to_numpy(
                    zero_copy_only=False
                )
                sentence = pc.list_flatten(batch.column("sentence")).to_numpy(
                    zero_copy_only=False
                ) + np.repeat(first, pairs)
                feature = pc.list_flatten(batch.column("feature")).to_numpy(zero_copy_only=False)
                n = int(count.sum())
                z = weights[0] + np.bincount(sentence, weights[feature], minlength=n)
                owner = np.repeat(np.arange(len(label)), count)
                none = np.bincount(owner, _softplus(z), minlength=len(label))  # -log(1 - P)
                odds = 1.0 / np.expm1(np.clip(none, 1e-12, 700.0))  # (1 - P) / P
                pull = np.where(label[owner] > 0, -odds[owner], 1.0) * _sigmoid(z)
                total += np.bincount(feature, pull[sentence], minlength=size)
                total[0] += pull.sum()
                docs += len(label)
            yield pa.RecordBatch.from_arrays(
                [pa.array([total.astype(np.float32).tobytes()]), pa.array([docs], pa.int64())],
                ["sum", "docs"],
            )

        parts = rows.mapInArrow(work, "sum binary, docs bigint").collect()
        docs = max(sum(r.docs for r in parts), 1)
        return sum((np.frombuffer(r["sum"], np.float32) for r in parts), np.zeros(size)) / docs

    weights = np.zeros(size)
    weights[0] = -5.0
    velocity = np.zeros(size)
    for step in range(1, STEPS + 1):
        shipped = rows.sparkSession.sparkContext.broadcast(weights.astype(np.float32))
        g = gradient(shipped)
        shipped.destroy()
        g[1:] += PENALTY * weights[1:]
        # A length of one keeps the many rare features from moving as fast as common ones.
        velocity = 0.9 * velocity + 0.1 * g / max(np.sqrt((g * g).sum()), 1e-12)
        weights -= RATE * min(1.0, 2.0 * (STEPS - step + 1) / STEPS) * velocity
    return weights


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[list[pa.Array], np.ndarray]:
    """(features by kind, weights); without both labels, a model that scores 0."""
    sample = staged(_sample(docs, labels, id_col, text_col).repartition(TRAIN_PARTS), "sample")
    if sample.agg(F.countDistinct(F.col("label") > 0)).first()[0] < 2:
        return [pa.array([], pa.string()) for _ in range(1 + len(STARTS))], np.array([-60.0])
    vocabulary = _vocabulary(sample)
    rows = staged(_training_rows(sample, vocabulary), "training")
    return vocabulary, _fit(rows, 1 + sum(len(v) for v in vocabulary))


def _logits(
    texts: pa.Array, vocabulary: list[pa.Array], weights: np.ndarray
) -> tuple[Sentences, np.ndarray]:
    """The sentences of some texts and the log odds of each."""
    s = Sentences(texts)
    value = np.zeros(len(s.words.unique))
    for number in _indexed(s, vocabulary):
        value += np.where(number >= 0, weights[number], 0.0)
    return s, weights[0] + np.bincount(s.sentence, value[s.words.index], minlength=s.count)


def score(
    docs: DataFrame,
    model: tuple[list[pa.Array], np.ndarray],
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, score, sentences, offending) of every document."""
    vocabulary, weights = model
    own = docs.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.col(text_col).cast("string").alias("text"),
    )
    flagged = pa.list_(
        pa.struct(
            [
                ("sentence", pa.int32()),
                ("first_word", pa.int32()),
                ("end_word", pa.int32()),
                ("score", pa.float64()),
            ]
        )
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                s, z = _logits(part.column("text"), vocabulary, weights)
                none = np.bincount(s.document, _softplus(z), minlength=len(part))
                p = _sigmoid(z)
                first, end = s.word_ranges()
                sentences = np.bincount(s.document, minlength=len(part))
                number = np.arange(s.count) - (np.cumsum(sentences) - sentences)[s.document]
                bad = np.flatnonzero(p >= 0.5)
                ends = np.concatenate(
                    [[0], np.cumsum(np.bincount(s.document[bad], minlength=len(part)))]
                )
                spans = pa.StructArray.from_arrays(
                    [
                        pa.array(number[bad].astype(np.int32)),
                        pa.array(first[bad].astype(np.int32)),
                        pa.array(end[bad].astype(np.int32)),
                        pa.array(p[bad]),
                    ],
                    fields=list(flagged.value_type),
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        pa.array(-np.expm1(-none)),
                        pa.array(sentences.astype(np.int32)),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), spans),
                    ],
                    ["id", "score", "sentences", "offending"],
                )

    scored = own.mapInArrow(
        work, f"id bigint, score double, sentences int, offending {FLAGGED}"
    )
    return scored.withColumnRenamed("id", id_col)


def score_column(model: tuple[list[pa.Array], np.ndarray], text_col: str = "text") -> Column:
    """The score alone, as a column beside a document's own."""
    vocabulary, weights = model

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        out = [np.zeros(0)]
        for part in slices(pa.RecordBatch.from_arrays([texts], ["text"])):
            s, z = _logits(part.column("text"), vocabulary, weights)
            none = np.bincount(s.document, _softplus(z), minlength=len(part))
            out.append(-np.expm1(-none))
        return pa.array(np.concatenate(out))

    return scored(F.col(text_col).cast("string"))


def op2_noisy_or_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = fit(docs, read_table(spark, sf_dir, "labels"))
    return score(docs, model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "sentences",
        "offending",
    )
