"""TF-IDF: the relational form and the row-local form used by models."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewloom import settings as S
from reviewloom.functions import text as X
from reviewloom.functions.blocks import flat_lists, lists_of, row_slices
from reviewloom.plans.shapes import stored


def term_list(text, stop_words: Iterable[str] = (), bigrams: bool = True):
    """Array of terms: word tokens without stop words, then neighbouring pairs."""
    words = X.word_tokens(text)
    stops = list(stop_words)
    if stops:
        words = X.drop_words(words, stops)
    return X.with_bigrams(words) if bigrams else words


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, also where lambdas refer to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def term_frequencies(terms: Column) -> Column:
    """Array of (term, tf) of an array of terms, by term: runs of the sorted array."""

    def starts_of(ordered: Column) -> Column:
        # A run starts where a term differs from the one before it.
        places = F.sequence(F.lit(0), F.size(ordered) - 1)
        return F.filter(places, lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1)))

    def runs(ordered: Column, starts: Column) -> Column:
        ends = F.concat(F.slice(starts, F.lit(2), F.size(starts)), F.array(F.size(ordered)))
        return F.zip_with(
            starts,
            ends,
            lambda a, b: F.struct(F.get(ordered, a).alias("term"), (b - a).cast("bigint").alias("tf")),
        )

    counted = _bound(F.sort_array(terms), lambda s: _bound(starts_of(s), lambda at: runs(s, at)))
    return F.when(F.size(terms) > 0, counted)


def term_counts(
    df: DataFrame,
    text: str = "classical_text",
    stop_words: Iterable[str] | None = None,
    bigrams: bool = True,
    key: str = "review_id",
) -> DataFrame:
    """(key, term, tf): terms are counted inside their row, so nothing is dealt."""
    stops = X.topic_stop_words() if stop_words is None else stop_words
    listed = df.select(key, term_list(F.col(text), stops, bigrams).alias("__terms"))
    return listed.select(key, F.inline(term_frequencies(F.col("__terms"))))


def vocabulary(
    counts: DataFrame,
    n_docs: int,
    max_features: int = S.TOPIC_VOCABULARY["max_features"],
    min_df: int = S.TOPIC_VOCABULARY["min_df"],
    max_df: float = S.TOPIC_VOCABULARY["max_df"],
) -> DataFrame:
    """Terms within the document-frequency bounds, most frequent first.

    The cap on the vocabulary is part of the operator; ties are by term.
    """
    frequencies = counts.groupBy("term").agg(
        F.count(F.lit(1)).alias("doc_count"), F.sum("tf").alias("total_count")
    )
    return (
        frequencies.where((F.col("doc_count") >= min_df) & (F.col("doc_count") <= max_df * n_docs))
        .orderBy(F.desc("total_count"), F.asc("term"))
        .limit(max_features)
    )


def tfidf(counts: DataFrame, vocab: DataFrame, n_docs: int, key: str = "review_id") -> DataFrame:
    """(key, term, weight): sublinear tf, smooth idf, unit length per review."""
    idf = F.ln((1.0 + n_docs) / (F.col("doc_count") + 1)) + 1
    known = stored(vocab.select("term", "doc_count"), "vocabulary")
    weighted = counts.join(known, "term").select(
        key, "term", ((F.ln("tf") + 1) * idf).alias("raw")
    )
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(key)))
    return weighted.select(key, "term", (F.col("raw") / norm).alias("weight"))


@dataclass
class TermWeights:
    """A fitted vocabulary: terms in index order with their idf."""

    terms: list[str]
    idf: np.ndarray
    stop_words: list[str] = field(default_factory=list)
    bigrams: bool = True

    def table(self, spark) -> DataFrame:
        rows = [(i, t, float(w)) for i, (t, w) in enumerate(zip(self.terms, self.idf))]
        return spark.createDataFrame(rows, "idx int, term string, idf double")


def fit_terms(
    df: DataFrame,
    text: str = "classical_text",
    stop_words: Iterable[str] | None = None,
    bigrams: bool = True,
    key: str = "review_id",
    **bounds,
) -> TermWeights:
    """Fit the vocabulary; at most ``max_features`` rows come to the driver."""
    stops = X.topic_stop_words() if stop_words is None else list(stop_words)
    n_docs = df.count()
    if n_docs == 0:
        raise ValueError("no texts to fit a vocabulary on")
    rows = vocabulary(term_counts(df, text, stops, bigrams, key), n_docs, **bounds).collect()
    if not rows:
        raise ValueError("no term is within the document-frequency bounds")
    counts = np.array([r["doc_count"] for r in rows], dtype=float)
    return TermWeights(
        [r["term"] for r in rows], np.log((1.0 + n_docs) / (1.0 + counts)) + 1.0, stops, bigrams
    )


def _counter(spark, terms: list[str]) -> CountVectorizerModel:
    """CountVectorizerModel over a given vocabulary.

    ``from_vocabulary`` copies the terms to the JVM one call each; splitting one
    joined string there takes a single call.  Terms never contain line breaks.
    """
    line_break = spark.sparkContext._jvm.java.util.regex.Pattern.compile("\n")
    model = CountVectorizerModel._create_from_java_class(
        "org.apache.spark.ml.feature.CountVectorizerModel", line_break.split("\n".join(terms))
    )
    return model._set(inputCol="__terms", outputCol="__tf", vocabSize=len(terms))


SPARSE = "indices array<int>, values array<double>"


def counted_terms(
    df: DataFrame, weights: TermWeights, text: str = "classical_text", output: str = "counts"
) -> DataFrame:
    """Sparse counts of the vocabulary's terms per row, by a JVM transformer.

    Terms outside the vocabulary drop out.
    """
    counter = _counter(df.sparkSession, weights.terms)
    listed = df.withColumn(
        "__terms", term_list(F.coalesce(text, F.lit("")), weights.stop_words, weights.bigrams)
    )
    return counter.transform(listed).withColumn(output, F.unwrap_udt("__tf")).drop("__terms", "__tf")


def unit_weights(cols: np.ndarray, tf: np.ndarray, rows: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Sublinear tf times idf of the entries of some whole rows, at unit length per row."""
    raw = (1.0 + np.log(tf)) * idf[cols]
    norms = np.sqrt(np.bincount(rows, weights=raw * raw))
    return raw / norms[rows]


def vectorise(
    df: DataFrame, weights: TermWeights, text: str = "classical_text", output: str = "features"
) -> DataFrame:
    """Sparse TF-IDF per row as struct(indices, values), without a shuffle.

    One Arrow UDF applies the weights to the counts.
    """
    idf = df.sparkSession.sparkContext.broadcast(weights.idf)

    @F.arrow_udf(SPARSE)
    def weigh(indices: pa.Array, counts: pa.Array) -> pa.Array:
        cols, tf, ends = flat_lists(indices, counts)
        unit = np.empty(len(cols))
        for first, last, rows in row_slices(ends):
            unit[first:last] = unit_weights(cols[first:last], tf[first:last], rows, idf.value)
        return pa.StructArray.from_arrays(
            [lists_of(cols, ends), lists_of(unit, ends)], names=["indices", "values"]
        )

    counted = counted_terms(df, weights, text, "__s")
    return counted.withColumn(output, weigh("__s.indices", "__s.values")).drop("__s")


def as_vector(df: DataFrame, size: int, features: str = "features") -> DataFrame:
    """The same column as an ML vector, for estimators."""

    @F.arrow_udf(VectorUDT())
    def wrap(indices: pa.Array, values: pa.Array) -> pa.Array:
        n = len(indices)
        kind, length = pa.array(np.zeros(n, np.int8)), pa.array(np.full(n, size, np.int32))
        return pa.StructArray.from_arrays(
            [kind, length, indices, values], names=["type", "size", "indices", "values"]
        )

    return df.withColumn(features, wrap(f"{features}.indices", f"{features}.values"))
