"""Sentiment model: split, class weights, training, scoring and enrichment."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewloom import settings as S
from reviewloom.functions.blocks import (
    fit_partitions,
    flat_lists,
    lists_of,
    row_slices,
    size_of,
    sum_by,
)
from reviewloom.functions.vectors import argmax, softmax
from reviewloom.operators.vectorize import (
    TermWeights,
    as_vector,
    counted_terms,
    fit_terms,
    unit_weights,
    vectorise,
)
from reviewloom.plans.shapes import literal_rows, require_columns, split_by_hash


def stratified_split(
    df: DataFrame,
    label: str = "sentiment_label",
    test_size: float = 0.20,
    validation_size: float = 0.20,
    seed: int = S.RANDOM_SEED,
    key: str = "review_id",
) -> DataFrame:
    """Adds ``split``: test and validation get exact per-label quotas, train the rest.

    ``validation_size`` is a share of what the test split leaves.
    """
    if not (0 < test_size < 1 and 0 < validation_size < 1):
        raise ValueError("test_size and validation_size must be between 0 and 1")

    def cuts(total: Column):
        test = F.floor(total * test_size + 0.5)
        validation = F.floor((total - test) * validation_size + 0.5)
        return [("test", test), ("validation", test + validation)]

    return split_by_hash(df, label, cuts, "train", seed, key)


def split_summary(split: DataFrame, label: str = "sentiment_label") -> DataFrame:
    """Percentage of each label inside each split."""
    counts = split.groupBy(label).agg(
        *[F.count_if(F.col("split") == s).alias(s) for s in ("train", "validation", "test")]
    )
    whole = Window.partitionBy(F.lit(1))
    return counts.select(
        label,
        *[
            F.round(F.try_divide(F.col(s), F.sum(s).over(whole)) * 100, 2).alias(s)
            for s in ("train", "validation", "test")
        ],
    )


def class_weights(df: DataFrame, label: str = "sentiment_label") -> DataFrame:
    """Balanced weight n / (classes x count) per label (one row per label)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("row_count"))
    whole = Window.partitionBy(F.lit(1))
    weight = F.sum("row_count").over(whole) / (F.count(F.lit(1)).over(whole) * F.col("row_count"))
    return counts.withColumn("weight", weight)


@dataclass
class SentimentModel:
    """Vocabulary and classifier with the labels in class order."""

    terms: TermWeights
    classifier: LogisticRegressionModel
    labels: list[str]


def train_classifier(
    df: DataFrame,
    text: str = "classical_text",
    label: str = "sentiment_label",
    key: str = "review_id",
    c: float = 1.0,
    max_iter: int = 1000,
    tol: float = 1e-4,
    balanced: bool = True,
    **bounds,
) -> SentimentModel:
    """TF-IDF (words and pairs) with a multinomial logistic regression, L2 strength 1/C."""
    require_columns(df, [key, text, label], "training table")
    bounds = {**S.CLASSIFIER_VOCABULARY, **bounds}
    texts = df.select(key, text, label).persist(StorageLevel.MEMORY_AND_DISK)
    terms = fit_terms(texts, text, stop_words=(), key=key, **bounds)
    weights = {r[label]: r["weight"] for r in class_weights(texts, label).collect()}
    labels = sorted(weights)
    position = F.create_map(*[F.lit(x) for i, v in enumerate(labels) for x in (v, float(i))])
    weight = F.create_map(*[F.lit(x) for v in labels for x in (v, float(weights[v] if balanced else 1.0))])
    rows = vectorise(texts, terms, text).select(
        "features", position[F.col(label)].alias("label"), weight[F.col(label)].alias("weight")
    )
    entries = F.size("features.indices")
    rows = rows.withColumn("entries", entries).persist(StorageLevel.MEMORY_AND_DISK)
    total = rows.agg(F.sum("weight")).first()[0]
    # The iterations keep blocks of their own, so what they do not read is dropped at once.
    texts.unpersist()
    _, n_parts, n_entries = size_of(rows, F.col("entries"))
    # Every iteration returns a gradient per partition, so small data uses few.
    sized, _ = fit_partitions(rows, n_parts, n_entries, 1e6)
    sized = as_vector(sized, len(terms.terms)).select("label", "weight", "features").persist()
    sized.count()
    rows.unpersist()
    classifier = LogisticRegression(
        family="multinomial",
        weightCol="weight",
        regParam=1.0 / (c * total),
        elasticNetParam=0.0,
        standardization=False,
        maxIter=max_iter,
        tol=tol,
    ).fit(sized)
    sized.unpersist()
    return SentimentModel(terms, classifier, labels)


def top_features(spark, model: SentimentModel, top_n: int = 20) -> DataFrame:
    """(sentiment_class, rank, feature, coefficient), strongest first per class."""
    if top_n < 1:
        raise ValueError("top_n must be at least 1")
    matrix = model.classifier.coefficientMatrix.toArray()
    if len(model.labels) == 2 and len(matrix) == 1:
        matrix = np.vstack([-matrix[0], matrix[0]])
    rows = []
    for name, weights in zip(model.labels, matrix):
        best = sorted(range(len(weights)), key=lambda i: (-weights[i], model.terms.terms[i]))[:top_n]
        rows += [(name, r, model.terms.terms[i], float(weights[i])) for r, i in enumerate(best, 1)]
    return spark.createDataFrame(
        rows, "sentiment_class string, rank int, feature string, coefficient double"
    )


# --- scoring ----------------------------------------------------------------------


def _with_scores(df: DataFrame, probabilities: Column, labels: Iterable[str]) -> DataFrame:
    labels = list(labels)
    scored = df.withColumn("__p", probabilities)
    return scored.withColumns(
        {
            "predicted_sentiment": F.element_at(F.array(*[F.lit(v) for v in labels]), argmax(F.col("__p")) + 1),
            **{f"probability_{v}": F.get("__p", F.lit(i)) for i, v in enumerate(labels)},
            "sentiment_confidence": F.array_max("__p"),
        }
    ).drop("__p")


def predict(df: DataFrame, model: SentimentModel, text: str = "classical_text") -> DataFrame:
    """Label, probability per class and confidence, from coefficients shared with the tasks.

    NULL text scores as empty.  Rows are never moved, and weights and scores are one step in
    Python: vectors that went back to Spark would come to a second worker of the task.
    """
    matrix = model.classifier.coefficientMatrix.toArray()
    intercepts = np.asarray(model.classifier.interceptVector)
    shared = df.sparkSession.sparkContext.broadcast((matrix, intercepts, model.terms.idf))

    @F.arrow_udf("array<double>")
    def logits(indices: pa.Array, counts: pa.Array) -> pa.Array:
        weights, intercept, idf = shared.value
        cols, tf, ends = flat_lists(indices, counts)
        sums = np.zeros((len(ends), len(intercept)))
        done = 0
        for first, last, rows in row_slices(ends):
            here = int(np.searchsorted(ends, last, side="right"))
            at = cols[first:last]
            products = unit_weights(at, tf[first:last], rows, idf)[:, None] * weights.T[at]
            sums[done:here] = sum_by(rows, products, here - done)
            done = here
        return lists_of((sums + intercept).ravel(), len(intercept) * np.arange(1, len(sums) + 1))

    counted = counted_terms(df, model.terms, text, "__counts")
    scored = counted.withColumn("__logits", logits("__counts.indices", "__counts.values"))
    return _with_scores(scored, softmax(F.col("__logits")), model.labels).drop("__counts", "__logits")


def predict_with(df: DataFrame, load: Callable[[], Callable], text: str, key: str = "review_id") -> DataFrame:
    """Score with any predictor: ``load()`` runs once per task and returns a function
    from a list of texts to an (n x 3) array of logits in label order."""

    def run(batches):
        score = load()
        for batch in batches:
            values = score(batch[text].fillna("").tolist())
            yield pd.DataFrame({key: batch[key], "logits": list(np.asarray(values, dtype=float))})

    kind = dict(df.dtypes)[key]
    scores = df.select(key, text).mapInPandas(run, f"{key} {kind}, logits array<double>")
    return _with_scores(scores, softmax(F.col("logits")), S.SENTIMENT_LABELS).drop("logits")


def from_logits(df: DataFrame, logits: str = "logits", labels: Iterable[str] = S.SENTIMENT_LABELS) -> DataFrame:
    """Label and probabilities from raw model outputs; the first label wins a tie."""
    return _with_scores(df, softmax(F.col(logits)), labels)


def prediction_record(df: DataFrame, labels: Iterable[str] = S.SENTIMENT_LABELS) -> DataFrame:
    """(label, confidence, probabilities) record per scored row."""
    labels = list(labels)
    missing = F.lit(0.0)
    values = [
        F.coalesce(F.col(f"probability_{v}"), missing) if f"probability_{v}" in df.columns else missing
        for v in labels
    ]
    return df.select(
        *[c for c in df.columns if c == "review_id"],
        F.col("predicted_sentiment").alias("label"),
        F.col("sentiment_confidence").alias("confidence"),
        F.map_from_arrays(F.array(*[F.lit(v) for v in labels]), F.array(*values)).alias("probabilities"),
    )


def predict_one(spark, model: SentimentModel, text: str) -> DataFrame:
    """The record of one text, as a one-row table."""
    row = literal_rows(spark, [(0, text)], "review_id bigint, classical_text string")
    return prediction_record(predict(row, model), S.SENTIMENT_LABELS)


def enrich_reviews(df: DataFrame, model: SentimentModel, text: str = "classical_text", path: str | None = None) -> DataFrame:
    """All columns plus predictions; written to ``path`` as Parquet when given."""
    require_columns(df, [text], "reviews")
    enriched = predict(df, model, text)
    if path is not None:
        enriched.write.mode("overwrite").parquet(path)
    return enriched


# --- persistence ------------------------------------------------------------------


def save_model(spark, model: SentimentModel, path: str) -> None:
    model.classifier.write().overwrite().save(f"{path}/classifier")
    model.terms.table(spark).write.mode("overwrite").parquet(f"{path}/vocabulary")
    labels = [(i, v) for i, v in enumerate(model.labels)]
    spark.createDataFrame(labels, "idx int, label string").write.mode("overwrite").parquet(f"{path}/labels")


def load_model(spark, path: str) -> SentimentModel:
    rows = spark.read.parquet(f"{path}/vocabulary").orderBy("idx").collect()
    labels = [r["label"] for r in spark.read.parquet(f"{path}/labels").orderBy("idx").collect()]
    terms = TermWeights([r["term"] for r in rows], np.array([r["idf"] for r in rows]))
    return SentimentModel(terms, LogisticRegressionModel.load(f"{path}/classifier"), labels)


def load_selected(spark, record_path: str) -> SentimentModel:
    """The model a selection record (JSON) points to."""
    record = spark.read.json(record_path).select("artifact_path").first()
    return load_model(spark, record["artifact_path"])


def probabilities_of(model: SentimentModel, vectors: DataFrame) -> DataFrame:
    """The library model's own probabilities, to check ``predict`` against."""
    scored = model.classifier.transform(as_vector(vectors, len(model.terms.terms)))
    return scored.withColumn("probabilities", vector_to_array("probability"))
