"""Saving and loading a fitted topic model as plain tables."""

from __future__ import annotations

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from reviewloom.operators.topics import TopicModel
from reviewloom.operators.vectorize import TermWeights

PARTS = ("vocabulary", "stop_words", "components", "centroids", "metadata")


def metadata(spark: SparkSession, model: TopicModel) -> DataFrame:
    row = (
        model.n_clusters,
        model.components.shape[1],
        model.explained_variance_ratio,
        model.inertia,
        model.silhouette,
        model.seed,
        model.terms.bigrams,
    )
    return spark.createDataFrame(
        [row],
        "n_clusters int, svd_components int, svd_explained_variance_ratio double, inertia double, "
        "silhouette_score double, random_state int, bigrams boolean",
    )


def save_topic_model(spark: SparkSession, model: TopicModel, path: str) -> str:
    """Only the fitted parts: their size depends on vocabulary, rank and k, not on the reviews."""
    tables = {
        "vocabulary": model.terms.table(spark),
        "stop_words": spark.createDataFrame([(w,) for w in model.terms.stop_words], "word string"),
        "components": spark.createDataFrame(
            [(i, [float(x) for x in row]) for i, row in enumerate(model.components)],
            "idx int, loadings array<double>",
        ),
        "centroids": spark.createDataFrame(
            [(i, [float(x) for x in row]) for i, row in enumerate(model.centres)],
            "cluster_id int, centre array<double>",
        ),
        "metadata": metadata(spark, model),
    }
    if model.topic_names:
        tables["topic_names"] = spark.createDataFrame(
            [(int(k), v) for k, v in model.topic_names.items()], "cluster_id int, topic_name string"
        )
    for name, table in tables.items():
        table.coalesce(1).write.mode("overwrite").parquet(f"{path}/{name}")
    return path


def load_topic_model(spark: SparkSession, path: str) -> TopicModel:
    """Rebuild the model; missing parts are named in the error."""

    def read(name: str):
        try:
            return spark.read.parquet(f"{path}/{name}").collect()
        except AnalysisException:
            return None

    parts = {name: read(name) for name in PARTS}
    missing = sorted(name for name, rows in parts.items() if rows is None)
    if missing:
        raise ValueError(f"invalid topic model at {path}: missing {missing}")
    facts = parts["metadata"][0]
    vocabulary = sorted(parts["vocabulary"], key=lambda r: r["idx"])
    names = read("topic_names")
    return TopicModel(
        TermWeights(
            [r["term"] for r in vocabulary],
            np.array([r["idf"] for r in vocabulary]),
            [r["word"] for r in parts["stop_words"]],
            facts["bigrams"],
        ),
        np.array([r["loadings"] for r in sorted(parts["components"], key=lambda r: r["idx"])]),
        np.array([r["centre"] for r in sorted(parts["centroids"], key=lambda r: r["cluster_id"])]),
        facts["svd_explained_variance_ratio"],
        facts["inertia"],
        facts["silhouette_score"],
        facts["random_state"],
        {r["cluster_id"]: r["topic_name"] for r in names} if names else None,
    )
