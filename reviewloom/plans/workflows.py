"""The three end-to-end jobs: prepare reviews, discover topics, export insights."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom import settings as S
from reviewloom.operators import features, insights, labeling, recommendations, reports, topics
from reviewloom.operators.cleaning import clean_dataset
from reviewloom.plans.shapes import stored
from reviewloom.sources import files

ARTIFACTS = {
    "dashboard": "dashboard.json",
    "topics": "topics.json",
    "recommendations": "recommendations.json",
    "report_json": "report.json",
    "report_markdown": "report.md",
}


def prepare_reviews(tables: Iterable[DataFrame]) -> DataFrame:
    """Raw tables to cleaned reviews with both text branches, one lazy plan."""
    return files.merge_datasets(tables).transform(clean_dataset).transform(features.model_text_features)


def discover_topics(reviews: DataFrame, n_clusters: int = S.N_CLUSTERS, **fit_options):
    """(model with names, reviews with cluster and topic name, top terms, representatives)."""
    usable = reviews.transform(features.drop_low_content)
    model, assigned = topics.fit_topic_model(usable, n_clusters, **fit_options)
    terms = stored(topics.top_terms(assigned, model.terms))
    named = labeling.suggest_topic_names(labeling.terms_list(terms))
    model.topic_names = {r["cluster_id"]: r["topic_name"] for r in named.collect()}  # k rows
    placed = stored(assigned.select("review_id", "cluster_id", "distance_to_centroid"))
    labelled = topics.add_topic_labels(usable.join(placed, "review_id"), model.topic_names)
    nearest = topics.nearest_to_centroid(
        labelled.select("review_id", "cluster_id", "review_text", "distance_to_centroid")
    )
    return model, labelled, terms, nearest


def export_all(reviews: DataFrame, root: str, generated_at: str, brand: str = S.REPORT_BRAND) -> DataFrame:
    """Write every artifact below ``root``; returns (artifact, path).

    The reviews are read once for the counts and once for the example texts; all
    five artifacts are built from those two small tables.
    """
    base = stored(insights.topic_base(reviews))
    summaries = stored(insights.topic_summaries(reviews, base=base))
    facts = stored(insights.topic_facts(base))
    ranked = stored(recommendations.ranked(recommendations.metrics_from_base(base)))
    overview = stored(insights.overview_summary(base, brand))
    payload = recommendations.payload(ranked)
    parts = (
        overview.select(F.struct("*").alias("overview")),
        _topic_list(summaries),
        payload.select(F.struct("*").alias("recommendations")),
    )
    report_inputs = (summaries, facts, ranked, overview, generated_at, brand)
    paths = {name: f"{root.rstrip('/')}/{relative}" for name, relative in ARTIFACTS.items()}
    files.write_json(reports.side_by_side(*parts), paths["dashboard"])
    files.write_json(summaries, paths["topics"])
    files.write_json(payload, paths["recommendations"])
    files.write_json(reports.report_payload(*report_inputs), paths["report_json"])
    files.write_report(reports.report_lines(*report_inputs), paths["report_markdown"])
    return reviews.sparkSession.createDataFrame(list(paths.items()), "artifact string, path string")


def _topic_list(summaries: DataFrame) -> DataFrame:
    keyed = summaries.select(
        F.struct((-F.col("review_count")).alias("a"), F.col("topic_id").alias("b")).alias("__k"),
        F.struct(*summaries.columns).alias("__v"),
    )
    return keyed.agg(recommendations.ordered_list("__k", F.col("__v")).alias("topics"))


def ensure_artifacts(reviews: DataFrame, root: str, generated_at: str) -> DataFrame:
    """Export only when an artifact is missing; returns the status table."""
    spark = reviews.sparkSession
    status = files.artifact_status(spark, root, ARTIFACTS)
    if not files.artifacts_available(status).first()[0]:
        export_all(reviews, root, generated_at)
        status = files.artifact_status(spark, root, ARTIFACTS)
    return status
