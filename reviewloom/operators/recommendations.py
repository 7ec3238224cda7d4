"""Ranked business recommendations from topic metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewloom import settings as S
from reviewloom.functions.numbers import ratio
from reviewloom.plans.shapes import col, first_present, literal_rows


def topic_metrics(topics: DataFrame, sentiment: DataFrame) -> DataFrame:
    """(topic_id, topic, topic_size, positive_ratio, negative_ratio) from two tables.

    Columns are found by candidate names.  A ratio column whose maximum exceeds 1
    is read as a percentage; values are then clipped to 0..1.
    """
    topic_id = first_present(topics.columns, S.TOPIC_ID_CANDIDATES)
    other_id = first_present(sentiment.columns, S.TOPIC_ID_CANDIDATES)
    if topic_id is None or other_id is None:
        raise ValueError(f"both tables need one of {S.TOPIC_ID_CANDIDATES}")
    name = first_present(topics.columns, S.TOPIC_NAME_CANDIDATES)
    size = first_present(topics.columns, S.TOPIC_SIZE_CANDIDATES)
    sources = {
        "positive_ratio": first_present(sentiment.columns, S.POSITIVE_CANDIDATES),
        "negative_ratio": first_present(sentiment.columns, S.NEGATIVE_CANDIDATES),
    }

    def number(column: str | None, kind: str) -> Column:
        if column is None:
            return F.lit(0).cast(kind)
        return F.coalesce(F.expr(f"try_cast(`{column}` as {kind})"), F.lit(0).cast(kind))

    left = topics.select(
        col(topic_id).alias("topic_id"),
        (F.concat(F.lit("Topic "), col(topic_id).cast("string")) if name is None else col(name).cast("string")).alias("topic"),
        number(size, "double").cast("bigint").alias("topic_size"),
    )
    right = sentiment.select(
        col(other_id).alias("topic_id"),
        *[number(source, "double").alias(target) for target, source in sources.items()],
    )
    joined = left.join(right, "topic_id", "left").fillna(0.0, list(sources))
    whole = Window.partitionBy(F.lit(1))
    # One row per topic, so the whole-table window is small.
    scaled = {
        n: F.greatest(
            F.lit(0.0),
            F.least(F.lit(1.0), F.when(F.max(n).over(whole) > 1, F.col(n) / 100).otherwise(F.col(n))),
        )
        for n in sources
    }
    return joined.withColumns(scaled)


def metrics_from_base(base: DataFrame) -> DataFrame:
    """Topic metrics straight from the per-topic counts."""
    known = sum((F.col(v) for v in S.SENTIMENT_LABELS), F.lit(0))
    rated = base.select(
        "cluster_id",
        "topic_name",
        "review_count",
        ratio(F.col("positive"), known).alias("positive_ratio"),
        ratio(F.col("negative"), known).alias("negative_ratio"),
    )
    return rated.select(
        F.col("cluster_id").alias("topic_id"),
        F.col("topic_name").alias("topic"),
        F.col("review_count").alias("topic_size"),
        "positive_ratio",
        "negative_ratio",
    )


def priority(negative: Column) -> Column:
    return (
        F.when(negative >= S.HIGH_PRIORITY_NEGATIVE, "High")
        .when(negative >= S.MEDIUM_PRIORITY_NEGATIVE, "Medium")
        .otherwise("Low")
    )


def severity(size: Column, negative: Column) -> Column:
    return F.round(size * F.lit(0.4) + negative * F.lit(100.0) * F.lit(0.6), 1)


def template(topic: Column, negative: Column) -> Column:
    """struct(recommendation, rationale): positive text, first keyword match, or fallback."""

    def pair(action: str, rationale: str) -> Column:
        return F.struct(F.lit(action).alias("recommendation"), F.lit(rationale).alias("rationale"))

    chosen = F.when(negative < S.POSITIVE_TEMPLATE_NEGATIVE, pair(*S.POSITIVE_TEMPLATE))
    for keyword, action, rationale in S.ACTION_TEMPLATES:
        chosen = chosen.when(
            F.contains(F.lower(topic), F.lit(keyword.lower())), pair(action, rationale)
        )
    return chosen.otherwise(pair(*S.FALLBACK_TEMPLATE))


def build(metrics: DataFrame) -> DataFrame:
    """Recommendation columns for every row of topic metrics."""
    negative = F.col("negative_ratio")
    return metrics.withColumn("__t", template(F.col("topic"), negative)).select(
        "topic_id",
        "topic",
        "topic_size",
        priority(negative).alias("priority"),
        severity(F.col("topic_size"), negative).alias("severity"),
        F.col("__t.recommendation").alias("recommendation"),
        F.col("__t.rationale").alias("rationale"),
        F.round("positive_ratio", 2).alias("positive_ratio"),
        F.round("negative_ratio", 2).alias("negative_ratio"),
    )


def ranked(metrics: DataFrame) -> DataFrame:
    """All recommendations with their rank, most severe first."""
    order = Window.partitionBy(F.lit(1)).orderBy(
        F.desc("severity"), F.desc("negative_ratio"), F.desc("topic_size"), F.asc("topic_id")
    )
    return build(metrics).withColumn("rank", F.row_number().over(order))


def for_topic(recommendations: DataFrame, topic_id: int) -> DataFrame:
    """One topic's recommendation; an unknown topic is an error."""
    found = recommendations.where(F.col("topic_id") == topic_id)
    if found.isEmpty():
        raise ValueError(f"no topic with topic_id={topic_id}")
    return found


def priority_counts(recommendations: DataFrame) -> DataFrame:
    """Recommendations per priority, High / Medium / Low always present."""
    fixed = literal_rows(
        recommendations.sparkSession, [(p,) for p in S.PRIORITIES], "priority string"
    )
    counts = recommendations.groupBy(F.coalesce("priority", F.lit("Low")).alias("priority")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return fixed.join(counts, "priority", "full").select(
        "priority", F.coalesce("n", F.lit(0)).cast("bigint").alias("recommendations")
    )


def top(recommendations: DataFrame, limit: int = 3) -> DataFrame:
    return recommendations.where(F.col("rank") <= max(limit, 0))


def _card(row: Column) -> list[Column]:
    """Aggregates of the dashboard card; ``row`` is the struct of the riskiest topic."""
    counts = [
        F.count_if(F.col("priority") == p).alias(f"{p.lower()}_priority") for p in S.PRIORITIES
    ]
    return [
        F.count(F.lit(1)).alias("total_recommendations"),
        *counts,
        F.coalesce(F.round(F.avg("severity"), 1), F.lit(0.0)).alias("average_severity"),
        F.max_by(row, F.struct("severity", -F.col("rank"))).alias("highest_risk_topic"),
    ]


def summary(recommendations: DataFrame) -> DataFrame:
    """Dashboard card numbers; zeros and NULL topic when there is nothing."""
    return recommendations.agg(*_card(F.struct("topic_id", "topic", "severity", "priority")))


def ordered_list(order: str, value: Column) -> Column:
    """Aggregate: ``value`` of all rows of a per-topic table, ordered by a column."""
    gathered = F.array_sort(F.collect_list(F.struct(F.col(order).alias("k"), value.alias("v"))))
    return F.transform(gathered, lambda x: x.v)


def payload(recommendations: DataFrame, top_limit: int = 3) -> DataFrame:
    """One row: summary, top recommendations, all recommendations."""
    rows = ordered_list("rank", F.struct(*recommendations.columns))
    card = F.struct(*_card(F.struct("topic_id", "topic", "severity", "priority")))
    return recommendations.agg(card.alias("summary"), rows.alias("recommendations")).select(
        "summary",
        F.slice("recommendations", 1, max(top_limit, 0)).alias("top_recommendations"),
        "recommendations",
    )
