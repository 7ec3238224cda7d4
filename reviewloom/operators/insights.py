"""Topic insights over clustered, labelled reviews.

One pass over the reviews gives ``topic_base`` (one row per topic); every count,
share, rate, summary and overview below is derived from that small table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewloom import settings as S
from reviewloom.functions.numbers import fixed, percent, ratio, thousands
from reviewloom.functions.text import strip
from reviewloom.plans.shapes import (
    col,
    first_present,
    literal_rows,
    require_columns,
    stored,
)


def _all_rows() -> Window:
    """Window over a table that has one row per topic or label."""
    return Window.partitionBy(F.lit(1))


# --- normalisation and checks ----------------------------------------------


def sentiment_alias(value: Column) -> Column:
    """Trimmed lowercase label; model ids map to their label."""
    label = F.lower(strip(value.cast("string")))
    pairs = F.create_map(*[F.lit(x) for pair in S.SENTIMENT_ALIASES.items() for x in pair])
    return F.coalesce(pairs[label], label)


def resolve_sentiment_column(columns: Sequence[str], preferred: str = "predicted_sentiment") -> str:
    name = first_present(columns, (preferred, *S.SENTIMENT_COLUMN_CANDIDATES))
    if name is None:
        raise ValueError(f"no sentiment column; expected one of {S.SENTIMENT_COLUMN_CANDIDATES}")
    return name


def normalise_reviews(
    df: DataFrame,
    text: str = "review_text",
    cluster: str = "cluster_id",
    topic: str = "topic_name",
    sentiment: str = "predicted_sentiment",
) -> DataFrame:
    """Trimmed text, integer cluster (a bad one fails the job), named topic, known label."""
    require_columns(df, [text, cluster, topic], "clustered reviews")
    found = resolve_sentiment_column(df.columns, sentiment)
    if found != sentiment:
        df = df.withColumnRenamed(found, sentiment)
    blank_to_null = F.nullif(strip(F.col(topic)), F.lit(""))
    return df.withColumns(
        {
            text: strip(F.coalesce(text, F.lit(""))),
            cluster: F.col(cluster).cast("double").cast("int"),
            topic: F.coalesce(blank_to_null, F.lit(S.UNCATEGORISED)),
            sentiment: sentiment_alias(F.col(sentiment)),
        }
    )


def insight_violations(df: DataFrame, sentiment: str = "predicted_sentiment") -> DataFrame:
    """Broken rules of the clustered table: empty, no usable text, unknown labels."""
    require_columns(df, (*S.INSIGHT_REQUIRED_COLUMNS, sentiment), "clustered reviews")
    known = F.coalesce(F.col(sentiment).isin(*S.SENTIMENT_LABELS), F.lit(False))
    rows = F.count(F.lit(1))
    usable = F.count_if(F.length("review_text") > 0)
    return df.agg(
        F.when(rows == 0, 1).otherwise(0).cast("bigint").alias("empty_table"),
        F.when((rows > 0) & (usable == 0), 1).otherwise(0).cast("bigint").alias("no_usable_text"),
        F.count_if(~known).alias("unknown_label"),
    ).unpivot([], ["empty_table", "no_usable_text", "unknown_label"], "rule", "violations")


# --- aggregates --------------------------------------------------------------


def topic_base(
    df: DataFrame,
    cluster: str = "cluster_id",
    topic: str = "topic_name",
    sentiment: str = "predicted_sentiment",
    rating: str | None = "rating",
) -> DataFrame:
    """Counts per topic, the only aggregate that reads the reviews."""
    labels = [F.count_if(F.col(sentiment) == v).alias(v) for v in S.SENTIMENT_LABELS]
    if rating and rating in df.columns:
        number = F.expr(f"try_cast(`{rating}` as double)")
    else:
        number = F.lit(None).cast("double")
    return df.groupBy(F.col(cluster).alias("cluster_id"), F.col(topic).alias("topic_name")).agg(
        F.count(F.lit(1)).alias("review_count"),
        *labels,
        F.sum(number).alias("rating_sum"),
        F.count(number).alias("rating_count"),
    )


def topics(base: DataFrame) -> DataFrame:
    """Topics with their count and share, largest first."""
    share = ratio(F.col("review_count"), F.sum("review_count").over(_all_rows()))
    return base.select(
        "cluster_id", "topic_name", "review_count", share.alias("review_share")
    ).orderBy(F.desc("review_count"), F.asc("cluster_id"))


def topic_sentiment(base: DataFrame) -> DataFrame:
    """Counts and rates of the three labels per topic, worst first."""
    known = sum((F.col(v) for v in S.SENTIMENT_LABELS), F.lit(0))
    return (
        base.select("cluster_id", "topic_name", *S.SENTIMENT_LABELS, known.cast("bigint").alias("review_count"))
        .withColumns({f"{v}_rate": ratio(F.col(v), F.col("review_count")) for v in S.SENTIMENT_LABELS})
        .orderBy(F.desc("negative_rate"), F.desc("review_count"), F.asc("cluster_id"))
    )


def _is_topic(topic: int | str, cluster: str, name: str) -> Column:
    return F.col(cluster) == topic if isinstance(topic, int) else F.col(name) == topic


def topic_reviews(
    df: DataFrame,
    topic: int | str,
    limit: int | None = None,
    cluster: str = "cluster_id",
    name: str = "topic_name",
) -> DataFrame:
    """Reviews of one topic by id or name; with a limit, the first by review_id."""
    if limit is not None and limit < 1:
        raise ValueError("limit must be at least 1")
    found = df.where(_is_topic(topic, cluster, name))
    return found if limit is None else found.orderBy("review_id").limit(limit)


def sentiment_distribution(
    df: DataFrame, topic: int | str | None = None, sentiment: str = "predicted_sentiment"
) -> DataFrame:
    """Count and share of each of the three labels, zero-filled."""
    chosen = df if topic is None else topic_reviews(df, topic)
    labels = literal_rows(df.sparkSession, [(v,) for v in S.SENTIMENT_LABELS], "sentiment string")
    counts = chosen.groupBy(F.col(sentiment).alias("sentiment")).agg(F.count(F.lit(1)).alias("n"))
    filled = labels.join(counts, "sentiment", "left").select(
        "sentiment", F.coalesce("n", F.lit(0)).cast("bigint").alias("review_count")
    )
    total = F.sum("review_count").over(_all_rows())
    return filled.withColumn("review_share", ratio(F.col("review_count"), total))


def representative_reviews(
    df: DataFrame,
    limit: int = 3,
    by_sentiment: bool = True,
    shortest_first: bool = False,
    text: str = "review_text",
    cluster: str = "cluster_id",
    sentiment: str = "predicted_sentiment",
) -> DataFrame:
    """Longest (or shortest) distinct texts per topic, or per topic and sentiment.

    Distinct texts are found on a digest and a length, so the shuffle carries a
    few bytes per review; only the chosen ids then fetch their text.
    """
    if limit < 1:
        raise ValueError("limit must be at least 1")
    groups = [cluster, sentiment] if by_sentiment else [cluster]
    trimmed = strip(col(text))
    distinct = (
        df.where(F.length(trimmed) > 0)
        .groupBy(*groups, F.unhex(F.sha2(trimmed, 256)).alias("digest"), F.length(trimmed).alias("size"))
        .agg(F.min("review_id").alias("review_id"))
    )
    by_size = F.asc("size") if shortest_first else F.desc("size")
    order = Window.partitionBy(*groups).orderBy(by_size, F.asc("review_id"))
    chosen = distinct.withColumn("position", F.row_number().over(order)).where(
        F.col("position") <= limit
    )
    chosen = stored(chosen.select("review_id", *groups, "position"))
    texts = df.select("review_id", trimmed.alias(text))
    return texts.join(chosen, "review_id").select(*groups, "position", "review_id", text)


def overview(base: DataFrame) -> DataFrame:
    """Totals, counts and rates per label and mean rating, from the topic table."""
    counts = {v: F.coalesce(F.sum(v), F.lit(0)).cast("bigint") for v in S.SENTIMENT_LABELS}
    known = sum(counts.values(), F.lit(0))
    return base.agg(
        F.coalesce(F.sum("review_count"), F.lit(0)).cast("bigint").alias("total_reviews"),
        F.count_distinct("cluster_id").alias("total_topics"),
        *[counts[v].alias(f"{v}_reviews") for v in S.SENTIMENT_LABELS],
        *[ratio(counts[v], known).alias(f"{v}_rate") for v in S.SENTIMENT_LABELS],
        F.try_divide(F.sum("rating_sum"), F.sum("rating_count")).alias("average_rating"),
    )


# --- wording -------------------------------------------------------------------


def dominant_sentiment(positive: Column, neutral: Column, negative: Column) -> Column:
    """Label with the highest rate; ties go positive, neutral, negative."""
    return (
        F.when((positive >= neutral) & (positive >= negative), "positive")
        .when(neutral >= negative, "neutral")
        .otherwise("negative")
    )


def sentiment_health(positive: Column, negative: Column) -> Column:
    strong = (positive >= S.STRONG_POSITIVE) & (negative < S.STRONG_MAX_NEGATIVE)
    return (
        F.when(negative >= S.CRITICAL_NEGATIVE, "critical")
        .when(negative >= S.ATTENTION_NEGATIVE, "needs_attention")
        .when(strong, "strong")
        .otherwise("mixed")
    )


def topic_narrative(
    name: Column, count: Column, share: Column, positive: Column, neutral: Column, negative: Column
) -> Column:
    """One sentence on size and one on sentiment."""
    pos, neu, neg = (fixed(percent(v)) for v in (positive, neutral, negative))
    # Fixed texts.
    insight = (
        F.when(
            negative >= S.CRITICAL_NEGATIVE,
            F.format_string(
                "Customer feedback is predominantly negative (%s%%), "
                "making this a high-priority improvement area.",
                neg,
            ),
        )
        .when(
            negative >= S.ATTENTION_NEGATIVE,
            F.format_string(
                "Negative feedback is material (%s%%) and should be "
                "reviewed alongside the positive experiences.",
                neg,
            ),
        )
        .when(
            positive >= S.STRONG_POSITIVE,
            F.format_string(
                "Customer feedback is strongly positive (%s%%), indicating a clear product strength.",
                pos,
            ),
        )
        .otherwise(
            F.format_string(
                "Feedback is mixed: %s%% positive, %s%% neutral, and %s%% negative.", pos, neu, neg
            )
        )
    )
    return F.format_string(
        "%s contains %s reviews, representing %s%% of the analysed dataset. %s",
        name,
        thousands(count),
        fixed(percent(share)),
        insight,
    )


# --- summaries -----------------------------------------------------------------


def topic_facts(base: DataFrame) -> DataFrame:
    """One flat summary row per topic: counts, rates, percents, health, narrative."""
    labels = ("positive", "neutral", "negative")
    known = sum((F.col(v) for v in labels), F.lit(0)).cast("bigint")
    total = F.sum("all_reviews").over(_all_rows())
    counted = (
        base.withColumnRenamed("review_count", "all_reviews")
        .withColumn("review_count", known)
        .withColumns({f"{v}_rate": ratio(F.col(v), known) for v in labels})
        .withColumn("share", ratio(F.col("review_count"), total))
    )
    pos, neu, neg = (F.col(f"{v}_rate") for v in labels)
    return counted.select(
        F.col("cluster_id").alias("topic_id"),
        "topic_name",
        "review_count",
        "all_reviews",
        "rating_sum",
        "rating_count",
        F.round("share", 4).alias("review_share"),
        percent(F.col("share")).alias("review_share_percent"),
        dominant_sentiment(pos, neu, neg).alias("dominant"),
        sentiment_health(pos, neg).alias("health"),
        *[F.col(v).alias(f"{v}_count") for v in labels],
        *[F.round(f"{v}_rate", 4).alias(f"{v}_rate") for v in labels],
        *[percent(F.col(f"{v}_rate")).alias(f"{v}_percent") for v in labels],
        topic_narrative(F.col("topic_name"), F.col("review_count"), F.col("share"), pos, neu, neg).alias(
            "summary"
        ),
    )


def volume_order() -> list[Column]:
    return [F.desc("all_reviews"), F.asc("topic_id")]


def topic_summaries(df: DataFrame, base: DataFrame | None = None, limit: int = 3) -> DataFrame:
    """Nested summary record per topic with its representative reviews, by volume."""
    base = topic_base(df) if base is None else base
    picked = representative_reviews(df, limit).where(
        F.col("predicted_sentiment").isin("positive", "negative")
    )

    def texts(label: str) -> Column:
        chosen = F.when(
            F.col("predicted_sentiment") == label, F.struct("position", "review_text")
        )
        return F.transform(F.array_sort(F.collect_list(chosen)), lambda x: x.review_text).alias(label)

    examples = picked.groupBy(F.col("cluster_id").alias("topic_id")).agg(
        F.struct(texts("positive"), texts("negative")).alias("representative_reviews")
    )
    empty = F.array().cast("array<string>")
    none = F.struct(empty.alias("positive"), empty.alias("negative"))
    facts = topic_facts(base).join(examples, "topic_id", "left")
    sentiment = F.struct(
        "dominant",
        "health",
        *[f"{v}_{k}" for k in ("count", "rate", "percent") for v in ("positive", "neutral", "negative")],
    )
    return facts.orderBy(*volume_order()).select(
        "topic_id",
        "topic_name",
        "review_count",
        "review_share",
        "review_share_percent",
        sentiment.alias("sentiment"),
        "summary",
        F.coalesce("representative_reviews", none).alias("representative_reviews"),
    )


def topic_summary(df: DataFrame, topic: int | str, limit: int = 3) -> DataFrame:
    """The summary of one topic; an unknown topic is an error."""
    if limit < 1:
        raise ValueError("limit must be at least 1")
    # Shares need all topics, one row each; texts are looked for in this topic alone.
    base = stored(topic_base(df), "topics")
    if base.where(_is_topic(topic, "cluster_id", "topic_name")).isEmpty():
        raise ValueError(f"topic {topic!r} was not found")
    own = topic_summaries(topic_reviews(df, topic), base=base, limit=limit)
    return own.where(_is_topic(topic, "topic_id", "topic_name"))


def overview_summary(base: DataFrame, brand: str = S.REPORT_BRAND) -> DataFrame:
    """Dataset summary: totals, percents, extreme topics, narrative, overall label."""
    facts = topic_facts(base)

    def top(metric: str, *fields: str) -> Column:
        # Ties go to the larger topic, then to the smaller id.
        key = F.struct(F.col(metric), F.col("all_reviews"), -F.col("topic_id"))
        return F.max_by(F.struct(*fields), key)

    counts = {v: F.coalesce(F.sum(f"{v}_count"), F.lit(0)).cast("bigint") for v in S.SENTIMENT_LABELS}
    known = sum(counts.values(), F.lit(0))
    both = facts.agg(
        F.coalesce(F.sum("all_reviews"), F.lit(0)).cast("bigint").alias("total_reviews"),
        F.count_distinct("topic_id").alias("total_topics"),
        *[counts[v].alias(f"{v}_reviews") for v in S.SENTIMENT_LABELS],
        *[ratio(counts[v], known).alias(f"{v}_rate") for v in S.SENTIMENT_LABELS],
        F.round(F.try_divide(F.sum("rating_sum"), F.sum("rating_count")), 2).alias("average_rating"),
        top("review_count", "topic_id", "topic_name", "review_count", "review_share_percent").alias(
            "largest_topic"
        ),
        top("negative_rate", "topic_id", "topic_name", "negative_percent").alias("most_negative_topic"),
        top("positive_rate", "topic_id", "topic_name", "positive_percent").alias("most_positive_topic"),
    )
    percents = {v: percent(F.col(f"{v}_rate")) for v in ("positive", "neutral", "negative")}
    # Fixed text.
    narrative = F.format_string(
        "%s analysed %s reviews across %s topics. Overall sentiment is %s%% positive, "
        "%s%% neutral, and %s%% negative. %s is the largest topic, while %s has the highest "
        "negative sentiment rate.",
        F.lit(brand),
        thousands(F.col("total_reviews")),
        F.col("total_topics").cast("string"),
        *[fixed(p) for p in percents.values()],
        F.col("largest_topic.topic_name"),
        F.col("most_negative_topic.topic_name"),
    )
    label = dominant_sentiment(F.col("positive_rate"), F.col("neutral_rate"), F.col("negative_rate"))
    return both.select(
        *both.columns,
        *[p.alias(f"{v}_percent") for v, p in percents.items()],
        *[p.alias(f"{v}_percentage") for v, p in percents.items()],
        narrative.alias("summary"),
        F.initcap(label).alias("overall_sentiment"),
    )


# --- topic hooks and shares ------------------------------------------------------


def sentiment_hooks(df: DataFrame, topic: str = "topic_name", sentiment: str = "predicted_sentiment") -> DataFrame:
    """Percentages per topic with a one-line angle, highest complaint rate first."""
    counts = df.groupBy(F.col(topic).alias("topic")).agg(
        *[F.count_if(F.col(sentiment) == v).alias(v) for v in S.SENTIMENT_LABELS]
    )
    total = sum((F.col(v) for v in S.SENTIMENT_LABELS), F.lit(0)).cast("bigint")
    shares = counts.select(
        "topic",
        total.alias("reviews"),
        *[
            F.round(F.try_divide(F.col(v), total) * 100, 2).alias(f"{v}_pct")
            for v in ("positive", "neutral", "negative")
        ],
    )
    worst = F.max("negative_pct").over(_all_rows())
    pos, neg = fixed(F.col("positive_pct"), 0), fixed(F.col("negative_pct"), 0)
    # Fixed texts.
    hook = (
        F.when(
            (F.col("negative_pct") == worst) & (worst > 0),
            F.format_string(
                "Highest complaint rate (%s%% negative) — lead the article with the recurring problems.",
                neg,
            ),
        )
        .when(
            F.col("positive_pct") >= S.HOOK_LIKED_PERCENT,
            F.format_string("Strongly liked (%s%% positive) — frame as a confident recommendation.", pos),
        )
        .otherwise(
            F.format_string(
                "Mixed reception (%s%% positive / %s%% negative) — contrast best vs worst picks.", pos, neg
            )
        )
    )
    return shares.withColumn("hook", hook).orderBy(F.desc("negative_pct"), F.asc("topic"))


def topic_sentiment_shares(df: DataFrame, topic: str = "topic_name", sentiment: str = "sentiment_label") -> DataFrame:
    """Count, topic total and percentage per (topic, sentiment)."""
    require_columns(df, [topic, sentiment])
    counts = df.groupBy(topic, sentiment).agg(F.count(F.lit(1)).alias("review_count"))
    total = F.sum("review_count").over(Window.partitionBy(topic))
    return (
        counts.withColumn("topic_review_count", total)
        .withColumn(
            "sentiment_percentage",
            F.round(F.col("review_count") / F.col("topic_review_count") * 100, 2),
        )
        .orderBy(F.asc(topic), F.desc("review_count"), F.asc(sentiment))
    )
