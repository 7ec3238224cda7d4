"""Report sentences, report lines and the full report payload."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewloom import settings as S
from reviewloom.functions.numbers import fixed, format_percentage, thousands
from reviewloom.operators.recommendations import ordered_list
from reviewloom.plans.shapes import literal_rows


def executive_summary(overview: DataFrame, brand: str = S.REPORT_BRAND) -> DataFrame:
    """One sentence row from the overview summary."""
    # Fixed text.
    return overview.select(executive_sentence(brand).alias("executive_summary"))


def executive_sentence(brand: str) -> Column:
    return F.format_string(
        "%s analysed %s customer reviews covering %s major product topics. The overall customer "
        "sentiment is %s, with %s%% positive reviews and %s%% negative reviews. The dashboard "
        "highlights the most important product areas requiring business attention.",
        F.lit(brand),
        thousands(F.col("total_reviews")),
        F.col("total_topics").cast("string"),
        F.lower("overall_sentiment"),
        fixed(F.col("positive_percentage")),
        fixed(F.col("negative_percentage")),
    )


def key_findings(facts: DataFrame) -> DataFrame:
    """One finding per topic, in volume order (``facts`` = flat topic rows)."""
    return facts.select(
        volume_rank(),
        F.format_string(
            "%s contains %s reviews with %s%% positive sentiment.",
            "topic_name",
            thousands(F.col("review_count")),
            fixed(F.col("positive_percent")),
        ).alias("finding"),
    )


def volume_rank() -> Column:
    """Position of a topic by volume; the table has one row per topic."""
    order = Window.partitionBy(F.lit(1)).orderBy(F.desc("all_reviews"), F.asc("topic_id"))
    return F.row_number().over(order).alias("position")


def business_risks(recommendations: DataFrame) -> DataFrame:
    return recommendations.where(F.col("priority") == "High").select(
        F.col("rank").alias("position"), F.format_string("%s: %s", "topic", "recommendation").alias("risk")
    )


def business_opportunities(facts: DataFrame, minimum: float = S.OPPORTUNITY_POSITIVE) -> DataFrame:
    return (
        facts.select(volume_rank(), "topic_name", "positive_rate")
        .where(F.col("positive_rate") >= minimum)
        .select(
            "position",
            F.format_string(
                "Customers consistently report positive experiences with %s. This area can be "
                "highlighted in marketing and customer-success initiatives.",
                "topic_name",
            ).alias("opportunity"),
        )
    )


def report_metrics(facts: DataFrame, recommendations: DataFrame, generated_at: str, base_overview: DataFrame) -> DataFrame:
    """Headline numbers of the report as one row."""
    counts = recommendations.agg(
        F.count(F.lit(1)).alias("recommendations"),
        F.count_if(F.col("priority") == "High").alias("high_priority"),
    )
    return side_by_side(
        base_overview.select(
            F.lit(generated_at).alias("generated_at"),
            F.col("total_reviews").alias("reviews"),
            F.col("total_topics").alias("topics"),
            *[F.col(f"{v}_percentage").alias(v) for v in ("positive", "negative", "neutral")],
        ),
        counts,
    )


def side_by_side(*one_row_tables: DataFrame) -> DataFrame:
    """Columns of several one-row tables in one row, by union and a global aggregate."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), one_row_tables)
    return stacked.agg(*[F.any_value(c, F.lit(True)).alias(c) for c in stacked.columns])


def report_payload(
    summaries: DataFrame,
    facts: DataFrame,
    recommendations: DataFrame,
    overview: DataFrame,
    generated_at: str,
    brand: str = S.REPORT_BRAND,
) -> DataFrame:
    """The whole report as one nested row."""
    metrics = report_metrics(facts, recommendations, generated_at, overview)

    def listed(df: DataFrame, order: str, value: Column, name: str) -> DataFrame:
        return df.agg(ordered_list(order, value).alias(name))

    topics = summaries.select(
        F.struct(-F.col("review_count"), F.col("topic_id")).alias("__k"), F.struct(*summaries.columns).alias("__v")
    )
    recs = F.struct(*recommendations.columns)
    return side_by_side(
        overview.select(executive_sentence(brand).alias("executive_summary"), F.struct("*").alias("overview")),
        metrics.select("generated_at", F.struct("*").alias("metrics")),
        listed(key_findings(facts), "position", F.col("finding"), "key_findings"),
        listed(business_risks(recommendations), "position", F.col("risk"), "business_risks"),
        listed(business_opportunities(facts), "position", F.col("opportunity"), "business_opportunities"),
        listed(topics, "__k", F.col("__v"), "topics"),
        listed(recommendations, "rank", recs, "recommendations"),
    )


# --- report lines ----------------------------------------------------------------


def _numbered(df: DataFrame, section: int, item: Column, lines: list[Column]) -> DataFrame:
    """Each row of ``df`` becomes several lines, tagged for ordering."""
    return df.select(
        F.lit(section).alias("section_no"),
        item.cast("int").alias("item_no"),
        F.posexplode(F.array(*lines)).alias("pos", "line"),
    )


def _flat(df: DataFrame, section: int, item: Column, lines: Column) -> DataFrame:
    return df.select(
        F.lit(section).alias("section_no"),
        item.cast("int").alias("item_no"),
        F.posexplode(lines).alias("pos", "line"),
    )


def _bullets(items: DataFrame, section: int, title: str, column: str, empty: str) -> list[DataFrame]:
    """Heading, one bullet per item or the empty message, closing blank line."""
    spark = items.sparkSession
    heading = literal_rows(
        spark, [(section, 0, 0, f"## {title}"), (section, 0, 1, "")], LINE_SCHEMA
    )
    lines = _numbered(items, section, F.col("position"), [F.concat(F.lit("- "), F.col(column))])
    closing = items.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(section).alias("section_no"),
        F.lit(2_000_000_000).alias("item_no"),
        F.posexplode(
            F.when(F.col("n") == 0, F.array(F.lit(empty), F.lit(""))).otherwise(F.array(F.lit("")))
        ).alias("pos", "line"),
    )
    return [heading, lines, closing]


LINE_SCHEMA = "section_no int, item_no int, pos int, line string"


def report_lines(
    summaries: DataFrame,
    facts: DataFrame,
    recommendations: DataFrame,
    overview: DataFrame,
    generated_at: str,
    brand: str = S.REPORT_BRAND,
) -> DataFrame:
    """The Markdown report as (line_no, line); every input has one row per topic or fewer."""
    metrics = report_metrics(facts, recommendations, generated_at, overview)
    labelled = side_by_side(
        metrics,
        overview.select("overall_sentiment", executive_sentence(brand).alias("sentence")),
    )
    # Fixed report layout.
    top = _numbered(
        labelled,
        0,
        F.lit(0),
        [
            F.lit(f"# {brand} Executive Review Report"),
            F.lit(""),
            F.format_string("_Generated at: %s_", "generated_at"),
            F.lit(""),
            F.lit("## Executive Summary"),
            F.lit(""),
            F.col("sentence"),
            F.lit(""),
            F.lit("## Dataset Overview"),
            F.lit(""),
            F.format_string("- Total reviews: %s", thousands(F.col("reviews"))),
            F.format_string("- Total topics: %s", F.col("topics").cast("string")),
            F.format_string("- Overall sentiment: %s", "overall_sentiment"),
            F.format_string("- Positive sentiment: %s", format_percentage(F.col("positive"))),
            F.format_string("- Negative sentiment: %s", format_percentage(F.col("negative"))),
            F.format_string("- Neutral sentiment: %s", format_percentage(F.col("neutral"))),
            F.format_string("- Total recommendations: %s", F.col("recommendations").cast("string")),
            F.format_string("- High-priority recommendations: %s", F.col("high_priority").cast("string")),
            F.lit(""),
        ],
    )

    def examples(label: str) -> Column:
        reviews = F.col(f"representative_reviews.{label}")
        block = F.concat(
            F.array(F.lit(f"**Representative {label} reviews**"), F.lit("")),
            F.transform(reviews, lambda r: F.concat(F.lit("- "), r)),
            F.array(F.lit("")),
        )
        return F.when(F.size(reviews) > 0, block).otherwise(F.array().cast("array<string>"))

    order = Window.partitionBy(F.lit(1)).orderBy(F.desc("review_count"), F.asc("topic_id"))
    topic_lines = F.concat(
        F.array(
            F.concat(F.lit("### "), F.col("topic_name")),
            F.lit(""),
            F.format_string("- Topic ID: %s", F.col("topic_id").cast("string")),
            F.format_string("- Reviews: %s", thousands(F.col("review_count"))),
            F.format_string("- Review share: %s", format_percentage(F.col("review_share_percent"))),
            *[
                F.format_string(
                    f"- {v.capitalize()} sentiment: %s", format_percentage(F.col(f"sentiment.{v}_percent"))
                )
                for v in ("positive", "neutral", "negative")
            ],
            F.format_string("- Dominant sentiment: %s", F.col("sentiment.dominant")),
            F.format_string("- Sentiment health: %s", F.col("sentiment.health")),
            F.lit(""),
            F.col("summary"),
            F.lit(""),
        ),
        examples("positive"),
        examples("negative"),
    )
    topics = summaries.withColumn("position", F.row_number().over(order))
    advice = _numbered(
        recommendations,
        5,
        F.col("rank"),
        [
            F.format_string("### %s. %s", F.col("rank").cast("string"), F.col("topic")),
            F.lit(""),
            F.format_string("- Priority: %s", "priority"),
            F.format_string("- Severity score: %s", fixed(F.col("severity"))),
            F.format_string("- Topic size: %s", thousands(F.col("topic_size"))),
            F.format_string("- Positive sentiment: %s", format_percentage(F.col("positive_ratio"), "ratio")),
            F.format_string("- Negative sentiment: %s", format_percentage(F.col("negative_ratio"), "ratio")),
            F.lit(""),
            F.format_string("**Recommendation:** %s", "recommendation"),
            F.lit(""),
            F.format_string("**Rationale:** %s", "rationale"),
            F.lit(""),
        ],
    )

    def headed(items: DataFrame, section: int, title: str, empty: str) -> DataFrame:
        return items.agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(section).alias("section_no"),
            F.lit(0).alias("item_no"),
            F.posexplode(
                F.concat(
                    F.array(F.lit(f"## {title}"), F.lit("")),
                    F.when(F.col("n") == 0, F.array(F.lit(empty), F.lit(""))).otherwise(
                        F.array().cast("array<string>")
                    ),
                )
            ).alias("pos", "line"),
        )

    parts = [
        top,
        *_bullets(key_findings(facts), 1, "Key Findings", "finding", "No key findings were generated."),
        *_bullets(
            business_risks(recommendations), 2, "Business Risks", "risk",
            "No high-priority business risks were detected.",
        ),
        *_bullets(
            business_opportunities(facts), 3, "Business Opportunities", "opportunity",
            "No strong positive opportunities were detected.",
        ),
        headed(summaries, 4, "Topic Analysis", "No topic summaries were generated."),
        _flat(topics, 4, F.col("position"), topic_lines),
        headed(recommendations, 5, "Recommendations", "No recommendations were generated."),
        advice,
    ]
    lines = reduce(DataFrame.unionByName, parts)
    numbering = Window.partitionBy(F.lit(1)).orderBy("section_no", "item_no", "pos")
    return lines.select(F.row_number().over(numbering).alias("line_no"), "line")


# --- artifact look-ups -------------------------------------------------------------


def by_id(table: DataFrame, topic_id: int | str) -> DataFrame:
    """Rows whose topic_id equals the given id, compared as text."""
    return table.where(F.col("topic_id").cast("string") == str(topic_id))


def search_topics(facts: DataFrame, text: str) -> DataFrame:
    """Case-insensitive substring search over name, summary and health; blank finds all."""
    wanted = text.strip().lower()
    if not wanted:
        return facts
    haystack = F.lower(F.concat_ws(" ", "topic_name", "summary", "health"))
    return facts.where(F.contains(haystack, F.lit(wanted)))


def by_priority(recommendations: DataFrame, priority: str) -> DataFrame:
    return recommendations.where(F.lower(F.trim("priority")) == priority.strip().lower())


def defensive_top(recommendations: DataFrame, limit: int = 5) -> DataFrame:
    """First rows by rank; an unreadable rank goes last, ties by severity."""
    rank = F.coalesce(F.expr("try_cast(`rank` as int)"), F.lit(1_000_000_000))
    weight = F.coalesce(F.expr("try_cast(severity as double)"), F.lit(0.0))
    return recommendations.orderBy(rank.asc(), weight.desc(), F.asc("topic_id")).limit(max(limit, 0))


RECOMMENDATION_SCHEMA = (
    "topic_id int, topic string, topic_size bigint, priority string, severity double, "
    "recommendation string, rationale string, positive_ratio double, negative_ratio double, rank int"
)


def recommendation_rows(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """Recommendation rows from JSON payloads that hold a list or an object with one."""
    row = f"struct<{RECOMMENDATION_SCHEMA.replace(' ', ':').replace(',:', ',')}>"
    text = F.trim(column)
    items = F.when(F.startswith(text, F.lit("[")), F.from_json(text, f"array<{row}>")).otherwise(
        F.from_json(text, f"struct<recommendations:array<{row}>>").getField("recommendations")
    )
    return payloads.select(F.explode(items).alias("item")).select("item.*")


def section(payloads: DataFrame, name: str, column: str = "payload") -> DataFrame:
    """One section of JSON payloads as text."""
    return payloads.select(F.get_json_object(column, f"$.{name}").alias(name))

