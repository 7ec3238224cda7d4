"""Structural cleaning of raw review tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom import settings as S
from reviewloom.functions import text as X
from reviewloom.plans.shapes import (
    col,
    duplicate_count,
    keep_first,
    literal_rows,
    require_columns,
)

# Bookkeeping columns that do not make two reviews different.
NOT_CONTENT = ("review_id", "source_dataset")


def rename_columns(df: DataFrame, names: Mapping[str, str] = S.RAW_TO_CLEAN_NAMES) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def drop_unusable_columns(df: DataFrame, columns: Iterable[str] = S.UNUSED_RAW_COLUMNS) -> DataFrame:
    unwanted = set(columns)
    return df.select(*[col(n) for n in df.columns if n not in unwanted])


def drop_missing(df: DataFrame, columns: Iterable[str] = ("review_text", "rating")) -> DataFrame:
    columns = list(columns)
    require_columns(df, columns, "review table")
    return df.dropna(subset=columns)


def clean_review_text(df: DataFrame, column: str = "review_text") -> DataFrame:
    require_columns(df, [column], "review table")
    return df.withColumn(column, X.normalise_text(F.col(column)))


def clean_review_titles(df: DataFrame, column: str = "review_title") -> DataFrame:
    if column not in df.columns:
        return df.withColumn(column, F.lit(""))
    return clean_review_text(df, column)


def valid_ratings(df: DataFrame, minimum: int = 1, maximum: int = 5, column: str = "rating") -> DataFrame:
    """Numeric ratings inside the range, truncated to tinyint after the check."""
    require_columns(df, [column], "review table")
    number = F.expr(f"try_cast(`{column}` as double)")
    return (
        df.withColumn(column, number)
        .where(F.col(column).between(minimum, maximum))
        .withColumn(column, F.col(column).cast("tinyint"))
    )


def parse_dates(df: DataFrame, columns: Iterable[str] = S.DATE_COLUMNS) -> DataFrame:
    """Date columns that exist become timestamps; unreadable values NULL."""
    present = [n for n in columns if n in df.columns]
    return df.withColumns({n: F.try_to_timestamp(F.col(n)) for n in present}) if present else df


def sentiment_label(rating):
    return (
        F.when(rating <= 2, "negative").when(rating == 3, "neutral").otherwise("positive")
    )


def add_sentiment_label(df: DataFrame, rating: str = "rating", output: str = "sentiment_label") -> DataFrame:
    require_columns(df, [rating], "review table")
    return df.withColumn(output, sentiment_label(F.col(rating)))


def drop_empty_reviews(df: DataFrame, column: str = "review_text") -> DataFrame:
    require_columns(df, [column], "review table")
    return df.where(F.length(column) > 0)


def content_columns(df: DataFrame, ignore: Iterable[str] = NOT_CONTENT) -> list[str]:
    return [n for n in df.columns if n not in set(ignore)]


def drop_exact_duplicates(
    df: DataFrame, ignore: Iterable[str] = NOT_CONTENT, dear: bool = False
) -> DataFrame:
    """One row per distinct content: the one with the smallest review_id.

    ``dear`` says that the rows cost more to compute than to store once.
    """
    return keep_first(df, content_columns(df, ignore), dear=dear)


def clean_violations(df: DataFrame) -> DataFrame:
    """Row count per broken rule of the cleaned table; all zero when valid."""
    require_columns(df, ("review_text", "review_title", "rating", "sentiment_label"), "cleaned table")
    known = F.col("sentiment_label").isin(*S.SENTIMENT_LABELS)
    rules = df.agg(
        F.count_if(F.col("review_text").isNull()).alias("missing_text"),
        F.count_if(F.length("review_text") == 0).alias("empty_text"),
        F.count_if(~F.coalesce(F.col("rating").between(1, 5), F.lit(False))).alias("rating_range"),
        F.count_if(~F.coalesce(known, F.lit(False))).alias("unknown_label"),
    )
    copies = duplicate_count(df, content_columns(df), "duplicate_rows")
    names = ("missing_text", "empty_text", "rating_range", "unknown_label")
    return rules.unpivot([], list(names), "rule", "violations").unionByName(
        copies.unpivot([], ["duplicate_rows"], "rule", "violations")
    )


def raise_on_violations(violations: DataFrame, what: str) -> None:
    """Action: fail with the names of the broken rules (one row per rule)."""
    broken = {r["rule"]: r["violations"] for r in violations.where("violations > 0").collect()}
    if broken:
        raise AssertionError(f"{what} breaks {broken}")


def require_clean_rows(df: DataFrame) -> DataFrame:
    """The table itself; reading a row that breaks a rule of the cleaned table fails."""
    require_columns(df, ("review_text", "rating", "sentiment_label"), "cleaned table")
    rules = {
        "missing_text": F.col("review_text").isNotNull(),
        "empty_text": F.length("review_text") > 0,
        "rating_range": F.col("rating").between(1, 5),
        "unknown_label": F.col("sentiment_label").isin(*S.SENTIMENT_LABELS),
    }
    passed = F.lit(True)
    for rule, ok in reversed(rules.items()):
        failed = F.raise_error(F.lit(f"cleaned table breaks {rule}"))
        passed = F.when(F.coalesce(ok, F.lit(False)), passed).otherwise(failed)
    return df.where(passed)


def clean_dataset(df: DataFrame) -> DataFrame:
    """The whole cleaning chain.

    Cleaned rows are stored once and searched for copies when this is called; the result
    is lazy from there on.  It ends with the row rules of the cleaned table; copies cannot
    be left after the last step but one.
    """
    return (
        df.transform(rename_columns)
        .transform(drop_unusable_columns)
        .transform(drop_missing)
        .transform(clean_review_text)
        .transform(clean_review_titles)
        .transform(valid_ratings)
        .transform(add_sentiment_label)
        .transform(parse_dates)
        .transform(drop_empty_reviews)
        .transform(drop_exact_duplicates, dear=True)
        .transform(require_clean_rows)
    )


def unexpected_labels(df: DataFrame, column: str = "sentiment_label", labels=S.SENTIMENT_LABELS) -> DataFrame:
    """Labels outside the domain with their row counts."""
    require_columns(df, [column], "labelled table")
    known = literal_rows(df.sparkSession, [(v,) for v in labels], f"`{column}` string")
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .join(F.broadcast(known), column, "left_anti")
    )


def validate_labels(df: DataFrame, required: Iterable[str] = S.CLEAN_REQUIRED_COLUMNS) -> DataFrame:
    """Check columns, then raise when a label is outside the domain (an action)."""
    require_columns(df, required)
    found = unexpected_labels(df).agg(
        F.count(F.lit(1)).alias("n"), F.min("sentiment_label").alias("example")
    ).first()
    if found["n"]:
        raise ValueError(f"{found['n']} unexpected sentiment labels, such as {found['example']!r}")
    return df


def quality_summary(raw: DataFrame, cleaned: DataFrame, processed: DataFrame) -> DataFrame:
    """Row accounting over the stages, one (metric, value) row each."""
    one = F.count(F.lit(1))
    empty_classical = (
        F.count_if(F.length("classical_text") == 0)
        if "classical_text" in processed.columns
        else F.lit(0).cast("bigint")
    )
    stages = (
        raw.agg(one.alias("raw"))
        .unpivot([], ["raw"], "stage", "rows")
        .unionByName(cleaned.agg(one.alias("clean")).unpivot([], ["clean"], "stage", "rows"))
        .unionByName(
            processed.agg(
                one.alias("processed"),
                F.count_if(F.col("review_text").isNull()).alias("missing_review_text"),
                F.count_if(~F.coalesce(F.col("rating").between(1, 5), F.lit(False))).alias("invalid_ratings"),
                F.count_if(F.length("transformer_text") == 0).alias("empty_transformer_text"),
                empty_classical.alias("empty_classical_text"),
            ).unpivot(
                [],
                ["processed", "missing_review_text", "invalid_ratings", "empty_transformer_text", "empty_classical_text"],
                "stage",
                "rows",
            )
        )
    )

    def of(stage: str):
        return F.max(F.when(F.col("stage") == stage, F.col("rows")))

    metrics = {
        "raw_rows": of("raw"),
        "cleaned_rows": of("clean"),
        "processed_rows": of("processed"),
        "removed_during_cleaning": of("raw") - of("clean"),
        "removed_during_normalized_deduplication": of("clean") - of("processed"),
        "missing_review_text": of("missing_review_text"),
        "invalid_ratings": of("invalid_ratings"),
        "empty_transformer_text": of("empty_transformer_text"),
        "empty_classical_text": of("empty_classical_text"),
    }
    return stages.agg(*[e.alias(n) for n, e in metrics.items()]).unpivot(
        [], list(metrics), "metric", "value"
    )
