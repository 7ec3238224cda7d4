"""Data profiling: overviews, text statistics, counts and distributions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.functions import text as X
from reviewloom.operators import sketches as K
from reviewloom.plans.shapes import col, duplicate_count, weighted_percentiles


def overview(df: DataFrame) -> DataFrame:
    """Rows, columns, duplicate rows, missing values and bytes of text."""
    strings = [n for n, t in df.dtypes if t == "string"]
    missing = sum((F.count_if(col(n).isNull()) for n in df.columns), F.lit(0))
    size = sum(
        (F.sum(F.coalesce(F.octet_length(col(n)), F.lit(0)).cast("bigint")) for n in strings),
        F.lit(0),
    )
    base = df.agg(
        F.count(F.lit(1)).cast("double").alias("rows"),
        F.lit(len(df.columns)).cast("double").alias("columns"),
        missing.cast("double").alias("total_missing_values"),
        F.round(F.coalesce(size, F.lit(0)) / (1024 * 1024), 2).alias("text_size_mb"),
    ).unpivot([], ["rows", "columns", "total_missing_values", "text_size_mb"], "metric", "value")
    copies = duplicate_count(df, df.columns).select(
        F.lit("duplicate_rows").alias("metric"), F.col("duplicate_rows").cast("double").alias("value")
    )
    return base.unionByName(copies)


def text_sizes(column: str) -> dict[str, Column]:
    """Characters and words of a text, NULL as empty."""
    text = F.coalesce(col(column), F.lit(""))
    return {"characters": F.length(text), "words": X.word_count(text)}


def text_statistics(df: DataFrame, column: str, approximate: float | None = None) -> DataFrame:
    """Mean, median, minimum and maximum of characters and words.

    ``approximate`` is the rank error allowed for the medians; they then come from
    quantile sketches instead of a table of all sizes.
    """
    sizes = df.select(*[v.alias(n) for n, v in text_sizes(column).items()])
    if approximate is not None:
        parts = {n: F.col(n) for n in ("characters", "words")}
        means = sizes.agg(*[F.round(F.avg(n), 2).alias(n) for n in parts]).unpivot(
            [], list(parts), "measure", "average"
        )
        summary = K.quantile_sketches(sizes, parts, rank_error=approximate).select(
            "measure", K.quantile("sketch", 0.5).alias("median"), F.col("low").alias("minimum"), F.col("high").alias("maximum")
        )
        return means.join(summary, "measure").unpivot(
            ["measure"], ["average", "median", "minimum", "maximum"], "statistic", "value"
        ).select(F.concat_ws("_", "statistic", "measure").alias("metric"), "value")
    # One narrow (measure, size, count) histogram feeds all eight numbers.
    histogram = (
        sizes.unpivot([], ["characters", "words"], "measure", "size")
        .groupBy("measure", "size")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    per = histogram.groupBy("measure").agg(
        F.round(F.sum(F.col("size") * F.col("n")) / F.sum("n"), 2).alias("average"),
        F.round(F.percentile("size", F.lit(0.5), F.col("n")), 2).alias("median"),
        F.min("size").cast("double").alias("minimum"),
        F.max("size").cast("double").alias("maximum"),
    )
    return per.unpivot(
        ["measure"], ["average", "median", "minimum", "maximum"], "statistic", "value"
    ).select(F.concat_ws("_", "statistic", "measure").alias("metric"), "value")


def vocabulary_size(df: DataFrame, column: str, approximate: bool = False) -> DataFrame:
    """Distinct lowercase whitespace tokens."""
    words = df.select(F.explode(X.split_words(F.lower(col(column)))).alias("word"))
    count = F.approx_count_distinct("word") if approximate else F.count_distinct("word")
    return words.agg(count.alias("vocabulary_size"))


def quality_report(df: DataFrame) -> DataFrame:
    """Missing count and type per column, from one pass."""
    types = F.create_map(*[F.lit(x) for pair in df.dtypes for x in pair])
    missing = df.agg(*[F.count_if(col(n).isNull()).alias(n) for n in df.columns])
    return missing.unpivot([], [col(n) for n in df.columns], "column_name", "missing").select(
        "column_name", types[F.col("column_name")].alias("data_type"), "missing"
    )


def profile(df: DataFrame, text_column: str) -> DataFrame:
    """Overview, text statistics and quality report as (section, metric, value)."""
    parts = (
        ("overview", overview(df)),
        ("text_statistics", text_statistics(df, text_column)),
        (
            "quality_report",
            quality_report(df).select(
                F.concat(F.lit("missing_"), "column_name").alias("metric"),
                F.col("missing").cast("double").alias("value"),
            ),
        ),
    )
    out = None
    for section, part in parts:
        part = part.select(F.lit(section).alias("section"), "metric", "value")
        out = part if out is None else out.unionByName(part)
    return out


def distinct_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct non-NULL values per column.

    Columns are stacked and reduced to distinct (column, value digest) pairs first,
    so one wide or hot column costs one narrow shuffle.
    """
    columns = list(columns or df.columns)
    stacked = df.select(*[F.md5(col(n).cast("string")).alias(n) for n in columns]).unpivot(
        [], [col(n) for n in columns], "column_name", "digest"
    )
    found = stacked.groupBy("column_name").agg(F.count_distinct("digest").alias("distinct_values"))
    return found


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, NULL counted as a value of its own."""
    return (
        df.groupBy(col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .orderBy(F.asc_nulls_last("value"))
    )


def crosstab(df: DataFrame, rows: str, columns: str, values: Sequence, missing: str = "missing") -> DataFrame:
    """Counts of ``rows`` by the given ``columns`` values plus NULL."""
    cells = [F.count_if(col(columns) == v).alias(f"{columns}_{v}") for v in values]
    return df.groupBy(col(rows)).agg(
        *cells, F.count_if(col(columns).isNull()).alias(f"{columns}_{missing}")
    )


def missing_by(df: DataFrame, group: str, column: str) -> DataFrame:
    """Missing and present counts of one column per group."""
    return df.groupBy(col(group)).agg(
        F.count_if(col(column).isNull()).alias("missing"),
        F.count_if(col(column).isNotNull()).alias("present"),
    )


def describe_numeric(df: DataFrame, column: str, approximate: float | None = None) -> DataFrame:
    """Count, mean, standard deviation, minimum, quartiles and maximum.

    Exact quartiles gather the distinct values of the column.  ``approximate`` is a rank
    error instead: quartiles come from a quantile sketch of bounded size.
    """
    v = col(column)
    if approximate is None:
        quartiles = [
            F.percentile(v, F.lit(f)).alias(n) for n, f in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))
        ]
        names = ["p25", "p50", "p75"]
    else:
        quartiles = [F.kll_sketch_agg_double(v.cast("double"), F.lit(K.kll_size(approximate))).alias("__s")]
        names = [K.quantile("__s", f).alias(n) for n, f in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))]
    return df.where(v.isNotNull()).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.round(F.avg(v), 6).alias("mean"),
        F.round(F.stddev_samp(v), 6).alias("std"),
        F.min(v).cast("double").alias("minimum"),
        *quartiles,
        F.max(v).cast("double").alias("maximum"),
    ).select("row_count", "mean", "std", "minimum", *names, "maximum")


def longest_texts(df: DataFrame, column: str, n: int = 5, keep: Sequence[str] = ("review_id",)) -> DataFrame:
    """The n longest texts; only keys and lengths reach the sort."""
    length = F.length(F.coalesce(col(column), F.lit("")))
    return df.select(*[col(k) for k in keep], length.alias("text_length")).orderBy(
        F.desc("text_length"), F.asc("review_id")
    ).limit(n)


def top_groups(df: DataFrame, group: str, n: int = 10, rating: str | None = None) -> DataFrame:
    """Largest groups by rows, or by mean rating when ``rating`` is given."""
    counted = F.count(F.lit(1)).alias("reviews")
    if rating is None:
        return df.groupBy(group).agg(counted).orderBy(F.desc("reviews"), F.asc(group)).limit(n)
    mean = F.round(F.avg(col(rating)), 6).alias("average_rating")
    return df.groupBy(group).agg(counted, mean).orderBy(
        F.desc_nulls_last("average_rating"), F.asc(group)
    ).limit(n)


def source_summary(df: DataFrame, source: str, rating: str, text: str, flag: str) -> DataFrame:
    """Reviews, mean rating, mean text length and missing flags per source."""
    return df.groupBy(col(source)).agg(
        F.count(F.lit(1)).alias("reviews"),
        F.round(F.avg(col(rating)), 6).alias("average_rating"),
        F.round(F.avg(F.length(F.coalesce(col(text), F.lit("")))), 6).alias("average_length"),
        F.count_if(col(flag).isNull()).alias("missing_flags"),
    )


def missing_rate(df: DataFrame, column: str) -> DataFrame:
    """Missing count and percentage of one column."""
    missing = col(column).isNull()
    return df.agg(
        F.count_if(missing).alias("missing"),
        F.round(F.avg(missing.cast("int")) * 100, 2).alias("missing_percent"),
    )


def class_distribution(df: DataFrame, label: str = "sentiment_label") -> DataFrame:
    """Rows and rounded percentage per label."""
    from pyspark.sql import Window

    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("row_count"))
    total = F.sum("row_count").over(Window.partitionBy(F.lit(1)))
    return counts.withColumn("percentage", F.round(F.col("row_count") / total * 100, 2))


def length_histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Equal-width bins over the text length, from per-length counts."""
    from pyspark.sql import Window

    lengths = df.groupBy(F.length(F.coalesce(col(column), F.lit(""))).alias("len")).agg(
        F.count(F.lit(1)).alias("n")
    )
    everything = Window.partitionBy(F.lit(1))
    low, high = F.min("len").over(everything), F.max("len").over(everything)
    width = (high - low) / F.lit(float(bins))
    bucket = F.when(high == low, F.lit(0)).otherwise(
        F.least(F.floor((F.col("len") - low) / width), F.lit(bins - 1))
    )
    return (
        lengths.select(
            bucket.cast("int").alias("bin"), F.round(low + bucket * width, 6).alias("bin_start"), "n"
        )
        .groupBy("bin", "bin_start")
        .agg(F.sum("n").alias("row_count"))
    )


def length_quartiles(df: DataFrame, column: str, approximate: float | None = None) -> DataFrame:
    """The five numbers behind a box plot of text length; ``approximate`` is a rank error."""
    lengths = df.select(F.length(F.coalesce(col(column), F.lit(""))).alias("len"))
    fractions = (0.0, 0.25, 0.5, 0.75, 1.0)
    if approximate is None:
        return weighted_percentiles(lengths, "len", fractions)
    found = K.quantile_sketches(lengths, {"len": F.col("len")}, rank_error=approximate)
    return found.select(*[K.quantile("sketch", f).alias(f"p{int(f * 100)}") for f in fractions])
