"""P: profiling queries."""

from pyspark.sql import functions as F

from reviewloom.catalog.registry import query
from reviewloom.functions import text as X
from reviewloom.operators import profiling as P
from reviewloom.operators import sketches as K
from reviewloom.plans import fixtures as fx
from reviewloom.plans.fixtures import sql_over
from reviewloom.plans.shapes import stored

RAW_COLUMNS = (
    "review_id",
    "product_name",
    "brand",
    "source_dataset",
    "review_title",
    "review_text",
    "rating_raw",
    "review_date_raw",
    "do_recommend",
)
CONTENT = RAW_COLUMNS[1:]
MISSING = " + ".join(f"count(*) filter (where {c} is null)" for c in CONTENT)
BYTES = " + ".join(f"sum(coalesce(octet_length(encode({c})), 0))" for c in CONTENT)
OVERVIEW_SQL = f"""select 'rows' as metric, cast(count(*) as double) as value from reviews_raw
union all select 'columns', cast({len(CONTENT)} as double)
union all select 'total_missing_values', cast({MISSING} as double) from reviews_raw
union all select 'text_size_mb', round(({BYTES}) / 1048576, 2) from reviews_raw
union all select 'duplicate_rows', cast(sum(n - 1) as double) from (
  select count(*) as n from reviews_raw group by {", ".join(CONTENT)}) q"""
WORDS = r"len(list_filter(regexp_split_to_array(coalesce(review_text, ''), '\s+'), lambda t: t <> ''))"
STATS_SQL = " union all ".join(
    f"select '{name}_{measure}' as metric, cast({fn} as double) as value from sizes"
    for measure in ("characters", "words")
    for name, fn in (
        ("average", f"round(avg({measure}), 2)"),
        ("median", f"round(median({measure}), 2)"),
        ("minimum", f"min({measure})"),
        ("maximum", f"max({measure})"),
    )
)
SIZES = ("sizes", f"select length(coalesce(review_text, '')) as characters, {WORDS} as words from reviews_raw")
TYPES = {c: "bigint" if c == "review_id" else "string" for c in RAW_COLUMNS}
QUALITY_SQL = " union all ".join(
    f"select '{c}' as column_name, '{t}' as data_type, count(*) filter (where {c} is null) as missing "
    "from reviews_raw"
    for c, t in TYPES.items()
)


@query("p01_overview", sql_over("reviews_raw", body=OVERVIEW_SQL))
def overview(spark, sf_dir):
    return P.overview(fx.reviews_raw(spark, sf_dir).select(*CONTENT))


@query("p02_text_stats", sql_over("reviews_raw", SIZES, body=STATS_SQL))
def text_stats(spark, sf_dir):
    return P.text_statistics(fx.reviews_raw(spark, sf_dir), "review_text")


@query(
    "p03_vocabulary",
    sql_over(
        "reviews_raw",
        body=r"""select count(distinct word) as vocabulary_size from (
        select unnest(regexp_split_to_array(lower(review_text), '\s+')) as word from reviews_raw) q
        where word <> ''""",
    ),
)
def vocabulary(spark, sf_dir):
    return P.vocabulary_size(fx.reviews_raw(spark, sf_dir), "review_text")


RANK_ERROR = 0.005
FRACTIONS = (0.05, 0.25, 0.5, 0.75, 0.95)
FRACTION_ROWS = ", ".join(f"({f}::double)" for f in FRACTIONS)


def sized(spark, sf_dir):
    """Sizes of the review texts by source, and their names."""
    raw = fx.reviews_raw(spark, sf_dir)
    sizes = P.text_sizes("review_text")
    return raw.select("source_dataset", *[v.alias(n) for n, v in sizes.items()]), {n: F.col(n) for n in sizes}


@query(
    "p02b_text_quantiles",
    sql_over(
        "reviews_raw",
        SIZES,
        ("fractions", f"select * from (values {FRACTION_ROWS}) as f(fraction)"),
        body="""select measure, fraction, n, low, high, true as within_error from (
        select 'characters' as measure, count(*) as n, min(characters)::double as low, max(characters)::double as high from sizes
        union all select 'words', count(*), min(words)::double, max(words)::double from sizes) s cross join fractions""",
    ),
)
def text_quantiles(spark, sf_dir):
    """Quantiles from per-source sketches united afterwards, held against exact ranks."""
    sizes, values = sized(spark, sf_dir)
    united = K.unite_quantiles(
        K.quantile_sketches(sizes, values, ["source_dataset"], RANK_ERROR), rank_error=RANK_ERROR
    )
    gaps = K.rank_gaps(sizes, values, K.quantiles_of(united, FRACTIONS))
    bounds = united.select("measure", "low", "high")
    # Uniting costs at most the error of the parts once more.
    return gaps.join(bounds, "measure").select(
        "measure", "fraction", "n", "low", "high", (F.col("gap") <= 2 * RANK_ERROR).alias("within_error")
    )


WORD_ROWS = r"""select source_dataset, unnest(regexp_split_to_array(lower(review_text), '\s+')) as word
  from reviews_raw"""


@query(
    "p03b_vocabulary_sketches",
    sql_over(
        "reviews_raw",
        ("words", WORD_ROWS),
        body="""select source_dataset, count(distinct word) as vocabulary_size, true as within_error
        from words where word <> '' group by 1
        union all select 'all', count(distinct word), true from words where word <> ''""",
    ),
)
def vocabulary_sketches(spark, sf_dir):
    """Vocabulary per source and of their union from stored sketches, beside exact counts."""
    raw = fx.reviews_raw(spark, sf_dir)
    words = raw.select(
        "source_dataset", F.explode(X.split_words(F.lower("review_text"))).alias("word")
    )
    # The texts are split twice, once for the sketches and once for the exact counts.
    parts = stored(K.distinct_sketches(words, {"word": F.col("word")}, ["source_dataset"]), "sketches")
    estimates = K.distinct_estimates(parts, ["source_dataset"]).unionByName(
        K.distinct_estimates(K.unite_distinct(parts)).withColumn("source_dataset", F.lit("all"))
    )
    pairs = stored(words.distinct(), "words")
    exact = (
        pairs.groupBy("source_dataset")
        .agg(F.count(F.lit(1)).alias("vocabulary_size"))
        .unionByName(
            pairs.agg(F.lit("all").alias("source_dataset"), F.count_distinct("word").alias("vocabulary_size"))
        )
    )
    return exact.join(estimates, "source_dataset").select(
        "source_dataset",
        "vocabulary_size",
        K.within(F.col("estimate"), F.col("vocabulary_size")).alias("within_error"),
    )


@query("p04_quality_report", sql_over("reviews_raw", body=QUALITY_SQL))
def quality_report(spark, sf_dir):
    return P.quality_report(fx.reviews_raw(spark, sf_dir).select(*RAW_COLUMNS))


@query(
    "p05_profile",
    sql_over(
        "reviews_raw",
        SIZES,
        body=f"""select 'overview' as section, * from ({OVERVIEW_SQL}) a
        union all select 'text_statistics', * from ({STATS_SQL}) b
        union all select 'quality_report', 'missing_' || column_name, cast(missing as double)
        from ({QUALITY_SQL}) c where column_name <> 'review_id'""",
    ),
)
def profile(spark, sf_dir):
    return P.profile(fx.reviews_raw(spark, sf_dir).select(*CONTENT), "review_text")


@query(
    "p06_distinct",
    sql_over(
        "reviews_raw",
        body=" union all ".join(
            f"select '{c}' as column_name, count(distinct {c}) as distinct_values from reviews_raw"
            for c in RAW_COLUMNS
        ),
    ),
)
def distinct(spark, sf_dir):
    return P.distinct_counts(fx.reviews_raw(spark, sf_dir), RAW_COLUMNS)


@query(
    "p06b_distinct_sketches",
    sql_over(
        "reviews_raw",
        body=" union all ".join(
            f"select '{c}' as measure, count(distinct {c}) as distinct_values, true as within_error, "
            "true as union_is_whole from reviews_raw"
            for c in RAW_COLUMNS
        ),
    ),
)
def distinct_sketches(spark, sf_dir):
    """Per-source sketches united, against the sketch of the whole table and exact counts."""
    raw = fx.reviews_raw(spark, sf_dir)
    values = {c: F.col(c) for c in RAW_COLUMNS}
    united = K.unite_distinct(K.distinct_sketches(raw, values, ["source_dataset"]))
    whole = K.unite_distinct(K.distinct_sketches(raw, values))
    exact = P.distinct_counts(raw, RAW_COLUMNS).withColumnRenamed("column_name", "measure")
    return (
        exact.join(K.distinct_estimates(united), "measure")
        .join(K.distinct_estimates(whole).withColumnRenamed("estimate", "estimate_of_whole"), "measure")
        .select(
            "measure",
            "distinct_values",
            K.within(F.col("estimate"), F.col("distinct_values")).alias("within_error"),
            (F.col("estimate") == F.col("estimate_of_whole")).alias("union_is_whole"),
        )
    )


@query(
    "p07_value_counts",
    sql_over(
        "reviews_raw",
        body="select do_recommend as value, count(*) as row_count from reviews_raw group by 1",
    ),
)
def value_counts(spark, sf_dir):
    return P.value_counts(fx.reviews_raw(spark, sf_dir), "do_recommend")


@query(
    "p08_crosstab",
    sql_over(
        "reviews_raw",
        body="""select rating_raw, count(*) filter (where do_recommend = 'false') as do_recommend_false,
        count(*) filter (where do_recommend = 'true') as do_recommend_true,
        count(*) filter (where do_recommend is null) as do_recommend_missing
        from reviews_raw group by 1""",
    ),
)
def crosstab(spark, sf_dir):
    return P.crosstab(fx.reviews_raw(spark, sf_dir), "rating_raw", "do_recommend", ("false", "true"))


@query(
    "p09_missing_by_source",
    sql_over(
        "reviews_raw",
        body="""select source_dataset, count(*) filter (where do_recommend is null) as missing,
        count(do_recommend) as present from reviews_raw group by 1""",
    ),
)
def missing_by_source(spark, sf_dir):
    return P.missing_by(fx.reviews_raw(spark, sf_dir), "source_dataset", "do_recommend")


@query(
    "p10_describe",
    sql_over(
        "reviews_labelled",
        body="""select count(rating) as row_count, round(avg(rating), 6) as mean,
        round(stddev_samp(rating), 6) as std, cast(min(rating) as double) as minimum,
        quantile_cont(rating, 0.25) as p25, quantile_cont(rating, 0.5) as p50,
        quantile_cont(rating, 0.75) as p75, cast(max(rating) as double) as maximum
        from reviews_labelled""",
    ),
)
def describe(spark, sf_dir):
    return P.describe_numeric(fx.reviews_labelled(spark, sf_dir), "rating")


@query(
    "p10b_describe_approximate",
    sql_over(
        "reviews_raw",
        ("lengths", "select length(coalesce(review_text, '')) as len from reviews_raw"),
        body=f"""select count(*) as row_count, round(avg(len), 6) as mean, round(stddev_samp(len), 6) as std,
        min(len)::double as minimum, max(len)::double as maximum, true as p25_ok, true as p50_ok,
        true as p75_ok from lengths""",
    ),
)
def describe_approximate(spark, sf_dir):
    """The sketch's quartiles, each told only by whether its exact rank is close enough."""
    lengths = fx.reviews_raw(spark, sf_dir).select(
        F.length(F.coalesce("review_text", F.lit(""))).alias("len")
    )
    found = P.describe_numeric(lengths, "len", approximate=RANK_ERROR)
    quartiles = found.unpivot([], ["p25", "p50", "p75"], "name", "value").select(
        F.lit("len").alias("measure"),
        (F.substring("name", 2, 2).cast("double") / 100).alias("fraction"),
        "value",
    )
    gaps = K.rank_gaps(lengths, {"len": F.col("len")}, quartiles)
    ok = gaps.groupBy("measure").pivot("fraction", [0.25, 0.5, 0.75]).agg(F.max(F.col("gap") <= RANK_ERROR))
    numbers = found.select(F.lit("len").alias("measure"), "row_count", "mean", "std", "minimum", "maximum")
    return numbers.join(ok, "measure").select(
        *["row_count", "mean", "std", "minimum", "maximum"],
        *[F.col(f"`{f}`").alias(n) for f, n in ((0.25, "p25_ok"), (0.5, "p50_ok"), (0.75, "p75_ok"))],
    )


@query(
    "p11_longest",
    sql_over(
        "reviews_raw",
        body="""select review_id, review_title, rating_raw, source_dataset,
        length(coalesce(review_text, '')) as text_length from reviews_raw
        order by text_length desc, review_id limit 5""",
    ),
)
def longest(spark, sf_dir):
    return P.longest_texts(
        fx.reviews_raw(spark, sf_dir),
        "review_text",
        keep=("review_id", "review_title", "rating_raw", "source_dataset"),
    )


@query(
    "p12_top_groups",
    sql_over(
        "reviews_labelled",
        body="""select 'by_reviews' as ranking, * from (select product_name, count(*) as reviews,
        cast(null as double) as average_rating from reviews_labelled group by 1
        order by reviews desc, product_name limit 10) a
        union all select 'by_rating', * from (select product_name, count(*) as reviews,
        round(avg(rating), 6) as average_rating from reviews_labelled group by 1
        order by average_rating desc, product_name limit 10) b""",
    ),
)
def top_groups(spark, sf_dir):
    reviews = fx.reviews_labelled(spark, sf_dir)
    by_reviews = P.top_groups(reviews, "product_name")
    by_rating = P.top_groups(reviews, "product_name", rating="rating")
    return by_reviews.select(
        F.lit("by_reviews").alias("ranking"),
        "product_name",
        "reviews",
        F.lit(None).cast("double").alias("average_rating"),
    ).unionByName(by_rating.withColumn("ranking", F.lit("by_rating")))


@query(
    "p13_source_summary",
    sql_over(
        "reviews_raw",
        body="""select source_dataset, count(*) as reviews,
        round(avg(try_cast(rating_raw as double)), 6) as average_rating,
        round(avg(length(coalesce(review_text, ''))), 6) as average_length,
        count(*) filter (where do_recommend is null) as missing_flags
        from reviews_raw group by 1""",
    ),
)
def source_summary(spark, sf_dir):
    raw = fx.reviews_raw(spark, sf_dir).withColumn("rating", F.expr("try_cast(rating_raw as double)"))
    return P.source_summary(raw, "source_dataset", "rating", "review_text", "do_recommend")


@query(
    "p14_missing_rate",
    sql_over(
        "reviews_raw",
        body="""select count(*) filter (where do_recommend is null) as missing,
        round(avg(case when do_recommend is null then 1 else 0 end) * 100, 2) as missing_percent
        from reviews_raw""",
    ),
)
def missing_rate(spark, sf_dir):
    return P.missing_rate(fx.reviews_raw(spark, sf_dir), "do_recommend")


@query(
    "p15_class_distribution",
    sql_over(
        "reviews_labelled",
        body="""select sentiment_label, count(*) as row_count,
        round(count(*) * 100.0 / sum(count(*)) over (), 2) as percentage
        from reviews_labelled group by 1""",
    ),
)
def class_distribution(spark, sf_dir):
    return P.class_distribution(fx.reviews_labelled(spark, sf_dir))


@query(
    "p16_length_histogram",
    sql_over(
        "reviews_labelled",
        ("lengths", "select length(review_text) as len from reviews_labelled"),
        ("bounds", "select min(len) as lo, max(len) as hi from lengths"),
        body="""select cast(least(floor((len - lo) / ((hi - lo) / 50.0)), 49) as int) as bin,
        round(lo + least(floor((len - lo) / ((hi - lo) / 50.0)), 49) * ((hi - lo) / 50.0), 6) as bin_start,
        count(*) as row_count from lengths cross join bounds group by 1, 2""",
    ),
)
def length_histogram(spark, sf_dir):
    return P.length_histogram(fx.reviews_labelled(spark, sf_dir), "review_text")


@query(
    "p16b_length_quartiles",
    sql_over(
        "reviews_labelled",
        ("lengths", "select length(review_text) as len from reviews_labelled"),
        body="""select quantile_cont(len, 0.0) as p0, quantile_cont(len, 0.25) as p25,
        quantile_cont(len, 0.5) as p50, quantile_cont(len, 0.75) as p75,
        quantile_cont(len, 1.0) as p100 from lengths""",
    ),
)
def length_quartiles(spark, sf_dir):
    return P.length_quartiles(fx.reviews_labelled(spark, sf_dir), "review_text")
