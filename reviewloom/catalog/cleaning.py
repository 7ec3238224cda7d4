"""C: cleaning queries."""

from pyspark.sql import functions as F

from reviewloom.catalog import sqltext as T
from reviewloom.catalog.registry import query
from reviewloom.functions import text as X
from reviewloom.operators import cleaning as C
from reviewloom.operators import features
from reviewloom.plans import fixtures as fx
from reviewloom.plans.fixtures import sql_over
from reviewloom.plans.shapes import spread_small

# Column names of a raw review file over the derived review table.
RAW_FILE = {
    "review_id": "review_id",
    "name": "product_name",
    "brand": "brand",
    "primaryCategories": "source_dataset",
    "reviews.title": "review_title",
    "reviews.text": "review_text",
    "reviews.rating": "rating_raw",
    "reviews.date": "review_date_raw",
    "reviews.doRecommend": "do_recommend",
    "keys": "brand",
    "source_dataset": "source_dataset",
}


def raw_file(spark, sf_dir, spread=False):
    raw = fx.reviews_raw(spark, sf_dir, spread)
    return raw.select(*[F.col(source).alias(name) for name, source in RAW_FILE.items()])


@query(
    "c01_rename",
    sql_over(
        "reviews_raw",
        body="""select review_id, product_name, brand, source_dataset as primary_categories,
        review_title, review_text, rating_raw as rating, review_date_raw as review_date,
        do_recommend, brand as keys, source_dataset from reviews_raw""",
    ),
)
def rename(spark, sf_dir):
    renamed = C.rename_columns(raw_file(spark, sf_dir))
    return renamed.withColumnRenamed("reviews.doRecommend", "do_recommend")


@query(
    "c02_drop_columns",
    sql_over(
        "reviews_raw",
        body="""select review_id, product_name, brand, source_dataset as primary_categories,
        review_title, review_text, rating_raw as rating, review_date_raw as review_date,
        source_dataset from reviews_raw""",
    ),
)
def drop_columns(spark, sf_dir):
    return C.drop_unusable_columns(C.rename_columns(raw_file(spark, sf_dir)))


@query(
    "c03_drop_missing",
    sql_over(
        "reviews_raw",
        body="""select review_id, review_text, rating_raw as rating from reviews_raw
        where review_text is not null and rating_raw is not null""",
    ),
)
def drop_missing(spark, sf_dir):
    raw = fx.reviews_raw(spark, sf_dir).withColumnRenamed("rating_raw", "rating")
    return C.drop_missing(raw).select("review_id", "review_text", "rating")


@query("c04_normalize_text")
def normalize_text(spark, sf_dir):
    pages = spread_small(fx.table(spark, sf_dir, "pages"), "page_id")
    return pages.select("page_id", X.normalise_text(F.col("html")).alias("text"))


@query(
    "c04c_normal_form",
    "select page_id, true as one_space, true as trimmed, true as no_entities, true as no_markup from pages",
)
def normal_form(spark, sf_dir):
    """What normalised text never holds."""
    text = normalize_text(spark, sf_dir)
    return text.select(
        "page_id",
        (~F.col("text").rlike(r"\s\s|[\t\n\r]")).alias("one_space"),
        (~F.col("text").rlike(r"^\s|\s$")).alias("trimmed"),
        (~F.col("text").rlike(r"&(amp|lt|gt|quot|nbsp|#[0-9]+);")).alias("no_entities"),
        (~F.col("text").rlike(r"(?i)</?(div|p|span|script|style|a|html|body)\b[^>]*>")).alias("no_markup"),
    )


@query(
    "c04b_strip_markup",
    f"select page_id, {T.collapse(T.strip_markup('html'))} as text from pages",
)
def strip_markup(spark, sf_dir):
    pages = fx.table(spark, sf_dir, "pages")
    return pages.select("page_id", X.collapse_spaces(X.strip_markup(F.col("html"))).alias("text"))


@query(
    "c05_clean_text",
    sql_over("reviews_raw", body=f"select review_id, {T.normalise('review_text')} as review_text from reviews_raw"),
)
def clean_text(spark, sf_dir):
    return C.clean_review_text(fx.reviews_raw(spark, sf_dir, spread=True)).select("review_id", "review_text")


@query(
    "c06_clean_title",
    sql_over("reviews_raw", body=f"select review_id, {T.normalise('review_title')} as review_title from reviews_raw"),
)
def clean_title(spark, sf_dir):
    return C.clean_review_titles(fx.reviews_raw(spark, sf_dir)).select("review_id", "review_title")


@query(
    "c07_valid_ratings",
    sql_over(
        "reviews_raw",
        body="""select review_id, cast(floor(r) as int) as rating from
        (select review_id, try_cast(rating_raw as double) as r from reviews_raw) q
        where r between 1 and 5""",
    ),
)
def valid_ratings(spark, sf_dir):
    raw = fx.reviews_raw(spark, sf_dir).withColumnRenamed("rating_raw", "rating")
    return C.valid_ratings(raw).select("review_id", F.col("rating").cast("int").alias("rating"))


DATE_SQL = "strftime(try_cast({} as timestamp), '%Y-%m-%d %H:%M:%S')"


def date_text(name):
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name)


@query(
    "c08_parse_dates",
    sql_over(
        "reviews_raw",
        body=f"select review_id, {DATE_SQL.format('review_date_raw')} as review_date from reviews_raw",
    ),
)
def parse_dates(spark, sf_dir):
    raw = fx.reviews_raw(spark, sf_dir).withColumnRenamed("review_date_raw", "review_date")
    return C.parse_dates(raw).select("review_id", date_text("review_date"))


@query(
    "c09_sentiment_label",
    sql_over(
        "reviews_labelled",
        body="""select review_id, rating, case when rating <= 2 then 'negative'
        when rating = 3 then 'neutral' else 'positive' end as sentiment_label
        from reviews_labelled""",
    ),
)
def label(spark, sf_dir):
    rated = fx.reviews_labelled(spark, sf_dir).select("review_id", "rating")
    return C.add_sentiment_label(rated)


@query(
    "c10_non_empty",
    sql_over(
        "reviews_raw",
        body="select review_id, review_text from reviews_raw where length(coalesce(review_text, '')) > 0",
    ),
)
def non_empty(spark, sf_dir):
    return C.drop_empty_reviews(fx.reviews_raw(spark, sf_dir)).select("review_id", "review_text")


DEDUP_COLUMNS = ("review_id", "source_dataset", "review_text", "rating", "sentiment_label")


@query(
    "c11_exact_dedup",
    sql_over(
        "reviews_labelled",
        body="""select review_id, source_dataset, review_text, rating, sentiment_label from (
        select *, row_number() over (partition by review_text, rating, sentiment_label
        order by review_id) as n from reviews_labelled) q where n = 1""",
    ),
)
def exact_dedup(spark, sf_dir):
    return C.drop_exact_duplicates(fx.reviews_labelled(spark, sf_dir).select(*DEDUP_COLUMNS))


@query(
    "c12_violations",
    sql_over(
        "reviews_raw",
        (
            "dirty",
            """select review_id, coalesce(review_title, '') as review_title, review_text,
            try_cast(rating_raw as double) as rating,
            case when rating_raw = '2.5' then 'unsure' else 'positive' end as sentiment_label
            from reviews_raw""",
        ),
        body="""select 'missing_text' as rule, count(*) as violations from dirty where review_text is null
        union all select 'empty_text', count(*) from dirty where review_text = ''
        union all select 'rating_range', count(*) from dirty where not coalesce(rating between 1 and 5, false)
        union all select 'unknown_label', count(*) from dirty where sentiment_label = 'unsure'
        union all select 'duplicate_rows', cast(coalesce(sum(n - 1), 0) as bigint) from (
          select count(*) as n from dirty group by review_title, review_text, rating, sentiment_label) q""",
    ),
)
def violations(spark, sf_dir):
    dirty = fx.reviews_raw(spark, sf_dir).select(
        "review_id",
        F.coalesce("review_title", F.lit("")).alias("review_title"),
        "review_text",
        F.expr("try_cast(rating_raw as double)").alias("rating"),
        F.when(F.col("rating_raw") == "2.5", "unsure").otherwise("positive").alias("sentiment_label"),
    )
    return C.clean_violations(dirty)


CLEAN_SQL = f"""select review_id, product_name, brand, primary_categories, review_title, review_text,
  rating, review_date, source_dataset, sentiment_label from (
  select *, row_number() over (partition by product_name, brand, primary_categories, review_title,
    review_text, rating, review_date, sentiment_label order by review_id) as n from (
    select review_id, product_name, brand, source_dataset as primary_categories,
      {T.normalise('review_title')} as review_title, {T.normalise('review_text')} as review_text,
      cast(floor(r) as int) as rating, {DATE_SQL.format('review_date_raw')} as review_date,
      source_dataset,
      case when floor(r) <= 2 then 'negative' when floor(r) = 3 then 'neutral'
           else 'positive' end as sentiment_label
    from (select *, try_cast(rating_raw as double) as r from reviews_raw
          where review_text is not null and rating_raw is not null) a
    where r between 1 and 5) b
  where length(review_text) > 0) c where n = 1"""


@query("c13_clean_dataset", sql_over("reviews_raw", body=CLEAN_SQL))
def clean_dataset(spark, sf_dir):
    cleaned = C.clean_dataset(raw_file(spark, sf_dir, spread=True))
    return cleaned.withColumn("rating", F.col("rating").cast("int")).withColumn(
        "review_date", date_text("review_date")
    )


@query(
    "c14_unexpected_labels",
    sql_over(
        "reviews_raw",
        body="""select label as sentiment_label, count(*) as row_count from (
        select case when rating_raw = 'x' then 'unreadable' when rating_raw = '0' then 'zero'
        when rating_raw is null then null else 'neutral' end as label from reviews_raw) q
        where label not in ('negative', 'neutral', 'positive') group by label""",
    ),
)
def unexpected_labels(spark, sf_dir):
    rating = F.col("rating_raw")
    named = fx.reviews_raw(spark, sf_dir).select(
        F.when(rating == "x", "unreadable")
        .when(rating == "0", "zero")
        .when(rating.isNotNull(), "neutral")
        .alias("sentiment_label")
    )
    return C.unexpected_labels(named)


@query(
    "c15_quality_summary",
    sql_over(
        "reviews_raw",
        ("cleaned", CLEAN_SQL),
        (
            "processed",
            f"""select *, {T.classical_text('transformer_text')} as classical_text from (
            select *, row_number() over (partition by transformer_text, rating order by review_id) as k
            from (select *, {T.normalise("concat_ws(' ', review_title, review_text)")} as transformer_text
            from cleaned) a where length(transformer_text) > 0) b where k = 1""",
        ),
        body="""select 'raw_rows' as metric, count(*) as value from reviews_raw
        union all select 'cleaned_rows', count(*) from cleaned
        union all select 'processed_rows', count(*) from processed
        union all select 'removed_during_cleaning',
          (select count(*) from reviews_raw) - (select count(*) from cleaned)
        union all select 'removed_during_normalized_deduplication',
          (select count(*) from cleaned) - (select count(*) from processed)
        union all select 'missing_review_text', count(*) from processed where review_text is null
        union all select 'invalid_ratings', count(*) from processed where not rating between 1 and 5
        union all select 'empty_transformer_text', count(*) from processed where transformer_text = ''
        union all select 'empty_classical_text', count(*) from processed where classical_text = ''""",
    ),
)
def quality_summary(spark, sf_dir):
    raw = raw_file(spark, sf_dir, spread=True)
    cleaned = C.clean_dataset(raw).persist()
    return C.quality_summary(raw, cleaned, features.model_text_features(cleaned))
