"""T: text feature queries."""

from pyspark.sql import functions as F

from reviewloom.catalog import sqltext as T
from reviewloom.catalog.registry import query
from reviewloom.functions import text as X
from reviewloom.operators import features as P
from reviewloom.plans import fixtures as fx
from reviewloom.plans.fixtures import sql_over

COMBINED = T.normalise("concat_ws(' ', review_title, review_text)")


@query(
    "t01_combine_text",
    sql_over(
        "reviews_labelled",
        body=f"select review_id, {COMBINED} as normalized_combined_text from reviews_labelled",
    ),
)
def combine(spark, sf_dir):
    return P.combine_review_text(fx.reviews_labelled(spark, sf_dir, spread=True)).select(
        "review_id", "normalized_combined_text"
    )


def _dedup_sql(keys):
    return f"""select review_id, review_text, rating from (select *, row_number() over (
        partition by {keys} order by review_id) as n from reviews_labelled) q where n = 1"""


@query(
    "t02_normalized_dedup",
    sql_over(
        "reviews_labelled",
        body=f"""select true as with_rating, * from ({_dedup_sql('review_text, rating')}) a
        union all select false, * from ({_dedup_sql('review_text')}) b""",
    ),
)
def normalized_dedup(spark, sf_dir):
    reviews = fx.reviews_labelled(spark, sf_dir).select("review_id", "review_text", "rating")
    parts = [
        P.drop_normalised_duplicates(reviews, text="review_text", include_rating=flag).select(
            F.lit(flag).alias("with_rating"), "review_id", "review_text", "rating"
        )
        for flag in (True, False)
    ]
    return parts[0].unionByName(parts[1])


@query(
    "t03_classical_clean",
    sql_over(
        "reviews_labelled",
        body=f"select review_id, {T.classical_clean('review_text')} as cleaned from reviews_labelled",
    ),
)
def classical_clean(spark, sf_dir):
    reviews = fx.reviews_labelled(spark, sf_dir, spread=True)
    return reviews.select("review_id", X.classical_clean(F.col("review_text")).alias("cleaned"))


@query(
    "t04_tokens",
    sql_over(
        "reviews_labelled",
        body=f"""select token, count(*) as occurrences from (
        select unnest({T.tokens(T.classical_clean('review_text'))}) as token from reviews_labelled) q
        group by token""",
    ),
)
def tokens(spark, sf_dir):
    words = X.tokens(X.classical_clean(F.col("review_text")))
    exploded = fx.reviews_labelled(spark, sf_dir, spread=True).select(F.explode(words).alias("token"))
    return exploded.groupBy("token").agg(F.count(F.lit(1)).alias("occurrences"))


@query(
    "t05_stopwords",
    sql_over(
        "reviews_labelled",
        body=f"""select review_id, array_to_string({T.sentiment_filtered('review_text')}, ' ') as kept
        from reviews_labelled""",
    ),
)
def stopwords(spark, sf_dir):
    words = X.tokens(X.classical_clean(F.col("review_text")))
    kept = X.drop_words(words, X.sentiment_stop_words(), min_length=2)
    return fx.reviews_labelled(spark, sf_dir, spread=True).select("review_id", F.array_join(kept, " ").alias("kept"))


@query(
    "t06_lemmas",
    sql_over(
        "reviews_labelled",
        body=f"select review_id, {T.classical_text('review_text')} as classical_text from reviews_labelled",
    ),
)
def lemmas(spark, sf_dir):
    reviews = fx.reviews_labelled(spark, sf_dir, spread=True)
    return reviews.select("review_id", X.classical_text(F.col("review_text")).alias("classical_text"))


# A dictionary from the tokens themselves: every other one by length loses its last letter.
@query(
    "t06b_dictionary_lemmas",
    sql_over(
        "reviews_labelled",
        (
            "words",
            f"""select review_id, generate_subscripts(w, 1) as pos, unnest(w) as token from (
          select review_id, {T.tokens(T.classical_clean('review_text'))} as w from reviews_labelled) q""",
        ),
        body="""select review_id, string_agg(case when length(token) % 2 = 0 and length(token) > 2
        then left(token, length(token) - 1) else token end, ' ' order by pos) as lemmas from words group by 1""",
    ),
)
def dictionary_lemmas(spark, sf_dir):
    reviews = fx.reviews_labelled(spark, sf_dir, spread=True)
    texts = reviews.select(
        "review_id", X.tokens(X.classical_clean(F.col("review_text"))).alias("w")
    ).where(F.size("w") > 0)
    tokens = texts.select(F.explode("w").alias("token")).distinct()
    dictionary = tokens.where("length(token) % 2 = 0 and length(token) > 2").select(
        "token", F.expr("left(token, length(token) - 1)").alias("lemma")
    )
    plain = texts.select("review_id", F.array_join("w", " ").alias("lemmas"))
    return P.lemmatise_with_dictionary(plain, dictionary, column="lemmas")


FEATURES_SQL = f"""select review_id, rating, normalized_combined_text,
  normalized_combined_text as transformer_text,
  {T.classical_text('normalized_combined_text')} as classical_text from (
  select *, row_number() over (partition by normalized_combined_text, rating order by review_id) as n
  from (select review_id, rating, {COMBINED} as normalized_combined_text from reviews_labelled) a
  where length(normalized_combined_text) > 0) b where n = 1"""


@query("t07_text_features", sql_over("reviews_labelled", body=FEATURES_SQL))
def text_features(spark, sf_dir):
    reviews = fx.reviews_labelled(spark, sf_dir, spread=True).select("review_id", "review_title", "review_text", "rating")
    return P.model_text_features(reviews).select(
        "review_id", "rating", "normalized_combined_text", "transformer_text", "classical_text"
    )


@query(
    "t08_feature_violations",
    sql_over(
        "reviews_raw",
        body="""select 'branches_differ' as rule, count(*) as violations from reviews_raw
          where review_title is distinct from review_text
        union all select 'empty_normalized', count(*) from reviews_raw where coalesce(review_text, '') = ''
        union all select 'empty_transformer', count(*) from reviews_raw where coalesce(review_title, '') = ''
        union all select 'missing_classical', count(*) from reviews_raw where review_text is null""",
    ),
)
def feature_violations(spark, sf_dir):
    raw = fx.reviews_raw(spark, sf_dir)
    return P.feature_violations(
        raw.select(
            F.col("review_text").alias("normalized_combined_text"),
            F.col("review_title").alias("transformer_text"),
            F.col("review_text").alias("classical_text"),
        )
    )


@query(
    "t09_low_content",
    sql_over(
        "reviews_raw",
        body=f"""select review_id, clean_text from (
        select review_id, {T.classical_clean("coalesce(review_text, '')")} as clean_text
        from reviews_raw) q
        where len(list_filter(regexp_split_to_array(lower(clean_text), '\\s+'),
          lambda t: t <> '' and not list_contains({T.word_list(X.topic_stop_words())}, t))) >= 3""",
    ),
)
def low_content(spark, sf_dir):
    cleaned = fx.reviews_raw(spark, sf_dir).select(
        "review_id",
        X.classical_clean(F.coalesce("review_text", F.lit(""))).alias("clean_text"),
    )
    return P.drop_low_content(cleaned, "clean_text")


@query(
    "t10_stop_word_set",
    sql_over(
        "reviews_labelled",
        body=f"""select word, count(occ) as occurrences from (
        select unnest({T.word_list(X.topic_stop_words(['Brand', 'the']))}) as word) w
        left join (select unnest({T.tokens(T.classical_clean('review_text'))}) as token, 1 as occ
        from reviews_labelled) q on q.token = w.word group by word""",
    ),
)
def stop_word_set(spark, sf_dir):
    """The stop-word table with how often each word occurs in the reviews."""
    stops = P.stop_word_table(spark, extra=["Brand", "the"])
    counted = tokens(spark, sf_dir)
    return F.broadcast(stops).join(counted, stops.word == counted.token, "left").select(
        "word", F.coalesce("occurrences", F.lit(0)).cast("bigint").alias("occurrences")
    )


@query(
    "t11_model_input",
    sql_over(
        "reviews_raw",
        body=f"""select review_id, {T.strip('review_text')} as classical_text, label as sentiment_label from (
        select review_id, review_text, case when rating_raw in ('1','2','2.5') then 'negative'
        when rating_raw = '3' then 'neutral' when rating_raw in ('4','5') then 'positive'
        when rating_raw = 'x' then 'unreadable' end as label from reviews_raw) q
        where review_text is not null and length({T.strip('review_text')}) > 0
        and label in ('negative','neutral','positive')""",
    ),
)
def model_input(spark, sf_dir):
    rating = F.col("rating_raw")
    named = fx.reviews_raw(spark, sf_dir).select(
        "review_id",
        F.col("review_text").alias("classical_text"),
        F.when(rating.isin("1", "2", "2.5"), "negative")
        .when(rating == "3", "neutral")
        .when(rating.isin("4", "5"), "positive")
        .when(rating == "x", "unreadable")
        .alias("sentiment_label"),
    )
    return P.model_input(named)
