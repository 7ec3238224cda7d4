"""I and L8, L9: topic insight queries."""

from pyspark.sql import functions as F

from reviewloom import settings as S
from reviewloom.catalog import sqltext as T
from reviewloom.catalog.registry import query
from reviewloom.operators import insights as I
from reviewloom.plans import fixtures as fx
from reviewloom.plans.fixtures import sql_over

BASE = (
    "base",
    """select cluster_id, topic_name, count(*) as review_count,
  count(*) filter (where predicted_sentiment = 'negative') as negative,
  count(*) filter (where predicted_sentiment = 'neutral') as neutral,
  count(*) filter (where predicted_sentiment = 'positive') as positive,
  avg(rating) * count(rating) as rating_sum, count(rating) as rating_count
  from clustered group by 1, 2""",
)
RATES = (
    "rates",
    """select *, negative / review_count as negative_rate, neutral / review_count as neutral_rate,
  positive / review_count as positive_rate, review_count / sum(review_count) over () as share
  from base""",
)


def pct(x: str) -> str:
    return f"printf('%.1f', round({x} * 100, 1))"


NARRATIVE = f"""topic_name || ' contains ' || format('{{:,}}', review_count) || ' reviews, representing '
  || {pct('share')} || '% of the analysed dataset. ' || case
  when negative_rate >= 0.6 then 'Customer feedback is predominantly negative (' || {pct('negative_rate')}
    || '%), making this a high-priority improvement area.'
  when negative_rate >= 0.35 then 'Negative feedback is material (' || {pct('negative_rate')}
    || '%) and should be reviewed alongside the positive experiences.'
  when positive_rate >= 0.6 then 'Customer feedback is strongly positive (' || {pct('positive_rate')}
    || '%), indicating a clear product strength.'
  else 'Feedback is mixed: ' || {pct('positive_rate')} || '% positive, ' || {pct('neutral_rate')}
    || '% neutral, and ' || {pct('negative_rate')} || '% negative.' end"""
DOMINANT = """case when positive_rate >= neutral_rate and positive_rate >= negative_rate then 'positive'
  when neutral_rate >= negative_rate then 'neutral' else 'negative' end"""
HEALTH = """case when negative_rate >= 0.6 then 'critical' when negative_rate >= 0.35 then 'needs_attention'
  when positive_rate >= 0.6 and negative_rate < 0.15 then 'strong' else 'mixed' end"""
FACTS = (
    "facts",
    f"""select cluster_id as topic_id, topic_name, review_count, round(share, 4) as review_share,
  round(share * 100, 1) as review_share_percent, {DOMINANT} as dominant, {HEALTH} as health,
  positive as positive_count, neutral as neutral_count, negative as negative_count,
  round(positive_rate, 4) as positive_rate, round(neutral_rate, 4) as neutral_rate,
  round(negative_rate, 4) as negative_rate, round(positive_rate * 100, 1) as positive_percent,
  round(neutral_rate * 100, 1) as neutral_percent, round(negative_rate * 100, 1) as negative_percent,
  {NARRATIVE} as summary from rates""",
)
REPRESENTATIVES = (
    "picked",
    f"""select cluster_id, predicted_sentiment, position, review_id, txt as review_text from (
  select *, row_number() over (partition by cluster_id, predicted_sentiment
    order by length(txt) desc, review_id) as position
  from (select cluster_id, predicted_sentiment, {T.strip('review_text')} as txt, min(review_id) as review_id
    from clustered where length({T.strip('review_text')}) > 0 group by 1, 2, 3) a) b where position <= 3""",
)


def over_clustered(*parts, body):
    return sql_over("clustered", *parts, body=body)


def rounded(df, *names):
    return df.withColumns({n: F.round(n, 6) for n in names})


def base(spark, sf_dir):
    return I.topic_base(fx.clustered(spark, sf_dir))


DIRTY_SQL = """select review_id, '  ' || review_text || ' ' as review_text,
  cast(cluster_id as varchar) as cluster_id,
  case when review_id % 11 = 0 then null when review_id % 13 = 0 then '   '
    else ' ' || topic_name end as topic_name,
  case when review_id % 3 = 0 then 'LABEL_' || case sentiment_label when 'negative' then '0'
    when 'neutral' then '1' else '2' end
    when review_id % 3 = 1 then ' ' || upper(sentiment_label) else case sentiment_label
    when 'negative' then '0' when 'neutral' then '1' else '2' end end as sentiment_label
  from clustered"""
ALIAS_SQL = """case lower(trim({0})) when 'label_0' then 'negative' when 'label_1' then 'neutral'
  when 'label_2' then 'positive' when '0' then 'negative' when '1' then 'neutral'
  when '2' then 'positive' else lower(trim({0})) end"""
NORMALISED_SQL = f"""select review_id, {T.strip('review_text')} as review_text, cast(cluster_id as int) as cluster_id,
  coalesce(nullif(trim(topic_name), ''), 'General / uncategorized') as topic_name,
  {ALIAS_SQL.format('sentiment_label')} as predicted_sentiment from dirty"""


def dirty(spark, sf_dir):
    rid, label = F.col("review_id"), F.col("sentiment_label")
    number = F.when(label == "negative", "0").when(label == "neutral", "1").otherwise("2")
    return fx.clustered(spark, sf_dir).select(
        "review_id",
        F.concat(F.lit("  "), "review_text", F.lit(" ")).alias("review_text"),
        F.col("cluster_id").cast("string").alias("cluster_id"),
        F.when(rid % 11 == 0, None)
        .when(rid % 13 == 0, "   ")
        .otherwise(F.concat(F.lit(" "), "topic_name"))
        .alias("topic_name"),
        F.when(rid % 3 == 0, F.concat(F.lit("LABEL_"), number))
        .when(rid % 3 == 1, F.concat(F.lit(" "), F.upper(label)))
        .otherwise(number)
        .alias("sentiment_label"),
    )


@query("i01_normalise", over_clustered(("dirty", DIRTY_SQL), body=NORMALISED_SQL))
def normalise(spark, sf_dir):
    return I.normalise_reviews(dirty(spark, sf_dir))


@query(
    "i02_sentiment_alias",
    over_clustered(
        ("dirty", DIRTY_SQL),
        body=f"""select sentiment_label as raw, {ALIAS_SQL.format('sentiment_label')} as label,
        count(*) as row_count from dirty group by 1, 2""",
    ),
)
def alias(spark, sf_dir):
    named = dirty(spark, sf_dir).select(
        F.col("sentiment_label").alias("raw"), I.sentiment_alias(F.col("sentiment_label")).alias("label")
    )
    return named.groupBy("raw", "label").agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "i03_resolve_column",
    over_clustered(body="select 'predicted_sentiment' as resolved, count(*) as row_count from clustered"),
)
def resolve(spark, sf_dir):
    reviews = fx.clustered(spark, sf_dir)
    return reviews.agg(
        F.lit(I.resolve_sentiment_column(reviews.columns)).alias("resolved"),
        F.count(F.lit(1)).alias("row_count"),
    )


@query(
    "i04_violations",
    over_clustered(
        body="""select 'empty_table' as rule, cast(case when count(*) = 0 then 1 else 0 end as bigint)
          as violations from clustered
        union all select 'no_usable_text', cast(case when count(*) > 0 and
          count(*) filter (where length(review_text) > 0) = 0 then 1 else 0 end as bigint) from clustered
        union all select 'unknown_label', count(*) filter (where rating = 2 or rating = 4) from clustered"""
    ),
)
def violations(spark, sf_dir):
    odd = F.when(F.col("rating") == 2, "unsure").when(F.col("rating") == 4, None)
    reviews = fx.clustered(spark, sf_dir)
    return I.insight_violations(
        reviews.withColumn(
            "predicted_sentiment",
            F.when(F.col("rating").isin(2, 4), odd).otherwise(F.col("predicted_sentiment")),
        )
    )


@query(
    "i05_topics",
    over_clustered(
        BASE,
        body="""select cluster_id, topic_name, review_count,
        round(review_count / sum(review_count) over (), 6) as review_share from base""",
    ),
)
def topics(spark, sf_dir):
    return rounded(I.topics(base(spark, sf_dir)), "review_share")


@query(
    "i06_topic_reviews",
    over_clustered(
        body="""select 'all of one id' as selection, review_id, review_text from clustered where cluster_id = 2
        union all select * from (select 'first by name', review_id, review_text from clustered
        where topic_name = 'Kindle reading' order by review_id limit 25) q"""
    ),
)
def topic_reviews(spark, sf_dir):
    reviews = fx.clustered(spark, sf_dir)
    whole = I.topic_reviews(reviews, 2).select(
        F.lit("all of one id").alias("selection"), "review_id", "review_text"
    )
    first = I.topic_reviews(reviews, "Kindle reading", limit=25).select(
        F.lit("first by name").alias("selection"), "review_id", "review_text"
    )
    return whole.unionByName(first)


@query(
    "i07_sentiment_distribution",
    over_clustered(
        ("counts", "select predicted_sentiment as s, count(*) as n from clustered group by 1"),
        (
            "topic_counts",
            "select predicted_sentiment as s, count(*) as n from clustered where cluster_id = 5 group by 1",
        ),
        body=f"""select 'all' as scope, label as sentiment, coalesce(n, 0) as review_count,
        round(coalesce(n, 0) / sum(n) over (), 6) as review_share from {T.labels_table()}
        left join counts on s = label
        union all select 'topic 5', label, coalesce(n, 0),
        round(coalesce(n, 0) / sum(n) over (), 6) from {T.labels_table()}
        left join topic_counts on s = label""",
    ),
)
def sentiment_distribution(spark, sf_dir):
    reviews = fx.clustered(spark, sf_dir)
    both = I.sentiment_distribution(reviews).withColumn("scope", F.lit("all")).unionByName(
        I.sentiment_distribution(reviews, topic=5).withColumn("scope", F.lit("topic 5"))
    )
    return rounded(both, "review_share")


@query(
    "i08_topic_sentiment",
    over_clustered(
        BASE,
        RATES,
        body="""select cluster_id, topic_name, negative, neutral, positive, review_count,
        round(negative_rate, 6) as negative_rate, round(neutral_rate, 6) as neutral_rate,
        round(positive_rate, 6) as positive_rate from rates""",
    ),
)
def topic_sentiment(spark, sf_dir):
    rated = I.topic_sentiment(base(spark, sf_dir))
    return rounded(rated, *[f"{v}_rate" for v in S.SENTIMENT_LABELS])


@query("i09_representatives", over_clustered(REPRESENTATIVES, body="select * from picked"))
def representatives(spark, sf_dir):
    return I.representative_reviews(fx.clustered(spark, sf_dir), limit=3)


OVERVIEW = (
    "overview_",
    """select cast(sum(review_count) as bigint) as total_reviews, count(distinct cluster_id) as total_topics,
  cast(sum(negative) as bigint) as negative_reviews, cast(sum(neutral) as bigint) as neutral_reviews,
  cast(sum(positive) as bigint) as positive_reviews, sum(negative) / sum(review_count) as negative_rate,
  sum(neutral) / sum(review_count) as neutral_rate, sum(positive) / sum(review_count) as positive_rate,
  sum(rating_sum) / sum(rating_count) as average_rating from base""",
)


@query(
    "i10_overview",
    over_clustered(
        BASE,
        OVERVIEW,
        body="""select * replace (round(negative_rate, 6) as negative_rate,
        round(neutral_rate, 6) as neutral_rate, round(positive_rate, 6) as positive_rate,
        round(average_rating, 6) as average_rating) from overview_""",
    ),
)
def overview(spark, sf_dir):
    rates = [f"{v}_rate" for v in S.SENTIMENT_LABELS]
    return rounded(I.overview(base(spark, sf_dir)), *rates, "average_rating")


def _from_facts(*names):
    def run(spark, sf_dir):
        return I.topic_facts(base(spark, sf_dir)).select("topic_id", *names)

    return run


for _key, _name in (
    ("i11_dominant", "dominant"),
    ("i12_health", "health"),
    ("i13_narrative", "summary"),
):
    query(_key, over_clustered(BASE, RATES, FACTS, body=f"select topic_id, {_name} from facts"))(
        _from_facts(_name)
    )

FLAT = (
    "topic_name",
    "review_count",
    "review_share",
    "review_share_percent",
    "dominant",
    "health",
    *[f"{v}_{k}" for k in ("count", "rate", "percent") for v in ("positive", "neutral", "negative")],
    "summary",
)


def flat_summary(df):
    nested = [c for c in FLAT if c not in df.columns]
    return df.select(
        "topic_id",
        *[c for c in FLAT if c in df.columns],
        *[F.col(f"sentiment.{c}").alias(c) for c in nested],
        *[
            F.array_join(f"representative_reviews.{v}", " || ").alias(f"{v}_examples")
            for v in ("positive", "negative")
        ],
    )


def summaries_sql(where=""):
    def examples(v):
        return f"""coalesce((select string_agg(review_text, ' || ' order by position) from picked
        where picked.cluster_id = facts.topic_id and predicted_sentiment = '{v}'), '') as {v}_examples"""

    return over_clustered(
        BASE,
        RATES,
        FACTS,
        REPRESENTATIVES,
        body=f"""select topic_id, {', '.join(FLAT)}, {examples('positive')}, {examples('negative')}
        from facts {where}""",
    )


@query("i14_topic_summary", summaries_sql("where topic_name = 'Echo speakers'"))
def topic_summary(spark, sf_dir):
    return flat_summary(I.topic_summary(fx.clustered(spark, sf_dir), "Echo speakers"))


@query("i15_topic_summaries", summaries_sql())
def topic_summaries(spark, sf_dir):
    return flat_summary(I.topic_summaries(fx.clustered(spark, sf_dir)))


SUMMARY_CTES = (
    BASE,
    RATES,
    FACTS,
    OVERVIEW,
    (
        "extremes",
        """select max_by(topic_id, (review_count, -topic_id)) as largest_id,
      max_by(topic_name, (review_count, -topic_id)) as largest_name,
      max_by(review_count, (review_count, -topic_id)) as largest_reviews,
      max_by(review_share_percent, (review_count, -topic_id)) as largest_share,
      max_by(topic_name, (negative_rate, review_count, -topic_id)) as negative_name,
      max_by(negative_percent, (negative_rate, review_count, -topic_id)) as negative_topic_percent,
      max_by(topic_name, (positive_rate, review_count, -topic_id)) as positive_name,
      max_by(positive_percent, (positive_rate, review_count, -topic_id)) as positive_topic_percent
      from facts""",
    ),
    (
        "summary_",
        f"""select *, round(positive_rate * 100, 1) as positive_percentage,
      round(neutral_rate * 100, 1) as neutral_percentage,
      round(negative_rate * 100, 1) as negative_percentage,
      case when positive_rate >= neutral_rate and positive_rate >= negative_rate then 'Positive'
        when neutral_rate >= negative_rate then 'Neutral' else 'Negative' end as overall_sentiment,
      '{S.REPORT_BRAND} analysed ' || format('{{:,}}', total_reviews) || ' reviews across '
        || total_topics || ' topics. Overall sentiment is ' || {pct('positive_rate')} || '% positive, '
        || {pct('neutral_rate')} || '% neutral, and ' || {pct('negative_rate')} || '% negative. '
        || largest_name || ' is the largest topic, while ' || negative_name
        || ' has the highest negative sentiment rate.' as summary
      from overview_ cross join extremes""",
    ),
)


@query(
    "i16_overview_summary",
    over_clustered(
        *SUMMARY_CTES,
        body="""select total_reviews, total_topics, positive_percentage, neutral_percentage,
        negative_percentage, overall_sentiment, summary, largest_id, largest_name, largest_reviews,
        largest_share, negative_name, negative_topic_percent, positive_name, positive_topic_percent,
        round(average_rating, 2) as average_rating from summary_""",
    ),
)
def overview_summary(spark, sf_dir):
    return I.overview_summary(base(spark, sf_dir)).select(
        "total_reviews",
        "total_topics",
        "positive_percentage",
        "neutral_percentage",
        "negative_percentage",
        "overall_sentiment",
        "summary",
        "average_rating",
        F.col("largest_topic.topic_id").alias("largest_id"),
        F.col("largest_topic.topic_name").alias("largest_name"),
        F.col("largest_topic.review_count").alias("largest_reviews"),
        F.col("largest_topic.review_share_percent").alias("largest_share"),
        F.col("most_negative_topic.topic_name").alias("negative_name"),
        F.col("most_negative_topic.negative_percent").alias("negative_topic_percent"),
        F.col("most_positive_topic.topic_name").alias("positive_name"),
        F.col("most_positive_topic.positive_percent").alias("positive_topic_percent"),
    )


HOOKS_SQL = """select topic_name as topic, reviews, positive_pct, neutral_pct, negative_pct, case
  when negative_pct = max(negative_pct) over () and max(negative_pct) over () > 0
    then 'Highest complaint rate (' || printf('%.0f', round(negative_pct, 0))
      || '% negative) — lead the article with the recurring problems.'
  when positive_pct >= 95 then 'Strongly liked (' || printf('%.0f', round(positive_pct, 0))
      || '% positive) — frame as a confident recommendation.'
  else 'Mixed reception (' || printf('%.0f', round(positive_pct, 0)) || '% positive / '
      || printf('%.0f', round(negative_pct, 0)) || '% negative) — contrast best vs worst picks.' end as hook
  from (select topic_name, count(*) as reviews,
    round(count(*) filter (where predicted_sentiment = 'positive') / count(*) * 100, 2) as positive_pct,
    round(count(*) filter (where predicted_sentiment = 'neutral') / count(*) * 100, 2) as neutral_pct,
    round(count(*) filter (where predicted_sentiment = 'negative') / count(*) * 100, 2) as negative_pct
    from clustered group by 1) q"""


@query("l08_sentiment_hooks", over_clustered(body=HOOKS_SQL))
def hooks(spark, sf_dir):
    return I.sentiment_hooks(fx.clustered(spark, sf_dir))


@query(
    "l09_topic_sentiment",
    over_clustered(
        body="""select topic_name, sentiment_label, count(*) as review_count,
        cast(sum(count(*)) over (partition by topic_name) as bigint) as topic_review_count,
        round(count(*) / sum(count(*)) over (partition by topic_name) * 100, 2) as sentiment_percentage
        from clustered group by 1, 2"""
    ),
)
def topic_shares(spark, sf_dir):
    return I.topic_sentiment_shares(fx.clustered(spark, sf_dir))
