"""Q: report tables and artifact look-ups."""

from pyspark.sql import functions as F

from reviewloom import settings as S
from reviewloom.catalog import insights as IQ
from reviewloom.catalog.insights import FLAT, SUMMARY_CTES, over_clustered, pct
from reviewloom.catalog.recommendations import BUILT, METRICS, RANKED, ranked
from reviewloom.catalog.registry import query
from reviewloom.functions.numbers import format_percentage
from reviewloom.operators import insights as I
from reviewloom.operators import recommendations as R
from reviewloom.operators import reports as P
from reviewloom.plans import fixtures as fx
from reviewloom.plans.shapes import stored

GENERATED_AT = "2024-01-31T00:00:00"
CTES = (*SUMMARY_CTES, METRICS, BUILT, RANKED)
BY_VOLUME = "row_number() over (order by review_count desc, topic_id)"


def facts(spark, sf_dir):
    return I.topic_facts(IQ.base(spark, sf_dir))


def overview(spark, sf_dir):
    return I.overview_summary(IQ.base(spark, sf_dir))


EXECUTIVE_SQL = f"""'{S.REPORT_BRAND} analysed ' || format('{{:,}}', total_reviews)
  || ' customer reviews covering ' || total_topics || ' major product topics. The overall customer sentiment is '
  || lower(overall_sentiment) || ', with ' || {pct('positive_rate')} || '% positive reviews and '
  || {pct('negative_rate')} || '% negative reviews. The dashboard highlights the most important product areas '
  || 'requiring business attention.'"""


@query("q01_exec_summary", over_clustered(*SUMMARY_CTES, body=f"select {EXECUTIVE_SQL} as executive_summary from summary_"))
def exec_summary(spark, sf_dir):
    return P.executive_summary(overview(spark, sf_dir))


FINDINGS_SQL = f"""select cast({BY_VOLUME} as int) as position, topic_name || ' contains '
  || format('{{:,}}', review_count) || ' reviews with ' || printf('%.1f', positive_percent)
  || '% positive sentiment.' as finding from facts"""
RISKS_SQL = "select rank as position, topic || ': ' || recommendation as risk from ranked where priority = 'High'"
OPPORTUNITIES_SQL = f"""select position, 'Customers consistently report positive experiences with ' || topic_name
  || '. This area can be highlighted in marketing and customer-success initiatives.' as opportunity
  from (select cast({BY_VOLUME} as int) as position, * from facts) q where positive_rate >= 0.7"""


@query("q02_key_findings", over_clustered(*CTES, body=FINDINGS_SQL))
def key_findings(spark, sf_dir):
    return P.key_findings(facts(spark, sf_dir))


@query("q03_risks", over_clustered(*CTES, body=RISKS_SQL))
def risks(spark, sf_dir):
    return P.business_risks(ranked(spark, sf_dir))


@query(
    "q04_opportunities",
    over_clustered(
        *CTES,
        body=f"""select 0.7::double as minimum, * from ({OPPORTUNITIES_SQL}) a
        union all select 0.3, * from ({OPPORTUNITIES_SQL.replace('>= 0.7', '>= 0.3')}) b""",
    ),
)
def opportunities(spark, sf_dir):
    """At the default bar and at a lower one that some topics reach."""
    rated = facts(spark, sf_dir)
    parts = [
        P.business_opportunities(rated, bar).withColumn("minimum", F.lit(bar))
        for bar in (S.OPPORTUNITY_POSITIVE, 0.3)
    ]
    return parts[0].unionByName(parts[1])


METRICS_SQL = f"""select '{GENERATED_AT}' as generated_at, total_reviews as reviews, total_topics as topics,
  positive_percentage as positive, negative_percentage as negative, neutral_percentage as neutral,
  (select count(*) from ranked) as recommendations,
  (select count(*) from ranked where priority = 'High') as high_priority from summary_"""


@query("q05_report_metrics", over_clustered(*CTES, body=METRICS_SQL))
def report_metrics(spark, sf_dir):
    counted = stored(IQ.base(spark, sf_dir))
    recommendations = R.ranked(R.metrics_from_base(counted))
    return P.report_metrics(
        I.topic_facts(counted), recommendations, GENERATED_AT, I.overview_summary(counted)
    )


def report_inputs(spark, sf_dir):
    """The four small tables every report form is made of, from one pass over the reviews."""
    reviews = fx.clustered(spark, sf_dir)
    counted = stored(I.topic_base(reviews))
    return (
        stored(I.topic_summaries(reviews, base=counted)),
        stored(I.topic_facts(counted)),
        stored(R.ranked(R.metrics_from_base(counted))),
        stored(I.overview_summary(counted)),
    )


@query("q06_report")
def report(spark, sf_dir):
    payload = P.report_payload(*report_inputs(spark, sf_dir), GENERATED_AT)
    return payload.select(F.to_json(F.struct("*")).alias("report"))


@query(
    "q06b_report_facts",
    over_clustered(
        *CTES,
        body=f"""select '{GENERATED_AT}' as generated_at, total_reviews as reviews, total_topics as topics,
        total_topics as topic_records, (select count(*) from ranked) as recommendations, true as largest_first
        from summary_""",
    ),
)
def report_facts(spark, sf_dir):
    """What the nested report says of itself, read back from its JSON."""
    whole = report(spark, sf_dir)
    record = "struct<review_count:bigint,topic_id:int>"
    parsed = F.from_json(
        "report",
        "generated_at string, metrics struct<reviews:bigint,topics:bigint>, "
        f"topics array<{record}>, recommendations array<struct<rank:int>>",
    )
    counts = F.transform("r.topics", lambda t: t["review_count"])
    return whole.select(parsed.alias("r")).select(
        "r.generated_at",
        "r.metrics.reviews",
        "r.metrics.topics",
        F.size("r.topics").cast("bigint").alias("topic_records"),
        F.size("r.recommendations").cast("bigint").alias("recommendations"),
        (counts == F.sort_array(counts, asc=False)).alias("largest_first"),
    )


@query(
    "q07_percent",
    over_clustered(
        IQ.BASE,
        IQ.RATES,
        body=f"""select cluster_id, {pct('negative_rate')} || '%' as from_ratio,
        printf('%.1f', round(share * 100, 1)) || '%' as from_percent from rates""",
    ),
)
def percent_text(spark, sf_dir):
    counted = IQ.base(spark, sf_dir)
    rated = I.topic_sentiment(counted).join(I.topics(counted).select("cluster_id", "review_share"), "cluster_id")
    return rated.select(
        "cluster_id",
        format_percentage(F.col("negative_rate"), "ratio").alias("from_ratio"),
        format_percentage(F.round(F.col("review_share") * 100, 1), "percent").alias("from_percent"),
    )


def _bullets(section, title, source, column, empty):
    return f"""select {section} as s, 0 as i, unnest([1, 2]) as p, unnest(['## {title}', '']) as line
  union all select {section}, position, 1, '- ' || {column} from {source}
  union all select {section}, 2000000000, 1, '{empty}' where (select count(*) from {source}) = 0
  union all select {section}, 2000000000, 2, ''"""


def _examples(label):
    rows = f"""select '- ' || review_text from picked where picked.cluster_id = t.topic_id
      and predicted_sentiment = '{label}' order by position"""
    return f"""case when (select count(*) from picked where picked.cluster_id = t.topic_id
      and predicted_sentiment = '{label}') > 0 then list_concat(
      ['**Representative {label} reviews**', ''], array({rows}), ['']) else [] end"""


LINES_SQL = f"""select cast(row_number() over (order by s, i, p) as int) as line_no, line from (
  select 0 as s, 0 as i, unnest(range(19)) as p, unnest([
    '# {S.REPORT_BRAND} Executive Review Report', '', '_Generated at: ' || generated_at || '_', '',
    '## Executive Summary', '', (select {EXECUTIVE_SQL} from summary_), '', '## Dataset Overview', '',
    '- Total reviews: ' || format('{{:,}}', reviews), '- Total topics: ' || topics,
    '- Overall sentiment: ' || (select overall_sentiment from summary_),
    '- Positive sentiment: ' || printf('%.1f', positive) || '%',
    '- Negative sentiment: ' || printf('%.1f', negative) || '%',
    '- Neutral sentiment: ' || printf('%.1f', neutral) || '%',
    '- Total recommendations: ' || recommendations, '- High-priority recommendations: ' || high_priority, ''
  ]) as line from metrics_
  union all {_bullets(1, 'Key Findings', 'findings', 'finding', 'No key findings were generated.')}
  union all {_bullets(2, 'Business Risks', 'risks', 'risk', 'No high-priority business risks were detected.')}
  union all {_bullets(3, 'Business Opportunities', 'opportunities', 'opportunity',
                      'No strong positive opportunities were detected.')}
  union all select 4, 0, unnest([1, 2]), unnest(['## Topic Analysis', ''])
  union all select 4, position, unnest(range(len(lines))), unnest(lines) from (
    select {BY_VOLUME} as position, list_concat([
      '### ' || topic_name, '', '- Topic ID: ' || topic_id, '- Reviews: ' || format('{{:,}}', review_count),
      '- Review share: ' || printf('%.1f', review_share_percent) || '%',
      '- Positive sentiment: ' || printf('%.1f', positive_percent) || '%',
      '- Neutral sentiment: ' || printf('%.1f', neutral_percent) || '%',
      '- Negative sentiment: ' || printf('%.1f', negative_percent) || '%',
      '- Dominant sentiment: ' || dominant, '- Sentiment health: ' || health, '', summary, ''],
      {_examples('positive')}, {_examples('negative')}) as lines from facts t) topics_
  union all select 5, 0, unnest([1, 2]), unnest(['## Recommendations', ''])
  union all select 5, rank, unnest(range(12)), unnest([
    '### ' || rank || '. ' || topic, '', '- Priority: ' || priority,
    '- Severity score: ' || printf('%.1f', severity), '- Topic size: ' || format('{{:,}}', topic_size),
    '- Positive sentiment: ' || {pct('positive_ratio')} || '%',
    '- Negative sentiment: ' || {pct('negative_ratio')} || '%', '',
    '**Recommendation:** ' || recommendation, '', '**Rationale:** ' || rationale, '']) from ranked
) all_lines"""


@query(
    "q08_report_lines",
    over_clustered(
        *CTES,
        IQ.REPRESENTATIVES,
        ("metrics_", METRICS_SQL),
        ("findings", FINDINGS_SQL),
        ("risks", RISKS_SQL),
        ("opportunities", OPPORTUNITIES_SQL),
        body=LINES_SQL,
    ),
)
def report_lines(spark, sf_dir):
    return P.report_lines(*report_inputs(spark, sf_dir), GENERATED_AT)


@query("q10_topic_lookup", over_clustered(*SUMMARY_CTES, body=f"select topic_id, {', '.join(FLAT)} from facts where topic_id = 4"))
def topic_lookup(spark, sf_dir):
    return P.by_id(facts(spark, sf_dir), "4").select("topic_id", *FLAT)


@query(
    "q11_topic_search",
    over_clustered(
        *SUMMARY_CTES,
        body="""select topic_id, topic_name from facts
        where contains(lower(topic_name || ' ' || summary || ' ' || health), 'material')""",
    ),
)
def topic_search(spark, sf_dir):
    return P.search_topics(facts(spark, sf_dir), "  MATERIAL ").select("topic_id", "topic_name")


@query("q12_recommendation_lookup", over_clustered(*CTES, body="select * from ranked where topic_id = 2"))
def recommendation_lookup(spark, sf_dir):
    return P.by_id(ranked(spark, sf_dir), 2)


@query("q13_by_priority", over_clustered(*CTES, body="select * from ranked where priority = 'Medium'"))
def by_priority(spark, sf_dir):
    return P.by_priority(ranked(spark, sf_dir), " medium ")


@query(
    "q14_defensive_top",
    over_clustered(
        *CTES,
        body="""select topic_id, rank_text as rank, severity from (select *,
        case when topic_id in (1, 4) then 'n/a' else cast(rank as varchar) end as rank_text from ranked) q
        order by coalesce(try_cast(rank_text as int), 1000000000), severity desc, topic_id limit 5""",
    ),
)
def defensive_top(spark, sf_dir):
    damaged = ranked(spark, sf_dir).withColumn(
        "rank", F.when(F.col("topic_id").isin(1, 4), "n/a").otherwise(F.col("rank").cast("string"))
    )
    return P.defensive_top(damaged, 5).select("topic_id", "rank", "severity")


@query(
    "q15_payload_sections",
    over_clustered(
        *CTES,
        body="""select 'object' as shape, * from ranked union all select 'list', * from ranked""",
    ),
)
def payload_sections(spark, sf_dir):
    payload = R.payload(ranked(spark, sf_dir))
    shapes = {"object": F.to_json(F.struct("*")), "list": F.to_json("recommendations")}
    out = None
    for name, text in shapes.items():
        rows = P.recommendation_rows(payload.select(text.alias("payload"))).withColumn("shape", F.lit(name))
        out = rows if out is None else out.unionByName(rows)
    return out
