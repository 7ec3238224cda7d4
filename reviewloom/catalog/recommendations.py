"""R: recommendation queries."""

from pyspark.sql import functions as F

from reviewloom import settings as S
from reviewloom.catalog.insights import BASE, RATES, base, over_clustered, rounded
from reviewloom.catalog.registry import query
from reviewloom.catalog.sqltext import quoted
from reviewloom.operators import insights as I
from reviewloom.operators import recommendations as R

METRICS = (
    "metrics",
    """select cluster_id as topic_id, topic_name as topic, review_count as topic_size,
  positive_rate as positive_ratio, negative_rate as negative_ratio from rates""",
)


def _template_sql(part: int) -> str:
    whens = " ".join(
        f"when contains(lower(topic), {quoted(t[0].lower())}) then {quoted(t[part])}"
        for t in S.ACTION_TEMPLATES
    )
    return (
        f"case when negative_ratio < 0.2 then {quoted(S.POSITIVE_TEMPLATE[part - 1])} {whens} "
        f"else {quoted(S.FALLBACK_TEMPLATE[part - 1])} end"
    )


PRIORITY = "case when negative_ratio >= 0.5 then 'High' when negative_ratio >= 0.35 then 'Medium' else 'Low' end"
SEVERITY = "round(topic_size * 0.4::double + negative_ratio * 100.0::double * 0.6::double, 1)"
BUILT = (
    "built",
    f"""select topic_id, topic, topic_size, {PRIORITY} as priority, {SEVERITY} as severity,
  {_template_sql(1)} as recommendation, {_template_sql(2)} as rationale,
  round(positive_ratio, 2) as positive_ratio, round(negative_ratio, 2) as negative_ratio from metrics""",
)
RANKED = (
    "ranked",
    """select *, cast(row_number() over (order by severity desc, negative_ratio desc, topic_size desc,
  topic_id) as int) as rank from built""",
)
CTES = (BASE, RATES, METRICS, BUILT, RANKED)


def ranked(spark, sf_dir):
    return R.ranked(R.metrics_from_base(base(spark, sf_dir)))


@query(
    "r01_topic_metrics",
    over_clustered(
        BASE,
        RATES,
        body="""select 'ratios' as source, cluster_id as topic_id, topic_name as topic,
          review_count as topic_size, round(positive_rate, 6) as positive_ratio,
          round(negative_rate, 6) as negative_ratio from rates
        union all select 'percentages', cluster_id, topic_name, review_count,
          round(positive_rate, 6), round(negative_rate, 6) from rates
        union all select 'counts', cluster_id, 'Topic ' || cluster_id, 0,
          least(1.0, positive / 100.0), least(1.0, negative / 100.0) from rates""",
    ),
)
def topic_metrics(spark, sf_dir):
    counted = base(spark, sf_dir)
    topics, sentiment = I.topics(counted), I.topic_sentiment(counted)
    variants = {
        "ratios": (
            topics,
            sentiment.withColumnsRenamed(
                {"positive_rate": "positive_ratio", "negative_rate": "negative_ratio"}
            ),
        ),
        "percentages": (
            topics.withColumnsRenamed({"cluster_id": "cluster", "review_count": "size"}),
            sentiment.select(
                F.col("cluster_id").alias("topic_id"),
                (F.col("positive_rate") * 100).alias("positive_percentage"),
                (F.col("negative_rate") * 100).alias("negative_percentage"),
            ),
        ),
        "counts": (topics.select("cluster_id"), sentiment),
    }
    out = None
    for name, (left, right) in variants.items():
        part = R.topic_metrics(left, right).withColumn("source", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return rounded(out, "positive_ratio", "negative_ratio")


def _built(*names):
    def run(spark, sf_dir):
        return R.build(R.metrics_from_base(base(spark, sf_dir))).select("topic_id", *names)

    return run


COLUMNS = (
    "topic",
    "topic_size",
    "priority",
    "severity",
    "recommendation",
    "rationale",
    "positive_ratio",
    "negative_ratio",
)
for _key, _names in (
    ("r02_priority", ("priority",)),
    ("r03_severity", ("severity",)),
    ("r04_template", ("recommendation", "rationale")),
    ("r05_build", COLUMNS),
):
    query(
        _key,
        over_clustered(BASE, RATES, METRICS, BUILT, body=f"select topic_id, {', '.join(_names)} from built"),
    )(_built(*_names))


@query("r06_one_topic", over_clustered(*CTES, body="select * from ranked where topic_id = 3"))
def one_topic(spark, sf_dir):
    return R.for_topic(ranked(spark, sf_dir), 3)


query("r07_ranked", over_clustered(*CTES, body="select * from ranked"))(ranked)


@query(
    "r08_priority_counts",
    over_clustered(
        *CTES,
        body="""select p.priority, count(r.topic_id) as recommendations
        from (values ('High'), ('Medium'), ('Low')) as p(priority)
        left join ranked r on r.priority = p.priority group by 1""",
    ),
)
def priority_counts(spark, sf_dir):
    return R.priority_counts(ranked(spark, sf_dir))


@query("r09_top_n", over_clustered(*CTES, body="select * from ranked where rank <= 3"))
def top_n(spark, sf_dir):
    return R.top(ranked(spark, sf_dir), 3)


@query(
    "r10_summary",
    over_clustered(
        *CTES,
        body="""select count(*) as total_recommendations,
        count(*) filter (where priority = 'High') as high_priority,
        count(*) filter (where priority = 'Medium') as medium_priority,
        count(*) filter (where priority = 'Low') as low_priority,
        round(avg(severity), 1) as average_severity,
        max_by(topic_id, (severity, -rank)) as riskiest_id, max_by(topic, (severity, -rank)) as riskiest_topic,
        max(severity) as riskiest_severity, max_by(priority, (severity, -rank)) as riskiest_priority
        from ranked""",
    ),
)
def summary(spark, sf_dir):
    card = R.summary(ranked(spark, sf_dir))
    risk = {
        "riskiest_id": "topic_id",
        "riskiest_topic": "topic",
        "riskiest_severity": "severity",
        "riskiest_priority": "priority",
    }
    return card.select(
        *[c for c in card.columns if c != "highest_risk_topic"],
        *[F.col(f"highest_risk_topic.{field}").alias(name) for name, field in risk.items()],
    )


RANKED_FIELDS = ("topic_id", *COLUMNS, "rank")
ROW_SQL = "{" + ", ".join(f"'{c}': {c}" for c in RANKED_FIELDS) + "}"


@query(
    "r11_payload",
    over_clustered(
        *CTES,
        body=f"""select cast(to_json({{
          'summary': {{'total_recommendations': count(*),
            'high_priority': count(*) filter (where priority = 'High'),
            'medium_priority': count(*) filter (where priority = 'Medium'),
            'low_priority': count(*) filter (where priority = 'Low'),
            'average_severity': coalesce(round(avg(severity), 1), 0),
            'highest_risk_topic': max_by({{'topic_id': topic_id, 'topic': topic, 'severity': severity,
              'priority': priority}}, (severity, -rank))}},
          'top_recommendations': list({ROW_SQL} order by rank)[1:3],
          'recommendations': list({ROW_SQL} order by rank)}}) as varchar) as payload from ranked""",
    ),
)
def payload(spark, sf_dir):
    return R.payload(ranked(spark, sf_dir)).select(F.to_json(F.struct("*")).alias("payload"))
