"""Review tables derived from the given documents and labels tables.

Each view exists twice: as a Spark projection and as the SQL text used by the
DuckDB check.  Both describe the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.plans.shapes import spread_small

VIEW_SQL = {
    "reviews_raw": """
select d.doc_id as review_id, d.source as product_name,
  concat('Brand', cast(d.doc_id % 4 as varchar(9))) as brand,
  d.lang as source_dataset,
  case when d.doc_id % 9 = 0 then null
       else split_part(d.text, chr(10), 1) end as review_title,
  case when d.doc_id % 41 = 0 then null when d.doc_id % 43 = 0 then ''
       else d.text end as review_text,
  case when d.doc_id % 37 = 0 then null
       when (d.doc_id*7+d.n_chars) % 23 = 0 then 'x'
       when l.toxic = 1 then '1' when l.quality = 0 then '2.5'
       else cast((d.doc_id*7+d.n_chars) % 7 as varchar(9)) end as rating_raw,
  case when d.doc_id % 29 = 0 then 'not a date'
       else concat('2024-0', cast(1 + d.doc_id % 9 as varchar(9)),
                   '-15 10:00:00') end as review_date_raw,
  case when d.lang = 'de' then null when d.doc_id % 3 = 0 then 'false'
       else 'true' end as do_recommend
from documents d left join labels l on d.doc_id = l.doc_id""",
    "reviews_labelled": """
select review_id, product_name, brand, source_dataset,
  coalesce(review_title,'') as review_title, review_text,
  cast(floor(r) as int) as rating,
  case when r < 3 then 'negative' when r < 4 then 'neutral'
       else 'positive' end as sentiment_label
from (select *, try_cast(rating_raw as double) as r from reviews_raw) q
where review_text is not null and length(review_text) > 0
  and r >= 1 and r <= 5""",
    "predictions": """
select review_id, review_text as text, sentiment_label as true_label,
  case when review_id % 5 <> 0 then sentiment_label
       when sentiment_label = 'negative' then 'neutral'
       when sentiment_label = 'neutral' then 'positive'
       else 'negative' end as pred_a,
  case when review_id % 7 <> 0 then sentiment_label
       when sentiment_label = 'negative' then 'positive'
       when sentiment_label = 'neutral' then 'negative'
       else 'neutral' end as pred_b,
  cast(50 + review_id % 50 as double) / 100 as confidence
from reviews_labelled""",
    "clustered": """
select r.review_id, r.review_text, r.rating, r.sentiment_label,
  p.pred_a as predicted_sentiment,
  cast(t.cluster_id as int) as cluster_id, t.topic_name
from reviews_labelled r join predictions p on r.review_id = p.review_id
join (values (0,'Battery life'),(1,'General / uncategorized'),
             (2,'Fire TV and streaming'),(3,'Kindle reading'),
             (4,'Echo speakers'),(5,'Setup and shipping'))
     as t(cluster_id, topic_name)
  on t.cluster_id = case
       when r.sentiment_label = 'negative' and r.review_id % 2 = 0 then 0
       when r.sentiment_label = 'neutral'  and r.review_id % 3 = 0 then 3
       when r.sentiment_label = 'positive' and r.review_id % 2 = 1 then 5
       else r.review_id % 6 end""",
}
_NEEDS = {
    "reviews_raw": (),
    "reviews_labelled": ("reviews_raw",),
    "predictions": ("reviews_raw", "reviews_labelled"),
    "clustered": ("reviews_raw", "reviews_labelled", "predictions"),
}
TOPIC_NAMES = (
    (0, "Battery life"),
    (1, "General / uncategorized"),
    (2, "Fire TV and streaming"),
    (3, "Kindle reading"),
    (4, "Echo speakers"),
    (5, "Setup and shipping"),
)


def sql_over(view: str, *parts: tuple[str, str], body: str) -> str:
    """``body`` with the view, what it needs, and further named parts as CTEs."""
    names = [*_NEEDS[view], view]
    ctes = [(n, VIEW_SQL[n]) for n in names] + list(parts)
    listed = ",\n".join(f"{name} as ({text})" for name, text in ctes)
    return f"with {listed}\n{body}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reviews_raw(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """``spread`` is for queries with heavy text work on every row."""
    documents = table(spark, sf_dir, "documents")
    return spark.sql(
        VIEW_SQL["reviews_raw"]
        .replace("from documents d", "from {documents} d")
        .replace("join labels l", "join {labels} l"),
        documents=spread_small(documents, "doc_id") if spread else documents,
        labels=table(spark, sf_dir, "labels"),
    )


def reviews_labelled(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    raw = reviews_raw(spark, sf_dir, spread).withColumn("r", F.expr("try_cast(rating_raw as double)"))
    return raw.where("length(review_text) > 0 and r between 1 and 5").select(
        "review_id",
        "product_name",
        "brand",
        "source_dataset",
        F.coalesce("review_title", F.lit("")).alias("review_title"),
        "review_text",
        F.floor("r").cast("int").alias("rating"),
        F.when(F.col("r") < 3, "negative")
        .when(F.col("r") < 4, "neutral")
        .otherwise("positive")
        .alias("sentiment_label"),
    )


def _shifted(modulus: int, negative: str, neutral: str, positive: str):
    label = F.col("sentiment_label")
    return (
        F.when(F.col("review_id") % modulus != 0, label)
        .when(label == "negative", negative)
        .when(label == "neutral", neutral)
        .otherwise(positive)
    )


_PRED_A = (5, "neutral", "positive", "negative")
_PRED_B = (7, "positive", "negative", "neutral")


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reviews_labelled(spark, sf_dir).select(
        "review_id",
        F.col("review_text").alias("text"),
        F.col("sentiment_label").alias("true_label"),
        _shifted(*_PRED_A).alias("pred_a"),
        _shifted(*_PRED_B).alias("pred_b"),
        ((F.lit(50) + F.col("review_id") % 50).cast("double") / 100).alias("confidence"),
    )


def clustered(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    label, rid = F.col("sentiment_label"), F.col("review_id")
    cluster = (
        F.when((label == "negative") & (rid % 2 == 0), 0)
        .when((label == "neutral") & (rid % 3 == 0), 3)
        .when((label == "positive") & (rid % 2 == 1), 5)
        .otherwise(rid % 6)
        .cast("int")
    )
    names = F.create_map(*[F.lit(x) for pair in TOPIC_NAMES for x in pair])
    return reviews_labelled(spark, sf_dir, spread).select(
        "review_id",
        "review_text",
        "rating",
        "sentiment_label",
        _shifted(*_PRED_A).alias("predicted_sentiment"),
        cluster.alias("cluster_id"),
        names[cluster].alias("topic_name"),
    )
