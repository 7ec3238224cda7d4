"""Quality by hierarchical empirical Bayes: the text's evidence and its site's record.

A logistic model on text statistics, fitted on at most TRAIN_DOCS labelled
documents, gives the evidence of the text alone.  The labels are also counted by
host and by path.  A host's share of good documents is shrunk toward that of all,
a path's toward its host's; how strongly follows from the counts themselves (the
spread between sites beyond what chance gives).  The document's posterior adds the
log odds of its path over those of all documents to the text's evidence.

Documents have their page's host and first path part where a page of the same id
has a URL, otherwise source and language stand for host and path.

Null and empty texts score by the statistics of an empty text.  Null ids have no
page and no label.  Null source and language are values of their own.  Of several
labels or pages of an id the least counts.  Without labels of both kinds the text
gives no evidence.  Repeated rows are scored alike.  Empty table: no rows.  Other
columns are not read.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.llm.common import held_out, read_table, staged, text_or_empty
from reviewloom.llm.urlrules import parsed

TRAIN_DOCS = 20_000
LEAST_STRENGTH, MOST_STRENGTH = 1.0, 1e6  # of a prior, in documents
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
DIGITS = "0123456789"
FEATURES = ("length", "symbols", "bars", "shouts", "capitals", "digits", "spaces", "variety", "lines")


def statistics(text: Column) -> list[Column]:
    """FEATURES of a non-null text; shares are of its characters."""
    n = F.length(text)

    def share(marks: str) -> Column:
        return (n - F.length(F.translate(text, marks, ""))) / F.greatest(n, F.lit(1))

    words = F.split(text, " ")
    lines = F.split(text, "\n")
    values = [
        F.log1p(n),
        F.sqrt(share("#*$%&<>")),
        F.sqrt(share("|")),
        F.sqrt(share("!")),
        share(LETTERS),
        share(DIGITS),
        share(" "),
        F.size(F.array_distinct(words)) / F.size(words),
        F.size(F.array_distinct(lines)) / F.size(lines),
    ]
    return [v.cast("double").alias(name) for name, v in zip(FEATURES, values, strict=True)]


def _key(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), text))


def _text_evidence(rows: DataFrame) -> Column:
    """Log odds of a good document by the statistics, less those of the sample."""
    sample = (
        rows.where("good is not null and not held_out")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(TRAIN_DOCS)
        .select("good", *FEATURES)
    )
    sample = staged(sample, "sample")
    share = sample.agg(F.avg("good").alias("p")).first()["p"]
    if share is None or share in (0.0, 1.0):
        return F.lit(0.0)
    table = VectorAssembler(inputCols=list(FEATURES), outputCol="x").transform(sample)
    model = LogisticRegression(
        featuresCol="x", labelCol="good", regParam=0.001, maxIter=50
    ).fit(table)
    total = F.lit(float(model.intercept))
    for name, weight in zip(FEATURES, model.coefficients, strict=True):
        total = total + F.lit(float(weight)) * F.col(name)
    return total - F.log(F.lit(share / (1 - share)))


def _strength(counts: DataFrame, prior: Column) -> float:
    """Documents a prior is worth, by moments: the spread of shares beyond chance."""
    share = F.col("good") / F.col("n")
    chance = prior * (1 - prior)
    m = counts.agg(
        F.sum(F.col("n") * F.pow(share - prior, 2)).alias("spread"),
        F.sum(chance).alias("chance"),
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.col("n")).alias("n2"),
        F.avg(chance).alias("mean"),
    ).first()
    if not m["n"] or m["n"] * m["n"] <= m["n2"]:
        return MOST_STRENGTH
    between = (m["spread"] - m["chance"]) / (m["n"] - m["n2"] / m["n"])
    if between <= 0 or not m["mean"]:
        return MOST_STRENGTH
    return min(MOST_STRENGTH, max(LEAST_STRENGTH, m["mean"] / between - 1))


def site_posteriors(labelled: DataFrame) -> tuple[DataFrame, DataFrame, float]:
    """(by host, by path, share of all); input host, path, good (0 or 1)."""
    paths = staged(
        labelled.groupBy("host", "path").agg(
            F.count(F.lit(1)).alias("n"), F.sum("good").alias("good")
        ),
        "path_counts",
    )
    total = paths.agg(F.sum("good").alias("g"), F.sum("n").alias("n")).first()
    # One good and one bad document more, so that no share is 0 or 1.
    everywhere = ((total["g"] or 0) + 1) / ((total["n"] or 0) + 2)
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    k = _strength(hosts, F.lit(everywhere))
    by_host = hosts.select(
        "host", ((F.col("good") + k * everywhere) / (F.col("n") + k)).alias("host_share")
    )
    below = paths.join(by_host, "host")
    k = _strength(below, F.col("host_share"))
    by_path = below.select(
        "host",
        "path",
        ((F.col("good") + k * F.col("host_share")) / (F.col("n") + k)).alias("path_share"),
    )
    return staged(by_host, "by_host"), staged(by_path, "by_path"), everywhere


def score_sites(
    docs: DataFrame,
    labels: DataFrame,
    pages: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, held_out, host, path, evidence, site_share, score, kept) of every document."""
    urls = (
        pages.where("page_id is not null")
        .groupBy(F.col("page_id").cast("bigint").alias("doc_id"))
        .agg(F.min("url").alias("url"))
    )
    sites = parsed(urls).where("host != ''").select(
        "doc_id", "host", F.regexp_extract("path", "^/([^/]*)", 1).alias("path")
    )
    marked = (
        labels.where("doc_id is not null and quality is not null")
        .groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
        .agg(F.min((F.col("quality") > 0).cast("int")).alias("good"))
    )
    own = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        _key(F.col("source")).alias("source"),
        _key(F.col("lang")).alias("lang"),
        *statistics(text_or_empty(text_col)),
    )
    own = staged(own, "statistics")
    rows = (
        own.join(sites, "doc_id", "left")
        .join(marked, "doc_id", "left")
        .select(
            "doc_id",
            "good",
            held_out(F.col("doc_id")).alias("held_out"),
            F.coalesce("host", "source").alias("host"),
            F.coalesce("path", "lang").alias("path"),
            *FEATURES,
        )
    )
    rows = staged(rows, "rows")
    evidence = _text_evidence(rows)
    by_host, by_path, everywhere = site_posteriors(
        rows.where("good is not null and not held_out").select("host", "path", "good")
    )
    share = F.coalesce("path_share", "host_share", F.lit(everywhere))
    odds = F.log(F.col("site_share") / (1 - F.col("site_share")))
    return (
        rows.withColumn("evidence", evidence)
        .join(by_path, ["host", "path"], "left")
        .join(by_host, "host", "left")
        .withColumn("site_share", share)
        .withColumn("score", 1 / (1 + F.exp(-(F.col("evidence") + odds))))
        .select(
            F.col("doc_id").alias(id_col),
            "held_out",
            "host",
            "path",
            "evidence",
            "site_share",
            "score",
            (F.col("score") >= 0.5).alias("kept"),
        )
    )


def op8_site_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels, pages = (read_table(spark, sf_dir, t) for t in ("documents", "labels", "pages"))
    return score_sites(docs, labels, pages)
