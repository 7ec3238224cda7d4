"""Topic names from top terms, and the cluster quality table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewloom import settings as S
from reviewloom.plans.shapes import col, first_present, literal_rows, require_columns


def terms_list(top_terms: DataFrame, cluster: str = "cluster_id") -> DataFrame:
    """(cluster, terms): ordered list per cluster, from long rows or an existing list."""
    if "top_terms" in top_terms.columns:
        return top_terms.select(cluster, F.col("top_terms").alias("terms"))
    require_columns(top_terms, [cluster, "term"], "top terms")
    order = "rank" if "rank" in top_terms.columns else "term"
    ordered = F.array_sort(F.collect_list(F.struct(F.col(order).alias("k"), "term")))
    return top_terms.groupBy(cluster).agg(F.transform(ordered, lambda x: x.term).alias("terms"))


def _tokens(lists: DataFrame, top_n: int, cluster: str) -> DataFrame:
    """(cluster, rank from 0, token) of the first ``top_n`` terms."""
    ranked = lists.select(cluster, F.posexplode(F.slice("terms", 1, top_n)).alias("rank", "term"))
    return ranked.select(
        cluster, "rank", F.explode(F.split(F.lower("term"), r"\s+")).alias("token")
    ).where("token <> ''")


def match_category(
    lists: DataFrame, top_n: int = S.NAMING_TERMS, taxonomy=S.TOPIC_TAXONOMY, cluster: str = "cluster_id"
) -> DataFrame:
    """Category with most matching terms; ties by earliest term, then taxonomy order."""
    rows = [(i, name, word) for i, (name, words) in enumerate(taxonomy) for word in words]
    triggers = literal_rows(lists.sparkSession, rows, "priority int, category string, token string")
    hits = (
        _tokens(lists, top_n, cluster)
        .join(F.broadcast(triggers), "token")
        .groupBy(cluster, "category", "priority")
        .agg(F.count_distinct("rank").alias("hits"), F.min("rank").alias("first_rank"))
    )
    order = Window.partitionBy(cluster).orderBy(F.desc("hits"), "first_rank", "priority")
    return (
        hits.withColumn("n", F.row_number().over(order))
        .where("n = 1")
        .select(cluster, "category", "hits", "first_rank")
    )


def is_generic(
    lists: DataFrame,
    top_n: int = S.NAMING_TERMS,
    threshold: float = S.GENERIC_SHARE,
    words: Sequence[str] = S.GENERIC_TERMS,
    cluster: str = "cluster_id",
) -> DataFrame:
    """True when most tokens of the top terms are filler, or there are none."""
    terms = F.slice("terms", 1, top_n)
    tokens = F.filter(
        F.flatten(F.transform(terms, lambda t: F.split(F.lower(t), r"\s+"))), lambda t: t != ""
    )
    filler = F.size(F.filter(tokens, lambda t: t.isin(*words)))
    share = F.try_divide(filler, F.size(tokens))
    return lists.select(cluster, F.coalesce(share >= threshold, F.lit(True)).alias("generic"))


def _filler_only(term: Column) -> Column:
    """True when most tokens of a term are filler, or there are none."""
    tokens = F.filter(F.split(F.lower(term), r"\s+"), lambda t: t != "")
    share = F.try_divide(F.size(F.filter(tokens, lambda t: t.isin(*S.GENERIC_TERMS))), F.size(tokens))
    return F.coalesce(share >= S.GENERIC_SHARE, F.lit(True))


def disambiguate(named: DataFrame, top_n: int = S.NAMING_TERMS, cluster: str = "cluster_id") -> DataFrame:
    """Names shared by several clusters get a marker term.

    The clusters of a name are folded in order of their id; the accumulator carries the
    markers used so far.  A marker is the first unused term that says something, else the
    first unused term, else the cluster's id.  A name has at most as many clusters as the
    model has.
    """
    kind = dict(named.dtypes)[cluster]
    members = named.groupBy("topic_name").agg(
        F.array_sort(F.collect_list(F.struct(col(cluster).alias("id"), F.slice("terms", 1, top_n).alias("terms")))).alias("members")
    )
    start = F.struct(
        F.array().cast("array<string>").alias("used"),
        F.array().cast(f"array<struct<id:{kind},marker:string>>").alias("marked"),
    )

    def mark(state: Column, member: Column) -> Column:
        free = F.filter(member["terms"], lambda t: ~F.array_contains(state["used"], t))
        telling = F.filter(free, lambda t: ~_filler_only(t))
        marker = F.coalesce(
            F.get(telling, F.lit(0)),
            F.get(free, F.lit(0)),
            F.concat(F.lit("cluster "), member["id"].cast("string")),
        )
        return F.struct(
            F.array_append(state["used"], marker).alias("used"),
            F.array_append(
                state["marked"], F.struct(member["id"].alias("id"), marker.alias("marker"))
            ).alias("marked"),
        )

    folded = members.select(
        "topic_name",
        (F.size("members") > 1).alias("shared"),
        F.explode(F.aggregate("members", start, mark)["marked"]).alias("m"),
    )
    marked = F.concat("topic_name", F.lit(" ("), "m.marker", F.lit(")"))
    return folded.select(
        F.col("m.id").alias(cluster),
        F.when(F.col("shared"), marked).otherwise(F.col("topic_name")).alias("topic_name"),
    )


def raw_topic_names(lists: DataFrame, top_n: int = S.NAMING_TERMS, cluster: str = "cluster_id") -> DataFrame:
    """Category name per cluster, before shared names are told apart."""
    both = lists.join(match_category(lists, top_n, cluster=cluster), cluster, "left").join(
        is_generic(lists, top_n, cluster=cluster), cluster
    )
    weak = F.col("category").isNull() | ((F.col("hits") == 1) & F.col("generic"))
    return both.select(
        cluster,
        F.when(weak, S.UNCATEGORISED).otherwise(F.col("category")).alias("topic_name"),
        "terms",
    )


def suggest_topic_names(lists: DataFrame, top_n: int = S.NAMING_TERMS, cluster: str = "cluster_id") -> DataFrame:
    """(cluster, topic_name) derived from the content of each cluster."""
    return disambiguate(raw_topic_names(lists, top_n, cluster), top_n, cluster)


def size_table(sizes: DataFrame, cluster: str = "cluster_id") -> DataFrame:
    """(cluster, size) from any of the size table shapes; falls back to the last column."""
    key = cluster if cluster in sizes.columns else sizes.columns[0]
    count = first_present(sizes.columns, S.CLUSTER_SIZE_CANDIDATES) or sizes.columns[-1]
    return sizes.select(col(key).cast("int").alias(cluster), col(count).cast("bigint").alias("size"))


def quality_report(
    lists: DataFrame,
    representatives: DataFrame,
    sizes: DataFrame | None = None,
    names: DataFrame | None = None,
    top_n: int = S.NAMING_TERMS,
    samples: int = 3,
    cluster: str = "cluster_id",
) -> DataFrame:
    """One row per cluster: name, size, share, terms, sample reviews, coherence."""
    ordered = F.array_sort(F.collect_list(F.struct("rank", "review_text")))
    examples = (
        representatives.where(F.col("rank") <= samples)
        .groupBy(cluster)
        .agg(F.array_join(F.transform(ordered, lambda x: x.review_text), " | ").alias("sample_reviews"))
    )
    report = (
        lists.select(cluster, F.array_join(F.slice("terms", 1, top_n), ", ").alias("top_terms"))
        .join(is_generic(lists, top_n, cluster=cluster).select(cluster, (~F.col("generic")).alias("coherent")), cluster)
        .join(examples, cluster, "left")
        .fillna("", ["sample_reviews"])
    )
    if names is not None:
        report = report.join(names.select(cluster, F.col("topic_name").alias("name")), cluster, "left").fillna("", ["name"])
    else:
        report = report.withColumn("name", F.lit(""))
    if sizes is not None:
        everything = Window.partitionBy(F.lit(1))
        counted = size_table(sizes, cluster).withColumn(
            "pct", F.round(F.col("size") / F.sum("size").over(everything) * 100, 2)
        )
        report = report.join(counted, cluster, "left")
    return report
