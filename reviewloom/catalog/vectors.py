"""V: vectorisation and topic model queries."""

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from reviewloom.catalog import sqltext as T
from reviewloom.catalog.registry import query
from reviewloom.functions import text as X
from reviewloom.functions.vectors import l2_normalise
from reviewloom.operators import topics as P
from reviewloom.operators import vectorize as V
from reviewloom.plans import fixtures as fx
from reviewloom.plans.fixtures import sql_over

CLASSICAL = (
    "classical",
    f"select review_id, {T.classical_text('review_text')} as classical_text from reviews_labelled",
)
WORDS = (
    "words",
    f"""select review_id, list_filter(regexp_extract_all(lower(classical_text), '{X.WORD}'),
  lambda t: not list_contains({T.word_list(X.topic_stop_words())}, t)) as w from classical""",
)
GRAMS = (
    "grams",
    """select review_id, term, count(*) as tf from (select review_id, unnest(list_concat(w,
  list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) as term from words) q group by 1, 2""",
)
VOCABULARY = (
    "vocab",
    """select term, count(*) as doc_count, cast(sum(tf) as bigint) as total_count from grams group by 1
  having count(*) >= 5 and count(*) <= 0.85 * (select count(*) from classical)
  order by total_count desc, term limit 10000""",
)
TFIDF = (
    "tfidf",
    """select review_id, term, raw / sqrt(sum(raw * raw) over (partition by review_id)) as weight
  from (select review_id, g.term, (1 + ln(tf)) * (ln((1.0::double + (select count(*) from classical))
    / (1 + doc_count)) + 1) as raw from grams g join vocab v on g.term = v.term) q""",
)
CTES = (CLASSICAL, WORDS, GRAMS, VOCABULARY, TFIDF)


def over_labelled(*parts, body):
    return sql_over("reviews_labelled", *parts, body=body)


def classical(spark, sf_dir):
    reviews = fx.reviews_labelled(spark, sf_dir, spread=True)
    return reviews.select("review_id", X.classical_text(F.col("review_text")).alias("classical_text"))


def fitted(spark, sf_dir):
    """Classical texts, their term counts, the vocabulary table and the text count."""
    texts = classical(spark, sf_dir).persist()
    counts = V.term_counts(texts)
    n = fx.reviews_labelled(spark, sf_dir).count()
    return texts, counts, V.vocabulary(counts, n), n


@query("v01_ngrams", over_labelled(*CTES[:3], body="select review_id, term, tf from grams"))
def ngrams(spark, sf_dir):
    return V.term_counts(classical(spark, sf_dir))


@query("v02_vocabulary", over_labelled(*CTES[:4], body="select term, doc_count, total_count from vocab"))
def vocabulary(spark, sf_dir):
    return fitted(spark, sf_dir)[2]


@query(
    "v03_tfidf",
    over_labelled(*CTES, body="select review_id, term, round(weight, 6) as weight from tfidf"),
)
def tfidf(spark, sf_dir):
    _, counts, vocab, n = fitted(spark, sf_dir)
    return V.tfidf(counts, vocab, n).withColumn("weight", F.round("weight", 6))


@query("v04_svd")
def svd(spark, sf_dir):
    """Length of every projected review and the explained share."""
    _, basis, projected = P.represent(classical(spark, sf_dir))
    share = P.explained_variance_ratio(projected, basis)
    length = F.sqrt(F.aggregate("lsa", F.lit(0.0), lambda acc, x: acc + x * x))
    return projected.select(
        "review_id",
        F.size("lsa").alias("components"),
        F.round(length, 6).alias("length"),
        F.lit(round(share, 6)).alias("explained_variance_ratio"),
    )


@query(
    "v04b_svd_residuals",
    f"""select unnest(range(1, {P.S.SVD_COMPONENTS + 1}))::int as component, true as falls, true as apart,
    true as leading_is_exact""",
)
def svd_residuals(spark, sf_dir):
    """Per component: no larger than the one before, at right angles to the others, and, for
    the first ten, a singular vector within two percent."""
    _, basis, projected = P.represent(classical(spark, sf_dir))
    found = P.svd_residuals(projected, basis)
    P.release(projected)
    inner = np.abs(basis.T @ basis - np.eye(basis.shape[1])).max(axis=0)
    angles = spark.createDataFrame([(i, float(a)) for i, a in enumerate(inner, 1)], "component int, inner double")
    # One row per component.
    order = Window.orderBy("component")
    falls = F.coalesce(F.lag("singular_value").over(order) >= F.col("singular_value") * (1 - 1e-9), F.lit(True))
    return found.join(angles, "component").select(
        "component",
        falls.alias("falls"),
        (F.col("inner") < 1e-8).alias("apart"),
        ((F.col("component") > 10) | (F.col("residual") < 0.02)).alias("leading_is_exact"),
    )


def embeddings(spark, sf_dir):
    return fx.table(spark, sf_dir, "embeddings").select(
        "vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("embedding"), "label"
    )


@query(
    "v05_l2_normalize",
    """select vec_id, pos, round(v / norm, 6) as value from (
    select vec_id, unnest(range(64)) as pos, unnest(embedding::double[]) as v,
    sqrt(list_sum(list_transform(embedding::double[], lambda x: x * x))) as norm from embeddings) q""",
)
def normalise(spark, sf_dir):
    unit = embeddings(spark, sf_dir).select("vec_id", F.posexplode(l2_normalise(F.col("embedding"))).alias("pos", "value"))
    return unit.select("vec_id", F.col("pos").cast("bigint").alias("pos"), F.round("value", 6).alias("value"))


@query("v06_kmeans")
def kmeans(spark, sf_dir):
    points = embeddings(spark, sf_dir).persist()
    centres, _ = P.kmeans(points, [6], vector="embedding", key="vec_id")[6]
    return P.assign(points, centres, "embedding").select(
        "vec_id", "cluster_id", F.round("distance_to_centroid", 6).alias("distance_to_centroid")
    )


@query(
    "v06b_kmeans_facts",
    """select vec_id, 6 as clusters, true as nearest, true as centre_is_mean from embeddings""",
)
def kmeans_facts(spark, sf_dir):
    """Per vector: is its centroid the nearest, and the mean of its members?"""
    points = embeddings(spark, sf_dir).persist()
    centres, _ = P.kmeans(points, [6], vector="embedding", key="vec_id")[6]
    placed = P.assign(points, centres, "embedding")
    gaps = [
        F.aggregate(
            F.zip_with("embedding", F.array(*[F.lit(float(x)) for x in c]), lambda x, y: (x - y) * (x - y)),
            F.lit(0.0),
            lambda acc, x: acc + x,
        )
        for c in centres
    ]
    means = P.group_centroids(placed.select("cluster_id", "embedding"), "embedding", "cluster_id").collect()
    moved = {r["cluster_id"]: float(np.abs(np.array(r["centre"]) - centres[r["cluster_id"]]).max()) for r in means}
    still = [k for k, gap in moved.items() if gap < 0.02]
    own = F.get(F.array(*gaps), F.col("cluster_id"))
    return placed.select(
        "vec_id",
        F.lit(len(means)).alias("clusters"),
        (own <= F.array_min(F.array(*gaps)) + 1e-9).alias("nearest"),
        F.col("cluster_id").isin(still).alias("centre_is_mean"),
    )


@query("v07_k_sweep")
def sweep(spark, sf_dir):
    _, basis, projected = P.represent(classical(spark, sf_dir))
    return P.sweep_cluster_counts(projected, basis)


@query(
    "v07b_sweep_facts",
    f"""select unnest({list(P.S.CLUSTER_COUNTS)})::int as n_clusters, {P.S.SVD_COMPONENTS} as svd_components,
    true as inertia_falls, true as silhouette_in_range, true as share_in_range""",
)
def sweep_facts(spark, sf_dir):
    """Per number of clusters: more of them fit closer; scores and shares are possible ones."""
    rows = sweep(spark, sf_dir)
    before = F.lag("inertia").over(Window.orderBy("n_clusters"))
    return rows.select(
        "n_clusters",
        "svd_components",
        F.coalesce(before > F.col("inertia"), F.lit(True)).alias("inertia_falls"),
        F.col("silhouette_score").between(-1, 1).alias("silhouette_in_range"),
        ((F.col("svd_explained_variance_ratio") > 0) & (F.col("svd_explained_variance_ratio") <= 1)).alias("share_in_range"),
    )


@query(
    "v08_silhouette",
    """with pairs as (select a.vec_id, a.label as own, b.label as other,
      avg(list_distance(a.embedding::double[], b.embedding::double[])) as d
      from embeddings a join embeddings b on a.vec_id <> b.vec_id group by 1, 2, 3),
    scored as (select vec_id, max(d) filter (where own = other) as a, min(d) filter (where own <> other) as b
      from pairs group by 1)
    select (select count(*) from embeddings) as sampled_rows,
      (select count(distinct label) from embeddings) as clusters,
      round(avg(case when a is null then 0 else (b - a) / greatest(a, b) end), 6) as silhouette from scored""",
)
def silhouette(spark, sf_dir):
    score = P.silhouette(embeddings(spark, sf_dir), "embedding", "label", "vec_id")
    return score.withColumn("silhouette", F.round("silhouette", 6))


@query(
    "v08b_silhouette_of_all",
    """with pairs as (select a.vec_id, a.label as own, b.label as other,
      avg(list_distance(a.embedding::double[], b.embedding::double[]) ** 2) as d
      from embeddings a join embeddings b on a.vec_id <> b.vec_id group by 1, 2, 3),
    scored as (select vec_id, max(d) filter (where own = other) as a, min(d) filter (where own <> other) as b
      from pairs group by 1)
    select (select count(*) from embeddings) as rows,
      (select count(distinct label) from embeddings) as clusters,
      round(avg(case when a is null then 0 else (b - a) / greatest(a, b) end), 6) as silhouette from scored""",
)
def silhouette_of_all(spark, sf_dir):
    score = P.silhouette_of_all(embeddings(spark, sf_dir), "embedding", "label")
    return score.withColumn("silhouette", F.round("silhouette", 6))


@query(
    "v09_top_terms",
    sql_over(
        "clustered",
        *CTES,
        body="""select cluster_id, rank, term, round(mean_tfidf, 6) as mean_tfidf from (
        select *, cast(row_number() over (partition by cluster_id order by mean_tfidf desc, term) as int) as rank
        from (select cluster_id, term, round(sum(weight) / max(size), 9) as mean_tfidf from tfidf
          join (select review_id, cluster_id, count(*) over (partition by cluster_id) as size
            from clustered) c using (review_id) group by 1, 2) a) b where rank <= 12""",
    ),
)
def top_terms(spark, sf_dir):
    _, counts, vocab, n = fitted(spark, sf_dir)
    placed = fx.clustered(spark, sf_dir).select("review_id", "cluster_id")
    weights = V.tfidf(counts, vocab, n).join(placed, "review_id")
    ranked = P.top_terms_of_weights(weights, P.cluster_sizes(placed))
    return ranked.select("cluster_id", "rank", "term", F.round("mean_tfidf", 6).alias("mean_tfidf"))


CENTROIDS = (
    "centroids",
    """select label, list(m order by pos) as centre from (select label, pos, avg(v) as m from (
  select label, unnest(range(64)) as pos, unnest(embedding::double[]) as v from embeddings) a
  group by 1, 2) b group by 1""",
)


def label_centroids(points):
    """Mean vector per label as a matrix in label order (one row per label)."""
    rows = sorted(P.group_centroids(points, "embedding", "label").collect(), key=lambda r: r["label"])
    return np.array([r["centre"] for r in rows])


@query(
    "v10_nearest_to_centroid",
    f"""with {CENTROIDS[0]} as ({CENTROIDS[1]})
    select label, cast(rank as int) as rank, vec_id, round(distance, 6) as distance_to_centroid from (
    select *, row_number() over (partition by label order by round(distance, 9), vec_id) as rank from (
      select e.label, vec_id, list_distance(embedding::double[], centre) as distance
      from embeddings e join centroids c on e.label = c.label) a) b where rank <= 5""",
)
def nearest(spark, sf_dir):
    points = embeddings(spark, sf_dir)
    distances = P.centroid_distances(F.col("embedding"), label_centroids(points))
    own = points.withColumn("distance_to_centroid", F.round(F.get(distances, F.col("label")), 9))
    ranked = P.nearest_to_centroid(own, cluster="label", key="vec_id")
    return ranked.select("label", "rank", "vec_id", F.round("distance_to_centroid", 6).alias("distance_to_centroid"))


@query(
    "v11_cluster_sizes",
    sql_over(
        "clustered",
        body="""select cluster_id, count(*) as review_count,
        round(count(*) / sum(count(*)) over () * 100, 2) as percentage from clustered group by 1""",
    ),
)
def sizes(spark, sf_dir):
    return P.cluster_sizes(fx.clustered(spark, sf_dir))


@query(
    "v12_topic_labels",
    sql_over("clustered", body="select review_id, cluster_id, topic_name from clustered"),
)
def topic_labels(spark, sf_dir):
    placed = fx.clustered(spark, sf_dir).select("review_id", "cluster_id")
    return P.add_topic_labels(placed, dict(fx.TOPIC_NAMES))


@query("v13_coordinates")
def coordinates(spark, sf_dir):
    points = embeddings(spark, sf_dir).withColumn("embedding", l2_normalise(F.col("embedding")))
    plane = P.plane_coordinates(points, "embedding", keep=("vec_id", "label"))
    return plane.withColumns({c: F.round(c, 6) for c in ("component_1", "component_2")})


@query(
    "v13b_coordinate_facts",
    "select count(*) as points, true as first_is_larger, true as at_right_angles from embeddings",
)
def coordinate_facts(spark, sf_dir):
    """The two axes carry falling shares and do not overlap."""
    points = embeddings(spark, sf_dir).withColumn("embedding", l2_normalise(F.col("embedding")))
    plane = P.plane_coordinates(points, "embedding", keep=("vec_id", "label"))
    a, b = F.col("component_1"), F.col("component_2")
    sums = plane.agg(
        F.count(F.lit(1)).alias("points"), F.sum(a * a).alias("aa"), F.sum(b * b).alias("bb"), F.sum(a * b).alias("ab")
    )
    return sums.select(
        "points",
        (F.col("aa") >= F.col("bb")).alias("first_is_larger"),
        (F.abs("ab") <= 1e-6 * F.sqrt(F.col("aa") * F.col("bb"))).alias("at_right_angles"),
    )


@query(
    "v15_centroid_distances",
    f"""with {CENTROIDS[0]} as ({CENTROIDS[1]})
    select vec_id, c.label as cluster_id, round(list_distance(embedding::double[], centre), 6) as distance
    from embeddings e cross join centroids c""",
)
def distances(spark, sf_dir):
    points = embeddings(spark, sf_dir)
    found = P.all_distances(points, label_centroids(points), "embedding", "vec_id")
    return found.withColumn("distance", F.round("distance", 6))
