"""Models, file round trips and plans: stated properties instead of fixed rows."""

import inspect
import json
import os

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

import __spark_entry__ as entry
from reviewloom.functions import blocks
from reviewloom.functions.text import classical_text
from reviewloom.operators import sentiment as M
from reviewloom.operators import sketches, stages
from reviewloom.operators import topics as T
from reviewloom.operators import tracking as K
from reviewloom.operators import vectorize as V
from reviewloom.plans import fixtures as fx
from reviewloom.plans import shapes, workflows
from reviewloom.session import scratch_path
from reviewloom.sources import files
from reviewloom.sources.models import load_topic_model, save_topic_model

QUERIES = entry.queries()


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    reviews = fx.reviews_labelled(spark, sf_dir)
    return reviews.select(
        "review_id", "review_text", "sentiment_label", classical_text(F.col("review_text")).alias("classical_text")
    ).cache()


@pytest.fixture(scope="module")
def represented(texts):
    return T.represent(texts, components=20, min_df=3)


def test_vectors_equal_the_relational_weights(texts):
    terms = V.fit_terms(texts, min_df=3)
    n = texts.count()
    counts = V.term_counts(texts)
    wanted = {
        (r["review_id"], r["term"]): r["weight"]
        for r in V.tfidf(counts, V.vocabulary(counts, n, min_df=3), n).collect()
    }
    rows = V.vectorise(texts, terms).select("review_id", "features").collect()
    got = {
        (r["review_id"], terms.terms[i]): v
        for r in rows
        for i, v in zip(r["features"]["indices"], r["features"]["values"])
    }
    assert got.keys() == wanted.keys()
    assert all(abs(got[k] - wanted[k]) < 1e-9 for k in got)


def test_svd_matches_numpy(represented):
    terms, basis, projected = represented
    rows = projected.select("features").collect()
    dense = np.zeros((len(rows), len(terms.terms)))
    for i, r in enumerate(rows):
        dense[i, r["features"]["indices"]] = r["features"]["values"]
    assert np.allclose(basis.T @ basis, np.eye(basis.shape[1]), atol=1e-8)
    exact = np.linalg.svd(dense, compute_uv=False)
    found = np.linalg.norm(dense @ basis, axis=0)
    assert np.allclose(found[:5], exact[:5], rtol=1e-3)
    ratio = T.explained_variance_ratio(projected, basis)
    assert ratio == pytest.approx((dense @ basis).var(axis=0).sum() / dense.var(axis=0).sum())
    assert 0 < ratio <= 1


def test_sparse_and_dense_products_agree():
    import pandas as pd

    rng = np.random.default_rng(1)
    for density in (0.002, 0.2):
        dense = rng.random((300, 500)) * (rng.random((300, 500)) < density)
        indices = pd.Series([np.flatnonzero(r) for r in dense])
        entries = pd.Series([r[r != 0] for r in dense])
        q, total, parts = rng.random((500, 7)), np.zeros((500, 7)), []
        for _, forward, backward in blocks.sparse_chunks(indices, entries, 500):
            parts.append(forward(q))
            total += backward(parts[-1])
        assert np.allclose(np.vstack(parts), dense @ q)
        assert np.allclose(total, dense.T @ (dense @ q))


def test_tree_addition_equals_direct(spark, monkeypatch):
    df = spark.range(0, 1000, 1, 16)

    def work(batches):
        total = np.zeros((300, 2))
        for batch in batches:
            for v in batch["id"]:
                total[v % 300] += (1.0, float(v))
        return total

    direct = blocks.add_matrices(df, work, 300, 2, 16)
    monkeypatch.setattr(blocks, "DIRECT_BYTES", 1000)
    monkeypatch.setattr(blocks, "FAN_IN", 4)
    assert np.array_equal(direct, blocks.add_matrices(df, work, 300, 2, 16))
    assert direct[:, 0].sum() == 1000


def test_kmeans_rows_are_at_their_nearest_centroid(represented):
    _, _, projected = represented
    models = T.kmeans(projected, [2, 4, 6], restarts=5)
    inertias = [models[k][1] for k in (2, 4, 6)]
    assert inertias == sorted(inertias, reverse=True)
    centres = models[4][0]
    rows = T.assign(projected, centres).select("lsa", "cluster_id", "distance_to_centroid").collect()
    gaps = np.linalg.norm(np.array([r["lsa"] for r in rows])[:, None] - centres[None], axis=2)
    assert [r["cluster_id"] for r in rows] == gaps.argmin(axis=1).tolist()
    assert sum(r["distance_to_centroid"] ** 2 for r in rows) == pytest.approx(models[4][1], rel=1e-3)


def test_kmeans_starts_from_all_rows(spark):
    """A far cluster of 3 rows in 60,000 is found; a sample of some thousand rows would miss it."""
    noise = (F.xxhash64("review_id") % 1000) / 10000.0
    far = F.when(F.col("review_id") % 20_000 == 7, 50.0).otherwise(0.0)
    rows = spark.range(0, 60_000, 1, 8).withColumnRenamed("id", "review_id")
    rows = rows.select("review_id", F.array(noise + far, noise, F.lit(1.0)).alias("lsa")).cache()
    centres, inertia = T.kmeans(rows, [2], restarts=2)[2]
    assert sorted(round(c) for c in centres[:, 0]) == [0, 50]
    assert inertia < 60_000 * 0.02


def test_kmeans_with_fewer_points_than_centroids(spark):
    rows = spark.range(6).select(F.col("id").alias("review_id"), F.array(F.col("id") % 2 * 1.0).alias("lsa")).cache()
    _, inertia = T.kmeans(rows, [3], restarts=2)[3]
    assert inertia == 0.0


def test_model_comparison_refuses_other_rows(spark):
    from reviewloom.operators import evaluation as E

    schema = "review_id bigint, text string, true_label string, predicted_label string"
    first = spark.createDataFrame([(1, "a", "positive", "negative"), (2, "b", "neutral", "neutral")], schema)
    same = first.withColumn("predicted_label", F.lit("neutral"))
    got = E.compare_models(first, same, "x", "y").orderBy("review_id").collect()
    assert [(r["review_id"], r["outcome"], r["disagree"]) for r in got] == [(1, "shared_errors", True)]
    for other in (same.where("review_id = 1"), same.withColumn("true_label", F.lit("neutral"))):
        for pair in ((first, other), (other, first)):
            with pytest.raises(Exception, match="same rows and labels"):
                E.compare_models(*pair, "x", "y").collect()


def test_cleaned_rows_are_checked(spark):
    from reviewloom.operators import cleaning as C

    schema = "review_text string, rating double, sentiment_label string"
    good = ("fine", 4.0, "positive")
    assert C.require_clean_rows(spark.createDataFrame([good], schema)).count() == 1
    broken = {
        "missing_text": (None, 4.0, "positive"),
        "empty_text": ("", 4.0, "positive"),
        "rating_range": ("fine", None, "positive"),
        "unknown_label": ("fine", 4.0, "unsure"),
    }
    for rule, row in broken.items():
        with pytest.raises(Exception, match=rule):
            C.require_clean_rows(spark.createDataFrame([good, row], schema)).count()


def test_sweep_rows(represented):
    _, basis, projected = represented
    rows = T.sweep_cluster_counts(projected, basis, [1, 2, 5, 10**6], restarts=3).orderBy("n_clusters").collect()
    assert [r["n_clusters"] for r in rows] == [2, 5]
    assert rows[0]["inertia"] > rows[1]["inertia"]
    assert all(-1 <= r["silhouette_score"] <= 1 for r in rows)
    with pytest.raises(ValueError):
        T.sweep_cluster_counts(projected, basis, [1])


def test_silhouette_against_brute_force(spark):
    rng = np.random.default_rng(3)
    points, labels = rng.normal(size=(60, 4)), rng.integers(0, 3, 60)
    labels[0] = 9  # a singleton scores 0
    df = spark.createDataFrame([(i, p.tolist(), int(c)) for i, (p, c) in enumerate(zip(points, labels))], "id int, v array<double>, c int")
    gaps = np.linalg.norm(points[:, None] - points[None], axis=2)
    scores = []
    for i in range(60):
        same = (labels == labels[i]) & (np.arange(60) != i)
        if not same.any():
            scores.append(0.0)
            continue
        a = gaps[i, same].mean()
        b = min(gaps[i, labels == c].mean() for c in set(labels) - {labels[i]})
        scores.append((b - a) / max(a, b))
    row = T.silhouette(df, "v", "c", "id").first()
    assert row["silhouette"] == pytest.approx(np.mean(scores))
    assert (row["sampled_rows"], row["clusters"]) == (60, 4)
    one = T.silhouette(df.withColumn("c", F.lit(1)), "v", "c", "id").first()
    assert one["silhouette"] is None


def test_discover_save_and_predict(spark, texts):
    model, labelled, terms, nearest = workflows.discover_topics(texts, 4, components=10, restarts=3, min_df=3)
    assert set(model.topic_names) == set(range(4)) and len(set(model.topic_names.values())) == 4
    loaded = load_topic_model(spark, save_topic_model(spark, model, scratch_path(spark, "m")))
    predicted = T.predict_topics(texts, loaded).select("review_id", "cluster_id", "topic_name")
    fitted = labelled.select("review_id", F.col("cluster_id").alias("c"), F.col("topic_name").alias("n"))
    both = fitted.join(predicted, "review_id")
    assert both.where("c <> cluster_id or n <> topic_name").count() == 0 and both.count() == labelled.count()
    assert terms.groupBy("cluster_id").count().agg(F.max("count")).first()[0] <= 12
    assert nearest.groupBy("cluster_id").count().agg(F.max("count")).first()[0] <= 5
    with pytest.raises(ValueError, match="missing"):
        load_topic_model(spark, scratch_path(spark, "nothing"))
    with pytest.raises(Exception, match="no topic name"):
        T.add_topic_labels(labelled, {0: "only"}).select("topic_name").collect()


def test_classifier_learns_and_matches_the_library(spark):
    rows = []
    words = {"negative": "bad broken awful", "neutral": "fine average okay", "positive": "great love excellent"}
    for i in range(90):
        label = list(words)[i % 3]
        rows.append((i, f"{words[label]} device number {'abcdefghij'[i % 10]}x", label))
    df = spark.createDataFrame(rows, "review_id int, classical_text string, sentiment_label string")
    model = M.train_classifier(df, min_df=1)
    scored = M.predict(df, model)
    assert scored.where("predicted_sentiment = sentiment_label").count() == 90
    total = F.col("probability_negative") + F.col("probability_neutral") + F.col("probability_positive")
    assert scored.where(F.abs(total - 1) > 1e-9).count() == 0
    library = M.probabilities_of(model, V.vectorise(df, model.terms)).select("review_id", "probabilities")
    far = scored.join(library, "review_id").where(F.abs(F.col("probabilities")[0] - F.col("probability_negative")) > 1e-9)
    assert far.count() == 0
    top = M.top_features(spark, model, 3).where("sentiment_class = 'positive'").collect()
    assert len(top) == 3 and any(w in top[0]["feature"] for w in ("great", "love", "excellent"))
    record = M.predict_one(spark, model, "awful broken device").first()
    assert record["label"] == "negative" and set(record["probabilities"]) == {"negative", "neutral", "positive"}
    path = scratch_path(spark, "clf")
    M.save_model(spark, model, path)
    again = M.predict(df, M.load_model(spark, path)).select("review_id", F.col("predicted_sentiment").alias("p"))
    assert again.join(scored, "review_id").where("p <> predicted_sentiment").count() == 0


def test_pluggable_predictor(spark):
    def load():
        def score(batch):
            return [[1.0 if "bad" in t else 0.0, 0.0, 1.0 if "good" in t else 0.0] for t in batch]

        return score

    df = spark.createDataFrame([(1, "bad"), (2, "good"), (3, None)], "review_id int, t string")
    rows = M.predict_with(df, load, "t").orderBy("review_id").collect()
    assert [r["predicted_sentiment"] for r in rows] == ["negative", "positive", "negative"]


def test_export_and_status(spark, sf_dir):
    root = scratch_path(spark, "artifacts")
    reviews = fx.clustered(spark, sf_dir)
    assert not files.artifacts_available(files.artifact_status(spark, root, workflows.ARTIFACTS)).first()[0]
    status = workflows.ensure_artifacts(reviews, root, "2024-01-31T00:00:00")
    assert files.artifacts_available(status).first()[0]
    document = json.loads(spark.read.text(f"{root}/report.json").first()[0])
    assert len(document["topics"]) == 6 and len(document["recommendations"]) == 6
    lines = [r[0] for r in spark.read.text(f"{root}/report.md").collect()]
    assert lines[0].endswith("Executive Review Report") and "## Recommendations" in lines
    dashboard = json.loads(spark.read.text(f"{root}/dashboard.json").first()[0])
    assert set(dashboard) == {"overview", "topics", "recommendations"}


def test_malformed_json_fails(spark, tmp_path):
    (tmp_path / "x.json").write_text("{broken")
    with pytest.raises(Exception):
        files.read_json(spark, str(tmp_path / "x.json"), "a int").collect()


def test_prepare_reviews_from_two_sources(spark, tmp_path):
    (tmp_path / "one.csv").write_text('name,reviews.text,reviews.rating,reviews.title\nA,"good, really\nnice",5,T\nA,,4,T\n')
    (tmp_path / "two.csv").write_text("reviews.text,reviews.rating,id\nbad thing here,1,x\nbad thing here,1,y\n")
    tables = files.read_all(spark, {"one": str(tmp_path / "one.csv"), "two": str(tmp_path / "two.csv")})
    numbered = [t.withColumn("review_id", F.monotonically_increasing_id() + i * 1000) for i, t in enumerate(tables.values())]
    out = workflows.prepare_reviews(numbered).orderBy("review_id").collect()
    assert [r["review_text"] for r in out] == ["good, really nice", "bad thing here"]
    assert [r["source_dataset"] for r in out] == ["one", "two"]
    assert out[1]["classical_text"] == "bad thing"


@pytest.mark.parametrize("key", ["v14_predict_topics", "s09_model_roundtrip"])
def test_predictions_equal_training(spark, sf_dir, key):
    df = QUERIES[key](spark, sf_dir)
    assert df.count() > 0 and df.where("not same").count() == 0


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", ["c11_exact_dedup", "c13_clean_dataset", "t02_normalized_dedup", "t07_text_features"])
def test_deduplication_deals_no_texts(spark, sf_dir, key, monkeypatch):
    monkeypatch.setattr(shapes, "spread_small", lambda df, key: df)
    monkeypatch.setattr(fx, "spread_small", lambda df, key: df)
    plan = physical(QUERIES[key](spark, sf_dir))
    assert "SortAggregate" not in plan and "Window" not in plan
    dealt = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]
    assert not any("digest" in x or "text" in x for x in dealt)


def test_keep_first_agrees_with_the_row_aggregate(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(i, int(rng.integers(0, 40)) if i % 3 else 7, f"text {i % 5}") for i in range(400)]
    df = spark.createDataFrame(rows, "review_id bigint, a bigint, b string").repartition(5)
    wanted = sorted(tuple(r) for r in shapes._keep_first_by_rows(df, ["a", "b"], "review_id").collect())
    assert sorted(tuple(r) for r in shapes.keep_first(df, ["a", "b"]).collect()) == wanted
    # Too many losers to broadcast: the Bloom filter parts suspects from the rest.
    monkeypatch.setattr(shapes, "BROADCAST_ROWS", 10)
    two_ways = shapes.keep_first(df, ["a", "b"])
    assert sorted(tuple(r) for r in two_ways.collect()) == wanted
    monkeypatch.setattr(shapes, "MOST_BLOOM_BITS", 1 << 6)
    assert sorted(tuple(r) for r in shapes.keep_first(df, ["a", "b"]).collect()) == wanted


@pytest.mark.parametrize("odd", [None, 3])
def test_keep_first_with_ids_that_repeat_or_are_missing(spark, odd):
    rows = [(1, "x"), (2, "x"), (odd, "y"), (odd, "y"), (3, "z")]
    df = spark.createDataFrame(rows, "review_id bigint, b string")
    got = shapes.keep_first(df, ["b"]).collect()
    assert sorted(r.b for r in got) == ["x", "y", "z"]
    assert [r.review_id for r in got if r.b == "x"] == [1]


def test_bloom_filter_holds_all_its_keys(spark):
    keys = spark.range(0, 3000, 3).withColumnRenamed("id", "k")
    test = shapes.bloom_test(keys, "k", 1000)
    found = spark.range(3000).withColumnRenamed("id", "k").withColumn("hit", test).collect()
    assert all(r.hit for r in found if r.k % 3 == 0)
    assert sum(r.hit for r in found if r.k % 3) < 200


@pytest.mark.parametrize("small", [5, 10_000])
def test_split_has_exact_quotas_and_one_scan(spark, monkeypatch, small):
    import hashlib

    monkeypatch.setattr(shapes, "SMALL_BUCKET", small)
    rows = [(i, "ab"[i % 7 == 0]) for i in range(2000)] + [(5000 + i, None) for i in range(9)]
    df = spark.createDataFrame(rows, "review_id bigint, sentiment_label string")
    split = M.stratified_split(df)
    assert "Exchange hashpartitioning" not in physical(split) and "SortMergeJoin" not in physical(split)
    got = {r.review_id: r.split for r in split.collect()}
    assert len(got) == len(rows)
    for label in ("a", "b", None):
        ids = [i for i, l in rows if l == label]
        ids.sort(key=lambda i: (hashlib.md5(f"42:{i}".encode()).hexdigest(), i))
        test = int(len(ids) * 0.2 + 0.5)
        validation = int((len(ids) - test) * 0.2 + 0.5)
        wanted = ["test"] * test + ["validation"] * validation
        wanted += ["train"] * (len(ids) - len(wanted))
        assert [got[i] for i in ids] == wanted


def test_silhouette_of_all_rows_against_brute_force(spark):
    rng = np.random.default_rng(4)
    points, labels = rng.normal(size=(70, 3)), rng.integers(0, 4, 70)
    labels[0] = 11
    rows = [(p.tolist(), int(c)) for p, c in zip(points, labels)] + [(None, 1), ([1.0, 1.0, 1.0], None)]
    df = spark.createDataFrame(rows, "v array<double>, c int")
    gaps = ((points[:, None] - points[None]) ** 2).sum(axis=2)
    scores = []
    for i in range(70):
        same = (labels == labels[i]) & (np.arange(70) != i)
        a = gaps[i, same].mean() if same.any() else 0.0
        b = min(gaps[i, labels == c].mean() for c in set(labels) - {labels[i]})
        scores.append((b - a) / max(a, b) if same.any() else 0.0)
    row = T.silhouette_of_all(df, "v", "c").first()
    assert (row["rows"], row["clusters"]) == (70, 5)
    assert row["silhouette"] == pytest.approx(np.mean(scores))
    assert T.silhouette_of_all(df.withColumn("c", F.lit(1)), "v", "c").first()["silhouette"] is None
    assert T.silhouette_of_all(df.where("false"), "v", "c").first()["rows"] == 0


def test_quantile_sketches_of_parts_are_united_within_their_error(spark):
    rng = np.random.default_rng(6)
    rows = [(i % 3, float(v)) for i, v in enumerate(rng.lognormal(size=20_000))]
    df = spark.createDataFrame(rows, "part int, v double").repartition(4)
    parts = sketches.quantile_sketches(df, {"v": F.col("v")}, ["part"], rank_error=0.01)
    assert parts.count() == 3
    united = sketches.unite_quantiles(parts, rank_error=0.01)
    found = sketches.quantiles_of(united, (0.1, 0.5, 0.99)).collect()
    values = np.sort([v for _, v in rows])
    for r in found:
        assert abs(np.searchsorted(values, r["value"]) / len(values) - r["fraction"]) < 0.02
    assert max(len(r["sketch"]) for r in parts.collect()) < 20_000
    with pytest.raises(ValueError):
        sketches.kll_size(1e-9)


def test_distinct_sketches_do_not_depend_on_the_parts(spark):
    df = spark.range(60_000).selectExpr("id % 4 as part", "id % 20000 as v", "cast(null as string) as none")
    values = {"v": F.col("v"), "none": F.col("none")}
    parts = sketches.distinct_sketches(df, values, ["part"])
    united = sketches.distinct_estimates(sketches.unite_distinct(parts)).collect()
    whole = sketches.distinct_estimates(sketches.unite_distinct(sketches.distinct_sketches(df, values))).collect()
    assert [(r["measure"], r["estimate"]) for r in united] == [(r["measure"], r["estimate"]) for r in whole]
    assert abs(united[0]["estimate"] / 20_000 - 1) < 0.07
    shared = {(r["left"], r["right"]): r["shared"] for r in sketches.overlap_estimates(parts, "part").collect()}
    assert len(shared) == 6 and all(v >= 0 for v in shared.values())


def test_writers_at_once_lose_no_run(spark):
    import threading

    path = scratch_path(spark, "shared_runs")
    failed = []

    def write(name):
        try:
            K.log_experiment(spark, path, K.experiment_row(spark, {"macro_f1": 0.5}, model_id=name))
        except Exception as error:  # noqa: BLE001
            failed.append(error)

    writers = [threading.Thread(target=write, args=(f"m{i}",)) for i in range(6)]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    assert not failed
    table = files.read_logged(spark, path, K.TRACKING_SCHEMA, "model_id")
    assert sorted(r["model_id"] for r in table.collect()) == [f"m{i}" for i in range(6)]
    # An entry whose writer was lost before it was recorded is not read.
    table.coalesce(1).write.parquet(f"{path}/data/entry=99999999T000000000000-lost")
    assert files.read_logged(spark, path, K.TRACKING_SCHEMA, "model_id").count() == 6


def test_pipelines_survive_saving(spark, texts):
    small = texts.select("review_id", "review_text", "sentiment_label").limit(120)
    topics = stages.topic_pipeline(k=3, components=5).fit(small)
    path = scratch_path(spark, "pipeline")
    topics.write().save(path)
    loaded = PipelineModel.load(path)
    assert [type(s).__name__ for s in loaded.stages] == ["ClassicalText", "TopicFinderModel"]
    one = {r["review_id"]: r["cluster_id"] for r in topics.transform(small).collect()}
    two = {r["review_id"]: r["cluster_id"] for r in loaded.transform(small).collect()}
    assert one == two and set(one.values()) <= {0, 1, 2}
    assert loaded.stages[1].uid == topics.stages[1].uid


def test_heavy_tokens_meet_the_dictionary_apart(spark, monkeypatch):
    from reviewloom.operators import features

    monkeypatch.setattr(features, "HEAVY_TOKENS", 2)
    rows = [(i, "same " * 50 + f"w{i} the cats") for i in range(30)] + [(99, "")]
    df = spark.createDataFrame(rows, "review_id int, classical_text string")
    words = [("same", "one"), ("cats", "cat"), ("w3", "third"), ("w3", "zzz"), ("unused", "x")]
    lemmas = spark.createDataFrame(words, "token string, lemma string")
    out = {r[0]: r[1] for r in features.lemmatise_with_dictionary(df, lemmas).select("review_id", "classical_text").collect()}
    assert out[3] == ("one " * 50 + "third the cat").strip() and out[4].endswith("w4 the cat") and out[99] == ""


def test_krylov_subspace_holds_as_much_as_the_exact_one(represented):
    terms, basis, projected = represented
    rows = projected.select("features").collect()
    dense = np.zeros((len(rows), len(terms.terms)))
    for i, r in enumerate(rows):
        dense[i, r["features"]["indices"]] = r["features"]["values"]
    best = (np.linalg.svd(dense, compute_uv=False)[: basis.shape[1]] ** 2).sum()
    assert (np.linalg.norm(dense @ basis) ** 2) > 0.99 * best


def test_term_counts_are_row_local(spark, sf_dir):
    texts = fx.reviews_labelled(spark, sf_dir).selectExpr("review_id", "review_text as classical_text")
    assert "Exchange" not in physical(V.term_counts(texts)).split("BroadcastExchange")[0]
    vocabulary = physical(V.vocabulary(V.term_counts(texts), 10))
    assert "review_text" not in "".join(x for x in vocabulary.splitlines() if "Exchange hash" in x)


def test_ranking_queries_trim_before_the_shuffle(spark, sf_dir):
    plan = physical(QUERIES["v09_top_terms"](spark, sf_dir))
    assert "WindowGroupLimit" in plan


@pytest.mark.parametrize("key", ["t07_text_features", "i08_topic_sentiment", "r07_ranked", "e04_benchmark_row"])
def test_no_cross_products(spark, sf_dir, key):
    plan = physical(QUERIES[key](spark, sf_dir))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_scans_read_only_what_is_needed(spark, sf_dir):
    plan = physical(QUERIES["i05_topics"](spark, sf_dir))
    assert "source:string" not in plan and "lang:string" not in plan


def test_no_local_checkpoint_in_the_package():
    root = os.path.dirname(inspect.getfile(shapes))
    package = os.path.dirname(root)
    for folder, _, names in os.walk(package):
        for name in names:
            if name.endswith(".py"):
                with open(os.path.join(folder, name), encoding="utf-8") as handle:
                    text = handle.read()
                assert "localCheckpoint" not in text and "toPandas" not in text and "crossJoin" not in text
