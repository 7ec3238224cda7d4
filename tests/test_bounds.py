"""What a step holds or sends does not grow with its batches, and dear work is done once."""

import numpy as np
import pyarrow as pa
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F
from pyspark.util import PythonEvalType

from reviewloom import settings as S
from reviewloom.catalog import profiling
from reviewloom.functions import blocks
from reviewloom.functions import text as X
from reviewloom.operators import sentiment as M
from reviewloom.operators import topics as P
from reviewloom.operators import vectorize as V


def test_texts_are_made_once_for_a_topic_model(spark):
    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def dear(value):
        made.add(1)
        return value

    rows = [(i, f"{'red' if i % 2 else 'blue'} {'sky' if i % 3 else 'sea'} w{i % 5}x") for i in range(40)] + [(99, " ")]
    df = spark.createDataFrame(rows, "review_id bigint, t string").select(
        "review_id", dear("t").alias("classical_text")
    )
    _, _, projected = P.represent(df, components=2, min_df=1, max_df=1.0)
    assert projected.count() == 40
    assert made.value == 41
    P.release(projected)


def test_start_rounds_return_counts_and_costs_only(spark):
    points = np.random.default_rng(5).standard_normal((3000, 4))
    df = spark.createDataFrame([(list(map(float, p)),) for p in points], "v array<double>").coalesce(1)
    models = [points[:3], points[3:8]]
    whole = P._lloyd_pass(df, "v", models, 1)
    short = P._lloyd_pass(df, "v", models, 1, sums=False)
    for centres, a, b in zip(models, whole, short, strict=True):
        gaps = ((points[:, None, :] - centres[None]) ** 2).sum(axis=2)
        own = gaps.argmin(axis=1)
        assert b.shape == (len(centres), 2) and np.allclose(a[:, :2], b)
        assert np.array_equal(a[:, 0], np.bincount(own, minlength=len(centres)))
        assert np.allclose(a[:, 1], np.bincount(own, weights=gaps.min(axis=1), minlength=len(centres)))
        assert np.allclose(a[:, 2:], [points[own == i].sum(axis=0) for i in range(len(centres))])


def test_sparse_rows_are_worked_on_in_slices(monkeypatch):
    monkeypatch.setattr(blocks, "SLICE", 4)
    lists = pa.array([[], [1, 2], [3, 4, 5], [], [6, 7, 8, 9, 10, 11], [], [12]], pa.list_(pa.int32()))
    flat, _, ends = blocks.flat_lists(lists, lists)
    slices = list(blocks.row_slices(ends))
    assert [s[:2] for s in slices] == [(0, 2), (2, 5), (5, 11), (11, 12)]
    assert all(len(r) == b - a for a, b, r in slices)
    assert blocks.lists_of(flat, ends).to_pylist() == lists.to_pylist()
    assert list(blocks.row_slices(np.zeros(0, dtype=np.int64))) == []


def test_texts_go_to_python_a_hundred_at_a_time():
    for step in (X._decode_entities, X._fold_unicode):
        assert step.evalType == PythonEvalType.SQL_BATCHED_UDF


def test_partial_matrices_of_twelve_slots_are_added_before_the_driver():
    width = S.SVD_COMPONENTS // 2 + 10
    assert 12 * S.TOPIC_VOCABULARY["max_features"] * width * 8 > blocks.DIRECT_BYTES


def test_vocabulary_sketches_split_the_texts_twice(spark, monkeypatch):
    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def dear(value):
        made.add(1)
        return value

    rows = [(f"s{i % 3}" if i % 7 else None, f"One two  w{i % 11} W{i % 5}" if i else None) for i in range(30)]
    raw = spark.createDataFrame(rows, "source_dataset string, review_text string").withColumn(
        "review_text", dear("review_text")
    )
    monkeypatch.setattr(profiling.fx, "reviews_raw", lambda *_: raw)
    found = {r[0]: (r[1], r[2]) for r in profiling.vocabulary_sketches(spark, "").collect()}
    words = [(s, w) for s, text in rows for w in (text or "").lower().split()]
    names = {s for s, _ in words if s}
    expected = {n: (len({w for s, w in words if s == n}), True) for n in names}
    assert found == {**expected, "all": (len({w for _, w in words}), True)}
    assert made.value == 2 * len(rows)


def test_a_fit_keeps_one_copy_of_the_training_rows(spark, monkeypatch):
    cached = []
    fit = M.LogisticRegression.fit

    def watched(self, dataset):
        cached.append(spark.sparkContext._jsc.getPersistentRDDs().size())
        return fit(self, dataset)

    monkeypatch.setattr(M.LogisticRegression, "fit", watched)
    rows = [(i, "red sky" if i % 2 else "blue sea", "negative" if i % 2 else "positive") for i in range(40)]
    df = spark.createDataFrame(rows, "review_id bigint, classical_text string, sentiment_label string")
    spark.catalog.clearCache()
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    model = M.train_classifier(df, min_df=1, max_df=1.0)
    assert model.labels == ["negative", "positive"]
    assert cached[0] - before == 1


def test_scores_are_one_step_in_python(spark):
    rows = [(i, "red sky" if i % 2 else "blue sea", "negative" if i % 2 else "positive") for i in range(40)]
    df = spark.createDataFrame(rows, "review_id bigint, classical_text string, sentiment_label string")
    model = M.train_classifier(df, min_df=1, max_df=1.0)
    odd = spark.createDataFrame([(1, "red red sky"), (2, None), (3, "unknown"), (4, "sea blue")], "review_id bigint, classical_text string")
    scored = M.predict(odd, model)
    assert scored._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    library = M.probabilities_of(model, V.vectorise(odd, model.terms)).select("review_id", "probabilities")
    both = scored.join(library, "review_id").collect()
    assert len(both) == 4
    for r in both:
        assert np.allclose([r["probability_negative"], r["probability_positive"]], r["probabilities"], atol=1e-12)


def test_vectors_are_wrapped_without_a_copy_per_row(spark):
    df = spark.createDataFrame([(([0, 3], [1.0, 2.0]),), (([], []),)], f"features struct<{V.SPARSE}>")
    wrapped = V.as_vector(df.coalesce(1), 5)
    assert "wrap(" in (plan := wrapped._jdf.queryExecution().executedPlan().toString())
    assert int(plan.split("ArrowEvalPython", 1)[1].split("], ")[2].split("\n")[0]) == PythonEvalType.SQL_SCALAR_ARROW_UDF
    assert [r[0] for r in wrapped.collect()] == [Vectors.sparse(5, [0, 3], [1.0, 2.0]), Vectors.sparse(5, [], [])]


def test_pairs_are_joined_by_plain_concatenation(spark):
    pairs = X.with_bigrams(X.word_tokens(F.col("t")))
    df = spark.createDataFrame([("One two  three",), ("alone",), ("",), (None,)], "t string").coalesce(1)
    made = df.select(pairs.alias("p"))
    assert "concat_ws" not in made._jdf.queryExecution().executedPlan().toString()
    assert [r[0] for r in made.collect()] == [["one", "two", "three", "one two", "two three"], ["alone"], [], None]


def made_reviews(spark, n=400):
    """(review_id, classical_text): two kinds of text, one without a known word, one blank."""
    rows = [(i, f"{'red' if i % 2 else 'blue'} {'sky' if i % 3 else 'sea'} w{i % 5}x w{i % 7}y") for i in range(n)]
    return spark.createDataFrame([*rows, (n, " ")], "review_id bigint, classical_text string").coalesce(2)


def cached_tables(spark):
    return spark.sparkContext._jsc.getPersistentRDDs().size()


def test_texts_vectors_and_points_of_a_topic_model_are_not_cached(spark):
    df = made_reviews(spark)
    spark.catalog.clearCache()
    before = cached_tables(spark)
    _, basis, projected = P.represent(df, components=3, min_df=1, max_df=1.0)
    assert cached_tables(spark) == before
    assert "InMemoryTableScan" not in projected._jdf.queryExecution().executedPlan().toString()
    P.sweep_cluster_counts(projected, basis, [2, 3], restarts=2)
    assert cached_tables(spark) == before
    _, assigned = P.fit_topic_model(df, 2, components=3, restarts=2, min_df=1, max_df=1.0)
    assert cached_tables(spark) == before
    assert assigned.columns == ["review_id", "classical_text", "features", "lsa", "cluster_id", "distance_to_centroid"]
    assert assigned.count() == 400


def test_points_that_do_not_fit_in_memory_are_not_written_by_the_cache(spark, monkeypatch):
    levels = []
    kmeans = P.kmeans

    def watched(df, *args, **kw):
        levels.append(df.storageLevel)
        return kmeans(df, *args, **kw)

    monkeypatch.setattr(P, "kmeans", watched)
    _, basis, projected = P.represent(made_reviews(spark), components=3, min_df=1, max_df=1.0)
    P.sweep_cluster_counts(projected, basis, [2], restarts=1)
    assert [(x.useMemory, x.useDisk) for x in levels] == [(True, False)]


def test_passes_over_vectors_take_small_batches(spark):
    name = blocks.ARROW_ROWS
    before = spark.conf.get(name)
    df = spark.range(2 * blocks.BATCH_ROWS + 500, numPartitions=1)

    def work(batches):
        return np.array([[max(len(b) for b in batches)]], dtype=float)

    try:
        for given, expected in (("0", blocks.BATCH_ROWS), ("10000", blocks.BATCH_ROWS), ("300", 300)):
            spark.conf.set(name, given)
            assert blocks.add_matrices(df, work, 1, 1, 1)[0, 0] == expected
            assert spark.conf.get(name) == given
    finally:
        spark.conf.set(name, before)


def test_distances_to_many_centroids_come_in_few_rows():
    rows = blocks.pd.Series(list(np.random.default_rng(2).standard_normal((3000, 4))))
    for n in (2, 1080, 8820, 10 * blocks.CELLS):
        slices = list(P._dense_slices(rows, n))
        assert all(len(x) == 1 or len(x) * n <= blocks.CELLS for _, x in slices)
        assert all(len(x) <= blocks.DENSE_ROWS for _, x in slices)
        assert [at for at, _ in slices] == list(np.cumsum([0] + [len(x) for _, x in slices])[:-1])
        assert sum(len(x) for _, x in slices) == len(rows)


def test_topics_are_predicted_in_one_step_in_python(spark):
    df = made_reviews(spark)
    model, assigned = P.fit_topic_model(df, 3, components=4, restarts=2, min_df=1, max_df=1.0)
    odd = df.unionByName(
        spark.createDataFrame([(1000, None), (1001, "unknown"), (1002, "sea sea blue")], df.schema)
    ).coalesce(2)
    predicted = P.predict_topics(odd, model)
    for made in (predicted, assigned):
        assert made._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert predicted.columns == ["review_id", "classical_text", "cluster_id", "distance_to_centroid"]
    steps = P.project(V.vectorise(odd, model.terms), model.components)
    plain = {r["review_id"]: np.array(r["lsa"]) for r in steps.collect()}
    found = {r["review_id"]: r for r in predicted.collect()}
    assert found.keys() == plain.keys() and len(found) == 404
    for i, x in plain.items():
        gaps = np.sqrt(((model.centres - x) ** 2).sum(axis=1))
        assert np.isclose(found[i]["distance_to_centroid"], gaps.min(), atol=1e-9)
        assert np.isclose(gaps[found[i]["cluster_id"]], gaps.min(), atol=1e-9)
    assert np.allclose(plain[1000], 0.0) and np.allclose(plain[1001], 0.0)
    for r in assigned.collect():
        assert np.allclose(r["lsa"], plain[r["review_id"]], atol=1e-9)
        assert r["cluster_id"] == found[r["review_id"]]["cluster_id"]
