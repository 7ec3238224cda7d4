"""Small frames with literal expected rows."""

import pytest
from pyspark.sql import functions as F

from reviewloom import settings as S
from reviewloom.functions import text as X
from reviewloom.functions.numbers import format_percentage
from reviewloom.operators import cleaning as C
from reviewloom.operators import evaluation as E
from reviewloom.operators import features as P
from reviewloom.operators import insights as I
from reviewloom.operators import labeling as L
from reviewloom.operators import recommendations as R
from reviewloom.operators import sentiment as M
from reviewloom.operators import topics as T
from reviewloom.operators import tracking as K
from reviewloom.session import scratch_path


def values(df, *names):
    return [tuple(r) for r in df.select(*names).collect()]


def test_ratings_keep_one_to_five_as_tinyint(spark):
    df = spark.createDataFrame([(v,) for v in ("0", "1", "3", "5", "6", "x", "4.5", "0.9")], "rating string")
    out = C.valid_ratings(df)
    assert dict(out.dtypes)["rating"] == "tinyint"
    assert sorted(r[0] for r in out.collect()) == [1, 3, 4, 5]


def test_labels_from_ratings(spark):
    df = spark.createDataFrame([(i,) for i in range(1, 6)], "rating int")
    assert [r[1] for r in C.add_sentiment_label(df).orderBy("rating").collect()] == [
        "negative", "negative", "neutral", "positive", "positive",
    ]


def test_missing_column_is_an_error(spark):
    with pytest.raises(ValueError):
        C.drop_missing(spark.createDataFrame([(1,)], "rating int"))


def test_normaliser_steps_in_order(spark):
    cases = {
        None: "",
        "a &amp; b": "a & b",
        "it&#39;s": "it's",
        "&lt;b&gt;bold&lt;/b&gt; text": "bold text",
        "x<script type='a'>var y = '<p>';</script>y": "x y",
        "a<!-- hidden\nthing -->b": "a b",
        "see https://example.com/a?b=1 now": "see now",
        "at www.example.com.": "at",
        "AT WWW.EXAMPLE.COM now": "AT now",
        "ﬁne": "fine",
        "a b": "a b",
        "a\u0007b​c": "abc",
        "plain\u0001text": "plaintext",
        "  many \t\n spaces here ": "many spaces here",
        "a < b > c": "a c",
    }
    rows = [(i, t) for i, t in enumerate(cases)]
    df = spark.createDataFrame(rows, "i int, t string").select("i", X.normalise_text(F.col("t")).alias("n"))
    assert [r["n"] for r in df.orderBy("i").collect()] == list(cases.values())


def test_exact_duplicates_keep_the_smallest_id(spark):
    rows = [(3, "a", "x", None), (1, "b", "x", None), (2, "a", "x", ""), (4, "a", "x", "")]
    df = spark.createDataFrame(rows, "review_id int, source_dataset string, text string, title string")
    assert sorted(values(C.drop_exact_duplicates(df), "review_id", "source_dataset", "title")) == [
        (1, "b", None), (2, "a", ""),
    ]


def test_clean_violations_raise(spark):
    df = spark.createDataFrame(
        [(1, "", "t", 3, "neutral"), (2, "x", "t", 9, "odd")],
        "review_id int, review_text string, review_title string, rating int, sentiment_label string",
    )
    found = dict(values(C.clean_violations(df), "rule", "violations"))
    assert found == {
        "missing_text": 0, "empty_text": 1, "rating_range": 1, "unknown_label": 1, "duplicate_rows": 0,
    }
    with pytest.raises(AssertionError):
        C.raise_on_violations(C.clean_violations(df), "table")


def test_classical_text(spark):
    df = spark.createDataFrame(
        [("I cannot find the BATTERIES, 3 boxes & women's watches! It is no glass.",)], "t string"
    )
    text = df.select(X.classical_text(F.col("t"))).first()[0]
    assert text == "not find battery box woman watch no glass"


def test_stop_words():
    words = set(X.topic_stop_words(["Extra "]))
    assert {"star", "stars", "five", "four", "three", "two", "one", "amazon", "extra", "the"} <= words
    assert not set(S.NEGATION_WORDS) & set(X.sentiment_stop_words())
    assert len(S.ENGLISH_STOP_WORDS) == len(set(S.ENGLISH_STOP_WORDS)) == 179


def test_lemma_dictionary(spark):
    reviews = spark.createDataFrame([(1, "better mice ran mice"), (2, "plain")], "review_id int, classical_text string")
    lemmas = spark.createDataFrame([("mice", "mouse"), ("better", "good")], "token string, lemma string")
    out = P.lemmatise_with_dictionary(reviews, lemmas)
    assert sorted(values(out, "review_id", "classical_text")) == [(1, "good mouse ran mouse"), (2, "plain")]


def test_split_quotas(spark):
    labels = ["positive"] * 150 + ["neutral"] * 90 + ["negative"] * 60
    df = spark.createDataFrame(list(enumerate(labels)), "review_id int, sentiment_label string")
    split = M.stratified_split(df).cache()
    assert split.count() == 300
    sizes = dict(values(split.groupBy("split").count(), "split", "count"))
    assert sizes["test"] == 60 and abs(sizes["train"] - 192) <= 1 and abs(sizes["validation"] - 48) <= 1
    assert split.select("split", "sentiment_label").distinct().count() == 9


BENCH = (
    "model_id string, model_name string, macro_f1 double, neutral_f1 double, negative_recall double, "
    "average_inference_ms double"
)


@pytest.mark.parametrize(
    "f1, neutral, ms, winner",
    [(0.805, 0.72, 15.0, "DistilBERT"), (0.86, 0.78, 18.0, "DeBERTa-v3-LoRA"), (0.90, 0.85, 60.0, "DistilBERT")],
)
def test_model_selection(spark, f1, neutral, ms, winner):
    rows = [("a", "DistilBERT", 0.80, 0.70, 0.75, 10.0), ("b", "DeBERTa-v3-LoRA", f1, neutral, 0.75, ms)]
    chosen = E.select_model(spark.createDataFrame(rows, BENCH)).first()
    assert chosen["model_name"] == winner
    assert winner.split("-")[0] in chosen["reason"]


def test_selection_without_candidates(spark):
    rows = [("a", "Other", 0.4, 0.7, 0.7, 1.0), ("b", "DistilBERT", 0.3, 0.7, 0.7, 1.0)]
    chosen = E.select_model(spark.createDataFrame(rows, BENCH)).first()
    assert chosen["model_name"] == "Other" and "not available" in chosen["reason"]


MATRIX = {
    ("negative", "negative"): 221, ("negative", "neutral"): 45, ("negative", "positive"): 29,
    ("neutral", "negative"): 51, ("neutral", "neutral"): 174, ("neutral", "positive"): 106,
    ("positive", "negative"): 114, ("positive", "neutral"): 404, ("positive", "positive"): 6420,
}


@pytest.fixture(scope="module")
def published(spark):
    cells = spark.createDataFrame([(*k, n) for k, n in MATRIX.items()], "true_label string, predicted_label string, n int")
    return cells.select("true_label", "predicted_label", F.explode(F.sequence(F.lit(1), "n"))).drop("col").cache()


def test_published_report(published):
    rows = {r["label"]: r for r in E.classification_report(published, S.SENTIMENT_LABELS).collect()}
    expected = {
        "negative": (0.572538860103627, 0.7491525423728813, 0.6490455212922174, 295),
        "neutral": (0.27929373996789725, 0.525679758308157, 0.36477987421383645, 331),
        "positive": (0.9794050343249427, 0.9253387143268954, 0.9516045356851701, 6938),
        "macro avg": (0.6104125447988223, 0.7333903383359779, 0.6551433103970746, 7564),
        "weighted avg": (0.9329002273673185, 0.9009783183500794, 0.9141251765903879, 7564),
        "accuracy": (0.9009783183500794,) * 4,
    }
    for label, numbers in expected.items():
        r = rows[label]
        assert (r["precision"], r["recall"], r["f1_score"], r["support"]) == pytest.approx(numbers, abs=1e-9)


def test_published_metrics_and_matrix(published):
    m = E.metrics(published).first()
    assert m["macro_f1"] == pytest.approx(0.6551433103970746)
    assert m["weighted_f1"] == pytest.approx(0.9141251765903879)
    row = {r["actual"]: r for r in E.confusion_matrix(published).collect()}["actual_neutral"]
    assert (row["predicted_negative"], row["predicted_neutral"], row["predicted_positive"]) == (51, 174, 106)


def test_contrast_words(spark):
    texts = ["good But late", "not yet", "all except one", "peanut butter"]
    df = spark.createDataFrame([(i, t, "a", "b") for i, t in enumerate(texts)], "review_id int, text string, true_label string, predicted_label string")
    rows = E.error_columns(df).orderBy("review_id").collect()
    assert [r["contains_contrast"] for r in rows] == [True, True, True, False]
    assert rows[0]["confidence"] is None and rows[0]["error_type"] == "a -> b"


def test_softmax_ties_and_large_values(spark):
    df = spark.createDataFrame([(1, [5.0, 5.0, 1.0]), (2, [1000.0, 0.0, 999.0])], "id int, logits array<double>")
    rows = M.from_logits(df).orderBy("id").collect()
    assert [r["predicted_sentiment"] for r in rows] == ["negative", "negative"]
    assert rows[1]["probability_positive"] == pytest.approx(0.2689414, abs=1e-6)


def named(spark, terms):
    lists = spark.createDataFrame(list(terms.items()), "cluster_id int, terms array<string>")
    return dict(values(L.suggest_topic_names(lists), "cluster_id", "topic_name"))


def test_names_follow_content(spark):
    assert named(spark, {
        0: ["battery", "brand", "long", "price"],
        1: ["echo", "alexa", "music", "home"],
        2: ["tablet", "kid", "price", "good"],
        3: ["kindle", "book", "read", "reader"],
    }) == {0: "Batteries", 1: "Echo & Alexa Devices", 2: "Fire Tablets", 3: "Kindle E-Readers & Books"}


def test_generic_clusters_get_distinct_markers(spark):
    names = named(spark, {
        0: ["great", "good", "love", "product", "price"],
        1: ["great", "good", "nice", "well", "use"],
    })
    assert all(n.startswith(S.UNCATEGORISED) for n in names.values()) and names[0] != names[1]


def test_published_topic_names(spark):
    tops = {
        0: ["tablet", "great tablet", "great", "kid", "good", "love", "tablet great", "good tablet"],
        1: ["easy", "easy use", "use", "great", "set", "love", "easy set", "tablet"],
        2: ["great", "good", "work", "love", "tv", "gift", "kid", "device"],
        3: ["battery", "brand", "good", "long", "great", "great battery", "good battery", "work"],
        4: ["echo", "alexa", "music", "love", "fun", "great", "home", "speaker"],
        5: ["kindle", "book", "read", "reading", "love", "reader", "great", "paperwhite"],
    }
    assert named(spark, tops) == {
        0: "Fire Tablets", 1: "General / uncategorized", 2: "Fire TV & Streaming",
        3: "Batteries", 4: "Echo & Alexa Devices", 5: "Kindle E-Readers & Books",
    }


def test_terms_list_accepts_lists(spark):
    df = spark.createDataFrame([(0, ["tablet", "kid"]), (1, ["battery", "long"])], "cluster_id int, top_terms array<string>")
    assert sorted(values(L.terms_list(df), "cluster_id", "terms")) == [(0, ["tablet", "kid"]), (1, ["battery", "long"])]


def test_cluster_shares(spark):
    sizes = [8437, 3853, 16432, 5420, 5788, 5427]
    df = spark.createDataFrame(list(enumerate(sizes)), "cluster_id int, n int")
    rows = df.select("cluster_id", F.explode(F.sequence(F.lit(1), "n"))).drop("col")
    assert dict(values(T.cluster_sizes(rows), "cluster_id", "percentage")) == {
        0: 18.6, 1: 8.49, 2: 36.23, 3: 11.95, 4: 12.76, 5: 11.97,
    }


def test_hooks_put_the_worst_first(spark):
    rows = [("Batteries", "negative")] * 4 + [("Batteries", "positive")] * 6
    rows += [("Fire Tablets", "negative")] + [("Fire Tablets", "positive")] * 9
    df = spark.createDataFrame(rows, "topic_name string, predicted_sentiment string")
    first = I.sentiment_hooks(df).first()
    assert first["topic"] == "Batteries" and "complaint" in first["hook"].lower()


def test_topic_sentiment_percentages(spark):
    rows = spark.createDataFrame([("positive", 4475), ("negative", 676), ("neutral", 269)], "sentiment_label string, n int")
    df = rows.select(F.lit("Batteries").alias("topic_name"), "sentiment_label", F.explode(F.sequence(F.lit(1), "n"))).drop("col")
    assert dict(values(I.topic_sentiment_shares(df), "sentiment_label", "sentiment_percentage")) == {
        "positive": 82.56, "negative": 12.47, "neutral": 4.96,
    }


def test_published_recommendations_use_raw_counts(spark):
    sizes = {2: ("Fire TV & Streaming", 16432, 805), 0: ("Fire Tablets", 8437, 219), 4: ("Echo & Alexa Devices", 5788, 150),
             5: ("Kindle E-Readers & Books", 5427, 200), 3: ("Batteries", 5420, 700), 1: ("General / uncategorized", 3853, 36)}
    topics = spark.createDataFrame([(k, n, s) for k, (n, s, _) in sizes.items()], "cluster_id int, topic_name string, review_count int")
    sentiment = spark.createDataFrame([(k, s - x, x) for k, (_, s, x) in sizes.items()], "cluster_id int, positive int, negative int")
    rows = R.ranked(R.topic_metrics(topics, sentiment)).orderBy("rank").collect()
    assert [r["topic_id"] for r in rows] == [2, 0, 4, 5, 3, 1]
    assert [r["severity"] for r in rows] == [6632.8, 3434.8, 2375.2, 2230.8, 2228.0, 1562.8]
    assert [r["priority"] for r in rows] == ["High"] * 5 + ["Medium"]
    assert rows[-1]["negative_ratio"] == 0.36
    assert rows[4]["recommendation"] == S.FALLBACK_TEMPLATE[0]
    assert rows[0]["recommendation"].startswith("Optimize streaming")


def test_ratio_columns_are_scaled_and_clipped(spark):
    topics = spark.createDataFrame([(1, 10), (2, 20)], "cluster int, size int")
    cases = {
        "negative_ratio": ([0.2, 0.9], [0.2, 0.9]),
        "negative_percentage": ([20.0, 90.0], [0.2, 0.9]),
        "negative": ([50.0, 400.0], [0.5, 1.0]),
        "other": ([0.2, 0.9], [0.0, 0.0]),
    }
    for name, (given, expected) in cases.items():
        sentiment = spark.createDataFrame(list(zip((1, 2), given)), f"topic_id int, {name} double")
        out = R.topic_metrics(topics, sentiment).orderBy("topic_id").collect()
        assert [r["negative_ratio"] for r in out] == expected
        assert out[0]["topic"] == "Topic 1"


def test_empty_recommendations(spark):
    empty = spark.createDataFrame([], "topic_id int, topic string, topic_size bigint, priority string, severity double, recommendation string, rationale string, positive_ratio double, negative_ratio double, rank int")
    card = R.summary(empty).first()
    assert card["total_recommendations"] == 0 and card["average_severity"] == 0.0 and card["highest_risk_topic"] is None
    assert dict(values(R.priority_counts(empty), "priority", "recommendations")) == {"High": 0, "Medium": 0, "Low": 0}


def test_sentiment_column_resolution():
    assert I.resolve_sentiment_column(["a", "sentiment_label"]) == "sentiment_label"
    assert I.resolve_sentiment_column(["predicted_sentiment", "sentiment_label"]) == "predicted_sentiment"
    with pytest.raises(ValueError):
        I.resolve_sentiment_column(["a"])


def test_percent_units(spark):
    row = spark.range(1).select(
        format_percentage(F.lit(0.72), "ratio").alias("a"), format_percentage(F.lit(0.9)).alias("b")
    ).first()
    assert (row["a"], row["b"]) == ("72.0%", "0.9%")


def test_unknown_topic_is_an_error(spark):
    df = spark.createDataFrame([(1, "x", 0, "A", "positive", 5)], "review_id int, review_text string, cluster_id int, topic_name string, predicted_sentiment string, rating int")
    with pytest.raises(ValueError):
        I.topic_summary(df, "B")
    assert I.topic_summary(df, 0).first()["sentiment"]["dominant"] == "positive"


def test_upsert_and_keep_last(spark):
    old = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "model_name string, macro_f1 double")
    new = spark.createDataFrame([("b", "b", 3.0)], "model_id string, model_name string, macro_f1 double")
    assert sorted(values(K.upsert(old, new, "model_id"), "model_id", "macro_f1")) == [("a", 1.0), ("b", 3.0)]
    row = K.experiment_row(spark, {"accuracy": 0.9, "macro_f1": 0.5}, {"b": 2, "a": [1]}, model_id="m", training_rows=3)
    first = row.first()
    assert first["hyperparameters"] == '{"a": [1], "b": 2}' and first["validation_accuracy"] == 0.9
    assert len(row.columns) == 25


def test_tracking_tables_replace_by_key(spark):
    path = scratch_path(spark, "runs")
    for f1 in (0.4, 0.6):
        row = K.experiment_row(spark, {"macro_f1": f1}, model_id="m1", model_name="One")
        table = K.log_experiment(spark, path, row)
    table = K.log_experiment(spark, path, K.experiment_row(spark, {"macro_f1": 0.9}, model_id="m2"))
    assert sorted(values(table, "model_id", "macro_f1")) == [("m1", 0.6), ("m2", 0.9)]
    assert table.columns == [n for n, _ in S.TRACKING_COLUMNS]
    path = scratch_path(spark, "ablations")
    K.record_ablation(spark, path, {"experiment_id": "a", "variant": "old", "macro_f1": 0.1})
    table = K.record_ablation(spark, path, {"experiment_id": "a", "variant": "new"})
    assert values(table, "experiment_id", "variant", "macro_f1") == [("a", "new", None)]


def test_duplicates_differ_by_microseconds(spark):
    from reviewloom.plans.shapes import keep_first

    rows = [(1, "2024-01-01 00:00:00.000100"), (2, "2024-01-01 00:00:00.000900"), (3, "2024-01-01 00:00:00.000900")]
    table = spark.createDataFrame(rows, "review_id bigint, at string").selectExpr(
        "review_id", "cast(at as timestamp) as at"
    )
    assert sorted(r.review_id for r in keep_first(table, ["at"]).collect()) == [1, 2]


def test_spread_of_large_values(spark):
    from reviewloom.operators.profiling import describe_numeric

    wide = spark.createDataFrame([(10**9 + i,) for i in (0, 1, 1, 2)], "v bigint")
    assert describe_numeric(wide, "v").first()["std"] == 0.816497
    huge = spark.createDataFrame([(5 * 10**9 + i,) for i in range(3)], "v bigint")
    assert describe_numeric(huge, "v").first()["std"] == 1.0


def test_validated_labels_pass_through_or_fail(spark):
    fine = spark.createDataFrame(
        [("positive", 1), (None, 2), ("neutral", 3)], "sentiment_label string, review_id bigint"
    )
    assert C.validate_labels(fine, ["sentiment_label"]).count() == 3
    wrong = fine.unionByName(
        spark.createDataFrame([("mixed", 4), ("mixed", 5), ("Positive", 6)], fine.schema)
    )
    assert sorted(values(C.unexpected_labels(wrong), "sentiment_label", "row_count")) == [
        ("Positive", 1), ("mixed", 2),
    ]
    with pytest.raises(ValueError, match="2 unexpected sentiment labels, such as 'Positive'"):
        C.validate_labels(wrong, ["sentiment_label"])
    with pytest.raises(ValueError, match="rating"):
        C.validate_labels(fine, ["sentiment_label", "rating"])
    assert C.validate_labels(fine.where("false"), ["sentiment_label"]).isEmpty()


def test_result_rows_share_the_comparison_layout(spark):
    df = spark.createDataFrame(
        [("positive", "positive"), ("negative", "positive"), ("negative", "negative"), ("neutral", "neutral")],
        "true_label string, predicted_label string",
    )
    rows = E.result_row(E.metrics(df), "first", 2.5).unionByName(
        E.result_row(E.metrics(df.limit(0)), "none")
    )
    assert tuple(rows.columns) == E.RESULT_COLUMNS
    first = rows.where("model_name = 'first'").first()
    assert first["accuracy"] == 0.75 and first["training_time_seconds"] == 2.5
    # Per label: F1 of 2/3, 2/3 and 1, with 1, 2 and 1 rows.
    assert first["macro_f1"] == pytest.approx(7 / 9) and first["weighted_f1"] == pytest.approx(0.75)
    assert first["inference_time_ms"] is None and dict(rows.dtypes)["inference_time_ms"] == "double"


def test_clusters_without_a_name(spark):
    used = spark.createDataFrame([(0,), (0,), (1,), (2,), (None,)], "cluster_id int")
    names = spark.createDataFrame([(0, "Batteries"), (7, "Unused")], "cluster_id int, topic_name string")
    got = T.unnamed_clusters(used, names)
    assert sorted(values(got, "cluster_id", "review_count"), key=str) == [(1, 1), (2, 1), (None, 1)]
    assert T.unnamed_clusters(used.where("cluster_id = 0"), names).isEmpty()


def test_error_subsets_are_written_by_subset(spark):
    rows = [
        ("good but dull", "positive", "negative", 0.99),
        ("fine", "positive", "neutral", 0.2),
        ("right", "neutral", "neutral", 0.99),
        ("no label", None, "neutral", None),
    ]
    schema = "text string, true_label string, predicted_label string, probability_negative double"
    analysis = E.error_columns(spark.createDataFrame(rows, schema))
    path = scratch_path(spark, "subsets")
    errors = E.error_subsets(analysis, path)
    expected = [
        ("all_errors", "fine"), ("all_errors", "good but dull"), ("all_errors", "no label"),
        ("contrast_errors", "good but dull"), ("high_confidence_errors", "good but dull"),
    ]
    assert sorted(values(errors, "subset", "text")) == expected
    assert sorted(values(spark.read.parquet(path), "subset", "text")) == expected
    # One subset is read without the others.
    one = spark.read.parquet(path).where("subset = 'contrast_errors'")
    assert one.count() == 1 and len(one.inputFiles()) >= 1
    E.error_subsets(analysis.where("is_correct"), path)
    assert spark.read.schema(errors.schema).parquet(path).isEmpty()
