"""M: sentiment model queries."""

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from reviewloom import settings as S
from reviewloom.catalog.registry import query
from reviewloom.functions import text as X
from reviewloom.operators import evaluation as E
from reviewloom.operators import sentiment as M
from reviewloom.operators import stages
from reviewloom.plans import fixtures as fx
from reviewloom.plans import model_store
from reviewloom.plans.fixtures import sql_over
from reviewloom.session import scratch_path

SPLIT = (
    "split_",
    """select review_id, sentiment_label, case when n <= test then 'test'
  when n <= test + floor((total - test) * 0.2::double + 0.5) then 'validation' else 'train' end as split from (
  select *, floor(total * 0.2::double + 0.5) as test from (
  select review_id, sentiment_label, count(*) over (partition by sentiment_label) as total,
    row_number() over (partition by sentiment_label order by md5('42:' || review_id), review_id) as n
  from reviews_labelled) a) b""",
)


def reviews_of(spark, sf_dir, spread=False):
    reviews = fx.reviews_labelled(spark, sf_dir, spread)
    return reviews.select("review_id", "review_text", "sentiment_label")


def classical(spark, sf_dir):
    return reviews_of(spark, sf_dir).select(
        "review_id", X.classical_text(F.col("review_text")).alias("classical_text"), "sentiment_label"
    )


def split(spark, sf_dir):
    return M.stratified_split(fx.reviews_labelled(spark, sf_dir).select("review_id", "sentiment_label"))


@query("m01_split", sql_over("reviews_labelled", SPLIT, body="select * from split_"))
def stratified(spark, sf_dir):
    return split(spark, sf_dir)


@query(
    "m02_split_summary",
    sql_over(
        "reviews_labelled",
        SPLIT,
        body="select sentiment_label, "
        + ", ".join(
            f"""round(count(*) filter (where split = '{s}') /
            sum(count(*) filter (where split = '{s}')) over () * 100, 2) as {s}"""
            for s in ("train", "validation", "test")
        )
        + " from split_ group by 1",
    ),
)
def split_summary(spark, sf_dir):
    return M.split_summary(split(spark, sf_dir))


@query(
    "m03_class_weights",
    sql_over(
        "reviews_labelled",
        body="""select sentiment_label, count(*) as row_count,
        round(sum(count(*)) over () / (count(*) over () * count(*)), 6) as weight
        from reviews_labelled group by 1""",
    ),
)
def class_weights(spark, sf_dir):
    weights = M.class_weights(fx.reviews_labelled(spark, sf_dir))
    return weights.withColumn("weight", F.round("weight", 6))


def training_part(spark, sf_dir):
    """Reviews of the training split; split before any text is cleaned."""
    return M.stratified_split(reviews_of(spark, sf_dir, spread=True)).where("split = 'train'")


def trained(spark, sf_dir) -> str:
    """Folder of the pipeline fitted on the training split."""
    return model_store.stored(
        spark, "sentiment", sf_dir, lambda _: stages.sentiment_pipeline().fit(training_part(spark, sf_dir))
    )


def scored(spark, sf_dir):
    """All reviews with the predictions of the stored pipeline."""
    return model_store.load(trained(spark, sf_dir)).transform(reviews_of(spark, sf_dir))


@query("m04_train_classifier")
def train(spark, sf_dir):
    """Validation metrics of a freshly fitted pipeline."""
    part = M.stratified_split(reviews_of(spark, sf_dir, spread=True))
    model = stages.sentiment_pipeline().fit(part.where("split = 'train'"))
    judged = model.transform(part.where("split = 'validation'"))
    return E.metrics(E.prediction_table(judged, "classical_text"))


@query(
    "m04b_training_facts",
    sql_over(
        "reviews_labelled",
        SPLIT,
        body="""select count(*) filter (where split = 'train') as training_rows,
        count(*) filter (where split = 'validation') as validation_rows, true as beats_the_largest_class,
        true as weights_settled from split_""",
    ),
)
def training_facts(spark, sf_dir):
    """Is the fitted model any good: macro F1 against always naming the largest class."""
    part = M.stratified_split(reviews_of(spark, sf_dir))
    counts = part.agg(
        F.count_if(F.col("split") == "train").alias("training_rows"),
        F.count_if(F.col("split") == "validation").alias("validation_rows"),
    )
    model = model_store.load(trained(spark, sf_dir))
    table = E.prediction_table(
        model.transform(part.where("split = 'validation'")), "classical_text"
    ).persist()
    largest = table.groupBy("true_label").count().orderBy(F.desc("count"), "true_label").first()[0]
    plain = E.metrics(table.withColumn("predicted_label", F.lit(largest))).first()["macro_f1"]
    found = E.metrics(table).first()["macro_f1"]
    table.unpersist()
    fitted = model.stages[-1].fitted.classifier
    steady = bool(np.isfinite(fitted.coefficientMatrix.toArray()).all())
    return counts.withColumns(
        {"beats_the_largest_class": F.lit(found > plain), "weights_settled": F.lit(steady)}
    )


@query("m05_top_features")
def top_features(spark, sf_dir):
    fitted = model_store.load(trained(spark, sf_dir)).stages[-1].fitted
    return M.top_features(spark, fitted, top_n=15)


@query(
    "m05b_top_feature_facts",
    f"""select unnest({list(S.SENTIMENT_LABELS)}) as sentiment_class, 15 as features,
    true as ranked, true as in_order, true as one_or_two_words""",
)
def top_feature_facts(spark, sf_dir):
    """Per class: fifteen features, ranks without gaps, weights falling, words or pairs."""
    best = top_features(spark, sf_dir)
    before = F.lag("coefficient").over(Window.partitionBy("sentiment_class").orderBy("rank"))
    checked = best.withColumn("falls", F.coalesce(before >= F.col("coefficient"), F.lit(True)))
    return checked.groupBy("sentiment_class").agg(
        F.count_distinct("feature").cast("int").alias("features"),
        (F.array_sort(F.collect_list("rank")) == F.sequence(F.lit(1), F.lit(15))).alias("ranked"),
        F.bool_and("falls").alias("in_order"),
        F.bool_and(F.size(F.split("feature", " ")) <= 2).alias("one_or_two_words"),
    )


@query("m07_predict")
def predict(spark, sf_dir):
    return scored(spark, sf_dir).drop("review_text", "classical_text", "sentiment_label")


def prediction_facts_of(predicted):
    """Per review: do the probabilities add up, and does the label have the largest?"""
    probabilities = [F.col(f"probability_{v}") for v in S.SENTIMENT_LABELS]
    total = sum(probabilities[1:], probabilities[0])
    named = F.element_at(
        F.map_from_arrays(F.array(*[F.lit(v) for v in S.SENTIMENT_LABELS]), F.array(*probabilities)),
        F.col("predicted_sentiment"),
    )
    return predicted.select(
        "review_id",
        (F.abs(total - 1) < 1e-9).alias("adds_up"),
        (named == F.greatest(*probabilities)).alias("label_is_likeliest"),
        (F.col("sentiment_confidence") == F.greatest(*probabilities)).alias("confidence_is_largest"),
    )


FACTS = "true as adds_up, true as label_is_likeliest, true as confidence_is_largest"


@query("m07b_prediction_facts", sql_over("reviews_labelled", body=f"select review_id, {FACTS} from reviews_labelled"))
def prediction_facts(spark, sf_dir):
    return prediction_facts_of(scored(spark, sf_dir))


LOGITS = "list_transform(embedding[1:3]::double[], lambda x: x)"
PROBABILITIES = f"""select vec_id, [exp(l[1] - m) / z, exp(l[2] - m) / z, exp(l[3] - m) / z] as p from (
  select vec_id, l, m, exp(l[1] - m) + exp(l[2] - m) + exp(l[3] - m) as z from (
  select vec_id, {LOGITS} as l, list_max({LOGITS}) as m from embeddings) a) b"""


@query(
    "m08_softmax",
    f"""select vec_id, ['negative', 'neutral', 'positive'][list_position(p, list_max(p))] as predicted_sentiment,
    round(p[1], 6) as probability_negative, round(p[2], 6) as probability_neutral,
    round(p[3], 6) as probability_positive, round(list_max(p), 6) as sentiment_confidence
    from ({PROBABILITIES}) q""",
)
def softmax(spark, sf_dir):
    logits = F.transform(F.slice("embedding", 1, 3), lambda x: x.cast("double"))
    scored = M.from_logits(fx.table(spark, sf_dir, "embeddings").select("vec_id", logits.alias("logits")))
    numbers = [c for c in scored.columns if c.startswith(("probability_", "sentiment_"))]
    return scored.drop("logits").withColumns({c: F.round(c, 6) for c in numbers})


SHARES = ", ".join(
    f"case when pred_a = '{v}' then confidence else (1 - confidence) / 2 end as probability_{v}"
    for v in S.SENTIMENT_LABELS
)


def scored_fixture(spark, sf_dir):
    """Predictions with a probability per label derived from the confidence."""
    confidence = F.col("confidence")
    return fx.predictions(spark, sf_dir).select(
        "review_id",
        "text",
        "true_label",
        F.col("pred_a").alias("predicted_sentiment"),
        confidence.alias("sentiment_confidence"),
        *[
            F.when(F.col("pred_a") == v, confidence).otherwise((1 - confidence) / 2).alias(f"probability_{v}")
            for v in S.SENTIMENT_LABELS
        ],
    )


@query(
    "m09_prediction_record",
    sql_over(
        "predictions",
        body=f"""select review_id, pred_a as label, confidence,
        round(probability_negative, 6) as negative, round(probability_neutral, 6) as neutral,
        round(probability_positive, 6) as positive from (select *, {SHARES} from predictions) q""",
    ),
)
def record(spark, sf_dir):
    records = M.prediction_record(scored_fixture(spark, sf_dir))
    return records.select(
        "review_id",
        "label",
        "confidence",
        *[F.round(F.element_at("probabilities", v), 6).alias(v) for v in S.SENTIMENT_LABELS],
    )


def enriched(spark, sf_dir):
    """The enriched table, written and read back."""
    reviews = classical(spark, sf_dir).withColumn("rating_source", F.lit("reviews"))
    path = scratch_path(spark, "enriched")
    fitted = model_store.load(trained(spark, sf_dir)).stages[-1].fitted
    M.enrich_reviews(reviews, fitted, path=path)
    return spark.read.parquet(path)


@query("m10_enrich")
def enrich(spark, sf_dir):
    return enriched(spark, sf_dir)


@query(
    "m10b_enriched_facts",
    sql_over(
        "reviews_labelled",
        body=f"select review_id, sentiment_label, 'reviews' as rating_source, {FACTS} from reviews_labelled",
    ),
)
def enriched_facts(spark, sf_dir):
    """Every review is there with its own columns, and its predictions hold together."""
    table = enriched(spark, sf_dir)
    own = table.select("review_id", "sentiment_label", "rating_source")
    return own.join(prediction_facts_of(table), "review_id")


def selected(spark, sf_dir):
    """The stored pipeline that a selection record names."""
    chosen = spark.createDataFrame(
        [("sentiment_01", "TF-IDF Logistic Regression", 0.5, "only candidate")],
        "model_id string, model_name string, macro_f1 double, reason string",
    )
    record = scratch_path(spark, "selection")
    E.selection_record(chosen, trained(spark, sf_dir)).write.text(record)
    return model_store.load(spark.read.json(record).first()["artifact_path"])


@query("m11_load_selected")
def load_selected(spark, sf_dir):
    """Predictions of the reloaded model that a selection record names."""
    found = selected(spark, sf_dir).transform(reviews_of(spark, sf_dir))
    return found.drop("review_text", "classical_text", "sentiment_label")


@query(
    "m11b_reloaded_is_fitted",
    sql_over("reviews_labelled", body="select review_id, true as same from reviews_labelled"),
)
def reloaded_is_fitted(spark, sf_dir):
    """Per review: does the pipeline saved, named and loaded score as one saved again?"""
    model = selected(spark, sf_dir)
    path = scratch_path(spark, "again")
    model.write().save(path)
    reviews = reviews_of(spark, sf_dir)
    names = [f"probability_{v}" for v in S.SENTIMENT_LABELS]
    one = model.transform(reviews).select("review_id", F.array(*names).alias("before"))
    two = model_store.load(path).transform(reviews).select("review_id", F.array(*names).alias("after"))
    return one.join(two, "review_id").select("review_id", (F.col("before") == F.col("after")).alias("same"))
