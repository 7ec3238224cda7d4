"""E: evaluation, selection and tracking queries."""

from pyspark.sql import functions as F

from reviewloom import settings as S
from reviewloom.catalog.registry import query
from reviewloom.catalog.sentiment import SHARES, scored_fixture
from reviewloom.catalog.sqltext import quoted
from reviewloom.operators import evaluation as E
from reviewloom.operators import tracking as K
from reviewloom.plans import fixtures as fx
from reviewloom.plans.fixtures import sql_over
from reviewloom.session import scratch_path
from reviewloom.sources import files

LONG = (
    "long_",
    """select review_id, text, true_label, pred_a as predicted_label, 'sentiment_02' as model_id from predictions
  union all select review_id, text, true_label, pred_b, 'sentiment_03' from predictions""",
)
SCORES = (
    "scores",
    """select model_id, label, sum(support) as support, sum(guessed) as guessed, sum(hits) as hits,
  coalesce(sum(hits) / nullif(sum(guessed), 0), 0) as p, coalesce(sum(hits) / nullif(sum(support), 0), 0) as r
  from (select model_id, true_label as label, 1 as support, 0 as guessed,
      case when true_label = predicted_label then 1 else 0 end as hits from long_
    union all select model_id, predicted_label, 0, 1, 0 from long_) q group by 1, 2""",
)
F1 = ("f1_scores", "select *, coalesce(2 * p * r / nullif(p + r, 0), 0) as f from scores")
OVERALL_SQL = """sum(hits) / sum(support) as accuracy, avg(p) as macro_precision, avg(r) as macro_recall,
  avg(f) as macro_f1, sum(f * support) / sum(support) as weighted_f1"""
BENCHMARK = (
    "bench",
    f"""select model_id, {OVERALL_SQL}, cast(sum(support) as bigint) as validation_rows, """
    + ", ".join(
        f"coalesce(max({c}) filter (where label = '{v}'), 0) as {v}_{n}"
        for v in S.SENTIMENT_LABELS
        for n, c in (("precision", "p"), ("recall", "r"), ("f1", "f"))
    )
    + " from f1_scores group by 1",
)
MODELS = "(values ('sentiment_02', 'DistilBERT', 10.0::double), ('sentiment_03', 'DeBERTa v3', 15.0::double))"
NAMED = (
    "named",
    f"""select bench.*, model_name, average_inference_ms from bench
  join (select * from {MODELS} as m(model_id, model_name, average_inference_ms)) m using (model_id)""",
)
CTES = (LONG, SCORES, F1, BENCHMARK, NAMED)


def over_predictions(*parts, body):
    return sql_over("predictions", *parts, body=body)


def model_predictions(spark, sf_dir, column="pred_a"):
    return fx.predictions(spark, sf_dir).select(
        "review_id", "text", "true_label", F.col(column).alias("predicted_label")
    )


def long(spark, sf_dir):
    parts = [
        model_predictions(spark, sf_dir, c).withColumn("model_id", F.lit(m))
        for c, m in (("pred_a", "sentiment_02"), ("pred_b", "sentiment_03"))
    ]
    return parts[0].unionByName(parts[1])


def costs(spark):
    return spark.createDataFrame(
        [("sentiment_02", "DistilBERT", 10.0), ("sentiment_03", "DeBERTa v3", 15.0)],
        "model_id string, model_name string, average_inference_ms double",
    )


def benchmark(spark, sf_dir):
    return E.benchmark_rows(long(spark, sf_dir), F.broadcast(costs(spark)))


def rounded(df):
    return df.withColumns({n: F.round(n, 6) for n, t in df.dtypes if t == "double"})


OVERALL_NAMES = ("accuracy", "macro_precision", "macro_recall", "macro_f1", "weighted_f1")
SCORE_NAMES = [f"{v}_{n}" for v in S.SENTIMENT_LABELS for n in ("precision", "recall", "f1")]
ROUNDED = ", ".join(f"round({n}, 6) as {n}" for n in OVERALL_NAMES)
ROUNDED_SCORES = ", ".join(f"round({n}, 6) as {n}" for n in SCORE_NAMES)


@query(
    "e01_metrics",
    over_predictions(*CTES, body=f"select {ROUNDED} from bench where model_id = 'sentiment_02'"),
)
def metrics(spark, sf_dir):
    return rounded(E.metrics(model_predictions(spark, sf_dir)))


@query(
    "e02_report",
    over_predictions(
        *CTES[:3],
        body="""select label, round(p, 6) as precision, round(r, 6) as recall, round(f, 6) as f1_score,
          cast(support as double) as support from f1_scores where model_id = 'sentiment_02'
        union all select 'accuracy', a, a, a, a from (select round(sum(hits) / sum(support), 6) as a
          from f1_scores where model_id = 'sentiment_02') q
        union all select 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), sum(support)
          from f1_scores where model_id = 'sentiment_02'
        union all select 'weighted avg', round(sum(p * support) / sum(support), 6),
          round(sum(r * support) / sum(support), 6), round(sum(f * support) / sum(support), 6), sum(support)
          from f1_scores where model_id = 'sentiment_02'""",
    ),
)
def report(spark, sf_dir):
    return rounded(E.classification_report(model_predictions(spark, sf_dir), S.SENTIMENT_LABELS))


@query(
    "e03_confusion",
    over_predictions(
        body="select 'actual_' || true_label as actual, "
        + ", ".join(f"count(*) filter (where pred_a = '{v}') as predicted_{v}" for v in S.SENTIMENT_LABELS)
        + " from predictions group by 1"
    ),
)
def confusion(spark, sf_dir):
    return E.confusion_matrix(model_predictions(spark, sf_dir))


@query(
    "e04_benchmark_row",
    over_predictions(
        *CTES,
        body=f"""select model_id, model_name, average_inference_ms, validation_rows, {ROUNDED},
        {ROUNDED_SCORES} from named""",
    ),
)
def benchmark_row(spark, sf_dir):
    return rounded(benchmark(spark, sf_dir))


@query(
    "e05_leaderboard",
    over_predictions(
        *CTES,
        body=f"""select model_id, model_name, {ROUNDED},
        cast(row_number() over (order by macro_f1 desc, model_id) as int) as place from named""",
    ),
)
def leaderboard(spark, sf_dir):
    from pyspark.sql import Window

    rows = benchmark(spark, sf_dir)
    table = E.leaderboard([rows.where(F.col("model_id") == m) for m in ("sentiment_02", "sentiment_03")])
    place = F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(F.desc("macro_f1"), "model_id"))
    return rounded(table.withColumn("place", place)).select("model_id", "model_name", *OVERALL_NAMES, "place")


@query("e06_artifact_size")
def artifact_size(spark, sf_dir):
    """Size of the stored predictions and of a path that does not exist."""
    path = files.write_table(fx.predictions(spark, sf_dir), scratch_path(spark, "predictions"))
    stored = files.size_mb(spark, path).withColumn("artifact", F.lit("predictions"))
    absent = files.size_mb(spark, f"{path}/nothing_here").withColumn("artifact", F.lit("absent"))
    return stored.unionByName(absent)


@query(
    "e06b_size_of_known_bytes",
    "select 'ten bytes a row' as artifact, round(count(*) * 10 / 1048576.0, 9) as size_mb from documents",
)
def size_of_known_bytes(spark, sf_dir):
    """Size of a text artifact whose bytes follow from the number of rows."""
    ids = fx.table(spark, sf_dir, "documents").select(F.lpad(F.col("doc_id").cast("string"), 9, "0").alias("value"))
    path = scratch_path(spark, "ids")
    ids.write.text(path)
    size = files.size_mb(spark, path)
    return size.select(F.lit("ten bytes a row").alias("artifact"), F.round("size_mb", 9).alias("size_mb"))


SELECTED = (
    "selected",
    """select w.model_id, w.model_name, w.macro_f1, case when gain >= 0.01 and (neutral > 0 or recall > 0)
    and latency <= 2.0 then 'DeBERTa improved Macro F1 by ' || printf('%.4f', round(gain, 4))
      || ', improved a priority class, and its latency multiplier (' || printf('%.2f', round(latency, 2))
      || 'x) stayed within the limit.'
    else 'DistilBERT was selected because DeBERTa''s Macro F1 gain was ' || printf('%.4f', round(gain, 4))
      || ' and its latency multiplier was ' || printf('%.2f', round(latency, 2))
      || 'x; the quality gain did not justify extra complexity.' end as reason
  from (select n.macro_f1 - o.macro_f1 as gain, n.neutral_f1 - o.neutral_f1 as neutral,
      n.negative_recall - o.negative_recall as recall,
      n.average_inference_ms / o.average_inference_ms as latency
    from (select * from named where model_name = 'DistilBERT') o,
      (select * from named where model_name ilike '%deberta%') n) g
  join named w on w.model_name = case when gain >= 0.01 and (neutral > 0 or recall > 0) and latency <= 2.0
    then 'DeBERTa v3' else 'DistilBERT' end""",
)


@query(
    "e07_select_model",
    over_predictions(
        *CTES, SELECTED, body="select model_id, model_name, round(macro_f1, 6) as macro_f1, reason from selected"
    ),
)
def select_model(spark, sf_dir):
    chosen = E.select_model(benchmark(spark, sf_dir))
    return rounded(chosen.select("model_id", "model_name", "macro_f1", "reason"))


@query(
    "e08_selection_record",
    over_predictions(
        *CTES,
        SELECTED,
        body="""select model_id, model_name, 'models/sentiment/chosen' as artifact_path,
        round(macro_f1, 6) as macro_f1, reason from selected""",
    ),
)
def selection_record(spark, sf_dir):
    """The JSON record, parsed back."""
    record = E.selection_record(E.select_model(benchmark(spark, sf_dir)), "models/sentiment/chosen")
    schema = "model_id string, model_name string, artifact_path string, macro_f1 double, reason string"
    return rounded(record.select(F.from_json("record", schema).alias("r")).select("r.*"))


ERRORS = (
    "errors_",
    rf"""select review_id, text, true_label, predicted_label, true_label = predicted_label as is_correct,
  true_label || ' -> ' || predicted_label as error_type, length(text) as text_length,
  len(list_filter(regexp_split_to_array(text, '\s+'), lambda t: t <> '')) as word_count,
  regexp_matches(text, '(?i)\b({'|'.join(S.CONTRAST_WORDS)})\b') as contains_contrast,
  round(greatest(probability_negative, probability_neutral, probability_positive), 6) as confidence
  from (select review_id, case review_id % 3 when 0 then 'Good BUT late. ' else '' end || text as text,
    true_label, pred_a as predicted_label, {SHARES} from predictions) q""",
)


def analysed(spark, sf_dir):
    """Scored rows, a third of them with a contrast word in front."""
    text = F.concat(F.when(F.col("review_id") % 3 == 0, "Good BUT late. ").otherwise(""), "text")
    scored = scored_fixture(spark, sf_dir).withColumn("text", text)
    renamed = scored.withColumnRenamed("predicted_sentiment", "predicted_label")
    return E.error_columns(renamed.drop("sentiment_confidence")).select(
        "review_id",
        "text",
        "true_label",
        "predicted_label",
        "is_correct",
        "error_type",
        "text_length",
        "word_count",
        "contains_contrast",
        F.round("confidence", 6).alias("confidence"),
    )


@query("e09_error_columns", over_predictions(ERRORS, body="select * from errors_"))
def error_columns(spark, sf_dir):
    return analysed(spark, sf_dir)


@query(
    "e10_error_subsets",
    over_predictions(
        ERRORS,
        body="""select 'all_errors' as subset, * from errors_ where not is_correct
        union all select 'high_confidence_errors', * from errors_ where not is_correct
          and coalesce(confidence, 0) >= 0.8
        union all select 'contrast_errors', * from errors_ where not is_correct and contains_contrast""",
    ),
)
def error_subsets(spark, sf_dir):
    return E.error_subsets(analysed(spark, sf_dir))


@query(
    "e11_model_diff",
    over_predictions(
        body="""select review_id, text, true_label, pred_a as distilbert_prediction,
        pred_b as deberta_prediction, case when pred_a <> true_label and pred_b <> true_label then 'shared_errors'
          when pred_a = true_label then 'distilbert_wins' else 'deberta_wins' end as outcome,
        pred_a <> pred_b as disagree from predictions where pred_a <> true_label or pred_b <> true_label"""
    ),
)
def model_diff(spark, sf_dir):
    return E.compare_models(
        model_predictions(spark, sf_dir, "pred_a"),
        model_predictions(spark, sf_dir, "pred_b"),
        "distilbert",
        "deberta",
    )


@query(
    "e11b_alignment",
    over_predictions(body="select count(*) filter (where review_id % 10 = 0 or review_id % 10 = 5) as mismatches from predictions"),
)
def alignment(spark, sf_dir):
    """A copy that lost some rows and changed the label of others."""
    first = model_predictions(spark, sf_dir)
    changed = F.when(F.col("review_id") % 10 == 5, "other").otherwise(F.col("true_label"))
    second = first.where("review_id % 10 <> 0").withColumn("true_label", changed)
    return E.alignment_mismatches(first, second)


@query(
    "e12_upsert",
    over_predictions(
        *CTES,
        body="""select 'sentiment_01' as model_id, 'kept' as features, 0.5 as macro_f1
        union all select model_id, case when model_id = 'sentiment_03' then 'new run' else 'old run' end,
        round(case when model_id = 'sentiment_03' then macro_f1 + 1 else macro_f1 end, 6) from named""",
    ),
)
def upsert(spark, sf_dir):
    """Tracking rows after two logged runs, through a logged table."""
    path = scratch_path(spark, "tracking")
    for features, shift in (("old run", 0.0), ("new run", 1.0)):
        runs = benchmark(spark, sf_dir).withColumn("features", F.lit(features))
        runs = runs.withColumn("macro_f1", F.col("macro_f1") + shift).select("model_id", "features", "macro_f1")
        if features == "old run":
            kept = spark.createDataFrame([("sentiment_01", "kept", 0.5)], runs.schema)
            runs = runs.unionByName(kept)
        else:
            runs = runs.where("model_id = 'sentiment_03'")
        files.append_entry(runs, path)
    return rounded(
        files.read_logged(spark, path, "model_id string, features string, macro_f1 double", "model_id")
    )


@query(
    "e13_keep_last",
    over_predictions(
        body="""select experiment_id, seq, variant from (select 'exp' || (review_id % 25) as experiment_id,
        review_id as seq, pred_a as variant, row_number() over (partition by review_id % 25
        order by review_id desc) as n from predictions) q where n = 1"""
    ),
)
def keep_last(spark, sf_dir):
    runs = fx.predictions(spark, sf_dir).select(
        F.concat(F.lit("exp"), (F.col("review_id") % 25).cast("string")).alias("experiment_id"),
        F.col("review_id").alias("seq"),
        F.col("pred_a").alias("variant"),
    )
    return K.keep_last(runs, "experiment_id", "seq")


@query(
    "e14_tracked_costs",
    over_predictions(
        *CTES,
        body="""select bench.model_id, round(macro_f1, 6) as macro_f1, training_time_seconds, average_inference_ms
        from bench left join (select * from (select model_id, cast(review_id as double) as training_time_seconds, review_id / 100.0 as average_inference_ms,
          row_number() over (partition by model_id order by review_id desc) as n from long_
          where model_id = 'sentiment_02') q where n = 1) t on t.model_id = bench.model_id""",
    ),
)
def tracked_costs(spark, sf_dir):
    """Newest tracked run per model; one model was never tracked."""
    runs = long(spark, sf_dir).where("model_id = 'sentiment_02'").select(
        "model_id",
        F.lpad(F.col("review_id").cast("string"), 20, "0").alias("timestamp_utc"),
        F.col("review_id").cast("double").alias("training_time_seconds"),
        (F.col("review_id") / 100.0).alias("inference_time_ms"),
    )
    rows = K.latest_costs(E.benchmark_rows(long(spark, sf_dir)), runs)
    return rows.select("model_id", F.round("macro_f1", 6).alias("macro_f1"), "training_time_seconds", "average_inference_ms")


COMPARED = ("accuracy", "macro_f1", "negative_f1", "neutral_f1", "positive_f1", "average_inference_ms")
CELLS = " || ' | ' || ".join(f"cast(round({c}::double, 4) as varchar)" for c in COMPARED)


@query(
    "e15_comparison_report",
    over_predictions(
        *CTES,
        SELECTED,
        body=f"""select cast(row_number() over (order by part, n) as int) as line_no, line from (
        select 0 as part, unnest(range(6)) as n, unnest(['# Sentiment Model Comparison', '', '## Final benchmark', '',
          '| model_name | {' | '.join(COMPARED)} |', '|{'|'.join(['---'] * (1 + len(COMPARED)))}|']) as line
        union all select 1, row_number() over (order by macro_f1 desc, model_id),
          '| ' || model_name || ' | ' || {CELLS} || ' |' from named
        union all select 2, unnest(range(10)), unnest(['', '## Selected production model', '',
          '**' || model_name || '**', '', reason, '', '## Decision priorities', '',
          {quoted(E.DECISION_NOTE)}]) from selected) q""",
    ),
)
def comparison_report(spark, sf_dir):
    rows = benchmark(spark, sf_dir)
    return E.comparison_report(rows, E.select_model(rows))


@query(
    "e16_predictions",
    over_predictions(
        body=f"""select review_id, text, true_label, pred_a as predicted_label,
        {', '.join(f'round(probability_{v}, 6) as probability_{v}' for v in S.SENTIMENT_LABELS)}
        from (select *, {SHARES} from predictions) q"""
    ),
)
def predictions(spark, sf_dir):
    return rounded(E.prediction_table(scored_fixture(spark, sf_dir), "text", "true_label"))
