"""Model evaluation, comparison, selection and error analysis."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewloom import settings as S
from reviewloom.functions.numbers import fixed, ratio
from reviewloom.functions.text import word_count
from reviewloom.plans.shapes import literal_rows, require_columns


def label_scores(
    df: DataFrame, true: str = "true_label", predicted: str = "predicted_label", by: Sequence[str] = ()
) -> DataFrame:
    """Precision, recall, F1, support per label seen as truth or prediction.

    One aggregate over the predictions gives the (truth, prediction) counts; the
    rest works on those few rows.
    """
    require_columns(df, [true, predicted, *by], "predictions")
    cells = df.groupBy(*by, true, predicted).agg(F.count(F.lit(1)).alias("n"))
    hit = F.when(F.col(true) == F.col(predicted), F.col("n")).otherwise(0)
    zero = F.lit(0).cast("bigint")
    sides = cells.select(
        *by, F.col(true).alias("label"), F.col("n").alias("support"), zero.alias("guessed"), hit.alias("hits")
    ).unionAll(cells.select(*by, F.col(predicted), zero, F.col("n"), zero))
    sums = sides.groupBy(*by, "label").agg(
        *[F.sum(c).cast("bigint").alias(c) for c in ("support", "guessed", "hits")]
    )
    precision, recall = ratio(F.col("hits"), F.col("guessed")), ratio(F.col("hits"), F.col("support"))
    return sums.withColumns({"precision": precision, "recall": recall}).withColumn(
        "f1", ratio(F.col("precision") * F.col("recall") * 2, F.col("precision") + F.col("recall"))
    )


def _overall() -> dict[str, Column]:
    support = F.sum("support")
    return {
        "accuracy": ratio(F.sum("hits"), support),
        "macro_precision": F.avg("precision"),
        "macro_recall": F.avg("recall"),
        "macro_f1": F.avg("f1"),
        "weighted_f1": ratio(F.sum(F.col("f1") * F.col("support")), support),
    }


def metrics(df: DataFrame, true: str = "true_label", predicted: str = "predicted_label") -> DataFrame:
    """Accuracy, macro and weighted scores as one row."""
    return label_scores(df, true, predicted).agg(*[e.alias(n) for n, e in _overall().items()])


def classification_report(
    df: DataFrame,
    labels: Sequence[str] | None = None,
    true: str = "true_label",
    predicted: str = "predicted_label",
) -> DataFrame:
    """Rows per label, then accuracy, macro avg and weighted avg."""
    scores = label_scores(df, true, predicted)
    if labels is not None:
        wanted = literal_rows(df.sparkSession, [(v,) for v in labels], "label string")
        scores = wanted.join(scores, "label", "left").fillna(0)
    support = F.sum("support").cast("double")
    total = scores.agg(
        support.alias("support"),
        ratio(F.sum("hits"), F.sum("support")).alias("accuracy"),
        *[F.avg(c).alias(f"macro_{c}") for c in ("precision", "recall", "f1")],
        *[
            ratio(F.sum(F.col(c) * F.col("support")), F.sum("support")).alias(f"weighted_{c}")
            for c in ("precision", "recall", "f1")
        ],
    )
    lines = F.array(
        F.struct(F.lit("accuracy").alias("label"), *[F.col("accuracy").alias(c) for c in ("precision", "recall", "f1_score", "support")]),
        *[
            F.struct(
                F.lit(f"{kind} avg").alias("label"),
                F.col(f"{kind}_precision").alias("precision"),
                F.col(f"{kind}_recall").alias("recall"),
                F.col(f"{kind}_f1").alias("f1_score"),
                F.col("support"),
            )
            for kind in ("macro", "weighted")
        ],
    )
    per_label = scores.select(
        "label", "precision", "recall", F.col("f1").alias("f1_score"), F.col("support").cast("double").alias("support")
    )
    return per_label.unionByName(total.select(F.explode(lines).alias("x")).select("x.*"))


def confusion_matrix(
    df: DataFrame,
    labels: Sequence[str] = S.SENTIMENT_LABELS,
    true: str = "true_label",
    predicted: str = "predicted_label",
) -> DataFrame:
    """One row per actual label, one column per predicted label, zero-filled."""
    names = [f"predicted_{v}" for v in labels]
    counts = df.groupBy(F.col(true).alias("label")).agg(
        *[F.count_if(F.col(predicted) == v).alias(n) for v, n in zip(labels, names)]
    )
    wanted = literal_rows(df.sparkSession, [(v,) for v in labels], "label string")
    return wanted.join(counts, "label", "left").fillna(0, names).select(
        F.concat(F.lit("actual_"), "label").alias("actual"), *names
    )


def benchmark_rows(
    df: DataFrame,
    costs: DataFrame | None = None,
    true: str = "true_label",
    predicted: str = "predicted_label",
    labels: Sequence[str] = S.SENTIMENT_LABELS,
) -> DataFrame:
    """One row per model_id: overall scores, per-label scores, cost columns.

    Macro scores average over the labels seen, per-label columns are fixed.
    """
    scores = label_scores(df, true, predicted, by=["model_id"])
    per_label = {
        f"{v}_{name}": F.coalesce(F.max(F.when(F.col("label") == v, F.col(source))), F.lit(0.0))
        for v in labels
        for name, source in (("precision", "precision"), ("recall", "recall"), ("f1", "f1"))
    }
    rows = scores.groupBy("model_id").agg(
        *[e.alias(n) for n, e in _overall().items()],
        F.sum("support").cast("bigint").alias("validation_rows"),
        *[e.alias(n) for n, e in per_label.items()],
    )
    return rows if costs is None else rows.join(costs, "model_id", "left")


def leaderboard(rows: Sequence[DataFrame], by: str = "macro_f1") -> DataFrame:
    """Benchmark rows of several models, best first."""
    if not rows:
        raise ValueError("at least one benchmark row is required")
    table = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    require_columns(table, [by], "benchmark")
    return table.orderBy(F.desc_nulls_last(by), F.asc("model_id"))


RESULT_COLUMNS = (
    "model_name",
    "accuracy",
    "macro_precision",
    "macro_recall",
    "macro_f1",
    "weighted_f1",
    "training_time_seconds",
    "inference_time_ms",
)


def result_row(metrics_row: DataFrame, model_name: str, training_time_seconds: float | None = None, inference_time_ms: float | None = None) -> DataFrame:
    """Metrics of one model in the comparison layout."""
    return metrics_row.select(
        F.lit(model_name).alias("model_name"),
        *RESULT_COLUMNS[1:6],
        F.lit(training_time_seconds).cast("double").alias("training_time_seconds"),
        F.lit(inference_time_ms).cast("double").alias("inference_time_ms"),
    )


def select_model(
    benchmark: DataFrame,
    incumbent: str = "DistilBERT",
    challenger: str = "DeBERTa",
    minimum_gain: float = 0.01,
    latency_limit: float = 2.0,
) -> DataFrame:
    """The chosen benchmark row and the reason, as one row.

    The challenger (name contains) replaces the incumbent (name equals) when its
    macro F1 gain is large enough, a priority class improves and its latency stays
    within the limit.  With either absent the best macro F1 wins.
    """
    require_columns(benchmark, ["model_id", "model_name", "macro_f1"], "benchmark")
    if benchmark.isEmpty():
        raise ValueError("the benchmark table is empty")
    row = F.struct(*benchmark.columns)
    order = F.struct(-F.col("macro_f1"), F.col("model_id"))

    def first_where(test: Column) -> Column:
        return F.min_by(row, F.when(test, order))

    both = benchmark.agg(
        F.min_by(row, order).alias("best"),
        first_where(F.rlike("model_name", F.lit(f"(?i)^(?:{incumbent})$"))).alias("old"),
        first_where(F.rlike("model_name", F.lit(f"(?i){challenger}"))).alias("new"),
    )

    def gain(name: str) -> Column:
        if name not in benchmark.columns:
            return F.lit(0.0)
        return F.col(f"new.{name}") - F.col(f"old.{name}")

    if "average_inference_ms" in benchmark.columns:
        old_ms, new_ms = F.col("old.average_inference_ms"), F.col("new.average_inference_ms")
        latency = F.when((old_ms > 0) & new_ms.isNotNull(), new_ms / old_ms).otherwise(1.0)
    else:
        latency = F.lit(1.0)
    better = (gain("macro_f1") >= minimum_gain) & (
        F.coalesce(gain("neutral_f1") > 0, F.lit(False)) | F.coalesce(gain("negative_recall") > 0, F.lit(False))
    )
    replace = better & (latency <= latency_limit)
    absent = F.col("old").isNull() | F.col("new").isNull()
    shown_gain, shown_latency = fixed(gain("macro_f1"), 4), fixed(latency, 2)
    # Fixed texts.
    reason = (
        F.when(
            absent,
            "Selected the highest Macro F1 because both transformer candidates were not available.",
        )
        .when(
            replace,
            F.format_string(
                f"{challenger} improved Macro F1 by %s, improved a priority class, and its latency "
                "multiplier (%sx) stayed within the limit.",
                shown_gain,
                shown_latency,
            ),
        )
        .otherwise(
            F.format_string(
                f"{incumbent} was selected because {challenger}'s Macro F1 gain was %s and its latency "
                "multiplier was %sx; the quality gain did not justify extra complexity.",
                shown_gain,
                shown_latency,
            )
        )
    )
    winner = F.when(absent, F.col("best")).when(replace, F.col("new")).otherwise(F.col("old"))
    return both.select(winner.alias("w"), reason.alias("reason")).select("w.*", "reason")


def selection_record(selected: DataFrame, artifact_path: str) -> DataFrame:
    """The selection as one JSON text row."""
    return selected.select(
        F.to_json(
            F.struct("model_id", "model_name", F.lit(artifact_path).alias("artifact_path"), "macro_f1", "reason")
        ).alias("record")
    )


# --- error analysis -----------------------------------------------------------------


def error_columns(predictions: DataFrame) -> DataFrame:
    """Correctness, error type, lengths, contrast-word flag and confidence per row."""
    require_columns(predictions, ["text", "true_label", "predicted_label"], "predictions")
    contrast = rf"(?i)\b({'|'.join(S.CONTRAST_WORDS)})\b"
    known = [f"probability_{v}" for v in S.SENTIMENT_LABELS if f"probability_{v}" in predictions.columns]
    if len(known) > 1:
        confidence = F.greatest(*known)
    else:
        confidence = F.col(known[0]) if known else F.lit(None).cast("double")
    return predictions.withColumn("text", F.coalesce("text", F.lit(""))).withColumns(
        {
            "is_correct": F.col("true_label").eqNullSafe(F.col("predicted_label")),
            "error_type": F.concat_ws(" -> ", "true_label", "predicted_label"),
            "text_length": F.length("text"),
            "word_count": word_count(F.col("text")),
            "contains_contrast": F.rlike("text", F.lit(contrast)),
            "confidence": confidence,
        }
    )


def error_subsets(analysis: DataFrame, path: str | None = None) -> DataFrame:
    """Errors tagged all_errors / high_confidence_errors / contrast_errors, most confident first.

    One pass; a row is repeated for each subset it belongs to.
    """
    confident = F.coalesce("confidence", F.lit(0.0)) >= S.HIGH_CONFIDENCE
    subsets = F.array_compact(
        F.array(
            F.lit("all_errors"),
            F.when(confident, "high_confidence_errors"),
            F.when(F.col("contains_contrast"), "contrast_errors"),
        )
    )
    errors = (
        analysis.where(~F.col("is_correct"))
        .withColumn("subset", F.explode(subsets))
        .orderBy(F.asc("subset"), F.desc_nulls_last("confidence"))
    )
    if path is not None:
        errors.write.mode("overwrite").partitionBy("subset").parquet(path)
    return errors


def compare_models(
    first: DataFrame, second: DataFrame, first_name: str, second_name: str, key: str = "review_id"
) -> DataFrame:
    """Rows where two models err or disagree, with the outcome of each.

    Reading the result fails when the tables differ in rows, texts or true labels:
    both sides are grouped by key, so a row missing on either side is seen.
    """

    def side(df: DataFrame, number: int) -> DataFrame:
        return df.select(
            key,
            F.lit(number).alias("side"),
            F.xxhash64("true_label", "text").alias("h"),
            # The text travels once.
            (F.col("text") if number == 1 else F.lit(None).cast("string")).alias("text"),
            "true_label",
            "predicted_label",
        )

    def predicted(number: int) -> Column:
        return F.max(F.when(F.col("side") == number, F.col("predicted_label")))

    paired = (
        side(first, 1)
        .unionByName(side(second, 2))
        .groupBy(key)
        .agg(
            F.count_if(F.col("side") == 1).alias("a"),
            F.count_if(F.col("side") == 2).alias("b"),
            F.min("h").alias("low"),
            F.max("h").alias("high"),
            F.max("text").alias("text"),
            F.max("true_label").alias("true_label"),
            predicted(1).alias("one"),
            predicted(2).alias("two"),
        )
    )
    one, two = F.col("one"), F.col("two")
    first_ok, second_ok = one == F.col("true_label"), two == F.col("true_label")
    apart = (F.col("a") != 1) | (F.col("b") != 1) | (F.col("low") != F.col("high"))
    outcome = (
        F.when(apart, F.raise_error(F.lit("predictions do not hold the same rows and labels")))
        .when(~first_ok & ~second_ok, "shared_errors")
        .when(first_ok & ~second_ok, f"{first_name}_wins")
        .when(~first_ok & second_ok, f"{second_name}_wins")
    )
    return paired.select(
        key,
        "text",
        "true_label",
        one.alias(f"{first_name}_prediction"),
        two.alias(f"{second_name}_prediction"),
        outcome.alias("outcome"),
        (one != two).alias("disagree"),
    ).where("outcome is not null")


def alignment_mismatches(first: DataFrame, second: DataFrame, key: str = "review_id") -> DataFrame:
    """Count of rows missing on one side or with different labels or text; 0 when comparable."""
    facts = [
        df.select(key, F.xxhash64("true_label", "text").alias("h"), F.lit(side).alias("side"))
        for side, df in ((1, first), (2, second))
    ]
    grouped = facts[0].unionByName(facts[1]).groupBy(key).agg(
        F.count_if(F.col("side") == 1).alias("a"),
        F.count_if(F.col("side") == 2).alias("b"),
        F.min("h").alias("low"),
        F.max("h").alias("high"),
    )
    bad = (F.col("a") != 1) | (F.col("b") != 1) | (F.col("low") != F.col("high"))
    return grouped.agg(F.count_if(bad).alias("mismatches"))


def prediction_table(scored: DataFrame, text: str, true: str = "sentiment_label") -> DataFrame:
    """Stored form of predictions: text, both labels, a probability per label when present."""
    known = [f"probability_{v}" for v in S.SENTIMENT_LABELS if f"probability_{v}" in scored.columns]
    return scored.select(
        *[c for c in scored.columns if c == "review_id"],
        F.col(text).alias("text"),
        F.col(true).alias("true_label"),
        F.col("predicted_sentiment").alias("predicted_label"),
        *known,
    )


# Fixed text of the comparison.
DECISION_NOTE = (
    "Macro F1 is the primary quality metric. Neutral-class F1 and negative recall are checked "
    "because these classes are more easily hidden by overall accuracy. Latency and model size "
    "are used when transformer quality is close."
)
COMPARISON_COLUMNS = (
    "model_name",
    "accuracy",
    "macro_f1",
    "negative_f1",
    "neutral_f1",
    "positive_f1",
    "average_inference_ms",
    "model_size_mb",
)


def comparison_report(benchmark: DataFrame, selected: DataFrame) -> DataFrame:
    """Markdown comparison as (line_no, line): one table row per model, winner, reason."""
    shown = [c for c in COMPARISON_COLUMNS if c in benchmark.columns]
    numeric = {n for n, t in benchmark.dtypes if t in ("double", "float")}
    cells = [
        F.coalesce((F.round(c, 4) if c in numeric else F.col(c)).cast("string"), F.lit("nan")) for c in shown
    ]
    order = Window.partitionBy(F.lit(1)).orderBy(F.desc("macro_f1"), F.asc("model_id"))
    rows = benchmark.select(
        F.lit(1).alias("part"),
        F.row_number().over(order).alias("n"),
        F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")).alias("line"),
    )
    # Fixed layout.
    head = [
        "# Sentiment Model Comparison",
        "",
        "## Final benchmark",
        "",
        f"| {' | '.join(shown)} |",
        f"|{'|'.join('---' for _ in shown)}|",
    ]
    closing = [
        F.lit(""),
        F.lit("## Selected production model"),
        F.lit(""),
        F.concat(F.lit("**"), "model_name", F.lit("**")),
        F.lit(""),
        F.col("reason"),
        F.lit(""),
        F.lit("## Decision priorities"),
        F.lit(""),
        F.lit(DECISION_NOTE),
    ]
    spark = benchmark.sparkSession
    top = literal_rows(spark, [(0, i, line) for i, line in enumerate(head)], "part int, n int, line string")
    end = selected.select(F.lit(2).alias("part"), F.posexplode(F.array(*closing)).alias("n", "line"))
    numbering = Window.partitionBy(F.lit(1)).orderBy("part", "n")
    return top.unionAll(rows).unionAll(end).select(F.row_number().over(numbering).alias("line_no"), "line")
