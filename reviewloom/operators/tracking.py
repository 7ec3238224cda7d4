"""Experiment and ablation tables: upsert, keep-last, latest costs."""

from __future__ import annotations

import json
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom import settings as S
from reviewloom.plans.shapes import col
from reviewloom.sources.files import append_entry, read_logged

TRACKING_SCHEMA = ", ".join(f"{n} {t}" for n, t in S.TRACKING_COLUMNS)
ABLATION_SCHEMA = ", ".join(f"{n} {t}" for n, t in S.ABLATION_COLUMNS)


def upsert(existing: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Existing rows whose key is not in ``new``, plus all of ``new``."""
    if key not in existing.columns:
        fallback = F.col("model_name") if "model_name" in existing.columns else F.lit("")
        existing = existing.withColumn(key, fallback)
    replaced = new.select(col(key).cast("string").alias("__k")).distinct()
    kept = existing.join(replaced, col(key).cast("string") == F.col("__k"), "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)


def keep_last(df: DataFrame, key: str, order: str) -> DataFrame:
    """One row per key: the one with the largest ``order``, by aggregation."""
    last = df.groupBy(key).agg(F.max_by(F.struct(*df.columns), col(order)).alias("r"))
    return last.select("r.*")


def experiment_row(
    spark: SparkSession,
    metrics: dict[str, Any],
    hyperparameters: dict[str, Any] | None = None,
    timestamp_utc: str | None = None,
    **fields,
) -> DataFrame:
    """One tracking row; hyperparameters become sorted JSON."""
    now = timestamp_utc or datetime.now(timezone.utc).isoformat(timespec="seconds")
    known = {name for name, _ in S.TRACKING_COLUMNS}
    # Evaluation calls the accuracy on held-out rows just "accuracy".
    measured = {"validation_accuracy" if k == "accuracy" else k: v for k, v in metrics.items()}
    measured.update({k: metrics[k] for k in ("validation_accuracy",) if k in metrics})
    values = {
        **fields,
        **{k: v for k, v in measured.items() if k in known},
        "hyperparameters": json.dumps(hyperparameters or {}, sort_keys=True, default=str),
        "timestamp_utc": now,
    }
    unknown = sorted(set(values) - known)
    if unknown:
        raise ValueError(f"unknown tracking fields {unknown}")
    casts = {"bigint": int, "int": int, "double": float, "string": str}
    row = tuple(
        None if values.get(n) is None else casts[t](values[n]) for n, t in S.TRACKING_COLUMNS
    )
    return spark.createDataFrame([row], TRACKING_SCHEMA)


def log_experiment(spark: SparkSession, path: str, row: DataFrame) -> DataFrame:
    """Add or replace the run of one model in the tracking table below ``path``.

    Writers at the same time do not lose each other's runs.
    """
    append_entry(row, path)
    return read_logged(spark, path, TRACKING_SCHEMA, "model_id")


def record_ablation(spark: SparkSession, path: str, row: dict[str, Any]) -> DataFrame:
    """Add or replace one ablation by experiment_id; fields not given are NULL."""
    new = spark.createDataFrame([tuple(row.get(n) for n, _ in S.ABLATION_COLUMNS)], ABLATION_SCHEMA)
    append_entry(new, path)
    return read_logged(spark, path, ABLATION_SCHEMA, "experiment_id")


def latest_costs(benchmark: DataFrame, tracking: DataFrame) -> DataFrame:
    """Benchmark rows with the times of the newest tracked run of the same model."""
    newest = keep_last(tracking, "model_id", "timestamp_utc").select(
        "model_id",
        "training_time_seconds",
        F.col("inference_time_ms").alias("average_inference_ms"),
    )
    return benchmark.join(newest, "model_id", "left")
