"""Session set-up and the two kinds of shared storage the operators need."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "reviewloom", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the operators assume (UTC, AQE, Arrow)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: the one named in spark.checkpoint.dir.

    Only a local-mode session without that setting falls back to a fresh
    temporary folder, since driver and executors are then the same process.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    known = getattr(spark.sparkContext, "_reviewloom_root", None)
    if known is None:
        if not _is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        known = tempfile.mkdtemp(prefix="reviewloom-")
        spark.sparkContext._reviewloom_root = known
    return known


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared root."""
    return f"{shared_root(spark)}/reviewloom/{uuid.uuid4().hex}/{name}"


def materialise(df: DataFrame) -> DataFrame:
    """Compute once and cut lineage through the reliable checkpoint folder."""
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(f"{shared_root(df.sparkSession)}/checkpoints")
    return df.checkpoint(eager=True)
