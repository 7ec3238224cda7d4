"""Fitted pipelines kept as files: fitted once per application, loaded by whoever needs them."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from reviewloom.session import shared_root


def stored(spark: SparkSession, name: str, data: str, fit: Callable[[str], PipelineModel]) -> str:
    """Folder of the fitted pipeline ``name`` over the tables in ``data``.

    The first caller of an application fits and saves it; a marker written last tells a
    finished model from one whose writer was lost.  ``fit`` is given the folder's path and
    may leave tables of its own beside it, under longer names.
    """
    key = hashlib.sha256(data.encode()).hexdigest()[:16]
    path = f"{shared_root(spark)}/reviewloom/models/{spark.sparkContext.applicationId}/{name}-{key}"
    try:
        spark.read.text(f"{path}-done")
    except AnalysisException:
        fit(path).write().overwrite().save(path)
        spark.createDataFrame([(name,)], "value string").write.mode("overwrite").text(f"{path}-done")
    return path


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)
