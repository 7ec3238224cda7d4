"""Vector expressions evaluated in the JVM."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def l2_normalise(values: Column) -> Column:
    """Unit length; a zero array stays zero."""
    as_double = F.transform(values, lambda x: x.cast("double"))
    norm = F.sqrt(F.aggregate(as_double, F.lit(0.0), lambda acc, x: acc + x * x))
    return F.when(norm > 0, F.transform(as_double, lambda x: x / norm)).otherwise(as_double)


def softmax(logits: Column) -> Column:
    """Stable softmax of an array of doubles."""
    peak = F.array_max(logits)
    exps = F.transform(logits, lambda x: F.exp(x - peak))
    total = F.aggregate(exps, F.lit(0.0), lambda acc, x: acc + x)
    return F.transform(exps, lambda x: x / total)


def argmax(values: Column) -> Column:
    """Zero-based position of the first largest element."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def sum_vectors(df: DataFrame, key: str, values: str) -> DataFrame:
    """Element-wise sum of array columns per key, combined on the map side in the JVM."""
    vectors = df.select(key, array_to_vector(F.col(values)).alias("__v"))
    total = Summarizer.sum(F.col("__v"))
    return vectors.groupBy(key).agg(vector_to_array(total).alias(values))
