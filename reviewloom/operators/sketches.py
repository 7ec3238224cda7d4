"""Stored, mergeable summaries: quantiles (KLL) and distinct values (Theta) per group.

A sketch table holds one small binary per group and measure.  It is built once per
batch of rows, stored, and united with those of other batches or over groups without
reading rows again.  No task ever holds the distinct values of a column.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.plans.shapes import col

MOST_K = 65_535
LG_K = 12  # 4,096 hashes kept per distinct sketch; the standard error is 1 / 64


def kll_size(rank_error: float) -> int:
    """The k of a KLL sketch whose ranks are within ``rank_error`` (a share of the rows)
    with 99 % confidence."""
    if not 0 < rank_error < 1:
        raise ValueError("rank_error must be between 0 and 1")
    k = math.ceil((2.296 / rank_error) ** (1 / 0.9021))
    if k > MOST_K:
        raise ValueError(f"rank_error {rank_error} needs a sketch of more than {MOST_K}")
    return max(8, k)


def _stacked(values: Mapping[str, Column], kind: str) -> Column:
    """One (measure, value) row per measure of a row."""
    pairs = [F.struct(F.lit(n).alias("measure"), v.cast(kind).alias("value")) for n, v in values.items()]
    return F.inline(F.array(*pairs))


def quantile_sketches(
    df: DataFrame, values: Mapping[str, Column], by: Sequence[str] = (), rank_error: float = 0.005
) -> DataFrame:
    """(by..., measure, n, low, high, sketch) of the non-NULL numbers of each measure."""
    rows = df.select(*[col(b) for b in by], _stacked(values, "double")).where("value is not null")
    return rows.groupBy(*by, "measure").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("value").alias("low"),
        F.max("value").alias("high"),
        F.kll_sketch_agg_double("value", F.lit(kll_size(rank_error))).alias("sketch"),
    )


def unite_quantiles(sketches: DataFrame, by: Sequence[str] = (), rank_error: float = 0.005) -> DataFrame:
    """Sketches of larger groups (or of several stored tables, by union) from smaller ones."""
    return sketches.groupBy(*by, "measure").agg(
        F.sum("n").alias("n"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.kll_merge_agg_double("sketch", F.lit(kll_size(rank_error))).alias("sketch"),
    )


def quantile(sketch: str | Column, fraction: float) -> Column:
    """A value of the sketched rows whose rank is about ``fraction``."""
    return F.kll_sketch_get_quantile_double(sketch, F.lit(float(fraction)))


def quantiles_of(sketches: DataFrame, fractions: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """(by..., measure, fraction, value) of a sketch table."""
    found = F.array(
        *[
            F.struct(F.lit(float(f)).alias("fraction"), quantile("sketch", f).alias("value"))
            for f in fractions
        ]
    )
    return sketches.select(*by, "measure", F.inline(found))


def rank_gaps(
    df: DataFrame, values: Mapping[str, Column], estimates: DataFrame
) -> DataFrame:
    """(measure, fraction, n, gap): how far the rank of each estimate is from its fraction.

    ``estimates`` has one row per (measure, fraction), a handful by construction.  An
    estimate that is tied with other rows has a range of ranks; the nearest counts.
    """
    rows = df.select(_stacked(values, "double")).where("value is not null")
    wanted = estimates.select("measure", "fraction", F.col("value").alias("estimate"))
    counted = (
        rows.join(F.broadcast(wanted), "measure")
        .groupBy("measure", "fraction")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("value") < F.col("estimate")).alias("below"),
            F.count_if(F.col("value") <= F.col("estimate")).alias("upto"),
        )
    )
    low, high = F.col("below") / F.col("n"), F.col("upto") / F.col("n")
    gap = F.greatest(low - F.col("fraction"), F.col("fraction") - high, F.lit(0.0))
    return counted.select("measure", "fraction", "n", gap.alias("gap"))


def distinct_sketches(
    df: DataFrame, values: Mapping[str, Column], by: Sequence[str] = (), lg_k: int = LG_K
) -> DataFrame:
    """(by..., measure, sketch) of the non-NULL values of each measure, compared as text."""
    rows = df.select(*[col(b) for b in by], _stacked(values, "string")).where("value is not null")
    return rows.groupBy(*by, "measure").agg(F.theta_sketch_agg("value", F.lit(lg_k)).alias("sketch"))


def unite_distinct(sketches: DataFrame, by: Sequence[str] = (), lg_k: int = LG_K) -> DataFrame:
    """Sketches of larger groups (or of several stored tables, by union) from smaller ones.

    The union keeps the least hashes of all parts, so it does not depend on how the rows
    were parted: uniting per-source sketches gives what the whole table gives.
    """
    return sketches.groupBy(*by, "measure").agg(F.theta_union_agg("sketch", F.lit(lg_k)).alias("sketch"))


def distinct_estimates(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by..., measure, estimate) of a sketch table."""
    return sketches.select(*by, "measure", F.theta_sketch_estimate("sketch").alias("estimate"))


def overlap_estimates(sketches: DataFrame, by: str) -> DataFrame:
    """(measure, left, right, shared): distinct values that two groups share, for each pair
    of groups.  ``sketches`` has one row per group and measure; groups are few (sources)."""
    one = sketches.select("measure", col(by).alias("left"), F.col("sketch").alias("a"))
    two = sketches.select("measure", col(by).alias("right"), F.col("sketch").alias("b"))
    pairs = one.join(two, (one["measure"] == two["measure"]) & (F.col("left") < F.col("right")))
    shared = F.theta_sketch_estimate(F.theta_intersection("a", "b"))
    return pairs.select(one["measure"], "left", "right", shared.alias("shared"))


def within(estimate: Column, exact: Column, lg_k: int = LG_K, deviations: float = 4.0) -> Column:
    """Whether a distinct estimate is as close as the size of its sketch promises."""
    return F.abs(estimate - exact) <= exact * (deviations / math.sqrt(1 << lg_k))
