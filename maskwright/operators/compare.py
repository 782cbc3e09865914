"""Comparing two datasets or two scorers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from maskwright.functions.arrays import unroll
from maskwright.operators.profile import EXACT, feature_stats, histogram


def stats_side_by_side(stats: DataFrame, left: str = "eval", right: str = "train") -> DataFrame:
    """Statistics of two splits next to each other; a statistic missing on one side stays, with null."""
    a = stats.filter(F.col("split") == left).select("feature", "stat", F.col("value").alias("left_value"))
    b = stats.filter(F.col("split") == right).select("feature", "stat", F.col("value").alias("right_value"))
    return a.join(b, ["feature", "stat"], "full_outer").withColumn(
        "difference", F.col("left_value") - F.col("right_value"))


def histogram_distance(histograms: DataFrame, left: str = "eval", right: str = "train") -> DataFrame:
    """Largest difference of bucket shares (L-infinity) per feature, from histograms over a shared range."""
    sides = histograms.filter(F.col("split").isin(left, right)).groupBy("feature", "bucket").agg(
        F.sum(F.when(F.col("split") == left, F.col("n")).otherwise(0)).alias("a"),
        F.sum(F.when(F.col("split") == right, F.col("n")).otherwise(0)).alias("b"))
    totals = sides.groupBy("feature").agg(F.sum("a").alias("ta"), F.sum("b").alias("tb"))
    share = F.abs(F.col("a") / F.col("ta") - F.col("b") / F.col("tb"))
    return sides.join(totals, "feature").groupBy("feature").agg(F.max(share).alias("linf"))


def split_skew(df: DataFrame, features: Sequence[str], split: str = "split", left: str = "eval",
               right: str = "train", buckets: int = 10, median: str | None = EXACT) -> DataFrame:
    """Statistics side by side, plus the histogram distance as a statistic named ``linf``."""
    table = stats_side_by_side(feature_stats(df, features, split, median), left, right)
    distance = histogram_distance(histogram(df, features, split, buckets, shared_range=True), left, right)
    extra = distance.select(
        "feature", F.lit("linf").alias("stat"), F.lit(None).cast("double").alias("left_value"),
        F.lit(None).cast("double").alias("right_value"), F.col("linf").alias("difference"))
    return table.unionByName(extra)


def parity(left: DataFrame, right: DataFrame, key: str, values: str, rtol: float = 1e-7,
           atol: float = 0.0) -> DataFrame:
    """Do two scorers agree? One row of counts and largest differences.

    Rows are matched by key (full outer) and unrolled to elements; an element passes when
    ``|a - b| <= atol + rtol * |b|``. Equal infinities and two NaN agree, with a gap of 0. Keys or elements
    found on one side only are counted as unmatched.
    """
    a = left.select(key, F.col(values).alias("a"))
    b = right.select(key, F.col(values).alias("b"))
    both = a.join(b, key, "full_outer")
    zipped = F.arrays_zip(F.coalesce("a", F.array()).alias("a"), F.coalesce("b", F.array()).alias("b"))
    pixels = unroll(both, zipped, "i", "p").select(
        F.col("p.a").cast("double").alias("a"), F.col("p.b").cast("double").alias("b"))
    same = (F.col("a") == F.col("b")) | (F.isnan("a") & F.isnan("b"))
    gap = F.when(same, F.lit(0.0)).otherwise(F.abs(F.col("a") - F.col("b")))
    matched = F.col("a").isNotNull() & F.col("b").isNotNull()
    finite = ~F.isnan("b") & (F.abs("b") < F.lit(float("inf"))) & ~F.isnan(gap)
    close = same | (finite & (gap <= F.lit(float(atol)) + F.lit(float(rtol)) * F.abs("b")))
    return pixels.agg(
        F.count_if(matched).alias("compared"),
        F.count_if(~matched).alias("unmatched"),
        F.count_if(matched & ~close).alias("different"),
        F.max(gap).alias("max_abs"),
        F.max(F.when(F.col("b") != 0, F.when(same, F.lit(0.0)).otherwise(gap / F.abs("b")))).alias("max_rel"),
    ).withColumn("equal", (F.col("different") == 0) & (F.col("unmatched") == 0))
