"""Tensor views of the test tables, in Spark and in SQL.

An embedding of 64 floats serves as an 8 x 8 image with one channel, as a 4 x 4 image with four
channels, or as the logits of a 4 x 4 mask with four classes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from maskwright.functions.arrays import argmax, shape_of, unroll
from maskwright.operators.ordering import bucket_split

SEED = 2022


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings")


def to_pixels(values: Column) -> Column:
    """Floats in about -1..1 as whole numbers 0..255, stored as floats."""
    return F.transform(values, lambda v: F.greatest(F.least(
        F.floor((v.cast("double") + F.lit(1.0)) * F.lit(127.5)), F.lit(255)), F.lit(0)).cast("float"))


def to_trimap(values: Column) -> Column:
    """A mask with classes 1..3, one per value."""
    return F.transform(to_pixels(values), lambda v: (v.cast("int") % F.lit(3) + 1).cast("float"))


def images(spark: SparkSession, folder: str) -> DataFrame:
    """vec_id, image 8 x 8 x 1 (0..255), label 8 x 8 (1..3), shapes."""
    return embeddings(spark, folder).select(
        "vec_id", to_pixels(F.col("embedding")).alias("image"), shape_of(8, 8, 1).alias("image_shape"),
        to_trimap(F.col("embedding")).alias("label"), shape_of(8, 8).alias("label_shape"))


def masks(spark: SparkSession, folder: str) -> DataFrame:
    """vec_id, logits 4 x 4 x 4, predicted mask, true mask (one class per image), split."""
    rows = embeddings(spark, folder).select(
        "vec_id", F.col("embedding").alias("logits"), shape_of(4, 4, 4).alias("shape"),
        F.array_repeat((F.col("label") % 4).cast("int"), 16).alias("truth"))
    rows = rows.withColumn("pred", argmax(F.col("logits"), F.col("shape")))
    return bucket_split(rows, ["vec_id"], 0.2, SEED, ("train", "eval"))


def three_channels(image: Column) -> Column:
    """A 4 x 4 view of 64 pixels in three channels: the third is the mean of the last two of four."""
    at = lambda p, c: F.get(image, p * 4 + c)
    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(15)), lambda p: F.array(
        at(p, 0), at(p, 1), F.floor((at(p, 2) + at(p, 3)) / F.lit(2)).cast("float"))))


def pictures(spark: SparkSession, folder: str) -> DataFrame:
    """vec_id, image of 64 pixels, and the mask predicted from the same row."""
    return embeddings(spark, folder).select("vec_id", to_pixels(F.col("embedding")).alias("image"),
                                            argmax(F.col("embedding"), shape_of(4, 4, 4)).alias("pred"))


def long(df: DataFrame, key: str, values: str, out: str = "v", kind: str = "double") -> DataFrame:
    return unroll(df, values, "i", out, key).withColumn(out, F.col(out).cast(kind))


# --- the same in SQL ---

def sql_hash(key: str, seed: int | str = SEED) -> str:
    return f"md5('{seed}:' || CAST({key} AS VARCHAR))"


def sql_split(key: str, fraction: float = 0.2, names: tuple[str, str] = ("train", "eval")) -> str:
    share = f"CAST(('0x' || substr({sql_hash(key)}, 1, 8)) AS BIGINT) / CAST(4294967296 AS DOUBLE)"
    return f"CASE WHEN {share} < CAST({fraction} AS DOUBLE) THEN '{names[1]}' ELSE '{names[0]}' END"


VALUES = ("SELECT vec_id, label, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS i, "
          "unnest(embedding) AS v FROM embeddings")
PIXELS = ("SELECT vec_id, label, i, CAST(greatest(least(floor((CAST(v AS DOUBLE) + CAST(1 AS DOUBLE)) * "
          f"CAST(127.5 AS DOUBLE)), 255), 0) AS INTEGER) AS px FROM ({VALUES})")
# Three channels of a 4 x 4 view, p the place and c the channel.
VIEW = ("SELECT vec_id, CAST(i // 4 AS INTEGER) AS p, CAST(least(i % 4, 2) AS INTEGER) AS c, "
        f"CAST(floor(avg(px)) AS INTEGER) AS px FROM ({PIXELS}) GROUP BY vec_id, i // 4, least(i % 4, 2)")
TRIMAP = f"SELECT vec_id, i, px % 3 + 1 AS cls FROM ({PIXELS})"
# First maximum of every group of four.
ARGMAX = ("SELECT vec_id, label, CAST(i // 4 AS INTEGER) AS px, "
          "CAST(min(i % 4) FILTER (WHERE v = peak) AS INTEGER) AS cls FROM "
          f"(SELECT *, max(v) OVER (PARTITION BY vec_id, i // 4) AS peak FROM ({VALUES})) GROUP BY ALL")
