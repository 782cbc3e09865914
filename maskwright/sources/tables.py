"""Tables a dataset run leaves behind: transformed examples, statistics, evaluations.

All are parquet, appended under ``run=<clock>`` and split folders, so that reading one split or the
latest run opens only its own folders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from maskwright.operators.ordering import seeded_shuffle
from maskwright.operators.tensors import LABEL, transformed_name


def write_transformed(df: DataFrame, path: str) -> None:
    df.write.mode("error").partitionBy("split").parquet(path)


def read_transformed(spark: SparkSession, path: str, split: str, label: str = transformed_name(LABEL)) -> DataFrame:
    """One split as ``features`` (every other column, as one struct) and ``label``."""
    rows = spark.read.parquet(path).filter(F.col("split") == F.lit(split)).drop("split")
    return rows.select(F.struct(*[c for c in rows.columns if c != label]).alias("features"),
                       F.col(label).alias("label"))


def read_shuffled(spark: SparkSession, path: str, split: str, keys: list[str], seed: int) -> DataFrame:
    """One split in seeded order for training; evaluation reads need no order."""
    rows = spark.read.parquet(path).filter(F.col("split") == F.lit(split))
    return seeded_shuffle(rows, keys, seed)


def append_run(df: DataFrame, path: str, clock: int, *partitions: str) -> None:
    """Append the rows of one run. A run appended twice fails rather than doubling its rows."""
    writer = df.write.mode("error")
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.parquet(f"{path.rstrip('/')}/run={int(clock)}")


def read_run(spark: SparkSession, path: str, clock: int | None = None) -> DataFrame:
    """The rows of one run, the latest unless given. Other runs are pruned by folder."""
    table = spark.read.parquet(path)
    if clock is None:
        clock = table.agg(F.max("run")).first()[0]  # answered from folder names and file footers
    return table.filter(F.col("run") == F.lit(clock)).drop("run")


def read_stats(spark: SparkSession, path: str, split: str, clock: int | None = None) -> DataFrame:
    """Statistics of one split of a run."""
    return read_run(spark, path, clock).filter(F.col("split") == F.lit(split))
