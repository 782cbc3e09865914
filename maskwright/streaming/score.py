"""Scoring a stream of files: the batch transform, applied to whatever has arrived."""

from __future__ import annotations

from collections.abc import Callable

from pyarrow.fs import FileType
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from maskwright.sources.storage import open_path


def read_stream(spark: SparkSession, folder: str, schema: StructType, pattern: str | None = None,
                files_per_trigger: int | None = None) -> DataFrame:
    """Parquet files of a folder as a stream, optionally only those matching a name pattern."""
    reader = spark.readStream.schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def read_table_stream(spark: SparkSession, path: str, schema: StructType, files_per_trigger: int | None = None) -> DataFrame:
    """A Parquet table as a stream, be it a folder of files, as Spark writes it, or a single file.

    Spark streams folders only, so a single file is named by a pattern in its folder.
    """
    system, inner = open_path(path.rstrip("/"))
    if system.get_file_info(inner).type == FileType.Directory:
        return read_stream(spark, path, schema, files_per_trigger=files_per_trigger)
    folder, _, name = path.rpartition("/")
    return read_stream(spark, folder, schema, name, files_per_trigger)


def score_stream(stream: DataFrame, score: Callable[[DataFrame], DataFrame], output: str,
                 checkpoint: str) -> StreamingQuery:
    """Score everything available and stop. Stateless, so no watermark; the checkpoint makes it exactly-once."""
    return (stream.transform(score).writeStream.format("parquet").outputMode("append")
            .option("path", output).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
