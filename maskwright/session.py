"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyarrow.fs import FileType
from pyspark.sql import SparkSession

from maskwright.sources.storage import open_path


def build_session(app: str = "maskwright", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library is tuned for.

    Image rows are wide (a 128x128x3 float tensor is 196 KB), so column batches of the parquet
    reader and Arrow batches are kept to a few hundred rows; every other choice is left to
    adaptive execution.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.parquet.columnarReaderBatchSize": "512",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
        "spark.sql.python.filterPushdown.enabled": "true",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_GIVEN: dict[str, list[str]] = {}  # scratch paths by application


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder path below the session's checkpoint folder, which every executor must reach.

    It is the setting ``spark.checkpoint.dir``, or else what ``SparkContext.setCheckpointDir`` was given. What is written
    there stays until ``clear_scratch``: results may be read from it as often as wanted.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _GIVEN.setdefault(getattr(spark.sparkContext, "applicationId", ""), []).append(path)
    return path


def clear_scratch(spark: SparkSession, since: int = 0) -> int:
    """Delete the scratch folders that this application was given, after the first ``since`` of them; returns their number.

    To be called when the results of the queries that made them have been read or written elsewhere:

        before = scratch_count(spark); query(spark).write.parquet(target); clear_scratch(spark, before)
    """
    given = _GIVEN.get(spark.sparkContext.applicationId, [])
    gone = 0
    for path in given[since:]:
        system, inner = open_path(path)
        if system.get_file_info(inner).type == FileType.Directory:
            system.delete_dir(inner)
            gone += 1
    del given[since:]
    return gone


def scratch_count(spark: SparkSession) -> int:
    """How many scratch folders this application has been given and not cleared."""
    return len(_GIVEN.get(spark.sparkContext.applicationId, []))


@contextmanager
def _unless_set(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    if spark.conf.get(name, None) is not None:
        yield
        return
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name)


def small_batches(spark: SparkSession, size: int = 4 << 20) -> AbstractContextManager[None]:
    """Actions inside send rows to Python about ``size`` bytes at a time, unless the session sets another limit: limited
    by rows alone, texts make large batches, which the executor and its worker hold at once."""
    return _unless_set(spark, "spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def dropping_shuffles(spark: SparkSession) -> AbstractContextManager[None]:
    """Writes inside delete their shuffle files when they end, unless the session sets otherwise: else the files of one step
    stay beside those of the next until the driver happens to collect its garbage."""
    return _unless_set(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def materialise(df, name: str):
    """Write ``df`` to the scratch folder and read it back: lineage is cut on shared storage, shuffle files go."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with dropping_shuffles(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
