"""File trees on shared storage, read and written by tasks with ``format("filetree")``: one row is one file.

Spark's own binary file source leaves out empty and hidden files, which a copy of a tree must keep.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage)

from maskwright.sources.storage import folder_size, open_path, pack, replacing, walk

TASK_FILES = 1 << 10  # that one task opens, if they are small
TASK_LISTED = 1 << 14  # that one task lists
TASK_BYTES = 64 << 20  # of files that one task reads


@dataclass
class FilesWritten(WriterCommitMessage):
    files: int


class TreeWriter(DataSourceArrowWriter):
    def __init__(self, options) -> None:
        self.root = options["path"]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        count = 0
        for batch in iterator:
            for path, content in zip(batch.column("path"), batch.column("content")):
                name = path.as_py()
                if name.startswith("/") or ".." in name.split("/"):
                    raise ValueError(f"path leaves the tree: {name}")
                data = content.as_py()
                with replacing(self.root, name) as stream:
                    stream.write(data.encode() if isinstance(data, str) else data)
                count += 1
        return FilesWritten(count)


@dataclass
class FileGroup(InputPartition):
    paths: list[str]


class TreeReader(DataSourceReader):
    def __init__(self, options) -> None:
        self.root = options["path"].rstrip("/")
        self.pack = int(options.get("maxPartitionBytes", 32 << 20))

    def partitions(self) -> list[FileGroup]:
        return [FileGroup(paths) for paths in pack(walk(self.root), self.pack)] or [FileGroup([])]

    def read(self, partition: FileGroup) -> Iterator[pa.RecordBatch]:
        for path in partition.paths:
            system, inner = open_path(f"{self.root}/{path}")
            with system.open_input_stream(inner) as stream:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path], pa.string()), pa.array([stream.read()], pa.binary())], ["path", "content"])


class TreeSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "filetree"

    def schema(self) -> str:
        return "path string, content binary"

    def reader(self, schema) -> DataSourceReader:
        return TreeReader(self.options)

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError("a file tree is written with mode('append') to a new folder")
        if not {"path", "content"} <= set(schema.names):
            raise ValueError("a file tree needs the columns path and content")
        return TreeWriter(self.options)


def write_tree(df: DataFrame, root: str) -> None:
    """One file per row, named by the relative ``path``."""
    df.sparkSession.dataSource.register(TreeSource)
    df.select("path", "content").write.format("filetree").mode("append").save(root)


def read_tree(spark: SparkSession, root: str) -> DataFrame:
    """All files below ``root`` as ``(path, content)``, paths relative to it."""
    spark.dataSource.register(TreeSource)
    return spark.read.format("filetree").load(root)


def list_folder(spark: SparkSession, folder: str, suffix: str) -> DataFrame:
    """Paths and sizes of the files with a suffix, not recursive; contents are not read."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}").load(folder)
    return in_few_tasks(listed, folder, suffix, TASK_LISTED, None).select("path", "length")


def in_few_tasks(scan: DataFrame, folder: str, suffix: str, files: int = TASK_FILES,
                 size: int | None = TASK_BYTES) -> DataFrame:
    """A scan of the files with a suffix in tasks of about ``files`` files or ``size`` bytes, whichever are fewer.

    Spark takes a file for 4 MB at least, so of small ones a task would read 32 only, and a large folder would cost more
    in starting tasks than in reading. No rows move: neighbouring parts of the scan are read by one task.
    """
    found = folder_size(folder, suffix)
    if found is None:
        return scan
    count, total = found
    tasks = max(-(-count // files), -(-total // size) if size else 0)
    return scan.coalesce(max(tasks, 2 * scan.sparkSession.sparkContext.defaultParallelism))
