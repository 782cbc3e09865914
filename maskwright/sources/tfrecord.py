"""Record shards as a Spark data source: ``format("tfrecord")``, read and write.

Reading: small shards are packed into one task up to ``maxPartitionBytes``, large ones are read
record by record, and only the columns of the given schema are decoded. The columns ``split``,
``shard`` and ``record`` come from the file name and the place in the file; filters on ``split``
and ``shard`` drop files before they are opened.

Writing: rows must carry ``split``, ``shard``, ``shard_size`` and lie together per shard, as
``ordering.shard_layout`` places them. Each shard becomes one file ``train-00-32.tfrec``. A folder is written
once: one that holds shards is refused, and a job that fails takes its shards away again.

A folder counts as written when its manifest is there: a Parquet file of shard names with their records, bytes and
checksums, which the job leaves as its last act. Readers take the shards from it and list nothing, so a folder whose
job was lost half-way is refused, and so is a shard that is missing, too short or another one's. Folders that come
from elsewhere, without a manifest, are read with ``option("manifest", "ignore")``, as their files are listed.

A growing set of records is a folder of such folders with a log (``append_records``): a folder enters it, under the next
number, when its manifest is there. A stream over it (``readStream``) has the log's numbers as offsets, so that every
finished folder is read once, whenever it arrives and however often the query is started anew.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from fnmatch import fnmatchcase

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow.fs import FileType
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamReader, EqualTo, In, InputPartition,
    WriterCommitMessage)
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from maskwright.functions.names import SHARD_PATTERN
from maskwright.operators.ordering import buffered_shuffle, check_split, shard_layout
from maskwright.operators.tensors import IMAGE, IMAGE_SHAPE, LABEL, LABEL_SHAPE
from maskwright.sources import record_format as fmt
from maskwright.sources.schema_text import Feature, struct_type
from maskwright.sources.storage import claim, claimed, list_files, open_path, pack, replacing

DEFAULT_SCHEMA = ("split string, shard int, image array<float>, image_shape array<bigint>, "
                  "label array<float>, label_shape array<bigint>")
PLACE = ("split", "shard", "record")
LAYOUT = ("split", "shard", "shard_size", "position")
BATCH_BYTES = 32 << 20
MANIFEST = "_manifest/shards.parquet"
LOG = "_log"
_NUMBERS = {"array<float>": "<f4", "array<double>": "<f8", "array<int>": "<i4", "array<bigint>": "<i8"}


@dataclass
class Shard:
    """A file as its manifest has it; records, bytes and checksum are unknown for a file without one."""

    name: str
    records: int | None = None
    bytes: int | None = None
    crc32: int | None = None


@dataclass
class ShardGroup(InputPartition):
    files: list[tuple[str, Shard]]


@dataclass
class ShardsWritten(WriterCommitMessage):
    shards: list[Shard]


class _Counted:
    """A stream that keeps the length and the checksum of what goes through it."""

    def __init__(self, stream) -> None:
        self.stream, self.bytes, self.crc32 = stream, 0, 0

    def _seen(self, data: bytes) -> bytes:
        self.bytes += len(data)
        self.crc32 = zlib.crc32(data, self.crc32)
        return data

    def read(self, n: int = -1) -> bytes:
        return self._seen(self.stream.read(n) if n >= 0 else self.stream.read())

    def write(self, data: bytes) -> None:
        self.stream.write(self._seen(data))


def read_manifest(folder: str) -> list[Shard]:
    """The shards of a finished folder, by name; a folder without a manifest is an error."""
    if not has_manifest(folder):
        raise ValueError(f"{folder} has no manifest: its job has not finished, or is not one of this library's "
                         "(then read it with the option manifest=ignore)")
    system, inner = open_path(folder)
    with system.open_input_file(f"{inner.rstrip('/')}/{MANIFEST}") as file:
        return [Shard(**row) for row in pq.read_table(file).to_pylist()]


def logged(root: str, after: int = 0, upto: int | None = None) -> list[str]:
    """The folders with numbers above ``after`` and up to ``upto`` in the log of ``root``."""
    folders = []
    for path in claimed(f"{root.rstrip('/')}/{LOG}"):
        number = int(path.rpartition("/")[2])
        if number <= after or upto is not None and number > upto:
            continue
        system, inner = open_path(path)
        with system.open_input_stream(inner) as file:
            folders.append(f"{root.rstrip('/')}/{file.read().decode()}")
    return folders


def has_manifest(folder: str) -> bool:
    system, inner = open_path(folder)
    return system.get_file_info(f"{inner.rstrip('/')}/{MANIFEST}").type == FileType.File


def write_manifest(folder: str, shards: list[Shard]) -> None:
    rows = sorted(shards, key=lambda s: s.name)
    table = pa.table({"name": pa.array([s.name for s in rows], pa.string()),
                      **{c: pa.array([getattr(s, c) for s in rows], pa.int64()) for c in ("records", "bytes", "crc32")}})
    with replacing(folder, MANIFEST) as stream:
        pq.write_table(table, stream)


class RecordReader(DataSourceReader):
    def __init__(self, schema: StructType, options) -> None:
        self.schema = schema
        self.path = options["path"]
        self.strict = options.get("encoding", "numeric") == "tensor"
        self.verify = options.get("verify", "true").lower() != "false"
        self.pack = int(options.get("maxPartitionBytes", 32 << 20))
        self.seed = options.get("shuffleShards")
        self.cycle = int(options.get("interleave", 1))
        self.manifest = options.get("manifest", "require").lower() != "ignore"
        self.keep: dict[str, set] = {}

    def pushFilters(self, filters):
        for f in filters:
            column = ".".join(f.attribute) if isinstance(f, (EqualTo, In)) else None
            if column in ("split", "shard"):
                values = set(f.value) if isinstance(f, In) else {f.value}
                self.keep[column] = self.keep.get(column, values) & values
            else:
                yield f

    def _place(self, path: str) -> dict[str, object]:
        match = re.search(SHARD_PATTERN, path)
        return {"split": match[1], "shard": int(match[2])} if match else {"split": None, "shard": None}

    def _shards(self) -> list[tuple[str, Shard, int]]:
        """Path, manifest entry and size of the folder's shards, or of those that match the pattern in the last part."""
        if not self.manifest:
            return [(path, Shard(path.rpartition("/")[2]), size) for path, size in list_files(self.path)]
        folder, _, pattern = self.path.rstrip("/").rpartition("/")
        if not any(c in pattern for c in "*?[") and not pattern.endswith(".tfrec"):
            folder, pattern = self.path.rstrip("/"), "*"
            if not has_manifest(folder) and (parts := logged(folder)):
                return [(f"{part}/{s.name}", s, s.bytes) for part in parts for s in read_manifest(part)]
        return [(f"{folder}/{s.name}", s, s.bytes) for s in read_manifest(folder) if fnmatchcase(s.name, pattern)]

    def partitions(self) -> Sequence[InputPartition]:
        found = self._shards()
        if not found and (any(c in self.path.rpartition("/")[2] for c in "*?[") or self.path.endswith(".tfrec")):
            raise ValueError(f"no file matches {self.path}")
        kept = [((path, shard), size) for path, shard, size in found
                if all(self._place(path)[c] in values for c, values in self.keep.items())]
        if self.seed is not None:
            kept.sort(key=lambda item: hashlib.md5(f"{self.seed}:{item[0][1].name}".encode()).digest())
        return [ShardGroup(files) for files in pack(kept, self.pack)] or [ShardGroup([])]

    def _rows(self, files: list[tuple[str, Shard]]) -> Iterator[dict[str, object]]:
        """Record by record from ``cycle`` files in turn; where one ends the next takes its place."""
        waiting = [self._records([file]) for file in files]
        while waiting:
            for source in waiting[:self.cycle]:
                row = next(source, None)
                if row is None:
                    waiting.remove(source)
                else:
                    yield row

    def _records(self, files: list[tuple[str, Shard]]) -> Iterator[dict[str, object]]:
        names = [f.name for f in self.schema if f.name not in PLACE]
        tensors = {n.removesuffix("_shape") for n in names}
        for path, shard in files:
            place = self._place(path)
            system, inner = open_path(path)
            if shard.bytes is not None:
                info = system.get_file_info(inner)
                if info.type != FileType.File:
                    raise ValueError(f"{path}: this shard of the manifest is missing")
                if info.size != shard.bytes:
                    raise ValueError(f"{path}: {info.size} bytes, {shard.bytes} by the manifest")
            count = 0
            with system.open_input_stream(inner) as file:
                stream = _Counted(file) if self.verify else file
                for record, message in enumerate(fmt.read_frames(stream, self.verify)):
                    found = fmt.decode_example(message, tensors | set(names))
                    count += 1
                    yield {**place, "record": record, **{n: self._value(found, n, path) for n in names}}
            if shard.records is not None and count != shard.records:
                raise ValueError(f"{path}: {count} records, {shard.records} by the manifest")
            if shard.crc32 is not None and self.verify and stream.crc32 != shard.crc32:
                raise ValueError(f"{path}: not the file of the manifest, by its checksum")

    def _value(self, found: dict[str, object], name: str, path: str):
        kind = self.schema[name].dataType.simpleString()
        value = found.get(name)
        source = name.removesuffix("_shape")
        if value is None and name != source and isinstance(found.get(source), list):
            return fmt.decode_tensor(found[source][0])[1]
        if value is None:
            if self.strict:
                raise ValueError(f"{path}: a record has no feature {name}")
            return [] if kind.startswith("array") else None
        if isinstance(value, list):
            if kind.startswith("array<float") or kind.startswith("array<double"):
                return fmt.decode_tensor(value[0])[0]
            return value if kind.startswith("array") else (value[0] if value else None)
        if kind.startswith("array"):
            try:
                return value.astype(_NUMBERS.get(kind, value.dtype), casting="same_kind", copy=False)
            except TypeError:
                raise ValueError(f"{path}: feature {name} holds {value.dtype.name} values, not {kind}") from None
        return value[0].item() if len(value) else None

    def read(self, partition: ShardGroup) -> Iterator[pa.RecordBatch]:
        target = to_arrow_schema(self.schema)
        rows: list[dict[str, object]] = []
        size = 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([r[f.name] for r in rows], f.type) for f in target], schema=target)

        for row in self._rows(partition.files):
            rows.append(row)
            size += sum(v.nbytes if isinstance(v, np.ndarray) else 64 for v in row.values())
            if size >= BATCH_BYTES:
                yield batch()
                rows, size = [], 0
        if rows:
            yield batch()


class RecordStream(DataSourceStreamReader):
    """The finished folders of a log, in its order; an offset is the number of the last one read."""

    def __init__(self, schema: StructType, options) -> None:
        self.reader = RecordReader(schema, options)

    def initialOffset(self) -> dict:
        return {"number": 0}

    def latestOffset(self) -> dict:
        return {"number": max((int(p.rpartition("/")[2]) for p in claimed(f"{self.reader.path.rstrip('/')}/{LOG}")), default=0)}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        folders = logged(self.reader.path, start["number"], end["number"])
        shards = [((f"{folder}/{s.name}", s), s.bytes) for folder in folders for s in read_manifest(folder)]
        return [ShardGroup(files) for files in pack(shards, self.reader.pack)]

    def read(self, partition: ShardGroup) -> Iterator[pa.RecordBatch]:
        return self.reader.read(partition)


class RecordWriter(DataSourceArrowWriter):
    def __init__(self, schema: StructType, options) -> None:
        self.path = options["path"]
        self.tensor = options.get("encoding", "numeric") == "tensor"
        names = [f.name for f in schema]
        missing = [c for c in ("split", "shard", "shard_size") if c not in names]
        if missing:
            raise ValueError(f"record shards need the columns {', '.join(missing)}: use shard_layout")
        self.features = [n for n in names if n not in LAYOUT]
        system, inner = open_path(self.path)
        if has_manifest(self.path) or system.get_file_info(inner).type == FileType.Directory and list_files(f"{self.path.rstrip('/')}/*.tfrec"):
            raise ValueError(f"{self.path} holds record shards already: write to a new folder")

    def _example(self, columns: dict[str, pa.Array], row: int) -> bytes:
        values = {}
        for name in self.features:
            cell = columns[name][row]
            if not cell.is_valid:
                continue
            if pa.types.is_list(cell.type):
                values[name] = cell.values.to_numpy(zero_copy_only=False)
            elif pa.types.is_binary(cell.type):
                values[name] = cell.as_py()
            elif pa.types.is_string(cell.type):
                values[name] = cell.as_py().encode()
            else:
                values[name] = np.array([cell.as_py()])
        if self.tensor:
            shapes = {n: values.pop(n) for n in list(values) if n.endswith("_shape")}
            values = {n: fmt.encode_tensor(v, shapes[f"{n}_shape"]) if f"{n}_shape" in shapes else v
                      for n, v in values.items()}
        return fmt.encode_example(values)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        done: dict[tuple[str, int], Shard] = {}

        def messages():
            for batch in iterator:
                columns = {n: batch.column(n) for n in batch.schema.names}
                keys = zip(*[columns[c].to_pylist() for c in ("split", "shard", "shard_size")])
                for row, key in enumerate(keys):
                    yield key, columns, row

        def write_shard(key, first, rest):
            split, shard, size = key
            if (split, shard) in done:
                raise ValueError(f"rows of shard {split}-{shard} do not lie together: use shard_layout")
            name = f"{split}-{shard:02d}-{size}.tfrec"
            count, item, waiting, held = 0, first, [], 0
            with replacing(self.path, name) as file:
                stream = _Counted(file)
                while item is not None and item[0] == key:
                    waiting.append(self._example(item[1], item[2]))
                    held += len(waiting[-1])
                    if held >= fmt.GROUP_BYTES:
                        stream.write(fmt.frame(waiting))
                        waiting, held = [], 0
                    count, item = count + 1, next(rest, None)
                stream.write(fmt.frame(waiting))
                if count != size:
                    raise ValueError(f"shard {split}-{shard} holds {count} records, not {size}")
            done[split, shard] = Shard(name, count, stream.bytes, stream.crc32)
            return item

        rest = messages()
        try:
            item = next(rest, None)
            while item is not None:
                item = write_shard(item[0], item, rest)
        except BaseException:
            self._remove(s.name for s in done.values())  # an attempt that follows writes them again
            raise
        return ShardsWritten(list(done.values()))

    def _remove(self, names) -> None:
        system, inner = open_path(self.path)
        for name in names:
            system.delete_file(f"{inner.rstrip('/')}/{name}")

    def abort(self, messages) -> None:
        self._remove(s.name for message in messages if message is not None for s in message.shards)

    def commit(self, messages) -> None:
        write_manifest(self.path, [s for message in messages if message is not None for s in message.shards])


class RecordSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tfrecord"

    def schema(self) -> str:
        return DEFAULT_SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return RecordReader(schema, self.options)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return RecordStream(schema, self.options)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError("record shards are written with mode('append') to a new folder")
        return RecordWriter(schema, self.options)


def register(spark: SparkSession) -> None:
    """Make ``format("tfrecord")`` known to the session, with filters handed to it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(RecordSource)


def example_columns(df: DataFrame) -> DataFrame:
    """The four feature columns with their stored types; integer masks become floats."""
    kinds = {IMAGE: "array<float>", IMAGE_SHAPE: "array<bigint>", LABEL: "array<float>", LABEL_SHAPE: "array<bigint>"}
    return df.withColumns({c: F.col(c).cast(kind) for c, kind in kinds.items() if c in df.columns})


def write_records(df: DataFrame, path: str, keys: Sequence[str], size: int = 32, seed: int = 2022,
                  encoding: str = "numeric", keep_keys: bool = False, index: DataFrame | None = None,
                  row_bytes: int | None = None, halves: Sequence[str] = ()) -> None:
    """Write the rows of ``df`` (with a ``split`` column) as shards of ``size`` records into a new folder.

    ``index``, ``row_bytes``, ``halves``: see ``shard_layout``.
    """
    register(df.sparkSession)
    placed = shard_layout(example_columns(df), keys, size, seed, index=index, row_bytes=row_bytes,
                          halves=halves)
    if not keep_keys:
        placed = placed.drop(*[k for k in keys if k not in LAYOUT])
    placed.write.format("tfrecord").mode("append").option("encoding", encoding).save(path)


def append_records(df: DataFrame, root: str, keys: Sequence[str], **kwargs) -> str:
    """Write the rows as a new folder below ``root`` and enter it in the log; returns the folder."""
    name = f"part-{uuid.uuid4().hex}"
    write_records(df, f"{root.rstrip('/')}/{name}", keys, **kwargs)
    claim(df.sparkSession, f"{root.rstrip('/')}/{LOG}", name.encode())
    return f"{root.rstrip('/')}/{name}"


def read_record_stream(spark: SparkSession, root: str, schema: str | StructType | None = None,
                       encoding: str = "numeric", verify: bool = True) -> DataFrame:
    """The folders that ``append_records`` has entered in the log of ``root``, and will, as a stream."""
    register(spark)
    reader = spark.readStream.format("tfrecord").option("encoding", encoding).option("verify", str(verify))
    return (reader.schema(schema) if schema is not None else reader).load(root)


def read_records(spark: SparkSession, path: str, schema: str | StructType | None = None,
                 encoding: str = "numeric", verify: bool = True, manifest: str = "require",
                 options: dict[str, str] | None = None) -> DataFrame:
    """Shards of a folder or name pattern. In ``tensor`` encoding a missing feature is an error.

    ``manifest="ignore"`` reads the files of a folder that has none. Other ``options``: ``maxPartitionBytes``;
    ``shuffleShards``, a seed for the order of shards; ``interleave``, the number of a task's shards read in turn.
    """
    register(spark)
    reader = spark.read.format("tfrecord").option("encoding", encoding).option("verify", str(verify)).option(
        "manifest", manifest).options(**(options or {}))
    return (reader.schema(schema) if schema is not None else reader).load(path)


def feed(spark: SparkSession, path: str, batch: int, epochs: int, seed: int, cycle: int = 4, buffer: int | None = None,
         **kwargs) -> DataFrame:
    """Training batches: all records once per epoch, shuffled by a buffer as they are read; no exchange.

    In every epoch the shards come in another seeded order, ``cycle`` of a task's shards are read in turn, and their
    records leave a buffer of two batches (or ``buffer`` rows) at random. Adds ``epoch``, ``stream`` (the task's number) and
    ``batch_id`` in it. The same seed and shards give the same batches. ``kwargs`` are those of ``read_records``.
    """
    if epochs < 1 or batch < 1 or cycle < 1:
        raise ValueError("there must be one epoch, one row per batch and one open shard at least")
    parts = []
    for epoch in range(epochs):
        rows = read_records(spark, path, options={"shuffleShards": f"{seed}:{epoch}", "interleave": str(cycle)}, **kwargs)
        parts.append(buffered_shuffle(rows, buffer or 2 * batch, seed + epoch).select(
            *rows.columns, F.lit(epoch).alias("epoch"), "stream", F.floor(F.col("position") / batch).cast("int").alias("batch_id")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def read_split(spark: SparkSession, path: str, split: str, **kwargs) -> DataFrame:
    """The shards of one split, ``train`` or ``val``."""
    return read_records(spark, f"{path.rstrip('/')}/{check_split(split)}-*", **kwargs)


def read_fixed(spark: SparkSession, path: str, features: list[Feature]) -> DataFrame:
    """Records with a declared schema: a list that does not have the declared length fails the job."""
    df = read_records(spark, path, struct_type(features))
    for f in features:
        if f.shape is not None:
            fits = F.size(f.name) == F.lit(int(np.prod(f.shape)))
            df = df.withColumn(f.name, F.when(fits, F.col(f.name)).otherwise(
                F.raise_error(F.lit(f"feature {f.name} does not have its declared shape"))))
    return df


# Split names of the dataset run and the shard files that belong to them.
ALL_SHARDS = {"train": "train-*.tfrec", "eval": "val-*.tfrec"}
FIRST_SHARDS = {"train": "train-00-*.tfrec", "eval": "val-00-*.tfrec"}


def import_splits(spark: SparkSession, base: str, patterns: dict[str, str] = ALL_SHARDS, **kwargs) -> DataFrame:
    """The union of one read per split pattern, with the pattern's name in ``split``."""
    parts = [read_records(spark, f"{base.rstrip('/')}/{pattern}", **kwargs).withColumn("split", F.lit(name))
             for name, pattern in patterns.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
