"""Token ids in files of shuffled planes.

A file holds the ids of a range of documents. Ids are cut into chunks of ``CHUNK`` ids; a chunk is transposed into
planes (all lowest bytes, then all second bytes, ...; or the same by bits) and each plane is compressed with zstandard
on its own: equal high planes shrink to nothing. Layout, integers little-endian:

    b"IDPLANES" | planes of chunk 0 | planes of chunk 1 | ... | index | length of index, 8 bytes | b"IDPLANES"

The index is zstandard-compressed: a header of three int64 (unit of a plane in bits, chunks, documents), then per chunk
five int64 (offset in the file, ids, planes, id before it in the file, bytes) with each plane's length, then per
document doc_id, whether it has one, and its number of ids. A reader can fetch any chunk by its offset.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from maskwright.llm.tokens import encoder, with_end
from maskwright.llm.words import chunks
from maskwright.session import materialise
from maskwright.sources.storage import open_path, replacing

MAGIC = b"IDPLANES"
CHUNK = 1 << 17
PLANES = 32  # an index keeps room for that many lengths
FILE_BYTES = 48 << 20  # of text per file

_CHUNK = np.dtype([("offset", "<i8"), ("ids", "<i8"), ("planes", "<i8"), ("before", "<i8"), ("bytes", "<i8"),
                   ("lengths", "<i8", (PLANES,))])
_DOC = np.dtype([("doc_id", "<i8"), ("known", "u1"), ("n", "<i8")])


def to_planes(ids: np.ndarray, unit: int = 8) -> list[bytes]:
    """Compressed planes of ``ids``, lowest first; planes above the highest set bit or byte are left out."""
    raw = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    planes = raw if unit == 8 else np.packbits(
        np.unpackbits(raw, axis=1, bitorder="little"), axis=0, bitorder="little")
    top = int(ids.max(initial=0)).bit_length()
    pack = zstandard.ZstdCompressor(level=1).compress
    return [pack(np.ascontiguousarray(planes[:, k]).tobytes()) for k in range(-(-top // unit))]


def from_planes(planes: list[bytes], n: int, unit: int = 8) -> np.ndarray:
    unpack = zstandard.ZstdDecompressor().decompress
    held = np.zeros((n if unit == 8 else -(-n // 8), 32 // unit), np.uint8)
    for k, plane in enumerate(planes):
        held[:, k] = np.frombuffer(unpack(plane), np.uint8)
    if unit == 1:
        held = np.packbits(np.unpackbits(held, axis=0, bitorder="little")[:n], axis=1, bitorder="little")
    return held.reshape(-1).view("<u4")


class Writer:
    """Writes one file: documents in, chunks out as they fill."""

    def __init__(self, stream, unit: int):
        self.stream, self.unit, self.at = stream, unit, len(MAGIC)
        self.chunks, self.docs, self.held, self.size, self.total = [], [], [], 0, 0
        stream.write(MAGIC)

    def add(self, ids: np.ndarray, docs: np.ndarray) -> None:
        self.docs.append(docs)
        self.held.append(ids)
        self.size += len(ids)
        if self.size >= CHUNK:
            ids = np.concatenate(self.held)
            whole = self.size - self.size % CHUNK
            for at in range(0, whole, CHUNK):
                self._chunk(ids[at:at + CHUNK])
            self.held, self.size = [ids[whole:]], self.size - whole

    def _chunk(self, ids: np.ndarray) -> None:
        planes = to_planes(ids, self.unit)
        entry = np.zeros(1, _CHUNK)
        entry["lengths"][0, :len(planes)] = [len(p) for p in planes]
        size = sum(map(len, planes))
        for name, value in (("offset", self.at), ("ids", len(ids)), ("planes", len(planes)), ("before", self.total),
                            ("bytes", size)):
            entry[name] = value
        self.chunks.append(entry)
        self.stream.write(b"".join(planes))
        self.at += size
        self.total += len(ids)

    def close(self) -> tuple[int, int]:
        if self.size:
            self._chunk(np.concatenate(self.held))
        docs = np.concatenate([np.empty(0, _DOC), *self.docs])
        head = np.array([self.unit, len(self.chunks), len(docs)], "<i8")
        index = zstandard.ZstdCompressor().compress(
            head.tobytes() + b"".join(c.tobytes() for c in self.chunks) + docs.tobytes())
        self.stream.write(index + len(index).to_bytes(8, "little") + MAGIC)
        return len(docs), self.total


def read_index(file) -> tuple[int, np.ndarray, np.ndarray]:
    """Unit, chunks and documents of an open file; raises ValueError for another or an unfinished file."""
    size = file.size()
    file.seek(max(0, size - 16))
    tail = file.read(16)
    if len(tail) < 16 or tail[8:] != MAGIC:
        raise ValueError("no finished file of id planes")
    n = int.from_bytes(tail[:8], "little")
    file.seek(size - 16 - n)
    index = zstandard.ZstdDecompressor().decompress(file.read(n))
    unit, n_chunks, n_docs = np.frombuffer(index, "<i8", 3).tolist()
    held = np.frombuffer(index, _CHUNK, n_chunks, 24)
    return unit, held, np.frombuffer(index, _DOC, n_docs, 24 + held.nbytes)


def read_file(file) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    """Documents (as in the index) with their ids, some chunks at a time."""
    unit, held, docs = read_index(file)
    ends = np.cumsum(docs["n"])
    rest, begin, done = np.empty(0, np.uint32), 0, 0
    for entry in held:
        file.seek(int(entry["offset"]))
        raw = file.read(int(entry["bytes"]))
        cuts = np.cumsum(entry["lengths"][:entry["planes"]]).tolist()
        planes = [raw[a:b] for a, b in zip([0, *cuts], cuts)]
        rest = np.concatenate([rest, from_planes(planes, int(entry["ids"]), unit)])
        upto = int(np.searchsorted(ends, begin + len(rest), "right"))
        if upto > done:
            cuts = ends[done:upto] - begin
            yield docs[done:upto], np.split(rest[:cuts[-1]], cuts[:-1])
            rest, begin, done = rest[cuts[-1]:], int(ends[upto - 1]), upto


def write_ids(docs: DataFrame, folder: str, tokenizer: Callable[[], str], gaps: bool, end_id: int,
              id_col: str = "doc_id", text_col: str = "text", unit: int = 8, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the ids of all texts, each followed by ``end_id``, below ``folder``; returns file, path, docs, tokens.

    Documents go in ascending ``id_col``, nulls first; equal ids in the order of their texts' hashes, then as read.
    A null or empty text has only the end id. ``tokenizer`` gives the file's path on the machine that runs a task.
    Ranges of documents make files of about ``file_bytes`` of text. Rows with one id spread over files like any others.
    A file is written whole or not at all, and a task that runs again writes the same file. An empty table gives no
    document, in files without any. Other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("id_"), F.col(text_col).cast("string").alias("text_"))
    size = rows.agg(F.sum(F.octet_length("text_"))).first()[0] or 0
    order = ["id_", "hash_", "row_"]
    ranged = rows.withColumns({"hash_": F.xxhash64("text_"), "row_": F.monotonically_increasing_id()}).repartitionByRange(
        int(size // file_bytes) + 1, *order).sortWithinPartitions(*order)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, ids_of = TaskContext.get().partitionId(), encoder(tokenizer(), gaps)
        name = f"ids-{file:08d}.planes"
        with replacing(folder, name) as stream:
            writer = Writer(stream, unit)
            for batch in chunks(batches, "text_"):
                ids, starts = with_end(*ids_of.encode(batch["text_"].to_pylist()), end_id)
                entry = np.empty(len(batch), _DOC)
                entry["doc_id"] = batch["id_"].fill_null(0)
                entry["known"] = batch["id_"].is_valid().to_numpy(zero_copy_only=False)
                entry["n"] = np.diff(starts)
                writer.add(ids, entry)
            n, total = writer.close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([file], pa.int32()), pa.array([f"{folder}/{name}"]), pa.array([n]), pa.array([total])],
            ["file", "path", "docs", "tokens"])

    return materialise(ranged.mapInArrow(run, "file int, path string, docs bigint, tokens bigint"), "ids-files")


def read_ids(files: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Documents in ``files`` (of ``write_ids``): ``id_col``, start (ids of all before it), n_tokens, ids.

    ``ids`` is binary, unsigned 32-bit little-endian.
    """
    before = F.sum("tokens").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))
    placed = files.select("file", "path", F.coalesce(before, F.lit(0)).alias("before"))  # one narrow row per file
    n = max(1, files.count())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, at in zip(batch["path"].to_pylist(), batch["before"].to_pylist()):
                system, inner = open_path(path)
                with system.open_input_file(inner) as file:
                    for docs, ids in read_file(file):
                        n = docs["n"].astype(np.int64)
                        ends = at + np.cumsum(n)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(docs["doc_id"].astype(np.int64), mask=docs["known"] == 0), pa.array(ends - n),
                             pa.array(n), pa.array([x.tobytes() for x in ids], pa.binary())],
                            [id_col, "start", "n_tokens", "ids"])
                        at = int(ends[-1])

    return placed.repartitionById(n, "file").mapInArrow(
        run, f"{id_col} bigint, start bigint, n_tokens bigint, ids binary")


def total_tokens(spark: SparkSession, files: DataFrame) -> int:
    return files.agg(F.sum("tokens")).first()[0] or 0
