"""Bounded-space online packing of documents into sequences.

Each partition keeps a fixed number of open windows. A document is cut into full windows and a rest; the rest goes
into the open window that it fills best. When it fits none, its beginning fills up the fullest window, which is emitted,
and what remains is placed in the same way; a new window is opened while there are fewer than the fixed number. What is
still open at a partition's end is merged with other partitions' leftovers: pieces of the emptiest windows fill up the
fullest ones, so that at most one window of a merged group needs padding.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from maskwright.llm.tokens import encoder, with_end
from maskwright.llm.words import chunks
from maskwright.llm.worker import give_back
from maskwright.session import scratch_path, small_batches

LENGTH = 1024
WINDOWS = 64
CHUNK = 1 << 20  # bytes of text that are encoded at a time
MERGED_TOGETHER = 64  # partitions whose leftovers meet in one task: at most 64 x 64 windows

_PIECES = ("doc_id bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, "
           "ids binary, open boolean")


class Packer:
    """The open windows of one partition, and the pieces in them."""

    def __init__(self, partition: int, length: int, windows: int):
        self.next, self.length, self.windows = partition << 32, length, windows
        self.free: list[tuple[int, int]] = []  # (free ids, window), ascending
        self.held: dict[int, list[tuple]] = {}
        self.out: list[tuple] = []

    def add(self, doc, ids: np.ndarray) -> None:
        total = len(ids)
        full = total - total % self.length
        for start in range(0, full, self.length):
            self._put(self._open(), 0, (doc, start, total), ids[start:start + self.length])
        start = full
        while start < total:
            at = bisect_left(self.free, (total - start, -1))
            if at < len(self.free):  # best fit
                free, window = self.free.pop(at)
            elif len(self.free) < self.windows:
                free, window = self.length, self._open()
            else:  # the fullest takes what it has room for
                free, window = self.free.pop(0)
            piece = ids[start:start + free]
            self._put(window, self.length - free, (doc, start, total), piece)
            if free > len(piece):
                insort(self.free, (free - len(piece), window))
            start += len(piece)

    def _open(self) -> int:
        self.next += 1
        return self.next - 1

    def _put(self, window: int, offset: int, place: tuple, piece: np.ndarray) -> None:
        doc, start, total = place
        self.held.setdefault(window, []).append((doc, start, len(piece), total, window, offset, piece.tobytes()))
        if offset + len(piece) == self.length:
            self.out += [(*row, False) for row in self.held.pop(window)]

    def finish(self) -> None:
        for window in list(self.held):
            self.out += [(*row, True) for row in self.held.pop(window)]

    def take(self) -> pa.RecordBatch:
        kinds = [pa.int64()] * 6 + [pa.binary(), pa.bool_()]
        names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids", "open"]
        columns = list(zip(*self.out)) or [()] * len(names)
        self.out = []
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def merge(pieces: pd.DataFrame, length: int) -> pd.DataFrame:
    """The pieces of open windows, moved from the emptiest windows into the fullest and cut where one is full."""
    rows: dict[int, list] = {}
    for row in pieces.sort_values(["sequence_id", "offset"]).itertuples(index=False):
        rows.setdefault(row.sequence_id, []).append(row)
    fill = {w: sum(r.length for r in held) for w, held in rows.items()}
    order = sorted(rows, key=lambda w: (-fill[w], w))
    first, last = 0, len(order) - 1
    while first < last:
        target, source = order[first], order[last]
        if fill[target] == length:
            first += 1
        elif not rows[source]:
            last -= 1
        else:
            row = rows[source].pop()
            n = min(row.length, length - fill[target])
            # the end of the piece moves; what stays keeps its place in the emptier window
            ids = row.ids[4 * (row.length - n):]
            rows[target].append(row._replace(start=row.start + row.length - n, length=n, sequence_id=target,
                                             offset=fill[target], ids=ids))
            fill[target] += n
            fill[source] -= n
            if n < row.length:
                rows[source].append(row._replace(length=row.length - n, ids=row.ids[:4 * (row.length - n)]))
    found = [r for held in rows.values() for r in held]
    return pd.DataFrame(found, columns=pieces.columns)


def pack(docs: DataFrame, tokenizer: Callable[[], str], gaps: bool = True, end_id: int = 0, length: int = LENGTH,
         windows: int = WINDOWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: ``id_col``, start, length, doc_tokens, sequence_id, offset, ids (binary, uint32 little-endian).

    A document is its ids and ``end_id``; a null or empty text is only the end id. Every id is in one piece. A sequence
    is filled from offset 0 without gaps up to ``length`` at most, and is to be padded from there. Ids may repeat or be
    null; each row is packed on its own. An empty table gives no rows. Other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("id_"), F.col(text_col).cast("string").alias("text_"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back("encoder")
        packer = Packer(TaskContext.get().partitionId(), length, windows)
        ids_of = encoder(tokenizer(), gaps)
        for batch in chunks(batches, "text_", CHUNK):
            ids, starts = with_end(*ids_of.encode(batch["text_"].to_pylist()), end_id)
            starts = starts.tolist()
            for doc, a, b in zip(batch["id_"].to_pylist(), starts[:-1], starts[1:]):
                packer.add(doc, ids[a:b])
            yield packer.take()
        packer.finish()
        yield packer.take()

    # written once: a second run of the tokenizer for the leftovers would cost as much as the first
    path = scratch_path(docs.sparkSession, "packing")
    with small_batches(docs.sparkSession):
        rows.mapInArrow(run, _PIECES).write.partitionBy("open").option("compression", "zstd").parquet(path)
    pieces = docs.sparkSession.read.schema(_PIECES).parquet(path)

    columns = [c for c in pieces.columns if c != "open"]
    group = F.floor(F.shiftright("sequence_id", 32) / F.lit(MERGED_TOGETHER))
    # the id travels as text: a column with nulls would turn into floats
    left = pieces.where("open").select(*columns).withColumn("doc_id", F.col("doc_id").cast("string"))
    merged = left.groupBy(group).applyInPandas(lambda held: merge(held, length), left.schema).withColumn(
        "doc_id", F.col("doc_id").cast("bigint"))
    return pieces.where("not open").select(*columns).unionByName(merged).withColumnRenamed("doc_id", id_col)
