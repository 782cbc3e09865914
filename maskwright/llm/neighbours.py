"""Nearest neighbours by a block matrix join.

Vectors are scaled to length 1 and rounded to int8, in blocks with their rounding errors. Query blocks meet candidate
blocks; a tile of int8 products estimates all cosines of two blocks, and the rounding errors bound how far each
estimate can be off. Pairs that may still be among a query's nearest are computed again from the original vectors in
double precision and kept in a heap per query; the heaps of all tasks are merged.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from maskwright.session import materialise

BLOCK_BYTES = 1 << 20  # of a candidate block's vectors; blocks are rows of a DataFrame
QUERY_BYTES = 1 << 19
SPREAD = 16  # tasks that share a query block's tiles when both sides are shuffled
MOST_HEAPS = 50_000  # of a task at a time
_SLACK = 1e-5  # above the rounding of float32 products and bounds

_BLOCK = "dim int, ids binary, rows binary, ints binary, scale binary, error binary"


def _sum(rows: np.ndarray) -> np.ndarray:
    """Sums of rows from left to right, as SQL adds a list up."""
    return np.cumsum(rows, axis=1)[:, -1]


def exact_cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of rows with rows, in double precision; equal vectors give equal results wherever they stand.

    Rows are first scaled by powers of two, which changes no result but spares very large and small ones.
    """
    a, b = (np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, initial=0))[1][:, None]) for x in (a, b))
    return _sum(a * b) / (np.sqrt(_sum(a * a)) * np.sqrt(_sum(b * b)))


def _blocks(most_bytes: int):
    """Blocks of valid vectors of one dimension each."""
    def block(ids: np.ndarray, rows: np.ndarray) -> list[pa.Array]:
        unit = rows.astype(np.float64)
        unit /= np.abs(unit).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
        unit /= np.sqrt((unit * unit).sum(axis=1, keepdims=True))
        scale = np.abs(unit).max(axis=1) / 127
        ints = np.rint(unit / scale[:, None]).astype(np.int8)
        error = np.sqrt(((unit - ints * scale[:, None]) ** 2).sum(axis=1))
        return [rows.shape[1], *(x.tobytes() for x in (ids, rows.astype(np.float64), ints,
                                                        scale.astype(np.float32), error.astype(np.float32)))]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            held = batch.filter(pa.compute.and_(batch["id_"].is_valid(), batch["vector_"].is_valid()))
            n = pa.compute.list_value_length(held["vector_"]).to_numpy(zero_copy_only=False)
            for dim in np.unique(n[n > 0]).tolist():
                some = held.take(pa.array(np.flatnonzero(n == dim)))
                rows = some["vector_"].flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
                ids = some["id_"].to_numpy(zero_copy_only=False).astype(np.int64)
                good = np.isfinite(rows).all(axis=1) & (rows != 0).any(axis=1)  # a null component reads as NaN
                ids, rows = ids[good], rows[good]
                size = max(16, most_bytes // (9 * dim))
                out += [block(ids[a:a + size], rows[a:a + size]) for a in range(0, len(ids), size)]
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out), [pa.int32()] + [pa.binary()] * 5)],
                    ["dim", "ids", "rows", "ints", "scale", "error"])
    return run


class _Side:
    def __init__(self, row: dict, prefix: str):
        get = lambda name, kind: np.frombuffer(row[prefix + name], kind)
        self.ids = get("ids", np.int64)
        self.rows = get("rows", np.float64).reshape(len(self.ids), -1)
        self.ints = get("ints", np.int8).reshape(len(self.ids), -1).astype(np.float32)
        self.scale, self.error = get("scale", np.float32), get("error", np.float32)


def _tiles(k: int):
    def survivors(query: _Side, block: _Side, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        # int8 products in float32: sums of up to 1,000 of them are exact, and longer ones are within the slack
        near = (query.ints @ block.ints.T) * query.scale[:, None] * block.scale[None, :]
        # |x.y - x'.y'| <= |x - x'| |y| + |x'| |y - y'| for unit x, y and rounded x', y'
        off = query.error[:, None] + (1 + query.error[:, None]) * block.error[None, :] + np.float32(_SLACK)
        own = query.ids[:, None] == block.ids[None, :]
        near[own] = -4
        if near.shape[1] >= k:
            low = near - off
            least = np.maximum(least, np.partition(low, near.shape[1] - k, axis=1)[:, near.shape[1] - k])
        return np.nonzero((near + off >= least[:, None]) & ~own)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps: dict[tuple, list] = {}

        def flush() -> pa.RecordBatch:
            rows = [(*key, -i, s) for key, heap in heaps.items() for s, i in heap]
            heaps.clear()
            columns = list(zip(*rows)) or [()] * 5
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 4 + [pa.float64()])],
                ["query_block", "query_at", "query_id", "vec_id", "score"])

        for batch in batches:
            for i in range(len(batch)):
                row = {c: batch[c][i].as_buffer() if pa.types.is_binary(batch[c].type) else batch[c][i].as_py()
                       for c in batch.schema.names}
                query, block, number = _Side(row, "query_"), _Side(row, ""), row["query_block"]
                held = [heaps.setdefault((number, j, q), []) for j, q in enumerate(query.ids.tolist())]
                least = np.array([h[0][0] if len(h) == k else -2 for h in held])
                a, b = survivors(query, block, least)
                scores = exact_cosine(query.rows[a], block.rows[b])
                for j, score, vec in zip(a.tolist(), scores.tolist(), block.ids[b].tolist()):
                    if len(held[j]) < k:
                        heapq.heappush(held[j], (score, -vec))
                    else:
                        heapq.heappushpop(held[j], (score, -vec))
                if len(heaps) > MOST_HEAPS:
                    yield flush()
        yield flush()
    return run


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id",
            vector_col: str = "embedding") -> DataFrame:
    """The ``k`` nearest rows of ``vectors`` for every row of ``queries``: query_id, rank (from 1), vec_id, score.

    Nearness is the largest cosine, ties go to the smaller id. A row is no candidate for a query of its own id. Vectors
    that are null, empty, zero or hold a null or non-finite component, and rows without an id, take no part; vectors of
    different dimensions never meet. A query row that repeats gets its own ranks; a repeated candidate counts each
    time. Fewer candidates give fewer rows, an empty table none. Other columns are not read.
    """
    def narrow(df: DataFrame) -> DataFrame:
        return df.select(F.col(id_col).cast("bigint").alias("id_"), F.col(vector_col).alias("vector_"))

    asked = materialise(narrow(queries).mapInArrow(_blocks(QUERY_BYTES), _BLOCK).withColumn(
        "query_block", F.monotonically_increasing_id()), "neighbours-queries")
    asked = asked.select("dim", "query_block", *[F.col(c).alias(f"query_{c}") for c in (
        "ids", "rows", "ints", "scale", "error")], F.pmod(F.xxhash64("query_block"), F.lit(SPREAD)).alias("turn"))
    # each candidate block is sent to one of SPREAD copies of every query block: tiles spread over tasks, and Spark
    # broadcasts the query blocks instead where they are small
    blocks = narrow(vectors).mapInArrow(_blocks(BLOCK_BYTES), _BLOCK).withColumn(
        "spread", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(SPREAD)))
    turns = [r.turn for r in asked.select("turn").distinct().collect()]  # at most SPREAD numbers
    blocks = blocks.withColumn("turn", F.explode(F.array(*[F.lit(t) for t in turns]).cast("array<bigint>")))
    asked = asked.withColumn("spread", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1)).cast("array<bigint>")))
    tiles = blocks.join(asked, ["dim", "turn", "spread"]).drop("dim", "turn", "spread")
    found = tiles.mapInArrow(_tiles(k), "query_block bigint, query_at bigint, query_id bigint, vec_id bigint, score double")
    best = Window.partitionBy("query_block", "query_at", "query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
