"""Cross-entropy difference of two n-gram models (Moore and Lewis, "Intelligent Selection of Language Model Training Data").

Tokens are UTF-8 bytes, so both models share one closed vocabulary of 256 and no token is unknown. A token's context is
the ``order`` - 1 bytes before it, as they are: the models have a row for each n-gram of the corpus and grow with it.
Counts are taken over all texts of target and background; background counts are scaled to the target's total, so that
smoothing weighs the same in both. Probabilities are smoothed from the context to the one without its farthest byte to
no context. A document's score is the mean over its tokens of loss under the target model less loss under the background
model. The models stay tables: blocks of documents are joined to them by their distinct n-grams.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from maskwright.llm.words import buffers, chunks
from maskwright.session import materialise

ORDER = 4
LONGEST = 7  # order: an n-gram is one number of 64 bits
SMOOTH = 4.0  # weight of the shorter context, in tokens

_PIECE = 1 << 20  # bytes of text that arrays are made of at a time
_HELD = 1 << 20  # distinct n-grams that a task holds before it hands them on, about
_BLOCK = 8 << 20  # bytes of text whose n-grams are looked up together


def cells(data: np.ndarray, starts: np.ndarray, order: int) -> np.ndarray:
    """For each byte the n-gram that it ends, as one number: bytes before it, the nearest highest, then the byte itself.

    Bytes before the beginning of a text are 0.
    """
    if not 1 <= order <= LONGEST:
        raise ValueError(f"order must be 1 to {LONGEST}")
    place = np.arange(len(data), dtype=np.int64) - np.repeat(starts[:-1], np.diff(starts))
    out = data.astype(np.int64)
    for k in range(1, order):
        back = np.zeros(len(data), np.int64)
        back[k:] = data[:-k]
        back[place < k] = 0
        out |= back << 8 * (order - k)
    return out


def _distinct(found: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    held, n = np.unique(found.astype(np.uint32) if order <= 4 else found, return_counts=True)
    return held.astype(np.int64), n


def _merged(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """The n-grams of all parts, each once, and the sums of their counts."""
    found, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    sums = [np.bincount(at, np.concatenate(n), len(found)).astype(np.int64) for n in list(zip(*parts))[1:]]
    return found, *sums


def _count(order: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(parts: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x) for x in _merged(parts)], ["cell", "target", "background"])

        parts, size = [], 0
        for batch in chunks(batches, "text_", _PIECE):
            data, starts = buffers(batch["text_"])
            found = cells(data, starts, order)
            target = np.repeat(batch["target_"].to_numpy(zero_copy_only=False).astype(bool), np.diff(starts))
            (good, n), (other, m) = _distinct(found[target], order), _distinct(found[~target], order)
            parts += [(good, n, np.zeros_like(n)), (other, np.zeros_like(m), m)]
            size += len(good) + len(other)
            if size > 2 * _HELD:
                parts = [_merged(parts)]
                size = len(parts[0][0])
            if size > _HELD:
                yield flush(parts)
                parts, size = [], 0
        if parts:
            yield flush(parts)
    return run


@dataclass
class Model:
    """``counts`` has cell, target and background for each n-gram of the corpus; ``alone`` both chances of each byte."""
    counts: DataFrame
    alone: np.ndarray
    scale: float  # of background counts
    order: int
    smooth: float

    def losses(self, asked: DataFrame) -> DataFrame:
        """cell, loss (bits, target less background) of each n-gram of the column ``cell``, seen or not."""
        unseen = asked.select("cell", F.lit(0).cast("bigint").alias("target"), F.lit(0).cast("bigint").alias("background"))
        held = self.counts.unionByName(unseen.distinct()).groupBy("cell").agg(
            F.sum("target").cast("double").alias("n0"), (F.sum("background") * F.lit(self.scale)).alias("n1"))
        held = held.select("cell", "n0", "n1", F.shiftright("cell", 16).alias("before"),
                           F.shiftright("cell", 8).alias("context"), F.col("cell").bitwiseAND(255).cast("int").alias("byte"))

        def chance(k: int) -> Column:
            alone = F.get(F.array(*[F.lit(x) for x in self.alone[k].tolist()]), F.col("byte"))
            total, byte, own = (F.sum(f"n{k}").over(Window.partitionBy("before", *more)) for more in ((), ("byte",), ("context",)))
            short = (byte + self.smooth * alone) / (total + self.smooth)
            return (F.col(f"n{k}") + self.smooth * short) / (own + self.smooth)

        return held.select("cell", (F.log2(chance(1)) - F.log2(chance(0))).alias("loss"))


def fit(texts: DataFrame, text_col: str = "text", target_col: str = "target", order: int = ORDER,
        smooth: float = SMOOTH) -> Model | None:
    """Count both models over all rows; ``target_col`` says which are target, the others are background.

    None without any target or any background byte. Only the counts of the 256 bytes reach the driver.
    """
    rows = texts.select(F.col(text_col).cast("string").alias("text_"),
                        F.coalesce(F.col(target_col), F.lit(False)).alias("target_")).where("text_ is not null")
    counts = materialise(rows.mapInArrow(_count(order), "cell bigint, target bigint, background bigint").groupBy("cell").agg(
        F.sum("target").alias("target"), F.sum("background").alias("background")), "model-counts")
    byte = np.zeros((2, 256))
    for r in counts.groupBy(F.col("cell").bitwiseAND(255).alias("byte")).agg(
            F.sum("target").alias("t"), F.sum("background").alias("b")).collect():
        byte[:, r.byte] = r.t, r.b
    totals = byte.sum(axis=1)
    if not totals.all():
        return None
    scale = totals[0] / totals[1]
    alone = (byte * np.array([[1.0], [scale]]) + 1) / (totals[0] + 256)
    return Model(counts, alone, float(scale), order, smooth)


def _blocks(order: int):
    """Rows with the block that they are in, and after them a row with the block's distinct n-grams."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, size, parts = TaskContext.get().partitionId() << 32, 0, []
        names = ["block", "id_", "text_", "held"]

        def close() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([
                pa.array([block]), pa.nulls(1, pa.int64()), pa.nulls(1, pa.string()),
                pa.array([_merged(parts)[0]], pa.list_(pa.int64()))], names)

        for batch in chunks(batches, "text_", _PIECE):
            n = len(batch)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, block)), batch["id_"], batch["text_"].cast(pa.string()),
                                              pa.nulls(n, pa.list_(pa.int64()))], names)
            data, starts = buffers(batch["text_"])
            parts.append(_distinct(cells(data, starts, order), order))
            size += len(data)
            if size >= _BLOCK:
                yield close()
                block, size, parts = block + 1, 0, []
        if parts:
            yield close()
    return run


def _mean_losses(order: int, id_col: str):
    def run(docs: pa.Table, losses: pa.Table) -> pa.Table:
        cell, loss = (losses[c].to_numpy() for c in ("cell", "loss"))
        by = np.argsort(cell)
        cell, loss = cell[by], loss[by]
        ids, sizes, scores = [], [], []
        for batch in chunks(docs.to_batches(), "text_", _PIECE):
            data, starts = buffers(batch["text_"])
            found = loss[np.searchsorted(cell, cells(data, starts, order))] if len(data) else np.empty(0)
            n = np.diff(starts)
            sums = np.array([found[a:b].sum() for a, b in zip(starts[:-1].tolist(), starts[1:].tolist())])
            ids.append(batch["id_"])
            sizes.append(n)
            scores.append(np.where(n > 0, sums / np.maximum(n, 1), np.nan))
        return pa.table([pa.chunked_array(ids, pa.int64()), pa.array(np.concatenate([np.empty(0, np.int64), *sizes])),
                         pa.array(np.concatenate([np.empty(0), *scores]), from_pandas=True)], [id_col, "n_tokens", "score"])
    return run


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id_col``, n_tokens, score (bits per token; the lower, the more like the target).

    A null or empty text has no tokens and a null score; so have all texts without a model. Texts are read whole. Ids
    may be null or repeat. Other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("id_"), F.col(text_col).cast("string").alias("text_"))
    if model is None:
        return rows.select(F.col("id_").alias(id_col), F.coalesce(F.octet_length("text_"), F.lit(0)).cast("bigint").alias(
            "n_tokens"), F.lit(None).cast("double").alias("score"))
    placed = materialise(rows.mapInArrow(
        _blocks(model.order), "block bigint, id_ bigint, text_ string, held array<bigint>"), "model-blocks")
    asked = placed.where("held is not null").select("block", F.explode("held").alias("cell"))
    found = asked.join(model.losses(asked), "cell").select(F.col("block").alias("at"), "cell", "loss")
    texts = placed.where("held is null").select("block", "id_", "text_")
    return texts.groupBy("block").cogroup(found.groupBy("at")).applyInArrow(
        _mean_losses(model.order, id_col), f"{id_col} bigint, n_tokens bigint, score double")


def marked_by(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
              text_col: str = "text") -> DataFrame:
    """``text_col`` and target: whether any label of the document is 1. Documents without an id or a label are background.

    Labels grow with the documents, so both are shuffled at every size; Spark splits what a hot id gathers.
    """
    good = labels.where(F.col(label_col) == 1).select(F.col(id_col).alias("id_")).distinct().withColumn("target", F.lit(True))
    rows = docs.select(F.col(id_col).alias("id_"), text_col)
    return rows.join(good.hint("merge"), "id_", "left").select(text_col, F.coalesce("target", F.lit(False)).alias("target"))
