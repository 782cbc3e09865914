"""The model slot: fit a classifier on feature vectors or pixels, score tables, score requests.

A fitted model is a small table of class centres (classes x dimensions). Its size is checked
before it leaves the cluster, like the coefficients of any Spark ML model.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from maskwright.functions import arrays, base64url
from maskwright.functions.arrays import _flat, _lists, _stacks
from maskwright.operators.overlay import overlay
from maskwright.operators.tensors import transformed_name

MAX_MODEL_CELLS = 4_000_000  # classes x dimensions of a model; more are refused when it is fitted
CHUNK = 1 << 13


def _logits(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Minus the squared distance to every centre; the largest wins."""
    out = np.empty((len(vectors), len(centres)))
    for i, centre in enumerate(centres):
        gap = vectors - centre
        out[:, i] = np.einsum("nd,nd->n", gap, gap)
    return -out


@dataclass(frozen=True)
class CentroidModel:
    """Class ids and their centres, one row per class."""

    classes: tuple[int, ...]
    centres: tuple[tuple[float, ...], ...]

    def predict(self, values: Column) -> Column:
        """The class of one feature vector per row."""
        classes, centres, width = np.array(self.classes, np.int32), np.array(self.centres), len(self.centres[0])

        @F.arrow_udf("int")
        def score(vectors: pa.Array) -> pa.Array:
            flat, at = _flat(vectors)
            present = vectors.is_valid().to_numpy(zero_copy_only=False)
            if (np.diff(at)[present] != width).any():
                raise ValueError(f"the model takes {width} values per row")
            best = _logits(flat.astype(np.float64).reshape(-1, width), centres).argmax(axis=1)
            out = np.zeros(len(present), np.int32)
            out[present] = classes[best]
            return pa.array(out, mask=~present)

        return score(values)

    def pixel_logits(self, values: Column) -> Column:
        """Flat H x W x classes logits from a flat H x W x C tensor."""
        centres, width = np.array(self.centres), len(self.centres[0])

        @F.arrow_udf("array<double>")
        def score(images: pa.Array) -> pa.Array:
            flat, at = _flat(images)
            present = images.is_valid().to_numpy(zero_copy_only=False)
            if (np.diff(at) % width).any():
                raise ValueError(f"the model takes {width} channels per pixel")
            logits = _logits(flat.astype(np.float64).reshape(-1, width), centres).ravel()
            return _lists(logits, np.diff(at) // width * len(centres), present, pa.float64())

        return score(values)

    def segment(self, values: Column) -> Column:
        """Class of every pixel, without keeping the logits of a batch."""
        classes, centres, width = np.array(self.classes, np.int32), np.array(self.centres), len(self.centres[0])

        @F.arrow_udf("array<int>")
        def score(images: pa.Array) -> pa.Array:
            flat, at = _flat(images)
            present = images.is_valid().to_numpy(zero_copy_only=False)
            if (np.diff(at) % width).any():
                raise ValueError(f"the model takes {width} channels per pixel")
            vectors = flat.reshape(-1, width)
            best = np.empty(len(vectors), np.int32)
            for start in range(0, len(vectors), CHUNK):
                part = vectors[start:start + CHUNK].astype(np.float64)
                best[start:start + CHUNK] = classes[_logits(part, centres).argmax(axis=1)]
            return _lists(best, np.diff(at) // width, present, pa.int32())

        return score(values)


def _centres(long: DataFrame) -> CentroidModel:
    """From (class, i, v) rows: one mean per cell. The table of means is the model; its size is checked."""
    cells = long.filter(F.col("class").isNotNull()).groupBy("class", "i").agg(
        F.avg(F.col("v").cast("double")).alias("m"))
    table = cells.orderBy("class", "i").limit(MAX_MODEL_CELLS + 1).toArrow()
    if table.num_rows > MAX_MODEL_CELLS:
        raise ValueError("the model has too many classes or dimensions")
    if not table.num_rows:
        raise ValueError("nothing to fit: no labelled rows")
    classes, first, sizes = np.unique(table["class"].to_numpy(), return_index=True, return_counts=True)
    if len(set(sizes)) != 1:
        raise ValueError("feature vectors differ in length")
    centres = table["m"].to_numpy().reshape(len(classes), -1)
    return CentroidModel(tuple(int(c) for c in classes), tuple(map(tuple, centres.tolist())))


def fit_centroids(df: DataFrame, values: str, label: str) -> CentroidModel:
    """Nearest-centroid classifier of whole feature vectors. Means are summed before the shuffle."""
    long = arrays.unroll(df, values, "i", "v", F.col(label).alias("class"))
    return _centres(long)


def fit_pixel_centroids(df: DataFrame, values: str, mask: str, channels: int) -> CentroidModel:
    """Nearest-centroid classifier of pixels: ``values`` is flat H x W x C, ``mask`` flat H x W.

    Fractional labels are truncated to their class.
    """
    long = arrays.unroll(df, values, "_at", "v", mask).select(
        F.element_at(mask, F.floor(F.col("_at") / F.lit(channels)).cast("int") + 1).cast("int").alias("class"),
        (F.col("_at") % F.lit(channels)).alias("i"), "v")
    return _centres(long)


def _windows(images: np.ndarray, window: int) -> np.ndarray:
    """A row per pixel: the channels of the window around it, edges repeated, and 1."""
    n, height, width, channels = images.shape
    reach = window // 2
    padded = np.pad(images, ((0, 0), (reach, reach), (reach, reach), (0, 0)), mode="edge")
    parts = [padded[:, y:y + height, x:x + width].reshape(-1, channels) for y in range(window) for x in range(window)]
    return np.concatenate([*parts, np.ones((n * height * width, 1))], axis=1)


@dataclass(frozen=True)
class SoftmaxModel:
    """Per class the weights of a pixel's window of channels and of a constant; ``losses`` of the fit, first to last."""

    classes: tuple[int, ...]
    weights: tuple[tuple[float, ...], ...]
    window: int
    losses: tuple[float, ...] = ()

    def segment(self, values: Column, shape: Column) -> Column:
        """Class of every pixel of flat H x W x C tensors with their shapes."""
        classes, weights, window = np.array(self.classes, np.int32), np.array(self.weights).T, self.window

        @F.arrow_udf("array<int>")
        def score(images: pa.Array, shapes: pa.Array) -> pa.Array:
            found: list[np.ndarray] = [np.empty(0, np.int32)] * len(images)
            for rows, _, stack in _stacks(images, shapes):
                for row, image in zip(rows, stack):
                    found[row] = classes[(_windows(image[None].astype(np.float64), window) @ weights).argmax(axis=1)]
            present = images.is_valid().to_numpy(zero_copy_only=False) & shapes.is_valid().to_numpy(zero_copy_only=False)
            return _lists(np.concatenate([np.empty(0, np.int32), *found]), np.array([len(x) for x in found], np.int64),
                          present, pa.int32())

        return score(values, shape)


def _gradient(df: DataFrame, classes: Sequence[int], window: int, weights: np.ndarray | None) -> np.ndarray:
    """Loss, pixels and gradient (classes x features) over all rows (image, shape, mask); without weights, as if all were 0.

    Each task adds up its rows in one array of the model's size; Spark sums these by cell.
    """
    known = np.array(classes)

    def run(batches):
        total = None
        for batch in batches:
            masks = batch.column(2)
            labels, at = _flat(masks)
            for rows, _, stack in _stacks(batch.column(0), batch.column(1)):
                for row, image in zip(rows, stack):
                    if not masks[row].is_valid:
                        continue
                    x = _windows(image[None].astype(np.float64), window)
                    label = labels[at[row]:at[row + 1]].astype(np.int64)
                    if len(label) != len(x):
                        raise ValueError(f"a mask of {len(label)} cells does not fit {len(x)} pixels")
                    hit = label[:, None] == known
                    some = hit.any(axis=1)  # pixels of other classes are not learned from
                    x, hit = x[some], hit[some]
                    logit = x @ (np.zeros((len(known), x.shape[1])) if weights is None else weights).T
                    logit -= logit.max(axis=1, keepdims=True)
                    share = np.exp(logit)
                    share /= share.sum(axis=1, keepdims=True)
                    loss = -np.log(np.maximum((share * hit).sum(axis=1), 1e-300)).sum()
                    mine = np.concatenate([[loss, len(x)], ((share - hit).T @ x).ravel()])
                    if total is None:
                        total = np.zeros(len(mine))
                    if len(mine) != len(total):
                        raise ValueError("images differ in channels")
                    total += mine
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["cells"])

    parts = df.mapInArrow(run, "cells array<double>").select(F.posexplode("cells").alias("at", "v"))
    sums = parts.groupBy("at").agg(F.sum("v").alias("v")).orderBy("at").limit(MAX_MODEL_CELLS + 3).toArrow()
    if sums.num_rows > MAX_MODEL_CELLS + 2:
        raise ValueError("the model has too many classes or dimensions")
    return sums["v"].to_numpy()


def fit_pixel_softmax(df: DataFrame, values: str, shape: str, mask: str, classes: Sequence[int], window: int = 3,
                      iterations: int = 20, ridge: float = 1e-4) -> SoftmaxModel:
    """Softmax regression of a pixel's class on the channels of the ``window`` x ``window`` pixels around it.

    ``values`` is flat H x W x C with its ``shape``, ``mask`` flat H x W; fractional labels are truncated, and pixels
    whose class is not in ``classes`` are not learned from. Every iteration is one pass over all rows, of which only
    sums of the model's size leave a task; steps are those of L-BFGS, and a step that raises the loss is halved. Rows with a
    null are left out. Nothing to learn from is an error.
    """
    if window < 1 or window % 2 == 0:
        raise ValueError("a window has an odd number of pixels")
    rows = df.select(values, shape, mask)

    def at(weights: np.ndarray | None) -> tuple[float, np.ndarray]:
        cells = _gradient(rows, classes, window, weights)
        if not len(cells) or not cells[1]:
            raise ValueError("nothing to fit: no labelled pixels")
        gradient = cells[2:].reshape(len(classes), -1) / cells[1]
        held = np.zeros_like(gradient) if weights is None else weights
        return cells[0] / cells[1] + ridge / 2 * (held ** 2).sum(), gradient + ridge * held

    loss, gradient = at(None)
    weights, losses, past = np.zeros_like(gradient), [loss], []
    step = 1.0
    for _ in range(iterations):
        direction = -_preconditioned(gradient, past)
        tried = weights + step * direction
        tried_loss, tried_gradient = at(tried)
        if tried_loss > loss:
            step /= 2
            if step < 1e-3:
                break
            past = past[-1:]
            continue
        if ((tried - weights) * (tried_gradient - gradient)).sum() > 1e-12:
            past = [*past, (tried - weights, tried_gradient - gradient)][-6:]
        weights, loss, gradient, step = tried, tried_loss, tried_gradient, min(1.0, 2 * step)
        losses.append(loss)
        if np.abs(gradient).max() < 1e-5:
            break
    return SoftmaxModel(tuple(int(c) for c in classes), tuple(map(tuple, weights.tolist())), window, tuple(losses))


def _preconditioned(gradient: np.ndarray, past: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The gradient times the inverse curvature that the last steps and their changes of gradient show."""
    out, shares = gradient.copy(), []
    for moved, changed in reversed(past):
        share = (moved * out).sum() / (moved * changed).sum()
        shares.append(share)
        out -= share * changed
    if past:
        moved, changed = past[-1]
        out *= (moved * changed).sum() / (changed * changed).sum()
    for (moved, changed), share in zip(past, reversed(shares)):
        out += moved * (share - (changed * out).sum() / (moved * changed).sum())
    return out


def fit_logistic(df: DataFrame, values: str, label: str, max_iter: int = 20):
    """Multinomial logistic regression from Spark ML on the same columns."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    rows = df.select(array_to_vector(F.col(values).cast("array<double>")).alias("features"),
                     F.col(label).cast("double").alias("label"))
    return LogisticRegression(family="multinomial", maxIter=max_iter).fit(rows)


def score_logistic(model, df: DataFrame, values: str, out: str = "pred") -> DataFrame:
    from pyspark.ml.functions import array_to_vector

    scored = model.transform(df.withColumn("features", array_to_vector(F.col(values).cast("array<double>"))))
    return scored.withColumn(out, F.col("prediction").cast("int")).select(*df.columns, out)


def score_examples(df: DataFrame, preprocess: Callable[[DataFrame], DataFrame], model: CentroidModel,
                   image: str = "image", out: str = "pred") -> DataFrame:
    """Transform, then score, with the same ``preprocess`` as in training."""
    return preprocess(df).withColumn(out, model.predict(F.col(transformed_name(image))))


def decode_payload(payload: Column) -> Column:
    """Raw 8-bit pixels as floats, from URL-safe base64 text."""
    return arrays.unpack_uint8(base64url.decode(payload)).cast("array<float>")


def score_requests(df: DataFrame, payload: str, shape: Sequence[int] | str, size: int, model: CentroidModel,
                   out: str = "seg_mask") -> DataFrame:
    """Decode, resize, normalise, score, argmax: one mask of ``size`` x ``size`` per payload row.

    The order is fixed: resize first, then normalise. ``shape`` is that of all payloads, or the name of a column that
    holds each payload's height, width and channels.
    """
    shapes = F.col(shape).cast("array<bigint>") if isinstance(shape, str) else arrays.shape_of(*shape)
    image = arrays.resize(decode_payload(F.col(payload)), shapes, size, size)
    return df.withColumn(out, model.segment(arrays.normalise(image)))


def score_overlay(df: DataFrame, image: str, shape: str, size: int, model: CentroidModel,
                  colours: list[tuple[int, int, int]], out: str = "overlay") -> DataFrame:
    """Mask and its overlay for display. This view scales to 0..1, not to -1..1 as training does."""
    view = arrays.scale01(arrays.resize(F.col(image), F.col(shape), size, size))
    return (df.withColumn("_view", view)
            .withColumn("seg_mask", model.segment(F.col("_view")))
            .withColumn(out, overlay(F.col("_view"), F.col("seg_mask"), colours)).drop("_view"))
