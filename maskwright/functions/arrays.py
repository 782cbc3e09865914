"""Tensor expressions. A tensor is one row: a flat row-major array plus a shape array.

Element-wise maps stay in the JVM (``transform``); measured on 49 million values they cost the
same as an Arrow function. Work over windows of an array (argmax, resize, moments) is 10-20
times faster as an Arrow function on numpy than as nested ``slice`` calls, so it lives here.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T


# --- element-wise, JVM side; every step is rounded to float32 as the tensors are float32 ---

def map_float(values: Column, step: Callable[[Column], Column]) -> Column:
    return F.transform(values, lambda x: step(x).cast("float"))


def normalise(values: Column) -> Column:
    """0..255 to -1..1: ``x / 127.5 - 1``. The fixed scaling of training and serving."""
    return F.transform(values, lambda x: (x / F.lit(127.5)).cast("float") - F.lit(1.0).cast("float"))


def scale01(values: Column) -> Column:
    return map_float(values, lambda x: x / F.lit(255.0))


def shift_label(values: Column) -> Column:
    return F.transform(values, lambda x: x.cast("float") - F.lit(1.0).cast("float"))


def clip(values: Column, low: float, high: float) -> Column:
    return map_float(values, lambda x: F.greatest(F.least(x, F.lit(high).cast("float")), F.lit(low).cast("float")))


def to_uint8(values: Column) -> Column:
    """Truncate towards zero and wrap to 0..255, which is what a cast of the clipped value gives."""
    return F.transform(values, lambda x: F.pmod(x.cast("int"), F.lit(256)))


def relu(values: Column) -> Column:
    return map_float(values, lambda x: F.greatest(x, F.lit(0.0).cast("float")))


# --- shapes ---

def shape_of(*dims: Column | int) -> Column:
    return F.array(*[(d if isinstance(d, Column) else F.lit(d)).cast("bigint") for d in dims])


def n_elements(shape: Column) -> Column:
    return F.aggregate(shape, F.lit(1).cast("bigint"), lambda acc, d: acc * d)


def fits_shape(values: Column, shape: Column) -> Column:
    return F.size(values).cast("bigint") == n_elements(shape)


def expand_dims(shape: Column, axis: int) -> Column:
    """Insert a 1 at ``axis``; -1 appends. Only the shape column changes."""
    if axis == -1:
        return F.concat(shape, shape_of(1))
    return F.concat(F.slice(shape, 1, axis), shape_of(1), F.slice(shape, F.lit(axis + 1), F.size(shape)))


def squeeze(shape: Column) -> Column:
    return F.filter(shape, lambda d: d != 1)


def cell_index(position: Column, *dims: int) -> list[Column]:
    """Row-major coordinates of a flat position, outermost first."""
    coordinates, stride = [], int(np.prod(dims))
    rest = position
    for size in dims:
        stride //= size
        coordinates.append(F.floor(rest / F.lit(stride)).cast("int"))
        rest = rest % F.lit(stride)
    return coordinates


def unroll(df: DataFrame, values: Column | str, position: str, value: str, *keep: Column | str) -> DataFrame:
    """One row per element of a list, with its position and the columns to keep; null and empty lists vanish.

    The outer form with its null rows filtered away again: for the inner form Spark adds a size
    check on ``values`` below, which would run the Arrow functions behind it twice.
    """
    return df.select(*keep, F.posexplode_outer(values).alias(position, value)).filter(F.col(position).isNotNull())


# --- Arrow functions ---

CHUNK_BYTES = 1 << 20
_ELEMENTS = {"float": (np.float32, pa.float32()), "int": (np.int32, pa.int32()), "double": (np.float64, pa.float64())}


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values of a list array and the offsets into them; a null row has length 0."""
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    values = column.flatten()
    if values.null_count:
        raise ValueError("a tensor holds null elements")
    return values.to_numpy(zero_copy_only=False), offsets


def _lists(values: np.ndarray, lengths: np.ndarray, valid: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    mask = None if valid.all() else pa.array(~valid)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind), mask=mask)


def _shapes(column: pa.Array) -> list[tuple[int, ...] | None]:
    return [None if s is None else tuple(s) for s in column.to_pylist()]


def _stacks(values: pa.Array, shapes: pa.Array):
    """Rows of one batch, stacked by equal shape so numpy works on many images at once."""
    flat, offsets = _flat(values)
    present = values.is_valid().to_numpy(zero_copy_only=False)
    groups: dict[tuple[int, ...], list[int]] = {}
    for row, shape in enumerate(_shapes(shapes)):
        if present[row] and shape is not None:
            groups.setdefault(shape, []).append(row)
    for shape, rows in groups.items():
        size = int(np.prod(shape))
        lengths = offsets[np.array(rows) + 1] - offsets[rows]
        if (lengths != size).any():
            raise ValueError(f"tensor of {lengths[lengths != size][0]} values does not fit shape {shape}")
        if len(rows) == len(values):
            stack = flat.reshape(len(rows), *shape)
        else:
            stack = np.stack([flat[offsets[r]:offsets[r + 1]] for r in rows]).reshape(len(rows), *shape)
        yield rows, shape, stack


def tensor_function(step: Callable[[np.ndarray], np.ndarray], element: str = "float"):
    """An Arrow function ``(values, shape) -> values`` from a numpy step over a stack of tensors."""
    dtype, kind = _ELEMENTS[element]

    @F.arrow_udf(f"array<{element}>")
    def apply(values: pa.Array, shapes: pa.Array) -> pa.Array:
        out: list[np.ndarray | None] = [None] * len(values)
        for rows, _, stack in _stacks(values, shapes):
            some = max(1, CHUNK_BYTES // max(1, stack[0].nbytes))  # a chunk stays in the processor cache
            for start in range(0, len(rows), some):
                part = rows[start:start + some]
                result = np.ascontiguousarray(step(stack[start:start + some]), dtype=dtype).reshape(len(part), -1)
                for row, line in zip(part, result):
                    out[row] = line
        valid = np.array([line is not None for line in out], dtype=bool)
        lines = [line for line in out if line is not None]
        flat = np.concatenate(lines) if lines else np.empty(0, dtype)
        lengths = np.array([0 if line is None else len(line) for line in out])
        return _lists(flat, lengths, valid, kind)

    return apply


def flat_function(step: Callable[[np.ndarray], np.ndarray], element: str = "float"):
    """An Arrow function from a numpy step that maps the joined values of many rows one by one.

    The step must keep the number of values; rows must hold whole pixels if it looks at channels.
    """
    dtype, kind = _ELEMENTS[element]

    @F.arrow_udf(f"array<{element}>")
    def apply(values: pa.Array) -> pa.Array:
        flat, offsets = _flat(values)
        present = values.is_valid().to_numpy(zero_copy_only=False)
        return _lists(step(flat).astype(dtype, copy=False).ravel(), np.diff(offsets), present, kind)

    return apply


def _axis_weights(size: int, target: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Half-pixel centres: the two source lines of every target line and the blend between them."""
    scale = np.float32(size) / np.float32(target)
    at = (np.arange(target, dtype=np.float32) + np.float32(0.5)) * scale - np.float32(0.5)
    low = np.floor(at)
    return (np.maximum(low, 0).astype(int), np.minimum(np.ceil(at), size - 1).astype(int),
            (at - low).astype(np.float32))


def resize_stack(stack: np.ndarray, height: int, width: int, method: str = "bilinear") -> np.ndarray:
    """Resize a stack of H x W (x C) tensors; no antialiasing, edges clamp, float32 throughout."""
    images = stack if stack.ndim == 4 else stack[..., None]
    images = images.astype(np.float32, copy=False)
    if method == "nearest":
        rows = np.minimum(((np.arange(height) + 0.5) * images.shape[1] / height).astype(int), images.shape[1] - 1)
        cols = np.minimum(((np.arange(width) + 0.5) * images.shape[2] / width).astype(int), images.shape[2] - 1)
        return images[:, rows][:, :, cols]
    if method != "bilinear":
        raise ValueError(f"unknown resize method: {method}")
    top, bottom, down = _axis_weights(images.shape[1], height)
    left, right, across = _axis_weights(images.shape[2], width)
    across, down = across[None, None, :, None], down[None, :, None, None]

    def blend_columns(lines: np.ndarray) -> np.ndarray:
        return lines[:, :, left] + (lines[:, :, right] - lines[:, :, left]) * across

    upper, lower = blend_columns(images[:, top]), blend_columns(images[:, bottom])
    return upper + (lower - upper) * down


def resize(values: Column, shape: Column, height: int, width: int, method: str = "bilinear") -> Column:
    return tensor_function(lambda s: resize_stack(s, height, width, method))(values, shape)


def transpose(values: Column, shape: Column, order: tuple[int, ...]) -> Column:
    if list(order) == list(range(len(order))):
        return values
    return tensor_function(lambda s: s.transpose(0, *[axis + 1 for axis in order]))(values, shape)


def transposed_shape(shape: Column, order: tuple[int, ...]) -> Column:
    return F.array(*[F.element_at(shape, axis + 1) for axis in order])


def argmax(logits: Column, shape: Column) -> Column:
    """Class of every pixel: the last axis is the class axis, the first maximum wins."""
    return tensor_function(lambda s: s.argmax(axis=-1), "int")(logits, shape)


def standardise_channels(values: Column, shape: Column, epsilon: float,
                         scale: tuple[float, ...] | None = None,
                         offset: tuple[float, ...] | None = None) -> Column:
    """Per image and channel: subtract the mean, divide by the population deviation."""
    def step(stack: np.ndarray) -> np.ndarray:
        wide = stack.astype(np.float64)
        mean = wide.mean(axis=(1, 2), keepdims=True)
        spread = wide.var(axis=(1, 2), keepdims=True)
        out = (wide - mean) / np.sqrt(spread + epsilon)
        if scale is not None:
            out = out * np.array(scale)
        return out if offset is None else out + np.array(offset)

    return tensor_function(step, "double")(values, shape)


def concat_channels(left: Column, left_shape: Column, right: Column, right_shape: Column) -> Column:
    """Join two tensors of equal height and width along their last axis."""
    @F.arrow_udf("array<float>")
    def join(a: pa.Array, a_shape: pa.Array, b: pa.Array, b_shape: pa.Array) -> pa.Array:
        out: list[np.ndarray | None] = [None] * len(a)
        other = {}
        for rows, shape, stack in _stacks(b, b_shape):
            other.update((row, tensor) for row, tensor in zip(rows, stack))
        for rows, shape, stack in _stacks(a, a_shape):
            for row, tensor in zip(rows, stack):
                if row in other:
                    out[row] = np.concatenate([tensor, other[row]], axis=-1).astype(np.float32).ravel()
        valid = np.array([line is not None for line in out], dtype=bool)
        lines = [line for line in out if line is not None]
        flat = np.concatenate(lines) if lines else np.empty(0, np.float32)
        return _lists(flat, np.array([0 if line is None else len(line) for line in out]), valid, pa.float32())

    return join(left, left_shape, right, right_shape)


# --- payload bytes ---

@F.arrow_udf(T.BinaryType())
def pack_uint8(values: pa.Array) -> pa.Array:
    """An int array as raw bytes, one byte per value (0..255)."""
    flat, offsets = _flat(values)
    raw = flat.astype(np.uint8).tobytes()
    present = values.is_valid().to_pylist()
    return pa.array([raw[a:b] if ok else None for a, b, ok in zip(offsets, offsets[1:], present)], pa.binary())


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def unpack_uint8(payload: pa.Array) -> pa.Array:
    """Raw bytes as an int array."""
    chunks = payload.to_pylist()
    valid = np.array([c is not None for c in chunks], dtype=bool)
    lengths = np.array([0 if c is None else len(c) for c in chunks])
    flat = np.frombuffer(b"".join(c for c in chunks if c is not None), np.uint8)
    return _lists(flat.astype(np.int32), lengths, valid, pa.int32())


@F.arrow_udf(T.StructType().add("matches", T.LongType()).add("pixels", T.LongType()))
def count_matches(truth: pa.Array, predicted: pa.Array) -> pa.Array:
    """Pixels whose label equals the prediction exactly; a fractional label never does."""
    a, a_at = _flat(truth)
    b, b_at = _flat(predicted)
    present = np.logical_and(truth.is_valid().to_numpy(zero_copy_only=False),
                             predicted.is_valid().to_numpy(zero_copy_only=False))
    if (np.diff(a_at)[present] != np.diff(b_at)[present]).any():
        raise ValueError("label and prediction differ in size")
    matches, pixels = np.zeros(len(present), np.int64), np.zeros(len(present), np.int64)
    for row in np.flatnonzero(present):
        x, y = a[a_at[row]:a_at[row + 1]], b[b_at[row]:b_at[row + 1]]
        matches[row], pixels[row] = (x == y).sum(), len(x)
    mask = pa.array(~present)
    return pa.StructArray.from_arrays([pa.array(matches), pa.array(pixels)], ["matches", "pixels"], mask=mask)


def pixel_losses(classes: int):
    """``(logits, truth) -> (loss sum, pixels)``: cross-entropy from logits, shifted by the maximum.

    Labels are truncated to integers. A label outside 0..classes-1 has no loss and raises.
    """
    @F.arrow_udf("struct<loss:double,pixels:bigint>")
    def apply(logits: pa.Array, truth: pa.Array) -> pa.Array:
        a, a_at = _flat(logits)
        b, b_at = _flat(truth)
        present = np.logical_and(logits.is_valid().to_numpy(zero_copy_only=False),
                                 truth.is_valid().to_numpy(zero_copy_only=False))
        loss, pixels = np.zeros(len(present)), np.zeros(len(present), np.int64)
        for row in np.flatnonzero(present):
            scores = a[a_at[row]:a_at[row + 1]].astype(np.float64).reshape(-1, classes)
            label = b[b_at[row]:b_at[row + 1]].astype(np.int64)
            if len(label) != len(scores) or ((label < 0) | (label >= classes)).any():
                raise ValueError("labels do not fit the logits")
            peak = scores.max(axis=1)
            total = np.log(np.exp(scores - peak[:, None]).sum(axis=1)) + peak
            loss[row] = (total - scores[np.arange(len(label)), label]).sum()
            pixels[row] = len(label)
        mask = pa.array(~present)
        return pa.StructArray.from_arrays([pa.array(loss), pa.array(pixels)], ["loss", "pixels"], mask=mask)

    return apply
