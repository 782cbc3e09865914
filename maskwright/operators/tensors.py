"""DataFrame forms of the tensor expressions: resize, preprocess, standardise, unroll to pixels."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from importlib import import_module

import numpy as np
from pyspark.sql import DataFrame, functions as F

from maskwright.functions import arrays

IMAGE, IMAGE_SHAPE, LABEL, LABEL_SHAPE = "image", "image_shape", "label", "label_shape"


def transformed_name(name: str) -> str:
    return f"{name}_xf"


def load_callable(dotted: str) -> Callable:
    """A user callback given by its dotted name, e.g. ``my_project.features.preprocess``."""
    module, _, name = dotted.rpartition(".")
    if not module:
        raise ValueError(f"not a dotted name: {dotted}")
    return getattr(import_module(module), name)


def resize_pair(df: DataFrame, size: int | None, shift: bool = True, mask_method: str = "bilinear") -> DataFrame:
    """Resize images and masks to ``size`` x ``size``; without a size the rows are left as they are.

    Masks are resized like images by default, which gives fractional classes along edges. The
    label shift by -1 belongs to the resize: masks that keep their size keep their values too.
    """
    if not size:
        return df
    label = arrays.resize(F.col(LABEL), F.col(LABEL_SHAPE), size, size, mask_method)
    if shift:
        label = arrays.shift_label(label)
    return df.withColumns({
        IMAGE: arrays.resize(F.col(IMAGE), F.col(IMAGE_SHAPE), size, size),
        IMAGE_SHAPE: arrays.shape_of(size, size, F.element_at(IMAGE_SHAPE, 3)),
        LABEL: label,
        LABEL_SHAPE: arrays.shape_of(size, size),
    })


def preprocess(df: DataFrame) -> DataFrame:
    """The one preprocessing step shared by training and scoring: normalised image, label as is.

    Shape columns are dropped, other columns pass through.
    """
    rest = [c for c in df.columns if c not in (IMAGE, IMAGE_SHAPE, LABEL, LABEL_SHAPE)]
    labels = [F.col(LABEL).alias(transformed_name(LABEL))] if LABEL in df.columns else []
    return df.select(*rest, arrays.normalise(F.col(IMAGE)).alias(transformed_name(IMAGE)), *labels)


def rename_transformed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed({c: transformed_name(c) for c in columns})


def check_shapes(df: DataFrame, values: str, shape: str) -> DataFrame:
    """Fail the job on a tensor whose length is not the product of its shape."""
    message = F.concat(F.lit(f"{values} does not fit {shape}: "), F.size(values).cast("string"))
    fits = arrays.fits_shape(F.col(values), F.col(shape)) | F.col(values).isNull()
    return df.withColumn(values, F.when(fits, F.col(values)).otherwise(F.raise_error(message)))


def to_cells(df: DataFrame, values: str, dims: Sequence[int], names: Sequence[str], value: str = "v") -> DataFrame:
    """One row per element with its coordinates. Follow it with an aggregate: nothing is kept wide."""
    rest = [c for c in df.columns if c != values]
    long = arrays.unroll(df, values, "_at", value, *rest)
    coordinates = arrays.cell_index(F.col("_at"), *dims)
    return long.select(*rest, *[c.alias(n) for c, n in zip(coordinates, names)], value)


def channel_moments(df: DataFrame, values: str, channels: int, by: Sequence[str] = ()) -> DataFrame:
    """Mean and population variance per channel, over the dataset or per group of ``by``."""
    long = arrays.unroll(df, values, "_at", "_v", *by)
    channel = (F.col("_at") % F.lit(channels)).alias("c")
    x = F.col("_v").cast("double")
    return long.groupBy(*by, channel).agg(F.avg(x).alias("mean"), F.var_pop(x).alias("variance"))


def standardise_dataset(df: DataFrame, values: str, channels: int, epsilon: float = 1e-3) -> DataFrame:
    """Standardise each channel by its mean and variance over the whole dataset.

    The moments (one row per channel) are computed when called; applying them then touches each
    row alone, so the tensors are neither joined nor shuffled.
    """
    rows = channel_moments(df, values, channels).orderBy("c").collect()
    if not rows:
        return df.withColumn(values, F.col(values).cast("array<double>"))
    mean = np.array([r["mean"] for r in rows])
    deviation = np.sqrt(np.array([r["variance"] for r in rows]) + epsilon)
    apply = arrays.flat_function(lambda flat: (flat.reshape(-1, channels).astype(np.float64) - mean) / deviation,
                                 "double")
    return df.withColumn(values, apply(F.col(values)))


def concat_tensors(left: DataFrame, right: DataFrame, key: str, values: str, shape: str) -> DataFrame:
    """Join two tensor tables on ``key`` and append the channels of the right to those of the left."""
    a = left.select(key, F.col(values).alias("_a"), F.col(shape).alias("_as"))
    b = right.select(key, F.col(values).alias("_b"), F.col(shape).alias("_bs"))
    joined = a.join(b, key)
    channels = F.element_at("_as", -1) + F.element_at("_bs", -1)
    return joined.select(
        key,
        arrays.concat_channels(F.col("_a"), F.col("_as"), F.col("_b"), F.col("_bs")).alias(values),
        F.concat(F.slice("_as", F.lit(1), F.size("_as") - 1), F.array(channels)).alias(shape))


def argmax_mask(df: DataFrame, logits: str, shape: str, out: str = "mask") -> DataFrame:
    return df.withColumn(out, arrays.argmax(F.col(logits), F.col(shape)))


