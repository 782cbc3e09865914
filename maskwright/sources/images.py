"""Images and masks: files decoded by Spark's image source, or payload columns in a parquet table."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from maskwright.functions.arrays import _lists, shape_of, unpack_uint8
from maskwright.functions.names import stem
from maskwright.operators.pairing import pair_by_key
from maskwright.operators.tensors import IMAGE, IMAGE_SHAPE, LABEL, LABEL_SHAPE
from maskwright.sources.files import in_few_tasks

# Integer luma weights (of 65,536) for red, green and blue.
LUMA = (19595, 38470, 7471)


def _pixels(grey: bool):
    @F.arrow_udf("array<float>")
    def decode(data: pa.Array, channels: pa.Array) -> pa.Array:
        lines = []
        for raw, depth in zip(data.to_pylist(), channels.to_pylist()):
            pixels = np.frombuffer(raw, np.uint8).reshape(-1, depth)
            if depth == 1:
                out = pixels if grey else np.repeat(pixels, 3, axis=1)
            else:
                rgb = pixels[:, 2::-1]  # stored blue first; a fourth channel is dropped
                out = (rgb.astype(np.uint32) @ np.array(LUMA, np.uint32) + 0x8000) >> 16 if grey else rgb
            lines.append(out.astype(np.float32).ravel())
        flat = np.concatenate(lines) if lines else np.empty(0, np.float32)
        return _lists(flat, np.array([len(x) for x in lines], np.int64), np.ones(len(lines), bool), pa.float32())

    return decode


def to_rgb(image: Column) -> Column:
    """Flat red-green-blue values of an image struct; a grey image gets three equal channels."""
    return _pixels(False)(image["data"], image["nChannels"])


def to_grey(image: Column) -> Column:
    """Flat grey values of an image struct; one channel passes through, colour is weighted."""
    return _pixels(True)(image["data"], image["nChannels"])


def scan_images(spark: SparkSession, folder: str, suffix: str) -> DataFrame:
    """Decoded image files of one folder (not recursive, suffix is case-sensitive): ``key, image``.

    Hidden files are skipped by Spark itself. A file that does not decode fails the job.
    """
    files = spark.read.format("image").option("pathGlobFilter", f"*{suffix}").option("dropInvalid", "false")
    checked = F.when(F.col("image.nChannels") > 0, F.col("image")).otherwise(
        F.raise_error(F.concat(F.lit("not an image: "), F.col("image.origin"))))
    return in_few_tasks(files.load(folder), folder, suffix).select(checked.alias("image")).select(
        stem(F.col("image.origin")).alias("key"), "image")


def load_pairs(spark: SparkSession, image_folder: str, mask_folder: str, image_suffix: str = ".jpg",
               mask_suffix: str = ".png") -> DataFrame:
    """Images joined with their masks by file stem, as flat float tensors with shapes."""
    images = scan_images(spark, image_folder, image_suffix)
    masks = scan_images(spark, mask_folder, mask_suffix).withColumnRenamed("image", "mask")
    # Joined as 8-bit pixels, a quarter of the size of the float tensors.
    pairs = pair_by_key(images, masks, "key")
    return pairs.select(
        "key", to_rgb(F.col("image")).alias(IMAGE),
        shape_of(F.col("image.height"), F.col("image.width"), 3).alias(IMAGE_SHAPE),
        to_grey(F.col("mask")).alias(LABEL),
        shape_of(F.col("mask.height"), F.col("mask.width")).alias(LABEL_SHAPE))


def load_sides(spark: SparkSession, image_folder: str, mask_folder: str, image_suffix: str = ".jpg",
               mask_suffix: str = ".png") -> DataFrame:
    """Images and masks as rows of their own, with null in the other's columns: for a layout that joins them by key."""
    images = scan_images(spark, image_folder, image_suffix).select(
        "key", to_rgb(F.col("image")).alias(IMAGE), shape_of(F.col("image.height"), F.col("image.width"), 3).alias(IMAGE_SHAPE))
    masks = scan_images(spark, mask_folder, mask_suffix).select(
        "key", to_grey(F.col("image")).alias(LABEL), shape_of(F.col("image.height"), F.col("image.width")).alias(LABEL_SHAPE))
    return images.unionByName(masks, allowMissingColumns=True)


def scan_payloads(spark: SparkSession, path: str, image: str = "pixel_values", label: str = "label",
                  shape: tuple[int, int] | str | None = None) -> DataFrame:
    """A parquet image table with ``struct<bytes,path>`` columns of raw 8-bit pixels.

    With ``shape`` the payloads are unpacked to float tensors of 3 and 1 channels: height and width of all images, or
    the name of a column that holds them as an array. A payload of another size fails the job.
    """
    table = spark.read.parquet(path)
    if shape is None:
        return table.select(image, label)
    height, width = (F.get(F.col(shape), F.lit(0)), F.get(F.col(shape), F.lit(1))) if isinstance(shape, str) else shape

    def pixels(column: str, channels: int):
        payload = F.col(f"{column}.bytes")
        cells = (height if isinstance(height, Column) else F.lit(height)) * width * channels
        wrong = F.raise_error(F.concat(F.lit("payload does not fit its shape: "), F.col(f"{column}.path"))).cast("binary")
        return unpack_uint8(F.when(F.octet_length(payload) == cells, payload).when(payload.isNotNull(), wrong)
                            ).cast("array<float>")

    return table.select(
        stem(F.col(f"{image}.path")).alias("key"), pixels(image, 3).alias(IMAGE),
        shape_of(height, width, 3).alias(IMAGE_SHAPE), pixels(label, 1).alias(LABEL),
        shape_of(height, width).alias(LABEL_SHAPE))
