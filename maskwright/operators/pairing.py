"""Pairing images with masks, and masks with a palette."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from maskwright.functions.names import base_name, stem
from maskwright.operators.ordering import sorted_rank


def list_files(files: DataFrame, suffix: str, path: str = "path", allow_hidden: bool = False) -> DataFrame:
    """Files whose name ends with ``suffix`` (case matters); names that start with a dot are dropped."""
    name = base_name(F.col(path))
    kept = files.filter(F.endswith(name, F.lit(suffix)))
    return kept if allow_hidden else kept.filter(~F.startswith(name, F.lit(".")))


def with_key(files: DataFrame, path: str = "path", key: str = "key") -> DataFrame:
    return files.withColumn(key, stem(F.col(path)))


def pair_by_key(images: DataFrame, masks: DataFrame, key: str) -> DataFrame:
    """Inner join on the key: a missing file costs one pair and shifts none."""
    return images.join(masks, key)


def orphans(images: DataFrame, masks: DataFrame, key: str) -> DataFrame:
    """Keys present on one side only, with the side they were found on."""
    left = images.select(key).join(masks.select(key), key, "left_anti").withColumn("side", F.lit("image"))
    right = masks.select(key).join(images.select(key), key, "left_anti").withColumn("side", F.lit("mask"))
    return left.unionByName(right)


def pair_by_position(images: DataFrame, masks: DataFrame, image_order: str, mask_order: str,
                     strict: bool = True) -> DataFrame:
    """The n-th image with the n-th mask, both in sorted order.

    One missing file shifts every later pair, so unequal counts are refused unless ``strict`` is off.
    """
    left = sorted_rank(images, [image_order], "position")
    right = sorted_rank(masks, [mask_order], "position")
    if strict:
        n_images, n_masks = left.count(), right.count()
        if n_images != n_masks:
            raise ValueError(f"{n_images} images but {n_masks} masks: pair by key instead")
    return left.join(right, "position")
