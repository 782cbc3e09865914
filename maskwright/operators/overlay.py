"""Colour overlays: a class mask drawn half transparent over its image."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from maskwright.functions.arrays import _flat, _lists, unroll
from maskwright.sources.palettes import colours_of


def overlay(image: Column, mask: Column, colours: list[tuple[int, int, int]], scaled: bool = True) -> Column:
    """``0.5 * image + 0.5 * colour`` per pixel, as values 0..255.

    A class without a colour is drawn black. The scaled form multiplies by 255 and clips before
    the cast; the plain form does neither and wraps. Images are 0..1 while colours are 0..255,
    so most pixels of the scaled form saturate. That is the expected result.
    """
    table = np.array(colours, np.float64)

    @F.arrow_udf("array<int>")
    def draw(images: pa.Array, masks: pa.Array) -> pa.Array:
        flat, at = _flat(images)
        classes, mask_at = _flat(masks)
        present = np.logical_and(images.is_valid().to_numpy(zero_copy_only=False),
                                 masks.is_valid().to_numpy(zero_copy_only=False))
        if (np.diff(at)[present] != 3 * np.diff(mask_at)[present]).any():
            raise ValueError("an overlay needs three channels per mask pixel")
        out = []
        for row in np.flatnonzero(present):
            label = classes[mask_at[row]:mask_at[row + 1]]
            colour = np.zeros((len(label), 3))
            known = (label >= 0) & (label < len(table)) & (label == np.floor(label))
            colour[known] = table[label[known].astype(int)]
            pixels = flat[at[row]:at[row + 1]].astype(np.float64).reshape(-1, 3) * 0.5 + colour * 0.5
            if scaled:
                pixels = np.clip(pixels * 255, 0, 255)
            out.append((np.trunc(pixels).astype(np.int64) % 256).astype(np.int32).ravel())
        lengths = np.where(present, np.diff(at), 0)
        values = np.concatenate(out) if out else np.empty(0, np.int32)
        return _lists(values, lengths, present, pa.int32())

    return draw(image, mask)


def with_overlay(df: DataFrame, image: str, mask: str, palette: DataFrame, out: str = "overlay",
                 scaled: bool = True) -> DataFrame:
    return df.withColumn(out, overlay(F.col(image), F.col(mask), colours_of(palette), scaled))


def mask_colours(df: DataFrame, key: str, mask: str, palette: DataFrame) -> DataFrame:
    """One row per pixel with its class and colour; a class without a colour gets 0, 0, 0."""
    colours_of(palette)  # raises unless the palette is small enough to broadcast
    pixels = unroll(df, mask, "px", "class", key)
    coloured = pixels.join(F.broadcast(palette), "class", "left")
    return coloured.select(key, "px", "class", *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in "rgb"])
