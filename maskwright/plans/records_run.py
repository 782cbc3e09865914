"""From raw images and masks to record shards: list, pair, split, resize, write."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from maskwright.operators import ordering, pairing, tensors
from maskwright.operators.tensors import IMAGE, IMAGE_SHAPE, LABEL, LABEL_SHAPE
from maskwright.session import materialise
from maskwright.sources import files, images, tfrecord


def list_keys(spark: SparkSession, image_folder: str, mask_folder: str, image_suffix: str, mask_suffix: str,
              strict: bool = True) -> DataFrame:
    """Keys of the files that pair up, from the folder listings alone. Files without a partner are an error
    unless ``strict`` is off; ``pairing.orphans`` names them."""
    listed = [pairing.with_key(files.list_folder(spark, folder, suffix)).select("key")
              for folder, suffix in ((image_folder, image_suffix), (mask_folder, mask_suffix))]
    if strict and (alone := pairing.orphans(*listed, "key").count()):
        raise ValueError(f"{alone} files have no partner")
    return pairing.pair_by_key(*listed, "key")


def _write(rows: DataFrame, index: DataFrame, out: str, fraction: float, size: int, resize: int | None, seed: int,
           shift: bool, encoding: str, halves: Sequence[str] = ()) -> None:
    keys = ["key"]
    split = ordering.exact_split(rows, keys, fraction, seed, index=index)
    split_index = ordering.exact_split(index, keys, fraction, seed)
    # Resizing after the shuffle would move full-size tensors; here only the results travel.
    floats = resize * resize * 4 * 4 if resize else None  # three channels and a mask
    tfrecord.write_records(tensors.resize_pair(split, resize, shift), out, keys, size, seed, encoding,
                           index=split_index, row_bytes=floats, halves=halves)


def images_to_records(spark: SparkSession, image_folder: str, mask_folder: str, out: str, fraction: float = 0.2,
                      size: int = 32, resize: int | None = None, seed: int = 2022, encoding: str = "numeric",
                      shift: bool = True, image_suffix: str = ".jpg", mask_suffix: str = ".png",
                      strict: bool = True) -> None:
    """Image files to ``train-*`` and ``val-*`` shards. Each image is decoded once, in the writing job.

    What is paired, split and placed are the names of the files. Images and masks then go, each in one exchange, to the
    task that writes their shard, and meet there.
    """
    index = materialise(list_keys(spark, image_folder, mask_folder, image_suffix, mask_suffix, strict), "image-keys")
    sides = images.load_sides(spark, image_folder, mask_folder, image_suffix, mask_suffix)
    _write(sides, index, out, fraction, size, resize, seed, shift, encoding, [IMAGE, IMAGE_SHAPE, LABEL, LABEL_SHAPE])


def payloads_to_records(spark: SparkSession, table: str, shape: tuple[int, int] | str, out: str, fraction: float = 0.2,
                        size: int = 32, resize: int | None = None, seed: int = 2022,
                        encoding: str = "numeric") -> None:
    """A parquet image table to shards; masks of such tables start at 0 and are not shifted.

    ``shape`` is height and width of all images, or the column that holds those of each.
    """
    pairs = images.scan_payloads(spark, table, shape=shape)
    _write(pairs, pairs.select("key"), out, fraction, size, resize, seed, False, encoding)
