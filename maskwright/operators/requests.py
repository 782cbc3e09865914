"""Scoring requests and responses as JSON columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from maskwright.functions import base64url
from maskwright.functions.arrays import unroll
from maskwright.operators.ordering import shard_layout


def build_requests(df: DataFrame, keys: Sequence[str], payload: str, size: int, seed: int,
                   field: str = "string_input", index: DataFrame | None = None) -> DataFrame:
    """One request per batch of ``size`` rows in seeded order: ``{"instances": [{field: base64}]}``.

    Payloads are shuffled once, to the task that ranks them; a batch lies within it, so at most
    ``size`` payloads are gathered at a time and no second shuffle follows. An ``index`` with the keys of the same rows
    spares the narrow passes a costly ``df``.
    """
    rows = df.select(*keys, payload).withColumn("split", F.lit("all"))
    index = None if index is None else index.select(*keys).withColumn("split", F.lit("all"))
    placed = shard_layout(rows, keys, size, seed, keep=["_task"], index=index)
    instance = F.struct(base64url.encode(F.col(payload)).alias(field))
    grouped = placed.groupBy("_task", "shard").agg(
        F.sort_array(F.collect_list(F.struct("position", instance.alias("instance")))).alias("_items"))
    body = F.struct(F.transform("_items", lambda item: item["instance"]).alias("instances"))
    return grouped.select(F.col("shard").alias("batch_id"), F.size("_items").alias("n"),
                          F.to_json(body).alias("request"))


def explode_requests(requests: DataFrame, body: str = "request", field: str = "string_input") -> DataFrame:
    """One row per instance, payload decoded."""
    parsed = F.from_json(F.col(body), f"instances array<struct<{field}:string>>")
    rest = [c for c in requests.columns if c != body]
    return unroll(requests, parsed["instances"], "instance", "_i", *rest).select(
        *rest, "instance", base64url.decode(F.col("_i")[field]).alias("payload"))


def build_response(masks: Column, **extra: Column) -> Column:
    """``{"predictions": [...], ...}`` with any further fields of the answer."""
    return F.to_json(F.struct(masks.alias("predictions"), *[v.alias(k) for k, v in extra.items()]))


def parse_response(body: Column, element: str = "array<double>") -> Column:
    """The ``predictions`` list: one entry per instance, each a flat or nested list of numbers."""
    return F.from_json(body, f"predictions array<{element}>")["predictions"]


def parse_config(text: Column) -> Column:
    """A flat settings literal, with single or double quotes, as a map; null stays null."""
    return F.from_json(text, "map<string,string>", {"allowSingleQuotes": "true"})
