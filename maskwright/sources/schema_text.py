"""Declared feature schemas: a small text file of features with type, presence, domain and shape."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, types as T

_SCALAR = {"FLOAT": T.FloatType, "INT": T.LongType, "BYTES": T.BinaryType}
_TOKEN = re.compile(r'(?P<open>\w+)\s*:?\s*\{|(?P<close>\})|(?P<name>\w+)\s*:\s*(?P<value>"[^"]*"|[^\s{}]+)')


@dataclass(frozen=True)
class Feature:
    name: str
    type: str
    min_fraction: float = 0.0
    low: float | None = None
    high: float | None = None
    shape: tuple[int, ...] | None = None


def _blocks(text: str) -> dict:
    """Nested ``name { ... }`` blocks as dicts of lists; ``#`` starts a comment."""
    plain = re.sub(r'("[^"\n]*")|#[^\n]*', lambda m: m.group(1) or "", text)
    stack: list[dict] = [{}]
    for token in _TOKEN.finditer(plain):
        if token["open"]:
            inner: dict = {}
            stack[-1].setdefault(token["open"], []).append(inner)
            stack.append(inner)
        elif token["close"]:
            if len(stack) == 1:
                raise ValueError("schema text closes a block it never opened")
            stack.pop()
        else:
            stack[-1].setdefault(token["name"], []).append(token["value"].strip('"'))
    if len(stack) != 1:
        raise ValueError("schema text ends inside a block")
    return stack[0]


def _feature(block: dict) -> Feature:
    name, kind = block["name"][0], block["type"][0]
    if kind not in _SCALAR:
        raise ValueError(f"feature {name} has unknown type {kind}")
    domain = (block.get("float_domain") or block.get("int_domain") or [{}])[0]
    presence = (block.get("presence") or [{}])[0]
    shape = block.get("shape")
    return Feature(
        name, kind, float(presence.get("min_fraction", [0.0])[0]),
        float(domain["min"][0]) if "min" in domain else None,
        float(domain["max"][0]) if "max" in domain else None,
        tuple(int(d["size"][0]) for d in shape[0].get("dim", [])) if shape else None)


def parse_schema(text: str) -> list[Feature]:
    return [_feature(block) for block in _blocks(text).get("feature", [])]


def read_schema(spark: SparkSession, path: str) -> list[Feature]:
    """Features declared in one text file (read whole on the driver: it holds names, not data)."""
    return parse_schema(spark.read.text(path, wholetext=True).first()["value"])


def struct_type(features: list[Feature]) -> T.StructType:
    """The row type of a record with these features. A tensor is a flat list."""
    return T.StructType([
        T.StructField(f.name, _SCALAR[f.type]() if f.type == "BYTES" else T.ArrayType(_SCALAR[f.type]()))
        for f in features])


def constraint_table(spark: SparkSession, features: list[Feature]) -> DataFrame:
    """The declared rules as rows."""
    rows = [(f.name, f.type, f.min_fraction, f.low, f.high, list(f.shape) if f.shape is not None else None)
            for f in features]
    return spark.createDataFrame(
        rows, "feature string, type string, min_fraction double, low double, high double, shape array<bigint>")
