"""Checking a dataset against its declared schema, and inferring a schema from statistics."""

from __future__ import annotations

from math import prod

from pyspark.sql import Column, DataFrame, functions as F, types as T

from maskwright.sources.schema_text import Feature

MAX_FEATURES = 100_000  # of an inferred schema; more are refused
_KINDS = {
    "FLOAT": (T.FloatType, T.DoubleType),
    "INT": (T.ByteType, T.ShortType, T.IntegerType, T.LongType),
    "BYTES": (T.BinaryType, T.StringType),
}


def feature_kind(data_type: T.DataType) -> str:
    element = data_type.elementType if isinstance(data_type, T.ArrayType) else data_type
    for kind, classes in _KINDS.items():
        if isinstance(element, classes):
            return kind
    return element.simpleString().upper()


def _number(value: float | None) -> str:
    return "" if value is None else f"{value:g}"


def anomalies(df: DataFrame, features: list[Feature], split: str | None = "split") -> DataFrame:
    """Broken rules: ``(split, feature, rule, expected, n_bad, n_rows)``; a clean dataset gives no rows.

    Rules: ``missing`` (column or too few values), ``type``, ``domain`` (rows with a value outside), ``shape``
    (rows of another length). All features are checked in one scan by one aggregate per split;
    nothing is unrolled.
    """
    group = F.col(split) if split else F.lit("all")
    checks: list[tuple[str, str, str, Column, Column]] = []
    rows = F.count(F.lit(1))
    for f in features:
        if f.name not in df.columns:
            if f.min_fraction > 0:
                checks.append((f.name, "missing", "column", rows, F.lit(True)))
            continue
        kind = df.schema[f.name].dataType
        x = F.col(f.name)
        # records have no null: a feature that a record lacks reads as an empty list
        empty = x.isNull() | (F.size(x) == 0) if isinstance(kind, T.ArrayType) else x.isNull()
        absent = F.count_if(empty)
        present = F.lit(1.0) - absent / rows
        checks.append((f.name, "missing", f"min_fraction {f.min_fraction:g}", absent,
                       present < F.lit(f.min_fraction)))
        if feature_kind(kind) != f.type:
            checks.append((f.name, "type", f.type, rows, F.lit(True)))
            continue
        is_list = isinstance(kind, T.ArrayType)
        if f.low is not None or f.high is not None:
            low, high = (F.array_min(x), F.array_max(x)) if is_list else (x, x)
            outside = F.lit(False)
            if f.low is not None:
                outside = outside | (low.cast("double") < F.lit(f.low))
            if f.high is not None:
                outside = outside | (high.cast("double") > F.lit(f.high))
            bad = F.count_if(outside)
            checks.append((f.name, "domain", f"{_number(f.low)}..{_number(f.high)}", bad, bad > 0))
        if f.shape is not None and f.type != "BYTES":
            length = F.size(x) if is_list else F.lit(1)
            bad = F.count_if(~empty & (length != F.lit(prod(f.shape))))
            checks.append((f.name, "shape", "x".join(map(str, f.shape)), bad, bad > 0))
    if not checks:
        raise ValueError("the schema declares nothing to check")
    found = F.array(*[
        F.struct(F.lit(name).alias("feature"), F.lit(rule).alias("rule"), F.lit(expected).alias("expected"),
                 bad.cast("bigint").alias("n_bad"), broken.alias("broken"))
        for name, rule, expected, bad, broken in checks])
    summary = df.groupBy(group.alias("split")).agg(rows.alias("n_rows"), found.alias("found"))
    return summary.select("split", "n_rows", F.inline("found")).filter("broken").select(
        "split", "feature", "rule", "expected", "n_bad", "n_rows")


def inferred_features(inferred: DataFrame) -> list[Feature]:
    """An inferred schema as declared features, to check other data against (one row per feature)."""
    rows = inferred.orderBy("feature").take(MAX_FEATURES + 1)
    if len(rows) > MAX_FEATURES:
        raise ValueError("too many features for a schema")
    return [Feature(r["feature"], r["type"], r["min_fraction"], r["low"], r["high"],
                    (r["size"],) if r["size"] is not None else None) for r in rows]


def infer_schema(df: DataFrame, stats_wide: DataFrame) -> DataFrame:
    """One row per feature: type, presence, value range, and the length if all rows agree on it.

    ``stats_wide`` comes from ``profile.feature_stats_wide``; its splits are merged.
    """
    merged = stats_wide.groupBy("feature").agg(
        F.sum("num_rows").alias("_rows"), F.sum("num_missing").alias("_missing"),
        F.min("min").alias("low"), F.max("max").alias("high"),
        F.min("min_size").alias("_least"), F.max("max_size").alias("_most"))
    # a row per column of the table, beside one per feature
    kinds = df.sparkSession.createDataFrame([(f.name, feature_kind(f.dataType)) for f in df.schema.fields],
                                            "feature string, type string")
    return merged.join(kinds, "feature", "left").select(
        "feature", "type", (F.lit(1.0) - F.col("_missing") / F.col("_rows")).alias("min_fraction"),
        "low", "high", F.when(F.col("_least") == F.col("_most"), F.col("_least")).alias("size"))
