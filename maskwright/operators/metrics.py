"""Metrics by name and by slice.

Every metric is a ratio of two sums. Each row (an image) is first reduced to its own pair of
numbers, rows are summed per finest slice, and the requested slices are grouping sets over that
small result. Pixels are never shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from maskwright.functions.arrays import count_matches, pixel_losses, unroll

Parts = Callable[[DataFrame, str, str], tuple[Column, Column]]
_METRICS: dict[str, Parts] = {}


def register_metric(name: str, parts: Parts) -> None:
    """Add a metric: ``parts(df, truth, prediction)`` gives the two columns to be summed and divided."""
    _METRICS[name] = parts


def metric_parts(name: str) -> Parts:
    if name not in _METRICS:
        raise ValueError(f"unknown metric: {name}; known: {', '.join(sorted(_METRICS))}")
    return _METRICS[name]


def _is_array(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.ArrayType)


def _accuracy(df: DataFrame, truth: str, prediction: str) -> tuple[Column, Column]:
    if _is_array(df, truth):
        counts = count_matches(F.col(truth), F.col(prediction))
        return counts["matches"].cast("double"), counts["pixels"].cast("double")
    both = F.col(truth).isNotNull() & F.col(prediction).isNotNull()
    match = F.when(F.col(truth) == F.col(prediction), F.lit(1.0)).otherwise(F.lit(0.0))
    return F.when(both, match), F.when(both, F.lit(1.0))


register_metric("SparseCategoricalAccuracy", _accuracy)


def cross_entropy(classes: int) -> Parts:
    """Cross-entropy from logits; register it under a name for the number of classes at hand."""
    losses = pixel_losses(classes)

    def parts(df: DataFrame, truth: str, logits: str) -> tuple[Column, Column]:
        pair = losses(F.col(logits), F.col(truth))
        return pair["loss"], pair["pixels"].cast("double")

    return parts


def _sliced(finest: DataFrame, columns: Sequence[str], slices: Sequence[Sequence[str]], sums: Sequence[Column]
            ) -> tuple[DataFrame, Column, Column]:
    """The sums per requested slice, with expressions for the slice name and value."""
    if not columns:
        return finest, F.lit("overall"), F.lit("")
    wanted = [[F.col(c) for c in spec] for spec in slices]
    grouped = finest.groupingSets(wanted, *columns).agg(F.grouping_id().alias("_id"), *sums)
    key, value = F.lit("overall"), F.lit("")
    for spec in slices:
        bits = sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in spec)
        here = F.col("_id") == F.lit(bits)
        shown = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in spec]
        key = F.when(here, F.lit(",".join(spec) or "overall")).otherwise(key)
        value = F.when(here, F.concat_ws(",", *shown) if spec else F.lit("")).otherwise(value)
    return grouped, key, value


def evaluate_models(df: DataFrame, truth: str, predictions: Mapping[str, str], metrics: Sequence[str],
                    slices: Sequence[Sequence[str]] = ((),)) -> DataFrame:
    """Metric values of several models over the same rows, in one pass.

    ``predictions`` maps model names to prediction columns. Result: ``(model, slice_key,
    slice_value, metric, value, n)``; the empty slice is the whole dataset.
    """
    columns = list(dict.fromkeys(c for spec in slices for c in spec))
    cells = [(model, metric, metric_parts(metric)(df, truth, column))
             for model, column in predictions.items() for metric in metrics]
    reduced = df.select(*columns, *[part.alias(f"_{kind}{i}") for i, (_, _, pair) in enumerate(cells)
                                    for kind, part in zip(("num", "den"), pair)])
    sums = [F.sum(f"_{kind}{i}").alias(f"_{kind}{i}") for i in range(len(cells)) for kind in ("num", "den")]
    grouped, key, value = _sliced(reduced.groupBy(*columns).agg(*sums), columns, slices, sums)
    rows = F.array(*[
        F.struct(F.lit(model).alias("model"), F.lit(metric).alias("metric"),
                 (F.col(f"_num{i}") / F.nullif(F.col(f"_den{i}"), F.lit(0.0))).alias("value"),
                 F.coalesce(F.col(f"_den{i}"), F.lit(0.0)).cast("bigint").alias("n"))
        for i, (model, metric, _) in enumerate(cells)])
    return grouped.select(key.alias("slice_key"), value.alias("slice_value"), F.inline(rows)).select(
        "model", "slice_key", "slice_value", "metric", "value", "n")


def evaluate(df: DataFrame, truth: str, prediction: str, metrics: Sequence[str],
             slices: Sequence[Sequence[str]] = ((),)) -> DataFrame:
    """Metric values of one model: ``(slice_key, slice_value, metric, value, n)``."""
    return evaluate_models(df, truth, {"model": prediction}, metrics, slices).drop("model")


def confusion(df: DataFrame, truth: str, prediction: str) -> DataFrame:
    """Counts per (label, prediction): unrolled to pixels and partially summed in place."""
    if _is_array(df, truth):
        pair = F.arrays_zip(F.col(truth).alias("label"), F.col(prediction).alias("pred"))
        pixels = unroll(df, pair, "_at", "_p").select("_p.*")
    else:
        pixels = df.select(F.col(truth).alias("label"), F.col(prediction).alias("pred"))
    return pixels.groupBy("label", "pred").agg(F.count(F.lit(1)).alias("n"))
