"""Comparing a candidate with a baseline, and deciding whether it may be published."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Threshold:
    """Limits for one metric.

    ``lower_bound`` / ``upper_bound`` hold for the value (inclusive), ``absolute_change`` for the
    difference to the baseline. ``value_rule`` says when the value limits apply: ``always``, or
    only while there is ``no_baseline``. The limits hold for every slice, or with ``slice_key`` for the
    slices of that key, or with ``slice_value`` too for that one slice.
    """

    metric: str
    lower_bound: float | None = None
    upper_bound: float | None = None
    absolute_change: float | None = None
    higher_is_better: bool = True
    value_rule: str = "always"
    slice_key: str | None = None
    slice_value: str | None = None

    def __post_init__(self) -> None:
        if self.slice_value is not None and self.slice_key is None:
            raise ValueError("a slice value needs a slice key")
        if self.value_rule not in ("always", "no_baseline"):
            raise ValueError(f"unknown value rule: {self.value_rule}")


# The accuracy gate of the training run.
DEFAULT_THRESHOLD = Threshold("SparseCategoricalAccuracy", lower_bound=0.55, absolute_change=-1e-3)

SLICE = ["slice_key", "slice_value", "metric"]


def compare(candidate: DataFrame, baseline: DataFrame | None) -> DataFrame:
    """Candidate metrics with the baseline value beside them; null where there is no baseline."""
    left = candidate.withColumnRenamed("value", "candidate")
    if baseline is None:
        return left.withColumn("baseline", F.lit(None).cast("double"))
    return left.join(baseline.select(*SLICE, F.col("value").alias("baseline")), SLICE, "left")


def compare_models(values: DataFrame, candidate: str = "candidate", baseline: str = "baseline") -> DataFrame:
    """The same from one table of both models' metrics (``metrics.evaluate_models``), without a join."""
    ours = F.col("model") == F.lit(candidate)
    return values.groupBy(*SLICE).agg(
        F.max(F.when(ours, F.col("n"))).alias("n"),
        F.max(F.when(ours, F.col("value"))).alias("candidate"),
        F.max(F.when(F.col("model") == F.lit(baseline), F.col("value"))).alias("baseline"))


_RULES = ("rule int, metric string, lower_bound double, upper_bound double, absolute_change double, "
          "higher_is_better boolean, value_rule string, on_key string, on_value string")


def _passes() -> tuple[Column, Column]:
    """Do value and change of a metric meet the rule in the same row? A limit that is not set holds."""
    known = F.col("candidate").isNotNull() & ~F.isnan("candidate")
    low = F.col("lower_bound").isNull() | (F.col("candidate") >= F.col("lower_bound"))
    high = F.col("upper_bound").isNull() | (F.col("candidate") <= F.col("upper_bound"))
    spared = (F.col("value_rule") == "no_baseline") & F.col("baseline").isNotNull()
    gain = F.col("candidate") - F.col("baseline")
    better = F.when(F.col("higher_is_better"), gain >= F.col("absolute_change")).otherwise(
        gain <= -F.col("absolute_change"))
    change = F.col("absolute_change").isNull() | F.col("baseline").isNull() | better
    return F.coalesce(known & (spared | (low & high)), F.lit(False)), F.coalesce(known & change, F.lit(False))


def check(compared: DataFrame, thresholds: Sequence[Threshold]) -> DataFrame:
    """One row per slice and limited metric with ``value_ok``, ``change_ok`` and ``passed``.

    All rules of a metric must hold together. A missing candidate value fails, and a rule that finds no value at all
    gives a failed row without a slice. The change rule is skipped without a baseline.
    """
    rules = compared.sparkSession.createDataFrame([
        (i, t.metric, *[None if x is None else float(x) for x in (t.lower_bound, t.upper_bound, t.absolute_change)],
         t.higher_is_better, t.value_rule, t.slice_key, t.slice_value) for i, t in enumerate(thresholds)], _RULES)
    values = compared.withColumnRenamed("metric", "_metric")
    here = (F.col("metric") == F.col("_metric")) & (
        F.col("on_key").isNull() | (F.col("on_key") == F.col("slice_key"))) & (
        F.col("on_value").isNull() | (F.col("on_value") == F.col("slice_value")))
    value_ok, change_ok = _passes()
    rest = [c for c in compared.columns if c not in SLICE]
    judged = rules.join(values, here, "left").groupBy(*SLICE).agg(
        *[F.first(c).alias(c) for c in rest], F.bool_and(value_ok).alias("value_ok"),
        F.bool_and(change_ok).alias("change_ok"))
    return judged.select(*compared.columns, "value_ok", "change_ok").withColumn(
        "passed", F.col("value_ok") & F.col("change_ok"))


def bless(checks: DataFrame) -> DataFrame:
    """One row: ``blessed`` is true when every check passed and there was at least one."""
    return checks.agg(
        F.coalesce(F.bool_and("passed"), F.lit(False)).alias("blessed"),
        F.count(F.lit(1)).alias("checks"),
        F.count_if(~F.col("passed")).alias("failed"))


def is_blessed(blessing: DataFrame | None) -> bool:
    """The decision as a Python value. Without a blessing input publishing is allowed."""
    if blessing is None:
        return True
    row = blessing.select("blessed").first()
    return bool(row and row["blessed"])
