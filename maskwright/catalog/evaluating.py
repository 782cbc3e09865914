"""Metrics, slices, and the gate."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from maskwright.catalog.views import ARGMAX, VALUES, masks, sql_split, table
from maskwright.operators import gate, metrics
from maskwright.operators.pairing import pair_by_key
from maskwright.operators.tensors import to_cells
from maskwright.session import scratch_path
from maskwright.sources import tables

METRIC = "SparseCategoricalAccuracy"
XENT = "SparseCategoricalCrossentropy"


def _judged(spark: SparkSession, folder: str) -> DataFrame:
    """True quality of a document beside two length rules that try to predict it."""
    truth = table(spark, folder, "labels").select("doc_id", F.col("quality").alias("truth"))
    guesses = table(spark, folder, "documents").select(
        "doc_id", "lang", (F.col("n_chars") >= 200).cast("bigint").alias("candidate"),
        (F.col("n_chars") >= 2000).cast("bigint").alias("baseline"))
    return pair_by_key(truth, guesses, "doc_id")


def _checks(spark: SparkSession, folder: str) -> DataFrame:
    values = metrics.evaluate_models(_judged(spark, folder), "truth",
                                     {"candidate": "candidate", "baseline": "baseline"}, [METRIC], [(), ("lang",)])
    return gate.check(gate.compare_models(values), [gate.DEFAULT_THRESHOLD])


def eval_gate(spark: SparkSession, folder: str) -> DataFrame:
    return _checks(spark, folder).select(
        "slice_key", "slice_value", "metric", "n", F.round("candidate", 6).alias("candidate"),
        F.round("baseline", 6).alias("baseline"), "value_ok", "change_ok", "passed")


def blessing(spark: SparkSession, folder: str) -> DataFrame:
    return gate.bless(_checks(spark, folder))


def baseline_join(spark: SparkSession, folder: str) -> DataFrame:
    """The baseline's metrics come from a stored earlier run and miss one slice: there the change rule is skipped."""
    rows = _judged(spark, folder)
    path = scratch_path(spark, "baseline")
    tables.append_run(metrics.evaluate(rows.filter("lang <> 'fr'"), "truth", "baseline", [METRIC], [("lang",)]), path, 1)
    candidate = metrics.evaluate(rows, "truth", "candidate", [METRIC], [("lang",)])
    checks = gate.check(gate.compare(candidate, tables.read_run(spark, path)), [gate.DEFAULT_THRESHOLD])
    return checks.select("slice_value", F.round("candidate", 6).alias("candidate"),
                         F.round("baseline", 6).alias("baseline"), "change_ok", "passed")


def gate_without_baseline(spark: SparkSession, folder: str) -> DataFrame:
    rows = masks(spark, folder)
    values = metrics.evaluate(rows, "truth", "pred", [METRIC], [(), ("split",)])
    rule = gate.Threshold(METRIC, lower_bound=0.55, absolute_change=-1e-3, value_rule="no_baseline")
    return gate.check(gate.compare(values, None), [rule]).select(
        "slice_key", "slice_value", F.round("candidate", 6).alias("candidate"), "baseline", "passed")


def _compared(spark: SparkSession, folder: str) -> DataFrame:
    return gate.compare_models(metrics.evaluate_models(
        _judged(spark, folder), "truth", {"candidate": "candidate", "baseline": "baseline"}, [METRIC], [(), ("lang",)]))


def gate_two_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Two rules for one metric: the second must not undo the first."""
    rules = [gate.Threshold(METRIC, lower_bound=0.99), gate.Threshold(METRIC, absolute_change=-1e-3)]
    return gate.check(_compared(spark, folder), rules).select("slice_key", "slice_value", "value_ok", "change_ok", "passed")


def gate_missing_metric(spark: SparkSession, folder: str) -> DataFrame:
    """A rule for a metric that nobody computed: not blessed."""
    return gate.bless(gate.check(_compared(spark, folder), [
        gate.Threshold(METRIC, lower_bound=0.0), gate.Threshold("NoSuchMetric", lower_bound=0.0)]))


def gate_per_slice(spark: SparkSession, folder: str) -> DataFrame:
    """A limit for the whole, another for every language, a third for one language."""
    rules = [gate.Threshold(METRIC, lower_bound=0.55, slice_key="overall"),
             gate.Threshold(METRIC, lower_bound=0.1, slice_key="lang"),
             gate.Threshold(METRIC, upper_bound=0.2, slice_key="lang", slice_value="en")]
    return gate.check(_compared(spark, folder), rules).select("slice_key", "slice_value", "n", "passed")


def pixel_accuracy(spark: SparkSession, folder: str) -> DataFrame:
    values = metrics.evaluate(masks(spark, folder), "truth", "pred", [METRIC], [(), ("split",)])
    return values.select("slice_key", "slice_value", "metric", F.round("value", 6).alias("value"), "n")


def eval_readback(spark: SparkSession, folder: str) -> DataFrame:
    """The evaluation written as a table and read back."""
    path = scratch_path(spark, "evaluation")
    slices = [(), ("lang",), ("truth", "lang")]
    tables.append_run(metrics.evaluate(_judged(spark, folder), "truth", "candidate", [METRIC], slices), path, 1)
    return tables.read_run(spark, path).select(
        "slice_key", "slice_value", "metric", F.round("value", 6).alias("value"), "n")


def xent(spark: SparkSession, folder: str) -> DataFrame:
    metrics.register_metric(XENT, metrics.cross_entropy(4))
    values = metrics.evaluate(masks(spark, folder), "truth", "logits", [XENT], [(), ("split",)])
    return values.select("slice_key", "slice_value", F.round("value", 6).alias("value"), "n")


def user_metric(spark: SparkSession, folder: str) -> DataFrame:
    """A user metric beside a built-in one: share of rows predicted positive."""
    metrics.register_metric("PositiveShare", lambda df, truth, pred: (
        F.col(pred).cast("double"), F.when(F.col(pred).isNotNull(), F.lit(1.0))))
    values = metrics.evaluate(_judged(spark, folder), "truth", "candidate", ["PositiveShare", METRIC], [("lang",)])
    return values.select("slice_value", "metric", F.round("value", 6).alias("value"), "n")


def confusion(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.confusion(masks(spark, folder), "truth", "pred")


def pixel_cells(spark: SparkSession, folder: str) -> DataFrame:
    """Predicted masks unrolled to coordinates and counted per cell and class."""
    cells = to_cells(masks(spark, folder).select("pred"), "pred", (4, 4), ("y", "x"), "cls")
    return cells.groupBy("y", "x", "cls").agg(F.count(F.lit(1)).alias("n"))


QUERIES = {
    "eval_gate": eval_gate, "blessing": blessing, "baseline_join": baseline_join,
    "gate_without_baseline": gate_without_baseline, "gate_two_rules": gate_two_rules,
    "gate_missing_metric": gate_missing_metric, "gate_per_slice": gate_per_slice,
    "pixel_accuracy": pixel_accuracy, "eval_readback": eval_readback, "xent": xent, "user_metric": user_metric,
    "confusion": confusion, "pixel_cells": pixel_cells,
}

_ROWS = ("SELECT l.quality AS truth, d.lang, CASE WHEN d.n_chars >= 200 THEN 1 ELSE 0 END AS cand, "
         "CASE WHEN d.n_chars >= 2000 THEN 1 ELSE 0 END AS base FROM labels l JOIN documents d USING (doc_id)")
_HIT = "CASE WHEN truth = {0} THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END"
_GATE = f"""
SELECT CASE WHEN grouping(lang) = 1 THEN 'overall' ELSE 'lang' END AS slice_key,
       CASE WHEN grouping(lang) = 1 THEN '' ELSE lang END AS slice_value,
       '{METRIC}' AS metric, count(*) AS n,
       avg({_HIT.format('cand')}) AS c, avg({_HIT.format('base')}) AS b
FROM ({_ROWS}) GROUP BY GROUPING SETS ((), (lang))"""
_CHECKED = f"""
SELECT slice_key, slice_value, metric, n, round(c, 6) AS candidate, round(b, 6) AS baseline,
       c >= CAST(0.55 AS DOUBLE) AS value_ok, c - b >= CAST(-0.001 AS DOUBLE) AS change_ok,
       c >= CAST(0.55 AS DOUBLE) AND c - b >= CAST(-0.001 AS DOUBLE) AS passed
FROM ({_GATE})"""
_PIXELS = (f"SELECT vec_id, px, label % 4 AS truth, cls, {sql_split('vec_id')} AS split FROM ({ARGMAX})")
_BY_SPLIT = ("CASE WHEN grouping(split) = 1 THEN 'overall' ELSE 'split' END AS slice_key, "
             "CASE WHEN grouping(split) = 1 THEN '' ELSE split END AS slice_value")
_ACCURACY = (f"SELECT {_BY_SPLIT}, avg({_HIT.format('cls')}) AS a, count(*) AS n FROM ({_PIXELS}) "
             "GROUP BY GROUPING SETS ((), (split))")
_LOSS = f"""
SELECT vec_id, i // 4 AS px, {sql_split('vec_id')} AS split,
       ln(sum(exp(CAST(v AS DOUBLE) - peak))) + max(peak)
         - max(CASE WHEN i % 4 = label % 4 THEN CAST(v AS DOUBLE) END) AS loss
FROM (SELECT *, max(CAST(v AS DOUBLE)) OVER (PARTITION BY vec_id, i // 4) AS peak FROM ({VALUES}))
GROUP BY vec_id, i // 4"""

ORACLES = {
    "eval_gate": _CHECKED,
    "blessing": f"SELECT bool_and(passed) AS blessed, count(*) AS checks, "
                f"count(*) FILTER (WHERE NOT passed) AS failed FROM ({_CHECKED})",
    "baseline_join": f"""
SELECT slice_value, round(c, 6) AS candidate, CASE WHEN slice_value <> 'fr' THEN round(b, 6) END AS baseline,
  slice_value = 'fr' OR c - b >= CAST(-0.001 AS DOUBLE) AS change_ok,
  c >= CAST(0.55 AS DOUBLE) AND (slice_value = 'fr' OR c - b >= CAST(-0.001 AS DOUBLE)) AS passed
FROM ({_GATE}) WHERE slice_key = 'lang'""",
    "gate_without_baseline": f"SELECT slice_key, slice_value, round(a, 6) AS candidate, CAST(NULL AS DOUBLE) "
                             f"AS baseline, a >= CAST(0.55 AS DOUBLE) AS passed FROM ({_ACCURACY})",
    "gate_two_rules": f"SELECT slice_key, slice_value, c >= CAST(0.99 AS DOUBLE) AS value_ok, "
                      f"c - b >= CAST(-0.001 AS DOUBLE) AS change_ok, c >= CAST(0.99 AS DOUBLE) AND "
                      f"c - b >= CAST(-0.001 AS DOUBLE) AS passed FROM ({_GATE})",
    "gate_missing_metric": f"SELECT false AS blessed, count(*) + 1 AS checks, CAST(1 AS BIGINT) AS failed FROM ({_GATE})",
    "gate_per_slice": f"SELECT slice_key, slice_value, n, CASE WHEN slice_key = 'overall' THEN c >= CAST(0.55 AS DOUBLE) "
                      f"ELSE c >= CAST(0.1 AS DOUBLE) AND (slice_value <> 'en' OR c <= CAST(0.2 AS DOUBLE)) END "
                      f"AS passed FROM ({_GATE})",
    "pixel_accuracy": f"SELECT slice_key, slice_value, '{METRIC}' AS metric, round(a, 6) AS value, n "
                      f"FROM ({_ACCURACY})",
    "eval_readback": f"""
SELECT CASE WHEN grouping(truth) = 0 THEN 'truth,lang' WHEN grouping(lang) = 0 THEN 'lang' ELSE 'overall' END
         AS slice_key,
       CASE WHEN grouping(truth) = 0 THEN CAST(truth AS VARCHAR) || ',' || lang
            WHEN grouping(lang) = 0 THEN lang ELSE '' END AS slice_value,
       '{METRIC}' AS metric, round(avg({_HIT.format('cand')}), 6) AS value, count(*) AS n
FROM ({_ROWS}) GROUP BY GROUPING SETS ((), (lang), (truth, lang))""",
    "xent": f"SELECT {_BY_SPLIT}, round(avg(loss), 6) AS value, count(*) AS n FROM ({_LOSS}) "
            "GROUP BY GROUPING SETS ((), (split))",
    "user_metric": f"""
SELECT lang AS slice_value, 'PositiveShare' AS metric, round(avg(CAST(cand AS DOUBLE)), 6) AS value, count(*) AS n
FROM ({_ROWS}) GROUP BY lang
UNION ALL
SELECT lang, '{METRIC}', round(avg({_HIT.format('cand')}), 6), count(*) FROM ({_ROWS}) GROUP BY lang""",
    "confusion": f"SELECT CAST(label % 4 AS INTEGER) AS label, cls AS pred, count(*) AS n FROM ({ARGMAX}) "
                 "GROUP BY ALL",
    "pixel_cells": f"SELECT CAST(px // 4 AS INTEGER) AS y, CAST(px % 4 AS INTEGER) AS x, cls, count(*) AS n "
                   f"FROM ({ARGMAX}) GROUP BY ALL",
}
