import random
from math import ceil

import numpy as np
import pytest
from pyspark.sql import functions as F

from maskwright.operators import compare, constraints, partials, profile
from maskwright.sources import schema_text

TEXT = """
# a comment { with: braces }
feature {
  name: "image"  # trailing
  type: FLOAT
  presence { min_fraction: 1.0 }
  float_domain { min: 0 max: 255 }
  shape { dim { size: 2 } dim { size: 1 } }
}
feature { name: "label" type: INT presence { min_fraction: 0.5 } int_domain { max: 2 } }
feature { name: "note" type: BYTES }
"""
FRAME = "split string, image array<float>, label bigint, note string"


def test_schema_text():
    image, label, note = schema_text.parse_schema(TEXT)
    assert image == schema_text.Feature("image", "FLOAT", 1.0, 0.0, 255.0, (2, 1))
    assert label == schema_text.Feature("label", "INT", 0.5, None, 2.0, None)
    assert note.type == "BYTES"
    assert schema_text.struct_type([image, label]).simpleString() == "struct<image:array<float>,label:array<bigint>>"


@pytest.mark.parametrize("bad", ["feature { name: \"x\" type: FLOAT", "}", "feature { name: \"x\" type: WAT }"])
def test_bad_schema_text(bad):
    with pytest.raises(ValueError):
        schema_text.parse_schema(bad)


def test_read_schema_and_rules(spark, tmp_path):
    (tmp_path / "schema.pbtxt").write_text(TEXT)
    features = schema_text.read_schema(spark, str(tmp_path / "schema.pbtxt"))
    assert [f.name for f in features] == ["image", "label", "note"]
    assert schema_text.constraint_table(spark, features).filter("shape is not null").first()["shape"] == [2, 1]


def test_clean_data_have_no_anomalies(spark):
    df = spark.createDataFrame([("train", [0.0, 255.0], 1, "x"), ("eval", [3.0, 4.0], None, None),
                                ("eval", [3.0, 4.0], 2, None)], FRAME)
    assert constraints.anomalies(df, schema_text.parse_schema(TEXT)).count() == 0


def test_every_injected_fault_is_found(spark):
    df = spark.createDataFrame([
        ("train", [0.0, 256.0], 1, "x"), ("train", [1.0], 3, "x"), ("train", None, 0, None),
        ("eval", [0.0, 1.0], None, "x"), ("eval", [0.0, 1.0], None, "x"), ("eval", [0.0, 1.0], 1, "x")], FRAME)
    found = {(r["split"], r["feature"], r["rule"]): (r["expected"], r["n_bad"], r["n_rows"])
             for r in constraints.anomalies(df, schema_text.parse_schema(TEXT)).collect()}
    assert found == {
        ("train", "image", "missing"): ("min_fraction 1", 1, 3), ("train", "image", "domain"): ("0..255", 1, 3),
        ("train", "image", "shape"): ("2x1", 1, 3), ("train", "label", "domain"): ("..2", 1, 3),
        ("eval", "label", "missing"): ("min_fraction 0.5", 2, 3)}
    wrong = df.withColumn("label", F.col("label").cast("double")).drop("note")
    rules = {(r["feature"], r["rule"]) for r in constraints.anomalies(wrong, schema_text.parse_schema(TEXT)).collect()}
    assert ("label", "type") in rules and ("note", "missing") not in rules  # note has no presence rule


def test_missing_column_is_reported_when_required(spark):
    df = spark.createDataFrame([("train", 1)], "split string, label bigint")
    rules = {(r["feature"], r["rule"], r["expected"])
             for r in constraints.anomalies(df, schema_text.parse_schema(TEXT)).collect()}
    assert rules == {("image", "missing", "column")}


def test_statistics_of_lists_and_scalars(spark):
    df = spark.createDataFrame([("train", [1.0, 3.0], 5, ""), ("train", None, None, ""), ("train", [], 0, ""),
                                ("train", [0.0, 0.0, 2.0], 7, "")], FRAME)
    for median in (None, "exact", "sketch"):
        got = {r["feature"]: r for r in profile.feature_stats_wide(df, ["image", "label"], median=median).collect()}
        image, label = got["image"], got["label"]
        assert (image["num_rows"], image["num_missing"], image["num_values"]) == (4, 2, 5)
        assert (image["min_size"], image["max_size"], image["avg_size"]) == (2, 3, 2.5)
        assert (image["num_zeros"], image["min"], image["max"]) == (2, 0.0, 3.0)
        assert image["median"] == (1.0 if median else None) and label["median"] == (5.0 if median else None)
        assert (label["num_rows"], label["num_missing"]) == (4, 1)


def test_nan_is_counted_but_not_averaged(spark):
    df = spark.createDataFrame([("a", [1.0, float("nan"), 3.0], 0, "")], FRAME)
    row = profile.feature_stats_wide(df, ["image"]).first()
    assert (row["num_values"], row["mean"], row["max"], row["median"]) == (3, 2.0, 3.0, 1.0)


def test_thousands_of_splits(spark):
    df = spark.range(12_000).withColumns({"x": F.col("id") * 1.0, "s": F.col("id") % 3000})
    rows = profile.feature_stats_wide(df, ["x"], "s", profile.EXACT).collect()
    assert len(rows) == 3000 and all(r["median"] == int(r["split"]) + 3000 and r["num_rows"] == 4 for r in rows)
    assert profile.histogram(df, ["x"], "s").agg(F.sum("n")).first()[0] == 12_000


def test_infinities_and_empty_tables(spark):
    inf = float("inf")
    df = spark.createDataFrame([("s", v) for v in (1.0, 2.0, 3.0, inf)] + [("t", inf), ("u", -inf), ("u", 5e-324),
                               ("u", 1e-323)], "split string, f double")
    got = {r["split"]: r for r in profile.feature_stats_wide(df, ["f"], "split", profile.EXACT).collect()}
    assert (got["s"]["median"], got["s"]["max"], got["s"]["mean"]) == (2.0, inf, 2.0)
    assert (got["t"]["median"], got["t"]["mean"], got["t"]["num_values"]) == (inf, None, 1)
    assert (got["u"]["min"], got["u"]["median"]) == (-inf, 5e-324)
    bars = {(r["split"], r["bucket"]): r["n"] for r in profile.histogram(df, ["f"], buckets=2).collect()}
    assert bars == {("s", 0): 1, ("s", 1): 2, ("s", 2): 1, ("t", 2): 1, ("u", -1): 1, ("u", 0): 1, ("u", 1): 1}
    empty = df.limit(0)
    assert profile.feature_stats(empty, ["f"], median=profile.EXACT).count() == profile.histogram(empty, ["f"]).count() == 0


def test_absent_lists_count_as_missing_whether_null_or_empty(spark):
    rows = [("train", [0.5, 0.5], 1, "a"), ("train", [], 1, "a"), ("train", None, 1, "a")]
    df = spark.createDataFrame(rows, FRAME)
    found = {(r["feature"], r["rule"]): r["n_bad"]
             for r in constraints.anomalies(df, schema_text.parse_schema(TEXT)).collect()}
    assert found["image", "missing"] == 2


@pytest.mark.parametrize("values", [
    [5.0], [1.0, 2.0], [3.0] * 1000 + [1.0], [1e300, -1e300, 0.0, 1e-300, 7.0],
    [1e18] + [i / 1000 for i in range(5000)], [random.Random(2).gauss(0, 1) for _ in range(5000)],
])
def test_exact_quantiles_match_sorting(spark, values):
    ranks = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    df = spark.createDataFrame([("s", v) for v in values] + [("s", None), (None, 1.0), (None, 2.0)],
                               "split string, f double")
    got = {}
    for r in profile.search_quantiles(df, ["f"], "split", ranks).orderBy("rank").collect():
        got.setdefault((r["split"], r["feature"]), []).append(r["value"])
    ordered = sorted(values)
    assert got == {("s", "f"): [ordered[max(ceil(p * len(values)), 1) - 1] for p in ranks],
                   (None, "f"): [1.0, 1.0, 1.0, 1.0, 2.0, 2.0]}


def test_histogram_counts_everything_once(spark):
    df = spark.createDataFrame([("a", [float(i) for i in range(101)], 4, "")], FRAME)
    rows = profile.histogram(df, ["image", "label"]).collect()
    image = {r["bucket"]: r["n"] for r in rows if r["feature"] == "image"}
    assert image == {**{b: 10 for b in range(9)}, 9: 11}
    assert [(r["bucket"], r["n"]) for r in rows if r["feature"] == "label"] == [(0, 1)]


def test_top_values_break_ties_by_value(spark):
    df = spark.createDataFrame([(None, x) for x in ["b", "b", "a", "a", "c", None]], "split string, x string")
    rows = profile.top_values(df, ["x"], 2).orderBy("rank").collect()
    assert [(r["value"], r["n"], r["n_distinct"]) for r in rows] == [("a", 2, 3), ("b", 2, 3)]


def test_top_values_cut_partitions_before_the_shuffle(spark):
    df = spark.range(1000).select(F.lit("s").alias("split"), F.col("id").cast("string").alias("x"))
    plan = profile.top_values(df, ["x"], 2)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_infer_schema(spark):
    df = spark.createDataFrame([("a", [1.0, 2.0], 1, ""), ("b", [1.0, 5.0], None, "")], FRAME)
    got = {r["feature"]: r for r in constraints.infer_schema(
        df, profile.feature_stats_wide(df, ["image", "label"])).collect()}
    assert (got["image"]["type"], got["image"]["size"], got["image"]["high"]) == ("FLOAT", 2, 5.0)
    assert (got["label"]["type"], got["label"]["min_fraction"]) == ("INT", 0.5)


def test_skew_of_equal_splits_is_zero_and_of_disjoint_ones_is_one(spark):
    def linf(eval_values):
        df = spark.createDataFrame([("train", [0.0, 1.0, 10.0], 0, ""), ("eval", eval_values, 0, "")], FRAME)
        rows = compare.split_skew(df, ["image"]).filter("stat = 'linf'").collect()
        return rows[0]["difference"]
    assert linf([0.0, 1.0, 10.0]) == 0.0
    assert linf([5.0, 5.0]) == 1.0


def test_byte_features(spark):
    df = spark.createDataFrame([("a", bytearray(b"xy")), ("a", bytearray(b"xy")), ("a", None), (None, bytearray(b""))],
                               "split string, payload binary")
    got = {r["split"]: r for r in profile.bytes_stats(df, ["payload"]).collect()}
    assert (got["a"]["num_rows"], got["a"]["num_missing"], got["a"]["n_distinct"], got["a"]["avg_length"]) == (3, 1, 1, 2)
    assert (got[None]["num_rows"], got[None]["n_distinct"]) == (1, 1)
    top = profile.top_values(df.filter("split = 'a'"), ["payload"], 1).first()
    assert top["n"] == 2 and len(top["value"]) == 32


@pytest.mark.parametrize("far", [1e8, 1e10, -1e10, 0.0])
def test_deviation_does_not_depend_on_the_mean(spark, far):
    rows = [("s", [far + (i + j) % 2 for j in range(i % 7 * 2 + 2)], far + i % 2) for i in range(400)]
    df = spark.createDataFrame(rows, "split string, x array<double>, y double").repartition(7)
    got = profile.feature_stats_wide(df, ["x", "y"], median=None).collect()
    assert len(got) == 2 and all(abs(r["std_dev"] - 0.5) < 1e-6 and abs(r["mean"] - far - 0.5) < 1e-4 for r in got)


def test_no_join_below_the_counts_and_blocks_of_ranges(spark, monkeypatch):
    df = spark.range(4000).select((F.col("id") % 300).cast("string").alias("split"), (F.col("id") * 1.0).alias("x"),
                                  F.array(F.col("id") * 1.0, F.lit(5.0)).alias("list"))
    found = profile.histogram(df, ["x", "list"], buckets=3, shared_range=False)
    plan = found._jdf.queryExecution().optimizedPlan().toString().split("Aggregate")
    assert len(plan) == 2 and "Join" not in plan[1] and "Generate" not in plan[1]
    whole = sorted(map(tuple, found.collect()))
    shared = sorted(map(tuple, profile.histogram(df, ["x"], buckets=3, shared_range=True).collect()))
    medians = sorted(map(tuple, profile.search_quantiles(df, ["x", "list"], "split", [0.2, 0.5]).collect()))
    monkeypatch.setattr(profile, "MAX_RANGES", 100)
    assert sorted(map(tuple, profile.histogram(df, ["x", "list"], buckets=3).collect())) == whole
    assert sorted(map(tuple, profile.histogram(df, ["x"], buckets=3, shared_range=True).collect())) == shared
    assert sorted(map(tuple, profile.search_quantiles(df, ["x", "list"], "split", [0.2, 0.5]).collect())) == medians
    assert sum(r[5] for r in whole) == 12_000 and len(medians) == 1200


def test_passes_do_not_grow_with_the_number_of_splits(spark, monkeypatch):
    inf, nan = float("inf"), float("nan")
    rows = [(None if i % 301 == 0 else "big" if i % 3 else str(i % 301), [5.0, inf, -inf, nan, None, -0.5][i % 29 % 6] if i % 29 < 6
             else float(i * 37 % 101), [float(i % 7)] * (i % 3) + [None] * (i % 2) if i % 11 else None) for i in range(6000)]
    df = spark.createDataFrame(rows, "split string, x double, list array<double>").repartition(5)
    ranks = [0.0, 0.3, 0.5, 1.0]

    def found() -> list:
        text = lambda d: sorted(map(str, d.collect()))
        return [text(profile.histogram(df, ["x", "list"], buckets=3)), text(profile.histogram(df, ["x", "list"], buckets=3, shared_range=True)),
                text(profile.search_quantiles(df, ["x", "list"], "split", ranks)),
                text(profile.feature_stats_wide(df, ["x"], median=profile.EXACT).select("split", "feature", "num_rows", "median", "max"))]

    want, counts, calls = found(), profile._counts, []
    monkeypatch.setattr(profile, "_counts", lambda *a: calls.append(1) or counts(*a))
    monkeypatch.setattr(profile, "MAX_RANGES", 20)
    monkeypatch.setattr("maskwright.operators.partials.PIECE", 50)
    assert found() == want and not calls  # all values of a split meet in a task
    monkeypatch.setattr(profile, "MOST_GATHERED", 100)
    assert found() == want and 0 < len(calls) <= 20  # the largest split is searched where its values are


def test_groups_beyond_a_task_are_passed_on(spark, monkeypatch):
    df = spark.range(2000).select((F.col("id") % 50).cast("string").alias("split"), F.array(F.col("id") * 1.0).alias("x"))
    rounded = lambda rows: sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows.collect())
    want = rounded(profile.feature_stats_wide(df, ["x"]))
    assert len(want) == 50 and {r[2] for r in want} == {40}
    monkeypatch.setattr("maskwright.operators.partials.MOST_GROUPS", 7)
    monkeypatch.setattr("maskwright.operators.partials.PIECE", 30)
    assert rounded(profile.feature_stats_wide(df, ["x"])) == want


@pytest.mark.parametrize("n", [1, 4096, 30_000, 400_000])
def test_sketches_keep_ranks(n):
    rng = np.random.default_rng(n)
    values = rng.permutation(n).astype(float)
    parts = []
    for some in np.array_split(values, 13):
        parts.append(partials.Sketch())
        for few in np.array_split(some, 5):
            parts[-1].merge([few])
    whole = partials.Sketch()
    for part in parts:
        whole.merge(partials.Sketch.unpacked(*part.packed()))
    ranks = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
    assert sum(len(x) << h for h, x in enumerate(whole.levels)) == n and sum(map(len, whole.levels)) < 20_000
    off = [abs(v - max(ceil(p * n) - 1, 0)) for v, p in zip(whole.quantiles(ranks), ranks)]
    assert max(off) <= (n / 1000 if n > 4096 else 0)


def test_schema_of_thousands_of_columns(spark):
    names = [f"c{i}" for i in range(3000)]
    df = spark.range(3).select(*[F.lit(1.0 if i % 2 else "x").alias(n) for i, n in enumerate(names)])
    stats = profile.feature_stats_wide(df.select(F.lit("a").alias("split"), *names[:9]), names[1:9:2])
    got = {r["feature"]: r["type"] for r in constraints.infer_schema(df, stats).collect()}
    assert got == {n: "FLOAT" for n in names[1:9:2]}


def test_sketched_top_values(spark):
    # one value holds a third of the rows, a hundred values a third, and the others are all different
    value = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, (F.col("id") % 100).cast("string"))
    df = spark.range(90_000).select(F.lit("s").alias("split"), F.coalesce(value, F.concat(F.lit("u"), F.col("id"))).alias("x"),
                                    F.when(F.col("id") % 2 == 0, F.lit("a" * 500)).alias("y"), F.lit(None).cast("string").alias("z"))
    found = profile.top_values_sketch(df, ["x", "y", "z"], 3, tracked=1000)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1 and "Join" not in plan and "Window" not in plan
    rows = {(r["feature"], r["rank"]): r for r in found.collect()}
    assert set(rows) == {("x", 1), ("x", 2), ("x", 3), ("y", 1)}
    hot = rows["x", 1]
    assert hot["value"] == "hot" and abs(hot["n"] - 30_000) <= hot["n_error"] and 0 < hot["n_error"] < 90_000 / 250
    assert abs(hot["n_distinct"] / 30_101 - 1) < 0.03
    assert (rows["y", 1]["n"], rows["y", 1]["n_error"], len(rows["y", 1]["value"])) == (45_000, 0, 32)
    stats = {r["feature"]: r for r in profile.bytes_stats(df, ["x", "z"], distinct=profile.SKETCH).collect()}
    exact = {r["feature"]: r for r in profile.bytes_stats(df, ["x", "z"]).collect()}
    assert abs(stats["x"]["n_distinct"] / exact["x"]["n_distinct"] - 1) < 0.03 and stats["z"]["n_distinct"] == 0
    assert stats["x"]["max_length"] == exact["x"]["max_length"] and stats["x"].asDict().keys() == exact["x"].asDict().keys()
    with pytest.raises(ValueError):
        profile.top_values_sketch(df, ["x"], 11, tracked=10)
