import math

import pytest

from maskwright.operators import compare, gate, metrics

ACC = "SparseCategoricalAccuracy"


def rows(spark):
    return spark.createDataFrame(
        [([0.0, 1.0, 0.5, 2.0], [0, 1, 0, 1], "a", 1), ([2.0, 2.0], [2, 2], "b", 1), ([1.0, 1.0], [1, 0], None, 2)],
        "truth array<float>, pred array<int>, part string, day int")


def values(df):
    return {(r["slice_key"], r["slice_value"], r["metric"]): (r["value"], r["n"]) for r in df.collect()}


def test_accuracy_counts_pixels_and_fractions_never_match(spark):
    assert values(metrics.evaluate(rows(spark), "truth", "pred", [ACC])) == {("overall", "", ACC): (5 / 8, 8)}


def test_slices(spark):
    got = values(metrics.evaluate(rows(spark), "truth", "pred", [ACC], [(), ("part",), ("day", "part")]))
    assert got[("overall", "", ACC)] == (5 / 8, 8)
    assert got[("part", "a", ACC)] == (0.5, 4) and got[("part", "null", ACC)] == (0.5, 2)
    assert got[("day,part", "1,b", ACC)] == (1.0, 2)
    assert len(got) == 7


def test_confusion_trace_over_total_is_accuracy(spark):
    table = metrics.confusion(rows(spark), "truth", "pred").collect()
    total = sum(r["n"] for r in table)
    assert sum(r["n"] for r in table if r["label"] == r["pred"]) / total == 5 / 8 and total == 8


def test_cross_entropy_from_logits(spark):
    df = spark.createDataFrame([([1000.0, 0.0, 0.0, 0.0], [0.9, 1.0])], "logits array<float>, truth array<float>")
    metrics.register_metric("x2", metrics.cross_entropy(2))
    got = values(metrics.evaluate(df, "truth", "logits", ["x2"]))[("overall", "", "x2")]
    assert math.isclose(got[0], math.log(2) / 2) and got[1] == 2


def test_unknown_metric_and_size_mismatch(spark):
    with pytest.raises(ValueError, match="unknown metric"):
        metrics.evaluate(rows(spark), "truth", "pred", ["Nope"])
    bad = spark.createDataFrame([([1.0], [1, 2])], "truth array<float>, pred array<int>")
    with pytest.raises(Exception, match="differ in size"):
        metrics.evaluate(bad, "truth", "pred", [ACC]).collect()


def metric_table(spark, *items):
    return spark.createDataFrame([("overall", s, ACC, v, 10) for s, v in items],
                                 "slice_key string, slice_value string, metric string, value double, n bigint")


def decide(spark, candidate, baseline=None, **kwargs):
    rule = gate.Threshold(ACC, **kwargs)
    base = metric_table(spark, ("", baseline)) if baseline is not None else None
    return gate.is_blessed(gate.bless(gate.check(gate.compare(metric_table(spark, ("", candidate)), base), [rule])))


def test_value_threshold_is_inclusive(spark):
    assert decide(spark, 0.55, lower_bound=0.55) and not decide(spark, 0.5499, lower_bound=0.55)
    assert decide(spark, 0.55, upper_bound=0.55) and not decide(spark, 0.56, upper_bound=0.55)


def test_change_threshold_tolerates_a_small_loss_and_needs_a_baseline(spark):
    assert decide(spark, 0.6995, 0.70, absolute_change=-1e-3)
    assert not decide(spark, 0.698, 0.70, absolute_change=-1e-3)
    assert decide(spark, 0.1, absolute_change=-1e-3)


def test_lower_is_better_flips_the_sign(spark):
    assert decide(spark, 0.7005, 0.70, absolute_change=-1e-3, higher_is_better=False)
    assert not decide(spark, 0.72, 0.70, absolute_change=-1e-3, higher_is_better=False)


def test_value_rule_without_baseline_only(spark):
    assert decide(spark, 0.4, 0.4, lower_bound=0.55, value_rule="no_baseline")
    assert not decide(spark, 0.4, lower_bound=0.55, value_rule="no_baseline")
    with pytest.raises(ValueError):
        gate.Threshold(ACC, value_rule="sometimes")


def test_one_bad_slice_blocks_and_no_rows_block(spark):
    rule = gate.Threshold(ACC, lower_bound=0.5)
    two = gate.check(gate.compare(metric_table(spark, ("a", 0.9), ("b", 0.4)), None), [rule])
    assert gate.bless(two).first().asDict() == {"blessed": False, "checks": 2, "failed": 1}
    none = gate.check(gate.compare(metric_table(spark).limit(0), None), [rule])
    assert gate.bless(none).first()["blessed"] is False
    missing = gate.check(gate.compare(metric_table(spark, ("", None)), None), [rule])
    assert gate.bless(missing).first()["blessed"] is False
    assert gate.is_blessed(None)


def test_parity(spark):
    a = spark.createDataFrame([(1, [1.0, 2.0]), (2, [3.0]), (4, [])], "k int, v array<double>")
    b = spark.createDataFrame([(1, [1.0, 2.0]), (3, [3.0, 4.0]), (4, [])], "k int, v array<double>")
    got = compare.parity(a, b, "k", "v").first()
    assert (got["compared"], got["unmatched"], got["different"], got["equal"]) == (2, 3, 0, False)
    near = spark.createDataFrame([(1, [1.0, 2.0 + 1e-8])], "k int, v array<double>")
    assert compare.parity(near, b.filter("k = 1"), "k", "v").first()["equal"]
    far = spark.createDataFrame([(1, [1.0, 2.1])], "k int, v array<double>")
    assert compare.parity(far, b.filter("k = 1"), "k", "v").first()["different"] == 1


def test_every_rule_of_a_metric_holds(spark):
    def passed(candidate, base, *rules):
        compared = gate.compare(metric_table(spark, ("", candidate)), metric_table(spark, ("", base)))
        return gate.is_blessed(gate.bless(gate.check(compared, rules)))
    low, change = gate.Threshold(ACC, lower_bound=0.55), gate.Threshold(ACC, absolute_change=-1e-3)
    assert not passed(0.40, 0.40, low, change) and not passed(0.40, 0.40, change, low)
    assert not passed(0.60, 0.90, low, change) and passed(0.60, 0.60, low, change)
    assert not passed(0.9, 0.9, low, gate.Threshold("Other", lower_bound=0.0))
    assert not passed(float("nan"), 0.5, low)
    with pytest.raises(ValueError):
        gate.Threshold(ACC, slice_value="en")


def test_rules_for_one_slice(spark):
    compared = gate.compare(metric_table(spark, ("a", 0.9), ("b", 0.4)), None)
    key = compared.first()["slice_key"]
    def failed(*rules):
        return gate.bless(gate.check(compared, rules)).first()["failed"]
    assert failed(gate.Threshold(ACC, lower_bound=0.5, slice_key=key)) == 1
    assert failed(gate.Threshold(ACC, lower_bound=0.5, slice_key=key, slice_value="a")) == 0
    assert failed(gate.Threshold(ACC, lower_bound=0.5, slice_key=key, slice_value="c")) == 1  # finds no value


def test_parity_of_infinities(spark):
    inf, nan = float("inf"), float("nan")
    a = spark.createDataFrame([(1, [inf, -inf, nan, 1.0])], "k int, v array<double>")
    row = compare.parity(a, a, "k", "v").first()
    assert row["equal"] and row["different"] == 0 and row["max_abs"] == 0.0
    b = spark.createDataFrame([(1, [-inf, 1.0, 2.0, inf])], "k int, v array<double>")
    assert compare.parity(a, b, "k", "v").first()["different"] == 4
