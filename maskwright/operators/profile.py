"""Feature statistics, histograms and top values, per split.

A dataset is read once for its statistics, medians among them, and once more for each count of buckets. Where there are
list features each task reduces its rows on numpy to one row per split and feature (``partials``), and these merge by
key; plain features alone are reduced by Spark's own aggregates. No value is unrolled into a row of its own or joined.
Ranges and intervals go to the tasks as a table of bounds for up to ``MAX_RANGES`` pairs of split and feature. With more
of them, the rows of all splits but the largest are brought together by split once, and a task has all values of a
split at hand: the work does not grow with the number of splits.

Infinities are values: they show in the smallest, the median and the largest, and have buckets of their own in
histograms. Mean and deviation are those of the finite values.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from math import ceil, log2

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from maskwright.operators.partials import (
    MOMENT_COLUMNS, count_buckets, gather_buckets, gather_quantiles, merge_sorted, summarise)
from maskwright.session import materialise

SEARCH_BUCKETS = 1 << 16
SKETCH_ACCURACY = 10_000  # of plain features: ranks of a sketch are off by one in so many
MAX_RANGES = 50_000  # pairs of split and feature whose bounds a task is given at once
MOST_GATHERED = 1 << 20  # rows, and values of a feature, of a split that are brought together in one task
SKETCH_PARTS = 64  # tasks that first merge a feature's sketches
TRACKED = 10_000  # values that a sketch of the frequent ones counts
DISTINCT_BITS = 14  # a sketch of distinct values has two to that power of registers
LONG_VALUE = 128  # bytes of text that such a sketch holds as they are
EXACT, SKETCH = "exact", "sketch"
STATS = ["num_rows", "num_missing", "num_values", "min_size", "max_size", "avg_size", "mean", "std_dev",
         "num_zeros", "min", "median", "max"]
_INF = float("inf")


def _group(split: str | None) -> Column:
    return (F.col(split).cast("string") if split else F.lit("all")).alias("split")


def _is_list(df: DataFrame, feature: str) -> bool:
    return isinstance(df.schema[feature].dataType, T.ArrayType)


def _columns(df: DataFrame, features: Sequence[str], split: str | None) -> DataFrame:
    """Split, then one column per feature: lists as they are, plain ones as doubles."""
    return df.select(_group(split), *[
        (F.col(f) if _is_list(df, f) else F.col(f).cast("double")).alias(f"f{i}") for i, f in enumerate(features)])


def _same(*keys: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys])


def _summary(df: DataFrame, features: Sequence[str], split: str | None, ranks: Sequence[float] | None = None) -> DataFrame:
    """One row per split and feature, from one scan: counts, sizes, mean, std_dev, finite extremes, ``quantiles`` by sketch."""
    rows = _columns(df, features, split)
    if not any(_is_list(df, f) for f in features):
        return _plain_summary(rows, features, ranks)
    sketched = ranks is not None
    more = ", items binary, levels array<int>" if sketched else ""
    found = rows.mapInArrow(summarise(list(features), sketched), f"split string, feature string, {MOMENT_COLUMNS}{more}")

    def merged(parts: DataFrame, keys: list[str], kinds: str, at: Sequence[float] | None, more: str) -> DataFrame:
        return parts.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(
            merge_sorted(keys, at, sketched), f"{kinds}, {MOMENT_COLUMNS}{more}")

    keys, kinds = ["split", "feature"], "split string, feature string"
    if sketched:  # sketches are large enough to be merged by several tasks first
        found = found.withColumn("part", F.spark_partition_id() % SKETCH_PARTS)
        found = merged(found, [*keys, "part"], f"{kinds}, part int", None, more)
        more = ", quantiles array<double>"
    found = merged(found, keys, kinds, ranks, more)
    return found.withColumn("std_dev", F.sqrt(F.col("m2") / F.nullif("n", F.lit(0))))


def _plain_summary(rows: DataFrame, features: Sequence[str], ranks: Sequence[float] | None) -> DataFrame:
    found = []
    for i, f in enumerate(features):
        x = F.col(f"f{i}")
        number = F.when(~F.isnan(x), x)
        finite = F.when(F.abs(number) < F.lit(_INF), x)
        columns = {
            "num_rows": F.count(F.lit(1)), "num_missing": F.count_if(x.isNull()), "num_values": F.count(x),
            "sizes": F.count(x), "n": F.count(finite), "num_zeros": F.count_if(x == 0), "below": F.count_if(x == -_INF),
            "above": F.count_if(x == _INF), "min_size": F.min(F.when(x.isNotNull(), F.lit(1))).cast("bigint"),
            "max_size": F.max(F.when(x.isNotNull(), F.lit(1))).cast("bigint"), "mean": F.avg(finite),
            "std_dev": F.stddev_pop(finite), "least": F.min(finite), "most": F.max(finite)}
        if ranks is not None:
            columns["quantiles"] = F.percentile_approx(number, [float(r) for r in ranks], SKETCH_ACCURACY)
        found.append(F.struct(F.lit(f).alias("feature"), *[c.alias(name) for name, c in columns.items()]))
    return rows.groupBy("split").agg(F.array(*found).alias("found")).select("split", F.inline("found"))


def _parted(rows: DataFrame, summary: DataFrame) -> tuple[Iterator[list], DataFrame | None, DataFrame | None]:
    """Blocks of summary rows whose values are counted where they are; the rows of all other splits, each split's
    together and sorted by split; the whole summary, if it was written. The last two are None where there are few pairs.

    Splits are counted in blocks if they have more than ``MOST_GATHERED`` rows or values, so blocks grow with the
    data and not with the number of splits: one is full at a hundred thousand million values or more.
    """
    found = summary.limit(MAX_RANGES + 1).collect()
    if len(found) <= MAX_RANGES:
        return iter([found]), None, None
    whole = materialise(summary, "summary")
    size = F.max(F.greatest("num_rows", "sizes"))
    large = materialise(whole.groupBy("split").agg(size.alias("size"), F.count(F.lit(1)).alias("pairs")).where(
        F.col("size") > MOST_GATHERED), "large-splits")
    pairs = large.agg(F.coalesce(F.sum("pairs"), F.lit(0))).first()[0]
    n = ceil(pairs / (MAX_RANGES / 2))
    of_large = whole.alias("l").join(large.alias("r"), _same("split"), "left_semi")
    blocks = (of_large.where(F.pmod(F.xxhash64("split"), F.lit(n)) == block).collect() for block in range(n))
    small = rows.alias("l").join(large.alias("r"), _same("split"), "left_anti") if pairs else rows
    return blocks, small.repartition("split").sortWithinPartitions("split"), whole


def _joined(parts: list[DataFrame], name: str) -> DataFrame:
    return parts[0] if len(parts) == 1 else reduce(DataFrame.unionByName, [materialise(p, name) for p in parts])


def _counts(rows: DataFrame, features: Sequence[str], ranges: dict, buckets: int) -> DataFrame:
    found = rows.mapInArrow(count_buckets(list(features), ranges, buckets),
                            "id bigint, bucket int, n bigint, least double, most double")
    return found.groupBy("id", "bucket").agg(F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most"))


def search_quantiles(df: DataFrame, features: Sequence[str], split: str | None, ranks: Sequence[float]) -> DataFrame:
    """Exact order statistics: ``(split, feature, rank, value)``, computed when called.

    The value at a rank is the one ``ceil(rank * n)`` places up the sorted values. It is searched for: count the
    values in 65,536 equal buckets, go on inside the bucket that holds the rank, narrowed to its own smallest
    and largest value, until one value is left. The smallest and the largest value of an interval never share a
    bucket, so every pass narrows it. Copies of a value and far outliers cost no memory, where ``percentile`` would
    hold every distinct value of a feature in one task. Whole-numbered pixels need one pass, measurements two or three.
    """
    return _search(df, features, split, ranks, _summary(df, features, split))[0]


def _search(df: DataFrame, features: Sequence[str], split: str | None, ranks: Sequence[float],
            summary: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The order statistics, and the summary to go on with: what was written, if it was."""
    spark, rows = df.sparkSession, _columns(df, features, split)
    ranks, parts = [float(r) for r in ranks], []
    blocks, others, whole = _parted(rows, summary)
    for some in blocks:
        wanted = {}  # by split, feature and rank: place, low, high
        for r in some:
            total = r.below + r.n + r.above
            for rank in ranks if total else ():
                place = max(ceil(rank * total), 1) - r.below
                low, high = (-_INF, -_INF) if place < 1 else (_INF, _INF) if place > r.n else (r.least, r.most)
                wanted[r.split, r.feature, rank] = (place, low, high)
        while open_ := {k: x for k, x in wanted.items() if x[1] < x[2]}:
            ids: dict = {}
            for (name, f, _), (_, low, high) in open_.items():
                ids.setdefault((name, f, low, high), len(ids))
            ranges: dict = {}
            for (name, f, low, high), i in ids.items():
                ranges.setdefault((name, f), []).append((i, low, high))
            counts = _counts(rows, features, ranges, SEARCH_BUCKETS).where(
                F.col("bucket").between(0, SEARCH_BUCKETS - 1))
            upto = F.sum("n").over(Window.partitionBy("id").orderBy("bucket"))
            asked = {(ids[name, f, low, high], place) for (name, f, _), (place, low, high) in open_.items()}
            places = spark.createDataFrame(sorted(asked), "id bigint, place bigint")
            hits = counts.withColumn("upto", upto).join(places, "id").where("place <= upto and place > upto - n")
            hit = {(r.id, r.place): (r.place - (r.upto - r.n), r.least, r.most) for r in hits.collect()}
            for (name, f, rank), (place, low, high) in open_.items():
                wanted[name, f, rank] = hit[ids[name, f, low, high], place]
        parts.append(spark.createDataFrame([(*k, low) for k, (_, low, _) in wanted.items()],
                                           "split string, feature string, rank double, value double"))
    if others is not None:
        parts.append(others.mapInArrow(gather_quantiles(list(features), ranks),
                                       "split string, feature string, rank double, value double"))
    return _joined(parts, "quantiles"), summary if whole is None else whole


def feature_stats_wide(df: DataFrame, features: Sequence[str], split: str | None = "split",
                       median: str | None = SKETCH) -> DataFrame:
    """Numeric statistics, one row per split and feature. A null or empty list is a missing row.

    One pass gives all of them. The median as a ``sketch`` is off by one rank in 10,000 at most, or with list features
    by one in 1,000 (with 99 % confidence); ``exact`` takes several passes more; None leaves it out.
    """
    if median not in (None, EXACT, SKETCH):
        raise ValueError(f"unknown kind of median: {median}")
    rows = _summary(df, features, split, [0.5] if median == SKETCH else None)
    if median == EXACT:
        medians, rows = _search(df, features, split, [0.5], rows)
    some, least, most = F.col("n") > 0, F.col("least"), F.col("most")
    held = F.col("num_rows") - F.col("num_missing")
    size = lambda c: F.when(held > 0, F.col(c)).cast("int")
    wide = rows.select(
        "split", "feature", "num_rows", "num_missing", "num_values", size("min_size").alias("min_size"),
        size("max_size").alias("max_size"), F.when(held > 0, F.col("sizes") / held).alias("avg_size"),
        F.when(some, F.col("mean")).alias("mean"), "std_dev", "num_zeros",
        F.when(F.col("below") > 0, F.lit(-_INF)).when(some, least).when(F.col("above") > 0, F.lit(_INF)).alias("min"),
        (F.get("quantiles", F.lit(0)) if median == SKETCH else F.lit(None).cast("double")).alias("median"),
        F.when(F.col("above") > 0, F.lit(_INF)).when(some, most).when(F.col("below") > 0, F.lit(-_INF)).alias("max"))
    if median != EXACT:
        return wide
    medians = medians.select("split", "feature", F.col("value").alias("median"))
    columns = [F.col("r.median") if c == "median" else F.col(f"l.{c}") for c in STATS]
    return wide.alias("l").join(medians.alias("r"), _same("split", "feature"), "left").select(
        "l.split", "l.feature", *columns)


def to_long(stats: DataFrame, names: Sequence[str] = STATS) -> DataFrame:
    """(split, feature, stat, value) rows; statistics without a value are left out."""
    pairs = F.array(*[F.struct(F.lit(n).alias("stat"), F.col(n).cast("double").alias("value")) for n in names])
    return stats.select("split", "feature", F.inline(pairs)).filter(F.col("value").isNotNull())


def feature_stats(df: DataFrame, features: Sequence[str], split: str | None = "split",
                  median: str | None = SKETCH) -> DataFrame:
    return to_long(feature_stats_wide(df, features, split, median))


def histogram(df: DataFrame, features: Sequence[str], split: str | None = "split", buckets: int = 10,
              shared_range: bool = False) -> DataFrame:
    """Equal-width histogram: ``(split, feature, bucket, low, high, n)`` for buckets that hold values.

    The range is that of the split, or of all splits with ``shared_range``. The last bucket
    includes the maximum; a feature with one value has everything in bucket 0. The range is finite: infinities
    are counted in bucket -1 and in the one after the last. Ranges are found when called, the counts are not.
    """
    parts, spark, rows = [], df.sparkSession, _columns(df, features, split)
    blocks, others, whole = _parted(rows, _summary(df, features, split))
    extent = lambda some: (min((r.least for r in some if r.n), default=_INF), max((r.most for r in some if r.n), default=-_INF))
    over = shared = None
    if shared_range and whole is not None:
        over = whole.where("n > 0").groupBy("feature").agg(
            F.lit(1).alias("n"), F.min("least").alias("least"), F.max("most").alias("most")).collect()
        shared = {f: extent([x for x in over if x.feature == f]) for f in features}
    columns = ["split", "feature", "bucket", "lo", "hi", "n"]
    for summary in blocks:
        if not shared_range:
            bounds = {(r.split, r.feature): extent([r]) for r in summary}
        else:
            bounds = {(r.split, r.feature): extent([x for x in over or summary if x.feature == r.feature]) for r in summary}
        known = [(i, *key, *bound) for i, (key, bound) in enumerate(bounds.items())]
        ranges = {(name, f): [(i, lo, hi)] for i, name, f, lo, hi in known}
        counts = _counts(rows, features, ranges, buckets)
        names = spark.createDataFrame([(i, name, f, *((lo, hi) if lo <= hi else (None, None))) for i, name, f, lo, hi in known],
                                      "id bigint, split string, feature string, lo double, hi double")
        parts.append(counts.join(names, "id").select(columns))
    if others is not None:
        parts.append(others.mapInArrow(gather_buckets(list(features), buckets, shared),
                                       "split string, feature string, bucket int, lo double, hi double, n bigint"))
    counts = _joined(parts, "histogram")
    lo, hi, at, size = F.col("lo"), F.col("hi"), F.col("bucket"), F.lit(float(buckets))
    # halved where the width of a very wide range would not be finite
    width = F.when(hi - lo < F.lit(_INF), (hi - lo) / size).otherwise(hi / size - lo / size)
    low = F.when(at == -1, F.lit(-_INF)).when(at == buckets, hi).otherwise(lo + width * at)
    high = F.when(at == -1, lo).when(at == buckets, F.lit(_INF)).otherwise(lo + width * (at + 1))
    return counts.select("split", "feature", "bucket", low.alias("low"), high.alias("high"), "n")


def quantile_histogram(df: DataFrame, features: Sequence[str], split: str | None = "split",
                       buckets: int = 10) -> DataFrame:
    """Bucket edges at equal ranks: ``(split, feature, bucket, low, high)``, computed when called."""
    edges = search_quantiles(df, features, split, [i / buckets for i in range(buckets + 1)])
    found = edges.groupBy("split", "feature").agg(F.sort_array(F.collect_list(F.struct("rank", "value"))).alias("e"))
    rows = found.select("split", "feature", "e", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("bucket"))
    return rows.select("split", "feature", "bucket", F.get("e", F.col("bucket"))["value"].alias("low"),
                       F.get("e", F.col("bucket") + 1)["value"].alias("high"))


def _text(df: DataFrame, feature: str) -> Column:
    """A value as text; bytes are represented by their digest."""
    return F.md5(feature) if isinstance(df.schema[feature].dataType, T.BinaryType) else F.col(feature).cast("string")


def bytes_stats(df: DataFrame, features: Sequence[str], split: str | None = "split",
                distinct: str = EXACT) -> DataFrame:
    """Statistics of text and byte features: rows, missing, length in bytes, number of distinct values.

    Lengths of all features come from one scan. Distinct values are counted in two steps, by value and then per
    feature, so that no task sees them all; as a ``sketch`` they come from the same scan, with a standard error of 0.6 %.
    """
    if distinct not in (EXACT, SKETCH):
        raise ValueError(f"unknown kind of distinct count: {distinct}")
    found = []
    for f in features:
        length = F.octet_length(f)
        found.append(F.struct(
            F.lit(f).alias("feature"), F.count(F.lit(1)).alias("num_rows"), F.count_if(F.col(f).isNull()).alias("num_missing"),
            F.min(length).alias("min_length"), F.max(length).alias("max_length"), F.avg(length).alias("avg_length"),
            *([F.hll_sketch_estimate(F.hll_sketch_agg(f, DISTINCT_BITS)).alias("n_distinct")] if distinct == SKETCH else [])))
    sums = df.groupBy(_group(split)).agg(F.array(*found).alias("found")).select("split", F.inline("found"))
    if distinct == SKETCH:
        return sums
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), _text(df, f).alias("value")) for f in features])
    values = df.select(_group(split), F.inline(pairs)).filter(F.col("value").isNotNull())
    unique = values.groupBy("split", "feature", "value").agg(F.lit(1).alias("one")).groupBy("split", "feature").agg(
        F.count(F.lit(1)).alias("n_distinct"))
    return sums.alias("l").join(unique.alias("r"), _same("split", "feature"), "left").select(
        "l.*", F.coalesce("n_distinct", F.lit(0).cast("bigint")).alias("n_distinct"))


def _short(df: DataFrame, feature: str) -> Column:
    """A value as text; bytes and long texts are represented by their digest, so that sketches of them stay small."""
    text = _text(df, feature)
    return F.when(F.octet_length(text) > LONG_VALUE, F.md5(F.encode(text, "UTF-8"))).otherwise(text)


def top_values_sketch(df: DataFrame, features: Sequence[str], k: int, split: str | None = "split",
                      tracked: int = TRACKED) -> DataFrame:
    """About the same as ``top_values`` from one scan whose tasks pass on sketches, never a list of values.

    (split, feature, rank, value, n, n_error, n_distinct). Up to ``tracked`` values are counted at a time: with no more
    distinct values than that, counts are exact, and with more they are off by ``n_error`` at most, a fixed share of
    the rows (0.02 % for 10,000). Only values that are surely among the frequent ones are named. ``n_distinct`` has a
    standard error of 0.6 %. Nulls are left out; a split whose values are all null gives no row. Bytes, and texts of
    more than 128 bytes, are reported by their digest.
    """
    if not 0 < k <= tracked:
        raise ValueError("k must lie between 1 and the number of tracked values")
    table = 1 << ceil(log2(tracked / 0.75))  # counters are kept in a table of that size, three quarters full at most
    found = []
    for f in features:
        value = _short(df, f)
        n = F.count(value)
        found.append(F.struct(
            F.lit(f).alias("feature"), F.call_function("approx_top_k", value, F.lit(k + 1), F.lit(tracked)).alias("top"),
            F.floor(n * F.lit(3.5 / table)).alias("n_error"),
            F.hll_sketch_estimate(F.hll_sketch_agg(value, DISTINCT_BITS)).alias("n_distinct")))
    rows = df.groupBy(_group(split)).agg(F.array(*found).alias("found")).select("split", F.inline("found"))
    named = F.slice(F.array_sort(F.filter("top", lambda x: x["item"].isNotNull()), _more_frequent), 1, k)
    exact = F.col("n_distinct") * 1.05 < tracked
    return rows.select("split", "feature", F.posexplode(named).alias("at", "x"), "n_error", "n_distinct").select(
        "split", "feature", (F.col("at") + 1).alias("rank"), F.col("x.item").alias("value"), F.col("x.count").alias("n"),
        F.when(exact, F.lit(0).cast("bigint")).otherwise(F.col("n_error")).alias("n_error"), "n_distinct")


def _more_frequent(a: Column, b: Column) -> Column:
    by_value = F.when(a["item"] < b["item"], -1).when(a["item"] > b["item"], 1).otherwise(0)
    return F.when(a["count"] > b["count"], -1).when(a["count"] < b["count"], 1).otherwise(by_value)


def top_values(df: DataFrame, features: Sequence[str], k: int, split: str | None = "split") -> DataFrame:
    """The ``k`` most frequent values: ``(split, feature, rank, value, n, n_distinct)``, ties by value.

    Byte features are reported by the digest of the value.

    Counts are summed per value first and Spark cuts each partition to ``k`` rows before the ranking
    shuffle, so a feature with millions of distinct values does not land in one task.
    """
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), _text(df, f).alias("value")) for f in features])
    long = df.select(_group(split), F.inline(pairs)).filter(F.col("value").isNotNull())
    counts = long.groupBy("split", "feature", "value").agg(F.count(F.lit(1)).alias("n"))
    distinct = counts.groupBy("split", "feature").agg(F.count(F.lit(1)).alias("n_distinct"))
    order = Window.partitionBy("split", "feature").orderBy(F.desc("n"), "value")
    ranked = counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= F.lit(k))
    same = ranked["split"].eqNullSafe(distinct["split"]) & (ranked["feature"] == distinct["feature"])
    return ranked.join(distinct, same).select(
        ranked["split"], ranked["feature"], "rank", "value", "n", "n_distinct")
