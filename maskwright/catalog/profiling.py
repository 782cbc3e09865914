"""Statistics, histograms, schema checks, skew."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from maskwright.catalog.views import SEED, embeddings, sql_split, table
from maskwright.operators import compare, constraints, profile
from maskwright.operators.ordering import bucket_split
from maskwright.session import scratch_path
from maskwright.sources import tables
from maskwright.sources.schema_text import constraint_table, parse_schema

VECTORS = """
# what an embedding row should look like
feature {
  name: "embedding"
  type: FLOAT
  presence { min_fraction: 1.0 }
  float_domain { min: -0.4  max: 0.4 }
  shape { dim { size: 64 } }
}
feature {
  name: "label"
  type: INT
  presence { min_fraction: 1.0 }
  int_domain { min: 0  max: 8 }
  shape { dim { size: 1 } }
}
feature { name: "vec_id" type: FLOAT }
feature { name: "caption" type: BYTES presence { min_fraction: 0.5 } }
"""
LINES = """
feature { name: "l_quantity" type: FLOAT presence { min_fraction: 1.0 } float_domain { min: 1  max: 50 } }
feature { name: "l_discount" type: FLOAT presence { min_fraction: 1.0 } float_domain { max: 0.08 } }
feature { name: "l_linenumber" type: INT int_domain { min: 2 } shape { dim { size: 1 } } }
feature { name: "l_returnflag" type: BYTES presence { min_fraction: 1.0 } }
"""
VECTOR_FEATURES = ["embedding", "label"]
LINE_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _vectors(spark: SparkSession, folder: str) -> DataFrame:
    return bucket_split(embeddings(spark, folder), ["vec_id"], 0.2, SEED, ("train", "eval"))


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").withColumnRenamed("l_returnflag", "split")


def feature_stats(spark: SparkSession, folder: str) -> DataFrame:
    stats = profile.feature_stats(_vectors(spark, folder), VECTOR_FEATURES, median=profile.EXACT)
    return stats.withColumn("value", F.round("value", 5))


def feature_stats_lineitem(spark: SparkSession, folder: str) -> DataFrame:
    stats = profile.feature_stats(_lines(spark, folder), LINE_FEATURES, median=profile.EXACT)
    return stats.withColumn("value", F.round("value", 4))


def stats_readback(spark: SparkSession, folder: str) -> DataFrame:
    """Statistics written per split, then one split read back (only its folder is opened)."""
    path = scratch_path(spark, "statistics")
    tables.append_run(profile.feature_stats(_vectors(spark, folder), VECTOR_FEATURES, median=profile.EXACT), path, 1, "split")
    return tables.read_stats(spark, path, "train").select("feature", "stat", F.round("value", 5).alias("value"))


def feature_stats_parts(spark: SparkSession, folder: str) -> DataFrame:
    """One split per part: thousands of them."""
    rows = table(spark, folder, "lineitem").withColumnRenamed("l_partkey", "split")
    stats = profile.feature_stats(rows, LINE_FEATURES, median=profile.EXACT)
    return stats.withColumn("value", F.round("value", 4))


def _infinite(spark: SparkSession, folder: str) -> DataFrame:
    """Lines with an infinite value wherever there is no discount or no tax."""
    infinite = lambda sign: F.lit(sign * float("inf"))
    return _lines(spark, folder).select("split", F.when(F.col("l_discount") == 0, infinite(1)).when(
        F.col("l_tax") == 0, infinite(-1)).otherwise(F.col("l_extendedprice")).alias("x"))


def stats_infinite(spark: SparkSession, folder: str) -> DataFrame:
    stats = profile.feature_stats_wide(_infinite(spark, folder), ["x"], median=profile.EXACT)
    return stats.select("split", "num_values", F.round("mean", 4).alias("mean"), F.round("std_dev", 4).alias("std_dev"),
                        F.col("min").cast("string").alias("min"), F.round("median", 4).alias("median"),
                        F.col("max").cast("string").alias("max"))


def histogram_infinite(spark: SparkSession, folder: str) -> DataFrame:
    return profile.histogram(_infinite(spark, folder), ["x"]).select("split", "bucket", "n")


def histogram(spark: SparkSession, folder: str) -> DataFrame:
    rows = profile.histogram(_vectors(spark, folder), VECTOR_FEATURES)
    return rows.withColumns({"low": F.round("low", 6), "high": F.round("high", 6)})


def histogram_lineitem(spark: SparkSession, folder: str) -> DataFrame:
    rows = profile.histogram(_lines(spark, folder), LINE_FEATURES)
    return rows.withColumns({"low": F.round("low", 4), "high": F.round("high", 4)})


def quantiles(spark: SparkSession, folder: str) -> DataFrame:
    rows = profile.quantile_histogram(_vectors(spark, folder), VECTOR_FEATURES)
    return rows.withColumns({"low": F.round("low", 6), "high": F.round("high", 6)})


def topk_values(spark: SparkSession, folder: str) -> DataFrame:
    documents = bucket_split(table(spark, folder, "documents"), ["doc_id"], 0.2, SEED, ("train", "eval"))
    return profile.top_values(documents, ["lang", "source"], 3)


def topk_lineitem(spark: SparkSession, folder: str) -> DataFrame:
    return profile.top_values(_lines(spark, folder), ["l_partkey", "l_suppkey", "l_linestatus"], 5)


def topk_sketch(spark: SparkSession, folder: str) -> DataFrame:
    """Most frequent values and distinct counts by sketches, judged by exact counts: off by what was stated, at most."""
    rows, features = _lines(spark, folder), ["l_partkey", "l_suppkey", "l_linestatus"]
    found = profile.top_values_sketch(rows, features, 5, tracked=3000)
    exact = profile.top_values(rows, features, 5)
    same = found.alias("a").join(exact.alias("b"), ["split", "feature", "rank"])
    return same.select("split", "feature", "rank", (F.abs(F.col("a.n") - F.col("b.n")) <= F.col("n_error")).alias("near"),
                       (F.abs(F.col("a.n_distinct") / F.col("b.n_distinct") - 1) < 0.03).alias("near_distinct"))


def schema_infer(spark: SparkSession, folder: str) -> DataFrame:
    rows = _vectors(spark, folder)
    inferred = constraints.infer_schema(rows, profile.feature_stats_wide(rows, VECTOR_FEATURES, median=None))
    return inferred.withColumns({"low": F.round("low", 6), "high": F.round("high", 6)})


def schema_anomalies(spark: SparkSession, folder: str) -> DataFrame:
    return constraints.anomalies(_vectors(spark, folder), parse_schema(VECTORS))


def schema_anomalies_lineitem(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem")
    return constraints.anomalies(rows, parse_schema(LINES), "l_linestatus")


def bytes_stats(spark: SparkSession, folder: str) -> DataFrame:
    documents = bucket_split(table(spark, folder, "documents"), ["doc_id"], 0.2, SEED, ("train", "eval"))
    rows = profile.bytes_stats(documents, ["text", "lang", "source"])
    return rows.withColumn("avg_length", F.round("avg_length", 6))


def topk_bytes(spark: SparkSession, folder: str) -> DataFrame:
    """Most frequent byte values (whole texts, exact copies among them), by digest."""
    documents = table(spark, folder, "documents").select(
        F.col("lang").alias("split"), F.encode("text", "UTF-8").alias("payload"))
    return profile.top_values(documents, ["payload"], 4)


def inferred_check(spark: SparkSession, folder: str) -> DataFrame:
    """A schema inferred from rows of the lower labels, and what the rows of the others break of it."""
    rows = embeddings(spark, folder).withColumn("split", F.when(F.col("label") < 7, "train").otherwise("eval"))
    train = rows.filter("split = 'train'")
    features = constraints.inferred_features(
        constraints.infer_schema(train, profile.feature_stats_wide(train, VECTOR_FEATURES, median=None)))
    found = constraints.anomalies(rows.filter("split = 'eval'"), features)
    return found.select("split", "feature", "rule", "n_bad", "n_rows")


def schema_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Declared rules beside observed statistics."""
    declared = constraint_table(spark, parse_schema(VECTORS))
    stats = profile.feature_stats_wide(_vectors(spark, folder), VECTOR_FEATURES, median=None)
    # The rules are one row per declared feature.
    return stats.join(F.broadcast(declared), "feature").select(
        "split", "feature", "type", F.col("low").alias("declared_low"), F.round("min", 6).alias("seen_low"),
        F.col("high").alias("declared_high"), F.round("max", 6).alias("seen_high"))


def split_skew(spark: SparkSession, folder: str) -> DataFrame:
    rows = compare.split_skew(_vectors(spark, folder), VECTOR_FEATURES)
    return rows.select("feature", "stat", *[F.round(c, 5).alias(c)
                                            for c in ("left_value", "right_value", "difference")])


def _far_from_zero(spark: SparkSession, folder: str) -> DataFrame:
    """Values of ten thousand million and of one more, as lists and as plain ones: which, goes by a sign or a label."""
    far = lambda one: F.when(one, F.lit(1e10 + 1)).otherwise(F.lit(1e10))
    return _vectors(spark, folder).select(
        "split", F.transform("embedding", lambda v: far(v > 0)).alias("image"), far(F.col("label") % 2 == 0).alias("even"))


def stats_large_mean(spark: SparkSession, folder: str) -> DataFrame:
    """Deviations of values whose mean is ten thousand million times as large."""
    stats = profile.feature_stats_wide(_far_from_zero(spark, folder), ["image", "even"], median=None)
    return stats.select("split", "feature", F.round(F.col("mean") - 1e10, 4).alias("mean"), F.round("std_dev", 6).alias("std_dev"))


def skew_large_mean(spark: SparkSession, folder: str) -> DataFrame:
    """The same values of two splits side by side."""
    rows = compare.split_skew(_far_from_zero(spark, folder), ["image", "even"])
    return rows.where("stat in ('std_dev', 'median', 'linf')").select(
        "feature", "stat", F.round("left_value", 5).alias("left_value"), F.round("right_value", 5).alias("right_value"),
        F.round("difference", 5).alias("difference"))


def histogram_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Histograms of one split per part: thousands of ranges."""
    rows = table(spark, folder, "lineitem").withColumnRenamed("l_partkey", "split")
    found = profile.histogram(rows, ["l_quantity", "l_discount"], buckets=4)
    return found.withColumns({"low": F.round("low", 4), "high": F.round("high", 4)})


def median_sketch(spark: SparkSession, folder: str) -> DataFrame:
    """Is the sketched median of a list feature within a thousandth of the ranks, on either side of the exact one?"""
    rows = _vectors(spark, folder)
    found = profile.feature_stats_wide(rows, ["embedding"]).select("split", "median", "num_values")
    ranks = rows.join(F.broadcast(found), "split").groupBy("split", "num_values").agg(  # a row per split
        F.sum(F.size(F.filter("embedding", lambda v: v < F.col("median")))).alias("below"),
        F.sum(F.size(F.filter("embedding", lambda v: v <= F.col("median")))).alias("upto"))
    slack = F.col("num_values") / 1000 + 1
    half = F.col("num_values") / 2
    return ranks.select("split", "num_values", ((F.col("below") <= half + slack) & (F.col("upto") >= half - slack)).alias("near"))


QUERIES = {f.__name__: f for f in (
    topk_sketch, stats_large_mean, skew_large_mean, histogram_parts, median_sketch, feature_stats, feature_stats_lineitem, feature_stats_parts, stats_infinite, histogram_infinite, stats_readback, histogram, histogram_lineitem, quantiles, topk_values,
    topk_lineitem, schema_infer, schema_anomalies, schema_anomalies_lineitem, schema_rules, split_skew, bytes_stats,
    topk_bytes, inferred_check)}

_V = (f"SELECT *, {sql_split('vec_id')} AS split FROM embeddings")
_VECTOR_ROWS = (f"SELECT split, 'embedding' AS feature, len(embedding) AS size, embedding::DOUBLE[] AS list FROM ({_V}) "
                f"UNION ALL SELECT split, 'label', 1, [CAST(label AS DOUBLE)] FROM ({_V})")
_LINE_ROWS = " UNION ALL ".join(
    f"SELECT l_returnflag AS split, '{c}' AS feature, 1 AS size, [{c}] AS list FROM lineitem" for c in LINE_FEATURES)


def _long(rows: str) -> str:
    return f"SELECT split, feature, unnest(list) AS v FROM ({rows})"


def _wide(rows: str) -> str:
    return f"""
SELECT * FROM (SELECT split, feature, CAST(count(*) AS DOUBLE) AS num_rows,
    CAST(count(*) FILTER (WHERE list IS NULL) AS DOUBLE) AS num_missing, CAST(min(size) AS DOUBLE) AS min_size,
    CAST(max(size) AS DOUBLE) AS max_size, avg(size) AS avg_size FROM ({rows}) GROUP BY ALL)
JOIN (SELECT split, feature, CAST(count(v) AS DOUBLE) AS num_values, avg(v) AS mean, stddev_pop(v) AS std_dev,
    CAST(count(*) FILTER (WHERE v = 0) AS DOUBLE) AS num_zeros, min(v) AS min, quantile_disc(v, 0.5) AS median,
    max(v) AS max FROM ({_long(rows)}) GROUP BY ALL) USING (split, feature)"""


def _stats(rows: str, digits: int) -> str:
    names = ", ".join(profile.STATS)
    return (f"SELECT split, feature, stat, round(value, {digits}) AS value FROM "
            f"(UNPIVOT ({_wide(rows)}) ON {names} INTO NAME stat VALUE value)")


def _histogram(rows: str, digits: int, shared: bool = False, buckets: int = 10) -> str:
    part = "feature" if shared else "split, feature"
    return f"""
SELECT split, feature, bucket, round(lo + (hi - lo) / CAST({buckets} AS DOUBLE) * bucket, {digits}) AS low,
       round(lo + (hi - lo) / CAST({buckets} AS DOUBLE) * (bucket + 1), {digits}) AS high, count(*) AS n FROM (
  SELECT *, CAST(CASE WHEN hi = lo THEN 0
    ELSE least(floor((v - lo) / (hi - lo) * CAST({buckets} AS DOUBLE)), {buckets - 1}) END AS INTEGER) AS bucket FROM (
    SELECT split, feature, v, min(v) OVER (PARTITION BY {part}) AS lo, max(v) OVER (PARTITION BY {part}) AS hi
    FROM ({_long(rows)})))
GROUP BY split, feature, bucket, lo, hi"""


def _wide_skew(rows: str) -> str:
    """Two splits' statistics side by side, and the largest difference of their shares of a bucket."""
    stats = f"(UNPIVOT ({_wide(rows)}) ON {', '.join(profile.STATS)} INTO NAME stat VALUE value)"
    return f"""
SELECT feature, stat, a.value AS left_value, b.value AS right_value, a.value - b.value AS difference FROM
  (SELECT * FROM {stats} WHERE split = 'eval') a FULL JOIN
  (SELECT * FROM {stats} WHERE split = 'train') b USING (feature, stat)
UNION ALL
SELECT feature, 'linf', NULL, NULL, max(abs(a / ta - b / tb)) FROM (
  SELECT *, sum(a) OVER (PARTITION BY feature) AS ta, sum(b) OVER (PARTITION BY feature) AS tb FROM (
    SELECT feature, bucket, CAST(coalesce(sum(n) FILTER (WHERE split = 'eval'), 0) AS DOUBLE) AS a,
           CAST(coalesce(sum(n) FILTER (WHERE split = 'train'), 0) AS DOUBLE) AS b
    FROM ({_histogram(rows, 6, True)}) GROUP BY feature, bucket))
GROUP BY feature"""


def _top(rows: str, k: int) -> str:
    return f"""
SELECT split, feature, rank, value, n, n_distinct FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY split, feature ORDER BY n DESC, value) AS INTEGER) AS rank,
         count(*) OVER (PARTITION BY split, feature) AS n_distinct
  FROM (SELECT split, feature, value, count(*) AS n FROM ({rows}) WHERE value IS NOT NULL GROUP BY ALL))
WHERE rank <= {k}"""


_DOCUMENTS = f"SELECT *, {sql_split('doc_id')} AS split FROM documents"
_EDGES = " UNION ALL ".join(
    f"SELECT split, feature, {b} AS bucket, round(quantile_disc(v, {b / 10}), 6) AS low, "
    f"round(quantile_disc(v, {(b + 1) / 10}), 6) AS high FROM ({_long(_VECTOR_ROWS)}) GROUP BY split, feature"
    for b in range(10))
_BAD = """
SELECT split, feature, rule, expected, n_bad, n_rows FROM (
  SELECT split, count(*) AS n_rows, 'embedding' AS feature, 'domain' AS rule, '-0.4..0.4' AS expected,
    count(*) FILTER (WHERE list_min(embedding)::DOUBLE < -0.4 OR list_max(embedding)::DOUBLE > 0.4) AS n_bad
  FROM ({0}) GROUP BY split
  UNION ALL SELECT split, count(*), 'label', 'domain', '0..8', count(*) FILTER (WHERE label < 0 OR label > 8)
  FROM ({0}) GROUP BY split
  UNION ALL SELECT split, count(*), 'vec_id', 'type', 'FLOAT', count(*) FROM ({0}) GROUP BY split
  UNION ALL SELECT split, count(*), 'caption', 'missing', 'column', count(*) FROM ({0}) GROUP BY split)
WHERE n_bad > 0""".format(_V)
_LINE_BAD = """
SELECT split, feature, rule, expected, n_bad, n_rows FROM (
  SELECT l_linestatus AS split, count(*) AS n_rows, 'l_quantity' AS feature, 'domain' AS rule, '1..50' AS expected,
    count(*) FILTER (WHERE l_quantity < 1 OR l_quantity > 50) AS n_bad FROM lineitem GROUP BY ALL
  UNION ALL SELECT l_linestatus, count(*), 'l_discount', 'domain', '..0.08',
    count(*) FILTER (WHERE l_discount > CAST(0.08 AS DOUBLE)) FROM lineitem GROUP BY ALL
  UNION ALL SELECT l_linestatus, count(*), 'l_linenumber', 'domain', '2..',
    count(*) FILTER (WHERE l_linenumber < 2) FROM lineitem GROUP BY ALL)
WHERE n_bad > 0"""
_SKEW = _wide_skew(_VECTOR_ROWS)
_FAR_ROWS = (
    "SELECT split, 'image' AS feature, len(embedding) AS size, list_transform(embedding, lambda v: CASE WHEN v > 0 THEN "
    f"10000000001::DOUBLE ELSE 10000000000::DOUBLE END) AS list FROM ({_V}) UNION ALL SELECT split, 'even', 1, "
    f"[CASE WHEN label % 2 = 0 THEN 10000000001::DOUBLE ELSE 10000000000::DOUBLE END] FROM ({_V})")

_BYTES = " UNION ALL ".join(
    f"SELECT split, '{c}' AS feature, count(*) AS num_rows, count(*) FILTER (WHERE {c} IS NULL) AS num_missing, "
    f"CAST(min(octet_length(encode({c}))) AS INTEGER) AS min_length, "
    f"CAST(max(octet_length(encode({c}))) AS INTEGER) AS max_length, "
    f"round(avg(octet_length(encode({c}))), 6) AS avg_length, count(DISTINCT {c}) AS n_distinct "
    f"FROM ({_DOCUMENTS}) GROUP BY split" for c in ("text", "lang", "source"))
_BEYOND = """
WITH v AS (SELECT CASE WHEN label < 7 THEN 'train' ELSE 'eval' END AS split, list_min(embedding) AS lo,
    list_max(embedding) AS hi, label FROM embeddings),
t AS (SELECT min(lo) AS lo, max(hi) AS hi, min(label) AS a, max(label) AS b FROM v WHERE split = 'train'),
e AS (SELECT count(*) AS n_rows, count(*) FILTER (WHERE v.lo < t.lo OR v.hi > t.hi) AS far,
      count(*) FILTER (WHERE v.label < t.a OR v.label > t.b) AS odd FROM v, t WHERE split = 'eval')
SELECT 'eval' AS split, 'embedding' AS feature, 'domain' AS rule, far AS n_bad, n_rows FROM e WHERE far > 0
UNION ALL SELECT 'eval', 'label', 'domain', odd, n_rows FROM e WHERE odd > 0"""

_PART_ROWS = " UNION ALL ".join(
    f"SELECT CAST(l_partkey AS VARCHAR) AS split, '{c}' AS feature, 1 AS size, [{c}] AS list FROM lineitem"
    for c in LINE_FEATURES)
_INFINITE = ("SELECT l_returnflag AS split, CASE WHEN l_discount = 0 THEN 'infinity'::DOUBLE WHEN l_tax = 0 THEN "
             "'-infinity'::DOUBLE ELSE l_extendedprice END AS x FROM lineitem")

ORACLES = {
    "topk_sketch": "SELECT split, feature, rank, true AS near, true AS near_distinct FROM (" + _top(" UNION ALL ".join(
        f"SELECT l_returnflag AS split, '{c}' AS feature, CAST({c} AS VARCHAR) AS value FROM lineitem"
        for c in ("l_partkey", "l_suppkey", "l_linestatus")), 5) + ")",
    "stats_large_mean": f"""
SELECT split, feature, round(avg(v - 10000000000::DOUBLE), 4) AS mean, round(stddev_pop(v - 10000000000::DOUBLE), 6) AS std_dev
FROM ({_long(_FAR_ROWS)}) GROUP BY split, feature""",
    "skew_large_mean": f"SELECT feature, stat, round(left_value, 5) AS left_value, round(right_value, 5) AS right_value, "
                       f"round(difference, 5) AS difference FROM ({_wide_skew(_FAR_ROWS)}) "
                       "WHERE stat IN ('std_dev', 'median', 'linf')",
    "histogram_parts": _histogram(f"SELECT * FROM ({_PART_ROWS}) WHERE feature IN ('l_quantity', 'l_discount')", 4, buckets=4),
    "median_sketch": f"SELECT split, count(*) AS num_values, true AS near FROM ({_long(_VECTOR_ROWS)}) "
                     "WHERE feature = 'embedding' GROUP BY split",
    "feature_stats_parts": _stats(_PART_ROWS, 4),
    "stats_infinite": f"""
SELECT split, count(*) AS num_values, round(avg(x) FILTER (WHERE isfinite(x)), 4) AS mean,
  round(stddev_pop(x) FILTER (WHERE isfinite(x)), 4) AS std_dev, '-Infinity' AS min, round(quantile_disc(x, 0.5), 4) AS median,
  'Infinity' AS max FROM ({_INFINITE}) GROUP BY split""",
    "histogram_infinite": f"""
SELECT split, CASE x WHEN 'infinity'::DOUBLE THEN 10 WHEN '-infinity'::DOUBLE THEN -1
  ELSE CAST(least(floor((x - lo) / (hi - lo) * CAST(10 AS DOUBLE)), 9) AS INTEGER) END AS bucket, count(*) AS n
FROM (SELECT *, min(x) FILTER (WHERE isfinite(x)) OVER (PARTITION BY split) AS lo,
      max(x) FILTER (WHERE isfinite(x)) OVER (PARTITION BY split) AS hi FROM ({_INFINITE})) GROUP BY ALL""",
    "bytes_stats": _BYTES,
    "topk_bytes": _top("SELECT lang AS split, 'payload' AS feature, md5(text) AS value FROM documents", 4),
    "inferred_check": _BEYOND,
    "feature_stats": _stats(_VECTOR_ROWS, 5),
    "feature_stats_lineitem": _stats(_LINE_ROWS, 4),
    "stats_readback": f"SELECT feature, stat, value FROM ({_stats(_VECTOR_ROWS, 5)}) WHERE split = 'train'",
    "histogram": _histogram(_VECTOR_ROWS, 6),
    "histogram_lineitem": _histogram(_LINE_ROWS, 4),
    "quantiles": _EDGES,
    "topk_values": _top(f"SELECT split, 'lang' AS feature, lang AS value FROM ({_DOCUMENTS}) UNION ALL "
                        f"SELECT split, 'source', source FROM ({_DOCUMENTS})", 3),
    "topk_lineitem": _top(" UNION ALL ".join(
        f"SELECT l_returnflag AS split, '{c}' AS feature, CAST({c} AS VARCHAR) AS value FROM lineitem"
        for c in ("l_partkey", "l_suppkey", "l_linestatus")), 5),
    "schema_infer": """
SELECT 'embedding' AS feature, 'FLOAT' AS type, CAST(1 AS DOUBLE) AS min_fraction,
  round(min(list_min(embedding))::DOUBLE, 6) AS low, round(max(list_max(embedding))::DOUBLE, 6) AS high,
  CASE WHEN min(len(embedding)) = max(len(embedding)) THEN CAST(min(len(embedding)) AS INTEGER) END AS size FROM embeddings
UNION ALL SELECT 'label', 'INT', 1, min(label), max(label), 1 FROM embeddings""",
    "schema_anomalies": _BAD,
    "schema_anomalies_lineitem": _LINE_BAD,
    "schema_rules": f"""
SELECT split, feature, d.type, d.lo AS declared_low, round(min, 6) AS seen_low, d.hi AS declared_high,
  round(max, 6) AS seen_high FROM ({_wide(_VECTOR_ROWS)})
JOIN (VALUES ('embedding', 'FLOAT', -0.4::DOUBLE, 0.4::DOUBLE), ('label', 'INT', 0, 8)) d(feature, type, lo, hi)
USING (feature)""",
    "split_skew": f"SELECT feature, stat, round(left_value, 5) AS left_value, round(right_value, 5) AS right_value, "
                  f"round(difference, 5) AS difference FROM ({_SKEW})",
}
