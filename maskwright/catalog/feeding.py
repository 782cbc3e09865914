"""Order, splits, shards, batches, epochs, pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from maskwright.catalog.views import SEED, embeddings, sql_hash, sql_split, table
from maskwright.functions import names
from maskwright.operators import ordering, pairing

KEY = ["vec_id"]


def _ids(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings(spark, folder).select("vec_id")


def seeded_shuffle(spark: SparkSession, folder: str) -> DataFrame:
    return ordering.global_rank(table(spark, folder, "orders").select("o_orderkey"), ["o_orderkey"], SEED)


def seeded_order(spark: SparkSession, folder: str) -> DataFrame:
    """The position of every row in the sorted form of the shuffle."""
    rows = ordering.seeded_shuffle(table(spark, folder, "orders").select("o_orderkey"), ["o_orderkey"], SEED)
    return ordering.sorted_rank(rows.withColumn("_at", F.monotonically_increasing_id()), ["_at"]).drop("_at")


def split_exact(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "lang")
    return ordering.exact_split(documents, ["doc_id"], 0.2, SEED)


def split_exact_orders(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    return ordering.exact_split(orders, ["o_orderkey"], 0.2, SEED)


def split_bucket(spark: SparkSession, folder: str) -> DataFrame:
    return ordering.bucket_split(_ids(spark, folder), KEY, 0.2, SEED)


def _split_ids(spark: SparkSession, folder: str) -> DataFrame:
    return ordering.exact_split(_ids(spark, folder), KEY, 0.2, SEED)


def shard_plan(spark: SparkSession, folder: str) -> DataFrame:
    plan = ordering.shard_plan(_split_ids(spark, folder), KEY, 32, SEED)
    return plan.withColumn("name", names.shard_name(F.col("split"), F.col("shard"), F.col("records")))


def shard_ids(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_returnflag").alias("split"))
    keyed = lines.groupBy("l_orderkey", "l_linenumber", "split").agg(F.count(F.lit(1)).alias("copies"))
    return ordering.shard_ids(keyed, ["l_orderkey", "l_linenumber"], 1000, SEED)


def shard_layout(spark: SparkSession, folder: str) -> DataFrame:
    return ordering.shard_layout(_split_ids(spark, folder), KEY, 32, SEED, shards_per_task=2)


def shard_layout_many(spark: SparkSession, folder: str) -> DataFrame:
    """The same for forty splits."""
    rows = _ids(spark, folder).withColumn("split", F.concat(F.lit("s"), (F.col("vec_id") % 40).cast("string")))
    return ordering.shard_layout(rows, KEY, 4, SEED, shards_per_task=2)


def shard_names(spark: SparkSession, folder: str) -> DataFrame:
    plan = shard_plan(spark, folder).withColumn(
        "path", names.join_path(F.lit("records"), F.col("name"))).select("path")
    return plan.select("path", *names.shard_parts(F.col("path")))


def epoch_feed(spark: SparkSession, folder: str) -> DataFrame:
    return ordering.epochs(_ids(spark, folder), KEY, 3, 64, SEED)


def eval_feed(spark: SparkSession, folder: str) -> DataFrame:
    return ordering.epochs(_ids(spark, folder), KEY, 2, 64, SEED, shuffle=False)


def step_feed(spark: SparkSession, folder: str) -> DataFrame:
    """160 steps of 64 rows, with the data repeated as often as that takes."""
    return ordering.step_feed(_ids(spark, folder), KEY, 160, 64, SEED)


def take_first(spark: SparkSession, folder: str) -> DataFrame:
    return ordering.take(table(spark, folder, "documents").select("doc_id", "n_chars"), 5, ["doc_id"])


def batch_sizes(spark: SparkSession, folder: str) -> DataFrame:
    batches = ordering.shard_ids(_split_ids(spark, folder), KEY, 64, SEED, name="batch_id")
    return batches.groupBy("split", "batch_id").agg(F.count(F.lit(1)).alias("n"))


def _image_files(spark: SparkSession, folder: str) -> DataFrame:
    dot = F.when(F.col("doc_id") % 11 == 0, F.lit(".")).otherwise(F.lit(""))
    suffix = F.when(F.col("doc_id") % 7 == 0, F.lit(".JPG")).otherwise(F.lit(".jpg"))
    files = table(spark, folder, "documents").select(
        F.concat(F.lit("images/"), dot, F.col("doc_id").cast("string"), suffix).alias("image_path"))
    return pairing.with_key(pairing.list_files(files, ".jpg", "image_path"), "image_path")


def _mask_files(spark: SparkSession, folder: str) -> DataFrame:
    files = table(spark, folder, "labels").select(
        F.concat(F.lit("masks/"), F.col("doc_id").cast("string"), F.lit(".png")).alias("mask_path"))
    return pairing.with_key(pairing.list_files(files, ".png", "mask_path"), "mask_path")


def pair_by_key(spark: SparkSession, folder: str) -> DataFrame:
    return pairing.pair_by_key(_image_files(spark, folder), _mask_files(spark, folder), "key")


def pair_by_position(spark: SparkSession, folder: str) -> DataFrame:
    return pairing.pair_by_position(_image_files(spark, folder).drop("key"), _mask_files(spark, folder).drop("key"),
                                    "image_path", "mask_path", strict=False)


def orphans(spark: SparkSession, folder: str) -> DataFrame:
    return pairing.orphans(_image_files(spark, folder), _mask_files(spark, folder), "key")


QUERIES = {
    "seeded_shuffle": seeded_shuffle, "seeded_order": seeded_order, "shard_layout_many": shard_layout_many,
    "split_exact": split_exact, "split_exact_orders": split_exact_orders,
    "split_bucket": split_bucket, "shard_plan": shard_plan, "shard_ids": shard_ids, "shard_layout": shard_layout,
    "shard_names": shard_names, "epoch_feed": epoch_feed, "eval_feed": eval_feed, "step_feed": step_feed,
    "take_first": take_first, "batch_sizes": batch_sizes, "pair_by_key": pair_by_key,
    "pair_by_position": pair_by_position, "orphans": orphans,
}


def _exact(tbl: str, key: str, columns: str) -> str:
    ranked = (f"SELECT {columns}, row_number() OVER (ORDER BY {sql_hash(key)}, {key}) - 1 AS r, "
              f"count(*) OVER () AS n FROM {tbl}")
    cut = "n - CAST(floor(n * CAST(0.2 AS DOUBLE)) AS BIGINT)"
    return f"SELECT {columns}, CASE WHEN r >= {cut} THEN 'val' ELSE 'train' END AS split FROM ({ranked})"


_SPLIT_IDS = _exact("embeddings", "vec_id", "vec_id")
_PLACED = (f"SELECT vec_id, split, row_number() OVER (PARTITION BY split ORDER BY {sql_hash('vec_id')}, vec_id) - 1 "
           f"AS r, count(*) OVER (PARTITION BY split) AS n FROM ({_SPLIT_IDS})")
_PLAN = (f"SELECT split, CAST(r // 32 AS INTEGER) AS shard, count(*) AS records FROM ({_PLACED}) GROUP BY ALL")
_NAMED = f"SELECT *, split || '-' || printf('%02d', shard) || '-' || records || '.tfrec' AS name FROM ({_PLAN})"
_IMAGES = ("SELECT 'images/' || doc_id || '.jpg' AS image_path, CAST(doc_id AS VARCHAR) AS key FROM documents "
           "WHERE doc_id % 11 <> 0 AND doc_id % 7 <> 0")
_MASKS = "SELECT 'masks/' || doc_id || '.png' AS mask_path, CAST(doc_id AS VARCHAR) AS key FROM labels"


def _epochs(count: int, hashed: str) -> str:
    return (f"SELECT vec_id, epoch, CAST((row_number() OVER (PARTITION BY epoch ORDER BY {hashed}, vec_id) - 1) "
            f"// 64 AS INTEGER) AS batch_id FROM embeddings, "
            f"(SELECT CAST(unnest(range({count})) AS INTEGER) AS epoch)")


ORACLES = {
    "seeded_shuffle": f"SELECT o_orderkey, row_number() OVER (ORDER BY {sql_hash('o_orderkey')}, o_orderkey) - 1 "
                      "AS rank FROM orders",
    "seeded_order": f"SELECT o_orderkey, row_number() OVER (ORDER BY {sql_hash('o_orderkey')}, o_orderkey) - 1 "
                    "AS rank FROM orders",
    "shard_layout_many": f"""
SELECT vec_id, split, CAST(r // 4 AS INTEGER) AS shard, CAST(least(4, n - (r // 4) * 4) AS INTEGER) AS shard_size,
  CAST(r % 4 AS INTEGER) AS position FROM (SELECT vec_id, 's' || (vec_id % 40) AS split, count(*) OVER
    (PARTITION BY vec_id % 40) AS n, row_number() OVER (PARTITION BY vec_id % 40 ORDER BY {sql_hash('vec_id')}, vec_id) - 1
    AS r FROM embeddings)""",
    "split_exact": _exact("documents", "doc_id", "doc_id, lang"),
    "split_exact_orders": _exact("orders", "o_orderkey", "o_orderkey, o_orderstatus"),
    "split_bucket": f"SELECT vec_id, {sql_split('vec_id', 0.2, ('train', 'val'))} AS split FROM embeddings",
    "shard_plan": _NAMED,
    "shard_ids": f"""
SELECT l_orderkey, l_linenumber, split, copies, CAST((row_number() OVER (PARTITION BY split ORDER BY
  md5('{SEED}:' || l_orderkey || ':' || l_linenumber), l_orderkey, l_linenumber) - 1) // 1000 AS INTEGER) AS shard
FROM (SELECT l_orderkey, l_linenumber, l_returnflag AS split, count(*) AS copies FROM lineitem GROUP BY ALL)""",
    "shard_layout": f"SELECT vec_id, split, CAST(r // 32 AS INTEGER) AS shard, "
                    f"CAST(least(32, n - (r // 32) * 32) AS INTEGER) AS shard_size, "
                    f"CAST(r % 32 AS INTEGER) AS position FROM ({_PLACED})",
    "shard_names": f"SELECT 'records/' || name AS path, split, shard, CAST(records AS INTEGER) AS shard_size "
                   f"FROM ({_NAMED})",
    "epoch_feed": _epochs(3, f"md5('{SEED}:' || epoch || ':' || vec_id)"),
    "eval_feed": _epochs(2, sql_hash("vec_id")),
    "step_feed": f"""
SELECT vec_id, CAST(place // 64 AS INTEGER) AS step, CAST(place % 64 AS INTEGER) AS position FROM (
  SELECT vec_id, p.pass * n + r AS place FROM (
    SELECT vec_id, row_number() OVER (ORDER BY {sql_hash('vec_id')}, vec_id) - 1 AS r, count(*) OVER () AS n
    FROM embeddings), (SELECT unnest(range(10240)) AS pass) p
  WHERE p.pass * n + r < 10240)""",
    "take_first": "SELECT doc_id, n_chars FROM documents ORDER BY doc_id LIMIT 5",
    "batch_sizes": f"SELECT split, CAST(r // 64 AS INTEGER) AS batch_id, count(*) AS n FROM ({_PLACED}) GROUP BY ALL",
    "pair_by_key": f"SELECT * FROM ({_IMAGES}) JOIN ({_MASKS}) USING (key)",
    "pair_by_position": f"""
SELECT position, image_path, mask_path FROM
  (SELECT image_path, row_number() OVER (ORDER BY image_path) - 1 AS position FROM ({_IMAGES}))
  JOIN (SELECT mask_path, row_number() OVER (ORDER BY mask_path) - 1 AS position FROM ({_MASKS})) USING (position)""",
    "orphans": f"""
SELECT key, 'image' AS side FROM ({_IMAGES}) WHERE key NOT IN (SELECT key FROM ({_MASKS}))
UNION ALL SELECT key, 'mask' FROM ({_MASKS}) WHERE key NOT IN (SELECT key FROM ({_IMAGES}))""",
}
