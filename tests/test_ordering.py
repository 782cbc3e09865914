import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from maskwright.operators import ordering, pairing


def order(seed, n):
    return sorted(range(n), key=lambda k: (hashlib.md5(f"{seed}:{k}".encode()).hexdigest(), k))


@pytest.mark.parametrize("n,fraction", [(1000, 0.2), (1000, 0.0), (1000, 1.0), (7, 0.5), (3, 0.2), (1, 0.9)])
def test_exact_split_takes_the_tail(spark, n, fraction):
    rows = ordering.exact_split(spark.range(n), ["id"], fraction, 7).collect()
    tail = order(7, n)[n - int(n * fraction):]
    assert {r["id"] for r in rows if r["split"] == "val"} == set(tail)
    assert len(rows) == n


def test_exact_split_digs_below_a_full_prefix(spark, monkeypatch):
    monkeypatch.setattr(ordering, "PREFIX", 1)
    rows = ordering.exact_split(spark.range(500), ["id"], 0.37, 1).filter("split = 'val'").collect()
    assert {r["id"] for r in rows} == set(order(1, 500)[500 - 185:])


def test_copies_of_a_key_are_counted_but_never_cut(spark):
    hot = spark.range(100).select(F.when(F.col("id") < 40, F.lit(5)).otherwise(F.col("id")).alias("k"))
    ranks = [k for k in order(1, 100) if k >= 40 or k == 5]
    sizes = [40 if k == 5 else 1 for k in ranks]
    outside = sum(sizes[ranks.index(5) + 1:])
    split = ordering.exact_split(hot, ["k"], (outside + 0.5) / 100, 1)
    assert split.filter("split = 'val'").count() == outside
    with pytest.raises(ValueError, match="both sides"):
        ordering.exact_split(hot, ["k"], (outside + 20.5) / 100, 1)


def test_split_is_a_row_expression(spark, tmp_path):
    spark.range(1000).write.parquet(str(tmp_path / "t"))
    split = ordering.exact_split(spark.read.parquet(str(tmp_path / "t")), ["id"], 0.2, 1)
    plan = split._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_empty_input(spark):
    empty = spark.range(0)
    assert ordering.exact_split(empty, ["id"], 0.2, 1).count() == 0
    assert ordering.global_rank(empty, ["id"], 1).count() == 0


def test_bucket_split_is_stable_as_data_grow(spark):
    small = {r["id"]: r["split"] for r in ordering.bucket_split(spark.range(100), ["id"], 0.2, 3).collect()}
    large = {r["id"]: r["split"] for r in ordering.bucket_split(spark.range(1000), ["id"], 0.2, 3).collect()}
    assert all(large[k] == v for k, v in small.items())
    assert 120 < sum(v == "val" for v in large.values()) < 280


def test_rank_equals_the_window_form_at_any_parallelism(spark):
    want = {k: i for i, k in enumerate(order(9, 3000))}
    for parts in (1, 8, 200):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        got = ordering.global_rank(spark.range(3000).repartition(5), ["id"], 9).collect()
        assert {r["id"]: r["rank"] for r in got} == want
    spark.conf.set("spark.sql.shuffle.partitions", 8)


def test_sorted_rank_uses_byte_order(spark):
    names = ["b.png", "B.png", "a10.png", "a2.png", "é.png"]
    df = spark.createDataFrame([(n,) for n in names], "name string").repartition(3)
    rows = ordering.sorted_rank(df, ["name"]).orderBy("rank").collect()
    assert [r["name"] for r in rows] == sorted(names, key=lambda n: n.encode())
    assert [r["rank"] for r in rows] == list(range(5))


@pytest.mark.parametrize("n,size,per_task", [(1000, 32, 1), (1000, 32, 3), (1000, 7, 16), (5, 32, 2), (64, 32, 1)])
def test_layout_places_rows_as_ranks_do(spark, n, size, per_task):
    df = spark.range(n).withColumn("split", F.when(F.col("id") % 3 == 0, "val").otherwise("train"))
    rows = ordering.shard_layout(df, ["id"], size, 4, shards_per_task=per_task).collect()
    assert len(rows) == n
    for split in ("train", "val"):
        wanted = [k for k in order(4, n) if (k % 3 == 0) == (split == "val")]
        got = {r["id"]: (r["shard"], r["position"], r["shard_size"]) for r in rows if r["split"] == split}
        assert got == {k: (i // size, i % size, min(size, len(wanted) - i // size * size))
                       for i, k in enumerate(wanted)}


def test_layout_keeps_a_shard_in_one_partition(spark):
    df = spark.range(5000).withColumn("split", F.lit("train"))
    placed = ordering.shard_layout(df, ["id"], 10, 4, shards_per_task=5).withColumn("p", F.spark_partition_id())
    assert placed.groupBy("shard").agg(F.count_distinct("p").alias("n")).filter("n > 1").count() == 0


def test_shard_plan(spark):
    df = spark.range(100).withColumn("split", F.lit("train"))
    plan = ordering.shard_plan(df, ["id"], 32, 0).orderBy("shard").collect()
    assert [r["records"] for r in plan] == [32, 32, 32, 4]


def test_epochs_reshuffle_and_eval_does_not(spark):
    def orders(shuffle):
        rows = ordering.epochs(spark.range(50), ["id"], 2, 10, 1, shuffle).collect()
        assert Counter((r["epoch"], r["batch_id"]) for r in rows) == {(e, b): 10 for e in (0, 1) for b in range(5)}
        return [{r["id"]: r["batch_id"] for r in rows if r["epoch"] == e} for e in (0, 1)]
    first, second = orders(True)
    assert first != second
    first, second = orders(False)
    assert first == second


def test_step_feed_repeats_short_data_and_cuts_long_data(spark):
    rows = ordering.step_feed(spark.range(10), ["id"], 4, 8, 1).collect()
    assert len(rows) == 32 and set(Counter(r["id"] for r in rows).values()) == {3, 4}
    assert len({(r["step"], r["position"]) for r in rows}) == 32
    long = ordering.step_feed(spark.range(1000), ["id"], 4, 8, 1).collect()
    assert {r["id"]: r["step"] * 8 + r["position"] for r in long} == {k: i for i, k in enumerate(order(1, 1000)[:32])}
    with pytest.raises(ValueError):
        ordering.step_feed(spark.range(0), ["id"], 1, 1, 1)


def test_split_names_are_checked():
    assert ordering.check_split("val") == "val"
    with pytest.raises(ValueError, match="no split is called"):
        ordering.check_split("eval")


def files(spark, names):
    return spark.createDataFrame([(n,) for n in names], "path string")


def test_listing_rules(spark):
    listed = pairing.list_files(files(spark, ["d/a.jpg", "d/.b.jpg", "d/c.JPG", "d/e.jpg.txt"]), ".jpg")
    assert [r["path"] for r in listed.collect()] == ["d/a.jpg"]
    assert pairing.list_files(files(spark, ["d/.b.jpg"]), ".jpg", allow_hidden=True).count() == 1


def test_pairing_by_key_survives_a_missing_file(spark):
    images = pairing.with_key(files(spark, ["i/a.jpg", "i/b.jpg", "i/c.x.jpg"])).withColumnRenamed("path", "image")
    masks = pairing.with_key(files(spark, ["m/b.png", "m/c.x.png", "m/z.png"])).withColumnRenamed("path", "mask")
    pairs = {r["image"]: r["mask"] for r in pairing.pair_by_key(images, masks, "key").collect()}
    assert pairs == {"i/b.jpg": "m/b.png", "i/c.x.jpg": "m/c.x.png"}
    left = {(r["key"], r["side"]) for r in pairing.orphans(images, masks, "key").collect()}
    assert left == {("a", "image"), ("z", "mask")}


def test_pairing_by_position_refuses_unequal_counts(spark):
    images = files(spark, ["a.jpg", "b.jpg"]).withColumnRenamed("path", "image")
    masks = files(spark, ["b.png"]).withColumnRenamed("path", "mask")
    with pytest.raises(ValueError, match="2 images but 1 masks"):
        pairing.pair_by_position(images, masks, "image", "mask")
    shifted = pairing.pair_by_position(images, masks, "image", "mask", strict=False).collect()
    assert [(r["image"], r["mask"]) for r in shifted] == [("a.jpg", "b.png")]


def test_rows_that_share_a_key_are_refused(spark):
    twice = spark.range(50).unionByName(spark.range(1)).withColumn("split", F.lit("train"))
    with pytest.raises(Exception, match="rows share the key"):
        ordering.global_rank(twice, ["id"], 1).collect()
    with pytest.raises(Exception, match="rows share the key"):
        ordering.shard_layout(twice, ["id"], 8, 1, shards_per_task=1).collect()


def test_ranked_rows_are_shuffled_once(spark):
    plan = ordering.global_rank(spark.range(10**6).withColumn("wide", F.repeat(F.lit("x"), 100)), ["id"], 1
                                )._jdf.queryExecution().executedPlan().toString()
    assert plan.count("wide") and plan.count("Exchange hashpartitioning(_bucket") == 2  # rows, and bucket counts


def test_layout_of_many_splits(spark):
    df = spark.range(400).withColumn("split", (F.col("id") % 40).cast("string"))
    rows = ordering.shard_layout(df, ["id"], 4, 1, shards_per_task=1, keep=["_task"]).collect()
    places = {(r["split"], r["shard"], r["position"]) for r in rows}
    assert len(places) == 400 and {r["shard"] for r in rows} == {0, 1, 2} and len({r["_task"] for r in rows}) == 120
    by_size = ordering.shard_layout(df, ["id"], 4, 1, row_bytes=ordering.TASK_BYTES, keep=["_task"])
    assert by_size.select("_task").distinct().count() == 120


def test_small_groups_of_shards_share_a_task(spark, monkeypatch):
    df = spark.range(400).withColumn("split", (F.col("id") % 40).cast("string"))
    layout = lambda: ordering.shard_layout(df, ["id"], 4, 1, shards_per_task=1, keep=["_task"])
    apart = {tuple(r) for r in layout().drop("_task").collect()}
    monkeypatch.setattr(ordering, "MAX_TASKS", 10)
    shared = layout()
    assert {tuple(r) for r in shared.drop("_task").collect()} == apart
    assert shared.select("_task").distinct().count() == shared.rdd.getNumPartitions() == 10
    monkeypatch.setattr(ordering, "TASK_RECORDS", 8)  # but no more records than that
    assert layout().select("_task").distinct().count() == 60


def test_epochs_rank_keys_and_join_the_rest(spark):
    df = spark.range(50).select(F.when(F.col("id") > 0, F.col("id")).alias("k"), F.col("id").alias("payload"))
    for shuffle in (True, False):
        rows = ordering.epochs(df, ["k"], 3, 8, 1, shuffle).collect()
        assert sorted((r["epoch"], r["payload"]) for r in rows) == [(e, p) for e in range(3) for p in range(50)]
        assert {r["batch_id"] for r in rows} == set(range(7))
    with pytest.raises(ValueError):
        ordering.epochs(df, ["k"], 0, 8, 1)
    with pytest.raises(ValueError):
        ordering.step_feed(df, ["k"], 0, 8, 1)


def test_null_groups_are_refused(spark):
    df = spark.range(10).withColumn("split", F.when(F.col("id") > 3, F.lit("train")))
    with pytest.raises(Exception, match="null in split"):
        ordering.global_rank(df, ["id"], 1, ["split"]).collect()
    with pytest.raises(Exception, match="null in split"):
        ordering.shard_layout(df, ["id"], 4, 1).collect()


def test_layout_has_a_task_per_group_and_one_wide_shuffle(spark):
    df = spark.range(1000).withColumn("split", F.lit("train")).withColumn("wide", F.repeat(F.col("id").cast("string"), 9))
    placed = ordering.shard_layout(df, ["id"], 10, 1, shards_per_task=5, keep=["_task"])
    assert placed.rdd.getNumPartitions() == 20
    where = placed.withColumn("p", F.spark_partition_id())
    assert where.filter("p <> _task").count() == 0 and where.select("p").distinct().count() == 20

    def exchanges(then):
        fresh = then(ordering.shard_layout(df, ["id"], 10, 1, shards_per_task=5, keep=["_task"]))
        return fresh._jdf.queryExecution().executedPlan().toString().count("Exchange ")
    assert exchanges(lambda f: f.groupBy("_task", "shard").agg(F.collect_list("wide"))) == exchanges(lambda f: f)
