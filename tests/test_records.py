import io
import struct
from collections import Counter
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from maskwright.operators import ordering
from maskwright.sources import record_format as fmt
from maskwright.sources import storage, tfrecord
from maskwright.sources.schema_text import Feature
from maskwright.sources.storage import list_files
from maskwright.streaming.score import score_stream


def bitwise_crc(data):
    state = 0xFFFFFFFF
    for byte in data:
        state ^= byte
        for _ in range(8):
            state = (state >> 1) ^ (fmt.POLYNOMIAL if state & 1 else 0)
    return state ^ 0xFFFFFFFF


def test_known_checksum():
    assert fmt.crc32c([b"123456789"])[0] == 0xE3069283


@settings(deadline=None, max_examples=50)
@given(st.lists(st.binary(max_size=700), max_size=6))
def test_checksums_match_the_bitwise_rule(messages):
    assert [int(c) for c in fmt.crc32c(messages)] == [bitwise_crc(m) for m in messages]


@settings(deadline=None, max_examples=50)
@given(st.lists(st.binary(min_size=1, max_size=300), max_size=5))
def test_frames_round_trip(messages):
    assert list(fmt.read_frames(io.BytesIO(fmt.frame(messages)))) == messages


def test_every_flipped_byte_is_noticed():
    good = fmt.frame([b"hello world", b"x" * 100])
    for at in range(len(good)):
        bad = bytearray(good)
        bad[at] ^= 0x10
        with pytest.raises((ValueError, OverflowError, MemoryError)):
            list(fmt.read_frames(io.BytesIO(bytes(bad))))
    with pytest.raises(ValueError, match="ends inside"):
        list(fmt.read_frames(io.BytesIO(good[:-3])))


def test_example_layout_is_the_public_one():
    """One float feature, written out by hand."""
    message = fmt.encode_example({"x": np.array([1.0], np.float32)})
    value = b"\x0a\x04" + struct.pack("<f", 1.0)
    feature = b"\x12" + bytes([len(value)]) + value
    entry = b"\x0a\x01x\x12" + bytes([len(feature)]) + feature
    inner = b"\x0a" + bytes([len(entry)]) + entry
    assert message == b"\x0a" + bytes([len(inner)]) + inner


def test_unpacked_lists_are_read_too():
    floats = b"\x0d" + struct.pack("<f", 2.5) + b"\x0d" + struct.pack("<f", 3.5)
    feature = b"\x12" + bytes([len(floats)]) + floats
    entry = b"\x0a\x01x\x12" + bytes([len(feature)]) + feature
    inner = b"\x0a" + bytes([len(entry)]) + entry
    got = fmt.decode_example(b"\x0a" + bytes([len(inner)]) + inner, {"x"})
    assert got["x"].tolist() == [2.5, 3.5]


def test_integers_and_bytes():
    got = fmt.decode_example(fmt.encode_example(
        {"i": np.array([0, 127, 128, -1, 2**62]), "b": b"\xff\x00", "skip": np.array([1.0])}), {"i", "b"})
    assert got["i"].tolist() == [0, 127, 128, -1, 2**62] and got["b"] == [b"\xff\x00"] and "skip" not in got


def test_tensor_bytes():
    values, shape = fmt.decode_tensor(fmt.encode_tensor(np.arange(6.0), [2, 3]))
    assert values.tolist() == [0, 1, 2, 3, 4, 5] and shape == [2, 3]
    with pytest.raises(ValueError, match="element type"):
        fmt.decode_tensor(b"\x08\x02")


def table(spark, n=70):
    return spark.range(n).select(
        "id", F.when(F.col("id") < 50, "train").otherwise("val").alias("split"),
        F.array(*[(F.col("id") + i).cast("float") for i in range(12)]).alias("image"),
        F.array(F.lit(2), F.lit(2), F.lit(3)).alias("image_shape"),
        F.array(*[(F.col("id") % 3).cast("int")] * 4).alias("label"),
        F.array(F.lit(2), F.lit(2)).alias("label_shape"))


def test_numeric_round_trip_names_and_columns(spark, tmp_path):
    path = str(tmp_path / "records")
    tfrecord.write_records(table(spark), path, ["id"], size=32, seed=1, keep_keys=True)
    names = [p.rsplit("/", 1)[1] for p, _ in list_files(path)]
    assert names == ["train-00-32.tfrec", "train-01-18.tfrec", "val-00-20.tfrec"]
    back = tfrecord.read_records(spark, path, "id bigint, split string, " + tfrecord.DEFAULT_SCHEMA.split(", ", 2)[2])
    wanted = tfrecord.example_columns(table(spark))
    assert back.select(*wanted.columns).exceptAll(wanted).count() == 0 and back.count() == 70
    default = tfrecord.read_records(spark, path)
    assert default.columns == ["split", "shard", "image", "image_shape", "label", "label_shape"]
    assert tfrecord.read_split(spark, path, "val").count() == 20
    with pytest.raises(ValueError, match="no split is called"):
        tfrecord.read_split(spark, path, "eval")


def test_shard_numbers_beyond_two_digits(spark, tmp_path):
    path = str(tmp_path / "records")
    tfrecord.write_records(table(spark, 50).limit(50).withColumn("split", F.lit("train")).select(
        "split", "image", F.posexplode(F.array_repeat("id", 3)).alias("copy", "id")), path, ["id", "copy"], size=1)
    names = {p.rsplit("/", 1)[1] for p, _ in list_files(path)}
    assert len(names) == 150 and "train-100-1.tfrec" in names and "train-07-1.tfrec" in names
    assert tfrecord.read_records(spark, path, "shard int").agg(F.max("shard")).first()[0] == 149
    first = tfrecord.import_splits(spark, path, {"train": "train-00-*.tfrec"}, schema="shard int, image array<float>")
    assert first.count() == 1


def test_tensor_encoding_carries_its_shape_and_missing_features_fail(spark, tmp_path):
    path = str(tmp_path / "records")
    tfrecord.write_records(table(spark), path, ["id"], encoding="tensor")
    back = tfrecord.read_records(spark, path, "image array<float>, image_shape array<bigint>", encoding="tensor")
    row = back.orderBy(F.col("image")[0]).first()
    assert row["image"] == [float(i) for i in range(12)] and row["image_shape"] == [2, 2, 3]
    with pytest.raises(Exception, match="no feature weight"):
        tfrecord.read_records(spark, path, "weight array<float>", encoding="tensor").collect()
    raw = tfrecord.read_records(spark, path, "image binary").first()["image"]
    assert fmt.decode_tensor(bytes(raw))[1] == [2, 2, 3]


def test_numeric_missing_features_are_empty(spark, tmp_path):
    path = str(tmp_path / "records")
    tfrecord.write_records(table(spark).drop("label"), path, ["id"])
    assert tfrecord.read_records(spark, path, "label array<float>").first()["label"] == []


def test_filters_on_split_and_shard_drop_files(spark, tmp_path):
    path = str(tmp_path / "records")
    tfrecord.write_records(table(spark), path, ["id"], size=8)
    tfrecord.register(spark)
    reader = spark.read.format("tfrecord").option("maxPartitionBytes", 1).schema("split string, shard int")
    assert reader.load(path).rdd.getNumPartitions() == 10
    some = reader.load(path).filter("split = 'train' and shard in (1, 3)")
    assert some.rdd.getNumPartitions() == 2 and some.count() == 16
    assert reader.load(path).filter("split = 'none'").count() == 0
    assert spark.read.format("tfrecord").load(path).rdd.getNumPartitions() == 1


def test_corrupt_shard_fails_unless_unverified(spark, tmp_path):
    path = tmp_path / "records"
    tfrecord.write_records(table(spark, 20), str(path), ["id"])
    shard = path / "train-00-20.tfrec"
    data = bytearray(shard.read_bytes())
    data[-5] ^= 1
    shard.write_bytes(bytes(data))
    with pytest.raises(Exception, match="checksum"):
        tfrecord.read_records(spark, str(path)).collect()
    assert tfrecord.read_records(spark, str(path), verify=False).count() == 20


def test_fixed_schema_checks_lengths(spark, tmp_path):
    path = str(tmp_path / "records")
    tfrecord.write_records(table(spark), path, ["id"])
    right = [Feature("image", "FLOAT", shape=(2, 2, 3)), Feature("label_shape", "INT", shape=(2,))]
    assert tfrecord.read_fixed(spark, path, right).filter(F.size("image") == 12).count() == 70
    with pytest.raises(Exception, match="declared shape"):
        tfrecord.read_fixed(spark, path, [Feature("image", "FLOAT", shape=(2, 2))]).collect()


def test_writer_refuses_rows_that_are_not_laid_out(spark, tmp_path):
    tfrecord.register(spark)
    with pytest.raises(Exception, match="shard_layout"):
        table(spark).write.format("tfrecord").mode("append").save(str(tmp_path / "a"))
    loose = spark.createDataFrame([("t", 0, 2, 1.0), ("t", 1, 1, 1.0), ("t", 0, 2, 2.0)],
                                  "split string, shard int, shard_size int, x float").coalesce(1)
    with pytest.raises(Exception, match="holds 1 records, not 2"):
        loose.write.format("tfrecord").mode("append").save(str(tmp_path / "b"))
    assert not list((tmp_path / "b").glob("*.tfrec")) if (tmp_path / "b").exists() else True


def test_import_by_split_pattern(spark, tmp_path):
    path = str(tmp_path / "records")
    tfrecord.write_records(table(spark), path, ["id"])
    counts = {r["split"]: r["count"] for r in tfrecord.import_splits(spark, path).groupBy("split").count().collect()}
    assert counts == {"train": 50, "eval": 20}
    counts = {r["split"]: r["count"] for r in
              tfrecord.import_splits(spark, path, tfrecord.FIRST_SHARDS).groupBy("split").count().collect()}
    assert counts == {"train": 32, "eval": 20}


def test_columns_may_be_wider_or_of_another_width_but_not_of_another_kind(spark, tmp_path):
    path = str(tmp_path / "records")
    tfrecord.write_records(table(spark, 10), path, ["id"], keep_keys=True)
    row = tfrecord.read_records(spark, path, "id int, image array<double>, label_shape array<int>").orderBy("id").first()
    assert row["id"] == 0 and row["image"][:3] == [0.0, 1.0, 2.0] and row["label_shape"] == [2, 2]
    with pytest.raises(Exception, match="holds float32 values, not array<int>"):
        tfrecord.read_records(spark, path, "label array<int>").collect()


def _plain(spark, n):
    return spark.range(n).select("id", F.lit("train").alias("split"), F.array(F.col("id").cast("float")).alias("image"))


def test_a_folder_is_written_once(spark, tmp_path):
    path = str(tmp_path / "shards")
    tfrecord.write_records(_plain(spark, 10), path, ["id"], 4, keep_keys=True)
    names = sorted(p.name for p in (tmp_path / "shards").iterdir())
    with pytest.raises(Exception, match="holds record shards already"):
        tfrecord.write_records(_plain(spark, 7), path, ["id"], 4, keep_keys=True)
    assert sorted(p.name for p in (tmp_path / "shards").iterdir()) == names
    assert tfrecord.read_records(spark, path, "id bigint").count() == 10


def test_a_failed_job_leaves_no_shard(spark, tmp_path):
    path = tmp_path / "shards"
    placed = _plain(spark, 40).select("split", (F.col("id") / 4).cast("int").alias("shard"), F.lit(4).alias("shard_size"),
                                      "image")
    broken = placed.repartition(1).sortWithinPartitions("shard").withColumn(
        "shard_size", F.when(F.col("shard") == 7, F.lit(5)).otherwise(F.col("shard_size")))
    tfrecord.register(spark)
    with pytest.raises(Exception, match="holds 4 records, not 5"):
        broken.write.format("tfrecord").mode("append").save(str(path))
    assert [p for p in path.iterdir() if p.suffix == ".tfrec"] == []


def test_an_unfinished_or_thinned_folder_is_refused(spark, tmp_path):
    path = tmp_path / "shards"
    tfrecord.write_records(_plain(spark, 20), str(path), ["id"], 4, keep_keys=True)
    read = lambda folder, **more: tfrecord.read_records(spark, str(folder), "id bigint", **more).agg(F.sum("id")).first()[0]
    assert read(path) == 190 and read(path / "train-0*") == 190 and read(path / "train-00-4.tfrec") < 190

    def copy(name, without=(), swap=()):
        folder = tmp_path / name
        folder.mkdir()
        for file in path.rglob("*.*"):
            inner = str(file.relative_to(path))
            if file.is_file() and inner not in without:
                target = folder / dict(zip(swap, reversed(swap))).get(inner, inner)
                target.parent.mkdir(exist_ok=True)
                target.write_bytes(file.read_bytes())
        return folder

    for folder, why in ((copy("unfinished", [tfrecord.MANIFEST, "train-03-4.tfrec"]), "no manifest"),
                        (copy("thinned", ["train-03-4.tfrec"]), "is missing"),
                        (copy("mixed", swap=["train-01-4.tfrec", "train-02-4.tfrec"]), "by its checksum")):
        with pytest.raises(Exception, match=why):
            read(folder)
        with pytest.raises(Exception, match="holds record shards already"):
            tfrecord.write_records(_plain(spark, 4), str(folder), ["id"], 4, keep_keys=True)
    short = copy("short")
    (short / "train-01-4.tfrec").write_bytes((path / "train-01-4.tfrec").read_bytes()[:-20])
    with pytest.raises(Exception, match="bytes, .* by the manifest"):
        read(short, verify=False)
    # other tools' folders have none
    assert read(tmp_path / "unfinished", manifest="ignore") < 190
    assert [s.records for s in tfrecord.read_manifest(str(path))] == [4] * 5


def test_the_manifest_is_the_last_file_of_a_job(spark, tmp_path):
    """A task that fails once leaves the same shards; until the job ends the folder cannot be read."""
    path, marks = tmp_path / "shards", tmp_path / "marks"
    marks.mkdir()
    placed = _plain(spark, 40).select("split", (F.col("id") / 4).cast("int").alias("shard"), F.lit(4).alias("shard_size"),
                                      "image")

    def look(batches):
        import os
        for batch in batches:
            open(f"{marks}/{os.path.exists(f'{path}/{tfrecord.MANIFEST}')}", "w").close()
            yield batch

    tfrecord.register(spark)
    watched = placed.repartition(1).sortWithinPartitions("shard").mapInArrow(look, placed.schema)
    watched.write.format("tfrecord").mode("append").save(str(path))
    assert [p.name for p in marks.iterdir()] == ["False"] and (path / tfrecord.MANIFEST).exists()
    assert tfrecord.read_records(spark, str(path), "image array<float>").count() == 40


def test_a_pattern_without_files_is_an_error(spark, tmp_path):
    path = str(tmp_path / "shards")
    tfrecord.write_records(_plain(spark, 5), path, ["id"], 4, keep_keys=True)
    with pytest.raises(Exception, match="no file matches"):
        tfrecord.read_split(spark, path, "val", schema="id bigint").count()
    with pytest.raises(Exception, match="no file matches"):
        tfrecord.import_splits(spark, path, {"train": "trian-*"}, schema="id bigint").count()


def test_folders_of_a_log_are_streamed_once(spark, tmp_path):
    root, out, checkpoint = (str(tmp_path / n) for n in ("log", "out", "checkpoint"))
    append = lambda low, high: tfrecord.append_records(
        _plain(spark, high).where(F.col("id") >= low), root, ["id"], size=4, keep_keys=True)

    def run():
        rows = tfrecord.read_record_stream(spark, root, "id bigint, split string, shard int")
        score_stream(rows, lambda df: df.withColumn("twice", F.col("id") * 2), out, checkpoint).awaitTermination()
        return sorted(r["id"] for r in spark.read.parquet(out).where("twice = id * 2").collect())

    append(0, 10)
    assert run() == list(range(10))
    assert run() == list(range(10))  # started anew, nothing arrived
    unfinished = tmp_path / "log" / "part-x"  # another job's, not finished and not in the log
    unfinished.mkdir()
    (unfinished / "train-00-4.tfrec").write_bytes(b"half")
    append(10, 17)
    append(17, 18)
    assert run() == list(range(18))
    assert tfrecord.read_records(spark, root, "id bigint").count() == 18
    assert tfrecord.logged(root, 1, 2) == tfrecord.logged(root)[1:2] and len(tfrecord.logged(root)) == 3


def test_claims_are_without_ties_and_gaps(spark, tmp_path):
    folder = str(tmp_path / "claims")
    with ThreadPoolExecutor(16) as pool:
        found = list(pool.map(lambda i: (storage.claim(spark, folder, str(i).encode()), i), range(200)))
    assert sorted(n for n, _ in found) == list(range(1, 201))
    assert all((tmp_path / "claims" / f"{n:012d}").read_text() == str(i) for n, i in found)
    assert len(storage.claimed(folder)) == 200 and storage.claimed(str(tmp_path / "none")) == []
    again = "file://" + folder
    assert storage.claim(spark, again) == 201 and len(list((tmp_path / "claims").iterdir())) == 201
    # the way of file systems that are not local
    (tmp_path / "one").write_text("1")
    (tmp_path / "two").write_text("2")
    place = lambda name: storage._placed(spark, None, "file://", str(tmp_path / name), str(tmp_path / "taken"))
    assert place("one") and not place("two") and (tmp_path / "taken").read_text() == "1" and (tmp_path / "two").exists()


def test_buffered_feed(spark, tmp_path):
    path = str(tmp_path / "records")
    tfrecord.write_records(_plain(spark, 203), path, ["id"], 8, keep_keys=True)
    small = {"schema": "id bigint, shard int"}
    found = tfrecord.feed(spark, path, 10, 2, 7, **small)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    rows = [tuple(r) for r in found.collect()]
    assert rows == [tuple(r) for r in tfrecord.feed(spark, path, 10, 2, 7, **small).collect()]
    assert rows != [tuple(r) for r in tfrecord.feed(spark, path, 10, 2, 8, **small).collect()]
    epochs = [[r for r in rows if r[2] == e] for e in (0, 1)]
    assert all(sorted(r[0] for r in e) == list(range(203)) for e in epochs)
    assert [r[0] for r in epochs[0]] != [r[0] for r in epochs[1]]
    sizes = Counter((r[2], r[3], r[4]) for r in rows)
    assert sorted(sizes.values()) == [3, 3] + [10] * 40
    first = [r[1] for r in epochs[0][:20]]  # several shards are mixed, but not all
    assert 3 < len(set(first)) < 20
    options = {"maxPartitionBytes": "300", "interleave": "3"}
    many = tfrecord.read_records(spark, path, "id bigint", options=options)
    assert many.rdd.getNumPartitions() > 3 and sorted(r[0] for r in many.collect()) == list(range(203))


@pytest.mark.parametrize("buffer", [1, 7, 5000])
def test_the_buffer_bounds_how_far_a_row_comes_forward(spark, buffer):
    df = spark.range(3000, numPartitions=2).withColumn("before", F.col("id") % 1500)
    rows = ordering.buffered_shuffle(df, buffer, 3).collect()
    assert sorted(r["id"] for r in rows) == list(range(3000)) and {r["stream"] for r in rows} == {0, 1}
    assert all(r["before"] - r["position"] <= buffer for r in rows)
    assert (buffer == 1) == all(r["before"] == r["position"] for r in rows)
    assert ordering.buffered_shuffle(df.limit(0), buffer, 3).count() == 0
    with pytest.raises(ValueError):
        ordering.buffered_shuffle(df, 0, 3)
