import base64
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from maskwright.functions import base64url, names
from maskwright.operators import gate, ordering, registry, requests, scoring, tensors
from maskwright.catalog.png import png_bytes
from maskwright.plans import dataset_run, publish_run, records_run
from maskwright.session import scratch_path
from maskwright.sources import images, tables, tfrecord
from maskwright.streaming.score import read_stream, score_stream


def test_base64_is_python_urlsafe_for_any_length(spark):
    rng = np.random.default_rng(0)
    payloads = [rng.integers(0, 256, n, dtype=np.uint8).tobytes() for n in (0, 1, 2, 3, 57, 58, 100, 5000)]
    df = spark.createDataFrame([(bytearray(p),) for p in payloads], "p binary").withColumn("c", base64url.encode(F.col("p")))
    rows = df.select("p", "c", base64url.decode(F.rtrim(F.col("c"), F.lit("="))).alias("back")).collect()
    assert all(r["c"] == base64.urlsafe_b64encode(bytes(r["p"])).decode() and r["back"] == r["p"] for r in rows)


def test_requests_round_trip(spark):
    df = spark.range(10).select("id", F.encode(F.concat(F.lit("p"), "id"), "UTF-8").alias("payload"))
    built = requests.build_requests(df, ["id"], "payload", 4, 1, "x")
    bodies = [json.loads(r["request"]) for r in built.orderBy("batch_id").collect()]
    assert [len(b["instances"]) for b in bodies] == [4, 4, 2] and set(bodies[0]["instances"][0]) == {"x"}
    back = requests.explode_requests(built.select("batch_id", "request"), field="x")
    assert sorted(bytes(r["payload"]) for r in back.collect()) == [f"p{i}".encode() for i in range(10)]


def test_responses_and_settings(spark):
    df = spark.createDataFrame([('{"predictions": [[1, 2], [3]], "model": "m"}', "{'app_path': 'a.b'}"), (None, None)],
                               "body string, conf string")
    rows = df.select(requests.parse_response(F.col("body")).alias("p"), requests.parse_config(F.col("conf")).alias("c")
                     ).collect()
    assert rows[0]["p"] == [[1.0, 2.0], [3.0]] and rows[0]["c"] == {"app_path": "a.b"}
    assert rows[1]["p"] is None and rows[1]["c"] is None
    nested = df.limit(1).select(requests.parse_response(F.lit('{"predictions": [[[1], [2]]]}'), "array<array<int>>"))
    assert nested.first()[0] == [[[1], [2]]]


def test_name_expressions(spark):
    row = spark.range(1).select(
        names.shard_name(F.lit("train"), F.lit(100), F.lit(5)).alias("long"),
        names.shard_name(F.lit("val"), F.lit(3), F.lit(32)).alias("short"),
        *names.shard_parts(F.lit("gs/x/my-set-07-12.tfrec")), names.stem(F.lit("a/b.c.png")).alias("stem"),
        names.stem(F.lit("a/.hidden")).alias("dot"), names.top_level(F.lit(".git/x/y")).alias("top"),
        names.version_name(F.lit(12.9)).alias("v"), names.dotted_to_path(F.lit("a.b.py")).alias("path")).first()
    assert row["long"] == "train-100-5.tfrec" and row["short"] == "val-03-32.tfrec"
    assert (row["split"], row["shard"], row["shard_size"]) == ("my-set", 7, 12)
    assert (row["stem"], row["dot"], row["top"], row["v"], row["path"]) == ("b.c", ".hidden", ".git", "v12", "a/b/py")


def test_centroids(spark):
    df = spark.createDataFrame([(0, [0.0, 0.0]), (0, [2.0, 0.0]), (5, [10.0, 10.0])], "label int, x array<float>")
    model = scoring.fit_centroids(df, "x", "label")
    assert model == scoring.CentroidModel((0, 5), ((1.0, 0.0), (10.0, 10.0)))
    got = df.select(model.predict(F.col("x")).alias("p")).collect()
    assert [r["p"] for r in got] == [0, 0, 5]
    image = spark.createDataFrame([([0.0, 0.0, 9.0, 9.0],), (None,)], "x array<float>")
    assert [r[0] for r in image.select(model.segment(F.col("x"))).collect()] == [[0, 5], None]
    logits = image.select(model.pixel_logits(F.col("x"))).first()[0]
    assert logits == [-1.0, -200.0, -(64.0 + 81.0), -2.0]
    with pytest.raises(ValueError, match="nothing to fit"):
        scoring.fit_centroids(df.limit(0), "x", "label")
    with pytest.raises(ValueError, match="differ in length"):
        scoring.fit_centroids(df.withColumn("x", F.slice("x", 1, F.col("label") % 2 + 1)), "x", "label")


def test_pixel_centroids_skip_nothing(spark):
    df = spark.createDataFrame([([1.0, 1.0, 3.0, 5.0], [0.0, 1.9])], "x array<float>, m array<float>")
    assert scoring.fit_pixel_centroids(df, "x", "m", 2) == scoring.CentroidModel((0, 1), ((1.0, 1.0), (3.0, 5.0)))


def test_model_size_is_checked(spark, monkeypatch):
    monkeypatch.setattr(scoring, "MAX_MODEL_CELLS", 3)
    df = spark.createDataFrame([(0, [0.0, 0.0]), (1, [2.0, 0.0])], "label int, x array<float>")
    with pytest.raises(ValueError, match="too many"):
        scoring.fit_centroids(df, "x", "label")


def test_stream_equals_batch(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.range(100).select("id", F.array(F.col("id").cast("float"), F.lit(50.0).cast("float")).alias("x")).repartition(
        4).write.parquet(source)
    model = scoring.CentroidModel((0, 1), ((0.0, 0.0), (100.0, 50.0)))
    score = lambda df: df.select("id", model.predict(F.col("x")).alias("p"))
    batch = spark.read.parquet(source)
    out = str(tmp_path / "out")
    for _ in range(2):  # the second run finds nothing new
        score_stream(read_stream(spark, source, batch.schema, files_per_trigger=1), score, out,
                     str(tmp_path / "state")).awaitTermination()
    assert sorted(spark.read.parquet(out).collect()) == sorted(score(batch).collect())


@pytest.mark.parametrize("single", [False, True])
def test_a_table_of_several_files_or_of_one_is_streamed(spark, tmp_path, single):
    rows = spark.range(60).select(F.col("id").alias("vec_id"), F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: (
        (F.col("id") * 7 + i * 5) % 11).cast("float")).alias("embedding"), F.lit(1).alias("label"))
    path = tmp_path / "embeddings.parquet"
    rows.repartition(1 if single else 3).write.parquet(str(tmp_path / "files" if single else path))
    if single:
        next((tmp_path / "files").glob("*.parquet")).rename(path)
    found = __spark_entry__.queries()["stream_score"](spark, str(tmp_path)).collect()
    held = rows.collect()
    assert len(found) == 60 * 16
    cells = {(r["vec_id"], r["px"]): r["cls"] for r in found}
    assert all(cells[r["vec_id"], p] == max(range(4), key=lambda c: (r["embedding"][4 * p + c], -c))
               for r in held for p in range(16))


def test_a_stream_without_rows_gives_no_rows(spark, tmp_path):
    kinds = "vec_id bigint, embedding array<float>, label int"
    spark.createDataFrame([], kinds).write.parquet(str(tmp_path / "embeddings.parquet"))
    assert __spark_entry__.queries()["stream_score"](spark, str(tmp_path)).collect() == []


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))

    class Cluster:
        class conf:
            get = staticmethod(lambda key, default=None: {"spark.master": "yarn"}.get(key, default))

        class sparkContext:
            getCheckpointDir = staticmethod(lambda: None)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(Cluster, "x")


def test_scratch_folders_can_be_cleared(spark):
    from pathlib import Path

    from maskwright.session import clear_scratch, materialise, scratch_count

    kept = materialise(spark.range(3), "kept")
    before = scratch_count(spark)
    gone = materialise(spark.range(5), "gone")
    scratch_path(spark, "never-written")
    files = [Path(f.removeprefix("file://")) for f in gone.inputFiles()]
    assert files and all(f.exists() for f in files)
    assert clear_scratch(spark, before) == 1 and scratch_count(spark) == before
    assert not any(f.exists() for f in files) and kept.count() == 3


def test_registry(spark, tmp_path):
    path = str(tmp_path / "registry")
    for seq, (kind, blessed) in enumerate([("Model", "1"), ("Model", "0"), ("Schema", "1")]):
        registry.append_record(spark, path, seq, kind, f"n{seq}", f"uri{seq}", {"blessed": blessed})
    table = registry.read_registry(spark, path)
    assert registry.by_type(table, "Model").count() == 2
    assert {r["type_name"]: r["uri"] for r in registry.latest(table, "type_name", "seq", "uri").collect()} == {
        "Model": "uri1", "Schema": "uri2"}
    flagged = registry.by_type(table, "Model").withColumn("ok", F.col("properties")["blessed"] == "1")
    assert registry.latest_blessed(flagged, "ok", "seq", "uri").first()["uri"] == "uri0"
    assert registry.latest_blessed(flagged.filter("seq = 1"), "ok", "seq", "uri").count() == 0


SCHEMA = """
feature { name: "image" type: FLOAT presence { min_fraction: 1.0 } float_domain { min: 0 max: 255 }
  shape { dim { size: 4 } dim { size: 4 } dim { size: 3 } } }
feature { name: "label" type: FLOAT presence { min_fraction: 1.0 } float_domain { min: 0 max: 2 }
  shape { dim { size: 4 } dim { size: 4 } } }
"""


def records(spark, path, noise):
    """Images whose pixels give their class away, except for a share of them."""
    rng = np.random.default_rng(5)
    rows = []
    for i in range(60):
        label = rng.integers(0, 3, 16)
        shown = np.where(rng.random(16) < noise, rng.integers(0, 3, 16), label)
        image = np.repeat(shown * 100, 3) + rng.integers(0, 20, 48)
        rows.append((i, image.astype(float).tolist(), [4, 4, 3], label.astype(float).tolist(), [4, 4]))
    df = spark.createDataFrame(rows, "id int, image array<float>, image_shape array<bigint>, label array<float>, "
                                     "label_shape array<bigint>")
    tfrecord.write_records(ordering.exact_split(df, ["id"], 0.25, 1), path, ["id"], 16)


def config(tmp_path, clock, data, **kwargs):
    return dataset_run.RunConfig(
        records=str(tmp_path / data), schema=str(tmp_path / "schema.pbtxt"), root=str(tmp_path / "root"),
        registry=str(tmp_path / "registry"), serving=str(tmp_path / "serving"), clock=clock, **kwargs)


def test_whole_run(spark, tmp_path):
    (tmp_path / "schema.pbtxt").write_text(SCHEMA)
    records(spark, str(tmp_path / "good"), 0.05)
    records(spark, str(tmp_path / "bad"), 0.9)

    app = tmp_path / "app"
    app.mkdir()
    (app / "app.py").write_text("$MODEL_REPO_ID $MODEL_VERSION")
    target = publish_run.PublishConfig("me", "seg", "https://models.example", str(tmp_path / "hub"),
                                       str(tmp_path / "registry"), app=str(app))
    first = dataset_run.run(spark, config(tmp_path, 1, "good", application=target))
    assert (tmp_path / "hub" / "app" / "version=v1" / "app.py").read_text() == "me/seg v1"
    assert first.application["pushed_version"] == "v1"
    assert {"linf", "mean"} <= {r["stat"] for r in first.comparison.collect()}
    assert first.blessed and first.pushed.endswith("version=v1") and first.anomalies.count() == 0
    assert first.checks.first()["baseline"] is None
    assert spark.read.parquet(first.pushed).count() == 3

    second = dataset_run.run(spark, config(tmp_path, 2, "good"))
    row = second.checks.first()
    assert second.blessed and row["baseline"] == pytest.approx(row["candidate"])

    third = dataset_run.run(spark, config(tmp_path, 3, "bad", application=target))
    assert not third.blessed and third.pushed is None and third.application == {"pushed": "0"}
    assert not (tmp_path / "hub" / "app" / "version=v3").exists()
    assert sorted(p.name for p in (tmp_path / "serving").iterdir()) == ["version=v1", "version=v2"]
    baseline = dataset_run.resolve_baseline(spark, str(tmp_path / "registry"))
    assert baseline == dataset_run.load_model(spark, str(tmp_path / "root" / "model" / "run=2"))
    pushed = registry.by_type(registry.read_registry(spark, str(tmp_path / "registry")), dataset_run.PUSHED)
    assert {r["seq"]: r["properties"]["pushed"] for r in pushed.collect()} == {1: "1", 2: "1", 3: "0"}
    known = registry.read_registry(spark, str(tmp_path / "registry"))
    stats = tables.read_stats(spark, registry.latest_uri(known, dataset_run.STATISTICS), "train")
    assert stats.filter("feature = 'label' and stat = 'num_rows'").first()["value"] == 45.0
    evaluation = tables.read_run(spark, registry.latest_uri(known, dataset_run.EVALUATION), 2)
    assert {r["model"] for r in evaluation.collect()} == {"candidate", "baseline"}
    assert registry.latest_uri(known, "Nothing") is None

    local = dataset_run.run(spark, config(tmp_path, 4, "good", patterns=tfrecord.FIRST_SHARDS))
    assert local.metrics.filter("model = 'candidate'").first()["n"] == 15 * 16


def test_a_version_is_never_overwritten(spark, tmp_path):
    snapshot = spark.range(3)
    assert registry.publish(snapshot, None, str(tmp_path / "s"), 5)
    with pytest.raises(Exception, match="already exists"):
        registry.publish(snapshot, None, str(tmp_path / "s"), 5)
    refused = spark.createDataFrame([(False,)], "blessed boolean")
    assert registry.publish(snapshot, refused, str(tmp_path / "s"), 6) is None
    record = registry.push_record(refused, 6, "me", "m", "https://models.example").first()
    assert record["pushed"] == 0 and record["repo_url"] is None
    assert gate.is_blessed(refused) is False


def test_logistic_regression_separates(spark):
    df = spark.range(40).select((F.col("id") % 2).alias("label"), F.array(
        (F.col("id") % 2 * 10).cast("float"), F.lit(1.0).cast("float")).alias("x"))
    model = scoring.fit_logistic(df, "x", "label", 20)
    assert scoring.score_logistic(model, df, "x").filter("pred != label").count() == 0


def test_preprocess_drops_shapes_and_keeps_keys(spark):
    df = spark.createDataFrame([(7, [255.0], [1, 1, 1], [2.0], [1, 1])],
                               "k int, image array<float>, image_shape array<bigint>, label array<float>, "
                               "label_shape array<bigint>")
    assert tensors.preprocess(df).first().asDict() == {"k": 7, "image_xf": [1.0], "label_xf": [2.0]}
    assert tensors.preprocess(df.drop("label")).columns == ["k", "image_xf"]


def test_publishing_an_application(spark, tmp_path):
    app = tmp_path / "apps" / "demo"
    (app / "sub").mkdir(parents=True)
    (app / "app.py").write_text('MODEL = "$MODEL_REPO_ID@$MODEL_VERSION"  # $MODEL_REPO_URL')
    (app / "sub" / "data.bin").write_bytes(b"$MODEL_VERSION\xff")
    (app / "empty.txt").write_text("")
    settings = publish_run.parse_settings("{'app_path': 'apps.demo'}")
    path = spark.range(1).select(names.dotted_to_path(F.lit(settings["app_path"]))).first()[0]
    base = dict(owner="me", name="seg", prefix="https://models.example/", destination=str(tmp_path / "out"),
                registry=str(tmp_path / "registry"))
    config = publish_run.PublishConfig(app=str(tmp_path / path), **base)
    first = publish_run.publish_version(spark, spark.range(3), None, config, 1)
    assert first["repo_id"] == "me/seg" and first["pushed_version"] == "v1"
    out = tmp_path / "out" / "app" / "version=v1"
    assert (out / "app.py").read_text() == 'MODEL = "me/seg@v1"  # https://models.example/me/seg'
    assert (out / "sub" / "data.bin").read_bytes() == b"$MODEL_VERSION\xff"
    assert (out / "empty.txt").read_bytes() == b""

    (out / ".gitattributes").write_text("kept")
    (app / "app.py").unlink()
    config = publish_run.PublishConfig(app=str(tmp_path / path), previous_app=str(out), **base)
    publish_run.publish_version(spark, spark.range(3), None, config, 2)
    second = tmp_path / "out" / "app" / "version=v2"
    assert {str(p.relative_to(second)) for p in second.rglob("*") if p.is_file()} == {
        ".gitattributes", "empty.txt", "sub/data.bin"}

    refused = spark.createDataFrame([(False,)], "blessed boolean")
    assert publish_run.publish_version(spark, spark.range(3), refused, config, 3) == {"pushed": "0"}
    assert not (tmp_path / "out" / "app" / "version=v3").exists()
    pushed = registry.by_type(registry.read_registry(spark, base["registry"]), "PushedModel").orderBy("seq").collect()
    assert [r["properties"]["pushed"] for r in pushed] == ["1", "1", "0"]
    assert pushed[0]["uri"] == "https://models.example/me/seg"


def test_pixel_softmax(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(40):  # a pixel's class hangs on its left neighbour: only a window sees that
        h, w = (4, 6) if i % 2 else (5, 3)
        image = rng.normal(size=(h, w, 2))
        mask = (np.concatenate([image[:, :1, 0], image[:, :-1, 0]], axis=1) > 0).astype(float) + 0.4
        mask[0, 0] = 9.0  # no class
        rows.append((image.ravel().tolist(), [h, w, 2], mask.ravel().tolist()))
    rows += [(None, [1, 1, 2], [0.0]), ([0.0, 0.0], [1, 1, 2], None)]
    df = spark.createDataFrame(rows, "image array<double>, shape array<bigint>, mask array<double>").repartition(3)

    def right(model):
        found = df.where("image is not null and mask is not null").select(
            "mask", model.segment(F.col("image"), F.col("shape")).alias("found")).collect()
        pairs = [(int(a), b) for r in found for a, b in zip(r["mask"], r["found"]) if a < 9]
        return sum(a == b for a, b in pairs) / len(pairs)

    wide, narrow = (scoring.fit_pixel_softmax(df, "image", "shape", "mask", [0, 1], w, 25) for w in (3, 1))
    assert right(wide) > 0.93 > 0.75 > right(narrow)
    assert list(wide.losses) == sorted(wide.losses, reverse=True) and abs(wide.losses[0] - np.log(2)) < 1e-9
    assert df.select(wide.segment(F.col("image"), F.col("shape")).alias("s")).where("s is null").count() == 1
    with pytest.raises(ValueError, match="no labelled pixels"):
        scoring.fit_pixel_softmax(df.where("mask is null"), "image", "shape", "mask", [0, 1])
    # the gradient is that of the loss
    weights = rng.normal(size=(2, 3))
    cells = scoring._gradient(df, [0, 1], 1, weights)
    moved = weights.copy()
    moved[1, 2] += 1e-5
    assert abs((scoring._gradient(df, [0, 1], 1, moved)[0] - cells[0]) / 1e-5 - cells[2:].reshape(2, 3)[1, 2]) < 1e-2


def test_two_runs_with_one_clock_value(spark, tmp_path):
    path = str(tmp_path / "registry")
    assert [registry.append_run(spark, path, [("Model", "m", f"uri{i}", {"run": "7"}), ("Schema", "s", "x", {})])
            for i in range(2)] == [1, 2]
    assert registry.latest_uri(registry.read_registry(spark, path), "Model") == "uri1"


def test_settings():
    assert publish_run.parse_settings(None) is None
    with pytest.raises(RuntimeError, match="app_path"):
        publish_run.parse_settings("{'space_sdk': 'x'}")


def test_run_tables(spark, tmp_path):
    path = str(tmp_path / "stats")
    for clock, value in ((1, 10.0), (2, 20.0)):
        tables.append_run(spark.createDataFrame([("train", "x", value), ("eval", "x", -value)],
                                                "split string, feature string, value double"), path, clock, "split")
    assert tables.read_stats(spark, path, "train").first()["value"] == 20.0
    assert tables.read_stats(spark, path, "eval", 1).first()["value"] == -10.0
    with pytest.raises(Exception, match="already exists"):
        tables.append_run(spark.range(1), path, 2)
    tables.write_transformed(spark.createDataFrame([("train", 1, [0.5], [1.0]), ("eval", 2, [0.1], [0.0])],
                                                   "split string, id int, image_xf array<float>, label_xf array<float>"),
                             str(tmp_path / "t"))
    row = tables.read_transformed(spark, str(tmp_path / "t"), "train").first()
    assert row["features"]["id"] == 1 and row["label"] == [1.0]
    assert tables.read_shuffled(spark, str(tmp_path / "t"), "eval", ["id"], 1).first()["id"] == 2


@pytest.mark.parametrize("encoding", ["numeric", "tensor"])
def test_images_to_records(spark, tmp_path, encoding):
    rng = np.random.default_rng(8)
    for name in range(25):
        for folder, pixels in (("i", rng.integers(0, 256, (4, 4, 3))), ("m", rng.integers(1, 4, (4, 4)))):
            (tmp_path / folder).mkdir(exist_ok=True)
            if (folder, name) != ("m", 7):
                (tmp_path / folder / f"{name}.png").write_bytes(png_bytes(pixels))
    out = str(tmp_path / "out")
    with pytest.raises(ValueError, match="1 files have no partner"):
        records_run.images_to_records(spark, str(tmp_path / "i"), str(tmp_path / "m"), out, image_suffix=".png")
    for target in (out, str(tmp_path / "again")):  # the same input gives the same shards
        records_run.images_to_records(spark, str(tmp_path / "i"), str(tmp_path / "m"), target, 0.25, 8, 2, 1, encoding,
                                      image_suffix=".png", strict=False)
    held = lambda name: {p.name: p.read_bytes() for p in (tmp_path / name).rglob("*") if p.is_file()}
    assert held("out") == held("again")
    assert sorted(p.name for p in (tmp_path / "out").glob("*.tfrec")) == [
        "train-00-8.tfrec", "train-01-8.tfrec", "train-02-2.tfrec", "val-00-6.tfrec"]
    rows = tfrecord.read_records(spark, out, encoding=encoding).collect()
    assert len(rows) == 24 and all(len(r["image"]) == 12 and len(r["label"]) == 4 for r in rows)
    assert all(0 <= v <= 2 for r in rows for v in r["label"]) and rows[0]["label_shape"] == [2, 2]


def test_pixels_cross_one_exchange(spark, tmp_path):
    for folder in ("i", "m"):
        (tmp_path / folder).mkdir()
        for name in range(6):
            (tmp_path / folder / f"{name}.png").write_bytes(png_bytes(np.full((2, 2), name + 1)))
    folders = [str(tmp_path / "i"), str(tmp_path / "m")]
    index = records_run.list_keys(spark, *folders, ".png", ".png").withColumn("split", F.lit("train"))
    sides = images.load_sides(spark, *folders, ".png", ".png").withColumn("split", F.lit("train"))
    halves = ["image", "image_shape", "label", "label_shape"]
    placed = ordering.shard_layout(sides, ["key"], 4, 1, index=index, halves=halves)
    above = placed._jdf.queryExecution().executedPlan().toString().split("Union")[0]  # what happens to rows with pixels
    assert above.count("Exchange") == 1 and "SortMergeJoin" not in above and "BroadcastHashJoin" in above
    rows = placed.collect()
    assert sorted((r["shard"], r["position"]) for r in rows) == [(0, 0), (0, 1), (0, 2), (0, 3), (1, 0), (1, 1)]
    assert all(r["image"] == [float(r["key"]) + 1] * 12 and r["label"] == [float(r["key"]) + 1] * 4 for r in rows)
    with pytest.raises(ValueError, match="need an index"):
        ordering.shard_layout(sides, ["key"], 4, 1, halves=halves)


def test_payloads_to_records(spark, tmp_path):
    rows = [((bytearray([i] * 12), f"x/{i}.raw"), (bytearray([i % 3] * 4), f"x/{i}.raw")) for i in range(10)]
    spark.createDataFrame(rows, "pixel_values struct<bytes:binary,path:string>, label struct<bytes:binary,path:string>"
                          ).write.parquet(str(tmp_path / "t"))
    records_run.payloads_to_records(spark, str(tmp_path / "t"), (2, 2), str(tmp_path / "out"))
    back = tfrecord.read_records(spark, str(tmp_path / "out")).collect()
    assert sorted(r["image"][0] for r in back) == [float(i) for i in range(10)]
    assert sorted({r["split"] for r in back}) == ["train", "val"] and {tuple(r["label_shape"]) for r in back} == {(2, 2)}
