"""Image files, record shards, text files, requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from maskwright.catalog.png import as_png
from maskwright.catalog.views import (
    ARGMAX, PIXELS, SEED, TRIMAP, images, masks, sql_hash, table)
from maskwright.functions import arrays, base64url, names
from maskwright.operators import constraints, filetree, ordering, requests
from maskwright.plans import records_run
from maskwright.session import scratch_path
from maskwright.sources import files as tree
from maskwright.sources import images as image_files
from maskwright.sources import palettes, schema_text, tfrecord
from maskwright.streaming.score import score_stream


def _colour(image) -> Column:
    """Each grey value as three channels that tell themselves apart."""
    return F.flatten(F.transform(image.cast("array<int>"), lambda v: F.array(v, 255 - v, v * 7 % 256)))


def _parts(pairs: DataFrame, *keep: str) -> DataFrame:
    """Values of images and masks, one row each."""
    parts = F.array(*[F.struct(F.lit(c).alias("part"), F.col(c).alias("values")) for c in ("image", "label")])
    rows = pairs.select(F.col("key").cast("bigint").alias("vec_id"), *keep, F.inline(parts))
    return rows.select("vec_id", *keep, "part", F.posexplode("values").alias("i", "v")).withColumn(
        "v", F.col("v").cast("int"))


def _spread(rows: DataFrame) -> DataFrame:
    """A narrow table may be a file or two, which few tasks would turn into files; rows of one name stay together."""
    return rows.repartition("vec_id")


def _image_files(spark: SparkSession, folder: str) -> str:
    """The embeddings as image and mask files."""
    root = scratch_path(spark, "images")
    name = F.format_string("%06d.png", F.col("vec_id"))
    rows = _spread(images(spark, folder))
    pictures = rows.select(F.concat(F.lit("images/"), name).alias("path"),
                           as_png(_colour(F.col("image")), 8, 8, 3).alias("content"))
    trimaps = rows.select(F.concat(F.lit("masks/"), name).alias("path"),
                          as_png(F.col("label").cast("array<int>"), 8, 8).alias("content"))
    tree.write_tree(pictures.unionByName(trimaps), root)
    return root


def image_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Image and mask files, listed, decoded and paired by file stem."""
    root = _image_files(spark, folder)
    return _parts(image_files.load_pairs(spark, f"{root}/images", f"{root}/masks", ".png", ".png"))


def image_records(spark: SparkSession, folder: str) -> DataFrame:
    """The whole run: image and mask files to record shards, and what these hold."""
    root, out = _image_files(spark, folder), scratch_path(spark, "records")
    records_run.images_to_records(spark, f"{root}/images", f"{root}/masks", out, 0.2, 32, seed=SEED, image_suffix=".png")
    weight = lambda values: F.aggregate(F.zip_with(values, F.sequence(F.lit(1), F.size(values)), lambda v, i: v.cast("bigint") * i),
                                        F.lit(0).cast("bigint"), lambda a, b: a + b)
    rows = tfrecord.read_records(spark, out, "split string, shard int, record int, " + tfrecord.DEFAULT_SCHEMA.split(", ", 2)[2])
    return rows.select("split", "shard", "record", weight(F.col("image")).alias("image"), weight(F.col("label")).alias("label"),
                       F.size("image").alias("cells"))


def _payloads(spark: SparkSession, folder: str) -> DataFrame:
    name = F.concat(F.lit("rows/"), F.col("vec_id").cast("string"), F.lit(".raw"))
    return images(spark, folder).select(
        F.struct(arrays.pack_uint8(_colour(F.col("image"))).alias("bytes"), name.alias("path")).alias("pixel_values"),
        F.struct(arrays.pack_uint8(F.col("label").cast("array<int>")).alias("bytes"), name.alias("path")).alias("label"),
        F.when(F.col("vec_id") % 2 == 0, F.array(F.lit(8), F.lit(8))).otherwise(F.array(F.lit(4), F.lit(16))).alias("shape"))


def payload_scan(spark: SparkSession, folder: str) -> DataFrame:
    """A parquet image table with ``struct<bytes,path>`` columns."""
    path = scratch_path(spark, "payloads")
    _payloads(spark, folder).write.parquet(path)
    return _parts(image_files.scan_payloads(spark, path, shape=(8, 8)))


def payload_shapes(spark: SparkSession, folder: str) -> DataFrame:
    """The same with 8 x 8 and 4 x 16 images in one table; each row says which it is."""
    path = scratch_path(spark, "payloads")
    _payloads(spark, folder).write.parquet(path)
    rows = image_files.scan_payloads(spark, path, shape="shape")
    shapes = [F.concat_ws("x", F.col(f"{c}_shape").cast("array<string>")).alias(f"{c}_shape") for c in ("image", "label")]
    return _parts(rows.select("key", "image", "label", *shapes), "image_shape", "label_shape")


_WRITTEN: dict[tuple[str, str, str], str] = {}


def _records(spark: SparkSession, folder: str, encoding: str = "numeric") -> str:
    """The embeddings as record shards, written once per session."""
    key = (spark.sparkContext.applicationId, folder, encoding)
    if key not in _WRITTEN or not tfrecord.has_manifest(_WRITTEN[key]):
        path = scratch_path(spark, "records")
        rows = ordering.exact_split(images(spark, folder), ["vec_id"], 0.2, SEED)
        if encoding == "tensor":
            rows = rows.withColumn("name", F.col("vec_id").cast("string"))
        tfrecord.write_records(rows, path, ["vec_id"], 32, SEED, encoding, keep_keys=True)
        _WRITTEN[key] = path
    return _WRITTEN[key]


SCHEMA = """
feature { name: "image" type: FLOAT presence { min_fraction: 1.0 } shape { dim { size: 64 } } }
feature { name: "label" type: FLOAT presence { min_fraction: 1.0 } shape { dim { size: 64 } } }
feature { name: "vec_id" type: INT presence { min_fraction: 1.0 } shape { dim { size: 1 } } }
"""


def _schema_file(spark: SparkSession, folder: str) -> str:
    """The schema as a text file, which has to come from somewhere: one row of a table."""
    root = scratch_path(spark, "schema")
    one = table(spark, folder, "region").limit(1)
    tree.write_tree(one.select(F.lit("schema.pbtxt").alias("path"), F.lit(SCHEMA).alias("content")), root)
    return f"{root}/schema.pbtxt"


def split_read(spark: SparkSession, folder: str) -> DataFrame:
    """One split by its name pattern."""
    return tfrecord.read_split(spark, _records(spark, folder), "val", schema="vec_id bigint, shard int, record int")


def fixed_read(spark: SparkSession, folder: str) -> DataFrame:
    """Records read with the schema of a file; every list has its declared length."""
    features = schema_text.read_schema(spark, _schema_file(spark, folder))
    rows = tfrecord.read_fixed(spark, _records(spark, folder), features)
    return rows.select(F.get("vec_id", F.lit(0)).alias("vec_id"), F.posexplode(
        F.arrays_zip(F.col("image"), F.col("label"))).alias("i", "p")).select(
        "vec_id", "i", F.col("p.image").cast("int").alias("image"), F.col("p.label").cast("int").alias("label"))


def absent_features(spark: SparkSession, folder: str) -> DataFrame:
    """Masks that records lack are found missing when these are read, as they are in the table."""
    features = schema_text.read_schema(spark, _schema_file(spark, folder))
    rows = ordering.exact_split(images(spark, folder), ["vec_id"], 0.2, SEED).withColumn(
        "label", F.when(F.col("vec_id") % 7 != 0, F.col("label")))
    path = scratch_path(spark, "records")
    tfrecord.write_records(rows, path, ["vec_id"], 32, SEED, keep_keys=True)
    read = tfrecord.read_records(spark, path, schema_text.struct_type(features).add("split", "string"))
    sides = [constraints.anomalies(df, features).withColumn("side", F.lit(side))
             for side, df in (("table", rows), ("records", read))]
    return sides[0].unionByName(sides[1]).select("side", "split", "feature", "rule", "n_bad", "n_rows")


NUMERIC = ("vec_id bigint, image array<float>, image_shape array<bigint>, label array<float>, "
           "label_shape array<bigint>")


def tfrecord_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    rows = tfrecord.read_records(spark, _records(spark, folder), NUMERIC)
    pair = F.arrays_zip(F.col("image"), F.col("label"))
    text = lambda c: F.concat_ws("x", F.col(c).cast("array<string>")).alias(c)
    return rows.select("vec_id", text("image_shape"), text("label_shape"), F.posexplode(pair).alias("i", "p")).select(
        "vec_id", "image_shape", "label_shape", "i", F.col("p.image").cast("int").alias("image"),
        F.col("p.label").cast("int").alias("label"))


def tensor_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """String encoding: each tensor is one byte string that carries its own shape."""
    rows = tfrecord.read_records(spark, _records(spark, folder, "tensor"),
                                 "name string, image array<float>, image_shape array<bigint>, label array<float>",
                                 encoding="tensor")
    pair = F.arrays_zip(F.col("image"), F.col("label"))
    shape = F.concat_ws("x", F.col("image_shape").cast("array<string>"))
    return rows.select(F.col("name").cast("bigint").alias("vec_id"), shape.alias("image_shape"),
                       F.posexplode(pair).alias("i", "p")).select(
        "vec_id", "image_shape", "i", F.col("p.image").cast("int").alias("image"),
        F.col("p.label").cast("int").alias("label"))


def split_import(spark: SparkSession, folder: str) -> DataFrame:
    """Shards imported by split pattern: ``train-*`` as train, ``val-*`` as eval."""
    path = _records(spark, folder)
    rows = tfrecord.import_splits(spark, path, schema="vec_id bigint, shard int, record int")
    return rows.select("vec_id", "split", "shard", "record")


def first_shard(spark: SparkSession, folder: str) -> DataFrame:
    path = _records(spark, folder)
    rows = tfrecord.import_splits(spark, path, tfrecord.FIRST_SHARDS, schema="vec_id bigint, shard int, record int")
    return rows.select("vec_id", "split", "shard", "record")


def shard_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Filters on split and shard drop files before they are read."""
    rows = tfrecord.read_records(spark, _records(spark, folder), "vec_id bigint, split string, shard int, record int")
    return rows.filter((F.col("split") == "train") & F.col("shard").isin(1, 3)).select("vec_id", "shard", "record")


def buffered_feed(spark: SparkSession, folder: str) -> DataFrame:
    """Three epochs of training batches from record shards: each record once an epoch, batches full but for the last."""
    rows = tfrecord.feed(spark, _records(spark, folder), 16, 3, SEED, schema="vec_id bigint, split string")
    sizes = rows.groupBy("epoch", "stream", "batch_id").agg(F.count(F.lit(1)).alias("n"))
    full = sizes.groupBy("epoch").agg((F.sum(F.when(F.col("n") < 16, 1).otherwise(0)) <= F.count_distinct("stream")).alias("full"))
    return rows.groupBy("epoch", "vec_id", "split").agg(F.count(F.lit(1)).alias("times")).join(F.broadcast(full), "epoch")


def record_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Records that arrive in two folders, streamed by two runs of one query: each image is weighed once."""
    root, out, checkpoint = (scratch_path(spark, n) for n in ("record-log", "weights", "checkpoint"))
    rows = ordering.exact_split(images(spark, folder), ["vec_id"], 0.2, SEED)
    weigh = lambda df: df.select("vec_id", "split", F.aggregate("image", F.lit(0).cast("bigint"), lambda a, v: a + v.cast(
        "bigint")).alias("weight"))
    for parity in (0, 1):
        tfrecord.append_records(rows.where(F.col("vec_id") % 2 == parity), root, ["vec_id"], seed=SEED, keep_keys=True)
        stream = tfrecord.read_record_stream(spark, root, "vec_id bigint, split string, image array<float>")
        score_stream(stream, weigh, out, checkpoint).awaitTermination()
    return spark.read.parquet(out)


def shard_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """What the manifest says of each shard, beside what its records say."""
    path = _records(spark, folder)
    held = spark.read.parquet(f"{path}/{tfrecord.MANIFEST}").select(
        F.regexp_extract("name", "^(.*)-[0-9]+-[0-9]+", 1).alias("split"),
        F.regexp_extract("name", "-([0-9]+)-[0-9]+", 1).cast("int").alias("shard"), "records", (F.col("bytes") > 0).alias("filled"))
    read = tfrecord.read_records(spark, path, "vec_id bigint, split string, shard int")
    found = read.groupBy("split", "shard").agg(F.count(F.lit(1)).alias("found"), F.sum("vec_id").alias("ids"))
    return held.join(found, ["split", "shard"], "full_outer")


def sample_check(spark: SparkSession, folder: str) -> DataFrame:
    """What was written against what is read back: rows of either side without a partner, and sizes."""
    written = ordering.exact_split(images(spark, folder), ["vec_id"], 0.2, SEED).select(
        "vec_id", "split", "image", "image_shape", "label", "label_shape")
    read = tfrecord.read_records(spark, _records(spark, folder), NUMERIC + ", split string").select(*written.columns)
    sides = written.exceptAll(read).withColumn("side", F.lit("lost")).unionByName(
        read.exceptAll(written).withColumn("side", F.lit("extra")))
    sizes = read.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.min(F.size("image")).alias("least"),
                                      F.max(F.size("image")).alias("most"))
    wrong = sides.groupBy("split").agg(F.count(F.lit(1)).alias("wrong"))
    return sizes.join(wrong, "split", "left").select("split", "n", "least", "most",
                                                     F.coalesce("wrong", F.lit(0)).cast("bigint").alias("wrong"))


def placeholder_replace(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens replaced in text files only; one value contains the next token on purpose."""
    suffix = F.element_at(F.array(F.lit(".py"), F.lit(".txt"), F.lit(".bin"), F.lit(".HTML"), F.lit("")),
                          (F.col("doc_id") % 5 + 1).cast("int"))
    documents = table(spark, folder, "documents").select(
        F.concat(F.lit("app/f"), F.col("doc_id").cast("string"), suffix).alias("path"),
        F.concat(F.lit("$MODEL_REPO_ID@$MODEL_VERSION\n"), F.col("text"), F.lit("\n$MODEL_REPO_URL")).alias("content"))
    pages = table(spark, folder, "pages").select(
        F.concat(F.lit("pages/"), F.col("page_id").cast("string"), F.lit(".html")).alias("path"),
        F.concat(F.col("html"), F.lit("$MODEL_VERSION")).alias("content"))
    values = filetree.placeholder_values("me/$MODEL_VERSION", "https://models.example/me", "v7")
    replaced = filetree.replace_placeholders(documents.unionByName(pages), values)
    return replaced.select("path", names.is_text_file(F.col("path")).alias("is_text"),
                           F.md5(F.encode("content", "UTF-8")).alias("digest"))


def app_tree(spark: SparkSession, folder: str) -> DataFrame:
    """The same over real files: written as a tree, read back, replaced."""
    root = scratch_path(spark, "app")
    suffix = F.when(F.col("page_id") % 2 == 0, F.lit(".html")).otherwise(F.lit(".dat"))
    pages = table(spark, folder, "pages").select(
        F.concat(F.lit("a/b"), (F.col("page_id") % 3).cast("string"), F.lit("/p"), F.col("page_id").cast("string"),
                 suffix).alias("path"),
        F.concat(F.lit("$MODEL_REPO_ID"), F.col("html")).alias("content"))
    tree.write_tree(pages, root)
    values = filetree.placeholder_values("me/it", "https://models.example/me/it", "v7")
    replaced = filetree.replace_placeholders(tree.read_tree(spark, root), values)
    return replaced.select("path", F.md5("content").alias("digest"))


def base64_urlsafe(spark: SparkSession, folder: str) -> DataFrame:
    coded = table(spark, folder, "documents").select(
        "doc_id", "text", base64url.encode(F.encode("text", "UTF-8")).alias("coded"))
    return coded.select(
        "doc_id", F.md5(F.encode("coded", "UTF-8")).alias("coded"),
        (F.decode(base64url.decode(F.rtrim(F.col("coded"), F.lit("="))), "UTF-8") == F.col("text")).alias("same"))


def request_build(spark: SparkSession, folder: str) -> DataFrame:
    rows = images(spark, folder).select("vec_id", arrays.pack_uint8(F.col("image").cast("array<int>")).alias("payload"))
    return requests.build_requests(rows, ["vec_id"], "payload", 64, SEED)


def response_parse(spark: SparkSession, folder: str) -> DataFrame:
    answers = masks(spark, folder).select("vec_id", requests.build_response(
        F.array("pred"), modelVersionId=F.lit("1")).alias("body"))
    parsed = answers.select("vec_id", F.explode(requests.parse_response(F.col("body"))).alias("mask"))
    return arrays.unroll(parsed, "mask", "px", "cls", "vec_id").withColumn("cls", F.col("cls").cast("int"))


def config_parse(spark: SparkSession, folder: str) -> DataFrame:
    """Settings with single quotes, as a dict literal has them: all entries, and null settings as they are."""
    literal = F.replace(F.col("props"), F.lit('"'), F.lit("'"))
    return table(spark, folder, "events").select(
        "event_id", F.explode_outer(requests.parse_config(literal)).alias("name", "value"))


def palette_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Palette texts made from nation keys: a comment, then one colour line per row, no final line end."""
    line = F.format_string("[%d, %d, %d]", F.col("n_nationkey"), F.col("n_regionkey") * 50, F.lit(255))
    texts = table(spark, folder, "nation").agg(F.concat(F.lit("# colours\n"), F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("n_nationkey", line.alias("line")))), lambda s: s["line"]), "\n")).alias("value"))
    root = scratch_path(spark, "palette")
    tree.write_tree(texts.select(F.lit("palette.txt").alias("path"), F.col("value").alias("content")), root)
    return palettes.read_palette(spark, f"{root}/palette.txt")


def path_functions(spark: SparkSession, folder: str) -> DataFrame:
    address = F.regexp_replace("url", "^[a-z]+://", "")
    pages = table(spark, folder, "pages").select(
        "page_id", address.alias("inner"), names.join_path(
            F.lit("site.v1"), address, F.concat(F.lit("page."), F.col("page_id").cast("string"))).alias("path"))
    return pages.select(
        "page_id", names.base_name(F.col("path")).alias("base"), names.stem(F.col("path")).alias("stem"),
        names.top_level(F.col("inner")).alias("top"), names.dotted_to_path(F.col("path")).alias("slashed"))


QUERIES = {f.__name__: f for f in (
    image_scan, image_records, payload_scan, payload_shapes, tfrecord_roundtrip, tensor_roundtrip, split_read, fixed_read,
    absent_features, split_import, first_shard, shard_filter,
    shard_manifest, buffered_feed, record_stream, sample_check, placeholder_replace, app_tree, base64_urlsafe, request_build, response_parse, config_parse,
    palette_scan, path_functions)}

_RANKED = (f"SELECT vec_id, row_number() OVER (ORDER BY {sql_hash('vec_id')}, vec_id) - 1 AS r, "
           "count(*) OVER () AS n FROM embeddings")
_SPLIT = ("SELECT vec_id, r, n - CAST(floor(n * CAST(0.2 AS DOUBLE)) AS BIGINT) AS cut FROM ({0})".format(_RANKED))
_SHARDED = (f"SELECT vec_id, CASE WHEN r >= cut THEN 'eval' ELSE 'train' END AS split, "
            f"CASE WHEN r >= cut THEN r - cut ELSE r END AS p FROM ({_SPLIT})")
_PLACED = (f"SELECT vec_id, split, CAST(p // 32 AS INTEGER) AS shard, CAST(p % 32 AS INTEGER) AS record "
           f"FROM ({_SHARDED})")
_PARTS = f"""
SELECT vec_id, {{0}}'image' AS part, CAST(i * 3 + c AS INTEGER) AS i,
  CAST(CASE c WHEN 0 THEN px WHEN 1 THEN 255 - px ELSE px * 7 % 256 END AS INTEGER) AS v
FROM ({PIXELS}), (SELECT unnest(range(3)) AS c) UNION ALL SELECT vec_id, {{0}}'label', i, cls FROM ({TRIMAP})"""
_BOTH = f"SELECT vec_id, i, px AS image, px % 3 + 1 AS label FROM ({PIXELS})"


def _replaced(text: str) -> str:
    return (f"replace(replace(replace({text}, '$MODEL_REPO_ID', 'me/$MODEL_VERSION'), '$MODEL_REPO_URL', "
            "'https://models.example/me'), '$MODEL_VERSION', 'v7')")


_DOC = "'$MODEL_REPO_ID@$MODEL_VERSION' || chr(10) || text || chr(10) || '$MODEL_REPO_URL'"
_HEX = f"SELECT vec_id, string_agg(printf('%02x', px), '' ORDER BY i) AS hex FROM ({PIXELS}) GROUP BY vec_id"
_CODED = "translate(to_base64({0}), '+/', '-_')"

ORACLES = {
    "image_scan": _PARTS.format(""),
    "image_records": f"""
SELECT CASE WHEN r >= cut THEN 'val' ELSE 'train' END AS split,
  CAST((CASE WHEN r >= cut THEN r - cut ELSE r END) // 32 AS INTEGER) AS shard,
  CAST((CASE WHEN r >= cut THEN r - cut ELSE r END) % 32 AS INTEGER) AS record, image, label, 192 AS cells
FROM (SELECT vec_id, row_number() OVER (ORDER BY h, vec_id) - 1 AS r, count(*) OVER () - CAST(floor(count(*) OVER () *
    CAST(0.2 AS DOUBLE)) AS BIGINT) AS cut FROM (SELECT vec_id, {sql_hash("printf('%06d', vec_id)")} AS h FROM embeddings))
JOIN (SELECT vec_id, CAST(sum(v * (i + 1)) FILTER (WHERE part = 'image') AS BIGINT) AS image,
    CAST(sum(v * (i + 1)) FILTER (WHERE part = 'label') AS BIGINT) AS label FROM ({_PARTS.format("")}) GROUP BY vec_id)
  USING (vec_id)""",
    "payload_scan": _PARTS.format(""),
    "payload_shapes": _PARTS.format("CASE WHEN vec_id % 2 = 0 THEN '8x8x3' ELSE '4x16x3' END AS image_shape, "
                                    "CASE WHEN vec_id % 2 = 0 THEN '8x8' ELSE '4x16' END AS label_shape, "),
    "split_read": f"SELECT vec_id, shard, record FROM ({_PLACED}) WHERE split = 'eval'",
    "fixed_read": f"SELECT vec_id, i, image, label FROM ({_BOTH})",
    "absent_features": f"""
SELECT side, split, 'label' AS feature, 'missing' AS rule, n_bad, n_rows FROM (
  SELECT CASE split WHEN 'eval' THEN 'val' ELSE split END AS split, count(*) FILTER (WHERE vec_id % 7 = 0) AS n_bad,
    count(*) AS n_rows FROM ({_PLACED}) GROUP BY ALL), (VALUES ('table'), ('records')) s(side) WHERE n_bad > 0""",
    "tfrecord_roundtrip": f"SELECT vec_id, '8x8x1' AS image_shape, '8x8' AS label_shape, i, image, label FROM ({_BOTH})",
    "tensor_roundtrip": f"SELECT vec_id, '8x8x1' AS image_shape, i, image, label FROM ({_BOTH})",
    "split_import": _PLACED,
    "first_shard": f"SELECT * FROM ({_PLACED}) WHERE shard = 0",
    "shard_filter": f"SELECT vec_id, shard, record FROM ({_PLACED}) WHERE split = 'train' AND shard IN (1, 3)",
    "buffered_feed": f"""
SELECT CAST(epoch AS INTEGER) AS epoch, vec_id, CASE split WHEN 'eval' THEN 'val' ELSE split END AS split,
  CAST(1 AS BIGINT) AS times, true AS full FROM ({_SHARDED}), (SELECT unnest(range(3)) AS epoch)""",
    "record_stream": f"""
SELECT vec_id, CASE split WHEN 'eval' THEN 'val' ELSE split END AS split, weight FROM ({_SHARDED})
JOIN (SELECT vec_id, CAST(sum(px) AS BIGINT) AS weight FROM ({PIXELS}) GROUP BY vec_id) USING (vec_id)""",
    "shard_manifest": f"""
SELECT CASE split WHEN 'eval' THEN 'val' ELSE split END AS split, shard, count(*) AS records, true AS filled,
  count(*) AS found, CAST(sum(vec_id) AS BIGINT) AS ids FROM ({_PLACED}) GROUP BY ALL""",
    "sample_check": f"SELECT CASE split WHEN 'eval' THEN 'val' ELSE split END AS split, count(*) AS n, 64 AS least, "
                    f"64 AS most, CAST(0 AS BIGINT) AS wrong FROM ({_PLACED}) GROUP BY ALL",
    "placeholder_replace": f"""
SELECT 'app/f' || doc_id || CASE doc_id % 5 WHEN 0 THEN '.py' WHEN 1 THEN '.txt' WHEN 2 THEN '.bin'
         WHEN 3 THEN '.HTML' ELSE '' END AS path, doc_id % 5 IN (0, 1, 3) AS is_text,
       md5(CASE WHEN doc_id % 5 IN (0, 1, 3) THEN {_replaced(_DOC)} ELSE {_DOC} END) AS digest FROM documents
UNION ALL SELECT 'pages/' || page_id || '.html', true, md5({_replaced("html || '$MODEL_VERSION'")}) FROM pages""",
    "app_tree": """
SELECT 'a/b' || (page_id % 3) || '/p' || page_id || CASE WHEN page_id % 2 = 0 THEN '.html' ELSE '.dat' END AS path,
       md5(CASE WHEN page_id % 2 = 0 THEN replace(replace(replace('$MODEL_REPO_ID' || html, '$MODEL_REPO_ID', 'me/it'),
         '$MODEL_REPO_URL', 'https://models.example/me/it'), '$MODEL_VERSION', 'v7')
       ELSE '$MODEL_REPO_ID' || html END) AS digest FROM pages""",
    "base64_urlsafe": f"SELECT doc_id, md5({_CODED.format('encode(text)')}) AS coded, true AS same FROM documents",
    "request_build": f"""
SELECT CAST(r // 64 AS INTEGER) AS batch_id, CAST(count(*) AS INTEGER) AS n,
  '{{"instances":[' || string_agg('{{"string_input":"' || {_CODED.format('unhex(hex)')} || '"}}', ',' ORDER BY r) || ']}}'
    AS request
FROM ({_RANKED}) JOIN ({_HEX}) USING (vec_id) GROUP BY r // 64""",
    "response_parse": f"SELECT vec_id, px, cls FROM ({ARGMAX})",
    "config_parse": "SELECT event_id, e.name, json_extract_string(props, '$.' || e.name) AS value FROM events LEFT JOIN "
                    "LATERAL (SELECT unnest(json_keys(props)) AS name) e ON true",
    "palette_scan": "SELECT CAST(row_number() OVER (ORDER BY n_nationkey) - 1 AS INTEGER) AS class, n_nationkey AS r, "
                    "n_regionkey * 50 AS g, 255 AS b FROM nation",
    "path_functions": """
SELECT page_id, 'page.' || page_id AS base, 'page' AS stem, split_part(a, '/', 1) AS top,
  replace('site.v1/' || a || '/page.' || page_id, '.', '/') AS slashed
FROM (SELECT page_id, regexp_replace(url, '^[a-z]+://', '') AS a FROM pages)""",
}
