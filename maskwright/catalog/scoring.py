"""Model slot, request scoring, parity, streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from maskwright.catalog.views import (
    ARGMAX, PIXELS, SEED, VIEW, embeddings, long, masks, pictures, sql_hash, sql_split, three_channels, to_pixels)
from maskwright.functions import arrays
from maskwright.operators import compare, requests, scoring, tensors
from maskwright.operators.ordering import bucket_split
from maskwright.session import scratch_path
from maskwright.sources import tables
from maskwright.sources.palettes import PETS
from maskwright.streaming.score import read_table_stream, score_stream

PREPROCESS = "maskwright.operators.tensors.preprocess"


def _examples(spark: SparkSession, folder: str) -> DataFrame:
    rows = embeddings(spark, folder).select("vec_id", to_pixels(F.col("embedding")).alias("image"), "label")
    return bucket_split(rows, ["vec_id"], 0.2, SEED, ("train", "eval"))


def centroid_fit_score(spark: SparkSession, folder: str) -> DataFrame:
    """Fit on the train split, score the eval split from raw examples, same preprocessing for both."""
    rows, preprocess = _examples(spark, folder), tensors.load_callable(PREPROCESS)
    model = scoring.fit_centroids(preprocess(rows.filter("split = 'train'")), "image_xf", "label_xf")
    scored = scoring.score_examples(rows.filter("split = 'eval'"), preprocess, model)
    return scored.select("vec_id", F.col("label_xf").alias("label"), "pred")


def transform_view(spark: SparkSession, folder: str) -> DataFrame:
    """Transform only, stored per split and read back as features and label."""
    path = scratch_path(spark, "transformed")
    tables.write_transformed(tensors.preprocess(_examples(spark, folder)), path)
    rows = tables.read_transformed(spark, path, "eval")
    return rows.select("features.vec_id", F.col("label").alias("label_xf"),
                       F.posexplode("features.image_xf").alias("i", "v")).withColumn("v", F.col("v").cast("double"))


def mllib_fit_score(spark: SparkSession, folder: str) -> DataFrame:
    """A label that follows from the first pixels: the model finds nearly all of it in the rows it has not seen."""
    first = F.get("image", F.lit(0)) + F.get("image", F.lit(1)) > F.get("image", F.lit(2)) + F.get("image", F.lit(3))
    rows = _examples(spark, folder).withColumn("label", first.cast("int"))
    model = scoring.fit_logistic(rows.filter("split = 'train'"), "image", "label", max_iter=30)
    scored = scoring.score_logistic(model, rows.filter("split = 'eval'"), "image")
    return scored.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("label").cast("bigint")).alias("positive"),
                      (F.avg((F.col("pred") == F.col("label")).cast("double")) > 0.85).alias("learned"))


def scorer_parity(spark: SparkSession, folder: str) -> DataFrame:
    """Masks from the logits against masks from logits rounded to 8 bits: ties make some pixels differ."""
    exact = masks(spark, folder).select("vec_id", "pred")
    coarse = embeddings(spark, folder).select(
        "vec_id", arrays.argmax(to_pixels(F.col("embedding")), arrays.shape_of(4, 4, 4)).alias("pred"))
    return compare.parity(exact, coarse, "vec_id", "pred").withColumn("max_rel", F.round("max_rel", 6))


def request_score(spark: SparkSession, folder: str) -> DataFrame:
    """Payloads packed into requests of 64, unpacked, and scored to 2 x 2 masks."""
    rows = pictures(spark, folder)
    model = scoring.fit_pixel_centroids(
        rows.withColumn("image", arrays.normalise(F.col("image"))), "image", "pred", 4)
    payloads = rows.select("vec_id", arrays.pack_uint8(F.col("image").cast("array<int>")).alias("payload"))
    sent = requests.build_requests(payloads, ["vec_id"], "payload", 64, SEED, index=embeddings(spark, folder).select(
        "vec_id")).select("batch_id", "request")
    received = requests.explode_requests(sent).withColumn("payload", requests.base64url.encode(F.col("payload")))
    scored = scoring.score_requests(received, "payload", (4, 4, 4), 2, model)
    return arrays.unroll(scored, "seg_mask", "px", "cls", "batch_id", "instance")


def score_overlay(spark: SparkSession, folder: str) -> DataFrame:
    rows = pictures(spark, folder).select("vec_id", "pred", three_channels(F.col("image")).alias("image"),
                                          arrays.shape_of(4, 4, 3).alias("shape"))
    model = scoring.fit_pixel_centroids(
        rows.withColumn("image", arrays.scale01(F.col("image"))), "image", "pred", 3)
    shown = scoring.score_overlay(rows, "image", "shape", 2, model, PETS)
    return long(shown, "vec_id", "overlay", kind="int")


def stream_score(spark: SparkSession, folder: str) -> DataFrame:
    """The argmax job over a file stream, run until everything available is scored."""
    source = embeddings(spark, folder)
    stream = read_table_stream(spark, f"{folder}/embeddings.parquet", source.schema)

    def score(df: DataFrame) -> DataFrame:
        shaped = df.withColumn("shape", arrays.shape_of(4, 4, 4))
        return tensors.argmax_mask(shaped, "embedding", "shape").select("vec_id", "mask")

    output = scratch_path(spark, "scored")
    score_stream(stream, score, output, scratch_path(spark, "stream-state")).awaitTermination()
    # the schema is known: a stream of no files writes none to infer it from
    return spark.read.schema(score(source).schema).parquet(output).select("vec_id", F.posexplode("mask").alias("px", "cls"))


def softmax_fit_score(spark: SparkSession, folder: str) -> DataFrame:
    """A pixel classifier learned by gradients on the train split: its loss falls, and unseen masks come out right."""
    rows = bucket_split(pictures(spark, folder), ["vec_id"], 0.2, SEED, ("train", "eval")).select(
        "split", "pred", arrays.normalise(F.col("image")).alias("image"), arrays.shape_of(4, 4, 4).alias("shape"))
    model = scoring.fit_pixel_softmax(rows.where("split = 'train'"), "image", "shape", "pred", range(4), 1, 12)
    falls = all(b <= a for a, b in zip(model.losses, model.losses[1:])) and model.losses[-1] < model.losses[0] / 3
    scored = rows.where("split = 'eval'").withColumn("found", model.segment(F.col("image"), F.col("shape")))
    pixels = scored.select(F.explode(F.arrays_zip("pred", "found")).alias("p"))
    return pixels.agg(F.count(F.lit(1)).alias("pixels"), F.lit(falls).alias("falls"),
                      (F.avg((F.col("p.pred") == F.col("p.found")).cast("double")) > 0.9).alias("learned"))


QUERIES = {f.__name__: f for f in (
    softmax_fit_score, centroid_fit_score, transform_view, mllib_fit_score, scorer_parity, request_score, score_overlay, stream_score)}

_XF = ("SELECT vec_id, label, i, CAST(CAST(px AS FLOAT) / CAST(127.5 AS FLOAT) - CAST(1 AS FLOAT) AS DOUBLE) AS x, "
       f"{sql_split('vec_id')} AS split FROM ({PIXELS})")
_CENTROID = f"""
WITH xf AS ({_XF}), centre AS (SELECT label AS cls, i, avg(x) AS m FROM xf WHERE split = 'train' GROUP BY ALL),
far AS (SELECT vec_id, xf.label, cls, sum((x - m) * (x - m)) AS d FROM xf JOIN centre USING (i)
        WHERE split = 'eval' GROUP BY ALL)
SELECT vec_id, label, CAST(arg_min(cls, d) AS INTEGER) AS pred FROM far GROUP BY ALL"""


def _pixel_model(scaled: str, view: str) -> str:
    """Class centres of scaled pixels (vec_id, p, c, px), applied to images halved to 2 x 2."""
    return f"""
px AS (SELECT q.vec_id, q.p, q.c, q.px, m.cls FROM ({view}) q JOIN ({ARGMAX}) m ON m.vec_id = q.vec_id AND m.px = q.p),
centre AS (SELECT cls, c, avg({scaled.format('px')}) AS m FROM px GROUP BY ALL),
small AS (SELECT vec_id, CAST(p // 8 * 2 + p % 4 // 2 AS INTEGER) AS s, c, {scaled.format('avg(px)')} AS x FROM px
          GROUP BY vec_id, p // 8, p % 4 // 2, c),
far AS (SELECT vec_id, s, centre.cls, sum((x - m) * (x - m)) AS d FROM small JOIN centre USING (c) GROUP BY ALL),
best AS (SELECT vec_id, s, CAST(arg_min(cls, d) AS INTEGER) AS cls FROM far GROUP BY ALL)"""


_FOUR = f"SELECT vec_id, i // 4 AS p, i % 4 AS c, px FROM ({PIXELS})"
_NORMALISED = "CAST(CAST({0} AS FLOAT) / CAST(127.5 AS FLOAT) - CAST(1 AS FLOAT) AS DOUBLE)"
_SCALED = "CAST(CAST({0} AS FLOAT) / CAST(255 AS FLOAT) AS DOUBLE)"
_PALETTE = ", ".join(f"({i}, {r}, {g}, {b})" for i, (r, g, b) in enumerate(PETS))

ORACLES = {
    "softmax_fit_score": f"SELECT count(*) * 16 AS pixels, true AS falls, true AS learned FROM embeddings "
                         f"WHERE {sql_split('vec_id')} = 'eval'",
    "centroid_fit_score": _CENTROID,
    "mllib_fit_score": f"""
SELECT count(*) AS n, CAST(sum(CAST(a > b AS INTEGER)) AS BIGINT) AS positive, true AS learned FROM (
  SELECT vec_id, sum(px) FILTER (WHERE i < 2) AS a, sum(px) FILTER (WHERE i IN (2, 3)) AS b FROM ({PIXELS}) GROUP BY vec_id)
WHERE {sql_split('vec_id')} = 'eval'""",
    "transform_view": f"SELECT vec_id, label AS label_xf, i, x AS v FROM ({_XF}) WHERE split = 'eval'",
    "scorer_parity": f"""
WITH a AS ({ARGMAX}), b AS (SELECT vec_id, i // 4 AS px, min(i % 4) FILTER (WHERE px = peak) AS cls FROM
  (SELECT *, max(px) OVER (PARTITION BY vec_id, i // 4) AS peak FROM ({PIXELS})) GROUP BY vec_id, i // 4),
g AS (SELECT CAST(abs(a.cls - b.cls) AS DOUBLE) AS gap, CAST(b.cls AS DOUBLE) AS r FROM a JOIN b USING (vec_id, px))
SELECT count(*) AS compared, CAST(0 AS BIGINT) AS unmatched, count(*) FILTER (WHERE gap > r * 1e-7) AS different,
  max(gap) AS max_abs, round(max(gap / r) FILTER (WHERE r <> 0), 6) AS max_rel,
  count(*) FILTER (WHERE gap > r * 1e-7) = 0 AS equal FROM g""",
    "request_score": f"""
WITH {_pixel_model(_NORMALISED, _FOUR)},
ranked AS (SELECT vec_id, row_number() OVER (ORDER BY {sql_hash('vec_id')}, vec_id) - 1 AS r FROM embeddings)
SELECT CAST(r // 64 AS INTEGER) AS batch_id, CAST(r % 64 AS INTEGER) AS instance, s AS px, cls
FROM best JOIN ranked USING (vec_id)""",
    "score_overlay": f"""
WITH {_pixel_model(_SCALED, VIEW)}
SELECT vec_id, CAST(s * 3 + c AS INTEGER) AS i, CAST(trunc(greatest(least((x * CAST(0.5 AS DOUBLE) +
  coalesce(CASE c WHEN 0 THEN r WHEN 1 THEN g ELSE b END, 0) * CAST(0.5 AS DOUBLE)) * CAST(255 AS DOUBLE),
  CAST(255 AS DOUBLE)), CAST(0 AS DOUBLE))) AS INTEGER) AS v
FROM small JOIN best USING (vec_id, s) LEFT JOIN (VALUES {_PALETTE}) p(class, r, g, b) ON p.class = best.cls""",
    "stream_score": f"SELECT vec_id, px, cls FROM ({ARGMAX})",
}
