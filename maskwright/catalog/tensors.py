"""Tensor operators on the 8 x 8 and 4 x 4 views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from maskwright.catalog.views import (
    ARGMAX, PIXELS, TRIMAP, VALUES, VIEW, embeddings, images, long, masks, pictures, three_channels)
from maskwright.functions import arrays
from maskwright.operators import overlay, tensors
from maskwright.sources.palettes import PETS, SIDEWALKS, palette_table


def resize_bilinear(spark: SparkSession, folder: str) -> DataFrame:
    """8 x 8 to 5 x 5, a scale that does not divide evenly."""
    rows = images(spark, folder).select("vec_id", arrays.resize(F.col("image"), F.col("image_shape"), 5, 5).alias("x"))
    return long(rows, "vec_id", "x")


def resize_pair(spark: SparkSession, folder: str) -> DataFrame:
    """Image and mask halved together; the mask is shifted to 0..2 and gets fractional classes."""
    rows = tensors.resize_pair(images(spark, folder), 4)
    pair = F.arrays_zip(F.col("image"), F.col("label"))
    return arrays.unroll(rows, pair, "i", "p", "vec_id").select(
        "vec_id", "i", F.col("p.image").cast("double").alias("image"), F.col("p.label").cast("double").alias("label"))


def resize_nearest(spark: SparkSession, folder: str) -> DataFrame:
    rows = images(spark, folder).select(
        "vec_id", arrays.resize(F.col("label"), F.col("label_shape"), 4, 4, "nearest").alias("x"))
    return long(rows, "vec_id", "x", kind="int")


def resize_none(spark: SparkSession, folder: str) -> DataFrame:
    """Without a size nothing changes: masks keep their classes 1..3."""
    return long(tensors.resize_pair(images(spark, folder), None), "vec_id", "label", kind="int")


def normalise(spark: SparkSession, folder: str) -> DataFrame:
    return long(images(spark, folder).withColumn("x", arrays.normalise(F.col("image"))), "vec_id", "x")


def scale01(spark: SparkSession, folder: str) -> DataFrame:
    return long(images(spark, folder).withColumn("x", arrays.scale01(F.col("image"))), "vec_id", "x")


def clip_cast(spark: SparkSession, folder: str) -> DataFrame:
    wide = arrays.map_float(F.col("embedding"), lambda v: v.cast("double") * F.lit(1000.0))
    rows = embeddings(spark, folder).withColumn("x", arrays.to_uint8(arrays.clip(wide, 0.0, 255.0)))
    return long(rows, "vec_id", "x", kind="int")


def cast_wrap(spark: SparkSession, folder: str) -> DataFrame:
    """The cast without a clip wraps around."""
    wide = arrays.map_float(F.col("embedding"), lambda v: v.cast("double") * F.lit(1000.0))
    return long(embeddings(spark, folder).withColumn("x", arrays.to_uint8(wide)), "vec_id", "x", kind="int")


def label_shift(spark: SparkSession, folder: str) -> DataFrame:
    return long(images(spark, folder).withColumn("x", arrays.shift_label(F.col("label"))), "vec_id", "x", kind="int")


def rename_xf(spark: SparkSession, folder: str) -> DataFrame:
    """The preprocessing callback: normalised image and label under their transformed names."""
    rows = tensors.preprocess(images(spark, folder))
    pair = F.arrays_zip(F.col("image_xf"), F.col("label_xf"))
    return arrays.unroll(rows, pair, "i", "p", "vec_id").select(
        "vec_id", "i", F.col("p.image_xf").cast("double").alias("image_xf"),
        F.col("p.label_xf").cast("int").alias("label_xf"))


def reshape(spark: SparkSession, folder: str) -> DataFrame:
    """Length checked against the shape column, then cells with their coordinates."""
    checked = tensors.check_shapes(embeddings(spark, folder).select(
        "vec_id", F.col("embedding").alias("image"), arrays.shape_of(4, 4, 4).alias("image_shape")),
        "image", "image_shape")
    return tensors.to_cells(checked.drop("image_shape"), "image", (4, 4, 4), ("y", "x", "c")).withColumn(
        "v", F.col("v").cast("double"))


def shape_edits(spark: SparkSession, folder: str) -> DataFrame:
    rows = images(spark, folder)
    text = lambda c: F.concat_ws("x", c.cast("array<string>"))
    return rows.select(
        "vec_id", text(F.col("image_shape")).alias("shape"),
        text(arrays.expand_dims(F.col("label_shape"), 0)).alias("batched"),
        text(arrays.expand_dims(F.col("label_shape"), -1)).alias("channelled"),
        text(arrays.squeeze(F.col("image_shape"))).alias("squeezed"),
        arrays.n_elements(F.col("image_shape")).alias("n"))


def argmax_mask(spark: SparkSession, folder: str) -> DataFrame:
    rows = tensors.argmax_mask(embeddings(spark, folder).withColumn("shape", arrays.shape_of(4, 4, 4)),
                               "embedding", "shape")
    return arrays.unroll(rows, "mask", "px", "cls", "vec_id")


def moments(spark: SparkSession, folder: str) -> DataFrame:
    rows = tensors.channel_moments(embeddings(spark, folder), "embedding", 4, ["vec_id"])
    return rows.select("vec_id", F.col("c").cast("int").alias("c"), F.round("mean", 6).alias("mean"),
                       F.round("variance", 6).alias("variance"))


def instance_norm(spark: SparkSession, folder: str) -> DataFrame:
    rows = embeddings(spark, folder).withColumn(
        "x", arrays.standardise_channels(F.col("embedding"), arrays.shape_of(4, 4, 4), 1e-5))
    return long(rows, "vec_id", "x").withColumn("v", F.round("v", 6))


def batch_norm(spark: SparkSession, folder: str) -> DataFrame:
    rows = tensors.standardise_dataset(embeddings(spark, folder).select("vec_id", "embedding"), "embedding", 4)
    return long(rows, "vec_id", "embedding").withColumn("v", F.round("v", 6))


def relu(spark: SparkSession, folder: str) -> DataFrame:
    return long(embeddings(spark, folder).withColumn("x", arrays.relu(F.col("embedding"))), "vec_id", "x")


def channel_concat(spark: SparkSession, folder: str) -> DataFrame:
    left = images(spark, folder).select("vec_id", "image", F.col("image_shape").alias("shape"))
    right = images(spark, folder).select(
        "vec_id", F.col("label").alias("image"), arrays.expand_dims(F.col("label_shape"), -1).alias("shape"))
    joined = tensors.concat_tensors(left, right, "vec_id", "image", "shape")
    return long(joined, "vec_id", "image", kind="int")


def transpose(spark: SparkSession, folder: str) -> DataFrame:
    rows = embeddings(spark, folder).withColumn(
        "x", arrays.transpose(F.col("embedding"), arrays.shape_of(4, 4, 4), (2, 0, 1)))
    return long(rows, "vec_id", "x")


def _shown(spark: SparkSession, folder: str) -> DataFrame:
    """A 4 x 4 colour view (0..1) with the predicted mask."""
    return pictures(spark, folder).select(
        "vec_id", "pred", arrays.scale01(three_channels(F.col("image"))).alias("view"))


def palette_overlay(spark: SparkSession, folder: str) -> DataFrame:
    rows = overlay.with_overlay(_shown(spark, folder), "view", "pred", palette_table(spark, PETS))
    return long(rows, "vec_id", "overlay", kind="int")


def overlay_plain(spark: SparkSession, folder: str) -> DataFrame:
    rows = overlay.with_overlay(_shown(spark, folder), "view", "pred", palette_table(spark, SIDEWALKS), scaled=False)
    return long(rows, "vec_id", "overlay", kind="int")


def mask_colours(spark: SparkSession, folder: str) -> DataFrame:
    return overlay.mask_colours(masks(spark, folder), "vec_id", "pred", palette_table(spark, PETS))


QUERIES = {f.__name__: f for f in (
    resize_bilinear, resize_pair, resize_nearest, resize_none, normalise, scale01, clip_cast, cast_wrap, label_shift,
    rename_xf, reshape, shape_edits, argmax_mask, moments, instance_norm, batch_norm, relu, channel_concat,
    transpose, palette_overlay, overlay_plain, mask_colours)}

_NORM = "CAST(CAST(px AS FLOAT) / CAST(127.5 AS FLOAT) - CAST(1 AS FLOAT) AS DOUBLE)"


def _axis(size: int, target: int) -> str:
    """Target position, its two source lines and the blend between them, in single precision."""
    at = (f"(CAST(t AS FLOAT) + CAST(0.5 AS FLOAT)) * (CAST({size} AS FLOAT) / CAST({target} AS FLOAT)) "
          "- CAST(0.5 AS FLOAT)")
    return (f"SELECT t, CAST(greatest(floor(p), 0) AS INTEGER) AS lo, CAST(least(ceil(p), {size - 1}) AS INTEGER) "
            f"AS hi, CAST(p - floor(p) AS FLOAT) AS w FROM (SELECT t, CAST({at} AS FLOAT) AS p "
            f"FROM (SELECT unnest(range({target})) AS t))")


def _resized(source: str, value: str, target: int, size: int = 8) -> str:
    """Bilinear resize of (vec_id, i, value) rows by joins with the two axis tables."""
    cell = "max(CASE WHEN s.i = {0} * " + str(size) + " + {1} THEN CAST(s." + value + " AS FLOAT) END)"
    tl, tr = cell.format("y.lo", "x.lo"), cell.format("y.lo", "x.hi")
    bl, br = cell.format("y.hi", "x.lo"), cell.format("y.hi", "x.hi")
    return f"""
SELECT vec_id, CAST(ty * {target} + tx AS INTEGER) AS i,
       CAST(top + CAST(CAST(bottom - top AS FLOAT) * wy AS FLOAT) AS FLOAT) AS v FROM (
  SELECT vec_id, ty, tx, wy, CAST(tl + CAST(CAST(tr - tl AS FLOAT) * wx AS FLOAT) AS FLOAT) AS top,
         CAST(bl + CAST(CAST(br - bl AS FLOAT) * wx AS FLOAT) AS FLOAT) AS bottom FROM (
    SELECT s.vec_id, y.t AS ty, x.t AS tx, any_value(y.w) AS wy, any_value(x.w) AS wx,
           {tl} AS tl, {tr} AS tr, {bl} AS bl, {br} AS br
    FROM ({source}) s JOIN ({_axis(size, target)}) y ON s.i // {size} IN (y.lo, y.hi)
      JOIN ({_axis(size, target)}) x ON s.i % {size} IN (x.lo, x.hi)
    GROUP BY s.vec_id, y.t, x.t))"""


def _palette_sql(colours) -> str:
    rows = ", ".join(f"({i}, {r}, {g}, {b})" for i, (r, g, b) in enumerate(colours))
    return f"(VALUES {rows}) AS p(class, r, g, b)"


def _overlay_sql(colours, scaled: bool) -> str:
    blend = ("CAST(CAST(q.px AS FLOAT) / CAST(255 AS FLOAT) AS DOUBLE) * CAST(0.5 AS DOUBLE) + "
             "coalesce(CASE q.c WHEN 0 THEN p.r WHEN 1 THEN p.g ELSE p.b END, 0) * CAST(0.5 AS DOUBLE)")
    if scaled:
        blend = f"greatest(least(({blend}) * CAST(255 AS DOUBLE), CAST(255 AS DOUBLE)), CAST(0 AS DOUBLE))"
    return f"""
SELECT q.vec_id, CAST(q.p * 3 + q.c AS INTEGER) AS i, CAST(trunc({blend}) AS INTEGER) % 256 AS v
FROM ({VIEW}) q JOIN ({ARGMAX}) m ON m.vec_id = q.vec_id AND m.px = q.p
LEFT JOIN {_palette_sql(colours)} ON p.class = m.cls"""


ORACLES = {
    "resize_bilinear": f"SELECT vec_id, i, CAST(v AS DOUBLE) AS v FROM ({_resized(PIXELS, 'px', 5)})",
    "resize_pair": f"SELECT vec_id, i, CAST(a.v AS DOUBLE) AS image, CAST(CAST(b.v - CAST(1 AS FLOAT) AS FLOAT) "
                   f"AS DOUBLE) AS label FROM ({_resized(PIXELS, 'px', 4)}) a JOIN ({_resized(TRIMAP, 'cls', 4)}) b "
                   "USING (vec_id, i)",
    "resize_nearest": f"SELECT vec_id, CAST((i // 8 // 2) * 4 + i % 8 // 2 AS INTEGER) AS i, cls AS v "
                      f"FROM ({TRIMAP}) WHERE i // 8 % 2 = 1 AND i % 2 = 1",
    "resize_none": f"SELECT vec_id, i, cls AS v FROM ({TRIMAP})",
    "normalise": f"SELECT vec_id, i, {_NORM} AS v FROM ({PIXELS})",
    "scale01": f"SELECT vec_id, i, CAST(CAST(px AS FLOAT) / CAST(255 AS FLOAT) AS DOUBLE) AS v FROM ({PIXELS})",
    "clip_cast": f"SELECT vec_id, i, CAST(trunc(greatest(least(CAST(CAST(v AS DOUBLE) * CAST(1000 AS DOUBLE) "
                 f"AS FLOAT), CAST(255 AS FLOAT)), CAST(0 AS FLOAT))) AS INTEGER) AS v FROM ({VALUES})",
    "cast_wrap": f"SELECT vec_id, i, ((w % 256) + 256) % 256 AS v FROM (SELECT vec_id, i, CAST(trunc(CAST("
                 f"CAST(v AS DOUBLE) * CAST(1000 AS DOUBLE) AS FLOAT)) AS INTEGER) AS w FROM ({VALUES}))",
    "label_shift": f"SELECT vec_id, i, cls - 1 AS v FROM ({TRIMAP})",
    "rename_xf": f"SELECT vec_id, i, {_NORM} AS image_xf, px % 3 + 1 AS label_xf FROM ({PIXELS})",
    "reshape": f"SELECT vec_id, CAST(i // 16 AS INTEGER) AS y, CAST(i // 4 % 4 AS INTEGER) AS x, "
               f"CAST(i % 4 AS INTEGER) AS c, CAST(v AS DOUBLE) AS v FROM ({VALUES})",
    "shape_edits": "SELECT vec_id, '8x8x1' AS shape, '1x8x8' AS batched, '8x8x1' AS channelled, '8x8' AS squeezed, "
                   "CAST(len(embedding) AS BIGINT) AS n FROM embeddings",
    "argmax_mask": f"SELECT vec_id, px, cls FROM ({ARGMAX})",
    "moments": f"SELECT vec_id, CAST(i % 4 AS INTEGER) AS c, round(avg(CAST(v AS DOUBLE)), 6) AS mean, "
               f"round(var_pop(CAST(v AS DOUBLE)), 6) AS variance FROM ({VALUES}) GROUP BY vec_id, i % 4",
    "instance_norm": f"SELECT vec_id, i, round((CAST(v AS DOUBLE) - avg(CAST(v AS DOUBLE)) OVER w) / "
                     f"sqrt(var_pop(CAST(v AS DOUBLE)) OVER w + CAST(0.00001 AS DOUBLE)), 6) AS v "
                     f"FROM ({VALUES}) WINDOW w AS (PARTITION BY vec_id, i % 4)",
    "batch_norm": f"SELECT vec_id, i, round((CAST(v AS DOUBLE) - m) / sqrt(s + CAST(0.001 AS DOUBLE)), 6) AS v "
                  f"FROM ({VALUES}) JOIN (SELECT i % 4 AS c, avg(CAST(v AS DOUBLE)) AS m, "
                  f"var_pop(CAST(v AS DOUBLE)) AS s FROM ({VALUES}) GROUP BY i % 4) ON c = i % 4",
    "relu": f"SELECT vec_id, i, greatest(CAST(v AS DOUBLE), CAST(0 AS DOUBLE)) AS v FROM ({VALUES})",
    "channel_concat": f"SELECT vec_id, CAST(i * 2 AS INTEGER) AS i, px AS v FROM ({PIXELS}) UNION ALL "
                      f"SELECT vec_id, CAST(i * 2 + 1 AS INTEGER), px % 3 + 1 FROM ({PIXELS})",
    "transpose": f"SELECT vec_id, CAST(i % 4 * 16 + i // 4 AS INTEGER) AS i, CAST(v AS DOUBLE) AS v FROM ({VALUES})",
    "palette_overlay": _overlay_sql(PETS, True),
    "overlay_plain": _overlay_sql(SIDEWALKS, False),
    "mask_colours": f"SELECT m.vec_id, m.px, m.cls AS class, coalesce(p.r, 0) AS r, coalesce(p.g, 0) AS g, "
                    f"coalesce(p.b, 0) AS b FROM ({ARGMAX}) m LEFT JOIN {_palette_sql(PETS)} ON p.class = m.cls",
}
