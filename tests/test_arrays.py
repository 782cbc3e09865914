import math
import random

import numpy as np
import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from maskwright.functions import arrays
from maskwright.operators import tensors


def one(spark, values, shape, kind="float"):
    return spark.createDataFrame([(values, shape)], f"x array<{kind}>, s array<bigint>")


def get(df, column):
    return df.select(column.alias("out")).first()["out"]


def slow_resize(image, height, width):
    """Bilinear resize written out one pixel at a time, in double precision."""
    rows, cols, channels = len(image), len(image[0]), len(image[0][0])
    out = []
    for y in range(height):
        py = (y + 0.5) * rows / height - 0.5
        y0, y1, wy = max(math.floor(py), 0), min(math.ceil(py), rows - 1), py - math.floor(py)
        for x in range(width):
            px = (x + 0.5) * cols / width - 0.5
            x0, x1, wx = max(math.floor(px), 0), min(math.ceil(px), cols - 1), px - math.floor(px)
            for c in range(channels):
                top = image[y0][x0][c] * (1 - wx) + image[y0][x1][c] * wx
                bottom = image[y1][x0][c] * (1 - wx) + image[y1][x1][c] * wx
                out.append(top * (1 - wy) + bottom * wy)
    return out


def test_resize_halves_by_averaging(spark):
    df = one(spark, [0.0, 2.0, 4.0, 6.0], [2, 2, 1])
    assert get(df, arrays.resize(F.col("x"), F.col("s"), 1, 1)) == [3.0]


def test_resize_doubles_with_clamped_edges(spark):
    df = one(spark, [0.0, 4.0], [1, 2])
    assert get(df, arrays.resize(F.col("x"), F.col("s"), 1, 4)) == [0.0, 1.0, 3.0, 4.0]


@pytest.mark.parametrize("size,target", [((5, 5), (3, 3)), ((7, 7), (4, 4)), ((3, 4), (8, 5)), ((128, 128), (100, 100))])
def test_resize_matches_a_pixel_loop(spark, size, target):
    rng = random.Random(1)
    image = [[[float(rng.randrange(256)) for _ in range(3)] for _ in range(size[1])] for _ in range(size[0])]
    flat = [v for row in image for px in row for v in px]
    got = get(one(spark, flat, [*size, 3]), arrays.resize(F.col("x"), F.col("s"), *target))
    assert np.allclose(got, slow_resize(image, *target), atol=1e-2)


def test_resize_to_the_same_size_is_the_identity(spark):
    values = [float(v) for v in range(27)]
    assert get(one(spark, values, [3, 3, 3]), arrays.resize(F.col("x"), F.col("s"), 3, 3)) == values


def test_resize_nearest_keeps_classes(spark):
    df = one(spark, [0.0, 1.0, 2.0, 0.0], [2, 2])
    got = get(df, arrays.resize(F.col("x"), F.col("s"), 4, 4, "nearest"))
    assert got == [0, 0, 1, 1, 0, 0, 1, 1, 2, 2, 0, 0, 2, 2, 0, 0]


def test_mixed_shapes_and_nulls_in_one_batch(spark):
    df = spark.createDataFrame([(0, [0.0, 4.0], [1, 2]), (1, None, [1, 2]), (2, [1.0, 2.0, 3.0, 6.0], [2, 2]),
                                (3, [2.0, 2.0], [2, 1])],
                               "k int, x array<float>, s array<bigint>").coalesce(1)
    rows = df.select("k", arrays.resize(F.col("x"), F.col("s"), 1, 1).alias("o")).orderBy("k").collect()
    assert [r["o"] for r in rows] == [[2.0], None, [3.0], [2.0]]


def test_wrong_shape_fails_the_job(spark):
    with pytest.raises(PythonException, match="does not fit shape"):
        get(one(spark, [1.0, 2.0, 3.0], [2, 2]), arrays.resize(F.col("x"), F.col("s"), 1, 1))
    df = tensors.check_shapes(one(spark, [1.0, 2.0, 3.0], [2, 2]), "x", "s")
    with pytest.raises(Exception, match="does not fit"):
        df.collect()


def test_resize_pair_shifts_only_when_resizing(spark):
    df = spark.createDataFrame([([0.0] * 12, [2, 2, 3], [1.0, 3.0, 1.0, 3.0], [2, 2])],
                               "image array<float>, image_shape array<bigint>, label array<float>, label_shape array<bigint>")
    small = tensors.resize_pair(df, 1).first()
    assert small["label"] == [1.0] and small["label_shape"] == [1, 1] and small["image_shape"] == [1, 1, 3]
    assert tensors.resize_pair(df, None).first()["label"] == [1.0, 3.0, 1.0, 3.0]
    assert tensors.resize_pair(df, 1, shift=False).first()["label"] == [2.0]


def test_scalings(spark):
    df = one(spark, [0.0, 127.5, 255.0], [3])
    assert get(df, arrays.normalise(F.col("x"))) == [-1.0, 0.0, 1.0]
    assert get(df, arrays.scale01(F.col("x"))) == [0.0, 0.5, 1.0]


def test_clip_and_cast(spark):
    df = one(spark, [-3.7, 1.9, 300.2, 255.9], [4])
    assert get(df, arrays.to_uint8(arrays.clip(F.col("x"), 0, 255))) == [0, 1, 255, 255]
    assert get(df, arrays.to_uint8(F.col("x"))) == [253, 1, 44, 255]


def test_argmax_takes_the_first_maximum(spark):
    df = one(spark, [1.0, 5.0, 5.0, 2.0, 2.0, 2.0], [2, 1, 3])
    assert get(df, arrays.argmax(F.col("x"), F.col("s"))) == [1, 0]


def test_standardised_channels_have_mean_zero(spark):
    rng = np.random.default_rng(3)
    values = rng.normal(5, 2, 48).astype(np.float32)
    got = np.array(get(one(spark, values.tolist(), [4, 4, 3]),
                       arrays.standardise_channels(F.col("x"), F.col("s"), 1e-5))).reshape(16, 3)
    assert np.allclose(got.mean(axis=0), 0, atol=1e-9) and np.allclose(got.var(axis=0), 1, atol=1e-3)
    scaled = np.array(get(one(spark, values.tolist(), [4, 4, 3]), arrays.standardise_channels(
        F.col("x"), F.col("s"), 1e-5, (2.0, 2.0, 2.0), (1.0, 0.0, 0.0)))).reshape(16, 3)
    assert np.allclose(scaled, got * 2 + [1, 0, 0])


def test_dataset_standardise_matches_numpy(spark):
    rng = np.random.default_rng(4)
    data = rng.normal(0, 1, (10, 8)).astype(np.float32)
    df = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(data)], "k int, x array<float>")
    rows = tensors.standardise_dataset(df, "x", 2, 1e-3).orderBy("k").collect()
    wide = data.astype(float).reshape(-1, 2)
    want = (wide - wide.mean(0)) / np.sqrt(wide.var(0) + 1e-3)
    assert np.allclose(np.array([r["x"] for r in rows]).reshape(-1, 2), want)


def test_transpose_and_concat(spark):
    df = one(spark, [float(v) for v in range(6)], [2, 3])
    assert get(df, arrays.transpose(F.col("x"), F.col("s"), (1, 0))) == [0, 3, 1, 4, 2, 5]
    assert get(df, arrays.transposed_shape(F.col("s"), (1, 0))) == [3, 2]
    left = spark.createDataFrame([(1, [1.0, 2.0], [1, 2, 1])], "k int, x array<float>, s array<bigint>")
    right = spark.createDataFrame([(1, [3.0, 4.0, 5.0, 6.0], [1, 2, 2])], "k int, x array<float>, s array<bigint>")
    row = tensors.concat_tensors(left, right, "k", "x", "s").first()
    assert row["x"] == [1, 3, 4, 2, 5, 6] and row["s"] == [1, 2, 3]


def test_shape_edits(spark):
    df = one(spark, [1.0], [1, 8, 1])
    assert get(df, arrays.squeeze(F.col("s"))) == [8]
    assert get(df, arrays.expand_dims(F.col("s"), 0)) == [1, 1, 8, 1]
    assert get(df, arrays.expand_dims(F.col("s"), 2)) == [1, 8, 1, 1]
    assert get(df, arrays.expand_dims(F.col("s"), -1)) == [1, 8, 1, 1]


def test_payload_bytes_round_trip(spark):
    df = spark.createDataFrame([([0, 255, 7],), (None,), ([],)], "x array<int>").coalesce(1)
    back = df.select(arrays.unpack_uint8(arrays.pack_uint8(F.col("x"))).alias("y")).collect()
    assert [r["y"] for r in back] == [[0, 255, 7], None, []]


def test_cells_have_row_major_coordinates(spark):
    df = spark.createDataFrame([([10, 11, 12, 13, 14, 15],)], "x array<int>")
    rows = tensors.to_cells(df, "x", (3, 2), ("y", "x_"), "v").collect()
    assert [(r["y"], r["x_"], r["v"]) for r in rows] == [
        (0, 0, 10), (0, 1, 11), (1, 0, 12), (1, 1, 13), (2, 0, 14), (2, 1, 15)]


def test_callbacks_by_dotted_name():
    assert tensors.load_callable("maskwright.operators.tensors.preprocess") is tensors.preprocess
    with pytest.raises(ValueError):
        tensors.load_callable("preprocess")


def test_unrolling_runs_an_arrow_function_once(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0], [2]), (2, None, [2]), (3, [], [0])],
                               "k int, x array<float>, s array<bigint>")
    rows = arrays.unroll(df.withColumn("m", arrays.argmax(F.col("x"), F.array(F.lit(1), F.lit(2)).cast("array<bigint>"))
                                       ).filter("k = 1"), "m", "i", "v", "k")
    assert rows.collect() == [(1, 0, 1)]
    assert rows._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert arrays.unroll(df, "x", "i", "v", "k").count() == 2
