"""A whole dataset run with a training callback of the user's own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from maskwright.catalog.files import _SHARDED, _records, _schema_file
from maskwright.catalog.views import PIXELS
from maskwright.operators import registry
from maskwright.operators.scoring import CentroidModel
from maskwright.plans import dataset_run
from maskwright.session import scratch_path


def fit_midpoints(train: DataFrame, config: dataset_run.RunConfig) -> CentroidModel:
    """A training callback: the centre of a class lies half-way between its smallest and its largest pixel."""
    pixels = train.select(F.explode(F.arrays_zip(F.col("image_xf"), F.col("label_xf"))).alias("p"))
    x = F.col("p.image_xf").cast("double")
    ends = pixels.groupBy(F.col("p.label_xf").cast("int").alias("class")).agg(((F.min(x) + F.max(x)) / 2).alias("centre"))
    rows = ends.orderBy("class").collect()  # a row per class
    return CentroidModel(tuple(r["class"] for r in rows), tuple((r["centre"],) for r in rows))


def callback_run(spark: SparkSession, folder: str) -> DataFrame:
    """Record shards imported, profiled, checked, fitted by ``fit_midpoints``, judged and published: its metrics and model."""
    paths = {c: scratch_path(spark, c) for c in ("root", "registry", "serving")}
    result = dataset_run.run(spark, dataset_run.RunConfig(
        records=_records(spark, folder), schema=_schema_file(spark, folder), channels=1, clock=7,
        preprocess="maskwright.catalog.running.image_and_label", fit="maskwright.catalog.running.fit_midpoints", **paths))
    model = registry.latest_uri(registry.read_registry(spark, paths["registry"]), dataset_run.MODEL)
    centres = spark.read.parquet(model).select(
        F.concat(F.lit("centre "), F.col("class")).alias("what"), F.round(F.get("centre", F.lit(0)), 6).alias("value"))
    return centres.unionByName(result.metrics.select("metric", F.col("value")).toDF("what", "value").withColumn(
        "value", F.round("value", 6)))


def image_and_label(df: DataFrame) -> DataFrame:
    """A preprocessing callback: the library's own, without the key that these records carry."""
    from maskwright.operators.tensors import preprocess

    return preprocess(df.drop("vec_id"))


QUERIES = {f.__name__: f for f in (callback_run,)}

_XF = (f"SELECT split, px % 3 + 1 AS cls, CAST(CAST(px AS FLOAT) / CAST(127.5 AS FLOAT) - CAST(1 AS FLOAT) AS DOUBLE) AS x "
       f"FROM ({_SHARDED}) JOIN ({PIXELS}) USING (vec_id)")
ORACLES = {
    "callback_run": f"""
WITH xf AS ({_XF}), kinds AS (SELECT split, cls, x, count(*) AS n FROM xf GROUP BY ALL),
centre AS (SELECT cls, (min(x) + max(x)) / 2 AS m FROM kinds WHERE split = 'train' GROUP BY cls),
best AS (SELECT kinds.cls, kinds.n, (SELECT c.cls FROM centre c ORDER BY (kinds.x - c.m) * (kinds.x - c.m), c.cls LIMIT 1) AS pred
  FROM kinds WHERE split = 'eval')
SELECT 'centre ' || cls AS what, round(m, 6) AS value FROM centre
UNION ALL SELECT 'SparseCategoricalAccuracy', round(CAST(sum(n) FILTER (WHERE cls = pred) AS DOUBLE) / sum(n), 6) FROM best""",
}
