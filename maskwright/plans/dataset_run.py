"""One whole dataset run: import, profile, check, transform, fit, judge against the last blessed model, publish.

Each step is one of the library's operators; what the run produces is written below
``config.root`` and entered in the registry, so the next run finds its baseline there.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from maskwright.operators import compare, constraints, gate, metrics, profile, registry, scoring, tensors
from maskwright.plans import publish_run
from maskwright.sources import schema_text, tables, tfrecord
from maskwright.operators.tensors import IMAGE, LABEL, transformed_name

MODEL, BLESSING, PUSHED = "Model", "ModelBlessing", "PushedModel"
STATISTICS, SCHEMA, ANOMALIES, EVALUATION = "ExampleStatistics", "Schema", "ExampleAnomalies", "ModelEvaluation"
BYTE_STATISTICS, COMPARISON = "ByteStatistics", "SplitComparison"
METRIC = "SparseCategoricalAccuracy"


@dataclass(frozen=True)
class RunConfig:
    records: str
    schema: str
    root: str
    registry: str
    serving: str
    channels: int = 3
    clock: int = 0
    patterns: dict[str, str] = field(default_factory=lambda: dict(tfrecord.ALL_SHARDS))
    preprocess: str = "maskwright.operators.tensors.preprocess"
    fit: str = "maskwright.plans.dataset_run.fit_pixels"
    slices: tuple[tuple[str, ...], ...] = ((),)
    thresholds: tuple[gate.Threshold, ...] = (gate.DEFAULT_THRESHOLD,)
    application: publish_run.PublishConfig | None = None


@dataclass(frozen=True)
class RunResult:
    anomalies: DataFrame
    metrics: DataFrame
    checks: DataFrame
    blessed: bool
    pushed: str | None
    comparison: DataFrame
    application: dict[str, str] | None


def fit_pixels(train: DataFrame, config: RunConfig) -> scoring.CentroidModel:
    """Default training callback: class centres of the transformed pixels."""
    return scoring.fit_pixel_centroids(train, transformed_name(IMAGE), transformed_name(LABEL), config.channels)


def model_table(spark: SparkSession, model: scoring.CentroidModel) -> DataFrame:
    return spark.createDataFrame([(c, list(m)) for c, m in zip(model.classes, model.centres)],
                                 "class int, centre array<double>")


def load_model(spark: SparkSession, path: str) -> scoring.CentroidModel:
    rows = spark.read.parquet(path).orderBy("class").collect()  # its size was checked when it was fitted
    return scoring.CentroidModel(tuple(r["class"] for r in rows), tuple(tuple(r["centre"]) for r in rows))


def resolve_baseline(spark: SparkSession, path: str) -> scoring.CentroidModel | None:
    """The model of the latest blessed run, or None before there is one."""
    try:
        records = registry.read_registry(spark, path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    blessings = registry.by_type(records, BLESSING).select(
        "seq", "uri", (F.col("properties")["blessed"] == "1").alias("blessed"))
    row = registry.latest_blessed(blessings, "blessed", "seq", "uri").first()
    return load_model(spark, row["uri"]) if row else None


def run(spark: SparkSession, config: RunConfig) -> RunResult:
    preprocess = tensors.load_callable(config.preprocess)
    fit = tensors.load_callable(config.fit)
    features = schema_text.read_schema(spark, config.schema)
    # Record files are rows; they are read once and kept as columns, so later steps open only what they use.
    imported = f"{config.root}/examples/run={config.clock}"
    schema = schema_text.struct_type(features)
    tfrecord.import_splits(spark, config.records, config.patterns, schema=schema).write.partitionBy(
        "split").parquet(imported)
    examples = spark.read.schema(schema.add("split", "string")).parquet(imported)

    numeric = [f.name for f in features if f.type != "BYTES"]
    statistics, anomalies = f"{config.root}/statistics", f"{config.root}/anomalies"
    tables.append_run(profile.feature_stats(examples, numeric), statistics, config.clock, "split")
    tables.append_run(constraints.anomalies(examples, features), anomalies, config.clock)
    byte_statistics, comparison = f"{config.root}/byte_statistics", f"{config.root}/comparison"
    texts = [f.name for f in features if f.type == "BYTES"]
    if texts:
        tables.append_run(profile.bytes_stats(examples, texts), byte_statistics, config.clock, "split")
    tables.append_run(compare.split_skew(examples, numeric, median=profile.SKETCH), comparison, config.clock)

    transformed = f"{config.root}/transformed/run={config.clock}"
    tables.write_transformed(preprocess(examples), transformed)
    train = spark.read.parquet(transformed).filter(F.col("split") == "train")

    model = fit(train, config)
    model_path = f"{config.root}/model/run={config.clock}"
    model_table(spark, model).write.parquet(model_path)
    baseline = resolve_baseline(spark, config.registry)

    # Both models see the same raw rows once; the transform is applied here, as it would be when serving.
    models = {"candidate": model} | ({"baseline": baseline} if baseline else {})
    scored = preprocess(examples.filter(F.col("split") == "eval")).withColumns(
        {name: m.segment(F.col(transformed_name(IMAGE))) for name, m in models.items()})
    evaluation = f"{config.root}/evaluation"
    tables.append_run(metrics.evaluate_models(scored, transformed_name(LABEL), {name: name for name in models},
                                              [METRIC], config.slices), evaluation, config.clock)
    values = tables.read_run(spark, evaluation, config.clock)
    checks = gate.check(gate.compare_models(values), config.thresholds)
    blessing = gate.bless(checks)
    blessed = gate.is_blessed(blessing)

    pushed = registry.publish(model_table(spark, model), blessing, config.serving, config.clock)
    place = registry.next_place(spark, config.registry)
    application = None
    if config.application:
        shared = place if config.application.registry == config.registry else None
        application = publish_run.publish_version(spark, model_table(spark, model), blessing, config.application,
                                                  config.clock, shared)
    flag = str(int(blessed))
    made = {"run": str(config.clock)}
    registry.append_run(spark, config.registry, [
        (STATISTICS, "statistics", statistics, made),
        (SCHEMA, "schema", config.schema, made),
        (ANOMALIES, "anomalies", anomalies, made),
        (COMPARISON, "comparison", comparison, made),
        *([(BYTE_STATISTICS, "byte_statistics", byte_statistics, made)] if texts else []),
        (EVALUATION, "evaluation", evaluation, made),
        (MODEL, "model", model_path, made),
        (BLESSING, "blessing", model_path, made | {"blessed": flag}),
        (PUSHED, "pushed_model", pushed or "", made | {"pushed": flag}),
    ], place)
    return RunResult(tables.read_run(spark, anomalies, config.clock), values, checks, blessed, pushed,
                     tables.read_run(spark, comparison, config.clock), application)
