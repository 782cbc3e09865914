"""The registry of produced artifacts: an append-only table.

Columns: ``seq`` (order of production), ``type_name``, ``name``, ``uri``, ``properties``. A run's place in that order is
claimed as the next number (``append_run``), so that runs of one clock value, or at the same time, never tie.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from maskwright.functions.names import repo_id, repo_url, version_name
from maskwright.operators.gate import is_blessed
from maskwright.sources.storage import claim

REGISTRY = "seq bigint, type_name string, name string, uri string, properties map<string,string>"


def append_records(spark: SparkSession, registry: str, records: list[tuple[int, str, str, str, dict]]) -> None:
    """Append the records of one run together, one file per type."""
    spark.createDataFrame(records, REGISTRY).coalesce(1).write.mode("append").partitionBy("type_name").parquet(registry)


def next_place(spark: SparkSession, registry: str) -> int:
    """Take the next place in the order of runs. A run that is lost after that leaves its place empty."""
    return claim(spark, f"{registry.rstrip('/')}/_places")


def append_run(spark: SparkSession, registry: str, records: list[tuple[str, str, str, dict]], place: int | None = None) -> int:
    """Append what a run produced, (type_name, name, uri, properties) each, at its place or the next; returns the place."""
    place = next_place(spark, registry) if place is None else place
    append_records(spark, registry, [(place, *record) for record in records])
    return place


def append_record(spark: SparkSession, registry: str, seq: int, type_name: str, name: str, uri: str,
                  properties: Mapping[str, str] | None = None) -> None:
    append_records(spark, registry, [(seq, type_name, name, uri, dict(properties or {}))])


def read_registry(spark: SparkSession, registry: str) -> DataFrame:
    """All records. Reading by type prunes to that type's folder."""
    return spark.read.schema(REGISTRY).parquet(registry)


def by_type(registry: DataFrame, type_name: str) -> DataFrame:
    return registry.filter(F.col("type_name") == F.lit(type_name))


def latest(registry: DataFrame, group: str, order: str, *columns: str) -> DataFrame:
    """The last record per group (partial ``max_by``: a group is never gathered in one task)."""
    payload = F.struct(order, *[c for c in columns if c != order])
    return registry.groupBy(group).agg(F.max_by(payload, order).alias("_last")).select(group, "_last.*")


def latest_uri(registry: DataFrame, type_name: str) -> str | None:
    """Where the last artifact of a type is, or None."""
    row = latest(by_type(registry, type_name), "type_name", "seq", "uri").first()
    return row["uri"] if row else None


def latest_blessed(registry: DataFrame, blessed: str, order: str, *columns: str) -> DataFrame:
    """The last record that passed its gate: one row, or none while nothing has passed."""
    payload = F.struct(order, *[c for c in columns if c != order])
    return (registry.filter(F.col(blessed)).agg(F.max_by(payload, order).alias("_last"))
            .filter(F.col("_last").isNotNull()).select("_last.*"))


def push_record(decision: DataFrame, clock: int, owner: str, name: str, prefix: str) -> DataFrame:
    """What a publishing attempt records, with the outcome of its gate.

    Only a blessed version has a version, branch and address.
    """
    version = version_name(F.lit(clock))
    only = lambda c: F.when(F.col("blessed"), c)
    outcome = [c for c in ("checks", "failed") if c in decision.columns]
    return decision.select(
        *outcome, F.col("blessed").cast("int").alias("pushed"),
        only(version).alias("pushed_version"), only(version).alias("branch"),
        only(repo_id(F.lit(owner), F.lit(name))).alias("repo_id"),
        only(repo_url(F.lit(prefix), F.lit(owner), F.lit(name))).alias("repo_url"))


def publish(snapshot: DataFrame, blessing: DataFrame | None, destination: str, clock: int) -> str | None:
    """Write ``destination/version=v<clock>`` if the gate was passed; otherwise write nothing.

    Returns the folder written, or None. An existing version is never overwritten.
    """
    if not is_blessed(blessing):
        return None
    folder = f"{destination.rstrip('/')}/version=v{int(clock)}"
    snapshot.write.mode("error").parquet(folder)
    return folder
