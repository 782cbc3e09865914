"""Registry, blessing, publishing, sync."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from maskwright.catalog.evaluating import _checks
from maskwright.catalog.views import embeddings, table
from maskwright.operators import filetree, gate, registry
from maskwright.session import scratch_path

CLOCK = 1_700_000_000
PREFIX = "https://models.example"


def _events(spark: SparkSession, folder: str) -> DataFrame:
    """Events as a registry: the type of an event is an artifact type, its id the order."""
    return table(spark, folder, "events").select(
        F.col("event_id").alias("seq"), F.col("event_type").alias("type_name"),
        F.concat(F.lit("run/"), F.col("user_id").cast("string")).alias("uri"),
        (F.col("value") >= 100).alias("blessed"))


def artifacts_by_type(spark: SparkSession, folder: str) -> DataFrame:
    return registry.by_type(_events(spark, folder), "view").select("seq", "uri")


def latest_artifact(spark: SparkSession, folder: str) -> DataFrame:
    return registry.latest(_events(spark, folder), "type_name", "seq", "uri")


def latest_blessed(spark: SparkSession, folder: str) -> DataFrame:
    return registry.latest_blessed(_events(spark, folder), "blessed", "seq", "uri", "type_name")


def gated_publish(spark: SparkSession, folder: str) -> DataFrame:
    """Publish the embeddings if the gate is passed, then show the record of the attempt."""
    decision = gate.bless(_checks(spark, folder))
    target = scratch_path(spark, "serving")
    written = registry.publish(embeddings(spark, folder), decision, target, CLOCK)
    rows = spark.read.parquet(target).count() if written else 0
    return registry.push_record(decision, CLOCK, "me", "segmentation", PREFIX).withColumn(
        "rows", F.lit(rows).cast("bigint"))


def refused_publish(spark: SparkSession, folder: str) -> DataFrame:
    """A limit no rule can meet: nothing is published."""
    decision = gate.bless(gate.check(_checks(spark, folder).select(
        *gate.SLICE, "n", "candidate", "baseline"), [gate.Threshold("SparseCategoricalAccuracy", lower_bound=1.01)]))
    written = registry.publish(embeddings(spark, folder), decision, scratch_path(spark, "serving"), CLOCK)
    return registry.push_record(decision, CLOCK, "me", "segmentation", PREFIX).withColumn(
        "rows", F.lit(-1 if written else 0).cast("bigint"))


def registry_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Events kept as a registry table, one record appended, the last record of every type looked up."""
    path = scratch_path(spark, "registry")
    events = _events(spark, folder).select(
        "seq", "type_name", F.lit("event").alias("name"), "uri",
        F.create_map(F.lit("blessed"), F.col("blessed").cast("int").cast("string")).alias("properties"))
    events.write.partitionBy("type_name").parquet(path)
    registry.append_record(spark, path, 10**12, "signup", "event", "run/last", {"blessed": "1"})
    last = registry.latest(registry.read_registry(spark, path), "type_name", "seq", "uri", "properties")
    return last.select("type_name", "seq", "uri", F.element_at("properties", "blessed").alias("blessed"))


def registry_places(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs with one clock value, made of each type's last and first event: the later run is the latest."""
    path = scratch_path(spark, "registry")
    ends = _events(spark, folder).groupBy("type_name").agg(F.max_by("uri", "seq").alias("last"), F.min_by("uri", "seq").alias("first"))
    rows = ends.orderBy("type_name").collect()  # a row per type
    for end in ("last", "first"):
        registry.append_run(spark, path, [(r["type_name"], end, r[end], {"run": "7"}) for r in rows])
    return registry.latest(registry.read_registry(spark, path), "type_name", "seq", "name", "uri")


def retention_sync(spark: SparkSession, folder: str) -> DataFrame:
    top = F.element_at(F.array(F.lit(".git/"), F.lit(".gitattributes"), F.lit("app/"), F.lit(".github/")),
                       (F.col("doc_id") % 4 + 1).cast("int"))
    existing = table(spark, folder, "documents").select(
        F.when(F.col("doc_id") % 4 == 1, F.lit(".gitattributes")).otherwise(
            F.concat(top, F.col("doc_id").cast("string"), F.lit(".txt"))).alias("path"), F.col("text").alias("content"))
    incoming = table(spark, folder, "pages").select(
        F.concat(F.when(F.col("page_id") == 0, F.lit(".gitattributes")).otherwise(
            F.concat(F.lit("app/"), F.col("page_id").cast("string"), F.lit(".html")))).alias("path"),
        F.col("html").alias("content"))
    synced = filetree.sync(existing, incoming)
    return synced.groupBy("path", F.md5(F.encode("content", "UTF-8")).alias("content")).agg(F.count(F.lit(1)).alias("n"))


QUERIES = {f.__name__: f for f in (
    artifacts_by_type, latest_artifact, latest_blessed, gated_publish, refused_publish, registry_roundtrip,
    registry_places, retention_sync)}

_BLESSED = ("SELECT bool_and(c >= CAST(0.55 AS DOUBLE) AND c - b >= CAST(-0.001 AS DOUBLE)) AS ok, "
            "count(*) AS checks, count(*) FILTER (WHERE NOT (c >= CAST(0.55 AS DOUBLE) AND "
            "c - b >= CAST(-0.001 AS DOUBLE))) AS failed FROM ("
            "SELECT lang, avg(CASE WHEN (n_chars >= 200) = (quality = 1) THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) "
            "END) AS c, avg(CASE WHEN (n_chars >= 2000) = (quality = 1) THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) "
            "END) AS b FROM labels JOIN documents USING (doc_id) GROUP BY GROUPING SETS ((), (lang)))")

ORACLES = {
    "artifacts_by_type": "SELECT event_id AS seq, 'run/' || user_id AS uri FROM events WHERE event_type = 'view'",
    "latest_artifact": "SELECT event_type AS type_name, max(event_id) AS seq, arg_max('run/' || user_id, event_id) "
                       "AS uri FROM events GROUP BY ALL",
    "latest_blessed": "SELECT event_id AS seq, 'run/' || user_id AS uri, event_type AS type_name FROM events "
                      "WHERE value >= 100 ORDER BY event_id DESC LIMIT 1",
    "gated_publish": f"""
SELECT checks, failed, CAST(ok AS INTEGER) AS pushed, CASE WHEN ok THEN 'v{CLOCK}' END AS pushed_version,
  CASE WHEN ok THEN 'v{CLOCK}' END AS branch, CASE WHEN ok THEN 'me/segmentation' END AS repo_id,
  CASE WHEN ok THEN '{PREFIX}/me/segmentation' END AS repo_url,
  CASE WHEN ok THEN (SELECT count(*) FROM embeddings) ELSE 0 END AS rows FROM ({_BLESSED})""",
    "refused_publish": "SELECT checks, checks AS failed, 0 AS pushed, CAST(NULL AS VARCHAR) AS pushed_version, CAST(NULL AS VARCHAR) AS branch, "
                       "CAST(NULL AS VARCHAR) AS repo_id, CAST(NULL AS VARCHAR) AS repo_url, "
                       f"CAST(0 AS BIGINT) AS rows FROM ({_BLESSED})",
    "registry_roundtrip": """
SELECT event_type AS type_name, CASE WHEN event_type = 'signup' THEN 1000000000000 ELSE max(event_id) END AS seq,
  CASE WHEN event_type = 'signup' THEN 'run/last' ELSE arg_max('run/' || user_id, event_id) END AS uri,
  CASE WHEN event_type = 'signup' OR arg_max(value >= 100, event_id) THEN '1' ELSE '0' END AS blessed
FROM events GROUP BY event_type""",
    "registry_places": """
SELECT event_type AS type_name, CAST(2 AS BIGINT) AS seq, 'first' AS name, arg_min('run/' || user_id, event_id) AS uri
FROM events GROUP BY event_type""",
    "retention_sync": """
SELECT path, content, count(*) AS n FROM (
  SELECT '.git/' || doc_id || '.txt' AS path, md5(text) AS content FROM documents WHERE doc_id % 4 = 0
  UNION ALL SELECT CASE WHEN page_id = 0 THEN '.gitattributes' ELSE 'app/' || page_id || '.html' END, md5(html) FROM pages)
GROUP BY ALL""",
}
