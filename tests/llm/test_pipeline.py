"""Each stage on a small table with planted cases, and the whole run."""

import time

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from maskwright.session import materialise

from test_jaccard import grams

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    """The test documents with rows that share an id, rows that repeat, nulls, other scripts and empty texts."""
    real = spark.read.parquet(f"{FOLDER}/documents.parquet")
    text = real.orderBy("doc_id").first().text
    extra = [(900_001, None, "en", "s", 0), (900_002, "", None, None, None), (None, text + " more", "en", "s", 1),
             (900_003, "漢字だけの長い文章をここに書いてみる。" * 9, None, "s", 1), (900_004, "12 34 56", "en", "s", 1),
             (900_005, "of the and in that with", "en", "s", 5), (900_005, "of the and in that with", "en", "s", 5)]
    return materialise(real.unionByName(spark.createDataFrame(extra, real.schema)), "pipeline-test")


def ids(df):
    return sorted((r.doc_id for r in df.collect()), key=str)


def test_languages(spark, docs):
    kept = corpus_pipeline.known_language(spark, docs, FOLDER)
    assert kept.columns == docs.columns
    gone = set(ids(docs)) - set(ids(kept))
    assert {900_001, 900_002, 900_003, 900_004} <= gone and len(gone) <= 5


def test_near_copies(spark, docs):
    kept = corpus_pipeline.one_of_near_copies(spark, docs, FOLDER)
    assert kept.columns == docs.columns
    rows = [(r.doc_id, grams(r.text)) for r in docs.collect()]
    left = [(r.doc_id, grams(r.text)) for r in kept.collect()]
    alike = lambda a, b: a and 100 * len(a & b) >= 75 * len(a | b)
    assert not [1 for i, (_, a) in enumerate(left) for _, b in left[i + 1:] if alike(a, b)]
    # who has no near copy stays
    alone = [i for k, (i, a) in enumerate(rows) if not any(alike(a, b) for m, (_, b) in enumerate(rows) if m != k)]
    assert set(alone) <= {i for i, _ in left} and len(left) < len(rows)
    assert ids(kept).count(900_005) == 1


def test_columns_of_any_name_are_kept(spark):
    rows = [(i, f"{w} " * 3 + "of the and in that", 7, "c") for i, w in ((1, "one"), (2, "two"), (2, "two"), (3, "three"))]
    docs = spark.createDataFrame(rows + [(4, "", 8, "c"), (4, "", 8, "c")], "doc_id bigint, text string, key int, Check string")
    kept = corpus_pipeline.one_of_near_copies(spark, docs, FOLDER)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect())) == sorted({r for r in rows} | {(4, "", 8, "c")}) + [(4, "", 8, "c")]


def test_near_copies_shuffles_texts_once(spark, docs, capsys):
    """Rows that are alike and all others are read from one shuffle, not from one each."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = corpus_pipeline.one_of_near_copies(spark, docs, FOLDER)
        assert ids(kept).count(900_005) == 1
        kept.explain()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    ran = capsys.readouterr().out.partition("Initial Plan")[0]
    assert "Union" in ran and sum("FileScan" in x and "text" in x for x in ran.splitlines()) == 1


def test_no_shuffle_outlives_its_step(spark):
    """What is materialised has no shuffle files left, so the disk holds one step's at a time."""
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
    shuffles = lambda: {x for x in env.blockManager().diskBlockManager().getAllBlocks().mkString(" ").split()
                        if x.startswith("shuffle_")}
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, was = shuffles(), spark.conf.get(setting, None)
    counts = spark.range(1000).repartition(4, "id").groupBy((F.col("id") % 7).alias("k")).count()
    for _ in range(2):  # the same DataFrame may be written again
        assert sum(r["count"] for r in materialise(counts, "shuffled").collect()) == 1000
    for _ in range(50):  # Spark deletes in the background
        if shuffles() <= before:
            break
        time.sleep(0.1)
    assert shuffles() <= before and spark.conf.get(setting, None) == was


def test_leaks_go_and_others_stay(spark, docs):
    items = [r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    kept = corpus_pipeline.without_benchmark(spark, docs, FOLDER)
    gone = {r.doc_id for r in docs.collect()} - {r.doc_id for r in kept.collect()}
    holds = {r.doc_id for r in docs.collect() if any(t in (r.text or "") for t in items)}
    assert kept.columns == docs.columns and holds <= gone and len(gone) <= len(holds) + 3


def test_run(spark):
    packed = entry.queries()["pipeline"](spark, FOLDER)
    rows = packed.collect()
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    assert all(sum(r.length for r in p) == p[0].doc_tokens for p in by_doc.values())
    assert 100 < len(by_doc) < 200
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language ID", "near duplicates", "benchmark decontamination", "packing"]


def test_every_stage_takes_an_empty_table(spark, docs):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), FOLDER).count() == 0


def test_registered():
    names = list(entry.queries())
    assert {f"op{n}_" for n in range(1, 14)} <= {n.split("_")[0] + "_" for n in names} and "pipeline" in names
