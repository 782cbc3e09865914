"""The corpus pipeline: documents in, packed training sequences out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from maskwright.llm import jaccard, language, packing, tiling
from maskwright.llm.catalog import as_digests, table, tokenizer
from maskwright.session import dropping_shuffles, materialise, scratch_path


def _free_names(docs: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until no column of ``docs`` is called so."""
    taken = {c.lower() for c in docs.columns}
    while any(n in taken for n in names):
        names = [n + "_" for n in names]
    return list(names)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that was learned from the labelled ones stay.

    Texts that are null or have no letter go, and so do those much further from every language than labelled texts are.
    """
    model = language.fit(docs)
    return language.predict(docs, model).where("not rejected").select(*docs.columns)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones stays, and one of rows that are alike in doc_id and text.

    Documents are told apart by hashes of doc_id and text, so null and repeated ids do no harm; the one with the smallest
    hash stays. Texts without words are linked with nothing and all stay. Links are found by one hash; should different
    documents share it, a second one tells that they are no repeats, and none goes that may have no link.
    """
    key, check = _free_names(docs, "key", "check")
    keyed = docs.withColumn(key, F.xxhash64("doc_id", "text"))
    found = jaccard.near_duplicates(keyed, id_col=key)
    linked = F.min(F.col(key) != F.col("component_id")).alias("linked")
    several = (F.count(F.lit(1)) > 1) & (F.max("n_shingles") > 0)
    marked = materialise(found.groupBy(key).agg(linked, several.alias("several")).where("linked or several"), "near-copies")
    kept = keyed.join(marked.where("linked"), key, "left_anti")
    repeated = marked.where("not linked").select(key)
    once = kept.join(repeated, key, "left_anti")
    # the second hash comes after the joins, so both branches read one shuffle of the texts
    first = kept.join(repeated, key, "left_semi").withColumn(
        check, F.xxhash64(F.lit(check), "text", "doc_id")).dropDuplicates([key, check]).drop(check)
    return once.unionByName(first).select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that cover half of a benchmark item or more go."""
    return tiling.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents that are left, in sequences of 1,024 ids."""
    return as_digests(packing.pack(docs, tokenizer("byte_bpe_50k.json")))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", known_language),
    ("near duplicates", one_of_near_copies),
    ("benchmark decontamination", without_benchmark),
    ("packing", packed),
]
# Fitted centroids and a tokenizer have no SQL; tests hold each stage against a plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; what a stage returns is written and read again for the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, "pipeline-" + name.replace(" ", "-"))
        left = stage(spark, docs, sf_dir)
        with dropping_shuffles(spark):
            left.write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
