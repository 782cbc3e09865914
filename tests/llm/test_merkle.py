import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from maskwright.llm import merkle
from maskwright.llm.catalog import op11_merkle_manifest


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def climb(nodes, fanout):
    """Subroot of a list of digests, and for each the (before, behind) of every level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i:i + fanout] for i in range(0, len(nodes), fanout)]
        for leaf, node in enumerate(at):
            run, slot = runs[node // fanout], node % fanout
            paths[leaf].append(("".join(run[:slot]), "".join(run[slot + 1:])))
        nodes, at = [digest("".join(run)) for run in runs], [node // fanout for node in at]
    return nodes[0] if nodes else None, paths


def plain(rows, fanout):
    """rows of (group, key, digest) -> sorted results."""
    order = lambda v: (v is not None, v)
    out, tops = [], []
    groups = sorted({g for g, _, _ in rows}, key=lambda g: (g is not None, (g or "").encode()))
    for g in groups:
        held = sorted((r for r in rows if r[0] == g), key=lambda r: (order(r[1]), r[2]))
        top, paths = climb([r[2] for r in held], fanout)
        tops.append(top)
        out.append([(g, k, d, i, p) for i, ((_, k, d), p) in enumerate(zip(held, paths))])
    root, above = climb(tops, fanout)
    return [(g, k, d, i, top, root, p + up) for held, top, up in zip(out, tops, above) for g, k, d, i, p in held]


def as_rows(df):
    return [(r["g"], r["k"], r["d"], r["position"], r["subroot"], r["root"], [tuple(s) for s in r["siblings"]])
            for r in df.collect()]


@pytest.mark.parametrize("fanout", [2, 3, 300])
def test_against_a_plain_tree(spark, monkeypatch, fanout):
    monkeypatch.setattr(merkle, "BLOCK", 8)  # several rounds
    rng = random.Random(fanout)
    rows = [(rng.choice(["a", "é", "b", None, "Z", ""]), rng.choice([None, *range(60)]), digest(str(rng.random())))
            for _ in range(60)]
    rows += [("hot", i, digest(str(i % 3))) for i in range(100)] + [("one", 5, digest("x"))]
    rows += [("twin", 1, digest("t"))] * 7
    df = spark.createDataFrame(rows, "g string, k bigint, d string").repartition(5)
    found = as_rows(merkle.manifest(df, "d", "g", ["k"], fanout))
    assert sorted(found, key=str) == sorted(plain(rows, fanout), key=str)


def test_fold_and_proof(spark):
    rows = [("g", i, digest(str(i))) for i in range(11)] + [("h", 1, digest("h"))]
    df = spark.createDataFrame(rows, "g string, k bigint, d string")
    out = merkle.manifest(df, "d", "g", ["k"]).withColumns({
        "to": merkle.folded(F.col("d"), F.col("siblings")), "other": merkle.folded(F.lit("x"), F.col("siblings")),
        "proof": merkle.proof_digest(F.col("siblings"))}).collect()
    assert all(r["to"] == r["root"] != r["other"] for r in out)
    assert all(r["proof"] == digest("".join(a + b for a, b in r["siblings"])) for r in out)


def test_lone_rows_other_columns_and_no_rows(spark):
    df = spark.createDataFrame([(None, None, "d0", 1, "kept")], "g string, k bigint, d string, root int, block string")
    out = merkle.manifest(df, "d", "g", ["k"]).collect()
    assert [(r["root"], r["subroot"], r["siblings"], r["block"], r["position"]) for r in out] == [("d0", "d0", [], "kept", 0)]
    assert merkle.manifest(df.limit(0), "d", "g", ["k"]).count() == 0
    with pytest.raises(ValueError):
        merkle.manifest(df, "d", "g", ["k"], 1)


def test_encoding_tells_values_apart(spark):
    df = spark.createDataFrame([("a", "b"), ("ab", ""), ("", "ab"), (None, "ab"), ("-", "ab"), ("1:é", "x")], "x string, y string")
    leaves = [r[0] for r in df.select(merkle.leaf_digest(F.col("x"), F.col("y"))).collect()]
    assert len(set(leaves)) == 6 and leaves[5] == digest("4:1:é1:x") and leaves[3] == digest("-2:ab")


def test_query_with_nulls_and_long_texts(spark, tmp_path):
    rng = random.Random(3)
    docs = [(i, None if i % 5 == 0 else "wörd " * rng.randint(0, 40), rng.choice([None, "en", "de"]), None if i % 3 else "s",
             None if i % 4 == 0 else i) for i in range(90)]
    docs += [(None, "x", "en", "s", 1), (500, "long " * 400_000, "fr", "s", 3), (7, "again", "en", None, 2)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, root string"
    spark.createDataFrame([(*d, "r") for d in docs], schema).write.parquet(str(tmp_path / "documents.parquet"))

    def leaf(d, more=0):
        i, text, lang, source, n = d
        values = [i, source, lang, None if n is None else n + more, text]
        return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))

    by_leaf = {leaf(d): d for d in docs}
    want = []
    for g, k, d, _, top, root, path in plain([(d[2], d[0], leaf(d)) for d in docs], 2):
        doc = by_leaf[d]
        touched = k is not None and zlib.crc32(str(k).encode()) % 7 == 0
        node = leaf(doc, 1) if touched else d
        for before, behind in path:
            node = digest(before + node + behind)
        want.append((k, d, top, root, digest("".join(a + b for a, b in path)), node, node == root))
    found = [tuple(r) for r in op11_merkle_manifest(spark, str(tmp_path)).collect()]
    assert sorted(found, key=str) == sorted(want, key=str)
    assert {r[6] for r in found} == {True, False}
