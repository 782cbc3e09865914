import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from maskwright.llm import quality
from maskwright.llm.catalog import op13_quality_classifier


def plain_words(text):
    return re.findall(r"[A-Za-z\x80-\U0010FFFF]+|[0-9]+|[^A-Za-z0-9\x80-\U0010FFFF\x20\x09-\x0D]+", text or "")


def test_words_against_a_plain_cut():
    rng = random.Random(1)
    texts = [None, "", " \n", "Wort*** 12ab!!x", "THE the The A a ÉÉ"] + [
        "".join(rng.choice("aAé1 .*\n\t") for _ in range(rng.randint(0, 40))) for _ in range(200)]
    classes, first = quality.word_classes(pa.array(texts))
    assert np.diff(first).tolist() == [len(plain_words(t)) for t in texts]
    known = {}
    for word, c in zip([w for t in texts for w in plain_words(t)], classes.tolist()):
        capitals = len(word) > 1 and all("A" <= ch <= "Z" for ch in word)
        key = (re.sub("[A-Z]", lambda m: m[0].lower(), word), capitals)
        assert known.setdefault(key, c) == c
    assert len(set(known.values())) > 0.9 * len(known)
    assert known[("the", False)] != known[("the", True)]


def test_context_sums_against_the_definition(spark):
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["a", "b", "c", "dd", "!!"]) for _ in range(rng.randint(0, 12))) for _ in range(40)] + [None]
    places, signs = quality.index_vectors()
    assert all(len(set(row)) == quality.ONES for row in places[:500].tolist())
    index = np.zeros((quality.WORDS, quality.DIMS))
    np.put_along_axis(index, places, signs, 1)
    want, seen = np.zeros((quality.WORDS, quality.DIMS)), np.zeros(quality.WORDS)
    for text in texts:
        words = quality.word_classes(pa.array([text]))[0].tolist()
        for i, word in enumerate(words):
            seen[word] += 1
            for j in range(max(0, i - quality.REACH), min(len(words), i + quality.REACH + 1)):
                if j != i:
                    want[word] += np.roll(index[words[j]], quality.DIMS // 2) if j > i else index[words[j]]
    context = want / np.maximum(seen, 1)[:, None]
    context -= (context * seen[:, None]).sum(0) / seen.sum()
    context /= np.maximum(np.linalg.norm(context, axis=1), 1e-9)[:, None]
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(4)
    vectors, weights = quality.corpus_vectors(df)
    assert np.allclose(vectors, context + index / 2, atol=1e-5)
    assert np.allclose(weights, 1e-3 / (1e-3 + seen / seen.sum()))


def test_temperature_calibrates():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(6000, 4))
    truth = 1 / (1 + np.exp(-2 * x[:, 0]))
    y = (rng.random(6000) < truth).astype(float)
    net = quality.train(x, y, np.arange(6000) % 5 == 0)
    fresh = rng.normal(size=(4000, 4))
    found = net.score(fresh)
    assert np.abs(found - 1 / (1 + np.exp(-2 * fresh[:, 0]))).mean() < 0.06


@pytest.fixture(scope="module")
def scored(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    return op13_quality_classifier(spark, folder).join(labels, "doc_id").select(
        "doc_id", "held_out", "score", "predicted", "quality").toPandas()


def test_held_out_accuracy(scored):
    assert (scored.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in scored.doc_id]).all()
    rest = scored[scored.held_out]
    assert len(rest) > 700 and (rest.predicted == rest.quality).mean() > 0.97
    assert (rest[rest.quality == 1].predicted == 1).mean() > 0.99
    assert abs(rest.score.mean() - rest.quality.mean()) < 0.03 and rest.score.between(0, 1).all()


def test_odd_rows_and_labels(spark):
    rng = random.Random(8)
    good = [(i, " ".join(rng.choice(["the", "of", "house", "tree"]) for _ in range(30)), "x") for i in range(0, 60)]
    bad = [(i, " ".join(rng.choice(["$$$", "###", "!!"]) for _ in range(30)), "x") for i in range(60, 120)]
    odd = [(None, "the tree", "x"), (200, None, "x"), (201, "", "x"), (202, " \n\t", "x"), (203, "the of " * 300_000, "x"),
           (5, "!! !!", "x"), (204, "漢字", "x")]
    schema = "doc_id bigint, text string, score string"
    docs = spark.createDataFrame(good + bad + odd, schema)
    labels = [(i, int(i < 60)) for i in range(118)] * 2 + [(118, 0), (118, 1), (None, 1), (119, None), (200, 7), (999, 1)]
    labels = spark.createDataFrame(labels, "doc_id bigint, quality int")
    model = quality.fit(docs, labels)
    out = quality.score(docs, model)
    assert out.columns == ["doc_id", "text", "score"]
    rows = out.collect()
    scores = {r.doc_id: r.score for r in rows if r.doc_id != 5}
    assert len(rows) == 127 and scores[1] > 0.7 > 0.3 > scores[61] and scores[203] > 0.5
    assert scores[200] == scores[201] == scores[202] and all(0 <= s <= 1 for s in scores.values())
    again = quality.score(docs.repartition(3), quality.fit(docs.repartition(7), labels.repartition(5))).collect()
    assert sorted((r.text or "", round(r.score, 6)) for r in again) == sorted((r.text or "", round(r.score, 6)) for r in rows)
    assert quality.score(docs.limit(0), model).count() == 0
    small = quality.fit(docs, labels, sample=20)
    assert small.score(pa.array([good[0][1]]))[0] > 0.5 > small.score(pa.array([bad[0][1]]))[0]


@pytest.mark.parametrize("held, want", [([], 0.5), ([(1, 1)], 1.0), ([(1, 0), (2, 0)], 0.0)])
def test_without_two_labels(spark, held, want):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id bigint, text string")
    model = quality.fit(docs, spark.createDataFrame(held, "doc_id bigint, quality int"))
    assert [r.score for r in quality.score(docs, model).collect()] == [want, want]
    empty = docs.limit(0)
    assert quality.score(empty, quality.fit(empty, spark.createDataFrame(held, "doc_id bigint, quality int"))).count() == 0
