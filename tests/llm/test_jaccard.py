"""The n-gram join and components against plain versions in Python."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from maskwright.llm import jaccard
from maskwright.llm.graph import components
from maskwright.llm.words import chunks, distinct_runs, run_hashes, word_hashes

SCHEMA = "doc_id bigint, text string, id_ string, text_ int, node string"


def grams(text, size=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)}


def plain_components(nodes, edges):
    least = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(least[a], least[b])
            changed |= least[a] != low or least[b] != low
            least[a] = least[b] = low
    return least


def plain(rows):
    sets = {i: grams(t) for i, t in rows}
    ids = sorted(sets)
    edges = [(a, b) for a in ids for b in ids if a < b and sets[a]
             and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    least = plain_components(ids, edges)
    return {(i, len(sets[i]), least[i]) for i in ids}


def changed(rng, words, share):
    return [rng.choice("pqrs") * 3 if rng.random() < share else w for w in words]


@pytest.fixture(scope="module")
def texts():
    """Groups of near copies around the threshold, a passage that many share, short and empty texts."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    passage = [word() for _ in range(60)]
    out = []
    for size in (2, 3, 30):
        base = [word() for _ in range(rng.randint(40, 120))]
        out += [" ".join(changed(rng, base, 0.025)) for _ in range(size)]
    out += [" ".join([word() for _ in range(rng.randint(5, 80))] + passage) for _ in range(25)]
    out += ["", " \t\n", "one two", "ONE  Two", "one two three four five", "É a b c d e", "é a b c d e", out[0], out[0]]
    return list(enumerate(out)) + [(1000 + i, t) for i, t in enumerate(out[30:40])]


def test_components_of_links(spark, texts):
    df = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in texts], SCHEMA).repartition(3)
    found = {tuple(r) for r in jaccard.near_duplicates(df).collect()}
    assert found == plain(texts)
    assert len({c for _, _, c in found}) < len(texts)


def test_null_and_repeated(spark):
    rows = [(None, "a b c d e f"), (7, "a b c d e f"), (7, "a b c d e f"), (3, None), (None, None), (None, "x y z"),
            (9, "q " * 30_000)]
    found = sorted(map(tuple, jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()),
                   key=str)
    assert found == sorted([(None, 2, 7), (7, 2, 7), (7, 2, 7), (3, 0, 3), (None, 0, None), (None, 1, None), (9, 1, 9)],
                           key=str)


def test_empty_table(spark):
    assert jaccard.near_duplicates(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_step_two_never_counts_too_few(texts):
    held = [t for _, t in texts] * 2
    batches = [pa.RecordBatch.from_arrays([pa.array(held[a:a + 20])], ["text_"]) for a in range(0, len(held), 20)]
    sent = [b for batch in batches for b in jaccard._scatter(5, 8)([batch])]
    counted = {}
    for batch in jaccard._count_shared(sent):
        for node, n in zip(batch["node"].to_pylist(), batch["shared"].to_pylist()):
            counted[node] = counted.get(node, 0) + n
    hashes, offsets, keys = jaccard._hashed(pa.RecordBatch.from_arrays([pa.array(held)], ["text_"]), 5)
    sets = {int(keys[i, 0]): set(hashes[offsets[i]:offsets[i + 1]].tolist()) for i in range(len(held))}
    for node, own in sets.items():
        others = set().union(*[s for k, s in sets.items() if k != node])
        assert counted.get(node, 0) >= len(own & others)


def test_hashes_do_not_depend_on_the_batch():
    held = pa.array(["a b", None, "B a c", "", "  a  ", "x" * 3_000_000 + " a"])
    whole, first = word_hashes(held)
    parts = [word_hashes(held.slice(i, 1))[0] for i in range(len(held))]
    assert np.array_equal(whole, np.concatenate(parts))
    assert whole[0] == whole[3] == whole[5] == whole[7] and whole[1] == whole[2]
    pieces = list(chunks([pa.RecordBatch.from_arrays([held], ["t"])], "t", 4))
    assert sum(map(len, pieces)) == len(held) and np.array_equal(
        whole, np.concatenate([word_hashes(p["t"])[0] for p in pieces]))


def test_runs():
    texts = ["a b c d e f a b c d e", "a b", "", "c"]
    runs, offsets = distinct_runs(*run_hashes(*word_hashes(pa.array(texts)), 5))
    assert np.diff(offsets).tolist() == [len(grams(t)) for t in texts]


def test_connected_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(250)] + [(i, i + 1) for i in range(500, 560)]
    edges = [(a, b) for a, b in edges if a != b]
    found = {r.node: r.comp for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert found == plain_components({n for e in edges for n in e}, edges)
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_ngrams_that_agree_in_their_low_half_are_all_counted(monkeypatch):
    """Two n-grams with one token, shared by a class that comes in a later merge, count twice."""
    def held(node):
        entries = np.array([(5, 0), (5, 0), (9, 0)], jaccard._ENTRY)
        return np.array([1, 0, 0, 3], np.int64).tobytes() + np.array([node], np.int64).tobytes() + entries.tobytes()

    monkeypatch.setattr(jaccard, "_MERGE", 0)
    batches = [pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([held(k)], pa.binary())], ["fragment", "held"])
               for k in (1, 2, 3)]
    found = {}
    for batch in jaccard._count_shared(batches):
        for node, n in zip(batch["node"].to_pylist(), batch["shared"].to_pylist()):
            found[node] = found.get(node, 0) + n
    assert found == {1: 3, 2: 3, 3: 3}
