import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from maskwright.llm import periodic
from maskwright.llm.catalog import op12_periodic_runs


def plain(words):
    """All runs, from the definition."""
    n, found = len(words), []
    for q in range(1, n // 4 + 1):
        for i in range(n):
            if i and i + q - 1 < n and words[i - 1] == words[i + q - 1]:
                continue  # the word before keeps the period
            j = i + q
            while j < n and words[j] == words[j - q]:
                j += 1
            if j - i >= max(6, 4 * q) and not any(
                    all(words[k] == words[k - r] for k in range(i + r, j)) for r in range(1, q)):
                found.append((i, j - i, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def some_words(rng, k):
    words = [rng.randrange(k) for _ in range(rng.randint(0, 60))]
    if rng.random() < 0.6:
        unit = [rng.randrange(k) for _ in range(rng.randint(1, 9))]
        cut = rng.randint(0, len(words))
        words = words[:cut] + (unit * rng.randint(1, 9))[:rng.randint(1, 60)] + words[cut:]
    return words


def test_runs_against_the_definition():
    rng = random.Random(4)
    for _ in range(300):
        docs = [some_words(rng, rng.choice([1, 2, 2, 3, 5])) for _ in range(rng.randint(1, 5))]
        found = periodic.runs_of(np.array(sum(docs, []), np.int64), np.array([len(d) for d in docs])).tolist()
        want, at = [], 0
        for d in docs:
            want += [[s + at, n, q] for s, n, q in plain(d)]
            at += len(d)
        assert found == want, docs


@pytest.mark.parametrize("forward", [True, False])
def test_agreement_against_a_plain_count(forward):
    rng = random.Random(7)
    body = sum([some_words(rng, 2) for _ in range(30)], [])
    symbols = np.array([98, *body, 99])
    grammar = periodic.Grammar(symbols)
    a = np.array([rng.randrange(1, len(body)) for _ in range(500)])
    b = np.array([rng.choice([i for i in range(1, len(body) + 1) if i != x]) for x in a])
    sign = 1 if forward else -1

    def count(x, y):
        n = 0
        while symbols[x] == symbols[y]:
            x, y, n = x + sign, y + sign, n + 1
        return n

    assert grammar.agree(a, b, forward).tolist() == [count(x, y) for x, y in zip(a, b)]


def test_long_texts_in_bounded_time():
    for words, want in ((np.zeros(300_000, np.int64), [[0, 300_000, 1]]),
                        (np.tile(np.arange(1000), 200), [[0, 200_000, 1000]]),
                        (np.arange(300_000), [])):
        assert periodic.runs_of(words, np.array([len(words)])).tolist() == want


def test_documents(spark, monkeypatch):
    monkeypatch.setattr(periodic, "PIECE", 40)
    rng = random.Random(9)
    texts = [None, [], ["a"] * 5, ["a"] * 6, ["é", "b"] * 4, ["x", None, "x", None, "x", None, "x", None], ["a", ""] * 2000]
    texts += [[f"w{i}" for i in some_words(rng, 2)] for _ in range(60)] * 2
    df = spark.createDataFrame([(i, t, "r", None) for i, t in enumerate(texts)],
                               "doc_id int, words array<string>, runs string, Period double")
    out = periodic.find_runs(df)
    assert out.columns == ["doc_id", "Period", "runs", "collapsed"]
    rows = {r["doc_id"]: r for r in out.collect()}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        words = [w or "" for w in text or []]
        want = plain(words) if len(words) < 1000 else [(0, len(words), 2)]
        assert [tuple(r) for r in rows[i]["runs"]] == want
        assert rows[i]["collapsed"] == collapsed(words, want)
    assert periodic.find_runs(df.limit(0)).count() == 0


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_query(spark, tmp_path):
    rng = random.Random(5)
    docs = [(i, None if i == 3 else rng.choice([" ", "\n", "\t\x0b"]).join(
        rng.choice(["a", "A", "bé", "c c"]) for _ in range(rng.randint(0, 70))) + rng.choice(["", " ", "\r\n"]))
        for i in range(120)] + [(None, "z z z z z z z"), (130, "")]
    spark.createDataFrame(docs, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    want = []
    for i, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        n = len(words)
        h = zlib.crc32(str(i).encode()) if i is not None else 1
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if j < a else words[a + (j - a) % p] for j, w in enumerate(words)]
        runs = plain(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        first = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        want.append((i, len(runs), *first, digest("".join(f"{s},{m},{q}\n" for s, m, q in runs)),
                     digest(collapsed(words, runs))))
    found = [tuple(r) for r in op12_periodic_runs(spark, str(tmp_path)).collect()]
    assert sorted(found, key=str) == sorted(want, key=str)
    assert any(r[1] > 0 for r in found)
