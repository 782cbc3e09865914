import math
from collections import Counter

import numpy as np
import pytest

from maskwright.llm import scoring


def plain_scores(texts, order=scoring.ORDER, smooth=scoring.SMOOTH):
    """The models with dictionaries; contexts as ``cells`` classes them."""
    def tokens(text):
        data = np.frombuffer((text or "").encode(), np.uint8)
        return [(c >> 8, c & 255) for c in scoring.cells(data, np.array([0, len(data)]), order).tolist()]

    counts = {kind: Counter(x for t, good in texts if good == kind for x in tokens(t)) for kind in (True, False)}
    total = {k: sum(c.values()) for k, c in counts.items()}
    scale = {True: 1.0, False: total[True] / total[False]}

    def chance(kind, context, byte):
        held = {k: n * scale[kind] for k, n in counts[kind].items()}
        alone = (sum(n for (_, b), n in held.items() if b == byte) + 1) / (total[True] + 256)
        short = {b: n for (c, b), n in [((c, b), n) for (c, b), n in held.items()] if False}
        before = [(b, n) for (c, b), n in held.items() if c >> 8 == context >> 8]
        short = (sum(n for b, n in before if b == byte) + smooth * alone) / (sum(n for _, n in before) + smooth)
        own = [(b, n) for (c, b), n in held.items() if c == context]
        return (sum(n for b, n in own if b == byte) + smooth * short) / (sum(n for _, n in own) + smooth)

    out = []
    for t, _ in texts:
        found = [math.log2(chance(False, c, b)) - math.log2(chance(True, c, b)) for c, b in tokens(t)]
        out.append(sum(found) / len(found) if found else None)
    return out


def test_against_a_plain_version(spark):
    texts = [("abc abd", True), ("xyz é", False), ("abd xyz", False), ("", True), (None, False), ("abc", True)]
    df = spark.createDataFrame([(i, t, g, 0.5) for i, (t, g) in enumerate(texts)],
                               "doc_id bigint, text string, target boolean, score double")
    rows = sorted(scoring.score(df, scoring.fit(df.repartition(3))).collect())
    assert [r.n_tokens for r in rows] == [7, 6, 7, 0, 0, 3]
    for r, want in zip(rows, plain_scores(texts)):
        assert r.score is None if want is None else r.score == pytest.approx(want, abs=1e-5)


def test_separates_target_from_background(spark):
    rows = [(i, "the cat sat on the mat " * (1 + i % 3), i % 2 == 0) if i % 2 == 0 else (i, "zx qj vk wz " * 4, False)
            for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, target boolean")
    found = {r.doc_id: r.score for r in scoring.score(df, scoring.fit(df)).collect()}
    assert max(found[i] for i in range(0, 40, 2)) < 0 < min(found[i] for i in range(1, 40, 2))


def test_no_model(spark):
    df = spark.createDataFrame([(1, "abc", False), (None, None, None)], "doc_id bigint, text string, target boolean")
    assert scoring.fit(df) is None and scoring.fit(df.limit(0)) is None
    assert {tuple(r) for r in scoring.score(df, None).collect()} == {(1, 3, None), (None, 0, None)}


def test_labels(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (2, "d")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 0), (1, 1), (1, 1), (2, 0), (None, 1)], "doc_id bigint, quality int")
    assert {tuple(r) for r in scoring.marked_by(docs, labels).collect()} == {
        ("a", True), ("b", False), ("c", False), ("d", False)}


def exact_scores(texts, order=scoring.ORDER, smooth=scoring.SMOOTH):
    """The models with the bytes themselves as contexts."""
    def tokens(text):
        data = bytes(order - 1) + text.encode()
        return [(data[i - order + 1:i], data[i]) for i in range(order - 1, len(data))]

    sides = []
    for kind in (True, False):
        found = [x for t, good in texts if good == kind for x in tokens(t)]
        sides.append((len(found), [Counter((c[k:], b) for c, b in found) for k in (0, 1, order - 1)],
                      [Counter(c[k:] for c, _ in found) for k in (0, 1)]))

    def chance(side, context, byte):
        total, (own, short, alone), (owns, shorts) = side
        scale = sides[0][0] / total
        p = (alone[b"", byte] * scale + 1) / (sides[0][0] + 256)
        p = (short[context[1:], byte] * scale + smooth * p) / (shorts[context[1:]] * scale + smooth)
        return (own[context, byte] * scale + smooth * p) / (owns[context] * scale + smooth)

    def mean(text):
        found = [math.log2(chance(sides[1], *x)) - math.log2(chance(sides[0], *x)) for x in tokens(text)]
        return sum(found) / len(found)
    return mean


def test_against_exact_contexts(spark):
    rng = np.random.default_rng(5)
    word = lambda k: "".join(chr(97 + int(c)) for c in rng.integers(0, 20, k))
    texts = [(" ".join(word(int(k)) for k in rng.integers(1, 8, 300)), i % 3 == 0) for i in range(60)]
    plain = exact_scores(texts)
    model = scoring.fit(spark.createDataFrame(texts, "text string, target boolean").repartition(4))
    unseen = ["ZZ not in the corpus é", "", None]  # n-grams that no model has are smoothed, too
    df = spark.createDataFrame(list(enumerate([t for t, _ in texts] + unseen)), "doc_id bigint, text string")
    found = {r.doc_id: r.score for r in scoring.score(df, model).collect()}
    assert found[61] is None and found[62] is None and len(found) == 63
    for i in range(61):
        assert found[i] == pytest.approx(plain((texts[i][0] if i < 60 else unseen[0])), abs=1e-9)


def test_models_grow_with_the_corpus(spark):
    """Every n-gram has its own row: more than the 65,536 that classes of contexts allow."""
    rng = np.random.default_rng(6)
    texts = [("".join(map(chr, rng.integers(97, 123, 20_000))), i % 2 == 0) for i in range(16)]
    sizes = []
    for n in (2, 16):
        counts = scoring.fit(spark.createDataFrame(texts[:n], "text string, target boolean"), order=6).counts
        want = Counter(t[i - 5:i + 1] for t, _ in texts[:n] for i in range(5, len(t)))
        sizes.append(counts.count())
        assert sizes[-1] == len(want) + len({t[:k] for t, _ in texts[:n] for k in range(1, 6)})
    assert sizes[1] > 7 * sizes[0] > 65_536


def test_blocks(spark, monkeypatch):
    """Texts of many blocks, copies and null ids give the scores of one block."""
    rows = [(None if i % 5 == 0 else i % 7, f"text {i % 11} of many blocks " * (i % 4)) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    model = scoring.fit(df.selectExpr("text", "doc_id = 1 target"))
    whole = sorted(map(str, scoring.score(df, model).collect()))
    monkeypatch.setattr(scoring, "_PIECE", 200)
    monkeypatch.setattr(scoring, "_BLOCK", 500)
    assert len(whole) == 200 and sorted(map(str, scoring.score(df, model).collect())) == whole
