"""Greedy string tiling: a plain version, planted leaks, and odd rows."""

import random

import numpy as np

from maskwright.llm import tiling


def plain_tiles(item, text, least):
    """Longest first, one match at a time."""
    used_i, used_t, out = set(), set(), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(text)):
                n = 0
                while i + n < len(item) and j + n < len(text) and item[i + n] == text[j + n] \
                        and i + n not in used_i and j + n not in used_t:
                    n += 1
                best = max(best, (n, -i, -j))
        if best[0] < least:
            return out
        n, i, j = best[0], -best[1], -best[2]
        used_i |= set(range(i, i + n))
        used_t |= set(range(j, j + n))
        out += n


def test_tiles_like_the_plain_version():
    rng = random.Random(3)
    for _ in range(150):
        item = [rng.randrange(6) for _ in range(rng.randint(1, 40))]
        text = [rng.randrange(6) for _ in range(rng.randint(0, 60))]
        if rng.random() < 0.5:
            cut = rng.randint(0, len(item))
            text[5:5] = item[cut:] + [9] + item[:cut]
        tiles = tiling.greedy_tiles(np.array(item, np.uint64), np.array(text, np.uint64), 3)
        assert all(item[i:i + n] == text[j:j + n] and n >= min(3, len(item)) for i, j, n in tiles)
        for k in (0, 1):
            taken = [x for t in tiles for x in range(t[k], t[k] + t[2])]
            assert len(taken) == len(set(taken))
        assert sum(t[2] for t in tiles) == plain_tiles(item, text, min(3, len(item)))


def test_repeated_words_in_bounded_time_and_memory(monkeypatch):
    word = np.uint64(7)
    assert tiling.greedy_tiles(np.full(1000, word), np.full(1_000_000, word)) == [(0, 0, 1000)]
    verse = np.arange(12, dtype=np.uint64)
    tiles = tiling.greedy_tiles(np.tile(verse, 40), np.tile(np.append(verse, np.uint64(99)), 3000))
    assert sum(n for _, _, n in tiles) == 480 and {n for _, _, n in tiles} == {12}
    rng = random.Random(5)
    monkeypatch.setattr(tiling, "PAIRS", 7)  # a few places at a time
    for _ in range(60):
        item, text = ([rng.randrange(2) for _ in range(rng.randint(1, n))] for n in (25, 50))
        tiles = tiling.greedy_tiles(np.array(item, np.uint64), np.array(text, np.uint64), 3)
        assert sum(t[2] for t in tiles) == plain_tiles(item, text, min(3, len(item)))


def test_a_benchmark_in_several_blocks(spark, monkeypatch):
    words = [f"w{i} x{i} y{i} z{i} v{i}" for i in range(30)]
    docs = spark.createDataFrame([(i, f"before {w} after", 1) for i, w in enumerate(words[:20])] + [(99, "clean words", 2)],
                                 "doc_id bigint, text string, n int")
    bench = spark.createDataFrame(list(enumerate(words)), "item_id bigint, text string")
    want = sorted(map(tuple, tiling.leaks(docs, bench).collect()))
    monkeypatch.setattr(tiling, "BLOCK_BYTES", 150)
    assert sorted(map(tuple, tiling.leaks(docs, bench).collect())) == want and len(want) == 20
    assert [tuple(r) for r in tiling.without_leaks(docs, bench).collect()] == [(99, "clean words", 2)]


def test_leaks(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    items = [(k, " ".join(word() for _ in range(30))) for k in range(20)] + [(20, "Two words"), (21, None), (22, "..."),
                                                                            (3, None)]
    noise = lambda n: " ".join(word() for _ in range(n))
    words = items[5][1].split()
    docs = [
        (1, f"{noise(50)}. {items[4][1].upper()}! {noise(20)}"), (2, f"{' '.join(words[15:])} {noise(9)} {' '.join(words[:15])}"),
        (3, noise(300)), (4, " ".join(words[:10]) + " " + noise(100)), (5, None), (6, ""), (7, "say two WORDS."),
        (None, items[6][1]), (8, items[7][1] + " " + items[8][1]), (8, items[7][1] + " " + items[8][1]),
        (9, noise(40_000) + " " + items[9][1])]
    df = spark.createDataFrame([(i, t, 0, "x") for i, t in docs], "doc_id bigint, text string, item_id int, m string")
    bench = spark.createDataFrame(items + items[:2], "item_id bigint, text string")
    found = sorted(((r.doc_id, r.item_id) for r in tiling.leaks(df, bench).collect()), key=str)
    assert found == sorted([(1, 4), (2, 5), (7, 20), (None, 6), (8, 7), (8, 8), (8, 7), (8, 8), (9, 9)], key=str)
    assert {r.doc_id: r.tiles for r in tiling.leaks(df, bench).collect()}[2] == 2
    kept = tiling.without_leaks(df, bench)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 6]


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c d e")], "doc_id bigint, text string")
    bench = spark.createDataFrame([], "item_id bigint, text string")
    assert tiling.leaks(docs, bench).count() == 0 and tiling.without_leaks(docs, bench).count() == 1
    assert tiling.leaks(docs.limit(0), spark.createDataFrame([(1, "a b c d e")], "item_id bigint, text string")).count() == 0


def test_all_items_of_the_test_table(spark):
    """Whole items that lie in a document are found; what is found is covered by the threshold or more."""
    folder = "/root/testdata/sf0.001"
    docs, bench = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    found = {(r.doc_id, r.item_id): r.coverage for r in tiling.leaks(docs, bench).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    whole = {(d, r.item_id) for r in bench.collect() for d, t in texts.items() if r.text in t}
    assert whole and whole <= set(found) and all(found[p] == 1 for p in whole)
    assert all(c >= tiling.COVERAGE for c in found.values())
