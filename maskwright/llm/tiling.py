"""Benchmark decontamination by greedy string tiling.

Runs of words that a document shares with a benchmark item are the seeds. For each document and item that share one,
the longest matches outside earlier ones are marked again and again, found by running Karp-Rabin: all windows of a
search length are hashed by one running sum, and the length shrinks as matches run out. The marked share of the item
is its coverage, whatever order its parts come in.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from maskwright.llm.words import PUNCTUATION, chunks, run_hashes, word_hashes
from maskwright.llm.worker import give_back
from maskwright.session import materialise

LEAST = 4  # words of a match
COVERAGE = 0.5
SEARCH = 32  # words of the first windows
BLOCK_BYTES = 8 << 20  # of benchmark text that goes to the tasks at a time
PAIRS = 1 << 20  # places of an item and a text that are held against each other at once

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))

_MATCH = pa.struct([("item_id", pa.int64()), ("coverage", pa.float64()), ("words", pa.int64()), ("tiles", pa.int64()),
                    ("first_word", pa.int64()), ("last_word", pa.int64())])


class _Windows:
    """Hashes of all windows of a text's words, and how far free words reach."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        power = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, _BASE))])
        self.words = words
        self.back = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, _BACK))])
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(words * power[:n])])
        self.marked = np.zeros(n, bool)

    def of(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of every window of ``size`` words without a marked one."""
        if size >= len(self.sums):
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        taken = np.concatenate([[0], np.cumsum(self.marked)])
        at = np.flatnonzero(taken[size:] == taken[:-size])
        return at, self.hashes(at, size)

    def hashes(self, at: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        return (self.sums[at + size] - self.sums[at]) * self.back[at]

    def free(self) -> np.ndarray:
        """From each word, the number of words up to the next marked one or the end."""
        stops = np.append(np.flatnonzero(self.marked), len(self.words))
        here = np.arange(len(self.words))
        return stops[np.searchsorted(stops, here)] - here


def _longest(item: _Windows, text: _Windows, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where in the item matches of ``size`` words or more begin: place, first place in the text of a longest one, words.

    Two windows begin a match where they agree and the words before them do not. Windows of one hash are sorted by the
    word before, so that others than those are never paired: a word that repeats makes as many pairs as it has places.
    """
    a, x = item.of(size)
    b, y = text.of(size)
    none = np.empty(0, np.int64)
    if not len(a) or not len(b):
        return none, none, none
    hashes, number = np.unique(x, return_inverse=True)
    at = np.minimum(np.searchsorted(hashes, y), len(hashes) - 1)
    hit = hashes[at] == y
    b, at = b[hit], at[hit]
    follows = (a > 0) & ~item.marked[a - 1]
    words, before = np.unique(item.words[a - 1], return_inverse=True)
    before = np.where(follows, before + 1, 0)  # 0: nothing before it that could match
    step = len(words) + 1
    key = number * step + before
    order = np.argsort(key, kind="stable")
    key, a = key[order], a[order]
    prior = np.minimum(np.searchsorted(words, text.words[b - 1]), len(words) - 1)
    same = (b > 0) & ~text.marked[b - 1] & (words[prior] == text.words[b - 1])
    low, high = np.searchsorted(key, at * step), np.searchsorted(key, (at + 1) * step)
    skip = np.where(same, np.searchsorted(key, at * step + prior + 1), low)
    skip_to = np.where(same, np.searchsorted(key, at * step + prior + 1, "right"), low)
    counts = (high - low) - (skip_to - skip)
    item_free, text_free = item.free(), text.free()
    best_n, best_j = np.zeros(len(item.words), np.int64), np.zeros(len(item.words), np.int64)
    ends, begin = np.cumsum(counts), 0
    while begin < len(b):
        done = ends[begin - 1] if begin else 0
        upto = max(begin + 1, int(np.searchsorted(ends, done + PAIRS, "right")))
        some = slice(begin, upto)
        begin = upto
        n = counts[some]
        place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low[some], n)
        place += np.where(place >= np.repeat(skip[some], n), np.repeat((skip_to - skip)[some], n), 0)
        i, j = a[place], np.repeat(b[some], n)
        limit, length = np.minimum(item_free[i], text_free[j]), np.full(len(i), size)
        for power in reversed(range(int(limit.max(initial=0)).bit_length())):
            more = length + (1 << power)
            may = np.flatnonzero(more <= limit)
            agree = item.hashes(i[may], more[may]) == text.hashes(j[may], more[may])
            length[may[agree]] += 1 << power
        order = np.lexsort((j, -length, i))
        first = order[np.append(True, i[order][1:] != i[order][:-1])[:len(order)]]
        better = first[length[first] > best_n[i[first]]]
        best_n[i[better]], best_j[i[better]] = length[better], j[better]
    found = np.flatnonzero(best_n)
    return found, best_j[found], best_n[found]


def greedy_tiles(item: np.ndarray, text: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """Matches (first word in the item, in the text, words) that do not overlap, longest first.

    Of equally long ones the first in the item is taken, at its first place in the text. Memory is that of the texts and
    of ``PAIRS`` pairs of places.
    """
    of_item, of_text = _Windows(item), _Windows(text)
    least = min(least, len(item))
    size, tiles = max(least, min(SEARCH, len(item))), []
    while least and len(text) >= least:
        starts, places, lengths = _longest(of_item, of_text, size)
        longest = int(lengths.max(initial=0))
        if longest > 2 * size:  # much longer ones come first
            size = longest
            continue
        marked = False
        for k in np.lexsort((starts, -lengths)).tolist():
            i, j, n = int(starts[k]), int(places[k]), int(lengths[k])
            if of_item.marked[i:i + n].any() or of_text.marked[j:j + n].any():
                break  # what is left of it, or another place in the text, may come before shorter ones
            of_item.marked[i:i + n] = of_text.marked[j:j + n] = marked = True
            tiles.append((i, j, n))
        if not marked:
            if size == least:
                break
            size = max(least, size // 2)
    return tiles


@dataclass
class Benchmark:
    """Words of all items of a block, and which items hold which seeds."""
    ids: list
    words: list[np.ndarray]
    seeds: np.ndarray  # sorted
    owner: np.ndarray  # item of each seed
    sizes: list[int]  # of seeds in words: less than ``least`` for the shortest items only
    least: int

    @staticmethod
    def of(items: list[tuple], least: int) -> Benchmark:
        hashes, first = word_hashes(_folded(pa.array([t for _, t in items], pa.string())), PUNCTUATION)
        words = [hashes[a:b] for a, b in zip(first[:-1], first[1:])]
        sizes = sorted({min(least, len(w)) for w in words if len(w)})
        seeds, owner = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
        for size in sizes:
            some = [k for k, w in enumerate(words) if min(least, len(w)) == size]
            bounds = np.concatenate([[0], np.cumsum([len(words[k]) for k in some])])
            runs, starts = run_hashes(np.concatenate([words[k] for k in some]), bounds, size)
            seeds.append(runs)
            owner.append(np.repeat(np.array(some, np.int64), np.diff(starts)))
        seeds, owner = np.concatenate(seeds), np.concatenate(owner)
        order = np.argsort(seeds, kind="stable")
        return Benchmark([i for i, _ in items], words, seeds[order], owner[order], sizes, least)

    def pairs(self, words: np.ndarray, first: np.ndarray) -> list[tuple[int, int]]:
        """(text, item) of all texts and items that share a seed."""
        out = set()
        for size in self.sizes:
            runs, starts = run_hashes(words, first, size)
            at = np.searchsorted(self.seeds, runs)
            hit = np.flatnonzero(self.seeds[np.minimum(at, len(self.seeds) - 1)] == runs)
            upto = np.searchsorted(self.seeds, runs[hit], "right")
            texts = np.searchsorted(starts, hit, "right") - 1
            for text, a, b in zip(texts.tolist(), at[hit].tolist(), upto.tolist()):
                out.update((text, int(item)) for item in self.owner[a:b])
        return sorted(out)

    def matches(self, texts: pa.Array, coverage: float) -> list[list[dict]]:
        words, first = word_hashes(_folded(texts), PUNCTUATION)
        out: list[list[dict]] = [[] for _ in range(len(texts))]
        for text, item in self.pairs(words, first) if len(self.seeds) else []:
            tiles = greedy_tiles(self.words[item], words[first[text]:first[text + 1]], self.least)
            n = sum(t[2] for t in tiles)
            if n and n >= coverage * len(self.words[item]):
                out[text].append({
                    "item_id": self.ids[item], "coverage": n / len(self.words[item]), "words": n, "tiles": len(tiles),
                    "first_word": min(t[1] for t in tiles), "last_word": max(t[1] + t[2] for t in tiles) - 1})
        return out


def _folded(texts: pa.Array) -> pa.Array:
    return pc.utf8_lower(texts.cast(pa.large_string()))


def _blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[tuple[list[tuple], bool]]:
    """The items, one block of bounded size after the other, and whether there are several; a block goes to all tasks."""
    items = benchmark.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text")).where(
        "text is not null").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = int(size // BLOCK_BYTES) + 1
    block = F.pmod(F.xxhash64("id", "text"), F.lit(n))
    for i in range(n):
        yield [(r.id, r.text) for r in items.where(block == i).orderBy("id", "text").collect()], n > 1


def leaked(text: Column, items: list[tuple], least: int = LEAST, coverage: float = COVERAGE) -> Column:
    """The items of a block that a text covers enough of: an array of item_id, coverage, words, tiles, first and last word."""
    held = Benchmark.of(items, least)

    @F.arrow_udf("array<struct<item_id:bigint,coverage:double,words:bigint,tiles:bigint,first_word:bigint,last_word:bigint>>")
    def match(texts: pa.Array) -> pa.Array:
        give_back()
        out = []
        for part in chunks([pa.RecordBatch.from_arrays([texts], ["text"])], "text"):
            out += held.matches(part["text"], coverage)
        return pa.array(out, pa.list_(_MATCH))

    return match(text.cast("string"))


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text_col: str = "text", least: int = LEAST,
          coverage: float = COVERAGE) -> DataFrame:
    """One row per document row and benchmark item of which at least ``coverage`` of the words lies in the document.

    Columns: ``id_col``, item_id, coverage, words (marked ones), tiles, first_word and last_word (in the document, of all
    tiles). Words are runs of letters and digits without regard to case; a match takes ``least`` words or the whole of
    a shorter item. Documents that cover no item give no row; null and empty texts and items match nothing. Repeated
    items count once, repeated documents each time. Empty tables give no rows. Other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("id_"), F.col(text_col).alias("text_"))
    found = None
    for items, several in _blocks(benchmark, item_col, item_text_col):
        part = rows.select("id_", F.explode(leaked(F.col("text_"), items, least, coverage)).alias("m"))
        part = materialise(part, "leaks") if several else part  # so that a task never holds two blocks
        found = part if found is None else found.unionByName(part)
    return found.select(F.col("id_").alias(id_col), "m.*")


def without_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", least: int = LEAST, coverage: float = COVERAGE) -> DataFrame:
    """``docs`` without the rows that ``leaks`` would name."""
    for items, several in _blocks(benchmark, item_col, item_text_col):
        docs = docs.where(F.size(leaked(F.col(text_col), items, least, coverage)) == 0)
        docs = materialise(docs, "without-leaks") if several else docs
    return docs
