"""Periodic runs of words, found by recompression.

A run is a stretch of consecutive words with smallest period q, at least ``LEAST`` words and ``TIMES`` periods long,
that no neighbouring word extends.

The words of many texts, with a symbol of its own between any two texts, are compressed into a run-length grammar:
by turns every block of equal symbols becomes one symbol, and then pairs of neighbours do. Symbols are dealt to two
sides by a hash, and a pair is one of the first side before one of the second, so that what is paired depends on the two
symbols alone: equal passages are compressed alike but for their edges. How far two places agree, forwards or
backwards, is answered exactly by going up from both while their symbols are equal, over one step at each level at
most, and down again where they differ. Levels are made as long as a question is still open.

A run of period p has a multiple of p among its first p places, and the same word there, one, two and three periods on.
Only such places of the harmonic grid are asked about. All questions of a range of periods are answered at once on
numpy. No suffix array is built.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

LEAST = 6  # words of a run
TIMES = 4  # periods of a run
PIECE = 400_000  # words of texts that share a grammar; a longer text has one to itself

_ODD = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: Column) -> Column:
    """Words of a text: runs of characters other than space and the controls 0x09 to 0x0D."""
    return F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))


def _sides(symbols: np.ndarray, level: int) -> np.ndarray:
    """A random-looking bit per symbol, another one at another level."""
    x = (symbols.astype(np.uint64) + np.uint64(level * 0xD1B54A32D192ED03 % (1 << 64))) * _ODD
    x = (x ^ (x >> np.uint64(32))) * _ODD
    return (x >> np.uint64(47)) & np.uint64(1) == 1


class _Level:
    """Symbols, and how they make up those of the next level: each symbol's parent, and the first child of each parent."""

    def __init__(self, symbols: np.ndarray):
        self.symbols = symbols
        self.up = self.first = None
        self.pairs = False

    def group(self, opens: np.ndarray, pairs: bool) -> None:
        """``opens`` marks the first child of each parent."""
        self.up = np.cumsum(opens) - 1
        self.first = np.append(np.flatnonzero(opens), len(opens))
        self.pairs = pairs


class Grammar:
    """A run-length grammar of ``symbols``, whose first and last one occur nowhere else."""

    def __init__(self, symbols: np.ndarray):
        self.levels = [_Level(symbols.astype(np.int64))]
        self.names = int(symbols.max(initial=0)) + 1  # symbols are numbered on from here
        self.turns = 0

    def _named(self, keys: np.ndarray) -> np.ndarray:
        """New symbols, the same for equal keys."""
        found, number = np.unique(keys, return_inverse=True)
        number += self.names
        self.names += len(found)
        return number

    def _blocks(self, last: _Level) -> np.ndarray | None:
        s = last.symbols
        opens = np.append(True, s[1:] != s[:-1])
        if opens.all():
            return None
        last.group(opens, False)
        sizes, out = np.diff(last.first), s[last.first[:-1]]
        many = np.flatnonzero(sizes > 1)
        out[many] = self._named(out[many] * np.int64(sizes.max() + 1) + sizes[many])
        return out

    def _pairs(self, last: _Level) -> np.ndarray | None:
        s = last.symbols
        side = _sides(s, self.turns)
        rising, falling = ~side[:-1] & side[1:], side[:-1] & ~side[1:]
        begins = rising if np.count_nonzero(rising) >= np.count_nonzero(falling) else falling
        if not begins.any():
            return None
        last.group(np.append(True, ~begins), True)
        out, at = s[last.first[:-1]], np.flatnonzero(begins)
        out[last.up[at]] = self._named(s[at] * np.int64(self.names) + s[at + 1])
        return out

    def above(self, level: int) -> _Level:
        """The level, with its grouping into the next one, which is made when it is first asked for."""
        while level + 1 >= len(self.levels):
            last = self.levels[-1]
            self.turns += 1
            made = self._blocks(last) if self.turns % 2 else self._pairs(last)
            if made is not None:
                self.levels.append(_Level(made))
        return self.levels[level]

    def agree(self, a: np.ndarray, b: np.ndarray, forward: bool) -> np.ndarray:
        """How many symbols from ``a`` on equal those from ``b`` on (``a != b``), to the right or to the left."""
        sign = 1 if forward else -1

        def rest(level: _Level, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Symbols from ``at`` to the end of its parent in this direction, and all symbols of the parent."""
            parent = level.up[at]
            first, after = level.first[parent], level.first[parent + 1]
            return (after - at if forward else at - first + 1), after - first

        asked, x, y = np.arange(len(a)), a.copy(), b.copy()
        stopped = []  # per level, the questions whose symbols differ there: which, and where
        while len(asked):
            level = len(stopped)
            s = self.levels[level].symbols
            differ = s[x] != s[y]
            held = [(asked[differ], x[differ], y[differ])]
            asked, x, y = asked[~differ], x[~differ], y[~differ]
            if len(asked):
                here = self.above(level)
                (left_x, all_x), (left_y, all_y) = rest(here, x), rest(here, y)
                step = np.where((left_x == all_x) & (left_y == all_y), 0, np.minimum(left_x, left_y))
                short = (step > 0) & (left_x != left_y)  # one block goes on where the other has ended
                x, y = x + sign * step, y + sign * step
                held.append((asked[short], x[short], y[short]))
                asked, x, y = asked[~short], here.up[x[~short]], here.up[y[~short]]
            stopped.append([np.concatenate(parts) for parts in zip(*held)])
        which, x, y = (np.empty(0, np.int64) for _ in range(3))
        for level in range(len(stopped) - 1, -1, -1):
            if len(which):  # they differ one level up, so they do here, after one child or one block at most
                here = self.levels[level]
                x, y = (here.first[x], here.first[y]) if forward else (here.first[x + 1] - 1, here.first[y + 1] - 1)
                (left_x, _), (left_y, _) = rest(here, x), rest(here, y)
                step = np.ones(len(x), np.int64) if here.pairs else np.minimum(left_x, left_y)
                step[here.symbols[x] != here.symbols[y]] = 0
                x, y = x + sign * step, y + sign * step
            which, x, y = (np.concatenate(parts) for parts in zip((which, x, y), stopped[level]))
        out = np.empty(len(a), np.int64)
        out[which] = sign * (x - a[which])
        return out


def _grid(symbols: np.ndarray, first: np.ndarray, size: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Places on the grid of each period from ``low`` below ``high`` with the same word one, two and three periods on.

    Texts are in descending order of ``size``.
    """
    texts = int(np.searchsorted(-size, -3 * low, "left"))  # those of more than three periods
    first, size = first[:texts], size[:texts]

    def by_period() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for p in range(low, high):
            some = int(np.searchsorted(-size, -3 * p, "left"))
            n = (size[:some] - 1) // p - 2
            ends = np.cumsum(n)
            yield np.repeat(first[:some] - p * (ends - n), n) + p * np.arange(n.sum()), p

    def by_multiple() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for begin, n in zip(first.tolist(), size.tolist()):
            for m in range((n - 1) // low - 2):
                p = np.arange(low, min(high, (n - 1) // (m + 3) + 1))
                yield begin + m * p, p

    places, periods = [], []
    for at, p in by_multiple() if (size // low).sum() < high - low else by_period():  # whichever has fewer turns
        for k in (1, 2, 3):
            same = symbols[at] == symbols[at + k * p]
            at, p = at[same], p[same] if isinstance(p, np.ndarray) else p
        places.append(at)
        periods.append(np.broadcast_to(p, at.shape))
    return np.concatenate([np.empty(0, np.int64), *places]), np.concatenate([np.empty(0, np.int64), *periods])


def runs_of(words: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All runs of texts whose words, as numbers, lie behind each other: rows of first word, length and period.

    First words count over all texts. Rows are sorted by it, then by period.
    """
    n_texts, total = len(sizes), len(words)
    if not total:
        return np.empty((0, 3), np.int64)
    before = np.cumsum(sizes) - sizes
    symbols = np.empty(total + n_texts + 1, np.int64)
    parted = np.append(before + np.arange(n_texts), total + n_texts)  # where the symbols between texts stand
    inside = np.ones(len(symbols), bool)
    inside[parted] = False
    symbols[inside] = words
    symbols[parted] = int(words.max()) + 1 + np.arange(n_texts + 1)
    order = np.argsort(-sizes, kind="stable")
    first, size = parted[:-1][order] + 1, sizes[order]
    grammar = Grammar(symbols)
    until, period = np.zeros(len(symbols), np.int64), np.ones(len(symbols), np.int64)  # of a run known at a place
    found = [np.empty((0, 3), np.int64)]
    low, last = 1, int(size[0]) // TIMES
    while low <= last:
        at, p = _grid(symbols, first, size, low, min(2 * low, last + 1))
        # within a run, a multiple of its period shows nothing but the run; no two periods of a range are multiples
        new = (until[at] <= at + 3 * p) | (p % period[at] != 0)
        at, p = at[new], p[new]
        if len(at):
            start = at - grammar.agree(at - 1, at + p - 1, False)
            end = at + p + grammar.agree(at, at + p, True)
            long = end - start >= np.maximum(LEAST, TIMES * p)
            some = np.unique(np.stack([start, end, p], 1)[long], axis=0)
            for s, e, q in some.tolist():
                until[s:e], period[s:e] = e, q
            found.append(some)
        low *= 2
    runs = np.concatenate(found)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    smallest = np.append(True, (runs[1:, :2] != runs[:-1, :2]).any(1))[:len(runs)]  # of a stretch's periods
    start, end, q = runs[smallest].T
    text = np.searchsorted(parted, start) - 1
    out = np.stack([start - text - 1, end - start, q], 1)
    return out[np.lexsort((q, start))]


def _pieces(batches: Iterable[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        sizes = pc.fill_null(pc.list_value_length(batch[column]), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(sizes)
        at = done = 0
        while at < len(batch):
            upto = max(at + 1, int(np.searchsorted(ends, done + PIECE, "right")))
            yield batch.slice(at, upto - at), sizes[at:upto]
            at, done = upto, int(ends[upto - 1])


def find_runs(docs: DataFrame, words: str = "words") -> DataFrame:
    """The documents, without ``words``, with ``runs`` and ``collapsed``.

    ``words`` is an array of text. ``runs`` is an array of ``start`` (word number from 0), ``length`` and ``period``,
    sorted by start, then period; runs may overlap. ``collapsed`` is the text of the words that no run contains after
    its first period, joined by one space.

    Null or empty ``words``, and a null word as an empty one, are taken as they come: no word gives no run and an empty
    text, neither of them null. A text of any length is taken whole, in time that grows with n log n. Repeated rows and
    equal texts are rows like others. An empty table gives none. Other columns are kept, those named like a result
    are replaced by it.
    """
    kept = [c for c in docs.columns if c not in (words, "runs", "collapsed")]
    # by position, as names that differ in case only, or occur twice, do no harm there
    rows = docs.select(F.col(words).alias("words_"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(kept)])
    kinds = ", ".join(f"c{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(kept))
    schema = ", ".join(filter(None, [kinds, "runs array<struct<start:bigint,length:bigint,period:bigint>>",
                                     "collapsed string"]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, sizes in _pieces(batches, "words_"):
            values = pc.fill_null(pc.list_flatten(batch["words_"]), "")
            numbers = values.dictionary_encode().indices.to_numpy().astype(np.int64)
            runs = runs_of(numbers, sizes)
            ends = np.append(0, np.cumsum(sizes))
            text = np.searchsorted(ends, runs[:, 0], "right") - 1
            drops = np.zeros(len(numbers) + 1, np.int64)
            np.add.at(drops, runs[:, 0] + runs[:, 2], 1)
            np.add.at(drops, runs[:, 0] + runs[:, 1], -1)
            stays = np.cumsum(drops[:-1]) == 0
            left = np.append(0, np.cumsum(stays))[ends]
            joined = pc.binary_join(pa.ListArray.from_arrays(
                pa.array(left, pa.int32()), values.filter(pa.array(stays)).cast(pa.string())), " ")
            spans = pa.StructArray.from_arrays(
                [pa.array(runs[:, 0] - ends[text]), pa.array(runs[:, 1]), pa.array(runs[:, 2])], ["start", "length", "period"])
            lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(text, np.arange(len(sizes) + 1)), pa.int32()), spans)
            yield pa.RecordBatch.from_arrays(
                [*[batch[f"c{i}"] for i in range(len(kept))], lists, joined],
                [*[f"c{i}" for i in range(len(kept))], "runs", "collapsed"])

    out = rows.mapInArrow(run, schema)
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(kept)], "runs", "collapsed")
