"""Hashes of words and of runs of words, for many texts at once, on numpy.

A word is a run of bytes other than ``gaps``, by default space and the controls 0x09 to 0x0D; A-Z count as a-z. UTF-8
never uses those bytes inside a longer character, so whole texts are cut without decoding them.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_ODD), -1, 1 << 64))


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


SPACE = np.zeros(256, bool)  # what parts words
SPACE[[0x20, *range(0x09, 0x0E)]] = True
PUNCTUATION = SPACE.copy()  # the same with all ASCII but letters and digits
PUNCTUATION[[c for c in range(128) if not chr(c).isalnum()]] = True
_LETTER = np.arange(256)
_LETTER[65:91] += 32
_VALUE = _mixed(_LETTER.astype(np.uint64) * _ODD + np.uint64(1))  # of a byte, the same for both cases


def chunks(batches: Iterable[pa.RecordBatch], column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in pieces of about ``limit`` bytes of ``column``, one row at least: arrays made of a
    piece stay small however many or long the texts of an Arrow batch are."""
    for batch in batches:
        _, starts = buffers(batch[column])
        at = 0
        while at < len(batch):
            upto = max(at + 1, int(np.searchsorted(starts, starts[at] + limit, "right")) - 1)
            yield batch.slice(at, upto - at)
            at = upto


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts behind each other, and where each begins (one more than texts); null is empty."""
    if not len(texts):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    texts = texts.cast(pa.large_string()).fill_null("")
    ends = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = texts.buffers()[2]
    held = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return held[ends[0]:ends[-1]], ends - ends[0]


def word_bounds(data: np.ndarray, starts: np.ndarray, gaps: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte and end of every word, and the first word of each text (one more than texts)."""
    inside = ~gaps[data]
    opens = starts[:-1][starts[:-1] < len(data)]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    first[opens] = inside[opens]  # a word never runs on into the next text
    before = opens[opens > 0] - 1
    last[before] = inside[before]
    begin = np.flatnonzero(first)
    return begin, np.flatnonzero(last) + 1, np.searchsorted(begin, starts)


def word_hashes(texts: pa.Array, gaps: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word, and the first word of each text (one more than texts).

    A word is hashed as a polynomial over random values of its bytes; powers of an odd number have
    inverses, so one running sum serves all words.
    """
    data, starts = buffers(texts)
    begin, end, first = word_bounds(data, starts, gaps)
    hashes = np.empty(len(begin), np.uint64)
    step = 1 << 20  # bytes per running sum, so that the powers stay in a small table
    power = back = np.ones(1, np.uint64)
    at = 0
    while at < len(begin):
        low = begin[at]
        upto = max(at + 1, int(np.searchsorted(begin, low + step)))
        high = int(end[upto - 1])
        if high - low > len(power):
            power = np.concatenate([[np.uint64(1)], np.cumprod(np.full(high - low, _ODD))])
            back = np.concatenate([[np.uint64(1)], np.cumprod(np.full(high - low, _INVERSE))])
        total = np.concatenate([[np.uint64(0)], np.cumsum(_VALUE[data[low:high]] * power[:high - low])])
        b, e = begin[at:upto] - low, end[at:upto] - low
        hashes[at:upto] = (total[e] - total[b]) * back[b] + (e - b).astype(np.uint64)
        at = upto
    return hashes, first


def run_hashes(words: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash of every run of ``size`` words, and the first run of each text (one more than texts).

    A text with fewer words gives one run of all its words; a text without words gives none.
    """
    n = np.diff(first)
    runs = np.where(n >= size, n - size + 1, (n > 0).astype(n.dtype))
    offsets = np.concatenate([[0], np.cumsum(runs)])
    hashes = np.zeros(offsets[-1], np.uint64)
    at = np.repeat(first[:-1] - offsets[:-1], runs) + np.arange(offsets[-1])  # each run's first word
    left = np.repeat(first[1:], runs) - at
    padded = np.concatenate([_mixed(words), np.zeros(size, np.uint64)])
    for k in range(size):
        hashes = hashes * _ODD + np.where(left > k, padded[at + k] | np.uint64(1 << 63), np.uint64(0))
    return _mixed(hashes), offsets


def distinct_runs(hashes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same with each text's runs sorted and without repeats."""
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        hashes[a:b].sort()
    keep = np.ones(len(hashes), bool)
    keep[1:] = hashes[1:] != hashes[:-1]
    keep[offsets[:-1][offsets[:-1] < len(hashes)]] = True
    return hashes[keep], np.concatenate([[0], np.cumsum(keep)])[offsets]
