"""What one task knows of its share of the values: moments, sketches and bucket counts, on numpy.

Values of plain and list features are reduced where they are read, or where all rows of their split have been brought
together. What leaves a task is a row per split and feature, or per bucket, and such rows merge: counts add up, means and squared deviations merge by the deviation of each
part's mean from that of all (never as a difference of squares, which a large mean would cancel), sketches compact.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa

SKETCH_SIZE = 4096  # ranks of a sketch are off by one in a thousand at most, with 99 % confidence
MOST_GROUPS = 50_000  # splits that a task holds at once; what it has of them is passed on at that number
PIECE = 1 << 20  # values worked on at once

_SUMS = ["num_rows", "num_missing", "num_values", "sizes", "n", "num_zeros", "below", "above"]
_LEAST, _MOST = ["min_size", "least"], ["max_size", "most"]
MOMENTS = np.dtype([(c, "i8") for c in _SUMS] + [("min_size", "i8"), ("max_size", "i8"), ("mean", "f8"), ("m2", "f8"),
                                                ("least", "f8"), ("most", "f8")])
MOMENT_COLUMNS = ", ".join(f"{c} {'bigint' if t[0].kind == 'i' else 'double'}" for c, t in MOMENTS.fields.items())


def no_moments(n: int) -> np.ndarray:
    out = np.zeros(n, MOMENTS)
    out["min_size"], out["max_size"], out["least"], out["most"] = np.iinfo(np.int64).max, -1, np.inf, -np.inf
    return out


def merged_moments(parts: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """One row per run of ``parts`` that begins at ``starts``."""
    out = np.empty(len(starts), MOMENTS)
    for c in _SUMS:
        out[c] = np.add.reduceat(parts[c], starts)
    for c in _LEAST:
        out[c] = np.minimum.reduceat(parts[c], starts)
    for c in _MOST:
        out[c] = np.maximum.reduceat(parts[c], starts)
    run = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(parts))))
    total = np.maximum(out["n"], 1)
    out["mean"] = np.add.reduceat(parts["mean"] * (parts["n"] / total[run]), starts)
    apart = np.where(parts["n"] > 0, parts["mean"] - out["mean"][run], 0.0)
    out["m2"] = np.add.reduceat(parts["m2"] + parts["n"] * apart * apart, starts)
    return out


class Sketch:
    """A KLL sketch: items of level h stand for 2^h values each. It is exact up to ``SKETCH_SIZE`` values."""

    def __init__(self, levels: list[np.ndarray] | None = None):
        self.levels = levels or [np.empty(0)]
        self.turns = 0

    def merge(self, levels: Sequence[np.ndarray]) -> None:
        while len(self.levels) < len(levels):
            self.levels.append(np.empty(0))
        for h, items in enumerate(levels):
            if len(items):
                self.levels[h] = np.concatenate([self.levels[h], items])
        self._compact()

    def _room(self, h: int) -> int:
        return max(8, int(SKETCH_SIZE * (2 / 3) ** (len(self.levels) - 1 - h)))

    def _compact(self) -> None:
        h = 0
        while h < len(self.levels):
            items = self.levels[h]
            if len(items) > self._room(h):
                items = np.sort(items)
                even = len(items) - len(items) % 2
                self.turns += 1
                offset = (self.turns * 0x9E3779B1 + len(items)) >> 7 & 1
                if h + 1 == len(self.levels):
                    self.levels.append(np.empty(0))
                    self.levels[h + 1], self.levels[h] = items[offset:even:2], items[even:]
                    h = 0  # with one more level, lower ones have less room
                    continue
                self.levels[h + 1] = np.concatenate([self.levels[h + 1], items[offset:even:2]])
                self.levels[h] = items[even:]
            h += 1

    def quantiles(self, ranks: Sequence[float]) -> list[float] | None:
        items = np.concatenate(self.levels)
        if not len(items):
            return None
        weight = np.concatenate([np.full(len(x), 1 << h) for h, x in enumerate(self.levels)])
        order = np.argsort(items, kind="stable")
        upto = np.cumsum(weight[order])
        place = np.maximum(np.ceil(np.array(ranks) * upto[-1]), 1)
        return items[order][np.searchsorted(upto, place)].tolist()

    def packed(self) -> tuple[bytes, list[int]]:
        return np.concatenate(self.levels).astype("<f8").tobytes(), [len(x) for x in self.levels]

    @staticmethod
    def unpacked(items: bytes, sizes: list[int]) -> list[np.ndarray]:
        return np.split(np.frombuffer(items, "<f8"), np.cumsum(sizes)[:-1])


class _Values:
    """The values of one feature in a batch: how many a row has, each one's row and value, and which are no nulls."""

    def __init__(self, column: pa.Array):
        if pa.types.is_list(column.type) or pa.types.is_large_list(column.type):
            self.sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = column.flatten()
        else:
            self.sizes = column.is_valid().to_numpy(zero_copy_only=False).astype(np.int64)
            flat = column.drop_null()
        self.row = np.repeat(np.arange(len(self.sizes)), self.sizes)
        self.present = flat.is_valid().to_numpy(zero_copy_only=False)
        self.v = flat.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)

    def moments(self, group: np.ndarray, n_groups: int) -> np.ndarray:
        """Per group of rows; NaN counts as a value and nothing else, infinities are counted apart."""
        out, of = no_moments(n_groups), group[self.row]
        count = lambda mask, at: np.bincount(at[mask], minlength=n_groups)
        everything = np.ones(len(group), bool)
        out["num_rows"], out["num_missing"] = count(everything, group), count(self.sizes == 0, group)
        out["sizes"] = np.bincount(group, self.sizes, n_groups).astype(np.int64)
        np.minimum.at(out["min_size"], group[self.sizes > 0], self.sizes[self.sizes > 0])
        np.maximum.at(out["max_size"], group[self.sizes > 0], self.sizes[self.sizes > 0])
        finite = np.isfinite(self.v)
        out["num_values"], out["num_zeros"] = count(self.present, of), count(self.v == 0, of)
        out["below"], out["above"] = count(self.v == -np.inf, of), count(self.v == np.inf, of)
        of, v = of[finite], self.v[finite]
        out["n"] = np.bincount(of, minlength=n_groups)
        share = 1 / np.maximum(out["n"], 1)
        mean = np.bincount(of, v * share[of], n_groups)  # no sum that could overflow
        mean += np.bincount(of, (v - mean[of]) * share[of], n_groups)
        out["mean"], out["m2"] = mean, np.bincount(of, (v - mean[of]) ** 2, n_groups)
        if n_groups == 1 and len(v):
            out["least"], out["most"] = v.min(), v.max()
        else:
            np.minimum.at(out["least"], of, v)
            np.maximum.at(out["most"], of, v)
        return out


def _pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of about ``PIECE`` values at a time, one row at least."""
    for batch in batches:
        width = np.ones(len(batch), np.int64)
        for column in batch.columns:
            if pa.types.is_list(column.type) or pa.types.is_large_list(column.type):
                width += column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        ends, at = np.cumsum(width), 0
        while at < len(batch):
            upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PIECE, "right")))
            yield batch.slice(at, upto - at)
            at = upto


def _grouped(batch: pa.RecordBatch) -> tuple[np.ndarray, list]:
    """A number for each row's split (the first column), and the splits in the order of their numbers."""
    held = batch.column(0).dictionary_encode(null_encoding="encode")
    return held.indices.to_numpy().astype(np.int64), held.dictionary.to_pylist()


def _sketch_columns(sketches: list[Sketch]) -> list[pa.Array]:
    held = [s.packed() for s in sketches]
    return [pa.array([x for x, _ in held], pa.binary()), pa.array([n for _, n in held], pa.list_(pa.int32()))]


def summarise(features: Sequence[str], with_sketch: bool) -> Callable:
    """A function for ``mapInArrow`` over (split, one column per feature): (split, feature, moments[, items, levels])."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        held = [no_moments(16) for _ in features]
        sketches: dict = {}

        def rows() -> Iterator[pa.RecordBatch]:
            names = pa.array(list(known), pa.string())
            for i, f in enumerate(features):
                part = held[i][:len(known)]
                columns = [names, pa.array([f] * len(known)), *[pa.array(part[c]) for c in MOMENTS.names]]
                if with_sketch:
                    columns += _sketch_columns([sketches.get((i, k)) or Sketch() for k in range(len(known))])
                names_of = ["split", "feature", *MOMENTS.names, *(["items", "levels"] if with_sketch else [])]
                whole = pa.RecordBatch.from_arrays(columns, names_of)
                for at in range(0, len(whole), 1000):
                    yield whole.slice(at, 1000)

        for batch in _pieces(batches):
            number, splits = _grouped(batch)
            at = np.array([known.setdefault(s, len(known)) for s in splits], np.int64)
            for i in range(len(features)):
                values = _Values(batch.column(i + 1))
                if len(known) > len(held[i]):
                    held[i] = np.concatenate([held[i], no_moments(len(known) + len(held[i]))])
                found = values.moments(number, len(splits))
                both = np.stack([held[i][at], found], 1).reshape(-1)
                held[i][at] = merged_moments(both, np.arange(0, len(both), 2))
                if with_sketch:
                    real = ~np.isnan(values.v)
                    of, v = number[values.row[real]], values.v[real]
                    order = np.argsort(of, kind="stable") if len(splits) > 1 else slice(None)
                    cuts = np.searchsorted(of[order], np.arange(len(splits) + 1))
                    v = v[order]
                    for k, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
                        if b > a:
                            sketches.setdefault((i, int(at[k])), Sketch()).merge([v[a:b]])
            if len(known) > MOST_GROUPS or sum(len(x) for s in sketches.values() for x in s.levels) > 16 * PIECE:
                yield from rows()
                known, held, sketches = {}, [no_moments(16) for _ in features], {}
        yield from rows()

    return run


def merge_sorted(keys: Sequence[str], ranks: Sequence[float] | None, sketched: bool) -> Callable:
    """A function for ``mapInArrow`` over rows of ``summarise`` sorted by ``keys``: one row per key.

    With ``ranks`` sketches end as the list of their quantiles, else they stay sketches. A task holds one sketch.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, rest, sketch = None, no_moments(0), Sketch()

        def row(done: list, parts: np.ndarray, sketches: list[Sketch]) -> pa.RecordBatch:
            columns = [pa.array([k[j] for k in done], t) for j, t in enumerate(kinds)]
            columns += [pa.array(parts[c]) for c in MOMENTS.names]
            names = [*keys, *MOMENTS.names]
            if sketched and ranks is not None:
                columns.append(pa.array([s.quantiles(ranks) for s in sketches], pa.list_(pa.float64())))
                names.append("quantiles")
            elif sketched:
                columns += _sketch_columns(sketches)
                names += ["items", "levels"]
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            if not len(batch):
                continue
            kinds = [batch[k].type for k in keys]
            parts = np.empty(len(batch), MOMENTS)
            for c in MOMENTS.names:
                parts[c] = batch[c].to_numpy()
            names = list(zip(*[batch[k].to_pylist() for k in keys]))
            if last is not None:
                parts, names = np.concatenate([rest, parts]), [last, *names]
            starts = np.array([i for i in range(len(names)) if not i or names[i] != names[i - 1]])
            done = merged_moments(parts, starts)
            sketches = []
            if sketched:
                held = list(zip(batch["items"].to_pylist(), batch["levels"].to_pylist()))
                held = ([None] if last is not None else []) + held
                bounds = [*starts.tolist(), len(names)]
                for a, b in zip(bounds[:-1], bounds[1:]):
                    mine = Sketch()
                    for i in range(a, b):
                        if held[i] is None:
                            mine = sketch
                        else:
                            mine.merge(Sketch.unpacked(*held[i]))
                    sketches.append(mine)
            ready = [names[i] for i in starts]
            if len(ready) > 1:
                yield row(ready[:-1], done[:-1], sketches[:-1])
            last, rest, sketch = ready[-1], done[-1:], sketches[-1] if sketched else sketch
        if last is not None:
            yield row([last], rest, [sketch])

    return run


def _buckets(x: np.ndarray, lo: np.ndarray, hi: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each value in its range; infinities are in -1 and ``buckets``."""
    with np.errstate(all="ignore"):
        # halved where the width of a very wide range would not be finite
        share = np.where(np.isfinite(hi - lo), (x - lo) / (hi - lo), (x / 2 - lo / 2) / (hi / 2 - lo / 2))
        bucket = np.where(hi == lo, 0, np.minimum(np.floor(share * float(buckets)), buckets - 1))
        return np.where(x == -np.inf, -1, np.where(x == np.inf, buckets, bucket)).astype(np.int64)


def count_buckets(features: Sequence[str], ranges: dict, buckets: int) -> Callable:
    """A function for ``mapInArrow`` over (split, one column per feature): (id, bucket, n, least, most).

    ``ranges`` gives per split and feature a list of (id, low, high). Bucket of a finite value within such a range: the
    range in ``buckets`` equal parts, the last one with its upper end; a range of one value is bucket 0. Infinities go
    to -1 and ``buckets`` of the first range.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            number, splits = _grouped(batch)
            for i, f in enumerate(features):
                mine = [ranges.get((s, f), ()) for s in splits]
                most = max(map(len, mine), default=0)
                if not most:
                    continue
                values = _Values(batch.column(i + 1))
                of, v = number[values.row], values.v
                keep = ~np.isnan(v)
                of, v = of[keep], v[keep]
                for j in range(most):
                    table = np.array([r[j] if j < len(r) else (-1, np.inf, -np.inf) for r in mine], "f8").reshape(-1, 3)
                    number_of, low, high = table[of].T
                    far = np.isinf(v) & (number_of >= 0) if j == 0 else np.zeros(len(v), bool)
                    inside = (v >= low) & (v <= high) & np.isfinite(v) | far
                    x, lo, hi, key = v[inside], low[inside], high[inside], number_of[inside].astype(np.int64)
                    if not len(x):
                        continue
                    bucket = _buckets(x, lo, hi, buckets)
                    order = np.lexsort((x, bucket, key))
                    x, bucket, key = x[order], bucket[order], key[order]
                    starts = np.flatnonzero(np.append(True, (bucket[1:] != bucket[:-1]) | (key[1:] != key[:-1])))
                    ends = np.append(starts[1:], len(x))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key[starts]), pa.array(bucket[starts].astype(np.int32)), pa.array(ends - starts),
                         pa.array(x[starts]), pa.array(x[ends - 1])], ["id", "bucket", "n", "least", "most"])

    return run


def _whole_splits(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by split (the first column), of about ``PIECE`` values or of one split: no split is cut."""
    held, size, most = [], 0, PIECE
    for batch in batches:
        if not len(batch):
            continue
        held.append(batch)
        size += len(batch) + sum(c.nbytes // 8 for c in batch.columns[1:])
        if size < most:
            continue
        rows = pa.Table.from_batches(held).combine_chunks()
        number = rows.column(0).combine_chunks().dictionary_encode(null_encoding="encode")
        number = (number.chunk(0) if isinstance(number, pa.ChunkedArray) else number).indices.to_numpy()
        cut = np.flatnonzero(number[1:] != number[:-1])
        if not len(cut):
            held, most = rows.to_batches(), 2 * size
            continue
        last = int(cut[-1]) + 1
        yield from rows.slice(0, last).to_batches()
        held = rows.slice(last).to_batches()
        size, most = size * (len(rows) - last) // len(rows), PIECE
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _gathered(batch: pa.RecordBatch, number: np.ndarray, i: int) -> tuple[np.ndarray, np.ndarray]:
    """The numbers and values of feature ``i`` without NaN, sorted by number and then by value."""
    values = _Values(batch.column(i + 1))
    real = ~np.isnan(values.v)
    of, v = number[values.row[real]], values.v[real]
    order = np.lexsort((v, of))
    return of[order], v[order]


def gather_quantiles(features: Sequence[str], ranks: Sequence[float]) -> Callable:
    """A function for ``mapInArrow`` over (split, one column per feature) sorted by split: (split, feature, rank, value)."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _whole_splits(batches):
            number, splits = _grouped(batch)
            for i, f in enumerate(features):
                of, v = _gathered(batch, number, i)
                count = np.bincount(of, minlength=len(splits))
                some, first = np.flatnonzero(count), np.cumsum(count) - count
                names = pa.array(splits, pa.string()).take(pa.array(some))
                for rank in ranks:
                    place = np.maximum(np.ceil(rank * count[some]), 1).astype(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [names, pa.array([f] * len(some), pa.string()), pa.array(np.full(len(some), rank)),
                         pa.array(v[first[some] + place - 1])], ["split", "feature", "rank", "value"])

    return run


def gather_buckets(features: Sequence[str], buckets: int, shared: dict | None) -> Callable:
    """A function for ``mapInArrow`` over (split, one column per feature) sorted by split: (split, feature, bucket, lo, hi, n).

    The range is that of the split's finite values, or what ``shared`` gives for the feature; null if there are none.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _whole_splits(batches):
            number, splits = _grouped(batch)
            for i, f in enumerate(features):
                of, v = _gathered(batch, number, i)
                low, high = np.full(len(splits), np.inf), np.full(len(splits), -np.inf)
                if shared is not None:
                    low[:], high[:] = shared[f]
                else:
                    finite = np.isfinite(v)
                    np.minimum.at(low, of[finite], v[finite])
                    np.maximum.at(high, of[finite], v[finite])
                bucket = _buckets(v, low[of], high[of], buckets)
                starts = np.flatnonzero(np.append(True, (bucket[1:] != bucket[:-1]) | (of[1:] != of[:-1]))) if len(v) else np.empty(0, int)
                own = of[starts]
                none = low[own] > high[own]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(splits, pa.string()).take(pa.array(own)), pa.array([f] * len(own), pa.string()),
                     pa.array(bucket[starts].astype(np.int32)), pa.array(low[own], mask=none), pa.array(high[own], mask=none),
                     pa.array(np.diff(np.append(starts, len(v))))], ["split", "feature", "bucket", "lo", "hi", "n"])

    return run
