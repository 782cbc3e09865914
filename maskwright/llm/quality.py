"""A quality classifier: random-indexing word vectors pooled per document, and a two-layer network on top.

Words. A text is cut into stretches of letters, of digits and of other signs; case is folded but for words all in
capitals. A word is known by a hash into ``WORDS`` classes, so that the model has one size whatever the corpus, and no
word is unknown to it.

Vectors. Each class has an index vector of ``DIMS`` places, ``ONES`` of them 1 or -1 and the others 0. A class's
context vector sums the index vectors of the words up to ``REACH`` places away, turned by half its length for those on
the right, over every word of every document. A word vector is the context vector, centred and of length one, plus the
index vector of length one.

Documents. Word vectors are averaged, rarer words weighing more, and so are their squares; three more features are how
alike neighbours are, and how many words and different words there are. A network of two layers is trained on ``SAMPLE`` labelled documents
per label at most (all of them if there are fewer), chosen by a hash of their id. A fifth of these is kept out of
the training to choose when to stop it, and the temperature that makes the outputs probabilities.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from maskwright.llm.words import buffers, chunks

WORDS = 1 << 14  # classes of words
DIMS = 64
ONES = 4
REACH = 2
RARE = 1e-3  # share of all words at which a word weighs half
SAMPLE = 8_000  # labelled documents per label that the network is fitted on
HIDDEN = 32
ROUNDS = 400

_ODD = np.uint64(0x9E3779B97F4A7C15)
_SHARE = 1 << 20  # bytes of text that are worked on at once


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _ODD
    x = (x ^ (x >> np.uint64(29))) * _ODD
    return x ^ (x >> np.uint64(32))


_KIND = np.full(256, 3, np.uint8)  # 0 parts words, 1 letters, 2 digits, 3 other signs
_KIND[[0x20, *range(0x09, 0x0E)]] = 0
_KIND[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_KIND[48:58] = 2
_FOLDED = np.arange(256, dtype=np.uint64)
_FOLDED[65:91] += np.uint64(32)
_VALUE = _mixed(_FOLDED + np.uint64(1))
_CAPITAL = np.zeros(256, np.int64)
_CAPITAL[65:91] = 1


def word_classes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The class of every word, and the first word of each text (one more than texts); null is an empty text."""
    data, starts = buffers(texts)
    kind = _KIND[data]
    opens = np.append(True, kind[1:] != kind[:-1])[:len(data)]
    opens[starts[:-1][starts[:-1] < len(data)]] = True
    begin = np.flatnonzero(opens)
    if not len(begin):
        return np.empty(0, np.int64), np.zeros(len(starts), np.int64)
    sizes = np.diff(np.append(begin, len(data)))
    powers = np.cumprod(np.full(int(sizes.max()), _ODD))  # modulo 2^64
    place = np.arange(len(data)) - np.repeat(begin, sizes)
    capitals = np.add.reduceat(_CAPITAL[data], begin)
    hashes = np.add.reduceat(_VALUE[data] * powers[place], begin) + ((capitals > 1) & (capitals == sizes)).astype(np.uint64)
    words = kind[begin] > 0
    first = np.append(0, np.cumsum(words))[np.searchsorted(begin, starts)]
    return (_mixed(hashes[words]) % np.uint64(WORDS)).astype(np.int64), first


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Per class the places that are not 0, and their signs. Places of a class differ."""
    seed = _mixed(np.arange(1, WORDS * ONES + 1, dtype=np.uint64).reshape(WORDS, ONES) * _ODD)
    width = DIMS // ONES
    places = (seed % np.uint64(width)).astype(np.int64) + width * np.arange(ONES)
    return places, np.where(seed >> np.uint64(63) == 1, 1.0, -1.0)


def context_sums(classes: np.ndarray, first: np.ndarray, into: np.ndarray) -> None:
    """Add the index vectors of each word's neighbours to its class's row of ``into`` (classes by dimensions)."""
    places, signs = index_vectors()
    flat = into.reshape(-1)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    for gap in range(1, REACH + 1):
        left, right = classes[:-gap], classes[gap:]
        together = text[:-gap] == text[gap:]
        left, right = left[together], right[together]
        for word, near, turn in ((left, right, DIMS // 2), (right, left, 0)):
            at = (word * DIMS)[:, None] + (places[near] + turn) % DIMS
            flat += np.bincount(at.ravel(), signs[near].ravel(), len(flat))


def corpus_vectors(docs: DataFrame, text_col: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """Word vectors and weights (classes by dimensions, and classes) over all texts of ``docs``.

    Each task adds its words up in one table of the model's size; these tables are added up by class. All sums are of
    whole numbers, so they do not depend on how the texts lie in tasks.
    """
    columns = [f"d{i}" for i in range(DIMS)]

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, seen = np.zeros((WORDS, DIMS)), np.zeros(WORDS, np.int64)
        for batch in chunks(batches, "text_", _SHARE):
            classes, first = word_classes(batch["text_"])
            seen += np.bincount(classes, minlength=WORDS)
            context_sums(classes, first, sums)
        met = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(met), pa.array(seen[met]), *[pa.array(sums[met, i].astype(np.int64)) for i in range(DIMS)]],
            ["word", "n", *columns])

    parts = docs.select(F.col(text_col).cast("string").alias("text_")).mapInArrow(
        count, ", ".join(f"{c} bigint" for c in ("word", "n", *columns)))
    table = parts.groupBy("word").agg(*[F.sum(c).alias(c) for c in ("n", *columns)]).toArrow()  # WORDS rows at most
    sums, seen = np.zeros((WORDS, DIMS)), np.zeros(WORDS)
    word = table["word"].to_numpy()
    seen[word] = table["n"].to_numpy()
    for i, c in enumerate(columns):
        sums[word, i] = table[c].to_numpy()
    context = sums / np.maximum(seen, 1)[:, None]
    context -= (context * seen[:, None]).sum(axis=0) / max(seen.sum(), 1)
    context /= np.maximum(np.sqrt((context ** 2).sum(axis=1)), 1e-9)[:, None]
    places, signs = index_vectors()
    np.put_along_axis(context, places, np.take_along_axis(context, places, 1) + signs / np.sqrt(ONES), 1)
    weights = RARE / (RARE + seen / max(seen.sum(), 1))
    return context.astype(np.float32), weights.astype(np.float32)


def pooled(texts: pa.Array, vectors: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Features of each text: mean and spread of its word vectors, likeness of neighbours, words, different words."""
    classes, first = word_classes(texts)
    n = np.diff(first)
    out = np.zeros((len(n), 2 * DIMS + 3))
    out[:, -2] = np.log1p(n)
    lengths = np.sqrt((vectors ** 2).sum(axis=1)) + 1e-9
    for i, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
        if a == b:
            continue
        word, times = np.unique(classes[a:b], return_counts=True)
        out[i, -1] = np.log(len(word) / (b - a))
        w = weights[word] * times
        w /= w.sum()
        held = vectors[word]
        mean = w @ held
        out[i, :DIMS] = mean
        out[i, DIMS:2 * DIMS] = np.sqrt(np.maximum(w @ held ** 2 - mean ** 2, 0))
        if b - a > 1:
            near = 0.0
            for at in range(a, b - 1, 1 << 16):  # long texts in turns
                x, y = classes[at:min(at + (1 << 16), b - 1)], classes[at + 1:min(at + (1 << 16), b - 1) + 1]
                near += ((vectors[x] * vectors[y]).sum(axis=1) / (lengths[x] * lengths[y])).sum()
            out[i, 2 * DIMS] = near / (b - a - 1)
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def _loss(logit: np.ndarray, y: np.ndarray) -> float:
    p = np.clip(_sigmoid(logit), 1e-12, 1 - 1e-12)
    return float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean())


@dataclass
class Network:
    """Features are standardised, go through ``HIDDEN`` rectified units, and give one logit that is divided by ``heat``."""

    middle: np.ndarray
    spread: np.ndarray
    layers: list[np.ndarray]
    heat: float = 1.0

    def logit(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        z = np.clip((x - self.middle) / self.spread, -8, 8)
        return np.maximum(z @ w1 + b1, 0) @ w2 + b2[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logit(x) / self.heat)


def train(x: np.ndarray, y: np.ndarray, kept: np.ndarray, rounds: int = ROUNDS) -> Network:
    """Fit by Adam on the rows that are not ``kept``; those say which round was best, and then the temperature.

    Where one of the parts lacks a label, all rows serve as both.
    """
    if len(set(y[kept])) < 2 or len(set(y[~kept])) < 2:
        fit = check = np.ones(len(y), bool)
    else:
        fit, check = ~kept, kept
    middle, spread = x[fit].mean(axis=0), x[fit].std(axis=0) + 1e-3
    rng = np.random.default_rng(13)
    layers = [rng.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN),
              rng.normal(0, np.sqrt(1 / HIDDEN), HIDDEN), np.zeros(1)]
    net = Network(middle, spread, layers)
    z, t = np.clip((x[fit] - middle) / spread, -8, 8), y[fit]
    moved, rough = [np.zeros_like(v) for v in layers], [np.zeros_like(v) for v in layers]
    best, best_loss = [v.copy() for v in layers], np.inf
    for step in range(1, rounds + 1):
        w1, b1, w2, b2 = net.layers
        inner = np.maximum(z @ w1 + b1, 0)
        error = (_sigmoid(inner @ w2 + b2[0]) - t) / len(t)
        back = np.outer(error, w2) * (inner > 0)
        grads = [z.T @ back + 1e-3 * w1, back.sum(axis=0), inner.T @ error + 1e-3 * w2, np.array([error.sum()])]
        for v, g, m, r in zip(net.layers, grads, moved, rough):
            m += 0.1 * (g - m)
            r += 0.001 * (g * g - r)
            v -= 0.01 * (m / (1 - 0.9 ** step)) / (np.sqrt(r / (1 - 0.999 ** step)) + 1e-8)
        if step % 10 == 0:
            loss = _loss(net.logit(x[check]), y[check])
            if loss < best_loss:
                best, best_loss = [v.copy() for v in net.layers], loss
    net.layers = best
    logit = net.logit(x[check])
    heats = np.exp(np.linspace(np.log(0.25), np.log(8), 101))
    net.heat = float(min(heats, key=lambda heat: _loss(logit / heat, y[check])))
    return net


@dataclass
class Model:
    vectors: np.ndarray
    weights: np.ndarray
    network: Network | None  # None: only one label was learned, which is ``only``
    only: float = 0.5

    def score(self, texts: pa.Array) -> np.ndarray:
        if self.network is None:
            return np.full(len(texts), self.only)
        held = [np.zeros(0)]
        for batch in chunks([pa.RecordBatch.from_arrays([texts], ["text_"])], "text_", _SHARE):
            held.append(self.network.score(pooled(batch["text_"], self.vectors, self.weights)))
        return np.concatenate(held)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text",
        sample: int = SAMPLE) -> Model:
    """Word vectors over all texts of ``docs``, a network over the labelled ones that ``sample`` allows.

    ``labels`` has a row per labelled id with ``label`` 0 or 1. Null ids and labels are left out, and ids whose labels
    contradict each other; an id of several documents stands for the one with the smallest hash of its text. A null
    text is an empty one. Without labelled documents every score is 0.5, with one label only every score is that label.
    """
    vectors, weights = corpus_vectors(docs, text_col)
    marked = labels.select(F.col(id_col).alias("id_"), F.col(label).cast("int").alias("y_")).where(
        "id_ is not null and y_ in (0, 1)").groupBy("id_").agg(F.min("y_").alias("y_"), F.max("y_").alias("most_"))
    marked = marked.where("y_ = most_").select("id_", "y_", F.xxhash64("id_").alias("turn_"))
    first = [marked.where(F.col("y_") == y).orderBy("turn_", "id_").limit(sample) for y in (0, 1)]
    chosen = first[0].unionByName(first[1])
    texts = docs.select(F.col(id_col).alias("of_"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text_"))
    texts = texts.join(F.broadcast(chosen), F.col("of_") == F.col("id_"))  # of ``2 * sample`` rows at most
    once = texts.groupBy("id_", "y_", "turn_").agg(F.min_by("text_", F.xxhash64("text_")).alias("text_"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text_", _SHARE):
            rows = pooled(batch["text_"], vectors, weights).astype(np.float32)
            yield pa.RecordBatch.from_arrays(
                [batch["turn_"], batch["y_"], pa.array(list(rows), pa.list_(pa.float32()))], ["turn", "y", "x"])

    held = once.mapInArrow(run, "turn bigint, y int, x array<float>").toPandas().sort_values("turn", kind="stable")
    y = held["y"].to_numpy(float)
    if len(set(y)) < 2:
        return Model(vectors, weights, None, float(y[0]) if len(y) else 0.5)
    turn = held["turn"].to_numpy().astype(np.uint64)
    return Model(vectors, weights, train(np.stack(held["x"]).astype(float), y, _mixed(turn) % np.uint64(5) == 0))


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score``, the probability (0 to 1) of label 1, from the whole text alone.

    Null and empty texts, and texts of blanks, get the score of no words. Scores are rounded to six places. A column
    named score is replaced; an empty table gives no rows.
    """
    @F.arrow_udf("double")
    def judge(texts: pa.Array) -> pa.Array:
        return pa.array(np.round(model.score(texts), 6), pa.float64())  # sums differ in last digits by batch

    own = [c for c in docs.columns if c.lower() != "score"]
    return docs.select(*own, judge(F.col(text_col).cast("string")).alias("score"))


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a document's label is kept from learning; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))
