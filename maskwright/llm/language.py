"""Language identification by the nearest of several centroids per language.

A text is a vector of counts of its letter n-grams (1 to 3 letters, words padded by a space, hashed into ``buckets``),
damped, weighted by inverse document frequency and scaled to length 1. Labelled texts of each language are clustered
on the sphere; a text gets the language of the centroid with the largest cosine. It is rejected when even that one is
much further away than labelled texts, or their openings, with about as many distinct n-grams are from theirs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from maskwright.llm.words import chunks
from maskwright.llm.worker import give_back, kept
from maskwright.session import materialise

UNKNOWN = "und"
BUCKETS = 1 << 13
CENTROIDS = 4  # per language
SAMPLE = 2_000  # labelled texts per language that the centroids are fitted on, about
MOST_LANGUAGES = 1_000
SLACK = 0.5  # of the cosine that nearly all labelled texts as rich as that reach
LENGTHS = 24  # classes of richness, by powers of two of the distinct n-grams
PIECES = (1, 2, 4, 8, 16, 32, 64)  # words of the openings that stand for short texts when thresholds are set

_ORDERS = (1, 2, 3)


def _letters() -> np.ndarray:
    """For every code point: the lower-case letter, or 0 for what is no letter."""
    table = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        if chr(c).isalpha():
            low = chr(c).lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


def features(texts: list[str | None], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of every n-gram of every text behind each other, and where each text begins (one more than texts)."""
    table = kept("letters", _letters)
    joined = np.frombuffer(" ".join(t or "" for t in texts).encode("utf-32-le", "replace"), np.uint32)
    letters = table[joined]
    # one blank at most between words: it begins and ends them
    keep = letters > 0
    keep[1:] |= letters[:-1] > 0
    ends = np.cumsum([len(t or "") + 1 for t in texts])
    text = np.repeat(np.arange(len(texts)), np.diff(ends, prepend=0))[:len(joined)][keep].astype(np.int32)
    letters = letters[keep].astype(np.uint64)
    found, owner = [], []
    for n in _ORDERS:
        if len(letters) < n:
            continue
        value = np.full(len(letters) - n + 1, n, np.uint64)
        for k in range(n):
            value = (value + letters[k:len(letters) - n + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
            value ^= value >> np.uint64(29)
        same = text[:len(value)] == text[n - 1:]
        if n == 1:
            same &= letters > 0
        found.append((value[same] % np.uint64(buckets)).astype(np.int32))
        owner.append(text[:len(value)][same])
    if not found:
        return np.empty(0, np.int32), np.zeros(len(texts) + 1, np.int64)
    bucket, text = np.concatenate(found), np.concatenate(owner)
    order = np.argsort(text, kind="stable")
    return bucket[order], np.searchsorted(text[order], np.arange(len(texts) + 1))


def vectors(texts: list[str | None], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors of the texts as rows, and their numbers of distinct n-grams; one without letters is a zero vector."""
    bucket, starts = features(texts, len(idf))
    out = np.zeros((len(texts), len(idf)), np.float32)
    for i, (a, b) in enumerate(zip(starts[:-1].tolist(), starts[1:].tolist())):
        if b > a:
            out[i] = np.bincount(bucket[a:b], minlength=len(idf))
    return weighted(out, idf), np.count_nonzero(out, axis=1)


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    out = np.log1p(counts, dtype=np.float32) * idf
    length = np.sqrt((out * out).sum(axis=1, keepdims=True))
    return out / np.where(length > 0, length, 1)


@dataclass
class Model:
    """``centroids`` are unit rows, ``languages`` names each one's; ``least`` is the cosine below which one rejects."""
    idf: np.ndarray
    centroids: np.ndarray
    languages: list[str]
    least: np.ndarray

    def judge(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, cosine and whether it is rejected, per text."""
        found, score, refused = [], [], []
        step = 512  # dense rows at a time
        for at in range(0, len(texts), step):
            rows, n = vectors(texts[at:at + step], self.idf)
            if not self.languages:
                found += [UNKNOWN] * len(n)
                score.append(np.zeros(len(n)))
                refused.append(np.ones(len(n), bool))
                continue
            near = rows @ self.centroids.T
            best = near.argmax(axis=1)
            cosine = np.clip(near[np.arange(len(n)), best], 0, 1).astype(np.float64)
            found += [self.languages[j] if m else UNKNOWN for j, m in zip(best.tolist(), n.tolist())]
            score.append(np.where(n > 0, cosine, 0.0))
            refused.append((n == 0) | (cosine < self.least[length_class(n)]))
        none = [np.zeros(0)]
        return found, np.concatenate(none + score), np.concatenate(none + refused).astype(bool)


def length_class(n: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(n, 1)).astype(int), LENGTHS - 1)


def cluster(rows: np.ndarray, k: int, turns: int = 12) -> np.ndarray:
    """Centroids of ``rows`` on the sphere, begun from rows as far from the earlier ones as can be."""
    centres = [rows.mean(axis=0)]
    centres[0] /= max(np.sqrt((centres[0] ** 2).sum()), 1e-12)
    near = rows @ centres[0]
    centres = []
    for _ in range(min(k, len(rows))):
        centres.append(rows[near.argmin()])
        near = np.maximum(near, rows @ centres[-1]) if len(centres) > 1 else rows @ centres[-1]
    held = np.stack(centres)
    for _ in range(turns):
        own = (rows @ held.T).argmax(axis=1)
        for j in range(len(held)):
            if (own == j).any():
                mean = rows[own == j].mean(axis=0)
                held[j] = mean / max(np.sqrt((mean * mean).sum()), 1e-12)
    return held


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", buckets: int = BUCKETS,
        centroids: int = CENTROIDS, sample: int = SAMPLE) -> Model:
    """Fit on about ``sample`` texts of each language, chosen by hash, equal texts once; languages with fewer give all.

    How many a language has is counted over what is drawn from: its distinct texts with a letter.

    Rows without text or language are left out, and so are texts without a letter. No labelled rows give a model that
    rejects every text. More than ``MOST_LANGUAGES`` languages are refused: the model goes to every task.
    """
    rows = labelled.select(F.col(lang_col).alias("lang_"), F.col(text_col).cast("string").alias("text_")).where(
        "lang_ is not null and text_ rlike '\\\\p{L}'")
    texts = rows.select("lang_", F.xxhash64("text_").alias("hash")).distinct()
    sizes = {r.lang_: r.n for r in texts.groupBy("lang_").agg(F.count("*").alias("n")).limit(MOST_LANGUAGES + 1).collect()}
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    if not sizes:
        return Model(np.ones(buckets, np.float32), np.zeros((0, buckets), np.float32), [], np.zeros(LENGTHS))
    share = F.create_map(*[F.lit(x) for lang, n in sorted(sizes.items()) for x in (lang, min(1.0, sample / n))])
    drawn = F.shiftrightunsigned(F.xxhash64("text_"), 11).cast("double") / float(1 << 53)
    chosen = rows.where(drawn < F.try_element_at(share, F.col("lang_"))).dropDuplicates(["lang_", "text_"])

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back("letters")
        for batch in chunks(batches, "text_", 1 << 20):
            texts, langs, whole = batch["text_"].to_pylist(), batch["lang_"].to_pylist(), [True] * len(batch)
            for lang, words in [(lang, t.split()) for lang, t in zip(langs, texts)]:
                short = [" ".join(words[:n]) for n in PIECES if n < len(words)]
                texts, langs, whole = texts + short, langs + [lang] * len(short), whole + [False] * len(short)
            bucket, starts = features(texts, buckets)
            held = [np.unique(bucket[a:b], return_counts=True) for a, b in zip(starts[:-1], starts[1:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array([x for x, _ in held], pa.list_(pa.int32())),
                 pa.array([n for _, n in held], pa.list_(pa.int64())), pa.array(whole)], ["lang", "bucket", "n", "whole"])

    both = materialise(chosen.mapInArrow(
        count, "lang string, bucket array<int>, n array<bigint>, whole boolean").where("size(bucket) > 0"), "language-sample")
    counted = both.where("whole")
    total = counted.count()
    df = np.zeros(buckets)
    for row in counted.select(F.explode("bucket").alias("b")).groupBy("b").count().collect():  # at most ``buckets``
        df[row.b] = row["count"]
    idf = np.log((1 + total) / (1 + df)).astype(np.float32) + np.float32(0.1)

    def rows_of(held: pd.DataFrame) -> np.ndarray:
        dense = np.zeros((len(held), buckets), np.float32)
        for i, (bucket, n) in enumerate(zip(held["bucket"], held["n"])):
            dense[i, bucket] = n
        return weighted(dense, idf)

    def centres(held: pd.DataFrame) -> pd.DataFrame:
        found = cluster(rows_of(held), centroids)
        return pd.DataFrame({"lang": held["lang"].iloc[0], "centroid": [c.tolist() for c in found]})

    fitted = counted.groupBy("lang").applyInPandas(centres, "lang string, centroid array<float>").orderBy("lang").collect()
    held, names = np.array([r.centroid for r in fitted], np.float32), np.array([r.lang for r in fitted])

    def nearness(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 512):
                some = batch.iloc[at:at + 512]
                near = (rows_of(some) @ held.T).max(axis=1)
                yield pd.DataFrame({"kind": length_class(some["n"].map(len).to_numpy()), "near": near.astype(float)})

    lowest = {r.kind: r for r in both.mapInPandas(nearness, "kind int, near double").groupBy("kind").agg(
        F.count("*").alias("n"), F.percentile_approx("near", 0.01).alias("near")).collect()}  # a row per class
    least, last = np.zeros(LENGTHS), 0.0
    for k in range(LENGTHS):  # richer texts are never held to less than poorer ones
        if k in lowest and lowest[k].n >= 20:
            last = max(last, SLACK * lowest[k].near)
        least[k] = last
    return Model(idf, held, names.tolist(), least)


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score and rejected.

    A text that is null or has no letter gets ``und``, score 0, and is rejected. Every other text gets the nearest
    centroid's language, its cosine as score, and is rejected if that is too low. Only the text is looked at, all of
    it. Columns of ``docs`` with these names are replaced.
    """
    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def judge(texts: pd.Series) -> pd.DataFrame:
        lang, score, refused = [], [], []
        give_back("letters")
        values = [None if t is None or t != t else t for t in texts]
        at = 0
        while at < len(values):  # about a million characters at a time: each takes some hundred bytes of arrays
            upto, size = at, 0
            while upto < len(values) and (upto == at or size < 1_000_000):
                size += len(values[upto] or "")
                upto += 1
            some = model.judge(values[at:upto])
            lang += some[0]
            score.append(some[1])
            refused.append(some[2])
            at = upto
        return pd.DataFrame({"lang_pred": lang, "score": np.concatenate([np.zeros(0), *score]),
                             "rejected": np.concatenate([np.zeros(0, bool), *refused])})

    own = [c for c in docs.columns if c.lower() not in ("lang_pred", "score", "rejected")]
    return docs.select(*own, judge(F.col(text_col).cast("string")).alias("judged_")).select(*own, "judged_.*")


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a document is kept from fitting; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))
