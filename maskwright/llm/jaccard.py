"""N-gram Jaccard join by vertical partitioning.

A document's set holds its distinct runs of words, as 64-bit hashes. Sets are compared as FS-Join does (Rong et al.,
"Fast and Scalable Distributed Set Similarity Joins for Big Data Analytics"): the global order of n-grams is cut into
fragments, each set falls into one segment per fragment, overlaps are counted in every fragment on their own, and the
counts are summed.

1. Equal sets form classes (128 bits of md5); the rest works on classes, so copies cost nothing further.
2. Segments of all classes go to their fragments, where the n-grams that occur in more than one class are counted per
   class. A class whose counts sum to less than ``percent`` of its set cannot have a partner and leaves.
3. Among the others, n-grams are ordered by frequency, and two sets that link share one in the prefixes that the
   threshold allows. Pairs met there have their segments intersected fragment by fragment, and the sums decide.

Only connections count, so pairs are compared in two ways. First every class is held against one anchor of each prefix
n-gram, which joins large groups of near copies with a few links per class. Then all pairs that share a prefix n-gram
and are not yet connected are compared: no link between components is lost, and none within one is needed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from maskwright.llm.graph import components
from maskwright.llm.words import chunks, distinct_runs, run_hashes, word_hashes
from maskwright.llm.worker import giving_back
from maskwright.session import materialise

SIZE = 5  # words of an n-gram
PERCENT = 75
FRAGMENT_BYTES = 16 << 20  # of text per fragment of step 2, some 2.5 million n-grams: what one task remembers
SEGMENTS = 8  # fragments of step 3, by the first three bits of the hash
SKETCH = 16  # words of 64 bits that bound how far two sets differ
ANCHOR_ROUNDS = 2

_SETS = "id_ bigint, n_shingles bigint, k1 bigint, k2 bigint"


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE,
                    percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, n_shingles, component_id (the smallest id reachable by links).

    Two rows link when ``100 * |A & B| >= percent * |A | B|``. A text of fewer than ``size`` words has one n-gram, all
    its words. A null text, or one without words, has an empty set and links with nothing. Ids may repeat: equal ids
    alone do not link. A null id is never the smallest; a component of null ids only gets a null component_id. Other
    columns are not read. An empty table gives an empty table. ``id_col`` must be an integer column.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("id_"), F.col(text_col).cast("string").alias("text_"))
    sets = materialise(rows.mapInArrow(giving_back(_sets(size)), _SETS), "jaccard-sets")
    filled = sets.where("n_shingles > 0")
    classes = materialise(filled.groupBy("k1", "k2").agg(
        F.min("id_").alias("rep"), F.first("n_shingles").alias("n")), "jaccard-classes")
    copies = filled.select("id_").distinct().join(classes.select(F.col("rep").alias("id_")), "id_", "left_anti")
    originals = rows.join(copies, "id_", "left_anti")
    possible = _possible(rows, originals, classes, size, percent)
    linked = _linked(_segments(rows, possible, size), percent)
    smallest = linked.join(classes, linked.node == classes.k1).groupBy("comp").agg(F.min("rep").alias("component"))
    known = classes.join(linked.join(smallest, "comp"), F.col("k1") == F.col("node"), "left").select(
        "k1", "k2", F.coalesce("component", "rep").alias("component_id"))
    out = (F.col("id_").alias(id_col), "n_shingles", "component_id")
    return filled.join(known, ["k1", "k2"]).select(*out).unionByName(
        sets.where("n_shingles = 0").withColumn("component_id", F.col("id_")).select(*out))


def _hashed(batch: pa.RecordBatch, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All sets of a batch behind each other, where each begins, and two 64-bit words that identify each."""
    hashes, offsets = distinct_runs(*run_hashes(*word_hashes(batch["text_"]), size))
    keys = b"".join(hashlib.md5(hashes[a:b].tobytes()).digest()
                    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()))
    return hashes, offsets, np.frombuffer(keys, np.int64).reshape(-1, 2)


def _sets(size: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text_"):
            _, offsets, keys = _hashed(batch, size)
            yield pa.RecordBatch.from_arrays(
                [batch["id_"], pa.array(np.diff(offsets)), pa.array(keys[:, 0]), pa.array(keys[:, 1])],
                names=["id_", "n_shingles", "k1", "k2"])
    return run


def _possible(rows: DataFrame, originals: DataFrame, classes: DataFrame, size: int, percent: int) -> DataFrame:
    """Classes (k1, rep) of which enough n-grams occur in other classes too."""
    total = rows.agg(F.sum(F.octet_length("text_"))).first()[0] or 0
    fragments = int(max(8, total // FRAGMENT_BYTES))
    counts = (originals.mapInArrow(giving_back(_scatter(size, fragments)), "fragment int, held binary")
              .repartitionById(fragments, "fragment")
              .mapInArrow(giving_back(_count_shared), "node bigint, shared bigint")
              .groupBy("node").agg(F.sum("shared").alias("shared")))
    near = classes.join(counts, F.col("k1") == F.col("node")).where(
        F.col("shared") * 100 >= F.col("n") * percent).select("k1", "rep")
    return materialise(near, "jaccard-possible")


_ENTRY = np.dtype([("token", "<u4"), ("doc", "<u2")])
_KNOWN = np.dtype([("doc", "<u2"), ("shared", "<u4")])
_MERGE = 500_000  # entries that are gathered before they are merged, at least
_DOCS = 1 << 15  # of a batch, at most twice as many: an entry numbers them in two bytes


def _scatter(size: int, fragments: int):
    """Cut each set by fragment: one row per fragment and some thousand documents.

    ``held`` has four counts, then the documents' classes, how many n-grams each shares within this batch already, and
    the n-grams as the low half of the hash and the document's number: shared ones first, then the others. Of an n-gram
    that several classes of the batch share only one entry is sent, so frequent n-grams are combined before the shuffle.
    """
    def flush(parts: list) -> Iterator[pa.RecordBatch]:
        hashes = np.concatenate([p[0] for p in parts])
        sizes = np.concatenate([p[1] for p in parts])
        keys = np.concatenate([p[2] for p in parts])
        doc = np.repeat(np.arange(len(keys)), sizes)
        order = np.argsort(hashes)
        hashes, doc = hashes[order], doc[order]
        first = np.ones(len(hashes), bool)
        first[1:] = hashes[1:] != hashes[:-1]
        last = np.roll(first, -1)
        several = ~(first & last)  # of distinct classes: each was taken once
        fragment = ((hashes >> np.uint64(32)) * np.uint64(fragments) >> np.uint64(32)).astype(np.int64)
        edges = np.searchsorted(fragment, np.arange(fragments + 1))
        ids, held = [], []
        for f, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())):
            if a == b:
                continue
            here, number = np.unique(doc[a:b], return_inverse=True)
            shares, n = np.unique(number[several[a:b]], return_counts=True)
            known = np.empty(len(shares), _KNOWN)
            known["doc"], known["shared"] = shares, n
            entries = np.empty(b - a, _ENTRY)
            entries["token"], entries["doc"] = hashes[a:b].astype(np.uint32), number
            sent = (entries[first[a:b] & several[a:b]], entries[~several[a:b]])
            counts = np.array([len(here), len(known), len(sent[0]), len(sent[1])], np.int64)
            ids.append(f)
            held.append(b"".join(x.tobytes() for x in (counts, keys[here], known, *sent)))
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(held, pa.binary())], ["fragment", "held"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, tokens, seen = [], 0, set()
        for whole in chunks(batches, "text_", 1 << 20):
            for at in range(0, len(whole), _DOCS):
                hashes, offsets, keys = _hashed(whole.slice(at, _DOCS), size)
                n = np.diff(offsets)
                new = np.zeros(len(keys), bool)
                for i in np.flatnonzero(n).tolist():
                    if (key := int(keys[i, 0])) not in seen:
                        seen.add(key)
                        new[i] = True
                parts.append((hashes[np.repeat(new, n)], n[new], keys[new, 0]))
                tokens += len(parts[-1][0])
                if tokens > 3_000_000 or len(seen) >= _DOCS:
                    yield from flush(parts)
                    parts, tokens, seen = [], 0, set()
        if tokens:
            yield from flush(parts)
    return run


def _count_shared(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per class, how many of its n-grams in these fragments occur in another class.

    Streams: an n-gram's first class is remembered, with how many n-grams it has that agree in fragment and low half, and
    credited with all of them when a second class comes; later ones are credited at once. Memory holds the distinct n-grams of the task's fragments, not their occurrences. Unequal n-grams that agree
    in fragment and low half count as shared: the count is only ever too high, and step 3 is exact.
    """
    state = (np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, bool), np.empty(0, np.int32))

    def credit(nodes: np.ndarray, weights: np.ndarray | None = None) -> pa.RecordBatch:
        found, at = np.unique(nodes, return_inverse=True)
        n = np.bincount(at, weights, len(found)).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(found), pa.array(n)], ["node", "shared"])

    def merge(parts: list) -> pa.RecordBatch:
        nonlocal state
        token = np.concatenate([state[0], *(p[0] for p in parts)])
        node = np.concatenate([state[1], *(p[1] for p in parts)])
        shared = np.concatenate([state[2], *(p[2] for p in parts)])
        weight = np.concatenate([state[3], np.ones(len(token) - len(state[3]), np.int32)])
        order = np.argsort(token, kind="stable")  # what is remembered comes before what is new
        token, node, shared, weight = token[order], node[order], shared[order], weight[order]
        first = np.ones(len(token), bool)
        first[1:] = token[1:] != token[:-1]
        group = np.cumsum(first) - 1
        head = np.flatnonzero(first)
        differs = np.zeros(len(head), bool)
        differs[group[node != node[head][group]]] = True
        common = differs.copy()
        common[group[shared]] = True
        # an entry marked as shared was credited where it was sent from
        due = common[group] & ~shared
        state = (token[head], node[head], common, np.add.reduceat(weight, head, dtype=np.int32))
        return credit(node[due], weight[due])

    parts, size = [], 0
    for batch in batches:
        for f, held in zip(batch["fragment"].to_pylist(), batch["held"]):
            raw = held.as_buffer()
            docs, known, sent, others = np.frombuffer(raw, np.int64, 4).tolist()
            keys = np.frombuffer(raw, np.int64, docs, 32)
            known = np.frombuffer(raw, _KNOWN, known, 32 + 8 * docs)
            entries = np.frombuffer(raw, _ENTRY, sent + others, 32 + 8 * docs + known.nbytes)
            if len(known):
                yield credit(keys[known["doc"]], known["shared"])
            parts.append((entries["token"].astype(np.uint64) | np.uint64(f << 32), keys[entries["doc"]],
                          np.arange(sent + others) < sent))
            size += len(entries)
            if size > _MERGE + len(state[0]) // 2:
                yield merge(parts)
                parts, size = [], 0
    if parts:
        yield merge(parts)


def _segments(rows: DataFrame, possible: DataFrame, size: int) -> DataFrame:
    """node, n, held, bits: the n-grams of each class that is left, by fragment of the order, and a sketch.

    The sketch has a bit for each remainder of the hash, set where an odd number of n-grams have it.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = (np.arange(1, SEGMENTS, dtype=np.uint64) << np.uint64(61))
        for batch in chunks(batches, "text_", 1 << 20):
            hashes, offsets, keys = _hashed(batch, size)
            held, bits = [], []
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                own = hashes[a:b]
                held.append([x.view(np.int64) for x in np.split(own, np.searchsorted(own, bounds))])
                odd = np.bincount((own % np.uint64(64 * SKETCH)).astype(np.int64), minlength=64 * SKETCH) & 1
                bits.append(np.packbits(odd.astype(np.uint8)).view(np.int64))
            yield pa.RecordBatch.from_arrays([
                pa.array(keys[:, 0]), pa.array(np.diff(offsets)), pa.array(held, pa.list_(pa.list_(pa.int64()))),
                pa.array(bits, pa.list_(pa.int64()))], ["node", "n", "held", "bits"])

    reps = possible.select(F.col("rep").alias("rep_")).distinct()
    texts = rows.join(reps, rows.id_.eqNullSafe(reps.rep_), "left_semi")
    cut = texts.mapInArrow(giving_back(run), "node bigint, n bigint, held array<array<bigint>>, bits array<bigint>")
    cut = cut.join(possible.select(F.col("k1").alias("node")), "node", "left_semi")
    return materialise(cut.dropDuplicates(["node"]), "jaccard-segments")


def _prefixes(segments: DataFrame, percent: int) -> DataFrame:
    """node, n, token, pos: the n-grams by which a set must meet any partner, at their place in its order.

    The order goes by frequency, then hash. N-grams of one class only stand first and never meet, so they are left out.
    """
    tokens = segments.select("node", "n", F.explode(F.flatten("held")).alias("token"))
    common = tokens.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    ordered = tokens.join(common, "token").groupBy("node", "n").agg(
        F.array_sort(F.collect_list(F.struct("df", "token"))).alias("held"))
    alone = F.col("n") - F.size("held")
    least = F.ceil(F.col("n") * percent / 100)  # overlap with any partner
    keep = F.greatest(F.lit(0), F.col("n") - least + 1 - alone).cast("int")
    placed = ordered.select("node", "n", alone.alias("alone"), F.posexplode(F.slice("held", 1, keep)))
    return placed.select("node", "n", F.col("col.token").alias("token"), (F.col("alone") + F.col("pos")).alias("pos"))


def _need(percent: int, a: str, b: str) -> Column:
    return F.ceil((F.col(f"{a}.n") + F.col(f"{b}.n")) * percent / (100 + percent))


def _near_enough(percent: int, a: str, b: str) -> Column:
    """Sketches differ in no more bits than linked sets have n-grams on one side only."""
    bits = [F.bit_count(F.get(f"{a}.bits", F.lit(i)).bitwiseXOR(F.get(f"{b}.bits", F.lit(i)))) for i in range(SKETCH)]
    return sum(bits[1:], bits[0]) <= F.col(f"{a}.n") + F.col(f"{b}.n") - 2 * _need(percent, a, b)


def _may_link(percent: int, a: str, b: str) -> Column:
    """Sizes and places allow the overlap that a link needs, if this is their first n-gram in common."""
    need = _need(percent, a, b)
    rest = F.least(F.col(f"{a}.n") - F.col(f"{a}.pos"), F.col(f"{b}.n") - F.col(f"{b}.pos"))
    return rest >= need


def _verified(pairs: DataFrame, segments: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that link: partial overlaps of the fragments, summed per pair."""
    left = segments.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("held").alias("held_a"))
    right = segments.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("held").alias("held_b"))
    partial = F.zip_with("held_a", "held_b", lambda x, y: F.size(F.array_intersect(x, y)))
    both = F.aggregate(partial, F.lit(0), lambda total, n: total + n)
    summed = pairs.join(left, "a").join(right, "b").select("a", "b", "na", "nb", both.alias("both"))
    return summed.where(F.col("both") * 100 >= (F.col("na") + F.col("nb") - F.col("both")) * percent).select("a", "b")


def _linked(segments: DataFrame, percent: int) -> DataFrame:
    """node, comp for every class that is linked to another."""
    sketches = segments.select("node", "bits")
    prefixes = materialise(_prefixes(segments, percent), "jaccard-prefixes")
    edges, comps = None, None
    for turn in range(ANCHOR_ROUNDS + 1):
        held = prefixes.withColumn("comp", F.col("node")) if comps is None else prefixes.join(
            comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
        # only n-grams of several components matter from here
        groups = held.groupBy("token").agg(
            F.min("comp").alias("low"), F.max("comp").alias("high"),
            F.min_by(F.struct("node", "n", "pos", "comp"), F.xxhash64("node", F.lit(turn))).alias("anchor"),
        ).where("low < high").select("token", "anchor")
        a, b = F.col("x.node"), F.col("y.node")
        if turn < ANCHOR_ROUNDS:
            other = groups.select("token", "anchor.*").alias("y")
            meet = held.alias("x").join(other, "token").where(a != b)
        else:
            mixed = held.join(groups.select("token"), "token").join(sketches, "node")
            meet = mixed.alias("x").join(mixed.alias("y"), "token").where((a < b) & _near_enough(percent, "x", "y"))
        pairs = meet.where((F.col("x.comp") != F.col("y.comp")) & _may_link(percent, "x", "y")).select(
            F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()
        found = materialise(_verified(pairs, segments, percent), "jaccard-links")
        edges = found if edges is None else edges.unionByName(found)
        comps = components(edges)
    return comps
