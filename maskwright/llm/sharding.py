"""Shards as the leaves of a k-d tree over document metadata, with DataFrame functions only.

Every node is cut at a weighted quantile of its widest dimension, found by counting weights in bins over all rows and
looking closer only into the bin where the cut falls. Rows of one group never part: they agree in all dimensions
and in the number that breaks ties. A cut misses its share by part of the group that lies across it, and long texts
meet in the same leaves, so at the end some groups change places between leaves until these are near equal in weight.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from maskwright.session import materialise

BINS = 1024
NEAR = 1e-3  # of a leaf's weight: a bin as light as this is not looked into further
MOST_PASSES = 12  # two numbers of 53 bits, ten bits a pass
MOVABLE = 256  # groups of a leaf that may change places: its lightest ones, and the heaviest that could help
EVEN = 1e-3  # of a leaf's weight: nearer than this to their mean, leaves stay as they are
MOST_MOVES = 20_000
_TIES = float(1 << 53)


@dataclass
class Node:
    """A part of the space that is to have ``leaves`` shards, from ``first`` on."""
    first: int
    leaves: int


@dataclass
class _Search:
    """Where a node's cut is looked for: ``low`` to ``high`` of dimension ``dim``, after ``before`` of the weight."""
    dim: int
    target: float
    near: float
    low: float
    high: float
    before: float = 0.0
    value: float | None = None  # of the dimension, once only ties are left to part


def tie_of(group: str) -> Column:
    """A number from 0 to 2^53 that is the same for all rows of a group."""
    return F.shiftrightunsigned(F.xxhash64(F.col(group)), 11).cast("double")


def kd_shards(rows: DataFrame, dims: list[str], shards: int, weight: str = "size", group: str = "group") -> DataFrame:
    """``rows`` with the column shard, 0 to ``shards - 1``.

    Weights are near equal: the tree's leaves differ by parts of groups, and what groups can even out by changing places
    they do. A group heavier than a shard's share has a shard to itself, and the others share the rest. ``dims``
    must be numbers without nulls, the same throughout a group. Rows are written once per level of the tree, so they
    should be narrow. No rows give no rows.
    """
    own = _heavy(rows, shards, weight, group)
    nodes = [Node(len(own), shards - len(own))] + [Node(i, 1) for i in range(len(own))]
    point = F.array(*[F.col(d).cast("double") for d in dims], tie_of(group))
    number = F.coalesce(F.array_position(F.array(*[F.lit(x) for x in own]), F.col(group)), F.lit(0)) if own else F.lit(0)
    held = materialise(rows.withColumns({"point_": point, "node_": number.cast("int")}), "sharding-level")
    while any(n.leaves > 1 for n in nodes):
        cuts = _cuts(held, nodes, len(dims), weight)
        below, left, right = [], [], []
        for i, node in enumerate(nodes):
            left.append(len(below))
            if i not in cuts:  # a leaf, or no rows
                below.append(Node(node.first, 1))
            else:
                half = node.leaves // 2
                below += [Node(node.first, half), Node(node.first + half, node.leaves - half)]
            right.append(len(below) - 1)
        dim, value, tie = zip(*[cuts.get(i, (0, 0.0, 0.0)) for i in range(len(nodes))])
        at = F.get("point_", _of(dim))
        goes_left = (at < _of(value)) | ((at == _of(value)) & (F.get("point_", F.lit(len(dims))) <= _of(tie)))
        held = materialise(held.withColumn("node_", F.when(goes_left, _of(left)).otherwise(_of(right))), "sharding-level")
        nodes = below
    placed = held.withColumn("shard", _of([n.first for n in nodes])).drop("point_", "node_")
    moves = _moves(placed, len(own), shards, weight, group)
    if not moves:
        return placed
    moved = F.create_map(*[F.lit(x) for pair in sorted(moves.items()) for x in pair])
    return placed.withColumn("shard", F.coalesce(F.try_element_at(moved, F.col(group)), F.col("shard")).cast("int"))


def _moves(placed: DataFrame, own: int, shards: int, weight: str, group: str) -> dict[int, int]:
    """Groups that are to change places, with their new shards. Some hundred groups of each leaf are looked at."""
    groups = materialise(placed.where(F.col("shard") >= own).groupBy("shard", F.col(group).alias("group_")).agg(
        F.sum(weight).alias("weight_")), "sharding-groups")
    weights = {i: 0 for i in range(own, shards)} | {
        r.shard: r.weight_ for r in groups.groupBy("shard").agg(F.sum("weight_").alias("weight_")).collect()}
    mean = sum(weights.values()) / max(1, len(weights))
    widest = max((abs(w - mean) for w in weights.values()), default=0.0)
    if widest <= EVEN * mean:
        return {}

    def some(rows: DataFrame, *order: Column) -> DataFrame:
        at = F.row_number().over(Window.partitionBy("shard").orderBy(*order))  # cut in each partition before the shuffle
        return rows.withColumn("at", at).where(F.col("at") <= MOVABLE).drop("at")

    light = some(groups, F.col("weight_"), F.col("group_"))
    heavy = some(groups.where(F.col("weight_") <= 2 * widest), F.desc("weight_"), F.col("group_"))
    movable: dict[int, list[tuple[int, int]]] = {i: [] for i in weights}
    for r in light.union(heavy).distinct().collect():
        movable[r.shard].append((r.weight_, r.group_))
    home = {g: i for i, held in movable.items() for _, g in held}
    for held in movable.values():
        held.sort()
    place = dict(home)
    for _ in range(MOST_MOVES):
        order = sorted(weights, key=lambda i: (weights[i], i))
        if weights[order[-1]] - weights[order[0]] <= EVEN * mean:
            break
        # the heaviest leaf with each other one, the lightest first, then the lightest with each other one
        pairs = [(order[-1], i) for i in order[:-1]] + [(i, order[0]) for i in reversed(order[1:-1])]
        found = ((over, under, _step(movable[over], movable[under], weights[over] - weights[under])) for over, under in pairs)
        over, under, step = next((x for x in found if x[2]), (0, 0, None))
        if step is None:
            break
        for item, source, target in zip(step, (over, under), (under, over)):
            if item is not None:
                movable[source].remove(item)
                insort(movable[target], item)
                weights[source] -= item[0]
                weights[target] += item[0]
                place[item[1]] = target
    return {g: i for g, i in place.items() if home[g] != i}


def _step(over: list[tuple[int, int]], under: list[tuple[int, int]], gap: float):
    """What moves over to the lighter leaf, and what comes back for it (or None), so that the gap narrows most."""
    best, left = None, gap
    lighter = [(0, None), *under]
    for item in over:
        at = bisect_left(lighter, (item[0] - gap / 2,))
        for back in lighter[max(0, at - 1):at + 1]:
            rest = abs(gap - 2 * (item[0] - back[0]))
            if rest < left * (1 - 1e-9):
                best, left = (item, back if back[1] is not None else None), rest
    return best


def _of(values) -> Column:
    """The entry of ``values`` for a row's node."""
    return F.get(F.array(*[F.lit(v) for v in values]), F.col("node_"))


def _heavy(rows: DataFrame, shards: int, weight: str, group: str) -> list[int]:
    """Groups that outweigh an equal share of what heavier ones leave, heaviest first."""
    total = float(rows.agg(F.sum(weight)).first()[0] or 0)
    sums = rows.groupBy(F.col(group).alias("group_")).agg(F.sum(weight).alias("weight_"))
    own: list[int] = []
    for row in sums.orderBy(F.desc("weight_"), "group_").limit(shards).collect():  # no more can be as heavy as that
        if len(own) + 1 >= shards or row.weight_ * (shards - len(own)) <= total:
            break
        own.append(row.group_)
        total -= row.weight_
    return own


def _cuts(held: DataFrame, nodes: list[Node], dims: int, weight: str) -> dict[int, tuple[int, float, float]]:
    """For each node that has rows and more than one leaf: dimension, value and tie of its cut; what is not greater goes
    left."""
    stats = held.groupBy("node_").agg(F.sum(weight).alias("weight"), *[f(F.get("point_", F.lit(d))).alias(f"{n}{d}") for d in
                                      range(dims) for n, f in (("low", F.min), ("high", F.max))]).collect()  # a row per node
    wide = [max(r[f"high{d}"] for r in stats) - min(r[f"low{d}"] for r in stats) if stats else 0.0 for d in range(dims)]
    searches, done = {}, {}
    for r in stats:
        node = nodes[r.node_]
        if node.leaves > 1:
            dim = max(range(dims), key=lambda d: (r[f"high{d}"] - r[f"low{d}"]) / wide[d] if wide[d] else 0.0)
            searches[r.node_] = _Search(dim, float(r.weight) * (node.leaves // 2) / node.leaves,
                                        float(r.weight) / node.leaves * NEAR, r[f"low{dim}"], r[f"high{dim}"])
    for _ in range(MOST_PASSES):
        if not searches:
            break
        for number, bin_ in _crossing(held, searches, len(nodes), dims, weight).items():
            s = searches[number]
            if bin_.low < bin_.high and bin_.weight > s.near:
                s.low, s.high, s.before = bin_.low, bin_.high, bin_.before
            elif bin_.weight > s.near and s.value is None:  # many rows at one value: part them by their ties
                s.low, s.high, s.before, s.value = 0.0, _TIES, bin_.before, bin_.low
            else:
                nearer = s.target - bin_.before < bin_.before + bin_.weight - s.target
                edge = bin_.prior if nearer and bin_.prior is not None else bin_.high
                done[number] = (s.dim, edge, _TIES) if s.value is None else (s.dim, s.value, edge)
                del searches[number]
    return done | {i: (s.dim, s.high, _TIES) if s.value is None else (s.dim, s.value, s.high) for i, s in searches.items()}


def _crossing(held: DataFrame, searches: dict[int, _Search], nodes: int, dims: int, weight: str) -> dict:
    """For each search, the bin in which the weight passes the target: low, high, before, weight, and the value before."""
    def per(f, none):
        return _of([f(searches[i]) if i in searches else none for i in range(nodes)])

    point = F.get("point_", per(lambda s: s.dim if s.value is None else dims, 0))
    low, high = per(lambda s: float(s.low), 1.0), per(lambda s: float(s.high), 0.0)  # none is inside where none is sought
    tied = per(lambda s: s.value is not None, False)
    inside = point.between(low, high) & (~tied | (F.get("point_", per(lambda s: s.dim, 0)) == per(lambda s: s.value or 0.0, 0.0)))
    place = F.floor((point - low) * per(lambda s: BINS / (s.high - s.low) if s.high > s.low else 0.0, 0.0))
    bins = held.where(inside).groupBy("node_", place.alias("bin")).agg(
        F.sum(weight).cast("double").alias("weight"), F.min(point).alias("low"), F.max(point).alias("high"))
    order = Window.partitionBy("node_").orderBy("bin")  # at most BINS + 1 rows
    upto = F.sum("weight").over(order.rowsBetween(Window.unboundedPreceding, 0)) + per(lambda s: s.before, 0.0)
    bins = bins.withColumns({"upto": upto, "prior": F.lag("high").over(order)}).withColumn("before", F.col("upto") - F.col("weight"))
    target = per(lambda s: s.target, 0.0)
    return {r.node_: r for r in bins.where((F.col("upto") >= target) & (F.col("before") < target)).collect()}


def shard_documents(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id_col``, size, text_crc32, lines, shard, slot.

    ``size`` is the text's UTF-8 bytes plus 16, ``text_crc32`` is of these bytes; a null text has none. Shards are near
    equal in the sum of sizes, and rows of equal texts share one; a text whose copies outweigh a shard has it to itself.
    The dimensions are size, number of lines and checksum. ``slot`` counts a shard's rows from 0 without gaps. Ids may be
    null or repeat. An empty table gives no rows. Other columns are not read.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    # the number of the part is stored with the rows: it stays the same however often they are read
    rows = docs.select(
        F.col(id_col).alias("id_"), (F.octet_length(text) + 16).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        (F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit("")))).cast("bigint").alias("lines"),
        F.xxhash64(text).alias("group"), F.spark_partition_id().alias("part"))
    placed = kd_shards(materialise(rows, "sharding-rows"), ["size", "lines", "text_crc32"], shards)
    # ranked within the part of the input that a row was read from; parts are bounded, shards are not
    within = Window.partitionBy("shard", "part").orderBy("id_", "group")
    ranked = placed.withColumn("at", F.row_number().over(within))
    earlier = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("shard", "part").agg(F.count("*").alias("n"))
    begins = counts.select("shard", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("begin"))
    return ranked.join(begins, ["shard", "part"]).select(
        F.col("id_").alias(id_col), "size", "text_crc32", "lines", "shard",
        (F.col("begin") + F.col("at") - 1).alias("slot"))
