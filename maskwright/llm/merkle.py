"""A Merkle manifest of a dataset: one digest for all rows, and for each row the proof that it belongs to it.

Rows are the leaves. Within a group they stand in order, and runs of ``fanout`` consecutive nodes become one node, level
by level, until one is left: the group's subroot. Subroots in the order of their groups become the root in the same way.

Levels are climbed as slot pivots. A node's position gives its parent and its slot there; conditional aggregates per
parent spread the children into one column for each slot. These columns, concatenated and hashed, are the parent;
without the node's own slot they are its siblings, those before it and those behind. Several levels are climbed after
one exchange: it is by block, the ancestor that many levels up, and runs within a block need no other. Blocks then are
the nodes of the next round, so a round has the ``BLOCK``-th part of the rows of the one before, and no group of rows
that meet in one task is larger than a block, however large the groups of the manifest are.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from maskwright.session import materialise

BLOCK = 256  # nodes of a block at most, or one run of a larger fanout
SIBLINGS = "array<struct<before:string,behind:string>>"
RESULTS = ("position", "subroot", "root", "siblings")


def sha256(*texts: Column) -> Column:
    """Lower-case hex digest of the concatenated texts as UTF-8."""
    return F.sha2(F.concat(*texts), 256)


def encoded(value: Column) -> Column:
    """A value so that no other row of values reads the same: ``-`` for null, else its bytes as text are counted."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(*values: Column) -> Column:
    return sha256(*map(encoded, values))


def folded(leaf: Column, siblings: Column) -> Column:
    """The root that a leaf leads to with its siblings, which are null for no leaf only."""
    return F.aggregate(siblings, leaf, lambda node, run: sha256(run["before"], node, run["behind"]))


def proof_digest(siblings: Column) -> Column:
    """One digest of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.flatten(F.transform(siblings, lambda s: F.array(s["before"], s["behind"]))), ""), 256)


def _placed(rows: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Adds ``pos`` (from 0, in the group) and ``size`` (of the group), without one task for a group.

    Ranges of all rows are sorted and written, so that their numbers hold; a range's share of a group then needs
    only the counts of the ranges before it.
    """
    keys = [F.col("group"), *order, F.col("digest"), F.col("seq")]
    ranged = rows.withColumn("seq", F.monotonically_increasing_id()).repartitionByRange(*keys)
    table = materialise(ranged.sortWithinPartitions(*keys).drop("seq").withColumn("at", F.monotonically_increasing_id()),
                        "merkle-order")
    part = F.shiftright("at", 33)  # the upper bits number the range, the lower ones its rows
    shares = table.groupBy("group", part.alias("part")).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    group = Window.partitionBy("group")
    before = F.sum("n").over(group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    shares = shares.select(F.col("group").alias("of"), "part", "first", F.coalesce(before, F.lit(0)).alias("before"),
                           F.sum("n").over(group).alias("size"))
    same = F.col("group").eqNullSafe(F.col("of")) & (part == F.col("part"))
    return table.join(shares, same).select(
        *rows.columns, (F.col("at") - F.col("first") + F.col("before")).alias("pos"), "size")


def _climbed(nodes: DataFrame, fanout: int, levels: int) -> DataFrame:
    """Adds ``block`` (the position of the ancestor ``levels`` up), ``top`` (its digest) and ``path`` (siblings so far).

    A group that is down to one node stays as it is.
    """
    digits = [f"digit{j}" for j in range(levels)]
    at = {d: F.floor(F.col("pos") / F.lit(fanout ** j)) % F.lit(fanout) for j, d in enumerate(digits)}
    out = nodes.withColumns({"block": F.floor(F.col("pos") / F.lit(fanout ** levels)), "top": F.col("digest"), **at})
    out = out.repartition("group", "block")
    for j, digit in enumerate(digits):
        run = Window.partitionBy("group", "block", *reversed(digits[j + 1:]))
        slots = [f"slot{s}" for s in range(fanout)]
        out = out.withColumns({c: F.max(F.when(F.col(digit) == s, F.col("top"))).over(run) for s, c in enumerate(slots)})
        several = F.ceil(F.col("size") / F.lit(fanout ** j)) > 1
        beside = lambda side: F.concat(*[F.when(side(s), F.col(c)).otherwise("") for s, c in enumerate(slots)])
        held = [F.col(c).isNotNull() for c in slots]
        before = beside(lambda s: held[s] & (F.lit(s) < F.col(digit)))
        behind = beside(lambda s: held[s] & (F.lit(s) > F.col(digit)))
        out = out.withColumns({
            f"run{j}": F.when(several, F.struct(before.alias("before"), behind.alias("behind"))),
            "top": F.when(several, sha256(*[F.coalesce(F.col(c), F.lit("")) for c in slots])).otherwise(F.col("top")),
        }).drop(*slots)
    path = F.array_compact(F.array(*[F.col(f"run{j}") for j in range(levels)])).cast(SIBLINGS)
    return out.select(*nodes.columns, "block", "top", path.alias("path"))


def _proven(nodes: DataFrame, largest: int, fanout: int, finish: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Adds ``top`` (the digest that a node's group comes down to), ``root`` and ``path`` (the siblings on the way there).

    ``finish`` does so where each group has one node left.
    """
    if largest <= 1:
        return finish(nodes)
    levels = 1
    while fanout ** (levels + 1) <= BLOCK and fanout ** levels < largest:
        levels += 1
    width = fanout ** levels
    table = materialise(_climbed(nodes, fanout, levels), "merkle-level")
    blocks = table.groupBy("group", F.col("block").alias("pos")).agg(
        F.ceil(F.min("size") / F.lit(width)).alias("size"), F.min("top").alias("digest"))
    above = _proven(blocks, -(-largest // width), fanout, finish).select(
        F.col("group").alias("of"), F.col("pos").alias("of_pos"), F.col("top").alias("last"), "root",
        F.col("path").alias("rest"))
    same = F.col("group").eqNullSafe(F.col("of")) & (F.col("block") == F.col("of_pos"))
    return table.join(above, same).select(
        *nodes.columns, F.col("last").alias("top"), "root", F.concat("path", "rest").alias("path"))


def _tree(rows: DataFrame, order: Sequence[Column], fanout: int, finish: Callable[[DataFrame], DataFrame]) -> DataFrame:
    placed = _placed(rows, order)
    largest = placed.agg(F.max("size")).first()[0] or 0
    return _proven(placed, largest, fanout, finish)


def _itself(nodes: DataFrame) -> DataFrame:
    return nodes.withColumns({"top": F.col("digest"), "root": F.col("digest"), "path": F.array().cast(SIBLINGS)})


def _under_root(subroots: DataFrame, fanout: int) -> DataFrame:
    """What ``finish`` does for groups: they are the leaves of a tree of their own."""
    rows = subroots.select(F.struct("group").alias("row"), F.lit(0).alias("group"), "digest")
    above = _tree(rows, [F.col("row")["group"]], fanout, _itself).select(
        F.col("row")["group"].alias("name"), "root", "path")
    return subroots.withColumn("top", F.col("digest")).join(above, F.col("group").eqNullSafe(F.col("name"))).drop("name")


def manifest(rows: DataFrame, digest: str, group: str, order: Sequence[str], fanout: int = 2) -> DataFrame:
    """The rows with ``position`` (long, from 0, in the group), ``subroot``, ``root`` and ``siblings``.

    ``digest`` is the column of the leaf, never null; ``siblings`` holds, level by level up to the root, the run's
    other digests concatenated, those before a node and those behind. Leaves ascend by ``order`` in their group, nulls
    first, rows alike in it by their digest; rows alike in that too are interchangeable. Null is a group of its own, and
    the first. A lone leaf is its group's subroot, a lone subroot the root. No rows give no rows. Columns of ``rows``
    that are named like a result are replaced by it; all others are kept as they are.
    """
    if fanout < 2:
        raise ValueError("runs need two nodes or more")
    packed = rows.select(F.struct(*rows.columns).alias("row"), F.col(group).alias("group"), F.col(digest).alias("digest"))
    leaves = materialise(packed, "merkle-leaves")  # digests once, not again for the ranges' sample
    proven = _tree(leaves, [F.col("row")[c] for c in order], fanout, lambda tops: _under_root(tops, fanout))
    kept = [F.col("row")[c].alias(c) for c in rows.columns if c not in RESULTS]
    return proven.select(*kept, F.col("pos").alias("position"), F.col("top").alias("subroot"), "root",
                         F.col("path").alias("siblings"))
