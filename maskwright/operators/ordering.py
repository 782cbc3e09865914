"""Seeded order, exact ranks, train/eval splits, shards, batches and epochs.

A plain ``row_number`` over a whole dataset runs in one task. Here rows are ordered by a seeded
md5 of their key, so a hash prefix cuts them into even buckets whatever the data look like:
count rows per bucket, cumulate the counts on that small table, and rank only inside a bucket.
The result equals the window form. The number of buckets follows the shuffle partitions, not the data.

Keys must identify rows (an image path, an id); pass several columns where one is not enough. Ranks
of rows that share a key would be arbitrary, so such input fails instead of being ranked.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window, functions as F, types as T

from maskwright.session import materialise

PREFIX = 3  # hex digits looked at per pass of the cut search: 4,096 counts
HASH_DIGITS = 32
TASK_BYTES = 256 << 20  # of records that one task ranks and writes, where their size is known
MAX_BOUNDS = 1 << 19  # rows of bounds between tasks that go to every task, so that wide rows need not be joined
MAX_TASKS = 1 << 11  # beyond it, a task takes several small groups of shards,
TASK_RECORDS = 1 << 9  # up to so many records
PLAN_BLOCK = 1 << 16  # shard numbers made in one row
SPLITS = ("train", "val")


def check_split(name: str, known: Sequence[str] = SPLITS) -> str:
    if name not in known:
        raise ValueError(f"no split is called {name!r}: choose one of {', '.join(known)}")
    return name


def order_hash(seed: int, *keys: str) -> Column:
    """Reproducible shuffle key. Equal on any engine with md5."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))


def bucket_digits(spark: SparkSession) -> int:
    """Hex digits that make a bucket: 4,096 buckets, or 32 for each shuffle partition if that is more."""
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return next(d for d in range(3, 8) if 32 * partitions <= 16**d or d == 7)


def hash_bucket(hashed: Column, digits: int) -> Column:
    return F.conv(F.substring(hashed, 1, digits), 16, 10).cast("int")


def hash_fraction(seed: int, *keys: str) -> Column:
    """The first 32 bits of the order hash, as a number in 0..1."""
    return F.conv(F.substring(order_hash(seed, *keys), 1, 8), 16, 10).cast("bigint") / F.lit(float(1 << 32))


def seeded_shuffle(df: DataFrame, keys: Sequence[str], seed: int) -> DataFrame:
    """All rows in seeded random order (a range-partitioned sort, not one task)."""
    return df.withColumn("_h", order_hash(seed, *keys)).orderBy("_h", *keys).drop("_h")


def _hashed(df: DataFrame, keys: Sequence[str], seed: int) -> DataFrame:
    digits = bucket_digits(df.sparkSession)
    return df.withColumn("_h", order_hash(seed, *keys)).withColumn("_bucket", hash_bucket(F.col("_h"), digits))


def _bucket_table(hashed: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows per bucket, rows before the bucket, rows in all: a row per bucket and group."""
    counts = hashed.groupBy(*by, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(*by)
    before = whole.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(
        *by, "_bucket", "_n",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(whole).alias("_total"),
    )


def _next_place(order, *keys: str) -> Column:
    """0-based position in a window; two neighbours with the same key fail the job."""
    here = F.struct("_h", *keys)
    message = F.concat(F.lit("rows share the key "), F.to_json(F.struct(*keys)), F.lit(": add columns to the keys"))
    return F.when(F.lag(here).over(order) == here, F.raise_error(message).cast("int")).otherwise(
        F.row_number().over(order) - 1)


def _offset(by: Sequence[str], name: str = "_before") -> Column:
    """Rows before the bucket. Only a null group finds no bucket, and fails."""
    return F.coalesce(F.col(name), F.raise_error(F.lit(f"null in {', '.join(by)}")).cast("bigint"))


def global_rank(df: DataFrame, keys: Sequence[str], seed: int, by: Sequence[str] = (),
                name: str = "rank") -> DataFrame:
    """Add the 0-based position of every row in seeded order, within each group of ``by``.

    ``by`` must not hold nulls. The ranking shuffles rows by bucket once; the table of bucket
    offsets is joined on the same columns, so the ranked rows stay where they are. (The join is a
    left join only to spare Spark a second hash per row; every bucket has its row in the table.)
    """
    hashed = _hashed(df, keys, seed)
    table = _bucket_table(hashed.select(*by, "_bucket"), by)
    inside = Window.partitionBy(*by, "_bucket").orderBy("_h", *keys)
    ranked = hashed.withColumn("_rn", _next_place(inside, *keys))
    return (
        ranked.join(table.select(*by, "_bucket", "_before"), [*by, "_bucket"], "left")
        .withColumn(name, _offset(by) + F.col("_rn"))
        .select(*df.columns, name)
    )


def sorted_rank(df: DataFrame, order: Sequence[str], name: str = "rank") -> DataFrame:
    """Add the 0-based position in the plain sort order of ``order`` (byte order for strings).

    One range-partitioned sort. Positions are local to a range, so the sorted rows are written
    to the shared folder first: the ranges must not be sampled anew between the two uses.
    """
    local = df.orderBy(*order).withColumn("_m", F.monotonically_increasing_id())
    kept = materialise(local, "sorted").withColumn("_part", F.shiftright("_m", 33))
    counts = kept.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    # one row per range of the sort
    return (
        kept.join(offsets, "_part")
        .withColumn(name, F.col("_before") + F.col("_m").bitwiseAND(F.lit((1 << 33) - 1)))
        .select(*df.columns, name)
    )


def find_cut(df: DataFrame, keys: Sequence[str], seed: int, place: Callable[[int], int]) -> tuple[Row | None, int]:
    """The hash and keys of the row at a position in seeded order, and the number of rows.

    ``place`` gives the position for a row count; the row is None when the position is at or beyond the end.

    A radix search over hash digits: count rows per 3-digit prefix, keep the prefix that holds the cut, go on
    with its next digits until one row is left. Every pass reads the key columns alone, sums before
    the shuffle and returns at most 4,096 counts, so copies of one key cost nothing extra.
    """
    narrow = df.select(order_hash(seed, *keys).alias("_h"), *keys)
    prefix, before, cut = "", 0, None
    while True:
        digits = F.substring("_h", len(prefix) + 1, PREFIX)
        inside = narrow.filter(F.startswith("_h", F.lit(prefix))) if prefix else narrow
        counts = sorted((r["d"], r["n"]) for r in
                        inside.groupBy(digits.alias("d")).agg(F.count(F.lit(1)).alias("n")).collect())
        if cut is None:
            total = sum(n for _, n in counts)
            cut = place(total)
            if cut >= total:
                return None, total
        for step, n in counts:
            if before + n > cut:
                break
            before += n
        prefix += step
        if n == 1 or len(prefix) >= HASH_DIGITS:
            break
    groups = narrow.filter(F.startswith("_h", F.lit(prefix))).groupBy("_h", *keys).agg(F.count(F.lit(1)).alias("_n"))
    for row in groups.orderBy("_h", *keys).collect():  # one row, but for keys whose whole hashes agree
        if before == cut:
            return row, total
        if before + row["_n"] > cut:
            break
        before += row["_n"]
    raise ValueError(f"rows that share the key {keys} lie on both sides of the cut: add columns that tell them apart")


def _before(df: DataFrame, keys: Sequence[str], seed: int, cut: Row) -> Column:
    """True for rows ahead of the cut row in seeded order."""
    kinds = {f.name: f.dataType for f in df.schema}
    here = F.struct(order_hash(seed, *keys).alias("_h"), *keys)
    at = F.struct(F.lit(cut["_h"]).alias("_h"), *[F.lit(cut[k]).cast(kinds[k]).alias(k) for k in keys])
    return here < at


def exact_split(df: DataFrame, keys: Sequence[str], fraction: float, seed: int,
                names: tuple[str, str] = SPLITS, index: DataFrame | None = None) -> DataFrame:
    """Add ``split``: exactly ``int(n * fraction)`` rows, the last in seeded order, go to the second name.

    The cut is found first (narrow passes over the keys); the split is then a comparison within
    each row, with no shuffle and no join, so filters on it and pruning below it keep working. A
    fraction that rounds to 0 rows leaves the second split empty. Give an ``index`` with the keys
    of the same rows where reading the keys of ``df`` itself is costly (decoded image files).
    """
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must lie in 0..1")
    first, second = names
    source = df if index is None else index
    cut, _ = find_cut(source, keys, seed, lambda total: total - int(total * fraction))
    if cut is None:
        return df.withColumn("split", F.lit(first))
    return df.withColumn("split", F.when(_before(df, keys, seed, cut), F.lit(first)).otherwise(F.lit(second)))


def bucket_split(df: DataFrame, keys: Sequence[str], fraction: float, seed: int,
                 names: tuple[str, str] = SPLITS) -> DataFrame:
    """Add ``split`` by hash threshold: no shuffle, sizes right only on average, stable as data grows."""
    first, second = names
    return df.withColumn(
        "split", F.when(hash_fraction(seed, *keys) < F.lit(float(fraction)), F.lit(second)).otherwise(F.lit(first)))


def shard_ids(df: DataFrame, keys: Sequence[str], size: int, seed: int, by: Sequence[str] = ("split",),
              name: str = "shard") -> DataFrame:
    """Add the shard (or batch) number: position in seeded order divided by ``size``."""
    ranked = global_rank(df, keys, seed, by, "_rank")
    return ranked.withColumn(name, F.floor(F.col("_rank") / F.lit(size)).cast("int")).drop("_rank")


def shard_plan(df: DataFrame, keys: Sequence[str], size: int, seed: int) -> DataFrame:
    """Shard number and record count per split. The last shard may be short.

    Counts follow from the split sizes alone, so no row is ranked. Numbers are made in blocks that spread over
    the tasks.
    """
    counts = df.groupBy("split").agg(F.count(F.lit(1)).alias("_n"))
    shards = F.ceil(F.col("_n") / F.lit(size))
    first = F.explode(F.sequence(F.lit(0).cast("bigint"), shards - 1, F.lit(PLAN_BLOCK).cast("bigint")))
    blocks = counts.select("split", "_n", first.alias("_first")).repartition("split", "_first")
    last = F.least(F.col("_first") + F.lit(PLAN_BLOCK), shards) - 1
    plan = blocks.select("split", "_n", F.explode(F.sequence("_first", last)).alias("shard")).withColumn(
        "shard", F.col("shard").cast("int"))
    return plan.select(
        "split", "shard",
        F.least(F.lit(size).cast("bigint"), F.col("_n") - F.col("shard") * F.lit(size)).alias("records"))


def shard_layout(df: DataFrame, keys: Sequence[str], size: int, seed: int, by: str = "split",
                 shards_per_task: int = 16, keep: Sequence[str] = (), index: DataFrame | None = None,
                 row_bytes: int | None = None, halves: Sequence[str] = ()) -> DataFrame:
    """Rows placed for a shard writer: add ``shard``, ``shard_size`` and ``position`` in the shard.

    Rows come out partitioned by ``_task`` (name it in ``keep`` to go on grouping without a shuffle).

    Wide rows are shuffled once. A narrow pass over (split, hash) finds the hashes at which
    groups of whole shards begin; rows find their group by comparing hashes, and each group is
    ranked and later written by one task, with one task per group whatever the session's number of
    shuffle partitions. A group holds ``size * shards_per_task`` records; with ``row_bytes``, the size of a record, as
    many whole shards as make 256 MB instead. Where that makes more than 2,048 groups, small neighbouring ones share a
    task, of 512 records at most. There may be any number of splits. An ``index`` with ``by`` and the keys
    of the same rows spares the narrow passes a costly ``df``.

    ``df`` may hold its rows in parts, each with some of the columns ``halves`` and null in the others: parts of one key
    go to the same task and become one row there, so that pairing wide rows costs no exchange of its own. Such input
    needs an ``index``, with each row once; a key whose parts leave one of ``halves`` null gives no row, and must not
    be in the index.
    """
    if halves and index is None:
        raise ValueError("rows in parts need an index")
    if row_bytes is not None:
        shards_per_task = max(1, TASK_BYTES // (size * row_bytes))
    step = size * shards_per_task
    source = df if index is None else index
    known = F.when(F.col(by).isNull(), F.raise_error(F.lit(f"null in {by}")).cast("bigint")).otherwise(
        F.ceil(F.col("n") / F.lit(step)))
    sizes = source.groupBy(by).agg(F.count(F.lit(1)).alias("n")).withColumn("_tasks", known)
    tasks, splits = sizes.agg(F.coalesce(F.sum("_tasks"), F.lit(0)), F.count(F.lit(1))).first()
    # every task costs the driver its result and figures, however few rows it has
    shared = 1 if row_bytes is not None else max(1, min(-(-tasks // MAX_TASKS), TASK_RECORDS // step))
    earlier = Window.orderBy(by).rowsBetween(Window.unboundedPreceding, -1)  # one row per split
    first_task = sizes.select(by, F.coalesce(F.sum("_tasks").over(earlier), F.lit(0)).alias("_first_task"))
    hashed = _hashed(df, keys, seed)
    narrow = _hashed(source.select(by, *keys), keys, seed)
    table = _bucket_table(narrow.select(by, "_bucket"), [by])
    table = table.withColumn("_base", F.ceil(F.col("_before") / F.lit(step)))
    has_cut = F.col("_base") * F.lit(step) < F.col("_before") + F.col("_n")
    inside = Window.partitionBy(by, "_bucket").orderBy("_h", *keys)
    cuts = (
        narrow.join(table.filter(has_cut), [by, "_bucket"])
        .withColumn("_rank", F.col("_before") + F.row_number().over(inside) - 1)
        .filter(F.col("_rank") % F.lit(step) == 0)
        .groupBy(by, "_bucket")
        .agg(F.sort_array(F.collect_list(F.struct("_h", *keys))).alias("_cuts"))
    )
    bounds = table.join(cuts, [by, "_bucket"], "left").join(first_task, by).select(
        by, "_bucket", "_base", "_total", "_first_task", F.coalesce("_cuts", F.array()).alias("_cuts"))
    # a row per bucket and split, a cut per task; larger tables are joined like any other
    small = splits * 16 ** bucket_digits(df.sparkSession) + tasks <= MAX_BOUNDS
    bounds = F.broadcast(bounds) if small else bounds
    here = F.struct("_h", *keys)
    group = F.col("_base") - 1 + F.size(F.filter("_cuts", lambda cut: cut <= here))
    placed = hashed.join(bounds, [by, "_bucket"], "left").withColumn("_group", group)
    number = F.floor((F.col("_first_task") + F.col("_group")) / F.lit(shared)).cast("int")
    placed = placed.withColumn("_task", number).repartitionById(max(1, -(-tasks // shared)), "_task")
    if halves:
        rest = [c for c in placed.columns if c not in ("_task", "_h", *keys, *halves)]
        whole = placed.groupBy("_task", "_h", *keys, *rest).agg(*[F.first(c, ignorenulls=True).alias(c) for c in halves])
        placed = whole.dropna("any", subset=list(halves))
    order = Window.partitionBy("_task", by, "_group").orderBy("_h", *keys)
    rank = F.col("_group") * F.lit(step) + _next_place(order, *keys)
    shard = F.floor(F.col("_rank") / F.lit(size)).cast("int")
    return (
        placed.withColumn("_rank", rank)
        .withColumn("shard", shard)
        .withColumn("shard_size", F.least(F.lit(size), F.col("_total") - F.col("shard") * F.lit(size)).cast("int"))
        .withColumn("position", (F.col("_rank") % F.lit(size)).cast("int"))
        .select(*df.columns, "shard", "shard_size", "position", *keep)
    )


def epochs(df: DataFrame, keys: Sequence[str], count: int, batch: int, seed: int,
           shuffle: bool = True) -> DataFrame:
    """Repeat the rows ``count`` times, each epoch in its own order, with ``epoch`` and ``batch_id``.

    An evaluation feed is not shuffled anew: with ``shuffle=False`` every epoch has the same order, which is found once.
    Only keys are ranked; other columns join the ranks at the end.
    """
    if count < 1 or batch < 1:
        raise ValueError("there must be one epoch and one row per batch at least")
    every = F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    narrow = df.select(*keys)
    if shuffle:
        ranked = shard_ids(narrow.withColumn("epoch", every), ["epoch", *keys], batch, seed, by=("epoch",), name="batch_id")
    else:
        ranked = shard_ids(narrow, keys, batch, seed, by=(), name="batch_id").withColumn("epoch", every)
    if set(df.columns) == set(keys):
        return ranked.select(*df.columns, "epoch", "batch_id")
    places = ranked.select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], "epoch", "batch_id")
    same = [F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)]
    return df.join(places, reduce(and_, same)).select(*df.columns, "epoch", "batch_id")


def buffered_shuffle(df: DataFrame, buffer: int, seed: int, part: str = "stream", position: str = "position") -> DataFrame:
    """Each partition's rows in the order in which they leave a buffer of ``buffer`` rows at random; no exchange.

    The buffer is filled, then every row that comes takes the place of one drawn at random, and what is left at the end
    leaves in random order. Adds the partition's number and the row's place in it. The same partitions give the same order.
    A partition holds the buffer and one Arrow batch.
    """
    if buffer < 1:
        raise ValueError("the buffer holds one row at least")
    kinds = T.StructType([*df.schema.fields, T.StructField(part, T.IntegerType()), T.StructField(position, T.LongType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, at = TaskContext.get().partitionId(), 0
        rng = np.random.default_rng([seed % (1 << 32), number])
        held: pa.Table | None = None

        def placed(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            nonlocal at
            out = rows.append_column(part, pa.array([number] * len(rows), pa.int32())).append_column(
                position, pa.array(np.arange(at, at + len(rows))))
            at += len(rows)
            yield from out.to_batches()

        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if held is None else pa.concat_tables([held, rows])
            slots = np.arange(min(buffer, len(rows)))
            coming = np.arange(len(slots), len(rows))
            leaving = np.empty(len(coming), np.int64)
            for i, slot in enumerate(rng.integers(0, buffer, len(coming)).tolist()):
                leaving[i], slots[slot] = slots[slot], coming[i]
            if len(leaving):
                yield from placed(rows.take(leaving))
            held = rows.take(slots).combine_chunks()
        if held is not None:
            yield from placed(held.take(rng.permutation(len(held))))

    return df.mapInArrow(run, kinds)


def step_feed(df: DataFrame, keys: Sequence[str], steps: int, batch: int, seed: int) -> DataFrame:
    """Exactly ``steps`` full batches: the first rows in seeded order, repeated when data run short.

    Long data are cut by hash before anything is ranked, so only the rows of the feed are shuffled.
    """
    if steps < 1 or batch < 1:
        raise ValueError("there must be one step and one row per batch at least")
    wanted = steps * batch
    cut, total = find_cut(df, keys, seed, lambda _: wanted)
    if total == 0:
        raise ValueError("cannot feed from an empty dataset")
    chosen = df if cut is None else df.filter(_before(df, keys, seed, cut))
    passes = -(-wanted // total)
    ranked = global_rank(chosen, keys, seed, name="_rank")
    repeated = ranked.withColumn("_pass", F.explode(F.sequence(F.lit(0), F.lit(passes - 1))))
    place = F.col("_pass") * F.lit(total) + F.col("_rank")
    return (
        repeated.withColumn("_place", place)
        .filter(F.col("_place") < F.lit(wanted))
        .withColumn("step", F.floor(F.col("_place") / F.lit(batch)).cast("int"))
        .withColumn("position", (F.col("_place") % F.lit(batch)).cast("int"))
        .select(*df.columns, "step", "position")
    )


def take(df: DataFrame, count: int, order: Sequence[str]) -> DataFrame:
    """The first rows in a stated order (a top-k plan, not a full sort)."""
    return df.orderBy(*order).limit(count)
