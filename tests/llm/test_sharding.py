from collections import Counter, defaultdict
import random
import zlib

from maskwright.llm import sharding


def check(rows, placed, shards, slack):
    assert Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows) == Counter(
        (r.doc_id, r.size, r.text_crc32) for r in placed)
    slots, sizes, groups = defaultdict(list), Counter(), defaultdict(set)
    for r in placed:
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r.size
        groups[r.size, r.text_crc32].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in groups.values())
    assert set(slots) <= set(range(shards))
    return sizes


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    sizes = check(rows, sharding.shard_documents(docs, 40).collect(), 40, 0)
    mean = sum(sizes.values()) / 40
    largest = max(Counter(r.text for r in docs.collect()).items(), key=lambda x: x[1] * (len((x[0] or "").encode()) + 16))
    group = largest[1] * (len(largest[0].encode()) + 16)
    assert len(sizes) == 40 and max(abs(s - mean) for s in sizes.values()) < min(group, 0.05 * mean)


def test_long_texts_do_not_make_shards_uneven(spark):
    rng = random.Random(4)
    rows = [(i, str(i) + "x" * int(rng.paretovariate(0.9) * 40)) for i in range(1500)]
    rows = [(i, t[:9000]) for i, t in rows]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    sizes = check(rows, sharding.shard_documents(df, 12).collect(), 12, 0)
    mean = sum(sizes.values()) / 12
    assert len(sizes) == 12 and max(abs(s - mean) for s in sizes.values()) < 0.01 * mean


def test_steps_narrow_the_gap():
    assert sharding._step([(3, 1), (5, 2), (9, 3)], [], 10) == ((5, 2), None)
    assert sharding._step([(9, 3)], [(4, 7), (6, 8)], 10) == ((9, 3), (4, 7))
    assert sharding._step([(11, 3)], [], 10) is None


def test_equal_sizes_and_a_group_of_a_third(spark):
    rows = [(i, f"{i:06d} abcdef") for i in range(4000)] + [(None, "the same text")] * 2000 + [(5, None), (6, ""), (6, "")]
    df = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in rows],
                               "doc_id bigint, text string, size int, shard string, part int").repartition(5)
    sizes = check(rows, sharding.shard_documents(df, 12).collect(), 12, 0)
    rest = sorted(sizes.values())[:-1]
    assert max(sizes.values()) == 2000 * 29 and len(sizes) == 12
    assert max(rest) - min(rest) <= 0.02 * max(rest)  # all of one size: ties alone part them


def test_few_rows(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id bigint, text string")
    check([(1, "a"), (2, "b")], sharding.shard_documents(df, 40).collect(), 40, 0)
    assert sharding.shard_documents(df.limit(0), 40).count() == 0
    assert [r.shard for r in sharding.shard_documents(df, 1).collect()] == [0, 0]
