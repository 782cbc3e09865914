import math
import random

from pyspark.sql import functions as F

from maskwright.llm import neighbours


def cosine(a, b):
    dot = x = y = 0.0
    a, b = ([math.ldexp(q, -math.frexp(max(map(abs, v)))[1]) for q in v] for v in (a, b))
    for p, q in zip(a, b):
        dot, x, y = dot + p * q, x + p * p, y + q * q
    return dot / (math.sqrt(x) * math.sqrt(y))


def plain(rows, k, queries):
    def good(v):
        return v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    rows = [(i, v) for i, v in rows if i is not None and good(v)]
    out = []
    for i, v in rows:
        if i in queries:
            near = sorted((-cosine(v, w), j) for j, w in rows if j != i and len(w) == len(v))[:k]
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(near)]
    return sorted(out)


def test_against_all_pairs(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(i, [float(rng.randint(-9, 9)) for _ in range(16)]) for i in range(600)]
    rows += [(600 + i, [2 * x for x in rows[i][1]]) for i in range(40)]  # ties
    rows += [(700, None), (701, []), (702, [0.0] * 16), (703, [float("nan")] + [1.0] * 15), (704, [None] + [1.0] * 15),
             (705, [float("inf")] * 16), (706, [1e300] * 16), (707, [1e-300] * 16), (None, [1.0] * 16), (708, [1.0, 2.0]),
             (709, [2.0, 1.0]), (710, [1.0, 3.0]), (5, rows[5][1])]
    monkeypatch.setattr(neighbours, "BLOCK_BYTES", 9 * 16 * 50)  # many tiles
    monkeypatch.setattr(neighbours, "QUERY_BYTES", 9 * 16 * 20)
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows],
                               "vec_id bigint, embedding array<double>, ids int, rows string").repartition(4)
    asked = set(range(0, 720, 25)) | {600, 708}
    found = neighbours.nearest(df, df.where(F.col("vec_id").isin(sorted(asked))))
    got = sorted(tuple(r) for r in found.collect())
    want = plain(rows, 5, asked)
    assert got == want and len(got) > 100


def test_few_and_none(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "vec_id bigint, embedding array<float>")
    assert [tuple(r) for r in neighbours.nearest(df, df.where("vec_id = 1")).collect()] == [(1, 1, 2, 0.0)]
    assert neighbours.nearest(df.limit(0), df.limit(0)).count() == 0
    assert neighbours.nearest(df, df.limit(0)).count() == 0
