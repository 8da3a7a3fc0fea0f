import math
from decimal import Decimal, localcontext

import numpy as np
from pyspark.sql import functions as F

from urbanflux.llm import neighbours
from urbanflux.llm.common import read
from urbanflux.llm.neighbours import Block, nearest_neighbours

SCHEMA = "vec_id long, embedding array<float>, label int"


def exact(rows, query, k):
    own = np.asarray(dict(rows)[query], np.float64)
    found = sorted((math.sqrt(float(np.square(np.asarray(v, np.float64) - own).sum())), i) for i, v in rows if i != query)
    return found[:k]


def recall(found, rows, queries, k=10):
    hit = total = 0
    for q in queries:
        want = exact(rows, q, k)
        got = [(r["score"], r["vec_id"]) for r in sorted((r for r in found if r["query_id"] == q), key=lambda r: r["rank"])]
        assert got == sorted(got) and len(got) == len(want)
        hit += len({i for _, i in got} & {i for _, i in want})
        total += len(want)
    return hit / total


def test_recall_on_the_given_vectors(spark):
    df = read(spark, "/root/testdata/sf0.01", "embeddings")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    found = nearest_neighbours(df, F.col("vec_id") % 20 == 0).collect()
    assert recall(found, rows, [i for i, _ in rows if i % 20 == 0]) >= 0.95


def test_recall_over_several_blocks_of_clustered_vectors(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 300)
    monkeypatch.setattr(neighbours, "BLOCK_QUERIES", 7)
    random = np.random.default_rng(1)
    centres = random.standard_normal((12, 16)) * 3
    rows = [(i, (centres[i % 12] + random.standard_normal(16) * 0.3).astype(np.float32).tolist()) for i in range(1200)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    found = nearest_neighbours(df, F.col("vec_id") % 40 == 0).collect()
    assert recall(found, rows, range(0, 1200, 40)) >= 0.9


def test_counting_skips_far_vectors():
    random = np.random.default_rng(3)
    near, far = random.standard_normal((200, 8)) * 0.05, random.standard_normal((2000, 8)) + 30
    block = Block(np.arange(2200), np.concatenate([near, far]))
    seen = []
    square = np.square
    try:
        np.square = lambda x: seen.append(len(x)) or square(x)
        best = block.nearest(0, near[0], 10)
    finally:
        np.square = square
    assert len(best) == 10 and all(i < 200 for _, i in best) and sum(seen) <= 200


def test_ties_repeats_and_unusable_vectors(spark):
    odd = [(5, None), (6, []), (7, [0.0, 0.0]), (8, [1.0, None]), (9, [float("nan"), 1.0]), (11, [float("inf"), 1.0]), (None, [1.0, 1.0])]
    good = [(0, [1.0, 0.0]), (3, [1.0, 0.0]), (2, [1.0, 0.0]), (1, [0.0, 1.0]), (1, [0.0, 1.0]), (4, [1.0, 1.0, 1.0])]
    df = spark.createDataFrame([(i, v, 1) for i, v in odd + good], SCHEMA).withColumn("score", F.lit("clash")).withColumn("id", F.lit(0))
    found = nearest_neighbours(df, F.col("vec_id") % 100 == 0).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in sorted(found, key=lambda r: r["rank"])] == [
        (0, 1, 2, 0.0),
        (0, 2, 3, 0.0),
        (0, 3, 1, math.sqrt(2)),
    ]
    assert nearest_neighbours(df.limit(0), F.col("vec_id") % 100 == 0).collect() == []


def exactly(a, b):
    """Distance by decimals of any size."""
    with localcontext() as context:
        context.prec, context.Emin, context.Emax = 60, -9_999, 9_999
        return float(sum((Decimal(x) - Decimal(y)) ** 2 for x, y in zip(a, b, strict=True)).sqrt())


def test_vectors_near_the_ends_of_the_double_range(spark):
    random = np.random.default_rng(5)
    for scale in (1.5e307, 1e300, 1e-300, 1e-320):
        rows = [(i, (random.standard_normal(4) / 8 * scale).tolist()) for i in range(50)]
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        found = nearest_neighbours(df, F.col("vec_id") == 0).collect()
        want = sorted((exactly(rows[0][1], v), i) for i, v in rows[1:])[:10]
        assert [r["vec_id"] for r in sorted(found, key=lambda r: r["rank"])] == [i for _, i in want]
        assert all(abs(r["score"] - want[r["rank"] - 1][0]) <= 1e-12 * want[9][0] + 5e-324 for r in found)


def test_queries_far_beyond_all_others(spark):
    rows = [(0, [1e308, -1e308]), *((i, [float(i), 1e-5]) for i in range(1, 30))]
    found = nearest_neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") == 0).collect()
    assert len(found) == 10 and all(r["score"] == found[0]["score"] for r in found)
    block = Block(np.arange(1, 30), np.array([v for _, v in rows[1:]]))
    assert [i for _, i in block.nearest(0, np.array(rows[0][1]), 10)] == list(range(1, 11))
