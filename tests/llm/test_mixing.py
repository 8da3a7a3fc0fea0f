import hashlib
import random
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from urbanflux.llm import mixing, queries


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def shared(sizes, weights=(5, 2, 1), epochs=3):
    """Targets by repeated resharing."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > epochs * sizes[s]}
        if not over:
            return out | {s: level * weight[s] for s in open_}
        for s in over:
            out[s] = epochs * sizes[s]
            left -= out[s]
        open_ -= over
    return out


def rows_of(spec):
    return [(i, " ".join(["w"] * n), s) for i, (s, n) in enumerate(spec)]


@pytest.mark.parametrize(
    "spec",
    [
        [("a", 10), ("b", 400), ("c", 3000), (None, 7), ("b", 0), ("é", 1)],
        [("a", 5000)] * 9 + [("b", 3)],
        [("only", 17)],
        [("a", 0), ("b", 0)],
        [(f"s{i % 23}", (i * 37) % 900) for i in range(300)],
    ],
)
def test_targets_are_met_and_nothing_exceeds_three_times(spark, spec):
    df = table(spark, rows_of(spec))
    found = mixing.mix(df, block_words=64).collect()
    assert len(found) == len(spec)
    sizes, taken = defaultdict(int), defaultdict(int)
    for s, n in spec:
        sizes[s] += n
    want = shared(sizes)
    for r in found:
        assert r["size"] == len((r["text"] or "").split())
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 0.5 + 1e-6


def test_schedule_is_even_and_complete(spark):
    plan = spark.createDataFrame([("a", 64_000.0), ("b", 32_000.0), ("c", 700.0), ("d", 0.0)], "source_key string, target double")
    slots = sorted(map(tuple, mixing.schedule(plan, 100).collect()))
    count, ranks = defaultdict(int), defaultdict(list)
    for i, (_, source, rank) in enumerate(slots, 1):
        count[source] += 1
        ranks[source].append(rank)
        if 20 < i < 900:  # every stretch of the schedule has the shares of the whole
            assert abs(count["a"] - i * 64_000 / 96_700) < 6
    assert count == {"a": 640, "b": 320, "c": 7}
    assert all(sorted(r) == list(range(len(r))) for r in ranks.values())


def test_chunks_and_ranks_agree_for_small_chunks(spark, monkeypatch):
    monkeypatch.setattr(mixing, "CHUNK", 16)
    plan = spark.createDataFrame([("a", 5_000.0), ("b", 1_000.0)], "source_key string, target double")
    slots = mixing.schedule(plan, 10).collect()
    assert sorted(r["rank"] for r in slots if r["source_key"] == "a") == list(range(500))


def test_query_equals_its_sql_with_nulls_and_repeats(spark, folder):
    rows = rows_of([("a", 30), ("a", 30), (None, 5), ("b", 0), ("c", 2000)]) + [(9, None, "b"), (None, "x y", "a"), (1, "w " * 30, "a")]
    df = table(spark, rows).withColumn("lang", F.lit("en")).withColumn("size", F.lit("clash"))
    df.write.parquet(f"{folder}/documents.parquet")
    found = queries.op10_mixing(spark, folder).collect()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    want = con.execute(queries.ORACLE["op10_mixing"]).fetchall()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, want))
    assert sorted(map(tuple, queries.op10_mixing(spark, folder).collect()), key=repr) == sorted(map(tuple, found), key=repr)


def test_empty_table_and_clashing_columns(spark):
    df = table(spark, [(1, "a b c", "s")]).withColumn("target", F.lit("old")).withColumn("taken", F.lit(True))
    assert mixing.mix(df).first()["taken"] == 3
    assert mixing.mix(df.limit(0)).collect() == []


def test_documents_without_ids_are_placed_by_size_and_not_in_one_task(spark, documents):
    rnd = random.Random(8)
    rows = [(None if rnd.random() < 0.9 else i, "w " * rnd.randrange(40), "en", f"s{i % 2}") for i in range(600)]
    df = documents(*rows)
    mixed = mixing.mix(df).collect()
    placed = sorted(
        (hashlib.md5(("null" if k is None else str(k)).encode()).hexdigest(), len((t or "").split()), s) for k, t, _, s in rows
    )
    goal = {r["source"]: round(r["target"]) for r in mixed}
    total = {r["source"]: r["source_size"] for r in mixed}
    starts, expected = dict.fromkeys(goal, 0), []
    for order, size, source in placed:
        start = starts[source]
        starts[source] += size
        taken = sum(max(0, min(start + e * total[source] + size, goal[source]) - (start + e * total[source])) for e in range(3))
        expected.append((source, size, taken))
    assert sorted((r["source"], r["size"], r["taken"]) for r in mixed) == sorted(expected)
    sized = df.withColumn("size", mixing.word_count(F.col("text"))).where("doc_id IS NULL")
    buckets = sized.select(mixing._bucket(F.col("doc_id"), F.md5(F.lit("null").cast("binary")), F.col("size")).alias("b"))
    assert buckets.distinct().count() >= 30
