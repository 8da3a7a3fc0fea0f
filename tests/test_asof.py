"""Versions valid at a row's own time, against a plain search."""

import random
from datetime import datetime, timedelta

import pytest

from urbanflux.operators.asof import attach_as_of

T0 = datetime(2026, 1, 1)
VERSIONS = "k string, start_date timestamp_ntz, end_date timestamp_ntz, v long"


def at(hours):
    return None if hours is None else T0 + timedelta(hours=hours)


def plain(versions, k, ts):
    begun = [v for v in versions if v[0] == k and k is not None and v[1] <= ts and (v[2] is None or v[2] > v[1])] if ts else []
    if not begun:
        return None
    last = max(begun, key=lambda v: v[1])
    return last[3] if last[2] is None or ts < last[2] else None


def test_like_a_plain_search_with_a_hot_key(spark):
    rnd = random.Random(4)
    versions, number = [], 0
    for k in ["hot", *"abcdefgh"]:
        hour = rnd.randrange(48)
        for _ in range(rnd.randrange(1, 9)):
            length = rnd.choice([1, 5, 24, 24, 100])
            number += 1
            versions.append((k, at(hour), at(hour + length), number))
            hour += length + rnd.choice([0, 0, 0, 30])  # mostly adjacent, sometimes a gap
        number += 1
        versions.append((k, at(hour), None, number))
    keys = ["hot"] * 12 + [*"abcdefgh", "unknown", None]
    rows = [(i, rnd.choice(keys), at(rnd.choice([rnd.randrange(600), None]))) for i in range(900)]
    rows += [(1000 + i, v[0], t) for i, v in enumerate(versions) for t in (v[1], v[2]) if t]  # boundaries
    df = spark.createDataFrame(rows, "id long, k string, ts timestamp_ntz").repartition(6)
    table = spark.createDataFrame(versions, VERSIONS)
    for seconds in (3600, 86_400, 10**9):
        found = attach_as_of(df, table, "k", "ts", ["v"], slice_seconds=seconds).collect()
        assert len(found) == len(rows)
        got = sorted((r["id"], r["ts"], r["v"]) for r in found if r["ts"])
        assert got == sorted((i, t, plain(versions, k, t)) for i, k, t in rows if t)
        assert all(r["v"] is None for r in found if r["ts"] is None)


def test_gaps_ends_and_useless_versions(spark):
    versions = [("a", at(0), at(10), 1), ("a", at(20), None, 2), ("a", at(5), at(5), 3), ("b", None, None, 4), (None, at(0), None, 5)]
    rows = [("a", at(h)) for h in (-1, 0, 5, 9, 10, 19, 20, 10**5)] + [("b", at(3)), (None, at(3)), ("a", None)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz")
    table = spark.createDataFrame(versions, VERSIONS)
    found = [(r["k"], r["ts"], r["v"]) for r in attach_as_of(df, table, "k", "ts", ["v"]).collect()]
    expected = [None, 1, 1, 1, None, None, 2, 2, None, None, None]
    assert sorted(found, key=str) == sorted([(k, t, v) for (k, t), v in zip(rows, expected, strict=True)], key=str)
    inner = attach_as_of(df, table, "k", "ts", ["v"], how="inner").collect()
    assert sorted(r["v"] for r in inner) == [1, 1, 1, 2, 2]
    with pytest.raises(ValueError):
        attach_as_of(df, table, "k", "ts", ["v"], how="outer")


def test_a_column_of_the_same_name_is_replaced_and_empty_tables(spark):
    df = spark.createDataFrame([("a", at(1), 99)], "k string, ts timestamp_ntz, v long")
    table = spark.createDataFrame([("a", at(0), None, 1)], VERSIONS)
    assert [tuple(r) for r in attach_as_of(df, table, "k", "ts", ["v"]).collect()] == [("a", at(1), 1)]
    assert attach_as_of(df, table.limit(0), "k", "ts", ["v"]).first()["v"] is None
    assert attach_as_of(df.limit(0), table, "k", "ts", ["v"]).collect() == []


def test_rows_meet_versions_by_equality(spark):
    df = spark.createDataFrame([("a", at(1))], "k string, ts timestamp_ntz")
    table = spark.createDataFrame([("a", at(0), None, 1)], VERSIONS)
    plan = attach_as_of(df, table, "k", "ts", ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
