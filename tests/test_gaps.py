"""Gaps between events from mergeable summaries, against pairing all events of an entity."""

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from conftest import SF

from urbanflux.operators.gaps import gap_summaries, label_gaps, stitched
from urbanflux.plans import derived
from urbanflux.plans.queries import QUERIES
from urbanflux.plans.views import Star, bus_punctuality, schedule_punctuality

T0 = datetime(2026, 1, 1)


def at(minutes):
    return None if minutes is None else T0 + timedelta(minutes=minutes)


def plain(rows):
    """``rows``: (entity, label, ts, order)."""
    by_entity = defaultdict(list)
    for entity, label, ts, order in rows:
        if entity is not None and ts is not None:
            by_entity[entity].append((ts, order, label))
    gaps, micros = defaultdict(int), defaultdict(int)
    for events in by_entity.values():
        events.sort(key=lambda e: (e[0], e[1]))
        for (ts, _, label), (following, _, _) in zip(events, events[1:], strict=False):
            gaps[label] += 1
            micros[label] += round((following - ts).total_seconds() * 10**6)
    return {(label, n, micros[label]) for label, n in gaps.items()}


def events(seed, interleaved):
    rnd = random.Random(seed)
    rows = []
    for bus in range(25):
        cut = rnd.randrange(60 * 24 * 3)
        for _ in range(rnd.choice([1, 2, 40, 300 if bus == 0 else 60])):
            minute = rnd.choice([rnd.randrange(60 * 24 * 3), rnd.randrange(90)])
            new = minute >= cut if not interleaved else rnd.random() < 0.5
            rows.append((f"bus{bus}", f"r{bus % 4 + 10 * new}", at(minute), len(rows)))
    return [*rows, ("bus1", "r1", None, 10**6), (None, "r1", at(3), 10**6 + 1)]


@pytest.mark.parametrize("interleaved", [False, True])
@pytest.mark.parametrize("seconds", [600, 3600, 10**8])
def test_like_pairing_all_events(spark, interleaved, seconds):
    rows = events(seconds, interleaved)
    df = spark.createDataFrame(rows, "bus string, route string, ts timestamp_ntz, id long").repartition(5)
    found = label_gaps(df, "bus", "ts", ["route"], ["id"], slice_seconds=seconds)
    assert {tuple(r) for r in found.collect()} == plain(rows)


@pytest.mark.parametrize("interleaved", [False, True])
def test_labels_from_a_dimension(spark, interleaved):
    rows = events(7, interleaved)
    versions = sorted({(bus, route) for bus, route, _, _ in rows if bus})
    keys = {v: i for i, v in enumerate(versions)}
    pings = [(keys.get((bus, route)), ts, n) for bus, route, ts, n in rows] + [(999, at(1), 1)]
    df = spark.createDataFrame(pings, "k long, ts timestamp_ntz, id long")
    known = spark.createDataFrame([(i, *v) for v, i in keys.items()], "k long, bus string, route string")
    found = label_gaps(df, "bus", "ts", ["route"], ["id"], known, "k")
    assert {tuple(r) for r in found.collect()} == plain(rows)


def test_summaries_tell_overlaps(spark):
    rows = [("a", "x", at(0)), ("a", "x", at(9)), ("a", "y", at(9)), ("a", "y", at(70)), ("b", "x", at(1)), ("b", "y", at(2))]
    summaries = gap_summaries(spark.createDataFrame(rows, "e string, l string, ts timestamp_ntz"), ["e", "l"], "ts")
    got = {(r["e"], r["l"], r["n"], r["mixed"]) for r in stitched(summaries, "e", ["l"]).collect()}
    assert got == {("a", "x", 2, True), ("a", "y", 1, True), ("a", "y", 1, False), ("b", "x", 1, False), ("b", "y", 1, False)}


def test_null_labels_and_empty_tables(spark):
    rows = [("a", None, at(0)), ("a", None, at(5)), ("a", "x", at(6))]
    df = spark.createDataFrame(rows, "e string, l string, ts timestamp_ntz")
    assert [tuple(r) for r in label_gaps(df, "e", "ts", ["l"], []).collect()] == [(None, 2, 360 * 10**6)]
    assert label_gaps(df.limit(0), "e", "ts", ["l"], []).collect() == []


def test_pings_are_scanned_once_though_most_buses_change_route(spark):
    pings = derived.star(spark, SF, "fact_gps_pings").fact_gps_pings
    plan = gap_summaries(pings, ["vehicle_key"], "record_timestamp")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("events.parquet") == 1 and "partial_count" in plan
    rest = QUERIES["punctuality_view"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "events.parquet" not in rest  # only the written summaries


def star(spark, pings, versions):
    return Star(
        dim_vehicles=spark.createDataFrame(versions, "vehicle_key long, vehicle_id string, vehicle_type string, assigned_route_id string"),
        fact_gps_pings=spark.createDataFrame(pings, "ping_id long, vehicle_key long, record_timestamp timestamp_ntz"),
    )


def test_limits_follow_the_schedule_at_the_time(spark):
    pings = [(i, 1, at(10 * i)) for i in range(7)] + [(10 + i, 2, at(10 * i)) for i in range(3)]
    buses = star(spark, pings, [(1, "a", "BUS", "R1"), (2, "b", "BUS", "R2"), (3, "c", "TAXI", "R1")])
    schedules = [("R1", 30, T0, at(35)), ("R1", 5, at(35), at(55)), ("R9", 1, T0, None)]
    history = spark.createDataFrame(schedules, "route_id string, schedule_interval_minutes int, start_date timestamp_ntz, end_date timestamp_ntz")
    rows = {tuple(r) for r in schedule_punctuality(buses, history).collect()}
    assert rows == {
        ("R1", 30, 10.0, "Early/Clustered"), ("R1", 5, 10.0, "Delayed"), ("R2", None, 10.0, "On Schedule"),
    }
    assert {tuple(r) for r in bus_punctuality(buses).collect()} == {("R1", 10.0, "On Schedule"), ("R2", 10.0, "On Schedule")}
