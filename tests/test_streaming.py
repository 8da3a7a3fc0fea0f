"""Streaming ingest, restart, replay and the dead-letter monitor on folder topics."""

import json
from datetime import datetime

import pytest

from urbanflux import constants as K
from urbanflux import schemas
from urbanflux.plans.pipelines import set_up_calendar, start_streams
from urbanflux.plans.warehouse import Warehouse
from urbanflux.sources.streams import Topic
from urbanflux.streaming.ingest import TRAFFIC, IngestJob, checked_readings
from urbanflux.streaming.monitor import (
    alert_lines,
    counts_by_reason,
    letter_counts,
    letters_of,
    start_monitor,
)

JAN = datetime(2026, 1, 1)


def reading(sensor="SNS-001", speed=30.0, ts="2026-07-17T10:34:02", **extra):
    return json.dumps({
        "sensor_id": sensor, "speed": speed, "vehicle_volume": 3, "occupancy": 0.1,
        "congestion_index": 0.4, "timestamp": ts, **extra,
    })


def ping(vehicle="VH-001", latitude=40.0, ts="2026-07-17T10:34:02"):
    return json.dumps({"vehicle_id": vehicle, "route_id": None, "latitude": latitude,
                       "longitude": -73.0, "speed": 10.0, "timestamp": ts})


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


@pytest.fixture
def wh(spark, folder):
    warehouse = Warehouse(spark, f"{folder}/wh")
    sensors = [(5, "SNS-001", "Here", 1.0, 2.0, "ACTIVE", JAN, None, True, JAN)]
    vehicles = [(8, "VH-001", "p", "BUS", "op", "R", "IN_SERVICE", JAN, None, True, JAN)]
    warehouse.dimension("dim_sensors").commit(spark.createDataFrame(sensors, schemas.DIM_SENSORS))
    warehouse.dimension("dim_vehicles").commit(
        spark.createDataFrame(vehicles, schemas.DIM_VEHICLES)
    )
    set_up_calendar(warehouse, "2026-07-01", "2026-07-31")
    return warehouse


@pytest.fixture
def topics(folder):
    return [Topic(n, "text", f"{folder}/{n}")
            for n in (K.TRAFFIC_TOPIC, K.GPS_TOPIC, K.DEAD_LETTER_TOPIC)]


def run(wh, topics, folder, stream_id="s1", **options):
    for query in start_streams(wh, *topics, f"{folder}/progress", stream_id,
                               available_now=True, **options):
        query.awaitTermination()


def test_both_feeds_to_facts_and_dead_letters(spark, wh, topics, folder):
    traffic, gps, dead = topics
    traffic.publish(
        texts(spark, reading(), reading(speed=-1.0), "junk", reading("SNS-404"),
              reading(ts="2026-07-18T00:07:00")), "1")
    gps.publish(texts(spark, ping(), ping(latitude=999.9)), "1")
    run(wh, topics, folder)

    facts = wh.fact("fact_traffic_readings")
    rows = facts.orderBy("date_key").collect()
    assert [(r["sensor_key"], r["date_key"], r["time_key"], r["speed"], r["record_timestamp"])
            for r in rows] == [
        (5, 20260717, 1034, 30.0, datetime(2026, 7, 17, 10, 34, 2)),
        (5, 20260718, 7, 30.0, datetime(2026, 7, 18, 0, 7)),
    ]
    pruned = facts.filter("date_key = 20260718")
    assert pruned.count() == 1
    pings = wh.fact("fact_gps_pings").collect()
    assert [(r["vehicle_key"], r["latitude"]) for r in pings] == [(8, 40.0)]

    letters = {(r["payload"][:4], r["validation_error"], r["source_topic"])
               for r in wh.dead_letter_queue().collect()}
    assert letters == {
        ("junk", "Malformed payload", K.TRAFFIC_TOPIC),
        ('{"se', "Speed cannot be negative", K.TRAFFIC_TOPIC),
        ('{"se', "Unknown sensor_id", K.TRAFFIC_TOPIC),
        ('{"ve', "Latitude out of bounds", K.GPS_TOPIC),
    }

    # restart with the same checkpoint: only what is new is read, dimensions are read anew
    newer = (9, "SNS-404", "There", 1.0, 2.0, "ACTIVE", JAN, None, True, JAN)
    table = wh.dimension("dim_sensors")
    table.commit(table.current(spark).union(spark.createDataFrame([newer], schemas.DIM_SENSORS)))
    traffic.publish(texts(spark, reading("SNS-404", 44.0)), "2")
    run(wh, topics, folder)
    assert sorted((r["sensor_key"], r["speed"]) for r in facts_of(wh)) == [
        (5, 30.0), (5, 30.0), (9, 44.0),
    ]

    # monitor: one alert per letter, counts per reason
    monitor = start_monitor(dead.read(spark, "earliest"), f"{folder}/alerts", f"{folder}/seen",
                            f"{folder}/progress-monitor", available_now=True)
    monitor.awaitTermination()
    alerts = [r["value"] for r in spark.read.text(f"{folder}/alerts").collect()]
    assert len(alerts) == 4
    assert all(a.startswith("CRITICAL INVALID PAYLOAD RECEIVED in DLQ: {") for a in alerts)
    counts = {(r["validation_error"], r["letters"])
              for r in letter_counts(spark, f"{folder}/seen").collect()}
    assert counts == {(error, 1) for _, error, _ in letters}


def facts_of(wh):
    return wh.fact("fact_traffic_readings").collect()


def test_a_replayed_batch_replaces_all_of_its_rows(spark, wh, folder):
    job = IngestJob(TRAFFIC, "s", lambda: wh.current_dimension("dim_sensors"),
                    wh.fact_path("fact_traffic_readings"), wh.dead_letter_path)
    job.process(texts(spark, reading(), reading(ts="2026-07-18T00:00:00"), "junk"), 0)
    job.process(texts(spark, reading(speed=1.0)), 1)
    assert len(facts_of(wh)) == 3 and wh.dead_letter_queue().count() == 1
    job.process(texts(spark, reading(), reading(ts="2026-07-18T00:00:00"), "junk"), 0)
    assert len(facts_of(wh)) == 3 and wh.dead_letter_queue().count() == 1
    job.process(texts(spark, reading()), 0)  # a replay that no longer yields the second day
    assert sorted((r["date_key"], r["speed"]) for r in facts_of(wh)) == [
        (20260717, 1.0), (20260717, 30.0),
    ]
    job.process(texts(spark), 2)
    assert len(facts_of(wh)) == 2
    job.process(texts(spark, *[reading()] * 50).repartition(5), 3)
    keys = [r["reading_id"] for r in facts_of(wh)]
    assert len(keys) == len(set(keys)) == 52


def test_another_checkpoint_keeps_what_is_stored(spark, wh, topics, folder):
    traffic, gps, _ = topics
    traffic.publish(texts(spark, reading(), reading(speed=31.0)), "1")
    gps.publish(texts(spark, ping()), "1")
    for progress in ("lost", "new"):
        for query in start_streams(wh, traffic, gps, None, f"{folder}/{progress}", "s1", True):
            query.awaitTermination()
    rows = facts_of(wh)
    assert len(rows) == 4 and len({r["stream_id"] for r in rows}) == 2
    assert len({r["reading_id"] for r in rows}) == 4


def test_ids_run_out_loudly(wh):
    job = IngestJob(TRAFFIC, "s", lambda: None, "", "", stream_number=lambda stream: 512)
    with pytest.raises(ValueError):
        job.first_id("s", 0)
    assert IngestJob(TRAFFIC, "s", lambda: None, "", "").first_id("s", 1) == 1 << 30


@pytest.mark.parametrize("profile", ["strict", "job"])
def test_constraints_of_the_fact_table_hold_in_every_profile(spark, wh, topics, folder, profile):
    traffic, gps, _ = topics
    no_index = json.loads(reading())
    del no_index["congestion_index"]
    traffic.publish(texts(spark, reading(), reading(ts="2030-01-01T00:00:00"), json.dumps(no_index),
                          reading(ts="2026-07-17T10:30:00+05:00")), "1")
    gps.publish(texts(spark, ping(ts="2026-08-01")), "1")
    run(wh, [traffic, gps, None], folder, profile=profile)
    assert sorted(r["time_key"] for r in facts_of(wh)) == [530, 1034]
    assert wh.fact("fact_gps_pings").count() == 0
    assert sorted(r["validation_error"] for r in wh.dead_letter_queue().collect()) == [
        "Missing required field: congestion_index", "Unknown date_key", "Unknown date_key",
    ]


def test_lenient_profile_drops_unknown_entities(spark, wh, topics, folder):
    traffic, gps, _ = topics
    no_index = json.loads(reading())
    del no_index["congestion_index"]
    traffic.publish(texts(spark, reading("SNS-404"), json.dumps(no_index), "junk"), "1")
    gps.publish(texts(spark, ping("VH-404")), "1")
    run(wh, [traffic, gps, None], folder, profile="job", on_unmatched="drop")
    assert facts_of(wh) == []
    assert sorted(r["validation_error"] for r in wh.dead_letter_queue().collect()) == [
        "Missing required field: congestion_index", K.TRAFFIC_JOB_REASON,
    ]
    assert wh.fact("fact_gps_pings").count() == 0


def test_unmatched_option_is_checked(spark, wh):
    with pytest.raises(ValueError):
        checked_readings(texts(spark, "x"), TRAFFIC, wh.current_dimension("dim_sensors"),
                         on_unmatched="ignore")


def test_kafka_options():
    topic = Topic(K.TRAFFIC_TOPIC, options={"kafka.bootstrap.servers": "broker:9092"})
    assert topic.read_options("latest") == {
        "subscribe": "traffic-sensors-topic", "startingOffsets": "latest",
        "kafka.bootstrap.servers": "broker:9092",
    }


def test_alerts_survive_undecodable_bytes(spark):
    value = bytearray(b'{"validation_error":"a\xff"}')
    messages = spark.createDataFrame([(value,)], "value binary")
    assert alert_lines(messages).first()["value"] == (
        'CRITICAL INVALID PAYLOAD RECEIVED in DLQ: {"validation_error":"a"}'
    )
    assert counts_by_reason(letters_of(messages)).first()["validation_error"] == "a"


def test_late_readings_get_the_version_of_their_own_time(spark, wh, topics, folder):
    traffic, gps, _ = topics
    cut = datetime(2026, 7, 10, 12)
    versions = [(5, "SNS-001", "Here", 1.0, 2.0, "ACTIVE", JAN, cut, False, JAN),
                (6, "SNS-001", "There", 1.0, 2.0, "ACTIVE", cut, None, True, JAN)]
    closed, current = (spark.createDataFrame([v], schemas.DIM_SENSORS) for v in versions)
    wh.dimension("dim_sensors").commit(current, closed)
    traffic.publish(texts(spark, reading(ts="2026-07-17T10:34:02", speed=1.0),
                          reading(ts="2026-07-10T11:59:59", speed=2.0),
                          reading(ts="2026-07-10T12:00:00", speed=3.0),
                          reading(ts="2025-12-31T23:59:59", speed=4.0), reading("SNS-404"), "junk"), "1")
    gps.publish(texts(spark, ping()), "1")
    run(wh, [traffic, gps, None], folder, as_of=True)
    assert {(r["speed"], r["sensor_key"]) for r in facts_of(wh)} == {(1.0, 6), (2.0, 5), (3.0, 6)}
    assert sorted(r["validation_error"] for r in wh.dead_letter_queue().collect()) == [
        "Malformed payload", "Unknown sensor_id", "Unknown sensor_id",
    ]


def monitored(spark, dead, folder, progress):
    start_monitor(dead.read(spark, "earliest"), f"{folder}/alerts", f"{folder}/seen",
                  f"{folder}/{progress}", available_now=True).awaitTermination()
    return {(r["source_topic"], r["validation_error"]): r["letters"]
            for r in letter_counts(spark, f"{folder}/seen").collect()}


def test_repeated_letters_and_a_lost_monitor_checkpoint_leave_the_counts(spark, wh, topics, folder):
    dead = topics[2]
    job = IngestJob(TRAFFIC, "s", lambda: wh.current_dimension("dim_sensors"),
                    wh.fact_path("fact_traffic_readings"), wh.dead_letter_path, dead)
    batch = texts(spark, "junk", "junk", "junk", reading(speed=-1.0), reading())
    job.process(batch, 0)
    expected = {(K.TRAFFIC_TOPIC, "Malformed payload"): 3, (K.TRAFFIC_TOPIC, "Speed cannot be negative"): 1}
    assert monitored(spark, dead, folder, "m1") == expected
    job.process(batch, 0)  # the ingest repeats its micro-batch; this topic keeps the first copy too
    dead.publish(spark.read.text(f"{dead.path}/s-0"), "copy")
    assert monitored(spark, dead, folder, "m1") == expected
    alerts = spark.read.text(f"{folder}/alerts").count()
    assert alerts == 4  # state dropped the copies before they raised an alert
    assert monitored(spark, dead, folder, "m2") == expected
    job.process(batch, 1)
    assert monitored(spark, dead, folder, "m2") == {k: 2 * n for k, n in expected.items()}


def test_letters_of_other_writers_all_count(spark, folder):
    dead = Topic(K.DEAD_LETTER_TOPIC, "text", f"{folder}/dead")
    dead.publish(texts(spark, *[json.dumps({"source_topic": "t", "validation_error": "e"})] * 3, "no json"), "1")
    assert monitored(spark, dead, folder, "m") == {("t", "e"): 3, (None, None): 1}
