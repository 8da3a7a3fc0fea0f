"""Serving views and roll-ups on a small star schema with hand-computed results."""

from datetime import date, datetime, timedelta

import pytest

from urbanflux import schemas
from urbanflux.functions.keys import with_calendar_keys
from urbanflux.plans import kpis, views
from urbanflux.plans.views import Star
from urbanflux.sources.calendar import dim_date, dim_time

DAY = datetime(2026, 7, 17)  # a Friday


def facts(spark, rows, columns):
    return with_calendar_keys(spark.createDataFrame(rows, columns))


def calendar(spark):
    return {"dim_date": dim_date(spark, "2026-07-01", "2026-07-31"), "dim_time": dim_time(spark)}


def sensors(spark):
    opened = datetime(2026, 1, 1)
    return spark.createDataFrame(
        [(1, "S1", "Old name", 1.0, 2.0, "ACTIVE", opened, DAY, False, opened),
         (2, "S1", "New name", 1.0, 2.0, "ACTIVE", DAY, None, True, DAY)],
        schemas.DIM_SENSORS,
    )


READING = (
    "reading_id long, sensor_key long, speed double, vehicle_volume int, occupancy double,"
    " congestion_index double, record_timestamp timestamp_ntz"
)


def test_congestion_view_keeps_the_version_of_the_fact(spark):
    rows = [
        (1, 1, 10.0, 5, 0.1, 0.8, DAY.replace(hour=8, minute=5)),
        (2, 2, 20.0, 6, 0.2, None, DAY.replace(hour=23, minute=59)),
        (3, 2, 30.0, 7, 0.3, 0.5, datetime(2026, 8, 1)),  # day outside the calendar
        (4, 99, 30.0, 7, 0.3, 0.5, DAY),  # unknown sensor
    ]
    star = Star(dim_sensors=sensors(spark), fact_traffic_readings=facts(spark, rows, READING),
                **calendar(spark))
    result = views.congestion_analysis(star).orderBy("speed").collect()
    assert [tuple(r) for r in result] == [
        ("S1", "Old name", 1.0, 2.0, date(2026, 7, 17), 2026, "July", "Friday", False, 8, 5,
         10.0, 5, 0.1, 0.8, "Critical"),
        ("S1", "New name", 1.0, 2.0, date(2026, 7, 17), 2026, "July", "Friday", False, 23, 59,
         20.0, 6, 0.2, None, "Low"),
    ]
    by_location = kpis.congestion_by_location(views.congestion_analysis(star)).collect()
    assert sorted(map(tuple, by_location), key=str) == [
        ("New name", "Low", None), ("Old name", "Critical", 0.8),
    ]


def test_peak_hours(spark):
    hours = [6, 7, 9, 10, 16, 18, 19]
    rows = [(i, 1, float(h), h, 0.1, h / 100, DAY.replace(hour=h, minute=59))
            for i, h in enumerate(hours)]
    star = Star(fact_traffic_readings=facts(spark, rows, READING), **calendar(spark))
    result = {r["time_period"]: r for r in views.peak_hour_analysis(star).collect()}
    assert {k: (r["day_name"], r["avg_speed"], r["avg_volume"]) for k, r in result.items()} == {
        "AM Peak (07:00-09:00)": ("Friday", 8.0, 8.0),
        "PM Peak (16:00-18:00)": ("Friday", 17.0, 17.0),
        "Off-Peak": ("Friday", 35 / 3, 35 / 3),
    }
    profile = kpis.peak_profile(views.peak_hour_analysis(star)).collect()
    assert {r["time_period"]: r["avg_volume"] for r in profile}["Off-Peak"] == 35 / 3


VEHICLE = "vehicle_key long, vehicle_id string, vehicle_type string, assigned_route_id string"
PING = "ping_id long, vehicle_key long, speed double, record_timestamp timestamp_ntz"


def test_travel_times(spark):
    vehicles = spark.createDataFrame([(1, "V1", "BUS", "R1"), (2, "V2", "TAXI", None)], VEHICLE)
    rows = [(1, 1, 20.0, DAY), (2, 1, 40.0, DAY + timedelta(minutes=59)),
            (3, 1, 10.0, DAY + timedelta(hours=1)), (4, 2, 0.0, DAY)]
    star = Star(dim_vehicles=vehicles, fact_gps_pings=facts(spark, rows, PING), **calendar(spark))
    result = views.travel_time_trends(star).orderBy("vehicle_id", "hour").collect()
    assert [tuple(r) for r in result] == [
        ("V1", "BUS", "R1", DAY.date(), 0, 30.0, 2.0),
        ("V1", "BUS", "R1", DAY.date(), 1, 10.0, 6.0),
        ("V2", "TAXI", None, DAY.date(), 0, 0.0, 0.0),
    ]
    card = kpis.travel_time_cards(views.travel_time_trends(star)).first()
    assert tuple(card) == (pytest.approx(40 / 3), pytest.approx(8 / 3))


def test_hotspots(spark):
    rows = [("Accident", "CRITICAL", "X", 1.0, 2.0, DAY),
            ("Accident", "CRITICAL", "X", 1.0, 2.0, DAY + timedelta(minutes=30)),
            ("Event", "MINOR", "X", 1.0, 2.0, DAY)]
    incidents = facts(
        spark, rows,
        "incident_type string, severity string, location_name string, latitude double,"
        " longitude double, record_timestamp timestamp_ntz",
    )
    star = Star(fact_incident_reports=incidents, **calendar(spark))
    result = views.incident_hotspots(star).orderBy("incident_type").collect()
    assert [(r["incident_count"], r["hazard_score"]) for r in result] == [(2, 3), (1, 1)]
    spot = kpis.hotspot_map(views.incident_hotspots(star)).first()
    assert tuple(spot) == (1.0, 2.0, 4, 3)


def gaps(*minutes):
    moment, moments = DAY, [DAY]
    for m in minutes:
        moment += timedelta(minutes=m)
        moments.append(moment)
    return moments


def punctuality(spark, vehicles, pings):
    star = Star(
        dim_vehicles=spark.createDataFrame(vehicles, VEHICLE),
        fact_gps_pings=facts(spark, pings, PING), **calendar(spark),
    )
    view = views.bus_punctuality(star)
    return {r[0]: (round(r[1], 6), r[2]) for r in view.collect()}, view


def test_punctuality_thresholds(spark):
    routes = {"R12": 12.0, "R12+": 12.1, "R8": 8.0, "R8-": 7.9}
    vehicles = [(i, f"V{i}", "BUS", route) for i, route in enumerate(routes)]
    pings = [(n, i, 1.0, moment) for i, gap in enumerate(routes.values())
             for n, moment in enumerate(gaps(gap, gap, gap))]
    vehicles += [(10, "T", "TAXI", "R12"), (11, "N", "BUS", None), (12, "L", "BUS", "lonely")]
    pings += [(n, 10, 1.0, m) for n, m in enumerate(gaps(1))]
    pings += [(n, 11, 1.0, m) for n, m in enumerate(gaps(1))] + [(1, 12, 1.0, DAY)]
    result, view = punctuality(spark, vehicles, pings)
    assert result == {
        "R12": (12.0, "On Schedule"), "R12+": (12.1, "Delayed"),
        "R8": (8.0, "On Schedule"), "R8-": (7.9, "Early/Clustered"),
    }
    share = kpis.punctuality_share(view).collect()
    assert {(r[0], r[1], r[2]) for r in share} == {(s, r, 1) for r, (_, s) in result.items()}


def test_sub_second_gaps_count(spark):
    pings = [(1, 1, 1.0, DAY), (2, 1, 1.0, DAY + timedelta(seconds=90, milliseconds=300))]
    result, _ = punctuality(spark, [(1, "V", "BUS", "R")], pings)
    assert result == {"R": (1.505, "Early/Clustered")}


def test_gap_across_a_route_change_belongs_to_the_earlier_route(spark):
    # V moved from A to B; two pings share an instant, and the later id decides its route
    vehicles = [(1, "V", "BUS", "A"), (2, "V", "BUS", "B")]
    t = gaps(10, 20, 30)
    pings = [(1, 1, 1.0, t[0]), (2, 2, 1.0, t[1]), (3, 1, 1.0, t[1]), (4, 2, 1.0, t[2]),
             (5, 2, 1.0, t[3])]
    # A: t0->t1 10, t1(3)->t2 20; B: t1(2)->t1(3) 0, t2->t3 30
    result, _ = punctuality(spark, vehicles, pings)
    assert result == {"A": (15.0, "Delayed"), "B": (15.0, "Delayed")}


def test_punctuality_against_row_by_row_pairing(spark):
    import random

    rng = random.Random(3)
    vehicles = [(k, f"V{k // 2}", "BUS", f"R{k % 5}") for k in range(12)]
    pings = [(n, rng.randrange(12) if n % 3 else 0, 1.0,
              DAY + timedelta(seconds=rng.randrange(7200))) for n in range(600)]
    routes = {k: (v, r) for k, v, _, r in vehicles}
    per_vehicle, totals = {}, {}
    for ping, key, _, ts in pings:
        per_vehicle.setdefault(routes[key][0], []).append((ts, ping, routes[key][1]))
    for rows in per_vehicle.values():
        rows.sort()
        for (a, _, route), (b, _, _) in zip(rows, rows[1:]):
            n, total = totals.get(route, (0, 0.0))
            totals[route] = (n + 1, total + (b - a).total_seconds() / 60)
    result, _ = punctuality(spark, vehicles, pings)
    assert {r: g for r, (g, _) in result.items()} == {
        r: pytest.approx(total / n, abs=1e-6) for r, (n, total) in totals.items()
    }


def test_views_are_available_to_sql(spark):
    empty = {
        "dim_sensors": sensors(spark),
        "dim_vehicles": spark.createDataFrame([(1, "V1", "BUS", "R1")], VEHICLE),
        "fact_traffic_readings": facts(spark, [(1, 1, 9.0, 1, 0.1, 0.9, DAY)], READING),
        "fact_gps_pings": facts(spark, [(1, 1, 30.0, DAY)], PING),
        "fact_incident_reports": spark.createDataFrame([], schemas.FACT_INCIDENT_REPORTS),
    }
    views.register_views(Star(**empty, **calendar(spark)))
    counts = {n: spark.sql(f"SELECT * FROM {n}").count() for n in views.VIEWS}
    assert counts == {
        "v_congestion_analysis": 1, "v_travel_time_trends": 1, "v_incident_hotspots": 0,
        "v_bus_punctuality": 0, "v_peak_hour_analysis": 1,
    }
    levels = spark.sql("SELECT congestion_level FROM v_congestion_analysis").first()
    assert levels[0] == "Critical"
