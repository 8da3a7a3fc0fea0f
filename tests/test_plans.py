"""Physical plans: what is pushed down, what is shuffled, what is broadcast."""

import re
from datetime import datetime

import pytest
from conftest import SF
from pyspark.sql import functions as F

from urbanflux import schemas
from urbanflux.functions.rules import traffic_rules
from urbanflux.operators.dedupe import first_per_key
from urbanflux.operators.validate import faulty_rows, mark_faults, parse_payloads
from urbanflux.plans import views
from urbanflux.plans.queries import QUERIES
from urbanflux.plans.views import Star
from urbanflux.sources.calendar import dim_date, dim_time

EAGER = {
    "as_of_lookup", "weather_ids", "landing_read", "delta_reference_check", "dead_letter_exactly_once", "fact_load_as_of",
    "audit_counts", "audit_failed_job", "stream_compacted_facts", "stream_constraint_check", "stream_dead_letter_monitor",
    "stream_fact_ingest", "stream_replay",
}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_small_tables(spark):
    """Nothing is small enough to broadcast by size: what remains is hinted."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_no_cross_joins_and_no_python_rows(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|Python|Pandas", text)


@pytest.mark.parametrize(
    "name,table",
    [("referential_check", "lineitem"), ("next_ping", "events"), ("incident_dedupe", "lineitem"),
     ("partial_update_upsert", "orders"), ("scd1_upsert", "lineitem")],
)
def test_large_inputs_are_scanned_once(spark, name, table):
    """After what the query has written, the plan reads the table once at most."""
    assert plan(QUERIES[name](spark, SF)).count(f"/{table}.parquet") <= 1


def test_entity_dimensions_are_not_broadcast_beyond_the_threshold(spark, no_small_tables):
    joined = plan(QUERIES["fact_load"](spark, SF))
    assert "SortMergeJoin" in joined and "BroadcastHashJoin" not in joined
    congestion = plan(QUERIES["congestion_view"](spark, SF))
    # the two calendars are hinted, the sensors are not
    assert congestion.count("BroadcastHashJoin") == 2 and "SortMergeJoin" in congestion


def test_results_do_not_depend_on_the_join_strategy(spark, no_small_tables):
    from oracle_check import connect, differences

    from __spark_entry__ import oracle_sql

    connection = connect(SF)
    for name in ("fact_load", "punctuality_view", "travel_time_view", "incident_dedupe",
                 "referential_check", "partial_update_upsert", "scd2_classify"):
        assert differences(QUERIES[name](spark, SF), connection, oracle_sql()[name]) == []


def test_a_message_is_parsed_once(spark, folder):
    spark.createDataFrame([("{}",)], "value string").write.parquet(f"{folder}/m")
    parsed = parse_payloads(spark.read.parquet(f"{folder}/m"), schemas.TRAFFIC_PAYLOAD)
    text = plan(faulty_rows(mark_faults(parsed, traffic_rules())))
    assert text.count("from_json") == 1


def test_copies_collapse_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("n"))
    text = plan(first_per_key(df, ["k"], ["n"]))  # printed from the result down to the scan
    assert text.index("Exchange hashpartitioning(k") < text.index("partial_min")


def test_facts_are_pruned_by_day_and_column(spark, folder):
    days = spark.range(5).select((F.col("id") + 20260701).cast("int").alias("date_key"), "id")
    days.withColumns({"other": F.lit(1)}).write.partitionBy("date_key").parquet(f"{folder}/f")
    text = plan(spark.read.parquet(f"{folder}/f").filter("date_key = 20260702").select("id"))
    assert "PartitionFilters: [isnotnull(date_key" in text
    assert "ReadSchema: struct<id:bigint>" in text


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(QUERIES["scd2_classify"](spark, SF))
    assert "PushedFilters: [IsNotNull(c_acctbal), GreaterThanOrEqual(c_acctbal,0.0)]" in text
    text = plan(QUERIES["primary_key_check"](spark, SF))
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in text


def test_windows_run_over_time_slices_only(spark, folder):
    """Pings are reduced to summaries; only where versions take turns are they ordered, within a slice."""
    vehicles = spark.createDataFrame(
        [(1, "V", "BUS", "R"), (2, "V", "BUS", "Q")],
        "vehicle_key long, vehicle_id string, vehicle_type string, assigned_route_id string",
    )
    calendars = {"dim_date": dim_date(spark, "2026-01-01", "2026-01-02"), "dim_time": dim_time(spark)}
    for name, keys in (("settled", (1, 1, 2)), ("mixed", (1, 2, 1))):
        rows = [(n, key, datetime(2026, 1, 1, 0, n)) for n, key in enumerate(keys)]
        columns = "ping_id long, vehicle_key long, record_timestamp timestamp_ntz"
        spark.createDataFrame(rows, columns).write.parquet(f"{folder}/{name}")
        pings = spark.read.schema(schemas.FACT_GPS_PINGS).parquet(f"{folder}/{name}")
        text = plan(views.bus_punctuality(Star(dim_vehicles=vehicles, fact_gps_pings=pings, **calendars)))
        windows = [line for line in text.splitlines() if "- Window [" in line]
        assert bool(windows) == (name == "mixed") and all("_slice" in line for line in windows)
