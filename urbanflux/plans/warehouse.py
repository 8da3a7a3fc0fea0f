"""Where the tables of one warehouse live under a root folder."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from urbanflux import schemas
from urbanflux.operators.audit import latest_state
from urbanflux.operators.enrich import current_versions
from urbanflux.operators.surrogate import highest_key
from urbanflux.operators.validate import newest_first
from urbanflux.plans.views import Star
from urbanflux.sources.compaction import CompactedTable
from urbanflux.sources.snapshots import SnapshotTable
from urbanflux.sources.tables import append_table, read_table

OPERATIONAL = {
    "sensors": schemas.SENSORS,
    "transit_routes": schemas.TRANSIT_ROUTES,
    "vehicles": schemas.VEHICLES,
    "weather_stations": schemas.WEATHER_STATIONS,
}
DIMENSIONS = {
    "dim_date": schemas.DIM_DATE,
    "dim_time": schemas.DIM_TIME,
    "dim_sensors": schemas.DIM_SENSORS,
    "dim_vehicles": schemas.DIM_VEHICLES,
    "dim_weather_stations": schemas.DIM_WEATHER_STATIONS,
}
# folders below a fact: one per stream and micro-batch, or one per batch run
STREAMED = schemas.columns("stream_id string, batch_id long")
LOADED = schemas.columns("run_id string")
FACTS = {
    "fact_traffic_readings": (schemas.FACT_TRAFFIC_READINGS, STREAMED),
    "fact_gps_pings": (schemas.FACT_GPS_PINGS, STREAMED),
    "fact_weather_readings": (schemas.FACT_WEATHER_READINGS, LOADED),
    "fact_incident_reports": (schemas.FACT_INCIDENT_REPORTS, LOADED),
}


@dataclass(frozen=True)
class Warehouse:
    spark: SparkSession
    root: str

    def operational(self, name: str) -> SnapshotTable:
        return SnapshotTable(f"{self.root}/operational/{name}", OPERATIONAL[name])

    def dimension(self, name: str) -> SnapshotTable:
        return SnapshotTable(f"{self.root}/dimensions/{name}", DIMENSIONS[name])

    def fact_path(self, name: str) -> str:
        return f"{self.root}/facts/{name}"

    def fact(self, name: str) -> DataFrame:
        """All rows of a fact; folder names come back as columns, ``date_key`` prunes folders."""
        schema, folders = FACTS[name]
        if folders is STREAMED:
            return self.compacted(name).read(self.spark)
        layout = StructType([*schema.fields, *folders.fields])
        return read_table(self.spark, self.fact_path(name), layout)

    def compacted(self, name: str) -> CompactedTable:
        """A streamed fact as what has been compacted and what has landed since."""
        schema, folders = FACTS[name]
        layout = StructType([*schema.fields, *folders.fields])
        return CompactedTable(self.fact_path(name), f"{self.root}/compacted/{name}", layout)

    @property
    def dead_letters(self) -> CompactedTable:
        """Dead letters of streams and batch runs, compacted and landed."""
        layout = StructType([*schemas.DEAD_LETTER_QUEUE.fields, *STREAMED.fields])
        path = f"{self.root}/compacted/dead_letter_queue"
        return CompactedTable(self.dead_letter_path, path, layout, partition_by=())

    def reserve_ids(self, name: str, run_id: str, n: int, start: int = 0) -> int:
        """Set ``n`` row ids aside for a run; they begin after the returned number.

        Reservations are kept in a table of one row per run, so the fact itself need not be
        scanned for its highest id.
        """
        path = f"{self.root}/reserved_ids/{name}"
        layout = schemas.columns("run_id string, last_id long")
        last = highest_key(read_table(self.spark, path, layout), "last_id", start)
        append_table(self.spark.createDataFrame([(run_id, last + n)], layout).coalesce(1), path)
        return last

    def stream_number(self, name: str, stream: str) -> int:
        """The number of a stream among those that write to a fact; one row per checkpoint."""
        known = read_table(
            self.spark,
            f"{self.root}/reserved_ids/streams-{name}",
            schemas.columns("run_id string, last_id long"),
        )
        own = known.filter(F.col("run_id") == stream).agg(F.min("last_id").alias("n")).first()["n"]
        return self.reserve_ids(f"streams-{name}", stream, 1) if own is None else own - 1

    def calendars(self) -> tuple[DataFrame, DataFrame]:
        days, minutes = (self.dimension(n).current(self.spark) for n in ("dim_date", "dim_time"))
        return days, minutes

    @property
    def dead_letter_path(self) -> str:
        return f"{self.root}/dead_letter_queue"

    def dead_letter_queue(self) -> DataFrame:
        return newest_first(self.dead_letters.read(self.spark), "created_at")

    def append_audit(self, events: DataFrame) -> None:
        append_table(events, f"{self.root}/etl_audit_log")

    def audit_events(self) -> DataFrame:
        return read_table(self.spark, f"{self.root}/etl_audit_log", schemas.ETL_AUDIT_LOG)

    def audit_log(self) -> DataFrame:
        """One row per run in its latest state, newest first."""
        return newest_first(latest_state(self.audit_events()), "start_time")

    def current_dimension(self, name: str) -> DataFrame:
        return current_versions(self.dimension(name).current(self.spark))

    def star(self) -> Star:
        def dimension(name: str) -> DataFrame:
            return self.dimension(name).all_versions(self.spark)

        return Star(
            dim_date=self.dimension("dim_date").current(self.spark),
            dim_time=self.dimension("dim_time").current(self.spark),
            dim_sensors=dimension("dim_sensors"),
            dim_vehicles=dimension("dim_vehicles"),
            fact_traffic_readings=self.fact("fact_traffic_readings"),
            fact_gps_pings=self.fact("fact_gps_pings"),
            fact_incident_reports=self.fact("fact_incident_reports"),
        )
