"""Declared schemas. Nothing is inferred from data; every timestamp is zone-less."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def columns(names_and_types: str) -> T.StructType:
    """``"id long, name string"`` as a schema, without needing a session."""
    pairs = [column.split() for column in names_and_types.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# stream payloads
TRAFFIC_PAYLOAD = columns(
    "sensor_id string, speed double, vehicle_volume int, occupancy double,"
    " congestion_index double, timestamp string"
)
GPS_PAYLOAD = columns(
    "vehicle_id string, route_id string, latitude double, longitude double,"
    " speed double, timestamp string"
)

# landing files
WEATHER_LANDING = columns(
    "station_id string, temperature double, precipitation double, wind_speed double,"
    " record_timestamp string"
)
INCIDENT_LANDING = columns(
    "incident_id long, incident_type string, severity string, location_name string,"
    " latitude double, longitude double, record_timestamp string"
)

# operational tables
SENSORS = columns(
    "sensor_id string, location_name string, latitude double, longitude double,"
    " status string, installation_date date, created_at timestamp_ntz, updated_at timestamp_ntz"
)
TRANSIT_ROUTES = columns(
    "route_id string, route_name string, route_type string, agency_name string,"
    " schedule_interval_minutes int, created_at timestamp_ntz, updated_at timestamp_ntz"
)
VEHICLES = columns(
    "vehicle_id string, license_plate string, vehicle_type string, operator_name string,"
    " assigned_route_id string, status string, created_at timestamp_ntz, updated_at timestamp_ntz"
)
WEATHER_STATIONS = columns(
    "station_id string, station_name string, latitude double, longitude double,"
    " created_at timestamp_ntz, updated_at timestamp_ntz"
)

# dimensions
DIM_DATE = columns(
    "date_key int, date date, year int, month int, month_name string, day int,"
    " day_of_week int, day_name string, is_weekend boolean"
)
DIM_TIME = columns("time_key int, hour int, minute int")
DIM_SENSORS = columns(
    "sensor_key long, sensor_id string, location_name string, latitude double,"
    " longitude double, status string, start_date timestamp_ntz, end_date timestamp_ntz,"
    " is_current boolean, created_at timestamp_ntz"
)
DIM_VEHICLES = columns(
    "vehicle_key long, vehicle_id string, license_plate string, vehicle_type string,"
    " operator_name string, assigned_route_id string, status string,"
    " start_date timestamp_ntz, end_date timestamp_ntz, is_current boolean,"
    " created_at timestamp_ntz"
)
DIM_WEATHER_STATIONS = columns(
    "station_key long, station_id string, station_name string, latitude double,"
    " longitude double, created_at timestamp_ntz"
)

# facts
FACT_TRAFFIC_READINGS = columns(
    "reading_id long, sensor_key long, date_key int, time_key int, speed double,"
    " vehicle_volume int, occupancy double, congestion_index double,"
    " record_timestamp timestamp_ntz"
)
FACT_GPS_PINGS = columns(
    "ping_id long, vehicle_key long, date_key int, time_key int, latitude double,"
    " longitude double, speed double, record_timestamp timestamp_ntz"
)
FACT_WEATHER_READINGS = columns(
    "reading_id long, station_key long, date_key int, time_key int, temperature double,"
    " precipitation double, wind_speed double, record_timestamp timestamp_ntz"
)
FACT_INCIDENT_REPORTS = columns(
    "incident_id long, incident_type string, severity string, location_name string,"
    " latitude double, longitude double, date_key int, time_key int,"
    " record_timestamp timestamp_ntz"
)

# logs
ETL_AUDIT_LOG = columns(
    "run_id string, job_name string, status string, start_time timestamp_ntz,"
    " end_time timestamp_ntz, records_read long, records_written long,"
    " error_message string, execution_date date"
)
DEAD_LETTER_QUEUE = columns(
    "payload string, validation_error string, source_topic string, created_at timestamp_ntz"
)
# as it travels through the topic; the id names stream, micro-batch and place of the message
DEAD_LETTER_MESSAGE = columns(
    "payload string, validation_error string, source_topic string, letter_id string"
)
# what the monitor keeps of a letter
SEEN_LETTER = columns("letter_id string, source_topic string, validation_error string")
