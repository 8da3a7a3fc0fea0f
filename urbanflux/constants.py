"""Values that consumers of the warehouse rely on and that therefore must not change."""

# ---------------------------------------------------------------- fixed values
TRAFFIC_TOPIC = "traffic-sensors-topic"
GPS_TOPIC = "gps-tracking-topic"
DEAD_LETTER_TOPIC = "dead-letter-topic"

TRAFFIC_JOB_REASON = "Validation Failed: Missing ID, invalid metrics, or parsing error"
GPS_JOB_REASON = "Validation Failed: Invalid coords or speed metrics"
MALFORMED_REASON = "Malformed payload"
MISSING_FIELD_REASON = "Missing required field: "
NEGATIVE_SPEED_REASON = "Speed cannot be negative"
LATITUDE_REASON = "Latitude out of bounds"
LONGITUDE_REASON = "Longitude out of bounds"
SEVERITY_REASON = "Invalid severity level. Must be MINOR, MAJOR, or CRITICAL."
MALFORMED_MARKER = "MALFORMED"
ALERT_PREFIX = "CRITICAL INVALID PAYLOAD RECEIVED in DLQ: "

SEVERITIES = ("MINOR", "MAJOR", "CRITICAL")
HAZARD_SCORES = {"CRITICAL": 3, "MAJOR": 2}
OTHER_HAZARD_SCORE = 1
CONGESTION_LEVELS = ((0.8, "Critical"), (0.5, "Heavy"), (0.3, "Moderate"))
LOWEST_CONGESTION_LEVEL = "Low"
TIME_BANDS = ((7, 9, "AM Peak (07:00-09:00)"), (16, 18, "PM Peak (16:00-18:00)"))
OFF_PEAK = "Off-Peak"
LATE_GAP_MINUTES = 12.0
EARLY_GAP_MINUTES = 8.0
#: Share by which a gap may differ from a route's schedule: the limits above are 10 minutes with it.
SCHEDULE_TOLERANCE = 0.2
DELAYED, EARLY, ON_SCHEDULE = "Delayed", "Early/Clustered", "On Schedule"
BUS = "BUS"
FREE_FLOW_SPEED = 55.0
DEFAULT_STATION_LATITUDE = 40.7
DEFAULT_STATION_LONGITUDE = -73.9
STATION_NAME_SUFFIX = " Station"
FIRST_INCIDENT_ID = 1000

STARTED, SUCCESS, FAILED = "STARTED", "SUCCESS", "FAILED"
SENSORS_JOB = "SCD2_Sensors"
VEHICLES_JOB = "SCD2_Vehicles"
HOURLY_JOB = "Airflow_Weather_Incidents"
DAILY_JOB = "Airflow_Transit_Schedule"
# ------------------------------------------------------- end of fixed values
