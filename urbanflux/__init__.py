"""Urban telemetry warehouse on Spark: streams, slowly changing dimensions, facts, views."""

__version__ = "0.1.0"
