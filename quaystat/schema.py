"""Schemas: the raw board snapshot feed, the flat observation, the staging
projection and the warehouse tables.

The raw schema is explicit and never inferred. Field names are the feed's
JSON contract.
"""

from __future__ import annotations

from pyspark.sql.types import StructType

# --- Fixed values: field names of the departure-board snapshot feed. ---
# One document per (stop, collection instant):
#   collected_at_utc, stop_place_id, data.stopPlace{id, name, estimatedCalls[]}
# Each estimated call:
#   realtime, aimedDepartureTime, expectedDepartureTime, actualDepartureTime,
#   quay{id, name}, destinationDisplay{frontText},
#   serviceJourney{id, journeyPattern{line{id, publicCode, name, transportMode}}}
LINE_DDL = "id STRING, publicCode STRING, name STRING, transportMode STRING"
CALL_DDL = (
    "realtime BOOLEAN, aimedDepartureTime STRING, expectedDepartureTime STRING, "
    "actualDepartureTime STRING, quay STRUCT<id: STRING, name: STRING>, "
    "destinationDisplay STRUCT<frontText: STRING>, "
    f"serviceJourney STRUCT<id: STRING, journeyPattern: STRUCT<line: STRUCT<{LINE_DDL}>>>"
)
SNAPSHOT_DDL = (
    "collected_at_utc STRING, stop_place_id STRING, "
    "data STRUCT<stopPlace: STRUCT<id: STRING, name: STRING, "
    f"estimatedCalls: ARRAY<STRUCT<{CALL_DDL}>>>>"
)


def snapshot_schema() -> StructType:
    """Parsed snapshot schema (needs an active session)."""
    return StructType.fromDDL(SNAPSHOT_DDL)


# Silver observation: one row per estimated call per snapshot. All instants
# are UTC wall-clock TIMESTAMP_NTZ, so nothing depends on the session zone.
OBSERVATION_DDL = (
    "collected_at_utc TIMESTAMP_NTZ, stop_place_id STRING, stop_name STRING, "
    "quay_id STRING, quay_name STRING, service_journey_id STRING, line_id STRING, "
    "line_public_code STRING, line_name STRING, transport_mode STRING, "
    "destination STRING, realtime BOOLEAN, aimed_departure_utc TIMESTAMP_NTZ, "
    "expected_departure_utc TIMESTAMP_NTZ, actual_departure_utc TIMESTAMP_NTZ, "
    "delay_seconds BIGINT, expected_departure_local TIMESTAMP_NTZ, "
    "service_date DATE, departure_hour INT, weekday_number INT, is_weekend BOOLEAN"
)
OBSERVATION_COLUMNS = [part.split(" ")[0] for part in OBSERVATION_DDL.split(", ")]

# Staging projection handed to the warehouse load (18 columns, fixed order).
STAGING_COLUMNS = [
    "collected_at_utc", "stop_place_id", "stop_name", "quay_id", "quay_name",
    "line_id", "line_public_code", "line_name", "transport_mode",
    "service_journey_id", "destination", "realtime", "aimed_departure_utc",
    "expected_departure_utc", "actual_departure_utc", "delay_seconds",
    "departure_hour", "service_date",
]

# Keys.
DEDUP_KEY = [
    "collected_at_utc", "stop_place_id", "service_journey_id", "quay_id",
    "aimed_departure_utc",
]
FACT_KEY = ["collected_at_utc", "stop_key", "service_journey_id", "aimed_departure_utc"]
DEPARTURE_KEY = ["stop_key", "service_journey_id", "aimed_departure_utc"]

# Warehouse table schemas (gold).
DIM_DATE_DDL = (
    "date_key INT, full_date DATE, year INT, quarter INT, month INT, "
    "month_name STRING, week_of_year INT, day_of_week INT, day_name STRING, "
    "is_weekend BOOLEAN"
)
DIM_STOP_DDL = "stop_key BIGINT, stop_place_id STRING, stop_name STRING"
DIM_QUAY_DDL = "quay_key BIGINT, quay_id STRING, quay_name STRING, stop_key BIGINT"
DIM_LINE_DDL = (
    "line_key BIGINT, line_id STRING, line_public_code STRING, line_name STRING, "
    "transport_mode STRING"
)
FACT_DDL = (
    "observation_key BIGINT, collected_at_utc TIMESTAMP_NTZ, date_key INT, "
    "stop_key BIGINT, quay_key BIGINT, line_key BIGINT, service_journey_id STRING, "
    "destination STRING, realtime BOOLEAN, aimed_departure_utc TIMESTAMP_NTZ, "
    "expected_departure_utc TIMESTAMP_NTZ, actual_departure_utc TIMESTAMP_NTZ, "
    "delay_seconds INT, departure_hour SMALLINT, collected_date DATE"
)

# Materialised latest estimates: the view's columns plus the partition
# column ``aimed_date`` (date of the aimed time, fixed by the departure key).
LATEST_DDL = (
    "observation_key BIGINT, collected_at_utc TIMESTAMP_NTZ, date_key INT, "
    "stop_key BIGINT, quay_key BIGINT, line_key BIGINT, service_journey_id STRING, "
    "destination STRING, realtime BOOLEAN, aimed_departure_utc TIMESTAMP_NTZ, "
    "expected_departure_utc TIMESTAMP_NTZ, actual_departure_utc TIMESTAMP_NTZ, "
    "delay_seconds INT, departure_hour SMALLINT, aimed_date DATE"
)

# Maintained report state: how many latest estimates have these values. ``service_day`` is the date of ``date_key``.
COUNTS_KEY = ["date_key", "stop_key", "line_key", "departure_hour", "delay_seconds"]
COUNTS_DDL = (
    "date_key INT, stop_key BIGINT, line_key BIGINT, departure_hour SMALLINT, delay_seconds INT, "
    "n BIGINT, service_day DATE"
)

# Columns of the latest-estimate view (the rank helper is dropped).
LATEST_COLUMNS = [
    "observation_key", "collected_at_utc", "date_key", "stop_key", "quay_key",
    "line_key", "service_journey_id", "destination", "realtime",
    "aimed_departure_utc", "expected_departure_utc", "actual_departure_utc",
    "delay_seconds", "departure_hour",
]
