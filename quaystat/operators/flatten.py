"""Snapshots -> observations (silver), with reject routing.

``flatten_snapshots`` is the reference transform: explode the calls (empty,
NULL or malformed documents give no rows), project the nested paths, parse
the four instants, compute delay and local-time features. ``validate`` then
labels every row with a reject reason (NULL = valid) so a caller can split
valid rows from rejects in one pass, without re-reading the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaystat.functions.time import delay_seconds, local_features, parse_instant
from quaystat.operators.ranking import first_per_group, total_order
from quaystat.schema import DEDUP_KEY, OBSERVATION_COLUMNS
from quaystat.sources.snapshots import CORRUPT_COLUMN, SOURCE_FILE_COLUMN

REJECT_COLUMN = "reject_reason"

# Reject reasons.
MISSING_KEY = "missing_required_field"
BAD_TIMESTAMP = "malformed_timestamp"
MISSING_LOAD_FIELD = "missing_warehouse_field"
DELAY_RANGE = "delay_out_of_range"
CORRUPT_FILE = "corrupt_snapshot"
# Labels of snapshots that hold no call. They are counted, not rejected.
EMPTY_BOARD = "empty_board"
NULL_BOARD = "null_board"
BOARD_COLUMN = "board_note"

INT_MIN, INT_MAX = -(2**31), 2**31 - 1


def _raw(path: str) -> Column:
    return F.col(f"call.{path}")


def flatten_snapshots(snapshots: DataFrame, keep_raw: bool = False, keep_empty: bool = False) -> DataFrame:
    """One row per estimated call per snapshot (observation columns).

    With ``keep_raw`` the raw timestamp strings and source file are kept as
    ``raw_*`` columns for reject diagnosis. With ``keep_empty`` a snapshot without
    calls gives one row too, told apart by ``board_note`` (NULL on calls).
    """
    note = (
        F.when(F.col(CORRUPT_COLUMN).isNotNull() if CORRUPT_COLUMN in snapshots.columns else F.lit(False), F.lit(CORRUPT_FILE))
        .when(F.col("data.stopPlace").isNull(), F.lit(NULL_BOARD))
        .when(F.coalesce(F.size("data.stopPlace.estimatedCalls"), F.lit(0)) <= 0, F.lit(EMPTY_BOARD))
    )
    explode = F.explode_outer if keep_empty else F.explode
    calls = snapshots.select(
        "collected_at_utc",
        "stop_place_id",
        F.col("data.stopPlace.id").alias("_payload_stop_id"),
        F.col("data.stopPlace.name").alias("_stop_name"),
        *([F.col(SOURCE_FILE_COLUMN)] if SOURCE_FILE_COLUMN in snapshots.columns else []),
        explode("data.stopPlace.estimatedCalls").alias("call"),
        *([note.alias(BOARD_COLUMN)] if keep_empty else []),
    )
    line = "serviceJourney.journeyPattern.line"
    flat = calls.select(
        parse_instant("collected_at_utc").alias("collected_at_utc"),
        F.coalesce(F.col("_payload_stop_id"), F.col("stop_place_id")).alias("stop_place_id"),
        F.col("_stop_name").alias("stop_name"),
        _raw("quay.id").alias("quay_id"),
        _raw("quay.name").alias("quay_name"),
        _raw("serviceJourney.id").alias("service_journey_id"),
        _raw(f"{line}.id").alias("line_id"),
        _raw(f"{line}.publicCode").alias("line_public_code"),
        _raw(f"{line}.name").alias("line_name"),
        _raw(f"{line}.transportMode").alias("transport_mode"),
        _raw("destinationDisplay.frontText").alias("destination"),
        _raw("realtime").alias("realtime"),
        parse_instant(_raw("aimedDepartureTime")).alias("aimed_departure_utc"),
        parse_instant(_raw("expectedDepartureTime")).alias("expected_departure_utc"),
        parse_instant(_raw("actualDepartureTime")).alias("actual_departure_utc"),
        F.col("collected_at_utc").alias("raw_collected_at"),
        _raw("aimedDepartureTime").alias("raw_aimed"),
        _raw("expectedDepartureTime").alias("raw_expected"),
        _raw("actualDepartureTime").alias("raw_actual"),
        *[F.col(c) for c in (SOURCE_FILE_COLUMN, BOARD_COLUMN) if c in calls.columns],
    )
    feats = {
        "delay_seconds": delay_seconds("expected_departure_utc", "aimed_departure_utc"),
        **local_features("expected_departure_utc"),
    }
    out = flat.select(*flat.columns, *[c.alias(n) for n, c in feats.items()])
    extra = [c for c in out.columns if c.startswith("raw_") or c == SOURCE_FILE_COLUMN]
    noted = [BOARD_COLUMN] if keep_empty else []
    return out.select(*OBSERVATION_COLUMNS, *(extra if keep_raw else []), *noted)


def _bad_instant(parsed: str, raw: str) -> Column:
    return F.col(raw).isNotNull() & F.col(parsed).isNull()


def reject_reason(strict_fields: bool = True) -> Column:
    """First failing rule, NULL when the row is valid.

    Order: malformed instants (the reference fails the whole job there), the
    four required fields (the reference filters these silently), then the
    fields the warehouse declares NOT NULL, then delay outside INTEGER.
    """
    bad_ts = (
        _bad_instant("collected_at_utc", "raw_collected_at")
        | _bad_instant("aimed_departure_utc", "raw_aimed")
        | _bad_instant("expected_departure_utc", "raw_expected")
        | _bad_instant("actual_departure_utc", "raw_actual")
    )
    missing_key = (
        F.col("stop_place_id").isNull()
        | F.col("service_journey_id").isNull()
        | F.col("aimed_departure_utc").isNull()
        | F.col("expected_departure_utc").isNull()
    )
    missing_load = (
        F.col("collected_at_utc").isNull()
        | F.col("stop_name").isNull()
        | F.col("line_id").isNull()
        | F.col("transport_mode").isNull()
        | F.col("realtime").isNull()
    )
    out_of_range = (F.col("delay_seconds") < INT_MIN) | (F.col("delay_seconds") > INT_MAX)
    reason = (
        F.when(bad_ts, F.lit(BAD_TIMESTAMP))
        .when(missing_key, F.lit(MISSING_KEY))
        .when(out_of_range, F.lit(DELAY_RANGE))
    )
    if strict_fields:
        reason = reason.when(missing_load, F.lit(MISSING_LOAD_FIELD))
    return reason


def validate(flat: DataFrame, strict_fields: bool = True) -> DataFrame:
    """Add ``reject_reason`` to a ``flatten_snapshots(keep_raw=True)`` frame."""
    return flat.withColumn(REJECT_COLUMN, reject_reason(strict_fields))


def label(flat: DataFrame, strict_fields: bool = True) -> DataFrame:
    """``validate`` for a ``flatten_snapshots(keep_raw=True, keep_empty=True)`` frame: corrupt
    documents are rejects, rows of empty boards carry their note and no reject reason."""
    note = F.col(BOARD_COLUMN)
    reason = F.when(note == CORRUPT_FILE, F.lit(CORRUPT_FILE)).when(note.isNull(), reject_reason(strict_fields))
    return flat.withColumn(REJECT_COLUMN, reason)


def is_valid() -> Column:
    """Condition: a labelled row is a valid observation."""
    return F.col(BOARD_COLUMN).isNull() & F.col(REJECT_COLUMN).isNull()


def dedup_observations(df: DataFrame) -> DataFrame:
    """One row per (collected, stop, journey, quay, aimed); NULL quays compare
    equal. The survivor is the newest expected time, then a total order over
    the remaining columns, so every run keeps the same row."""
    rest = [c for c in OBSERVATION_COLUMNS if c not in DEDUP_KEY]
    order = total_order([F.col("expected_departure_utc").desc_nulls_last()], rest)
    return first_per_group(df, DEDUP_KEY, order)
