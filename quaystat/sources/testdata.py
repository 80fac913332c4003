"""Map the driver's shared tables onto departure observations.

The shared tables hold no departures, so ``events`` is mapped column by
column onto the observation schema (rules below). Every rule is a built-in
expression, so the mapping is one narrow projection over the scan.

``lineitem`` joined to ``orders`` gives a second, join-heavy source used by
the bench (``scale_observations``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quaystat.functions.time import delay_seconds, local_features, ntz_literal
from quaystat.schema import OBSERVATION_COLUMNS

# --- Fixed values: the mapping rules from events to observations. ---
# k = props.k; bkt = whole days since 2024-01-01 integer-divided by 3
# stop  = 'S' || user_id % 5, name 'Stop ' || user_id % 5
# quay  = NULL when k % 10 = 0, else stop || ':Q' || k % 4, name 'Quay ' || k % 4
# line  = 'L' || user_id; code user_id / name 'Line ' || user_id, NULL when user_id % 25 = 0
# mode  = MODES[(user_id div 5) % 5]
# journey = 'J' || user_id || ':' || event_type; destination 'Dest ' || user_id % 7
# realtime = k % 2 = 1
# aimed = 2024-01-01 + 3*bkt days + (user_id*7 + length(event_type)*5) % 72 hours
# delay = floor(value * 6) - 60 seconds; expected = aimed + delay; actual = NULL
MODES = ["bus", "tram", "metro", "rail", "coach"]
BASE_DATE = dt.date(2024, 1, 1)
BASE_TS = dt.datetime(2024, 1, 1)
# "dirty" variant: journey id missing when k % 50 = 7.
DIRTY_MOD, DIRTY_REMAINDER = 50, 7
# "two-batch" variant, by event_id % 7. 0: seen again, expected time later by the shift.
# 1: a new journey ('N' behind its id) on a stored collected date. 2: a new journey ('F')
# collected this many days later, its line's name missing for even user ids, else ending in ' II'.
SECOND_BATCH_SHIFT_SECONDS = 90_000
SECOND_BATCH_FRESH_DAYS = 400

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _idiv(a: Column, b: int) -> Column:
    return F.call_function("div", a, F.lit(b))


def _mapped_columns(events: DataFrame, dirty: bool) -> list[Column]:
    user = F.col("user_id")
    etype = F.col("event_type")
    k = F.get_json_object("props", "$.k").cast("int")
    bkt = _idiv(F.datediff(F.to_date("ts"), F.lit(BASE_DATE)), 3)
    stop = F.concat(F.lit("S"), (user % 5).cast("string"))
    no_quay = (k % 10) == 0
    no_code = (user % 25) == 0
    aimed = F.timestamp_add(
        "HOUR",
        (user * 7 + F.length(etype) * 5) % 72,
        F.timestamp_add("DAY", bkt * 3, ntz_literal(BASE_TS)),
    )
    delay = F.floor(F.col("value") * 6) - 60
    journey = F.concat(F.lit("J"), user.cast("string"), F.lit(":"), etype)
    if dirty:
        journey = F.when((k % DIRTY_MOD) != DIRTY_REMAINDER, journey)
    return [
        F.col("ts").alias("collected_at_utc"),
        stop.alias("stop_place_id"),
        F.concat(F.lit("Stop "), (user % 5).cast("string")).alias("stop_name"),
        F.when(~no_quay, F.concat(stop, F.lit(":Q"), (k % 4).cast("string"))).alias("quay_id"),
        F.when(~no_quay, F.concat(F.lit("Quay "), (k % 4).cast("string"))).alias("quay_name"),
        journey.alias("service_journey_id"),
        F.concat(F.lit("L"), user.cast("string")).alias("line_id"),
        F.when(~no_code, user.cast("string")).alias("line_public_code"),
        F.when(~no_code, F.concat(F.lit("Line "), user.cast("string"))).alias("line_name"),
        F.element_at(F.array(*[F.lit(m) for m in MODES]), (_idiv(user, 5) % 5 + 1).cast("int"))
        .alias("transport_mode"),
        F.concat(F.lit("Dest "), (user % 7).cast("string")).alias("destination"),
        ((k % 2) == 1).alias("realtime"),
        aimed.alias("aimed_departure_utc"),
        F.timestamp_add("SECOND", delay, aimed).alias("expected_departure_utc"),
        F.lit(None).cast("timestamp_ntz").alias("actual_departure_utc"),
        delay.cast("long").alias("delay_seconds"),
    ]


def observations_from_events(events: DataFrame, dirty: bool = False) -> DataFrame:
    """One observation per event (whole table), with local-time features."""
    flat = events.select(*_mapped_columns(events, dirty))
    feats = local_features("expected_departure_utc")
    return flat.select(*flat.columns, *[c.alias(n) for n, c in feats.items()]).select(
        *OBSERVATION_COLUMNS
    )


def observations(spark: SparkSession, sf_dir: str, dirty: bool = False) -> DataFrame:
    return observations_from_events(read_table(spark, sf_dir, "events"), dirty=dirty)


def second_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The later batch of the "two-batch" variant (rules above)."""
    events = read_table(spark, sf_dir, "events")
    part = {k: observations_from_events(events.filter(F.col("event_id") % 7 == k)) for k in (0, 1, 2)}
    shift = F.lit(SECOND_BATCH_SHIFT_SECONDS)
    again = part[0].withColumns(
        {
            "expected_departure_utc": F.timestamp_add("SECOND", shift, "expected_departure_utc"),
            "delay_seconds": F.col("delay_seconds") + shift,
        }
    )
    again = again.withColumns(local_features("expected_departure_utc"))
    stored = part[1].withColumn("service_journey_id", F.concat("service_journey_id", F.lit("N")))
    even = F.substring("line_id", 2, 20).cast("long") % 2 == 0
    fresh = part[2].withColumns(
        {
            "service_journey_id": F.concat("service_journey_id", F.lit("F")),
            "collected_at_utc": F.timestamp_add("DAY", F.lit(SECOND_BATCH_FRESH_DAYS), "collected_at_utc"),
            "line_name": F.when(~even, F.concat("line_name", F.lit(" II"))),
        }
    )
    return again.unionByName(stored).unionByName(fresh).select(*OBSERVATION_COLUMNS)


def scale_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Join-heavy source: order as journey, supplier as stop, part as line,
    ship date - order date as delay. ``(l_orderkey, l_linenumber)`` repeats,
    so the observation key is made unique with the line number."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate"
    )
    od = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    j = li.join(od, li.l_orderkey == od.o_orderkey)
    aimed = F.col("o_orderdate").cast("timestamp_ntz")
    expected = F.col("l_shipdate").cast("timestamp_ntz")
    stop = F.concat(F.lit("SUP"), F.col("l_suppkey").cast("string"))
    flat = j.select(
        F.timestamp_add("SECOND", F.col("l_linenumber"), aimed).alias("collected_at_utc"),
        stop.alias("stop_place_id"),
        F.concat(F.lit("Supplier "), F.col("l_suppkey").cast("string")).alias("stop_name"),
        F.lit(None).cast("string").alias("quay_id"),
        F.lit(None).cast("string").alias("quay_name"),
        F.concat(F.lit("O"), F.col("l_orderkey").cast("string")).alias("service_journey_id"),
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("line_id"),
        F.col("l_partkey").cast("string").alias("line_public_code"),
        F.concat(F.lit("Part "), F.col("l_partkey").cast("string")).alias("line_name"),
        F.element_at(F.array(*[F.lit(m) for m in MODES]), (F.col("l_partkey") % 5 + 1).cast("int"))
        .alias("transport_mode"),
        F.col("o_orderpriority").alias("destination"),
        F.lit(True).alias("realtime"),
        aimed.alias("aimed_departure_utc"),
        expected.alias("expected_departure_utc"),
        F.lit(None).cast("timestamp_ntz").alias("actual_departure_utc"),
        delay_seconds(expected, aimed).alias("delay_seconds"),
    )
    feats = local_features("expected_departure_utc")
    return flat.select(*flat.columns, *[c.alias(n) for n, c in feats.items()]).select(
        *OBSERVATION_COLUMNS
    )
