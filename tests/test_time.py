"""Time scalars must not depend on the session zone (session here: New York)."""

import datetime as dt

from pyspark.sql import functions as F

from helpers import call, observations_df, snapshot
from quaystat.functions.time import epoch_seconds, parse_instant, to_instant, to_local
from quaystat.sources.boards import board_observations, iso_local


def _one(spark, expr, value, ddl="x TIMESTAMP_NTZ"):
    return spark.createDataFrame([(value,)], ddl).select(expr.alias("y")).first().y


def test_epoch_seconds_in_summer(spark):
    assert _one(spark, epoch_seconds("x"), dt.datetime(2024, 7, 1, 0, 0, 0, 900000)) == 1719792000


def test_delay_across_session_dst_change(spark):
    # New York leaves DST at 2026-11-01 06:00 UTC; the delay is one real hour.
    docs = [snapshot([call(aimed="2026-11-01T05:30:00Z", expected="2026-11-01T06:30:00Z")])]
    assert observations_df(spark, docs).first().delay_seconds == 3600


def test_board_floor_is_utc_six_hours(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 7, 1, 13, 5),)], "collected_at_utc TIMESTAMP_NTZ")
    assert board_observations(df).first().collected_at_utc == dt.datetime(2024, 7, 1, 12, 0)


def test_iso_local_round_trip_in_summer(spark):
    value = dt.datetime(2024, 7, 1, 22, 30, 0, 123456)
    text = _one(spark, iso_local("x"), value)
    assert text == "2024-07-02T00:30:00.123456+02:00"
    assert _one(spark, iso_local("x"), dt.datetime(2024, 1, 1, 5)) == "2024-01-01T06:00:00+01:00"
    assert _one(spark, parse_instant("x"), text, "x STRING") == value


def test_local_time_and_instant(spark):
    assert _one(spark, to_local("x"), dt.datetime(2026, 10, 25, 0, 30)) == dt.datetime(2026, 10, 25, 2, 30)
    inst = _one(spark, F.unix_seconds(to_instant("x")), dt.datetime(2024, 7, 1))
    assert inst == 1719792000


def test_instant_texts_in_any_session_zone(spark):  # P-03
    cases = {
        "2026-09-17T08:00:00": dt.datetime(2026, 9, 17, 8), "2026-09-17 08:00:00": dt.datetime(2026, 9, 17, 8), "2026-09-17 08:00": None, "2026-09-17T10:00:00+02:00": dt.datetime(2026, 9, 17, 8),
        "2026-09-17T10:00:00.25+0200": dt.datetime(2026, 9, 17, 8, 0, 0, 250000), "2026-09-17T08:00:00Z": dt.datetime(2026, 9, 17, 8), " 2026-09-17T03:00:00-05 ": dt.datetime(2026, 9, 17, 8),
        "12:30": None, "2026-09-17": None, "now": None, "": None, None: None, "2026-13-17T08:00:00": None, "2026-09-17T25:00:00Z": None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "x STRING")
    for zone in ("America/New_York", "UTC"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            assert {r.x: r.y for r in df.select("x", parse_instant("x").alias("y")).collect()} == cases
        finally:
            spark.conf.set("spark.sql.session.timeZone", "America/New_York")
