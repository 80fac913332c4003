"""Raw snapshot -> observation (reference ETL cases plus ledger T*/N*)."""

import datetime as dt

from pyspark.sql import functions as F

from helpers import call, snapshot, snapshots_df, write_landed
from quaystat.operators.flatten import (
    BAD_TIMESTAMP,
    MISSING_KEY,
    REJECT_COLUMN,
    dedup_observations,
    flatten_snapshots,
    validate,
)
from quaystat.plans.jobs import silver_from_snapshots
from quaystat.sources.snapshots import MissingInputError, read_snapshots


def _flat(spark, docs, **kw):
    return flatten_snapshots(snapshots_df(spark, docs), **kw)


def test_nested_row_becomes_one_observation(spark):
    rows = _flat(spark, [snapshot([call()])]).collect()
    assert len(rows) == 1
    r = rows[0]
    assert r.stop_name == "Quayside"
    assert r.line_public_code == "8X"
    assert r.delay_seconds == 300
    assert r.departure_hour == 10
    assert r.is_weekend is False
    assert r.weekday_number == 5  # Thursday with 1 = Sunday (T7)
    assert r.aimed_departure_utc == dt.datetime(2026, 9, 17, 8, 0)  # offset honoured (T2)
    assert r.collected_at_utc == dt.datetime(2026, 9, 17, 8, 0)
    assert r.service_date == dt.date(2026, 9, 17)


def test_null_journey_is_filtered(spark):
    valid, rejects = silver_from_snapshots(snapshots_df(spark, [snapshot([call(journey=None)])]))
    assert valid.count() == 0
    assert [r[REJECT_COLUMN] for r in rejects.collect()] == [MISSING_KEY]


def test_malformed_timestamp_is_rejected_not_fatal(spark):  # T3
    docs = [snapshot([call(expected="garbage"), call(journey="J2")])]
    valid, rejects = silver_from_snapshots(snapshots_df(spark, docs))
    assert valid.count() == 1
    assert [r[REJECT_COLUMN] for r in rejects.collect()] == [BAD_TIMESTAMP]


def test_delay_floors_each_instant_first(spark):  # T4
    docs = [snapshot([call(aimed="2026-09-17T08:00:00.9Z", expected="2026-09-17T08:00:01.1Z")])]
    assert _flat(spark, docs).first().delay_seconds == 1


def test_dates_use_expected_local_time(spark):  # T5
    docs = [snapshot([call(aimed="2026-07-01T22:20:00Z", expected="2026-07-01T22:30:00Z")])]
    r = _flat(spark, docs).first()
    assert r.service_date == dt.date(2026, 7, 2)
    assert r.departure_hour == 0


def test_dst_fall_back_doubles_hour_two(spark):  # T6
    docs = [
        snapshot([call(aimed="2026-10-25T00:30:00Z", expected="2026-10-25T00:30:00Z"),
                  call(journey="J2", aimed="2026-10-25T01:30:00Z", expected="2026-10-25T01:30:00Z")])
    ]
    assert sorted(r.departure_hour for r in _flat(spark, docs).collect()) == [2, 2]


def test_empty_or_missing_calls_give_no_rows(spark):  # N1
    docs = [snapshot([]), snapshot(None)]
    no_stop = snapshot([call()])
    no_stop["data"]["stopPlace"] = None
    docs.append(no_stop)
    assert _flat(spark, docs).count() == 0


def test_dedup_treats_null_quays_as_equal_and_is_deterministic(spark):  # N3
    docs = [snapshot([call(quay=None, expected="2026-09-17T10:05:00+02:00"),
                      call(quay=None, expected="2026-09-17T10:07:00+02:00")])]
    flat = _flat(spark, docs)
    out = [dedup_observations(flat.repartition(2)).collect() for _ in range(3)]
    assert all(len(o) == 1 for o in out)
    assert {o[0].delay_seconds for o in out} == {420}


def test_strict_fields_reject_missing_stop_name(spark):  # N4
    checked = validate(_flat(spark, [snapshot([call()], stop_name=None)], keep_raw=True))
    assert checked.filter(F.col(REJECT_COLUMN).isNotNull()).count() == 1


def test_reader_skips_tmp_files_and_reports_corrupt_ones(spark, tmp_root):  # S-01, N2
    write_landed(tmp_root, snapshot([call()]))
    write_landed(tmp_root, snapshot([call()]), name="2026-09-17/x/partial.json.tmp")
    bad = write_landed(tmp_root, snapshot([call()]), name="2026-09-17/x/broken.json")
    bad.write_text('{"collected_at_utc": "2026-09-17T08:00:00+00:00", "data": {', encoding="utf-8")
    snaps = read_snapshots(spark, tmp_root)
    rows = snaps.collect()
    assert len(rows) == 2
    corrupt = [r for r in rows if r["_corrupt_record"] is not None]
    assert len(corrupt) == 1 and corrupt[0]["source_file"].endswith("broken.json")
    assert flatten_snapshots(snaps).count() == 1


def test_missing_input_path_is_a_clear_error(spark, tmp_root):  # S-03
    import pytest

    with pytest.raises(MissingInputError):
        read_snapshots(spark, tmp_root + "/nope")
