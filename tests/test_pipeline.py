"""Jobs: ETL from landed files, ordered refresh, streaming = batch (K-*, R-*)."""

import pytest
from pyspark.sql import functions as F

from helpers import call, observations_df, snapshot, write_landed
from quaystat.operators.latest import latest_from_silver
from quaystat.plans import jobs
from quaystat.sources.snapshots import read_snapshots
from quaystat.sources.store import VersionedStore
from quaystat.streaming import ingest


def _land_two_snapshots(root):
    write_landed(root, snapshot([call(), call(journey="J2", quay=None)], collected="2026-09-17T08:00:00+00:00"))
    write_landed(root, snapshot([call(expected="2026-09-17T10:07:00+02:00")], collected="2026-09-17T08:05:00+00:00"))
    write_landed(root, snapshot([call()]), name="2026-09-17/stop_204/inflight.json.tmp")


def test_refresh(spark, tmp_root):  # K-01..K-03
    raw = tmp_root + "/raw"
    _land_two_snapshots(raw)
    silver, gold = tmp_root + "/silver", tmp_root + "/gold"
    etl, load = jobs.refresh(spark, raw, silver, gold)
    assert (etl.raw_count, etl.processed_count, etl.rejected_count) == (2, 3, 0)
    assert load.fact_rows == 3
    assert spark.table("v_latest_departure_estimate").count() == 2
    assert spark.table("v_latest_departure_estimate").filter("delay_seconds = 420").count() == 1


def test_refresh_stops_at_the_first_error(spark, tmp_root):
    raw, silver, gold = tmp_root + "/raw", tmp_root + "/silver", tmp_root + "/gold"
    _land_two_snapshots(raw)
    jobs.refresh(spark, raw, silver, gold)
    write_landed(tmp_root + "/empty", snapshot([]))
    with pytest.raises(jobs.NoObservationsError) as failed:
        jobs.refresh(spark, tmp_root + "/empty", silver, gold)
    assert failed.value.stage == "observations" and "stage 'observations'" in failed.value.__notes__[0]
    assert jobs.read_silver(spark, silver).count() == 3 and spark.table("fact_departure_observation").count() == 3


def test_etl_labels_every_document(spark, tmp_root):  # N1, N2, T3
    raw, silver = tmp_root + "/raw", tmp_root + "/silver"
    write_landed(raw, snapshot([call(), call(journey=None), call(journey="J3", aimed="10:00")]))
    write_landed(raw, snapshot([], collected="2026-09-17T08:10:00+00:00"))
    write_landed(raw, {**snapshot([]), "data": {"stopPlace": None}}, name="2026-09-17/x/null.json")
    (tmp_root_path := write_landed(raw, snapshot([call()]), name="2026-09-17/x/cut.json")).write_text('{"collected_at_utc": "2026')
    got = jobs.run_etl(spark, raw, silver)
    assert (got.raw_count, got.processed_count, got.rejected_count) == (4, 1, 3)
    assert (got.empty_boards, got.null_boards, got.corrupt_files) == (1, 1, 1)
    m = VersionedStore(spark, silver).current().body
    reasons = sorted((r.reject_reason, r.source_file.endswith(tmp_root_path.name)) for r in spark.read.parquet(m["rejects"]).collect())
    assert reasons == [("corrupt_snapshot", True), ("malformed_timestamp", False), ("missing_required_field", False)]


def test_etl_guard_keeps_previous_version(spark, tmp_root):  # U6
    raw, silver = tmp_root + "/raw", tmp_root + "/silver"
    _land_two_snapshots(raw)
    jobs.run_etl(spark, raw, silver)
    empty = tmp_root + "/raw_empty"
    write_landed(empty, snapshot([]))
    with pytest.raises(jobs.NoObservationsError):
        jobs.run_etl(spark, empty, silver)
    assert jobs.read_silver(spark, silver).count() == 3


def test_streaming_latest_takes_late_files(spark, tmp_root):  # R-01, R-03, L1
    raw, out, ck = tmp_root + "/raw", tmp_root + "/latest", tmp_root + "/ck"
    docs = [("2026-09-17T08:10:00+00:00", "09"), ("2026-09-17T08:00:00+00:00", "01"), ("2025-01-01T08:00:00+00:00", "02")]
    for collected, minute in docs:  # newest first, the last months late
        write_landed(raw, snapshot([call(expected=f"2026-09-17T10:{minute}:00+02:00"), call(journey=f"J{minute}")], collected=collected))
        ingest.run_available(ingest.snapshot_observations(spark, raw, 1), ingest.latest_sink(out), ck)
    streamed = ingest.read_latest(spark, out)
    batch = latest_from_silver(jobs.silver_from_snapshots(read_snapshots(spark, raw))[0])
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.select(*streamed.columns).collect()))
    assert {r.service_journey_id: r.delay_seconds for r in streamed.collect()} == {"sj-501": 540, "J09": 300, "J01": 300, "J02": 300}


def test_latest_ties_do_not_follow_row_order(spark, tmp_root):  # N5
    rows = observations_df(spark, [snapshot([call(quay=("q:1", "A")), call(quay=("q:2", "B"), expected="2026-09-17T10:06:00+02:00")])])
    kept = []
    for name, order in (("up", "delay_seconds"), ("down", "-delay_seconds")):
        ingest.latest_sink(f"{tmp_root}/{name}")(rows.orderBy(F.expr(order)), 0)
        kept += [r.delay_seconds for r in ingest.read_latest(spark, f"{tmp_root}/{name}").collect()]
    assert kept == [360, 360]


def test_streaming_dedup_across_batches_and_replays(spark, tmp_root):  # R-02
    out = tmp_root + "/dedup"
    sink = ingest.dedup_sink(out)
    first = observations_df(spark, [snapshot([call(), call(), call(journey="J2", quay=None)])])
    later = observations_df(spark, [snapshot([call(), call(journey="J2", quay=None), call(journey="J3")]), snapshot([call()], collected="2020-01-01T00:00:00+00:00")])
    sink(first, 0)
    sink(later, 1)
    sink(later, 1)
    assert ingest.read_dedup(spark, out).count() == 4


def test_directory_table_as_stream(spark, tmp_root):
    spark.range(100).repartition(5).write.parquet(tmp_root + "/t.parquet")
    seen = []
    ingest.run_available(ingest.stream_table(spark, tmp_root + "/t.parquet", 2), lambda b, n: seen.append(b.count()), tmp_root + "/ck")
    assert sum(seen) == 100 and len(seen) >= 3


def test_micro_batch_upsert_replay_is_harmless(spark, tmp_root):  # R-04
    raw, gold = tmp_root + "/raw", tmp_root + "/gold"
    _land_two_snapshots(raw)
    sink = ingest.upsert_each_batch(spark, gold)
    ingest.run_available(ingest.snapshot_observations(spark, raw), sink, tmp_root + "/ck3")
    from quaystat.plans.warehouse import read_warehouse

    store = VersionedStore(spark, gold)
    before = read_warehouse(spark, store).fact.count()
    silver, _ = jobs.silver_from_snapshots(read_snapshots(spark, raw))
    sink(silver, 0)  # replay the same rows
    assert read_warehouse(spark, store).fact.count() == before == 3
    assert read_warehouse(spark, store).fact.filter(F.col("delay_seconds") == 420).count() == 1


def test_incremental_etl_appends_new_files_only(spark, tmp_root):  # R-01, U5
    raw = tmp_root + "/raw"
    silver, rejects, ck = tmp_root + "/silver", tmp_root + "/rejects", tmp_root + "/ck4"
    write_landed(raw, snapshot([call(), call(journey=None)], collected="2026-09-17T08:00:00+00:00"))
    ingest.run_incremental_etl(spark, raw, silver, rejects, ck)
    write_landed(raw, snapshot([call(journey="J2")], collected="2026-09-17T08:05:00+00:00"))
    ingest.run_incremental_etl(spark, raw, silver, rejects, ck)
    rows = spark.read.parquet(silver)
    assert rows.count() == 2
    assert sorted(r.batch_id for r in rows.select("batch_id").distinct().collect()) == [0, 1]
    assert spark.read.parquet(rejects).count() == 1


def test_views_answer_business_sql(spark, tmp_root):  # S-09, K-05 as SQL
    from quaystat.plans import reports
    from quaystat.plans.warehouse import load_batch, read_warehouse
    from quaystat.sources import testdata

    root = tmp_root + "/gold"
    load_batch(spark, testdata.observations(spark, "/root/testdata/sf0.001"), VersionedStore(spark, root))
    jobs.register_views(spark, root)
    sql = spark.sql(
        """SELECT line.transport_mode, COUNT(*) AS departures,
                  COUNT_IF(estimate.delay_seconds > 180) AS over
           FROM v_latest_departure_estimate AS estimate
           JOIN dim_line AS line ON estimate.line_key = line.line_key
           GROUP BY line.transport_mode"""
    )
    wh = read_warehouse(spark, VersionedStore(spark, root))
    api = {r.transport_mode: r.departures for r in reports.delay_by_mode(wh.latest, wh.dim_line).collect()}
    assert {r.transport_mode: r.departures for r in sql.collect()} == api
