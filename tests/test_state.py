"""Stateful streaming (R-01..R-03), maintained counts (A-03..A-07) and one-pass dashboard views (K-06)."""

import random

import pytest
from pyspark.sql import functions as F

from helpers import call, observations_df, snapshot, write_landed
from quaystat.operators import summaries
from quaystat.operators.flatten import dedup_observations
from quaystat.operators.latest import latest_from_silver
from quaystat.plans import explore, reports
from quaystat.plans.warehouse import compact, load_batch, read_warehouse
from quaystat.schema import COUNTS_KEY
from quaystat.sources.snapshots import read_snapshots
from quaystat.sources.store import VersionedStore
from quaystat.streaming import ingest, state


def _rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)


def _land(raw, rng, n, day=17):
    """Boards collected at any of the day's minutes, in any order, with repeated calls and null quays."""
    for _ in range(n):
        minute = rng.randrange(0, 50)
        calls = [call(journey=f"J{rng.randrange(4)}", expected=f"2026-09-{day}T10:{rng.randrange(10, 59)}:00+02:00", quay=rng.choice([None, ("q:1", "A"), ("q:2", "B")])) for _ in range(3)]
        write_landed(raw, snapshot(calls, collected=f"2026-09-{day}T08:{minute:02d}:00+00:00"), name=f"x/{rng.random()}.json")


@pytest.fixture(scope="module")
def streamed(spark, tmp_path_factory):
    """Seven runs of both streams over one landing folder, each from the checkpoint of the one before."""
    root = str(tmp_path_factory.mktemp("state"))
    rng = random.Random(3)
    latest, dedup = state.latest_table(spark, root + "/latest"), state.dedup_table(spark, root + "/dedup")
    for k in range(7):
        _land(root + "/raw", rng, 2, day=17 - k % 2)
        stream = ingest.snapshot_observations(spark, root + "/raw")
        state.stream_latest(stream, latest, root + "/ck-latest")
        state.stream_dedup(ingest.snapshot_observations(spark, root + "/raw"), dedup, root + "/ck-dedup")
    return root, latest, dedup


def test_streamed_rows_equal_the_batch(spark, streamed):
    root, latest, dedup = streamed
    valid = observations_df_of(spark, root + "/raw")
    assert _rows(dedup.read()) == _rows(dedup_observations(valid))
    want = latest_from_silver(dedup_observations(valid))
    assert _rows(latest.read(), *state.LATEST_KEY, "collected_at_utc", "delay_seconds") == _rows(want, *state.LATEST_KEY, "collected_at_utc", "delay_seconds")


def observations_df_of(spark, raw):
    from quaystat.operators.flatten import flatten_snapshots

    return flatten_snapshots(read_snapshots(spark, raw))


def test_state_holds_one_row_per_key(spark, streamed):  # R-03: state checked through the state data source
    root, latest, dedup = streamed
    for name, table in (("latest", latest), ("dedup", dedup)):
        kept = spark.read.format("statestore").load(f"{root}/ck-{name}")
        assert kept.count() == table.read().count()


def test_versions_of_a_date_are_folded(spark, streamed):
    _, latest, _ = streamed
    body = latest.store.current().body
    assert body["batch"] >= 6 and all(len(vs) <= state.FOLD for vs in body["dates"].values())
    live = {(d, v) for d, vs in body["dates"].items() for v in vs} | {tuple(x) for x in body["old"]}
    stored = {(p.split("/day=")[1].split("/")[0], int(p.rsplit("=", 1)[1])) for p in latest.store.glob("rows/day=*/v=*")}
    assert stored == live


def test_a_replayed_batch_changes_nothing(spark, streamed):
    _, _, dedup = streamed
    before, version = _rows(dedup.read()), dedup.store.current().version
    dedup.upsert(dedup.read().withColumn("delay_seconds", F.lit(7).cast("long")), dedup.store.current().body["batch"])
    assert dedup.store.current().version == version and _rows(dedup.read()) == before


def test_settings_of_the_caller_come_back(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    with state.state_in_rocksdb(spark):
        assert "RocksDB" in spark.conf.get(name)
    assert spark.conf.get(name, None) == before


def test_incremental_etl_rejects_corrupt_files_and_archives(spark, tmp_path):  # N2, S-08
    raw, archive = tmp_path / "raw", tmp_path / "archive"
    paths = [f"{tmp_path}/{n}" for n in ("silver", "rejects", "ck")]
    write_landed(str(raw), snapshot([call()], collected="2026-09-17T08:00:00+00:00"))
    write_landed(str(raw), snapshot([call()]), name="2026-09-17/x/cut.json").write_text('{"collected_at_utc": "2026')
    write_landed(str(raw), snapshot([], collected="2026-09-17T08:10:00+00:00"))
    ingest.run_incremental_etl(spark, str(raw), *paths, archive=str(archive))
    # Late: collected before all that was read.
    write_landed(str(raw), snapshot([call(journey="J2")], collected="2026-09-16T08:00:00+00:00"))
    ingest.run_incremental_etl(spark, str(raw), *paths, archive=str(archive))
    write_landed(str(raw), snapshot([call(journey="J3")], collected="2026-09-17T09:00:00+00:00"))
    ingest.run_incremental_etl(spark, str(raw), *paths, archive=str(archive))
    assert sorted(r.service_journey_id for r in ingest.read_dedup(spark, paths[0]).collect()) == ["J2", "J3", "sj-501"]
    rejects = spark.read.parquet(paths[1]).collect()
    assert [(r.reject_reason, r.source_file.endswith("cut.json")) for r in rejects] == [("corrupt_snapshot", True)]
    left, moved = ({p.name for p in d.rglob("*.json")} for d in (raw, archive))
    assert len(moved) >= 3 and "cut.json" in moved and not left & moved
    assert not list((tmp_path / "rejects-labelled").glob("*"))


def test_a_batch_lists_only_its_own_dates(spark, tmp_path):  # R-02
    sink = ingest.dedup_sink(str(tmp_path / "rows"))
    for n, day in enumerate((15, 16, 17, 17)):
        sink(observations_df(spark, [snapshot([call(), call(journey=f"J{n}")], collected=f"2026-09-{day}T08:00:00+00:00")]), n)
    stored = ingest._stored(spark, str(tmp_path / "rows"), "collected_date", ["2026-09-17"])
    assert all("collected_date=2026-09-17" in f for f in stored.inputFiles()) and stored.count() == 3
    assert ingest.read_dedup(spark, str(tmp_path / "rows")).count() == 7


@pytest.mark.parametrize("seed", range(2))
def test_counts_follow_every_load(spark, tmp_path, seed):
    """Loads that replace estimates, bring old ones, move departures to another day, and repeat; with a compaction between."""
    rng = random.Random(seed)
    store = VersionedStore(spark, str(tmp_path / "wh"))
    docs = []
    for k in range(4):
        new = [
            snapshot(
                [call(journey=f"J{rng.randrange(5)}", expected=f"2026-09-17T{rng.choice(['10:07', '10:12', '23:58'])}:00+02:00", line=rng.choice([("line:1", "1", "A", "bus"), ("line:2", "2", None, "rail")]))],
                collected=f"2026-09-17T08:{rng.randrange(60):02d}:00+00:00", stop_id=f"stop:{rng.randrange(2)}", stop_name="S",
            )
            for _ in range(4)
        ]
        docs += new
        load_batch(spark, observations_df(spark, rng.sample(docs, min(len(docs), 6))), store)
        if k == 2:
            compact(spark, store)
        wh = read_warehouse(spark, store)
        want = wh.latest.groupBy(*COUNTS_KEY).agg(F.count(F.lit(1)).alias("n"))
        assert _rows(reports.current_counts(wh.counts), *COUNTS_KEY, "n") == _rows(want, *COUNTS_KEY, "n")
    counts = reports.current_counts(wh.counts)
    assert _rows(reports.coverage(counts, wh.dim_date, weight="n")) == _rows(reports.coverage(wh.latest, wh.dim_date))
    assert _rows(reports.delay_by_mode(counts, wh.dim_line, weight="n")) == _rows(reports.delay_by_mode(wh.latest, wh.dim_line))
    assert _rows(reports.worst_lines(counts, wh.dim_line, 1, weight="n")) == _rows(reports.worst_lines(wh.latest, wh.dim_line, 1))


def _departures(spark, n):
    rows = spark.range(n)
    i = F.col("id")
    return rows.select(
        (i % 3).alias("stop_key"), F.when(i % 3 != 2, F.lit("same")).otherwise(F.lit("other")).alias("stop_name"), (i % 7).alias("line_key"),
        F.when(i % 7 != 1, (i % 7).cast("string")).alias("line_public_code"), F.lit(None).cast("string").alias("line_name"),
        F.when(i % 5 != 0, F.lit("bus")).alias("transport_mode"), (i % 24).cast("int").alias("departure_hour"),
        F.when(i % 11 != 0, (i * 37 % 400).cast("int")).alias("delay_seconds"),
    )


def test_views_equal_their_summaries(spark):
    departures = _departures(spark, 500)
    views = summaries.dashboard_views(departures)
    for view, columns in summaries.VIEWS.items():
        if columns:
            want = summaries.summarize_delays(departures, columns)
            assert _rows(summaries.view_rows(views, view), *want.columns) == _rows(want), view
    assert _rows(summaries.overview_of(views)) == _rows(summaries.overview(departures).select(*summaries.overview_of(views).columns))
    empty = departures.filter(F.lit(False))
    assert summaries.overview_of(summaries.dashboard_views(empty)).collect() == summaries.overview(empty).collect()


def test_views_read_departures_once(spark, tmp_path):
    _departures(spark, 50).write.parquet(f"{tmp_path}/d")
    plan = summaries.dashboard_views(spark.read.parquet(f"{tmp_path}/d"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    stored = explore.stored_views(spark.read.parquet(f"{tmp_path}/d"))
    assert all("dashboard-views" in f for f in summaries.overview_of(stored).inputFiles())
