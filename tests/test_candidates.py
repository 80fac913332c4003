"""Runtime filter of stored rows by a batch's keys (J-10), landing names (S-08), views that follow (S-09)."""

import datetime as dt
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from helpers import call, observations_df, snapshot
from quaystat.operators import candidates
from quaystat.plans import jobs
from quaystat.plans.warehouse import load_batch, read_warehouse, stored_candidates
from quaystat.schema import STAGING_COLUMNS
from quaystat.sources import testdata
from quaystat.sources.boards import board_observations, land_boards
from quaystat.sources.snapshots import read_snapshots
from quaystat.sources.store import VersionedStore

TINY = "/root/testdata/sf0.001"


@pytest.mark.parametrize("bits", [candidates.BITS, 1 << 17, 1])
def test_no_partner_is_lost(spark, monkeypatch, bits):
    monkeypatch.setattr(candidates, "BITS", bits)
    key = ["a", "b"]
    stored = spark.range(20_000).select((F.col("id") % 500).alias("a"), F.when(F.col("id") % 7 > 0, F.col("id").cast("string")).alias("b"))
    batch = stored.where("a < 5").unionByName(spark.range(50).select(F.col("id").alias("a"), F.lit("new").alias("b")))
    passed = candidates.may_match(stored, candidates.key_bits(batch, key), key)
    assert passed.columns == key
    wanted = stored.where("a < 5")
    assert wanted.exceptAll(passed).count() == 0
    n, n_wanted = passed.count(), wanted.count()
    assert n == 20_000 if bits == 1 else n_wanted <= n < n_wanted + 200
    assert candidates.key_bits(batch, key).count() <= -(-bits // 32768)


def test_empty_batch_and_empty_store(spark):
    rows = spark.range(10).select("id")
    assert candidates.may_match(rows, candidates.key_bits(rows.limit(0), ["id"]), ["id"]).count() == 0
    assert candidates.may_match(rows.limit(0), candidates.key_bits(rows, ["id"]), ["id"]).count() == 0


def test_a_load_ranks_and_shuffles_only_candidates(spark, tmp_root):  # J-10
    store = VersionedStore(spark, tmp_root + "/wh")
    calls = [call(journey=f"J{i}") for i in range(200)]
    for minute in (0, 5):  # two versions of one day: its rows are ranked before the join
        load_batch(spark, observations_df(spark, [snapshot(calls, collected=f"2026-09-17T08:0{minute}:00+00:00")]), store)
    again = [call(journey="J3", expected="2026-09-17T10:09:00+02:00"), call(journey="J999")]
    obs = observations_df(spark, [snapshot(again, collected="2026-09-17T08:05:00+00:00")])
    fact = store.current().body["fact"]
    left = stored_candidates(spark, store, "fact", fact, list(fact), obs.select(*STAGING_COLUMNS))
    assert [r["service_journey_id"] for r in left.collect()] == ["J3"]
    plan = left._jdf.queryExecution().executedPlan().toString()
    semi = plan.index("LeftSemi")
    assert plan.index("Window") < semi and "Exchange hashpartitioning(collected_at_utc" in plan[:semi]  # filtered below the ranking and its shuffle
    result = load_batch(spark, obs, store)
    wh = read_warehouse(spark, store)
    assert result.fact_rows == wh.fact.count() == 401
    delays = {(r["collected_at_utc"].minute, r["service_journey_id"]): r["delay_seconds"] for r in wh.fact.collect()}
    assert delays[5, "J3"] == 540 and delays[0, "J3"] == delays[5, "J4"] == 300
    latest = {r["service_journey_id"]: r["delay_seconds"] for r in wh.latest.collect()}
    assert len(latest) == 201 and latest["J3"] == 540 and latest["J4"] == 300


def test_landed_names(spark, tmp_path):  # S-08
    obs = testdata.observations(spark, TINY)
    boards = board_observations(obs).select("collected_at_utc", "stop_place_id").distinct().collect()
    raw = tmp_path / "raw"
    assert land_boards(obs, str(raw)) == len(boards)
    expected = {f"{r[0]:%Y-%m-%d}/{r[1].replace(':', '_')}/{r[0]:%Y%m%dT%H%M%S}Z.json" for r in boards}
    assert {str(p.relative_to(raw)) for p in raw.rglob("*") if p.is_file()} == expected
    one = Path(raw, min(expected))
    assert dt.datetime.fromisoformat(json.loads(one.read_text())["collected_at_utc"]).strftime("%Y%m%dT%H%M%SZ.json") == one.name
    land_boards(obs, str(raw))  # again: the same files
    assert read_snapshots(spark, str(raw)).count() == len(boards)


def test_views_follow_the_published_version(spark, tmp_root):  # S-09
    root, ask = tmp_root + "/wh", "SELECT count(*) AS n FROM v_latest_departure_estimate"
    jobs.load_warehouse(spark, observations_df(spark, [snapshot([call()])]), root)
    jobs.register_views(spark, root)
    assert spark.sql(ask).first()["n"] == 1
    jobs.load_warehouse(spark, observations_df(spark, [snapshot([call(journey="J2")])]), root)
    assert spark.sql(ask).first()["n"] == 2
    load_batch(spark, observations_df(spark, [snapshot([call(journey="J3")])]), VersionedStore(spark, root))  # as if by another application
    assert jobs.sql(spark, root, ask).first()["n"] == 3
