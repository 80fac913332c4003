"""Properties of the load on the mapped shared events (sf0.001),
split into two batches by collection time."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quaystat.functions.time import ntz_literal
from quaystat.operators.latest import latest_estimates
from quaystat.plans.warehouse import load_batch, read_warehouse
from quaystat.sources import testdata
from quaystat.sources.store import VersionedStore

SF = "/root/testdata/sf0.001"
SPLIT = dt.datetime(2024, 1, 16)


def _natural(wh, table):
    """Rows keyed by natural ids instead of surrogate keys."""
    df = getattr(wh, table)
    df = df.join(wh.dim_stop.select("stop_key", "stop_place_id"), "stop_key").join(
        wh.dim_line.select("line_key", "line_id"), "line_key"
    )
    df = df.join(wh.dim_quay.select("quay_key", "quay_id"), "quay_key", "left")
    cols = ["stop_place_id", "line_id", "quay_id", "service_journey_id", "collected_at_utc",
            "aimed_departure_utc", "expected_departure_utc", "delay_seconds", "departure_hour", "date_key",
            "realtime", "destination"]
    return sorted(repr(tuple(r)) for r in df.select(*cols).collect())


@pytest.fixture(scope="module")
def batches(spark):
    obs = testdata.observations(spark, SF)
    split = ntz_literal(SPLIT)  # a datetime literal would be read in the session zone
    return obs.filter(F.col("collected_at_utc") < split), obs.filter(F.col("collected_at_utc") >= split), obs


def _load(spark, root, *parts):
    store = VersionedStore(spark, root)
    for p in parts:
        load_batch(spark, p, store)
    return read_warehouse(spark, store)


def test_split_equals_whole_and_order_does_not_matter(spark, tmp_root, batches):
    a, b, whole = batches
    one = _load(spark, tmp_root + "/one", whole)
    ab = _load(spark, tmp_root + "/ab", a, b)
    ba = _load(spark, tmp_root + "/ba", b, a)
    assert _natural(one, "fact") == _natural(ab, "fact") == _natural(ba, "fact")
    assert _natural(one, "latest") == _natural(ab, "latest") == _natural(ba, "latest")
    # the second load wrote only its own collected dates, beside what was stored
    versions = ab.manifest.body["fact"]
    second_days = {str(r[0]) for r in b.select(F.to_date("collected_at_utc")).distinct().collect()}
    assert {d for d, vs in versions.items() if 2 in vs} == second_days


def test_incremental_latest_equals_full_rank(spark, tmp_root, batches):
    a, b, _ = batches
    wh = _load(spark, tmp_root + "/inc", a, b)
    full = latest_estimates(wh.fact).drop("observation_key")
    stored = wh.latest.drop("observation_key", "aimed_date")
    assert sorted(map(repr, map(tuple, full.collect()))) == sorted(map(repr, map(tuple, stored.select(*full.columns).collect())))
    keys = wh.fact.select("stop_key", "service_journey_id", "aimed_departure_utc").distinct().count()
    assert wh.latest.count() == keys


def test_batch_mixing_stored_and_new_dates(spark, tmp_root, batches):
    a, _, whole = batches
    once = _load(spark, tmp_root + "/once", whole)
    mixed = _load(spark, tmp_root + "/mixed", a, whole)  # second batch: A's dates stored, B's dates new
    assert _natural(once, "fact") == _natural(mixed, "fact")
    assert _natural(once, "latest") == _natural(mixed, "latest")
    keys = mixed.fact.select("observation_key")
    assert keys.distinct().count() == keys.count() == whole.count()
