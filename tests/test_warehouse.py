"""Star-schema load: upserts, keys, publish (ledger U*, N5, N6, L1, L2)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import call, observations_df, snapshot
from quaystat.operators import checks
from quaystat.operators.keys import parts_ahead, placed, with_dense_keys, with_row_ids
from quaystat.operators.latest import latest_estimates
from quaystat.plans import explore
from quaystat.plans.warehouse import (
    LAYOUTS,
    DeltaConstraintError,
    EmptyLoadError,
    StagingConstraintError,
    append_version,
    compact,
    fact_row_count,
    latest_between,
    load_batch,
    read_warehouse,
    retain,
    retain_silver,
)
from quaystat.schema import FACT_KEY
from quaystat.sources.store import LostRaceError, VersionedStore


def _store(spark, tmp_root):
    return VersionedStore(spark, tmp_root + "/wh")


def _rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_reload_updates_only_four_columns(spark, tmp_root):  # U1
    store = _store(spark, tmp_root)
    load_batch(spark, observations_df(spark, [snapshot([call()])]), store)
    before = read_warehouse(spark, store).fact.first()
    moved = snapshot([call(expected="2026-09-18T00:30:00+02:00", realtime=False, quay=("quay:32", "P2"),
                           destination="Elsewhere")])
    load_batch(spark, observations_df(spark, [moved]), store)
    wh = read_warehouse(spark, store)
    after = wh.fact.first()
    assert wh.fact.count() == 1
    assert after.delay_seconds == 52200 and after.realtime is False
    assert after.expected_departure_utc == dt.datetime(2026, 9, 17, 22, 30)
    for col in ("date_key", "departure_hour", "quay_key", "line_key", "destination", "observation_key"):
        assert after[col] == before[col], col
    assert wh.dim_date.count() == 2  # the new service date is still inserted
    assert [(r.delay_seconds, r.date_key) for r in wh.latest.collect()] == [(52200, before.date_key)]


def test_dimensions_overwrite_including_nulls(spark, tmp_root):  # U2
    store = _store(spark, tmp_root)
    load_batch(spark, observations_df(spark, [snapshot([call()])]), store)
    later = snapshot([call(line=("line:8", "8X", None, "rail"))], collected="2026-09-17T09:00:00+00:00",
                     stop_id="stop:377", stop_name="Other")
    load_batch(spark, observations_df(spark, [later]), store)
    wh = read_warehouse(spark, store)
    assert wh.dim_line.first().line_name is None
    quay = wh.dim_quay.first()
    stop2 = wh.dim_stop.filter("stop_place_id = 'stop:377'").first()
    assert quay.stop_key == stop2.stop_key
    assert checks.warehouse_fk_violations(wh).count() == 0


def test_load_twice_is_idempotent(spark, tmp_root):  # U3
    store = _store(spark, tmp_root)
    obs = observations_df(spark, [snapshot([call(), call(journey="J2", quay=None)])])
    load_batch(spark, obs, store)
    first = read_warehouse(spark, store)
    snap1 = {t: _rows(getattr(first, t), *getattr(first, t).columns) for t in ("dim_stop", "dim_line", "dim_quay", "fact")}
    load_batch(spark, obs, store)
    second = read_warehouse(spark, store)
    snap2 = {t: _rows(getattr(second, t), *getattr(second, t).columns) for t in ("dim_stop", "dim_line", "dim_quay", "fact")}
    assert snap1 == snap2
    assert checks.warehouse_key_duplicates(second).count() == 0


def test_failed_load_keeps_previous_version(spark, tmp_root):  # U4, U6
    store = _store(spark, tmp_root)
    load_batch(spark, observations_df(spark, [snapshot([call()])]), store)
    v = store.current().version
    with pytest.raises(EmptyLoadError):
        load_batch(spark, observations_df(spark, [snapshot([])]), store)
    with pytest.raises(StagingConstraintError):
        load_batch(spark, observations_df(spark, [snapshot([call()], stop_name=None)]), store)
    assert store.current().version == v
    assert read_warehouse(spark, store).fact.count() == 1


def test_one_journey_two_quays_collapses(spark, tmp_root):  # N5
    store = _store(spark, tmp_root)
    obs = observations_df(spark, [snapshot([call(), call(quay=("quay:39", "P9"))])])
    assert obs.count() == 2
    res = load_batch(spark, obs, store)
    assert res.collapsed_rows == 1 and res.fact_rows == 1


def test_newest_name_wins(spark, tmp_root):  # N6
    store = _store(spark, tmp_root)
    docs = [snapshot([call()], collected="2026-09-17T08:00:00+00:00", stop_name="Old"),
            snapshot([call()], collected="2026-09-17T09:00:00+00:00", stop_name="New")]
    load_batch(spark, observations_df(spark, docs), store)
    assert read_warehouse(spark, store).dim_stop.first().stop_name == "New"


def test_latest_ignores_load_order(spark, tmp_root):  # L1
    store = _store(spark, tmp_root)
    newer = snapshot([call(expected="2026-09-17T10:09:00+02:00")], collected="2026-09-17T08:05:00+00:00")
    older = snapshot([call(expected="2026-09-17T10:01:00+02:00")], collected="2026-09-17T08:00:00+00:00")
    load_batch(spark, observations_df(spark, [newer]), store)
    load_batch(spark, observations_df(spark, [older]), store)
    wh = read_warehouse(spark, store)
    latest = latest_estimates(wh.fact).collect()
    assert len(latest) == 1 and latest[0].delay_seconds == 540
    assert [r.delay_seconds for r in wh.latest.collect()] == [540]  # materialised, maintained incrementally


def test_filters_apply_after_ranking(spark, tmp_root):  # L2
    store = _store(spark, tmp_root)
    day1 = snapshot([call(expected="2026-09-17T23:50:00+02:00")], collected="2026-09-17T08:00:00+00:00")
    day2 = snapshot([call(expected="2026-09-18T00:10:00+02:00")], collected="2026-09-17T09:00:00+00:00")
    load_batch(spark, observations_df(spark, [day1, day2]), store)
    wh = read_warehouse(spark, store)
    dep = explore.star(latest_estimates(wh.fact), wh.dim_date, wh.dim_stop, wh.dim_line)
    only_day1 = explore.DashboardFilters(start_date=dt.date(2026, 9, 17), end_date=dt.date(2026, 9, 17))
    assert explore.filter_departures(dep, only_day1).count() == 0


def test_keys_dense_and_ordered(spark, tmp_root):  # U-06
    df = spark.range(0, 1000, numPartitions=7).select(F.format_string("k%04d", (999 - F.col("id"))).alias("nk"))
    df.repartitionByRange(5, "nk").withColumn("bucket", F.spark_partition_id()).write.parquet(tmp_root + "/keys")
    keyed = with_dense_keys(spark.read.parquet(tmp_root + "/keys"), "key", "nk", "bucket", 100)
    got = sorted((r.nk, r.key) for r in keyed.collect())
    assert [k for _, k in got] == list(range(101, 1101))


def test_compaction_and_retention(spark, tmp_root):
    store = _store(spark, tmp_root)
    for minute, late in ((0, 5), (5, 7), (10, 9)):
        doc = snapshot([call(expected=f"2026-09-17T10:0{late}:00+02:00"), call(journey=f"J{minute}")], collected=f"2026-09-17T08:{minute:02d}:00+00:00")
        load_batch(spark, observations_df(spark, [doc]), store)
    load_batch(spark, observations_df(spark, [doc]), store)  # replay: nothing new
    before = read_warehouse(spark, store)
    fact, latest = _rows(before.fact, *before.fact.columns), _rows(before.latest, *before.latest.columns)
    assert len(fact) == fact_row_count(before) == 6
    assert before.manifest.body["fact"] == {"2026-09-17": [1, 2, 3, 4]}
    assert compact(spark, store) == 5 and compact(spark, store) is None
    assert retain(store) > 0
    after = read_warehouse(spark, store)
    assert _rows(after.fact, *after.fact.columns) == fact and _rows(after.latest, *after.latest.columns) == latest
    stored = spark.read.option("recursiveFileLookup", True).parquet(store.root + "/fact")
    assert stored.count() == 6 and store.versions() == [5]
    load_batch(spark, observations_df(spark, [doc]), store)
    assert _rows(read_warehouse(spark, store).fact, *before.fact.columns) == fact


def test_date_filter_chooses_partitions(spark, tmp_root):  # F-03
    store = _store(spark, tmp_root)
    days = [snapshot([call(aimed=f"2026-09-{d}T10:00:00+02:00", expected=f"2026-09-{d}T10:05:00+02:00")]) for d in (17, 18, 19)]
    load_batch(spark, observations_df(spark, days), store)
    moved = call(aimed="2026-09-17T10:00:00+02:00", expected="2026-09-19T00:30:00+02:00", journey="J-late")
    load_batch(spark, observations_df(spark, [snapshot([moved])]), store)
    wh = read_warehouse(spark, store)
    some = latest_between(spark, store, wh, 20260919, 20260919)
    assert sorted(r.date_key for r in some.filter("date_key = 20260919").collect()) == [20260919, 20260919]
    assert not any("2026-09-18" in f for f in some.inputFiles())


def test_bad_hour_fails_the_load(spark, tmp_root):  # P-15
    store = _store(spark, tmp_root)
    obs = observations_df(spark, [snapshot([call()])]).withColumn("departure_hour", F.lit(24))
    with pytest.raises(Exception, match="outside 0..23"):
        load_batch(spark, obs, store)
    assert store.current() is None


def test_date_dimension_iso_week_vs_calendar_year(spark, tmp_root):  # T8
    store = _store(spark, tmp_root)
    load_batch(spark, observations_df(spark, [snapshot([call(aimed="2027-01-01T10:00:00+01:00",
                                                              expected="2027-01-01T10:00:00+01:00")])]), store)
    d = read_warehouse(spark, store).dim_date.first()
    assert (d.date_key, d.year, d.week_of_year, d.day_of_week, d.day_name, d.is_weekend) == (
        20270101, 2027, 53, 5, "Friday", False)


def test_retry_after_crash_before_publish(spark, tmp_root):  # U4
    store = _store(spark, tmp_root)
    load_batch(spark, observations_df(spark, [snapshot([call()])]), store)
    # a load that died after writing some tables of version 2, before publishing
    spark.range(1).write.parquet(store.table_path(2, "dim_date"))
    assert store.current().version == 1 and store.next_version() == 3
    load_batch(spark, observations_df(spark, [snapshot([call(journey="J2")])]), store)
    assert store.current().version == 3
    assert read_warehouse(spark, store).fact.count() == 2


def _overtaken(store, other):
    """Let ``other`` run in full just before ``store`` publishes for the first time."""
    publish = store.publish

    def late(*args, **kwargs):
        store.publish = publish
        other()
        return publish(*args, **kwargs)

    store.publish = late
    return store


def _doc(journey, stop, minute=0, **kw):
    return snapshot([call(journey=journey, **kw)], collected=f"2026-09-17T08:{minute:02d}:00+00:00", stop_id=stop, stop_name=stop)


def test_overlapping_loads_keep_both(spark, tmp_root):  # U4
    store = _store(spark, tmp_root)
    load_batch(spark, observations_df(spark, [_doc("J0", "stop:0")]), store)
    one, two = (observations_df(spark, [_doc(j, s), _doc("J0", "stop:0", minute=k, expected=f"2026-09-17T10:0{k}:00+02:00")]) for j, s, k in (("J1", "stop:1", 5), ("J2", "stop:2", 7)))
    first = _overtaken(_store(spark, tmp_root), lambda: load_batch(spark, two, _store(spark, tmp_root)))
    result = load_batch(spark, one, first)
    wh = read_warehouse(spark, store)
    assert result.version == store.current().version and result.fact_rows == wh.fact.count() == 5
    assert _rows(wh.dim_stop, "stop_place_id") == [("stop:0",), ("stop:1",), ("stop:2",)]
    assert sorted(r.delay_seconds for r in wh.latest.join(wh.dim_stop, "stop_key").filter("stop_place_id = 'stop:0'").collect()) == [420]
    assert checks.warehouse_key_duplicates(wh).count() == 0 and checks.warehouse_fk_violations(wh).count() == 0


def test_compaction_overtaken_by_a_load(spark, tmp_root):
    store = _store(spark, tmp_root)
    for minute in (0, 5):
        load_batch(spark, observations_df(spark, [_doc(f"J{minute}", "stop:1", minute)]), store)
    third = observations_df(spark, [_doc("J9", "stop:1", 9)])
    version = compact(spark, _overtaken(_store(spark, tmp_root), lambda: load_batch(spark, third, _store(spark, tmp_root))))
    wh = read_warehouse(spark, store)
    assert store.current().version == version and wh.fact.count() == 3 and wh.manifest.body["fact"] == {"2026-09-17": [version]}


def test_a_commit_without_its_manifest_is_completed(spark, tmp_root):
    store = _store(spark, tmp_root)
    load_batch(spark, observations_df(spark, [_doc("J0", "stop:0")]), store)
    base, body = store.current().version, store.current().body
    # A load committed its version and died before the manifest had its own name.
    dead = store.claim()
    assert store._create(f"_manifests/after-{base}.json", __import__("json").dumps({**body, "version": dead, "staged_rows": 77}))
    assert store.current().version == base
    with pytest.raises(LostRaceError):
        store.publish(store.claim(), body, base=base)
    assert store.current().version == dead and store.current().body["staged_rows"] == 77
    result = load_batch(spark, observations_df(spark, [_doc("J1", "stop:1")]), store)
    assert store.current().version == result.version > dead


def test_claims_are_never_shared(spark, tmp_root):
    stores = [_store(spark, tmp_root) for _ in range(3)]
    numbers = [s.claim() for s in stores * 2]
    assert numbers == sorted(set(numbers))
    assert stores[0]._create("_claims/99", "") and not stores[1]._create("_claims/99", "")


def test_row_ids_with_more_parts_than_any_bit_budget(spark, tmp_root):  # U-06
    counts = spark.range(70_000).select(F.col("id").cast("int").alias("_part"), (F.col("id") % 5 + 2**33).alias("_n"))
    ahead = {r._part: r._ahead for r in parts_ahead(counts).collect()}
    assert len(ahead) == 70_000 and ahead[0] == 0
    assert all(ahead[p + 1] == ahead[p] + p % 5 + 2**33 for p in range(69_999))
    rows = spark.range(0, 1000, numPartitions=11).select("id", F.when(F.col("id") % 3 == 0, F.col("id")).alias("k"), (F.col("id") % 3 != 0).alias("fresh"))
    placed(rows).write.parquet(tmp_root + "/placed")
    got = with_row_ids(spark.read.parquet(tmp_root + "/placed"), "k", 5000, F.col("fresh")).collect()
    fresh = [r.k for r in got if r.id % 3]
    assert len(set(fresh)) == len(fresh) and min(fresh) > 5000 and max(fresh) <= 6000
    assert all(r.k == r.id for r in got if r.id % 3 == 0)


def test_broken_rows_are_refused_and_kept_for_reading(spark, tmp_root):  # P-15
    store = _store(spark, tmp_root)
    load_batch(spark, observations_df(spark, [_doc("J0", "stop:0")]), store)
    good, bad = observations_df(spark, [_doc("J1", "stop:1")]), observations_df(spark, [_doc("J2", "stop:2")])
    batch = good.unionByName(bad.withColumns({"departure_hour": F.lit(24), "delay_seconds": F.lit(2**40), "stop_name": F.lit(None).cast("string")}))
    with pytest.raises(StagingConstraintError) as refused:
        load_batch(spark, batch, store)
    rows = spark.read.parquet(refused.value.path).collect()
    assert [(r.service_journey_id, sorted(r.rules)) for r in rows] == [("J2", ["delay outside the integer range", "hour outside 0..23", "not_null.stop_name"])]
    assert read_warehouse(spark, store).fact.count() == 1
    assert load_batch(spark, batch, store, strict=False).fact_rows == 2


def test_a_dimension_that_broke_refuses_the_next_batch(spark, tmp_root):  # U-08
    store = _store(spark, tmp_root)
    load_batch(spark, observations_df(spark, [_doc("J0", "stop:0")]), store)
    wh = read_warehouse(spark, store)
    extra = wh.dim_line.withColumn("line_key", F.col("line_key") + 100).collect()
    spark.createDataFrame(extra, wh.dim_line.schema).write.mode("append").parquet(wh.manifest.body["tables"]["dim_line"])
    renamed = observations_df(spark, [_doc("J1", "stop:0", line=("line:8", "8X", "Other name", "rail"))])
    with pytest.raises(DeltaConstraintError, match="dim_line.line_id") as refused:
        load_batch(spark, renamed, store)
    assert store.current().version == wh.manifest.version
    assert [(r["rule"], r["key_text"], r["rows"]) for r in spark.read.parquet(refused.value.path).collect()] == [("dim_line.line_id", "line:8", 2)]


def test_unchanged_dimensions_are_not_written(spark, tmp_root):
    store = _store(spark, tmp_root)
    load_batch(spark, observations_df(spark, [_doc("J0", "stop:0")]), store)
    load_batch(spark, observations_df(spark, [_doc("J1", "stop:0", quay=("quay:31", "Renamed"))]), store)
    tables = store.current().body["tables"]
    assert {n: p.split("/")[-2] for n, p in tables.items()} == {"dim_date": "v1", "dim_stop": "v1", "dim_line": "v1", "dim_quay": "v2"}


def _rows_scanned(df):
    """Rows that the scan of an executed plan handed on: those of pages and row groups that weren't skipped."""
    frame = df._jdf
    frame.collectToPython()
    plan = frame.queryExecution().executedPlan()
    while "Scan" not in plan.nodeName():
        plan = plan.executedPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan.children().head()
    return plan.metrics().apply("numOutputRows").value()


def test_line_filter_skips_pages(spark, tmp_root):  # F-04, F-06
    store = _store(spark, tmp_root)
    i = F.col("id")
    rows = spark.range(0, 200_000, numPartitions=4).select(
        i.alias("observation_key"), F.lit(dt.datetime(2026, 9, 17, 8)).cast("timestamp_ntz").alias("collected_at_utc"), F.lit(20260917).alias("date_key"),
        (i * 7919 % 50).alias("stop_key"), F.lit(None).cast("long").alias("quay_key"), (i * 104_729 % 400).alias("line_key"), i.cast("string").alias("service_journey_id"),
        F.lit("x").alias("destination"), F.lit(True).alias("realtime"), *[F.lit(dt.datetime(2026, 9, 17, 9)).cast("timestamp_ntz").alias(f"{c}_departure_utc") for c in ("aimed", "expected", "actual")],
        (i % 600).cast("int").alias("delay_seconds"), F.lit(11).cast("smallint").alias("departure_hour"), F.lit(dt.date(2026, 9, 17)).alias("aimed_date"),
    )
    append_version(rows, store, "latest", LAYOUTS["latest"], 1)
    table = spark.read.parquet(store.root + "/latest")
    assert _rows_scanned(table.filter("line_key >= 0").select("line_key")) == 200_000
    few = table.filter(F.col("line_key").isin(3, 7)).select("line_key")
    assert few.count() == 1000 and _rows_scanned(few) < 100_000
    # Inside the range of values but in no file: the Bloom filter knows.
    odd = rows.filter("line_key % 2 = 0")
    append_version(odd, store, "even", LAYOUTS["latest"], 1)
    assert _rows_scanned(spark.read.parquet(store.root + "/even").filter("line_key = 101").select("line_key")) == 0


def test_silver_retention(spark, tmp_root):
    store = _store(spark, tmp_root)
    for v in (1, 2, 3):
        spark.range(v).write.parquet(store.table_path(v, "observations"))
        store.publish(v, {"observations": store.table_path(v, "observations")})
    assert retain_silver(store, keep=2) == 1 and store.versions() == [2, 3] and store.version_dirs() == [2, 3]


def test_row_ids_leave_stored_rows_where_they_are(spark, tmp_root):  # U-06
    placed(spark.range(3000).withColumn("observation_key", F.lit(None).cast("long"))).write.parquet(tmp_root + "/placed")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if the stored rows were many
    try:
        rows = with_row_ids(spark.read.parquet(tmp_root + "/placed"), "observation_key", 10, F.lit(True))
        assert sorted(r["observation_key"] for r in rows.collect()) == list(range(11, 3011))
        plan = rows._jdf.queryExecution().executedPlan().toString()
        joins = [line for line in plan.splitlines() if "Join " in line and "Join [_part" in line]
        assert joins and all("BroadcastHashJoin" in line for line in joins)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_keys_are_written_as_texts_only_if_one_may_repeat(spark):  # U-08
    key = [f"{k} {'timestamp_ntz' if k.endswith('utc') else 'long' if k == 'stop_key' else 'string'}" for k in FACT_KEY]
    at = dt.datetime(2026, 9, 17, 8)
    schema = ", ".join([*key, *(f"{c} long" for c in checks.FACT_REFERENCES if c not in FACT_KEY)])
    values = {"collected_at_utc": at, "stop_key": 1, "service_journey_id": "J1", "aimed_departure_utc": at}
    row = lambda **new: tuple({**values, **new}.get(c.split(" ")[0], 1) for c in schema.split(", "))
    dims = {t: spark.createDataFrame([(1,)], f"{pk} long") for t, pk in checks.FACT_REFERENCES.values()}
    sound = spark.createDataFrame([row(), row(service_journey_id="J2"), row(service_journey_id=None)], schema)
    assert not checks.may_repeat(sound, FACT_KEY)
    assert checks.delta_violations(sound, dims, []).count() == 0
    for new in ({}, {"service_journey_id": None}):
        twice = sound.unionAll(spark.createDataFrame([row(**new)], schema))
        assert checks.may_repeat(twice, FACT_KEY)
        assert [(r["rule"], r["rows"]) for r in checks.delta_violations(twice, dims, []).collect()] == [("fact.natural", 2)]
