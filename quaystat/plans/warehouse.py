"""The star schema (gold): read a published version, or load a batch into it.

Fact layout: Parquet partitioned by ``collected_date`` (= date of
``collected_at_utc``) and the version ``v`` that wrote the rows. The collected
date is fixed by the fact key; ``date_key`` is not (the expected time may move to
another day), which is why it is not the partition column. The latest table is
partitioned by ``aimed_date`` (fixed by the departure key) in the same way.

A load writes its batch once, as a delta beside what is stored: the incoming
rows, already carrying the stored values that a conflict must not change. The
manifest lists for each date the versions that wrote to it. A date with one version
is read as it is; for a date with several the newest version of each key wins.
``compact`` folds the deltas of such dates into one, and ``retain`` deletes what no
kept manifest names. Reads open exactly the listed directories, so planning does
not grow with superseded versions. Dimensions are written in full per version.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quaystat.operators import checks, counts, keys, upsert
from quaystat.operators.candidates import key_bits, may_match
from quaystat.operators.ranking import first_per_group
from quaystat.schema import (
    COUNTS_DDL,
    COUNTS_KEY,
    DEPARTURE_KEY,
    DIM_DATE_DDL,
    DIM_LINE_DDL,
    DIM_QUAY_DDL,
    DIM_STOP_DDL,
    FACT_DDL,
    FACT_KEY,
    LATEST_DDL,
    STAGING_COLUMNS,
)
from quaystat.sources.store import LostRaceError, Manifest, VersionedStore

FACT_COLUMNS = [part.split(" ")[0] for part in FACT_DDL.split(", ")]

DIMENSIONS = {
    "dim_date": DIM_DATE_DDL,
    "dim_stop": DIM_STOP_DDL,
    "dim_quay": DIM_QUAY_DDL,
    "dim_line": DIM_LINE_DDL,
}


@dataclass
class Warehouse:
    dim_date: DataFrame
    dim_stop: DataFrame
    dim_quay: DataFrame
    dim_line: DataFrame
    fact: DataFrame
    latest: DataFrame
    counts: DataFrame | None = None
    manifest: Manifest | None = None
    stats: dict = field(default_factory=dict)


@dataclass
class LoadResult:
    staged_rows: int
    fact_rows: int
    collapsed_rows: int
    version: int


class EmptyLoadError(ValueError):
    """The batch holds no rows; nothing is published."""


class ConstraintError(ValueError):
    """A batch breaks rules of the warehouse; nothing is published. ``path`` holds what it breaks."""

    def __init__(self, message: str, path: str):
        super().__init__(message)
        self.path = path


class StagingConstraintError(ConstraintError):
    """Staged rows break rules of their own."""


class DeltaConstraintError(ConstraintError):
    """The rows to write break keys or references."""


def _empty(spark: SparkSession, ddl: str) -> DataFrame:
    return spark.createDataFrame([], ddl)


def read_warehouse(spark: SparkSession, store: VersionedStore, manifest: Manifest | None = None) -> Warehouse:
    """DataFrames of a published version (the latest by default)."""
    manifest = manifest or store.current()
    if manifest is None:
        tables = {name: _empty(spark, ddl) for name, ddl in DIMENSIONS.items()}
        return Warehouse(fact=_empty(spark, FACT_DDL), latest=_empty(spark, LATEST_DDL), counts=_empty(spark, COUNTS_DDL), **tables)
    body = manifest.body
    tables = {name: spark.read.schema(DIMENSIONS[name]).parquet(path) for name, path in body["tables"].items()}
    fact = _read_versions(spark, store, "fact", body["fact"])
    latest = _read_versions(spark, store, "latest", body["latest"])
    held = _read_versions(spark, store, "counts", body["counts"])
    return Warehouse(fact=fact, latest=latest, counts=held, manifest=manifest, stats=body, **tables)


def latest_between(spark: SparkSession, store: VersionedStore, warehouse: Warehouse, first: int, last: int) -> DataFrame:
    """Latest estimates whose ``date_key`` can lie in first..last: partitions that hold none of these are not read.

    Ranking is by departure, and a departure has one aimed date, so choosing aimed dates before it is safe.
    """
    body = warehouse.stats
    if not body:
        return warehouse.latest
    days = [d for d, (lo, hi) in body["latest_dates"].items() if lo <= last and hi >= first]
    return _read_versions(spark, store, "latest", body["latest"], days)


VERSION_COLUMN = "v"


@dataclass(frozen=True)
class Layout:
    """A table of dated versions: its columns, date partition, key, which row of a key is current, and
    the columns that files are sorted by and carry Bloom filters for, so that filters on them skip pages and row groups."""

    ddl: str
    date_column: str
    key: Sequence[str]
    order: Sequence[str]
    cluster: Sequence[str] = ()

    @property
    def columns(self) -> list[str]:
        return [part.split(" ")[0] for part in self.ddl.split(", ")]

    def newest_first(self) -> list[Column]:
        return [F.col(c).desc() for c in self.order]


LAYOUTS = {
    "fact": Layout(FACT_DDL, "collected_date", FACT_KEY, [VERSION_COLUMN], ["line_key", "stop_key"]),
    "latest": Layout(LATEST_DDL, "aimed_date", DEPARTURE_KEY, ["collected_at_utc", VERSION_COLUMN, "observation_key"], ["line_key", "stop_key"]),
    "counts": Layout(COUNTS_DDL, "service_day", COUNTS_KEY, [VERSION_COLUMN]),
}


def read_versions(
    spark: SparkSession, store: VersionedStore, table: str, layout: Layout, dates: dict[str, list[int]], days: Sequence[str] | None = None,
    only: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Current rows of the given dates (all by default), from exactly the listed directories.

    ``only`` is a filter on columns of the table's key: it takes all rows of a key or none, so it applies before ranking.
    """
    wanted = {d: vs for d, vs in dates.items() if days is None or d in days}

    def scan(some: dict[str, list[int]]) -> DataFrame:
        root = f"{store.root}/{table}"
        paths = [f"{root}/{layout.date_column}={d}/{VERSION_COLUMN}={v}" for d, vs in some.items() for v in vs]
        rows = spark.read.schema(f"{layout.ddl}, {VERSION_COLUMN} INT").option("basePath", root).parquet(*paths)
        return only(rows) if only else rows

    single = {d: vs for d, vs in wanted.items() if len(vs) == 1}
    several = {d: vs for d, vs in wanted.items() if len(vs) > 1}
    out = scan(single).select(*layout.columns) if single else None
    if several:
        current = first_per_group(scan(several), list(layout.key), layout.newest_first()).select(*layout.columns)
        out = current if out is None else out.unionByName(current)
    return out if out is not None else _empty(spark, layout.ddl)


def append_version(df: DataFrame, store: VersionedStore, table: str, layout: Layout, version: int) -> None:
    """Write rows as this version's directories beside the older ones (never overwrites).

    Rows are clustered by date first, so a date's number of files follows its size and not the
    number of tasks; a date too large for one task is split.
    """
    rows = df.select(*layout.columns).hint("rebalance", layout.date_column).withColumn(VERSION_COLUMN, F.lit(version))
    if layout.cluster:
        rows = rows.sortWithinPartitions(layout.date_column, *layout.cluster)
    writer = rows.write.mode("append").partitionBy(layout.date_column, VERSION_COLUMN)
    for column in layout.cluster:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    writer.parquet(f"{store.root}/{table}")


def _read_versions(spark: SparkSession, store: VersionedStore, table: str, dates: dict[str, list[int]], days: Sequence[str] | None = None) -> DataFrame:
    return read_versions(spark, store, table, LAYOUTS[table], dates, days)


def stored_candidates(spark: SparkSession, store: VersionedStore, table: str, dates: dict[str, list[int]], days: Sequence[str], staging: DataFrame) -> DataFrame:
    """Stored rows of the given dates that a batch can meet: what it can't is left out before any shuffle.

    The bits come from the key's columns that the staging names itself, so no dimension is joined for them.
    """
    columns = [c for c in LAYOUTS[table].key if c in staging.columns]
    bits = key_bits(staging, columns)
    return read_versions(spark, store, table, LAYOUTS[table], dates, days, lambda rows: may_match(rows, bits, columns))


def _append(df: DataFrame, store: VersionedStore, table: str, version: int) -> None:
    append_version(df, store, table, LAYOUTS[table], version)


#: Times a load is built anew when another one published first.
RETRIES = 20


def load_batch(spark: SparkSession, observations: DataFrame, store: VersionedStore, strict: bool = True) -> LoadResult:
    """Upsert one batch of silver observations and publish a new version.

    All-or-nothing: tables become visible only when the manifest is published at the very
    end, and only if no other load published meanwhile; else this one is built anew on what
    that one left. A batch that breaks a rule is refused: the broken rows or keys are stored
    beside the version that wasn't published, and the error names the place. Without
    ``strict``, rows that break a rule of their own are left out instead.

    The batch is read three times with pruned columns (a guard pass, the natural keys, the
    fact rows), so hand over stored observations rather than an expensive plan.
    """
    staging = observations.select(*STAGING_COLUMNS)
    whole = F.size(checks.broken_rules()) == 0
    if not strict:
        staging = staging.filter(whole)
    # Dates only: bounded by the days a batch spans.
    shape = staging.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~whole).alias("bad"),
        F.collect_set("service_date").alias("service"),
        F.collect_set(F.to_date("collected_at_utc")).alias("collected"),
        F.collect_set(F.to_date("aimed_departure_utc")).alias("aimed"),
    ).first()
    if shape["bad"]:
        broken = staging.withColumn("rules", checks.broken_rules()).filter(F.size("rules") > 0)
        path, rules = _refuse(broken, store, store.claim(), F.col("rules"))
        raise StagingConstraintError(f"{shape['bad']} staged rows break rules of the warehouse ({rules}); see {path}", path)
    if not shape["rows"]:
        raise EmptyLoadError("no staged rows; previous version left in place")
    for _ in range(RETRIES):
        try:
            return _upsert_and_publish(spark, staging, shape, store)
        except LostRaceError as e:
            lost = e
    raise lost


def _refuse(broken: DataFrame, store: VersionedStore, version: int, rules: Column) -> tuple[str, str]:
    """Store what a refused batch breaks; its path and the names of the rules."""
    path = store.table_path(version, "refused")
    broken.write.parquet(path)
    names = broken.sparkSession.read.parquet(path).select(F.explode(rules).alias("rule")).distinct().orderBy("rule").collect()
    return path, ", ".join(r["rule"] for r in names)


def _upsert_and_publish(spark: SparkSession, staging: DataFrame, shape, store: VersionedStore) -> LoadResult:
    current = store.current()
    old = read_warehouse(spark, store, current)
    prev = current.body if current else {"tables": {}, "max_keys": {}, "fact": {}, "fact_rows": 0, "latest": {}, "counts": {}}
    version = store.claim()  # after reading the current version, so later versions have higher numbers
    days, aimed_days = ({str(d) for d in shape[c]} for c in ("collected", "aimed"))

    def write(df: DataFrame, name: str, schema: str | None = None) -> DataFrame:
        path = store.table_path(version, name)
        df.write.mode("errorifexists").parquet(path)
        return spark.read.schema(schema or df.schema).parquet(path)

    tables, max_keys, dims, changed = _dimensions(spark, staging, shape["service"], old, prev, store, version, write)

    # The delta is stored once without ids: then one count per task says where each task's ids begin.
    rows = upsert.fact_rows(staging, dims["dim_date"], dims["dim_stop"], dims["dim_line"], dims["dim_quay"])
    known = [d for d in days if d in prev["fact"]]
    stored = stored_candidates(spark, store, "fact", prev["fact"], known, staging) if known else None
    delta = write(keys.placed(upsert.fact_delta(rows, stored)), "delta")
    sizes, spans = _delta_counts(delta, prev)
    violations = write(checks.delta_violations(delta, dims, changed), "violations")
    if not violations.isEmpty():
        path = store.table_path(version, "violations")
        rules = ", ".join(r["rule"] for r in violations.select("rule").distinct().orderBy("rule").collect())
        raise DeltaConstraintError(f"the batch breaks rules of the warehouse ({rules}); see {path}", path)
    start = max_keys.get("fact", 0)
    delta = keys.with_row_ids(delta, "observation_key", start, F.col("_new"))
    _append(delta, store, "fact", version)
    max_keys["fact"] = start + sizes["rows"]
    # Candidates for the latest estimates come from the rows just written, keys included.
    written = _read_versions(spark, store, "fact", {d: [version] for d in days})
    candidates = written.withColumn("aimed_date", F.to_date("aimed_departure_utc"))
    order = [F.col("collected_at_utc").desc(), F.col("observation_key").desc()]
    candidates = first_per_group(candidates, DEPARTURE_KEY, order)
    touched = [d for d in aimed_days if d in prev["latest"]]
    before = stored_candidates(spark, store, "latest", prev["latest"], touched, staging) if touched else None
    # Only estimates that replace the stored one are written; what they replace leaves the counts.
    newer = write(counts.newer_estimates(candidates, before), "newer")
    _append(newer, store, "latest", version)
    changes = write(counts.count_changes(newer), "changes")
    count_days = {str(r["d"]) for r in changes.select(F.to_date(F.col("date_key").cast("string"), "yyyyMMdd").alias("d")).distinct().collect()}
    held = [d for d in count_days if d in prev["counts"]]
    totals = _read_versions(spark, store, "counts", prev["counts"], held) if held else None
    _append(counts.new_totals(changes, totals), store, "counts", version)
    latest_days = {str(r["aimed_date"]) for r in newer.select("aimed_date").distinct().collect()}

    def add(table: str, new: set[str]) -> dict[str, list[int]]:
        return {**prev[table], **{d: [*prev[table].get(d, []), version] for d in sorted(new)}}

    body = {
        "tables": tables,
        "fact": add("fact", days),
        "fact_rows": prev["fact_rows"] + sizes["new"],
        "latest": add("latest", latest_days),
        "counts": add("counts", count_days),
        "latest_dates": spans,
        "max_keys": max_keys,
        "staged_rows": shape["rows"],
    }
    store.publish(version, body, base=current.version if current else 0)
    for name in ("delta", "newer", "changes"):  # they only served the load
        store.delete(f"v{version}/{name}")
    return LoadResult(shape["rows"], body["fact_rows"], shape["rows"] - sizes["rows"], version)


def _dimensions(spark, staging, service_dates, old: Warehouse, prev: dict, store: VersionedStore, version: int, write) -> tuple[dict, dict, dict, list]:
    """Paths, highest keys and frames of the dimensions after a batch, and which were written. One that it doesn't change stays where it is."""
    paths, highest = dict(prev["tables"]), dict(prev["max_keys"])
    frames = {name: getattr(old, name) for name in DIMENSIONS}
    renewed: list[str] = []

    def renew(name: str, df: DataFrame) -> None:
        frames[name] = write(df, name)
        paths[name] = store.table_path(version, name)
        renewed.append(name)

    dates = spark.createDataFrame([(d,) for d in service_dates], "full_date DATE")
    # Stored with its range buckets, from which all three dimensions take dense keys.
    newest = upsert.newest_attributes(staging).repartitionByRange("dim", "nk")
    newest = write(newest.withColumn("bucket", F.spark_partition_id()), "natural_keys")
    natural = {
        "stop": old.dim_stop, "line": old.dim_line,
        "quay": old.dim_quay.join(old.dim_stop.select("stop_key", "stop_place_id"), "stop_key"),
    }
    fresh_dates = dates.join(old.dim_date, "full_date", "left_anti").select(F.lit("date").alias("dim")).groupBy("dim").agg(F.count(F.lit(1)).alias("changes"))
    changed = {r["dim"] for r in upsert.changed_dimensions(newest, natural).unionByName(fresh_dates).collect()}
    if "date" in changed:
        renew("dim_date", upsert.upsert_dim_date(old.dim_date, dates))
    for dim in ("stop", "line"):
        if dim in changed:
            nk, attrs = upsert.NATURAL[dim]
            incoming = upsert.incoming_dimension(newest, dim)
            renew(f"dim_{dim}", upsert.upsert_dimension(frames[f"dim_{dim}"], incoming, nk, f"{dim}_key", attrs, highest.get(dim, 0)))
    if "quay" in changed:
        renew("dim_quay", upsert.upsert_dim_quay(old.dim_quay, upsert.incoming_dimension(newest, "quay"), frames["dim_stop"], highest.get("quay", 0)))
    tops = [frames[f"dim_{d}"].select(F.lit(d).alias("dim"), F.col(f"{d}_key").alias("key")) for d in sorted(changed - {"date"})]
    if tops:
        top = reduce(DataFrame.unionByName, tops).groupBy("dim").agg(F.max("key").alias("top"))
        highest.update({r["dim"]: r["top"] for r in top.collect()})
    for name in DIMENSIONS:  # a first load without quays has an empty dimension all the same
        if name not in paths:
            renew(name, frames[name])
    return paths, highest, frames, renewed


def _delta_counts(delta: DataFrame, prev: dict) -> tuple[dict, dict]:
    """Rows and new rows of a delta, and which service dates each aimed date can hold, so that date filters choose partitions."""
    spans = {d: list(r) for d, r in prev.get("latest_dates", {}).items()}
    by_day = delta.groupBy(F.to_date("aimed_departure_utc").alias("day")).agg(
        F.min("date_key").alias("lo"), F.max("date_key").alias("hi"), F.count(F.lit(1)).alias("rows"), F.count_if("_new").alias("new")
    )
    sizes = {"rows": 0, "new": 0}
    for r in by_day.collect():  # one row per day
        lo, hi = spans.get(str(r["day"]), (r["lo"], r["hi"]))
        spans[str(r["day"])] = [min(lo, r["lo"]), max(hi, r["hi"])]
        sizes["rows"] += r["rows"]
        sizes["new"] += r["new"]
    return sizes, spans


def compact(spark: SparkSession, store: VersionedStore, max_versions: int = 1) -> int | None:
    """Fold the deltas of every date with more than ``max_versions`` versions into one new
    version and publish it; returns that version, or None if nothing was to be done.

    Meant for once a day or so: a load itself never rewrites a stored day.
    """
    for _ in range(RETRIES):
        current = store.current()
        body = dict(current.body) if current else {t: {} for t in LAYOUTS}
        many = {t: [d for d, vs in body[t].items() if len(vs) > max_versions] for t in LAYOUTS}
        if not any(many.values()):
            return None
        version = store.claim()
        for table, days in many.items():
            if days:
                _append(_read_versions(spark, store, table, body[table], days), store, table, version)
                body[table] = {**body[table], **{d: [version] for d in days}}
        try:
            store.publish(version, body, base=current.version)
            return version
        except LostRaceError as e:
            lost = e
    raise lost


def retain(store: VersionedStore, keep: int = 1) -> int:
    """Delete the manifests but for the newest ``keep``, and all files that those no longer name;
    returns the number of deleted directories. Run it when no reader uses an older version."""
    versions = store.versions()
    kept = versions[-keep:]
    if not kept:
        return 0
    bodies = [store.manifest(v).body for v in kept]
    paths = {p for b in bodies for p in b["tables"].values()}
    live = {(t, d, v) for b in bodies for t in LAYOUTS for d, vs in b[t].items() for v in vs}
    for v in versions[:-keep]:
        store.delete_manifest(v)
    gone = 0
    for table, layout in LAYOUTS.items():
        for date_dir in store.list_dirs(table):
            for version_dir in store.list_dirs(f"{table}/{date_dir}"):
                day, v = date_dir.split("=", 1)[1], int(version_dir.split("=", 1)[1])
                if v <= kept[-1] and (table, day, v) not in live:
                    gone += store.delete(f"{table}/{date_dir}/{version_dir}")
    for version_dir in store.version_dirs():
        for name in store.list_dirs(f"v{version_dir}"):
            if version_dir <= kept[-1] and store.table_path(version_dir, name) not in paths:
                gone += store.delete(f"v{version_dir}/{name}")
    return gone


def retain_silver(store: VersionedStore, keep: int = 1) -> int:
    """The same for a store of full refreshes, whose versions share no files: older manifests and versions go."""
    versions = store.versions()
    for v in versions[:-keep]:
        store.delete_manifest(v)
    return sum(store.delete(f"v{v}") for v in store.version_dirs() if versions and v < versions[-keep:][0])


def fact_row_count(warehouse: Warehouse) -> int:
    """Number of fact rows of the published version, from its manifest."""
    return int(warehouse.stats.get("fact_rows", 0))
