"""User-level jobs: raw -> silver ETL (K-01), silver -> star schema (K-02),
full refresh (K-03), quality report (K-04).

Also builds the whole chain from the shared driver tables (``events`` mapped
to observations) once per session and table directory, so that every
registered query runs over Spark-derived gold tables.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quaystat.operators.flatten import (
    BOARD_COLUMN,
    CORRUPT_FILE,
    EMPTY_BOARD,
    NULL_BOARD,
    REJECT_COLUMN,
    dedup_observations,
    flatten_snapshots,
    is_valid,
    label,
    validate,
)
from quaystat.plans import quality
from quaystat.plans.warehouse import LoadResult, Warehouse, load_batch, read_warehouse
from quaystat.schema import OBSERVATION_COLUMNS, OBSERVATION_DDL
from quaystat.session import scratch_path
from quaystat.sources import testdata
from quaystat.sources.boards import land_boards, snapshots_from_observations
from quaystat.sources.snapshots import read_snapshots
from quaystat.sources.store import VersionedStore


class NoSnapshotsError(ValueError):
    """No snapshot documents under the input path."""


class NoObservationsError(ValueError):
    """Snapshots were read but no valid observation came out."""


@dataclass
class EtlResult:
    raw_count: int
    processed_count: int
    rejected_count: int
    version: int
    empty_boards: int = 0
    null_boards: int = 0
    corrupt_files: int = 0


def silver_from_snapshots(snapshots: DataFrame, strict_fields: bool = True) -> tuple[DataFrame, DataFrame]:
    """(valid deduplicated observations, rejects with reason) from snapshots."""
    checked = validate(flatten_snapshots(snapshots, keep_raw=True), strict_fields)
    valid = dedup_observations(checked.filter(F.col(REJECT_COLUMN).isNull()).select(*OBSERVATION_COLUMNS))
    rejects = checked.filter(F.col(REJECT_COLUMN).isNotNull())
    return valid, rejects


def run_etl(spark: SparkSession, raw_path: str, silver_root: str, strict_fields: bool = True) -> EtlResult:
    """Raw JSON -> silver Parquet partitioned by service date (full refresh).

    The documents are parsed once, into a labelled table (calls, rejects, boards without
    calls); observations and rejects are split from that. All is counted while it is
    written and guarded before it is published: with zero snapshots or zero valid rows
    nothing is published and the previous version stays readable.
    """
    store = VersionedStore(spark, silver_root)
    version = store.claim()
    path = {name: store.table_path(version, name) for name in ("labelled", "observations", "rejects")}
    documents, notes, kept, dropped = (Observation() for _ in range(4))
    count = F.count(F.lit(1)).alias("n")
    snapshots = read_snapshots(spark, raw_path).observe(documents, count)
    labelled = label(flatten_snapshots(snapshots, keep_raw=True, keep_empty=True), strict_fields)
    by_note = [F.count_if(F.col(BOARD_COLUMN) == n).alias(n) for n in (EMPTY_BOARD, NULL_BOARD, CORRUPT_FILE)]
    labelled.observe(notes, *by_note).write.mode("errorifexists").parquet(path["labelled"])
    if documents.get["n"] == 0:
        raise NoSnapshotsError(f"nothing to process: no *.json document below {raw_path}")
    rows = spark.read.schema(labelled.schema).parquet(path["labelled"])
    valid = dedup_observations(rows.filter(is_valid()).select(*OBSERVATION_COLUMNS)).observe(kept, count)
    valid.hint("rebalance", "service_date").write.mode("errorifexists").partitionBy("service_date").parquet(path["observations"])
    if kept.get["n"] == 0:
        raise NoObservationsError(f"no call among {documents.get['n']} documents passed validation; see {path['labelled']}")
    rejects = rows.filter(F.col(REJECT_COLUMN).isNotNull()).select("source_file", REJECT_COLUMN, "raw_collected_at", "service_journey_id")
    rejects.observe(dropped, count).write.mode("errorifexists").parquet(path["rejects"])
    boards = notes.get
    result = EtlResult(documents.get["n"], kept.get["n"], dropped.get["n"], version, boards[EMPTY_BOARD], boards[NULL_BOARD], boards[CORRUPT_FILE])
    store.publish(version, {"observations": path["observations"], "rejects": path["rejects"], "counts": vars(result)})
    store.delete(f"v{version}/labelled")  # it only served the split
    return result


def read_silver(spark: SparkSession, silver_root: str) -> DataFrame:
    m = VersionedStore(spark, silver_root).current()
    if m is None:
        raise FileNotFoundError(f"no published silver version in {silver_root}")
    return spark.read.schema(OBSERVATION_DDL).parquet(m.body["observations"])


def load_warehouse(spark: SparkSession, silver: DataFrame, warehouse_root: str, strict: bool = True) -> LoadResult:
    """Load a batch; views registered over this warehouse then show the new version."""
    result = load_batch(spark, silver, VersionedStore(spark, warehouse_root), strict=strict)
    if _VIEWED.get(spark.sparkContext.applicationId) == warehouse_root:
        register_views(spark, warehouse_root)
    return result


# The warehouse's table and view names.
VIEW_NAMES = {
    "dim_date": "dim_date",
    "dim_stop": "dim_stop",
    "dim_quay": "dim_quay",
    "dim_line": "dim_line",
    "fact": "fact_departure_observation",
    "latest": "v_latest_departure_estimate",
}


#: The warehouse that each application's views lie over.
_VIEWED: dict[str, str] = {}


def sql(spark: SparkSession, warehouse_root: str, text: str) -> DataFrame:
    """A query over the views, on the version that is published when it is asked: also one from another application."""
    register_views(spark, warehouse_root)
    return spark.sql(text)


def register_views(spark: SparkSession, warehouse_root: str) -> dict[str, DataFrame]:
    """Expose the current gold version under the warehouse's names, so the
    analysis can also be written as Spark SQL. The latest view is the
    materialised table (same rows as the window over the fact)."""
    wh = current_warehouse(spark, warehouse_root)
    frames = {
        "dim_date": wh.dim_date,
        "dim_stop": wh.dim_stop,
        "dim_quay": wh.dim_quay,
        "dim_line": wh.dim_line,
        "fact": wh.fact,
        "latest": wh.latest.drop("aimed_date"),
    }
    for key, df in frames.items():
        df.createOrReplaceTempView(VIEW_NAMES[key])
    _VIEWED[spark.sparkContext.applicationId] = warehouse_root
    return frames


def refresh(spark: SparkSession, raw_path: str, silver_root: str, warehouse_root: str) -> tuple[EtlResult, LoadResult]:
    """Raw snapshots to silver, silver to gold, views over gold; an error stops it where it occurs,
    with what was published before still in place. The error keeps its type and names the stage (``stage`` and a note)."""
    done = {}
    stages: dict[str, Callable[[], object]] = {
        "observations": lambda: run_etl(spark, raw_path, silver_root),
        "warehouse": lambda: load_warehouse(spark, read_silver(spark, silver_root), warehouse_root),
        "views": lambda: register_views(spark, warehouse_root),
    }
    for name, run in stages.items():
        try:
            done[name] = run()
        except Exception as e:
            e.stage = name
            e.add_note(f"the refresh stopped in its stage '{name}'")
            raise
    return done["observations"], done["warehouse"]


def quality_report(observations: DataFrame) -> tuple[DataFrame, DataFrame]:
    return quality.quality_summary(observations), quality.quality_by_mode(observations)


# --- tables built once per application from the shared driver tables ---------------
_BUILT: dict[tuple[str, str, str], str] = {}
_BUILD_LOCK = threading.RLock()  # a table may be built from another


def built(spark: SparkSession, sf_dir: str, name: str, build: Callable[[str], object]) -> str:
    """Path of a derived table, built by ``build(path)`` once per application and table directory."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name)
    with _BUILD_LOCK:
        path = _BUILT.get(key)
        if path is None:
            path = scratch_path(spark, name)
            build(path)
            _BUILT[key] = path
    return path


def warehouse_root_for(spark: SparkSession, sf_dir: str) -> str:
    """Root of a store loaded with the mapped ``events`` observations."""
    load = lambda root: load_batch(spark, testdata.observations(spark, sf_dir), VersionedStore(spark, root))
    return built(spark, sf_dir, "warehouse", load)


def snapshots_for(spark: SparkSession, sf_dir: str, dirty: bool = False) -> DataFrame:
    """Nested snapshots of the mapped observations, as a stored table."""
    obs = lambda: snapshots_from_observations(testdata.observations(spark, sf_dir, dirty=dirty))
    return spark.read.parquet(built(spark, sf_dir, f"snapshots-{dirty}", lambda p: obs().write.parquet(p)))


def json_lines_for(spark: SparkSession, sf_dir: str) -> str:
    """The same snapshots as JSON Lines files."""
    return built(spark, sf_dir, "json-lines", lambda p: snapshots_for(spark, sf_dir).write.json(p))


def landed_boards_for(spark: SparkSession, sf_dir: str) -> str:
    """Board snapshots (many calls each, some empty, some without payload) as one file each."""
    return built(spark, sf_dir, "landed", lambda p: land_boards(testdata.observations(spark, sf_dir), p))


_READ: dict[tuple[str, str, int], Warehouse] = {}


def current_warehouse(spark: SparkSession, root: str) -> Warehouse:
    """Gold DataFrames of the current published version, reused while that
    version stays current (a new publish changes the key)."""
    store = VersionedStore(spark, root)
    manifest = store.current()
    key = (spark.sparkContext.applicationId, root, manifest.version if manifest else 0)
    wh = _READ.get(key)
    if wh is None:
        wh = _READ[key] = read_warehouse(spark, store, manifest)
    return wh


def warehouse_for(spark: SparkSession, sf_dir: str) -> Warehouse:
    return current_warehouse(spark, warehouse_root_for(spark, sf_dir))


def two_batch_warehouse_root_for(spark: SparkSession, sf_dir: str) -> str:
    """Two loads into one store: every mapped observation, then a batch with
    updates, new keys on stored dates and new keys on a fresh date."""

    def load(root: str) -> None:
        store = VersionedStore(spark, root)
        load_batch(spark, testdata.observations(spark, sf_dir), store)
        load_batch(spark, testdata.second_batch(spark, sf_dir), store)

    return built(spark, sf_dir, "warehouse-two-batch", load)
