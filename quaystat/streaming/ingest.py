"""Incremental processing of recurring snapshots (Structured Streaming).

* R-01 ``snapshot_observations``: new snapshot files -> valid observations.
* R-02 ``dedup_sink``: rows whose dedup key was not stored before (``state.stream_dedup`` keeps them in state).
* R-03 ``latest_sink``: newest rows per departure and batch (``state.stream_latest`` keeps them in state).
* R-04 ``upsert_each_batch``: every micro-batch is loaded into the star schema
  (replaying a batch is harmless: conflicts resolve on natural keys).

Here the sinks' state lives in stored tables, by date and then by micro-batch, and not behind
a watermark: a snapshot that arrives late, in whatever order, counts as if it had
come in time. A replayed batch overwrites its own directories, so a restart never
repeats a row; only the dates that a batch touches are listed and read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaystat.operators.flatten import (
    REJECT_COLUMN,
    dedup_observations,
    flatten_snapshots,
    is_valid,
    label,
    validate,
)
from quaystat.operators.latest import newest_first
from quaystat.operators.ranking import first_per_group
from quaystat.plans.warehouse import load_batch
from quaystat.schema import DEDUP_KEY, OBSERVATION_COLUMNS, OBSERVATION_DDL
from quaystat.sources.snapshots import path_exists, remove_path, stream_snapshots
from quaystat.sources.store import VersionedStore

Sink = Callable[[DataFrame, int], None]

LATEST_KEY = ["stop_place_id", "service_journey_id", "aimed_departure_utc"]


def snapshot_observations(spark: SparkSession, raw_path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Valid observations from newly landed snapshot files."""
    snaps = stream_snapshots(spark, raw_path, max_files_per_trigger)
    checked = validate(flatten_snapshots(snaps, keep_raw=True))
    return checked.filter(REJECT_COLUMN + " IS NULL").select(*OBSERVATION_COLUMNS)


def _stored(spark: SparkSession, path: str, date_column: str, days: list[str] | None = None) -> DataFrame:
    """Stored rows, of the given days only if there are any named: then no other day is listed."""
    paths = [path] if days is None else [f"{path}/{date_column}={d}" for d in days]
    paths = [p for p in paths if path_exists(spark, p)]
    schema = f"{OBSERVATION_DDL}, batch_id BIGINT, {date_column} DATE"
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*paths)


def _store_batch(rows: DataFrame, path: str, date_column: str, batch_id: int) -> None:
    """Write a micro-batch below its dates; a replay replaces what the first try wrote there."""
    named = rows.hint("rebalance", date_column).withColumn("batch_id", F.lit(batch_id).cast("long"))
    named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(date_column, "batch_id").parquet(path)


def latest_sink(path: str) -> Sink:
    """Keep the newest row of each departure of every micro-batch under ``path``, by aimed date.

    A batch is written once and no stored row is touched; ``read_latest`` ranks what the batches hold.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        newest = first_per_group(batch, LATEST_KEY, newest_first(OBSERVATION_COLUMNS, LATEST_KEY))
        _store_batch(newest.withColumn("aimed_date", F.to_date("aimed_departure_utc")), path, "aimed_date", batch_id)

    return sink


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    """Latest estimate of every departure over all micro-batches; filters on the aimed date prune the scan."""
    stored = _stored(spark, path, "aimed_date")
    # The aimed date follows from the key, so ranking within it is the same and lets date filters through.
    key = ["aimed_date", *LATEST_KEY]
    return first_per_group(stored, key, newest_first(OBSERVATION_COLUMNS, key)).select(*OBSERVATION_COLUMNS)


def dedup_sink(path: str) -> Sink:
    """Store rows whose (collected, stop, journey, quay, aimed) no earlier batch stored, by collected date.

    Earlier rows are looked up on the batch's own dates only, which are all that is listed.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        own = dedup_observations(batch.select(*OBSERVATION_COLUMNS))
        own = own.withColumn("collected_date", F.to_date("collected_at_utc"))
        days = [str(r["d"]) for r in batch.select(F.to_date("collected_at_utc").alias("d")).distinct().collect()]  # a row per day
        earlier = _stored(spark, path, "collected_date", days).filter(F.col("batch_id") < batch_id)
        same = earlier["collected_date"] == own["collected_date"]
        for c in DEDUP_KEY:
            same &= earlier[c].eqNullSafe(own[c])
        _store_batch(own.join(earlier, same, "left_anti"), path, "collected_date", batch_id)

    return sink


def read_dedup(spark: SparkSession, path: str) -> DataFrame:
    return _stored(spark, path, "collected_date").select(*OBSERVATION_COLUMNS)


def upsert_each_batch(spark: SparkSession, warehouse_root: str) -> Sink:
    store = VersionedStore(spark, warehouse_root)

    def sink(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            load_batch(spark, batch, store)

    return sink


def run_available(stream: DataFrame, sink: Sink, checkpoint: str) -> None:
    """Process everything available now, then stop (restartable from ``checkpoint``)."""
    query = (
        stream.writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def stream_table(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Files of a Parquet table (a directory, part files at any depth) as a stream."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema).option("recursiveFileLookup", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def silver_batches_sink(silver_path: str, rejects_path: str) -> Sink:
    """foreachBatch sink for the incremental ETL: the labelled batch is stored while
    it is split. Rejects, corrupt files among them, go to their own folder by batch, and valid rows through
    ``dedup_sink``, so a call seen again in a later batch is stored once."""
    store_valid = dedup_sink(silver_path)

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        labelled = f"{rejects_path}-labelled/batch_id={batch_id}"
        batch.write.mode("overwrite").parquet(labelled)
        checked = spark.read.schema(batch.schema).parquet(labelled)
        store_valid(checked.filter(is_valid()), batch_id)
        checked.filter(F.col(REJECT_COLUMN).isNotNull()).select(
            "source_file", REJECT_COLUMN, "raw_collected_at", "service_journey_id"
        ).write.mode("overwrite").parquet(f"{rejects_path}/batch_id={batch_id}")
        remove_path(spark, labelled)

    return sink


def run_incremental_etl(
    spark: SparkSession, raw_path: str, silver_path: str, rejects_path: str, checkpoint: str,
    max_files_per_trigger: int | None = None, archive: str | None = None,
) -> None:
    """Process the snapshot files that landed since the last run (the polling
    loop's output) into silver, then stop. Restartable from ``checkpoint``. With ``archive`` files that are
    done move out of the landing folder."""
    snaps = stream_snapshots(spark, raw_path, max_files_per_trigger, archive)
    checked = label(flatten_snapshots(snaps, keep_raw=True, keep_empty=True))
    run_available(checked, silver_batches_sink(silver_path, rejects_path), checkpoint)
