"""Streaming latest estimate and dedup as stateful aggregates (R-02, R-03).

The stream is grouped by its key, and the state holds the best row of each key under
a total order: so the result doesn't depend on batches, and nothing that comes late is lost, as
there is no watermark. State lies in the RocksDB store with changelog checkpoints: a batch
costs what it changes, whatever came before, and a restart goes on from the checkpoint.

Each micro-batch brings only the keys whose best row changed. They are upserted into a dated
table: written beside the older rows of their dates, newest first; a date with more than ``FOLD``
versions is folded into one, so reading costs no more after many batches.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quaystat.functions.time import epoch_seconds
from quaystat.plans.warehouse import Layout, append_version, read_versions
from quaystat.schema import DEDUP_KEY, OBSERVATION_COLUMNS, OBSERVATION_DDL
from quaystat.sources.store import VersionedStore

LATEST_KEY = ["stop_place_id", "service_journey_id", "aimed_departure_utc"]
#: Versions of a date that a read has to merge, at most.
FOLD = 4
_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def state_in_rocksdb(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB; the caller's settings come back afterwards."""
    before = {name: spark.conf.get(name, None) for name in _STATE}
    for name, value in _STATE.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def _newest(name: str) -> Column:
    """Rises from the newest instant to the oldest; NULL comes last."""
    whole = F.date_part(F.lit("SECOND"), F.col(name)) * 1_000_000
    return F.coalesce(-(epoch_seconds(name) * 1_000_000 + (whole % 1_000_000).cast("long")), F.lit(2**63 - 1))


def best_rows(stream: DataFrame, key: Sequence[str], newest: Sequence[str]) -> DataFrame:
    """The best row of each key: newest by ``newest`` in turn, then the least in every other column, NULL last."""
    rest = [c for c in OBSERVATION_COLUMNS if c not in key and c not in newest]
    order = [
        *[_newest(c).alias(f"_{i}") for i, c in enumerate(newest)],
        *[x for c in rest for x in (F.col(c).isNull().alias(f"_no_{c}"), F.col(c))],
        *[F.col(c) for c in newest],
    ]
    best = stream.groupBy(*key).agg(F.min(F.struct(*order)).alias("_best"))
    return best.select(*[F.col(c) if c in key else F.col(f"_best.{c}").alias(c) for c in OBSERVATION_COLUMNS])


class UpsertTable:
    """Rows by key under ``root``, dated by the day of an instant of the key."""

    def __init__(self, spark: SparkSession, root: str, key: Sequence[str], day_of: str):
        self.spark, self.store, self.day_of = spark, VersionedStore(spark, root), day_of
        self.layout = Layout(f"{OBSERVATION_DDL}, day DATE", "day", list(key), ["v"])

    def _read(self, dates: dict[str, list[int]], days: Sequence[str] | None = None) -> DataFrame:
        return read_versions(self.spark, self.store, "rows", self.layout, dates, days)

    def upsert(self, batch: DataFrame, batch_id: int) -> None:
        """Store the changed rows of a micro-batch. One that is replayed after it was published changes nothing."""
        current = self.store.current()
        body = current.body if current else {"dates": {}, "batch": -1, "old": []}
        if batch_id <= body["batch"]:
            return
        version = self.store.claim()
        dated = batch.withColumn("day", F.to_date(self.day_of))
        append_version(dated, self.store, "rows", self.layout, version)
        days = self._days(version)
        if not days:
            return
        dates = {**body["dates"], **{d: [*body["dates"].get(d, []), version] for d in days}}
        full = [d for d in days if len(dates[d]) > FOLD]
        old = []
        if full:
            folded = self.store.claim()
            append_version(self._read(dates, full), self.store, "rows", self.layout, folded)
            old = [[d, v] for d in full for v in dates[d]]
            dates.update({d: [folded] for d in full})
        self.store.publish(max([version, *(vs[-1] for vs in dates.values())]), {"dates": dates, "batch": batch_id, "old": old}, base=current.version if current else 0)
        for day, v in body["old"]:  # replaced one publish ago, so no reader of the last version needs them
            self.store.delete(f"rows/day={day}/v={v}")

    def _days(self, version: int) -> list[str]:
        """The days that a version wrote, from its directories."""
        pattern = self.store.glob(f"rows/day=*/v={version}")
        return sorted(p.split("/day=", 1)[1].split("/", 1)[0] for p in pattern)

    def read(self) -> DataFrame:
        current = self.store.current()
        dates = current.body["dates"] if current else {}
        return self._read(dates).select(*OBSERVATION_COLUMNS)


def latest_table(spark: SparkSession, root: str) -> UpsertTable:
    return UpsertTable(spark, root, LATEST_KEY, "aimed_departure_utc")


def dedup_table(spark: SparkSession, root: str) -> UpsertTable:
    return UpsertTable(spark, root, DEDUP_KEY, "collected_at_utc")


def _run(best: DataFrame, table: UpsertTable, checkpoint: str) -> None:
    with state_in_rocksdb(table.spark):
        query = (
            best.writeStream.outputMode("update")
            .foreachBatch(table.upsert)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
    query.awaitTermination()


def stream_latest(observations: DataFrame, table: UpsertTable, checkpoint: str) -> None:
    """Bring ``table`` up to date with the latest estimate of every departure in a stream (what is available now)."""
    _run(best_rows(observations, LATEST_KEY, ["collected_at_utc", "expected_departure_utc"]), table, checkpoint)


def stream_dedup(observations: DataFrame, table: UpsertTable, checkpoint: str) -> None:
    """Keep one row per dedup key of a stream: that which the batch dedup keeps of all rows."""
    _run(best_rows(observations, DEDUP_KEY, ["expected_departure_utc"]), table, checkpoint)
