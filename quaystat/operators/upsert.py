"""Star-schema loads as joins (no MERGE on plain Parquet).

* ``dim_date``: insert new dates only (anti join + union).
* ``dim_stop``, ``dim_line``, ``dim_quay``: type-1 upsert. The incoming value
  per natural key is the newest observation (ties broken by a total order);
  existing rows present in the batch take *all* incoming attributes, NULLs
  included; new natural keys get fresh surrogate keys.
* fact: one incoming row per fact key; on conflict only expected, actual,
  delay and realtime change; date, hour, quay, line, destination and the
  observation key keep their stored values.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaystat.functions.time import date_attributes
from quaystat.operators.keys import with_dense_keys
from quaystat.operators.ranking import first_per_group, total_order
from quaystat.schema import FACT_KEY

PRESENT = "_incoming"

# Dimensions by name: natural key, its attributes in the staging.
NATURAL = {
    "stop": ("stop_place_id", ["stop_name"]),
    "line": ("line_id", ["line_public_code", "line_name", "transport_mode"]),
    "quay": ("quay_id", ["quay_name", "stop_place_id"]),
}
_WIDTH = max(len(attrs) for _, attrs in NATURAL.values())


def newest_attributes(staging: DataFrame) -> DataFrame:
    """Newest attributes of every natural key of every dimension: dim, nk, attrs.

    The attribute values are first pre-aggregated by hash to one row each with
    their newest instant; only that small result is ranked. Among equally new
    values the least wins (NULLs last).
    """
    kinds = F.array(
        *[
            F.struct(F.lit(dim).alias("dim"), F.col(key).alias("nk"), F.array(*[F.col(a) for a in attrs]).alias("attrs"))
            for dim, (key, attrs) in NATURAL.items()
        ]
    )
    rows = staging.select("collected_at_utc", F.explode(kinds).alias("k")).select("collected_at_utc", "k.*")
    seen = rows.filter(F.col("nk").isNotNull()).groupBy("dim", "nk", "attrs").agg(F.max("collected_at_utc").alias("at"))
    order = [F.col("at").desc(), *[F.get("attrs", F.lit(i)).asc_nulls_last() for i in range(_WIDTH)]]
    return first_per_group(seen, ["dim", "nk"], order).drop("at")


def incoming_dimension(newest: DataFrame, dim: str) -> DataFrame:
    """Rows of one dimension from the stored ``newest_attributes`` (with their range bucket)."""
    key, attrs = NATURAL[dim]
    return newest.filter(F.col("dim") == dim).select(
        F.col("nk").alias(key), *[F.get("attrs", F.lit(i)).alias(a) for i, a in enumerate(attrs)], "bucket"
    )


def upsert_dimension(
    existing: DataFrame, incoming: DataFrame, natural_key: str, surrogate_key: str, attrs: Sequence[str], max_key: int
) -> DataFrame:
    """Type-1 upsert of ``incoming`` (one row per natural key, with its range
    ``bucket``) into ``existing``: one full join, then keys for the new rows."""
    cols = [surrogate_key, natural_key, *attrs]
    inc = incoming.select(
        natural_key, "bucket", *[F.col(a).alias(f"_new_{a}") for a in attrs], F.lit(True).alias(PRESENT)
    )
    joined = existing.join(inc, natural_key, "full_outer").select(
        surrogate_key, natural_key, "bucket",
        *[F.when(F.col(PRESENT), F.col(f"_new_{a}")).otherwise(F.col(a)).alias(a) for a in attrs],
    )
    new = joined.filter(F.col(surrogate_key).isNull()).drop(surrogate_key)
    keyed = with_dense_keys(new, surrogate_key, natural_key, "bucket", max_key)
    return joined.filter(F.col(surrogate_key).isNotNull()).select(*cols).unionByName(keyed.select(*cols))


def dates_dimension(dates: DataFrame) -> DataFrame:
    """Calendar rows of the distinct dates in column ``full_date``."""
    return dates.select(*[c.alias(n) for n, c in date_attributes("full_date").items()])


def upsert_dim_date(existing: DataFrame, dates: DataFrame) -> DataFrame:
    """Insert dates not yet present; existing rows never change."""
    new = dates_dimension(dates).join(existing.select("full_date"), "full_date", "left_anti")
    return existing.unionByName(new.select(*existing.columns))


def upsert_dim_quay(existing: DataFrame, incoming: DataFrame, dim_stop: DataFrame, max_key: int) -> DataFrame:
    """The stop key comes from the (already upserted) stop dimension, so a quay
    reported at another stop moves."""
    with_stop = incoming.join(dim_stop.select("stop_place_id", "stop_key"), "stop_place_id").drop("stop_place_id")
    return upsert_dimension(existing, with_stop, "quay_id", "quay_key", ["quay_name", "stop_key"], max_key)


def fact_rows(
    staging: DataFrame,
    dim_date: DataFrame,
    dim_stop: DataFrame,
    dim_line: DataFrame,
    dim_quay: DataFrame,
) -> DataFrame:
    """Staging resolved to surrogate keys and collapsed to one row per fact
    key (newest expected time, then a total order). The fact key omits the
    quay, so one journey seen at two quays in one snapshot becomes one row;
    the load reports how many rows collapsed."""
    rows = resolve_keys(staging, dim_date, dim_stop, dim_line, dim_quay)
    rest = [c for c in rows.columns if c not in FACT_KEY]
    order = total_order([F.col("expected_departure_utc").desc_nulls_last()], rest)
    return first_per_group(rows, FACT_KEY, order).withColumn("collected_date", F.to_date("collected_at_utc"))


def resolve_keys(
    staging: DataFrame, dim_date: DataFrame, dim_stop: DataFrame, dim_line: DataFrame, dim_quay: DataFrame
) -> DataFrame:
    """Staging with surrogate keys in place of natural ones, one row each."""
    j = (
        staging.join(dim_date.select(F.col("full_date").alias("service_date"), "date_key"), "service_date")
        .join(dim_stop.select("stop_place_id", "stop_key"), "stop_place_id")
        .join(dim_line.select("line_id", "line_key"), "line_id")
        .join(dim_quay.select("quay_id", "quay_key"), "quay_id", "left")
    )
    return j.select(
        "collected_at_utc",
        "date_key",
        "stop_key",
        "quay_key",
        "line_key",
        "service_journey_id",
        "destination",
        "realtime",
        "aimed_departure_utc",
        "expected_departure_utc",
        "actual_departure_utc",
        F.col("delay_seconds").cast("int").alias("delay_seconds"),
        F.col("departure_hour").cast("smallint").alias("departure_hour"),
    )


UPDATED_ON_CONFLICT = ["expected_departure_utc", "actual_departure_utc", "delay_seconds", "realtime"]


def fact_delta(incoming: DataFrame, stored: DataFrame | None) -> DataFrame:
    """What a batch changes: every incoming row (one per fact key), with the
    stored values of the columns a conflict must not touch, and whether it is new.

    ``stored`` holds the resolved fact of the batch's collected dates (None if
    there are none, so nothing can conflict). Rows that the batch doesn't hold
    are not part of the delta and stay as they are. New rows have no ``observation_key`` yet.
    """
    fresh = F.lit(None).cast("long")
    if stored is None:
        return incoming.withColumn("observation_key", fresh).withColumn("_new", F.lit(True))
    kept = [c for c in stored.columns if c not in FACT_KEY and c not in UPDATED_ON_CONFLICT]
    old = stored.select(*FACT_KEY, *[F.col(c).alias(f"_old_{c}") for c in kept], F.lit(True).alias("_was"))
    known = F.col("_was").isNotNull()
    return incoming.join(old, FACT_KEY, "left").select(
        *FACT_KEY,
        *UPDATED_ON_CONFLICT,
        *[
            F.when(known, F.col(f"_old_{c}")).otherwise(fresh if c == "observation_key" else F.col(c)).alias(c)
            for c in kept
        ],
        (~known).alias("_new"),
    )


def changed_dimensions(newest: DataFrame, old: dict[str, DataFrame]) -> DataFrame:
    """dim and changes: how many natural keys of the batch are new to a dimension or have other attributes than stored.

    ``old`` has the dimensions with the natural attributes of ``NATURAL`` (a quay's stop by its natural id).
    """
    known = [
        old[dim].select(F.lit(dim).alias("dim"), F.col(key).alias("nk"), F.array(*[F.col(a) for a in attrs]).alias("_stored"))
        for dim, (key, attrs) in NATURAL.items()
    ]
    joined = newest.join(reduce(DataFrame.unionByName, known), ["dim", "nk"], "left")
    return joined.filter(F.col("_stored").isNull() | ~F.col("attrs").eqNullSafe(F.col("_stored"))).groupBy("dim").agg(F.count(F.lit(1)).alias("changes"))
