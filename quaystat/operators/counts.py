"""Report state: counts of latest estimates, maintained by retraction.

A load adds the estimates that became the latest of their departure and takes away
those they replaced, so totals follow from the batch and the departures it touches. The
five business reports need no more than these totals, as each is a function of (date, stop,
line, hour, delay) and how often it occurs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaystat.schema import COUNTS_KEY, DEPARTURE_KEY

_VALUES = [*COUNTS_KEY, "collected_at_utc"]


def newer_estimates(candidates: DataFrame, stored: DataFrame | None) -> DataFrame:
    """Candidates (one per departure) that are not older than the stored latest estimate of
    their departure, with the stored one's counted values as _old_* (null where there is none)."""
    if stored is None:
        return candidates.withColumns({f"_old_{c}": F.lit(None).cast(candidates.schema[c].dataType) for c in COUNTS_KEY})
    old = stored.select(*DEPARTURE_KEY, *[F.col(c).alias(f"_old_{c}") for c in _VALUES if c not in DEPARTURE_KEY], F.col("stop_key").alias("_old_stop_key"))
    joined = candidates.join(old, DEPARTURE_KEY, "left")
    newer = F.col("_old_collected_at_utc").isNull() | (F.col("collected_at_utc") >= F.col("_old_collected_at_utc"))
    return joined.filter(newer).drop("_old_collected_at_utc")


def count_changes(newer: DataFrame) -> DataFrame:
    """By how much each count changes: +1 for an estimate that became the latest, -1 for the one it replaced."""
    plus = F.struct(*[F.col(c) for c in COUNTS_KEY], F.lit(1).cast("long").alias("change"))
    minus = F.when(F.col("_old_date_key").isNotNull(), F.struct(*[F.col(f"_old_{c}").alias(c) for c in COUNTS_KEY], F.lit(-1).cast("long").alias("change")))
    both = newer.select(F.explode(F.filter(F.array(plus, minus), lambda c: c.isNotNull())).alias("c")).select("c.*")
    return both.groupBy(*COUNTS_KEY).agg(F.sum("change").alias("change")).filter(F.col("change") != 0)


def new_totals(changes: DataFrame, stored: DataFrame | None) -> DataFrame:
    """Totals of the counts that change, 0 included, as rows of the stored table."""
    day = F.to_date(F.col("date_key").cast("string"), "yyyyMMdd").alias("service_day")
    if stored is None:
        return changes.select(*COUNTS_KEY, F.col("change").alias("n"), day)
    old = stored.select(*COUNTS_KEY, F.col("n").alias("_n"))
    total = F.coalesce(F.col("_n"), F.lit(0)) + F.col("change")
    return changes.join(old, COUNTS_KEY, "left").select(*COUNTS_KEY, total.alias("n"), day)
