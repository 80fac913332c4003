"""Latest estimate per logical departure (stop, service journey, aimed time).

Newest ``collected_at_utc`` wins whatever order the data was loaded in. The
fact key makes collected time unique within a departure, and the observation
key breaks ties for inputs that are not unique.

Filters on date, mode or line must be applied *after* this operator: an
older estimate on a filtered-out date must not resurface. Only filters on
the partition columns (stop, journey, aimed) may be pushed below it, and
Catalyst does exactly that on its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaystat.operators.ranking import first_per_group, total_order
from quaystat.schema import DEPARTURE_KEY, LATEST_COLUMNS


def latest_estimates(
    observations: DataFrame,
    key: Sequence[str] = tuple(DEPARTURE_KEY),
    columns: Sequence[str] | None = tuple(LATEST_COLUMNS),
) -> DataFrame:
    """``row_number() over (partition by key order by collected desc) = 1``."""
    order = [F.col("collected_at_utc").desc()]
    if "observation_key" in observations.columns:
        order.append(F.col("observation_key").desc())
    top = first_per_group(observations, list(key), order)
    return top.select(*columns) if columns else top


def latest_from_silver(silver: DataFrame) -> DataFrame:
    """Same rule on silver observations keyed by the natural stop id."""
    return latest_estimates(
        silver, key=("stop_place_id", "service_journey_id", "aimed_departure_utc"), columns=None
    )


def newest_first(columns: Sequence[str], key: Sequence[str]) -> list[Column]:
    """Total order within a departure: newest collected, then newest expected time, then every other column."""
    rest = [c for c in columns if c not in key and c not in ("collected_at_utc", "expected_departure_utc")]
    return total_order([F.col("collected_at_utc").desc(), F.col("expected_departure_utc").desc_nulls_last()], rest)
