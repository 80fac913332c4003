"""Top-1 per group.

``row_number() = 1`` over a partitioned window: Spark plans a partial
``WindowGroupLimit`` before the shuffle (one row per key per map task), so a
key holding a large share of the rows is cut down map-side and never lands
whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANK_COLUMN = "_rank"


def first_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row of every ``keys`` group under ``order``.

    NULL key values form one group (NULLs compare equal here). ``order``
    must be a total order within a group for the survivor to be stable.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(RANK_COLUMN, F.row_number().over(w)).filter(F.col(RANK_COLUMN) == 1).drop(RANK_COLUMN)


def total_order(primary: Sequence[Column], columns: Sequence[str]) -> list[Column]:
    """``primary`` followed by every remaining column ascending, nulls last:
    a total order over whole rows."""
    return [*primary, *[F.col(c).asc_nulls_last() for c in columns]]
