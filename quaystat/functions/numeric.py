"""Numeric scalars for delay statistics.

Ratios are formed from exact integer sums and counts. Where a report rounds
(half away from zero, like SQL ``NUMERIC``), the rounding is done in integer
arithmetic so the result does not depend on binary floating point.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values: "over 3 minutes" and "over 5 minutes" are strict thresholds.
DELAY_THRESHOLD_SECONDS = 180
LONG_DELAY_SECONDS = 300
MINIMUM_GROUP_SAMPLE = 30
TOP_LINES = 15


def _idiv(a: Column, b: Column) -> Column:
    """Integer division (``div``) of non-negative longs."""
    return F.call_function("div", a, b)


def round_ratio(num: Column, den: Column, digits: int = 1) -> Column:
    """``num / den`` rounded half away from zero to ``digits`` places -> DOUBLE.

    Exact for integral ``num``/``den``; NULL when ``den`` is 0 or NULL.
    """
    scale = 10**digits
    n = num.cast("long")
    d = den.cast("long")
    magnitude = _idiv(F.abs(n) * (2 * scale) + d, d * 2)
    signed = F.when(n < 0, -magnitude).otherwise(magnitude)
    return F.when(d > 0, signed.cast("double") / F.lit(float(scale)))


def ratio(num: Column, den: Column) -> Column:
    """Unrounded ``num / den`` as one IEEE division of exact values."""
    return F.when(den > 0, num.cast("double") / den.cast("double"))
