"""The five business queries over the latest estimates (K-05).

Averages and rates are rounded to one decimal, half away from zero, from
exact integer sums and counts; medians/p90 are exact interpolated
percentiles. Each report takes the latest estimates or, with ``weight="n"``, the
maintained counts of a warehouse (``current_counts``), which need neither the estimates nor a
ranking. Dimension joins are equi-joins on surrogate keys; Catalyst
broadcasts a dimension only when its measured size is under the broadcast
threshold and shuffles otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaystat.functions.numeric import MINIMUM_GROUP_SAMPLE, TOP_LINES
from quaystat.operators.summaries import check_floor, rounded_stats

MEDIAN = ("median_delay_seconds", 0.5)
P90 = ("p90_delay_seconds", 0.9)


def current_counts(counts: DataFrame) -> DataFrame:
    """Counts that stand for any estimate; those that were all taken away remain stored as 0."""
    return counts.filter(F.col("n") > 0)


def coverage(latest: DataFrame, dim_date: DataFrame, weight: str | None = None) -> DataFrame:
    """First/last service date, departures, stops and lines."""
    j = latest.join(dim_date.select("date_key", "full_date"), "date_key")
    return j.agg(
        F.min("full_date").alias("first_service_date"),
        F.max("full_date").alias("last_service_date"),
        (F.coalesce(F.sum(weight), F.lit(0)) if weight else F.count(F.lit(1))).alias("unique_departures"),
        F.count_distinct("stop_key").alias("monitored_stops"),
        F.count_distinct("line_key").alias("distinct_lines"),
    )


def delay_by_mode(latest: DataFrame, dim_line: DataFrame, weight: str | None = None) -> DataFrame:
    j = latest.join(dim_line.select("line_key", "transport_mode"), "line_key")
    return (
        j.groupBy("transport_mode")
        .agg(*rounded_stats([MEDIAN, P90], long_rate=True, weight=weight))
        .orderBy(F.col("average_delay_seconds").desc(), F.col("transport_mode"))
    )


def delay_by_stop(latest: DataFrame, dim_stop: DataFrame, weight: str | None = None) -> DataFrame:
    """Grouped by stop *name*: two stops sharing a name form one row."""
    j = latest.join(dim_stop.select("stop_key", "stop_name"), "stop_key")
    return (
        j.groupBy("stop_name")
        .agg(*rounded_stats([MEDIAN], weight=weight))
        .orderBy(F.col("average_delay_seconds").desc(), F.col("stop_name"))
    )


def delay_by_hour(latest: DataFrame, weight: str | None = None) -> DataFrame:
    return latest.groupBy("departure_hour").agg(*rounded_stats([MEDIAN], weight=weight)).orderBy("departure_hour")


def worst_lines(
    latest: DataFrame, dim_line: DataFrame, minimum_sample: int = MINIMUM_GROUP_SAMPLE, top: int = TOP_LINES,
    weight: str | None = None,
) -> DataFrame:
    """Lines with at least ``minimum_sample`` departures, by the *rounded*
    share over 3 minutes, then departures; ``line_id`` settles the top-k."""
    check_floor(minimum_sample, "line")
    j = latest.join(
        dim_line.select("line_key", "line_id", "transport_mode", "line_public_code", "line_name"), "line_key"
    )
    stats = rounded_stats(weight=weight)
    return (
        j.groupBy("line_id", "transport_mode", "line_public_code", "line_name")
        .agg(*[c for c in stats])
        .filter(F.col("departures") >= minimum_sample)
        .orderBy(F.col("percent_over_3_minutes").desc(), F.col("departures").desc(), F.col("line_id"))
        .limit(top)
        .select(
            "transport_mode",
            "line_public_code",
            "line_name",
            "departures",
            "average_delay_seconds",
            "percent_over_3_minutes",
        )
    )
