"""Time scalars. All built-in expressions, independent of the session zone.

Instants are carried as UTC wall-clock ``TIMESTAMP_NTZ``. Parsing honours
the offset in ISO-8601 strings; malformed strings become NULL instead of
failing the job (they are routed to rejects by the caller).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# All local dates and hours are Oslo time; weekend = Sunday (1)
# and Saturday (7) in Spark's 1=Sunday weekday numbering.
LOCAL_ZONE = "Europe/Oslo"
WEEKEND_DAYS = (1, 7)

EPOCH = dt.datetime(1970, 1, 1)


def ntz_literal(value: dt.datetime) -> Column:
    """An NTZ literal built from text: a Python ``datetime`` literal would be
    read in the session zone, a string cast to NTZ is not."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def _epoch() -> Column:
    return ntz_literal(EPOCH)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Date and time of day, perhaps with a UTC offset behind them; nothing less is an instant.
_OFFSET = r"(Z|[+-]\d{2}(:?\d{2})?)$"
_ISO = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d{1,9})?" + _OFFSET.replace("$", "?$")


def parse_instant(text: Column | str) -> Column:
    """ISO-8601 text -> UTC ``TIMESTAMP_NTZ`` (NULL if malformed).

    A date and a time of day down to the second are required; text without an offset is UTC, so
    the session zone never matters. ``try_to_timestamp`` yields an instant;
    adding its epoch microseconds to the NTZ epoch is integer arithmetic.
    """
    c = F.trim(_col(text))
    whole = F.when(c.rlike(_ISO), F.when(c.rlike(_OFFSET), c).otherwise(F.concat(c, F.lit("Z"))))
    return F.timestamp_add("MICROSECOND", F.unix_micros(F.try_to_timestamp(whole)), _epoch())


def epoch_seconds(ntz: Column | str) -> Column:
    """Whole seconds since 1970 of an NTZ value (floored), from its fields.

    ``timestamp_diff``/``unix_*`` would cast NTZ to a session-zone TIMESTAMP
    first; date and clock fields of an NTZ value never consult a zone.
    """
    x = _col(ntz)
    days = F.datediff(F.to_date(x), F.lit(EPOCH.date())).cast("long")
    return days * 86400 + F.hour(x) * 3600 + F.minute(x) * 60 + F.second(x)


def micros_of_second(ntz: Column | str) -> Column:
    """Microseconds within the second (0..999999) of an NTZ value."""
    return (F.date_part(F.lit("SECOND"), _col(ntz)) * 1_000_000).cast("long") % 1_000_000


def epoch_micros(ntz: Column | str) -> Column:
    return epoch_seconds(ntz) * 1_000_000 + micros_of_second(ntz)


def delay_seconds(expected: Column | str, aimed: Column | str) -> Column:
    """expected - aimed, each floored to the second first (1.1s - 0.9s = 1)."""
    return epoch_seconds(expected) - epoch_seconds(aimed)


def to_local(utc_ntz: Column | str, zone: str = LOCAL_ZONE) -> Column:
    """UTC wall clock -> local wall clock (both NTZ); DST handled by tz rules."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), _col(utc_ntz))


def local_features(expected_utc: Column | str) -> dict[str, Column]:
    """Local-time attributes derived from the *expected* departure."""
    local = to_local(expected_utc)
    weekday = F.dayofweek(local)
    return {
        "expected_departure_local": local,
        "service_date": F.to_date(local),
        "departure_hour": F.hour(local),
        "weekday_number": weekday,
        "is_weekend": weekday.isin(*WEEKEND_DAYS),
    }


def date_attributes(full_date: Column | str) -> dict[str, Column]:
    """Calendar attributes of a date (dimension row).

    ``year`` is the calendar year while ``week_of_year`` is the ISO week, so
    2027-01-01 is year 2027, week 53. ``day_of_week`` is ISO (1 = Monday).
    """
    d = _col(full_date)
    iso_dow = F.weekday(d) + 1
    return {
        "date_key": (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int"),
        "full_date": d,
        "year": F.year(d),
        "quarter": F.quarter(d),
        "month": F.month(d),
        "month_name": F.date_format(d, "MMMM"),
        "week_of_year": F.weekofyear(d),
        "day_of_week": iso_dow,
        "day_name": F.date_format(d, "EEEE"),
        "is_weekend": iso_dow.isin(6, 7),
    }


def to_instant(utc_ntz: Column | str) -> Column:
    """UTC NTZ -> instant (``TIMESTAMP``) via epoch microseconds, for APIs
    that need an instant, such as streaming watermarks."""
    return F.timestamp_micros(epoch_micros(utc_ntz))
