"""Calendar expressions on zone-less UTC timestamps."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def hour_start(ts: Column) -> Column:
    """The start of the hour holding ``ts``."""
    return F.window(ts, "1 hour")["start"]


def hour_end(ts: Column) -> Column:
    """The end of the hour holding ``ts``: the default label of hourly values."""
    return F.window(ts, "1 hour")["end"]


def hour_index(ts: Column) -> Column:
    """Whole hours since 1970-01-01 00:00."""
    return F.unix_date(ts.cast("date")).cast("bigint") * 24 + F.hour(ts)


def from_hour_index(index: Column) -> Column:
    """The timestamp of an hour index."""
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(
        days=F.floor(index / 24).cast("int"), hours=F.pmod(index, F.lit(24)).cast("int"))


def day_index(day: Column) -> Column:
    """Whole days since 1970-01-01."""
    return F.unix_date(day.cast("date"))


def day_of_year0(day: Column) -> Column:
    """Day of the year counted from zero."""
    return F.dayofyear(day) - 1


def not_leap_day(ts: Column) -> Column:
    """False on February 29."""
    return ~((F.month(ts) == 2) & (F.dayofmonth(ts) == 29))


def in_typical_year(ts: Column) -> Column:
    """The same calendar hour in 1970, the conventional year of typical-year files.

    Drop February 29 first (:func:`not_leap_day`); 1970 has none.
    """
    return F.make_timestamp_ntz(F.lit(1970), F.month(ts), F.dayofmonth(ts),
                                F.hour(ts), F.lit(0), F.lit(0))


def utc_offset_hours(ts: Column, zone: Column) -> Column:
    """Offset of ``zone`` from UTC at the UTC instant ``ts``; half hours are kept."""
    local = F.convert_timezone(F.lit("UTC"), zone, ts)
    return (F.unix_timestamp(local) - F.unix_timestamp(ts)) / F.lit(3600.0)


def month_day(day: Column) -> Column:
    """``M/D`` without leading zeros."""
    return F.concat_ws("/", F.month(day).cast("string"), F.dayofmonth(day).cast("string"))
