"""Small column expressions for incidents: time parts, ratios, labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def calendar_columns(ts: str = "timestamp", month_end: str = "midnight") -> list[Column]:
    """Calendar features. `midnight` marks only 00:00 of a month's last day; `calendar` the whole day."""
    if month_end not in ("midnight", "calendar"):
        raise ValueError("month_end is 'midnight' or 'calendar'")
    when = F.col(ts) if month_end == "midnight" else F.to_date(ts)
    return [
        F.dayofweek(ts).alias("day_of_week"),
        F.weekofyear(ts).alias("week_of_year"),
        F.month(ts).alias("month"),
        (when == F.last_day(ts)).alias("is_month_end"),
    ]


def start_of(unit: str, ts: str = "timestamp") -> Column:
    """Start of the hour, day, week (Monday) or month, independent of the session time zone."""
    if unit == "hour":
        day = F.to_date(ts).cast("timestamp_ntz")
        return day + F.make_dt_interval(hours=F.hour(ts))
    if unit == "day":
        return F.to_date(ts).cast("timestamp_ntz")
    if unit in ("week", "month"):
        return F.trunc(F.to_date(ts), unit).cast("timestamp_ntz")
    raise ValueError("unit is 'hour', 'day', 'week' or 'month'")


def guarded_ratio(part: Column, whole: Column) -> Column:
    """`part / whole`, 0 where the whole is 0 or missing."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def flag_sum(flag: Column) -> Column:
    """Number of rows whose flag is true; missing counts as false."""
    return F.sum(F.when(flag, 1).otherwise(0))


def percent_text(rate: Column) -> Column:
    return F.format_string("%.2f%%", rate * 100)


def map_value(value: Column, table: dict, otherwise) -> Column:
    """Recode by a small table."""
    out = None
    for key, result in table.items():
        out = (F if out is None else out).when(value == key, result)
    return out.otherwise(otherwise)
