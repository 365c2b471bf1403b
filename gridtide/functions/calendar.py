"""Attributes of dates and times of day."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

QUARTER_HOUR_MICROS = 15 * 60 * 1_000_000


def flag(condition: Column) -> Column:
    """1 or 0."""
    return condition.cast("bigint")


def date_id(day: Column) -> Column:
    """``yyyyMMdd`` as a number, by arithmetic: no text is formatted."""
    return (F.year(day) * 10_000 + F.month(day) * 100 + F.dayofmonth(day)).cast("bigint")


def calendar_attributes(day: Column) -> dict[str, Column]:
    """The attributes of a calendar day, in table order."""
    month, day_of_month = F.month(day), F.dayofmonth(day)
    monday_based = F.weekday(day)  # Monday is 0
    return {
        "date_id": date_id(day),
        "year": F.year(day).cast("bigint"),
        "month": month.cast("bigint"),
        "day": day_of_month.cast("bigint"),
        "quarter": F.quarter(day).cast("bigint"),
        "day_name": F.date_format(day, "EEEE"),
        "month_name": F.date_format(day, "MMMM"),
        "day_of_week": (monday_based + 1).cast("bigint"),
        "day_of_year": F.dayofyear(day).cast("bigint"),
        "week_of_year": F.weekofyear(day).cast("bigint"),
        "year_quarter": F.concat_ws("-Q", F.year(day), F.quarter(day)),
        "year_month": F.date_format(day, "yyyy-MM"),
        "is_weekday": flag(monday_based < 5),
        "is_weekend": flag(monday_based >= 5),
        "is_month_start": flag(day_of_month == 1),
        "is_month_end": flag(F.last_day(day) == day),
        "is_quarter_start": flag((day_of_month == 1) & (month % 3 == 1)),
        "is_year_start": flag(F.dayofyear(day) == 1),
        "is_year_end": flag((month == 12) & (day_of_month == 31)),
    }


def time_attributes(quarter_id: Column) -> dict[str, Column]:
    """The attributes of a quarter hour, numbered 0..95 from midnight."""
    hour = F.call_function("div", quarter_id, F.lit(4))
    quarter = quarter_id % 4
    minute = quarter * 15
    return {
        "time_quarter_id": quarter_id.cast("bigint"),
        "hour": hour.cast("bigint"),
        "quarter_of_hour": quarter.cast("bigint"),
        "minute": minute.cast("bigint"),
        "time_15min": F.format_string("%02d:%02d:00", hour, minute),
    }


def floor_to_quarter_hour(moment: Column) -> Column:
    """Start of the quarter hour a timestamp lies in."""
    micros = F.unix_micros(moment)
    return F.timestamp_micros(micros - F.pmod(micros, F.lit(QUARTER_HOUR_MICROS)))


def time_of_day_text(moment: Column) -> Column:
    """``HH:mm:ss``; a fraction of a second is cut off."""
    return F.date_format(moment, "HH:mm:ss")


def second_of_day(moment: Column) -> Column:
    """The same as a number: seconds since midnight, without the fraction."""
    return F.hour(moment) * 3600 + F.minute(moment) * 60 + F.second(moment)
