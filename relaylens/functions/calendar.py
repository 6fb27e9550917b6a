"""Calendar of reports and trainings as column expressions over dates and timestamps: months, weeks, offsets, parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Units of a training period.
UNITS = ("MONTHS", "WEEKS", "DAYS")


def previous_month(day: Column) -> tuple[Column, Column]:
    """First and last day of the month before; on a month's last day that month itself."""
    last = F.when(day == F.last_day(day), day).otherwise(F.last_day(F.add_months(day, -1)))
    return F.trunc(last, "MONTH"), last


def next_weekday(day: Column, weekday: int) -> Column:
    """The next day of that weekday (Monday 0), the day itself if it is one."""
    return F.date_add(day, F.pmod(F.lit(weekday) - F.weekday(day), F.lit(7)))


def previous_week(day: Column) -> tuple[Column, Column]:
    """Monday and Sunday of the last week that is over; on a Sunday that week itself."""
    sunday = F.date_sub(day, F.pmod(F.weekday(day) + 1, F.lit(7)))
    return F.date_sub(sunday, 6), sunday


def next_week(day: Column) -> tuple[Column, Column]:
    """Monday and Sunday of the next week to begin; on a Monday that week itself."""
    monday = next_weekday(day, 0)
    return monday, F.date_add(monday, 6)


def training_start(at: Column, length: int, unit: str) -> Column:
    """The time of day kept, so many months, weeks or days earlier; a day that the month hasn't becomes its last."""
    if unit not in UNITS:
        raise ValueError(f"a training period's unit is one of {', '.join(UNITS)}")
    if unit == "MONTHS":
        return at - F.make_ym_interval(F.lit(0), F.lit(length))
    return at - F.make_dt_interval(F.lit(length * (7 if unit == "WEEKS" else 1)))


def with_offset(text: Column) -> Column:
    """The instant of yyyy-MM-ddTHH:mm:ss with an offset (+0300, +03:00 or Z), null for any other text.

    A plus sign that came as a space, as in a query string, counts as one.
    """
    plus = F.replace(text, F.lit(" "), F.lit("+"))
    return F.coalesce(F.try_to_timestamp(plus, F.lit("yyyy-MM-dd'T'HH:mm:ssXXX")), F.try_to_timestamp(plus, F.lit("yyyy-MM-dd'T'HH:mm:ssxx")))
