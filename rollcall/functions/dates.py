"""Date and week arithmetic."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollcall.settings import Settings


def to_local(utc: Column, zone: str) -> Column:
    """A naive UTC timestamp as naive local time."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def days_between(start: Column, end: Column) -> Column:
    """Number of midnights from ``start`` to ``end``."""
    return F.datediff(F.to_date(end), F.to_date(start))


def later_of(a: Column, b: Column) -> Column:
    """The later date; a NULL one is ignored."""
    return F.greatest(a, b)


def week_start(day: Column, anchor: date, floor: bool = False) -> Column:
    """First day of the seven-day week counted from ``anchor``.

    The remainder keeps its sign, so a day before the anchor belongs to the
    week that starts *after* it. ``floor`` gives the week that contains it.
    """
    elapsed = F.datediff(day, F.lit(anchor))
    return F.date_sub(day, F.pmod(elapsed, F.lit(7)) if floor else elapsed % 7)


def week_columns(day: Column, settings: Settings) -> dict[str, Column]:
    start = week_start(day, settings.week_anchor, settings.floor_weeks)
    this_week = week_start(settings.today, settings.week_anchor, settings.floor_weeks)
    return {
        "week_start_date": start,
        "week_year": F.year(start),
        "week_number": F.weekofyear(start),
        "week_offset": (F.datediff(start, this_week) / 7).cast("int"),
    }


def week_label(offset: Column) -> Column:
    """This / Last / Next Week, else the distance in weeks.

    An action without a date has no offset; its label keeps the suffix only.
    """
    distance = F.coalesce(F.abs(offset).cast("string"), F.lit(""))
    return (
        F.when(offset == 0, "This Week")
        .when(offset == -1, "Last Week")
        .when(offset == 1, "Next Week")
        .when(offset < 0, F.concat(distance, F.lit(" Weeks Ago")))
        .otherwise(F.concat(distance, F.lit(" Weeks Ahead")))
    )


def clock_text(ts: Column) -> Column:
    return F.date_format(ts, "MMM d 'at' h:mm a")
