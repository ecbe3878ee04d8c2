"""Measures: aggregates evaluated per group of a report.

A measure restricts columns of its facts. As in a report, its restriction on a
column replaces whatever the report does with that column: a measure that
fixes the status shows the same figure on every status row. So a measure is
evaluated over the group columns it leaves alone and then spread over the
groups. Counts without rows are 0, ratios without a numerator or denominator
are NULL. Text is compared in any casing.

``shown`` holds the report's own tests on columns of the facts. They decide which
groups there are; those that no measure replaces are a filter below the first
aggregate, the others count for the measures that leave their column alone.
(`contexts.py` has the tests on related tables.)
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping, Sequence
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.functions.dates import clock_text, days_between
from rollcall.functions.predicates import (
    any_case_in,
    flag,
    is_any_confirmed,
    is_confirmed,
    is_double_confirmed,
)
from rollcall.operators.aggregates import together
from rollcall.settings import Settings

# Restrictions by column: column name -> test on the row.
Filters = Mapping[str, Column]
NOTHING: Filters = {}

# Fixed values.
WEEK_FILTER_COLUMNS = [
    "week_label", "week_start_date", "week_offset", "week_number", "week_year",
]
TRAVEL_TYPES = {
    "rt_flight_only": "Flight Only",
    "rt_hotel_only": "Hotel Only",
    "rt_both": "Both",
    "rt_is_local": "Is Local",
}

# Display names of the measures (fixed values).
TITLES = {
    "confirmations": "Confirmations",
    "confirmed": "Confirmed",
    "double_confirmed": "Double Confirmed",
    "double_confirmations": "Double Confirmations",
    "total_businesses": "Total Businesses",
    "confirmations_tw": "Confirmations TW",
    "confirmations_lw": "Confirmations LW",
    "wow_change": "WoW Change",
    "wow_pct": "WoW %",
    "data_status": "Data Status",
    "net_new_confirmed": "Net New Confirmed",
    "net_new_double_confirmed": "Net New Double Confirmed",
    "net_new_confirmed_today": "Net New Confirmed Today",
    "tickets_confirmed_2plus": "Tickets Confirmed 2+ Times",
    "times_confirmed": "Times Confirmed",
    "times_double_confirmed": "Times Double Confirmed",
    "rt_travel_confirmed": "RT Travel Confirmed",
    "rt_flight_only": "RT Flight Only",
    "rt_hotel_only": "RT Hotel Only",
    "rt_both": "RT Both",
    "rt_is_local": "RT Is Local",
    "total_tickets": "Total Tickets",
    "confirmed_tickets": "Confirmed Tickets",
    "pct_confirmed": "% Confirmed",
    "confirmed_past": "_Confirmed Tickets Past",
    "confirmed_attended": "_Confirmed & Attended",
    "confirmation_attendance_pct": "Confirmation Attendance %",
    "dc_past": "_DC Tickets Past",
    "dc_attended": "_DC & Attended",
    "dc_attendance_pct": "DC Attendance %",
    "confirmed_no_shows": "_Confirmed No Shows",
    "dc_no_shows": "_DC No Shows",
    "confirmed_no_show_pct": "Confirmed No Show %",
    "dc_no_show_pct": "DC No Show %",
    "avg_days_to_dc": "Avg Days to DC",
}


def with_titles(df: DataFrame) -> DataFrame:
    """The measures under their display names."""
    return df.withColumnsRenamed({c: TITLES[c] for c in df.columns if c in TITLES})


def _by_rep() -> Filters:
    return {"is_rep_action": F.col("is_rep_action") == 1}


def _with_status(test) -> Filters:
    return {"confirmation_status": test(F.col("confirmation_status"))}


def _equals(column: str, value: int) -> Filters:
    return {column: F.col(column) == value}


def _all(filters: Filters) -> Column:
    return reduce(lambda a, b: a & b, filters.values())


def where(rows: DataFrame, tests: Filters) -> DataFrame:
    """The rows that pass every test."""
    return rows.filter(_all(tests)) if tests else rows


def _but(tests: Filters, columns: Collection[str]) -> Filters:
    return {column: test for column, test in tests.items() if column not in columns}


def _left_alone(group_cols: Sequence[str], filters: Filters) -> tuple[str, ...]:
    return tuple(c for c in group_cols if c not in filters)


def _over_groups(
    rows: DataFrame,
    group_cols: Sequence[str],
    values: Mapping[str, tuple[tuple[str, ...], Callable]],
    shown: Filters,
) -> DataFrame:
    """Rows that hold their part of each value, combined per group and then over the groups that
    share the value's grain.

    ``values`` has the grain of each value and how parts combine. The rows are read once: a value of a
    coarser grain is spread by a window over the groups, of which there are few.
    """
    parts = [combine(name).alias(name) for name, (_, combine) in values.items()]
    grouped = rows.groupBy(*group_cols).agg(*parts, *([F.max("_shown").alias("_shown")] if shown else []))
    spread = {
        name: combine(name).over(Window.partitionBy(*grain))
        for name, (grain, combine) in values.items()
        if grain != tuple(group_cols)
    }
    if spread:
        grouped = grouped.withColumns(spread)
    # The total is there whether or not it has rows.
    return grouped.filter("_shown = 1") if shown and group_cols else grouped


def _per_ticket(
    facts: DataFrame, group_cols: Sequence[str], values: Mapping[str, tuple], shown: Filters
) -> DataFrame:
    """One row per group and ticket; ``values`` has the grain of each value, its column, and how rows
    combine.

    A ticket that is in several groups of one grain counts once there: the first of its rows has the
    value of all of them, the others have none.
    """
    known = [F.max(flag(_all(shown))).alias("_shown")] if shown else []
    rows = facts.groupBy(*together(group_cols, "ticket_id")).agg(
        *[combine(column).alias(name) for name, (_, column, combine) in values.items()], *known
    )
    coarser = {grain for grain, _, _ in values.values() if grain != tuple(group_cols)}
    for grain in sorted(coarser):
        of_ticket = Window.partitionBy(*together(grain, "ticket_id"))
        rest = [c for c in group_cols if c not in grain]
        first = F.row_number().over(of_ticket.orderBy(*rest)) == 1
        rows = rows.withColumns(
            {
                name: F.when(first, combine(name).over(of_ticket))
                for name, (its, _, combine) in values.items()
                if its == grain
            }
        )
    return rows


def count_tickets(
    facts: DataFrame,
    group_cols: Sequence[str],
    measures: dict[str, Filters],
    id_is_unique: bool = False,
    shown: Filters = NOTHING,
    maxima: Mapping[str, tuple[Filters, Column]] = NOTHING,
) -> DataFrame:
    """Distinct tickets per group for each measure, and the greatest value of each of ``maxima`` on
    rows that pass its tests; the facts are read once."""
    filters_of = {**measures, **{name: filters for name, (filters, _) in maxima.items()}}
    replaced = {column for filters in filters_of.values() for column in filters}
    partly = {column: test for column, test in shown.items() if column in replaced}
    facts = where(facts, _but(shown, replaced))
    values = {}
    for name, filters in filters_of.items():
        test = _all({**_but(partly, filters), **filters})
        column = flag(test & F.col("ticket_id").isNotNull())
        if name in maxima:
            column = F.when(test, maxima[name][1])
        values[name] = (_left_alone(group_cols, filters), column, F.max)
    if id_is_unique:
        known = [flag(_all(partly)).alias("_shown")] if partly else []
        rows = facts.select(*group_cols, *[column.alias(name) for name, (_, column, _) in values.items()], *known)
    else:
        rows = _per_ticket(facts, group_cols, values, partly)
    totals = {
        name: (grain, F.max if name in maxima else F.sum) for name, (grain, _, _) in values.items()
    }
    wide = _over_groups(rows, group_cols, totals, partly)
    return wide.select(*group_cols, *[F.coalesce(n, F.lit(0)).alias(n) for n in filters_of])


def ratio(part: str, whole: str) -> Column:
    """part / whole; an empty count on either side gives NULL."""
    share = F.try_divide(F.nullif(F.col(part), F.lit(0)).cast("double"), F.col(whole))
    return share.cast("double")


def confirmations(
    actions: DataFrame, group_cols: Sequence[str], settings: Settings, shown: Filters = NOTHING
) -> DataFrame:
    """Tickets confirmed by people: at either level, and at each."""
    doubled = {**_by_rep(), **_with_status(is_double_confirmed)}
    return count_tickets(
        actions,
        group_cols,
        {
            "confirmations": {**_by_rep(), **_with_status(is_any_confirmed)},
            "confirmed": {**_by_rep(), **_with_status(is_confirmed)},
            "double_confirmed": doubled,
            "double_confirmations": doubled,
        },
        shown=shown,
    )


def businesses(
    customers: DataFrame, group_cols: Sequence[str], settings: Settings, shown: Filters = NOTHING
) -> DataFrame:
    """Distinct business names; a missing name counts as one."""
    return where(customers, shown).groupBy(*group_cols).agg(
        (F.count_distinct(F.lower("name")) + F.max(flag(F.col("name").isNull()))).alias(
            "total_businesses"
        )
    )


def week_over_week(
    actions: DataFrame, group_cols: Sequence[str], settings: Settings, shown: Filters = NOTHING
) -> DataFrame:
    """Confirmations of this week and the last, whatever week the group shows."""

    def in_week(offset: int) -> Filters:
        any_week = {c: F.lit(True) for c in WEEK_FILTER_COLUMNS}
        return {
            **_by_rep(),
            **_with_status(is_any_confirmed),
            **any_week,
            **_equals("week_offset", offset),
        }

    weeks = {"confirmations_tw": in_week(0), "confirmations_lw": in_week(-1)}
    counted = count_tickets(actions, group_cols, weeks, shown=shown)
    change = F.col("confirmations_tw") - F.col("confirmations_lw")
    return counted.withColumn("wow_change", change).withColumn(
        "wow_pct", F.try_divide(F.col("wow_change").cast("double"), F.col("confirmations_lw"))
    )


def data_status(
    actions: DataFrame, group_cols: Sequence[str], settings: Settings, shown: Filters = NOTHING
) -> DataFrame:
    """How recent the data is and when it was looked at, in local time."""
    viewed = F.lit((settings.as_of - timedelta(hours=7)).isoformat(" ")).cast("timestamp_ntz")
    latest = F.coalesce(clock_text(F.max("action_time_az")), F.lit(""))
    return where(actions, shown).groupBy(*group_cols).agg(
        F.concat(
            F.lit("Data through "), latest, F.lit(" AZ  •  Viewed "), clock_text(viewed)
        ).alias("data_status")
    )


def depth(
    actions: DataFrame, group_cols: Sequence[str], settings: Settings, shown: Filters = NOTHING
) -> DataFrame:
    """First-time and repeated confirmations.

    The highest touch counts are over all actors, the ticket counts over people.
    """
    confirmed = {**_by_rep(), **_with_status(is_confirmed)}
    doubled = {**_by_rep(), **_with_status(is_double_confirmed)}
    first = _equals("ticket_confirmation_rank", 1)
    today = {"action_date_az": F.col("action_date_az") == settings.today}
    repeated = {"ticket_status_action_count": F.col("ticket_status_action_count") >= 2}
    touches = F.col("ticket_status_action_count")
    return count_tickets(
        actions,
        group_cols,
        {
            "net_new_confirmed": {**confirmed, **first},
            "net_new_double_confirmed": {**doubled, **first},
            "net_new_confirmed_today": {**confirmed, **first, **today},
            "tickets_confirmed_2plus": {**confirmed, **repeated},
        },
        shown=shown,
        maxima={
            "times_confirmed": (_with_status(is_confirmed), touches),
            "times_double_confirmed": (_with_status(is_double_confirmed), touches),
        },
    )


def travel(
    actions: DataFrame,
    all_tickets: DataFrame,
    group_cols: Sequence[str],
    settings: Settings,
    shown: Filters = NOTHING,
    of_type: Column | None = None,
) -> DataFrame:
    """Tickets by their first travel confirmation, in all and per travel type.

    The type is the ticket's, so a restriction on tickets reaches the actions
    through the ticket id. Both sides are cut to what is needed before they
    meet: tickets of the four types, one row each; actions to one row per
    group and ticket. ``of_type`` is the report's test on the type, which the
    measures per type replace.
    """
    has_type = {
        name: any_case_in(F.col("travel_type"), [label]) for name, label in TRAVEL_TYPES.items()
    }
    wanted = any_case_in(F.col("travel_type"), TRAVEL_TYPES.values())
    if of_type is not None:
        has_type["of_type"] = of_type
        wanted = wanted | of_type
    typed = (
        all_tickets.filter(wanted)
        .groupBy("ticket_id")
        .agg(*[F.max(flag(test)).alias(f"_{name}") for name, test in has_type.items()])
    )
    first = _equals("is_first_travel_action", 1)
    of_report = {} if of_type is None else {"travel_type": F.col("_of_type") == 1}
    in_first = {c: F.col("_in_group") == 1 for c in first if c in shown}
    flagged = (
        where(actions, _but(shown, first))
        .groupBy(*together(group_cols, "ticket_id"))
        .agg(
            F.max(flag(_all(first))).alias("is_first_travel_action"),
            *[F.max(flag(shown[c])).alias("_in_group") for c in in_first],
        )
        .join(typed, "ticket_id", "left")
    )
    measures = {"rt_travel_confirmed": first}
    for name in TRAVEL_TYPES:
        measures[name] = {**first, "travel_type": F.col(f"_{name}") == 1}
    return count_tickets(flagged, group_cols, measures, shown={**in_first, **of_report})


def event_health(
    all_tickets: DataFrame, group_cols: Sequence[str], settings: Settings, shown: Filters = NOTHING
) -> DataFrame:
    """Live tickets and how many are confirmed at either level."""
    live = {"is_reset_ghost": ~F.col("is_reset_ghost")}
    counted = count_tickets(
        all_tickets,
        group_cols,
        {
            "total_tickets": live,
            "confirmed_tickets": {**live, **_with_status(is_any_confirmed)},
        },
        settings.tickets_are_unique,
        shown,
    )
    return counted.withColumn("pct_confirmed", ratio("confirmed_tickets", "total_tickets"))


def outcomes(
    actions: DataFrame, group_cols: Sequence[str], settings: Settings, shown: Filters = NOTHING
) -> DataFrame:
    """What became of past tickets, by the person who confirmed them last.

    An event of the as-of day is past, since the day has begun.
    """
    begun = F.col("original_event_date").cast("timestamp_ntz") < settings.now
    last = {
        **_by_rep(),
        **_equals("is_last_confirmer", 1),
        "original_event_date": begun,
    }
    outcome = F.col("ticket_outcome")
    attended = {"ticket_outcome": any_case_in(outcome, ["Attended"])}
    missed = {"ticket_outcome": any_case_in(outcome, ["No Show", "No Show (Reset)"])}
    confirmed = {**last, **_with_status(is_confirmed)}
    doubled = {**last, **_with_status(is_double_confirmed)}
    counted = count_tickets(
        actions,
        group_cols,
        {
            "confirmed_past": confirmed,
            "confirmed_attended": {**confirmed, **attended},
            "dc_past": doubled,
            "dc_attended": {**doubled, **attended},
            "confirmed_no_shows": {**confirmed, **missed},
            "dc_no_shows": {**doubled, **missed},
        },
        shown=shown,
    )
    return counted.withColumns(
        {
            "confirmation_attendance_pct": ratio("confirmed_attended", "confirmed_past"),
            "dc_attendance_pct": ratio("dc_attended", "dc_past"),
            "confirmed_no_show_pct": ratio("confirmed_no_shows", "confirmed_past"),
            "dc_no_show_pct": ratio("dc_no_shows", "dc_past"),
        }
    )


def days_to_double(
    actions: DataFrame, group_cols: Sequence[str], settings: Settings, shown: Filters = NOTHING
) -> DataFrame:
    """Mean days from a ticket's first confirmation to its first double one.

    Negative where the double confirmation came first.
    """
    fixed = {**_by_rep(), **_with_status(is_any_confirmed)}
    grain = _left_alone(group_cols, fixed)
    partly = {column: test for column, test in shown.items() if column in fixed}
    day, status = F.col("action_date_az"), F.col("confirmation_status")
    by_rep = F.col("is_rep_action") == 1
    values = {
        "first_confirmed": (grain, F.when(by_rep & is_confirmed(status), day), F.min),
        "first_double": (grain, F.when(by_rep & is_double_confirmed(status), day), F.min),
    }
    per_ticket = _per_ticket(where(actions, _but(shown, fixed)), group_cols, values, partly)
    days = days_between(F.col("first_confirmed"), F.col("first_double")).cast("bigint")
    parts = per_ticket.withColumns({"_days": days, "_n": flag(days.isNotNull())})
    wide = _over_groups(parts, group_cols, {"_days": (grain, F.sum), "_n": (grain, F.sum)}, partly)
    mean = F.try_divide(F.col("_days").cast("double"), F.col("_n"))
    return wide.select(*group_cols, mean.alias("avg_days_to_dc"))
