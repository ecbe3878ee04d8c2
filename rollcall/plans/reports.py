"""The report queries.

Each takes the derived facts and dimensions it needs and returns the sorted
report. Where the event is part of the group, the facts are aggregated by its
id before the event table is joined, so only the result meets the dimension.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions.predicates import (
    any_case_in,
    is_any_confirmed,
    is_confirmed,
    is_double_confirmed,
    none_of,
    percent,
)
from rollcall.operators.aggregates import count_distinct_where
from rollcall.settings import Settings

# Fixed values.
RESTRICTIONS = ["Do Not Blast", "Do Not Call", "Do Not Contact"]
OUTCOMES = ["attended", "no show"]
NO_TRAVEL = "Not Confirmed"


def _live(all_tickets: DataFrame) -> DataFrame:
    return all_tickets.filter(~F.col("is_reset_ghost"))


def _events(events: DataFrame, *more: Column) -> DataFrame:
    """The event columns a report shows, keyed for the join on event_id.

    An event that is recorded twice repeats what is joined with it.
    """
    return events.select(
        F.col("CVEventID").alias("event_id"),
        F.col("EventName").alias("event_name"),
        F.col("StartDate").alias("event_date"),
        F.col("EventType").alias("event_type"),
        *more,
    )


def _different_events(events: DataFrame, *more: Column) -> DataFrame:
    """The same for reports that group by all of the columns: equal rows are one group."""
    return _events(events, *more).distinct()


def _rep_actions(actions: DataFrame) -> DataFrame:
    return actions.filter(
        (F.col("is_rep_action") == 1) & is_any_confirmed(F.col("confirmation_status"))
    )


def event_overview(all_tickets: DataFrame, events: DataFrame, settings: Settings) -> DataFrame:
    """Confirmation state per event over live tickets that are not cancelled."""
    status = F.col("confirmation_status")
    counted = count_distinct_where(
        _live(all_tickets).filter(none_of(F.lower("status"), settings.excluded_statuses)),
        ["event_id"],
        "ticket_id",
        {
            "total_tickets": F.lit(True),
            "confirmed": is_confirmed(status),
            "double_confirmed": is_double_confirmed(status),
            "total_confirmed": is_any_confirmed(status),
        },
        settings.tickets_are_unique,
    )
    dimension = _different_events(
        events,
        F.col("EventCode").alias("event_code"),
        F.col("TargetAttendance").alias("target_attendance"),
    )
    confirmed = F.col("total_confirmed")
    return (
        counted.join(dimension, "event_id")
        .select(
            "event_name",
            "event_code",
            "event_type",
            "event_date",
            "target_attendance",
            "total_tickets",
            "confirmed",
            "double_confirmed",
            "total_confirmed",
            percent(confirmed, F.col("total_tickets")).alias("pct_confirmed"),
            percent(confirmed, F.col("target_attendance")).alias("pct_of_target"),
        )
        .orderBy(F.desc_nulls_last("event_date"), "event_name", "event_code")
    )


def rep_performance(actions: DataFrame, employees: DataFrame, events: DataFrame) -> DataFrame:
    """Distinct tickets confirmed per rep, day, event and status.

    ``actions`` are actions on live tickets. Events are told apart by what is
    shown, not by id. Reps are looked up for the result only, so that a rep with
    very many actions never gathers them in one task.
    """
    reps = employees.select(
        F.col("Email").alias("rep_email"),
        F.col("EmployeeName").alias("rep_name"),
        F.col("Team").alias("rep_team"),
    ).distinct()
    return (
        _rep_actions(actions)
        .filter(F.col("user_email").isNotNull())
        .join(_different_events(events), "event_id")
        .groupBy(
            F.col("user_email").alias("rep_email"),
            F.col("action_date_az").alias("action_date"),
            "week_label",
            "week_offset",
            "event_name",
            "event_type",
            "event_date",
            "confirmation_status",
        )
        .agg(F.count_distinct("ticket_id").alias("tickets_confirmed"))
        .join(reps, "rep_email")
        .select(
            "rep_name",
            "rep_email",
            "rep_team",
            "action_date",
            "week_label",
            "week_offset",
            "event_name",
            "event_type",
            "event_date",
            "confirmation_status",
            "tickets_confirmed",
        )
        .orderBy(
            F.desc_nulls_last("action_date"),
            F.desc("tickets_confirmed"),
            "rep_email",
            "event_name",
            "confirmation_status",
        )
    )


def daily_activity(actions: DataFrame, events: DataFrame) -> DataFrame:
    """Distinct tickets and raw actions per day, event, status and touch source."""
    return (
        actions.filter(F.col("is_rep_action") == 1)
        .join(_events(events), "event_id")
        .groupBy(
            F.col("action_date_az").alias("action_date"),
            "week_label",
            "week_offset",
            "event_name",
            "event_type",
            "event_date",
            "confirmation_status",
            "confirmation_touch_source",
        )
        .agg(
            F.count_distinct("ticket_id").alias("tickets_confirmed"),
            F.count("*").alias("total_actions"),
        )
        .orderBy(
            F.desc_nulls_last("action_date"),
            "event_type",
            F.desc("tickets_confirmed"),
            "event_name",
            "confirmation_status",
            "confirmation_touch_source",
        )
    )


def depth_per_ticket(actions: DataFrame, events: DataFrame) -> DataFrame:
    """Per event and status: how many tickets were confirmed n times."""
    return (
        _rep_actions(actions)
        .filter(F.col("is_last_confirmer") == 1)
        .groupBy(
            "event_id",
            "confirmation_status",
            F.col("ticket_status_action_count").alias("times_confirmed_to_this_status"),
        )
        .agg(F.count_distinct("ticket_id").alias("ticket_count"))
        .join(_different_events(events), "event_id")
        .orderBy(
            F.desc_nulls_last("event_date"),
            "confirmation_status",
            "times_confirmed_to_this_status",
            "event_id",
        )
        .select(
            "event_name",
            "event_date",
            "event_type",
            "confirmation_status",
            "times_confirmed_to_this_status",
            "ticket_count",
        )
    )


def depth_per_company(
    all_tickets: DataFrame, events: DataFrame, customers: DataFrame, settings: Settings
) -> DataFrame:
    """Ticket and confirmation counts per event and company with a confirmation."""
    status = F.col("confirmation_status")
    counted = count_distinct_where(
        _live(all_tickets).filter(
            F.col("event_id").isNotNull() & F.col("customer_id").isNotNull()
        ),
        ["event_id", "customer_id"],
        "ticket_id",
        {
            "total_tickets": F.lit(True),
            "confirmed_tickets": is_confirmed(status),
            "double_confirmed_tickets": is_double_confirmed(status),
            "total_confirmed_tickets": is_any_confirmed(status),
        },
        settings.tickets_are_unique,
    ).filter(F.col("total_confirmed_tickets") > 0)
    # A company that is recorded twice is one group as well.
    companies = customers.select(
        F.col("id").alias("customer_id"), F.col("name").alias("company_name"), "vertical"
    ).distinct()
    return (
        counted.join(_different_events(events), "event_id")
        .join(companies, "customer_id")
        .orderBy(
            F.desc_nulls_last("event_date"),
            F.desc("total_confirmed_tickets"),
            "event_id",
            "customer_id",
        )
        .select(
            "event_name",
            "event_date",
            "company_name",
            "vertical",
            "total_tickets",
            "confirmed_tickets",
            "double_confirmed_tickets",
            "total_confirmed_tickets",
        )
    )


def attendance_outcomes(actions: DataFrame, events: DataFrame, settings: Settings) -> DataFrame:
    """Attended / no show tickets of past events by their last confirmation."""
    return (
        _rep_actions(actions)
        .filter(
            (F.col("is_last_confirmer") == 1)
            & (F.col("ticket_event_date") < settings.today)
            & any_case_in(F.col("ticket_status"), OUTCOMES)
        )
        .groupBy("event_id", "confirmation_status", "ticket_status")
        .agg(F.count_distinct("ticket_id").alias("tickets"))
        .join(_different_events(events), "event_id")
        .orderBy(
            F.desc_nulls_last("event_date"), "confirmation_status", "ticket_status", "event_id"
        )
        .select(
            "event_name",
            "event_date",
            "event_type",
            "confirmation_status",
            "ticket_status",
            "tickets",
        )
    )


def travel_status(all_tickets: DataFrame, events: DataFrame, settings: Settings) -> DataFrame:
    """Confirmed tickets of upcoming events per travel category."""
    counted = count_distinct_where(
        _live(all_tickets).filter(
            is_any_confirmed(F.col("confirmation_status"))
            & (F.col("event_date") >= settings.today)
        ),
        ["event_id", "attendance_type", "travel_details", "confirmation_status"],
        "ticket_id",
        {"tickets": F.lit(True)},
        settings.tickets_are_unique,
    )
    return (
        counted.join(_different_events(events), "event_id")
        .orderBy(
            F.asc_nulls_first("event_date"),
            F.asc_nulls_first("travel_details"),
            "event_id",
            "attendance_type",
            "confirmation_status",
        )
        .select(
            "event_name",
            "event_date",
            "event_type",
            "attendance_type",
            F.coalesce("travel_details", F.lit(NO_TRAVEL)).alias("travel_category"),
            "confirmation_status",
            "tickets",
        )
    )


def _ticket_detail(
    tickets: DataFrame, attendees: DataFrame, customers: DataFrame, events: DataFrame
) -> DataFrame:
    """Tickets with their event, attendee and company; without one of them, dropped.

    The event's own date replaces the ticket's.
    """
    return (
        tickets.drop("event_date")
        .join(events, "event_id")
        .join(attendees.drop("customer_id"), "attendee_id")
        .join(
            customers.withColumnsRenamed({"id": "customer_id", "name": "company_name"}),
            "customer_id",
        )
    )


def outreach_queue(
    all_tickets: DataFrame,
    events: DataFrame,
    attendees: DataFrame,
    customers: DataFrame,
    settings: Settings,
) -> DataFrame:
    """Upcoming tickets that must not be contacted, and why."""
    restricted = _live(all_tickets).filter(
        F.col("outreach_restriction").isin(RESTRICTIONS)
        & (F.col("event_date") >= settings.today)
    )
    return (
        _ticket_detail(restricted, attendees, customers, _events(events))
        .withColumnRenamed("status", "ticket_status")
        .select(
            "event_name",
            "event_date",
            "event_type",
            "outreach_restriction",
            "ticket_id",
            "confirmation_status",
            "ticket_status",
            "attendee_name",
            "attendee_email",
            "attendee_phone",
            "purchaser_name",
            "purchaser_email",
            "company_name",
            "vertical",
        )
        .orderBy("event_date", "outreach_restriction", "company_name", "attendee_name", "ticket_id")
    )


def roster(
    all_tickets: DataFrame,
    events: DataFrame,
    attendees: DataFrame,
    customers: DataFrame,
    event_id: str | None = None,
) -> DataFrame:
    """Every ticket and ghost, of one event or of all, with its people."""
    if event_id is not None:
        all_tickets = all_tickets.filter(F.col("event_id") == event_id)
    dimension = _events(
        events, F.col("CityName").alias("event_city"), F.col("VenueName").alias("venue")
    )
    return (
        _ticket_detail(all_tickets, attendees, customers, dimension)
        .withColumnRenamed("status", "ticket_status")
        .select(
            "event_name",
            "event_date",
            "event_type",
            "event_city",
            "venue",
            "ticket_id",
            "ticket_status",
            "confirmation_status",
            "confirmation_method",
            "ticket_type",
            "attendance_type",
            "travel_details",
            "outreach_restriction",
            "ticket_price",
            "is_comped",
            "is_reset_ghost",
            "attendee_name",
            "attendee_email",
            "attendee_phone",
            "first_name",
            "last_name",
            "dietary_restrictions",
            "purchaser_name",
            "purchaser_email",
            "company_name",
            "vertical",
            "SBU",
            "PR",
            "EliteEdge",
        )
        .orderBy("is_reset_ghost", "company_name", "attendee_name", "ticket_id")
    )
