"""All tickets: live ones plus the ghosts that no-show resets leave behind."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions.predicates import is_any_confirmed
from rollcall.operators.picks import keep_first
from rollcall.sources.schemas import TICKETS_ALL
from rollcall.sources.tables import Tables


def _as_tickets_all(df: DataFrame, **special: Column) -> DataFrame:
    """Projects onto the shared layout; columns the source lacks become typed NULLs."""
    return df.withColumns(special).to(TICKETS_ALL)


def live_tickets(tickets: DataFrame) -> DataFrame:
    return _as_tickets_all(
        tickets,
        is_comped=F.coalesce("is_comped", F.lit(0)),
        travel_type=F.coalesce("double_confirm_type", "travel_details"),
        is_reset_ghost=F.lit(False),
    )


def ghost_tickets(tickets: DataFrame, resets: DataFrame) -> DataFrame:
    """Confirmed resets, the latest per (event, root ticket), gone from that event.

    Whether the root ticket still sits on the event depends on the group key
    alone, so the groups are cut to one row first; the anti join then reuses
    their partitioning and no key has more than one row in it. A NULL root or
    event matches no ticket and stays.
    """
    latest = keep_first(
        resets.filter(is_any_confirmed(F.col("confirmation_status"))),
        ["event_id", "root_ticket_id"],
        [F.desc_nulls_last("reset_at"), F.asc_nulls_first("ticket_id")],
    )
    still_there = tickets.select(
        F.col("event_id"), F.col("ticket_id").alias("root_ticket_id")
    )
    gone = latest.join(still_there, ["event_id", "root_ticket_id"], "left_anti")
    return _as_tickets_all(
        gone,
        status=F.lit("no show"),
        is_comped=F.coalesce("is_comped", F.lit(0)),
        travel_type=F.col("double_confirm_type"),
        is_reset_ghost=F.lit(True),
    )


def tickets_all(tables: Tables) -> DataFrame:
    """One row per live ticket or ghost.

    ``is_reset_ghost`` is a literal in each branch, so a filter on it removes
    the other branch from the plan.
    """
    tickets, resets = tables["tickets"], tables["ticket_no_show_resets"]
    return live_tickets(tickets).unionByName(ghost_tickets(tickets, resets))
