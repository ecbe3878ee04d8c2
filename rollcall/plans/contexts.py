"""What a report is restricted to, and how that reaches the facts of a measure.

A report restricts columns of any table of the model. The restrictions run along its relations:

    events, customers -> tickets -> actions <- employees

Tests on events and customers select tickets, all of these select ticket ids, and the actions are cut
to those ids and to the addresses of the employees that pass. Every step is a semi join below the
first aggregate of a measure, so rows out of the report's scope are never shuffled to be counted, and
a table or a key that is recorded twice repeats nothing. Tests on the facts' own columns are handed to
the measure, which replaces those on columns it restricts itself (`measures.py`).

Actions without a ticket, tickets without an event or customer, and actions of unknown people pass
as long as nothing is asked of the missing row.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from rollcall.plans import measures
from rollcall.plans.measures import Filters, where
from rollcall.settings import Settings


@dataclass(frozen=True)
class Model:
    """The two facts and the tables they are related to."""

    actions: DataFrame
    tickets: DataFrame
    events: DataFrame
    customers: DataFrame
    employees: DataFrame


@dataclass(frozen=True)
class Context:
    """Tests by column, for each table."""

    tickets: Filters = field(default_factory=dict)
    events: Filters = field(default_factory=dict)
    customers: Filters = field(default_factory=dict)
    employees: Filters = field(default_factory=dict)
    actions: Filters = field(default_factory=dict)

    @property
    def reaches_tickets(self) -> bool:
        return bool(self.tickets or self.events or self.customers)


def _related(rows: DataFrame, key: str, table: DataFrame, its_key: str, tests: Filters) -> DataFrame:
    """The rows whose related row passes; all of them if nothing is asked of it."""
    if not tests:
        return rows
    passing = where(table, tests).select(table[its_key].alias(key))
    return rows.join(passing, key, "left_semi")


def related_tickets(model: Model, context: Context) -> DataFrame:
    """Tickets of the events and customers that pass; their own columns are left to the measure."""
    tickets = _related(model.tickets, "event_id", model.events, "CVEventID", context.events)
    return _related(tickets, "customer_id", model.customers, "id", context.customers)


def ticket_keys(model: Model, context: Context, but: Collection[str] = ()) -> DataFrame:
    """Ids of the tickets that pass, each once; tests on the columns of `but` are left out."""
    own = {column: test for column, test in context.tickets.items() if column not in but}
    return where(related_tickets(model, context), own).select("ticket_id").distinct()


def related_actions(model: Model, context: Context, but: Collection[str] = ()) -> DataFrame:
    """Actions on tickets and by employees that pass; their own columns are left to the measure."""
    actions = _related(model.actions, "user_email", model.employees, "Email", context.employees)
    if context.events or context.customers or set(context.tickets) - set(but):
        actions = actions.join(ticket_keys(model, context, but), "ticket_id", "left_semi")
    return actions


_OF_ACTIONS = {
    "confirmations": measures.confirmations,
    "week_over_week": measures.week_over_week,
    "data_status": measures.data_status,
    "depth": measures.depth,
    "outcomes": measures.outcomes,
    "days_to_double": measures.days_to_double,
}
NAMES = [*_OF_ACTIONS, "businesses", "travel", "event_health"]


def measured(
    name: str, model: Model, context: Context, group_cols: Sequence[str], settings: Settings
) -> DataFrame:
    """The measures of that name per group, as a report restricted to the context shows them."""
    if name in _OF_ACTIONS:
        actions = related_actions(model, context)
        return _OF_ACTIONS[name](actions, group_cols, settings, context.actions)
    if name == "businesses":
        return measures.businesses(model.customers, group_cols, settings, context.customers)
    if name == "event_health":
        tickets = related_tickets(model, context)
        return measures.event_health(tickets, group_cols, settings, context.tickets)
    # The types of travel replace a test on the type, so it is not among those that select ids.
    actions = related_actions(model, context, but=["travel_type"])
    of_type = context.tickets.get("travel_type")
    return measures.travel(actions, model.tickets, group_cols, settings, context.actions, of_type)
