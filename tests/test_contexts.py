"""Measures in a restricted report, on literal rows and in their plans."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from compare import SMALL
from rollcall.plans import actions, contexts
from rollcall.plans.contexts import Context, Model, measured
from rollcall.plans.tickets import tickets_all
from rollcall.sinks import staged
from rollcall.sources.sample import SETTINGS, sample_tables

ACTIONS = (
    "user_email string, ticket_id string, confirmation_status string, week_label string, week_offset int, "
    "week_start_date date, week_number int, week_year int, action_date_az date, is_rep_action int, "
    "is_first_travel_action int, ticket_confirmation_rank int, ticket_status_action_count long"
)
TICKETS = (
    "ticket_id string, event_id string, customer_id long, product_name string, travel_type string, "
    "confirmation_status string, is_reset_ghost boolean"
)


@pytest.fixture(scope="module")
def model(spark):
    def action(who, ticket, status, offset=0, travel=0, rank=1, touches=1):
        label = {0: "This Week", -1: "Last Week"}[offset]
        week = date(2024, 1, 15 + 7 * offset)
        return (who, ticket, status, label, offset, week, 3 + offset, 2024, week, 1, travel, rank, touches)

    acts = [
        action("ann", "a", "Confirmed", 0, 1),
        action("ann", "b", "Double Confirmed", -1),
        action("bob", "a", "Confirmed", -1, 0, 2, 2),
        action("bob", "c", "Confirmed", 0, 1),
        action("eve", "d", "Confirmed"),  # no such ticket, no such employee
        action(None, None, "Confirmed"),
    ]
    tickets = [
        ("a", "E1", 1, "Alpha VIP", "Both", "Confirmed", False),
        ("a", "E2", 1, "Alpha VIP", "Both", "Confirmed", True),  # a ghost of the same ticket
        ("b", "E2", 2, "Alpha", "Hotel Only", "Double Confirmed", False),
        ("c", "E2", 2, "Beta VIP", "Hotel Only", None, False),
        ("e", None, None, "Beta", None, "Confirmed", False),
    ]
    events = [("E1", "Gala"), ("E1", "Gala"), ("E2", "Fair")]  # recorded twice
    return Model(
        spark.createDataFrame(acts, ACTIONS),
        spark.createDataFrame(tickets, TICKETS),
        spark.createDataFrame(events, "CVEventID string, EventType string"),
        spark.createDataFrame([(1, "x", "Arts"), (2, "y", "Law"), (2, "Y", "Law")], "id long, name string, vertical string"),
        spark.createDataFrame([("ann", "North"), ("bob", "South"), ("bob", "South")], "Email string, Team string"),
    )


def test_each_table_reaches_the_actions(model, rows):
    def of(**tests):
        df = measured("confirmations", model, Context(**tests), [], SETTINGS)
        return rows(df, "confirmations", "confirmed", "double_confirmed")

    assert of() == [(4, 3, 1)]
    assert of(tickets={"product_name": F.col("product_name").contains("VIP")}) == [(2, 2, 0)]
    assert of(events={"EventType": F.col("EventType") == "Gala"}) == [(1, 1, 0)]
    # The ghost is at the fair.
    assert of(events={"EventType": F.col("EventType") == "Fair"}) == [(3, 2, 1)]
    assert of(customers={"vertical": F.col("vertical") == "Law"}) == [(2, 1, 1)]
    assert of(employees={"Team": F.col("Team") == "South"}) == [(2, 2, 0)]
    assert of(actions={"week_label": F.col("week_label") == "Last Week"}) == [(2, 1, 1)]
    everything = of(
        tickets={"product_name": F.col("product_name").contains("VIP")},
        events={"EventType": F.col("EventType") == "Fair"},
        employees={"Team": F.col("Team") == "South"},
        customers={"vertical": F.col("vertical") == "Law"},
        actions={"week_label": F.col("week_label") == "This Week"},
    )
    assert everything == [(1, 1, 0)]
    assert of(tickets={"product_name": F.lit(False)}) == [(0, 0, 0)]


def test_only_groups_that_are_shown(model, rows):
    context = Context(tickets={"product_name": F.col("product_name").contains("VIP")})
    got = measured("confirmations", model, context, ["user_email"], SETTINGS)
    assert rows(got, "user_email", "confirmations") == [("ann", 1), ("bob", 2)]


def test_a_measure_replaces_a_test_on_its_column(model, rows):
    status = {"confirmation_status": F.col("confirmation_status") == "Double Confirmed"}
    got = measured("confirmations", model, Context(actions=status), ["user_email"], SETTINGS)
    # Bob has no such action, so he is not shown; Ann's counts ignore the test on the status.
    assert rows(got, "user_email", "confirmations", "confirmed") == [("ann", 2, 1)]
    last = {"week_label": F.col("week_label") == "Last Week"}
    got = measured("week_over_week", model, Context(actions=last), ["user_email"], SETTINGS)
    assert rows(got, "user_email", "confirmations_tw", "confirmations_lw") == [("ann", 1, 1), ("bob", 1, 1)]
    touched = {"ticket_confirmation_rank": F.col("ticket_confirmation_rank") == 2}
    got = measured("depth", model, Context(actions=touched), [], SETTINGS)
    # First confirmations are of rank 1 whatever is shown; the other two figures keep the test.
    assert rows(got, "net_new_confirmed", "tickets_confirmed_2plus", "times_confirmed") == [(3, 1, 2)]


def test_travel_types_replace_a_test_on_the_type(model, rows):
    both = Context(tickets={"travel_type": F.col("travel_type") == "Both"})
    got = measured("travel", model, both, [], SETTINGS)
    assert rows(got, "rt_travel_confirmed", "rt_both", "rt_hotel_only") == [(1, 1, 1)]
    vip = Context(tickets={**both.tickets, "product_name": F.col("product_name") == "Alpha VIP"})
    got = measured("travel", model, vip, [], SETTINGS)
    assert rows(got, "rt_travel_confirmed", "rt_both", "rt_hotel_only") == [(1, 1, 0)]
    first = Context(actions={"is_first_travel_action": F.col("is_first_travel_action") == 0})
    got = measured("travel", model, first, ["user_email"], SETTINGS)
    assert rows(got, "user_email", "rt_travel_confirmed") == [("ann", 1), ("bob", 1), ("eve", 0), (None, 0)]


def test_tickets_and_customers(model, rows):
    fair = Context(events={"EventType": F.col("EventType") == "Fair"})
    assert rows(measured("event_health", model, fair, [], SETTINGS), "total_tickets", "confirmed_tickets") == [(2, 1)]
    some = Context(tickets={"confirmation_status": F.col("confirmation_status").isNull()})
    assert rows(measured("event_health", model, some, [], SETTINGS), "total_tickets", "confirmed_tickets") == [(1, 3)]
    law = Context(customers={"vertical": F.col("vertical") == "Law"})
    assert rows(measured("businesses", model, law, [], SETTINGS)) == [(1,)]


def test_selecting_comes_before_counting(spark):
    tables = sample_tables(spark, SMALL)
    log = staged(actions.confirmation_actions(tables, SETTINGS))
    tickets = staged(tickets_all(tables))
    model = Model(log, tickets, tables["dim_event"], tables["customers"], tables["dim_employee"])
    context = Context(
        tickets={"product_name": F.col("product_name").contains("VIP")},
        employees={"Team": F.col("Team") < "NATION_15"},
        actions={"week_offset": F.col("week_offset") <= 0},
    )
    for name in ("confirmations", "outcomes", "depth", "week_over_week", "travel"):
        plan = measured(name, model, context, [], SETTINGS)._jdf.queryExecution().optimizedPlan().toString()
        lines = plan.splitlines()
        # The first thing that counts actions lies above the semi joins, which read the log itself.
        semi = [i for i, line in enumerate(lines) if "Join LeftSemi" in line]
        counts = [i for i, line in enumerate(lines) if "Aggregate" in line and "is_rep_action" not in line]
        assert len(semi) >= 2 and min(counts) < min(semi), name
        indent = lines[semi[0]].index("Join")
        below = [line for line in lines[semi[0] :] if "Relation" in line]
        assert below and indent > lines[min(counts)].index("Aggregate")


def test_every_measure_has_a_name():
    assert contexts.NAMES == [
        "confirmations", "week_over_week", "data_status", "depth", "outcomes", "days_to_double",
        "businesses", "travel", "event_health",
    ]
