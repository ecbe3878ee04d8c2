from dataclasses import replace
from datetime import date, datetime

import pytest

from compare import SMALL
from rollcall.plans import actions, measures, reports
from rollcall.plans.tickets import tickets_all
from rollcall.sinks import staged
from rollcall.sources.sample import SETTINGS, sample_tables
from test_facts import DATE, STATUS, change, reset

EVENTS = [
    {"CVEventID": "E1", "EventName": "One", "EventCode": "C1", "EventType": "Workshop",
     "StartDate": date(2024, 1, 10), "TargetAttendance": 0, "CityName": "Oslo"},
    {"CVEventID": "E2", "EventName": "Two", "EventType": "Summit",
     "StartDate": date(2024, 1, 25), "TargetAttendance": 4},
]


def test_event_overview(make, rows, settings):
    tables = make(
        dim_event=EVENTS,
        tickets=[
            {"ticket_id": "1", "event_id": "E1", "status": "Open", "confirmation_status": "CONFIRMED"},
            {"ticket_id": "1", "event_id": "E1", "status": "Open", "confirmation_status": "confirmed"},
            {"ticket_id": "2", "event_id": "E1", "status": "Scheduled"},
            {"ticket_id": "3", "event_id": "E1", "status": "Cancelled"},
            {"ticket_id": "4", "event_id": "E1", "status": None},  # dropped like a cancelled one
            {"ticket_id": "5", "event_id": "E2", "status": "x",
             "confirmation_status": "Double Confirmed"},
            {"ticket_id": "6", "event_id": None, "status": "x"},
        ],
        ticket_no_show_resets=[reset("r", "9", "E1", None)],
    )
    overview = reports.event_overview(tickets_all(tables), tables["dim_event"], settings)
    columns = ("event_name", "total_tickets", "confirmed", "double_confirmed", "total_confirmed",
               "pct_confirmed", "pct_of_target")
    assert [tuple(r) for r in overview.select(*columns).collect()] == [
        ("Two", 1, 0, 1, 1, 100.0, 25.0), ("One", 2, 1, 0, 1, 50.0, None),
    ]
    fewer = replace(settings, excluded_statuses=("scheduled", "cancelled"))
    booked = reports.event_overview(tickets_all(tables), tables["dim_event"], fewer)
    assert rows(booked, "event_name", "total_tickets") == [("One", 1), ("Two", 1)]


@pytest.fixture
def log(make):
    """Ann and System work on tickets 1 and 2 of event E1 and 3 of no event."""
    return make(
        dim_event=EVENTS,
        dim_employee=[{"EmployeeName": "Ann", "Email": "ann", "Team": "T"}],
        tickets=[
            {"ticket_id": "1", "event_id": "E1", "status": "attended", "event_date": date(2024, 1, 10)},
            {"ticket_id": "2", "event_id": "E1", "status": "No Show", "event_date": date(2024, 1, 10)},
            {"ticket_id": "3", "status": "attended", "event_date": date(2024, 1, 10)},
            {"ticket_id": "4", "event_id": "E2", "status": "open", "event_date": date(2024, 1, 20)},
        ],
        history=[
            change("1", "ann", STATUS, "Confirmed", datetime(2024, 1, 8, 12)),
            change("1", "ann", DATE, None, datetime(2024, 1, 9, 12)),
            change("2", "ann", STATUS, "Confirmed", datetime(2024, 1, 8, 12)),
            change("2", "System", STATUS, "Confirmed", datetime(2024, 1, 9, 12)),
            change("3", "ann", STATUS, "Confirmed", datetime(2024, 1, 8, 12)),
            change("4", "zed", STATUS, "Confirmed", datetime(2024, 1, 16, 12)),
            change("4", "ann", STATUS, "Double Confirmed", datetime(2024, 1, 14, 12)),
        ],
    )


def test_reports_on_actions(log, rows, settings):
    done = actions.ticket_actions(log, settings)
    performance = reports.rep_performance(done, log["dim_employee"], log["dim_event"])
    assert rows(performance, "rep_name", "action_date", "event_name", "tickets_confirmed") == [
        ("Ann", date(2024, 1, 14), "Two", 1), ("Ann", date(2024, 1, 8), "One", 2),
        ("Ann", date(2024, 1, 9), "One", 1),
    ]
    daily = reports.daily_activity(done, log["dim_event"])
    assert rows(daily, "action_date", "confirmation_touch_source", "tickets_confirmed",
                "total_actions") == [
        (date(2024, 1, 14), "Status Update", 1, 1), (date(2024, 1, 16), "Status Update", 1, 1),
        (date(2024, 1, 8), "Status Update", 2, 2), (date(2024, 1, 9), "Date Update", 1, 1),
    ]
    # Ticket 2 was touched last by a machine, so no rep holds it.
    depth = reports.depth_per_ticket(done, log["dim_event"])
    assert rows(depth, "event_name", "times_confirmed_to_this_status", "ticket_count") == [
        ("One", 2, 1), ("Two", 1, 1), ("Two", 1, 1),
    ]
    outcome = reports.attendance_outcomes(done, log["dim_event"], settings)
    assert rows(outcome, "ticket_status", "tickets") == [("attended", 1)]


def test_same_ticket_twice_a_day_counts_once(make, rows, settings):
    tables = make(
        dim_event=EVENTS,
        tickets=[{"ticket_id": "1", "event_id": "E1"}],
        history=[change("1", by, DATE, None, datetime(2024, 1, 8, 12)) for by in ("ann", "bob")],
    )
    daily = reports.daily_activity(actions.ticket_actions(tables, settings), tables["dim_event"])
    assert rows(daily, "tickets_confirmed", "total_actions") == [(1, 2)]


def test_depth_per_company_and_travel(make, rows, settings):
    def ticket(n, status, **more):
        return {"ticket_id": n, "event_id": "E2", "customer_id": 1, "confirmation_status": status,
                "event_date": date(2024, 1, 20), **more}

    tables = make(
        dim_event=EVENTS,
        customers=[{"id": 1, "name": "Acme"}, {"id": 2, "name": "Bolt"}],
        tickets=[ticket("1", "Confirmed"), ticket("2", "double confirmed", travel_details="Both"),
                 ticket("3", None), ticket("4", None, customer_id=2),
                 ticket("5", "Confirmed", event_date=date(2024, 1, 19))],
    )
    depth = reports.depth_per_company(
        tickets_all(tables), tables["dim_event"], tables["customers"], settings
    )
    assert rows(depth, "company_name", "total_tickets", "confirmed_tickets",
                "double_confirmed_tickets", "total_confirmed_tickets") == [("Acme", 4, 2, 1, 3)]
    travel = reports.travel_status(tickets_all(tables), tables["dim_event"], settings)
    got = [tuple(r) for r in travel.select("travel_category", "tickets").collect()]
    assert got == [("Not Confirmed", 1), ("Both", 1)]  # today counts, yesterday does not


def test_queue_and_roster(make, rows, settings):
    def ticket(n, **more):
        return {"ticket_id": n, "event_id": "E2", "customer_id": 1, "attendee_id": 5,
                "event_date": date(2024, 1, 25), **more}

    tables = make(
        dim_event=EVENTS,
        customers=[{"id": 1, "name": "Acme", "EliteEdge": "3"}],
        attendees=[{"attendee_id": 5, "customer_id": 99, "attendee_name": "Al"}],
        tickets=[ticket("1", outreach_restriction="Do Not Call"),
                 ticket("2", outreach_restriction=""),
                 ticket("3", outreach_restriction="Do Not Blast", attendee_id=None),
                 ticket("4", outreach_restriction="Do Not Call", event_date=date(2024, 1, 2)),
                 ticket("5", event_id="E1")],
        ticket_no_show_resets=[reset("r", "9", "E1", None, customer_id=1, attendee_id=5)],
    )
    sources = (tickets_all(tables), tables["dim_event"], tables["attendees"], tables["customers"])
    queue = reports.outreach_queue(*sources, settings)
    assert rows(queue, "ticket_id", "company_name", "attendee_name") == [("1", "Acme", "Al")]
    full = reports.roster(*sources)
    assert len(full.columns) == 29
    assert [r.ticket_id for r in full.collect()] == ["1", "2", "4", "5", "r"]  # ghosts last
    assert rows(reports.roster(*sources, event_id="E1"), "ticket_id", "event_city") == [
        ("5", "Oslo"), ("r", "Oslo"),
    ]


# --- measures ----------------------------------------------------------------------


def test_a_fixed_status_replaces_the_group(log, rows, settings):
    facts = actions.confirmation_actions(log, settings)
    by_status = measures.confirmations(facts, ["confirmation_status"], settings)
    assert rows(by_status, "confirmation_status", "confirmations", "confirmed",
                "double_confirmed") == [("Confirmed", 4, 4, 1), ("Double Confirmed", 4, 4, 1)]
    total = measures.confirmations(facts, [], settings)
    assert rows(total) == [(4, 4, 1, 1)]
    assert measures.with_titles(total).columns == [
        "Confirmations", "Confirmed", "Double Confirmed", "Double Confirmations",
    ]


def test_weeks_ignore_week_groups_but_not_days(log, rows, settings):
    facts = actions.confirmation_actions(log, settings)
    by_week = measures.week_over_week(facts, ["week_label"], settings)
    assert {r[1:] for r in rows(by_week)} == {(1, 4, -3, -0.75)}
    by_day = measures.week_over_week(facts, ["action_date_az"], settings)
    assert rows(by_day, "action_date_az", "confirmations_tw", "confirmations_lw", "wow_pct") == [
        (date(2024, 1, 14), 0, 1, -1.0), (date(2024, 1, 16), 1, 0, None),
        (date(2024, 1, 8), 0, 3, -1.0), (date(2024, 1, 9), 0, 1, -1.0),
    ]


def test_depth_measures(log, rows, settings):
    facts = actions.confirmation_actions(log, settings)
    per_ticket = measures.depth(facts, ["ticket_id"], settings)
    assert rows(per_ticket, "ticket_id", "net_new_confirmed", "tickets_confirmed_2plus",
                "times_confirmed", "times_double_confirmed") == [
        ("1", 1, 1, 2, 0), ("2", 1, 1, 2, 0), ("3", 1, 0, 1, 0), ("4", 1, 0, 1, 1),
    ]
    today = replace(settings, as_of=datetime(2024, 1, 16, 9))
    assert rows(measures.depth(facts, [], today), "net_new_confirmed_today") == [(1,)]


def test_outcome_measures(log, rows, settings):
    facts = actions.confirmation_actions(log, settings)
    got = measures.outcomes(facts, [], settings).first().asDict()
    # Ticket 4's event is on the as-of day, which has begun.
    assert got["confirmed_past"] == 3 and got["confirmed_attended"] == 2
    assert got["dc_past"] == 1 and got["dc_attended"] == 0
    assert got["dc_attendance_pct"] is None and got["confirmed_no_show_pct"] is None
    midnight = replace(settings, as_of=datetime(2024, 1, 20))
    assert measures.outcomes(facts, [], midnight).first()["confirmed_past"] == 2


def test_days_to_double_may_be_negative(log, rows, settings):
    facts = actions.confirmation_actions(log, settings)
    assert rows(measures.days_to_double(facts, [], settings)) == [(-2.0,)]
    assert rows(measures.days_to_double(facts, ["confirmation_status"], settings)) == [
        ("Confirmed", -2.0), ("Double Confirmed", -2.0),
    ]


def test_travel_reaches_actions_through_tickets(make, rows, settings):
    tables = make(
        tickets=[
            {"ticket_id": "1", "double_confirm_type": "BOTH"},
            {"ticket_id": "2", "double_confirm_type": "Other"},
            {"ticket_id": "3", "travel_details": "Both"},  # no travel confirmation
        ],
        history=[change(n, "ann", STATUS, "Confirmed", datetime(2024, 1, 8)) for n in "123"],
    )
    facts = actions.confirmation_actions(tables, settings)
    got = measures.travel(facts, tickets_all(tables), [], settings)
    assert rows(got) == [(2, 0, 0, 1, 0)]


def test_businesses_count_a_blank_name_once(make, rows, settings):
    names = ["Acme", "ACME", "Bolt", None, None]
    tables = make(customers=[{"id": n, "name": name} for n, name in enumerate(names)])
    assert rows(measures.businesses(tables["customers"], [], settings)) == [(3,)]


def test_event_health(make, rows, settings):
    tables = make(
        tickets=[{"ticket_id": "1", "event_id": "E", "confirmation_status": "CONFIRMED"},
                 {"ticket_id": "1", "event_id": "E", "confirmation_status": "Confirmed"},
                 {"ticket_id": "2", "event_id": "E", "status": "cancelled"},
                 {"ticket_id": "3", "event_id": "F"}],
        ticket_no_show_resets=[reset("r", "9", "G", None)],
    )
    facts = tickets_all(tables)
    assert rows(measures.event_health(facts, ["event_id"], settings)) == [
        ("E", 2, 1, 0.5), ("F", 1, 0, None), ("G", 0, 0, None),
    ]


def test_measures_of_nothing(make, rows, settings):
    empty = actions.confirmation_actions(make(), settings)
    assert rows(measures.confirmations(empty, [], settings)) == [(0, 0, 0, 0)]
    assert rows(measures.week_over_week(empty, [], settings)) == [(0, 0, 0, None)]
    assert rows(measures.days_to_double(empty, [], settings)) == [(None,)]
    status = measures.data_status(empty, [], settings).first()[0]
    assert status == "Data through  AZ  •  Viewed Jan 20 at 8:30 AM"


def test_measures_of_several_grains_read_the_log_once(spark):
    log = staged(actions.confirmation_actions(sample_tables(spark, SMALL), SETTINGS))
    for measure, groups in (
        (measures.confirmations, ["week_label", "confirmation_status"]),
        (measures.week_over_week, ["user_email", "week_label"]),
        (measures.depth, ["week_start_date", "confirmation_status"]),
        (measures.depth, ["confirmation_status"]),
        (measures.days_to_double, ["user_email", "confirmation_status"]),
        (measures.outcomes, ["is_last_confirmer", "ticket_outcome"]),
    ):
        plan = measure(log, groups, SETTINGS)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan parquet") == 1, (measure, groups)


def test_a_ticket_in_several_groups_counts_once_in_their_grain(spark, rows):
    # Ticket a is confirmed in both weeks; whatever the status shown, each week counts it once.
    acts = [("a", "x", "Confirmed", 1), ("a", "x", "Double Confirmed", 1), ("a", "y", "Confirmed", 1), ("b", "x", "Confirmed", 1), (None, "x", "Confirmed", 1)]
    log = spark.createDataFrame(acts, "ticket_id string, week_label string, confirmation_status string, is_rep_action int")
    got = measures.confirmations(log, ["week_label", "confirmation_status"], SETTINGS)
    assert rows(got, "week_label", "confirmation_status", "confirmations", "confirmed", "double_confirmed") == [
        ("x", "Confirmed", 2, 2, 1), ("x", "Double Confirmed", 2, 2, 1), ("y", "Confirmed", 1, 1, 0),
    ]
    by_ticket = measures.confirmations(log, ["ticket_id", "confirmation_status"], SETTINGS)
    assert rows(by_ticket, "ticket_id", "confirmation_status", "confirmations") == sorted(
        [("a", "Confirmed", 1), ("a", "Double Confirmed", 1), ("b", "Confirmed", 1), (None, "Confirmed", 0)], key=repr
    )
