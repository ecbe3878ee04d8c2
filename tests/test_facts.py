from datetime import date, datetime

from compare import SMALL
from rollcall.plans import actions
from rollcall.plans.tickets import tickets_all
from rollcall.sinks import staged
from rollcall.sources.sample import SETTINGS, sample_tables
from rollcall.sources.schemas import CONFIRMATION_ACTIONS, TICKETS_ALL

STATUS, DATE = "Confirmation status updated", "Confirmation date updated"


def change(ticket, by, action, value, at):
    return {
        "ticket_id": ticket, "changed_by": by, "action": action, "new_value": value,
        "changed_at": at,
    }


def reset(ticket, root, event, at, status="Confirmed", **more):
    return {
        "ticket_id": ticket, "root_ticket_id": root, "event_id": event, "reset_at": at,
        "confirmation_status": status, **more,
    }


# --- tickets_all -----------------------------------------------------------------


def test_ghosts(make, rows):
    noon, later = datetime(2024, 1, 1, 12), datetime(2024, 1, 2, 12)
    tables = make(
        tickets=[{"ticket_id": "1", "event_id": "E1", "is_comped": 1},
                 {"ticket_id": "2", "event_id": None}],
        ticket_no_show_resets=[
            reset("1-a", "1", "E1", noon),  # still on the event
            reset("1-b", "1", "E2", noon),  # older of two
            reset("1-c", "1", "E2", later),
            reset("2-a", "2", None, noon),  # a NULL event matches nothing
            reset("x-a", None, "E1", noon),  # so does a NULL root
            reset("3-b", "3", "E1", noon, "double confirmed"),  # equal times: smaller id
            reset("3-a", "3", "E1", noon, "CONFIRMED"),
            reset("4-a", "4", "E1", later, "Undecided"),  # not confirmed
        ],
    )
    all_tickets = tickets_all(tables)
    assert all_tickets.columns == TICKETS_ALL.names
    assert [f.dataType for f in all_tickets.schema] == [f.dataType for f in TICKETS_ALL]
    ghosts = all_tickets.filter("is_reset_ghost")
    assert rows(ghosts, "ticket_id", "status", "is_comped", "person_id") == [
        ("1-c", "no show", 0, None), ("2-a", "no show", 0, None),
        ("3-a", "no show", 0, None), ("x-a", "no show", 0, None),
    ]
    assert rows(all_tickets.filter("NOT is_reset_ghost"), "ticket_id", "is_comped") == [
        ("1", 1), ("2", 0),
    ]


def test_live_filter_removes_the_ghost_branch(spark):
    live = tickets_all(sample_tables(spark, SMALL)).filter("NOT is_reset_ghost")
    plan = live._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and "Window" not in plan and "LeftAnti" not in plan


def test_travel_type_falls_back_on_live_tickets_only(make, rows):
    tables = make(
        tickets=[
            {"ticket_id": "1", "double_confirm_type": "Both", "travel_details": "Hotel Only"},
            {"ticket_id": "2", "travel_details": "Is Local"},
        ]
    )
    assert rows(tickets_all(tables), "ticket_id", "travel_type") == [
        ("1", "Both"), ("2", "Is Local"),
    ]


# --- touches ---------------------------------------------------------------------


def test_touch_sources(make, rows, settings):
    at = datetime(2024, 1, 10, 3)  # the evening before, in Arizona
    tables = make(
        history=[
            change("1", "ann", STATUS, "double CONFIRMED", at),
            change("1", "System", STATUS, "confirmed", at),
            change("1", None, DATE, "anything", at),
            change("1", "ann", STATUS, "Undecided", at),
            change("1", "ann", "Note added", "Confirmed", at),
        ]
    )
    touches = actions.history_touches(tables["history"], settings)
    columns = ("user_email", "confirmation_status", "action_date_az", "is_rep_action",
               "confirmation_touch_source")
    day = date(2024, 1, 9)
    assert rows(touches, *columns) == [
        ("System", "Confirmed", day, 0, "Status Update"),
        ("ann", "Double Confirmed", day, 1, "Status Update"),
        (None, "Confirmed", day, 1, "Date Update"),  # an unknown actor is a person
    ]
    split = actions.status_touches(tables["history"], settings).unionByName(
        actions.date_touches(tables["history"], settings)
    )
    assert rows(split) == rows(touches)


def test_pre_history(make, rows, settings):
    day = date(2024, 1, 3)
    tables = make(
        tickets=[
            {"ticket_id": "1", "confirmed_by": "ann", "confirmed_date": day,
             "double_confirmed_by": "bob"},
            {"ticket_id": "2", "confirmed_by": "System", "double_confirmed_by": "bulk-import"},
            {"ticket_id": "3", "confirmed_by": "ann"},  # has a status change
            {"ticket_id": "4", "confirmed_by": "ann"},  # has other changes only
        ],
        history=[
            change("3", "bob", STATUS, "Confirmed", datetime(2024, 1, 5)),
            change("4", "bob", DATE, None, datetime(2024, 1, 5)),
            change(None, "bob", STATUS, "Confirmed", datetime(2024, 1, 5)),
        ],
    )
    touches = actions.pre_history_touches(tables["tickets"], tables["history"], settings)
    assert rows(touches, "ticket_id", "user_email", "confirmation_status", "action_ts_az") == [
        ("1", "ann", "Confirmed", datetime(2024, 1, 3)),
        ("1", "bob", "Double Confirmed", None),
        ("4", "ann", "Confirmed", None),
    ]


def test_one_action_per_actor_ticket_status_and_day(make, rows, settings):
    tables = make(
        history=[
            change("1", "ann", STATUS, "Confirmed", datetime(2024, 1, 10, 20)),
            change("1", "ann", DATE, None, datetime(2024, 1, 10, 20)),  # equal: source decides
            change("1", "ann", STATUS, "Confirmed", datetime(2024, 1, 10, 21)),
            change("1", "ann", STATUS, "Double Confirmed", datetime(2024, 1, 10, 21)),
            change("1", "bob", STATUS, "Confirmed", datetime(2024, 1, 10, 21)),
            change("1", "ann", STATUS, "Confirmed", datetime(2024, 1, 11, 21)),
        ]
    )
    unique = actions.unique_actions(tables, settings)
    assert rows(unique, "user_email", "confirmation_status", "action_ts_az",
                "confirmation_touch_source") == [
        ("ann", "Confirmed", datetime(2024, 1, 10, 13), "Date Update"),
        ("ann", "Confirmed", datetime(2024, 1, 11, 14), "Status Update"),
        ("ann", "Double Confirmed", datetime(2024, 1, 10, 14), "Status Update"),
        ("bob", "Confirmed", datetime(2024, 1, 10, 14), "Status Update"),
    ]


def test_first_travel_and_reset_context(make, rows, settings):
    tables = make(
        tickets=[{"ticket_id": "1", "double_confirm_type": "Both"}, {"ticket_id": "2"}],
        history=[
            change("1", "System", STATUS, "Confirmed", datetime(2024, 1, 2)),
            change("1", None, STATUS, "Confirmed", datetime(2024, 1, 3)),
            change("1", "ann", STATUS, "Confirmed", datetime(2024, 1, 9, 12)),
            change("1", "ann", STATUS, "Confirmed", datetime(2024, 1, 8, 12)),
            change("2", "ann", STATUS, "Confirmed", datetime(2024, 1, 8, 12)),
        ],
        ticket_no_show_resets=[
            reset("a", "1", "E", None, event_date=date(2024, 1, 5), scheduled_event_name="Zeta"),
            reset("b", "1", "E", None, event_date=date(2024, 1, 9), scheduled_event_name="Alef"),
            reset("c", None, "E", None, event_date=date(2024, 1, 1)),
        ],
    )
    assert rows(actions.first_travel(tables, settings)) == [("1", date(2024, 1, 8))]
    # The earliest date and the smallest name, though of different resets.
    assert rows(actions.reset_context(tables["ticket_no_show_resets"])) == [
        ("1", date(2024, 1, 5), "Alef"),
    ]


# --- confirmation actions ----------------------------------------------------------


def test_outcomes_and_first_travel_flag(make, rows, settings):
    at = datetime(2024, 1, 8, 12)
    tables = make(
        tickets=[
            {"ticket_id": "1", "status": "Attended", "double_confirm_type": "Both"},
            {"ticket_id": "2", "status": "no show"},
            {"ticket_id": "3", "status": "No Show", "event_date": date(2024, 1, 3)},
            {"ticket_id": "4", "status": "CANCELLED"},
            {"ticket_id": "5"},
        ],
        history=[change(t, "ann", STATUS, "Confirmed", at) for t in "123456"],
        ticket_no_show_resets=[
            reset("r1", "1", "E", None, event_date=date(2024, 1, 1)),
            reset("r2", "2", "E", None),
            reset("r6", "6", "E", None, event_date=date(2024, 1, 2)),
        ],
    )
    log = actions.confirmation_actions(tables, settings)
    assert log.columns == CONFIRMATION_ACTIONS
    assert rows(log, "ticket_id", "ticket_outcome", "is_no_show_reset", "original_event_date",
                "is_first_travel_action") == [
        ("1", "Attended", 1, date(2024, 1, 1), 1),
        ("2", "No Show (Reset)", 1, None, 0),
        ("3", "No Show", 0, date(2024, 1, 3), 0),
        ("4", "Cancelled", 0, None, 0),
        ("5", "Upcoming", 0, None, 0),
        ("6", "No Show (Reset)", 1, date(2024, 1, 2), 0),  # the ticket itself is gone
    ]
    assert actions.ticket_actions(tables, settings).count() == 5


def test_ranks_cover_all_actors(make, rows, settings):
    tables = make(
        tickets=[{"ticket_id": "1", "confirmed_by": "eve"}],
        history=[
            change("1", "ann", DATE, None, datetime(2024, 1, 10, 20)),
            change("1", "bob", DATE, None, datetime(2024, 1, 10, 20)),  # equal time: by actor
            change("1", "System", DATE, None, datetime(2024, 1, 12, 20)),
            change("1", "ann", DATE, None, None),  # no time: before all others
        ],
    )
    log = actions.confirmation_actions(tables, settings)
    got = rows(log, "ticket_confirmation_rank", "user_email", "is_last_confirmer", "week_label",
               "ticket_status_action_count", "ticket_total_action_count")
    assert got == [
        (1, "ann", 0, " Weeks Ahead", 5, 5),
        (2, "eve", 0, " Weeks Ahead", 5, 5),
        (3, "ann", 0, "Last Week", 5, 5),
        (4, "bob", 0, "Last Week", 5, 5),
        (5, "System", 1, "Last Week", 5, 5),
    ]


def test_a_third_of_the_history_on_no_ticket(spark, rows):
    tables = sample_tables(spark, SMALL)
    history = tables["history"].selectExpr(
        "CASE WHEN hash(ticket_id, changed_at) % 3 <> 0 THEN ticket_id END AS ticket_id",
        "changed_by", "action", "new_value",
        "CASE WHEN hash(changed_at) % 50 <> 0 THEN changed_at END AS changed_at",
    )
    log = actions.confirmation_actions(tables.replaced(history=history), SETTINGS)
    got = [r.asDict() for r in log.collect()]
    groups = {}
    for r in got:
        groups.setdefault((r["ticket_id"], r["confirmation_status"]), []).append(r)
    total = {}
    for (ticket, _), of_group in groups.items():
        total[ticket] = total.get(ticket, 0) + len(of_group)

    def order(r):
        at, user = r["action_time_az"], r["user_email"]
        return (at is not None, at or 0, r["confirmation_touch_source"], user is not None, user or "")

    for (ticket, _), of_group in groups.items():
        for rank, r in enumerate(sorted(of_group, key=order), 1):
            assert r["ticket_confirmation_rank"] == rank
            assert r["ticket_status_action_count"] == len(of_group)
            assert r["ticket_total_action_count"] == total[ticket]
            assert r["is_last_confirmer"] == (rank == len(of_group))
    assert max(len(g) for (ticket, _), g in groups.items() if ticket is None) > 100


def test_the_history_is_read_once(spark, monkeypatch):
    plans = []

    def noted(df):
        plans.append(df._jdf.queryExecution().analyzed().toString())
        return staged(df)

    monkeypatch.setattr(actions, "staged", noted)
    tables = sample_tables(spark, SMALL)
    log = actions.confirmation_actions(tables, SETTINGS)
    assert len(plans) == 1 and "Confirmation status updated" in plans[0]
    rest = log._jdf.queryExecution().optimizedPlan().toString()
    assert "Confirmation status updated" not in rest and "event_type" not in rest


def test_same_actions_under_other_partitioning(spark, rows):
    expected = rows(actions.confirmation_actions(sample_tables(spark, SMALL), SETTINGS))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        again = sample_tables(spark, SMALL)
        again = again.replaced(history=again["history"].repartition(5))
        assert rows(actions.confirmation_actions(again, SETTINGS)) == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_no_dimension_is_cut(spark):
    sources = {"dim_event": "part", "dim_employee": "supplier", "dim_customer": "customer"}
    tables = sample_tables(spark, SMALL)
    for table, source in sources.items():
        rows = spark.read.parquet(f"{SMALL}/{source}.parquet").count()
        assert tables[table].distinct().count() == rows
