from dataclasses import replace
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from compare import SMALL
from rollcall.plans import lists
from rollcall.sinks import staged
from rollcall.sources.sample import SETTINGS, sample_tables

SPEC = lists.ListSpec("Alpha", "Alpha")


def ticket(ticket_id, **more):
    return {
        "ticket_id": ticket_id, "customer_id": 1, "product_name": "Alpha Workshop",
        "is_deleted": 0, "status": "Open", **more,
    }


def business(**more):
    return {"id": 1, "cv_customer_id": "CV1", "name": "Acme", **more}


OWNER = {
    "dim_customer_contact": [
        {"Customer": "CV1", "Person": 7, "StaffTitleName": "Owner", "IsActiveName": "Yes"}
    ],
    "dim_person": [{"CVPersonID": 7, "PersonName": "Olga", "Email": "o@x.com", "Phone": "1"}],
}


def test_layout():
    assert len(SPEC.columns) == 47
    assert lists.ListSpec("Beta", "Alpha").columns == SPEC.columns
    assert SPEC.columns[37:39] == ["Alpha Customer", "First Alpha Purchase Date"]


def test_full_row(make, settings):
    tables = make(
        customers=[business()],
        tickets=[
            ticket("b", status="Undecided", transaction_id=5, sales_order_id="SO2",
                   undecided_timestamp=datetime(2024, 1, 15, 23, 59),
                   outreach_restriction="Do Not Call"),
            ticket("a", status="EXPIRED", transaction_id=6, sales_order_id=" ",
                   registration_date=datetime(2024, 1, 18), outreach_restriction="Do Not Blast"),
            ticket("c", status="Reserved", event_date=date(2024, 1, 20), sales_order_id="SO1"),
            ticket("d", status="scheduled", event_date=date(2024, 1, 19), sales_order_id="SO1"),
            ticket("e", status="attended", event_date=date(2024, 1, 2)),
            ticket("f", is_deleted=1),
            ticket("g", product_name="Beta", status="mystery"),
            ticket("h", product_name="Beta", status="cancelled"),
        ],
        transactions=[
            {"cv_transaction_id": 5, "transaction_date": datetime(2024, 1, 3, 5)},
            {"cv_transaction_id": 6, "transaction_date": datetime(2024, 1, 8, 5)},
        ],
        attendee_tickets=[
            {"ticket_id": "a", "blast_date": date(2024, 1, 5)},
            {"ticket_id": "f", "last_called_date": date(2024, 1, 9)},  # deleted tickets count
            {"ticket_id": "g", "blast_date": date(2024, 1, 12)},
        ],
        fact_gl=[
            {"CVCustomerID": "CV1", "CVProductID": 1, "GLDate": date(2024, 1, 1), "GLLineID": 0,
             "SalesOrderCashCollected": 1.0},
            {"CVCustomerID": "CV1", "CVProductID": 1, "GLDate": date(2024, 1, 2), "GLLineID": 1,
             "SalesOrderCashCollected": 0.0},
            {"CVCustomerID": "CV1", "CVProductID": 2, "GLDate": date(2024, 1, 3), "GLLineID": 1,
             "SalesOrderCashCollected": 1.0},
            {"CVCustomerID": "CV1", "CVProductID": 1, "GLDate": date(2024, 1, 4), "GLLineID": 1,
             "SalesOrderCashCollected": 1.0},
        ],
        dim_product=[{"CVProductID": 1, "ProductName": "My Alpha"},
                     {"CVProductID": 2, "ProductName": "Beta"}],
        **OWNER,
    )
    row = lists.customer_list(tables, SPEC, settings).collect()[0].asDict()
    expected = {
        "Business Name": "Acme", "CV Customer ID": "CV1", "Contact Source": "business_owner",
        "Unscheduled Ticket Group": "Open/Undecided + Expired", "Total Tickets": 5,
        "Unscheduled Tickets": 2, "Open Tickets": 0, "Undecided Tickets": 1, "Expired Tickets": 1,
        "Scheduled Tickets": 1, "Reserved Tickets": 1, "Attended Tickets": 1,
        "First Purchase Date": date(2024, 1, 3), "Latest Purchase Date": date(2024, 1, 8),
        "Days Since Latest Purchase": 12, "Next Event Date": date(2024, 1, 20),
        "Last Attended Event Date": date(2024, 1, 2), "Outreach Restriction": "Do Not Blast",
        "Last Blast (This Product)": date(2024, 1, 5),
        "Last Call (This Product)": date(2024, 1, 9),
        "Days Since Last Contact (This Product)": 11,
        "Last Blast (All Products)": date(2024, 1, 12),
        "Days Since Last Contact (All Products)": 8,
        "Elite Status": None, "Alpha Customer": "Yes",
        "First Alpha Purchase Date": date(2024, 1, 4),
        "Queue Start Date": datetime(2024, 1, 15, 23, 59), "Days in Queue": 5,
        "Ticket Types": "Alpha Workshop x5", "Ticket IDs": "a, b, c, d, e",
        "Sales Order Numbers": "SO1, SO2",
        "Ticket Summary (This Product)": (
            "undecided: Alpha Workshop x1 | reserved: Alpha Workshop x1 | "
            "scheduled: Alpha Workshop x1 | attended: Alpha Workshop x1 | "
            "expired: Alpha Workshop x1"
        ),
        "Ticket Summary (All Products)": (
            "undecided: Alpha Workshop x1 | reserved: Alpha Workshop x1 | "
            "scheduled: Alpha Workshop x1 | attended: Alpha Workshop x1 | "
            "expired: Alpha Workshop x1 | cancelled: Beta x1 | mystery: Beta x1"
        ),
        "Generated At": datetime(2024, 1, 20, 15, 30),
    }
    assert {name: row[name] for name in expected} == expected


def test_group_labels(spark):
    cases = {(0, 0, 0, 0): "Nothing to Schedule", (0, 0, 0, 2): "Expired Only",
             (0, 1, 0, 0): "Open/Undecided Only", (1, 0, 1, 3): "Open/Undecided + Expired"}
    for counts, label in cases.items():
        got = spark.range(1).select(lists.unscheduled_group(*map(F.lit, counts))).first()[0]
        assert got == label


def test_a_repeated_sale_inflates_row_counts_only(make, settings):
    tables = make(
        customers=[business()],
        tickets=[ticket("a", transaction_id=5)],
        transactions=[{"cv_transaction_id": 5}, {"cv_transaction_id": 5}],
        **OWNER,
    )
    row = lists.customer_list(tables, SPEC, settings).collect()[0]
    assert (row["Total Tickets"], row["Open Tickets"], row["Ticket Types"], row["Ticket IDs"]) == (
        1, 2, "Alpha Workshop x2", "a",
    )
    assert row["Ticket Summary (This Product)"] == "open: Alpha Workshop x1"


def test_types_of_the_distinct_kind(make, settings):
    tables = make(
        customers=[business()],
        tickets=[ticket("a", ticket_type="VIP"), ticket("b", ticket_type="General"),
                 ticket("c", ticket_type="VIP"), ticket("d")],
        **OWNER,
    )
    spec = replace(SPEC, counted_types=False)
    assert lists.customer_list(tables, spec, settings).collect()[0]["Ticket Types"] == "General, VIP"


def test_order_is_by_queue_start_with_missing_first(make, settings):
    queued = {1: datetime(2024, 1, 5), 2: None, 3: datetime(2024, 1, 1)}
    tables = make(
        customers=[business(id=n, cv_customer_id=f"CV{n}") for n in queued],
        tickets=[ticket(str(n), customer_id=n, registration_date=at) for n, at in queued.items()]
        + [ticket("x", customer_id=None)],
        attendees=[{"customer_id": n, "attendee_email": "a@x.com"} for n in queued],
    )
    got = [r["CV Customer ID"] for r in lists.customer_list(tables, SPEC, settings).collect()]
    assert got == ["CV2", "CV3", "CV1"]


# --- contacts --------------------------------------------------------------------


def contacts(make, settings, **tables):
    built = make(customers=[business()], **tables)
    scoped = lists.scope(built, "Alpha")
    return lists.contact_candidates(built, scoped, settings)


FIELDS = ("contact_email", "contact_name", "contact_phone", "contact_source")


def test_purchaser_contacts(make, rows, settings):
    found = contacts(
        make, settings,
        tickets=[
            ticket("a", purchaser_email="p@x.com", purchaser_name="ImportJob", transaction_id=5),
            ticket("b", purchaser_email="", purchaser_name="Pat", transaction_id=5),
            ticket("c", purchaser_email="ImportJob", transaction_id=6),  # none usable
            ticket("d", purchaser_email=None),
        ],
        transactions=[
            {"cv_transaction_id": 5, "purchaser_email": "s@x.com", "purchaser_name": "ImportJob",
             "purchaser_phone": "9"},
            {"cv_transaction_id": 6, "purchaser_email": ""},
        ],
    )
    # The name falls back to the sale's, junk though that is.
    assert rows(found, *FIELDS) == [
        ("p@x.com", "ImportJob", "9", "purchaser"), ("s@x.com", "Pat", "9", "purchaser"),
    ]


def test_attendees_may_have_an_empty_email_which_sorts_first(make, rows, settings):
    found = contacts(
        make, settings,
        tickets=[ticket("a", purchaser_email="p@x.com")],
        attendees=[
            {"customer_id": 1, "attendee_email": "z@x.com", "attendee_name": "Zoe"},
            {"customer_id": 1, "attendee_email": "", "attendee_name": "Empty"},
            {"customer_id": 1, "attendee_email": None, "attendee_name": "None"},
            {"customer_id": 1, "attendee_email": "a+placeholder@x.com", "attendee_name": "Ph"},
        ],
    )
    assert found.count() == 3
    assert rows(lists.pick_contact(found), *FIELDS) == [("", "Empty", None, "attendee")]


def test_source_preference_and_filters(make, rows, settings):
    tables = dict(
        tickets=[ticket("a", purchaser_email="p@x.com")],
        dim_customer=[{"CVCustomerID": "CV1", "NetSuiteID": 9}],
        silver_entity=[{"EntityID": 9, "Email": "e@x.com", "BusinessOwnerName": "Ed"}],
    )
    found = contacts(make, settings, **tables)
    assert rows(found, "contact_source") == [("netsuite",), ("purchaser",)]
    assert rows(lists.pick_contact(found), "contact_source") == [("purchaser",)]
    assert rows(lists.pick_contact(contacts(make, settings, **tables, **OWNER)), *FIELDS) == [
        ("o@x.com", "Olga", "1", "business_owner"),
    ]
    former = {**OWNER, "dim_customer_contact": [
        {**OWNER["dim_customer_contact"][0], "IsActiveName": "No"}]}
    assert "business_owner" not in {
        r[0] for r in rows(contacts(make, settings, **tables, **former), "contact_source")
    }


def test_contacts_ignore_casing(make, rows, settings):
    found = contacts(
        make, settings,
        tickets=[
            ticket("a", purchaser_email="BOB@x.com", purchaser_name="Bob"),
            ticket("b", purchaser_email="bob@x.com", purchaser_name="bob"),
            ticket("c", purchaser_email="Cid@x.com"),
            ticket("d", purchaser_email="amy@x.com"),
        ],
    )
    assert rows(lists.distinct_contacts(found), "contact_email") == [
        ("BOB@x.com",), ("Cid@x.com",), ("amy@x.com",),
    ]
    # In binary order the capitals would come first.
    assert rows(lists.pick_contact(found), "contact_email") == [("amy@x.com",)]


# --- whole lists -------------------------------------------------------------------


@pytest.mark.parametrize("spec", [SPEC, lists.ListSpec("Gamma", "Alpha", counted_types=False)])
def test_declared_keys_do_not_change_the_list(spark, rows, spec):
    tables = sample_tables(spark, SMALL)
    undeclared = replace(SETTINGS, tickets_are_unique=False, sales_are_unique=False)
    declared = rows(lists.customer_list(tables, spec, SETTINGS))
    assert len(declared) > 100
    assert declared == rows(lists.customer_list(tables, spec, undeclared))


def test_aggregates_meet_without_another_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        listed = lists.customer_list(sample_tables(spark, SMALL), SPEC, SETTINGS)
        plan = listed._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    by_business = [line for line in plan.splitlines() if "hashpartitioning(customer_id#" in line]
    single = [line for line in by_business if line.split("hashpartitioning(")[1].count("#") == 1]
    # One per branch: rollup, contacts, profile, types, orders, activity, purchase, summary; and
    # two to cut the attendees to the businesses in scope.
    assert len(single) == 10


def test_a_list_scans_the_tickets_twice(spark, monkeypatch):
    plans = []

    def noted(df):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return staged(df)

    monkeypatch.setattr(lists, "staged", noted)
    listed = lists.customer_list(sample_tables(spark, SMALL), SPEC, SETTINGS)
    plans.append(listed._jdf.queryExecution().optimizedPlan().toString())
    # The first stores the tickets in scope; product names are made in no other plan.
    assert "LeftSemi" in plans[0] and plans[0].count("Relation [o_orderkey") == 2
    assert not any("Beta Bootcamp" in plan for plan in plans[1:])


# --- several lists at once ----------------------------------------------------------


def test_lists_made_at_once_equal_lists_made_alone(spark, rows):
    tables = sample_tables(spark, SMALL)
    specs = {
        "alpha": SPEC,
        "beta": lists.ListSpec("Beta", "Alpha"),
        "gamma": lists.ListSpec("Gamma", "Alpha", counted_types=False),
        # Its products are in the other lists too, its flagship is another one.
        "vip": lists.ListSpec("VIP", "small"),
    }
    undeclared = replace(SETTINGS, tickets_are_unique=False, sales_are_unique=False)
    for settings in (SETTINGS, undeclared):
        made = lists.customer_lists(tables, specs, settings)
        for name, spec in specs.items():
            alone = lists.customer_list(tables, spec, settings)
            assert made[name].columns == alone.columns
            assert rows(made[name]) == rows(alone)


def test_a_ticket_is_in_each_list_of_its_product(make, rows):
    specs = {"a": lists.ListSpec("Alpha", "Alpha"), "w": lists.ListSpec("Workshop", "Alpha")}
    tables = make(
        tickets=[ticket("1"), ticket("2", product_name="Workshop"), ticket("3", product_name=None), ticket("4", customer_id=None)]
    )
    assert rows(lists.listed_tickets(tables, specs), "list", "ticket_id") == [("a", "1"), ("w", "1"), ("w", "2")]


def _below_aggregate(plan: str, column: str) -> bool:
    """Whether the first aggregate of a column's table reads a semi join."""
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if "Aggregate" in line and column in line)
    depth = lines[at].index("Aggregate")
    inside = [line for line in lines[at + 1 :] if len(line) - len(line.lstrip(" :+-")) > depth]
    return any("LeftSemi" in line for line in inside)


def test_logs_are_cut_to_the_list_before_they_are_aggregated(spark):
    tables = lists.of_businesses_with(sample_tables(spark, SMALL), {"": SPEC})
    touched = lists.last_activity(tables, "Alpha")._jdf.queryExecution().optimizedPlan().toString()
    lines = [line for line in touched.splitlines() if "Aggregate [ticket_id" in line]
    assert len(lines) == 1 and _below_aggregate(touched, "Aggregate [ticket_id")
    bought = lists.first_purchase(tables, "Alpha")._jdf.queryExecution().optimizedPlan().toString()
    assert _below_aggregate(bought, "Aggregate [CVCustomerID")


def test_activity_counts_tickets_of_every_product(make, rows):
    tables = make(
        tickets=[ticket("1"), ticket("2", product_name="Beta"), ticket("3", customer_id=2)],
        attendee_tickets=[
            {"ticket_id": "1", "blast_date": date(2024, 1, 2)},
            {"ticket_id": "1", "blast_date": date(2024, 1, 5)},
            {"ticket_id": "2", "blast_date": date(2024, 1, 9), "last_called_date": date(2024, 1, 1)},
            {"ticket_id": "x", "blast_date": date(2024, 2, 9)},
        ],
    )
    assert rows(lists.last_activity(tables, "Alpha")) == [(1, date(2024, 1, 9), date(2024, 1, 1), date(2024, 1, 5), None)]


def test_ids_alone_equal_those_of_the_lists(spark, rows):
    tables = sample_tables(spark, SMALL)
    specs = {"alpha": SPEC, "vip": lists.ListSpec("VIP", "small")}
    made = lists.customer_lists(tables, specs, SETTINGS)
    expected = [(name, r[0]) for name, df in made.items() for r in df.select("CV Customer ID").collect()]
    assert rows(lists.listed_ids(tables, specs, SETTINGS), "list", "cv_customer_id") == sorted(expected, key=repr)
    alone = lists.listed_ids(tables, {"": SPEC}, SETTINGS)
    assert [(r[0],) for r in rows(alone)] == rows(made["alpha"], "CV Customer ID")


def test_ids_alone_need_no_join_of_the_tickets(spark, monkeypatch):
    plans = []

    def noted(df):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return staged(df)

    monkeypatch.setattr(lists, "staged", noted)
    lists.listed_ids(sample_tables(spark, SMALL), {"": SPEC}, SETTINGS)
    assert "Join" not in plans[0] and plans[0].count("Relation [o_orderkey") == 1


def test_only_columns_of_a_list_are_kept_of_its_tickets(spark):
    tables = lists.of_businesses_with(sample_tables(spark, SMALL), {"": SPEC})
    assert sorted(tables["tickets"].columns) == sorted(lists.TICKET_COLUMNS)


def test_purchasers_are_sought_where_no_preferred_contact_is(make, rows):
    specs = {"a": lists.ListSpec("Alpha", "Alpha"), "b": lists.ListSpec("Beta", "Alpha")}
    buyer = {"purchaser_email": "p@x.com", "purchaser_name": "P"}
    tables = make(
        tickets=[
            ticket("1", **buyer), ticket("2", **buyer, customer_id=2), ticket("3", **buyer, customer_id=3),
            ticket("4", customer_id=4), ticket("5", customer_id=2, product_name="Beta"),
            ticket("6", customer_id=3, product_name="Beta"),
        ],
        customers=[business(id=i, cv_customer_id=f"CV{i}") for i in (1, 2, 3, 4)],
        attendees=[{"customer_id": 1, "attendee_email": "a@x.com"}, {"customer_id": None, "attendee_email": "n@x.com"}],
        dim_customer=[{"CVCustomerID": f"CV{i}", "NetSuiteID": i} for i in (1, 2, 4)],
        silver_entity=[{"EntityID": i, "Email": f"e{i}@x.com"} for i in (1, 2, 4)],
    )
    picked = lists.pick_contacts(tables, lists.listed_tickets(tables, specs), SETTINGS)
    assert rows(picked, "list", "customer_id", "contact_source", "contact_email") == [
        ("a", 1, "attendee", "a@x.com"), ("a", 2, "purchaser", "p@x.com"),
        ("a", 3, "purchaser", "p@x.com"), ("a", 4, "netsuite", "e4@x.com"),
        ("b", 2, "netsuite", "e2@x.com"),
    ]
    assert "LeftAnti" in picked._jdf.queryExecution().optimizedPlan().toString()


def test_ticket_ids_are_not_broadcast_to_the_contact_log(spark):
    tables = lists.of_businesses_with(sample_tables(spark, SMALL), {"": SPEC})
    plan = lists.last_activity(tables, "Alpha")._jdf.queryExecution().executedPlan().toString()
    semi = [line for line in plan.splitlines() if "Join [ticket_id" in line and "LeftSemi" in line]
    assert semi and all("SortMergeJoin" in line for line in semi)


def test_items_of_a_text_are_shuffled_as_rows(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        texts = lists.status_summaries(sample_tables(spark, SMALL), {"": SPEC})
        plan = texts._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # The count, and its rows by business; none for the texts of a status.
    assert plan.count("Exchange hashpartitioning") == 2
