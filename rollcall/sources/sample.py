"""The base tables derived from the generic test tables.

Each entry is (source, columns). The expressions are valid in Spark and DuckDB
alike, so the oracle derives the same tables from the same text; only the
source may differ per engine.
"""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from pyspark.sql import SparkSession

from rollcall.settings import Settings
from rollcall.sources.tables import Tables

SETTINGS = Settings(
    as_of=datetime(2024, 1, 20, 15, 30),
    junk=("ImportJob", ""),
    tickets_are_unique=True,
    sales_are_unique=True,
)
# The same without declared keys, for tables that repeat rows.
UNDECLARED = replace(SETTINGS, tickets_are_unique=False, sales_are_unique=False)
PATTERNS = {"alpha": "Alpha", "beta": "Beta", "gamma": "Gamma"}
FLAGSHIP = "Alpha"

SOURCES: dict[str, str] = {
    "tickets": (
        "(SELECT o_orderkey AS k, o_custkey AS cust, o_orderdate AS od, o_totalprice AS tp "
        "FROM {orders}) x"
    ),
    "history": "{events}",
    "ticket_no_show_resets": (
        "(SELECT l_orderkey AS k, l_linenumber AS ln, max(l_shipdate) AS sd, "
        "max(l_extendedprice) AS tp FROM {lineitem} WHERE l_returnflag = 'R' "
        "GROUP BY l_orderkey, l_linenumber) x"
    ),
    "transactions": "{orders}",
    "attendees": "(SELECT c_custkey, explode(array(0, 1, 2)) AS j FROM {customer}) x",
    "attendee_tickets": "{events}",
    "customers": "{customer}",
    # Some events are recorded twice.
    "dim_event": "(SELECT * FROM {part} UNION ALL SELECT * FROM {part} WHERE p_partkey % 50 = 3) x",
    "dim_employee": "{supplier} JOIN {nation} ON n_nationkey = s_nationkey",
    "dim_customer": "{customer} JOIN {nation} ON n_nationkey = c_nationkey",
    "dim_customer_contact": "{customer}",
    "dim_person": "{customer}",
    "fact_gl": "{lineitem} JOIN {orders} ON o_orderkey = l_orderkey",
    "dim_product": "{part}",
    "silver_entity": "{customer}",
}

DUCKDB_SOURCES = {
    **SOURCES,
    "attendees": "(SELECT c_custkey, unnest([0, 1, 2]) AS j FROM {customer}) x",
}

COLUMNS: dict[str, dict[str, str]] = {
    "tickets": {
        "ticket_id": "CAST(k AS STRING)",
        # Eight orders an event, so that events grow with the data.
        "event_id": (
            "CASE WHEN k % 37 = 0 THEN NULL "
            "ELSE 'EV-' || CAST(CAST(floor(k / 8) AS BIGINT) AS STRING) END"
        ),
        "event_type_id": "CAST(k % 3 AS INT)",
        "attendee_id": "CASE WHEN k % 11 = 0 THEN NULL ELSE cust * 10 + k % 3 END",
        "customer_id": "CASE WHEN k % 23 = 0 THEN NULL ELSE cust END",
        "product_category_name": "CASE WHEN k % 2 = 0 THEN 'Event' ELSE 'Training' END",
        "product_name": (
            "CASE k % 3 WHEN 0 THEN 'Alpha Workshop' WHEN 1 THEN 'Beta Bootcamp' "
            "ELSE 'Gamma Summit' END || CASE WHEN k % 7 = 0 THEN ' VIP' ELSE '' END"
        ),
        "scheduled_event_name": "'Event ' || CAST(CAST(floor(k / 8) AS BIGINT) AS STRING)",
        "ticket_type": "CASE k % 4 WHEN 0 THEN 'General' WHEN 1 THEN 'VIP' WHEN 2 THEN 'Staff' END",
        "status": (
            "CASE (k * 7 + CAST(floor(k / 13) AS BIGINT)) % 10 WHEN 0 THEN 'Open' "
            "WHEN 1 THEN 'undecided' WHEN 2 THEN 'undecided_at_sale' WHEN 3 THEN 'expired' "
            "WHEN 4 THEN 'assigned' WHEN 5 THEN 'Scheduled' WHEN 6 THEN 'reserved' "
            "WHEN 7 THEN 'attended' WHEN 8 THEN 'No Show' ELSE 'cancelled' END"
        ),
        "confirmation_status": (
            "CASE CAST(floor(k / 3) AS BIGINT) % 4 WHEN 1 THEN 'CONFIRMED' "
            "WHEN 2 THEN 'Confirmed' WHEN 3 THEN 'DOUBLE CONFIRMED' END"
        ),
        "event_date": "date '2024-01-01' + CAST(k % 40 AS INT)",
        "ticket_price": "CAST(tp AS DECIMAL(18,2))",
        "confirmation_method": "CASE k % 3 WHEN 0 THEN 'Phone' WHEN 1 THEN 'Text' END",
        "confirmed_by": (
            "CASE CAST(floor(k / 5) AS BIGINT) % 3 "
            "WHEN 0 THEN 'rep' || CAST(CAST(floor(k / 160) AS BIGINT) AS STRING) || '@x.com' "
            "WHEN 1 THEN 'System' END"
        ),
        "confirmed_date": (
            "CASE WHEN k % 31 = 0 THEN NULL ELSE date '2024-01-01' + CAST(k % 25 AS INT) END"
        ),
        "double_confirmed_by": (
            "CASE WHEN CAST(floor(k / 3) AS BIGINT) % 4 = 3 AND k % 2 = 0 "
            "THEN 'rep' || CAST(CAST(floor(k / 160) AS BIGINT) + 1 AS STRING) || '@x.com' END"
        ),
        "double_confirmed_date": (
            "CASE WHEN CAST(floor(k / 3) AS BIGINT) % 4 = 3 "
            "THEN date '2024-01-03' + CAST(k % 22 AS INT) END"
        ),
        "double_confirm_type": (
            "CASE WHEN CAST(floor(k / 3) AS BIGINT) % 4 = 3 THEN CASE k % 5 "
            "WHEN 0 THEN 'Hotel Only' WHEN 1 THEN 'Flight Only' WHEN 2 THEN 'Both' "
            "WHEN 3 THEN 'Is Local' END END"
        ),
        "travel_details": "CASE k % 6 WHEN 0 THEN 'Hotel Only' WHEN 1 THEN 'Is Local' END",
        "outreach_restriction": (
            "CASE k % 29 WHEN 0 THEN 'Do Not Contact' WHEN 1 THEN 'Do Not Call' "
            "WHEN 2 THEN 'Do Not Blast' WHEN 3 THEN '' END"
        ),
        "person_id": "CAST(cust AS INT)",
        "sales_order_id": (
            "CASE k % 9 WHEN 0 THEN NULL WHEN 1 THEN ' ' "
            "ELSE 'SO' || CAST(floor(k / 2) AS BIGINT) END"
        ),
        "purchaser_name": (
            "CASE k % 5 WHEN 0 THEN 'ImportJob' WHEN 1 THEN NULL "
            "ELSE 'Buyer ' || CAST(cust AS STRING) END"
        ),
        "purchaser_email": (
            "CASE CASE WHEN cust % 7 = 3 THEN 0 ELSE k % 5 END WHEN 0 THEN 'ImportJob' "
            "WHEN 1 THEN '' WHEN 2 THEN 'Buyer' || CAST(cust AS STRING) || '@x.com' "
            "ELSE 'buyer' || CAST(cust AS STRING) || '@x.com' END"
        ),
        "purchaser_phone": "CASE k % 5 WHEN 0 THEN '' ELSE '555-' || CAST(cust AS STRING) END",
        "is_comped": "CASE k % 10 WHEN 0 THEN NULL WHEN 1 THEN 1 ELSE 0 END",
        "undecided_timestamp": "CASE WHEN k % 5 = 0 THEN od + INTERVAL '2' DAY END",
        "registration_date": "CASE WHEN k % 41 = 0 THEN NULL ELSE od END",
        "attendance_type": "CASE WHEN k % 4 = 0 THEN 'Virtual' ELSE 'In-Person' END",
        "transaction_id": "CASE WHEN k % 19 = 0 THEN NULL ELSE k END",
        "is_deleted": "CASE WHEN k % 17 = 0 THEN 1 ELSE 0 END",
    },
    "history": {
        "ticket_id": "CAST(user_id * 4 + event_id % 4 AS STRING)",
        "changed_by": (
            "CASE event_id % 9 WHEN 6 THEN 'System' WHEN 7 THEN 'bulk-import' "
            "WHEN 8 THEN NULL WHEN 5 THEN 'temp@x.com' ELSE 'rep' || CAST(CAST(floor(user_id / 2) "
            "AS BIGINT) + event_id % 3 AS STRING) || '@x.com' END"
        ),
        "action": (
            "CASE event_type WHEN 'purchase' THEN 'Confirmation status updated' "
            "WHEN 'signup' THEN 'Confirmation status updated' "
            "WHEN 'click' THEN 'Confirmation date updated' ELSE 'Note added' END"
        ),
        "new_value": (
            "CASE WHEN event_id % 13 = 0 THEN 'UNDECIDED' WHEN event_type = 'purchase' "
            "THEN 'CONFIRMED' WHEN event_type = 'signup' THEN 'Double Confirmed' END"
        ),
        "changed_at": "ts",
    },
    "ticket_no_show_resets": {
        "ticket_id": "CAST(k AS STRING) || '-' || CAST(ln AS STRING)",
        "root_ticket_id": "CASE WHEN k % 97 = 0 THEN NULL ELSE CAST(k AS STRING) END",
        "event_id": "'EV-' || CAST(CAST(floor(k / 8) AS BIGINT) + ln % 2 AS STRING)",
        "event_type_id": "CAST(k % 3 AS INT)",
        "attendee_id": "CAST(floor(k / 10) AS BIGINT) * 10 + ln % 3",
        "customer_id": "CAST(floor(k / 10) AS BIGINT)",
        "product_name": (
            "CASE k % 3 WHEN 0 THEN 'Alpha Workshop' WHEN 1 THEN 'Beta Bootcamp' "
            "ELSE 'Gamma Summit' END"
        ),
        "scheduled_event_name": (
            "'Event ' || CAST(CAST(floor(k / 8) AS BIGINT) + ln % 2 AS STRING)"
        ),
        "ticket_type": "'General'",
        "confirmation_status": (
            "CASE ln % 3 WHEN 0 THEN 'Confirmed' WHEN 1 THEN 'DOUBLE CONFIRMED' "
            "ELSE 'Undecided' END"
        ),
        "event_date": "date '2024-01-01' + CAST((k + ln % 2) % 40 AS INT)",
        "ticket_price": "CAST(tp AS DECIMAL(18,2))",
        "confirmation_method": "'Phone'",
        "confirmed_date": "date '2024-01-01' + CAST(k % 25 AS INT)",
        "double_confirm_type": "CASE ln % 3 WHEN 1 THEN 'Both' END",
        "outreach_restriction": "CASE k % 29 WHEN 0 THEN 'Do Not Contact' END",
        "sales_order_id": "'SO' || CAST(floor(k / 2) AS BIGINT)",
        "purchaser_email": "'buyer' || CAST(CAST(floor(k / 10) AS BIGINT) AS STRING) || '@x.com'",
        "is_comped": "CASE WHEN k % 10 = 1 THEN 1 END",
        "attendance_type": "'In-Person'",
        "reset_at": "sd",
    },
    "transactions": {
        "cv_transaction_id": "o_orderkey",
        "transaction_date": "o_orderdate",
        "purchaser_name": (
            "CASE o_orderkey % 4 WHEN 0 THEN 'ImportJob' "
            "ELSE 'Payer ' || CAST(o_custkey AS STRING) END"
        ),
        "purchaser_email": (
            "CASE CASE WHEN o_custkey % 7 = 3 THEN 1 ELSE o_orderkey % 4 END "
            "WHEN 0 THEN 'ImportJob' WHEN 1 THEN NULL "
            "ELSE 'payer' || CAST(o_custkey AS STRING) || '@x.com' END"
        ),
        "purchaser_phone": "'556-' || CAST(o_custkey AS STRING)",
    },
    "attendees": {
        "attendee_id": "c_custkey * 10 + j",
        "customer_id": "c_custkey",
        "attendee_name": "'Att ' || CAST(c_custkey AS STRING) || '-' || CAST(j AS STRING)",
        "attendee_email": (
            "CASE CASE WHEN c_custkey % 4 = 1 THEN 0 ELSE (c_custkey * 3 + j) % 7 END "
            "WHEN 0 THEN NULL WHEN 1 THEN 'a' || CAST(c_custkey AS STRING) || '+placeholder@x.com' "
            "ELSE CASE WHEN (c_custkey + j) % 13 = 0 THEN '' "
            "ELSE 'att' || CAST(c_custkey AS STRING) || CAST(j AS STRING) || '@x.com' END END"
        ),
        "attendee_phone": "'557-' || CAST(c_custkey AS STRING)",
        "first_name": "'Att'",
        "last_name": "CAST(c_custkey AS STRING) || '-' || CAST(j AS STRING)",
        "dietary_restrictions": "CASE WHEN c_custkey % 6 = 0 THEN 'Vegan' END",
    },
    "attendee_tickets": {
        "ticket_id": "CAST(user_id * 4 + event_id % 4 AS STRING)",
        "blast_date": "CASE WHEN event_type = 'view' THEN CAST(ts AS DATE) END",
        "last_called_date": "CASE WHEN event_type = 'error' THEN CAST(ts AS DATE) END",
    },
    "customers": {
        "id": "c_custkey",
        "name": "CASE WHEN c_custkey % 50 = 0 THEN NULL ELSE c_name END",
        "cv_customer_id": "'CV' || CAST(c_custkey AS STRING)",
        "vertical": "CAST(c_nationkey AS STRING)",
        "SBU": "CASE WHEN c_custkey % 3 = 0 THEN 'Yes' ELSE 'No' END",
        "PR": "CASE WHEN c_custkey % 4 = 0 THEN 'Yes' ELSE 'No' END",
        "EliteEdge": "CASE c_custkey % 6 WHEN 0 THEN '3' WHEN 1 THEN '4' END",
    },
    "dim_event": {
        "CVEventID": "'EV-' || CAST(p_partkey AS STRING)",
        "EventName": "p_name",
        "EventCode": "'CV-' || CAST(p_partkey AS STRING)",
        "EventType": "p_type",
        "StartDate": "date '2024-01-01' + CAST(p_partkey % 60 AS INT)",
        "TargetAttendance": (
            "CASE WHEN p_size % 5 = 0 THEN 0 WHEN p_size % 7 = 0 THEN NULL ELSE p_size * 10 END"
        ),
        "CityName": "'City ' || CAST(p_size AS STRING)",
        "VenueName": "'Venue ' || p_brand",
    },
    "dim_employee": {
        "EmployeeName": "s_name",
        "Email": "'rep' || CAST(s_suppkey AS STRING) || '@x.com'",
        "Team": "n_name",
    },
    "dim_customer": {
        "CVCustomerID": "CASE WHEN c_custkey % 8 <> 0 THEN 'CV' || CAST(c_custkey AS STRING) END",
        "NetSuiteID": "c_custkey + 100000",
        "EliteStatus": "CASE c_custkey % 6 WHEN 0 THEN '3' WHEN 1 THEN '4' END",
        "EliteStatusName": "CASE c_custkey % 6 WHEN 0 THEN 'E125' WHEN 1 THEN 'E250' END",
        "PRClientStatusName": "CASE WHEN c_custkey % 4 = 0 THEN 'Active' END",
        "SBUClientStatusName": "CASE WHEN c_custkey % 3 = 0 THEN 'Active' END",
        "AnnualBusinessRevenueName": (
            "CASE WHEN c_acctbal < 0 THEN 'Under 1M' WHEN c_acctbal < 5000 THEN '1M-5M' "
            "ELSE '5M+' END"
        ),
        "VerticalName": "c_mktsegment",
        "SubVerticalName": "n_name",
    },
    "dim_customer_contact": {
        "Customer": "'CV' || CAST(c_custkey AS STRING)",
        "Person": "c_custkey + 500000",
        "StaffTitleName": "CASE WHEN c_custkey % 3 = 0 THEN 'Owner' ELSE 'Manager' END",
        "IsActiveName": "CASE WHEN c_custkey % 4 = 3 THEN 'No' ELSE 'Yes' END",
    },
    "dim_person": {
        "CVPersonID": "c_custkey + 500000",
        "PersonName": "'Owner ' || CAST(c_custkey AS STRING)",
        "Email": (
            "CASE c_custkey % 5 WHEN 0 THEN '' WHEN 1 THEN NULL "
            "ELSE 'owner' || CAST(c_custkey AS STRING) || '@x.com' END"
        ),
        "Phone": "'558-' || CAST(c_custkey AS STRING)",
    },
    "fact_gl": {
        "CVCustomerID": "'CV' || CAST(o_custkey AS STRING)",
        "CVProductID": "l_partkey",
        "GLDate": "CAST(l_shipdate AS DATE)",
        "GLLineID": "l_linenumber - 1",
        "SalesOrderCashCollected": "CASE WHEN l_returnflag = 'R' THEN 0.0 ELSE l_extendedprice END",
    },
    "dim_product": {
        "CVProductID": "p_partkey",
        "ProductName": "CASE WHEN p_partkey % 50 = 0 THEN 'Alpha Workshop' ELSE p_name END",
    },
    "silver_entity": {
        "EntityID": "c_custkey + 100000",
        "BusinessOwnerName": "'Entity ' || CAST(c_custkey AS STRING)",
        "Email": (
            "CASE c_custkey % 6 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '  ' "
            "ELSE 'ns' || CAST(c_custkey AS STRING) || '@x.com' END"
        ),
        "Phone": "'559-' || CAST(c_custkey AS STRING)",
    },
}

# Columns of the test tables the mapping reads (fixed values). Stating them
# spares a job per table to infer them.
RAW_TABLES = {
    "nation": "n_nationkey int, n_name string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_totalprice double, "
    "o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_extendedprice double, "
    "l_returnflag string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string",
}


def select_text(table: str, sources: dict[str, str]) -> str:
    items = ", ".join(f"{expr} AS {name}" for name, expr in COLUMNS[table].items())
    return f"SELECT {items} FROM {sources[table]}"


def sample_tables(spark: SparkSession, sf_dir: str) -> Tables:
    """The base tables over the parquet files in ``sf_dir``."""

    def load(table: str):
        used = [raw for raw in RAW_TABLES if f"{{{raw}}}" in SOURCES[table]]
        frames = {
            raw: spark.read.schema(RAW_TABLES[raw]).parquet(f"{sf_dir}/{raw}.parquet")
            for raw in used
        }
        return spark.sql(select_text(table, SOURCES), **frames)

    return Tables(load)
