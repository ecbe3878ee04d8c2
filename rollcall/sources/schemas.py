"""Column names and types of the base tables and of the derived tables.

All names and orders here are fixed values of the data model.
"""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "decimal(18,2)": T.DecimalType(18, 2),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def _schema(columns: str) -> T.StructType:
    """Built without a session, so that importing this module needs none."""
    pairs = [column.split(" ") for column in columns.split(", ")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


BASE_TABLES: dict[str, T.StructType] = {
    "tickets": _schema(
        "ticket_id string, event_id string, event_type_id int, attendee_id bigint, "
        "customer_id bigint, product_category_name string, product_name string, "
        "scheduled_event_name string, ticket_type string, status string, "
        "confirmation_status string, event_date date, ticket_price decimal(18,2), "
        "confirmation_method string, confirmed_by string, confirmed_date date, "
        "double_confirmed_by string, double_confirmed_date date, double_confirm_type string, "
        "travel_details string, outreach_restriction string, person_id int, "
        "sales_order_id string, purchaser_name string, purchaser_email string, "
        "purchaser_phone string, is_comped int, undecided_timestamp timestamp_ntz, "
        "registration_date timestamp_ntz, attendance_type string, transaction_id bigint, "
        "is_deleted int"
    ),
    "history": _schema(
        "ticket_id string, changed_by string, action string, new_value string, "
        "changed_at timestamp_ntz"
    ),
    "ticket_no_show_resets": _schema(
        "ticket_id string, root_ticket_id string, event_id string, event_type_id int, "
        "attendee_id bigint, customer_id bigint, product_name string, "
        "scheduled_event_name string, ticket_type string, confirmation_status string, "
        "event_date date, ticket_price decimal(18,2), confirmation_method string, "
        "confirmed_date date, double_confirm_type string, outreach_restriction string, "
        "sales_order_id string, purchaser_email string, is_comped int, "
        "attendance_type string, reset_at timestamp_ntz"
    ),
    "transactions": _schema(
        "cv_transaction_id bigint, transaction_date timestamp_ntz, purchaser_name string, "
        "purchaser_email string, purchaser_phone string"
    ),
    "attendees": _schema(
        "attendee_id bigint, customer_id bigint, attendee_name string, attendee_email string, "
        "attendee_phone string, first_name string, last_name string, dietary_restrictions string"
    ),
    "attendee_tickets": _schema("ticket_id string, blast_date date, last_called_date date"),
    "customers": _schema(
        "id bigint, name string, cv_customer_id string, vertical string, SBU string, "
        "PR string, EliteEdge string"
    ),
    "dim_event": _schema(
        "CVEventID string, EventName string, EventCode string, EventType string, "
        "StartDate date, TargetAttendance int, CityName string, VenueName string"
    ),
    "dim_employee": _schema("EmployeeName string, Email string, Team string"),
    "dim_customer": _schema(
        "CVCustomerID string, NetSuiteID bigint, EliteStatus string, EliteStatusName string, "
        "PRClientStatusName string, SBUClientStatusName string, "
        "AnnualBusinessRevenueName string, VerticalName string, SubVerticalName string"
    ),
    "dim_customer_contact": _schema(
        "Customer string, Person bigint, StaffTitleName string, IsActiveName string"
    ),
    "dim_person": _schema("CVPersonID bigint, PersonName string, Email string, Phone string"),
    "fact_gl": _schema(
        "CVCustomerID string, CVProductID bigint, GLDate date, GLLineID int, "
        "SalesOrderCashCollected double"
    ),
    "dim_product": _schema("CVProductID bigint, ProductName string"),
    "silver_entity": _schema(
        "EntityID bigint, BusinessOwnerName string, Email string, Phone string"
    ),
}

TICKETS_ALL = _schema(
    "ticket_id string, event_id string, event_type_id int, attendee_id bigint, "
    "customer_id bigint, product_category_name string, product_name string, "
    "scheduled_event_name string, ticket_type string, status string, "
    "confirmation_status string, event_date date, ticket_price decimal(18,2), "
    "confirmation_method string, confirmed_date date, double_confirm_type string, "
    "outreach_restriction string, person_id int, sales_order_id string, "
    "purchaser_email string, purchaser_name string, is_comped int, "
    "undecided_timestamp timestamp_ntz, attendance_type string, travel_details string, "
    "travel_type string, is_reset_ghost boolean"
)

TOUCHES = _schema(
    "user_email string, ticket_id string, confirmation_status string, action_date_az date, "
    "action_ts_az timestamp_ntz, is_rep_action int, confirmation_touch_source string"
)

WEEK_COLUMNS = ["week_start_date", "week_year", "week_number", "week_offset"]

CONFIRMATION_ACTIONS = [
    "user_email", "ticket_id", "confirmation_status", "action_date_az", "action_time_az",
    "is_rep_action", "confirmation_touch_source", *WEEK_COLUMNS, "is_first_travel_action",
    "ticket_outcome", "is_no_show_reset", "original_event_date", "original_event_name",
    "week_label", "ticket_confirmation_rank", "ticket_status_action_count",
    "ticket_total_action_count", "is_last_confirmer",
]
