"""Expected results as DuckDB SQL over the generic test tables.

The base tables come from the shared mapping; everything derived from them is
written here a second time, in plain SQL and independently of the pipelines.
``query`` puts the needed common table expressions in front of a statement.
"""

from __future__ import annotations

import re

from rollcall.sources.sample import DUCKDB_SOURCES, RAW_TABLES, select_text
from rollcall.sources.schemas import BASE_TABLES

AS_OF = "TIMESTAMP '2024-01-20 15:30:00'"
TODAY = "DATE '2024-01-20'"
FLAGSHIP = "Alpha"

_DUCKDB_TYPES = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "double": "DOUBLE", "decimal(18,2)": "DECIMAL(18,2)",
    "boolean": "BOOLEAN",
}


def _base(table: str) -> str:
    raw = select_text(table, DUCKDB_SOURCES).format(**{r: r for r in RAW_TABLES})
    columns = ", ".join(
        f"CAST({f.name} AS {_DUCKDB_TYPES[f.dataType.simpleString()]}) AS {f.name}"
        for f in BASE_TABLES[table]
    )
    return f"SELECT {columns} FROM ({raw})"


C = "lower(confirmation_status) = 'confirmed'"
DC = "lower(confirmation_status) = 'double confirmed'"
ANY = "lower(confirmation_status) IN ('confirmed', 'double confirmed')"
MACHINES = "('System', 'bulk-import')"
STATUS_CHANGE = (
    "action = 'Confirmation status updated' "
    "AND upper(new_value) IN ('CONFIRMED', 'DOUBLE CONFIRMED')"
)
LOCAL = "changed_at - INTERVAL 7 HOUR"


def _monday(day: str) -> str:
    return f"({day} - CAST(date_diff('day', DATE '2024-01-01', {day}) % 7 AS INTEGER))"


CTES: dict[str, str] = {f"b_{table}": _base(table) for table in BASE_TABLES}

CTES["d_live"] = """
SELECT ticket_id, event_id, event_type_id, attendee_id, customer_id, product_category_name,
       product_name, scheduled_event_name, ticket_type, status, confirmation_status, event_date,
       ticket_price, confirmation_method, confirmed_date, double_confirm_type,
       outreach_restriction, person_id, sales_order_id, purchaser_email, purchaser_name,
       CAST(ifnull(is_comped, 0) AS INTEGER) AS is_comped, undecided_timestamp, attendance_type,
       travel_details, ifnull(double_confirm_type, travel_details) AS travel_type,
       false AS is_reset_ghost
FROM b_tickets"""

CTES["d_ghosts"] = f"""
SELECT r.ticket_id, r.event_id, r.event_type_id, r.attendee_id, r.customer_id,
       NULL::VARCHAR AS product_category_name, r.product_name, r.scheduled_event_name,
       r.ticket_type, 'no show' AS status, r.confirmation_status, r.event_date, r.ticket_price,
       r.confirmation_method, r.confirmed_date, r.double_confirm_type, r.outreach_restriction,
       NULL::INTEGER AS person_id, r.sales_order_id, r.purchaser_email,
       NULL::VARCHAR AS purchaser_name, CAST(ifnull(r.is_comped, 0) AS INTEGER) AS is_comped,
       NULL::TIMESTAMP AS undecided_timestamp, r.attendance_type, NULL::VARCHAR AS travel_details,
       r.double_confirm_type AS travel_type, true AS is_reset_ghost
FROM b_ticket_no_show_resets r ANTI JOIN b_tickets t
  ON t.ticket_id = r.root_ticket_id AND t.event_id = r.event_id
WHERE {ANY}
QUALIFY row_number() OVER (PARTITION BY r.event_id, r.root_ticket_id
                           ORDER BY r.reset_at DESC NULLS LAST, r.ticket_id) = 1"""

CTES["d_tickets_all"] = "SELECT * FROM d_live UNION ALL BY NAME SELECT * FROM d_ghosts"

CTES["d_status_touches"] = f"""
SELECT changed_by AS user_email, ticket_id,
       if(upper(new_value) = 'CONFIRMED', 'Confirmed', 'Double Confirmed') AS confirmation_status,
       CAST({LOCAL} AS DATE) AS action_date_az, {LOCAL} AS action_ts_az,
       if(changed_by IN {MACHINES}, 0, 1)::INTEGER AS is_rep_action,
       'Status Update' AS confirmation_touch_source
FROM b_history WHERE {STATUS_CHANGE}"""

CTES["d_date_touches"] = f"""
SELECT changed_by AS user_email, ticket_id, 'Confirmed' AS confirmation_status,
       CAST({LOCAL} AS DATE) AS action_date_az, {LOCAL} AS action_ts_az,
       if(changed_by IN {MACHINES}, 0, 1)::INTEGER AS is_rep_action,
       'Date Update' AS confirmation_touch_source
FROM b_history WHERE action = 'Confirmation date updated'"""

CTES["d_pre_history"] = f"""
SELECT user_email, ticket_id, confirmation_status, day AS action_date_az,
       CAST(day AS TIMESTAMP) AS action_ts_az, 1::INTEGER AS is_rep_action,
       'Pre-History Direct' AS confirmation_touch_source
FROM (SELECT ticket_id, confirmed_by AS user_email, confirmed_date AS day,
             'Confirmed' AS confirmation_status FROM b_tickets
      UNION ALL
      SELECT ticket_id, double_confirmed_by, double_confirmed_date, 'Double Confirmed'
      FROM b_tickets) x
WHERE user_email IS NOT NULL AND user_email NOT IN {MACHINES}
  AND ticket_id NOT IN (SELECT ticket_id FROM b_history WHERE {STATUS_CHANGE})"""

CTES["d_unique"] = """
SELECT * FROM (SELECT * FROM d_status_touches UNION ALL BY NAME SELECT * FROM d_date_touches
               UNION ALL BY NAME SELECT * FROM d_pre_history) x
QUALIFY row_number() OVER (
  PARTITION BY user_email, ticket_id, confirmation_status, action_date_az
  ORDER BY action_ts_az NULLS FIRST, confirmation_touch_source) = 1"""

CTES["d_first_travel"] = f"""
SELECT h.ticket_id, min(CAST(h.{LOCAL} AS DATE)) AS first_travel_date
FROM b_history h JOIN b_tickets t ON t.ticket_id = h.ticket_id
WHERE {STATUS_CHANGE} AND h.changed_by NOT IN {MACHINES} AND t.double_confirm_type IS NOT NULL
GROUP BY h.ticket_id"""

CTES["d_resets"] = """
SELECT root_ticket_id, min(event_date) AS original_event_date,
       min(scheduled_event_name) AS original_event_name
FROM b_ticket_no_show_resets WHERE root_ticket_id IS NOT NULL GROUP BY root_ticket_id"""

CTES["d_weeks"] = f"""
SELECT *,
       CASE week_offset WHEN 0 THEN 'This Week' WHEN -1 THEN 'Last Week' WHEN 1 THEN 'Next Week'
            ELSE concat(abs(week_offset), if(week_offset < 0, ' Weeks Ago', ' Weeks Ahead'))
       END AS week_label
FROM (SELECT *, {_monday('action_date_az')} AS week_start_date,
             year(week_start_date)::INTEGER AS week_year,
             week(week_start_date)::INTEGER AS week_number,
             (date_diff('day', {_monday(TODAY)}, week_start_date) // 7)::INTEGER AS week_offset
      FROM d_unique) x"""

CTES["d_actions"] = """
SELECT u.user_email, u.ticket_id, u.confirmation_status, u.action_date_az,
       u.action_ts_az AS action_time_az, u.is_rep_action, u.confirmation_touch_source,
       u.week_start_date, u.week_year, u.week_number, u.week_offset,
       if(u.action_date_az = f.first_travel_date, 1, 0)::INTEGER AS is_first_travel_action,
       CASE WHEN lower(t.status) = 'attended' THEN 'Attended'
            WHEN r.root_ticket_id IS NOT NULL THEN 'No Show (Reset)'
            WHEN lower(t.status) = 'no show' THEN 'No Show'
            WHEN lower(t.status) = 'cancelled' THEN 'Cancelled'
            ELSE 'Upcoming' END AS ticket_outcome,
       (r.root_ticket_id IS NOT NULL)::INTEGER AS is_no_show_reset,
       ifnull(r.original_event_date, t.event_date) AS original_event_date,
       ifnull(r.original_event_name, t.scheduled_event_name) AS original_event_name,
       u.week_label,
       (row_number() OVER touches)::INTEGER AS ticket_confirmation_rank,
       count(*) OVER (PARTITION BY u.ticket_id, u.confirmation_status)
           AS ticket_status_action_count,
       count(*) OVER (PARTITION BY u.ticket_id) AS ticket_total_action_count,
       if(row_number() OVER backwards = 1, 1, 0)::INTEGER AS is_last_confirmer
FROM d_weeks u
LEFT JOIN b_tickets t USING (ticket_id)
LEFT JOIN d_first_travel f USING (ticket_id)
LEFT JOIN d_resets r ON r.root_ticket_id = u.ticket_id
WINDOW touches AS (PARTITION BY u.ticket_id, u.confirmation_status
                   ORDER BY u.action_ts_az NULLS FIRST, u.confirmation_touch_source,
                            u.user_email NULLS FIRST),
       backwards AS (PARTITION BY u.ticket_id, u.confirmation_status
                     ORDER BY u.action_ts_az DESC NULLS LAST, u.confirmation_touch_source DESC,
                              u.user_email DESC NULLS LAST)"""

CTES["d_event_actions"] = f"""
SELECT a.*, t.event_id, t.status AS ticket_status, t.event_date AS ticket_event_date,
       e.EventName AS event_name, e.EventType AS event_type, e.StartDate AS event_date
FROM d_actions a JOIN b_tickets t USING (ticket_id) JOIN b_dim_event e ON e.CVEventID = t.event_id
WHERE a.is_rep_action = 1"""

CTES["d_event_tickets"] = """
SELECT t.* EXCLUDE (event_date), t.event_date AS ticket_event_date, e.EventName AS event_name,
       e.EventType AS event_type, e.StartDate AS event_date, e.EventCode AS event_code,
       e.TargetAttendance AS target_attendance, e.CityName AS event_city, e.VenueName AS venue
FROM d_tickets_all t JOIN b_dim_event e ON e.CVEventID = t.event_id"""

# --- customer lists --------------------------------------------------------------

STATUSES = {
    "open": "Open", "undecided": "Undecided", "undecided_at_sale": "Undecided at Sale",
    "expired": "Expired", "assigned": "Assigned", "scheduled": "Scheduled",
    "reserved": "Reserved", "attended": "Attended", "no show": "No Show",
    "cancelled": "Cancelled",
}


def _counts_as(name) -> str:
    return ",\n       ".join(
        f"count(*) FILTER (st = '{s}') AS {name(s)}" for s in STATUSES
    )


def _snake(status: str) -> str:
    return f"{status.replace(' ', '_')}_tickets"


def _list_ctes(product: str, counted: bool) -> dict[str, str]:
    """The stages of one list; names carry the product."""
    p = product.lower()
    ctes: dict[str, str] = {}
    ctes[f"d_{p}_scope"] = f"""
SELECT t.*, lower(t.status) AS st, s.transaction_date, s.purchaser_name AS sale_name,
       s.purchaser_email AS sale_email, s.purchaser_phone AS sale_phone
FROM b_tickets t LEFT JOIN b_transactions s ON s.cv_transaction_id = t.transaction_id
WHERE contains(t.product_name, '{product}') AND t.is_deleted = 0
  AND t.customer_id IS NOT NULL  -- such tickets belong to no business
"""
    ctes[f"d_{p}_rollup"] = f"""
SELECT customer_id, count(DISTINCT ticket_id) AS ticket_count,
       count(DISTINCT ticket_id) FILTER (st IN ('open', 'undecided', 'undecided_at_sale',
                                                'expired')) AS unscheduled_tickets,
       min(transaction_date)::DATE AS first_purchase_date,
       max(transaction_date)::DATE AS latest_purchase_date,
       min(event_date) FILTER (st IN ('scheduled', 'reserved') AND event_date >= {TODAY})
           AS next_event_date,
       max(event_date) FILTER (st = 'attended') AS last_attended_date,
       min(ifnull(undecided_timestamp, registration_date)) AS priority_date,
       ['Do Not Call', 'Do Not Blast', 'Do Not Contact'][nullif(max(list_position(
           ['Do Not Call', 'Do Not Blast', 'Do Not Contact'], outreach_restriction)), 0)]
           AS outreach_restriction
FROM d_{p}_scope GROUP BY customer_id"""
    ctes[f"d_{p}_counts"] = f"""
SELECT customer_id, {_counts_as(_snake)} FROM d_{p}_scope GROUP BY customer_id"""
    ctes[f"d_{p}_types"] = (
        f"""
SELECT customer_id, string_agg(format('{{}} x{{}}', product_name, n), ', ' ORDER BY product_name)
           AS ticket_types
FROM (SELECT customer_id, product_name, count(*) AS n FROM d_{p}_scope GROUP BY ALL) x
GROUP BY customer_id"""
        if counted
        else f"""
SELECT customer_id, string_agg(DISTINCT ticket_type, ', ' ORDER BY ticket_type) AS ticket_types
FROM d_{p}_scope WHERE ticket_type IS NOT NULL GROUP BY customer_id"""
    )
    ctes[f"d_{p}_ids"] = f"""
SELECT customer_id, string_agg(DISTINCT ticket_id, ', ' ORDER BY ticket_id) AS ticket_ids
FROM d_{p}_scope GROUP BY customer_id"""
    ctes[f"d_{p}_orders"] = f"""
SELECT customer_id,
       string_agg(DISTINCT sales_order_id, ', ' ORDER BY sales_order_id) AS sales_orders
FROM d_{p}_scope WHERE trim(sales_order_id) <> '' GROUP BY customer_id"""
    ctes[f"d_{p}_activity"] = f"""
SELECT t.customer_id,
       max(a.blast_date) FILTER (contains(t.product_name, '{product}')) AS last_blast_product,
       max(a.last_called_date) FILTER (contains(t.product_name, '{product}')) AS last_call_product,
       max(a.blast_date) AS last_blast_all, max(a.last_called_date) AS last_call_all
FROM b_attendee_tickets a JOIN b_tickets t USING (ticket_id)
WHERE t.customer_id IN (SELECT customer_id FROM d_{p}_scope)
GROUP BY t.customer_id"""
    ctes[f"d_{p}_candidates"] = f"""
SELECT customer_id,
       if(purchaser_name IS NULL OR rtrim(purchaser_name) IN ('ImportJob', ''), sale_name,
          purchaser_name) AS contact_name,
       if(purchaser_email IS NULL OR rtrim(purchaser_email) IN ('ImportJob', ''), sale_email,
          purchaser_email) AS contact_email,
       if(purchaser_phone IS NULL OR rtrim(purchaser_phone) IN ('ImportJob', ''), sale_phone,
          purchaser_phone) AS contact_phone,
       'purchaser' AS contact_source
FROM d_{p}_scope
WHERE coalesce(rtrim(purchaser_email) NOT IN ('ImportJob', ''), false)
   OR coalesce(rtrim(sale_email) NOT IN ('ImportJob', ''), false)
UNION ALL BY NAME
SELECT customer_id, attendee_name AS contact_name, attendee_email AS contact_email,
       attendee_phone AS contact_phone, 'attendee' AS contact_source
FROM b_attendees WHERE NOT contains(attendee_email, '+placeholder@')
UNION ALL BY NAME
SELECT c.id AS customer_id, e.BusinessOwnerName AS contact_name, e.Email AS contact_email,
       e.Phone AS contact_phone, 'netsuite' AS contact_source
FROM b_silver_entity e JOIN b_dim_customer d ON d.NetSuiteID = e.EntityID
JOIN b_customers c ON c.cv_customer_id = d.CVCustomerID
WHERE rtrim(e.Email) <> ''
UNION ALL BY NAME
SELECT c.id AS customer_id, o.PersonName AS contact_name, o.Email AS contact_email,
       o.Phone AS contact_phone, 'business_owner' AS contact_source
FROM b_dim_person o JOIN b_dim_customer_contact l ON l.Person = o.CVPersonID
JOIN b_customers c ON c.cv_customer_id = l.Customer
WHERE rtrim(o.Email) <> '' AND l.StaffTitleName = 'Owner' AND l.IsActiveName = 'Yes'"""
    ctes[f"d_{p}_contacts"] = f"""
SELECT * FROM d_{p}_candidates SEMI JOIN d_{p}_scope USING (customer_id)
QUALIFY row_number() OVER (
  PARTITION BY customer_id
  ORDER BY list_position(['business_owner', 'attendee', 'purchaser', 'netsuite'], contact_source),
           lower(contact_email) NULLS FIRST, lower(contact_name) NULLS FIRST,
           lower(contact_phone) NULLS FIRST, contact_email NULLS FIRST,
           contact_name NULLS FIRST, contact_phone NULLS FIRST) = 1"""
    for suffix, test in (("product", f"contains(product_name, '{product}')"), ("all", "true")):
        ctes[f"d_{p}_summary_{suffix}"] = f"""
SELECT customer_id, string_agg(st || ': ' || items, ' | ' ORDER BY place, st) AS summary_{suffix}
FROM (SELECT customer_id, st,
             string_agg(product_name || ' x' || n, ', ' ORDER BY product_name) AS items,
             ifnull(nullif(list_position(
                 ['undecided', 'undecided_at_sale', 'open', 'reserved', 'scheduled', 'assigned',
                  'attended', 'no show', 'expired', 'cancelled'], st), 0), 11) AS place
      FROM (SELECT customer_id, lower(status) AS st, product_name, count(*) AS n FROM b_tickets
            WHERE is_deleted = 0 AND {test}
              AND customer_id IN (SELECT customer_id FROM d_{p}_scope)
            GROUP BY ALL) x
      GROUP BY customer_id, st) y
GROUP BY customer_id"""
    ctes[f"d_{p}_list"] = f"""
SELECT f.business_name AS "Business Name", f.cv_customer_id AS "CV Customer ID",
       p.contact_name AS "Contact Name", p.contact_email AS "Contact Email",
       p.contact_phone AS "Contact Phone", p.contact_source AS "Contact Source",
       CASE (n.open_tickets + n.undecided_tickets + n.undecided_at_sale_tickets > 0)::INT * 2
            + (n.expired_tickets > 0)::INT
            WHEN 0 THEN 'Nothing to Schedule' WHEN 1 THEN 'Expired Only'
            WHEN 2 THEN 'Open/Undecided Only' ELSE 'Open/Undecided + Expired'
       END AS "Unscheduled Ticket Group",
       r.ticket_count AS "Total Tickets", r.unscheduled_tickets AS "Unscheduled Tickets",
       {", ".join(f'n.{_snake(s)} AS "{label} Tickets"' for s, label in STATUSES.items())},
       r.first_purchase_date AS "First Purchase Date",
       r.latest_purchase_date AS "Latest Purchase Date",
       ({TODAY} - r.latest_purchase_date)::INTEGER AS "Days Since Latest Purchase",
       r.next_event_date AS "Next Event Date", r.last_attended_date AS "Last Attended Event Date",
       r.outreach_restriction AS "Outreach Restriction",
       a.last_blast_product AS "Last Blast (This Product)",
       a.last_call_product AS "Last Call (This Product)",
       ({TODAY} - greatest(a.last_blast_product, a.last_call_product))::INTEGER
           AS "Days Since Last Contact (This Product)",
       a.last_blast_all AS "Last Blast (All Products)",
       a.last_call_all AS "Last Call (All Products)",
       ({TODAY} - greatest(a.last_blast_all, a.last_call_all))::INTEGER
           AS "Days Since Last Contact (All Products)",
       f.elite_status AS "Elite Status", f.pr_status AS "PR Client Status",
       f.sbu_status AS "SBU Client Status", f.abr AS "Annual Business Revenue",
       f.vertical AS "Vertical", f.sub_vertical AS "Sub-Vertical",
       if(g.customer_id IS NULL, 'No', 'Yes') AS "{FLAGSHIP} Customer",
       g.first_flagship_date AS "First {FLAGSHIP} Purchase Date",
       r.priority_date AS "Queue Start Date",
       ({TODAY} - r.priority_date::DATE)::INTEGER AS "Days in Queue",
       y.ticket_types AS "Ticket Types", i.ticket_ids AS "Ticket IDs",
       o.sales_orders AS "Sales Order Numbers",
       sp.summary_product AS "Ticket Summary (This Product)",
       sa.summary_all AS "Ticket Summary (All Products)", {AS_OF} AS "Generated At"
FROM d_{p}_contacts p
JOIN d_profile f USING (customer_id)
JOIN d_{p}_rollup r USING (customer_id)
JOIN d_{p}_counts n USING (customer_id)
LEFT JOIN d_{p}_types y USING (customer_id)
LEFT JOIN d_{p}_ids i USING (customer_id)
LEFT JOIN d_{p}_orders o USING (customer_id)
LEFT JOIN d_{p}_activity a USING (customer_id)
LEFT JOIN d_first_purchase g USING (customer_id)
LEFT JOIN d_{p}_summary_product sp USING (customer_id)
LEFT JOIN d_{p}_summary_all sa USING (customer_id)"""
    return ctes


CTES["d_first_purchase"] = f"""
SELECT c.id AS customer_id, min(g.GLDate) AS first_flagship_date
FROM b_customers c JOIN b_fact_gl g ON g.CVCustomerID = c.cv_customer_id
WHERE g.GLLineID <> 0 AND g.SalesOrderCashCollected > 0
  AND g.CVProductID IN (SELECT CVProductID FROM b_dim_product
                        WHERE contains(ProductName, '{FLAGSHIP}'))
GROUP BY c.id"""

CTES["d_profile"] = """
SELECT c.id AS customer_id, c.name AS business_name, c.cv_customer_id,
       d.EliteStatusName AS elite_status, d.PRClientStatusName AS pr_status,
       d.SBUClientStatusName AS sbu_status, d.AnnualBusinessRevenueName AS abr,
       d.VerticalName AS vertical, d.SubVerticalName AS sub_vertical
FROM b_customers c LEFT JOIN b_dim_customer d ON d.CVCustomerID = c.cv_customer_id"""

for _product, _counted in (("Alpha", True), ("Beta", True), ("Gamma", False)):
    CTES.update(_list_ctes(_product, _counted))

# --- checks: an earlier version of the lists ----------------------------------

# Before deletions, and with the tickets registered by then.
OLD_TICKETS = "registration_date < TIMESTAMP '1999-01-01 00:00:00'"

for _product in ("Alpha", "Beta", "Gamma"):
    CTES[f"d_{_product.lower()}_old_ids"] = f"""
SELECT DISTINCT c.cv_customer_id
FROM b_customers c JOIN (
    SELECT customer_id, transaction_id, purchaser_email FROM b_tickets
    WHERE {OLD_TICKETS} AND contains(product_name, '{_product}')) t ON t.customer_id = c.id
LEFT JOIN b_transactions s ON s.cv_transaction_id = t.transaction_id
WHERE coalesce(t.purchaser_email NOT IN ('ImportJob', ''), false)
   OR coalesce(s.purchaser_email NOT IN ('ImportJob', ''), false)
   OR c.id IN (SELECT customer_id FROM d_{_product.lower()}_candidates
               WHERE contact_source <> 'purchaser')"""

_RECOUNT_CHECKS = {
    "status_counts_match": " OR ".join(
        f'l."{label} Tickets" <> x.n_{s.replace(" ", "_")}' for s, label in STATUSES.items()
    ),
    "dates_match": (
        'l."First Purchase Date" IS DISTINCT FROM x.first_bought '
        'OR l."Latest Purchase Date" IS DISTINCT FROM x.last_bought '
        'OR l."Next Event Date" IS DISTINCT FROM x.next_event '
        'OR l."Last Attended Event Date" IS DISTINCT FROM x.last_attended'
    ),
    "first_flagship_purchase_matches": (
        'l."First Alpha Purchase Date" IS DISTINCT FROM g.d '
        "OR (l.\"Alpha Customer\" = 'Yes') <> (g.d IS NOT NULL)"
    ),
    "elite_label_matches": (
        "l.\"Elite Status\" IS DISTINCT FROM CASE d.EliteStatus WHEN '3' THEN 'E125' "
        "WHEN '4' THEN 'E250' END"
    ),
    "verticals_match": (
        "nullif(l.\"Vertical\", '') IS DISTINCT FROM nullif(d.VerticalName, '') "
        "OR nullif(l.\"Sub-Vertical\", '') IS DISTINCT FROM nullif(d.SubVerticalName, '')"
    ),
    "touch_dates_match": (
        'l."Last Blast (This Product)" IS DISTINCT FROM w.bp '
        'OR l."Last Call (This Product)" IS DISTINCT FROM w.cp '
        'OR l."Last Blast (All Products)" IS DISTINCT FROM w.ba '
        'OR l."Last Call (All Products)" IS DISTINCT FROM w.ca'
    ),
}

for _product in ("Alpha", "Beta", "Gamma"):
    CTES[f"d_{_product.lower()}_recounted"] = f"""
SELECT l.*, {", ".join(f"({test}) AS bad_{name}" for name, test in _RECOUNT_CHECKS.items())}
FROM d_{_product.lower()}_list l
JOIN (SELECT c.cv_customer_id AS cv,
             {", ".join(f"count(*) FILTER (lower(t.status) = '{s}') AS n_{s.replace(' ', '_')}"
                        for s in STATUSES)},
             min(s.transaction_date)::DATE AS first_bought,
             max(s.transaction_date)::DATE AS last_bought,
             min(t.event_date) FILTER (lower(t.status) IN ('scheduled', 'reserved')
                                       AND t.event_date >= {TODAY}) AS next_event,
             max(t.event_date) FILTER (lower(t.status) = 'attended') AS last_attended
      FROM b_tickets t JOIN b_customers c ON c.id = t.customer_id
      LEFT JOIN b_transactions s ON s.cv_transaction_id = t.transaction_id
      WHERE contains(t.product_name, '{_product}') AND t.is_deleted = 0 GROUP BY ALL) x
  ON x.cv = l."CV Customer ID"
LEFT JOIN (SELECT g.CVCustomerID AS cv, min(g.GLDate) AS d
           FROM b_fact_gl g JOIN b_dim_product p USING (CVProductID)
           WHERE contains(p.ProductName, 'Alpha') AND g.GLLineID <> 0
             AND g.SalesOrderCashCollected > 0 GROUP BY ALL) g ON g.cv = l."CV Customer ID"
LEFT JOIN b_dim_customer d ON d.CVCustomerID = l."CV Customer ID"
LEFT JOIN (SELECT c.cv_customer_id AS cv,
                  max(a.blast_date) FILTER (contains(t.product_name, '{_product}')) AS bp,
                  max(a.last_called_date) FILTER (contains(t.product_name, '{_product}')) AS cp,
                  max(a.blast_date) AS ba, max(a.last_called_date) AS ca
           FROM b_attendee_tickets a JOIN b_tickets t USING (ticket_id)
           JOIN b_customers c ON c.id = t.customer_id GROUP BY ALL) w
  ON w.cv = l."CV Customer ID\""""

_USED = re.compile(r"\b[bd]_[a-z_]+\b")


def query(body: str, replaced: dict[str, str] | None = None) -> str:
    """The statement with the common table expressions it needs, in order.

    ``replaced`` states some of them anew; ``<name>_once`` is then the original.
    """
    ctes = dict(CTES)
    for name, text in (replaced or {}).items():
        ctes[f"{name}_once"], ctes[name] = CTES[name], text
    needed: list[str] = []

    def need(text: str) -> None:
        for name in _USED.findall(text):
            if name in ctes and name not in needed:
                need(ctes[name])
                needed.append(name)

    need(body)
    used = ",\n".join(f"{name} AS ({ctes[name]}\n)" for name in needed)
    return f"WITH {used}\n{body}" if used else body


# --- measures ----------------------------------------------------------------------


def tickets_where(test: str, name: str) -> str:
    return f"count(DISTINCT ticket_id) FILTER ({test}) AS {name}"


REP = "is_rep_action = 1"
PAST = f"{REP} AND is_last_confirmer = 1 AND CAST(original_event_date AS TIMESTAMP) < {AS_OF}"
MISSED = "ticket_outcome IN ('No Show', 'No Show (Reset)')"

CONFIRMATIONS = ", ".join(
    [
        tickets_where(f"{REP} AND {ANY}", "confirmations"),
        tickets_where(f"{REP} AND {C}", "confirmed"),
        tickets_where(f"{REP} AND {DC}", "double_confirmed"),
        tickets_where(f"{REP} AND {DC}", "double_confirmations"),
    ]
)
WEEKS = ", ".join(
    [
        tickets_where(f"{REP} AND {ANY} AND week_offset = 0", "confirmations_tw"),
        tickets_where(f"{REP} AND {ANY} AND week_offset = -1", "confirmations_lw"),
    ]
)
WOW = (
    "confirmations_tw - confirmations_lw AS wow_change, "
    "(confirmations_tw - confirmations_lw)::DOUBLE / nullif(confirmations_lw, 0) AS wow_pct"
)
DEPTH = ", ".join(
    [
        tickets_where(f"{REP} AND {C} AND ticket_confirmation_rank = 1", "net_new_confirmed"),
        tickets_where(
            f"{REP} AND {DC} AND ticket_confirmation_rank = 1", "net_new_double_confirmed"
        ),
        tickets_where(
            f"{REP} AND {C} AND ticket_confirmation_rank = 1 AND action_date_az = {TODAY}",
            "net_new_confirmed_today",
        ),
        tickets_where(
            f"{REP} AND {C} AND ticket_status_action_count >= 2", "tickets_confirmed_2plus"
        ),
        f"coalesce(max(ticket_status_action_count) FILTER ({C}), 0) AS times_confirmed",
        f"coalesce(max(ticket_status_action_count) FILTER ({DC}), 0) AS times_double_confirmed",
    ]
)
TRAVEL = ", ".join(
    [tickets_where("is_first_travel_action = 1", "rt_travel_confirmed")]
    + [
        tickets_where(
            "is_first_travel_action = 1 AND ticket_id IN (SELECT ticket_id FROM d_tickets_all "
            f"WHERE lower(travel_type) = '{label}')",
            name,
        )
        for name, label in (
            ("rt_flight_only", "flight only"), ("rt_hotel_only", "hotel only"),
            ("rt_both", "both"), ("rt_is_local", "is local"),
        )
    ]
)
HEALTH = ", ".join(
    [
        tickets_where("NOT is_reset_ghost", "total_tickets"),
        tickets_where(f"NOT is_reset_ghost AND {ANY}", "confirmed_tickets"),
        "nullif(confirmed_tickets, 0)::DOUBLE / nullif(total_tickets, 0) AS pct_confirmed",
    ]
)
OUTCOMES = ", ".join(
    [
        tickets_where(f"{PAST} AND {C}", "confirmed_past"),
        tickets_where(f"{PAST} AND {C} AND ticket_outcome = 'Attended'", "confirmed_attended"),
        tickets_where(f"{PAST} AND {DC}", "dc_past"),
        tickets_where(f"{PAST} AND {DC} AND ticket_outcome = 'Attended'", "dc_attended"),
        tickets_where(f"{PAST} AND {C} AND {MISSED}", "confirmed_no_shows"),
        tickets_where(f"{PAST} AND {DC} AND {MISSED}", "dc_no_shows"),
        "nullif(confirmed_attended, 0)::DOUBLE / nullif(confirmed_past, 0) "
        "AS confirmation_attendance_pct",
        "nullif(dc_attended, 0)::DOUBLE / nullif(dc_past, 0) AS dc_attendance_pct",
        "nullif(confirmed_no_shows, 0)::DOUBLE / nullif(confirmed_past, 0) "
        "AS confirmed_no_show_pct",
        "nullif(dc_no_shows, 0)::DOUBLE / nullif(dc_past, 0) AS dc_no_show_pct",
    ]
)


def by(group: str, values: str, facts: str) -> str:
    return query(f"SELECT {group}, {values} FROM {facts} GROUP BY {group}")


def verdict_union(rows: str, id_col: str, bad: dict[str, str]) -> str:
    """One verdict row per check; ``bad`` holds the failing condition."""

    def one(name: str, test: str) -> str:
        named = f"FILTER (({test}) AND {id_col} IS NOT NULL)"
        return (
            f"SELECT '{name}' AS \"check\", count(*) FILTER ({test}) = 0 AS passed, "
            f"count(*) FILTER ({test}) AS failing_count, "
            f"array_to_string((list({id_col} ORDER BY {id_col}) {named})[1:5], ', ') "
            f"|| if(count(*) {named} > 5, ' ...', '') AS sample FROM {rows}"
        )

    return "\nUNION ALL BY NAME\n".join(one(name, test) for name, test in bad.items())
