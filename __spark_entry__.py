"""

Every query runs over whole tables derived from the parquet files in the given
folder; the expected results are DuckDB SQL over the same files.
"""

from __future__ import annotations

import importlib.util
import re
import sys
from collections.abc import Callable
from functools import reduce
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oracle import duckdb_sql as sql
from rollcall.plans import (
    actions,
    checks,
    contexts,
    increments,
    lists,
    measures,
    reports,
    versions as kept_versions,
)
from rollcall.plans.tickets import ghost_tickets, tickets_all
from rollcall.sinks import in_file_order, shared_path, staged, write_change_file, write_report
from rollcall.sources.sample import FLAGSHIP, PATTERNS, SETTINGS, UNDECLARED, sample_tables
from rollcall.sources.tables import Tables

#: The text operators and the pipeline over them are an optional part.
if importlib.util.find_spec("rollcall.llm") and importlib.util.find_spec("corpus_pipeline"):
    import corpus_pipeline
    from rollcall.llm import queries as text_queries
else:
    corpus_pipeline = text_queries = None

Query = Callable[[SparkSession, str], DataFrame]

SPECS = {
    "alpha": lists.ListSpec(PATTERNS["alpha"], FLAGSHIP),
    "beta": lists.ListSpec(PATTERNS["beta"], FLAGSHIP),
    "gamma": lists.ListSpec(PATTERNS["gamma"], FLAGSHIP, counted_types=False),
}
ALPHA = SPECS["alpha"]


def entry(spark: SparkSession) -> DataFrame:
    """Confirmation state of every event."""
    return queries()["event_overview"](spark, "/root/testdata/sf0.001")


def _repeated(t: Tables) -> Tables:
    """The tables with some tickets, sales and customers recorded twice."""
    twice = {
        "tickets": "ticket_id LIKE '%5'",
        "transactions": "cv_transaction_id % 6 = 1",
        "customers": "id % 60 = 7",
    }
    return t.replaced(**{n: t[n].unionByName(t[n].filter(test)) for n, test in twice.items()})


def _over(build: Callable[[Tables], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(sample_tables(spark, sf_dir))


# --- facts and reports -----------------------------------------------------------


def _fact_queries() -> dict[str, Callable[[Tables], DataFrame]]:
    s = SETTINGS
    return {
        "tickets_all": tickets_all,
        "ghost_dedup": lambda t: ghost_tickets(t["tickets"], t["ticket_no_show_resets"]),
        "status_touches": lambda t: actions.status_touches(t["history"], s),
        "date_touches": lambda t: actions.date_touches(t["history"], s),
        "pre_history_touches": lambda t: actions.pre_history_touches(
            t["tickets"], t["history"], s
        ),
        "unique_actions": lambda t: actions.unique_actions(t, s),
        "first_travel": lambda t: actions.first_travel(t, s),
        "reset_context": lambda t: actions.reset_context(t["ticket_no_show_resets"]),
        "week_math": lambda t: actions.with_weeks(actions.unique_actions(t, s), s),
        "confirmation_actions": lambda t: actions.confirmation_actions(t, s),
    }


def _kept_log_queries() -> dict[str, Callable[[Tables], DataFrame]]:
    s = SETTINGS

    def kept(t: Tables) -> DataFrame:
        """The touches of the history, kept by day and brought up to date in three runs: the third
        brings the last days, late rows of earlier ones, and rows that are there already."""
        history = t["history"]
        path = shared_path(history.sparkSession)
        late = F.col("ticket_id").endswith("3")
        early = F.col("changed_at") < F.lit("2024-01-12 18:00:00").cast("timestamp_ntz")
        middle = F.col("changed_at") < F.lit("2024-01-21 03:00:00").cast("timestamp_ntz")
        increments.record(history.filter(early & ~late), s, path)
        increments.record(history.filter(middle & ~early & ~late), s, path)
        return increments.record(history.filter(late | ~middle | F.col("ticket_id").endswith("1")), s, path)

    return {
        "unique_actions_kept": lambda t: actions.all_actions(kept(t), t, s),
        "confirmation_actions_kept": lambda t: actions.confirmation_actions(t, s, kept(t)),
    }


def _report_queries() -> dict[str, Callable[[Tables], DataFrame]]:
    s = SETTINGS

    def people(t: Tables):
        return t["dim_event"], t["attendees"], t["customers"]

    return {
        "event_overview": lambda t: reports.event_overview(tickets_all(t), t["dim_event"], s),
        "rep_performance": lambda t: reports.rep_performance(
            actions.ticket_actions(t, s), t["dim_employee"], t["dim_event"]
        ),
        "daily_activity": lambda t: reports.daily_activity(
            actions.ticket_actions(t, s), t["dim_event"]
        ),
        "depth_per_ticket": lambda t: reports.depth_per_ticket(
            actions.ticket_actions(t, s), t["dim_event"]
        ),
        "depth_per_company": lambda t: reports.depth_per_company(
            tickets_all(t), t["dim_event"], t["customers"], s
        ),
        "attendance_outcomes": lambda t: reports.attendance_outcomes(
            actions.ticket_actions(t, s), t["dim_event"], s
        ),
        "travel_status": lambda t: reports.travel_status(tickets_all(t), t["dim_event"], s),
        "outreach_queue": lambda t: reports.outreach_queue(tickets_all(t), *people(t), s),
        "roster": lambda t: reports.roster(tickets_all(t), *people(t)),
        "event_overview_undeclared": lambda t: reports.event_overview(
            tickets_all(_repeated(t)), t["dim_event"], UNDECLARED
        ),
        "depth_per_company_repeated": lambda t: reports.depth_per_company(
            tickets_all(t), t["dim_event"], _repeated(t)["customers"], s
        ),
        "roster_of_event": lambda t: reports.roster(tickets_all(t), *people(t), event_id="EV-7"),
    }


# --- customer lists --------------------------------------------------------------


def _list_queries() -> dict[str, Callable[[Tables], DataFrame]]:
    s = SETTINGS

    def scoped(t: Tables, name: str = "alpha") -> DataFrame:
        return lists.scope(t, SPECS[name].product)

    def businesses(t: Tables) -> DataFrame:
        return scoped(t).select("customer_id").distinct()

    def of_businesses(df: DataFrame, t: Tables) -> DataFrame:
        return df.join(businesses(t), "customer_id", "left_semi")

    def candidates(t: Tables) -> DataFrame:
        return lists.contact_candidates(t, scoped(t), s)

    def listing(name: str) -> Callable[[Tables], DataFrame]:
        return lambda t: lists.customer_list(t, SPECS[name], s)

    return {
        "list_scope": lambda t: scoped(t).select(
            "customer_id", "ticket_id", "transaction_id", "product_name", "ticket_type", "status",
            "event_date", "undecided_timestamp", "registration_date", "outreach_restriction",
            "purchaser_name", "purchaser_email", "purchaser_phone", "sales_order_id",
            "transaction_date",
        ),
        "list_ticket_summary": lambda t: lists.ticket_summary(scoped(t), s),
        "list_status_counts": lambda t: lists.status_counts(scoped(t)),
        "list_types_counted": lambda t: lists.types_counted(scoped(t)),
        "list_types_distinct": lambda t: lists.types_distinct(scoped(t, "gamma")),
        "list_ticket_ids": lambda t: lists.ticket_ids(scoped(t)),
        "list_sales_orders": lambda t: lists.sales_orders(scoped(t)),
        "list_last_activity": lambda t: of_businesses(lists.last_activity(t, ALPHA.product), t),
        "list_first_purchase": lambda t: lists.first_purchase(t, FLAGSHIP),
        "list_profile": lists.profile,
        "list_contact_candidates": lambda t: lists.distinct_contacts(candidates(t)),
        "list_contacts": lambda t: of_businesses(lists.pick_contact(candidates(t)), t),
        "list_summary_product": lambda t: lists.status_summary(t, ALPHA.product).drop(
            "summary_all"
        ),
        "list_summary_all": lambda t: lists.status_summary(t, ALPHA.product).drop(
            "summary_product"
        ),
        "list_alpha": listing("alpha"),
        "list_beta": listing("beta"),
        "list_gamma": listing("gamma"),
        "list_alpha_undeclared": lambda t: lists.customer_list(
            t.replaced(**{n: _repeated(t)[n] for n in ("tickets", "transactions")}),
            ALPHA,
            UNDECLARED,
        ),
    }


# --- measures --------------------------------------------------------------------


def _measure_queries() -> dict[str, Callable[[Tables], DataFrame]]:
    s = SETTINGS

    def over_actions(measure, *group_cols: str) -> Callable[[Tables], DataFrame]:
        return lambda t: measure(actions.confirmation_actions(t, s), list(group_cols), s)

    def over_event_actions(measure, *group_cols: str) -> Callable[[Tables], DataFrame]:
        return lambda t: measure(actions.ticket_actions(t, s), list(group_cols), s)

    def travel(*group_cols: str) -> Callable[[Tables], DataFrame]:
        return lambda t: measures.travel(
            actions.confirmation_actions(t, s), tickets_all(t), list(group_cols), s
        )

    def health(*group_cols: str) -> Callable[[Tables], DataFrame]:
        return lambda t: measures.event_health(tickets_all(t), list(group_cols), s)

    return {
        "measures_confirmations": over_actions(measures.confirmations),
        "measures_confirmations_by_rep": over_actions(measures.confirmations, "user_email"),
        "measures_confirmations_by_week_and_status": over_actions(
            measures.confirmations, "week_label", "confirmation_status"
        ),
        "measures_businesses": lambda t: measures.businesses(t["customers"], [], s),
        "measures_week_over_week": over_actions(measures.week_over_week),
        "measures_week_over_week_by_rep_and_week": over_actions(
            measures.week_over_week, "user_email", "week_label"
        ),
        "measure_data_status": over_actions(measures.data_status),
        "measures_depth": over_actions(measures.depth),
        "measures_depth_by_week_and_status": over_actions(
            measures.depth, "week_start_date", "confirmation_status"
        ),
        "measures_travel": travel(),
        "measures_travel_by_week": travel("week_start_date"),
        "measures_event_health": health(),
        "measures_event_health_by_event": health("event_id"),
        "measures_event_health_by_status": health("confirmation_status"),
        "measures_confirmations_by_event": over_event_actions(measures.confirmations, "event_id"),
        "measures_depth_by_rep": over_actions(measures.depth, "user_email"),
        "measures_travel_by_rep": travel("user_email"),
        "measures_event_health_undeclared": lambda t: measures.event_health(
            tickets_all(_repeated(t)), [], UNDECLARED
        ),
        "measures_outcomes": over_actions(measures.outcomes),
        "measures_outcomes_by_event": over_event_actions(measures.outcomes, "event_id"),
        "measure_days_to_dc": over_actions(measures.days_to_double),
        "measure_days_to_dc_by_rep": over_actions(measures.days_to_double, "user_email"),
        "measures_titled": lambda t: measures.with_titles(
            measures.confirmations(actions.confirmation_actions(t, s), ["week_label"], s)
        ),
    }


# --- measures in a restricted report -------------------------------------------------


def _of_vip_product() -> contexts.Filters:
    return {"product_name": F.col("product_name").contains("VIP")}


def _of_standard_events() -> contexts.Filters:
    return {"EventType": F.col("EventType").startswith("STANDARD")}


def _of_some_teams() -> contexts.Filters:
    return {"Team": F.col("Team") < "NATION_15"}


def _of_pr_customers() -> contexts.Filters:
    return {"PR": F.col("PR") == "No"}


def _context_queries() -> dict[str, Callable[[Tables], DataFrame]]:
    s = SETTINGS

    def model(t: Tables) -> contexts.Model:
        return contexts.Model(
            actions.confirmation_actions(t, s), tickets_all(t), t["dim_event"], t["customers"],
            t["dim_employee"],
        )

    def within(name: str, *group_cols: str, **tests: Callable[[], contexts.Filters]):
        def build(t: Tables) -> DataFrame:
            context = contexts.Context(**{table: test() for table, test in tests.items()})
            return contexts.measured(name, model(t), context, list(group_cols), s)

        return build

    return {
        "measures_confirmations_of_product_by_rep": within(
            "confirmations", "user_email", tickets=_of_vip_product
        ),
        "measures_confirmations_of_all": within(
            "confirmations", tickets=_of_vip_product, events=_of_standard_events,
            employees=_of_some_teams, customers=_of_pr_customers,
        ),
        "measures_depth_of_event_type": within(
            "depth", "week_start_date", "confirmation_status", events=_of_standard_events
        ),
        "measures_depth_of_status_by_rep": within(
            "depth", "user_email", employees=_of_some_teams,
            actions=lambda: {
                "confirmation_status": F.col("confirmation_status") == "Confirmed",
                "ticket_outcome": F.col("ticket_outcome") == "Attended",
            },
        ),
        "measures_outcomes_of_team": within("outcomes", employees=_of_some_teams),
        "measures_outcomes_of_customers_by_rep": within(
            "outcomes", "user_email", customers=_of_pr_customers
        ),
        "measures_week_over_week_of_week": within(
            "week_over_week", "user_email", tickets=_of_vip_product,
            actions=lambda: {"week_label": F.col("week_label") == "Last Week"},
        ),
        "measures_travel_of_type": within(
            "travel", "week_start_date", events=_of_standard_events,
            tickets=lambda: {"travel_type": F.col("travel_type") == "Both"},
        ),
        "measures_travel_of_team": within("travel", employees=_of_some_teams),
        "measures_event_health_of_event_type": within(
            "event_health", events=_of_standard_events, customers=_of_pr_customers,
            tickets=lambda: {"confirmation_status": F.lower("confirmation_status") == "confirmed"},
        ),
        "measures_event_health_of_product_by_event": within(
            "event_health", "event_id", tickets=_of_vip_product
        ),
        "measure_days_to_dc_of_customers_by_rep": within(
            "days_to_double", "user_email", customers=_of_pr_customers,
            actions=lambda: {
                "confirmation_status": F.col("confirmation_status") == "Double Confirmed",
                "confirmation_touch_source": F.col("confirmation_touch_source") != "Date Update",
            },
        ),
        "measure_data_status_of_team": within("data_status", employees=_of_some_teams),
        "measures_businesses_of_customers": within("businesses", "vertical", customers=_of_pr_customers),
    }


# --- order of rows ---------------------------------------------------------------

# The columns by which a report is ordered, as far as it shows them, in DuckDB's words.
ORDERS = {
    "event_overview": "event_date DESC NULLS LAST, event_name NULLS FIRST, event_code NULLS FIRST",
    "rep_performance": "action_date DESC NULLS LAST, tickets_confirmed DESC, rep_email NULLS FIRST, "
    "event_name NULLS FIRST, confirmation_status NULLS FIRST",
    "daily_activity": "action_date DESC NULLS LAST, event_type NULLS FIRST, tickets_confirmed DESC, "
    "event_name NULLS FIRST, confirmation_status NULLS FIRST, confirmation_touch_source NULLS FIRST",
    "depth_per_ticket": "event_date DESC NULLS LAST, confirmation_status NULLS FIRST, "
    "times_confirmed_to_this_status NULLS FIRST",
    "depth_per_company": "event_date DESC NULLS LAST, total_confirmed_tickets DESC",
    "attendance_outcomes": "event_date DESC NULLS LAST, confirmation_status NULLS FIRST, "
    "ticket_status NULLS FIRST",
    # A category that is missing is shown as Not Confirmed and comes first.
    "travel_status": "event_date ASC NULLS FIRST, nullif(travel_category, 'Not Confirmed') NULLS FIRST",
    "outreach_queue": "event_date NULLS FIRST, outreach_restriction NULLS FIRST, "
    "company_name NULLS FIRST, attendee_name NULLS FIRST, ticket_id NULLS FIRST",
    "roster": "is_reset_ghost NULLS FIRST, company_name NULLS FIRST, attendee_name NULLS FIRST, "
    "ticket_id NULLS FIRST",
    **{f"list_{name}": '"Queue Start Date" NULLS FIRST, "CV Customer ID" NULLS FIRST' for name in SPECS},
}


def _ordered_columns(name: str) -> list[str]:
    plain = re.sub(r"nullif\((\w+), '[^']*'\)", r"\1", ORDERS[name])
    return [re.match(r'"[^"]+"|\w+', term)[0].strip('"') for term in plain.split(", ")]


def _order_queries() -> dict[str, Callable[[Tables], DataFrame]]:
    """Position and columns of order of each report as it is written to files."""
    made = {**_report_queries(), **_list_queries()}

    def ordered(name: str) -> Callable[[Tables], DataFrame]:
        def build(t: Tables) -> DataFrame:
            report = made[name](t)
            path = shared_path(report.sparkSession)
            write_report(report, path)
            return in_file_order(report.sparkSession, path).select("position", *_ordered_columns(name))

        return build

    return {f"order_{name}": ordered(name) for name in ORDERS}


# --- checks ----------------------------------------------------------------------


def _earlier(t: Tables) -> Tables:
    """The snapshot of an earlier day: fewer tickets, none of them deleted yet."""
    before = F.col("registration_date") < F.lit("1999-01-01 00:00:00").cast("timestamp_ntz")
    return t.replaced(tickets=t["tickets"].filter(before).withColumn("is_deleted", F.lit(0)))


def _check_queries() -> dict[str, Callable[[Tables], DataFrame]]:
    s = SETTINGS

    def listed(t: Tables) -> DataFrame:
        """The rows of every list; all lists are made in one pass."""
        return checks.together(lists.customer_lists(t, SPECS, s), SPECS)

    def consistency(t: Tables) -> DataFrame:
        made = lists.customer_lists(t, SPECS, s)
        rows = checks.together(made, SPECS)
        layouts = [
            check.withColumn("list", F.lit(name))
            for name, df in made.items()
            for check in (
                checks.layout_checks(df, SPECS[name]),
                checks.same_layout_check({name: df}, SPECS[name].flagship),
            )
        ]
        parts = [*layouts, checks.key_checks(rows, SPECS), checks.row_checks(rows, SPECS)]
        return reduce(DataFrame.unionByName, parts)

    def damaged(t: Tables) -> DataFrame:
        """A list with wrong counts, repeated and missing keys and other casing fails its checks."""
        alpha = staged(lists.customer_list(t, ALPHA, s))
        more = F.when(F.col("Total Tickets") >= 3, 1).otherwise(0)
        worse = alpha.withColumn("Open Tickets", F.col("Open Tickets") + more)
        worse = worse.unionByName(worse.filter(F.col("Expired Tickets") > 0)).withColumn(
            checks.CV, F.when(F.col("No Show Tickets") == 0, F.col(checks.CV))
        )
        shouted = F.when(F.col("Total Tickets") >= 2, F.upper("Contact Email"))
        other = alpha.withColumn("Contact Email", F.coalesce(shouted, "Contact Email"))
        return (
            checks.key_checks(worse)
            .unionByName(checks.row_checks(worse))
            .unionByName(checks.rerun_check(alpha, other))
        )

    def rerun(t: Tables) -> DataFrame:
        """The second run has its rows dealt otherwise, by their hash, to as many tasks as any step."""
        dealt = {n: t[n].repartition(F.xxhash64(*t[n].columns)) for n in ("tickets", "attendees")}
        again = t.replaced(**dealt)
        return checks.rerun_check(listed(t), listed(again), SPECS)

    def versions(t: Tables) -> tuple[DataFrame, DataFrame]:
        """The ids on each list, of an earlier version and of this one."""
        sides = [lists.listed_ids(tables, SPECS, s) for tables in (_earlier(t), t)]
        return tuple(ids.withColumnRenamed("cv_customer_id", checks.CV) for ids in sides)

    def change_file(t: Tables) -> DataFrame:
        """The change file of each list, read back."""
        changes = staged(checks.snapshot_diff(*versions(t)))
        spark, folder = changes.sparkSession, shared_path(changes.sparkSession)
        for name in SPECS:
            write_change_file(changes.filter(F.col("list") == name), f"{folder}/{name}")
        files = [
            spark.read.option("header", True)
            .schema("cv_customer_id string, change string")
            .csv(f"{folder}/{name}")
            .withColumn("list", F.lit(name))
            for name in SPECS
        ]
        return reduce(DataFrame.unionByName, files)

    def kept_diff(t: Tables) -> DataFrame:
        """The same from two kept versions, of which only the buckets that differ are read."""
        old, new = versions(t)
        folder = shared_path(old.sparkSession)
        kept_versions.keep(old, f"{folder}/old", buckets=16)
        kept_versions.keep(new, f"{folder}/new", buckets=16)
        return kept_versions.changes(old.sparkSession, f"{folder}/old", f"{folder}/new")

    return {
        "change_file": change_file,
        "snapshot_diff_kept": kept_diff,
        "checks_consistency": consistency,
        "checks_population": lambda t: checks.population_checks(listed(t), t, SPECS, s),
        "checks_recount": lambda t: checks.recount_checks(listed(t), t, SPECS, s),
        "checks_damaged": damaged,
        "checks_rerun": rerun,
        "checks_profile": lambda t: checks.blank_shares(listed(t)),
        "checks_profile_labels": lambda t: checks.group_histogram(listed(t)),
        "checks_profile_flagship": lambda t: checks.flagship_share(listed(t), SPECS),
        "snapshot_diff": lambda t: checks.snapshot_diff(*versions(t)),
        "snapshot_summary": lambda t: checks.snapshot_summary(*versions(t)),
        "snapshot_removals": lambda t: checks.removal_check(
            checks.snapshot_diff(*versions(t)), t, SPECS, s
        ),
    }


def queries() -> dict[str, Query]:
    """One entry per query, each taking (spark, folder of parquet files)."""
    groups = [
        _fact_queries(), _report_queries(), _list_queries(), _measure_queries(), _context_queries(),
        _check_queries(), _kept_log_queries(), _order_queries(),
    ]
    found = {name: _over(build) for group in groups for name, build in group.items()}
    if text_queries:
        found |= text_queries.queries() | {"pipeline": corpus_pipeline.run}
    return found


# --- expected results --------------------------------------------------------------

_TOUCH_COLUMNS = (
    "user_email, ticket_id, confirmation_status, action_date_az, action_ts_az, is_rep_action, "
    "confirmation_touch_source"
)


def _everything(name: str) -> str:
    return sql.query(f"SELECT * FROM {name}")


_TWICE = {
    "b_tickets": "ticket_id LIKE '%5'",
    "b_transactions": "cv_transaction_id % 6 = 1",
    "b_customers": "id % 60 = 7",
}


def _twice(*names: str) -> dict[str, str]:
    """Base tables with the rows that ``_repeated`` repeats."""
    return {
        n: f"SELECT * FROM {n}_once UNION ALL SELECT * FROM {n}_once WHERE {_TWICE[n]}" for n in names
    }


def _fact_sql() -> dict[str, str]:
    return {
        "tickets_all": _everything("d_tickets_all"),
        "ghost_dedup": _everything("d_ghosts"),
        "status_touches": _everything("d_status_touches"),
        "date_touches": _everything("d_date_touches"),
        "pre_history_touches": _everything("d_pre_history"),
        "unique_actions": sql.query(f"SELECT {_TOUCH_COLUMNS} FROM d_unique"),
        "first_travel": _everything("d_first_travel"),
        "reset_context": _everything("d_resets"),
        "week_math": _everything("d_weeks"),
        "confirmation_actions": _everything("d_actions"),
    }


def _kept_log_sql() -> dict[str, str]:
    """However the history comes in, the log is that of the whole of it."""
    facts = _fact_sql()
    return {f"{name}_kept": facts[name] for name in ("unique_actions", "confirmation_actions")}


def _order_sql() -> dict[str, str]:
    reports_sql = {**_report_sql(), **_list_sql()}
    found = {}
    for name, order in ORDERS.items():
        columns = ", ".join(f'"{c}"' for c in _ordered_columns(name))
        found[f"order_{name}"] = (
            f"SELECT row_number() OVER (ORDER BY {order}) AS position, {columns} FROM ({reports_sql[name]}) r"
        )
    return found


def _report_sql() -> dict[str, str]:
    q = sql.query
    company = "JOIN b_customers c ON c.id = t.customer_id"
    person = "JOIN b_attendees a ON a.attendee_id = t.attendee_id"
    overview = f"""
SELECT event_name, event_code, event_type, event_date, target_attendance,
       count(DISTINCT ticket_id) AS total_tickets,
       {sql.tickets_where(sql.C, "confirmed")}, {sql.tickets_where(sql.DC, "double_confirmed")},
       {sql.tickets_where(sql.ANY, "total_confirmed")},
       round(100.0 * total_confirmed / total_tickets, 1) AS pct_confirmed,
       round(100.0 * total_confirmed / nullif(target_attendance, 0), 1) AS pct_of_target
FROM d_event_tickets WHERE NOT is_reset_ghost AND lower(status) <> 'cancelled'
GROUP BY event_id, event_name, event_code, event_type, event_date, target_attendance"""
    companies = f"""
SELECT t.event_name, t.event_date, c.name AS company_name, c.vertical,
       count(DISTINCT ticket_id) AS total_tickets,
       {sql.tickets_where(sql.C, "confirmed_tickets")},
       {sql.tickets_where(sql.DC, "double_confirmed_tickets")},
       {sql.tickets_where(sql.ANY, "total_confirmed_tickets")}
FROM d_event_tickets t {company} WHERE NOT t.is_reset_ghost
GROUP BY t.event_id, t.event_name, t.event_date, c.id, c.name, c.vertical
HAVING total_confirmed_tickets > 0"""
    roster = f"""
SELECT t.event_name, t.event_date, t.event_type, t.event_city, t.venue, t.ticket_id,
       t.status AS ticket_status, t.confirmation_status, t.confirmation_method, t.ticket_type,
       t.attendance_type, t.travel_details, t.outreach_restriction, t.ticket_price, t.is_comped,
       t.is_reset_ghost, a.attendee_name, a.attendee_email, a.attendee_phone, a.first_name,
       a.last_name, a.dietary_restrictions, t.purchaser_name, t.purchaser_email,
       c.name AS company_name, c.vertical, c.SBU, c.PR, c.EliteEdge
FROM d_event_tickets t {person} {company}"""
    return {
        "event_overview": q(overview),
        "rep_performance": q(f"""
SELECT e.EmployeeName AS rep_name, e.Email AS rep_email, e.Team AS rep_team,
       a.action_date_az AS action_date, a.week_label, a.week_offset, a.event_name, a.event_type,
       a.event_date, a.confirmation_status, count(DISTINCT a.ticket_id) AS tickets_confirmed
FROM d_event_actions a JOIN b_dim_employee e ON e.Email = a.user_email
WHERE {sql.ANY} GROUP BY ALL"""),
        "daily_activity": q("""
SELECT action_date_az AS action_date, week_label, week_offset, event_name, event_type, event_date,
       confirmation_status, confirmation_touch_source,
       count(DISTINCT ticket_id) AS tickets_confirmed, count(*) AS total_actions
FROM d_event_actions GROUP BY ALL"""),
        "depth_per_ticket": q(f"""
SELECT event_name, event_date, event_type, confirmation_status,
       ticket_status_action_count AS times_confirmed_to_this_status,
       count(DISTINCT ticket_id) AS ticket_count
FROM d_event_actions WHERE is_last_confirmer = 1 AND {sql.ANY}
GROUP BY event_id, event_name, event_date, event_type, confirmation_status,
         ticket_status_action_count"""),
        "depth_per_company": q(companies),
        "attendance_outcomes": q(f"""
SELECT event_name, event_date, event_type, confirmation_status, ticket_status,
       count(DISTINCT ticket_id) AS tickets
FROM d_event_actions
WHERE is_last_confirmer = 1 AND {sql.ANY} AND ticket_event_date < {sql.TODAY}
  AND lower(ticket_status) IN ('attended', 'no show')
GROUP BY event_id, event_name, event_date, event_type, confirmation_status, ticket_status"""),
        "travel_status": q(f"""
SELECT event_name, event_date, event_type, attendance_type,
       ifnull(travel_details, 'Not Confirmed') AS travel_category, confirmation_status,
       count(DISTINCT ticket_id) AS tickets
FROM d_event_tickets
WHERE NOT is_reset_ghost AND {sql.ANY} AND ticket_event_date >= {sql.TODAY}
GROUP BY event_id, event_name, event_date, event_type, attendance_type, travel_details,
         confirmation_status"""),
        "outreach_queue": q(f"""
SELECT t.event_name, t.event_date, t.event_type, t.outreach_restriction, t.ticket_id,
       t.confirmation_status, t.status AS ticket_status, a.attendee_name, a.attendee_email,
       a.attendee_phone, t.purchaser_name, t.purchaser_email, c.name AS company_name, c.vertical
FROM d_event_tickets t {person} {company}
WHERE NOT t.is_reset_ghost AND t.ticket_event_date >= {sql.TODAY}
  AND t.outreach_restriction IN ('Do Not Blast', 'Do Not Call', 'Do Not Contact')"""),
        "roster": q(roster),
        "event_overview_undeclared": q(overview, _twice("b_tickets")),
        "depth_per_company_repeated": q(companies, _twice("b_customers")),
        "roster_of_event": q(f"{roster} WHERE t.event_id = 'EV-7'"),
    }


def _list_sql() -> dict[str, str]:
    return {
        "list_scope": sql.query("""
SELECT customer_id, ticket_id, transaction_id, product_name, ticket_type, st AS status, event_date,
       undecided_timestamp, registration_date, outreach_restriction, purchaser_name,
       purchaser_email, purchaser_phone, sales_order_id, transaction_date
FROM d_alpha_scope"""),
        "list_ticket_summary": _everything("d_alpha_rollup"),
        "list_status_counts": _everything("d_alpha_counts"),
        "list_types_counted": _everything("d_alpha_types"),
        "list_types_distinct": _everything("d_gamma_types"),
        "list_ticket_ids": _everything("d_alpha_ids"),
        "list_sales_orders": _everything("d_alpha_orders"),
        "list_last_activity": _everything("d_alpha_activity"),
        "list_first_purchase": _everything("d_first_purchase"),
        "list_profile": _everything("d_profile"),
        "list_contact_candidates": sql.query("""
SELECT * FROM d_alpha_candidates QUALIFY row_number() OVER (
  PARTITION BY customer_id, contact_source, lower(contact_email), lower(contact_name),
               lower(contact_phone)
  ORDER BY contact_email NULLS FIRST, contact_name NULLS FIRST, contact_phone NULLS FIRST) = 1"""),
        "list_contacts": _everything("d_alpha_contacts"),
        "list_summary_product": _everything("d_alpha_summary_product"),
        "list_summary_all": _everything("d_alpha_summary_all"),
        "list_alpha": _everything("d_alpha_list"),
        "list_beta": _everything("d_beta_list"),
        "list_gamma": _everything("d_gamma_list"),
        "list_alpha_undeclared": sql.query(
            "SELECT * FROM d_alpha_list", _twice("b_tickets", "b_transactions")
        ),
    }


def _measure_sql() -> dict[str, str]:
    q, facts = sql.query, "d_actions"
    groups = f"(SELECT DISTINCT week_label, confirmation_status FROM {facts}) g"
    depth_groups = f"(SELECT DISTINCT week_start_date, confirmation_status FROM {facts}) g"
    days = """
(SELECT {keys} ticket_id,
        date_diff('day', min(action_date_az) FILTER (confirmation_status = 'Confirmed'),
                  min(action_date_az) FILTER (confirmation_status = 'Double Confirmed')) AS days
 FROM d_actions WHERE is_rep_action = 1 GROUP BY ALL) d"""
    return {
        "measures_confirmations": q(f"SELECT {sql.CONFIRMATIONS} FROM {facts}"),
        "measures_confirmations_by_rep": sql.by("user_email", sql.CONFIRMATIONS, facts),
        "measures_confirmations_by_week_and_status": q(f"""
SELECT g.*, v.* EXCLUDE (week_label) FROM {groups}
JOIN (SELECT week_label, {sql.CONFIRMATIONS} FROM {facts} GROUP BY ALL) v
  ON v.week_label = g.week_label"""),
        "measures_businesses": q("""
SELECT count(DISTINCT ifnull('=' || lower(name), 'none')) AS total_businesses
FROM b_customers"""),
        "measures_week_over_week": q(f"SELECT {sql.WEEKS}, {sql.WOW} FROM {facts}"),
        "measures_week_over_week_by_rep_and_week": q(f"""
SELECT g.*, v.* EXCLUDE (user_email), {sql.WOW}
FROM (SELECT DISTINCT user_email, week_label FROM {facts}) g
JOIN (SELECT user_email, {sql.WEEKS} FROM {facts} GROUP BY ALL) v
  ON v.user_email IS NOT DISTINCT FROM g.user_email"""),
        "measure_data_status": q(f"""
SELECT 'Data through ' || strftime(max(action_time_az), '%b %-d at %-I:%M %p')
       || ' AZ  •  Viewed ' || strftime({sql.AS_OF} - INTERVAL 7 HOUR, '%b %-d at %-I:%M %p')
       AS data_status
FROM {facts}"""),
        "measures_depth": q(f"SELECT {sql.DEPTH} FROM {facts}"),
        "measures_depth_by_week_and_status": q(f"""
SELECT g.*, v.* EXCLUDE (week_start_date) FROM {depth_groups}
JOIN (SELECT week_start_date, {sql.DEPTH} FROM {facts} GROUP BY ALL) v
  ON v.week_start_date IS NOT DISTINCT FROM g.week_start_date"""),
        "measures_travel": q(f"SELECT {sql.TRAVEL} FROM {facts}"),
        "measures_travel_by_week": sql.by("week_start_date", sql.TRAVEL, facts),
        "measures_event_health": q(f"SELECT {sql.HEALTH} FROM d_tickets_all"),
        "measures_event_health_by_event": sql.by("event_id", sql.HEALTH, "d_tickets_all"),
        "measures_event_health_by_status": q(f"""
SELECT t.confirmation_status, t.total_tickets, a.confirmed_tickets,
       nullif(a.confirmed_tickets, 0)::DOUBLE / nullif(t.total_tickets, 0) AS pct_confirmed
FROM (SELECT confirmation_status,
             {sql.tickets_where("NOT is_reset_ghost", "total_tickets")}
      FROM d_tickets_all GROUP BY ALL) t,
     (SELECT {sql.tickets_where(f"NOT is_reset_ghost AND {sql.ANY}", "confirmed_tickets")}
      FROM d_tickets_all) a"""),
        "measures_confirmations_by_event": sql.by(
            "event_id", sql.CONFIRMATIONS, "(SELECT * FROM d_actions JOIN (SELECT ticket_id, "
            "event_id FROM b_tickets) t USING (ticket_id)) x"
        ),
        "measures_depth_by_rep": sql.by("user_email", sql.DEPTH, facts),
        "measures_travel_by_rep": sql.by("user_email", sql.TRAVEL, facts),
        "measures_event_health_undeclared": q(
            f"SELECT {sql.HEALTH} FROM d_tickets_all", _twice("b_tickets")
        ),
        "measures_outcomes": q(f"SELECT {sql.OUTCOMES} FROM {facts}"),
        "measures_outcomes_by_event": sql.by(
            "event_id", sql.OUTCOMES, "(SELECT * FROM d_actions JOIN (SELECT ticket_id, event_id "
            "FROM b_tickets) t USING (ticket_id)) x"
        ),
        "measure_days_to_dc": q(f"SELECT avg(days) AS avg_days_to_dc FROM {days.format(keys='')}"),
        "measure_days_to_dc_by_rep": q(f"""
SELECT g.user_email, avg(d.days) AS avg_days_to_dc
FROM (SELECT DISTINCT user_email FROM d_actions) g
LEFT JOIN {days.format(keys='user_email,')} ON d.user_email IS NOT DISTINCT FROM g.user_email
GROUP BY g.user_email"""),
        "measures_titled": q(f"""
SELECT week_label, {sql.tickets_where(f"{sql.REP} AND {sql.ANY}", '"Confirmations"')},
       {sql.tickets_where(f"{sql.REP} AND {sql.C}", '"Confirmed"')},
       {sql.tickets_where(f"{sql.REP} AND {sql.DC}", '"Double Confirmed"')},
       {sql.tickets_where(f"{sql.REP} AND {sql.DC}", '"Double Confirmations"')}
FROM {facts} GROUP BY week_label"""),
    }


def _context_sql() -> dict[str, str]:
    q = sql.query
    vip = "contains(product_name, 'VIP')"
    standard = "event_id IN (SELECT CVEventID FROM b_dim_event WHERE starts_with(EventType, 'STANDARD'))"
    pr = "customer_id IN (SELECT id FROM b_customers WHERE PR = 'No')"
    team = "user_email IN (SELECT Email FROM b_dim_employee WHERE Team < 'NATION_15')"

    def on(*tests: str) -> str:
        return f"ticket_id IN (SELECT ticket_id FROM d_tickets_all WHERE {' AND '.join(tests)})"

    def facts(*tests: str, source: str = "d_actions") -> str:
        return f"(SELECT * FROM {source} WHERE {' AND '.join(tests)}) f"

    def spread(keys: str, groups: str, values: str, source: str, more: str = "") -> str:
        """The groups of some facts with values of others."""
        same = " AND ".join(f"v.{k} IS NOT DISTINCT FROM g.{k}" for k in keys.split(", "))
        return f"""
SELECT g.*, v.* EXCLUDE ({keys}){more} FROM (SELECT DISTINCT {keys} FROM {groups}) g
LEFT JOIN (SELECT {keys}, {values} FROM {source} GROUP BY {keys}) v ON {same}"""

    attended = facts(team, "ticket_outcome = 'Attended'")
    vip_actions = facts(on(vip))
    both, first = on(standard, "travel_type = 'Both'"), "is_first_travel_action = 1"
    health_tickets = facts(standard, pr, source="d_tickets_all")
    days_facts = facts(on(pr), "confirmation_touch_source <> 'Date Update'")
    return {
        "measures_confirmations_of_product_by_rep": sql.by("user_email", sql.CONFIRMATIONS, vip_actions),
        "measures_confirmations_of_all": q(
            f"SELECT {sql.CONFIRMATIONS} FROM {facts(on(vip, standard, pr), team)}"
        ),
        "measures_depth_of_event_type": q(f"""
SELECT g.*, v.* EXCLUDE (week_start_date)
FROM (SELECT DISTINCT week_start_date, confirmation_status FROM {facts(on(standard))}) g
JOIN (SELECT week_start_date, {sql.DEPTH} FROM {facts(on(standard))} GROUP BY ALL) v
  ON v.week_start_date IS NOT DISTINCT FROM g.week_start_date"""),
        "measures_depth_of_status_by_rep": q(
            spread("user_email", f"(SELECT * FROM {attended} WHERE {sql.C})", sql.DEPTH, attended)
        ),
        "measures_outcomes_of_team": q(f"SELECT {sql.OUTCOMES} FROM {facts(team)}"),
        "measures_outcomes_of_customers_by_rep": sql.by("user_email", sql.OUTCOMES, facts(on(pr))),
        "measures_week_over_week_of_week": q(
            spread(
                "user_email", f"(SELECT * FROM {vip_actions} WHERE week_label = 'Last Week')", sql.WEEKS,
                vip_actions, f", {sql.WOW}",
            )
        ),
        "measures_travel_of_type": q(
            spread(
                "week_start_date", facts(both),
                sql.tickets_where(f"{first} AND {both}", "rt_travel_confirmed")
                + sql.TRAVEL[sql.TRAVEL.index(", ") :],
                facts(on(standard)),
            )
        ),
        "measures_travel_of_team": q(f"SELECT {sql.TRAVEL} FROM {facts(team)}"),
        "measures_event_health_of_event_type": q(f"""
SELECT {sql.tickets_where(f"NOT is_reset_ghost AND {sql.C}", "total_tickets")},
       {sql.tickets_where(f"NOT is_reset_ghost AND {sql.ANY}", "confirmed_tickets")},
       nullif(confirmed_tickets, 0)::DOUBLE / nullif(total_tickets, 0) AS pct_confirmed
FROM {health_tickets}"""),
        "measures_event_health_of_product_by_event": sql.by(
            "event_id", sql.HEALTH, facts(vip, source="d_tickets_all")
        ),
        "measure_days_to_dc_of_customers_by_rep": q(f"""
SELECT g.user_email, avg(d.days) AS avg_days_to_dc
FROM (SELECT DISTINCT user_email FROM {days_facts} WHERE {sql.DC}) g
LEFT JOIN (SELECT user_email, ticket_id,
                  date_diff('day', min(action_date_az) FILTER (confirmation_status = 'Confirmed'),
                            min(action_date_az) FILTER (confirmation_status = 'Double Confirmed')) AS days
           FROM {days_facts} WHERE is_rep_action = 1 GROUP BY ALL) d
  ON d.user_email IS NOT DISTINCT FROM g.user_email
GROUP BY g.user_email"""),
        "measure_data_status_of_team": q(f"""
SELECT 'Data through ' || strftime(max(action_time_az), '%b %-d at %-I:%M %p')
       || ' AZ  •  Viewed ' || strftime({sql.AS_OF} - INTERVAL 7 HOUR, '%b %-d at %-I:%M %p')
       AS data_status
FROM {facts(team)}"""),
        "measures_businesses_of_customers": q("""
SELECT vertical, count(DISTINCT ifnull('=' || lower(name), 'none')) AS total_businesses
FROM b_customers WHERE PR = 'No' GROUP BY vertical"""),
    }


def _check_sql() -> dict[str, str]:
    q = sql.query
    listed, cv = "d_alpha_list", '"CV Customer ID"'
    worse = f"""(WITH worse AS (SELECT * REPLACE ("Open Tickets" + ("Total Tickets" >= 3)::INT
                                             AS "Open Tickets") FROM {listed})
 SELECT * REPLACE (if("No Show Tickets" = 0, {cv}, NULL) AS {cv})
 FROM (FROM worse UNION ALL FROM worse WHERE "Expired Tickets" > 0) w) w"""

    def of_every_list(verdicts: Callable[[str, str], str]) -> str:
        """The verdicts on each list, from the statement for a name and a product."""
        parts = [f"SELECT *, '{n}' AS list FROM ({verdicts(n, p)}) v" for n, p in PATTERNS.items()]
        return q("\nUNION ALL BY NAME\n".join(parts))

    counts = [f'"{label} Tickets"' for label in sql.STATUSES.values()]
    open_sum, expired = " + ".join(counts[:3]), counts[3]
    row_tests = {
        "status_counts_sum_to_total": f'"Total Tickets" <> {" + ".join(counts)}',
        "unscheduled_is_sum": f'"Unscheduled Tickets" <> {open_sum} + {expired}',
        "group_label_matches": (
            '"Unscheduled Ticket Group" <> CASE '
            f"WHEN {open_sum} > 0 AND {expired} > 0 THEN 'Open/Undecided + Expired' "
            f"WHEN {open_sum} > 0 THEN 'Open/Undecided Only' "
            f"WHEN {expired} > 0 THEN 'Expired Only' ELSE 'Nothing to Schedule' END"
        ),
        "summary_adds_up": (
            "list_sum(list_transform(regexp_extract_all(\"Ticket Summary (This Product)\", "
            "' x(\\d+)', 1), lambda n: n::INT)) <> \"Total Tickets\""
        ),
    }

    def rows(source: str) -> str:
        keys = sql.verdict_union(
            f"(SELECT {cv}, count(*) AS n FROM {source} GROUP BY ALL) k",
            cv,
            {"key_is_present": f"{cv} IS NULL", "one_row_per_business": "n > 1"},
        )
        return f"{keys}\nUNION ALL BY NAME\n{sql.verdict_union(source, cv, row_tests)}"

    def consistency(name: str, product: str) -> str:
        # The agreed layout has 47 columns; the lists are made with these.
        names = len(checks.agreed_layout(FLAGSHIP))
        return f"""
SELECT 'columns_match_layout' AS "check", {names} = 47 AS passed, abs(47 - {names})::BIGINT AS failing_count,
       NULL::VARCHAR AS sample
UNION ALL BY NAME
SELECT 'lists_share_layout' AS "check", {names} = 47 AS passed, abs(47 - {names})::BIGINT AS failing_count,
       NULL::VARCHAR AS sample
UNION ALL BY NAME
SELECT 'returns_rows' AS "check", count(*) > 0 AS passed, (count(*) = 0)::BIGINT AS failing_count,
       NULL::VARCHAR AS sample FROM d_{name}_list
UNION ALL BY NAME
{rows(f"d_{name}_list")}"""

    def holders(name: str) -> str:
        return f"""(SELECT DISTINCT c.cv_customer_id AS cv, c.id IN (SELECT customer_id
  FROM d_{name}_candidates) AS has_contact FROM b_customers c JOIN d_{name}_scope s
  ON s.customer_id = c.id) e"""

    def population(name: str, product: str) -> str:
        return sql.verdict_union(
            f"(SELECT coalesce(e.cv, l.{cv}) AS cv, coalesce(e.has_contact, false) AS expected, "
            f"l.{cv} IS NOT NULL AS listed FROM {holders(name)} "
            f"FULL JOIN d_{name}_list l ON l.{cv} = e.cv) p",
            "cv",
            {
                "every_expected_is_listed": "expected AND NOT listed",
                "every_listed_is_expected": "listed AND NOT expected",
            },
        )

    def recount(name: str, product: str) -> str:
        tests = {check: f"bad_{check}" for check in sql._RECOUNT_CHECKS}
        return sql.verdict_union(f"d_{name}_recounted", cv, tests)

    def of_each(statement: Callable[[str], str]) -> str:
        """A statement over each list, for its name."""
        parts = [f"SELECT *, '{n}' AS list FROM ({statement(n)}) v" for n in PATTERNS]
        return q("\nUNION ALL BY NAME\n".join(parts))

    shouted = sql.verdict_union(
        listed,
        cv,
        {
            "same_contacts_on_rerun": '"Total Tickets" >= 2 '
            'AND upper("Contact Email") <> "Contact Email"'
        },
    )
    # The rerun and removal checks restate what must hold: no difference.
    nothing_wrong = (
        "SELECT '{check}' AS \"check\", count(*) = 0 AS passed, count(*) AS failing_count, "
        "NULL::VARCHAR AS sample FROM {failing}"
    )
    def blank(list_name: str) -> str:
        return "UNION ALL BY NAME".join(
            f"""
SELECT '{name}' AS "column", count(*) FILTER ("{name}" IS NULL OR "{name}"::VARCHAR IN ('', '0')) AS blank,
       count(*) AS rows, blank::DOUBLE / nullif(rows, 0) AS blank_share FROM d_{list_name}_list
"""
            for name in checks.PROFILED_COLUMNS
        )

    def diff(name: str) -> str:
        old, new = f"d_{name}_old_ids", f"(SELECT {cv} AS cv_customer_id FROM d_{name}_list)"
        return f"""
(SELECT cv_customer_id, 'removed' AS change FROM (FROM {old} EXCEPT FROM {new}) x
 UNION ALL
 SELECT cv_customer_id, 'added' FROM (FROM {new} EXCEPT FROM {old}) y)"""

    return {
        "checks_consistency": of_every_list(consistency),
        "checks_population": of_every_list(population),
        "checks_recount": of_every_list(recount),
        "checks_damaged": q(f"{rows(worse)}\nUNION ALL BY NAME\n{shouted}"),
        "checks_rerun": of_each(
            lambda n: nothing_wrong.format(
                check="same_contacts_on_rerun",
                failing=f"(SELECT {cv} FROM d_{n}_list GROUP BY ALL HAVING count(*) > 1) x",
            )
        ),
        "checks_profile": of_each(blank),
        "checks_profile_labels": of_each(
            lambda n: 'SELECT "Unscheduled Ticket Group" AS label, count(*) AS businesses '
            f"FROM d_{n}_list GROUP BY ALL"
        ),
        "checks_profile_flagship": of_each(
            lambda n: f"SELECT count(*) FILTER (\"{FLAGSHIP} Customer\" = 'Yes') AS flagship_customers, "
            f"count(*) AS businesses FROM d_{n}_list"
        ),
        "change_file": of_each(lambda n: f"SELECT * FROM {diff(n)} d"),
        "snapshot_diff": of_each(lambda n: f"SELECT * FROM {diff(n)} d"),
        "snapshot_diff_kept": of_each(lambda n: f"SELECT * FROM {diff(n)} d"),
        "snapshot_summary": of_each(
            lambda n: f"""
SELECT (SELECT count(*) FROM d_{n}_old_ids) AS old_businesses,
       (SELECT count(*) FROM d_{n}_list) AS new_businesses,
       count(*) FILTER (change = 'added') AS added,
       count(*) FILTER (change = 'removed') AS removed FROM {diff(n)} d"""
        ),
        "snapshot_removals": of_each(
            lambda n: nothing_wrong.format(
                check="every_removal_is_explained",
                failing=f"(SELECT * FROM {diff(n)} d WHERE change = 'removed' AND cv_customer_id IN "
                f"(SELECT cv FROM {holders(n)} WHERE has_contact)) x",
            )
        ),
    }


def oracle_sql() -> dict[str, str]:
    """The expected result of each query as DuckDB SQL over the same files."""
    groups = [
        _fact_sql(), _report_sql(), _list_sql(), _measure_sql(), _context_sql(), _check_sql(),
        _kept_log_sql(), _order_sql(),
    ]
    found = {name: text for group in groups for name, text in group.items()}
    if text_queries:
        found |= text_queries.oracle_sql()
        if corpus_pipeline.ORACLE_SQL:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
