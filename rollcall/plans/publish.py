"""The whole job: derived tables first, then everything that reads them.

The two facts feed every report and measure. They are written once, to the
shared folder, and read back, so that the history is cleaned once per run and a
lost executor costs no more than the stage it was in.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.plans import actions, checks, lists, measures, reports
from rollcall.plans.tickets import tickets_all
from rollcall.settings import Settings
from rollcall.sinks import run_folder, staged, write_bucketed, write_change_file, write_report
from rollcall.sources.schemas import CONFIRMATION_ACTIONS
from rollcall.sources.tables import Tables


def publish(
    tables: Tables,
    specs: Mapping[str, lists.ListSpec],
    settings: Settings,
    root: str,
    earlier: Mapping[str, DataFrame] | None = None,
    buckets: int = 0,
    recorded: DataFrame | None = None,
) -> dict[str, str]:
    """Writes facts, reports, lists with their checks, and measure totals under ``root``.

    ``earlier`` holds lists of an earlier version; their changes are written
    too. With ``buckets``, both facts are tables of the catalog (``rollcall_`` and
    their name) in so many buckets of the ticket id, and what selects or counts
    tickets does not shuffle them. ``recorded`` has the touches kept between runs
    (``increments.py``). Returns the folder of each output. What is kept between
    steps is gone in the end.
    """
    with run_folder(tables["tickets"].sparkSession):
        return _published(tables, specs, settings, root, earlier or {}, buckets, recorded)


def _published(
    tables: Tables,
    specs: Mapping[str, lists.ListSpec],
    settings: Settings,
    root: str,
    earlier: Mapping[str, DataFrame],
    buckets: int,
    recorded: DataFrame | None,
) -> dict[str, str]:
    written: dict[str, str] = {}

    def write(name: str, df: DataFrame) -> DataFrame:
        written[name] = f"{root.rstrip('/')}/{name}"
        write_report(df, written[name])
        return df.sparkSession.read.parquet(written[name])

    def write_fact(name: str, df: DataFrame) -> DataFrame:
        if not buckets:
            return write(name, df)
        written[name] = f"{root.rstrip('/')}/{name}"
        return write_bucketed(df, f"rollcall_{name}", written[name], "ticket_id", buckets)

    all_tickets = write_fact("tickets_all", tickets_all(tables))
    # The log with what reports take from its ticket, clustered by ticket: no report joins
    # the two facts again. Touches of one ticket may lie in several files.
    detail = actions.action_detail(tables, settings, recorded)
    detail = detail.repartitionByRange("ticket_id", "action_time_az")
    detail = write("action_detail", detail.sortWithinPartitions("ticket_id"))
    log = write_fact("confirmation_actions", detail.select(*CONFIRMATION_ACTIONS))
    done = actions.of_live_tickets(detail)
    events, attendees, customers = (
        tables[name] for name in ("dim_event", "attendees", "customers")
    )
    outputs = {
        "event_overview": reports.event_overview(all_tickets, events, settings),
        "rep_performance": reports.rep_performance(done, tables["dim_employee"], events),
        "daily_activity": reports.daily_activity(done, events),
        "depth_per_ticket": reports.depth_per_ticket(done, events),
        "depth_per_company": reports.depth_per_company(all_tickets, events, customers, settings),
        "attendance_outcomes": reports.attendance_outcomes(done, events, settings),
        "travel_status": reports.travel_status(all_tickets, events, settings),
        "outreach_queue": reports.outreach_queue(
            all_tickets, events, attendees, customers, settings
        ),
        "roster": reports.roster(all_tickets, events, attendees, customers),
    }
    totals = {
        "confirmations": measures.confirmations(log, [], settings),
        "businesses": measures.businesses(customers, [], settings),
        "week_over_week": measures.week_over_week(log, [], settings),
        "data_status": measures.data_status(log, [], settings),
        "depth": measures.depth(log, [], settings),
        "travel": measures.travel(log, all_tickets, [], settings),
        "event_health": measures.event_health(all_tickets, [], settings),
        "outcomes": measures.outcomes(log, [], settings),
        "days_to_double": measures.days_to_double(log, [], settings),
    }
    for name, df in outputs.items():
        write(name, df)
    made = lists.customer_lists(tables, specs, settings) if specs else {}
    listed = {name: write(f"list_{name}", df) for name, df in made.items()}
    if listed:
        verdicts = staged(checks.checks_of_lists(listed, tables, specs, settings))
    for name, df in listed.items():
        write(f"checks_{name}", verdicts.filter(F.col("list") == name).drop("list"))
        if name in earlier:
            write(f"summary_{name}", checks.snapshot_summary(earlier[name], df))
            written[f"changes_{name}"] = f"{root.rstrip('/')}/changes_{name}"
            write_change_file(checks.snapshot_diff(earlier[name], df), written[f"changes_{name}"])
    for name, df in totals.items():
        write(f"measures_{name}", measures.with_titles(df))
    return written
