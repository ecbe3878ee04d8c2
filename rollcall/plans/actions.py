"""The cleaned log of confirmation actions.

Grain: actor x ticket x status x local day. Every stage is a function of
DataFrames, so that it can be queried and checked by itself.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.functions.dates import to_local, week_columns, week_label
from rollcall.functions.predicates import (
    CONFIRMED,
    DOUBLE_CONFIRMED,
    any_case_in,
    flag,
    is_any_confirmed,
    none_of,
)
from rollcall.settings import Settings
from rollcall.sinks import staged
from rollcall.sources.schemas import CONFIRMATION_ACTIONS, TOUCHES
from rollcall.sources.tables import Tables, conform

# History actions and the touch sources they stand for.
STATUS_ACTION = "Confirmation status updated"
DATE_ACTION = "Confirmation date updated"
STATUS_SOURCE = "Status Update"
DATE_SOURCE = "Date Update"
PRE_HISTORY_SOURCE = "Pre-History Direct"

# The hour slice of touches without a time, which rank before all others.
NO_TIME_SLICE = -1_000_000_000


def _is_status_change() -> Column:
    return (F.col("action") == STATUS_ACTION) & is_any_confirmed(F.col("new_value"))


def _is_date_change() -> Column:
    return F.col("action") == DATE_ACTION


def _touches(changes: DataFrame, settings: Settings) -> DataFrame:
    """History rows of the two confirming actions as touches.

    A date change re-confirms; it counts as Confirmed whatever its value.
    """
    by_date = _is_date_change()
    doubled = any_case_in(F.col("new_value"), [DOUBLE_CONFIRMED]) & ~by_date
    local = to_local(F.col("changed_at"), settings.local_zone)
    by_machine = F.col("changed_by").isin(list(settings.machine_actors))
    return conform(
        changes.select(
            F.col("changed_by").alias("user_email"),
            "ticket_id",
            F.when(doubled, DOUBLE_CONFIRMED).otherwise(CONFIRMED).alias("confirmation_status"),
            F.to_date(local).alias("action_date_az"),
            local.alias("action_ts_az"),
            # An unknown actor (NULL) counts as a person.
            F.when(by_machine, 0).otherwise(1).alias("is_rep_action"),
            F.when(by_date, DATE_SOURCE)
            .otherwise(STATUS_SOURCE)
            .alias("confirmation_touch_source"),
        ),
        TOUCHES,
    )


def status_touches(history: DataFrame, settings: Settings) -> DataFrame:
    return _touches(history.filter(_is_status_change()), settings)


def date_touches(history: DataFrame, settings: Settings) -> DataFrame:
    return _touches(history.filter(_is_date_change()), settings)


def history_touches(history: DataFrame, settings: Settings) -> DataFrame:
    """Status and date touches from one scan of the history."""
    return _touches(history.filter(_is_status_change() | _is_date_change()), settings)


def pre_history_touches(tickets: DataFrame, history: DataFrame, settings: Settings) -> DataFrame:
    """Confirmations recorded on the ticket only, before the history was kept.

    One anti join serves both levels. The dates are taken as they are, not
    shifted to local time.
    """
    in_history = history.filter(_is_status_change()).select("ticket_id").distinct()
    return _unrecorded_touches(tickets, in_history, settings)


def _unrecorded_touches(tickets: DataFrame, in_history: DataFrame, settings: Settings) -> DataFrame:
    def touch(status: str, actor: str, day: str) -> Column:
        return F.struct(
            F.col(actor).alias("user_email"),
            F.lit(status).alias("confirmation_status"),
            F.col(day).alias("action_date_az"),
        )

    def by_person(actor: str) -> Column:
        return none_of(F.col(actor), settings.machine_actors)

    unrecorded = tickets.filter(by_person("confirmed_by") | by_person("double_confirmed_by")).join(
        in_history, "ticket_id", "left_anti"
    )
    both = F.array(
        touch(CONFIRMED, "confirmed_by", "confirmed_date"),
        touch(DOUBLE_CONFIRMED, "double_confirmed_by", "double_confirmed_date"),
    )
    levels = unrecorded.select("ticket_id", F.inline(both)).filter(by_person("user_email"))
    return conform(
        levels.withColumns(
            {
                "action_ts_az": F.col("action_date_az").cast("timestamp_ntz"),
                "is_rep_action": F.lit(1),
                "confirmation_touch_source": F.lit(PRE_HISTORY_SOURCE),
            }
        ),
        TOUCHES,
    )


_ACTION = ["user_email", "ticket_id", "confirmation_status", "action_date_az"]
# Touches at one time count as the first source by name.
_SOURCES = sorted([DATE_SOURCE, PRE_HISTORY_SOURCE, STATUS_SOURCE])
_STATUS = _SOURCES.index(STATUS_SOURCE)


def _by_source(touches: DataFrame) -> DataFrame:
    """Touches with a time and a flag for each source."""
    of_source = [F.col("confirmation_touch_source") == s for s in _SOURCES]
    return touches.select(
        *_ACTION,
        "is_rep_action",
        *[F.when(test, F.col("action_ts_az")).alias(f"_ts{n}") for n, test in enumerate(of_source)],
        *[flag(test).alias(f"_has{n}") for n, test in enumerate(of_source)],
    )


def _reduced(touches: DataFrame) -> DataFrame:
    """One row per actor, ticket, status and day, with the earliest time of each source.

    These are plain minima, so touches are hashed and combined on the map side
    and never sorted. Whether the actor is a person depends on the key alone.
    """
    return touches.groupBy(*_ACTION).agg(
        F.max("is_rep_action").alias("is_rep_action"),
        *[F.min(f"_ts{n}").alias(f"_ts{n}") for n in range(len(_SOURCES))],
        *[F.max(f"_has{n}").alias(f"_has{n}") for n in range(len(_SOURCES))],
    )


def reduced_touches(history: DataFrame, settings: Settings) -> DataFrame:
    """The history's touches reduced to actions; so are several such tables together by ``merged``."""
    return _reduced(_by_source(history_touches(history, settings)))


def merged(*reduced: DataFrame) -> DataFrame:
    """Several tables of reduced touches as one: minima of minima, flags of flags."""
    return _reduced(reduce(DataFrame.unionByName, reduced))


def recorded_actions(tables: Tables, settings: Settings) -> DataFrame:
    """The history's touches reduced to actions, in the shared folder.

    Everything that the action log takes from the history comes from this
    table, so the history itself is read once.
    """
    return staged(reduced_touches(tables["history"], settings))


def all_actions(recorded: DataFrame, tables: Tables, settings: Settings) -> DataFrame:
    """All touches, the earliest per actor, ticket, status and day, from the reduced touches of the
    history and the tickets."""
    in_history = recorded.filter(F.col(f"_has{_STATUS}") == 1).select("ticket_id").distinct()
    earlier = _unrecorded_touches(tables["tickets"], in_history, settings)
    together = merged(recorded, _by_source(earlier))
    earliest = F.least(*[F.col(f"_ts{n}") for n in range(len(_SOURCES))])
    # Touches without a time have no day either, so they form groups of their own.
    first_source = F.coalesce(
        *[
            F.when((F.col(f"_has{n}") == 1) & F.col(f"_ts{n}").eqNullSafe(earliest), s)
            for n, s in enumerate(_SOURCES)
        ]
    )
    return conform(
        together.withColumns({"action_ts_az": earliest, "confirmation_touch_source": first_source}),
        TOUCHES,
    )


def unique_actions(tables: Tables, settings: Settings) -> DataFrame:
    """All touches, the earliest per actor, ticket, status and day."""
    return all_actions(recorded_actions(tables, settings), tables, settings)


def _first_rep_status_date(history: DataFrame, settings: Settings) -> DataFrame:
    by_person = none_of(F.col("changed_by"), settings.machine_actors)
    return (
        status_touches(history.filter(by_person), settings)
        .groupBy("ticket_id")
        .agg(F.min("action_date_az").alias("first_travel_date"))
    )


def _first_recorded_date(recorded: DataFrame, settings: Settings) -> DataFrame:
    by_person = none_of(F.col("user_email"), settings.machine_actors)
    return (
        recorded.filter(by_person & (F.col(f"_has{_STATUS}") == 1))
        .groupBy("ticket_id")
        .agg(F.min("action_date_az").alias("first_travel_date"))
    )


def first_travel(tables: Tables, settings: Settings) -> DataFrame:
    """First day a known person confirmed a ticket that has a travel type."""
    travelling = tables["tickets"].filter(F.col("double_confirm_type").isNotNull())
    return _first_rep_status_date(tables["history"], settings).join(
        travelling.select("ticket_id"), "ticket_id", "left_semi"
    )


def reset_context(resets: DataFrame) -> DataFrame:
    """Earliest event date and, separately, smallest event name per reset ticket."""
    return (
        resets.filter(F.col("root_ticket_id").isNotNull())
        .groupBy("root_ticket_id")
        .agg(
            F.min("event_date").alias("original_event_date"),
            F.min("scheduled_event_name").alias("original_event_name"),
        )
    )


def with_weeks(actions: DataFrame, settings: Settings) -> DataFrame:
    weeks = week_columns(F.col("action_date_az"), settings)
    return actions.withColumns(weeks).withColumn("week_label", week_label(F.col("week_offset")))


def _ticket_facts(recorded: DataFrame, tables: Tables, settings: Settings) -> list[DataFrame]:
    """What the actions look up by ticket: its current state, its first travel
    confirmation, its resets. Each has one row per ticket."""
    state = tables["tickets"].select(
        "ticket_id",
        F.lit(True).alias("ticket_found"),
        "event_id",
        "double_confirm_type",
        F.col("status").alias("ticket_status"),
        F.col("event_date").alias("ticket_event_date"),
        F.col("scheduled_event_name").alias("ticket_event_name"),
    )
    resets = reset_context(tables["ticket_no_show_resets"]).select(
        F.col("root_ticket_id").alias("ticket_id"),
        F.lit(True).alias("was_reset"),
        "original_event_date",
        "original_event_name",
    )
    return [state, _first_recorded_date(recorded, settings), resets]


def _enriched(actions: DataFrame, facts: list[DataFrame]) -> DataFrame:
    """Actions on no ticket match nothing, so they are kept out of the look-ups."""
    found = actions.filter(F.col("ticket_id").isNotNull())
    loose = actions.filter(F.col("ticket_id").isNull())
    for fact in facts:
        found = found.join(fact, "ticket_id", "left")
    found = found.unionByName(loose, allowMissingColumns=True)
    status = F.lower("ticket_status")
    outcome = (
        F.when(status == "attended", "Attended")
        .when(F.col("was_reset"), "No Show (Reset)")
        .when(status == "no show", "No Show")
        .when(status == "cancelled", "Cancelled")
        .otherwise("Upcoming")
    )
    on_first_travel_day = F.col("double_confirm_type").isNotNull() & (
        F.col("action_date_az") == F.col("first_travel_date")
    )
    return found.withColumns(
        {
            "is_first_travel_action": flag(on_first_travel_day),
            "ticket_outcome": outcome,
            "is_no_show_reset": flag(F.col("was_reset")),
            "original_event_date": F.coalesce("original_event_date", "ticket_event_date"),
            "original_event_name": F.coalesce("original_event_name", "ticket_event_name"),
        }
    )


def _touch_order() -> list[Column]:
    """A total order of the touches of one ticket and status."""
    return [
        F.asc_nulls_first("action_ts_az"),
        F.asc("confirmation_touch_source"),
        F.asc_nulls_first("user_email"),
    ]


def _ranked(actions: DataFrame) -> DataFrame:
    """Touch rank and counts by ticket and status, and the counts by ticket.

    The touches of a ticket and status are cut into hours; a touch ranks after
    all touches of earlier hours, so only the touches of one hour (at most one
    per actor) meet in a task, however many a ticket has. The hourly counts are
    combined on the map side.
    """
    hours = F.unix_date("action_date_az") * 24 + F.hour("action_ts_az")
    keys = ["ticket_id", "confirmation_status", "_slice"]
    sliced = actions.withColumn("_slice", F.coalesce(hours, F.lit(NO_TIME_SLICE)))

    by_status = Window.partitionBy("ticket_id", "confirmation_status")
    earlier = by_status.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    counts = (
        sliced.groupBy(*keys)
        .agg(F.count("*").alias("_rows"))
        .withColumns(
            {
                "_before": F.coalesce(F.sum("_rows").over(earlier), F.lit(0)),
                "ticket_status_action_count": F.sum("_rows").over(by_status),
                "ticket_total_action_count": F.sum("_rows").over(Window.partitionBy("ticket_id")),
            }
        )
        .drop("_rows")
        .withColumnsRenamed({key: f"_c_{key}" for key in keys})
    )
    same_slice = reduce(
        lambda a, b: a & b, [F.col(key).eqNullSafe(F.col(f"_c_{key}")) for key in keys]
    )
    in_slice = F.row_number().over(Window.partitionBy(*keys).orderBy(*_touch_order()))
    return (
        sliced.withColumn("_in_slice", in_slice)
        .join(counts, same_slice)
        .withColumn(
            "ticket_confirmation_rank", (F.col("_before") + F.col("_in_slice")).cast("int")
        )
        .drop("_slice", "_in_slice", "_before", *[f"_c_{key}" for key in keys])
    )


def action_detail(
    tables: Tables, settings: Settings, recorded: DataFrame | None = None
) -> DataFrame:
    """The action log with the current state of each action's ticket attached.

    ``recorded`` has the reduced touches where they are kept between runs
    (``increments.py``); the history is not read then.
    """
    if recorded is None:
        recorded = recorded_actions(tables, settings)
    actions = all_actions(recorded, tables, settings)
    ranked = _ranked(_enriched(actions, _ticket_facts(recorded, tables, settings)))

    # The touch order is total, so the last touch is the one ranked highest.
    last = F.col("ticket_confirmation_rank") == F.col("ticket_status_action_count")
    return with_weeks(
        ranked.withColumn("is_last_confirmer", flag(last))
        .withColumnRenamed("action_ts_az", "action_time_az"),
        settings,
    )


def confirmation_actions(
    tables: Tables, settings: Settings, recorded: DataFrame | None = None
) -> DataFrame:
    return action_detail(tables, settings, recorded).select(*CONFIRMATION_ACTIONS)


def of_live_tickets(detail: DataFrame) -> DataFrame:
    """Actions on live tickets, with event_id, ticket_status and ticket_event_date."""
    return detail.filter(F.col("ticket_found")).select(
        *CONFIRMATION_ACTIONS, "event_id", "ticket_status", "ticket_event_date"
    )


def ticket_actions(tables: Tables, settings: Settings) -> DataFrame:
    return of_live_tickets(action_detail(tables, settings))
