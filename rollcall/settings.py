"""Everything a pipeline needs besides its tables."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Settings:
    """Parameters shared by the pipelines.

    ``as_of`` is one naive UTC instant. It stands in for the wall clock, so
    that a run is reproducible and date filters are literals that reach the
    scan.
    """

    as_of: datetime
    # Purchaser fields holding one of these are no purchaser: blank ones, and what
    # an import job has filled in.
    junk: tuple[str, ...] = ("",)
    machine_actors: tuple[str, ...] = ("System", "bulk-import")
    week_anchor: date = date(2024, 1, 1)
    local_zone: str = "America/Phoenix"
    # The anchored week of a date before the anchor rounds towards the anchor.
    # Set this to round it down, like every other week.
    floor_weeks: bool = False
    # Statuses (any casing) the event overview leaves out.
    excluded_statuses: tuple[str, ...] = ("cancelled",)
    # Set when a table enforces one row per ticket_id / per cv_transaction_id.
    # Distinct ticket counts then become plain counts and need no shuffle of the
    # tickets, and tickets are not joined to sales just to count the repeats.
    tickets_are_unique: bool = False
    sales_are_unique: bool = False

    @property
    def now(self) -> Column:
        return F.lit(self.as_of.isoformat(" ")).cast("timestamp_ntz")

    @property
    def today(self) -> Column:
        return F.lit(self.as_of.date())
