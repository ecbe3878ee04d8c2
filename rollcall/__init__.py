"""Event-ticket confirmation analytics as Spark DataFrame pipelines."""

from rollcall.settings import Settings
from rollcall.sources.tables import Tables

__all__ = ["Settings", "Tables"]
