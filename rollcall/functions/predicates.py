"""Row tests and small column expressions used across the pipelines."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

CONFIRMED = "Confirmed"
DOUBLE_CONFIRMED = "Double Confirmed"


def any_case_in(value: Column, options: Iterable[str]) -> Column:
    return F.lower(value).isin([o.lower() for o in options])


def is_confirmed(status: Column) -> Column:
    return any_case_in(status, [CONFIRMED])


def is_double_confirmed(status: Column) -> Column:
    return any_case_in(status, [DOUBLE_CONFIRMED])


def is_any_confirmed(status: Column) -> Column:
    return any_case_in(status, [CONFIRMED, DOUBLE_CONFIRMED])


def none_of(value: Column, options: Iterable[str]) -> Column:
    """True only for a non-NULL value outside ``options``; trailing blanks do not count."""
    return value.isNotNull() & ~F.rtrim(value).isin([option.rstrip(" ") for option in options])


def has_text(value: Column) -> Column:
    """True only for a value with something besides blanks."""
    return value.isNotNull() & (F.trim(value) != "")


def or_fallback(value: Column, fallback: Column, junk: Iterable[str]) -> Column:
    """``value`` unless it is NULL or junk, then ``fallback`` whatever it holds."""
    return F.when(none_of(value, junk), value).otherwise(fallback)


def flag(test: Column) -> Column:
    """1 where the test holds, else 0 (also where it is NULL)."""
    return F.when(test, 1).otherwise(0)


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """Rounded percentage; NULL where ``whole`` is 0 or NULL."""
    return F.round(F.try_divide(part.cast("double") * 100, whole.cast("double")), digits)
