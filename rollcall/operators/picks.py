"""Keeping one row per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """The first row of each group.

    Spark limits each group to one row before the shuffle and again after it,
    so a group of any size sends at most one row per input partition. ``order``
    must be total for the result to be deterministic.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).filter(F.col("_place") == 1).drop("_place")
