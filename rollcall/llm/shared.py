"""Helpers of the text operators: words, and tables kept in the shared folder."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.sinks import staged

#: A word is a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def importable(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver has it, whatever their folder."""
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment
    paths = [p for p in known.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        known["PYTHONPATH"] = os.pathsep.join([root, *paths])


def stored(df: DataFrame) -> DataFrame:
    """The rows, written once to the shared folder and read back, so that nothing is computed twice."""
    return staged(df)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def word_list(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8; bytes.split() knows exactly the six ASCII characters."""
    return (text or "").encode("utf-8", "surrogatepass").split()
