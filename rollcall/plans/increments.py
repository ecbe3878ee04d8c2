"""The action log between runs: reduced touches kept by day, and brought up to date by what is new.

The history is by far the largest table, and only its last days change. Its touches, reduced to one row
per actor, ticket, status and day with the earliest time of each source, are kept as a table
partitioned by that day. New history rows are reduced in the same way; the days that they fall on
are read back, merged and written over, all other days are not touched. Merging takes minima, so rows
that come late, twice or again after a failed run change nothing. The log itself is then made
from the kept table: its ranks need a ticket's touches of all days, but no row of the history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.plans import actions
from rollcall.settings import Settings
from rollcall.sinks import staged

DAY = "action_date_az"


def _schema(history: DataFrame, settings: Settings):
    return actions.reduced_touches(history.limit(0), settings).schema


def kept_touches(spark: SparkSession, path: str, schema) -> DataFrame:
    """The kept table; the schema is given, so that none is read from its files."""
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def _is_kept(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def record(history: DataFrame, settings: Settings, path: str) -> DataFrame:
    """Adds history rows to the table of reduced touches at ``path`` and returns the whole table.

    The first call makes it. A day with very many touches is written by several
    tasks. The merged days are stored before they replace the old ones, so a
    run that fails leaves each day as it was or as it is to be.
    """
    spark, schema = history.sparkSession, _schema(history, settings)
    new = staged(actions.reduced_touches(history, settings))
    if _is_kept(spark, path):
        # A run adds few days; there are never more than the calendar has.
        days = [row[0] for row in new.select(DAY).distinct().collect()]
        same_day = F.col(DAY).isin([day for day in days if day is not None])
        if None in days:
            same_day = same_day | F.col(DAY).isNull()
        new = staged(actions.merged(kept_touches(spark, path, schema).filter(same_day), new))
    (
        new.repartitionByRange(DAY, "ticket_id", "user_email")
        .write.mode("overwrite")
        .partitionBy(DAY)
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .parquet(path)
    )
    return kept_touches(spark, path, schema)
