"""Writers for reports and change files, and tables kept between the steps of a job."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Folders of the runs that are going on, by application, the innermost last.
_RUNS: dict[str, list[str]] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: the session's checkpoint folder.

    Where none is set, a temporary folder will do on one machine only; on a
    cluster each executor would write to a disk of its own, so that is an error.
    """
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if master == "local" or master.startswith("local["):
        return f"file://{tempfile.gettempdir()}/rollcall-{spark.sparkContext.applicationId}"
    raise RuntimeError("name a folder that all executors share in spark.checkpoint.dir")


def shared_path(spark: SparkSession) -> str:
    """A new path in the shared folder, within the folder of the run if one is going on."""
    runs = _RUNS.get(spark.sparkContext.applicationId)
    return f"{runs[-1] if runs else shared_folder(spark)}/{uuid.uuid4().hex}"


@contextmanager
def run_folder(spark: SparkSession) -> Iterator[str]:
    """A folder of the run's own for what it keeps between steps, deleted with all of it at the end.

    For jobs that write their results elsewhere: what is read lazily from a table
    kept here cannot be read after the run.
    """
    path = shared_path(spark)
    runs = _RUNS.setdefault(spark.sparkContext.applicationId, [])
    runs.append(path)
    try:
        yield path
    finally:
        runs.remove(path)
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def staged(df: DataFrame) -> DataFrame:
    """The rows, written once to the shared folder and read back.

    For what several steps read: it is computed once, and a lost executor costs
    no more than a stage.
    """
    path = shared_path(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_report(df: DataFrame, path: str) -> None:
    """Writes a report as parquet, with its display column names."""
    df.write.mode("overwrite").parquet(path)


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int) -> DataFrame:
    """Writes a table in buckets of a key, sorted within them, and returns it from the catalog.

    What joins or groups such tables by the key, or by more than it, needs no
    shuffle. A bucket has all rows of its keys, so this is for tables whose keys
    have few rows each.
    """
    (
        df.repartition(buckets, key)
        .write.mode("overwrite")
        .bucketBy(buckets, key)
        .sortBy(key)
        .option("path", path)
        .saveAsTable(table)
    )
    return df.sparkSession.table(table)


def in_file_order(spark: SparkSession, path: str) -> DataFrame:
    """A written report with the position of each row in its files, from 1, as column ``position``.

    Rows are counted per file; no task reads more than a file of them.
    """
    rows = spark.read.parquet(path).select(
        "*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row")
    )
    # Numbers of files are padded with zeros up to a length; longer names come later.
    earlier = Window.orderBy(F.length("_file"), "_file").rowsBetween(Window.unboundedPreceding, -1)
    files = rows.groupBy("_file").agg(F.count("*").alias("_n")).select(
        "_file", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start")
    )
    placed = rows.join(files, "_file").withColumn("position", F.col("_start") + F.col("_row") + 1)
    return placed.drop("_file", "_row", "_start")


def write_change_file(changes: DataFrame, path: str) -> None:
    """Writes (cv_customer_id, change) as CSV, removals first, each part by id.

    Rows are range-partitioned by the sort, so the part files read in name
    order hold the whole sorted file.
    """
    (
        changes.select("cv_customer_id", "change")
        .orderBy(F.desc("change"), F.asc("cv_customer_id"))
        .write.mode("overwrite")
        .option("header", True)
        .csv(path)
    )
