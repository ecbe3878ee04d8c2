"""Versions of the lists, kept so that two of them are compared without reading either whole.

Of a version the ids are kept, dealt to a fixed number of buckets by their hash, each a folder of its own,
and for each bucket a digest. Equal digests mean equal buckets (a sum and an exclusive or of 64-bit
hashes, and the number of rows); from one day to the next few ids change, so few buckets are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.plans import checks
from rollcall.plans.checks import CV

BUCKETS = 256


def digests(ids: DataFrame) -> DataFrame:
    """bucket, rows, sum, xor: one row for each bucket of ``ids``, whatever the order of its rows."""
    keys = [c for c in ids.columns if c in ("list", CV)]
    value = F.xxhash64(*keys)
    return ids.groupBy("bucket").agg(
        F.count("*").alias("rows"),
        F.sum(value.cast("decimal(38,0)")).alias("sum"),
        F.bit_xor(value).alias("xor"),
    )


def keep(listed: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Keeps the ids of a list, or of several told apart by column ``list``, as a version at ``path``."""
    keys = [c for c in listed.columns if c in ("list", CV)]
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    ids = listed.select(*keys, bucket.alias("bucket"))
    (
        ids.repartitionByRange("bucket", CV)
        .write.mode("overwrite")
        .partitionBy("bucket")
        .parquet(f"{path}/ids")
    )
    # The columns, for a version without any rows.
    ids.limit(0).coalesce(1).write.mode("overwrite").parquet(f"{path}/columns")
    kept = _kept(listed.sparkSession, path)
    digests(kept).coalesce(1).write.mode("overwrite").parquet(f"{path}/digests")


def differing(spark: SparkSession, old: str, new: str) -> list[int]:
    """The buckets that differ between two versions; there are no more than buckets."""
    sides = [spark.read.parquet(f"{path}/digests") for path in (old, new)]
    columns = ["rows", "sum", "xor"]
    named = [df.select("bucket", F.struct(*columns).alias(side)) for df, side in zip(sides, ("old", "new"))]
    both = named[0].join(named[1], "bucket", "full")
    changed = both.filter(~F.col("old").eqNullSafe(F.col("new")))
    return sorted(row.bucket for row in changed.select("bucket").collect())


def _kept(spark: SparkSession, path: str) -> DataFrame:
    columns = spark.read.parquet(f"{path}/columns").schema
    return spark.read.schema(columns).parquet(f"{path}/ids")


def _ids(spark: SparkSession, path: str, buckets: list[int]) -> DataFrame:
    return _kept(spark, path).filter(F.col("bucket").isin(buckets)).drop("bucket")


def changes(spark: SparkSession, old: str, new: str) -> DataFrame:
    """(cv_customer_id, change) for ids in one version only (and their list), from the buckets that differ."""
    buckets = differing(spark, old, new)
    return checks.snapshot_diff(_ids(spark, old, buckets), _ids(spark, new, buckets))
