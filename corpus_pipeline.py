"""A pipeline over the documents in five stages, each of them one of the text operators.

A stage takes the session, the documents that its predecessor kept and the folder of tables, and
returns documents with the same columns; the last returns the mix. Results of stages are kept as
Parquet in the shared folder between stages, so that a lost executor costs no more than a stage.

  toxicity          documents that the segment search calls toxic go
  near duplicates   one document of each SimHash group stays, the one with the smallest doc_id
  decontamination   documents that hold a benchmark item go
  personal data     spans are replaced by their kind; n_chars is counted anew
  mix               how many words of each document the mix takes (0: it is not in the mix)

Every stage keeps rows with null or empty texts (the near-duplicate stage one of them, since they
are equal), treats extra columns as it finds them and gives an empty table for an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.llm import decontam, mixing, pii, simhash, toxicity
from rollcall.llm.shared import importable, stored


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.without_toxic(docs, model)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs).select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    redacted = pii.redacted(docs)
    return redacted.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.cube_mix(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("near duplicates", without_near_duplicates),
    ("decontamination", without_benchmark),
    ("personal data", without_personal_data),
    ("mix", mixed),
]

#: Its stages cannot be expressed in SQL; tests compare it with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies, source of the documents that stay."""
    importable(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
