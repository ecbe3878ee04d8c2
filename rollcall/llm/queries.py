"""The registered queries of the text operators, with their production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rollcall.llm import (
    cleaning,
    decontam,
    fingerprints,
    licences,
    mixing,
    periods,
    phrases,
    pii,
    simhash,
    substrings,
    suffixes,
    tokens,
    toxicity,
)
from rollcall.llm.shared import importable

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _over_documents(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(_table(spark, sf_dir, "documents"))


def _toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.toxic_scores(docs, _table(spark, sf_dir, "labels")).drop("passages")


def queries() -> dict[str, Query]:
    return {
        "op1_token_counts": _over_documents(
            lambda docs: tokens.token_counts(docs, "word_bpe_49k.json")
        ),
        "op2_decontamination": lambda spark, sf_dir: decontam.contaminated_docs(
            _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
        ),
        "op3_seed_and_extend": _over_documents(
            lambda docs: substrings.without_repeats(docs, texts=False)
        ),
        "op4_deep_shallow": _over_documents(
            lambda docs: suffixes.without_repeats(docs, texts=False)
        ),
        "op5_cube_mix": _over_documents(lambda docs: mixing.cube_mix(docs).drop("copies", "source")),
        "op6_line_first": _over_documents(cleaning.line_first),
        "op7_toxic_segments": _toxicity,
        "op8_licence_sentences": _over_documents(licences.licences),
        "op9_simhash_pigeonring": _over_documents(simhash.simhash_components),
        "op10_personal_data": _over_documents(pii.personal_data),
        "op11_collocations": _over_documents(
            lambda docs: phrases.collocations(docs).drop("doc_id", "word")
        ),
        "op12_periodic_runs": _over_documents(periods.period_digests),
        "op13_scaled_sketch": _over_documents(fingerprints.edited_fingerprints),
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op6_line_first": cleaning.line_first_sql(),
        "op8_licence_sentences": licences.licences_sql(),
        "op11_collocations": phrases.collocations_sql(),
        "op13_scaled_sketch": fingerprints.edited_fingerprints_sql(),
    }
