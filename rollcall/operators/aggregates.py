"""Grouped counts and ordered text lists."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions.predicates import flag


def count_distinct_where(
    df: DataFrame,
    keys: Sequence[str],
    id_col: str,
    tests: Mapping[str, Column],
    id_is_unique: bool = False,
) -> DataFrame:
    """Per group, the distinct ids that pass each test at least once.

    The rows are first reduced to one per group and id, which spreads a large
    group over all tasks and needs no copy of the rows per test. With
    ``id_is_unique`` that step is void and the counts combine on the map side.
    """
    flags = {name: flag(test & F.col(id_col).isNotNull()) for name, test in tests.items()}
    if id_is_unique:
        return df.groupBy(*keys).agg(*[F.sum(f).alias(name) for name, f in flags.items()])
    per_id = df.groupBy(*together(keys, id_col)).agg(*[F.max(f).alias(name) for name, f in flags.items()])
    return per_id.groupBy(*keys).agg(*[F.sum(name).alias(name) for name in flags])


def together(keys: Sequence[str], id_col: str) -> list[str]:
    """The keys and the id, which may be a key itself."""
    return list(dict.fromkeys([*keys, id_col]))


def text_list(value: str, separator: str = ", ", order: str | None = None) -> Column:
    """Ordered concatenation of the non-NULL values; NULL if there is none."""
    return F.expr(f"listagg({value}, '{separator}') WITHIN GROUP (ORDER BY {order or value})")


def counted_list(df: DataFrame, keys: Sequence[str], item: str, name: str) -> DataFrame:
    """One text per group: ``item xN, item xN``, by item.

    The rows of a text are brought together as they are: parts of a text are no
    smaller than its rows, so combining them before the shuffle saves nothing.
    """
    counted = df.groupBy(*keys, item).agg(F.count("*").alias("_n")).repartition(*keys)
    labelled = counted.withColumn("_label", F.concat(F.col(item), F.lit(" x"), F.col("_n")))
    return labelled.groupBy(*keys).agg(text_list("_label", order=item).alias(name))


def distinct_list(df: DataFrame, keys: Sequence[str], item: str, name: str) -> DataFrame:
    """One text per group: the distinct values, in order; brought together as in ``counted_list``."""
    values = df.select(*keys, item).distinct().repartition(*keys)
    return values.groupBy(*keys).agg(text_list(item).alias(name))


def rank_of_label(label: Column, ranked: Sequence[str]) -> Column:
    """Severity of a label: highest for the first of ``ranked``, 0 for others.

    The maximum over a group, turned back into a label, is the worst in it.
    """
    rank = F.lit(0)
    for height, text in enumerate(reversed(ranked), start=1):
        rank = F.when(label == text, height).otherwise(rank)
    return rank


def label_of_rank(rank: Column, ranked: Sequence[str]) -> Column:
    label = F.lit(None).cast("string")
    for height, text in enumerate(reversed(ranked), start=1):
        label = F.when(rank == height, text).otherwise(label)
    return label
