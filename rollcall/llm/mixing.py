"""Mixing sources to target weights by the cube method.

Every source has a target number of words. A document of a source is taken `target / size of the
source` times on average: the whole part for certain, the rest as a fractional inclusion
probability. The cube method turns these into copies while two totals of each source stay as they
are, the words and the documents: among any three documents there is a direction in which their
probabilities can move with both totals unchanged (the null space of the constraints); the flight
goes along it until a probability is 0 or 1, and goes on with the next document. At most two
documents of a flight stay undecided; they and a few that it does not take up are left over.

A flight takes a block of a source's documents, never a whole source: what all blocks leave meets
in the next round's blocks, until a source has one block. The landing then decides the last handful
of a source by trying all outcomes. A round leaves at most LANDING + 2 of `block` documents, so
rounds grow as the logarithm of the table and no task holds more than a block.

Everything random comes from hashes of doc_id, size and a seed, so reruns agree. Documents of a
null source are one source, the last. Null and empty texts have size 0: their target is their
source's, they take no words. Rows repeated in every column are separate documents. Extra columns
are ignored, an empty table gives an empty result. If all sizes are 0, targets are 0.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollcall.llm.shared import WORD, stored, text_or_empty

_EDGE = 1e-9
#: Documents of each flight kept for the landing, besides the two that a flight leaves undecided.
LANDING = 8


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = (5.0, 2.0, 1.0), most: float = 3.0
) -> DataFrame:
    """source, source_size, target: one row per source of (source, size), kept in the shared folder.

    Weights repeat along the sources in code-point order, null last. Targets share all sizes by
    weight, stop at `most` times the source's size, and what is above is shared again by weight.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # Sources are numbered within ranges of their order, after the sources of earlier ranges.
    order = F.asc_nulls_last("source")
    ranges = stored(totals.repartitionByRange(order).withColumn("range", F.spark_partition_id()))
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.groupBy("range").agg(F.count("*").alias("n")).select(
        "range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start")
    )
    place = F.row_number().over(Window.partitionBy("range").orderBy(order)) - 1
    table = ranges.withColumn("place", place).join(starts, "range").select(
        "source", "source_size", (F.col("start") + F.col("place")).alias("rank")
    )
    weight = F.lit(float(weights[-1]))
    for i, w in enumerate(weights[:-1]):
        weight = F.when(F.col("rank") % len(weights) == i, float(w)).otherwise(weight)
    table = stored(table.withColumn("weight", weight))
    cap = F.col("source_size") * float(most)
    everything = table.agg(F.sum("source_size")).first()[0] or 0

    # Sums of the capped and the others; each round caps at least one more source or ends.
    level, n_capped = 0.0, -1
    while True:
        above = cap <= F.col("weight") * level
        found = table.agg(
            F.count_if(above),
            F.sum(F.when(above, cap).otherwise(0.0)),
            F.sum(F.when(above, 0.0).otherwise(F.col("weight"))),
        ).first()
        if found[0] == n_capped or not found[2]:
            break
        n_capped, level = found[0], (everything - found[1]) / found[2]
    return table.select(
        "source", "source_size", F.least(cap, F.col("weight") * level).alias("target")
    )


def flight(p: np.ndarray, sizes: np.ndarray, draws: np.ndarray) -> np.ndarray:
    """Moves the probabilities until at most two of those taken up lie strictly between 0 and 1.

    The last LANDING documents are not taken up: they are left for the landing.

    Three open documents a, b, c move by (s_b - s_c, s_c - s_a, s_a - s_b): neither their sum nor
    their words change. Documents of equal size leave the words alone in any pair, so then the
    first two trade.
    """
    p = p.copy()
    open_units: list[int] = []
    for i in range(max(0, len(p) - LANDING)):
        if _EDGE < p[i] < 1 - _EDGE:
            open_units.append(i)
        while len(open_units) == 3:
            a, b, c = open_units
            step = (sizes[b] - sizes[c], sizes[c] - sizes[a], sizes[a] - sizes[b])
            if not any(step):
                step = (1.0, -1.0, 0.0)
            up = min((1 - p[k] if s > 0 else p[k]) / abs(s) for k, s in zip(open_units, step, strict=True) if s)
            down = min((p[k] if s > 0 else 1 - p[k]) / abs(s) for k, s in zip(open_units, step, strict=True) if s)
            length = up if draws[i] * (up + down) < down else -down
            for k, s in zip(open_units, step, strict=True):
                p[k] = min(1.0, max(0.0, p[k] + length * s))
            # The one that reached its end is snapped to it.
            nearest = min((k for k, s in zip(open_units, step, strict=True) if s), key=lambda k: min(p[k], 1 - p[k]))
            p[nearest] = round(p[nearest])
            open_units = [k for k in open_units if _EDGE < p[k] < 1 - _EDGE]
    return p


def _flights(units: DataFrame, block: int, seed: int, round_no: int) -> DataFrame:
    """One round: blocks of about `block` units of a source, each flown in one task."""
    # Stored, so that the join knows its size, or splits a large source where it is none to send.
    counts = stored(units.groupBy("source_no").agg(F.count("*").alias("n_units")))
    blocks = F.ceil(F.col("n_units") / block)
    block_no = F.pmod(F.xxhash64("unit", F.lit(seed + round_no)), blocks)
    # One key for source and block, so that the blocks of a large source are dealt to many tasks.
    dealt = units.join(counts, "source_no").withColumn(
        "flown_with", F.concat_ws(":", "source_no", block_no)
    )

    def fly(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["draw", "unit"])
        group["p"] = flight(
            group["p"].to_numpy(), group["size"].to_numpy(dtype="float64"), group["draw"].to_numpy()
        )
        return group[["source_no", "unit", "size", "draw", "p"]]

    columns = dealt.select("flown_with", "source_no", "unit", "size", "draw", "p")
    return columns.groupBy("flown_with").applyInPandas(
        fly, "source_no long, unit string, size long, draw double, p double"
    )


def _landed(units: DataFrame) -> DataFrame:
    """The last units, a handful a source, decided: of all outcomes the one that keeps its words
    best, one document counting as much as a hundredth of the mean size."""

    def land(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["draw", "unit"])
        p, sizes = group["p"].to_numpy(), group["size"].to_numpy(dtype="float64")
        outcomes = np.array(list(product((0.0, 1.0), repeat=len(group))))
        moved = outcomes - p
        cost = np.abs(moved @ sizes) + 0.01 * sizes.mean() * np.abs(moved.sum(axis=1))
        group["p"] = outcomes[int(cost.argmin())]
        return group

    columns = "source_no long, unit string, size long, draw double, p double"
    return units.groupBy("source_no").applyInPandas(land, columns)


def _numbered(sized: DataFrame) -> DataFrame:
    """sized with `copy_no` instead of `dealt`: equal rows are told apart by a number within them, so
    that every row is a unit of its own. Rows of size 0 are never flown and have none.

    Rows are numbered within the part of the table that they are `dealt` to, after the counts of
    earlier parts; so no task holds all rows that are equal.
    """
    key = ["doc_id", "source", "size"]
    within = Window.partitionBy(*key, "dealt").orderBy("doc_id")
    earlier = Window.partitionBy(*key).orderBy("dealt").rowsBetween(Window.unboundedPreceding, -1)
    flown = sized.filter("size > 0")
    counts = flown.groupBy(*key, "dealt").agg(F.count("*").alias("n"))
    # Stored, so that the join knows its size; most keys are in one part and have no row here.
    before = stored(counts.withColumn("n_before", F.sum("n").over(earlier)).filter("n_before > 0").drop("n"))
    numbers = flown.withColumn("place", F.row_number().over(within))
    same = numbers["doc_id"].eqNullSafe(before["doc_id"])
    for column in ("source", "size", "dealt"):
        same &= numbers[column].eqNullSafe(before[column])
    numbered = numbers.join(before, same, "left").select(
        *(numbers[c] for c in key), (F.coalesce("n_before", F.lit(0)) + F.col("place")).alias("copy_no")
    )
    empty = sized.filter("size = 0").select(*key, F.lit(None).cast("long").alias("copy_no"))
    return numbered.unionByName(empty)


def cube_mix(
    docs: DataFrame,
    weights: Sequence[float] = (5.0, 2.0, 1.0),
    most: float = 3.0,
    block: int = 4096,
    seed: int = 42,
) -> DataFrame:
    """doc_id, size, source_size, target, taken (words, repeats counted), copies, source."""
    words = F.regexp_count(text_or_empty(), F.lit(WORD)).cast("long")
    sized = stored(docs.select("doc_id", "source", words.alias("size"), F.spark_partition_id().alias("dealt")))
    targets = source_targets(sized, weights, most)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    # An empty doc_id and none are two things.
    named = F.coalesce(F.concat(F.lit("="), F.col("doc_id").cast("string")), F.lit("-"))
    key = F.concat_ws(":", named, "size", "copy_no")
    mixed = stored(
        _numbered(sized)
        .join(
            targets.withColumnRenamed("source", "its_source"),
            F.col("source").eqNullSafe(F.col("its_source")),
        )
        .drop("its_source")
        .withColumn("unit", key)
        .withColumn("source_no", F.xxhash64(F.coalesce(F.concat(F.lit("="), "source"), F.lit("-"))))
        .withColumn("whole", F.floor(rate + _EDGE))
        .withColumn("part", F.greatest(F.lit(0.0), rate - F.col("whole")))
    )
    draw = F.pmod(F.xxhash64("unit", F.lit(seed)), F.lit(2**40)) / float(2**40)
    open_units = mixed.filter((F.col("part") > _EDGE) & (F.col("size") > 0)).select(
        "source_no", "unit", "size", draw.alias("draw"), F.col("part").alias("p")
    )
    decided, round_no = [], 0
    while True:
        flown = stored(_flights(open_units, block, seed, round_no))
        ended = (F.col("p") <= _EDGE) | (F.col("p") >= 1 - _EDGE)
        decided.append(flown.filter(ended))
        open_units = flown.filter(~ended)
        # The landing begins when each source had one block.
        most_left = open_units.groupBy("source_no").count().agg(F.max("count")).first()[0] or 0
        round_no += 1
        if most_left <= LANDING + 2:
            break
    landed = _landed(open_units)
    for part in decided:
        landed = landed.unionByName(part)
    chosen = landed.select("source_no", "unit", F.round("p").cast("long").alias("extra"))
    copies = F.col("whole") + F.coalesce(F.col("extra"), F.lit(0))
    return (
        mixed.join(chosen, ["source_no", "unit"], "left")
        .withColumn("copies", copies.cast("long"))
        .select(
            "doc_id",
            "size",
            "source_size",
            "target",
            (F.col("copies") * F.col("size")).alias("taken"),
            "copies",
            "source",
        )
    )
