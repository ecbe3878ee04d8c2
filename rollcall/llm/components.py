"""Connected components of links, by alternating large and small stars.

Every round joins each node's neighbours to the smallest node among them; the links shrink to one
star per component in a number of rounds that grows as the logarithm of the largest component.
Links stay in tables: a node's neighbours are reduced to their minimum, never gathered, and the
minima are stored before they are joined, so that Spark can split a node with very many links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.shared import stored


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(stored(least), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    least = stored(links.groupBy("u").agg(F.min("v").alias("m")))
    moved = links.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.withColumnRenamed("m", "v")).distinct()


def _state(links: DataFrame) -> tuple:
    digest = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return tuple(links.agg(F.count("*"), digest).first())


def components(links: DataFrame) -> DataFrame:
    """u, root: each linked node but the roots, and the smallest node that it reaches.

    `links` has long columns u and v, in any order, with repeats; a link of a node to itself and
    links to null are left out.
    """
    high, low = F.greatest("u", "v"), F.least("u", "v")
    links = stored(links.filter("u <> v").select(high.alias("u"), low.alias("v")).distinct())
    state = _state(links)
    while True:
        links = stored(_small_star(_large_star(links)))
        before, state = state, _state(links)
        if state == before:
            return links.withColumnRenamed("v", "root")
