"""SimHash near-duplicates with pigeonring filtering.

Fingerprints: ASCII capitals lower-cased, words joined to shingles, XXH64 of each shingle, and a
majority vote for each of 64 bits (a text with fewer words than a shingle is one shingle, a text
without words has fingerprint zero and is linked like any other).

Links: two fingerprints within `max_bits` bits. The 64 bits are cut into `segments` around a ring.
If all segments together differ in at most t bits, there is a segment from which every chain of l
consecutive segments differs in at most l * t / segments bits. With more segments than bits, the
first segment of such a chain is equal and the first two differ in one bit at most. So a
fingerprint is looked up by its first two segments from each start, once as they are and once with
every single bit of the second flipped; candidates must then keep the whole chain within its
budgets, and the last budget is the Hamming check itself. Equal fingerprints are one class before
any of this, so copies cost nothing; keys of four segments have 32 bits, so that candidates grow
little faster than the classes.

Nulls count as empty texts. A null doc_id takes part, but is no component's id unless all of it are
null. Repeated rows give equal rows, extra columns are ignored, an empty table gives an empty
result. Very long texts are hashed piece by piece.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.components import components
from rollcall.llm.shared import stored, text_or_empty

_PIECE = 65_536


def fingerprint(text: str, width: int = 3, seed: int = 42) -> int:
    """The fingerprint as an unsigned number; the majority is strict."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n, digest = max(1, len(words) - width + 1), xxhash.xxh64_intdigest
    votes = np.zeros(64, dtype=np.int64)
    for start in range(0, n, _PIECE):
        piece = range(start, min(n, start + _PIECE))
        hashes = np.array([digest(b" ".join(words[i : i + width]), seed) for i in piece], dtype=">u8")
        votes += np.unpackbits(hashes.view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > n).tobytes(), "big")


def fingerprints(docs: DataFrame, width: int = 3, seed: int = 42) -> DataFrame:
    """docs with `fp`, the fingerprint as a signed long."""

    def compute(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            prints = np.array([fingerprint(t, width, seed) for t in batch], dtype=np.uint64)
            yield pd.Series(prints.view(np.int64))

    return docs.withColumn("fp", F.pandas_udf(compute, "long")(text_or_empty()))


def _rotated(fp: Column, by: int) -> Column:
    return fp if by == 0 else F.shiftleft(fp, by).bitwiseOR(F.shiftrightunsigned(fp, 64 - by))


def links(classes: DataFrame, max_bits: int = 3, segments: int = 4) -> DataFrame:
    """u, v (u < v): all pairs of different fingerprints of `classes.fp` within max_bits bits."""
    if not 0 <= max_bits < segments <= 16:
        raise ValueError("more segments than differing bits are needed, and 16 at most")
    edges = [64 * i // segments for i in range(segments + 1)]
    widths = [b - a for a, b in zip(edges, edges[1:], strict=False)]

    def ring(i: int, length: int) -> int:
        return sum(widths[(i + j) % segments] for j in range(length))

    fp = F.col("fp")
    plain, flipped, chains = [], [], []
    for i in range(segments):
        rotated, two = _rotated(fp, edges[i]), ring(i, min(2, segments))
        key = F.shiftrightunsigned(rotated, 64 - two) if two < 64 else rotated
        start = F.lit(i).alias("start")
        keys = [key, *(key.bitwiseXOR(F.lit(1 << b)) for b in range(widths[(i + 1) % segments]))]
        plain.append(F.struct(start, key.alias("key")))
        flipped.append(F.struct(start, F.array(*keys).alias("keys")))
        differ = _rotated(F.col("u").bitwiseXOR(F.col("v")), edges[i])
        chain = F.lit(True)
        for length in range(1, segments + 1):
            far = 64 - ring(i, length)
            part = F.shiftrightunsigned(differ, far) if far else differ
            chain &= F.bit_count(part) <= length * max_bits // segments
        chains.append((F.col("start") == i) & chain)
    one = classes.select(fp.alias("u"), F.explode(F.array(*plain)).alias("k")).select("u", "k.*")
    other = (
        classes.select(fp.alias("v"), F.explode(F.array(*flipped)).alias("k"))
        .select("v", "k.start", F.explode("k.keys").alias("key"))
    )
    within = chains[0]
    for chain in chains[1:]:
        within |= chain
    # Both sides are many times their table, whose size Spark goes by: neither is to be broadcast.
    return one.join(other.hint("merge"), ["start", "key"]).filter((F.col("u") < F.col("v")) & within).select("u", "v").distinct()


def near_duplicates(docs: DataFrame, width: int = 3, max_bits: int = 3, segments: int = 4, seed: int = 42) -> DataFrame:
    """doc_id, fp, component_id (smallest doc_id reachable by links): one row per row of docs."""
    prints = stored(fingerprints(docs.select("doc_id", "text"), width, seed).select("doc_id", "fp"))
    classes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first_doc")))
    roots = components(links(classes, max_bits, segments)).select(F.col("u").alias("fp"), "root")
    rooted = classes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = rooted.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    # A table of its own, so that the copies of one fingerprint are split between tasks.
    found = stored(rooted.join(smallest, "root").select("fp", "component_id"))
    return prints.join(found, "fp").select("doc_id", "fp", "component_id")


def simhash_components(docs: DataFrame, width: int = 3, max_bits: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits), component_id."""
    found = near_duplicates(docs, width, max_bits)
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, width: int = 3, max_bits: int = 3, segments: int = 4, seed: int = 42) -> DataFrame:
    """One row of docs of each component: the smallest doc_id, and of its texts the smallest digest.

    Rows that are equal in doc_id and text count once. A component whose rows have no doc_id keeps
    the one of the smallest digest.
    """
    digest = F.md5(docs["text"])
    # Nulls come last as doc_id; the digest tells apart the texts that share one.
    first = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "digest")
    texts = docs.select("doc_id", "text", digest.alias("digest"))
    prints = fingerprints(texts, width, seed).select("fp", first.alias("first"))
    classes = stored(prints.groupBy("fp").agg(F.min("first").alias("first")))
    roots = components(links(classes, max_bits, segments)).select(F.col("u").alias("fp"), "root")
    rooted = classes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    kept = stored(rooted.groupBy("root").agg(F.min("first").alias("first")).select("first.*"))
    same = docs["doc_id"].eqNullSafe(kept["doc_id"]) & digest.eqNullSafe(kept["digest"])
    return docs.join(kept, same, "left_semi").dropDuplicates(["doc_id", "text"])
