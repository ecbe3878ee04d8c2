"""Substring removal by seed and extend.

A repeat is a stretch of at least `length` words that an earlier document (smaller doc_id) also
has. Seeds: documents meet on winnowed anchors, k words that every window of `length` words picks
from itself, so that equal windows have equal anchors. Extension: an anchor's occurrences are
extended both ways over all windows that select it. Those whose whole surroundings are equal are
one class, and all of its windows are repeats in every document but the first. What remains are the
first documents of classes that differ somewhere around the same anchor: their extensions are
compared window by window, from the leftmost to the rightmost that holds the anchor. Runs of
matched windows are the maximal repeats; their words are removed.

Classes and windows are reduced to their smallest doc_id before they meet, so a group of copies or
a passage of many documents is never gathered and its pairs are never formed.

Nulls have no words. Rows without a doc_id neither lose words nor count as earlier. Equal doc_ids
are never earlier than each other, so repeated rows lose the same words. Extra columns are ignored,
an empty table gives an empty result. Anchors and windows are compared by
64-bit hashes of one kind, surroundings by another.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.llm.seeds import anchor_table, repeated_anchors, unpacked
from rollcall.llm.shared import stored, text_or_empty, word_list
from rollcall.llm.winnowing import Rolling

_REMEMBERED_WORDS = 500_000


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > _REMEMBERED_WORDS:
            self.clear()
        found = xxhash.xxh64_intdigest(word, 7)
        if len(word) < 100:
            self[word] = found
        return found


_HASHES = _WordHashes()


def hashes_of(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))


def word_hashes(text: str) -> np.ndarray:
    return hashes_of(word_list(text))


def _identified(docs: DataFrame) -> DataFrame:
    """doc_id, t (tells texts of one doc_id apart), text."""
    text = text_or_empty()
    return docs.select("doc_id", F.hash(text).alias("t"), text.alias("text"))


def _window_rows(sought: DataFrame, length: int, doc_type: T.DataType) -> DataFrame:
    """anchor, context, offset, doc_id and hash of every window of the sought anchors of texts."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, columns = [], ([], [], [], [])
            asked = zip(batch.column("text").to_pylist(), batch.column("asks").to_pylist(), strict=True)
            for i, (text, asks) in enumerate(asked):
                words = word_list(text)
                for ask in asks:
                    first, more, _ = unpacked(ask["at"])
                    found = Rolling(hashes_of(words[first : first + more + length])).all(length)
                    n = len(found)
                    rows.append(np.full(n, i))
                    columns[0].append(np.full(n, ask["anchor"], dtype=np.int64))
                    columns[1].append(np.full(n, ask["context"], dtype=np.int64))
                    columns[2].append(np.arange(n, dtype=np.int32))
                    columns[3].append(found.view(np.int64))
            if rows:
                ids = batch.column("doc_id").take(pa.array(np.concatenate(rows)))
                arrays = [pa.array(np.concatenate(c)) for c in columns]
                yield pa.RecordBatch.from_arrays(
                    [*arrays, ids], names=["anchor", "context", "offset", "window", "doc_id"]
                )

    kind = T.StructType()
    for name, part in (("anchor", T.LongType()), ("context", T.LongType()), ("offset", T.IntegerType())):
        kind = kind.add(name, part)
    return sought.mapInArrow(cut, kind.add("window", T.LongType()).add("doc_id", doc_type))


def removed_words(runs: list | None, n: int, length: int) -> np.ndarray:
    """Which of n words lie in a matched window; a run is (ats, offsets of windows or None for all)."""
    steps = np.zeros(n + 1, dtype=np.int64)
    for run in runs if runs is not None else ():
        for at in run["ats"]:
            first, more, _ = unpacked(at)
            for offset in range(more + 1) if run["offsets"] is None else run["offsets"]:
                steps[first + offset] += 1
                steps[first + offset + length] -= 1
    return np.cumsum(steps[:n]) > 0


def without_repeats(
    docs: DataFrame, length: int = 50, k: int = 25, texts: bool = True
) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and, if `texts`, kept_text: one row per row of docs."""
    doc_type = docs.schema["doc_id"].dataType
    known = _identified(docs).filter("doc_id IS NOT NULL")
    seeds = repeated_anchors(anchor_table(known, ["doc_id", "t"], word_hashes, length, k))
    # What follows joins stored tables, so that large keys are split between tasks.
    classes = stored(
        seeds.groupBy("anchor", "context").agg(
            F.min(F.struct("doc_id", "t", F.col("ats")[0].alias("at"))).alias("first"),
            F.max("doc_id").alias("last_doc"),
        )
    )
    # Anchors with different surroundings: their first documents are extended window by window.
    differing = stored(
        classes.groupBy("anchor")
        .agg(F.min("context").alias("low"), F.max("context").alias("high"))
        .filter("low <> high")
        .select("anchor")
    )
    asked = classes.join(differing, "anchor").select("anchor", "context", "first.*")
    asks = asked.groupBy("doc_id", "t").agg(F.collect_list(F.struct("anchor", "context", "at")).alias("asks"))
    windows = stored(_window_rows(known.join(asks, ["doc_id", "t"]), length, doc_type))
    earliest = stored(
        windows.groupBy("anchor", "window")
        .agg(F.min("doc_id").alias("earliest"), F.max("doc_id").alias("latest"))
        .filter("earliest < latest")
        .drop("latest")
    )
    extended = (
        windows.join(earliest, ["anchor", "window"])
        .filter("earliest < doc_id")
        .groupBy("anchor", "context")
        .agg(F.collect_list("offset").alias("offsets"))
    )
    decided = stored(
        classes.select("anchor", "context", F.col("first.doc_id").alias("first_doc"), "last_doc")
        .join(extended, ["anchor", "context"], "left")
        .filter("last_doc > first_doc OR offsets IS NOT NULL")
    )
    whole = F.col("doc_id") > F.col("first_doc")
    runs = (
        seeds.join(decided, ["anchor", "context"])
        .filter(whole | F.col("offsets").isNotNull())
        .withColumn("offsets", F.when(~whole, F.col("offsets")))
        .groupBy("doc_id", "t")
        .agg(F.collect_list(F.struct("ats", "offsets")).alias("runs"))
    )
    nothing = F.lit(None).cast(runs.schema["runs"].dataType)
    found = known.join(runs, ["doc_id", "t"], "left").unionByName(
        _identified(docs).filter("doc_id IS NULL").withColumn("runs", nothing)
    )

    def keep(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for batch, matched in batches:
            rows = []
            for text, its in zip(batch, matched, strict=True):
                words = word_list(text)
                lost = removed_words(its, len(words), length)
                kept = b" ".join([w for w, gone in zip(words, lost.tolist(), strict=True) if not gone])
                row = (len(words), int(lost.sum()), hashlib.sha256(kept).hexdigest())
                rows.append((*row, kept.decode("utf-8", "surrogatepass")) if texts else row)
            yield pd.DataFrame(rows, columns=names)

    kind = "n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * texts
    names = [c.split()[0] for c in kind.split(", ")]
    kept = F.pandas_udf(keep, kind)("text", "runs")
    return found.select("doc_id", kept.alias("kept")).select("doc_id", "kept.*")
