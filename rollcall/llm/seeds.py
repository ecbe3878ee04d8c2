"""Anchors of all documents as a table, and those that can lead to a repeat."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.llm.shared import stored
from rollcall.llm.winnowing import Rolling, anchors

_BYTE = 256


def unpacked(at: int) -> tuple[int, int, int]:
    """Of an anchor's `at`: the first window start selecting it, how many more do, and how far
    the anchor lies behind the first."""
    return at >> 16, (at >> 8) & 255, at & 255


def firsts_and_count(ats: Column) -> tuple[Column, Column]:
    """Equal surroundings are selected by equally many windows each."""
    return F.transform(ats, lambda at: F.shiftright(at, 16)), F.shiftright(ats[0], 8).bitwiseAND(F.lit(255)) + 1


def anchor_table(
    docs: DataFrame,
    keys: Sequence[str],
    tokens: Callable[[str], np.ndarray],
    length: int,
    k: int,
) -> DataFrame:
    """keys, anchor, context, ats: the anchors of each row of docs (keys and text).

    `anchor` is the hash of its k tokens, `context` that of all tokens of the windows selecting it.
    Those that are equal in one text are one row with all their places in ascending order, so a
    text that repeats itself does not send a row for each token to one key.
    """
    if not 0 < length - k < _BYTE:
        raise ValueError("an anchor must leave room for fewer than 256 windows")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, counts, sizes = [], [], []
            for text in batch.column("text").to_pylist():
                found = tokens(text)
                if len(found) < length:
                    counts.append(0)
                    continue
                grams, wide = Rolling(found).all(k), Rolling(found, 1)
                places, first, last = anchors(grams, length - k + 1)
                at = (first << 16) + (last - first << 8) + places - first
                anchor, context = grams[places], wide.between(first, last + length)
                order = np.lexsort((at, context, anchor))
                at, anchor, context = at[order], anchor[order], context[order]
                new = np.append(True, (anchor[1:] != anchor[:-1]) | (context[1:] != context[:-1]))
                begin = np.flatnonzero(new)
                counts.append(len(begin))
                sizes.append(np.diff(np.append(begin, len(at))))
                parts.append((anchor[begin], context[begin], at))
            if not parts:
                continue
            rows = pa.array(np.repeat(np.arange(len(counts)), counts))
            columns = [batch.column(name).take(rows) for name in keys]
            found = [pa.array(np.concatenate(x).view(np.int64)) for x in zip(*parts, strict=True)]
            ends = pa.array(np.append(0, np.cumsum(np.concatenate(sizes))), pa.int32())
            columns += [*found[:2], pa.ListArray.from_arrays(ends, found[2])]
            yield pa.RecordBatch.from_arrays(columns, names=[*keys, "anchor", "context", "ats"])

    kind = T.StructType([docs.schema[name] for name in keys])
    for name in ("anchor", "context"):
        kind = kind.add(name, T.LongType())
    kind = kind.add("ats", T.ArrayType(T.LongType()))
    return stored(docs.select(*keys, "text").mapInArrow(find, kind))


def repeated_anchors(table: DataFrame) -> DataFrame:
    """The rows of the anchors that are found twice or more.

    Their list is a table of its own, so that both sides of the join are plain shuffles and an
    anchor with very many rows (of a passage that very many texts have) is split among tasks.
    """
    often = table.groupBy("anchor").agg(F.sum(F.size("ats")).alias("n")).filter("n > 1").select("anchor")
    return stored(table.join(stored(often), "anchor"))
