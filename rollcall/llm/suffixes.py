"""Suffix-array removal of repeated strings, sorted deep and shallow.

Every byte covered by a string of `length` bytes that starts anywhere else too is removed. Suffixes
that share `length` bytes are neighbours in the sorted array, so the array is cut into the groups
whose members share that many and all members of a group of two or more are repeats.

Only suffixes that can have such a neighbour are sorted. Each window of `length` bytes picks an
anchor of k bytes from itself (winnowing), so a suffix whose anchor is found once in all texts is
alone. Occurrences of an anchor whose whole surroundings are equal are one class, and the windows
of a class with two members repeat; the array holds one member for each class, and only of anchors
with several classes.

The array is sorted in buckets, each sorted by one task. A bucket's key is the core that a block
of neighbouring windows has in common, a stretch of bytes that holds the anchor: suffixes of one
block can only be equal if their cores are. Within buckets, a library sort by group and eight bytes takes
one level after another down to a shallow depth; what is still tied has a long common prefix and is ordered by
blind tries: an insertion goes down by branching bytes alone, compares once with the leaf that it
finds, and branches at the first difference.

A bucket holds one member for each class of its anchor, so its size is bounded by `BUCKET` classes.
For an anchor with more (a passage shorter than `length` in very many surroundings) the windows are
counted by two hashes of all their bytes instead, which combines on the map side and needs no task
to hold them. Both ways give the same answer.

Nulls count as empty texts; texts shorter than `length` lose nothing. Matches never cross texts;
repeated rows are copies of each other. Extra columns are ignored and an empty table gives an empty
result. A text of any length is hashed in linear time. Anchors and surroundings are compared by two
independent 64-bit hashes, texts by 96 bits, the sorted strings byte by byte.
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

from rollcall.llm.seeds import anchor_table, firsts_and_count, repeated_anchors, unpacked
from rollcall.llm.shared import stored, text_or_empty

#: Windows in a block, whose common core is their bucket, and depth of the shallow sort.
BLOCK, SHALLOW = 128, 32
#: Classes of one anchor that are sorted by one task.
BUCKET = 20_000
_KEYS = ["h", "t"]
_WORD = 8
_BYTES = np.random.default_rng(400).integers(1, 1 << 63, 256, dtype=np.uint64)


def block_size(length: int) -> int:
    """Small enough that the windows of a block have at least half of their bytes in common."""
    return max(1, min(BLOCK, length // 2))


def utf8(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def byte_tokens(text: str) -> np.ndarray:
    return _BYTES[np.frombuffer(utf8(text), dtype=np.uint8)]


def _identified(docs: DataFrame) -> DataFrame:
    """doc_id, text and h, t, which tell texts apart."""
    text = text_or_empty()
    return docs.select("doc_id", F.xxhash64(text).alias("h"), F.hash(text).alias("t"), text.alias("text"))


class BlindTrie:
    """Equal strings of a fixed length; inner nodes hold a depth and children by their byte there."""

    def __init__(self, data: bytes, length: int):
        self.data, self.length, self.root = data, length, None

    def insert(self, start: int) -> list[int]:
        """Adds the string at `start`; the starts of its equals so far, itself included."""
        data, length = self.data, self.length
        if self.root is None:
            self.root = [start]
            return self.root
        node = self.root
        while type(node) is tuple:  # blindly down to some leaf
            depth, children = node
            node = children.get(data[start + depth]) or next(iter(children.values()))
        other = node[0]
        if data[start : start + length] == data[other : other + length]:
            node.append(start)
            return node
        low, high = 0, length  # the first difference lies in low .. high - 1
        while high - low > 1:
            middle = (low + high) // 2
            if data[start + low : start + middle] == data[other + low : other + middle]:
                low = middle
            else:
                high = middle
        leaf, parent, node = [start], None, self.root
        while type(node) is tuple and node[0] < low:
            parent, node = node, node[1][data[other + node[0]]]
        if type(node) is tuple and node[0] == low:
            node[1][data[start + low]] = leaf
            return leaf
        split = (low, {data[other + low]: node, data[start + low]: leaf})
        if parent is None:
            self.root = split
        else:
            parent[1][data[other + parent[0]]] = split
        return leaf


def tied_suffixes(data: bytes, starts: np.ndarray, groups: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes sorted within groups, a library sort for each eight bytes, down to `depth`.

    Returns the order of those not alone by then, and their groups.
    """
    words = np.ndarray((len(data) - _WORD + 1,), dtype=">u8", buffer=data, strides=(1,))
    order = np.arange(len(starts))
    for at in range(0, depth, _WORD):
        if not len(order):
            break
        word = words[starts[order] + at].astype(np.uint64)
        ranked = np.lexsort((word, groups))
        order, groups, word = order[ranked], groups[ranked], word[ranked]
        new = np.append(True, (groups[1:] != groups[:-1]) | (word[1:] != word[:-1]))
        groups = np.cumsum(new) - 1
        many = np.bincount(groups)[groups] > 1
        order, groups = order[many], groups[many]
    return order, groups


def repeated_starts(data: bytes, starts: np.ndarray, groups: np.ndarray, length: int) -> np.ndarray:
    """Which suffixes share `length` bytes with another one of their group."""
    repeated = np.zeros(len(starts), dtype=bool)
    shallow = min(SHALLOW, length // _WORD * _WORD)
    order, groups = tied_suffixes(data, starts, groups, shallow)
    if not len(order):
        return repeated
    begins = np.flatnonzero(np.append(True, groups[1:] != groups[:-1]))
    places = dict(zip(starts[order].tolist(), order.tolist(), strict=True))
    tied = starts[order].tolist()
    for a, b in zip(begins.tolist(), [*begins[1:].tolist(), len(tied)], strict=True):
        trie, found = BlindTrie(data, length), []
        for start in tied[a:b]:
            equals = trie.insert(start)
            if len(equals) == 2:
                found.append(equals)
        for equals in found:
            repeated[[places[start] for start in equals]] = True
    return repeated


def _blocks(asked: DataFrame, length: int) -> DataFrame:
    """core, check, h, t, first, phase, content: blocks of neighbouring windows of the asked anchors.

    `first` is the block's first window start and `phase` its place in the aligned block. Of
    crowded anchors, every window is a block of its own, with two hashes and no content.
    """
    block = block_size(length)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, cores, checks, firsts, phases, contents = [], [], [], [], [], []
            asked = zip(batch.column("text").to_pylist(), batch.column("asks").to_pylist(), strict=True)
            for i, (text, asks) in enumerate(asked):
                data = utf8(text)
                for ask in asks:
                    first, more, lead = unpacked(ask["at"])
                    place = first + lead
                    if ask["crowded"]:
                        windows = [data[a : a + length] for a in range(first, first + more + 1)]
                        rows += [i] * len(windows)
                        cores += [xxhash.xxh64_intdigest(w, 1) for w in windows]
                        checks += [xxhash.xxh64_intdigest(w, 2) >> 1 for w in windows]
                        firsts += range(first, first + more + 1)
                        phases += [0] * len(windows)
                        contents += [None] * len(windows)
                        continue
                    # Windows by how far before the anchor they start, in aligned blocks of that.
                    for b in range((lead - more) // block, lead // block + 1):
                        high = place - b * block
                        low = high - block + 1
                        begin, last = max(first, low), min(first + more, high)
                        core = data[high : low + length]
                        rows.append(i)
                        checks.append(None)
                        cores.append(xxhash.xxh64_intdigest(core, (ask["anchor"] + b) & 0xFFFFFFFF))
                        firsts.append(begin)
                        phases.append(begin - low)
                        contents.append(data[begin : last + length])
            if rows:
                taken = pa.array(rows)
                arrays = [
                    pa.array(np.array(cores, dtype=np.uint64).view(np.int64)),
                    pa.array(checks, pa.int64()),
                    *(batch.column(k).take(taken) for k in _KEYS),
                    pa.array(firsts, pa.int64()),
                    pa.array(phases, pa.int32()),
                    pa.array(contents, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    kind = "core long, check long, h long, t int, first long, phase int, content binary"
    names = [c.split()[0] for c in kind.split(", ")]
    return asked.mapInArrow(cut, kind)


def _sorted_buckets(blocks: DataFrame, length: int) -> DataFrame:
    """h, t, first, n: runs of n repeated windows among those of the blocks."""

    def repeats(table: pa.Table) -> pa.RecordBatch | None:
        contents = table.column("content").to_pylist()
        sizes = np.array([len(c) for c in contents], dtype=np.int64)
        n = sizes - length + 1
        row = np.repeat(np.arange(len(n)), n)
        inner = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        starts = (np.cumsum(sizes) - sizes)[row] + inner
        # Windows are compared only with those at the same distance from the anchor.
        core = np.unique(table.column("core").to_numpy(), return_inverse=True)[1]
        group = core[row] * block_size(length) + table.column("phase").to_numpy()[row] + inner
        hit = np.flatnonzero(repeated_starts(b"".join(contents), starts, group, length))
        if not len(hit):
            return None
        row, inner = row[hit], inner[hit]
        begin = np.flatnonzero(np.append(True, (np.diff(row) != 0) | (np.diff(inner) != 1)))
        taken = pa.array(row[begin])
        arrays = [table.column(k).combine_chunks().take(taken) for k in _KEYS]
        first = table.column("first").to_numpy()[row[begin]] + inner[begin]
        return pa.RecordBatch.from_arrays(
            [*arrays, pa.array(first), pa.array(np.diff(np.append(begin, len(hit))))], names=[*_KEYS, "first", "n"]
        )

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            core = batch.column("core").to_numpy()
            # The last bucket of a batch may go on in the next one.
            cut = int(np.searchsorted(core, core[-1]))
            if cut:
                if found := repeats(pa.Table.from_batches([*held, batch.slice(0, cut)])):
                    yield found
                held = []
            elif held and held[-1].column("core")[-1].as_py() != core[-1]:
                if found := repeats(pa.Table.from_batches(held)):
                    yield found
                held = []
            held.append(batch.slice(cut))
        if held and (found := repeats(pa.Table.from_batches(held))):
            yield found

    bucketed = blocks.repartition("core").sortWithinPartitions("core")
    return bucketed.mapInArrow(sort, "h long, t int, first long, n long")


def _counted_windows(windows: DataFrame) -> DataFrame:
    """h, t, first, n of the crowded windows whose hashes are found twice or more."""
    often = windows.groupBy("core", "check").agg(F.count("*").alias("m")).filter("m > 1")
    found = windows.join(stored(often.drop("m")), ["core", "check"])
    return found.select(*_KEYS, "first", F.lit(1).cast("long").alias("n"))


def removed_bytes(runs: list | None, n: int, length: int) -> np.ndarray:
    """Which of n bytes lie in a repeated window; a run is (firsts, n) of window starts: n from
    each first."""
    steps = np.zeros(n + 1, dtype=np.int64)
    for run in runs if runs is not None else ():
        firsts = np.asarray(run["firsts"], dtype=np.int64)
        np.add.at(steps, firsts, 1)
        np.add.at(steps, firsts + run["n"] - 1 + length, -1)
    return np.cumsum(steps[:n]) > 0


def without_repeats(
    docs: DataFrame, length: int = 400, k: int = 200, texts: bool = True, bucket: int = BUCKET
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if `texts`, kept (binary): one row per
    row of docs."""
    known = _identified(docs)
    # Copies of a text are one here, reduced before they are shuffled.
    single = known.select("h", "t", "text").dropDuplicates(_KEYS)
    seeds = repeated_anchors(anchor_table(known, _KEYS, byte_tokens, length, k))
    # What follows joins stored tables, so that large keys are split between tasks.
    classes = stored(
        seeds.groupBy("anchor", "context").agg(
            F.sum(F.size("ats")).alias("members"),
            F.min(F.struct("h", "t", F.col("ats")[0].alias("at"))).alias("one"),
        )
    )
    equal = classes.filter("members > 1").select("anchor", "context")
    firsts, n = firsts_and_count(F.col("ats"))
    whole = seeds.join(equal, ["anchor", "context"]).select(*_KEYS, firsts.alias("firsts"), n.alias("n"))
    differing = stored(
        classes.groupBy("anchor")
        .agg(F.count("*").alias("n_classes"))
        .filter("n_classes > 1")
        .select("anchor", (F.col("n_classes") > bucket).alias("crowded"))
    )
    asked = classes.join(differing, "anchor").select("anchor", "one.*", "crowded")
    asks = asked.groupBy(*_KEYS).agg(F.collect_list(F.struct("anchor", "at", "crowded")).alias("asks"))
    blocks = stored(_blocks(single.join(asks, _KEYS), length))
    sorted_runs = _sorted_buckets(blocks.filter("check IS NULL").drop("check"), length)
    counted_runs = _counted_windows(blocks.filter("check IS NOT NULL"))
    extended = sorted_runs.unionByName(counted_runs).select(*_KEYS, F.array("first").alias("firsts"), "n")
    runs = (
        whole.unionByName(extended)
        .groupBy(*_KEYS)
        .agg(F.collect_set(F.struct("firsts", "n")).alias("runs"))
    )

    def keep(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for batch, matched in batches:
            rows = []
            for text, its in zip(batch, matched, strict=True):
                data = utf8(text)
                gone = removed_bytes(its, len(data), length)
                spans = int(np.count_nonzero(np.diff(gone.astype(np.int8), prepend=0) == 1))
                kept = np.frombuffer(data, dtype=np.uint8)[~gone].tobytes()
                row = (len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
                rows.append((*row, kept) if texts else row)
            yield pd.DataFrame(rows, columns=names)

    kind = "n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * texts
    names = [c.split()[0] for c in kind.split(", ")]
    cleaned = single.join(runs, _KEYS, "left").select(*_KEYS, F.pandas_udf(keep, kind)("text", "runs").alias("found"))
    return known.select("doc_id", *_KEYS).join(stored(cleaned), _KEYS).select("doc_id", "found.*")
