"""Periodic runs of words, from suffix trees and Lyndon roots.

A run is a stretch of words with a smallest period q, at least twice as long as that and at least
`LEAST` words long, that no neighbouring word extends. Every run has a Lyndon root: for one of two
orders of the words (some order and its reverse, the end of the text least in both) there is a
place whose longest Lyndon word is one period of the run. That word ends where the next smaller
suffix begins, so two candidates for each place are enough. A candidate is extended to the right by the
common extension of two suffixes and to the left by that of two prefixes; if both together are a
period or more, it is a run.

Common extensions take constant time: Ukkonen's tree of the words (and of their reversal) is walked
by an Euler tour, and the extension of two suffixes is the depth of their lowest common ancestor,
the least depth that the tour passes between their leaves, looked up in a sparse table. The order in
which the tour meets the leaves is the order of suffixes; a tour that takes children the other way
round gives the reverse order.

Trees are built where a run can be and not for every word: a run that is long enough repeats each six
words of it one period on, so it lies within a stretch covered by six-word sequences that are
found twice in the stretch (compared by hash; a collision only makes a stretch longer). Texts
without such a stretch have no run and need no tree.

Nulls count as empty texts and have no words. Repeated rows are treated row by row, extra columns are
kept by `with_runs` and ignored by `period_digests`, an empty table gives an empty result. A text of any
length takes linear time for its trees and O(n log n) for the table of depths.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.shared import WORD, text_or_empty, word_list
from rollcall.llm.winnowing import spread

#: Words of the shortest run.
LEAST = 12
_ROUNDS = 4
_BASE = np.uint64(0x9E3779B97F4A7C15)
_KIND = "struct<n_words: long, runs: array<struct<start: long, length: long, period: long>>, collapsed: string>"


class SuffixTree:
    """Ukkonen's suffix tree; the last symbol is 0 and found nowhere else, the others are 1 .. size - 1.

    Node 0 is the root. The edge into a node holds symbols[start:end], `child` leads from
    node * size + symbol to the node at the end of the edge that begins with the symbol.
    """

    def __init__(self, symbols: list[int], size: int):
        self.n, self.size = len(symbols), size
        start, end, link, child = [0], [0], [0], {}
        n, node, edge, matched, pending = len(symbols), 0, 0, 0, 0
        for place, symbol in enumerate(symbols):
            pending += 1
            unlinked = 0
            while pending:
                if not matched:
                    edge = place
                key = node * size + symbols[edge]
                below = child.get(key)
                if below is None:
                    child[key] = len(start)
                    start.append(place)
                    end.append(n)
                    link.append(0)
                    at = node
                else:
                    begin = start[below]
                    long = min(end[below], place + 1) - begin
                    if matched >= long:  # walk down the whole edge
                        edge += long
                        matched -= long
                        node = below
                        continue
                    if symbols[begin + matched] == symbol:
                        if unlinked:
                            link[unlinked] = node
                        matched += 1
                        break
                    at = len(start)
                    start += (begin, place)
                    end += (begin + matched, n)
                    link += (0, 0)
                    child[key] = at
                    child[at * size + symbol] = at + 1
                    start[below] = begin + matched
                    child[at * size + symbols[begin + matched]] = below
                if unlinked:
                    link[unlinked] = at
                unlinked = at
                pending -= 1
                if node:
                    node = link[node]
                elif matched:
                    matched -= 1
                    edge = place - pending + 1
        self.start, self.end = start, end
        self.keys = np.fromiter(child.keys(), dtype=np.int64, count=len(child))
        self.below = np.fromiter(child.values(), dtype=np.int64, count=len(child))

    def tour(self, reverse: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """The suffixes in the order of an Euler tour, and for each the least depth that the tour
        has passed since the one before. The end of the text is the least symbol either way."""
        nodes, symbols = np.divmod(self.keys, self.size)
        order = np.argsort(nodes * self.size + (-symbols % self.size if reverse else symbols))
        children = self.below[order].tolist()
        first = np.searchsorted(nodes[order], np.arange(len(self.start) + 1)).tolist()
        start, end, n = self.start, self.end, self.n
        leaves, least = [], []
        todo = [(0, 0, 0)]
        while todo:
            node, depth, passed = todo.pop()
            depth += end[node] - start[node]
            a, b = first[node], first[node + 1]
            if a == b:
                leaves.append(n - depth)
                least.append(passed)
                continue
            # Between two children the tour comes back to their parent.
            todo += [(children[k], depth, depth) for k in range(b - 1, a, -1)]
            todo.append((children[a], depth, passed))
        return np.array(leaves), np.array(least, dtype=np.int32)


class Extensions:
    """How many symbols two suffixes have in common, for arrays of pairs of their starts."""

    def __init__(self, tree: SuffixTree):
        leaves, least = tree.tour()
        self.rank = np.empty(len(leaves), dtype=np.int64)
        self.rank[leaves] = np.arange(len(leaves))
        self.table = [least]
        width = 1
        while 2 * width <= len(least):
            last = self.table[-1]
            self.table.append(np.minimum(last[:-width], last[width:]))
            width *= 2

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """`a` and `b` must differ in every pair."""
        a, b = self.rank[a], self.rank[b]
        low, high = np.minimum(a, b) + 1, np.maximum(a, b) + 1
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        found = np.empty(len(a), dtype=np.int64)
        for i in np.unique(level).tolist():
            here, depths = level == i, self.table[i]
            found[here] = np.minimum(depths[low[here]], depths[high[here] - (1 << i)])
        return found


def next_smaller(rank: list[int]) -> np.ndarray:
    """For each place but the last, the next one of smaller rank; the last has the least."""
    found, open_ = [0] * (len(rank) - 1), []
    for i, r in enumerate(rank):
        while open_ and rank[open_[-1]] > r:
            found[open_.pop()] = i
        open_.append(i)
    return np.array(found, dtype=np.int64)


def runs_of(words: np.ndarray, least: int = LEAST) -> np.ndarray:
    """Rows of start, length, period: the runs of a sequence of numbers from 1, by start and period."""
    n, size = len(words), int(words.max()) + 1
    tree = SuffixTree([*words.tolist(), 0], size)
    right = Extensions(tree)
    leaves = tree.tour(reverse=True)[0]
    opposite = np.empty(n + 1, dtype=np.int64)
    opposite[leaves] = np.arange(n + 1)
    del tree
    left = Extensions(SuffixTree([*words[::-1].tolist(), 0], size))
    begin = np.tile(np.arange(n), 2)
    end = np.concatenate([next_smaller(right.rank.tolist()), next_smaller(opposite.tolist())])
    period = end - begin
    start = begin - left(n - begin, n - end)
    length = end + right(begin, end) - start
    runs = np.stack([start, length, period], axis=1)[length >= np.maximum(2 * period, least)]
    runs = np.unique(runs, axis=0)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def stretches(words: np.ndarray, least: int = LEAST) -> list[tuple[int, int]]:
    """Where runs can be: begin and end of stretches covered by sequences of half a run's least
    length that are found twice in the stretch."""
    width = (least + 1) // 2
    n = len(words) - width + 1
    if n < 2:
        return []
    grams = np.zeros(n, dtype=np.uint64)
    tokens = spread(words.astype(np.uint64) * _BASE)
    for k in range(width):
        grams = grams * _BASE + tokens[k : k + n]
    label = np.zeros(n, dtype=np.int64)
    code = np.unique(grams, return_inverse=True)[1]
    places = np.arange(n)
    for _ in range(_ROUNDS):
        group = np.unique(code[places] * (n + 1) + label[places], return_inverse=True)[1]
        often = places[np.bincount(group)[group] > 1]
        if not len(often):
            return []
        # Words that are covered, and the stretch of each sequence that is found often.
        steps = np.zeros(len(words) + 1, dtype=np.int64)
        np.add.at(steps, often, 1)
        np.add.at(steps, often + width, -1)
        covered = np.cumsum(steps[:-1]) > 0
        edges = np.flatnonzero(np.diff(covered.astype(np.int8), prepend=0, append=0))
        begins, ends = edges[::2], edges[1::2]
        label = np.cumsum(np.bincount(begins, minlength=n)[:n])
        done = len(often) == len(places)
        places = often
        if done:
            break
    return [(a, b) for a, b in zip(begins.tolist(), ends.tolist(), strict=True) if b - a >= least]


def text_runs(words: list[bytes], least: int = LEAST) -> np.ndarray:
    """Rows of start, length, period of the runs of a text's words."""
    numbers: dict[bytes, int] = {}
    coded = np.fromiter((numbers.setdefault(w, len(numbers) + 1) for w in words), dtype=np.int64, count=len(words))
    found = [np.empty((0, 3), dtype=np.int64)]
    for a, b in stretches(coded, least):
        part = np.unique(coded[a:b], return_inverse=True)[1] + 1
        runs = runs_of(part, least)
        runs[:, 0] += a
        found.append(runs)
    return np.concatenate(found)


def collapsed(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    if not len(runs):
        return words
    steps = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(steps, runs[:, 0] + runs[:, 2], 1)
    np.add.at(steps, runs[:, 0] + runs[:, 1], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(steps[:-1]) == 0).tolist()]


def with_runs(docs: DataFrame, least: int = LEAST, name: str = "found") -> DataFrame:
    """docs and a struct of n_words, runs (by start and period) and the collapsed text."""

    def find(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch:
                words = word_list(text)
                runs = text_runs(words, least)
                kept = b" ".join(collapsed(words, runs)).decode("utf-8", "surrogatepass")
                shown = [dict(zip(("start", "length", "period"), run, strict=True)) for run in runs.tolist()]
                rows.append((len(words), shown, kept))
            yield pd.DataFrame(rows, columns=["n_words", "runs", "collapsed"])

    return docs.withColumn(name, F.pandas_udf(find, _KIND)("text"))


def made_periodic(docs: DataFrame) -> DataFrame:
    """doc_id, text: every text whose doc_id has a CRC-32 that ends in 0 repeats itself from some word on.

    Word i >= a becomes word a + (i - a) % p; a and p follow from the other digits of the CRC-32
    and from the number of words. Rows without a doc_id stay as they are.
    """
    digits = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = F.coalesce(digits % 10 == 0, F.lit(False))
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    g, n, a, p = (F.col(c) for c in ("g", "n", "a", "p"))
    i = F.sequence(F.lit(0).cast("long"), n - 1)
    # Plain columns here, so that a text is split once and not for each of its words.
    rows = docs.select("doc_id", "text", F.expr("crc32(cast(cast(doc_id AS string) AS binary)) div 10").alias("g"), F.when(chosen, words).alias("words"))
    rows = rows.withColumn("n", F.size("words").cast("long")).withColumn("a", F.when(n > 0, g % n))
    rows = rows.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    taken = F.transform(i, lambda i: F.get("words", F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")))
    return rows.select("doc_id", F.when(n > 0, F.array_join(taken, " ")).otherwise(F.col("text")).alias("text"))


def period_digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256, n_words:
    one row per row of docs, of the texts that `made_periodic` gives."""
    texts = made_periodic(docs.select("doc_id", text_or_empty().alias("text")))
    runs = F.col("found.runs")
    lines = F.transform(runs, lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    written = F.array_join(F.transform(lines, lambda line: F.concat(line, F.lit("\n"))), "")
    best = F.array_min(F.transform(runs, lambda r: F.struct((-r["length"]).alias("less"), r["start"], r["period"])))
    rows = with_runs(texts).select("doc_id", "found", best.alias("best"))
    length = -F.col("best.less")
    return rows.select(
        "doc_id",
        F.size("found.runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        length.alias("length"),
        F.col("best.period").alias("period"),
        F.expr("-1000 * best.less div best.period").alias("exponent_milli"),
        F.sha2(written, 256).alias("runs_sha256"),
        F.sha2("found.collapsed", 256).alias("collapsed_sha256"),
        F.col("found.n_words").alias("n_words"),
    )
