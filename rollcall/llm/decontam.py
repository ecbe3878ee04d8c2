"""Benchmark decontamination by a q-gram filter over diagonal bands.

Texts and items are normalised: lower case, and one space for each run of other characters than
letters and digits. An item of m characters is found in a text if it aligns with a region of it
with at most e = errors * m edits. By the q-gram lemma such a region shares at least
m + 1 - q (e + 1) q-grams with the item, and their diagonals (place in the text less place in the
item) lie within e + 1 neighbouring ones. So shared q-grams are counted in overlapping bands of
2 (e + 1) diagonals, bands that reach the bound are kept, and each is verified by an alignment
confined to the band. Items shorter than q, and those that leave the bound no q-gram, have
their budget lowered until it is one at least; those shorter than q must occur as they are.

Items are taken in blocks of at most `block_chars` characters, which are sent to the tasks;
documents are read once for all blocks, and no rows are shuffled. Null and empty texts contain
nothing; null items and items without a letter or digit are left out; equal items are each
found; repeated rows give equal rows; extra columns are ignored or, by a filter, kept. Empty tables
give no matches. A very long text is scanned whole in
linear time.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.shared import text_or_empty

Q = 8  # characters of a q-gram: folded to a byte each, they are one 64-bit key
BLOCK_CHARS = 2_000_000
_TABLE_BITS = 22
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_MATCH = "array<struct<item_id: long, start: int, end: int, edits: int>>"


class _Spaces(dict):
    """Translates letters and digits to themselves and all other characters to spaces."""

    def __missing__(self, point: int) -> int:
        self[point] = point if chr(point).isalnum() else 32
        return self[point]


_SPACES = _Spaces({i: i if chr(i).isalnum() else 32 for i in range(128)})


def normalised(text: str | None) -> str:
    return " ".join((text or "").lower().translate(_SPACES).split())


def grams(text: str) -> np.ndarray:
    """A 64-bit key for the q-gram at each place; equal q-grams have equal keys."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    if len(points) < Q:
        return np.empty(0, dtype=np.uint64)
    folded = (points ^ (points >> 8)).astype(np.uint8)
    return np.ndarray((len(folded) - Q + 1,), dtype="<u8", buffer=folded.tobytes(), strides=(1,)).astype(np.uint64)


def banded_edits(item: str, region: str, low: int, high: int, most: int) -> tuple[int, int, int] | None:
    """Fewest edits that turn `item` into a part of `region`, on the diagonals low..high (place in
    the region less place in the item), with start and end of that part; None if over `most`."""
    at = region.find(item)
    if at >= 0:
        return 0, at, at + len(item)
    width, far = high - low + 1, len(item) + len(region) + 1
    chars = np.frombuffer(region.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    # cost[d] is for the cell (i, i + low + d); a path may start anywhere in the region.
    diagonals = np.arange(width)
    places = diagonals + low
    cost = np.where((places >= 0) & (places <= len(region)), 0, far)
    start = places.copy()
    for i, char in enumerate(item):
        places = i + low + diagonals  # of the character that a step along a diagonal takes
        inside = (places >= 0) & (places < len(region))
        differs = np.ones(width, dtype=np.int64)
        differs[inside] = chars[places[inside]] != ord(char)
        along = np.where(inside, cost + differs, far)
        skip = np.append(cost[1:], far) + 1  # the item's character is left out
        best = np.minimum(along, skip)
        origin = np.where(along <= skip, start, np.append(start[1:], 0))
        best[(places + 1 < 0) | (places + 1 > len(region))] = far
        # Extra characters of the region: moves to the next diagonal at one edit each.
        run = best - diagonals
        source = np.maximum.accumulate(np.where(run == np.minimum.accumulate(run), diagonals, 0))
        cost, start = run[source] + diagonals, origin[source]
        if cost.min() > most:
            return None
    d = int(cost.argmin())
    return (int(cost[d]), max(0, int(start[d])), len(item) + low + d) if cost[d] <= most else None


class Items:
    """A block of items with its q-gram index."""

    def __init__(self, items: tuple[tuple[int, str], ...], errors: float):
        self.ids = [i for i, _ in items]
        self.texts = [t for _, t in items]
        sizes = np.array([len(t) for t in self.texts], dtype=np.int64)
        self.budgets = np.minimum((errors * sizes).astype(np.int64), np.maximum(sizes // Q - 1, 0))
        self.bounds = sizes + 1 - Q * (self.budgets + 1)
        self.short = [i for i, t in enumerate(self.texts) if len(t) < Q]
        keys, owners, places = [], [], []
        for i, text in enumerate(self.texts):
            found = grams(text)
            keys.append(found)
            owners.append(np.full(len(found), i, dtype=np.int64))
            places.append(np.arange(len(found), dtype=np.int64))
        keys = np.concatenate(keys) if keys else np.empty(0, np.uint64)
        order = np.argsort(keys, kind="stable")
        self.keys, first = np.unique(keys[order], return_index=True)
        self.first = np.append(first, len(keys))
        self.owners = (np.concatenate(owners) if owners else np.empty(0, np.int64))[order]
        self.places = (np.concatenate(places) if places else np.empty(0, np.int64))[order]
        self.maybe = np.zeros(1 << _TABLE_BITS, dtype=bool)
        self.maybe[self._slots(self.keys)] = True
        self.least = int(self.bounds[sizes >= Q].min()) if (sizes >= Q).any() else 1 << 62

    @staticmethod
    def _slots(keys: np.ndarray) -> np.ndarray:
        return ((keys * _SPREAD) >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)

    def find(self, text: str) -> list[dict]:
        """All items found in a normalised text."""
        out = [(i, (0, at, at + len(self.texts[i]))) for i in self.short if (at := text.find(self.texts[i])) >= 0]
        keys = grams(text)
        at = np.flatnonzero(self.maybe[self._slots(keys)])
        if len(at) >= self.least:
            out += self._bands(text, keys[at], at)
        return [
            {"item_id": self.ids[i], "start": a, "end": b, "edits": e}
            for i, (e, a, b) in sorted(out)
        ]

    def _bands(self, text: str, keys: np.ndarray, at: np.ndarray) -> list:
        slot = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        known = self.keys[slot] == keys
        slot, at = slot[known], at[known]
        n = self.first[slot + 1] - self.first[slot]
        ends = np.cumsum(n)
        if not len(n):
            return []
        posting = np.arange(ends[-1]) - np.repeat(ends - n, n) + np.repeat(self.first[slot], n)
        item, diagonal = self.owners[posting], np.repeat(at, n) - self.places[posting]
        # Only items with enough hits in the whole text can reach their bound in a band.
        enough = np.bincount(item, minlength=len(self.ids)) >= self.bounds
        chosen = enough[item]
        item, diagonal = item[chosen], diagonal[chosen]
        if not len(item):
            return []
        width = self.budgets[item] + 1
        band = (diagonal + len(text) + 4 * width) // width  # shifted to be positive
        span = np.int64(2 * len(text) + (1 << 20))
        # A hit counts for its own band and for the one before, which overlaps it.
        own = item * span + band
        bands, counts = np.unique(np.concatenate([own, own - 1]), return_counts=True)
        bands = bands[counts >= self.bounds[bands // span]]
        if not len(bands):
            return []
        own_order = np.argsort(own, kind="stable")
        own, diagonal, place = own[own_order], diagonal[own_order], self.places[posting][chosen][own_order]
        found: dict[int, tuple[int, int, int]] = {}
        for key in bands.tolist():
            i, b = divmod(key, int(span))
            e, item_text = int(self.budgets[i]), self.texts[i]
            hits = slice(*np.searchsorted(own, [key, key + 2]))
            if i in found and found[i][0] == 0 or not self._shares(i, diagonal[hits], place[hits]):
                continue
            # A band covers diagonals low .. low + 2 (e + 1) - 1; an alignment may leave it by e.
            low = b * (e + 1) - len(text) - 4 * (e + 1)
            high = low + 2 * (e + 1) - 1
            a = max(0, low - e)
            region = text[a : max(0, high + len(item_text) + e + 1)]
            edits = banded_edits(item_text, region, low - e - a, high + e - a, e)
            if edits and (i not in found or edits[0] < found[i][0]):
                found[i] = (edits[0], a + edits[1], a + edits[2])
        return list(found.items())


    def _shares(self, i: int, diagonal: np.ndarray, place: np.ndarray) -> bool:
        """Whether e + 1 neighbouring diagonals hold enough different q-grams of the item."""
        order = np.argsort(diagonal, kind="stable")
        diagonal, place = diagonal[order], place[order]
        ends = np.searchsorted(diagonal, diagonal + self.budgets[i], "right")
        for first in np.flatnonzero(ends - np.arange(len(ends)) >= self.bounds[i]).tolist():
            if len(np.unique(place[first : ends[first]])) >= self.bounds[i]:
                return True
        return False


@lru_cache(maxsize=4)
def _indexed(items: tuple[tuple[int, str], ...], errors: float) -> Items:
    return Items(items, errors)


def _matches(items: tuple[tuple[int, str], ...], errors: float) -> Column:
    def find(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index = _indexed(items, errors)
        for batch in texts:
            yield pd.Series([index.find(normalised(t)) for t in batch])

    return F.pandas_udf(find, _MATCH)(text_or_empty())


def matches_of(benchmark: DataFrame, errors: float = 0.1, block_chars: int = BLOCK_CHARS) -> Column:
    """Of the column text: item, start and end in the normalised text, and edits of each match."""
    usable = benchmark.select(F.col("item_id").cast("long"), "text").filter("text IS NOT NULL")
    chars = usable.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-2 * chars // block_chars))
    found = F.array().cast(_MATCH)
    for block in range(blocks):
        rows = usable.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        named = ((r["item_id"], t) for r in rows if (t := normalised(r["text"])))
        items = sorted(named, key=lambda x: (x[0] is None, x[0] or 0, x[1]))
        if items:
            found = F.concat(found, _matches(tuple(items), errors))
    return found


def contaminated_docs(docs: DataFrame, benchmark: DataFrame, errors: float = 0.1) -> DataFrame:
    """doc_id, contaminated, n_items, items (ascending ids, joined by commas): one row per row of docs."""
    found = docs.select("doc_id", matches_of(benchmark, errors).alias("matches"))
    ids = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["item_id"])))
    return found.select("doc_id", ids.alias("ids")).select(
        "doc_id",
        (F.size("ids") > 0).alias("contaminated"),
        F.size("ids").cast("long").alias("n_items"),
        F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("items"),
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, errors: float = 0.1) -> DataFrame:
    """The rows of docs that hold no item."""
    return docs.filter(F.size(matches_of(benchmark, errors)) == 0)
