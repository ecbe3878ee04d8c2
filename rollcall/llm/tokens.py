"""Token counts by heap-and-linked-list byte-pair merging.

A text falls into special strings, which count one token each, and ordinary words. The symbols of
a word (its UTF-8 bytes, the last one marked as the end) form a linked list; a heap holds the
adjacent pairs that have a merge. The pair of lowest rank, leftmost first, is merged until none is
left. The count is the number of symbols less the number of merges; no token ids are emitted.

Nulls count as empty texts and empty texts have no tokens. Repeated rows are counted row by row,
other columns are ignored, an empty table gives an empty result. A text of any length takes
O(n log n): a word is merged on a heap, and equal words are merged once per worker.
"""

from __future__ import annotations

import heapq
import json
import os
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.shared import text_or_empty

#: Equal words are merged once per worker; the table of counts starts anew at this size.
REMEMBERED_WORDS = 500_000
_LONGEST_REMEMBERED = 100


def _locate(vocabulary: str) -> str:
    """A path, or the name of a file of the installed public vocabularies."""
    if os.sep in vocabulary:
        return vocabulary
    import public_tokenizers

    return public_tokenizers.path(vocabulary)


def _byte_characters() -> dict[int, str]:
    """Byte-level vocabularies write printable bytes as themselves, others as characters from 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def merge_count(symbols: list[int], merges: dict[tuple[int, int], tuple[int, int]]) -> int:
    """How many merges a word takes, lowest rank first and leftmost among equal ranks."""
    size = len(symbols)
    after, before = list(range(1, size + 1)), list(range(-1, size - 1))
    heap = [
        (*found, i)
        for i in range(size - 1)
        if (found := merges.get((symbols[i], symbols[i + 1])))
    ]
    heapq.heapify(heap)
    gone, done = -1, 0
    while heap:
        _, merged, i = heapq.heappop(heap)
        j = after[i]
        if symbols[i] == gone or j >= size:
            continue
        found = merges.get((symbols[i], symbols[j]))
        if not found or found[1] != merged:
            continue
        done += 1
        symbols[i], symbols[j] = merged, gone
        after[i] = k = after[j]
        if k < size:
            before[k] = i
            if found := merges.get((merged, symbols[k])):
                heapq.heappush(heap, (*found, i))
        h = before[i]
        if h >= 0 and (found := merges.get((symbols[h], merged))):
            heapq.heappush(heap, (*found, h))
    return done


class Vocabulary(dict):
    """Merges of a word-end BPE file; as a dictionary, the token count of each run without white space."""

    def __init__(self, vocabulary: str):
        with open(_locate(vocabulary), encoding="utf-8") as file:
            spec = json.load(file)
        model, ids = spec["model"], spec["model"]["vocab"]
        if model["type"] != "BPE" or not model["end_of_word_suffix"] or model["ignore_merges"]:
            raise ValueError("a BPE vocabulary with word ends and merges is needed")
        pairs = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        self.merges = {(ids[a], ids[b]): (r, ids[a + b]) for r, (a, b) in enumerate(pairs)}
        end, chars = model["end_of_word_suffix"], _byte_characters()
        self.inner = [ids[chars[b]] for b in range(256)]
        self.last = [ids[chars[b] + end] for b in range(256)]
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = regex.compile(split.replace(r"\s", r"\p{White_Space}"))
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, special)) or r"(?!)")
        self.of_word: dict[str, int] = {}

    def count(self, text: str) -> int:
        # Every special string counts one; what stands between two is a text of its own.
        parts = self.special.split(text)
        # str.split() also cuts at four separators that are no white space here.
        return len(parts) - 1 + sum(
            sum(map(self.__getitem__, part.split()))
            if not _SEPARATORS.search(part)
            else self._count_runs(part)
            for part in parts
        )

    def __missing__(self, run: str) -> int:
        if len(self) > REMEMBERED_WORDS:
            self.clear()
        n = self._count_runs(run)
        if len(run) <= _LONGEST_REMEMBERED:
            self[run] = n
        return n

    def _count_runs(self, text: str) -> int:
        if not text.isascii():
            # Lower case goes by single characters, so sigma has no special form at a word's end.
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return sum(map(self._count_word, self.words.findall(text.lower())))

    def _count_word(self, word: str) -> int:
        n = self.of_word.get(word)
        if n is None:
            data = word.encode("utf-8", "surrogatepass")
            symbols = [self.inner[b] for b in data[:-1]] + [self.last[data[-1]]]
            n = len(symbols) - merge_count(symbols, self.merges)
            if len(self.of_word) > REMEMBERED_WORDS:
                self.of_word.clear()
            if len(word) <= _LONGEST_REMEMBERED:
                self.of_word[word] = n
        return n


_SEPARATORS = regex.compile("[\x1c-\x1f]")


@lru_cache
def loaded(vocabulary: str) -> Vocabulary:
    """One for each worker."""
    return Vocabulary(vocabulary)


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens and whether a document is over the limit, one row per row of docs."""

    def counted(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        count = loaded(vocabulary).count
        for batch in texts:
            yield pd.Series([count(t) for t in batch], dtype="int64")

    n_tokens = F.pandas_udf(counted, "long")
    text = text_or_empty()
    return docs.select(
        "doc_id",
        F.octet_length(text).cast("long").alias("n_bytes"),
        n_tokens(text).alias("n_tokens"),
    ).withColumn("over_limit", F.col("n_tokens") > limit)
