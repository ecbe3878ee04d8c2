"""Substring removal and suffix sorting against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from rollcall.llm import seeds, substrings, suffixes, winnowing


def by_words(rows, length):
    words = [(d, (t or "").encode().split()) for d, t in rows]
    first = {}
    for d, w in words:
        for i in range(len(w) - length + 1):
            key = tuple(w[i : i + length])
            if d is not None:
                first[key] = min(first.get(key, d), d)
    out = []
    for d, w in words:
        gone = set()
        for i in range(len(w) - length + 1):
            if d is not None and first[tuple(w[i : i + length])] < d:
                gone |= set(range(i, i + length))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def by_bytes(rows, length):
    data = [(d, (t or "").encode()) for d, t in rows]
    found = Counter(b[i : i + length] for _, b in data for i in range(len(b) - length + 1))
    out = []
    for d, b in data:
        gone = np.zeros(len(b) + 1, dtype=bool)
        for i in range(len(b) - length + 1):
            if found[b[i : i + length]] > 1:
                gone[i : i + length] = True
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        kept = bytes(c for c, g in zip(b, gone, strict=False) if not g)
        out.append((d, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def given(texts):
    return [*enumerate(texts), (3, texts[3]), (None, None), (None, texts[35]), (7, texts[36])]


def test_seed_and_extend(docs_of, rows, given):
    for length, k in ((50, 25), (20, 5)):
        got = rows(substrings.without_repeats(docs_of(given, extra=True), length, k, texts=False))
        assert got == by_words(given, length)


def test_deep_and_shallow(docs_of, rows, given):
    for length, k in ((400, 200), (100, 30)):
        for bucket in (2, 1000):  # crowded anchors, and none
            df = docs_of(given, extra=True)
            got = rows(suffixes.without_repeats(df, length, k, texts=False, bucket=bucket))
            assert got == by_bytes(given, length)


def test_kept_texts(docs_of):
    long = " ".join(f"w{i}" for i in range(60))
    df = docs_of([(1, long), (2, f"x {long} y")])
    assert {r[0]: r[4] for r in substrings.without_repeats(df).collect()} == {1: long, 2: "x y"}
    text = "".join(chr(33 + i * 7 % 90) + str(i) for i in range(200))
    kept = {r[0]: bytes(r[5]) for r in suffixes.without_repeats(docs_of([(1, text), (2, f"é{text}")])).collect()}
    assert kept == {1: b"", 2: "é".encode()}


def test_empty(docs_of):
    for module in (substrings, suffixes):
        assert module.without_repeats(docs_of([])).count() == 0


def test_a_text_that_repeats_itself_sends_one_row_to_a_key(docs_of, rows):
    given = [(1, "a" * 3000), (2, "a" * 700 + "b" * 500), (3, "xyz " * 300), (4, None)]
    docs = docs_of(given)
    for tokens, length, k in ((suffixes.byte_tokens, 400, 200), (substrings.word_hashes, 50, 25)):
        table = seeds.anchor_table(docs.fillna(""), ["doc_id"], tokens, length, k)
        keys = rows(table, "doc_id", "anchor", "context")
        assert keys and len(set(keys)) == len(keys)
    assert rows(suffixes.without_repeats(docs, texts=False)) == by_bytes(given, 400)
    words = [(d, (t or "").replace("a", "a ")) for d, t in given]
    assert rows(substrings.without_repeats(docs_of(words), texts=False)) == by_words(words, 50)


def test_windows_are_sorted_into_equals():
    r = random.Random(1)
    for _ in range(100):
        length = r.choice([8, 9, 16, 40])
        base = [bytes(r.choice(b"abc") for _ in range(60)) for _ in range(3)]
        data = b"".join(r.choice(base)[r.randint(0, 20) : r.randint(30, 60)] for _ in range(12))
        starts = np.arange(len(data) - length + 1)
        got = suffixes.repeated_starts(data, starts, np.zeros(len(starts), dtype=np.int64), length)
        found = Counter(data[i : i + length] for i in starts)
        assert got.tolist() == [found[data[i : i + length]] > 1 for i in starts]


def test_anchors_are_the_leftmost_least():
    r = np.random.default_rng(3)
    for n, width in ((1, 1), (5, 7), (40, 6), (300, 26)):
        grams = r.integers(0, 5, n).astype(np.uint64)
        order = winnowing.spread(grams) >> np.uint64(32)
        places, first, last = winnowing.anchors(grams, width)
        chosen = {s: int(p) for p, a, b in zip(places, first, last, strict=True) for s in range(a, b + 1)}
        assert chosen == {s: s + int(np.argmin(order[s : s + width])) for s in range(n - width + 1)}
