"""Periodic runs against brute force."""

import hashlib
import random
import zlib

import numpy as np

from rollcall.llm import periods


def all_runs(words, least):
    """By trying every period and every place."""
    n, found = len(words), []
    for p in range(1, n // 2 + 1):
        i = 0
        while i < n - p:
            j = i
            while j < n - p and words[j] == words[j + p]:
                j += 1
            length = j - i + p
            smaller = any(
                all(words[k] == words[k + q] for k in range(i, i + length - q)) for q in range(1, p)
            )
            if j > i and length >= max(least, 2 * p) and not smaller:
                found.append((i, length, p))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def digests(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = all_runs(words, 12)
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
    gone = {i for s, length, p in runs for i in range(s + p, s + length)}
    lines = "".join(f"{s},{length},{p}\n" for s, length, p in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    milli = 1000 * best[1] // best[2] if runs else None
    digest = [hashlib.sha256(x).hexdigest() for x in (lines.encode(), kept)]
    return (doc_id, len(runs), *best, milli, *digest)


def test_runs_of_short_sequences():
    r = random.Random(5)
    for _ in range(1500):
        letters, n = r.choice([1, 2, 2, 3, 5]), r.randint(0, 60)
        words = [b"%d" % r.randrange(letters) for _ in range(n)]
        if r.random() < 0.5 and n > 4:
            p, a = r.randint(1, n // 2), r.randint(0, n // 2)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        least = r.choice([2, 3, 6, 12])
        assert [tuple(x) for x in periods.text_runs(words, least).tolist()] == all_runs(words, least)


def test_extensions_of_suffixes():
    r = random.Random(2)
    for _ in range(50):
        s = [r.randint(1, 3) for _ in range(r.randint(1, 40))] + [0]
        extension = periods.Extensions(periods.SuffixTree(s, 4))
        pairs = [(a, b) for a in range(len(s)) for b in range(len(s)) if a != b]
        got = extension(*np.array(pairs).T)
        for (a, b), found in zip(pairs, got.tolist(), strict=True):
            assert s[a : a + found] == s[b : b + found]
            assert s[a + found] != s[b + found]
        assert extension.rank.tolist() == [sorted(s[k:] for k in range(len(s))).index(s[i:]) for i in range(len(s))]


def test_query(docs_of, rows, texts):
    r = random.Random(3)
    loop = [f"w{i}" for i in range(9)]
    more = [" ".join(loop * 3), " ".join(loop[:4] * 40), "a\x0bb\x1ca " * 9, "é ü " * 7, " ".join(r.choice("ab") for _ in range(300))]
    given = [*enumerate(texts + more), *((i, t) for i, t in enumerate(texts, 1000)), (3, texts[3]), (None, None), (None, more[0]), (70, None)]
    assert any(zlib.crc32(str(d).encode()) % 10 == 0 and t for d, t in given)
    columns = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = rows(periods.period_digests(docs_of(given, extra=True)), *columns)
    assert got == sorted((digests(d, t) for d, t in given), key=repr)


def test_very_long_and_empty(docs_of):
    long = " ".join(str(i % 4000) for i in range(60_000))
    found = periods.with_runs(docs_of([(1, long), (2, long + " x" * 11)])).select("found.runs").collect()
    assert [[tuple(run) for run in row[0]] for row in found] == [[(0, 60_000, 4000)]] * 2
    assert periods.period_digests(docs_of([])).count() == 0


def test_text_ids_and_extra_columns(docs_of):
    docs = docs_of([(1, "a " * 12), (None, "a " * 12)]).selectExpr("concat('d', doc_id) AS doc_id", "text", "1 AS found", "2 AS words")
    assert sorted((r.doc_id or "", r.n_runs) for r in periods.period_digests(docs).collect()) == [("", 1), ("d1", 1)]
