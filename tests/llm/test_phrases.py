"""Collocations against a plain count of all phrases."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from rollcall.llm import phrases

LEAST = 4
COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def counts(given):
    found, places, total = Counter(), defaultdict(set), Counter()
    for doc_id, text, lang in given:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        at = 0
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text):
            words = re.findall("[^ \t]+", piece)
            total[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    key = (lang, " ".join(words[i : i + k]))
                    found[key] += 1
                    places[key].add((doc_id, at + i))
            at += len(words)
    return found, places, total


def expected(given, listed=2000, within=80):
    found, _, total = counts(given)
    rows = []
    frequent = {key: a for key, a in found.items() if a >= LEAST and " " in key[1]}
    for (lang, phrase), a in frequent.items():
        words = phrase.split(" ")
        cuts = []
        for k in range(1, len(words)):
            left, r = found[lang, " ".join(words[:k])], found[lang, " ".join(words[k:])]
            cuts.append((2000000 * a // (left + r), k, left, r))
        score, _, left, r = min(cuts)
        longer = any(
            other == lang and len(text.split(" ")) > len(words) and f" {phrase} " in f" {text} " and 100 * b >= within * a
            for (other, text), b in frequent.items()
        )
        if not longer:
            rows.append((lang, -score, -a, phrase.encode(), left, r))
    out, rank = [], Counter()
    for lang, score, a, phrase, left, r in sorted(rows, key=lambda x: x[:4]):
        rank[lang] += 1
        if rank[lang] <= listed:
            out.append((lang, rank[lang], phrase.decode(), -a, left, r, total[lang], -score))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def given():
    r = random.Random(11)
    words = ["The", "of", "new", "york", "Größe", "λ", "state", "x", "été", "ß"]
    ends = [" ", " ", " ", " ", "  ", "\t", ". ", "\n", ", ", "!?"]
    rows = []
    for i in range(150):
        text = "".join(r.choice(words) + r.choice(ends) for _ in range(r.randint(0, 60)))
        rows.append((i * 13 % 151, text + r.choice(["", "New York State of the Art. "]), r.choice(["en", "en", "de", "", None])))
    rows += [(3, None, "en"), (None, "new york " * 9, None), (4, "of the", "und")] + [rows[5]] * 6
    return rows


def docs_from(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


@pytest.mark.parametrize("bits", [2, 26])  # a filter where everything collides, and an ordinary one
def test_collocations(spark, rows, given, bits):
    docs = docs_from(spark, given).selectExpr("*", "'x' AS phrase", "1 AS n", "2 AS k")
    got = phrases.collocations(docs, LEAST, filter_bits=bits)
    assert rows(got, *COLUMNS) == expected(given)
    places = counts(given)[1]
    assert all((r.doc_id, r.word) in places[r.lang, r.phrase] for r in got.collect())


def test_few_are_listed(spark, rows, given):
    docs = docs_from(spark, given).repartition(5)
    assert rows(phrases.collocations(docs, LEAST, listed=7, within=60), *COLUMNS) == expected(given, 7, 60)


def test_empty(spark):
    assert phrases.collocations(docs_from(spark, [])).count() == 0
    assert phrases.collocations(docs_from(spark, [(1, None, None), (2, "", "en"), (None, " \n", "en")])).count() == 0


def test_text_ids(spark):
    docs = spark.createDataFrame([(f"d{i}", "so called", "en") for i in range(40)] + [(None, "so called", "en")], "doc_id string, text string, lang string")
    row = phrases.collocations(docs).first()
    assert tuple(row)[:8] == ("en", 1, "so called", 41, 41, 41, 82, 1000000) and row.word == 0


def test_exact_scores_beyond_64_bits(spark):
    big = 5_000_000_000_000
    rows = [("en", 1, "a", 2 * big + 1), ("en", 1, "b", big), ("en", 2, "a b", big)]
    found = spark.createDataFrame([(*r, 1, 0) for r in rows], "lang string, k int, phrase string, a long, doc_id long, word long")
    assert [int(r.score) for r in phrases.scored(found).collect()] == [2_000_000 * big // (3 * big + 1)]


def test_colliding_fingerprints_are_told_apart():
    texts = ["a b a b c a b", "b a b a a"]
    words = phrases.split_words(texts, ["en", "en"])
    words.hashes = np.zeros_like(words.hashes)
    for k in (1, 2, 3):
        fp, check, n, first = words.grouped(k, words.phrases(k)[1])
        assert len(set(fp.tolist())) == 1 and len(set(check.tolist())) == len(check)
        plain = Counter(" ".join(w[i : i + k]) for w in (t.split() for t in texts) for i in range(len(w) - k + 1))
        assert dict(zip(words.texts(first, k), n.tolist(), strict=True)) == plain


def test_windows_and_groups(spark, rows, monkeypatch, given):
    plain = phrases.split_words([t or "" for _, t, _ in given], ["en"] * len(given))
    monkeypatch.setattr(phrases, "_WINDOW", 7)
    windowed = phrases.split_words([t or "" for _, t, _ in given], ["en"] * len(given))
    assert plain.hashes.tolist() == windowed.hashes.tolist()


def test_a_very_long_text(spark, rows):
    r = random.Random(4)
    text = " ".join(r.choice(["a", "b", "c", "d.", "e"]) for _ in range(200_000))
    found, _, total = counts([(1, text, "en")])
    got = {row.phrase: (row.a, row.n) for row in phrases.collocations(docs_from(spark, [(1, text, "en")])).collect()}
    assert got and all(a == found["en", phrase] and n == total["en"] for phrase, (a, n) in got.items())
