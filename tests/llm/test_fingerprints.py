"""Scaled sketches against plain sets, and the query's rows against its definition."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from rollcall.llm import fingerprints as fp


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def words_of(text):
    """Words end at ASCII white space; Han characters and the like are words of their own."""
    out, word = [], ""
    for c in text:
        alone = any(a <= c <= b for a, b in ("぀ヿ", "㐀䶿", "一鿿", "가힯"))
        if alone or c in "\t\n\x0b\x0c\r ":
            out += [word] if word else []
            out += [c] if alone else []
            word = ""
        else:
            word += c
    return out + ([word] if word else [])


def sketch(text, scale=8):
    words = words_of(text)
    shingles = {" ".join(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()
    hashes = {md5(s)[:16] for s in shingles}
    return sorted({h for h in hashes if int(h, 16) < 2**64 // scale}) or sorted(hashes)[:1]


def like(a, b):
    return len({*a} & {*b}) / len({*a} | {*b}) if a or b else 1.0


def expected(given):
    known = [(d, t or "") for d, t in given]
    known.sort(key=lambda r: md5(md5(r[1]) + ("" if r[0] is None else f"={r[0]}")))
    known.sort(key=lambda r: float("inf") if r[0] is None else -r[0])
    out = []
    for i, (d, text) in enumerate(known):
        following = known[(i + 1) % len(known)][1]
        k = len(text) // 3
        edited = text[: len(text) - k] + following[:k]
        own, new, after = sketch(text), sketch(edited), sketch(following)
        out.append((d, len(text), hashlib.sha256(edited.encode()).hexdigest(), "".join(own), "".join(new), like(own, new), like(own, after)))
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


@pytest.mark.parametrize("extra", [False, True])
def test_query(docs_of, rows, texts, extra):
    given = [(i * 7 % 61, t) for i, t in enumerate(texts)]
    given += [(3, texts[3])] * 3 + [(None, None), (None, ""), (None, texts[4]), (99, "漢字かな 文 test 한국어 " * 4), (100, "a b c")]
    assert rows(fp.edited_fingerprints(docs_of(given, extra=extra)), *COLUMNS) == expected(given)


def test_one_row_and_none(docs_of, rows):
    assert rows(fp.edited_fingerprints(docs_of([(5, "one two three")])), *COLUMNS) == expected([(5, "one two three")])
    assert fp.edited_fingerprints(docs_of([])).count() == 0


def test_very_long_text(docs_of, rows):
    given = [(1, " ".join(str(i * i % 9973) for i in range(120_000))), (2, "short text of six words here"), (3, "x" * 300_000)]
    assert rows(fp.edited_fingerprints(docs_of(given)), *COLUMNS) == expected(given)


def test_text_ids(docs_of):
    docs = docs_of([(1, "a b"), (2, "c d"), (None, "e f")]).withColumn("doc_id", F.concat(F.lit("d"), F.col("doc_id")))
    ids = [r.doc_id for r in fp.edited_fingerprints(docs).collect()]
    assert sorted(map(str, ids)) == ["None", "d1", "d2"]


def test_sketches_merge_and_estimate_containment(docs_of):
    r = random.Random(1)
    big = [f"w{r.randrange(5000)}" for _ in range(8000)]
    texts = [(1, " ".join(big)), (2, " ".join(big[3000:4000])), (3, " ".join(big[:4002])), (4, " ".join(big[3998:]))]
    marked = fp.with_fingerprint(docs_of(texts), "text", "f")
    f = {row.doc_id: row.f for row in marked.collect()}
    assert f[1] == "".join(sketch(texts[0][1]))
    df = marked.sparkSession.createDataFrame([(f[1], f[2], f[3], f[4])], "a string, b string, c string, d string")
    a, b, c, d = (F.col(x) for x in "abcd")
    row = df.select(
        fp.containment(b, a), fp.containment(a, b), fp.likeness(a, b), fp.merged(c, d), fp.containment(F.lit(""), a),
        fp.merged(F.lit(""), a),
    ).first()
    assert row[0] == 1.0
    assert abs(row[1] - 1 / 8) < 0.03
    assert abs(row[2] - 1 / 8) < 0.03
    # Two halves that overlap by one shingle's words hold all shingles of the whole.
    assert row[3] == f[1]
    assert (row[4], row[5]) == (1.0, f[1])


def test_stays_in_the_jvm(docs_of, texts):
    plan = fp.edited_fingerprints(docs_of(enumerate(texts)))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_texts_are_shuffled_once(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    df = fp.edited_fingerprints(docs)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "ReusedExchange" in plan
