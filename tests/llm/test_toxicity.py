import random

import pytest

from rollcall.llm import toxicity


def highest_parts(s):
    """Maximal segments by their recursive definition."""

    def parts(low, high):
        best = None
        for a in range(low, high):
            total = 0.0
            for b in range(a, high):
                total += s[b]
                if total > 1e-9 and (best is None or total > best[2] + 1e-9):
                    best = (a, b + 1, total)
        return [] if best is None else [*parts(low, best[0]), best[:2], *parts(best[1], high)]

    return parts(0, len(s))


def test_segments_are_the_maximal_ones():
    r = random.Random(3)
    for _ in range(500):
        s = [r.uniform(-3, 2.5) for _ in range(r.randint(0, 12))]
        assert [x[:2] for x in toxicity.maximal_segments(s)] == highest_parts(s)


@pytest.fixture(scope="module")
def tables(spark):
    return [spark.read.parquet(f"/root/testdata/sf0.01/{n}.parquet") for n in ("documents", "labels")]


def test_held_out_accuracy(tables):
    docs, labels = tables
    found = toxicity.toxic_scores(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    right = sum(r.predicted == r.toxic for r in found)
    assert right >= 0.95 * len(found)
    assert all(0 <= r.score <= 1 and (r.predicted == 1) == (r.score >= 0.5) for r in found)
    assert all(r.passages for r in found if r.score > 0.9)


def test_held_out_labels_and_other_columns_do_not_matter(tables, rows):
    docs, labels = tables
    flipped = labels.selectExpr("doc_id", "quality", "IF(crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 = 0, 1 - toxic, toxic) AS toxic")
    given = docs.filter("doc_id < 60").selectExpr("doc_id", "text", "'z' AS lang", "'z' AS source", "'y' AS score")
    one = toxicity.fit(docs, labels)
    assert one == toxicity.fit(docs.repartition(7), flipped)
    scored = given.select("doc_id", toxicity.toxicity_of(given["text"], one)["score"].alias("s"))
    assert scored.count() == 60


def test_nulls_repeats_and_empty_tables(docs_of, tables, rows):
    _, labels = tables
    given = docs_of([(None, None), (1, ""), (2, "you idiot and moron, scum"), (2, "you idiot and moron, scum")], extra=True)
    got = toxicity.toxic_scores(given, labels).select("doc_id", "score", "predicted").collect()
    assert len(got) == 4 and len({r.score for r in got if r.doc_id == 2}) == 1
    assert toxicity.toxic_scores(docs_of([]), labels).count() == 0
    none = toxicity.toxic_scores(given, labels.limit(0)).collect()
    assert all(r.score < 1e-6 and r.predicted == 0 for r in none)


def test_long_text():
    model = toxicity.Model(units={"bad$": 5.0}, other=-0.05, slope=1.0)
    words = toxicity._Scores(model)
    evidence, spans = model.passages("fine " * 200_000 + "bad bad bad bad " + "fine " * 1000, words)
    assert [(a, b) for a, b, _ in spans] == [(200_000, 200_004)] and evidence > 0
