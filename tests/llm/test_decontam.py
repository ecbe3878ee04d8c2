import random

import pytest

from rollcall.llm import decontam


def fewest_edits(item, text):
    before = [0] * (len(text) + 1)
    for i, c in enumerate(item):
        row = [i + 1]
        for j, x in enumerate(text):
            row.append(min(before[j] + (c != x), before[j + 1] + 1, row[-1] + 1))
        before = row
    return min(before)


def test_matches_are_those_of_full_alignment():
    r = random.Random(5)

    def text(low, high):
        return "".join(r.choice("abcd ef") for _ in range(r.randint(low, high)))

    for _ in range(150):
        items = [text(9, 120) for _ in range(4)]
        edited = list(r.choice(items))
        for _ in range(r.randint(0, int(0.13 * len(edited)))):
            at = r.randrange(len(edited))
            edited[at : at + r.randint(0, 1)] = r.choice(["", "a", "b"])
        index = decontam.Items(tuple(enumerate(items)), 0.1)
        whole = text(0, 80) + "".join(edited) + text(0, 80)
        expected = {i: fewest_edits(t, whole) for i, t in enumerate(items)}
        expected = {i: e for i, e in expected.items() if e <= index.budgets[i]}
        assert {m["item_id"]: m["edits"] for m in index.find(whole)} == expected


@pytest.fixture(scope="module")
def benchmark(spark):
    items = [(1, "What is the capital of that small old country?"), (2, None), (3, "..."), (4, "Yes 42"),
             (5, "What is the capital of that small old country?")]
    return spark.createDataFrame(items, "item_id long, text string")


def test_rows(docs_of, rows, benchmark):
    given = [
        (1, "so: what IS the capital,\nof that small old country"),
        (2, "so what iz the capital of that smalll old country then"),
        (3, "what is the capital of a large new town"),
        (4, "oh yes... 42!"),
        (None, None),
        (6, ""),
        (6, ""),
    ]
    got = rows(decontam.contaminated_docs(docs_of(given, extra=True), benchmark))
    none = [(None, False, 0, ""), (3, False, 0, ""), (6, False, 0, ""), (6, False, 0, "")]
    assert got == sorted([(1, True, 2, "1,5"), (2, True, 2, "1,5"), (4, True, 1, "4"), *none], key=repr)
    kept = decontam.without_contaminated(docs_of(given, extra=True), benchmark)
    assert sorted(r[0] or 0 for r in kept.select("doc_id").collect()) == [0, 3, 6, 6]


def test_blocks_give_the_same(docs_of, rows, benchmark):
    df = docs_of([(1, "what is the capital of that small old country"), (2, "yes 42")])
    one = df.select("doc_id", decontam.matches_of(benchmark).alias("m"))
    many = df.select("doc_id", decontam.matches_of(benchmark, block_chars=40).alias("m"))
    listed = [sorted((r[0], m.item_id, m.start, m.end) for r in x.collect() for m in r[1]) for x in (one, many)]
    assert listed[0] == listed[1] and len(listed[0]) == 3


def test_empty_tables(docs_of, benchmark):
    assert decontam.contaminated_docs(docs_of([]), benchmark).count() == 0
    assert decontam.contaminated_docs(docs_of([(1, "a")]), benchmark.limit(0)).collect()[0][1] is False


def test_planted_passages(spark):
    folder = "/root/testdata/sf0.001"
    docs, items = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "benchmark"))
    named = [(i, decontam.normalised(t)) for i, t in items.collect()]
    got = {r[0]: r[3] for r in decontam.contaminated_docs(docs, items).collect()}
    for row in docs.collect():
        inside = {i for i, t in named if t in decontam.normalised(row["text"])}
        assert inside <= {int(i) for i in got[row["doc_id"]].split(",") if i}


def test_an_item_without_id_beside_others(spark, docs_of, rows):
    items = [(None, "a passage of no name"), (None, "another one of no name"), (3, "a passage with a name")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = docs_of([(1, "So: a passage of no name."), (2, "A passage with a name!"), (3, "none")])
    assert rows(decontam.contaminated_docs(docs, benchmark)) == [(1, True, 1, ""), (2, True, 1, "3"), (3, False, 0, "")]
    assert [r.doc_id for r in decontam.without_contaminated(docs, benchmark).collect()] == [3]
