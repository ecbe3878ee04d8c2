import math
import re

import pytest

from rollcall.llm import mixing


@pytest.fixture(scope="module")
def given():
    rows = [(i, "w " * (5 + i * 37 % 90), f"s{i % 7}") for i in range(600)]
    rows += [(i, "w " * 40, "hot") for i in range(600, 900)]
    return [*rows, (900, None, "s1"), (901, "", "s1"), (902, "a b", None), (903, "a b c", None), (5, "x y", "s1"), (5, "x y", "s1"), (None, "x", "s2")]


def test_targets_share_all_words_and_stop_at_the_cap(spark):
    sizes = [("a", 10), ("b", 1000), ("c", 1000), (None, 100), ("é", 100)]
    df = spark.createDataFrame(sizes, "source string, size long")
    got = {r[0]: r[2] for r in mixing.source_targets(df).collect()}
    # Weights 5, 2, 1, 5, 2 in the order a, b, c, é, null; a and é stop at three times their size.
    expected = {"a": 30.0, "é": 300.0}
    rest = 2210 - 330
    expected |= {"b": rest * 2 / 5, "c": rest / 5, None: rest * 2 / 5}
    expected[None] = 300.0  # 752 is over its cap, so the rest is shared again
    rest -= 300
    expected |= {"b": rest * 2 / 3, "c": rest / 3}
    assert got == pytest.approx(expected)


def test_mix(docs_of, given):
    got = mixing.cube_mix(docs_of(given, extra=False), block=64).collect()
    assert len(got) == len(given)
    totals, sizes, targets = {}, {}, {}
    for r in got:
        totals[r.source] = totals.get(r.source, 0) + r.taken
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        targets[r.source] = r.target
        assert r.taken == r.copies * r.size <= 3 * r.size
        assert r.copies in (math.floor(r.target / r.source_size + 1e-9), math.ceil(r.target / r.source_size - 1e-9)) or r.size == 0
    assert all(r.source_size == sizes[r.source] for r in got)
    assert sum(targets.values()) == pytest.approx(sum(sizes.values()))
    for source, target in targets.items():
        assert abs(totals[source] - target) <= max(3, 0.01 * target)


def test_reruns_agree_whatever_the_partitions(docs_of, given, rows):
    one = rows(mixing.cube_mix(docs_of(given), block=64))
    assert one == rows(mixing.cube_mix(docs_of(given[::-1]).repartition(9), block=64))


def test_extra_columns_and_empty(docs_of):
    assert mixing.cube_mix(docs_of([(1, "a b")], extra=True)).collect()[0].taken == 2
    assert mixing.cube_mix(docs_of([])).count() == 0
    assert [r.taken for r in mixing.cube_mix(docs_of([(1, None), (2, " ")])).collect()] == [0, 0]


def test_flight_keeps_both_totals():
    import numpy as np

    r = np.random.default_rng(2)
    p, sizes = r.uniform(0.01, 0.99, 300), r.integers(1, 50, 300).astype(float)
    moved = mixing.flight(p, sizes, r.uniform(0, 1, 300))
    assert moved.sum() == pytest.approx(p.sum()) and moved @ sizes == pytest.approx(p @ sizes)
    assert ((moved > 1e-9) & (moved < 1 - 1e-9)).sum() <= mixing.LANDING + 2


def test_equal_rows_are_numbered_in_parts(spark):
    rows = [(None, "s", 3, i % 5) for i in range(40)] + [(None, "s", 0, i % 5) for i in range(40)]
    rows += [(1, None, 2, 0), (1, None, 2, 4), (2, "s", 2, 1)]
    numbered = mixing._numbered(spark.createDataFrame(rows, "doc_id long, source string, size long, dealt int"))
    got = sorted([(r.doc_id, r.source, r.size, r.copy_no) for r in numbered.collect()], key=repr)
    expected = [(None, "s", 3, i + 1) for i in range(40)] + [(None, "s", 0, None)] * 40
    assert got == sorted([*expected, (1, None, 2, 1), (1, None, 2, 2), (2, "s", 2, 1)], key=repr)
    # No window that numbers rows is over all that are equal.
    plan = numbered._jdf.queryExecution().optimizedPlan().toString()
    assert re.findall(r"row_number\(\) windowspecdefinition\(doc_id#\d+L?, source#\d+, size#\d+L?, dealt#", plan)


def test_text_ids_empty_and_missing(spark):
    rows = [("", "a b c", "s"), (None, "a b c", "s"), ("-", "a b c", "s"), ("x", "a b c", "s"), ("", "a b c", "s"), ("", "", "s"), ("x", "q", None), (None, "q", "")]
    docs = spark.createDataFrame(rows, "doc_id string, text string, source string")
    got = mixing.cube_mix(docs).collect()
    assert sorted(((r.doc_id, r.size, r.source) for r in got), key=repr) == sorted(
        ((d, len(t.split()), s) for d, t, s in rows), key=repr
    )
    of_s = [r for r in got if r.source == "s"]
    assert sum(r.taken for r in of_s) == pytest.approx(of_s[0].target, abs=3)


def test_sources_are_numbered_in_code_point_order(spark):
    names = [f"s{i}" for i in range(300)] + ["", "é", "Z", "a", "\U0001f600", "￮", None]
    docs = spark.createDataFrame([(name, 7) for name in names], "source string, size long").repartition(5)
    got = {r[0]: r[2] for r in mixing.source_targets(docs, (3.0, 2.0, 1.0), most=9).collect()}
    order = sorted((n for n in names if n is not None), key=lambda n: [ord(c) for c in n]) + [None]
    weights = {name: (3.0, 2.0, 1.0)[i % 3] for i, name in enumerate(order)}
    share = 7 * len(names) / sum(weights.values())
    assert got == pytest.approx({name: w * share for name, w in weights.items()})
