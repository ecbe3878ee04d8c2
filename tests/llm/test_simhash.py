import random

import xxhash

from rollcall.llm import components, simhash


def plain(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def smallest_reachable(ids, prints, most=3):
    n, seen, out = len(ids), {}, {}
    near = {i: [j for j in range(n) if (prints[i] ^ prints[j]).bit_count() <= most] for i in range(n)}
    for i in range(n):
        if i not in seen:
            group, todo = {i}, [i]
            while todo:
                for j in near[todo.pop()]:
                    if j not in group:
                        group.add(j)
                        todo.append(j)
            least = min((ids[j] for j in group if ids[j] is not None), default=None)
            seen |= dict.fromkeys(group)
            out |= dict.fromkeys(group, least)
    return [out[i] for i in range(n)]


def test_links_are_all_pairs_within_the_distance(spark):
    r, values = random.Random(2), set()
    for _ in range(12):
        centre = r.getrandbits(64)
        for _ in range(20):
            x = centre
            for _ in range(r.randint(0, 4)):
                x ^= 1 << r.randrange(64)
            values.add(x - (1 << 64) if x >> 63 else x)
    df = spark.createDataFrame([(x,) for x in values], "fp long")
    for bits, segments in ((3, 4), (3, 5), (2, 3), (3, 8), (0, 2)):
        got = [tuple(x) for x in simhash.links(df, bits, segments).collect()]
        near = {(a, b) for a in values for b in values if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= bits}
        assert len(got) == len(set(got)) and set(got) == near


def test_components(docs_of, texts):
    near = [" ".join(f"w{i}" for i in range(400) if i != skip) for skip in range(0, 400, 40)]
    given = [*enumerate([*texts, *near, texts[5].upper(), "A b", "a  B", None]), (None, None), (None, "only here")]
    got = simhash.simhash_components(docs_of(given, extra=True)).collect()
    prints = [plain(t) for _, t in given]
    expected = zip([d for d, _ in given], [f"{p:016x}" for p in prints], smallest_reachable([d for d, _ in given], prints), strict=True)
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)


def test_one_of_each(docs_of):
    long = " ".join(f"w{i}" for i in range(300))
    given = docs_of([(4, long), (2, long), (2, long), (9, long.upper()), (5, "something else"), (None, "x")], extra=True)
    kept = simhash.one_of_each(given)
    assert kept.columns == given.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 2, 5]
    assert simhash.one_of_each(docs_of([])).count() == simhash.simhash_components(docs_of([])).count() == 0


def test_chains_stars_and_hot_nodes_become_one_component(spark):
    r = random.Random(4)
    chain = [(i, i + 1) for i in range(100, 220)]
    star = [(1000, 1000 + i) for i in range(1, 400)]
    loose = [(r.randrange(2000, 2100), r.randrange(2000, 2100)) for _ in range(70)]
    edges = chain + star + loose + [(5, 5), (7, 6), (6, 7)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    expected = {x: root(x) for x in parent if root(x) != x}
    got = components.components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert dict(map(tuple, got)) == expected and len(got) == len(expected)


def test_long_text_in_pieces(monkeypatch):
    text = " ".join(f"w{i % 977}" for i in range(5000))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "_PIECE", 64)
    assert simhash.fingerprint(text) == whole == plain(text)


def test_one_of_each_keeps_one_row_of_each_component(docs_of):
    words = [f"w{i}" for i in range(400)]
    long, near, other = " ".join(words), " ".join(words[:3] + words[4:]), "something else altogether"
    assert 0 < (plain(long) ^ plain(near)).bit_count() <= 3
    # A doc_id on two texts, one of them a near copy of another document's.
    kept = simhash.one_of_each(docs_of([(3, long), (7, near), (7, other), (None, other.upper())], extra=True))
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(3, long), (7, other)]
    # Rows without doc_id: near copies of a kept document, near copies among them, null and empty texts.
    given = [(None, long), (None, near), (None, near), (4, near), (None, other), (None, other.upper()), (None, None), (None, ""), (None, None)]
    for rows in (given, given[::-1]):
        kept = [(r.doc_id, (r.text or "").lower()) for r in simhash.one_of_each(docs_of(rows)).collect()]
        assert sorted(kept, key=repr) == sorted([(4, near), (None, other), (None, "")], key=repr)


def test_exploded_sides_are_not_broadcast(spark):
    classes = spark.range(1000).selectExpr("xxhash64(id) AS fp")
    plan = simhash.links(classes)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
