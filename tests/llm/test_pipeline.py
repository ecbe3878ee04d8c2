import corpus_pipeline
import pytest

from rollcall.llm import decontam, pii, simhash, toxicity

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark):
    """What each stage leaves, by doc_id."""
    docs, out = spark.read.parquet(f"{FOLDER}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, FOLDER)
        rows = {r.doc_id: r for r in docs.collect()}
        if name != "mix":
            assert docs.columns == before.columns and docs.dtypes == before.dtypes
            docs = spark.createDataFrame(list(rows.values()), before.schema)
        out.append(rows)
    return out


def test_every_stage_decides_on_what_its_predecessor_kept(spark, kept):
    tables = {n: spark.read.parquet(f"{FOLDER}/{n}.parquet") for n in ("documents", "labels", "benchmark")}
    docs = {r.doc_id: r for r in tables["documents"].collect()}
    toxic, unique, clean, private, mix = kept
    model = toxicity.fit(tables["documents"], tables["labels"])
    words = toxicity._Scores(model)
    assert set(toxic) == {d for d, r in docs.items() if model.probability(model.passages(r.text, words)[0]) < 0.5}

    prints = {d: simhash.fingerprint(r.text) for d, r in toxic.items()}
    groups = {}
    for d in sorted(prints):  # smallest first, so a group's smallest names it
        if d not in groups:
            todo = [d]
            while todo:
                x = todo.pop()
                if x not in groups:
                    groups[x] = d
                    todo += [y for y in prints if y not in groups and (prints[x] ^ prints[y]).bit_count() <= 3]
    assert set(unique) == set(groups.values())

    items = [decontam.normalised(r.text) for r in tables["benchmark"].collect()]
    leaks = {d for d, r in unique.items() if any(i in decontam.normalised(r.text) for i in items)}
    assert set(unique) - set(clean) >= leaks and len(set(unique) - set(clean)) <= len(leaks) + 1

    assert set(private) == set(clean)
    for d, r in private.items():
        assert r.n_chars == len(r.text)
        assert not pii.base_spans(r.text)
        assert r.text == clean[d].text or pii.base_spans(clean[d].text)

    assert set(mix) == set(private)
    assert all(mix[d].size == len(private[d].text.encode().split()) for d in mix)


def test_run_is_the_stages_in_order(spark, kept):
    got = corpus_pipeline.run(spark, FOLDER).collect()
    assert {r.doc_id: tuple(r) for r in got} == {d: tuple(r) for d, r in kept[-1].items()}


def test_odd_rows_pass_through_all_stages(spark, tmp_path):
    schema = spark.read.parquet(f"{FOLDER}/documents.parquet").schema.add("score", "string").add("matches", "string")
    rows = [(1, None, None, None, None, "a", "b"), (2, "", "en", "s", 0, "a", "b"), (None, "some words", "en", None, 10, None, None),
            (3, "mail me@x.com", "en", "s", 13, "", ""), (3, "mail me@x.com", "en", "s", 13, "", "")]
    for given in (rows, []):
        folder = tmp_path / str(len(given))
        spark.createDataFrame(given, schema).write.parquet(str(folder / "documents.parquet"))
        for name in ("labels", "benchmark"):
            spark.read.parquet(f"{FOLDER}/{name}.parquet").write.parquet(str(folder / f"{name}.parquet"))
        docs = spark.read.parquet(str(folder / "documents.parquet"))
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, str(folder))
            assert docs.columns == schema.names
        got = corpus_pipeline.run(spark, str(folder)).collect()
        assert sorted((r.doc_id or 0) for r in got) == ([0, 1, 3] if given else [])
