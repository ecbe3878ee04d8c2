import re

import duckdb

from rollcall.llm import licences

MIT = "\n".join(licences.SENTENCES[s] for s in ("mit-title-2", "mit-grant", "mit-condition"))
GIVEN = [
    (1, f"Some text.\n{MIT}\nMore text."),
    (2, "Prose here. Released under the MIT License."),
    (3, "LICENSED under the  Apache License, Version 2.0.\nAll rights\nreserved."),
    (4, "\n".join(licences.SENTENCES[s] for s in ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names"))),
    (5, "\n".join(licences.SENTENCES[s] for s in ("bsd-grant", "bsd-source", "bsd-binary"))),
    (6, "This is under some licence of ours! Nothing else"),
    (7, "\n".join(licences.SENTENCES[s] for s in ("bsd-source", "mit-condition"))),
    (8, None),
    (9, ""),
    (9, ""),
    (None, "Licensed under CC BY-NC 4.0."),
    (11, "x " * 50_000 + "\nLicensed under CC0 1.0."),
]


def test_sequences_name_licences(docs_of):
    got = {r.doc_id: (r.licences, r.n_unknown) for r in licences.licences(docs_of(GIVEN, extra=True)).collect()}
    assert got == {
        1: ("MIT", 0), 2: ("MIT", 0), 3: ("Apache-2.0,all-rights-reserved", 0), 4: ("BSD-3-Clause", 0),
        5: ("BSD-2-Clause", 0), 6: ("", 1), 7: ("", 0), 8: ("", 0), 9: ("", 0), None: ("CC-BY-NC-4.0", 0),
        11: ("CC0-1.0", 0),
    }


def test_sql_gives_the_same(docs_of, rows):
    df = docs_of(GIVEN)
    con = duckdb.connect()
    con.register("documents", df.toPandas())
    names = ["doc_id", "sentence_ids", "licences", "n_unknown"]
    expected = con.execute(f"SELECT {', '.join(names)} FROM ({licences.licences_sql()})").fetchall()
    assert rows(licences.licences(df), *names) == sorted(expected, key=repr)


def test_no_python_in_the_plan(docs_of):
    plan = licences.licences(docs_of(GIVEN))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_every_known_sentence_is_one_and_is_hinted():
    known = licences._known()
    assert len(known) == len(licences.SENTENCES)
    assert all(re.search(licences.HINTS, s) for s in known)
    assert {s for rule, _ in licences.RULES for s in rule} <= set(licences.SENTENCES)


def test_empty(docs_of):
    assert licences.licences(docs_of([])).count() == 0


def test_texts_are_cut_whatever_stands_between_the_words_of_a_hint(docs_of, rows):
    reserved = ["All rights\nreserved.", "All rights  reserved.", "All rights\treserved", "All-rights-reserved", "All rights reserved."]
    grants = ["This program is free\nsoftware:", "This program is FREE -- software: x"]
    df = docs_of([*enumerate(reserved), *enumerate(grants, 10), (20, "Provided he reserved free seats, that is all.")])
    got = {r.doc_id: (r.sentence_ids, r.licences) for r in licences.licences(df).collect()}
    assert got == {
        **{i: ("reserved", "all-rights-reserved") for i in range(len(reserved))},
        10: ("gpl-grant", ""), 11: ("gpl-grant", ""), 20: ("", ""),
    }
    con = duckdb.connect()
    con.register("documents", df.toPandas())
    names = ["doc_id", "sentence_ids", "licences", "n_unknown"]
    expected = con.execute(f"SELECT {', '.join(names)} FROM ({licences.licences_sql()})").fetchall()
    assert rows(licences.licences(df), *names) == sorted(expected, key=repr)
