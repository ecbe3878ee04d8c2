import hashlib
import random
import re

import numpy as np

from rollcall.llm import pii


def by_patterns(text):
    def digits(s):
        return re.sub("[^0-9]", "", s)

    def luhn(s):
        return sum(sum(map(int, str(int(c) * (1 + i % 2)))) for i, c in enumerate(reversed(s))) % 10 == 0

    email = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
    out = [(m.start(), m.end(), "email") for m in re.finditer(email, text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append((m.start(), m.end(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        if 12 <= len(digits(m[0])) <= 19 and luhn(digits(m[0])):
            out.append((m.start(), m.end(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(digits(m[0])) <= 15:
            out.append((m.start(), m.end(), "phone"))
    return sorted(out, key=lambda s: (s[0], pii.KINDS.index(s[2])))


def test_base_spans_are_the_patterns():
    r = random.Random(4)
    parts = ["a", ".", "@", "b.c", "1", "23", "255", ".", " ", "-", "+1", "(", ")", "é", "_", "%", "4111111111111111", "\n", "0"]
    for _ in range(20_000):
        text = "".join(r.choice(parts) for _ in range(r.randint(0, 22)))
        assert pii.base_spans(text) == by_patterns(text), repr(text)


CALLS = "call +1 (743) 555-3824 now. Later (743) 555-3824 or 743-555-3824, not 12345678"


def corpus(docs_of):
    rows = [(i, f"word +1 ({200 + i}) 555-{1000 + i} word 4111 1111 1111 1111 u{i}@x.com 10.0.0.{i}") for i in range(60)]
    rows += [(100 + i, f"order {20240000 + 37 * i} and {91 * i + 10_000_000}") for i in range(60)]
    return docs_of([*rows, (500, CALLS), (501, "mail u7@x.com and u7@xcom"), (502, None), (502, None), (503, ""), (None, "10.1.2.3")], extra=True)


def test_repeated_mentions_take_the_label_of_their_like(docs_of):
    got = {r.doc_id: r for r in pii.personal_data(corpus(docs_of)).collect()}
    spans = [tuple(s.split(":")) for s in got[500].spans.split(",")]
    assert [(k, CALLS[int(a) : int(b)]) for k, a, b in spans] == [
        ("phone", "+1 (743) 555-3824"), ("phone", "(743) 555-3824"), ("phone", "743-555-3824"),
    ]
    assert got[500].n_phone == 1 and all(got[i].spans == "" for i in range(100, 160))
    assert got[501].spans == "email:5:13,email:18:25"
    assert got[None].spans == "ip:0:8" and got[502].spans == got[503].spans == ""


def test_base_columns(docs_of):
    df = corpus(docs_of)
    texts = {r.doc_id: r.text or "" for r in df.collect()}
    for r in pii.personal_data(df).collect():
        base = by_patterns(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for *_, k in base) for x in pii.KINDS]
        joined = ",".join(f"{k}:{a}:{b}" for a, b, k in base)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert {s for s in joined.split(",") if s} <= set(r.spans.split(","))


def test_messages_spread_along_skips_only_where_texts_are_alike():
    field = pii.Field(nodes={"number": (2.0, 0, 0, 0, 0)}, equal=6.0)
    text = "+1 743 555 3824 x 743-555-3824 x 888-555-0000 x 743.555.3824"
    base, spans = field.spans(text)
    assert [text[a:b] for a, b, _ in spans] == ["+1 743 555 3824", "743-555-3824", "743.555.3824"]
    assert len(base) == 1


def test_redaction(docs_of):
    got = {r.doc_id: r.text for r in pii.redacted(corpus(docs_of)).collect()}
    assert got[500] == "call [PHONE] now. Later [PHONE] or [PHONE], not 12345678"
    assert got[502] is None and got[503] == "" and got[None] == "[IP]"
    assert pii.redacted_text("ab12cd", [(2, 4, "ip"), (3, 5, "card")]) == "ab[IP]d"


def test_long_runs_and_empty_tables(docs_of):
    for text in ("1" * 200_000, "a" * 200_000 + "@", "+1" + " " * 100_000, "1.2." * 50_000, "1 " * 100_000):
        pii.Field().spans(text)
    assert pii.personal_data(docs_of([])).count() == 0


def test_every_copy_of_a_base_span_hears_of_it_directly():
    for against in (1.0, 2.0, 3.0):
        for marked_first in (True, False):
            field = pii.Field(nodes={"number": (against, 0, 0, 0, 0)})
            copies = ["743-555-3824"] * 10
            text = " x ".join(["+1 743 555 3824", *copies] if marked_first else [*copies, "+1 743 555 3824"])
            base, spans = field.spans(text)
            assert len(base) == 1 and [k for *_, k in spans] == ["phone"] * 11
    # A stronger word against it than the link's stays, however often the number is written.
    assert len(pii.Field(nodes={"number": (5.0, 0, 0, 0, 0)}).spans(text)[1]) == 1


def test_messages_go_on_until_they_settle():
    chain = tuple(tuple(6.0 * (a == b) for b in range(5)) for a in range(5))
    field = pii.Field(nodes={"number": (0.002, 0, 0, 0, 0)}, chain=chain)
    text = "+1 743 555 3824 " + " ".join(f"x {n}" for n in range(555_0000, 555_0060))
    found = pii.mentions(text, pii.base_spans(text))
    belief = field.marginals(found)
    # The chain has no loops, so that sums of products forwards and backwards are exact.
    pair, node = np.exp(np.array(chain)), np.array([[np.exp(0.002), 1, 1, 1, 1]] * len(found))
    node[0] = [0, 0, 0, 0, 1]
    forth, back = [node[0]], [np.ones(5)]
    for i in range(1, len(found)):
        forth.append(node[i] * (pair.T @ forth[-1]) / forth[-1].sum())
        back.append(pair @ (node[-i] * back[-1]) / back[-1].sum())
    exact = np.array(forth) * np.array(back[::-1])
    exact /= exact.sum(axis=1, keepdims=True)
    assert len(found) == 61 and np.abs(np.exp(belief) - exact).max() < 0.01
