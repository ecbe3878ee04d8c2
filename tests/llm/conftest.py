from __future__ import annotations

import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text[, source]); `extra` adds columns named like our own ones."""

    def build(rows, extra: bool = False):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, COLUMNS)
        if extra:
            for name in ("fp", "size", "target", "score", "matches", "pii", "h", "t", "at", "ids", "kept"):
                df = df.selectExpr("*", f"'x' AS {name}")
        return df

    return build


@pytest.fixture(scope="session")
def texts():
    """Invented texts with copies, shared passages, repeats and other languages' letters."""
    import random

    r = random.Random(7)
    words = ["the", "of", "and", "Größe", "naïve", "λόγος", "x1", "run,", "end.", "ein", "que", "a"]

    def text(n):
        return "".join(r.choice(words) + r.choice([" ", " ", " ", "\n", "\t"]) for _ in range(n))

    passage, other = text(70), text(140)
    made = [text(r.randint(0, 160)) for _ in range(30)]
    made += [text(r.randint(0, 20)) + passage + text(r.randint(0, 20)) for _ in range(12)]
    made += [text(10) + other[: r.randint(300, len(other))] for _ in range(8)]
    made += [made[3]] * 4 + ["", "word", " \n ", passage * 3, "aa " * 120, "a" * 900]
    return made
