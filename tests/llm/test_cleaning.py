import re
from collections import Counter

from rollcall.llm import cleaning


def base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    twice = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    failed = len(words) < 50 or 100 * len(twice) > 50 * len(words)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(twice), failed


def test_base_figures(docs_of, rows, texts):
    odd = ["a\x1cb　c\x85d", "x\n\n \nx\r\nx", "# * $ | < >", "one two three " * 30, "é" * 40_000]
    given = [*enumerate([*texts, *odd, None]), (None, "a b")]
    got = cleaning.line_first(docs_of(given, extra=True)).collect()
    assert sorted((tuple(r)[:7] for r in got), key=repr) == sorted(((d, *base(t)) for d, t in given), key=repr)
    assert not any(r.kept and r.base_failed for r in got)
    assert cleaning.line_first(docs_of([])).count() == 0


def judged(text):
    return cleaning.judged(text, cleaning.LineRules())


def prose(n):
    return "\n".join(" ".join(f"word{i}of{j}" for j in range(9)) + "." for i in range(n))


def test_verdicts():
    assert judged(prose(12))[6]
    assert not judged(prose(2))[6]  # too short
    menu = "\n".join(f"Home {i} | About us | News | Log in | Contact" for i in range(9))
    assert judged(prose(30) + "\n" + menu)[6]  # loses a little
    assert not judged(prose(6) + "\n" + menu)[6]  # loses too much
    assert not judged(" ".join(f"WORD{i}!!" for i in range(80)))[6]
    assert not judged(" ".join(f"word{i}###" for i in range(80)))[6]


def test_cleaned_text_leaves_out_failed_and_repeated_lines():
    good = "A good line that ends well."
    assert cleaning.cleaned_text(f"{good}\nWe use cookies. Read more\n\n{good}\nHome | News | Sport | Log in") == f"{good}\n"
    assert cleaning.cleaned_text(None) == ""


def test_labelled_rows_of_low_quality_are_rejected(spark):
    folder = "/root/testdata/sf0.01"
    found = cleaning.line_first(spark.read.parquet(f"{folder}/documents.parquet"))
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    pairs = found.filter("NOT base_failed").join(labels, "doc_id").select("quality", "kept").collect()
    good = [kept for quality, kept in pairs if quality == 1]
    bad = [kept for quality, kept in pairs if quality == 0]
    assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.05 * len(bad)
