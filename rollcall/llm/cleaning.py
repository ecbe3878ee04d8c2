"""Quality rules, line first: every line is judged by itself, failed lines are taken out, and a
document that loses too much of its text is rejected.

A line with words fails one of the rules for

  punctuation  it holds a symbol for every few words, or many words and no sentence end, or
               an exclamation mark for most of its words, or shouts (capitals only);
  navigation   it is a row of short labels between separators;
  boilerplate  it holds a stock phrase of page furniture, or repeats an earlier line.

Nulls and empty texts have no words and fail the base check (so are not kept). Repeated rows are
judged row by row, other columns are ignored, an empty table gives an empty result. The cost is
linear in the text; a very long text is one value of one task and is judged whole.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.shared import word_list

SYMBOLS = "#*$%&|<>"
_SPACES = " \t\n\x0b\x0c\r"
_SEPARATOR = r"[ \t\r\f\v](?:[|»›•·>/]|->)[ \t\r\f\v]"
_END = r"[.!?。！？…:;]"
_SMALL, _CAPITAL = r"\p{Ll}", r"\p{Lu}"
_SEPARATORS, _SENTENCE_END = regex.compile(_SEPARATOR), regex.compile(_END)
_SMALL_LETTER, _CAPITAL_LETTER = regex.compile(_SMALL), regex.compile(_CAPITAL)

#: Stock phrases of page furniture; fixed values.
BOILERPLATE = (
    "accept all cookies",
    "all rights reserved",
    "back to top",
    "click here",
    "cookie policy",
    "enable javascript",
    "log in to comment",
    "privacy policy",
    "read more",
    "share this",
    "sign up for our newsletter",
    "skip to content",
    "terms of use",
    "we use cookies",
)
_FURNITURE = "(?i)" + "|".join(BOILERPLATE)
_BOILERPLATE = regex.compile(_FURNITURE)


@dataclass(frozen=True)
class LineRules:
    """Limits of the line rules and of the share of words that a document may lose."""

    symbols_per_word: float = 0.3
    words_without_end: int = 120
    shouts_per_word: float = 0.5
    least_words: int = 5
    separators: int = 3
    words_per_label: float = 3.0
    boilerplate_words: int = 20
    lost_share: float = 0.3

    def fails(self, line: str, n: int) -> str:
        """The rule that a line of n words fails; empty if none."""
        separators = len(_SEPARATORS.findall(line))
        if n >= self.least_words:
            symbols = sum(map(line.count, SYMBOLS))
            if symbols > self.symbols_per_word * n and separators < self.separators:
                return "punctuation"
            if not _SMALL_LETTER.search(line) and _CAPITAL_LETTER.search(line):
                return "punctuation"
            if line.count("!") > self.shouts_per_word * n:
                return "punctuation"
        if n >= self.words_without_end and not _SENTENCE_END.search(line):
            return "punctuation"
        labels = separators + 1
        if separators >= self.separators and n - separators <= self.words_per_label * labels:
            return "navigation"
        if n <= self.boilerplate_words and _BOILERPLATE.search(line):
            return "boilerplate"
        return ""


def repeated_words(words: list[bytes]) -> int:
    """Words in windows of three that are found twice or more, the first one included."""
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    if len(windows) >= len(words) - 2:
        return 0
    n, covered = 0, 0
    for i, window in enumerate(zip(words, words[1:], words[2:], strict=False)):
        if windows[window] > 1:
            n += i + 3 - max(i, covered)
            covered = i + 3
    return n


def judged(text: str | None, rules: LineRules) -> tuple:
    """The base figures, what the line rules took out, and the verdict."""
    text = text or ""
    words = word_list(text)
    n_words, n_dup, lost_words, lost_lines, seen = len(words), 0, 0, 0, set()
    for line in text.split("\n"):
        if n := len(line.encode("utf-8", "surrogatepass").split()):
            repeated = line in seen
            seen.add(line)
            n_dup += repeated
            if repeated or rules.fails(line, n):
                lost_lines += 1
                lost_words += n
    n_repeat = repeated_words(words)
    base_failed = n_words < 50 or 100 * n_repeat > 50 * n_words
    return (
        n_words,
        len(text) - sum(map(text.count, _SPACES)),
        sum(map(text.count, SYMBOLS)),
        n_dup,
        n_repeat,
        base_failed,
        not base_failed and lost_words <= rules.lost_share * n_words,
        lost_lines,
        lost_words,
    )


_COLUMNS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, n_lost_lines long, n_lost_words long"
)


def line_first(docs: DataFrame, rules: LineRules | None = None) -> DataFrame:
    """The figures and the verdict of every document, one row per row of docs."""
    rules = rules or LineRules()
    names = [c.split()[0] for c in _COLUMNS.split(", ")]

    def judge(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            yield pd.DataFrame([judged(t, rules) for t in batch], columns=names)

    verdict = F.pandas_udf(judge, _COLUMNS)
    return docs.select("doc_id", verdict("text").alias("verdict")).select("doc_id", "verdict.*")


def cleaned_text(text: str | None, rules: LineRules | None = None) -> str:
    """The text without the lines that fail."""
    rules, seen, kept = rules or LineRules(), set(), []
    for line in (text or "").split("\n"):
        n = len(line.encode("utf-8", "surrogatepass").split())
        if not n or not (line in seen or rules.fails(line, n)):
            kept.append(line)
        seen.add(line)
    return "\n".join(kept)


def line_first_sql(rules: LineRules | None = None) -> str:
    """The same over the view `documents`, for DuckDB: words and lines as rows, windows over them."""
    r, word = rules or LineRules(), r"[^\x20\x09-\x0D]+"

    def count(pattern: str, text: str = "line") -> str:
        return f"len(regexp_extract_all({text}, '{pattern}'))"

    return f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS n FROM documents),
words AS (SELECT n, unnest(ws) AS w, generate_subscripts(ws, 1) AS i
          FROM (SELECT n, regexp_extract_all(text, '{word}') AS ws FROM docs) x),
windows AS (SELECT n, i, w AS a, lead(w) OVER o AS b, lead(w, 2) OVER o AS c FROM words
            WINDOW o AS (PARTITION BY n ORDER BY i)),
often AS (SELECT n, i, count(*) OVER (PARTITION BY n, a, b, c) AS times FROM windows
          WHERE c IS NOT NULL),
repeats AS (SELECT n, count(DISTINCT i + j) AS n_repeat FROM often, (VALUES (0), (1), (2)) t(j)
            WHERE times > 1 GROUP BY n),
cut AS (SELECT n, unnest(ls) AS line, generate_subscripts(ls, 1) AS place
        FROM (SELECT n, string_split(text, chr(10)) AS ls FROM docs) x),
counted AS (SELECT n, line, {count(word)} AS k, {count(_SEPARATOR)} AS seps,
                   {count("[" + SYMBOLS + "]")} AS symbols, {count("!")} AS shouts,
                   row_number() OVER (PARTITION BY n, line ORDER BY place) > 1 AS again FROM cut),
judged AS (SELECT n, k, again, again
    OR (k >= {r.least_words} AND (
         (symbols > {r.symbols_per_word}::DOUBLE * k AND seps < {r.separators})
         OR (NOT regexp_matches(line, '{_SMALL}') AND regexp_matches(line, '{_CAPITAL}'))
         OR shouts > {r.shouts_per_word}::DOUBLE * k))
    OR (k >= {r.words_without_end} AND NOT regexp_matches(line, '{_END}'))
    OR (seps >= {r.separators} AND k - seps <= {r.words_per_label}::DOUBLE * (seps + 1))
    OR (k <= {r.boilerplate_words} AND regexp_matches(line, '{_FURNITURE}')) AS lost
  FROM counted WHERE k > 0),
totals AS (SELECT n, sum(k) AS words, count(*) FILTER (again) AS dups, count(*) FILTER (lost) AS lost_lines,
                  coalesce(sum(k) FILTER (lost), 0) AS lost_words FROM judged GROUP BY n),
figures AS (SELECT d.doc_id, d.text, coalesce(words, 0)::BIGINT AS n_words, coalesce(dups, 0) AS n_dup_lines,
                   coalesce(n_repeat, 0) AS n_repeat_words, coalesce(lost_lines, 0) AS n_lost_lines,
                   coalesce(lost_words, 0)::BIGINT AS n_lost_words
            FROM docs d LEFT JOIN totals USING (n) LEFT JOIN repeats USING (n))
SELECT doc_id, n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
       {count("[" + SYMBOLS + "]", "text")} AS n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT base_failed AND n_lost_words <= {r.lost_share}::DOUBLE * n_words AS kept,
       n_lost_lines, n_lost_words
FROM figures"""
