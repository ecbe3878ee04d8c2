import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from rollcall.llm import tokens

NAME = "word_bpe_49k.json"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(NAME))


def test_counts_are_the_librarys(library):
    r, count = random.Random(1), tokens.Vocabulary(NAME).count
    parts = ["a", "B", " ", "İ", "Σ", "é", "é", "'s", "'LL", "1", "½", "\x85", "\x1c", "\x1f", "\n",
             "中", "🙂", "<|endoftext|>", "<|", "!!", "xxxxx", "ſ", "ß", "ﬁ", "\x00", "K", "ΑΣ", "the"]
    for _ in range(3000):
        text = "".join(r.choice(parts) for _ in range(r.randint(0, 14)))
        assert count(text) == len(library.encode(text, add_special_tokens=False).ids), repr(text)


def test_very_long_word(library):
    text = "abc" * 20_000
    assert tokens.Vocabulary(NAME).count(text) == len(library.encode(text, add_special_tokens=False).ids)


def test_lowest_rank_goes_first_and_the_leftmost_among_equals():
    merges = {(1, 1): (0, 2), (2, 1): (1, 3)}
    assert tokens.merge_count([1, 1, 1], merges) == 2  # (11)1, then (111)
    assert tokens.merge_count([1, 1, 1, 1], merges) == 2  # (11)(11)
    assert tokens.merge_count([], merges) == tokens.merge_count([5], merges) == 0


def test_rows(docs_of, rows, library):
    given = [(1, "Hello the end."), (1, "Hello the end."), (None, None), (2, ""), (3, "é" * 3000)]
    got = rows(tokens.token_counts(docs_of(given, extra=True), NAME))
    n = len(library.encode("é" * 3000, add_special_tokens=False).ids)
    long = (3, 6000, n, n > 2048)
    assert got == sorted([(1, 14, 4, False)] * 2 + [(None, 0, 0, False), (2, 0, 0, False), long], key=repr)
    assert tokens.token_counts(docs_of([]), NAME).count() == 0
