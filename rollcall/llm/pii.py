"""Personal data by fixed patterns and a skip-chain conditional random field.

The base patterns find e-mail addresses, IP addresses, card and telephone numbers. They stay as
found. Other mentions that look like personal data (long numbers in any punctuation, words around
an at sign) are labelled by a conditional random field over all mentions of a document:

  nodes   a mention's shape (digits, groups, separators, check digit) speaks for each label;
          base spans are observed, their label is fixed;
  chain   neighbouring mentions have a potential for each pair of labels;
  skips   a mention and the next one with the same or a similar text (the same last digits, the
          same letters) share a potential for equal labels, however far apart they are; so does
          a mention with every base span of such a text. Labels of base spans are fixed, so these
          links are a sum per text and label, and their number stays linear.

Loopy message passing in both directions over chain and skips, until no message moves, gives each
mention's marginals (messages that never settle end after four rounds a mention, twice what it
takes to cross the document); a
mention whose most probable label is a kind of personal data becomes a span. Node and chain
potentials are learned by counting over the whole corpus, with the base patterns as labels; the
counts are few (labels times shapes) and come from one pass.

Null texts count as empty, empty texts have no spans. All places are code points. Repeated rows
give equal rows, extra columns are ignored, an empty table gives an empty result. Patterns, links
and messages are linear in the length of a text, whatever repeats in it.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.shared import text_or_empty

KINDS = ("email", "ip", "card", "phone")
LABELS = ("other", *KINDS)
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits that is no first part makes none from its middle either.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NUMBER = re.compile(r"\(?[0-9][0-9 ()./-]{5,}[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")

Span = tuple[int, int, str]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from their at signs: what may stand before one is a run of its own."""
    ended, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > ended and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            ended = found.end()
            yield start, ended
        at = text.find("@", max(ended, at + 1))


def base_spans(text: str) -> list[Span]:
    """All spans of the base patterns, by start and then kind in the order of KINDS."""
    spans = [(a, b, "email") for a, b in _emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in m[0].split(".")):
                spans.append((m.start(), m.end(), "ip"))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                spans.append((m.start(), m.end(), "card"))
        for m in _PHONE.finditer(text):
            if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                spans.append((m.start(), m.end(), "phone"))
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def written(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


@dataclass(frozen=True)
class Mention:
    start: int
    end: int
    text: str
    label: int | None  # of a base span

    @property
    def shape(self) -> tuple[str, ...]:
        """Features; a plus sign is none, so that unmarked numbers compare with marked ones."""
        if "@" in self.text:
            _, _, domain = self.text.partition("@")
            return ("address", f"dots:{min(domain.count('.'), 3)}", f"at:{min(self.text.count('@'), 2)}")
        digits = _NOT_DIGIT.sub("", self.text)
        groups = [len(g) for g in re.split(r"[^0-9]+", self.text) if g]
        marks = "".join(sorted(set(re.sub(r"[0-9+]", "", self.text))))
        luck = 12 <= len(digits) <= 19 and luhn(digits)
        return ("number", f"digits:{min(len(digits), 20)}", f"groups:{'-'.join(map(str, groups[-3:]))}", f"marks:{marks}", f"check:{luck}")

    @property
    def key(self) -> str:
        """Equal for repeated and similar mentions: numbers by their last nine digits."""
        if "@" in self.text:
            return "".join(c for c in self.text.lower() if c.isalnum() or c == "@")
        return _NOT_DIGIT.sub("", self.text)[-9:]


def mentions(text: str, base: list[Span]) -> list[Mention]:
    """Base spans, and loose mentions that overlap none, by start."""
    found = [Mention(a, b, text[a:b], LABELS.index(kind)) for a, b, kind in base]
    taken = sorted((a, b) for a, b, _ in base)
    loose = []
    if _DIGIT.search(text):
        for m in _NUMBER.finditer(text):
            if 7 <= len(_NOT_DIGIT.sub("", m[0])) <= 19:
                loose.append((m.start(), m.end()))
    ended, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > ended and not text[start - 1].isspace():
            start -= 1
        end = at + 1
        while end < len(text) and not text[end].isspace():
            end += 1
        if start < at and end > at + 1:
            loose.append((start, end))
        ended, at = end, text.find("@", end)
    loose.sort()
    i, reach = 0, -1
    for a, b in loose:
        while i < len(taken) and taken[i][0] < b:
            reach = max(reach, taken[i][1])
            i += 1
        if reach <= a:
            found.append(Mention(a, b, text[a:b], None))
            reach = b
    return sorted(found, key=lambda m: (m.start, m.label or 0))


@dataclass(frozen=True)
class Field:
    """Potentials as logarithms: of a shape's features for each label, and of label pairs."""

    nodes: dict[str, tuple[float, ...]] = field(default_factory=dict)
    prior: tuple[float, ...] = (0.0,) * len(LABELS)
    chain: tuple[tuple[float, ...], ...] = ((0.0,) * len(LABELS),) * len(LABELS)
    equal: float = 4.0
    rounds: int = 30

    def marginals(self, found: list[Mention]) -> np.ndarray:
        """Beliefs of all mentions after loopy message passing."""
        n, k = len(found), len(LABELS)
        node = np.tile(np.array(self.prior), (n, 1))
        for i, mention in enumerate(found):
            if mention.label is not None:
                node[i] = -50.0
                node[i, mention.label] = 0.0
            else:
                for feature in mention.shape:
                    node[i] += self.nodes.get(feature, (0.0,) * k)
        chain, same = np.array(self.chain), self.equal * np.eye(k)
        # What the base spans of a key tell each other mention of it: one link for each of them.
        told: dict[str, np.ndarray] = {}
        for mention in found:
            if mention.label is not None:
                told.setdefault(mention.key, np.zeros(k))[mention.label] += self.equal
        last: dict[str, int] = {}
        pairs = [(i, i + 1, chain) for i in range(n - 1)]
        for i, mention in enumerate(found):
            if mention.label is None:
                key = mention.key
                if key in told:
                    node[i] += told[key]
                if key in last:
                    pairs.append((last[key], i, same))
                last[key] = i
        source = np.array([a for a, _, _ in pairs] + [b for _, b, _ in pairs], dtype=np.int64)
        target = np.array([b for _, b, _ in pairs] + [a for a, _, _ in pairs], dtype=np.int64)
        potential = np.array([p for _, _, p in pairs] + [p.T for _, _, p in pairs]).reshape(-1, k, k)
        back = np.roll(np.arange(2 * len(pairs)), len(pairs))
        message = np.zeros((2 * len(pairs), k))
        belief = node.copy()
        active = np.arange(2 * len(pairs))
        for _ in range(self.rounds + 4 * n):
            if not len(active):
                break
            cavity = belief[source[active]] - message[back[active]]
            fresh = np.logaddexp.reduce(cavity[:, :, None] + potential[active], axis=1)
            fresh -= np.logaddexp.reduce(fresh, axis=1, keepdims=True)
            moved = fresh - message[active]
            message[active] += 0.5 * moved  # damped, so that loops settle
            np.add.at(belief, target[active], 0.5 * moved)
            # Those that moved go on, and so do those sent by the mentions that they reach.
            going = active[np.abs(moved).max(axis=1) >= 1e-4]
            reached, again = np.zeros(n, dtype=bool), np.zeros(len(source), dtype=bool)
            reached[target[going]] = again[going] = True
            active = np.flatnonzero(again | reached[source])
        return belief - np.logaddexp.reduce(belief, axis=1, keepdims=True)

    def spans(self, text: str) -> tuple[list[Span], list[Span]]:
        """Base spans, and all spans."""
        base = base_spans(text)
        found = mentions(text, base)
        if len(found) == len(base):
            return base, base
        beliefs = self.marginals(found)
        added = [
            (m.start, m.end, LABELS[best])
            for m, best in zip(found, beliefs.argmax(axis=1).tolist(), strict=True)
            if m.label is None and best
        ]
        return base, sorted(base + added, key=lambda s: (s[0], KINDS.index(s[2])))


def _counted(texts: pd.Series) -> Counter:
    counts: Counter = Counter()
    for text in texts:
        found = mentions(text, base_spans(text))
        labels = [m.label or 0 for m in found]
        for m, label in zip(found, labels, strict=True):
            counts["label", "", label, 0] += 1
            for feature in m.shape:
                counts["node", feature, label, 0] += 1
        for a, b in zip(labels, labels[1:], strict=False):
            counts["chain", "", a, b] += 1
    return counts


def fit(docs: DataFrame, equal: float = 4.0, smoothing: float = 0.5) -> Field:
    """Potentials counted over all documents."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = _counted(batch["text"])
            rows = [(*key, n) for key, n in found.items()]
            yield pd.DataFrame(rows, columns=["part", "feature", "a", "b", "n"])

    rows = (
        docs.select(text_or_empty().alias("text"))
        .mapInPandas(count, "part string, feature string, a int, b int, n long")
        .groupBy("part", "feature", "a", "b")
        .agg(F.sum("n").alias("n"))
        .collect()  # labels times shapes: a few thousand at most, whatever the corpus
    )
    k, labels, chain, nodes = len(LABELS), np.zeros(len(LABELS)), None, {}
    chain = np.zeros((k, k))
    for r in rows:
        if r["part"] == "label":
            labels[r["a"]] += r["n"]
        elif r["part"] == "chain":
            chain[r["a"], r["b"]] += r["n"]
        else:
            nodes.setdefault(r["feature"], np.zeros(k))[r["a"]] += r["n"]
    if not labels.sum():
        return Field(equal=equal)
    prior = np.log((labels + smoothing) / (labels + smoothing).sum())
    shares = {
        f: np.log((n + smoothing) / (labels + 2 * smoothing)) for f, n in sorted(nodes.items())
    }
    joint = (chain + smoothing) / (chain + smoothing).sum()
    mutual = np.log(joint / np.outer(joint.sum(axis=1), joint.sum(axis=0)))
    return Field(
        nodes={f: tuple(v.tolist()) for f, v in shares.items()},
        prior=tuple(prior.tolist()),
        chain=tuple(map(tuple, mutual.tolist())),
        equal=equal,
    )


def found_spans(docs: DataFrame, model: Field | None = None) -> DataFrame:
    """docs with `pii`: counts of the base kinds, base spans and all spans as text, redacted text."""
    model = model or fit(docs)

    def find(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            rows = []
            for text in batch:
                base, spans = model.spans(text)
                n = Counter(kind for _, _, kind in base)
                rows.append((*(n[k] for k in KINDS), written(base), written(spans)))
            yield pd.DataFrame(rows, columns=[*(f"n_{k}" for k in KINDS), "base", "spans"])

    kind = ", ".join(f"n_{k} long" for k in KINDS) + ", base string, spans string"
    return docs.withColumn("pii", F.pandas_udf(find, kind)(text_or_empty()))


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans: one row per row of docs."""
    return found_spans(docs.select("doc_id", "text")).select(
        "doc_id", *(f"pii.n_{k}" for k in KINDS), F.sha2("pii.base", 256).alias("base_sha256"), "pii.spans"
    )


def redacted_text(text: str, spans: list[Span]) -> str:
    """The text with each run of overlapping spans replaced by the first one's kind in brackets."""
    out, ended = [], 0
    for a, b, kind in spans:
        if a >= ended:
            out += [text[ended:a], f"[{kind.upper()}]"]
        ended = max(ended, b)
    return "".join([*out, text[ended:]])


def redacted(docs: DataFrame) -> DataFrame:
    """docs with personal data taken out of their texts; null texts stay null."""
    model = fit(docs)

    def redact(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([None if t is None else redacted_text(t, model.spans(t)[1]) for t in batch])

    return docs.withColumn("text", F.pandas_udf(redact, "string")("text"))
