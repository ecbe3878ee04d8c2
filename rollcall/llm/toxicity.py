"""Toxic passages by maximum-scoring segments of token log-odds.

Fitting. Every different word of a text counts as itself and as its prefixes of 6, 5 and 4 letters. The log-odds of
such a unit (toxic against clean) are smoothed by a Dirichlet prior whose mean is the rate of the
next shorter prefix; whole words and long prefixes are kept only where they differ from that
clearly, other words use their longest kept prefix, and all remaining words share one small
negative score, the log-odds of being none of the kept ones. The units are counted on one part of
the labelled rows; the rest calibrates: the highest segments of clean texts follow an
extreme-value law P(S >= x) = 1 - exp(-K n exp(-lambda x)) for n tokens, and a logistic curve
turns the evidence above it into a score between 0 and 1.

Scoring. One linear scan finds all maximal scoring segments of a text (Ruzzo and Tompa). Segments
that the extreme-value law finds significant are the toxic passages; a document's evidence is the
sum of their excess over the law's level, or what its best segment lacks.

Labels are read from at most `fit_rows` rows, the first by a hash of doc_id, and the units kept
are bounded with them. Labels, lang, source and doc_id take no part in a score. Null and empty
texts have no tokens and get the score of no evidence. Without labels of both kinds, every score
is the share of toxic labels (0 without labels). Repeated rows get equal scores, extra columns are
ignored, an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.shared import stored, text_or_empty

FIT_ROWS = 20_000
PREFIXES = (6, 5, 4)
_TOKEN = re.compile(r"\w+")
_REMEMBERED_WORDS = 500_000
_EULER = 0.5772156649


def tokens_of(text: str) -> list[str]:
    return _TOKEN.findall(text.lower())


def units_of(word: str) -> list[str]:
    """The word itself (marked by its end) and its prefixes, longest first."""
    return [word + "$", *(word[:n] for n in PREFIXES if len(word) >= n)]


def held_out(doc_id: Column, folds: int = 5) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


def maximal_segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end exclusive, score) in one linear scan."""
    left: list[float] = []
    right: list[float] = []
    spans: list[tuple[int, int]] = []
    below: list[int] = []  # the nearest earlier segment with a smaller left sum
    total = 0.0
    for i, score in enumerate(scores):
        before, total = total, total + score
        if score <= 0:
            continue
        start, level = i, before
        while True:
            j = len(spans) - 1
            while j >= 0 and left[j] >= level:
                j = below[j]
            if j < 0 or right[j] >= total:
                left.append(level)
                right.append(total)
                spans.append((start, i + 1))
                below.append(j)
                break
            start, level = spans[j][0], left[j]
            del left[j:], right[j:], spans[j:], below[j:]
    return [(a, b, r - v) for (a, b), v, r in zip(spans, left, right, strict=True)]


@dataclass(frozen=True)
class Model:
    units: dict[str, float] = field(default_factory=dict)
    other: float = 0.0
    decay: float = 1.0
    log_k: float = 0.0
    slope: float = 0.0
    intercept: float = 0.0
    significance: float = 0.05

    def word_score(self, word: str) -> float:
        for unit in units_of(word):
            if unit in self.units:
                return self.units[unit]
        return self.other

    def passages(self, text: str, words: _Scores) -> tuple[float, list[tuple[int, int, float]]]:
        """The evidence, and the significant segments as token positions with their scores."""
        tokens = tokens_of(text)
        scores = np.fromiter(map(words.__getitem__, tokens), "float64", len(tokens))
        told = np.flatnonzero(scores != self.other)
        if not len(told):
            return self._level(len(tokens), 0.0), []
        # Runs of the common score are one item each.
        gaps = np.diff(told, prepend=-1) - 1
        items = np.empty(2 * len(told))
        items[0::2], items[1::2] = gaps * self.other, scores[told]
        found = maximal_segments(items.tolist())
        segments = [
            (int(told[a // 2] if a % 2 else told[a // 2] - gaps[a // 2]), int(told[(b - 1) // 2]) + 1, s)
            for a, b, s in found
        ]
        evidence, toxic = self.evidence(len(tokens), [s for _, _, s in segments])
        return evidence, [segments[i] for i in toxic]

    def evidence(self, n: int, scores: list[float]) -> tuple[float, list[int]]:
        """Evidence of a text of n tokens with these segments, and which of them are significant."""
        limit = -math.log(self.significance)
        excess = [self._level(n, s) for s in scores]
        toxic = [i for i, e in enumerate(excess) if e >= limit]
        if toxic:
            return sum(excess[i] for i in toxic), toxic
        return max(excess, default=self._level(n, 0.0)), []

    def _level(self, n: int, score: float) -> float:
        return self.decay * score - self.log_k - math.log(max(n, 1))

    def probability(self, evidence: float) -> float:
        x = self.slope * min(max(evidence, -50.0), 50.0) + self.intercept
        return 1 / (1 + math.exp(-min(max(x, -30.0), 30.0)))


class _Scores(dict):
    def __init__(self, model: Model):
        self.model = model

    def __missing__(self, word: str) -> float:
        if len(self) > _REMEMBERED_WORDS:
            self.clear()
        score = self[word] = self.model.word_score(word)
        return score


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """Texts with their labels, at most `rows` labelled ids, none of them held out."""
    usable = F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"))
    picked = (
        labels.filter(usable)
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    # Bounded by `rows`, so it may be sent to every task. Copies of a text count once.
    texts = docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(picked), "doc_id")
    first = texts.groupBy(F.xxhash64("text").alias("h"), "text").agg(F.min_by(F.struct("doc_id", "toxic"), "doc_id").alias("first"))
    return stored(first.select("first.doc_id", "text", "first.toxic"))


def fit(
    docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, prior: float = 4.0, clear: float = 4.0
) -> Model:
    sample = labelled_sample(docs, labels, fit_rows).withColumn(
        "calibrates", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 4
    )

    def count_units(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words = {0: Counter(), 1: Counter()}
            for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
                words[toxic].update(set(tokens_of(text)))
            units = {0: Counter(), 1: Counter()}
            for toxic, found in words.items():
                for word, n in found.items():
                    for unit in units_of(word):
                        units[toxic][unit] += n
                units[toxic][""] += sum(found.values())
            names = list(units[0].keys() | units[1].keys())
            yield pd.DataFrame(
                {"unit": names, "t": [units[1][u] for u in names], "c": [units[0][u] for u in names]}
            )

    counts = (
        sample.filter(~F.col("calibrates"))
        .select("text", "toxic")
        .mapInPandas(count_units, "unit string, t long, c long")
        .groupBy("unit")
        .agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
        .persist()
    )
    total = counts.filter("unit = ''").first()
    toxic_all, clean_all = (total["t"], total["c"]) if total else (0, 0)
    if not toxic_all or not clean_all:
        counts.unpersist()
        share = sample.agg(F.avg("toxic")).first()[0] or 0.0
        return Model(intercept=math.log(max(share, 1e-9) / max(1 - share, 1e-9)))

    base = toxic_all / (toxic_all + clean_all)
    word = F.regexp_replace("unit", r"\$$", "")
    shorter = [(F.length(word) - F.when(F.col("unit").endswith("$"), 0).otherwise(1) >= n, n) for n in PREFIXES]
    parent = F.lit("")
    for holds, n in reversed(shorter):
        parent = F.when(holds, F.substring(word, 1, n)).otherwise(parent)
    parents = counts.select(F.col("unit").alias("parent"), F.col("t").alias("pt"), F.col("c").alias("pc"))
    parent_rate = (F.col("pt") + prior * base) / (F.col("pt") + F.col("pc") + prior)
    parent_odds = F.log(parent_rate / (1 - parent_rate))
    rate = (F.col("t") + prior * parent_rate) / (F.col("t") + F.col("c") + prior)
    odds = F.log(rate / (1 - rate))
    spread = F.sqrt(1 / (F.col("t") + prior * parent_rate) + 1 / (F.col("c") + prior * (1 - parent_rate)))
    candidates = counts.filter("unit <> '' and t + c >= 3").withColumn("parent", parent)
    # The empty prefix is the parent of very many units, and its counts are known.
    of_all = candidates.filter("parent = ''").withColumns(
        {"pt": F.lit(toxic_all).cast("long"), "pc": F.lit(clean_all).cast("long")}
    )
    kept = (
        candidates.filter("parent <> ''")
        .join(parents, "parent")
        .unionByName(of_all)
        .withColumn("odds", odds - math.log(base / (1 - base)))
        .filter(F.abs(odds - parent_odds) >= clear * spread)
        .select("unit", "odds", "t", "c")
        .toPandas()
    )
    counts.unpersist()
    units = dict(zip(kept["unit"], kept["odds"].astype(float), strict=True))
    toxic_other, clean_other = toxic_all, clean_all
    # A token counts as told once: by a kept unit none of whose longer forms need be looked at.
    tops = kept[[not any(u.rstrip("$")[:n] in units and u != u.rstrip("$")[:n] for n in PREFIXES) for u in kept["unit"]]]
    toxic_other = max(1.0, toxic_all - float(tops["t"].sum()))
    clean_other = max(1.0, clean_all - float(tops["c"].sum()))
    other = min(-0.01, math.log(toxic_other / toxic_all) - math.log(clean_other / clean_all))
    return _calibrated(sample.filter("calibrates"), Model(units=units, other=other))


def _calibrated(sample: DataFrame, model: Model) -> Model:
    """Fits the extreme-value law and the logistic curve on the rows kept back for it."""
    raw = Model(units=model.units, other=model.other, significance=math.inf)

    def segments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = _Scores(raw)
        for batch in batches:
            found = [raw.passages(t, words)[1] for t in batch["text"]]
            yield pd.DataFrame(
                {
                    "toxic": batch["toxic"],
                    "n": [len(tokens_of(t)) for t in batch["text"]],
                    "scores": [[s for _, _, s in spans] for spans in found],
                }
            )

    kind = "toxic int, n long, scores array<double>"
    rows = sample.select("doc_id", "text", "toxic").orderBy("doc_id").mapInPandas(segments, kind).toPandas()
    n, toxic = rows["n"].to_numpy(), rows["toxic"].to_numpy(dtype="float64")
    top = np.array([max(s, default=0.0) for s in rows["scores"]])
    clean = (toxic == 0) & (n > 0)
    decay, log_k = 1.0, 0.0
    if clean.sum() >= 5:
        # Moments of the Gumbel law of decay * S - ln n, the decay of log-odds being 1 at most.
        decay = min(1.0, math.pi / (math.sqrt(6) * max(float(np.std(top[clean])), 1e-6)))
        log_k = float(np.mean(decay * top[clean] - np.log(n[clean]))) - _EULER
    fitted = Model(units=model.units, other=model.other, decay=decay, log_k=log_k)
    x = np.array([fitted.evidence(k, list(s))[0] for k, s in zip(n, rows["scores"], strict=True)])
    slope, intercept = logistic(x, toxic)
    return Model(model.units, model.other, decay, log_k, slope, intercept)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[float, float]:
    """Slope and intercept by Newton's method; a little ridge keeps separable data finite."""
    w, design = np.array([0.5, -2.0]), np.column_stack([np.clip(x, -50, 50), np.ones(len(x))])
    if not len(x) or y.min() == y.max():
        return float(w[0]), float(w[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        gradient = design.T @ (p - y) + ridge * w
        curve = (design * (p * (1 - p))[:, None]).T @ design + ridge * np.eye(2)
        step = np.linalg.solve(curve, gradient)
        w = w - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def toxicity_of(text: Column, model: Model) -> Column:
    """score and passages (token start, end, segment score) of texts."""

    def score(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        words = _Scores(model)
        for batch in texts:
            found = [model.passages(t, words) for t in batch]
            yield pd.DataFrame(
                {
                    "score": [model.probability(e) for e, _ in found],
                    "passages": [
                        [{"start": a, "end": b, "weight": w} for a, b, w in spans] for _, spans in found
                    ],
                }
            )

    kind = "score double, passages array<struct<start: int, end: int, weight: double>>"
    return F.pandas_udf(score, kind)(text)


def toxic_scores(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted, passages: one row per row of docs."""
    model = fit(docs, labels, fit_rows)
    found = docs.select("doc_id", toxicity_of(text_or_empty(), model).alias("toxicity"))
    score = F.col("toxicity.score")
    return found.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        score.alias("score"),
        (score >= 0.5).cast("int").alias("predicted"),
        F.col("toxicity.passages").alias("passages"),
    )


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of docs that are not called toxic."""
    return docs.filter(toxicity_of(text_or_empty(), model)["score"] < 0.5)
