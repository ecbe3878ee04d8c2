"""Collocations: frequent phrases of two to four words, found by Rabin-Karp fingerprints.

Text is cut into pieces at punctuation and line breaks and those into words, all as numpy arrays over
the bytes of many documents at once. Prefix polynomials give the hash of every word in constant
time and, over the words' hashes, that of every run of words within a piece: its fingerprint, 64 bits
that also hold language and number of words.

  count        fingerprints are counted in each batch and shuffled with their counts and the pointer to an
               occurrence: the part of the documents that it is in, by a hash of the text, the least of all.
               A phrase can only be frequent if its parts are, so words and pairs are counted
               first, then those phrases of three and four words all of whose pairs are frequent.
  filter       frequent fingerprints are marked by three bits each in a bitmap of 2 ** `filter_bits` bits,
               which is all that tasks are given; its size does not grow with the data. Marks can stand
               for another fingerprint too: then more is counted than need be, nothing is missed.
  materialise  only documents of the part that a frequent fingerprint points to give its text. So there is
               about one row for each frequent phrase, however many tasks and occurrences there are.
  verify       a fingerprint goes with 28 bits of another hash, made from other sums over the bytes; where
               phrases collide in the first they are counted apart by the second. Should the
               texts at the pointers of one fingerprint differ all the same, the query ends with an error.

What is shuffled first is at most a row for each different fingerprint of a batch, reduced by a plain
sum. The rest works on frequent phrases only, with joins on language and phrase. The best phrases of a
language are picked in parts before they meet, so that no task sorts a whole language.

Nulls count as empty texts, a null language as `und`. Repeated rows count as often as they are there. Extra
columns are ignored, an empty table gives an empty result. A long text is hashed in windows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.llm.shared import stored
from rollcall.llm.winnowing import Rolling, spread

#: Words of the longest phrase, occurrences of a frequent one, phrases listed for a language.
LONGEST, FREQUENT, LISTED = 4, 30, 2000
#: A phrase goes if a longer one holds this many of 100 of its occurrences.
WITHIN = 80
#: Bits of the filter, as a power of two: 8 MB.
FILTER_BITS = 26
UNKNOWN = "und"
_CHUNK = 1 << 16
#: Bytes of text treated at a time, and of a window of prefix sums.
_GROUP, _WINDOW = 3 << 20, 1 << 20
_PARTS = 64
#: Bits of the part of the documents, and of the second hash.
_PART, _CHECK = 16, 28
_CAPITALS = bytes(range(65, 91))
_LOWER = bytes.maketrans(_CAPITALS, _CAPITALS.lower())
_PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
_BYTES = np.random.default_rng(1987).integers(1, 1 << 63, 256, dtype=np.uint64)
_OTHER_BYTES = np.random.default_rng(1988).integers(1, 1 << 63, 256, dtype=np.uint64)
_APART = np.zeros(256, dtype=np.uint8)
_APART[list(b" \t")] = 1
_APART[list(_PIECE_ENDS)] = 2


@dataclass
class Words:
    """The words of some texts: where each begins and ends in `data`, its piece, row and hashes."""

    data: bytes
    begins: np.ndarray
    ends: np.ndarray
    pieces: np.ndarray
    rows: np.ndarray
    hashes: np.ndarray
    checks: np.ndarray  # another hash of each word
    seeds: np.ndarray  # of each row's language

    def phrases(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Fingerprints of all runs of k words, and which of them lie within a piece."""
        n = max(len(self.hashes) - k + 1, 0)
        if not n:
            return np.empty(0, dtype=np.uint64), np.empty(0, dtype=bool)
        seeds = self.seeds[self.rows[:n]] + np.uint64(k)
        return spread(Rolling(self.hashes, 1).all(k) + spread(seeds)), self.pieces[:n] == self.pieces[k - 1 :]

    def second(self, k: int) -> np.ndarray:
        """The other hash of all runs of k words."""
        return (Rolling(self.checks).all(k) >> np.uint64(64 - _CHECK)).astype(np.int64)

    def grouped(self, k: int, kept: np.ndarray) -> tuple[np.ndarray, ...]:
        """Of the runs of k words that are kept: both hashes of each different one, how many there are, and
        the first of them."""
        at = np.flatnonzero(kept)
        fp, check = self.phrases(k)[0][at], self.second(k)[at]
        order = np.argsort(fp, kind="stable")
        new = fp[order][1:] != fp[order][:-1]
        if np.any(~new & (check[order][1:] != check[order][:-1])):
            order = np.lexsort((check, fp))
            new = (fp[order][1:] != fp[order][:-1]) | (check[order][1:] != check[order][:-1])
        begins = np.flatnonzero(np.append(len(at) > 0, new))
        first = order[begins]
        return fp[first], check[first], np.diff(np.append(begins, len(at))), at[first]

    def texts(self, first: np.ndarray, k: int) -> list[str]:
        """The runs of k words that begin at these words, with one space between."""
        spans = zip(self.begins[first].tolist(), self.ends[first + k - 1].tolist(), strict=True)
        return [b" ".join(self.data[a:b].split()).decode("utf-8", "surrogatepass") for a, b in spans]


def split_words(texts: list[str], langs: list[str]) -> Words:
    parts = [text.encode("utf-8", "surrogatepass") for text in texts]
    data = b"\n".join(parts).translate(_LOWER)
    raw = np.frombuffer(data, dtype=np.uint8)
    apart = _APART[raw]
    inside = apart == 0
    begins = np.flatnonzero(inside & np.append(True, ~inside[:-1])[: len(raw)])
    ends = np.flatnonzero(inside & np.append(~inside[1:], True)[: len(raw)]) + 1
    pieces = np.searchsorted(np.flatnonzero(apart == 2), begins)
    rows = np.searchsorted(np.cumsum([len(p) + 1 for p in parts]), begins, side="right")
    hashes, checks = np.empty((2, len(begins)), dtype=np.uint64)
    a = 0
    while a < len(begins):  # windows of whole words
        b = max(a + 1, int(np.searchsorted(ends, begins[a] + _WINDOW, side="right")))
        low = begins[a]
        sums = Rolling(_BYTES[raw[low : ends[b - 1]]])
        hashes[a:b] = sums.between(begins[a:b] - low, ends[a:b] - low)
        plain = np.append(np.uint64(0), np.cumsum(_OTHER_BYTES[raw[low : ends[b - 1]]]))
        checks[a:b] = spread(plain[ends[a:b] - low] - plain[begins[a:b] - low])
        a = b
    seeds = {lang: xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass"), 11) for lang in set(langs)}
    of_rows = np.array([seeds[lang] for lang in langs], dtype=np.uint64)
    return Words(data, begins, ends, pieces, rows, hashes, checks ^ of_rows[rows], of_rows)


def _groups(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, Words]]:
    """Stretches of a batch of bounded size (or of one row) and their words."""
    a = size = 0
    sizes = pc.binary_length(batch.column("text")).to_pylist()
    for i, n in enumerate([*sizes, 0]):
        if i == len(sizes) or (size and size + n > _GROUP):
            if i > a:
                part = batch.slice(a, i - a)
                yield part, split_words(part.column("text").to_pylist(), part.column("lang").to_pylist())
            a, size = i, 0
        size += n


class Marks:
    """A bitmap of fingerprints: three places each, from their highest, next and lowest bits."""

    def __init__(self, bits: int, chunks: dict[int, bytes]):
        self.bits = bits
        self.map = np.zeros(max(1 << bits, _CHUNK) // 8, dtype=np.uint8)
        for chunk, content in chunks.items():
            at = chunk * (_CHUNK // 8)
            self.map[at : at + len(content)] |= np.frombuffer(content, dtype=np.uint8)

    def holds(self, fingerprints: np.ndarray) -> np.ndarray:
        kept = np.ones(len(fingerprints), dtype=bool)
        for left in self.shifts(self.bits):
            at = np.flatnonzero(kept)
            place = ((fingerprints[at] << np.uint64(left)) >> np.uint64(64 - self.bits)).astype(np.int64)
            kept[at] = (self.map[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1 == 1
        return kept

    @staticmethod
    def shifts(bits: int) -> tuple[int, ...]:
        """By how much a fingerprint is shifted to the left for the bits of each place to lead."""
        return 0, bits, 64 - bits


def _prepared(docs: DataFrame) -> DataFrame:
    lang, text = F.coalesce("lang", F.lit(UNKNOWN)), F.coalesce("text", F.lit(""))
    part = F.xxhash64(text).bitwiseAND(F.lit((1 << _PART) - 1))
    return docs.select("doc_id", lang.alias("lang"), text.alias("text"), part.alias("part"))


def _frequent(docs: DataFrame, lengths: list[int], marks, least: int) -> DataFrame:
    """fp, check, a, part: the phrases of these lengths that are found `least` times or more, in the
    shared folder. With marks, only phrases whose pairs are all marked are counted."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # In the order of parts, so that the first occurrence is in the least.
            batch = batch.take(pc.sort_indices(batch.column("part")))
            for some, words in _groups(batch):
                part = some.column("part").to_numpy()
                if marks is not None:
                    found, pairs = words.phrases(2)
                    pairs = pairs & marks.value.holds(found)
                for k in lengths:
                    kept = words.phrases(k)[1]
                    if marks is not None:
                        for j in range(k - 1 if len(kept) else 0):
                            kept = kept & pairs[j : j + len(kept)]
                    fp, check, n, first = words.grouped(k, kept)
                    pointer = (part[words.rows[first]] << _CHECK) | check
                    columns = [pa.array(fp.view(np.int64)), pa.array(n), pa.array(pointer)]
                    yield pa.RecordBatch.from_arrays(columns, names=["fp", "n", "pointer"])

    # Counts are combined within a batch; what is left is mostly different, so it is shuffled as it is.
    counted = docs.select("lang", "text", "part").mapInArrow(count, "fp long, n long, pointer long").repartition("fp")
    check = F.col("pointer").bitwiseAND(F.lit((1 << _CHECK) - 1)).alias("check")
    reduced = counted.groupBy("fp", check).agg(F.sum("n").alias("a"), F.min("pointer").alias("pointer"))
    return stored(
        reduced.filter(F.col("a") >= least).select(
            "fp", "check", "a", F.shiftrightunsigned("pointer", _CHECK).alias("part")
        )
    )


#: Where the bits of a part are put in a fingerprint for a mark of both.
_PLACES = (38, 12, 0)


def _of_part(fp: Column, part: Column) -> Column:
    for left in _PLACES:
        fp = fp.bitwiseXOR(F.shiftleft(part, left))
    return fp


def _of_parts(fp: np.ndarray, part: np.ndarray) -> np.ndarray:
    for left in _PLACES:
        fp = fp ^ (part.astype(np.uint64) << np.uint64(left))
    return fp


def _marked(frequent: DataFrame, bits: int) -> dict[int, bytes]:
    """The bitmap of these fingerprints, in chunks; no larger than the whole bitmap."""
    shifted = [F.shiftrightunsigned(F.shiftleft("fp", left), 64 - bits) for left in Marks.shifts(bits)]
    place = F.col("place")
    places = frequent.select(F.explode(F.array(*shifted)).alias("place")).select(
        (place / _CHUNK).cast("int").alias("chunk"), (place % _CHUNK).cast("int").alias("at")
    )

    def pack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        marks = np.zeros(_CHUNK, dtype=np.uint8)
        marks[rows["at"].to_numpy()] = 1
        return pd.DataFrame({"chunk": [int(key[0])], "content": [np.packbits(marks).tobytes()]})

    chunks = places.distinct().groupBy("chunk").applyInPandas(pack, "chunk int, content binary")
    return {row.chunk: bytes(row.content) for row in chunks.toLocalIterator()}


def _materialised(docs: DataFrame, marks) -> DataFrame:
    """fp, check, lang, k, phrase, n, doc_id, word: the phrases that are marked for the part of a
    document; k = 0 has the number of words of a language."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some, words in _groups(batch):
                part = some.column("part").to_numpy()
                offset = np.searchsorted(words.rows, words.rows)
                totals = _totals(words, some.column("lang").to_pylist())
                none = [None] * len(totals)
                yield made(some, none, none, list(totals), 0, none, list(totals.values()), none)
                for k in range(1, LONGEST + 1):
                    fp, kept = words.phrases(k)
                    kept &= marks.value.holds(_of_parts(fp, part[words.rows[: len(fp)]]))
                    fp, check, n, first = words.grouped(k, kept)
                    texts, places = words.texts(first, k), first - offset[first]
                    yield made(some, fp.view(np.int64), check, words.rows[first], k, texts, n, places)

    def made(some: pa.RecordBatch, fp, check, rows, k: int, texts, n, places) -> pa.RecordBatch:
        taken = pa.array(rows, pa.int64())
        columns = [
            pa.array(fp, pa.int64()),
            pa.array(check, pa.int64()),
            some.column("lang").take(taken),
            pa.array([k] * len(taken), pa.int32()),
            pa.array(texts, pa.string()),
            pa.array(n, pa.int64()),
            some.column("doc_id").take(taken),
            pa.array(places, pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=kind.names)

    kind = T.StructType.fromDDL("fp long, check long, lang string, k int, phrase string, n long")
    kind = kind.add("doc_id", docs.schema["doc_id"].dataType).add("word", T.LongType())
    return docs.mapInArrow(read, kind)


def _totals(words: Words, langs: list[str]) -> dict[int, int]:
    """Number of words of each language, under one of its rows."""
    count = np.bincount(words.rows, minlength=len(langs)).tolist()
    where, total = {}, {}
    for i, (lang, n) in enumerate(zip(langs, count, strict=True)):
        row = where.setdefault(lang, i)
        total[row] = total.get(row, 0) + n
    return total


def frequent_phrases(docs: DataFrame, least: int = FREQUENT, filter_bits: int = FILTER_BITS) -> DataFrame:
    """lang, k, phrase, a, doc_id, word: phrases of one to four words found `least` times or more.

    k = 0 stands for all words of a language. doc_id and word (its number among the words of the text,
    from 0) are the place of an occurrence.
    """
    docs = _prepared(docs)
    context = docs.sparkSession.sparkContext
    few = _frequent(docs, [1, 2], None, least)
    marks = context.broadcast(Marks(filter_bits, _marked(few, filter_bits)))
    many = _frequent(docs, list(range(3, LONGEST + 1)), marks, least)
    frequent = few.unionByName(many)
    pointers = frequent.select(_of_part(F.col("fp"), F.col("part")).alias("fp"))
    owners = context.broadcast(Marks(filter_bits, _marked(pointers, filter_bits)))
    texts = stored(_materialised(docs, owners))
    phrase, place = F.struct("lang", "k", "phrase"), F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "word")
    told = texts.filter("k > 0").groupBy("fp", "check").agg(
        F.min(phrase).alias("phrase"), F.max(phrase).alias("other"), F.min(place).alias("place")
    )
    same = F.when(F.col("phrase") == F.col("other"), F.col("phrase.phrase")).otherwise(
        F.raise_error(F.lit("two phrases have one fingerprint")).cast("string")
    )
    found = frequent.drop("part").join(told, ["fp", "check"]).select(
        "phrase.lang", "phrase.k", same.alias("phrase"), "a", "place.doc_id", "place.word"
    )
    totals = texts.filter("k = 0").groupBy("lang", "k").agg(F.sum("n").alias("a"))
    return stored(found.unionByName(totals, allowMissingColumns=True))


def _exact(value: Column | str) -> Column:
    """A whole number of any size that can come up here."""
    return (F.col(value) if isinstance(value, str) else value).cast("decimal(20,0)")


def scored(found: DataFrame) -> DataFrame:
    """Phrases of two words or more with l, r and score of their lowest-scoring cut."""
    words, k = F.split("phrase", " "), F.col("k")

    def cut(i: Column) -> Column:
        first, rest = F.slice(words, F.lit(1), i), F.slice(words, i + 1, k - i)
        return F.struct(i.alias("cut"), F.array_join(first, " ").alias("first"), F.array_join(rest, " ").alias("rest"))

    cuts = found.filter("k > 1").select(
        "lang", "phrase", "a", F.inline(F.transform(F.sequence(F.lit(1), k - 1), cut))
    )
    parts = found.filter("k BETWEEN 1 AND 3")
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("first"), F.col("a").alias("l")), ["lang", "first"])
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r")), ["lang", "rest"])
    # Whole numbers throughout: the product can pass 64 bits.
    cuts = cuts.withColumns({"top": _exact("a") * 2_000_000, "sum": _exact("l") + _exact("r")})
    best = F.min(F.struct(F.expr("top div sum").alias("score"), "cut", "l", "r"))
    return cuts.groupBy("lang", "phrase").agg(best.alias("best")).select("lang", "phrase", "best.l", "best.r", "best.score")


def not_within_longer(found: DataFrame, within: int = WITHIN) -> DataFrame:
    """Phrases of two words or more less those that mostly occur as part of a longer one."""
    phrases = found.filter("k > 1")
    words, k = F.split("phrase", " "), F.col("k")
    parts = F.flatten(
        F.transform(
            F.sequence(F.lit(2), k - 1),
            lambda m: F.transform(F.sequence(F.lit(1), k - m + 1), lambda i: F.array_join(F.slice(words, i, m), " ")),
        )
    )
    longer = (
        phrases.filter("k > 2")
        .select("lang", F.explode(parts).alias("phrase"), "a")
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("most"))
    )
    mostly = F.coalesce(_exact("most") * 100 >= _exact("a") * within, F.lit(False))
    return phrases.join(longer, ["lang", "phrase"], "left").filter(~mostly).drop("most")


def collocations(
    docs: DataFrame, least: int = FREQUENT, listed: int = LISTED, within: int = WITHIN, filter_bits: int = FILTER_BITS
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score, doc_id, word: the best phrases of each language."""
    found = frequent_phrases(docs, least, filter_bits)
    kept = not_within_longer(found, within).join(scored(found), ["lang", "phrase"])
    totals = found.filter("k = 0").select("lang", F.col("a").alias("n"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.hash("phrase"), F.lit(_PARTS))
    in_part = Window.partitionBy("lang", "part").orderBy(*order)
    in_lang = Window.partitionBy("lang").orderBy(*order)
    best = kept.withColumn("part", part).withColumn("rank", F.row_number().over(in_part)).filter(F.col("rank") <= listed)
    best = best.withColumn("rank", F.row_number().over(in_lang).cast("long")).filter(F.col("rank") <= listed)
    return best.join(totals, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"), "doc_id", "word"
    )


def collocations_sql(least: int = FREQUENT, listed: int = LISTED, within: int = WITHIN) -> str:
    """The same without the pointers over a view named documents, in DuckDB SQL."""
    capitals = _CAPITALS.decode()
    leads = ", ".join(f"lead(word, {k}) OVER here AS w{k + 1}" for k in range(1, LONGEST))
    runs = " UNION ALL ".join(
        f"SELECT lang, {k} AS k, concat_ws(' ', {', '.join(f'w{j}' for j in range(1, k + 1))}) AS phrase "
        f"FROM y WHERE w{k} IS NOT NULL"
        for k in range(1, LONGEST + 1)
    )
    return rf"""
WITH d AS (SELECT coalesce(lang, '{UNKNOWN}') AS lang,
                  translate(coalesce(text, ''), '{capitals}', '{capitals.lower()}') AS text FROM documents),
     p AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
     w AS (SELECT lang, row_number() OVER () AS id, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
     x AS (SELECT lang, id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM w),
     y AS (SELECT lang, word AS w1, {leads} FROM x WINDOW here AS (PARTITION BY id ORDER BY i)),
     o AS ({runs}),
     f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS a FROM o GROUP BY ALL HAVING count(*) >= {least}),
     n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
     c AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
     ends AS MATERIALIZED (SELECT lang, phrase, a, i, array_to_string(w[1:i], ' ') AS first,
                                  array_to_string(w[i + 1:k], ' ') AS rest
                           FROM (SELECT *, unnest(range(1, k)) AS i FROM c)),
     cuts AS (SELECT e.lang, e.phrase, e.a, i, x.a AS l, y.a AS r,
                     (2000000::HUGEINT * e.a) // (x.a + y.a) AS score
              FROM ends e JOIN f x ON x.lang = e.lang AND x.phrase = e.first
              JOIN f y ON y.lang = e.lang AND y.phrase = e.rest),
     best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, i) = 1),
     parts AS (SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS most
               FROM (SELECT *, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM c))
               GROUP BY ALL),
     kept AS (SELECT b.* FROM best b LEFT JOIN parts q ON q.lang = b.lang AND q.phrase = b.phrase
              WHERE q.most IS NULL OR 100::HUGEINT * q.most < {within}::HUGEINT * b.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, score::BIGINT AS score
FROM kept JOIN n USING (lang) QUALIFY rank <= {listed}"""
