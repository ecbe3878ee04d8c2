"""Document fingerprints: sketches scaled by a threshold.

A text is a set of shingles of five words. A shingle's hash is the first 64 bits of its MD5, and the
sketch keeps every hash below a fixed fraction of all values, 1 / `SCALE`. Which hash is kept depends
on the hash alone, so the sketch of two texts together is the union of their sketches, and the share
of a small text's sketch that a large one holds estimates the share of the small text itself, however
unequal the two are. Only built-in functions take part: no row leaves the JVM.

A fingerprint is the text form of a sketch: its hashes in order, 16 hexadecimal digits each. Equal
texts have equal fingerprints. A text with words none of whose hashes lies below the threshold keeps
its least hash, so that only a text without words has the empty fingerprint; in a union that hash
goes as soon as there is another. Words end at ASCII white space; in scripts written without spaces
each character is a word. A text of fewer than five words is one shingle.

`next_texts` puts every row beside the row that follows by falling doc_id (rows without one come last;
among equal ids, rows are in order of a digest of the text) and the last beside the first. Neighbours
are found in a narrow table of keys, dealt by ranges; only then the part of a text that its
neighbour needs is sent there. So no task holds more than a range of the order, and texts are
shuffled once. Repeated rows are one row with a count until the end: all but the last are followed
by their like.

Nulls count as empty texts; an only row follows itself; extra columns are ignored and an empty table
gives an empty result. A text of any length takes linear time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.llm.shared import WORD, stored, text_or_empty

#: Words of a shingle; one hash in so many is kept.
SHINGLE, SCALE = 5, 8
#: Characters that are words of their own: kana, Han, Hangul.
ALONE = r"[\x{3040}-\x{30FF}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{AC00}-\x{D7AF}]"
_DIGITS = 16


def threshold(scale: int) -> str:
    """The least hash that is not kept, as hexadecimal digits."""
    return f"{(1 << 64) // scale:0{_DIGITS}x}"


def with_fingerprint(df: DataFrame, text: str, name: str, scale: int = SCALE) -> DataFrame:
    """Adds the fingerprint of a text column as column `name`."""
    # Each step is a column of its own, so that it is computed once and not for each of its uses.
    words, hashes, below = (f"{name}_{step}" for step in ("words", "hashes", "below"))
    given = F.col(text)
    spaced = F.when(given.rlike(ALONE), F.regexp_replace(given, f"({ALONE})", " $1 ")).otherwise(given)

    def hashed(i: Column) -> Column:
        shingle = F.concat_ws(" ", *[F.get(words, i + k) for k in range(SHINGLE)])
        return F.substring(F.md5(shingle), 1, _DIGITS)

    n = F.size(words)
    shingles = F.transform(F.sequence(F.lit(0), F.greatest(n - SHINGLE, F.lit(0))), hashed)
    kept = F.when(F.size(below) > 0, F.array_distinct(below)).otherwise(F.slice(F.sort_array(hashes), 1, 1))
    return (
        df.withColumn(words, F.regexp_extract_all(spaced, F.lit(WORD), F.lit(0)))
        .withColumn(hashes, F.when(n > 0, shingles).otherwise(F.array().cast("array<string>")))
        .withColumn(below, F.filter(hashes, lambda h: h < F.lit(threshold(scale))))
        .withColumn(name, F.array_join(F.sort_array(kept), ""))
        .drop(words, hashes, below)
    )


def hashes_of(fingerprint: Column) -> Column:
    return F.regexp_extract_all(fingerprint, F.lit(f".{{{_DIGITS}}}"), F.lit(0))


def merged(a: Column, b: Column, scale: int = SCALE) -> Column:
    """The fingerprint of two texts together, from theirs."""
    both = F.sort_array(F.array_union(hashes_of(a), hashes_of(b)))
    below = F.filter(both, lambda h: h < F.lit(threshold(scale)))
    return F.array_join(F.when(F.size(below) > 0, below).otherwise(F.slice(both, 1, 1)), "")


def _size(fingerprint: Column) -> Column:
    return (F.length(fingerprint) / _DIGITS).cast("long")


def _shared(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(hashes_of(a), hashes_of(b))).cast("long")


def containment(a: Column, b: Column) -> Column:
    """The share of the first text's shingles that the second has too; 1 for a text without any."""
    return F.when(a == "", 1.0).otherwise(_shared(a, b).cast("double") / _size(a))


def likeness(a: Column, b: Column) -> Column:
    """The share of both texts' shingles that are in both; 1 where neither has any."""
    shared = _shared(a, b)
    both = _size(a) + _size(b) - shared
    return F.when(a == b, 1.0).otherwise(shared.cast("double") / both)


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text and k, which tells rows apart that differ in either."""
    text = text_or_empty()
    known = F.when(F.col("doc_id").isNull(), "").otherwise(F.concat(F.lit("="), F.col("doc_id").cast("string")))
    return docs.select("doc_id", text.alias("text"), F.md5(F.concat(F.md5(text), known)).alias("k"))


def _before(keyed: DataFrame) -> DataFrame:
    """k, before, n: the key that each key follows, and that one's length in code points."""
    order = [F.desc_nulls_last("doc_id"), F.asc("k")]
    keys = keyed.groupBy("k").agg(F.first("doc_id").alias("doc_id"), F.first(F.length("text")).alias("n"))
    ranges = stored(keys.repartitionByRange(*order).withColumn("part", F.spark_partition_id()))
    here = Window.partitionBy("part").orderBy(*order)
    row = F.struct("k", "n")
    placed = ranges.select(
        "part", "k", F.lag(row).over(here).alias("inside"), row.alias("row"), F.lead("k").over(here).alias("after")
    )
    # The last row of each range comes before the first of the next one: a row for each range.
    over = Window.orderBy("part")
    last = placed.filter("after IS NULL").select("part", "row")
    whole = over.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    borders = last.select("part", F.coalesce(F.lag("row").over(over), F.last("row").over(whole)).alias("border"))
    found = F.coalesce("inside", "border")
    return placed.join(borders, "part").select("k", found["k"].alias("before"), found["n"].alias("n"))


def next_texts(docs: DataFrame, scale: int = SCALE) -> DataFrame:
    """doc_id, text, next_fingerprint, head, copies: each row with what it needs of the one that follows.

    `head` is the start of that text, a third as long as the row's own; `copies` says how many rows
    the result row stands for.
    """
    keyed = _keyed(docs)
    single = keyed.groupBy("k").agg(
        F.first(F.struct("doc_id", "text")).alias("row"), F.count("*").alias("copies")
    )
    # Both sides of the join below read the same columns, so the texts are shuffled once.
    followers = single.filter("copies > 0 AND isnotnull(row.text)").join(_before(keyed), "k")
    third = F.floor(F.col("n") / 3).cast("int")
    sent = with_fingerprint(
        followers.select("before", "n", F.col("row.text").alias("text")), "text", "next_fingerprint", scale
    ).select(
        F.col("before").alias("k"),
        F.substring("text", F.lit(1), third).alias("head"),
        F.unhex("next_fingerprint").alias("sketch"),
    )
    own = single.filter("copies > 0 AND isnotnull(row.text)")
    return own.join(sent, "k").select("row.*", "copies", "head", F.lower(F.hex("sketch")).alias("next_fingerprint"))


def edited_fingerprints(docs: DataFrame, scale: int = SCALE) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next,
    contained_edited, contained_next: one row per row of docs.

    The edited text has its last third replaced by the start of the next text. `near_` is the
    likeness to the edited and to the next text, `contained_` the share of the text found there.
    """
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    rows = with_fingerprint(next_texts(docs, scale), "text", "fingerprint", scale)
    # A repeated row is followed by itself, but for the last of them.
    like = F.struct(
        (F.col("copies") - 1).alias("times"),
        F.substring("text", F.lit(1), third).alias("head"),
        F.col("fingerprint").alias("next_fingerprint"),
    )
    other = F.struct(F.lit(1).cast("long").alias("times"), "head", "next_fingerprint")
    both = F.when(F.col("copies") > 1, F.array(other, like)).otherwise(F.array(other))
    rows = rows.select("doc_id", "text", "fingerprint", F.inline(both))
    edited = F.concat(F.substring("text", F.lit(1), n - third), F.col("head"))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), "fingerprint", "next_fingerprint", "times", edited.alias("edited"))
    rows = with_fingerprint(rows, "edited", "edited_fingerprint", scale)
    own, new, following = (F.col(c) for c in ("fingerprint", "edited_fingerprint", "next_fingerprint"))
    rows = rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        likeness(own, new).alias("near_edited"),
        likeness(own, following).alias("near_next"),
        containment(own, new).alias("contained_edited"),
        containment(own, following).alias("contained_next"),
        "times",
    )
    repeated = F.when(F.col("times") > 1, F.sequence(F.lit(1).cast("long"), "times")).otherwise(F.array(F.lit(1).cast("long")))
    return rows.withColumn("copy", F.explode(repeated)).drop("times", "copy")


def edited_fingerprints_sql(scale: int = SCALE) -> str:
    """The same over a view named documents, in DuckDB SQL."""

    def hashes(text: str) -> str:
        words = f"regexp_extract_all(regexp_replace({text}, '({ALONE})', ' \\1 ', 'g'), '{WORD}')"
        shifted = ", ".join(f"w[{k}:]" for k in range(1, SHINGLE + 1))
        shingle = ", ".join(f"z[{k}]" for k in range(1, SHINGLE + 1))
        hashed = (
            f"list_transform(list_zip({shifted})[1:greatest(len(w) - {SHINGLE - 1}, 1)], "
            f"lambda z: substr(md5(concat_ws(' ', {shingle})), 1, {_DIGITS}))"
        )
        return f"(SELECT CASE WHEN len(w) = 0 THEN [] ELSE {hashed} END FROM (SELECT {words} AS w))"

    def sketch(hashes: str) -> str:
        below = f"list_filter({hashes}, lambda h: h < '{threshold(scale)}')"
        return (
            f"list_sort(list_distinct(CASE WHEN len({below}) > 0 THEN {below} "
            f"ELSE list_sort({hashes})[1:1] END))"
        )

    def near(a: str, b: str) -> str:
        shared = f"len(list_intersect({a}, {b}))"
        return f"CASE WHEN {a} = {b} THEN 1.0 ELSE {shared} / (len({a}) + len({b}) - {shared}) END::DOUBLE"

    def within(a: str, b: str) -> str:
        return f"CASE WHEN len({a}) = 0 THEN 1.0 ELSE len(list_intersect({a}, {b})) / len({a}) END::DOUBLE"

    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
     o AS (SELECT *, row_number() OVER (ORDER BY doc_id DESC NULLS LAST,
                  md5(md5(text) || CASE WHEN doc_id IS NULL THEN '' ELSE '=' || doc_id END)) AS i,
                  count(*) OVER () AS m FROM d),
     e AS (SELECT a.doc_id, a.i, length(a.text) AS n_chars, a.text, b.text AS following,
                  substr(a.text, 1, length(a.text) - length(a.text) // 3)
                  || substr(b.text, 1, length(a.text) // 3) AS edited
           FROM o a JOIN o b ON b.i = a.i % a.m + 1),
     h AS (SELECT *, {hashes("text")} AS own_h, {hashes("edited")} AS new_h, {hashes("following")} AS next_h FROM e),
     s AS (SELECT doc_id, n_chars, edited, {sketch("own_h")} AS own, {sketch("new_h")} AS new, {sketch("next_h")} AS follows
           FROM h)
SELECT doc_id, n_chars, sha256(edited) AS edited_sha256,
       coalesce(array_to_string(own, ''), '') AS fingerprint,
       coalesce(array_to_string(new, ''), '') AS edited_fingerprint,
       {near("own", "new")} AS near_edited, {near("own", "follows")} AS near_next,
       {within("own", "new")} AS contained_edited, {within("own", "follows")} AS contained_next
FROM s"""
