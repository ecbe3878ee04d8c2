"""Licence scans by sentence rules, with built-in DataFrame functions only.

A text is cut into sentences, a sentence is normalised (ASCII lower case, other characters than
letters and digits as one space), and each known licence sentence becomes its identifier; other
sentences that speak of a licence or copyright become UNKNOWN, all others nothing. The identifiers
of a document, in order, are then matched with the licence rules: the rules are tried in their
order, longer sequences first, and what a rule matches is consumed and names its licence.

Null and empty texts have no sentences and no licence. The scan is row by row: repeated rows give
equal rows, extra columns are ignored, an empty table gives an empty result, and a very long text
is a few values of one task. A line break followed by a small letter is a wrapped line, any other
line break ends a sentence.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.shared import text_or_empty

#: Known sentences of public licences and of licence notices; fixed values.
SENTENCES = {
    "mit-notice": "Released under the MIT License.",
    "mit-notice-2": "Licensed under the MIT License.",
    "mit-notice-3": "This project is licensed under the MIT License.",
    "mit-title": "The MIT License (MIT)",
    "mit-title-2": "MIT License",
    "mit-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction, '
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, "
        "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
        "furnished to do so, subject to the following conditions:"
    ),
    "mit-condition": (
        "The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software."
    ),
    "apache-2-notice": "Licensed under the Apache License, Version 2.0.",
    "apache-2-notice-2": 'Licensed under the Apache License, Version 2.0 (the "License");',
    "apache-2-condition": "you may not use this file except in compliance with the License.",
    "apache-2-copy": "You may obtain a copy of the License at",
    "gpl-3-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3-notice-2": "Licensed under the GNU General Public License, version 3.",
    "gpl-2-notice": "This work is licensed under the GNU General Public License, version 2.",
    "gpl-grant": "This program is free software:",
    "gpl-3-later": (
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) "
        "any later version."
    ),
    "gpl-copy": "You should have received a copy of the GNU General Public License along with this program.",
    "bsd-grant": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met:"
    ),
    "bsd-source": (
        "Redistributions of source code must retain the above copyright notice, this list of conditions "
        "and the following disclaimer."
    ),
    "bsd-binary": (
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions "
        "and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution."
    ),
    "bsd-names": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse "
        "or promote products derived from this software without specific prior written permission."
    ),
    "bsd-3-notice": "Licensed under the 3-Clause BSD License.",
    "isc-grant": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
        "fee is hereby granted, provided that the above copyright notice and this permission notice appear "
        "in all copies."
    ),
    "mpl-2-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v.",
    "cc-by-nc-4-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4-notice": "Licensed under CC BY-SA 4.0.",
    "cc-by-4-notice": "Licensed under CC BY 4.0.",
    "cc0-notice": "Licensed under CC0 1.0.",
    "unlicense-notice": "This is free and unencumbered software released into the public domain.",
    "reserved": "All rights reserved.",
}

#: Licence rules in the order in which they are tried: the sentences in sequence, and the licence.
RULES = (
    (("mit-title", "mit-grant", "mit-condition"), "MIT"),
    (("mit-title-2", "mit-grant", "mit-condition"), "MIT"),
    (("mit-grant", "mit-condition"), "MIT"),
    (("bsd-grant", "bsd-source", "bsd-binary", "bsd-names"), "BSD-3-Clause"),
    (("bsd-grant", "bsd-source", "bsd-binary"), "BSD-2-Clause"),
    (("apache-2-notice-2", "apache-2-condition", "apache-2-copy"), "Apache-2.0"),
    (("apache-2-notice-2", "apache-2-condition"), "Apache-2.0"),
    (("gpl-grant", "gpl-3-later", "gpl-copy"), "GPL-3.0-or-later"),
    (("gpl-grant", "gpl-3-later"), "GPL-3.0-or-later"),
    (("mit-notice",), "MIT"),
    (("mit-notice-2",), "MIT"),
    (("mit-notice-3",), "MIT"),
    (("apache-2-notice",), "Apache-2.0"),
    (("apache-2-notice-2",), "Apache-2.0"),
    (("gpl-3-notice",), "GPL-3.0-only"),
    (("gpl-3-notice-2",), "GPL-3.0-only"),
    (("gpl-2-notice",), "GPL-2.0-only"),
    (("bsd-3-notice",), "BSD-3-Clause"),
    (("isc-grant",), "ISC"),
    (("mpl-2-notice",), "MPL-2.0"),
    (("cc-by-nc-4-notice",), "CC-BY-NC-4.0"),
    (("cc-by-sa-4-notice",), "CC-BY-SA-4.0"),
    (("cc-by-4-notice",), "CC-BY-4.0"),
    (("cc0-notice",), "CC0-1.0"),
    (("unlicense-notice",), "Unlicense"),
    (("reserved",), "all-rights-reserved"),
)

#: Every known sentence has one of these; other sentences with one of the first two are UNKNOWN.
SPEAKS = "licen[cs]e|copyright"
HINTS = f"{SPEAKS}|rights reserved|redistribut|free software|unencumbered|provided that|permission"
#: The hints as they may stand in a text before it is normalised.
RAW_HINTS = f"(?i){HINTS.replace(' ', '[^A-Za-z0-9]+')}"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WRAP, END, OTHER = r"\n[ \t]*([a-z(])", r"[.!?;:]+[ \t\r\n\f]+|\n+", r"[^a-z0-9\n]+"


def normalised(sentence: str) -> str:
    """A known sentence as it appears among the normalised ones of a text."""
    ended = re.sub(END, "\n", sentence.lower() + "\n")
    return re.sub(OTHER, " ", ended).strip(" \n")


def _known() -> dict[str, str]:
    return {normalised(s): name for name, s in SENTENCES.items() if "\n" not in normalised(s)}


def normalised_sentences(text: Column) -> Column:
    """The sentences of texts, normalised, in order; empty ones included."""
    unwrapped = F.regexp_replace(F.concat(text, F.lit("\n")), WRAP, " $1")
    ended = F.regexp_replace(F.translate(unwrapped, UPPER, LOWER), END, "\n")
    return F.transform(F.split(F.regexp_replace(ended, OTHER, " "), "\n"), lambda x: F.trim(x))


def sentence_ids(text: Column) -> Column:
    """Identifiers of the licence sentences of texts, in order."""
    known = F.create_map(*[F.lit(x) for pair in sorted(_known().items()) for x in pair])

    def identifier(sentence: Column) -> Column:
        # An array of one or none, so that sentences of no interest leave nothing behind.
        found = F.element_at(known, sentence)
        unknown = F.when(sentence.rlike(SPEAKS), F.lit("UNKNOWN"))
        return F.when(sentence.rlike(HINTS), F.coalesce(found, unknown))

    ids = F.filter(F.transform(normalised_sentences(text), identifier), lambda x: x.isNotNull())
    # Most texts have no hint of a licence and are not cut at all.
    return F.when(text.rlike(RAW_HINTS), ids).otherwise(F.array().cast("array<string>"))


def licences(docs: DataFrame) -> DataFrame:
    """doc_id, sentence_ids, licences (in order of the text), n_unknown: one row per row of docs."""
    text = text_or_empty()
    joined = F.concat(F.lit(","), F.array_join("ids", ",,"), F.lit(","))
    matched = F.when(F.size("ids") > 0, joined).otherwise(F.lit(""))
    for sequence, licence in RULES:
        matched = F.replace(matched, F.lit("".join(f",{x}," for x in sequence)), F.lit(f",!{licence},"))
    named = F.filter(F.split("matched", ","), lambda x: x.startswith("!"))
    return (
        docs.select("doc_id", sentence_ids(text).alias("ids"))
        .select("doc_id", "ids", matched.alias("matched"))
        .select(
            "doc_id",
            F.array_join("ids", ",").alias("sentence_ids"),
            F.array_join(F.transform(named, lambda x: F.substring(x, 2, 100)), ",").alias("licences"),
            F.size(F.filter("ids", lambda x: x == "UNKNOWN")).cast("long").alias("n_unknown"),
        )
    )


def licences_sql() -> str:
    """The same over the view `documents`, for DuckDB: sentences unnested and joined with the table."""

    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    known = ", ".join(f"({quoted(s)}, {quoted(name)})" for s, name in sorted(_known().items()))
    matched = "joined"
    for sequence, licence in RULES:
        matched = f"replace({matched}, {quoted(''.join(f',{x},' for x in sequence))}, {quoted(f',!{licence},')})"
    wrap, end, other = (x.replace(r"\t", "\t").replace(r"\n", "\n").replace(r"\r", "\r").replace(r"\f", "\f") for x in (WRAP, END, OTHER))
    return f"""
WITH known(sentence, id) AS (VALUES {known}),
numbered AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS n FROM documents),
cut AS (
  SELECT n, string_split(regexp_replace(regexp_replace(translate(regexp_replace(
    text || chr(10), {quoted(wrap)}, ' \\1', 'g'), '{UPPER}', '{LOWER}'), {quoted(end)}, chr(10), 'g'),
    {quoted(other)}, ' ', 'g'), chr(10)) AS sentences FROM numbered),
placed AS (SELECT n, unnest(sentences) AS sentence, generate_subscripts(sentences, 1) AS place FROM cut),
ids AS (
  SELECT n, place, coalesce(k.id, 'UNKNOWN') AS id
  FROM placed p LEFT JOIN known k ON k.sentence = trim(p.sentence)
  WHERE k.id IS NOT NULL OR regexp_matches(p.sentence, '{SPEAKS}')),
per_text AS (
  SELECT n, string_agg(id, ',' ORDER BY place) AS sentence_ids,
         string_agg(',' || id || ',', '' ORDER BY place) AS joined,
         count(*) FILTER (id = 'UNKNOWN') AS n_unknown FROM ids GROUP BY n),
named AS (SELECT n, sentence_ids, n_unknown, {matched} AS matched FROM per_text)
SELECT doc_id, coalesce(sentence_ids, '') AS sentence_ids,
       coalesce(array_to_string([x[2:] FOR x IN string_split(matched, ',') IF x LIKE '!%'], ','), '')
         AS licences,
       coalesce(n_unknown, 0) AS n_unknown
FROM numbered LEFT JOIN named USING (n)"""
