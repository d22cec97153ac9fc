"""Licences by sentence: known sentences get identifiers, and the sequence of identifiers is matched with ordered rules.

A text is cut into sentences, these are normalised and compared with the starts of known licence sentences; the known
ones of a text form a sequence. Rules, the longer and more special first, each name a licence and a sequence; a rule that
is found takes its sentences away from later ones. All of it is row-wise expressions, so nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Starts of licence sentences, normalised (lower case, letters and digits, single spaces), by identifier.
SENTENCES = {
    "agpl-name": "gnu affero general public license",
    "agpl-redistribute": "you can redistribute it and or modify it under the terms of the gnu affero general public license",
    "agpl3-under": "licensed under the gnu affero general public license version 3",
    "apache-under": "licensed under the apache license version 2 0",
    "apache-may-not": "you may not use this file except in compliance with the license",
    "apache-obtain": "you may obtain a copy of the license at",
    "apache-unless": "unless required by applicable law or agreed to in writing software distributed under the license",
    "bsd-redistribution": "redistribution and use in source and binary forms with or without modification are permitted",
    "bsd-source": "redistributions of source code must retain the above copyright notice",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice",
    "bsd-name": "neither the name of",
    "bsd-provided": "this software is provided by the copyright holders and contributors as is",
    "bsd2-under": "licensed under the bsd 2 clause license",
    "bsd3-under": "licensed under the bsd 3 clause license",
    "cc0-under": "licensed under cc0 1 0",
    "cc-by-nc-nd-under": "licensed under cc by nc nd 4 0",
    "cc-by-nc-sa-under": "licensed under cc by nc sa 4 0",
    "cc-by-nc-under": "licensed under cc by nc 4 0",
    "cc-by-sa-under": "licensed under cc by sa 4 0",
    "cc-by-nd-under": "licensed under cc by nd 4 0",
    "cc-by-under": "licensed under cc by 4 0",
    "gpl2-under": "this work is licensed under the gnu general public license version 2",
    "gpl3-under": "this work is licensed under the gnu general public license version 3",
    "gpl-free": "this program is free software",
    "gpl-redistribute": "you can redistribute it and or modify it under the terms of the gnu general public license",
    "gpl-warranty": "this program is distributed in the hope that it will be useful but without any warranty",
    "gpl-received": "you should have received a copy of the gnu general public license",
    "isc-permission": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    "lgpl-free": "this library is free software",
    "lgpl-redistribute": "you can redistribute it and or modify it under the terms of the gnu lesser general public license",
    "mit-permission": "permission is hereby granted free of charge to any person obtaining a copy of this software",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies",
    "mit-provided": "the software is provided as is without warranty of any kind",
    "mit-released": "released under the mit license",
    "mit-under": "licensed under the mit license",
    "mpl-subject": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "public-domain": "this is free and unencumbered software released into the public domain",
    "reserved": "all rights reserved",
}

#: Licences and the sentences that show them, in the order in which they are tried.
RULES = (
    ("MIT", "mit-permission mit-notice mit-provided"),
    ("Apache-2.0", "apache-under apache-may-not apache-obtain apache-unless"),
    ("BSD-3-Clause", "bsd-redistribution bsd-source bsd-binary bsd-name bsd-provided"),
    ("BSD-2-Clause", "bsd-redistribution bsd-source bsd-binary bsd-provided"),
    ("AGPL-3.0", "gpl-free agpl-redistribute"),
    ("GPL", "gpl-free gpl-redistribute gpl-warranty gpl-received"),
    ("LGPL", "lgpl-free lgpl-redistribute"),
    ("LGPL", "lgpl-redistribute"),
    ("ISC", "isc-permission mit-provided"),
    ("ISC", "isc-permission"),
    ("MIT", "mit-permission mit-notice"),
    ("MIT", "mit-permission"),
    ("MIT", "mit-released"),
    ("MIT", "mit-under"),
    ("Apache-2.0", "apache-under"),
    ("BSD-3-Clause", "bsd3-under"),
    ("BSD-2-Clause", "bsd2-under"),
    ("AGPL-3.0", "agpl3-under"),
    ("AGPL-3.0", "agpl-redistribute"),
    ("AGPL-3.0", "agpl-name"),
    ("GPL-3.0", "gpl3-under"),
    ("GPL-2.0", "gpl2-under"),
    ("GPL", "gpl-redistribute"),
    ("MPL-2.0", "mpl-subject"),
    ("CC0-1.0", "cc0-under"),
    ("CC-BY-NC-ND-4.0", "cc-by-nc-nd-under"),
    ("CC-BY-NC-SA-4.0", "cc-by-nc-sa-under"),
    ("CC-BY-NC-4.0", "cc-by-nc-under"),
    ("CC-BY-SA-4.0", "cc-by-sa-under"),
    ("CC-BY-ND-4.0", "cc-by-nd-under"),
    ("CC-BY-4.0", "cc-by-under"),
    ("Unlicense", "public-domain"),
    ("Proprietary", "reserved"),
)

#: What a sentence about rights mentions; it is looked at more closely only then.
MENTIONS = r"(?i)licen[sc]|copyright|permission|redistribut|warrant|unencumbered|free software|rights reserved|neither the name|may not use this file|provided (by|as)"
#: Indentation and comment marks in front of a line; a version mark, whose full stop ends no sentence; the start of a line
#: that goes on with the sentence before, in lower case or within a licence's name.
MARGIN = r"(^|\n)[ \t]*(?:#+|//+|/\*+|\*+|--+|;+|%+)?[ \t]*"
VERSION = r"\b([Vv])\.[ \t\r\n]+(\d)"
CONTINUED = r"\n(\p{Ll}|(?:Affero|Lesser|General|Public|License)[ ,])"
END = r"([.!?;:])[ \t\r\n]+"
OTHER = r"[^\p{L}\p{Nd}]+"


def sentences(text: Column) -> Column:
    """Sentences of a text that mention rights, normalised. Lines that go on belong together, also in comments.

    Colons and semicolons end a sentence, too; known sentences are the pieces that this leaves of the notices.
    """
    plain = F.regexp_replace(F.regexp_replace(text, MARGIN, "$1"), VERSION, "$1 $2")
    joined = F.regexp_replace(plain, CONTINUED, " $1")
    parts = F.split(F.regexp_replace(joined, END, "$1\n"), "\n")
    return F.transform(F.filter(parts, lambda s: s.rlike(MENTIONS)), lambda s: F.trim(F.regexp_replace(F.lower(s), OTHER, " ")))


def identifier(sentence: Column) -> Column:
    """Identifier of the known sentence that this one starts with; null if there is none. Longer ones are tried first."""
    out = F.lit(None).cast("string")
    for name, known in sorted(SENTENCES.items(), key=lambda x: (len(x[1]), x[0])):
        out = F.when(F.startswith(sentence, F.lit(known)), name).otherwise(out)
    return out


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, licenses (in rule order, each once), known (identifiers in text order) and n_unknown (other such sentences).

    One row per document; a null or empty text, and one that mentions no rights, has empty lists. Whole texts of any
    length are read; repeated rows and null keys stay; other columns are left out.
    """
    rows = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    none = F.array().cast("array<string>")
    said = rows.select("_key", F.when(F.col("_text").rlike(MENTIONS), sentences(F.col("_text"))).otherwise(none).alias("_said"))
    named = said.select("_key", F.transform("_said", identifier).alias("_ids"))
    known = named.select("_key", F.filter("_ids", lambda x: x.isNotNull()).alias("known"), F.size("_ids").alias("_n"))
    rules = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(f" {seq.replace(' ', '  ')} ").alias("seq")) for name, seq in RULES])
    start = F.struct(F.concat(F.lit(" "), F.array_join("known", "  "), F.lit(" ")).alias("left"), none.alias("found"))

    def step(state: Column, rule: Column) -> Column:
        hit = F.contains(state["left"], rule["seq"])
        return F.struct(F.replace(state["left"], rule["seq"], F.lit(" | ")).alias("left"),
                        F.when(hit, F.array_append(state["found"], rule["name"])).otherwise(state["found"]).alias("found"))

    matched = F.aggregate(rules, start, step)["found"]
    return known.select(
        F.col("_key").alias(key), F.when(F.size("known") > 0, F.array_distinct(matched)).otherwise(none).alias("licenses"),
        "known", (F.col("_n") - F.size("known")).cast("long").alias("n_unknown"))


def oracle(table: str = "documents") -> str:
    """DuckDB SQL for the licences, joined by commas, of each document."""
    def quoted(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    cases = " ".join(f"WHEN starts_with(s, {quoted(known)}) THEN {quoted(name)}"
                     for name, known in sorted(SENTENCES.items(), key=lambda x: (-len(x[1]), x[0])))
    steps, last = [], "known"
    for i, (name, seq) in enumerate(RULES):
        seq = quoted(f" {seq.replace(' ', '  ')} ")
        steps.append(f"r{i} AS (SELECT doc_id, ids, n, replace(rest, {seq}, ' | ') AS rest, "
                     f"CASE WHEN contains(rest, {seq}) AND NOT list_contains(found, {quoted(name)}) THEN list_append(found, {quoted(name)}) ELSE found END AS found FROM {last})")
        last = f"r{i}"
    return f"""
WITH texts AS (
    SELECT doc_id, CASE WHEN regexp_matches(coalesce(text, ''), {quoted(MENTIONS)}) THEN text ELSE '' END AS text FROM {table}),
parts AS (
    SELECT doc_id, string_split(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
        text, {quoted(MARGIN)}, '\\1', 'g'), {quoted(VERSION)}, '\\1 \\2', 'g'), {quoted(CONTINUED)}, ' \\1', 'g'),
        {quoted(END)}, '\\1' || chr(10), 'g'), chr(10)) AS parts FROM texts),
ids AS (
    SELECT doc_id, list_transform(list_transform(list_filter(parts, lambda s: regexp_matches(s, {quoted(MENTIONS)})),
        lambda s: trim(regexp_replace(lower(s), {quoted(OTHER)}, ' ', 'g'))), lambda s: CASE {cases} END) AS ids FROM parts),
known AS (
    SELECT doc_id, list_filter(ids, lambda x: x IS NOT NULL) AS ids, len(ids) AS n,
           ' ' || coalesce(array_to_string(list_filter(ids, lambda x: x IS NOT NULL), '  '), '') || ' ' AS rest,
           []::VARCHAR[] AS found FROM ids),
{", ".join(steps)}
SELECT doc_id, coalesce(array_to_string(found, ','), '') AS licenses, coalesce(array_to_string(ids, ' '), '') AS known,
       (n - len(ids))::BIGINT AS n_unknown FROM {last}
"""
