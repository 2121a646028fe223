"""Licence recognition by sentences (German, Manabe and Inoue, "A Sentence-
Matching Method for Automatic License Identification", 2010).

A text is normalised and cut into sentences at blank lines and full stops. Known
licence sentences are mapped to their identifiers: they begin and end with a
sentence, a line or a clause (semicolon, colon), and may go over line ends and
clauses. The sequence of identifiers is matched against ordered rules; a rule that
matches uses up its identifiers.

DataFrame functions only.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences with any of these words are licence-like, known or not.
HINT = "(?i)licen[sc]e|copyright|spdx|warrant|permission|redistribut|public domain"
# In a text with one of those words, so are sentences with one of these.
MORE = "general public|as is|source code|mpl|hope that"
# Every known sentence holds one of these words or of HINT's (tests/llm/test_licences.py).
KNOWN = "(?i)released|dedicated|distributed|reserved|warranties|endorse|mpl"
# A tag's colon and the full stop of "v. 2" end no sentence.
TAG = "(?i)(license-identifier):"
VERSION = "(?<![a-z0-9])v[.][^a-z0-9]*(?=[0-9])"
# Marks in a normalised text: end of a sentence, of a line, of a clause.
END, LINE, CLAUSE = "\x01", "\x02", "\x03"
SENTENCE_END = "[.](?: +|[ \\t\\r]*(?=\\n)|$)|\\n[^a-z0-9]*\\n"
CLAUSE_END = "[;:](?: +|[ \\t\\r]*(?=\\n))"
# Everything but these is a blank in a normalised sentence.
DROPPED = "[^a-z0-9.+/-]+"

# Known sentences: identifier and the whole normalised sentence. Fixed values.
SENTENCES: tuple[tuple[str, str], ...] = (
    ("SpdxApache2", "spdx-license-identifier apache-2.0"),
    ("SpdxMIT", "spdx-license-identifier mit"),
    ("SpdxBSD3", "spdx-license-identifier bsd-3-clause"),
    ("SpdxBSD2", "spdx-license-identifier bsd-2-clause"),
    ("SpdxGPL2", "spdx-license-identifier gpl-2.0(-only)?"),
    ("SpdxGPL2plus", "spdx-license-identifier gpl-2.0(\\+|-or-later)"),
    ("SpdxGPL3", "spdx-license-identifier gpl-3.0(-only)?"),
    ("SpdxGPL3plus", "spdx-license-identifier gpl-3.0(\\+|-or-later)"),
    ("SpdxMPL2", "spdx-license-identifier mpl-2.0"),
    ("SpdxLGPL2", "spdx-license-identifier lgpl-2.(0|1)(-only)?"),
    ("SpdxLGPL2plus", "spdx-license-identifier lgpl-2.(0|1)(\\+|-or-later)"),
    ("SpdxLGPL3", "spdx-license-identifier lgpl-3.0(-only)?"),
    ("SpdxLGPL3plus", "spdx-license-identifier lgpl-3.0(\\+|-or-later)"),
    ("SpdxAGPL3", "spdx-license-identifier agpl-3.0(-only)?"),
    ("SpdxAGPL3plus", "spdx-license-identifier agpl-3.0(\\+|-or-later)"),
    ("SpdxISC", "spdx-license-identifier isc"),
    ("SpdxZlib", "spdx-license-identifier zlib"),
    ("SpdxBoost", "spdx-license-identifier bsl-1.0"),
    ("SpdxUnlicense", "spdx-license-identifier unlicense"),
    ("SpdxEPL2", "spdx-license-identifier epl-2.0"),
    ("SpdxArtistic2", "spdx-license-identifier artistic-2.0"),
    ("SpdxCC0", "spdx-license-identifier cc0-1.0"),
    ("SpdxCCBY", "spdx-license-identifier cc-by-4.0"),
    ("SpdxCCBYSA", "spdx-license-identifier cc-by-sa-4.0"),
    ("ApacheRef", "((this|the) (work|file|software|project|program) is )?(licensed|released|distributed) under the( terms of the)? apache license( version)? 2.0( the license)?"),
    ("ApacheUse", "you may not use this file except in compliance with the license"),
    ("ApacheCopy", "you may obtain a copy of the license at( .*)?"),
    ("ApacheAsIs", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis.*"),
    ("ApacheSee", "see the license for the specific language governing permissions and limitations under the license"),
    ("MITRef", "((this|the) (work|file|software|project|program) is )?(licensed|released|distributed) under the( terms of the)? mit license"),
    ("MITPerm", "permission is hereby granted free of charge to any person obtaining a copy of this software.*"),
    ("MITNotice", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("MITAsIs", "the software is provided as is without warranty of any kind.*"),
    ("MITLiable", "in no event shall the authors or copyright holders be liable.*"),
    ("ISCPerm", "permission to use copy modify and/or distribute this software for any purpose with or without fee is hereby granted.*"),
    ("ISCAsIs", "the software is provided as is and the author disclaims all warranties.*"),
    ("BSDRef3", "((this|the) (work|file|software|project|program) is )?(licensed|released|distributed) under the( terms of the)? (3-clause bsd|bsd 3-clause) license"),
    ("BSDRef2", "((this|the) (work|file|software|project|program) is )?(licensed|released|distributed) under the( terms of the)? (2-clause bsd|bsd 2-clause|simplified bsd) license"),
    ("BSDUse", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("BSDSource", "([1*-] )?redistributions of source code must retain the above copyright notice.*"),
    ("BSDBinary", "([2*-] )?redistributions in binary form must reproduce the above copyright notice.*"),
    ("BSDName", "([3*-] )?neither the names? of .* may be used to endorse or promote products.*"),
    ("BSDAsIs", "this software is provided by .* as is and any express or implied warranties.*"),
    ("GPL3Ref", "((this|the) (work|file|software|project|program) is )?(licensed|released|distributed) under the( terms of the)? gnu general public license( gpl)?( version| v)? ?3(.0)?"),
    ("GPL2Ref", "((this|the) (work|file|software|project|program) is )?(licensed|released|distributed) under the( terms of the)? gnu general public license( gpl)?( version| v)? ?2(.0)?"),
    ("GPL3Later", "this program is free software you can redistribute it and/or modify it under the terms of the gnu general public license.* either version 3 of the license or at your option any later version"),
    ("GPL2Later", "this program is free software you can redistribute it and/or modify it under the terms of the gnu general public license.* either version 2 of the license or at your option any later version"),
    ("GPLHope", "this program is distributed in the hope that it will be useful but without any warranty.*"),
    ("GPLSee", "see the gnu general public license for more details"),
    ("GPLCopy", "you should have received a copy of the gnu general public license.*"),
    ("LGPLRef", "((this|the) (work|file|software|project|program) is )?(licensed|released|distributed) under the( terms of the)? gnu lesser general public license.*"),
    ("AGPLRef", "((this|the) (work|file|software|project|program) is )?(licensed|released|distributed) under the( terms of the)? gnu affero general public license.*"),
    ("MPLRef", "this source code form is subject to the terms of the mozilla public license v. 2.0"),
    ("MPLCopy", "if a copy of the mpl was not distributed with this file you can obtain one at.*"),
    ("CC0Ref", "((this|the) (work|file|text|dataset) is )?(licensed|released|dedicated) (under|to) (cc0|the public domain)( 1.0)?( universal)?"),
    ("CCBYNCSARef", "((this|the) (work|file|text|dataset) is )?(licensed|released) under (a )?(cc|creative commons) by-nc-sa( 4.0)?( international)?( license)?"),
    ("CCBYNCNDRef", "((this|the) (work|file|text|dataset) is )?(licensed|released) under (a )?(cc|creative commons) by-nc-nd( 4.0)?( international)?( license)?"),
    ("CCBYNCRef", "((this|the) (work|file|text|dataset) is )?(licensed|released) under (a )?(cc|creative commons) by-nc( 4.0)?( international)?( license)?"),
    ("CCBYSARef", "((this|the) (work|file|text|dataset) is )?(licensed|released) under (a )?(cc|creative commons) by-sa( 4.0)?( international)?( license)?"),
    ("CCBYNDRef", "((this|the) (work|file|text|dataset) is )?(licensed|released) under (a )?(cc|creative commons) by-nd( 4.0)?( international)?( license)?"),
    ("CCBYRef", "((this|the) (work|file|text|dataset) is )?(licensed|released) under (a )?(cc|creative commons) by( 4.0)?( international)?( license)?"),
    ("ISCRef", "((this|the) (work|file|software|project|program) is )?(licensed|released|distributed) under the( terms of the)? isc license"),
    ("ZlibRef", "((this|the) (work|file|software|project|program) is )?(licensed|released|distributed) under the( terms of the)? zlib license"),
    ("ZlibAsIs", "this software is provided as-is without any express or implied warranty"),
    ("ZlibUse", "permission is granted to anyone to use this software for any purpose including commercial applications.*"),
    ("BoostRef", "((this|the) (work|file|software|project|program) is )?(licensed|released|distributed) under the( terms of the)? boost software license( version)?( 1.0)?"),
    ("BoostPerm", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation.*"),
    ("UnlicenseFree", "this is free and unencumbered software released into the public domain"),
    ("EPLRef", "((this|the) (work|file|software|project|program) is )?(licensed|released|distributed) under the( terms of the)? eclipse public license( version| v)? ?2(.0)?"),
    ("EPLNotice", "this program and the accompanying materials are made available under the terms of the eclipse public license.* 2.0.*"),
    ("ArtisticRef", "((this|the) (work|file|software|project|program) is )?(licensed|released|distributed) under the( terms of the)? artistic license( version)? 2.0"),
    ("CC0Waiver", "to the extent possible under law .* waived all copyright and related or neighboring rights.*"),
    ("AllRights", "all rights reserved"),
)

# Ordered rules: the licence and the sentences it takes, one after another.
RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("Apache-2.0", ("ApacheRef", "ApacheUse", "ApacheCopy", "ApacheAsIs", "ApacheSee")),
    ("MIT", ("MITPerm", "MITNotice", "MITAsIs", "MITLiable")),
    ("MIT", ("MITPerm", "MITNotice", "MITAsIs")),
    ("ISC", ("ISCPerm", "ISCAsIs")),
    ("BSD-3-Clause", ("BSDUse", "BSDSource", "BSDBinary", "BSDName", "BSDAsIs")),
    ("BSD-3-Clause", ("BSDUse", "BSDSource", "BSDBinary", "BSDName")),
    ("BSD-2-Clause", ("BSDUse", "BSDSource", "BSDBinary", "BSDAsIs")),
    ("BSD-2-Clause", ("BSDUse", "BSDSource", "BSDBinary")),
    ("GPL-3.0-or-later", ("GPL3Later", "GPLHope", "GPLSee", "GPLCopy")),
    ("GPL-2.0-or-later", ("GPL2Later", "GPLHope", "GPLSee", "GPLCopy")),
    ("GPL-3.0-or-later", ("GPL3Later",)),
    ("GPL-2.0-or-later", ("GPL2Later",)),
    ("Zlib", ("ZlibAsIs", "ZlibUse")),
    ("BSL-1.0", ("BoostPerm",)),
    ("Unlicense", ("UnlicenseFree",)),
    ("EPL-2.0", ("EPLNotice",)),
    ("CC0-1.0", ("CC0Waiver",)),
    ("MPL-2.0", ("MPLRef", "MPLCopy")),
    ("MPL-2.0", ("MPLRef",)),
    ("Apache-2.0", ("ApacheRef",)),
    ("MIT", ("MITRef",)),
    ("BSD-3-Clause", ("BSDRef3",)),
    ("BSD-2-Clause", ("BSDRef2",)),
    ("GPL-3.0-only", ("GPL3Ref",)),
    ("GPL-2.0-only", ("GPL2Ref",)),
    ("LGPL", ("LGPLRef",)),
    ("AGPL", ("AGPLRef",)),
    ("CC0-1.0", ("CC0Ref",)),
    ("CC-BY-NC-SA-4.0", ("CCBYNCSARef",)),
    ("CC-BY-NC-ND-4.0", ("CCBYNCNDRef",)),
    ("CC-BY-NC-4.0", ("CCBYNCRef",)),
    ("CC-BY-SA-4.0", ("CCBYSARef",)),
    ("CC-BY-ND-4.0", ("CCBYNDRef",)),
    ("CC-BY-4.0", ("CCBYRef",)),
    ("Apache-2.0", ("SpdxApache2",)),
    ("MIT", ("SpdxMIT",)),
    ("BSD-3-Clause", ("SpdxBSD3",)),
    ("BSD-2-Clause", ("SpdxBSD2",)),
    ("GPL-2.0-only", ("SpdxGPL2",)),
    ("GPL-2.0-or-later", ("SpdxGPL2plus",)),
    ("GPL-3.0-only", ("SpdxGPL3",)),
    ("GPL-3.0-or-later", ("SpdxGPL3plus",)),
    ("MPL-2.0", ("SpdxMPL2",)),
    ("ISC", ("ISCRef",)),
    ("Zlib", ("ZlibRef",)),
    ("BSL-1.0", ("BoostRef",)),
    ("EPL-2.0", ("EPLRef",)),
    ("Artistic-2.0", ("ArtisticRef",)),
    ("LGPL", ("SpdxLGPL2",)),
    ("LGPL", ("SpdxLGPL2plus",)),
    ("LGPL", ("SpdxLGPL3",)),
    ("LGPL", ("SpdxLGPL3plus",)),
    ("AGPL", ("SpdxAGPL3",)),
    ("AGPL", ("SpdxAGPL3plus",)),
    ("ISC", ("SpdxISC",)),
    ("Zlib", ("SpdxZlib",)),
    ("BSL-1.0", ("SpdxBoost",)),
    ("Unlicense", ("SpdxUnlicense",)),
    ("EPL-2.0", ("SpdxEPL2",)),
    ("Artistic-2.0", ("SpdxArtistic2",)),
    ("CC0-1.0", ("SpdxCC0",)),
    ("CC-BY-4.0", ("SpdxCCBY",)),
    ("CC-BY-SA-4.0", ("SpdxCCBYSA",)),
    ("Proprietary", ("AllRights",)),
)


def _normalised(sentence: Column) -> Column:
    """Words between single blanks and marks, without what surrounds a line's text
    (comment signs, bullets, dashes)."""
    out = F.lower(F.translate(sentence, END + LINE + CLAUSE, "   "))
    for pattern, by in (
        (TAG, "$1"),
        (VERSION, "v "),
        (SENTENCE_END, END),
        (CLAUSE_END, CLAUSE),
        ("\\n", LINE),
        (DROPPED.replace("[^", "[^" + END + LINE + CLAUSE), " "),
        (f"(?<![ ./-])[ ./-]++(?=[{END}{LINE}{CLAUSE}])", ""),
        (f"(?<=[{END}{LINE}{CLAUSE}])[ ./-]+", ""),
    ):
        out = F.regexp_replace(out, pattern, by)
    return F.btrim(out, F.lit(" ./-"))


def _spanning(pattern: str) -> str:
    """A known sentence's pattern in a normalised sentence: from mark to mark, with
    marks for blanks, and as short as ``.*`` allows."""
    pattern = re.sub(VERSION, "v ", pattern)
    pattern = re.sub("[.](?![*])", "[.]", pattern).replace(".*)?", ".*)??").replace(".*", "[^<]*?")
    return f"(?<![^{LINE}{CLAUSE}])" + pattern.replace(" ", f"(?:[ {LINE}{CLAUSE}]+)") + f"(?![^{LINE}{CLAUSE}])"


def _identified(sentence: Column) -> Column:
    """The normalised sentence with <identifier> for each known one. What follows
    a pattern's ``.*`` within the clause belongs to it, but for known ones."""
    for name, pattern in SENTENCES:
        tail = "~" if pattern.endswith((".*", ".*)?")) else ""
        sentence = F.regexp_replace(sentence, _spanning(pattern), f"<{name}{tail}>")
    return F.regexp_replace(sentence, f"~>[^<{CLAUSE}]*", ">")


def licence_scan(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_sentences (known or licence-like
    ones), sentence_ids (known ones, in order, comma-separated) and licences
    (found, in the rules' order, comma-separated; UNKNOWN if no rule matches a text that has
    licence-like sentences; else empty).

    Everything happens within the row: a text is scanned for the words that known
    and licence-like sentences hold, and only texts with one are cut, and only
    sentences with one are matched. Cases: null, empty and blank texts have none; repeated rows are scanned one by one; a null doc_id stays
    null; other columns are ignored; no documents give no rows."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    none = F.array().cast("array<string>")
    hinted = text.rlike(HINT.replace(" ", "\\s+"))
    cut = F.when(hinted | text.rlike(KNOWN), F.split(_normalised(text), END)).otherwise(none)
    step = docs.select(F.col("doc_id").cast("long").alias("doc_id"), hinted.alias("hinted"), cut.alias("cut"))
    step = step.withColumn("cut", F.filter("cut", lambda s: s.rlike(f"{HINT}|{KNOWN}|{MORE}".replace(" ", f"[ {LINE}]"))))
    step = step.withColumn("cut", F.transform("cut", _identified))
    ids = F.transform("cut", lambda s: F.regexp_extract_all(s, F.lit("<([A-Za-z0-9]+)>"), F.lit(1)))
    rest = F.flatten(F.transform("cut", lambda s: F.split(F.replace(s, F.lit(LINE), F.lit(" ")), f"<[A-Za-z0-9]+>|{CLAUSE}")))
    like = F.filter(rest, lambda s: s.rlike(HINT) | (F.col("hinted") & s.rlike(MORE)))
    step = step.select("doc_id", F.flatten(ids).alias("ids"), (F.size(like) + F.size(F.flatten(ids))).cast("long").alias("n_sentences"))
    step = step.withColumn("sequence", F.concat_ws("", F.transform("ids", lambda x: F.concat(F.lit("<"), x, F.lit(">")))))
    rules = F.array(
        *[F.struct(F.lit(name).alias("name"), F.lit("".join(f"<{i}>" for i in ids)).alias("ids")) for name, ids in RULES]
    )
    matched = F.aggregate(
        rules,
        F.struct(F.col("sequence").alias("rest"), none.alias("found")),
        lambda acc, r: F.struct(
            # what is used up leaves a mark, so its neighbours don't become one sequence
            F.replace(acc["rest"], r["ids"], F.lit("<>")).alias("rest"),
            F.when(F.contains(acc["rest"], r["ids"]), F.array_append(acc["found"], r["name"])).otherwise(acc["found"]).alias("found"),
        ),
        lambda acc: F.array_distinct(acc["found"]),
    )
    found = F.when(F.col("sequence") != "", matched).otherwise(none)
    return step.withColumn("found", found).select(
        "doc_id",
        "n_sentences",
        F.concat_ws(",", "ids").alias("sentence_ids"),
        F.when(F.size("found") > 0, F.concat_ws(",", "found"))
        .when(F.col("n_sentences") > 0, F.lit("UNKNOWN"))
        .otherwise(F.lit(""))
        .alias("licences"),
    )


def _spanning_sql(pattern: str) -> str:
    """``_spanning`` without lookarounds: marks are doubled in the SQL, so that two
    sentences with a mark between them take one each, and put it back."""
    body = _spanning(pattern).removeprefix(f"(?<![^{LINE}{CLAUSE}])").removesuffix(f"(?![^{LINE}{CLAUSE}])")
    body = body.replace("(?:", "(").replace("(", "(?:")
    return f"(^|[{LINE}{CLAUSE}]){body}($|[{LINE}{CLAUSE}])"


def scan_sql() -> str:
    """The same in DuckDB SQL, whose patterns have no lookarounds, and without the
    words that the operator looks for first."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    replaced = lambda s, pattern, by: f"regexp_replace({s}, {quote(pattern)}, {quote(by)}, 'g')"
    marks = END + LINE + CLAUSE
    full_stop = "\x04"  # at the end of a line
    normal = f"lower(translate(text, {quote(marks + full_stop)}, '    '))"
    for pattern, by in (
        (TAG.removeprefix("(?i)"), r"\1"),
        ("(^|[^a-z0-9])v[.][^a-z0-9]*([0-9])", r"\1v \2"),
        (r"[.]([ \t\r]*\n)", full_stop + r"\1"),
        (rf"{full_stop}[ \t\r]*|[.](?: +|$)|\n[^a-z0-9]*\n", END),
        (r"[;:](?: +|[ \t\r]*(\n))", CLAUSE + r"\1"),
        ("\n", LINE),
        (DROPPED.replace("[^", "[^" + marks), " "),
        (f"[ ./-]+([{marks}])", r"\1"),
        (f"([{marks}])[ ./-]+", r"\1"),
    ):
        normal = replaced(normal, pattern, by)
    sentence = replaced("s", f"([{LINE}{CLAUSE}])", r"\1\1")
    for name, pattern in SENTENCES:
        tail = "~" if pattern.endswith((".*", ".*)?")) else ""
        sentence = replaced(sentence, _spanning_sql(pattern), rf"\1<{name}{tail}>\2")
    sentence = replaced(sentence, f"~>[^<{CLAUSE}]*", ">")
    rest, tests = "sequence", []
    for name, ids in RULES:
        own = "".join(f"<{i}>" for i in ids)
        tests.append(f"CASE WHEN contains({rest}, '{own}') THEN '{name}' END")
        rest = f"replace({rest}, '{own}', '<>')"
    letters = "abcdefghijklmnopqrstuvwxyz"
    hint = HINT.removeprefix("(?i)")
    blanks = "[ \t\n\x0b\f\r]+"
    return f"""
WITH doc AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_matches(translate(coalesce(text, ''), '{letters.upper()}', '{letters}'), {quote(hint.replace(" ", blanks))}) AS hinted
  FROM documents
), cut AS (
  SELECT doc_id, hinted, list_transform(string_split(trim({normal}, ' ./-'), {quote(END)}), lambda s: {sentence}) AS cut FROM doc
), known AS (
  SELECT doc_id, hinted, flatten(list_transform(cut, lambda s: regexp_extract_all(s, '<([A-Za-z0-9]+)>', 1))) AS ids,
         flatten(list_transform(cut, lambda s: string_split_regex(regexp_replace(s, '{LINE}+', ' ', 'g'), '<[A-Za-z0-9]+>|{CLAUSE}'))) AS rest
  FROM cut
), seq AS (
  SELECT doc_id, (len(ids) + len(list_filter(rest, lambda s: regexp_matches(s, {quote(hint)})
                                                  OR (hinted AND regexp_matches(s, {quote(MORE)})))))::BIGINT AS n_sentences,
         coalesce(array_to_string(ids, ','), '') AS sentence_ids,
         coalesce(array_to_string(list_transform(ids, lambda x: '<' || x || '>'), ''), '') AS sequence FROM known
), hits AS (SELECT *, list_filter([{", ".join(tests)}], lambda x: x IS NOT NULL) AS found FROM seq)
SELECT doc_id, n_sentences, sentence_ids,
       CASE WHEN len(found) > 0 THEN array_to_string(list_filter(found, lambda x, i: list_position(found, x) = i), ',')
            WHEN n_sentences > 0 THEN 'UNKNOWN' ELSE '' END AS licences
FROM hits"""
