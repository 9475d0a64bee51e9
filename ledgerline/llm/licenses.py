"""Licence scan by sentence rules, in DataFrame functions only.

A text is cut into sentences; each sentence, normalised, is looked up among
known licence sentences, by its whole text or, where names stand in it, by its
beginning and end or by the licence that it grants.  The identifiers, with a
mark where unknown sentences lie between them, are matched against ordered
rules, each a run of identifiers that follow one another; numbering and blank
lines between them do not count.  Rules are matched longest first, and a match
takes its sentences: a shorter rule is reported where it stands by itself, also
in a text that holds the longer one elsewhere.  SPDX lines name their licences
themselves.

Everything happens within the row, so nothing is shuffled and no document
depends on another.  Defined cases: null and empty texts have no sentence and
no licence; repeated rows give repeated rows; an empty table gives an empty
result; other columns are not read; a very long text is cut and looked up
whole, sentence by sentence.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import documents

# Normalised licence sentences by identifier, as sentences() cuts
# them: at colons and semicolons, and before a line that begins with a capital
# (so a notice whose usual wrapping does that is also there in its parts).
SENTENCES: dict[str, str] = {
    "agpl3-rest": "license or at your option any later version",
    "agpl3-terms": "you can redistribute it and or modify it under the terms of the gnu affero "
                   "general public license as published by the free software foundation either "
                   "version 3 of the license or at your option any later version",
    "agpl3-terms-cut": "you can redistribute it and or modify it under the terms of the gnu "
                       "affero general public license as published by the free software "
                       "foundation either version 3 of the",
    "apache-header": "licensed under the apache license version 2 0 the license",
    "apache-notice": "licensed under the apache license version 2 0",
    "apache-use": "you may not use this file except in compliance with the license",
    "boost-notice": "distributed under the boost software license version 1 0",
    "bsd-grant": "redistribution and use in source and binary forms with or without "
                 "modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice "
                  "this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice "
                  "this list of conditions and the following disclaimer in the documentation "
                  "and or other materials provided with the distribution",
    "bsd-names": "neither the name of the copyright holder nor the names of its contributors "
                 "may be used to endorse or promote products derived from this software "
                 "without specific prior written permission",
    "cc-by-nc-notice": "licensed under cc by nc 4 0",
    "cc-by-notice": "licensed under cc by 4 0",
    "cc-by-sa-notice": "licensed under cc by sa 4 0",
    "cc-by-long": "this work is licensed under a creative commons attribution 4 0 international "
                  "license",
    "cc-by-nc-long": "this work is licensed under a creative commons attribution noncommercial "
                     "4 0 international license",
    "cc-by-sa-long": "this work is licensed under a creative commons attribution sharealike 4 0 "
                     "international license",
    "epl2-notice": "this program and the accompanying materials are made available under the "
                   "terms of the eclipse public license 2 0 which is available at https www "
                   "eclipse org legal epl 2 0",
    "free-library": "this library is free software",
    "free-program": "this program is free software",
    "fsf-published": "license as published by the free software foundation",
    "gpl-terms": "you can redistribute it and or modify it under the terms of the gnu general "
                 "public license as published by the free software foundation",
    "gpl2-terms": "you can redistribute it and or modify it under the terms of the gnu general "
                  "public license as published by the free software foundation either version 2 "
                  "of the license or at your option any later version",
    "gpl3-terms": "you can redistribute it and or modify it under the terms of the gnu general "
                  "public license as published by the free software foundation either version 3 "
                  "of the license or at your option any later version",
    "gpl3-notice": "this work is licensed under the gnu general public license version 3",
    "gpl3-program": "this program is free software you can redistribute it and or modify it "
                    "under the terms of the gnu general public license as published by the "
                    "free software foundation either version 3 of the license or at your "
                    "option any later version",
    "isc-grant-and": "permission to use copy modify and distribute this software for any purpose "
                     "with or without fee is hereby granted provided that the above copyright "
                     "notice and this permission notice appear in all copies",
    "isc-grant": "permission to use copy modify and or distribute this software for any "
                 "purpose with or without fee is hereby granted provided that the above "
                 "copyright notice and this permission notice appear in all copies",
    "lgpl-terms": "you can redistribute it and or modify it under the terms of the gnu lesser "
                  "general public license as published by the free software foundation",
    "lgpl-terms-cut": "you can redistribute it and or modify it under the terms of the gnu "
                      "lesser general public",
    "lgpl3-terms": "you can redistribute it and or modify it under the terms of the gnu lesser "
                   "general public license as published by the free software foundation either "
                   "version 3 of the license or at your option any later version",
    "mit-licensed": "licensed under the mit license",
    "mit-project": "this project is licensed under the mit license",
    "mit-notice": "released under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy "
                 "of this software and associated documentation files the software to deal "
                 "in the software without restriction including without limitation the "
                 "rights to use copy modify merge publish distribute sublicense and or sell "
                 "copies of the software and to permit persons to whom the software is "
                 "furnished to do so subject to the following conditions",
    "mit-keep": "the above copyright notice and this permission notice shall be included in "
                "all copies or substantial portions of the software",
    "mpl2-copy": "if a copy of the mpl was not distributed with this file you can obtain one at "
                 "http mozilla org mpl 2 0",
    "mpl2-copy-s": "if a copy of the mpl was not distributed with this file you can obtain one "
                   "at https mozilla org mpl 2 0",
    "or-later-2": "either version 2 of the license or at your option any later version",
    "or-later-2-1": "either version 2 1 of the license or at your option any later version",
    "or-later-3": "either version 3 of the license or at your option any later version",
    "rights-reserved": "all rights reserved",
    "unlicense-notice": "this is free and unencumbered software released into the public domain",
    "zlib-grant": "permission is granted to anyone to use this software for any purpose including "
                  "commercial applications and to alter it and redistribute it freely subject to "
                  "the following restrictions",
}
# Sentences in which a name stands, as (identifier, beginning, end).
NAMED: tuple[tuple[str, str, str], ...] = (
    ("bsd-names", "neither the name of ",
     " contributors may be used to endorse or promote products derived from this software "
     "without specific prior written permission"),
    ("bsd-names", "the name of ",
     " may not be used to endorse or promote products derived from this software without "
     "specific prior written permission"),
)
# How a sentence names the licence it grants, after "under the",
# "under the terms of the" or "under"; the identifier is the licence's.
GRANTED: tuple[tuple[str, str], ...] = (
    ("AGPL-3.0", "gnu affero general public license version 3"),
    ("AGPL-3.0", "gnu agpl v3"),
    ("Apache-2.0", "apache 2 0 license"),
    ("Apache-2.0", "apache license 2 0"),
    ("Apache-2.0", "apache license v2 0"),
    ("Apache-2.0", "apache license version 2 0"),
    ("BSD-2-Clause", "bsd 2 clause license"),
    ("BSD-2-Clause", "simplified bsd license"),
    ("BSD-3-Clause", "bsd 3 clause license"),
    ("BSD-3-Clause", "modified bsd license"),
    ("BSD-3-Clause", "new bsd license"),
    ("BSL-1.0", "boost software license version 1 0"),
    ("CC-BY-4.0", "cc by 4 0"),
    ("CC-BY-NC-4.0", "cc by nc 4 0"),
    ("CC-BY-SA-4.0", "cc by sa 4 0"),
    ("CC0-1.0", "cc0 1 0"),
    ("EPL-2.0", "eclipse public license 2 0"),
    ("EPL-2.0", "eclipse public license v 2 0"),
    ("GPL-2.0", "gnu general public license version 2"),
    ("GPL-2.0", "gpl v2"),
    ("GPL-2.0", "gplv2"),
    ("GPL-3.0", "gnu general public license version 3"),
    ("GPL-3.0", "gpl v3"),
    ("GPL-3.0", "gplv3"),
    ("ISC", "isc license"),
    ("LGPL-2.1", "gnu lesser general public license version 2 1"),
    ("LGPL-3.0", "gnu lesser general public license version 3"),
    ("MIT", "mit license"),
    ("MPL-2.0", "mozilla public license 2 0"),
    ("MPL-2.0", "mozilla public license v 2 0"),
    ("MPL-2.0", "mozilla public license version 2 0"),
    ("Unlicense", "unlicense"),
    ("Zlib", "zlib license"),
)
# Licences and the runs of sentences that state them.
GRANTS: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("AGPL-3.0-or-later", ("free-program", "agpl3-terms")),
    ("AGPL-3.0-or-later", ("free-program", "agpl3-terms-cut", "agpl3-rest")),
    ("Apache-2.0", ("apache-header",)),
    ("Apache-2.0", ("apache-header", "apache-use")),
    ("Apache-2.0", ("apache-notice",)),
    ("Apache-2.0", ("apache-notice", "apache-use")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names")),
    ("BSL-1.0", ("boost-notice",)),
    ("CC-BY-4.0", ("cc-by-long",)),
    ("CC-BY-4.0", ("cc-by-notice",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-long",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-notice",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-long",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-notice",)),
    ("EPL-2.0", ("epl2-notice",)),
    ("GPL-2.0-or-later", ("free-program", "gpl-terms", "or-later-2")),
    ("GPL-2.0-or-later", ("free-program", "gpl2-terms")),
    ("GPL-3.0", ("gpl3-notice",)),
    ("GPL-3.0-or-later", ("free-program", "gpl-terms", "or-later-3")),
    ("GPL-3.0-or-later", ("free-program", "gpl3-terms")),
    ("GPL-3.0-or-later", ("gpl3-program",)),
    ("ISC", ("isc-grant",)),
    ("ISC", ("isc-grant-and",)),
    ("LGPL-2.1-or-later", ("free-library", "lgpl-terms", "or-later-2-1")),
    ("LGPL-2.1-or-later", ("free-library", "lgpl-terms-cut", "fsf-published", "or-later-2-1")),
    ("LGPL-3.0-or-later", ("free-library", "lgpl-terms", "or-later-3")),
    ("LGPL-3.0-or-later", ("free-library", "lgpl-terms-cut", "fsf-published", "or-later-3")),
    ("LGPL-3.0-or-later", ("free-library", "lgpl3-terms")),
    ("LGPL-3.0-or-later", ("free-program", "lgpl3-terms")),
    ("MIT", ("mit-licensed",)),
    ("MIT", ("mit-project",)),
    ("MIT", ("mit-notice",)),
    ("MIT", ("mit-grant", "mit-keep")),
    ("MPL-2.0", ("mpl2-copy",)),
    ("MPL-2.0", ("mpl2-copy-s",)),
    ("Unlicense", ("unlicense-notice",)),
    ("Zlib", ("zlib-grant",)),
)
# "All rights reserved" right before a grant belongs to it; alone it grants nothing.
_NAMES = dict.fromkeys(name for name, _ in GRANTED)
STATED = (*GRANTS, *((name, (f"grant:{name}",)) for name in _NAMES))
RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    *STATED, *((name, ("rights-reserved", *run)) for name, run in STATED),
    ("All-Rights-Reserved", ("rights-reserved",)))
#: Every known sentence holds one of these, so other texts need no cutting.
ANCHORS = ("licensed", "license", "permission", "redistribution", "free software",
           "redistribute", "mozilla", "rights reserved", "unencumbered", "neither the name",
           "promote products", " under ")

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
COMMENT_MARK = r"(?m)^[ \t]*(?:#+|//+|\*+|--)[ \t]?"
WRAPPED = r"([^.!?;: \t\n\r])[ \t\r]*\n[ \t]*([a-z(])"
SENTENCE_END = r"[.!?;:]+[ \t\n\r]+|\n+"


def sentences(text: Column) -> Column:
    """Normalised sentences of a text: comment marks dropped, wrapped lines
    joined, cut at sentence ends and line ends, ASCII letters and digits only."""
    whole = F.regexp_replace(F.regexp_replace(text, COMMENT_MARK, ""), WRAPPED, "$1 $2")
    clean = lambda s: F.trim(F.regexp_replace(
        F.translate(s, UPPER, LOWER), "[^a-z0-9]+", " "))
    return F.transform(F.split(whole, SENTENCE_END, -1), clean)


#: Numbering and blank lines: sentences that do not part their neighbours.
FILLER = r"^(?:[0-9]{0,4}|[a-z]|[ivx]{1,5})$"
SPDX_LINE = r"SPDX-License-Identifier:[ \t]*([^\r\n]*)"
SPDX_PART = r"(?:^|[\s(])(?!(?:AND|OR|WITH)\b)([A-Za-z0-9][A-Za-z0-9.+-]*)"
SPDX_EXCEPTION = r"\bWITH\s+[A-Za-z0-9.+-]+"


def runs_by_length(rules: Sequence[tuple[str, tuple[str, ...]]]) -> list[tuple[str, str]]:
    """(marked run, licence), longest run first.

    Raises where the end of one run begins another and what they make together
    is no rule: which of them takes the sentences between would be arbitrary.
    """
    wrap = lambda run: "".join(f"<{i}>" for i in run)
    runs = {run for _, run in rules}
    for a in runs:
        for b in runs:
            for k in range(1, min(len(a), len(b))):
                if a[-k:] == b[:k] and a + b[k:] not in runs:
                    raise ValueError(f"the end of {a} begins {b}")
    return sorted(((wrap(run), name) for name, run in rules), key=lambda r: (-len(r[0]), r))


def scan(docs: DataFrame, text: str = "text", known: dict[str, str] | None = None,
         rules: Sequence[tuple[str, tuple[str, ...]]] = RULES,
         anchors: Sequence[str] = ANCHORS) -> DataFrame:
    """``docs`` with ``l_ids`` (identifiers found, in text order) and
    ``l_licenses`` (licences, each once, sorted), both arrays."""
    known = SENTENCES if known is None else known
    stated = [*known.values(), *(end for _, _, end in NAMED)]
    if missed := [s for s in stated if not any(a in s for a in anchors)]:
        raise ValueError(f"sentences without an anchor: {missed}")
    table = F.create_map(*(F.lit(x) for k, s in known.items() for x in (s, k)))
    granted = F.array(*(F.struct(F.lit(phrase).alias("phrase"),
                                 F.lit(f"grant:{name}").alias("id"))
                        for name, phrase in GRANTED))
    folded = F.translate(F.col(text), UPPER, LOWER)
    # An anchor of several words may be split by a line end, so look for its words.
    hinted = F.lit(False)
    for a in anchors:
        words = [F.contains(folded, F.lit(w)) for w in a.split()]
        hinted = hinted | reduce(lambda x, y: x & y, words)

    def by_grant(s: Column) -> Column:
        """The licence that a sentence grants by name: the longest name it holds."""
        plain = F.concat(F.lit(" "), F.replace(F.replace(s, F.lit("under the terms of the "),
                                               F.lit("under ")),
                                               F.lit("under the "), F.lit("under ")), F.lit(" "))
        hits = F.filter(granted, lambda g: F.contains(
            plain, F.concat(F.lit(" under "), g["phrase"], F.lit(" "))))
        first = F.array_sort(F.transform(hits, lambda g: F.struct(
            (-F.length(g["phrase"])).alias("n"), g["id"].alias("id"))))
        return F.when(F.contains(s, F.lit("under ")), F.get(first, F.lit(0))["id"])

    identify = lambda s: F.coalesce(table[s], *(
        F.when(F.startswith(s, F.lit(begin)) & F.endswith(s, F.lit(end)), F.lit(i))
        for i, begin, end in NAMED), by_grant(s))
    nothing = F.array().cast("array<string>")
    parts = F.filter(sentences(F.col(text)), lambda s: ~F.rlike(s, F.lit(FILLER)))
    # Unknown sentences are empty here, so that they part what lies around them.
    marks = F.transform(parts, lambda s: F.coalesce(identify(s), F.lit("")))
    out = docs.withColumn("l_marks", F.when(F.coalesce(hinted, F.lit(False)), marks)
                          .otherwise(nothing))
    out = out.withColumn("l_ids", F.filter("l_marks", lambda i: i != ""))
    found = F.array_join(F.transform("l_marks", lambda i: F.concat(
        F.lit("<"), i, F.lit(">"))), "")
    # A match takes its sentences: the licence in braces stands in their place.
    for run, name in runs_by_length(rules):
        found = F.replace(found, F.lit(run), F.lit("{" + name + "}"))
    out = out.withColumn("l_found", F.when(F.size("l_ids") > 0, found).otherwise(F.lit("")))
    lines = F.regexp_extract_all(F.col(text), F.lit(SPDX_LINE), F.lit(1))
    spdx = F.flatten(F.transform(lines, lambda x: F.regexp_extract_all(
        F.regexp_replace(x, SPDX_EXCEPTION, ""), F.lit(SPDX_PART), F.lit(1))))
    names = F.concat(F.regexp_extract_all("l_found", F.lit(r"\{([^}]*)\}"), F.lit(1)),
                     F.when(F.contains(F.col(text), F.lit("SPDX-License-Identifier:")), spdx)
                     .otherwise(nothing))
    return out.withColumn("l_licenses", F.array_sort(F.array_distinct(
        F.coalesce(names, nothing)))).drop("l_marks", "l_found")


def op9_license_scan(spark, sf_dir: str) -> DataFrame:
    """Every document's licence sentences and licences."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return scan(docs).select(
        "doc_id", F.size("l_ids").cast("long").alias("n_license_sentences"),
        F.array_join("l_ids", ",").alias("sentence_ids"),
        F.array_join("l_licenses", ",").alias("licenses"))


def _sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _replaced(column: str) -> str:
    """The rules as nested replacements, longest first."""
    for run, name in runs_by_length(RULES):
        column = f"replace({column}, {_sql_text(run)}, {_sql_text('{' + name + '}')})"
    return column


OP9_SQL = rf"""
WITH known(id, s) AS (VALUES {", ".join(f"({_sql_text(k)}, {_sql_text(s)})" for k, s in SENTENCES.items())}),
named(n_id, head, tail) AS (VALUES {", ".join(f"({_sql_text(i)}, {_sql_text(b)}, {_sql_text(e)})" for i, b, e in NAMED)}),
granted(g_id, phrase) AS (VALUES {", ".join(f"('grant:{n}', {_sql_text(p)})" for n, p in GRANTED)}),
d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text,
         regexp_split_to_array(regexp_replace(regexp_replace(coalesce(text, ''),
           '(?m)^[ \t]*(?:#+|//+|\*+|--)[ \t]?', '', 'g'),
           '([^.!?;: \t\n\r])[ \t\r]*\n[ \t]*([a-z(])', '\1 \2', 'g'),
           '[.!?;:]+[ \t\n\r]+|\n+') AS parts
  FROM documents
), p AS (
  SELECT rid, unnest(range(1, len(parts) + 1)) AS i, unnest(parts) AS part FROM d
), c AS (
  SELECT rid, i, trim(regexp_replace(
    translate(part, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^a-z0-9]+', ' ', 'g')) AS s FROM p
), e AS (   -- each distinct sentence once
  SELECT s, coalesce(
    (SELECT id FROM known k WHERE k.s = u.s),
    (SELECT min(n_id) FROM named WHERE starts_with(u.s, head) AND suffix(u.s, tail)),
    (SELECT arg_max(g_id, length(phrase)) FROM granted WHERE contains(
       ' ' || replace(replace(u.s, 'under the terms of the ', 'under '), 'under the ', 'under ')
       || ' ', ' under ' || phrase || ' '))) AS id
  FROM (SELECT DISTINCT s FROM c WHERE NOT regexp_matches(s, '{FILLER}')) u
), m AS (
  SELECT rid, string_agg(id, ',' ORDER BY i) AS ids, count(id) AS n,
         {_replaced("string_agg('<' || coalesce(id, '') || '>', '' ORDER BY i)")} AS found
  FROM c JOIN e USING (s) GROUP BY rid HAVING count(id) > 0
), x AS (
  SELECT rid, unnest(regexp_extract_all(found, '\{{([^}}]*)\}}', 1)) AS name FROM m
  UNION ALL
  SELECT rid, unnest(regexp_extract_all(' ' || regexp_replace(line, '{SPDX_EXCEPTION}', '', 'g'),
                                        '[\s(]([A-Za-z0-9][A-Za-z0-9.+-]*)', 1)) AS name
  FROM (SELECT rid, unnest(regexp_extract_all(text, '{SPDX_LINE}', 1)) AS line FROM d)
), o AS (
  SELECT rid, string_agg(DISTINCT name, ',' ORDER BY name) AS licenses
  FROM x WHERE name NOT IN ('AND', 'OR', 'WITH') GROUP BY rid
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_license_sentences,
       coalesce(ids, '') AS sentence_ids, coalesce(licenses, '') AS licenses
FROM d LEFT JOIN m USING (rid) LEFT JOIN o USING (rid)
"""
