"""Licence scans by sentence rules, with built-in functions only.

One-line statements: a text is cut at line ends and after '.', '!' or '?' before blanks. The licences' own
texts and notices: lines lose comment marks and are joined to paragraphs (up to a blank line), which are cut after
'.', '!', '?' or ':' before blanks, but not after 'v.' before a digit; so it doesn't matter where lines end, nor
whether a text is wrapped at all. A sentence is normalised: A-Z lower-cased, runs of blanks made one
space, punctuation and blanks stripped at both ends. In paragraphs a title without a full stop may stand before a
known sentence, as it does in texts on one line. Known sentences get their identifiers, others a point;
the sequence is matched against ordered rules, whose identifiers may have up to ``NEAR`` sentences between them.

Nulls and edge cases: a NULL or empty text has no sentences and the licence list ''. Repeated rows
give repeated results. Sentences and rules are parameters; their tables are the caller's, held in
the plan, and so bounded by what a program can state. Extra columns are ignored. A licence with other words in
a sentence, such as an organisation's name in the BSD clause, is not found by that sentence.
"""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, table

#: One-line statements in normalised form, by identifier.
SENTENCES = {
    1: "released under the mit license",
    2: "licensed under the mit license",
    3: "licensed under the apache license, version 2.0",
    4: "this work is licensed under the gnu general public license, version 3",
    5: "licensed under cc by-nc 4.0",
    6: "licensed under cc by 4.0",
    7: "licensed under cc by-sa 4.0",
    8: "all rights reserved",
}
#: A licence, and the statements that tell it.
RULES = (
    ("MIT", (1,)),
    ("MIT", (2,)),
    ("Apache-2.0", (3,)),
    ("GPL-3.0", (4,)),
    ("CC-BY-NC-4.0", (5,)),
    ("CC-BY-4.0", (6,)),
    ("CC-BY-SA-4.0", (7,)),
    ("Proprietary", (8,)),
)
#: Whole sentences of the licences' own texts and notices, sought in paragraphs.
NOTICES = {
    18: "permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"software\"), to deal in the software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the software, and to permit persons to whom the software is furnished to do so, subject to the following conditions",
    19: "the software is provided \"as is\", without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement",
    20: "redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    21: "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    22: "this software is provided by the copyright holders and contributors \"as is\" and any express or implied warranties, including, but not limited to, the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
    23: "you can redistribute it and/or modify it under the terms of the gnu general public license as published by the free software foundation, either version 3 of the license, or (at your option) any later version",
    24: "you should have received a copy of the gnu general public license along with this program",
    25: "this source code form is subject to the terms of the mozilla public license, v. 2.0",
    26: "licensed under the apache license, version 2.0 (the \"license\"); you may not use this file except in compliance with the license",
    28: "permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    29: "the software is provided \"as is\" and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness",
    30: "by contrast, the gnu general public license is intended to guarantee your freedom to share and change all versions of a program--to make sure it remains free software for all its users",
    31: "\"licensor\" shall mean the copyright owner or entity authorized by the copyright owner that is granting the license",
    32: "grant of patent license",
    33: "\"contributor\" means each individual or legal entity that creates, contributes to the creation of, or owns covered software",
    34: "by contrast, the gnu general public license is intended to guarantee your freedom to share and change free software--to make sure the software is free for all its users",
    35: "you can redistribute it and/or modify it under the terms of the gnu general public license as published by the free software foundation; either version 2 of the license, or (at your option) any later version",
    36: "this is free and unencumbered software released into the public domain",
    37: "this work is licensed under a creative commons attribution 4.0 international license",
    38: "this work is licensed under a creative commons attribution-sharealike 4.0 international license",
    39: "this work is licensed under a creative commons attribution-noncommercial 4.0 international license",
}
#: A licence, and the identifiers that must follow one another. The first rule of a pair in UNLESS gives way to the second.
NOTICE_RULES = (
    ("MIT", (18, 19)),
    ("BSD-2-Clause", (20, 22)),
    ("BSD-3-Clause", (20, 21, 22)),
    ("GPL-3.0", (23, 24)),
    ("GPL-3.0", (30,)),
    ("GPL-2.0", (35, 24)),
    ("GPL-2.0", (34,)),
    ("MPL-2.0", (25,)),
    ("MPL-2.0", (33,)),
    ("Apache-2.0", (26,)),
    ("Apache-2.0", (31, 32)),
    ("ISC", (28, 29)),
    ("Unlicense", (36,)),
    ("CC-BY-4.0", (37,)),
    ("CC-BY-SA-4.0", (38,)),
    ("CC-BY-NC-4.0", (39,)),
)
UNLESS = {"BSD-2-Clause": "BSD-3-Clause"}
#: Sentences that may stand between two of a rule.
NEAR = 60
STRIPPED = " \t\x0b\x0c\r.,;:!?*#()[]-_/"


def sentences_of(text: Column) -> Column:
    """Normalised, non-empty sentences in order."""
    marked = F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), "([.!?])[ \\t\\x0B\\f\\r]+", "$1\n")
    plain = F.transform(F.split(marked, "\n"), lambda s: F.btrim(s, F.lit(STRIPPED)))
    return F.filter(plain, lambda s: s != "")


def licence_ids(text: Column, sentences: dict[int, str] = SENTENCES) -> Column:
    """Identifiers of the known sentences of a text, in order."""
    by_text: dict[str, int] = {}
    for i, s in sentences.items():
        by_text.setdefault(s, i)
    lookup = F.create_map(*[F.lit(x) for s, i in by_text.items() for x in (s, i)])
    lengths = sorted({len(s) for s in by_text})
    blanks = lambda s: F.regexp_replace(s, "[ \\t\\x0B\\f\\r]+", " ")
    # Only a sentence of a fitting length can be known; blanks only shorten it
    likely = F.filter(sentences_of(text), lambda s: F.char_length(s) >= lengths[0])
    known = F.filter(F.transform(likely, blanks), lambda s: s.isin(list(by_text)))
    return F.transform(known, lambda s: F.element_at(lookup, s))


_COMMENT = r"(?m)^[ \t\x0B\f\r]*(?:[#*;%]+|/[/*]+|--+)?[ \t\x0B\f\r]*"


def notice_marks(text: Column, notices: dict[int, str] = NOTICES) -> Column:
    """A text's paragraphs as marks: <id> for each known sentence, a point for each other one."""
    plain = F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), "[\\x1e\\x1f]", " ")
    # a blank line ends a paragraph; other line ends are blanks
    joined = F.regexp_replace(F.regexp_replace(F.regexp_replace(plain, _COMMENT, ""), "\n{2,}", "\x1e"), "[ \\t\\x0B\\f\\r\\n]+", " ")
    marked = F.regexp_replace(F.regexp_replace(joined, "\\bv\\. ([0-9])", "v.\x1f$1"), "([.!?:]) ", "$1\x1e")
    parts = F.filter(F.transform(F.split(marked, "\x1e"), lambda s: F.btrim(F.translate(s, "\x1f", " "), F.lit(STRIPPED))), lambda s: s != "")
    known = list(notices.values())

    def mark(s: Column) -> Column:
        out, led = F.when(F.lit(False), "."), F.concat(F.lit(" "), s)
        for i, k in notices.items():
            out = out.when(F.endswith(led, F.lit(f" {k}")), f"<{i}>")
        return out.otherwise(".")

    marks = F.array_join(F.transform(parts, mark), "")
    # a sentence stands only in a text with its longest word, whatever the line ends
    words = sorted({max(re.findall("[a-z]+", s), key=len) for s in known})
    return F.when(reduce(or_, [F.contains(plain, F.lit(w)) for w in words]), marks).otherwise("")


def _pattern(ids: tuple[int, ...], near: int) -> str:
    """Identifiers in this order with up to ``near`` sentences between two."""
    return rf"(?:\.|<[0-9]+>){{0,{near}}}".join(f"<{i}>" for i in ids)


def scan(docs: DataFrame, sentences: dict[int, str] = SENTENCES, rules: tuple = RULES, notices: dict[int, str] = NOTICES, notice_rules: tuple = NOTICE_RULES, near: int = NEAR) -> DataFrame:
    """doc_id, sentence_ids (ids joined by a space, statements first), licenses (names in code-point order joined by a comma)."""
    lines = F.array_join(F.transform(licence_ids(F.col("text"), sentences), lambda i: F.concat(F.lit("<"), i.cast("string"), F.lit(">"))), "")
    found = docs.select("doc_id", lines.alias("_lines"), notice_marks(F.col("text"), notices).alias("_marks"))
    hits = [F.when(F.col("_lines").rlike(_pattern(ids, near)), F.lit(name)) for name, ids in rules]
    told = {}
    for name, ids in notice_rules:
        told[name] = told.get(name, F.lit(False)) | F.col("_marks").rlike(_pattern(ids, near))
    hits += [F.when(is_so & ~told[UNLESS[name]] if UNLESS.get(name) in told else is_so, F.lit(name)) for name, is_so in told.items()]
    return found.select(
        "doc_id",
        F.array_join(F.regexp_extract_all(F.concat("_lines", "_marks"), F.lit("<([0-9]+)>"), 1), " ").alias("sentence_ids"),
        F.array_join(F.array_sort(F.array_distinct(F.array_compact(F.array(*hits)))), ",").alias("licenses"),
    )


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def _sql() -> str:
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    known = ", ".join(f"({i}, {quote(s)})" for i, s in SENTENCES.items())
    notices = ", ".join(f"({i}, {quote(s)})" for i, s in NOTICES.items())
    line_rules = ", ".join(f"({quote(name)}, {quote(_pattern(ids, NEAR))})" for name, ids in RULES)
    rules = ", ".join(f"({quote(name)}, {quote(_pattern(ids, NEAR))}, {quote(UNLESS.get(name, ''))})" for name, ids in NOTICE_RULES)
    blanks = "[ \\t\\x0B\\f\\r]+"
    return f"""
WITH known(id, s) AS (VALUES {known}), notices(id, s) AS (VALUES {notices}), line_rules(name, p) AS (VALUES {line_rules}), rules(name, p, unless) AS (VALUES {rules}),
low AS (SELECT row_number() OVER () AS r, doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
lines AS (SELECT r, string_split(regexp_replace(t, '([.!?]){blanks}', '\\1' || chr(10), 'g'), chr(10)) AS parts FROM low),
each AS (SELECT r, generate_subscripts(parts, 1) AS i, unnest(parts) AS s FROM lines),
normal AS (SELECT r, i, regexp_replace(trim(s, E' \\t\\x0b\\x0c\\r.,;:!?*#()[]-_/'), '{blanks}', ' ', 'g') AS s FROM each),
line_marks AS (SELECT r, string_agg('<' || id || '>', '' ORDER BY i) AS marks FROM normal JOIN known USING (s) GROUP BY r),
bare AS (SELECT r, regexp_replace(regexp_replace(t, '[\\x1e\\x1f]', ' ', 'g'), '{_COMMENT}', '', 'g') AS t FROM low),
joined AS (SELECT r, regexp_replace(regexp_replace(t, '\\n{{2,}}', chr(30), 'g'), '[ \\t\\x0B\\f\\r\\n]+', ' ', 'g') AS t FROM bare),
cut AS (SELECT r, string_split(regexp_replace(regexp_replace(t, '\\bv\\. ([0-9])', 'v.' || chr(31) || '\\1', 'g'), '([.!?:]) ', '\\1' || chr(30), 'g'), chr(30)) AS parts FROM joined),
sentences AS (SELECT r, generate_subscripts(parts, 1) AS i, trim(translate(unnest(parts), chr(31), ' '), E' \\t\\x0b\\x0c\\r.,;:!?*#()[]-_/') AS s FROM cut),
marks AS (SELECT r, string_agg(CASE WHEN id IS NULL THEN '.' ELSE '<' || id || '>' END, '' ORDER BY i) AS marks FROM sentences LEFT JOIN notices ON ends_with(' ' || sentences.s, ' ' || notices.s) WHERE sentences.s <> '' GROUP BY r HAVING count(id) > 0),
hits AS (SELECT DISTINCT r, name, unless FROM marks JOIN rules ON regexp_matches(marks, p)),
named AS (SELECT r, name FROM line_marks JOIN line_rules ON regexp_matches(marks, p) UNION SELECT r, name FROM hits h WHERE NOT EXISTS (SELECT 1 FROM hits o WHERE o.r = h.r AND o.name = h.unless)),
listed AS (SELECT r, string_agg(name, ',' ORDER BY name) AS licenses FROM named GROUP BY r)
SELECT doc_id, array_to_string(regexp_extract_all(coalesce(a.marks, '') || coalesce(b.marks, ''), '<([0-9]+)>', 1), ' ') AS sentence_ids, coalesce(licenses, '') AS licenses
FROM low LEFT JOIN line_marks a USING (r) LEFT JOIN marks b USING (r) LEFT JOIN listed USING (r)"""


SQL = {"op9_licenses": _sql()}
