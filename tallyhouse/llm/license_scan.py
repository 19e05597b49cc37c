"""License recognition by sentences and rules, in DataFrame operations only.

A text is cut into sentences, each is normalised (lower case, words of letters and
digits), and known ones get their licence-sentence identifier. The identifiers of a text
in order are then matched against rules: a rule is the ordered identifiers of one licence
text, longer rules come first, and what a rule has matched is not matched again. Two
identifiers with more than `MAX_GAP` unknown sentences between them do not belong together.
Notices with a sign within, as `free software: you can` and `v. 2.0`, are known by their parts.

No shuffle and no join: the known sentences are a fixed table inside the expressions, and
texts without any of the words that every known sentence has one of are not cut up.

Defined results: null and empty texts have no licences; a sentence on one line of a
wrapped paragraph is found as well as one that runs over lines; repeated rows are each
scanned; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_GAP = 3

# Sentences of public licence texts and notices, normalised, by identifier.
SENTENCES: dict[str, tuple[str, ...]] = {
    "mit-notice": (
        "released under the mit license",
        "licensed under the mit license",
        "this project is licensed under the mit license",
        "this software is released under the mit license",
        "the mit license mit",
        "the mit license",
        "mit license",
    ),
    "mit-grant": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation the "
        "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
        "persons to whom the software is furnished to do so subject to the following conditions",
    ),
    "mit-condition": (
        "the above copyright notice and this permission notice shall be included in all copies or substantial portions of "
        "the software",
    ),
    "mit-warranty": (
        "the software is provided as is without warranty of any kind express or implied including but not limited to the "
        "warranties of merchantability fitness for a particular purpose and noninfringement",
    ),
    "mit-liability": (
        "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an "
        "action of contract tort or otherwise arising from out of or in connection with the software or the use or other "
        "dealings in the software",
    ),
    "apache-notice": (
        "licensed under the apache license version 2 0",
        "licensed under the apache license version 2 0 the license",
        "this project is licensed under the apache license version 2 0",
        "released under the apache license version 2 0",
        "apache license version 2 0",
    ),
    "apache-compliance": ("you may not use this file except in compliance with the license",),
    "apache-copy": (
        "you may obtain a copy of the license at http www apache org licenses license 2 0",
        "you may obtain a copy of the license at https www apache org licenses license 2 0",
    ),
    "apache-basis": (
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed on "
        "an as is basis without warranties or conditions of any kind either express or implied",
    ),
    "apache-limits": ("see the license for the specific language governing permissions and limitations under the license",),
    "gpl3-notice": (
        "this work is licensed under the gnu general public license version 3",
        "licensed under the gnu general public license version 3",
        "this program is licensed under the gnu general public license version 3",
        "released under the gnu general public license version 3",
    ),
    "gpl2-notice": (
        "this work is licensed under the gnu general public license version 2",
        "licensed under the gnu general public license version 2",
        "released under the gnu general public license version 2",
    ),
    "gpl-details": ("see the gnu general public license for more details",),
    "lgpl-notice": (
        "licensed under the gnu lesser general public license version 3",
        "this work is licensed under the gnu lesser general public license version 3",
    ),
    "agpl-notice": (
        "licensed under the gnu affero general public license version 3",
        "this work is licensed under the gnu affero general public license version 3",
    ),
    "mpl-notice": (
        "licensed under the mozilla public license version 2 0",
    ),
    "bsd-grant": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that the "
        "following conditions are met",
    ),
    "bsd-source": (
        "redistributions of source code must retain the above copyright notice this list of conditions and the following "
        "disclaimer",
    ),
    "bsd-binary": (
        "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following "
        "disclaimer in the documentation and or other materials provided with the distribution",
    ),
    "bsd-endorse": (
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission",
    ),
    "isc-grant": (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies",
        "permission to use copy modify and distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies",
    ),
    "epl2-notice": (
        "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 "
        "which is available at https www eclipse org legal epl 2 0",
        "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 "
        "which is available at http www eclipse org legal epl 2 0",
        "this program and the accompanying materials are made available under the terms of the eclipse public license v2 0 "
        "which accompanies this distribution and is available at https www eclipse org legal epl v20 html",
    ),
    "bsd-notice": (
        "released under the bsd license",
        "licensed under the bsd license",
        "licensed under the bsd 3 clause license",
        "released under the bsd 3 clause license",
    ),
    "cc0-notice": ("licensed under cc0 1 0", "released under cc0 1 0", "this work is licensed under cc0 1 0"),
    "cc-by-notice": (
        "licensed under cc by 4 0",
        "this work is licensed under cc by 4 0",
        "this work is licensed under a creative commons attribution 4 0 international license",
    ),
    "cc-by-sa-notice": (
        "licensed under cc by sa 4 0",
        "this work is licensed under cc by sa 4 0",
        "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    ),
    "cc-by-nc-notice": (
        "licensed under cc by nc 4 0",
        "this work is licensed under cc by nc 4 0",
        "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
    ),
    "reserved": ("all rights reserved",),
    "unlicense": ("this is free and unencumbered software released into the public domain",),
}

# Licence and ordered sentence identifiers; earlier rules win.
RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("MIT", ("mit-notice", "mit-grant", "mit-condition", "mit-warranty", "mit-liability")),
    ("MIT", ("mit-grant", "mit-condition", "mit-warranty", "mit-liability")),
    ("Apache-2.0", ("apache-notice", "apache-compliance", "apache-copy", "apache-basis", "apache-limits")),
    ("MIT", ("mit-grant",)),
    ("MIT", ("mit-notice",)),
    ("Apache-2.0", ("apache-notice",)),
    ("GPL-3.0", ("gpl3-notice",)),
    ("GPL-2.0", ("gpl2-notice",)),
    ("LGPL-3.0", ("lgpl-notice",)),
    ("AGPL-3.0", ("agpl-notice",)),
    ("MPL-2.0", ("mpl-notice",)),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("ISC", ("isc-grant",)),
    ("EPL-2.0", ("epl2-notice",)),
    ("BSD", ("bsd-grant",)),
    ("BSD", ("bsd-notice",)),
    ("CC0-1.0", ("cc0-notice",)),
    ("CC-BY-4.0", ("cc-by-notice",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-notice",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-notice",)),
    ("Unlicense", ("unlicense",)),
    ("Proprietary", ("reserved",)),
)

_TERMS = "you can redistribute it and or modify it under the terms of the gnu {}general public license as published by the free software foundation"
_LATER = "either version {} of the license or at your option any later version"

# Notices that a sign ends within, as `_END` cuts them.
PARTS: dict[str, tuple[str, ...]] = {
    "free-software": tuple(f"this {what} is free software" for what in ("program", "library", "file", "software")),
    "gpl-terms": (_TERMS.format(""),),
    "lgpl-terms": (_TERMS.format("lesser "), _TERMS.format("library ")),
    "agpl-terms": (_TERMS.format("affero "),),
    "version2-later": (_LATER.format("2"),),
    "version21-later": (_LATER.format("2 1"),),
    "version3-later": (_LATER.format("3"),),
    "version2-only": ("version 2 of the license",),
    "version3-only": ("version 3 of the license",),
    "gpl2-terms": (f"{_TERMS.format('')} {_LATER.format('2')}",),
    "gpl3-terms": (f"{_TERMS.format('')} {_LATER.format('3')}",),
    "lgpl21-terms": (f"{_TERMS.format('lesser ')} {_LATER.format('2 1')}",),
    "lgpl3-terms": (f"{_TERMS.format('lesser ')} {_LATER.format('3')}",),
    "agpl3-terms": (f"{_TERMS.format('affero ')} {_LATER.format('3')}",),
    "hope": tuple(
        f"this {what} is distributed in the hope that it will be useful but without any warranty"
        for what in ("program", "library", "file", "software")
    ),
    "implied": ("without even the implied warranty of merchantability or fitness for a particular purpose",),
    "lgpl-details": (
        "see the gnu lesser general public license for more details",
        "see the gnu library general public license for more details",
    ),
    "agpl-details": ("see the gnu affero general public license for more details",),
    "mpl-terms": ("this source code form is subject to the terms of the mozilla public license v",),
    "mpl-copy": (
        "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0",
        "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0",
    ),
    "apache-copy-at": ("you may obtain a copy of the license at",),
    "apache-address": ("http www apache org licenses license 2 0", "https www apache org licenses license 2 0"),
}


# Names that a licence goes by after the words "SPDX-License-Identifier".
SPDX = (
    "0BSD", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC-BY-4.0",
    "CC-BY-NC-4.0", "CC-BY-SA-4.0", "CC0-1.0", "EPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only",
    "GPL-3.0-or-later", "ISC", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "MIT", "MPL-2.0",
    "Unlicense", "Zlib",
)

#: The words that announce such a name, and the names; a name means a licence only after them.
NAMES: dict[str, tuple[str, ...]] = {"spdx": ("spdx license identifier",)} | {
    f"spdx-{name.lower()}": (name.lower().replace("-", " ").replace(".", " "),) for name in SPDX
}


def _part_rules() -> tuple[tuple[str, tuple[str, ...]], ...]:
    grants = (
        ("GPL-2.0-or-later", ("gpl-terms", "version2-later"), "gpl-details"),
        ("GPL-3.0-or-later", ("gpl-terms", "version3-later"), "gpl-details"),
        ("GPL-2.0", ("gpl-terms", "version2-only"), "gpl-details"),
        ("GPL-3.0", ("gpl-terms", "version3-only"), "gpl-details"),
        ("LGPL-2.0-or-later", ("lgpl-terms", "version2-later"), "lgpl-details"),
        ("LGPL-2.1-or-later", ("lgpl-terms", "version21-later"), "lgpl-details"),
        ("LGPL-3.0-or-later", ("lgpl-terms", "version3-later"), "lgpl-details"),
        ("AGPL-3.0-or-later", ("agpl-terms", "version3-later"), "agpl-details"),
        ("GPL-2.0-or-later", ("gpl2-terms",), "gpl-details"),
        ("GPL-3.0-or-later", ("gpl3-terms",), "gpl-details"),
        ("LGPL-2.1-or-later", ("lgpl21-terms",), "lgpl-details"),
        ("LGPL-3.0-or-later", ("lgpl3-terms",), "lgpl-details"),
        ("AGPL-3.0-or-later", ("agpl3-terms",), "agpl-details"),
    )
    rules = [("Apache-2.0", ("apache-notice", "apache-compliance", "apache-copy-at", "apache-address", "apache-basis", "apache-limits"))]
    for licence, grant, details in grants:
        rules += [(licence, ("free-software", *grant, "hope", "implied", details)), (licence, ("free-software", *grant)), (licence, grant)]
    rules += [("MPL-2.0", ("mpl-terms", "mpl-copy")), ("MPL-2.0", ("mpl-terms",))]
    return tuple(sorted(rules, key=lambda rule: -len(rule[1])))


#: All rules in order: names, parts, whole sentences. The names without "only" stand for themselves, as in `RULES`.
ALL_RULES = (
    *((name.removesuffix("-only"), ("spdx", f"spdx-{name.lower()}")) for name in SPDX),
    *_part_rules(),
    *RULES,
)
KNOWN = SENTENCES | PARTS | NAMES

#: Every known sentence and part, and the words before a name, has at least one of these.
MARKERS = (
    "licen", "permission", "copyright", "provided as is", "redistribution", "rights reserved", "unencumbered",
    "without any warranty", "under cc", "is free software", "implied warranty", "mozilla",
)

#: A sentence ends at a sign and white space, or at an empty line.
_END = "([.;:!?])[ \t\r\n]+|\n[ \t\r]*\n"


def _normal(sentence: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(sentence), "[^a-z0-9]+", " "))


def _known() -> Column:
    pairs = [F.lit(x) for identifier, forms in KNOWN.items() for form in forms for x in (form, identifier)]
    return F.create_map(*pairs)


def _flat_markers(text: Column) -> Column:
    """Whether the text, in lower case and with wrapped lines joined, has any marker."""
    flat = F.regexp_replace(F.lower(text), "[^a-z0-9]+", " ")
    near = F.lower(text)
    # A one-word marker shows in the text as it is; only for the others the text is flattened.
    single = [near.contains(marker) for marker in MARKERS if " " not in marker]
    double = [flat.contains(marker) for marker in MARKERS if " " in marker]
    hint = near.contains("provided") | near.contains("rights") | near.contains("warranty") | near.contains("cc") | near.contains("free")
    some = double[0]
    for other in double[1:]:
        some = some | other
    test = hint & some
    for one in single:
        test = one | test
    return test


def _identifiers(text: Column) -> Column:
    """One entry per sentence and, for an unknown sentence over lines, per line with a word: its identifier or null."""
    sentences = F.split(F.regexp_replace(text, _END, "$1\u0001"), "\u0001")
    known = _known()

    def by_line(sentence: Column) -> Column:
        lines = F.transform(F.split(sentence, "\n"), lambda line: _normal(line))
        return F.concat(F.array(_normal(sentence)), F.filter(lines, lambda line: line != ""))

    entries = F.transform(
        sentences,
        lambda s: F.when(F.contains(s, F.lit("\n")) & F.try_element_at(known, _normal(s)).isNull(), by_line(s)).otherwise(F.array(_normal(s))),
    )
    return F.transform(F.flatten(entries), lambda s: F.try_element_at(known, s))


def _sequence(identifiers: Column) -> Column:
    """`;a;b;|;c;`: the identifiers in order, `|` where too many unknown sentences lie between two."""
    start = F.struct(F.lit(";").alias("done"), F.lit(0).alias("gap"))

    def step(state: Column, identifier: Column) -> Column:
        parted = F.when((state["gap"] > MAX_GAP) & (state["done"] != ";"), F.lit("|;")).otherwise(F.lit(""))
        known = F.struct(F.concat(state["done"], parted, identifier, F.lit(";")).alias("done"), F.lit(0).alias("gap"))
        unknown = F.struct(state["done"].alias("done"), (state["gap"] + 1).alias("gap"))
        return F.when(identifier.isNotNull(), known).otherwise(unknown)

    return F.aggregate(identifiers, start, step, lambda state: state["done"])


def _matches(sequence: Column) -> Column:
    """`licence` of each rule that matches, in the order of the rules."""
    rules = F.array(
        *[F.struct(F.lit(licence).alias("licence"), F.lit(";" + ";".join(ids) + ";").alias("ids")) for licence, ids in ALL_RULES]
    )
    start = F.struct(sequence.alias("left"), F.array().cast("array<string>").alias("found"))

    def step(state: Column, rule: Column) -> Column:
        hit = F.contains(state["left"], rule["ids"])
        return F.struct(
            F.when(hit, F.replace(state["left"], rule["ids"], F.lit(";#;"))).otherwise(state["left"]).alias("left"),
            F.when(hit, F.array_append(state["found"], rule["licence"])).otherwise(state["found"]).alias("found"),
        )

    return F.aggregate(rules, start, step, lambda state: state["found"])


def scan_licenses(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_sentences known, their sequence, and the licences, as `A,B`."""
    text = F.coalesce(F.col("text"), F.lit(""))
    marked = F.when(_flat_markers(text), text)
    sequence = F.coalesce(_sequence(_identifiers(marked)), F.lit(";"))
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), sequence.alias("sequence"))
    # The parts of the sequence that are identifiers, and the licences the rules give.
    parts = F.filter(F.split("sequence", ";"), lambda part: ~part.isin("", "|"))
    return found.select(
        "doc_id",
        F.size(parts).cast("long").alias("n_sentences"),
        "sequence",
        F.concat_ws(",", F.array_sort(F.array_distinct(_matches(F.col("sequence"))))).alias("licenses"),
    )


def license_scan_sql() -> str:
    """The same scan as DuckDB SQL over `documents`."""
    known = ", ".join(f"('{form}', '{name}')" for name, forms in KNOWN.items() for form in forms)
    rules = ", ".join(f"{{'licence': '{licence}', 'ids': ';{';'.join(ids)};'}}" for licence, ids in ALL_RULES)
    marked = " OR ".join(f"contains({'flat' if ' ' in marker else 'low'}, '{marker}')" for marker in MARKERS)
    return f"""
        WITH RECURSIVE known(form, name) AS (VALUES {known}),
        rules AS (SELECT generate_subscripts(r, 1) AS turn, unnest(r, recursive := true) FROM (SELECT [{rules}] AS r)),
        docs AS (SELECT row_number() OVER () AS r, CAST(doc_id AS BIGINT) AS doc_id, coalesce(text, '') AS text FROM documents),
        cut AS (SELECT r, string_split(regexp_replace(text, '{_END}', '\\1' || chr(1), 'g'), chr(1)) AS parts
                FROM (SELECT r, text, lower(text) AS low, regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g') AS flat FROM docs)
                WHERE {marked}),
        sentences AS (SELECT r, generate_subscripts(parts, 1) AS spot, unnest(parts) AS s FROM cut),
        judged AS (SELECT *, trim(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g'), ' ') AS form FROM sentences),
        whole AS (SELECT j.*, contains(s, chr(10)) AND k.form IS NULL AS by_line FROM judged j LEFT JOIN known k USING (form)),
        lines AS (SELECT r, spot, unnest(string_split(s, chr(10))) AS s, generate_subscripts(string_split(s, chr(10)), 1) AS sub
                  FROM whole WHERE by_line),
        pieces AS (SELECT r, spot, 0 AS sub, form FROM whole UNION ALL
                   SELECT * FROM (SELECT r, spot, sub, trim(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g'), ' ') AS form FROM lines)
                   WHERE form <> ''),
        numbered AS (SELECT r, row_number() OVER (PARTITION BY r ORDER BY spot, sub) AS n, form FROM pieces),
        hits AS (SELECT r, n, name, n - lag(n) OVER (PARTITION BY r ORDER BY n) - 1 AS gap FROM numbered JOIN known USING (form)),
        sequences AS (SELECT r, ';' || string_agg(CASE WHEN gap > {MAX_GAP} THEN '|;' ELSE '' END || name || ';', '' ORDER BY n) AS sequence,
                             count(*) AS n FROM hits GROUP BY r),
        -- One rule at a time, over each sequence that occurs; what a rule has taken is gone for later ones.
        taken(sequence, rest, turn, licence) AS (
            SELECT DISTINCT sequence, sequence, CAST(0 AS BIGINT), CAST(NULL AS VARCHAR) FROM sequences
            UNION ALL
            SELECT t.sequence, replace(t.rest, u.ids, ';#;'), u.turn, CASE WHEN contains(t.rest, u.ids) THEN u.licence END
            FROM taken t JOIN rules u ON u.turn = t.turn + 1),
        named AS (SELECT sequence, string_agg(DISTINCT licence, ',' ORDER BY licence) AS licenses FROM taken GROUP BY sequence)
        SELECT d.doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_sentences, coalesce(s.sequence, ';') AS sequence,
               coalesce(n.licenses, '') AS licenses
        FROM docs d LEFT JOIN sequences s USING (r) LEFT JOIN named n ON n.sequence = s.sequence
    """
