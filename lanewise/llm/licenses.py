"""Licence recognition by sentences and rules over their sequence.

Normalised sentences of a text are mapped to identifiers of known licence sentences; the
sequence of identifiers is matched against ordered rules, longer and more specific ones
first, and what a rule has matched no later rule sees.
"""

from pyspark.sql import Column, DataFrame, functions as F

#: Known licence sentences, normalised, with their identifiers: fixed values.
SENTENCES = {
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit-warranty": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "mit-liability": "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    "mit-name": "released under the mit license",
    "mit-licensed": "licensed under the mit license",
    "mit-this": "this project is licensed under the mit license",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "bsd-grant": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-name": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    # The rest of it after a name with a full stop inside.
    "bsd-name-rest": "nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd3-name": "licensed under the bsd 3 clause license",
    "bsd2-name": "licensed under the bsd 2 clause license",
    "apache-name": "licensed under the apache license version 2 0",
    "apache-the": "licensed under the apache license version 2 0 the license",
    "apache-comply": "you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at http www apache org licenses license 2 0",
    "gpl3-name": "this work is licensed under the gnu general public license version 3",
    "gpl2-name": "this work is licensed under the gnu general public license version 2",
    "gpl3-later": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl2-later": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "lgpl3-later": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "agpl3-later": "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gnu-hope": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "mpl2-form": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "ccbync4-name": "licensed under cc by nc 4 0",
    "ccby4-name": "licensed under cc by 4 0",
    "ccbysa4-name": "licensed under cc by sa 4 0",
    "cc0-name": "released under cc0 1 0",
    "unlicense-grant": "this is free and unencumbered software released into the public domain",
    "spdx-mit": "spdx license identifier mit",
    "spdx-apache": "spdx license identifier apache 2 0",
    "spdx-bsd3": "spdx license identifier bsd 3 clause",
    "spdx-gpl3-later": "spdx license identifier gpl 3 0 or later",
    "spdx-gpl3-only": "spdx license identifier gpl 3 0 only",
    "spdx-gpl2-only": "spdx license identifier gpl 2 0 only",
    "spdx-gpl2-later": "spdx license identifier gpl 2 0 or later",
    "spdx-lgpl21-only": "spdx license identifier lgpl 2 1 only",
    "spdx-lgpl21-later": "spdx license identifier lgpl 2 1 or later",
    "spdx-lgpl3-later": "spdx license identifier lgpl 3 0 or later",
    "spdx-agpl3-only": "spdx license identifier agpl 3 0 only",
    "spdx-agpl3-later": "spdx license identifier agpl 3 0 or later",
    "spdx-bsd2": "spdx license identifier bsd 2 clause",
    "spdx-isc": "spdx license identifier isc",
    "spdx-mpl2": "spdx license identifier mpl 2 0",
    "spdx-cc0": "spdx license identifier cc0 1 0",
    "spdx-unlicense": "spdx license identifier unlicense",
    "spdx-mit-or-apache": "spdx license identifier mit or apache 2 0",
    "spdx-apache-or-mit": "spdx license identifier apache 2 0 or mit",
    # The units that ENDS makes of sentences with a mark inside, as notices over several
    # lines are read.
    "gnu-program": "this program is free software",
    "gnu-library": "this library is free software",
    "gpl-terms": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
    "gpl3-terms": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl2-terms": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "lgpl-terms": "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation",
    "lgpl3-terms": "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "agpl-terms": "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation",
    "agpl3-terms": "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gnu-version3": "either version 3 of the license or at your option any later version",
    "gnu-version2": "either version 2 of the license or at your option any later version",
    "gnu-hope-useful": "this program is distributed in the hope that it will be useful but without any warranty",
    "gnu-hope-implied": "without even the implied warranty of merchantability or fitness for a particular purpose",
    "mpl2-form-open": "this source code form is subject to the terms of the mozilla public license v",
    "apache-obtain": "you may obtain a copy of the license at",
    "apache-obtain-http": "you may obtain a copy of the license at http",
    "apache-obtain-https": "you may obtain a copy of the license at https",
    "apache-url": "www apache org licenses license 2 0",
    "apache-url-unless": "www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
}



def _gnu(name: str, number: str, who: list[str], hope: bool) -> list[tuple[str, list[str]]]:
    """Rules for the units of a notice of the GNU licences: with and without what follows
    it, and with the version in the same unit or in the next."""
    licence = f"{name.upper()}-{number}.0-or-later"
    ends = [["gnu-hope-useful", "gnu-hope-implied"], []] if hope else [[]]
    terms = [[f"{name}{number}-terms"], [f"{name}-terms", f"gnu-version{number}"]]
    return [(licence, [w, *t, *e]) for e in ends for w in who for t in terms]


#: Rules in order: licence, and the identifiers that must follow one another: fixed values.
RULES = [
    ("MIT", ["mit-grant", "mit-notice", "mit-warranty", "mit-liability"]),
    ("MIT", ["mit-grant", "mit-notice", "mit-warranty"]),
    ("MIT", ["mit-grant", "mit-notice"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-name"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-name-rest"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("BSD-1-Clause", ["bsd-grant", "bsd-source"]),
    ("Apache-2.0", ["apache-the", "apache-comply", "apache-copy"]),
    *[
        ("Apache-2.0", ["apache-the", "apache-comply", obtain, url])
        for obtain in ("apache-obtain", "apache-obtain-http", "apache-obtain-https")
        for url in ("apache-url", "apache-url-unless")
    ],
    ("Apache-2.0", ["apache-the"]),
    ("Apache-2.0", ["apache-name"]),
    ("GPL-3.0-or-later", ["gpl3-later", "gnu-hope"]),
    ("GPL-3.0-or-later", ["gpl3-later"]),
    ("GPL-2.0-or-later", ["gpl2-later", "gnu-hope"]),
    ("GPL-2.0-or-later", ["gpl2-later"]),
    ("LGPL-3.0-or-later", ["lgpl3-later"]),
    ("AGPL-3.0-or-later", ["agpl3-later", "gnu-hope"]),
    ("AGPL-3.0-or-later", ["agpl3-later"]),
    *_gnu("gpl", "3", ["gnu-program"], True),
    *_gnu("gpl", "2", ["gnu-program"], True),
    *_gnu("lgpl", "3", ["gnu-library", "gnu-program"], False),
    *_gnu("agpl", "3", ["gnu-program"], True),
    ("GPL-3.0-only", ["gpl3-name"]),
    ("GPL-2.0-only", ["gpl2-name"]),
    ("MPL-2.0", ["mpl2-form"]),
    ("MPL-2.0", ["mpl2-form-open"]),  # these words are of version 2.0 alone
    ("ISC", ["isc-grant"]),
    ("MIT", ["mit-name"]),
    ("MIT", ["mit-licensed"]),
    ("MIT", ["mit-this"]),
    ("BSD-3-Clause", ["bsd3-name"]),
    ("BSD-2-Clause", ["bsd2-name"]),
    ("CC-BY-NC-4.0", ["ccbync4-name"]),
    ("CC-BY-SA-4.0", ["ccbysa4-name"]),
    ("CC-BY-4.0", ["ccby4-name"]),
    ("CC0-1.0", ["cc0-name"]),
    ("Unlicense", ["unlicense-grant"]),
    ("MIT", ["spdx-mit"]),
    ("Apache-2.0", ["spdx-apache"]),
    ("BSD-3-Clause", ["spdx-bsd3"]),
    ("GPL-3.0-or-later", ["spdx-gpl3-later"]),
    ("GPL-3.0-only", ["spdx-gpl3-only"]),
    ("GPL-2.0-only", ["spdx-gpl2-only"]),
    ("GPL-2.0-or-later", ["spdx-gpl2-later"]),
    ("LGPL-2.1-only", ["spdx-lgpl21-only"]),
    ("LGPL-2.1-or-later", ["spdx-lgpl21-later"]),
    ("LGPL-3.0-or-later", ["spdx-lgpl3-later"]),
    ("AGPL-3.0-only", ["spdx-agpl3-only"]),
    ("AGPL-3.0-or-later", ["spdx-agpl3-later"]),
    ("BSD-2-Clause", ["spdx-bsd2"]),
    ("ISC", ["spdx-isc"]),
    ("MPL-2.0", ["spdx-mpl2"]),
    ("CC0-1.0", ["spdx-cc0"]),
    ("Unlicense", ["spdx-unlicense"]),
    ("MIT OR Apache-2.0", ["spdx-mit-or-apache"]),
    ("Apache-2.0 OR MIT", ["spdx-apache-or-mit"]),
]

#: Sentences with a place for a name: what is found, and the known sentence it is read as.
SLOTS = [
    (
        "^neither the name of .+ nor the names of (its|his|her|their|the) contributors may be used",
        "neither the name of the copyright holder nor the names of its contributors may be used",
    ),
    ("^in no event shall .+ be liable for any claim", "in no event shall the authors or copyright holders be liable for any claim"),
    ("^this (file|package|code|software|library|program|work) is licensed under the mit license( see license)?$", "this project is licensed under the mit license"),
]

#: Every known sentence has one of these, so other texts need no closer look.
HINT = "licen|permi|redistribut|software|hope|cc0|neither|implied warranty"
#: Where sentences end: a closing mark before space or the end, a colon, a blank line.
ENDS = r"[.;!?]+(?:\s|$)|:|\n\s*\n"
LINES = r"\n"
_OTHER = "[^a-z0-9]+"


def _pattern(chain: list[str]) -> str:
    return "," + ",".join(chain) + ","


def normalised(sentence: Column) -> Column:
    """Lower-case letters and digits, other characters as one space; names in the places of
    known sentences as the sentences have them."""
    plain = F.trim(F.regexp_replace(F.lower(sentence), _OTHER, " "))
    for slot, known in SLOTS:
        plain = F.regexp_replace(plain, slot, known)
    return plain


def sentence_ids(text: Column, ends: str) -> Column:
    """Identifiers of the known sentences of a text, in order."""
    known = F.create_map(*[F.lit(x) for name, s in SENTENCES.items() for x in (s, name)])
    units = F.split(text, ends)
    return F.filter(F.transform(units, lambda u: F.element_at(known, normalised(u))), lambda i: i.isNotNull())


def _licences(ids: Column) -> Column:
    rules = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(_pattern(chain)).alias("chain")) for name, chain in RULES])
    start = F.struct(
        F.concat(F.lit(","), F.array_join(ids, ","), F.lit(",")).alias("left"),
        F.array().cast("array<string>").alias("names"),
    )

    def apply(state: Column, rule: Column) -> Column:
        hit = F.contains(state["left"], rule["chain"])
        return F.struct(
            F.replace(state["left"], rule["chain"], F.lit(",")).alias("left"),
            F.when(hit, F.array_append(state["names"], rule["name"])).otherwise(state["names"]).alias("names"),
        )

    return F.aggregate(rules, start, apply, lambda state: state["names"])


def scan_licences(docs: DataFrame, text: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` with ``sentences`` and ``licences`` (replaced if
    present): the identifiers found, and the licences of the rules that match them.

    The whole text is read twice: as sentences, which may run over lines, and as lines,
    for notices after a line without a closing mark; a licence that either finds is listed
    once, in the order of rules.  Null, empty and other texts have empty arrays.
    """
    value, none = F.col(text), F.array().cast("array<string>")
    hint = HINT.replace(" ", "[^a-z0-9]+")
    quick = F.coalesce(F.regexp_like(F.lower(value), F.lit(hint)), F.lit(False))
    found = {ends: F.when(quick, sentence_ids(value, ends)).otherwise(none) for ends in (ENDS, LINES)}
    out = docs.withColumns({"__sentences": found[ENDS], "__lines": found[LINES]})
    own = out.withColumns(
        {
            "sentences": F.array_distinct(F.concat("__sentences", "__lines")),
            "licences": F.when(
                F.size("__sentences") + F.size("__lines") > 0,
                F.array_distinct(F.concat(_licences(F.col("__sentences")), _licences(F.col("__lines")))),
            ).otherwise(none),
        }
    )
    return own.drop("__sentences", "__lines")


def duckdb_scan(table: str) -> str:
    """``scan_licences`` as DuckDB SQL: doc_id, sentences and licences (joined by commas)."""
    known = ", ".join(f"('{name}', '{s}')" for name, s in SENTENCES.items())
    plain = "trim(regexp_replace(lower(u), '[^a-z0-9]+', ' ', 'g'))"
    for slot, sentence in SLOTS:
        plain = f"regexp_replace({plain}, '{slot}', '{sentence}')"
    rules = ", ".join(f"({i}, '{name}', '{_pattern(chain)}')" for i, (name, chain) in enumerate(RULES))
    return f"""
WITH RECURSIVE known(id, s) AS (VALUES {known}),
rules(place, name, chain) AS (VALUES {rules}),
texts AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM {table}),
units AS (
  SELECT r, 0 AS way, unnest(string_split_regex(t, '{ENDS}')) AS u,
         generate_subscripts(string_split_regex(t, '{ENDS}'), 1) AS pos FROM texts
  UNION ALL
  SELECT r, 1, unnest(string_split(t, chr(10))), generate_subscripts(string_split(t, chr(10)), 1) FROM texts
),
found AS (
  SELECT r, way, pos, id FROM units
  JOIN known ON {plain} = s
),
chains AS (SELECT r, way, ',' || string_agg(id, ',' ORDER BY pos) || ',' AS line FROM found GROUP BY r, way),
steps AS (
  SELECT r, way, line, CAST(-1 AS INTEGER) AS place, false AS hit FROM chains
  UNION ALL
  SELECT s.r, s.way, replace(s.line, n.chain, ','), n.place, contains(s.line, n.chain)
  FROM steps s JOIN rules n ON n.place = s.place + 1
),
hits AS (
  SELECT r, name, min(way * 1000 + place) AS first FROM steps JOIN rules USING (place) WHERE hit GROUP BY r, name
),
names AS (SELECT r, string_agg(name, ',' ORDER BY first) AS licences FROM hits GROUP BY r),
firsts AS (SELECT r, id, min(way * 1000000000 + pos) AS first FROM found GROUP BY r, id),
lists AS (SELECT r, string_agg(id, ',' ORDER BY first) AS sentences FROM firsts GROUP BY r)
SELECT doc_id, coalesce(sentences, '') AS sentences, coalesce(licences, '') AS licences
FROM texts LEFT JOIN lists USING (r) LEFT JOIN names USING (r)"""
