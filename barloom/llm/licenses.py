"""Licence recognition by sentence rules.

Comment marks and list numbers go, wrapped lines are joined, and the text is cut into sentences.
Each is normalised and mapped to the identifier of a known licence sentence. What is left is a short sequence of identifiers, matched against ordered
licence rules: the first rule that fits a place takes its sentences, so a longer licence is
not reported as the shorter one it contains. Only DataFrame functions are used, row by row.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm.common import read

#: Identifiers and known licence sentences, as they stand in public licence
#: texts and notices. ``#`` stands for a number or version.
SENTENCES = {
    "mit_notice": ["Released under the MIT License", "Licensed under the MIT License", "This project is licensed under the MIT License", "This software is released under the MIT License"],
    "mit_grant": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions"],
    "mit_condition": ["The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"],
    "as_is_software": ["The Software is provided as is, without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement"],
    "apache_notice": ["Licensed under the Apache License, Version #", "Licensed under the Apache License, Version # (the License)"],
    "apache_comply": ["you may not use this file except in compliance with the License"],
    "apache_copy": ["You may obtain a copy of the License at"],
    "gpl_notice": ["This work is licensed under the GNU General Public License, version #", "Licensed under the GNU General Public License, version #", "Released under the GNU General Public License, version #"],
    "gpl_free": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version # of the License, or (at your option) any later version", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version # of the License, or (at your option) any later version"],
    "gpl_warranty": ["This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE"],
    "lgpl_free": ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version # of the License, or (at your option) any later version", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version # of the License, or (at your option) any later version"],
    "agpl_free": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version # of the License, or (at your option) any later version"],
    "agpl_notice": ["Licensed under the GNU Affero General Public License, version #", "This work is licensed under the GNU Affero General Public License, version #"],
    "lgpl_notice": ["Licensed under the GNU Lesser General Public License, version #", "This work is licensed under the GNU Lesser General Public License, version #"],
    "bsd_grant": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"],
    "bsd_source": ["Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer"],
    "bsd_binary": ["Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution"],
    "bsd_endorse": ["Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"],
    "bsd_notice": ["Licensed under the BSD License", "Released under the BSD License"],
    "mpl_notice": ["This Source Code Form is subject to the terms of the Mozilla Public License, version #", "Licensed under the Mozilla Public License, version #"],
    "mpl_obtain": ["If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/#", "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/#"],
    "isc_grant": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"],
    "isc_notice": ["Licensed under the ISC License", "Released under the ISC License"],
    "unlicense": ["This is free and unencumbered software released into the public domain"],
    "zlib_as_is": ["This software is provided as-is, without any express or implied warranty"],
    "zlib_liable": ["In no event will the authors be held liable for any damages arising from the use of this software"],
    "zlib_notice": ["Licensed under the zlib License", "Released under the zlib License"],
    "boost_grant": ["Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the Software) to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following"],
    "boost_notice": ["Distributed under the Boost Software License, Version #", "Licensed under the Boost Software License, Version #"],
    "epl_terms": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License # which is available at https://www.eclipse.org/legal/epl-#/", "This program and the accompanying materials are made available under the terms of the Eclipse Public License v# which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v#.html"],
    "epl_notice": ["Licensed under the Eclipse Public License, version #"],
    "cc_by_nc_notice": ["Licensed under CC BY-NC #", "This work is licensed under CC BY-NC #"],
    "cc_by_sa_notice": ["Licensed under CC BY-SA #", "This work is licensed under CC BY-SA #"],
    "cc_by_notice": ["Licensed under CC BY #", "This work is licensed under CC BY #"],
    "cc0_notice": ["Released under CC0 #", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"],
    "rights_reserved": ["All rights reserved"],
}

#: Ordered rules, licence and the sequence of sentences it needs. Unknown
#: sentences between them break a sequence.
RULES = [
    ("MIT", ["mit_grant", "mit_condition", "as_is_software"]),
    ("MIT", ["mit_grant", "mit_condition"]),
    ("Apache-2.0", ["apache_notice", "apache_comply", "apache_copy"]),
    ("GPL", ["gpl_free", "gpl_warranty"]),
    ("BSD-3-Clause", ["bsd_grant", "bsd_source", "bsd_binary", "bsd_endorse"]),
    ("BSD-2-Clause", ["bsd_grant", "bsd_source", "bsd_binary"]),
    ("LGPL", ["lgpl_free"]),
    ("AGPL", ["agpl_free"]),
    ("MPL-2.0", ["mpl_notice", "mpl_obtain"]),
    ("ISC", ["isc_grant"]),
    ("Unlicense", ["unlicense"]),
    ("Zlib", ["zlib_as_is", "zlib_liable"]),
    ("BSL-1.0", ["boost_grant"]),
    ("EPL", ["epl_terms"]),
    ("MIT", ["mit_notice"]),
    ("MIT", ["mit_grant"]),
    ("Apache-2.0", ["apache_notice"]),
    ("AGPL", ["agpl_notice"]),
    ("LGPL", ["lgpl_notice"]),
    ("GPL", ["gpl_notice"]),
    ("GPL", ["gpl_free"]),
    ("BSD", ["bsd_notice"]),
    ("MPL-2.0", ["mpl_notice"]),
    ("ISC", ["isc_notice"]),
    ("Zlib", ["zlib_notice"]),
    ("BSL-1.0", ["boost_notice"]),
    ("EPL", ["epl_notice"]),
    ("CC-BY-NC", ["cc_by_nc_notice"]),
    ("CC-BY-SA", ["cc_by_sa_notice"]),
    ("CC-BY", ["cc_by_notice"]),
    ("CC0-1.0", ["cc0_notice"]),
    ("Proprietary", ["rights_reserved"]),
]

#: Licence by the identifier of a tag line, without what says "only" or "or later".
TAGS = {
    "MIT": "MIT", "Apache-#": "Apache-2.0", "GPL-#": "GPL", "LGPL-#": "LGPL", "AGPL-#": "AGPL", "BSD-two-Clause": "BSD-2-Clause",
    "BSD-three-Clause": "BSD-3-Clause", "MPL-#": "MPL-2.0", "ISC": "ISC", "Unlicense": "Unlicense", "Zlib": "Zlib", "BSL-#": "BSL-1.0",
    "EPL-#": "EPL", "CC0-#": "CC0-1.0", "CC-BY-#": "CC-BY", "CC-BY-SA-#": "CC-BY-SA", "CC-BY-NC-#": "CC-BY-NC",
}
_TAG = "SPDX license identifier"
for _tag, _license in TAGS.items():
    _name = f"tag_{_license.lower().replace('-', '_').replace('.', '_')}"
    SENTENCES[_name] = [f"{_TAG} {_tag}{end}" for end in (("", "-only", "-or-later", "+") if "GPL" in _tag else ("",))]
    RULES.append((_license, [_name]))

#: What is done to a text, headed by a newline, before it is cut: pattern and replacement, with
#: {1} for the first group. A tag line is a paragraph; "v. 2" is no end of a sentence; comment
#: marks go; an item of a list is a paragraph.
_PREPARE = [
    ("\\r\\n?", "\n"),
    ("SPDX-License-Identifier:[ \\t]*([A-Za-z0-9.+-]+)", f"\n\n{_TAG} {{1}}\n\n"),
    ("-2-Clause", "-two-Clause"),
    ("-3-Clause", "-three-Clause"),
    ("([^A-Za-z])[vV][.] ?([0-9])", "{1}version {2}"),
    ("\\n[ \\t]*(//+!?|/[*]+!?|[*]+/?|#+|--+|;+|>+|%+)?[ \\t]*", "\n"),
    ("\\n[(]?([0-9]{1,2}|[a-z])[.)][ \\t]+", "\n\n"),
]
#: A sentence ends at a blank line, or at `.`, `!`, `?`, `:` or `;` before white space.
_SENTENCE_END = '\\n[ \\t]*\\n[ \\t\\n]*|[.!?:;]+[")]*[ \\t\\n]+'
_VERSION = "[0-9]+([.][0-9]+)*"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ#", "abcdefghijklmnopqrstuvwxyz "


def _plain(text: str) -> str:
    """A known sentence as ``_normal`` leaves it; its ``#`` already stand for numbers."""
    return re.sub(r"[^a-z#]+", " ", re.sub(_VERSION, "#", text.lower())).strip(" ")


def known_sentences() -> dict[str, str]:
    """Normalised known sentences with their identifiers.

    One that holds an end of its own is known by its parts: all of them, in order.
    """
    found: dict[str, str] = {}
    for name, texts in SENTENCES.items():
        for variant, text in enumerate(texts):
            parts = [_plain(x) for x in re.split(_SENTENCE_END, text)]
            for i, part in enumerate(parts):
                if " " not in part.replace("#", "").strip():
                    raise ValueError(f"{name}: {part!r} is no sentence")
                found.setdefault(part, name if len(parts) == 1 else f"{name}_{variant}_{i}")
    return found


def _ids_of(name: str) -> list[list[str]]:
    """The sequences of identifiers that a sentence of a rule may stand for."""
    known = known_sentences()
    return [list(x) for x in dict.fromkeys(tuple(known[_plain(p)] for p in re.split(_SENTENCE_END, text)) for text in SENTENCES[name])]


def expanded_rules() -> list[tuple[str, str]]:
    """Licence and text of identifiers, in the order of the rules; one for each choice of variants."""
    out = []
    for name, ids in RULES:
        choices: list[list[str]] = [[]]
        for sentence in ids:
            choices = [held + own for held in choices for own in _ids_of(sentence)]
        out += [(name, _sequence(x)) for x in choices]
    return list(dict.fromkeys(out))


def _sequence(ids: list[str]) -> str:
    return "".join(f",{x}," for x in ids)


def _normal(sentence: Column) -> Column:
    lowered = F.translate(sentence, _UPPER, _LOWER)
    return F.trim(F.regexp_replace(F.regexp_replace(lowered, _VERSION, "#"), "[^a-z#]+", " "))


def _prepared(text: Column) -> Column:
    out = F.concat(F.lit("\n"), F.coalesce(text, F.lit("")))
    for pattern, replacement in _PREPARE:
        out = F.regexp_replace(out, pattern, replacement.replace("{1}", "$1").replace("{2}", "$2"))
    return out


def scan_licenses(docs: DataFrame) -> DataFrame:
    """Adds ``sentence_ids`` (array), ``licenses`` (sorted array) and ``n_sentences``.

    Lines of a paragraph are one text, whose sentences may go over line ends; a sentence over
    several lines that is not known as a whole is looked up line by line. Comment marks and list
    numbers at the start of a line do not count, and a tag line (SPDX) stands alone. A null or
    empty text has no sentence and no licence. Every row is judged by its own text alone, so
    repeated rows, ties and null ids need no rule. Columns of the same names are replaced.
    """
    known = F.create_map(*[F.lit(x) for pair in known_sentences().items() for x in pair])
    id_of = lambda plain: F.try_element_at(known, plain)
    parts = F.transform(F.split(_prepared(F.col("text")), _SENTENCE_END), lambda x: F.struct(x.alias("raw"), _normal(x).alias("plain")))
    rows = docs.drop("sentence_ids", "licenses", "n_sentences", "_named", "_parts").withColumn("_parts", F.filter(parts, lambda x: x["plain"] != ""))
    lines = lambda raw: F.filter(F.transform(F.split(raw, "\n"), _normal), lambda x: x != "")
    named = F.transform(
        "_parts",
        lambda x: F.when(id_of(x["plain"]).isNotNull(), F.array(id_of(x["plain"])))
        .when(F.contains(x["raw"], F.lit("\n")), F.transform(lines(x["raw"]), lambda y: F.coalesce(id_of(y), F.lit("-"))))
        .otherwise(F.array(F.lit("-"))),
    )
    rows = rows.withColumn("_named", F.flatten(named))
    rules = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(ids).alias("ids")) for name, ids in expanded_rules()])
    start = F.struct(F.concat(F.lit(","), F.array_join("_named", ",,"), F.lit(",")).alias("rest"), F.array().cast("array<string>").alias("found"))
    taken = F.aggregate(
        rules,
        start,
        lambda state, rule: F.struct(
            F.replace(state["rest"], rule["ids"], F.lit(",-,")).alias("rest"),
            F.when(F.contains(state["rest"], rule["ids"]), F.array_append(state["found"], rule["name"])).otherwise(state["found"]).alias("found"),
        ),
        lambda state: F.array_sort(F.array_distinct(state["found"])),
    )
    none = F.array().cast("array<string>")
    return rows.select(
        *[c for c in docs.columns if c not in ("sentence_ids", "licenses", "n_sentences")],
        F.size("_parts").cast("long").alias("n_sentences"),
        F.filter("_named", lambda x: x != "-").alias("sentence_ids"),
        F.when(F.exists("_named", lambda x: x != "-"), taken).otherwise(none).alias("licenses"),
    )


def op9_license_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: its sentences, the known ones in order, and its licences."""
    rows = scan_licenses(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "n_sentences", F.array_join("sentence_ids", ",").alias("sentence_ids"), F.array_join("licenses", ",").alias("licenses"))


def _sql() -> str:
    """The known table is made by SQL's own functions from the sentences as they stand above."""
    def text(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    def normal(x: str) -> str:
        return f"trim(regexp_replace(regexp_replace(lower({x}), '{_VERSION}', '#', 'g'), '[^a-z#]+', ' ', 'g'), ' ')"

    raw = ", ".join(f"({text(name)}, {i}, {text(sentence)})" for name, texts in SENTENCES.items() for i, sentence in enumerate(texts))
    prepared = "chr(10) || coalesce(text, '')"
    for pattern, replacement in _PREPARE:
        made = replacement.replace("{1}", "\\1").replace("{2}", "\\2")
        prepared = f"regexp_replace({prepared}, '{pattern}', '{made}', 'g')"
    steps, found, last = [], [], "joined"
    for i, (name, seq) in enumerate(expanded_rules()):
        steps.append(f"r{i} AS (SELECT * EXCLUDE (rest), contains(rest, '{seq}') AS hit{i}, replace(rest, '{seq}', ',-,') AS rest FROM {last})")
        found.append(f"CASE WHEN hit{i} THEN '{name}' END")
        last = f"r{i}"
    return f"""
WITH raw(name, variant, sentence) AS (VALUES {raw}),
cut AS (SELECT name, variant, regexp_split_to_array(sentence, '{_SENTENCE_END}') AS l FROM raw),
ids AS (
    SELECT {normal("l[i]")} AS sentence, CASE WHEN len(l) = 1 THEN name ELSE name || '_' || variant || '_' || (i - 1) END AS id, u.n
    FROM (SELECT *, row_number() OVER () AS n FROM cut) u, LATERAL (SELECT unnest(range(1, len(u.l) + 1)) AS i)),
known AS (SELECT sentence, arg_min(id, n) AS id FROM ids GROUP BY sentence),
parts AS (
    SELECT doc_id, p.pos, p.raw, {normal("replace(p.raw, '#', ' ')")} AS s
    FROM (SELECT doc_id, regexp_split_to_array({prepared}, '{_SENTENCE_END}') AS l FROM documents) d,
    LATERAL (SELECT unnest(d.l) AS raw, generate_subscripts(d.l, 1) AS pos) p),
whole AS (SELECT parts.*, id FROM parts LEFT JOIN known ON s = sentence WHERE s <> ''),
lines AS (
    SELECT doc_id, w.pos, q.line_pos, {normal("replace(q.line, '#', ' ')")} AS s
    FROM whole w, LATERAL (SELECT unnest(string_split(w.raw, chr(10))) AS line, generate_subscripts(string_split(w.raw, chr(10)), 1) AS line_pos) q
    WHERE w.id IS NULL AND contains(w.raw, chr(10))),
named AS (
    SELECT doc_id, pos, 0 AS line_pos, coalesce(id, '-') AS name FROM whole WHERE id IS NOT NULL OR NOT contains(raw, chr(10))
    UNION ALL
    SELECT doc_id, pos, line_pos, coalesce(id, '-') FROM lines LEFT JOIN known ON s = sentence WHERE s <> ''),
counted AS (SELECT doc_id, count(*) AS n_sentences FROM whole GROUP BY doc_id),
summed AS (SELECT doc_id, string_agg(name, ',' ORDER BY pos, line_pos) FILTER (WHERE name <> '-') AS sentence_ids,
           list(name ORDER BY pos, line_pos) AS names FROM named GROUP BY doc_id),
joined AS (SELECT *, ',' || array_to_string(names, ',,') || ',' AS rest FROM summed),
{", ".join(steps)}
SELECT d.doc_id, coalesce(n_sentences, 0)::BIGINT AS n_sentences, coalesce(sentence_ids, '') AS sentence_ids,
       coalesce(array_to_string(list_sort(list_distinct(list_filter([{", ".join(found)}], lambda x: x IS NOT NULL))), ','), '') AS licenses
FROM documents d LEFT JOIN {last} r ON d.doc_id = r.doc_id LEFT JOIN counted c ON d.doc_id = c.doc_id
"""


OP9_SQL = _sql()
