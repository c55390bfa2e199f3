"""Licence scan by sentence rules: known sentences become identifiers, their sequence meets ordered rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.llm.common import let

#: Known sentences, normalised, by identifier: fixed values.
SENTENCES = {
    "apache-notice": "licensed under the apache license version 2 0",
    "apache-comply": "you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at http www apache org licenses license 2 0",
    "apache-basis": (
        "unless required by applicable law or agreed to in writing software distributed under the license is"
        " distributed on an as is basis without warranties or conditions of any kind either express or implied"
    ),
    "mit-notice": "released under the mit license",
    "mit-licensed": "licensed under the mit license",
    "mit-title": "the mit license",
    "mit-permission": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
        " documentation files the software to deal in the software without restriction including without limitation"
        " the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and"
        " to permit persons to whom the software is furnished to do so subject to the following conditions"
    ),
    "mit-condition": (
        "the above copyright notice and this permission notice shall be included in all copies or substantial"
        " portions of the software"
    ),
    "as-is": (
        "the software is provided as is without warranty of any kind express or implied including but not limited to"
        " the warranties of merchantability fitness for a particular purpose and noninfringement"
    ),
    "bsd-permission": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that"
        " the following conditions are met"
    ),
    "bsd-source": (
        "redistributions of source code must retain the above copyright notice this list of conditions and the"
        " following disclaimer"
    ),
    "bsd-binary": (
        "redistributions in binary form must reproduce the above copyright notice this list of conditions and the"
        " following disclaimer in the documentation and or other materials provided with the distribution"
    ),
    "bsd-endorse": (
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote"
        " products derived from this software without specific prior written permission"
    ),
    "gpl3-work": "this work is licensed under the gnu general public license version 3",
    "gpl3-notice": "licensed under the gnu general public license version 3",
    "gpl-modify": (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general"
        " public license as published by the free software foundation either version 3 of the license or at your"
        " option any later version"
    ),
    "gpl-warranty": (
        "this program is distributed in the hope that it will be useful but without any warranty without even the"
        " implied warranty of merchantability or fitness for a particular purpose"
    ),
    "cc-by": "licensed under cc by 4 0",
    "cc-by-sa": "licensed under cc by sa 4 0",
    "cc-by-nc": "licensed under cc by nc 4 0",
    "cc0": "to the extent possible under law the author has waived all copyright and related rights to this work",
    "cc-by-nd": "licensed under cc by nd 4 0",
    "cc-by-nc-sa": "licensed under cc by nc sa 4 0",
    "cc-by-nc-nd": "licensed under cc by nc nd 4 0",
    "apache-title": "apache license version 2 0 january 2004",
    "gpl3-title": "gnu general public license version 3 29 june 2007",
    "gpl2-title": "gnu general public license version 2 june 1991",
    "gpl3-later": "licensed under the gnu general public license version 3 or later",
    "gpl3-only-modify": (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general"
        " public license as published by the free software foundation version 3"
    ),
    "gpl2-notice": "licensed under the gnu general public license version 2",
    "gpl2-later": "licensed under the gnu general public license version 2 or later",
    "gpl2-modify": (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general"
        " public license as published by the free software foundation either version 2 of the license or at your"
        " option any later version"
    ),
    "gpl2-only-modify": (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general"
        " public license as published by the free software foundation version 2"
    ),
    "agpl3-title": "gnu affero general public license version 3 19 november 2007",
    "agpl3-modify": (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu affero"
        " general public license as published by the free software foundation either version 3 of the license or at"
        " your option any later version"
    ),
    "lgpl3-title": "gnu lesser general public license version 3 29 june 2007",
    "lgpl3-modify": (
        "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser"
        " general public license as published by the free software foundation either version 3 of the license or at"
        " your option any later version"
    ),
    "lgpl21-title": "gnu lesser general public license version 2 1 february 1999",
    "lgpl21-modify": (
        "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser"
        " general public license as published by the free software foundation either version 2 1 of the license or at"
        " your option any later version"
    ),
    "lgpl-warranty": (
        "this library is distributed in the hope that it will be useful but without any warranty without even the"
        " implied warranty of merchantability or fitness for a particular purpose"
    ),
    "mpl-title": "mozilla public license version 2 0 1 definitions",
    "mpl-form": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "mpl-copy": "if a copy of the mpl was not distributed with this file you can obtain one at",
    "epl-made": (
        "this program and the accompanying materials are made available under the terms of the eclipse public license"
        " 2 0 which is available at"
    ),
    "isc-permission": (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby"
        " granted provided that the above copyright notice and this permission notice appear in all copies"
    ),
    "0bsd-permission": (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby"
        " granted"
    ),
    "author-as-is": (
        "the software is provided as is and the author disclaims all warranties with regard to this software including"
        " all implied warranties of merchantability and fitness"
    ),
    "unlicense-free": "this is free and unencumbered software released into the public domain",
    "unlicense-anyone": (
        "anyone is free to copy modify publish use compile sell or distribute this software either in source code form"
        " or as a compiled binary for any purpose commercial or non commercial and by any means"
    ),
    "boost-notice": "distributed under the boost software license version 1 0",
    "boost-title": "boost software license version 1 0 august 17th 2003",
    "zlib-as-is": (
        "this software is provided as is without any express or implied warranty in no event will the authors be held"
        " liable for any damages arising from the use of this software"
    ),
    "zlib-permission": (
        "permission is granted to anyone to use this software for any purpose including commercial applications and to"
        " alter it and redistribute it freely subject to the following restrictions"
    ),
}

#: Other published wordings of a known sentence, normalised: fixed values.
WORDINGS = {
    "you may obtain a copy of the license at https www apache org licenses license 2 0": "apache-copy",
    "you may obtain a copy of the license at": "apache-copy",
    (
        "the above copyright notice and this permission notice including the next paragraph shall be included in all"
        " copies or substantial portions of the software"
    ): "mit-condition",
    # Names of the holder stand before this part.
    (
        "nor the names of its contributors may be used to endorse or promote products derived from this software"
        " without specific prior written permission"
    ): "bsd-endorse",
    (
        "permission to use copy modify and distribute this software for any purpose with or without fee is hereby"
        " granted provided that the above copyright notice and this permission notice appear in all copies"
    ): "isc-permission",
    "has waived all copyright and related or neighboring rights to": "cc0",
    **{
        f"licensed under {article}creative commons attribution {words}4 0 international": name
        for article in ("a ", "the ", "")
        for words, name in (
            ("", "cc-by"),
            ("sharealike ", "cc-by-sa"),
            ("noncommercial ", "cc-by-nc"),
            ("noderivatives ", "cc-by-nd"),
            ("noncommercial sharealike ", "cc-by-nc-sa"),
            ("noncommercial noderivatives ", "cc-by-nc-nd"),
        )
    },
    # "or later" takes the place of "version 3" alone.
    **{
        f"{start}licensed under the gnu general public license version {n} {end}": f"gpl{n}-later"
        for start in ("", "this work is ")
        for n in (2, 3)
        for end in ("or later", "or any later version", "or at your option any later version")
    },
}

#: Rules: name, licence, and the identifiers that must follow one another: fixed values.
RULES = [
    ("apache-2.0-notice", "Apache-2.0", ["apache-notice"]),
    ("apache-2.0-header", "Apache-2.0", ["apache-notice", "apache-comply", "apache-copy", "apache-basis"]),
    ("mit-notice", "MIT", ["mit-notice"]),
    ("mit-licensed", "MIT", ["mit-licensed"]),
    ("mit-text", "MIT", ["mit-permission", "mit-condition", "as-is"]),
    ("mit-title-text", "MIT", ["mit-title", "mit-permission", "mit-condition", "as-is"]),
    ("bsd-2-clause", "BSD-2-Clause", ["bsd-permission", "bsd-source", "bsd-binary"]),
    ("bsd-3-clause", "BSD-3-Clause", ["bsd-permission", "bsd-source", "bsd-binary", "bsd-endorse"]),
    ("gpl-3.0-work", "GPL-3.0-only", ["gpl3-work"]),
    ("gpl-3.0-notice", "GPL-3.0-only", ["gpl3-notice"]),
    ("gpl-3.0-header", "GPL-3.0-or-later", ["gpl-modify", "gpl-warranty"]),
    ("cc-by-4.0", "CC-BY-4.0", ["cc-by"]),
    ("cc-by-sa-4.0", "CC-BY-SA-4.0", ["cc-by-sa"]),
    ("cc-by-nc-4.0", "CC-BY-NC-4.0", ["cc-by-nc"]),
    ("cc0-1.0", "CC0-1.0", ["cc0"]),
    ("cc-by-nd-4.0", "CC-BY-ND-4.0", ["cc-by-nd"]),
    ("cc-by-nc-sa-4.0", "CC-BY-NC-SA-4.0", ["cc-by-nc-sa"]),
    ("cc-by-nc-nd-4.0", "CC-BY-NC-ND-4.0", ["cc-by-nc-nd"]),
    ("apache-2.0-text", "Apache-2.0", ["apache-title"]),
    ("gpl-3.0-text", "GPL-3.0-only", ["gpl3-title"]),
    ("gpl-3.0-later-notice", "GPL-3.0-or-later", ["gpl3-later"]),
    ("gpl-3.0-only-header", "GPL-3.0-only", ["gpl3-only-modify"]),
    ("gpl-2.0-text", "GPL-2.0-only", ["gpl2-title"]),
    ("gpl-2.0-notice", "GPL-2.0-only", ["gpl2-notice"]),
    ("gpl-2.0-later-notice", "GPL-2.0-or-later", ["gpl2-later"]),
    ("gpl-2.0-only-header", "GPL-2.0-only", ["gpl2-only-modify"]),
    ("gpl-2.0-header", "GPL-2.0-or-later", ["gpl2-modify", "gpl-warranty"]),
    ("agpl-3.0-text", "AGPL-3.0-only", ["agpl3-title"]),
    ("agpl-3.0-header", "AGPL-3.0-or-later", ["agpl3-modify", "gpl-warranty"]),
    ("lgpl-3.0-text", "LGPL-3.0-only", ["lgpl3-title"]),
    ("lgpl-3.0-header", "LGPL-3.0-or-later", ["lgpl3-modify", "lgpl-warranty"]),
    ("lgpl-2.1-text", "LGPL-2.1-only", ["lgpl21-title"]),
    ("lgpl-2.1-header", "LGPL-2.1-or-later", ["lgpl21-modify", "lgpl-warranty"]),
    ("mpl-2.0-text", "MPL-2.0", ["mpl-title"]),
    ("mpl-2.0-header", "MPL-2.0", ["mpl-form", "mpl-copy"]),
    ("epl-2.0-header", "EPL-2.0", ["epl-made"]),
    ("isc-text", "ISC", ["isc-permission", "author-as-is"]),
    ("0bsd-text", "0BSD", ["0bsd-permission", "author-as-is"]),
    ("unlicense-text", "Unlicense", ["unlicense-free", "unlicense-anyone"]),
    ("bsl-1.0-notice", "BSL-1.0", ["boost-notice"]),
    ("bsl-1.0-text", "BSL-1.0", ["boost-title"]),
    ("zlib-text", "Zlib", ["zlib-as-is", "zlib-permission"]),
]

#: Where a sentence ends in the check SQL, which knows whole sentences only: a stop with what clings to it before white space, or the end of a line or paragraph.
LINE_ENDS = r"[.?][^\p{L}\p{N}\s]*\s+|\n+"
PARAGRAPH_ENDS = r"[.?:][^\p{L}\p{N}\s]*\s+|\n\s*\n"


def normalised(sentence: Column) -> Column:
    """Lower case, with one blank for each run of anything but letters and digits."""
    return F.trim(F.regexp_replace(F.lower(sentence), r"[^\p{L}\p{N}]+", " "))


def identifiers(text: Column) -> Column:
    """Identifiers of the known sentences of a text, in order; all other words are left out.

    A sentence is found wherever its words follow one another, so wraps, comment signs, stops and what
    stands before or after it do not matter. Of several at one place the longest counts; after "not" none.
    """
    names = {words: name for name, words in SENTENCES.items()} | WORDINGS
    known = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    longest_first = "|".join(sorted(names, key=len, reverse=True))
    padded = F.concat(F.lit(" "), normalised(F.coalesce(text, F.lit(""))), F.lit(" "))
    found = F.regexp_extract_all(padded, F.lit(f" (?<! not )({longest_first})(?= )"), F.lit(1))
    return F.transform(found, lambda s: F.element_at(known, s))


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, rule, license and sentences for every rule that a text of `docs` (doc_id, text) meets.

    The whole text is read. A rule is met if its identifiers follow one another, with no other known
    sentence between; a rule that is part of a longer rule met is left out. NULL and empty texts meet
    none. Repeated rows give repeated results; an empty table gives an empty result; further columns are
    ignored.
    """
    found = docs.select("doc_id", identifiers(F.col(text)).alias("names"))
    spelled = F.concat(F.lit("|"), F.array_join("names", "|"), F.lit("|"))
    rules = F.array(
        *[
            F.struct(
                F.lit(name).alias("rule"), F.lit(licence).alias("license"), F.lit("|" + "|".join(ids) + "|").alias("ids")
            )
            for name, licence, ids in RULES
        ]
    )
    met = F.when(F.size("names") > 0, let(spelled, lambda ids: F.filter(rules, lambda r: F.contains(ids, r["ids"]))))
    longest = let(
        met,
        lambda m: F.filter(
            m, lambda r: ~F.exists(m, lambda q: (F.length(q["ids"]) > F.length(r["ids"])) & F.contains(q["ids"], r["ids"]))
        ),
    )
    rows = found.select("doc_id", F.explode_outer(longest).alias("r")).filter("r IS NOT NULL")
    return rows.select(
        "doc_id", "r.rule", "r.license", (F.size(F.split("r.ids", r"\|")) - 2).cast("bigint").alias("sentences")
    )


def scan_sql() -> str:
    """The same for the table `documents` in SQL."""
    known = ", ".join(f"('{words}', '{name}')" for name, words in SENTENCES.items())
    rules = ", ".join(f"('{name}', '{licence}', '|{'|'.join(ids)}|', {len(ids)})" for name, licence, ids in RULES)

    def spelled(ends: str) -> str:
        return f"""
            SELECT r.row, '|' || string_agg(k.name, '|' ORDER BY r.place) || '|' AS ids
            FROM (SELECT row, generate_subscripts(list, 1) AS place, unnest(list) AS sentence
                  FROM (SELECT row, string_split_regex(text, '{ends}') AS list FROM docs)) r
            JOIN known k ON k.words = trim(regexp_replace(lower(r.sentence), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))
            GROUP BY r.row"""

    return f"""
        WITH docs AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
        known(words, name) AS (VALUES {known}),
        rules(rule, license, ids, sentences) AS (VALUES {rules}),
        seen AS ({spelled(LINE_ENDS)} UNION ALL {spelled(PARAGRAPH_ENDS)}),
        met AS (SELECT DISTINCT s.row, r.* FROM seen s JOIN rules r ON contains(s.ids, r.ids))
        SELECT d.doc_id, m.rule, m.license, CAST(m.sentences AS BIGINT) AS sentences
        FROM met m JOIN docs d ON d.row = m.row
        WHERE NOT EXISTS (SELECT 1 FROM met q WHERE q.row = m.row AND length(q.ids) > length(m.ids)
                          AND contains(q.ids, m.ids))"""
