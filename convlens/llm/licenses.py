"""Licences in documents: known sentences first, then ordered rules over their identifiers."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convlens.llm.quality import let

# Normalised sentences of public licence texts and notices, and the rules over them, the specific before the general.
SENTENCES = {
    "mit-notice": "released under the mit license",
    "mit-licensed": "licensed under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-condition": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit-as-is": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "apache-notice": "licensed under the apache license version 2 0",
    "apache-the-license": "licensed under the apache license version 2 0 the license",
    "apache-use": "you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at",
    "gpl-3-notice": "this work is licensed under the gnu general public license version 3",
    "gpl-2-notice": "this work is licensed under the gnu general public license version 2",
    "gpl-free": "this program is free software",
    "gpl-3-redistribute": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl-2-redistribute": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl-useful": "this program is distributed in the hope that it will be useful but without any warranty",
    "cc-by-nc-4-notice": "licensed under cc by nc 4 0",
    "cc-by-sa-4-notice": "licensed under cc by sa 4 0",
    "cc-by-4-notice": "licensed under cc by 4 0",
    "bsd-head": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-names": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd-as-is": "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
    "mpl-notice-cut": "this source code form is subject to the terms of the mozilla public license v",
    "mpl-notice": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "mit-title": "mit license",
    "mit-the-title": "the mit license",
    "mit-the-title-mark": "the mit license mit",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "isc-grant-old": "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "isc-as-is": "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness",
    "bsd-names-owner": "neither the name of the copyright owner nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "apache-title": "apache license",
    "apache-date": "version 2 0 january 2004",
    "apache-terms": "terms and conditions for use reproduction and distribution",
    "gpl-title": "gnu general public license",
    "lgpl-title": "gnu lesser general public license",
    "agpl-title": "gnu affero general public license",
    "date-1991": "version 2 june 1991",
    "date-1999": "version 2 1 february 1999",
    "date-2007-june": "version 3 29 june 2007",
    "date-2007-november": "version 3 19 november 2007",
    "library-free": "this library is free software",
    "gpl-2-only": "you can redistribute it and or modify it under the terms of the gnu general public license version 2 as published by the free software foundation",
    "gpl-3-only": "you can redistribute it and or modify it under the terms of the gnu general public license version 3 as published by the free software foundation",
    "lgpl-21-redistribute": "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version",
    "lgpl-3-redistribute": "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "agpl-3-redistribute": "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "mpl-title": "mozilla public license version 2 0",
    "epl-notice": "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0",
    "epl-title": "eclipse public license v 2 0",
    "unlicense-domain": "this is free and unencumbered software released into the public domain",
    "unlicense-anyone": "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means",
    "cc0-title": "cc0 1 0 universal",
    "cc0-notice": "to the extent possible under law the author s have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide",
    "cc-by-4-long": "this work is licensed under a creative commons attribution 4 0 international license",
    "cc-by-sa-4-long": "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    "cc-by-nc-4-long": "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
}
RULES = [
    ("BSD-3-Clause", ["bsd-head", "bsd-source", "bsd-binary", "bsd-names", "bsd-as-is"]),
    ("BSD-3-Clause", ["bsd-head", "bsd-source", "bsd-binary", "bsd-names-owner", "bsd-as-is"]),
    ("BSD-2-Clause", ["bsd-head", "bsd-source", "bsd-binary", "bsd-as-is"]),
    ("MIT", ["mit-grant", "mit-condition", "mit-as-is"]),
    ("ISC", ["isc-grant", "isc-as-is"]),
    ("ISC", ["isc-grant-old", "isc-as-is"]),
    ("AGPL-3.0-or-later", ["gpl-free", "agpl-3-redistribute"]),
    ("LGPL-3.0-or-later", ["library-free", "lgpl-3-redistribute"]),
    ("LGPL-3.0-or-later", ["gpl-free", "lgpl-3-redistribute"]),
    ("LGPL-2.1-or-later", ["library-free", "lgpl-21-redistribute"]),
    ("LGPL-2.1-or-later", ["gpl-free", "lgpl-21-redistribute"]),
    ("GPL-3.0-or-later", ["gpl-free", "gpl-3-redistribute", "gpl-useful"]),
    ("GPL-2.0-or-later", ["gpl-free", "gpl-2-redistribute", "gpl-useful"]),
    ("GPL-3.0-only", ["gpl-free", "gpl-3-only"]),
    ("GPL-2.0-only", ["gpl-free", "gpl-2-only"]),
    ("Unlicense", ["unlicense-domain", "unlicense-anyone"]),
    ("EPL-2.0", ["epl-notice"]),
    ("CC0-1.0", ["cc0-notice"]),
    ("Apache-2.0", ["apache-the-license", "apache-use"]),
    ("Apache-2.0", ["apache-title", "apache-date"]),
    ("AGPL-3.0", ["agpl-title", "date-2007-november"]),
    ("LGPL-3.0", ["lgpl-title", "date-2007-june"]),
    ("LGPL-2.1", ["lgpl-title", "date-1999"]),
    ("GPL-3.0", ["gpl-title", "date-2007-june"]),
    ("GPL-2.0", ["gpl-title", "date-1991"]),
    ("MPL-2.0", ["mpl-title"]),
    ("EPL-2.0", ["epl-title"]),
    ("CC0-1.0", ["cc0-title"]),
    ("MPL-2.0", ["mpl-notice"]),
    ("MPL-2.0", ["mpl-notice-cut"]),
    ("MIT", ["mit-notice"]),
    ("MIT", ["mit-licensed"]),
    ("Apache-2.0", ["apache-notice"]),
    ("GPL-3.0", ["gpl-3-notice"]),
    ("GPL-2.0", ["gpl-2-notice"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-4-notice"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-4-long"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-4-notice"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-4-long"]),
    ("CC-BY-4.0", ["cc-by-4-notice"]),
    ("CC-BY-4.0", ["cc-by-4-long"]),
    ("MIT", ["mit-title", "mit-grant"]),
    ("MIT", ["mit-the-title", "mit-grant"]),
    ("MIT", ["mit-the-title-mark", "mit-grant"]),
]
#: Licences named by a tag line; the tag line's sentence is `spdx license identifier` and the name.
TAGGED = [
    "MIT", "Apache-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later",
    "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "AGPL-3.0-only", "AGPL-3.0-or-later",
    "BSD-2-Clause", "BSD-3-Clause", "ISC", "MPL-2.0", "EPL-2.0", "Unlicense",
    "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0",
]
for _name in TAGGED:
    SENTENCES[f"spdx-{_name.lower()}"] = "spdx license identifier " + " ".join(re.findall("[a-z0-9]+", _name.lower()))
    RULES.append((_name, [f"spdx-{_name.lower()}"]))
#: A text without any of these words holds none of the sentences.
STEMS = "licen[cs]e|redistribut|permission|warrant|software|public|version|terms|anyone|cc0"


def sentences(text: Column) -> Column:
    """A text cut at line ends, and after `.`, `!`, `?`, `;` or `:` before white space."""
    return F.split(F.regexp_replace(text, r"[.!?;:]+[\x20\x09-\x0D]+", "\n"), "\n")


#: A tag keeps its value: no sentence ends at its colon.
TAG = r"(?i)(SPDX-License-Identifier):[ \t]*"
#: What comments put before the text of a line.
LEADER = r"(?m)^[ \t]*(?:/\*+|\*+/|\*+|//+|#+|--+|;+|%+|<!--+|dnl\b|rem\b)[ \t]*"
#: Lines that are no part of the sentence around them: copyright lines and headings.
ALONE = (
    r"(?mi)^[ \t]*((?:copyright[ \t]+(?:\(c\)|(?:19|20)[0-9]{2})|\(c\)|all rights reserved|spdx-license-identifier)[^\n]*|"
    r"(?:the )?(?:mit|isc|apache|bsd|gnu [a-z ]*general public|mozilla public|eclipse public) licen[cs]e(?: \(mit\)| \(isc\))?[ \t]*)$"
)


def paragraphs(text: Column) -> Column:
    """The text with its wrapped lines joined, and line ends only between paragraphs.

    Comment leaders are taken off. Blank lines and the end of a comment end a
    paragraph; copyright lines, headings and tags stand alone.
    """
    plain = F.regexp_replace(F.regexp_replace(text, r"\r\n?", "\n"), LEADER, "\u0002")
    plain = F.translate(F.regexp_replace(plain, "(\u0002[^\n]*\n)(?!\u0002)", "$1\n"), "\u0002", "")
    marked = F.regexp_replace(F.regexp_replace(plain, ALONE, "\n\n$1\n\n"), r"\n[ \t]*\n[ \t\n]*", "\u0001")
    return F.translate(marked, "\n\u0001", " \n")


def normalised(sentence: Column) -> Column:
    """Lower-cased ASCII letters and digits, single spaces between."""
    return F.trim(F.regexp_replace(F.lower(sentence), "[^a-z0-9]+", " "))


def identifiers(listed: Column, known: dict[str, str]) -> Column:
    """The identifiers of the known sentences, in order. A sentence is normalised only if it begins like one."""
    texts = list(known.values())
    begin = "|".join(sorted({t.split()[0] for t in texts}))
    likely = F.filter(listed, lambda s: F.lower(s).rlike(f"^[^a-z0-9]*(?:{begin})(?![a-z0-9])"))
    plain = F.transform(likely, normalised)
    table = F.create_map(*[x for name, s in known.items() for x in (F.lit(s), F.lit(name))])
    return F.transform(F.filter(plain, lambda s: s.isin(texts)), lambda s: table[s])


def matched(ids: Column, rules: list[tuple[str, list[str]]]) -> Column:
    """The licences whose rule is a run of the identifiers, in the order of the rules."""
    run = F.concat(F.lit(" "), F.array_join(ids, " "), F.lit(" "))
    names = list(dict.fromkeys(n for n, _ in rules))
    parts = []
    for name in names:
        hits = [F.locate(f" {' '.join(r)} ", run) > 0 for n, r in rules if n == name]
        parts.append(F.when(reduce(lambda a, b: a | b, hits), F.lit(name)))
    return F.array_compact(F.array(*parts))


def winner(ids: Column, rules: list[tuple[str, list[str]]]) -> Column:
    """The licence of the first rule, in order, that is a run of the identifiers; null if none is."""
    run = F.concat(F.lit(" "), F.array_join(ids, " "), F.lit(" "))
    return F.coalesce(*[F.when(F.locate(f" {' '.join(r)} ", run) > 0, F.lit(n)) for n, r in rules])


def scan(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text",
    known: dict[str, str] = SENTENCES, rules: list[tuple[str, list[str]]] = RULES, stems: str = STEMS,
) -> DataFrame:
    """(id, sentence_ids, licenses, license) of every row: two arrays, and the licence of the first rule that fits.

    A whole text is read twice: by lines, and by paragraphs with wrapped lines
    joined and comment leaders taken off; a rule may match in either. Sentences
    outside the known ones are passed over, so a rule is a run of known
    sentences. `licenses` names every rule that fits, `license` the first in
    order, the specific before the general, paragraphs before lines. Null and
    empty texts have empty arrays and a null; repeated rows each keep theirs.
    Sentences and rules are lists of fixed size that are part of the query; a
    text without any of the `stems` holds no known sentence and is not cut.
    """
    whole = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), TAG, "$1 ")
    none = F.array().cast("array<string>")
    both = let(
        whole,
        lambda t: F.when(
            F.lower(t).rlike(stems),
            F.struct(identifiers(sentences(t), known).alias("by_line"), identifiers(sentences(paragraphs(t)), known).alias("joined")),
        ).otherwise(F.struct(none.alias("by_line"), none.alias("joined"))),
    )
    made = docs.select(F.col(id_col), both.alias("_ids"))
    licences = F.array_union(matched(F.col("_ids.by_line"), rules), matched(F.col("_ids.joined"), rules))
    longer = F.when(F.size("_ids.joined") > F.size("_ids.by_line"), F.col("_ids.joined")).otherwise(F.col("_ids.by_line"))
    first = F.coalesce(winner(F.col("_ids.joined"), rules), winner(F.col("_ids.by_line"), rules))
    return made.select(id_col, longer.alias("sentence_ids"), licences.alias("licenses"), first.alias("license"))
