"""Licence recognition by sentence rules.

A text is cut into segments: at line ends, and behind ".", ";", ":", "!" or "?" where white
space or the end follows. Segments are normalised: lower case, everything but letters and digits
one space, so that comment marks vanish; a list number at the begin of a line is left out. A known sentence is
one segment or several in a row, so a sentence may be wrapped anywhere, and a full stop
within it does no harm; the longest known sentence that begins at a segment is taken. It becomes its
identifier, any run of other segments a gap. Ordered rules, more sentences first, then match
identifier sequences: from left to right, the first rule that fits takes its sentences.

Null or empty text: no sentence and no licence. A repeated notice counts each time, repeated rows each get their result, an empty table
gives no row. Of docs only the columns named are read, so that others may have any name.
All of it is Spark expressions without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of public licence texts and notices, by identifier.
TEXTS = {
    "MIT1": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "MIT2": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "MIT3": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    "MIT4": "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "MIT0": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so.",
    "ISC1": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "ISC2": "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "ISC3": "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",
    "ZBSD": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
    "BSD0": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "BSD1": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "BSD2": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "BSD3": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "BSD4": "All advertising materials mentioning features or use of this software must display the following acknowledgement:",
    "BSDD": "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
    "APA1": "Licensed under the Apache License, Version 2.0 (the \"License\");",
    "APA2": "you may not use this file except in compliance with the License.",
    "APA3": "You may obtain a copy of the License at",
    "GPL1": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "GPL2": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "GPL3": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation.",
    "GPL4": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, version 3.",
    "LGP1": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "LGP2": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "AGP1": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "MPL1": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "MPL2": "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "MPL3": "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "EPL1": "This program and the accompanying materials are made available under the terms of the Eclipse Public License v2.0 which accompanies this distribution.",
    "EPL2": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "UNL1": "This is free and unencumbered software released into the public domain.",
    "ZLI1": "This software is provided 'as-is', without any express or implied warranty.",
    "ZLI2": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    "BSL1": "Distributed under the Boost Software License, Version 1.0.",
    "BSL2": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:",
    "WTF1": "Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as long as the name is changed.",
    "WTF2": "You just DO WHAT THE FUCK YOU WANT TO.",
    "CC01": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
}
# Who may not be named in the third condition of the BSD licence, besides "the copyright holder".
HOLDERS = ("the copyright holders", "the author", "the organization", "the University", "the project")
# Licences, and the names by which notices call them.
NAMES = {
    "MIT": ("MIT License", "MIT licence", "MIT"),
    "ISC": ("ISC License",),
    "BSD-2-Clause": ("BSD 2-Clause License", "Simplified BSD License", "2-Clause BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "3-Clause BSD License", "New BSD License"),
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache License v2.0"),
    "GPL-2.0-only": ("GNU General Public License, version 2", "GNU General Public License v2.0", "GPLv2"),
    "GPL-3.0-only": ("GNU General Public License, version 3", "GNU General Public License v3.0", "GPLv3"),
    "LGPL-2.1-only": ("GNU Lesser General Public License, version 2.1", "LGPLv2.1"),
    "LGPL-3.0-only": ("GNU Lesser General Public License, version 3", "LGPLv3"),
    "AGPL-3.0-only": ("GNU Affero General Public License, version 3", "GNU Affero General Public License v3.0", "AGPLv3"),
    "MPL-2.0": ("Mozilla Public License, version 2.0", "Mozilla Public License 2.0"),
    "EPL-2.0": ("Eclipse Public License 2.0",),
    "BSL-1.0": ("Boost Software License 1.0",),
    "CC0-1.0": ("CC0", "CC0 1.0", "Creative Commons Zero v1.0 Universal license"),
    "CC-BY-4.0": ("CC BY 4.0", "CC-BY-4.0", "Creative Commons Attribution 4.0 International License"),
    "CC-BY-SA-4.0": ("CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    "CC-BY-ND-4.0": ("CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License"),
    "CC-BY-NC-4.0": ("CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    "CC-BY-NC-SA-4.0": ("CC BY-NC-SA 4.0", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"),
    "CC-BY-NC-ND-4.0": ("CC BY-NC-ND 4.0", "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License"),
}
# Identifiers of further licences, for the machine-readable line alone.
MORE = ("0BSD", "MIT-0", "BSD-4-Clause", "GPL-2.0-or-later", "GPL-3.0-or-later", "LGPL-2.1-or-later", "LGPL-3.0-or-later", "AGPL-3.0-or-later", "Unlicense", "Zlib", "WTFPL")
#: How a notice may begin; "the" and "a" before a name are tried too.
NOTICES = ("Licensed under", "Released under", "Distributed under", "This work is licensed under", "This project is licensed under", "This software is released under")
# Rules in order, licence and sequence of identifiers.
ORDERED = [
    ("BSD-4-Clause", ("BSD0", "BSD1", "BSD2", "BSD4")),
    ("BSD-3-Clause", ("BSD0", "BSD1", "BSD2", "BSD3")),
    ("MIT", ("MIT1", "MIT2", "MIT3", "MIT4")),
    ("MIT", ("MIT1", "MIT2", "MIT3")),
    ("BSD-2-Clause", ("BSD0", "BSD1", "BSD2", "BSDD")),
    ("BSD-2-Clause", ("BSD0", "BSD1", "BSD2")),
    ("Apache-2.0", ("APA1", "APA2", "APA3")),
    ("MIT-0", ("MIT0", "MIT3", "MIT4")),
    ("MIT", ("MIT1", "MIT2")),
    ("Apache-2.0", ("APA1", "APA2")),
    ("ISC", ("ISC1", "ISC3")),
    ("ISC", ("ISC2", "ISC3")),
    ("0BSD", ("ZBSD", "ISC3")),
    ("MPL-2.0", ("MPL1", "MPL2")),
    ("MPL-2.0", ("MPL1", "MPL3")),
    ("WTFPL", ("WTF1", "WTF2")),
    ("GPL-3.0-or-later", ("GPL1",)),
    ("GPL-2.0-or-later", ("GPL2",)),
    ("GPL-2.0-only", ("GPL3",)),
    ("GPL-3.0-only", ("GPL4",)),
    ("LGPL-2.1-or-later", ("LGP1",)),
    ("LGPL-3.0-or-later", ("LGP2",)),
    ("AGPL-3.0-or-later", ("AGP1",)),
    ("ISC", ("ISC1",)),
    ("ISC", ("ISC2",)),
    ("0BSD", ("ZBSD",)),
    ("MIT", ("MIT1",)),
    ("MIT-0", ("MIT0",)),
    ("Apache-2.0", ("APA1",)),
    ("MPL-2.0", ("MPL1",)),
    ("EPL-2.0", ("EPL1",)),
    ("EPL-2.0", ("EPL2",)),
    ("Unlicense", ("UNL1",)),
    ("Zlib", ("ZLI2",)),
    ("BSL-1.0", ("BSL1",)),
    ("BSL-1.0", ("BSL2",)),
    ("WTFPL", ("WTF2",)),
    ("CC0-1.0", ("CC01",)),
]
# How the identifiers of licences begin under which commercial or closed use isn't free.
RESTRICTED = ("GPL-", "AGPL-", "CC-BY-NC")
#: Every known sentence has one of these; a text without any needs no further look.
KEYWORDS = "licen[cs]e|copyright|permission|warrant|redistribut|unencumbered|permitted|advertising|obtain|released|distributed|fuck"
GAP = "~"


def plain(sentence: str) -> str:
    """An ASCII sentence as it is compared."""
    return " ".join("".join(c if c.isalnum() else " " for c in sentence.lower()).split())


ARTICLES = ("", "the", "a")
LINE = "SPDX-License-Identifier:"


def _table() -> tuple[dict[str, str], list[tuple[str, tuple[str, ...]]]]:
    """Identifiers by normalised sentence, and all rules: the texts', then those of one-line notices, made from names."""
    ids = {plain(x): k for k, x in TEXTS.items()}
    for who in HOLDERS:
        ids[plain(TEXTS["BSD3"].replace("the copyright holder", who))] = "BSD3"
    rules = list(ORDERED)
    for k, name in enumerate([*NAMES, *MORE]):
        known = [f"{LINE} {name}", *[f"{notice} {article} {x}" for x in NAMES.get(name, ()) for notice in NOTICES for article in ARTICLES]]
        for x in known:
            ids.setdefault(plain(x), f"N{k:03d}")
        rules.append((name, (f"N{k:03d}",)))
    return ids, rules


SENTENCES, RULES = _table()
#: A segment's bounds, and where a segment ends; both in Java's and RE2's syntax.
BOUND = "|"
ENDS = r"\n|[.;:!?]+(?:[ \t\r\x0B\f\n]+|$)"
#: A list number or letter at the begin of a line, behind comment marks: "1.", "(a)", "b)".
NUMBERED = r"(^|\n)([^\p{L}\p{Nd}\n]*)(?:[0-9]{1,2}|[a-zA-Z])[.)][ \t]+"


def sentence_pattern() -> str:
    """One known sentence between bounds, longest first, else one segment. Spaces may be bounds: the sentence is wrapped there."""
    some = lambda xs: "(?:" + "|".join(sorted(map(plain, xs), key=lambda x: (-len(x), x))) + ")"
    notices = f"{some(NOTICES)} (?:{'|'.join(f'{a} ' for a in ARTICLES if a)}){{0,1}}{some(x for n in NAMES.values() for x in n)}"
    line = f"{plain(LINE)} {some([*NAMES, *MORE])}"
    texts = some([*TEXTS.values(), *[TEXTS["BSD3"].replace("the copyright holder", who) for who in HOLDERS]])
    known = "|".join((texts, notices, line)).replace(" ", r"(?: |\|\|)")
    return rf"(\|(?:{known})\||\|[^|]*\|)"


def rule_pattern() -> str:
    return "|".join("".join(f"{s};" for s in ids) for _, ids in RULES)


def segments(text: Column) -> Column:
    """|segment||segment|...: normalised words between bounds."""
    x = F.regexp_replace(F.replace(text, F.lit(BOUND), F.lit(" ")), NUMBERED, "$1$2")
    x = F.regexp_replace(F.regexp_replace(x, ENDS, BOUND), r"[^\p{L}\p{Nd}|]+", " ")
    x = F.regexp_replace(F.lower(x), r" ?(?:\| ?)+", BOUND)
    x = F.regexp_replace(F.trim(x), r"^\||\|$", "")
    return F.concat(F.lit(BOUND), F.replace(x, F.lit(BOUND), F.lit(BOUND * 2)), F.lit(BOUND))


def scan(docs: DataFrame, text: str = "text", ids: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """ids, n_license_sentences, sequence (identifiers; ~ for a gap), licenses (in order of matching), restricted."""
    t = F.coalesce(F.col(text), F.lit(""))
    known = F.create_map(*[F.lit(x) for k, v in SENTENCES.items() for x in (k, v + ";")])
    names = F.create_map(*[F.lit(x) for lic, seq in reversed(RULES) for x in ("".join(f"{s};" for s in seq), lic)])
    # only what matched a known sentence, or has a keyword as they do, is looked up
    found = F.transform(F.regexp_extract_all(segments(t), F.lit(sentence_pattern()), F.lit(1)), lambda s: F.when(s.rlike(KEYWORDS), F.coalesce(F.try_element_at(known, F.trim(F.regexp_replace(s, r"\|+", " "))), F.lit(GAP))).otherwise(F.lit(GAP)))
    rows = docs.select(*ids, F.when(F.lower(t).rlike(KEYWORDS), F.regexp_replace(F.concat_ws("", found), GAP + "+", GAP)).otherwise(F.lit(GAP)).alias("sequence"))
    rows = rows.select(*ids, "sequence", F.transform(F.regexp_extract_all("sequence", F.lit(f"({rule_pattern()})"), F.lit(1)), lambda s: names[s]).alias("licenses"))
    restricted = F.exists("licenses", lambda x: x.rlike("^(?:" + "|".join(RESTRICTED) + ")"))
    return rows.select(*ids, F.regexp_count("sequence", F.lit(";")).cast("long").alias("n_license_sentences"), "sequence", "licenses", restricted.alias("restricted"))


def oracle(table: str = "documents") -> str:
    """The same in DuckDB's SQL, licenses joined by commas."""
    known = ", ".join(f"('{k}', '{v};')" for k, v in SENTENCES.items())
    names = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in {"".join(f"{s};" for s in seq): lic for lic, seq in reversed(RULES)}.items()) + "}"
    ends, numbered, sentence = (x.replace("'", "''") for x in (ENDS, NUMBERED, sentence_pattern()))
    return f"""
        WITH known(s, id) AS (VALUES {known}),
        cut AS (SELECT doc_id, lower(regexp_replace(regexp_replace(regexp_replace(replace(coalesce(text, ''), '|', ' '), '{numbered}', '\\1\\2', 'g'), '{ends}', '|', 'g'), '[^\\p{{L}}\\p{{Nd}}|]+', ' ', 'g')) AS x FROM {table}),
        bounds AS (SELECT doc_id, '|' || replace(regexp_replace(trim(regexp_replace(x, ' ?(?:\\| ?)+', '|', 'g')), '^\\||\\|$', '', 'g'), '|', '||') || '|' AS x FROM cut),
        lists AS (SELECT doc_id, regexp_extract_all(x, '{sentence}', 1) AS l FROM bounds),
        parts AS (SELECT doc_id, unnest(l) AS s, generate_subscripts(l, 1) AS i FROM lists),
        marked AS (SELECT doc_id, string_agg(coalesce(id, '~'), '' ORDER BY i) AS seq FROM parts LEFT JOIN known ON known.s = trim(regexp_replace(parts.s, '\\|+', ' ', 'g')) GROUP BY doc_id),
        ids AS (SELECT doc_id, regexp_replace(seq, '~+', '~', 'g') AS sequence FROM marked),
        named AS (SELECT doc_id, sequence, list_transform(regexp_extract_all(sequence, '({rule_pattern()})', 1), lambda x: ({names})[x]) AS l FROM ids)
        SELECT doc_id, CAST(len(sequence) - len(replace(sequence, ';', '')) AS BIGINT) AS n_license_sentences, sequence, array_to_string(l, ',') AS licenses, len(list_filter(l, lambda x: regexp_matches(x, '^(?:{"|".join(RESTRICTED)})'))) > 0 AS restricted FROM named"""
