"""Licence recognition by sentences.

A text is cut into sentences, each normalised to lower-case ASCII words and digits. Known
licence sentences become identifiers; the sequence of identifiers of a text is matched
against ordered licence rules, longer ones first, and what a rule has matched is used up.
Known wordings are cut with the same pattern, so one of them may become several identifiers.
Built-in functions only; every text is handled alone, whole, and without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Identifier and wording of known licence sentences (public licence texts).
WORDINGS = (
    ("APACHE2_REF", "Licensed under the Apache License, Version 2.0"),
    ("APACHE2_LICENSED", 'Licensed under the Apache License, Version 2.0 (the "License")'),
    ("APACHE2_COMPLY", "you may not use this file except in compliance with the License"),
    ("APACHE2_COPY", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("APACHE2_AS_IS", 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied'),
    ("APACHE2_SEE", "See the License for the specific language governing permissions and limitations under the License"),
    ("MIT_REF", "Released under the MIT License"),
    ("MIT_REF", "Licensed under the MIT License"),
    ("MIT_GRANT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions'),
    ("MIT_NOTICE", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"),
    ("MIT_AS_IS", 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT'),
    ("BSD_GRANT", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD_SOURCE", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer"),
    ("BSD_BINARY", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution"),
    ("BSD_ENDORSE", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("BSD_REF", "Licensed under the BSD 3-Clause License"),
    ("GPL3_REF", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL3_REF", "Licensed under the GNU General Public License, version 3"),
    ("GPL_MODIFY3", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("MPL2_REF", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("GPL_MODIFY3", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 3 of the License, or (at your option) any later version"),
    ("GPL3_ONLY", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, version 3"),
    ("GPL3_ONLY", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; version 3 of the License"),
    ("GPL2_LATER", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version"),
    ("GPL2_LATER", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 2 of the License, or (at your option) any later version"),
    ("GPL2_ONLY", "you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation"),
    ("GPL2_ONLY", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; version 2 of the License"),
    ("LGPL20_LATER", "you can redistribute it and/or modify it under the terms of the GNU Library General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version"),
    ("LGPL21_LATER", "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version"),
    ("LGPL21_LATER", "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 2.1 of the License, or (at your option) any later version"),
    ("LGPL3_LATER", "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 3 of the License, or (at your option) any later version"),
    ("LGPL3_LATER", "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("AGPL3_LATER", "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("AGPL3_LATER", "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation; either version 3 of the License, or (at your option) any later version"),
    ("GPL2_REF", "Licensed under the GNU General Public License, version 2"),
    ("GPL2_REF", "This work is licensed under the GNU General Public License, version 2"),
    ("ISC_GRANT", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("ISC_GRANT", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("BSD0_GRANT", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("ISC_REF", "Licensed under the ISC License"),
    ("BSD2_REF", "Licensed under the BSD 2-Clause License"),
    ("EPL2_REF", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0"),
    ("EPL2_REF", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at http://www.eclipse.org/legal/epl-2.0"),
    ("EPL2_REF", "This program and the accompanying materials are made available under the terms of the Eclipse Public License v2.0 which accompanies this distribution, and is available at https://www.eclipse.org/legal/epl-2.0"),
    ("EPL2_TITLE", "Eclipse Public License - v 2.0"),
    ("EPL1_REF", "All rights reserved. This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html"),
    ("EPL1_TITLE", "Eclipse Public License - v 1.0"),
    ("CC0_TITLE", "CC0 1.0 Universal"),
    ("CC0_DEED", "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide. This software is distributed without any warranty"),
    ("UNLICENSE", "This is free and unencumbered software released into the public domain"),
    ("MPL2_TITLE", "Mozilla Public License Version 2.0"),
    *[
        (f"{name}_REF", wording)
        for name, short, kind in (
            ("CC_BY", "CC BY", "Attribution"),
            ("CC_BY_SA", "CC BY-SA", "Attribution-ShareAlike"),
            ("CC_BY_NC", "CC BY-NC", "Attribution-NonCommercial"),
            ("CC_BY_ND", "CC BY-ND", "Attribution-NoDerivatives"),
            ("CC_BY_NC_SA", "CC BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
            ("CC_BY_NC_ND", "CC BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
        )
        for wording in (
            f"Licensed under {short} 4.0",
            f"This work is licensed under {short} 4.0",
            f"This work is licensed under a Creative Commons {kind} 4.0 International License",
            f"This work is licensed under the Creative Commons {kind} 4.0 International License",
            f"Licensed under a Creative Commons {kind} 4.0 International License",
            f"Licensed under the Creative Commons {kind} 4.0 International License",
            f"This work is licensed under Creative Commons {kind} 4.0 International",
        )
    ],
    ("SPDX", "SPDX-License-Identifier"),
    ("ZLIB_GRANT", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions"),
    ("BOOST_REF", "Distributed under the Boost Software License, Version 1.0"),
    ("BOOST_GRANT", 'Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following'),
    ("MPL11_REF", "The contents of this file are subject to the Mozilla Public License Version 1.1"),
    ("MPL11_REF", 'The contents of this file are subject to the Mozilla Public License Version 1.1 (the "License")'),
    ("APACHE2_TITLE", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("APACHE2_TITLE", "Apache License Version 2.0, January 2004"),
    ("GPL3_TITLE", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("GPL2_TITLE", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("LGPL21_TITLE", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL3_TITLE", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("AGPL3_TITLE", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("BOOST_TITLE", "Boost Software License - Version 1.0 - August 17th, 2003"),
)

#: Licence, and names that people write for it in a notice.
NOTICE_NAMES = (
    ("Apache-2.0", ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache 2.0", "Apache-2.0")),
    ("MIT", ("MIT License", "MIT")),
    ("BSD-3-Clause", ("BSD 3-Clause License", "3-Clause BSD License", "BSD-3-Clause")),
    ("BSD-2-Clause", ("BSD 2-Clause License", "2-Clause BSD License", "BSD-2-Clause")),
    ("ISC", ("ISC License", "ISC")),
    ("Zlib", ("zlib License", "Zlib")),
    ("BSL-1.0", ("Boost Software License, Version 1.0", "Boost Software License 1.0", "BSL-1.0")),
    ("MPL-2.0", ("Mozilla Public License 2.0", "Mozilla Public License, Version 2.0", "MPL 2.0", "MPL-2.0")),
    ("GPL-3.0-only", ("GNU General Public License v3.0", "GNU GPL v3", "GPLv3", "GPL-3.0")),
    ("GPL-2.0-only", ("GNU General Public License v2.0", "GNU GPL v2", "GPLv2", "GPL-2.0")),
    ("LGPL-3.0-only", ("GNU Lesser General Public License v3.0", "LGPLv3", "LGPL-3.0")),
    ("AGPL-3.0-only", ("GNU Affero General Public License v3.0", "AGPLv3", "AGPL-3.0")),
    ("EPL-2.0", ("Eclipse Public License 2.0", "EPL-2.0")),
    ("CC0-1.0", ("CC0 1.0 Universal", "CC0", "CC0-1.0")),
    ("Unlicense", ("Unlicense",)),
)
#: What stands before the name, with or without an article.
NOTICE_FORMS = ("Licensed under", "Released under", "Distributed under")
TAG_FORMS = ("License: {}",)


def notices() -> list[tuple[str, str]]:
    """Identifier and wording of every notice: forms times names."""
    out = []
    for licence, names in NOTICE_NAMES:
        for name in names:
            # One identifier per verb, so that its word tells which texts to read.
            out += [
                (f"{form.split()[0].upper()}_{licence}", f"{form} {article}{name}")
                for form in NOTICE_FORMS
                for article in ("the ", "")
            ]
            out += [(f"TAG_{licence}", form.format(name)) for form in TAG_FORMS]
    return out

#: SPDX identifier and the older ones that mean the same.
SPDX_IDS = (
    ("Apache-2.0",), ("MIT",), ("GPL-3.0-only", "GPL-3.0"), ("BSD-3-Clause",), ("BSD-2-Clause",),
    ("GPL-3.0-or-later",), ("GPL-2.0-only", "GPL-2.0"), ("GPL-2.0-or-later",),
    ("LGPL-2.0-only", "LGPL-2.0"), ("LGPL-2.0-or-later",), ("LGPL-2.1-only", "LGPL-2.1"),
    ("LGPL-2.1-or-later",), ("LGPL-3.0-only", "LGPL-3.0"), ("LGPL-3.0-or-later",),
    ("AGPL-3.0-only", "AGPL-3.0"), ("AGPL-3.0-or-later",), ("MPL-2.0",), ("MPL-1.1",), ("ISC",),
    ("EPL-1.0",), ("EPL-2.0",), ("CC0-1.0",), ("Unlicense",), ("0BSD",), ("Zlib",), ("BSL-1.0",),
    ("MIT-0",), ("CC-BY-4.0",), ("CC-BY-SA-4.0",), ("CC-BY-NC-4.0",), ("CC-BY-ND-4.0",),
    ("CC-BY-NC-SA-4.0",), ("CC-BY-NC-ND-4.0",),
)

#: Licence and the wordings that stand for it, in the order of trial.
LICENCE_RULES = (
    ("Apache-2.0", ("APACHE2_LICENSED", "APACHE2_COMPLY", "APACHE2_COPY", "APACHE2_AS_IS", "APACHE2_SEE")),
    ("Apache-2.0", ("APACHE2_LICENSED", "APACHE2_COMPLY")),
    ("MIT", ("MIT_GRANT", "MIT_NOTICE", "MIT_AS_IS")),
    ("BSD-3-Clause", ("BSD_GRANT", "BSD_SOURCE", "BSD_BINARY", "BSD_ENDORSE")),
    ("BSD-2-Clause", ("BSD_GRANT", "BSD_SOURCE", "BSD_BINARY")),
    ("GPL-3.0-or-later", ("GPL_MODIFY3",)),
    *[(names[0], ("SPDX", f"ID_{names[0]}")) for names in SPDX_IDS],
    ("Apache-2.0", ("APACHE2_REF",)),
    ("MIT", ("MIT_REF",)),
    ("BSD-3-Clause", ("BSD_REF",)),
    ("GPL-3.0-only", ("GPL3_REF",)),
    ("MPL-2.0", ("MPL2_REF",)),
    ("CC-BY-4.0", ("CC_BY_REF",)),
    ("CC-BY-SA-4.0", ("CC_BY_SA_REF",)),
    ("CC-BY-NC-4.0", ("CC_BY_NC_REF",)),
    ("CC-BY-ND-4.0", ("CC_BY_ND_REF",)),
    ("CC-BY-NC-SA-4.0", ("CC_BY_NC_SA_REF",)),
    ("CC-BY-NC-ND-4.0", ("CC_BY_NC_ND_REF",)),
    ("GPL-3.0-only", ("GPL3_ONLY",)),
    ("GPL-2.0-or-later", ("GPL2_LATER",)),
    ("GPL-2.0-only", ("GPL2_ONLY",)),
    ("GPL-2.0-only", ("GPL2_REF",)),
    ("LGPL-2.0-or-later", ("LGPL20_LATER",)),
    ("LGPL-2.1-or-later", ("LGPL21_LATER",)),
    ("LGPL-3.0-or-later", ("LGPL3_LATER",)),
    ("AGPL-3.0-or-later", ("AGPL3_LATER",)),
    ("MPL-2.0", ("MPL2_TITLE",)),
    ("ISC", ("ISC_GRANT",)),
    ("ISC", ("ISC_REF",)),
    ("0BSD", ("BSD0_GRANT",)),
    ("BSD-2-Clause", ("BSD2_REF",)),
    ("EPL-2.0", ("EPL2_REF",)),
    ("EPL-2.0", ("EPL2_TITLE",)),
    ("EPL-1.0", ("EPL1_REF",)),
    ("EPL-1.0", ("EPL1_TITLE",)),
    ("CC0-1.0", ("CC0_TITLE",)),
    ("CC0-1.0", ("CC0_DEED",)),
    ("Unlicense", ("UNLICENSE",)),
    ("Zlib", ("ZLIB_GRANT",)),
    ("BSL-1.0", ("BOOST_REF",)),
    ("BSL-1.0", ("BOOST_GRANT",)),
    ("BSL-1.0", ("BOOST_TITLE",)),
    ("MPL-1.1", ("MPL11_REF",)),
    ("Apache-2.0", ("APACHE2_TITLE",)),
    ("GPL-3.0-only", ("GPL3_TITLE",)),
    ("GPL-2.0-only", ("GPL2_TITLE",)),
    ("LGPL-2.1-only", ("LGPL21_TITLE",)),
    ("LGPL-3.0-only", ("LGPL3_TITLE",)),
    ("AGPL-3.0-only", ("AGPL3_TITLE",)),
    *[(licence, (f"{kind}_{licence}",)) for licence, _ in NOTICE_NAMES for kind in ("LICENSED", "RELEASED", "DISTRIBUTED", "TAG")],
)

#: Ends of sentences where lines are wrapped, and where every line is on its own.
WRAPPED_ENDS = r"[.!?;:][ \t\r\n\f]+|\n[ \t\r]*\n"
LINE_ENDS = r"[.!?;:][ \t\r\n\f]+|\n"
_CUT = "\u0001"


def normal_form(sentence: str) -> str:
    """The normalised form of one sentence, as the expressions below make it."""
    return re.sub(r"[^A-Za-z0-9]+", " ", sentence).lower().strip(" ")


def cut_tables(
    wordings: Sequence[tuple[str, str]], rules: Sequence[tuple[str, Sequence[str]]]
) -> tuple[tuple[tuple[str, str], ...], tuple[tuple[str, tuple[str, ...]], ...]]:
    """Sentences and rules with every wording cut as a text is.

    A wording of several sentences gets an identifier for each, ``NAME_1``, ``NAME_2`` ...,
    and a rule that names it asks for them one after another. Equal sentences share the
    identifier of the first. Tables that are cut already stay as they are.
    """
    known: dict[str, str] = {}
    forms: list[tuple[str, str]] = []
    ways: dict[str, list[tuple[str, ...]]] = {}
    for name, wording in wordings:
        parts = [part for part in re.split(WRAPPED_ENDS, wording) if normal_form(part)]
        ids = []
        for i, part in enumerate(parts, 1):
            form = normal_form(part)
            if form not in known:
                known[form] = name if len(parts) == 1 else f"{name}_{i}"
                forms.append((known[form], part))
            ids.append(known[form])
        if tuple(ids) not in ways.setdefault(name, []):
            ways[name].append(tuple(ids))
    full = [
        (licence, tuple(name for way in choice for name in way))
        for licence, sequence in rules
        for choice in product(*[sorted(ways.get(x, [(x,)]), key=len)[::-1] for x in sequence])
    ]
    return tuple(forms), tuple(dict.fromkeys(full))


SENTENCES, RULES = cut_tables(
    [*WORDINGS, *[(f"ID_{names[0]}", x) for names in SPDX_IDS for x in names], *notices()],
    LICENCE_RULES,
)

#: The holder in the endorsement clause varies, and may hold the end of a sentence (Inc.).
HOLDER = (
    r"(?is)\bneither[^a-z0-9]+the[^a-z0-9]+names?[^a-z0-9]+of\b.{1,300}?\bnor[^a-z0-9]+the"
    r"[^a-z0-9]+names?[^a-z0-9]+of[^a-z0-9]+(?:its|their|any|the)\b(?=[^a-z0-9]+contributors)"
)
#: A notice that names what it is about, which is left out.
ABOUT = (
    r"(?i)\bthis[ \t\r\n]+(?:file|software|code|project|program|package|library|module|repository|source)"
    r"[ \t\r\n]+is[ \t\r\n]+(licensed|released|distributed)[ \t\r\n]+under\b"
)
#: An operator in an SPDX expression, after its tag or after the operator before it.
OPERATOR = (
    r"(SPDX-License-Identifier:[ \t]*|\G(?!\A))([^\n]*?)[ \t)]+(?:OR|AND|WITH|or|and|with)[ \t(]+"
)
#: An older way to write "or later", whose sign the normal form would drop.
PLUS = r"\b(A?L?GPL-[0-9.]+)\+"


def settle(text: Column) -> Column:
    """The text with one fixed holder name, ``-or-later`` for the sign ``+``, notices without
    what they are about, and one tag per part of an SPDX expression, whatever joins the parts.
    """
    held = F.regexp_replace(
        text, HOLDER, "neither the name of the copyright holder nor the names of its"
    )
    held = F.regexp_replace(held, ABOUT, "$1 under")
    parts = F.regexp_replace(held, OPERATOR, "$1$2. SPDX-License-Identifier: ")
    return F.regexp_replace(parts, PLUS, "$1-or-later")


def sentence_ids(text: Column, ends: str, sentences: Sequence[tuple[str, str]]) -> Column:
    """Identifiers of the known sentences of a text, in order."""
    # By first word, because a map is searched entry by entry.
    known: dict[str, dict[str, str]] = {}
    for name, wording in sentences:
        form = normal_form(wording)
        known.setdefault(form.split(" ")[0], {})[form] = name

    def literal(entries) -> Column:
        return F.create_map(*[F.lit(x) if isinstance(x, str) else x for pair in entries for x in pair])

    lookup = literal([(first, literal(forms.items())) for first, forms in known.items()])
    cut = F.regexp_replace(text, ends, _CUT)
    # Only ASCII is left when capitals are lowered.
    normal = F.lower(F.regexp_replace(cut, f"[^A-Za-z0-9{_CUT}]+", " "))
    said = F.transform(F.split(normal, _CUT, -1), lambda s: F.trim(s))
    found = F.transform(
        said, lambda s: F.try_element_at(F.try_element_at(lookup, F.substring_index(s, " ", 1)), s)
    )
    return F.filter(found, lambda name: name.isNotNull())


def match_rules(ids: Column, rules: Sequence[tuple[str, Sequence[str]]]) -> Column:
    """The licences of the rules that match an identifier sequence, in rule order."""
    steps = F.array(
        *[
            F.struct(
                F.lit(name).alias("name"), F.lit(f"|{'|'.join(sequence)}|").alias("sequence")
            )
            for name, sequence in rules
        ]
    )
    # Every identifier has a bar on either side of its own, so that neighbours share none.
    start = F.struct(
        F.concat(F.lit("|"), F.array_join(ids, "|"), F.lit("|")).alias("rest"),
        F.array().cast("array<string>").alias("found"),
    )

    def step(state: Column, rule: Column) -> Column:
        return F.when(
            F.contains(state["rest"], rule["sequence"]),
            F.struct(
                F.replace(state["rest"], rule["sequence"], F.lit("|.|")).alias("rest"),
                F.array_append(state["found"], rule["name"]).alias("found"),
            ),
        ).otherwise(state)

    none = F.array().cast("array<string>")
    return F.when(F.size(ids) == 0, none).otherwise(
        F.aggregate(steps, start, step, lambda state: state["found"])
    )


def anchors(sentences: Sequence[tuple[str, str]], rules) -> list[str]:
    """Words such that a text in which any rule matches contains one of them.

    A rule needs every identifier of its sequence, so a word that stands in all
    wordings of one of them serves. The word that serves most rules is taken first.
    """
    wordings: dict[str, list[str]] = {}
    for name, wording in sentences:
        wordings.setdefault(name, []).append(normal_form(wording))
    words = {w for forms in wordings.values() for form in forms for w in form.split() if len(w) > 5}
    serves = {
        word: {
            i
            for i, (_, sequence) in enumerate(rules)
            if any(all(word in form for form in wordings.get(name, [""])) for name in sequence)
        }
        for word in words
    }
    chosen, left = [], set(range(len(rules)))
    while left:
        best = max(serves, key=lambda w: (len(serves[w] & left), len(w), w), default="")
        if not best or not serves[best] & left:
            return [""]  # some rule has no such word: every text is read
        chosen.append(best)
        left -= serves[best]
    return chosen


def recognise_licences(
    docs: DataFrame,
    sentences: Sequence[tuple[str, str]] = SENTENCES,
    rules: Sequence[tuple[str, Sequence[str]]] = RULES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``id_col``, ``licences`` and ``sentence_ids`` for every row of ``docs``.

    ``licences`` are the distinct names in rule order, joined by commas; ``sentence_ids``
    the identifiers in text order, joined by bars. Each text is read twice, with line ends
    as blanks (wrapped licence texts) and as sentence ends (one-line notices); a rule
    counts if either reading matches it, and the identifiers of the reading with more of
    them, the first on a tie, are shown as evidence. A null, empty or unlicensed text gives
    empty strings. Repeated rows and null ids give a row each; other columns are not read.

    A text without any of the words that the rules need (:func:`anchors`) is not cut up.
    """
    sentences, rules = cut_tables(sentences, rules)
    lowered = F.lower(F.col(text_col))
    possible = F.lit(False)
    for word in anchors(sentences, rules):
        possible = possible | F.contains(lowered, F.lit(word))
    text = F.when(possible, settle(F.col(text_col))).otherwise("")
    read = docs.select(
        F.col(id_col),
        sentence_ids(text, WRAPPED_ENDS, sentences).alias("__wrapped"),
        sentence_ids(text, LINE_ENDS, sentences).alias("__lines"),
    )
    wrapped, lines = F.col("__wrapped"), F.col("__lines")
    order = list(dict.fromkeys(name for name, _ in rules))
    both = F.array_union(match_rules(wrapped, rules), match_rules(lines, rules))
    return read.select(
        id_col,
        F.array_join(
            F.filter(F.array(*[F.lit(x) for x in order]), lambda x: F.array_contains(both, x)), ","
        ).alias("licences"),
        F.when(F.size(both) == 0, "")
        .otherwise(
            F.array_join(F.when(F.size(lines) > F.size(wrapped), lines).otherwise(wrapped), "|")
        )
        .alias("sentence_ids"),
    )
