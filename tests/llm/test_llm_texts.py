"""Repetition rules, licences, language and quality on single texts and small tables."""

import random
import textwrap
import zlib
from collections import Counter

import numpy as np
import pytest
from helpers import SF, docs_of, rows_of, with_clashes
from pyspark.sql import functions as F

from cohortine.llm import langid, ranking
from cohortine.llm.base import read
from cohortine.llm.licences import (
    LICENCE_RULES,
    LINE_ENDS,
    RULES,
    SENTENCES,
    SPDX_IDS,
    WORDINGS,
    anchors,
    normal_form,
    notices,
    recognise_licences,
)
from cohortine.llm.repetition import FIELDS, RepetitionRules, measure, repetition_quality

NAMES = [name for name, _ in FIELDS]


def brute_repetition(text: bytes) -> dict:
    words = text.split()
    n = len(words)
    size = [len(w.decode()) for w in words]
    chars = sum(size)
    covered, top = {}, 0.0
    passed = True
    rules = RepetitionRules()
    for k in range(2, 11):
        windows = [tuple(words[i : i + k]) for i in range(n - k + 1)]
        counts = Counter(windows)
        inside = {i + j for i, w in enumerate(windows) if counts[w] > 1 for j in range(k)}
        covered[k] = inside
        if k in dict(rules.top) and windows:
            share = max((c * sum(len(w.decode()) for w in g) for g, c in counts.items() if c > 1), default=0) / chars
            top = max(top, share)
            passed &= share <= dict(rules.top)[k]
        if k in dict(rules.duplicated):
            passed &= sum(size[i] for i in inside) / max(chars, 1) <= dict(rules.duplicated)[k]
    lines = [x for x in text.split(b"\n") if x.split()]
    dup = [x for i, x in enumerate(lines) if x in lines[:i]]
    passed &= len(dup) / max(len(lines), 1) <= 0.3
    length = [len(x.decode()) for x in lines]
    passed &= sum(len(x.decode()) for x in dup) / max(sum(length), 1) <= 0.2
    failed = n < 10 or 100 * len(covered[5]) > 20 * n
    return {
        "n_words": n, "word_chars": chars, "n_symbols": sum(text.count(c.encode()) for c in "#*$%&|<>"),
        "n_dup_lines": len(dup), "n_repeat_words": len(covered[5]), "base_failed": failed,
        "kept": bool(passed and not failed), "top_ngram_share": top,
    }


def test_repetition_equals_brute_force():
    rng = random.Random(3)
    for _ in range(300):
        vocabulary = ["a", "bé", "c|c", "dd", "ée", "#x"][: rng.randint(2, 6)] + [
            f"w{i}" for i in range(rng.randint(0, 60))
        ]
        words = [rng.choice(vocabulary) for _ in range(rng.randint(0, 80))]
        text = "".join(w + rng.choice([" ", " ", "\n", "\t", "  ", "\r"]) for w in words).encode()
        got = dict(zip(NAMES, measure(text, RepetitionRules())))
        for name, value in brute_repetition(text).items():
            assert got[name] == pytest.approx(value), (name, text)


def test_repetition_defined_cases(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, "one two"), (None, "x " * 50), (5, long), (5, long)]
    got = {
        (r.doc_id, r.n_words): (r.base_failed, r.kept)
        for r in repetition_quality(with_clashes(docs_of(spark, rows))).collect()
    }
    assert got == {
        (1, 0): (True, False), (2, 0): (True, False), (3, 2): (True, False),
        (None, 50): (True, False), (5, 30_000): (False, True),
    }
    assert repetition_quality(docs_of(spark, rows)).count() == 6
    assert repetition_quality(docs_of(spark, [])).count() == 0


MIT = """Copyright 2020 Someone

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT
"""


def test_licences(spark):
    bsd = {name: wording for name, wording in SENTENCES}
    three = "; ".join(bsd[k] for k in ("BSD_GRANT", "BSD_SOURCE", "BSD_BINARY", "BSD_ENDORSE")) + "."
    two = ". ".join(bsd[k] for k in ("BSD_GRANT", "BSD_SOURCE", "BSD_BINARY")) + ".\nEnd"
    rows = [
        (1, None), (2, ""), (3, MIT), (4, three), (5, two),
        (6, "no stop |\nLicensed under CC BY-NC 4.0.\nReleased under the MIT License.\nx"),
        (7, "// SPDX-License-Identifier: Apache-2.0\ncode"),
        (8, "Licensed under the Apache Licence, Version 2.0."), (None, "Released under the MIT License."),
        (6, "we are licensed under the MIT license"),
    ]
    got = rows_of(recognise_licences(with_clashes(docs_of(spark, rows))), "doc_id", "licences")
    assert got == sorted(
        [
            (1, ""), (2, ""), (3, "MIT"), (4, "BSD-3-Clause"), (5, "BSD-2-Clause"),
            (6, "MIT,CC-BY-NC-4.0"), (6, ""), (7, "Apache-2.0"), (8, ""), (None, "MIT"),
        ],
        key=repr,
    )
    assert recognise_licences(docs_of(spark, [])).count() == 0
    assert anchors(SENTENCES, RULES)[0] == "license"
    lone = [("A", "one two"), ("A", "three"), ("B", "four phrases here now")]
    assert anchors(lone, [("x", ("A",)), ("y", ("A", "B"))]) == [""]
    assert anchors(lone, [("y", ("A", "B"))]) == ["phrases"]
    assert normal_form(" (The \"X-2.0\")") == "the x 2 0" and LINE_ENDS


NOTICES = {
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "GPL-2.0-or-later": """This program is free software; you can redistribute it and/or
modify it under the terms of the GNU General Public License
as published by the Free Software Foundation; either version 2
of the License, or (at your option) any later version.""",
    "GPL-3.0-or-later": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.""",
    "LGPL-2.1-or-later": """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.""",
    "AGPL-3.0-or-later": """# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU Affero General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.""",
    "EPL-2.0": """This program and the accompanying materials are made
available under the terms of the Eclipse Public License 2.0
which is available at https://www.eclipse.org/legal/epl-2.0/""",
    "CC0-1.0": "Creative Commons Legal Code\n\nCC0 1.0 Universal\n\n    CREATIVE COMMONS",
    "Unlicense": "This is free and unencumbered software released into the public domain.\n\nAnyone",
    "CC-BY-4.0": """This work is licensed under a Creative Commons Attribution 4.0
International License.""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of Some Maker, Inc. nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.""",
}


def test_licence_notices_and_all_table_entries(spark):
    rows = [(name, notice) for name, notice in NOTICES.items()]
    rows += [(names[0], f"// SPDX-License-Identifier: {x}\ncode") for names in SPDX_IDS for x in names]
    rows.append(("LGPL-2.1-or-later", "/* SPDX-License-Identifier: LGPL-2.1+ */\ncode"))
    wordings: dict[str, list[str]] = {}
    for name, wording in [*WORDINGS, *notices()]:
        wordings.setdefault(name, []).append(wording)
    for licence, sequence in LICENCE_RULES:
        if sequence[0] != "SPDX":
            for k in range(max(len(wordings[name]) for name in sequence)):
                parts = [wordings[name][min(k, len(wordings[name]) - 1)] for name in sequence]
                rows.append((licence, "\n\n".join(textwrap.fill(part + ".", 72) for part in parts)))
    used = {name for _, sequence in LICENCE_RULES for name in sequence}
    assert used == {*wordings, *(f"ID_{names[0]}" for names in SPDX_IDS)}
    docs = docs_of(spark, [(i, text) for i, (_, text) in enumerate(rows)])
    got = {r.doc_id: r.licences for r in recognise_licences(docs).collect()}
    assert [got[i] for i in range(len(rows))] == [name for name, _ in rows]


def test_grams_by_hand():
    def key(*chars):
        out = 0
        for c in chars:
            out = out << 21 | (1 if c == "_" else ord(c))
        return out

    want = [key(*g) for g in ("a", "b", "c", "_a", "ab", "b_", "_c", "c_", "_ab", "ab_", "_c_")]
    assert sorted(langid.grams(b"Ab, 12 C!").tolist()) == sorted(want)
    assert not len(langid.grams(b"12 . !")) and not len(langid.grams(b""))


def test_language_held_out_accuracy_and_cases(spark):
    docs = read(spark, "/root/testdata/sf0.01", "documents")
    model = langid.learn_languages(docs)
    scored = langid.predict_language(docs, model).join(docs.select("doc_id", "lang"), "doc_id")
    right = scored.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")))
    assert right.first()[0] > 0.98
    # The counts behind the profiles are those of all training rows.
    rows = docs.where(~langid.held_out("doc_id", 3, 1)).where("lang = 'es'").collect()
    counts = Counter(g for r in rows for g in langid.grams(r.text.encode()).tolist())
    best = sorted(counts, key=lambda g: (-counts[g], g))[:400]
    assert model.profiles["es"].tolist() == best

    small = docs_of(spark, [(1, None), (2, ""), (3, "1 2 3"), (None, "the of and"), (5, "x"), (5, "x")])
    got = langid.predict_language(with_clashes(small), model).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    assert {r.doc_id for r in got if r.lang_pred == "und"} == {1, 2, 3}
    assert langid.predict_language(docs_of(spark, []), model).count() == 0
    none = langid.learn_languages(docs_of(spark, []))
    assert none.predict(b"text") == ("und", 0.0)
    tie = langid.LanguageModel({"b": np.array([97]), "a": np.array([97])})
    assert tie.predict(b"a")[0] == "a"
    clash = with_clashes(docs_of(spark, [(1, None), (7, rows[0].text)]))
    kept = langid.filter_language(clash, model, min_score=0.2)
    assert kept.columns == clash.columns and [r.doc_id for r in kept.collect()] == [7]


def test_pair_weights_are_optimal():
    rng = np.random.default_rng(0)
    d = rng.normal(size=(400, 3)) + [1.0, 0.2, 0.0]
    w = ranking.fit_pairs(d, l2=0.1)
    p = 1 / (1 + np.exp(d @ w))
    assert np.abs(-(d.T @ p) / len(d) + 0.1 * w).max() < 1e-4


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = read(spark, sf, "documents"), read(spark, sf, "labels")
    model = ranking.learn_quality(docs, labels)
    scored = ranking.score_quality(docs, model).join(labels, "doc_id").where("held_out").toPandas()
    good, bad = scored[scored.quality == 1].score, scored[scored.quality == 0].score
    auc = np.mean([[g > b for b in bad] for g in good])
    assert auc > 0.97
    assert (scored.predicted == scored.quality).mean() > 0.9
    assert (scored.predicted == (scored.score >= 0.3)).all()


def test_quality_defined_cases(spark):
    labels = spark.createDataFrame(
        [(1, 1), (2, 0), (2, 0), (3, None), (None, 1), (4, 1), (4, 0), (6, 1), (7, 0)],
        "doc_id bigint, quality int",
    )
    rows = [(i, "good words here" if i % 2 else "## $$ ##") for i in range(1, 9)]
    docs = docs_of(spark, rows + [(None, None), (9, ""), (9, "")])
    model = ranking.learn_quality(docs, labels)
    got = ranking.score_quality(with_clashes(docs), model).collect()
    assert len(got) == 11 and all(0 <= r.score <= 1 for r in got)
    empty = ranking.learn_quality(docs, labels.limit(0))
    assert {r.predicted for r in ranking.score_quality(docs, empty).collect()} == {1}
    assert ranking.score_quality(docs_of(spark, []), model).count() == 0
    again = ranking.learn_quality(docs, labels)
    assert (again.weights == model.weights).all() and again.cut == model.cut


def test_quality_with_hot_id(spark):
    """Repeated rows of an id crowd out no other labelled id, wherever its hash lies."""
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 5]
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id bigint, quality int")
    plain = [(i, f"good words here {i}" if i % 2 else f"## $$ ## {i}") for i in ids]
    first = ranking.learn_quality(docs_of(spark, plain), labels, max_labelled=len(ids))
    for hot in ids:
        docs = docs_of(spark, plain + [r for r in plain if r[0] == hot] * len(ids))
        model = ranking.learn_quality(docs, labels, max_labelled=len(ids))
        assert model.known and np.allclose(model.weights, first.weights)
        if hot > 4:
            break


def test_quality_cut_covers_all_labels(spark):
    """The bound is for the fit; as many labelled rows fall below the cut as have label 0."""
    rng = random.Random(3)
    ids = [i for i in range(600) if zlib.crc32(str(i).encode()) % 5]
    good = {i: int(rng.random() < 0.6) for i in ids}
    texts = {i: "word " * rng.randint(1, 40) + "#$ " * rng.randint(0, 30 - 20 * good[i]) for i in ids}
    labels = spark.createDataFrame(list(good.items()), "doc_id bigint, quality int")
    model = ranking.learn_quality(docs_of(spark, list(texts.items())), labels, max_labelled=30)
    scores = ranking.score_texts(model, [texts[i].encode() for i in ids])
    assert abs((scores < model.threshold).sum() - (len(ids) - sum(good.values()))) <= 2


def test_features_are_finite():
    for text in (b"", b" \n", b"a", b"a b", "é".encode() * 9, b"x" * 10_000, b"a\n" * 500):
        assert np.isfinite(ranking.text_features(text)).all()
        assert len(ranking.text_features(text)) == ranking.N_FEATURES
    assert SF


def slow_scores(texts, labels, max_labelled):
    """(id, held out, score, predicted) of every row, on the driver alone."""
    import zlib

    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    fold = {i: i is not None and zlib.crc32(str(i).encode()) % 5 == 0 for i, _ in texts}
    least = {}
    for i, t in texts:
        features = tuple(ranking.text_features((t or "").encode()))
        least[i] = min(least.get(i, features), features)
    usable = {}
    for i, label in labels:
        if i is not None and label in (0, 1) and i in least and not fold[i]:
            usable[i] = min(label, usable.get(i, 1))
    ids = spark.createDataFrame([(i,) for i in usable], "i bigint").selectExpr("i", "xxhash64(i) AS h")
    sample = ids.orderBy("h", "i").limit(max_labelled).selectExpr("i", "string(i) AS s")
    first = [r.i for r in sample.selectExpr("i", "xxhash64(s) AS h", "s").orderBy("h", "s").collect()]
    model = ranking.fit_model(np.array([least[i] for i in first]), np.array([usable[i] for i in first]))
    raw = [(i, float(model.raw(np.array([ranking.text_features((t or "").encode())]))[0])) for i, t in texts]
    by_id = {i: min(r for j, r in raw if j == i) for i in usable}
    scores, bad = sorted(by_id.values()), sum(1 for label in usable.values() if label == 0)
    k = min(max(bad, 1), len(scores) - 1)
    cut = (scores[k - 1] + scores[k]) / 2
    shift = np.log(0.3 / 0.7)
    out = [(i, fold[i], 1 / (1 + np.exp(-(np.clip(r - cut, -30, 30) + shift)))) for i, r in raw]
    return [(i, held, score, int(score >= 0.3)) for i, held, score in out]


def labelled_texts():
    rng = np.random.default_rng(11)
    words = np.array("alpha beta gamma delta epsilon zeta eta theta iota kappa".split())
    texts, labels = [], []
    for i in range(200):
        good = i % 3 > 0
        text = " ".join(rng.choice(words, int(rng.integers(5, 60)))) + ("." if good else " ### $$$ 1234 |||")
        texts.append((i, text))
        labels.append((i, int(good)))
    texts += [(7, "again and again"), (None, "no id"), (300, None), (301, ""), texts[3], (302, "x " * 50_000)]
    return texts, labels + [(5, 0), (None, 1), (300, 1), (301, 0), (6, None), (8, 2)]


@pytest.mark.parametrize("max_labelled", [50, 20_000])
def test_quality_equals_brute_force(spark, max_labelled):
    texts, labels = labelled_texts()
    # Labels of documents that are elsewhere must not use up the sample.
    elsewhere = [(i, i % 2) for i in range(1000, 21_000)]
    table = spark.createDataFrame(labels + elsewhere, "doc_id bigint, quality int")
    docs = with_clashes(docs_of(spark, texts))
    got = ranking.rank_quality(docs, table, max_labelled).collect()
    want = slow_scores(texts, labels, max_labelled)
    key = lambda r: (str(r[0]), r[2])
    assert len(got) == len(want)
    for a, b in zip(sorted(map(tuple, got), key=key), sorted(want, key=key)):
        assert (a[0], a[1], a[3]) == (b[0], b[1], b[3]) and abs(a[2] - b[2]) < 1e-9
    assert {0, 1} == {r.predicted for r in got}
    kept = ranking.keep_good(docs, table, max_labelled)
    assert kept.columns == docs.columns
    good = sorted((r[0] if r[0] is not None else -1 for r in want if r[3]))
    assert sorted(r.doc_id if r.doc_id is not None else -1 for r in kept.collect()) == good


def test_quality_of_empty_tables(spark):
    labels = spark.createDataFrame([(1, 1)], "doc_id bigint, quality int")
    assert ranking.rank_quality(docs_of(spark, []), labels).count() == 0
    assert ranking.keep_good(docs_of(spark, []), labels).count() == 0
    alone = ranking.rank_quality(docs_of(spark, [(1, "a b")]), labels.limit(0)).collect()
    assert [(r.score, r.predicted) for r in alone] == [(0.5, 1)]


def test_licence_heads_notices_and_expressions(spark):
    rows = [
        ("Apache-2.0", "                                 Apache License\n                           Version 2.0, January 2004\n                        http://www.apache.org/licenses/\n\n   TERMS"),
        ("GPL-3.0-only", "                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n Copyright"),
        ("MIT", "This file is licensed under the MIT license."),
        ("MIT", "/*\n * This file is licensed under\n * the MIT License.\n */"),
        ("MIT", "License: MIT"),
        ("Apache-2.0", "# License: Apache-2.0\n# code"),
        ("GPL-3.0-only", "This program is released under GPLv3.\n"),
        ("BSL-1.0", "// Distributed under the Boost Software License, Version 1.0.\n// (See accompanying file"),
        ("Zlib", "Permission is granted to anyone to use this software for any purpose,\nincluding commercial applications, and to alter it and redistribute it\nfreely, subject to the following restrictions:\n"),
        ("MPL-1.1", "The contents of this file are subject to the Mozilla Public License\nVersion 1.1 (the \"License\"); you may not use"),
        ("Apache-2.0,MIT", "// SPDX-License-Identifier: MIT OR Apache-2.0\ncode"),
        ("Apache-2.0,MIT,ISC", "/* SPDX-License-Identifier: (MIT AND Apache-2.0) OR ISC */"),
        ("GPL-2.0-only", "# SPDX-License-Identifier: GPL-2.0 WITH Classpath-exception-2.0\n"),
        ("GPL-2.0-or-later,MIT", "// SPDX-License-Identifier: GPL-2.0+ OR MIT\n// x OR y"),
        ("", "He wrote that this file is licensed under the MIT license."),
        ("", "MIT OR Apache-2.0"),
        ("", "License: MIT or so they say"),
        ("MIT", "word " * 100_000 + ".\nReleased under the MIT License.\n"),
    ]
    docs = docs_of(spark, [(i, text) for i, (_, text) in enumerate(rows)])
    got = {r.doc_id: set(filter(None, r.licences.split(","))) for r in recognise_licences(docs).collect()}
    for i, (licences, text) in enumerate(rows):
        assert got[i] == set(filter(None, licences.split(","))), text[:80]
