"""Cases that an index, a splitter or a sample must not lose."""

import math
import random
from itertools import combinations

import brute
import numpy as np
import pytest

from rankmill.llm import decontam, licenses, simhash


def leak_tables(spark):
    """Items with short questions and long answers and the other way round; documents hold parts of them."""
    rnd = random.Random(11)

    def some(n):
        return [f"w{min(int(rnd.expovariate(0.02)), 400)}" for _ in range(n)]

    parts = [(some(rnd.choice((1, 3, 4, 5, 8, 20))), some(rnd.choice((0, 1, 3, 5, 12, 37)))) for _ in range(60)]
    items = [(k, " ".join(q) + "\n" + " ".join(a) if a else " ".join(q)) for k, (q, a) in enumerate(parts)]
    docs = []
    for k, (q, a) in enumerate(parts):
        for held in (a, q, [*q, *some(3), *a], a[len(a) // 6 :], [*a[: len(a) // 2], "x", *a[len(a) // 2 :]], q[: -len(q) // 6]):
            docs.append((len(docs), " ".join([*some(rnd.randint(0, 90)), *held, *some(rnd.randint(0, 90))])))
    table = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    return docs, items, table, spark.createDataFrame(items, "item_id bigint, text string")


def test_answers_leak_without_their_questions(spark):
    answer = " ".join(f"a{k}" for k in range(37))
    docs = spark.createDataFrame([(1, f"so {answer} it goes"), (2, "who was it"), (3, "other text")], "doc_id bigint, text string")
    items = spark.createDataFrame([(7, f"who was it that did so and when\n{answer}")], "item_id bigint, text string")
    (row,) = decontam.find_leaks(docs, items).filter("leaked").collect()
    assert (row.doc_id, row.item_id, row.answer_overlap, row.question_overlap) == (1, 7, 1.0, 0.0)
    assert 0 < row.score < decontam.SCORE
    assert sorted(r.doc_id for r in decontam.drop_leaked(docs, items).collect()) == [2, 3]


def test_leaks_of_any_part_equal_brute_force(spark):
    docs, items, table, benchmark = leak_tables(spark)
    rows = decontam.find_leaks(table, benchmark).collect()
    expected = brute.leaks(docs, items)
    assert {(r.doc_id, r.item_id) for r in rows if r.leaked} == expected
    assert len(rows) == len({(r.doc_id, r.item_id) for r in rows})
    assert any(r.leaked and r.score < decontam.SCORE for r in rows)


def test_lost_words_equal_all_choices_of_missing_shingles():
    rnd = random.Random(5)
    for size in (4, 10, 1000) * 40:
        parts = [[f"w{rnd.randrange(size)}" for _ in range(rnd.randint(1, 16))] for _ in range(rnd.choice((1, 2)))]
        weights = {w: rnd.random() + 0.1 for p in parts for w in p}
        places = [(k, i) for k, p in enumerate(parts) for i in range(max(1, len(p) - 4))]
        gram = {(k, i): (k, *parts[k][i : i + 5]) for k, i in places}
        worst = 0.0
        for missing in combinations(sorted(set(gram.values())), len(set(gram.values())) // 5):
            held = {w for k, i in places if gram[k, i] not in missing for w in parts[k][i : i + 5]}
            worst = max(worst, sum(v for w, v in weights.items() if w not in held))
        got = decontam.most_lost(parts, weights)
        assert got >= worst - 1e-12
        if len(weights) == sum(map(len, parts)):
            assert got == pytest.approx(worst)


@pytest.mark.parametrize("step", [1, decontam.STEP])
def test_index_retrieves_every_pair_at_its_threshold(spark, monkeypatch, step):
    """Every (document, item) pair scored plainly: those at a threshold are retrieved, no other, and all leaks are."""
    monkeypatch.setattr(decontam, "STEP", step)
    docs, items, _, _ = leak_tables(spark)
    index = decontam.Index(items)
    numbers = {item.item_id: n for n, item in enumerate(index.items)}
    bodies = [np.array([index.words.get(w, -1) for w in brute.bare(text)], np.int64) for _, text in docs]
    got = index.retrieve_leaks(bodies)

    texts = {i: [brute.bare(p) for p in (t.strip().rpartition("\n")[0] or t, t.strip().rpartition("\n")[2] if "\n" in t else "")] for i, t in items}
    whole = [q + a for q, a in texts.values()]
    df = {w: sum(w in t for t in whole) for t in whole for w in t}
    mean = sum(map(len, whole)) / len(whole)
    expected = set()
    for item, (q, a) in texts.items():
        for parts in [[p for p in (q, a) if p]] + ([[q]] if a and len(q) >= 8 else []):
            words = [w for p in parts for w in p]
            impact = {}
            for w in words:
                idf = math.log(1 + (len(whole) - df[w] + 0.5) / (df[w] + 0.5))
                impact[w] = idf * words.count(w) * 2.2 / (words.count(w) + 1.2 * (0.25 + 0.75 * len(words) / mean))
            least = max(sum(impact.values()) - decontam.most_lost(parts, impact), min(impact.values()))
            for n, (_, text) in enumerate(docs):
                held = set(brute.bare(text))
                if sum(v for w, v in impact.items() if w in held) >= least * (1 - 1e-9):
                    expected.add((n, numbers[item]))
    assert got == expected
    leaked = {(d, numbers[i]) for d, i in brute.leaks(docs, items)}
    assert leaked <= got and len(got) < len(docs) * len(items)


def test_parts_scattered_over_a_long_text_leak(spark):
    """Pieces of one question far apart, thousands of words between them, in one document."""
    question = [f"q{k}" for k in range(40)]
    filler = [f"f{k % 997}" for k in range(6000)]
    pieces = [*question[:18], *filler, *question[14:32], *filler, *question[28:]]
    rows = [(1, " ".join(pieces)), (2, " ".join([*filler, *question[:18]])), (3, ""), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    items = spark.createDataFrame([(7, " ".join(question)), (8, None), (9, "")], "item_id bigint, text string")
    (row,) = decontam.find_leaks(docs, items).filter("leaked").collect()
    assert (row.doc_id, row.item_id, row.question_overlap) == (1, 7, 1.0)


MIT = """MIT License

Copyright (c) 2020 Jane Doe

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
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
BSD_2 = """Copyright (c) 2020, Jane Doe

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD_3 = f"""{BSD_2}
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
DISCLAIMER = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED.
"""
APACHE = """Copyright 2020 Jane Doe

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""
GPL_3 = """Copyright (C) 2020  Jane Doe

This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.

You should have received a copy of the GNU General Public License
along with this program.  If not, see <https://www.gnu.org/licenses/>.
"""
GPL_2 = GPL_3.replace("software:", "software;").replace("Foundation,", "Foundation;").replace("version 3", "version 2")
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.
"""
ISC = """ISC License

Copyright (c) 2020, Jane Doe

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES
"""
UNLICENSE = "This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy.\n"
CREATIVE = "Jane Doe\n\nThis work is licensed under a Creative Commons Attribution{} 4.0 International License.\n"
HOPE = """
{} is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU {} License for more details.
"""
AGPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU Affero General Public License as published
by the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.
"""
LGPL_3 = AGPL.replace("Affero", "Lesser")
LGPL_21 = """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.
"""
GPL_2_ONLY = """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License version 2 as
published by the Free Software Foundation.
"""
GPL_2_CONDITIONS = GPL_2_ONLY.replace("terms of", "terms and conditions of").replace("License version 2 as", "License, version 2, as")
GPL_2_VERSION = GPL_2_ONLY.replace("version 2 as", "as").replace("Foundation.", "Foundation;\nversion 2 of the License.")
CC0_DEED = """The person who associated a work with this deed has dedicated the work to the
public domain by waiving all of his or her rights to the work worldwide under
copyright law, including all related and neighboring rights, to the extent
allowed by law.

You can copy, modify, distribute and perform the work, even for commercial purposes, all without asking permission.
"""
CC0_CODE = """Statement of Purpose

The laws of most jurisdictions throughout the world automatically confer
exclusive Copyright and Related Rights (defined below) upon the creator
and subsequent owner(s) (each and all, an "owner") of an original work of
authorship and/or a database (each, a "Work").
"""
STANDARD = [
    (AGPL + HOPE.format("This program", "Affero General Public"), "agpl-3.0"),
    (AGPL.replace("Foundation,", "Foundation;") + HOPE.format("This program", "Affero General Public"), "agpl-3.0"),
    (AGPL, "agpl-3.0-notice"),
    (LGPL_3 + HOPE.format("This program", "Lesser General Public"), "lgpl-3.0"),
    (LGPL_3, "lgpl-3.0-notice"),
    (LGPL_21 + HOPE.format("This library", "Lesser General Public"), "lgpl-2.1"),
    (LGPL_21.replace("Foundation;", "Foundation,") + HOPE.format("This library", "Lesser General Public"), "lgpl-2.1"),
    (LGPL_21, "lgpl-2.1-notice"),
    (GPL_2_ONLY + HOPE.format("This program", "General Public"), "gpl-2.0-only"),
    (GPL_2_CONDITIONS + HOPE.format("This program", "General Public"), "gpl-2.0-only"),
    (GPL_2_VERSION + HOPE.format("This program", "General Public"), "gpl-2.0-only"),
    (GPL_2_ONLY, "gpl-2.0-only-notice"),
    (CC0_DEED, "cc0-1.0"),
    (CC0_CODE, "cc0-1.0"),
    ("SPDX-License-Identifier: MIT", "mit"),
    ("SPDX-License-Identifier: Apache-2.0", "apache-2.0"),
    ("SPDX-License-Identifier: BSD-3-Clause", "bsd-3-clause"),
    ("SPDX-License-Identifier: GPL-2.0-only", "gpl-2.0-only"),
    ("SPDX-License-Identifier: GPL-2.0-or-later", "gpl-2.0"),
    ("SPDX-License-Identifier: GPL-3.0-only", "gpl-3.0-only"),
    ("SPDX-License-Identifier: LGPL-2.1-only", "lgpl-2.1-only"),
    ("SPDX-License-Identifier: LGPL-3.0-only", "lgpl-3.0-only"),
    ("SPDX-License-Identifier: AGPL-3.0-only", "agpl-3.0-only"),
    ("spdx-license-identifier: CC0-1.0", "cc0-1.0"),
    (MIT, "mit"),
    (BSD_2 + DISCLAIMER, "bsd-2-clause"),
    (BSD_3 + DISCLAIMER, "bsd-3-clause"),
    (APACHE, "apache-2.0"),
    (APACHE.replace("\n\n    http", "\n    https").replace("2.0\n\n", "2.0\n"), "apache-2.0"),
    (GPL_3, "gpl-3.0"),
    (GPL_2, "gpl-2.0"),
    (GPL_2.replace("Foundation;", "Foundation,"), "gpl-2.0"),
    (GPL_3.split("\n\nThis program is distributed")[0], "gpl-3.0-notice"),
    (GPL_2.split("\n\nThis program is distributed")[0], "gpl-2.0-notice"),
    ("This work is licensed under the GNU General Public License, version 3.", "gpl-3.0-notice"),
    ("Licensed under the GNU General Public License, version 3.", "gpl-3.0-notice"),
    (MPL, "mpl-2.0"),
    (ISC, "isc"),
    (UNLICENSE, "unlicense"),
    (CREATIVE.format(""), "cc-by-4.0"),
    (CREATIVE.format("-ShareAlike"), "cc-by-sa-4.0"),
    (CREATIVE.format("-NonCommercial"), "cc-by-nc-4.0"),
    ("Licensed under CC BY 4.0.", "cc-by-4.0"),
    ("Licensed under CC BY-SA 4.0.", "cc-by-sa-4.0"),
    ("Licensed under CC BY-NC 4.0.", "cc-by-nc-4.0"),
    ("Released under the MIT License.", "mit-notice"),
    ("Licensed under the MIT License.", "mit-notice"),
    ("Licensed under the Apache License, Version 2.0.", "apache-2.0-notice"),
]


def test_standard_texts_give_their_licenses(spark):
    def commented(text, lead):
        return "\n".join(f"{lead} {line}".rstrip() for line in text.split("\n"))

    rows, expected = [], {}
    for text, name in STANDARD:
        for form in (text, text.replace("\n", "\r\n"), commented(text, "#"), f"/*\n{commented(text, ' *')}\n */\nint x;\n", f"code\n\n{text}\n\nmore"):
            expected[len(rows)] = name
            rows.append((len(rows), form))
    got = {r.doc_id: r.licenses for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == expected
    assert {name for name, _, _ in licenses.RULES} == set(expected.values())


def test_texts_without_words_are_one_group(spark):
    texts = ["", " ", None, "\n\n", "\t \r\n", "some words", "  \x0b"]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert sorted(r.doc_id for r in simhash.keep_first_copies(table).collect()) == [0, 5]
