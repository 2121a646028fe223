from __future__ import annotations

import itertools
import random
import re

import pytest

from marquee.llm.licences import RULES, SENTENCES, licence_scan, scan_sql

MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files. The above copyright notice and this permission notice shall be included in all copies or "
    'substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS.'
)


@pytest.mark.parametrize(
    "text, licences",
    [
        ("Words.\nReleased under the MIT License.", "MIT"),
        ("Licensed under the Apache License, Version 2.0.\nmore", "Apache-2.0"),
        ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0-only"),
        ("x\nLicensed under CC BY-NC 4.0.\nReleased under the MIT License.", "MIT,CC-BY-NC-4.0"),
        ("Licensed under CC BY 4.0.", "CC-BY-4.0"),
        (MIT, "MIT"),
        ("// SPDX-License-Identifier: GPL-2.0-or-later", "GPL-2.0-or-later"),
        ("You need permission to enter.", "UNKNOWN"),
        ("no such words here", ""),
        ("The software is provided as is without warranty of any kind", "UNKNOWN"),  # one sentence of a rule
    ],
)
def test_licences(make_docs, text, licences):
    (row,) = licence_scan(make_docs([(1, text)])).collect()
    assert row.licences == licences


def test_rules_use_known_sentences_and_are_ordered():
    known = {name for name, _ in SENTENCES}
    assert len(known) == len(SENTENCES) and {i for _, ids in RULES for i in ids} <= known
    texts = ["".join(f"<{i}>" for i in ids) for _, ids in RULES]
    for k, later in enumerate(texts):  # a longer rule isn't hidden by an earlier part of it
        assert not any(earlier in later for earlier in texts[:k])


def test_what_is_used_up_joins_no_neighbours(make_docs):
    text = "\n".join(["Licensed under the Apache License, Version 2.0.", "Released under the MIT License."] * 2)
    (row,) = licence_scan(make_docs([(1, text)])).collect()
    assert row.licences == "Apache-2.0,MIT" and row.sentence_ids == "ApacheRef,MITRef,ApacheRef,MITRef"


def test_odd_rows(odd_docs, no_docs):
    rows = licence_scan(odd_docs).collect()
    assert len(rows) == 13 and all((r.n_sentences, r.sentence_ids, r.licences) == (0, "", "") for r in rows)
    assert licence_scan(no_docs).count() == 0


def examples(parsed):
    """Texts that a pattern of SENTENCES matches: every branch, options both out and in."""
    parts = []
    for kind, arg in parsed:
        match str(kind):
            case "LITERAL":
                parts.append([chr(arg)])
            case "ANY":
                parts.append(["x"])
            case "IN":
                parts.append([chr(a) for k, a in arg if str(k) == "LITERAL"])
            case "SUBPATTERN":
                parts.append(examples(arg[-1]))
            case "BRANCH":
                parts.append([t for branch in arg[1] for t in examples(branch)])
            case "MAX_REPEAT":
                parts.append([""] * (arg[0] == 0 and str(arg[2][0][0]) != "ANY") + examples(arg[2]))
            case _:
                raise ValueError(kind)
    return ["".join(p) for p in itertools.product(*parts)]


def test_every_known_sentence_is_recognised(spark):
    # "." stands for itself but in ".*"
    cases = [(n, t) for n, p in SENTENCES for t in examples(re._parser.parse(re.sub(r"[.](?![*])", "[.]", p)))]
    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(cases)], "doc_id long, text string")
    found = {r.doc_id: r for r in licence_scan(docs).collect()}
    wrong = [(n, t, found[i].sentence_ids) for i, (n, t) in enumerate(cases) if found[i].sentence_ids != n or found[i].n_sentences != 1]
    assert not wrong, wrong[:5]


@pytest.mark.parametrize(
    "text, licences",
    [
        ("Prose.\nAll rights reserved.", "Proprietary"),
        ("Released under CC0 1.0.", "CC0-1.0"),
        ("Released under CC BY 4.0.", "CC-BY-4.0"),
        ("They released an example.", ""),
    ],
)
def test_sentences_without_licence_words(make_docs, text, licences):
    (row,) = licence_scan(make_docs([(1, text)])).collect()
    assert row.licences == licences and row.n_sentences == (licences != "")


NOTICES = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy
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
LIABILITY.""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY ARE DISCLAIMED.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES
WITH REGARD TO THIS SOFTWARE.""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "GPL-3.0-or-later": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.

You should have received a copy of the GNU General Public License
along with this program.  If not, see <https://www.gnu.org/licenses/>.""",
    "GPL-2.0-or-later": """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; either version 2 of the License, or
(at your option) any later version.""",
}


OTHERS = {
    "Zlib": """This software is provided 'as-is', without any express or implied
warranty. In no event will the authors be held liable for any damages
arising from the use of this software.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:""",
    "BSL-1.0": """Distributed under the Boost Software License, Version 1.0.
(See accompanying file LICENSE_1_0.txt)""",
    "Unlicense": """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or
distribute this software.""",
    "EPL-2.0": """This program and the accompanying materials are made available under the
terms of the Eclipse Public License 2.0 which is available at
http://www.eclipse.org/legal/epl-2.0.""",
    "CC0-1.0": """To the extent possible under law, the author has waived all copyright and
related or neighboring rights to this work.""",
    "AGPL": "SPDX-License-Identifier: AGPL-3.0-or-later",
    "LGPL": "SPDX-License-Identifier: LGPL-2.1",
}


@pytest.mark.parametrize("sign", ["", "# "])
@pytest.mark.parametrize("name", list(OTHERS))
def test_more_notices(make_docs, name, sign):
    text = "\n".join(sign + line for line in OTHERS[name].split("\n"))
    (row,) = licence_scan(make_docs([(1, f"Title\n{text}\nimport x")])).collect()
    assert name in row.licences.split(",")


@pytest.mark.parametrize("sign", ["", "# ", "// ", " * "])
def test_wrapped_notices(spark, sign):
    """All sentences of the longest rule, with and without comment signs, between other lines."""
    cases = [(name, f"Title\n{text}\nimport x") for name, text in NOTICES.items()]
    rows = [(i, "\n".join(sign + line for line in t.split("\n"))) for i, (_, t) in enumerate(cases)]
    found = {r.doc_id: r for r in licence_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [found[i].licences for i in range(len(cases))] == list(NOTICES)
    longest = {}
    for name, ids in RULES:
        longest.setdefault(name, ",".join(ids))
    longest["GPL-2.0-or-later"] = "GPL2Later"
    assert [found[i].sentence_ids for i in range(len(cases))] == [longest[n] for n in NOTICES]


def test_wrapped_lines_are_one_sentence(make_docs):
    (row,) = licence_scan(make_docs([(1, "You need permission\nof the copyright holder.\nMore prose.")])).collect()
    assert (row.n_sentences, row.licences) == (1, "UNKNOWN")


def test_sql_agrees_on_mixed_texts(make_docs):
    """Notices, known sentences and plain ones joined by all kinds of ends, in SQL and Spark."""
    import duckdb
    import pandas as pd

    r = random.Random(8)
    known = [t for _, pattern in SENTENCES for t in examples(re._parser.parse(re.sub(r"[.](?![*])", "[.]", pattern)))[:2]]
    plain = ["plain words", "You need permission", "public\ndomain", "the source code v. 2", "a -- b", "LicenSe: x", "v.\n2.0", "é İ ok", "mpl"]
    ends = [". ", ".\n", "\n", "; ", ": ", ";\n", "\n\n", ". \n", "\n---\n", ".\r\n", " ", " ./- ", ".\t\n", "\x01", "\x02", "..", "\n // "]
    texts = ["".join(r.choice(known + plain + list(NOTICES.values())) + r.choice(ends) for _ in range(r.randint(1, 9))) for _ in range(1500)]
    docs = list(enumerate(texts)) + [(9000, None), (9001, "")]
    want = {(x.doc_id, x.n_sentences, x.sentence_ids, x.licences) for x in licence_scan(make_docs(docs)).collect()}
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(docs, columns=["doc_id", "text"]))
    assert set(con.execute(scan_sql()).fetchall()) == want
