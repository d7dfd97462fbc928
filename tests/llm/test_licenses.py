import itertools
import re

import duckdb

from pyspark.sql import functions as F

from llm import license_expectations, license_names, licenses
from small_corpus import corpus, docs, no_docs  # noqa: F401

APACHE = '''# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
#
# Unless required by applicable law or agreed to in writing, software
# distributed under the License is distributed on an "AS IS" BASIS.
# See the License for the specific language governing permissions and limitations.
'''
MIT = '''Permission is hereby granted, free of charge, to any person obtaining a copy
of this software, to deal in it.

The above copyright notice and this permission notice shall be included in all
copies of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE.'''


def scan(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string")
    return [tuple(r)[2:] for r in licenses.scan_licenses(df).orderBy("id").collect()]


def test_rules_match_ordered_sentences(spark):
    got = scan(spark, [APACHE, MIT, "Prose.\nReleased under the MIT License.\nMore prose.", MIT[::-1],
                       "Licensed under CC BY-NC 4.0. This work is licensed under the GNU General Public License, version 3.",
                       "All rights reserved.", "You may obtain a copy of the License at x. Licensed software."])
    assert [g[1] for g in got] == [["Apache-2.0"], ["MIT"], ["MIT"], [], ["GPL-3.0", "CC-BY-NC-4.0"],
                                   ["LicenseRef-All-Rights-Reserved"], []]
    assert got[0][0] == 4 and got[0][2] == 0
    assert got[6][2] == 1  # a known sentence that no rule takes


def test_order_of_sentences_matters(spark):
    parts = MIT.split("\n\n")
    assert scan(spark, ["\n\n".join([parts[2], parts[1], parts[0]])])[0][1] == []


def test_every_phrase_holds_a_cue_and_every_rule_known_phrases():
    ids = [i for i, _ in licenses.PHRASES]
    assert len(set(ids)) == len(ids)
    kinds = {f"{i}{k}" for i in ids if "gpl" in i and i.endswith("-free") for k in ("-or-later", "-only")}
    assert {p for _, chain in licenses.RULES for p in chain} <= {*ids, *kinds, "name:Apache-2.0"}
    assert {n for n, _ in licenses.RULES} <= set(licenses.ORDER) and len(set(licenses.ORDER)) == len(licenses.ORDER)
    assert {*license_names.NAMED.values(), *license_names.TAGS.values()} <= set(licenses.ORDER)
    for _, pattern in licenses.PHRASES:
        assert any(c in pattern for c in licenses.CUES), pattern


def examples(pattern):
    """Every choice of alternatives and options of a phrase's pattern, written out."""
    def parts(tokens):
        return ["".join(x) for x in itertools.product(*[part(str(op), value) for op, value in tokens])]

    def part(op, value):
        if op == "LITERAL":
            return [chr(value)]
        if op == "ANY":
            return ["."]
        if op == "IN":
            return [chr(v) for _, v in value]
        if op == "SUBPATTERN":
            return parts(value[3])
        if op == "BRANCH":
            return [x for tokens in value[1] for x in parts(tokens)]
        assert op == "MAX_REPEAT", op
        return ([""] if value[0] == 0 else []) + parts(value[2])

    return parts(re._parser.parse(pattern))


def test_every_alternative_holds_a_cue_within_one_word():
    assert all(re.fullmatch("[a-z0-9]+", c) for c in licenses.CUES)
    for _, pattern in licenses.PHRASES:
        for sentence in examples(pattern):
            assert re.search(pattern, sentence)
            assert any(c in sentence for c in licenses.CUES), sentence


def test_cues_miss_nothing(spark, monkeypatch):
    texts = ["This data is released under CC0.", "It is dedicated under Creative Commons Zero.",
             "/* All rights\n * reserved. */", "// If a copy of the\n// MPL was not distributed with this\n"
             "// file, You can obtain one at https://mozilla.org/MPL/2.0/.", "Released under the MIT\n# License."]
    got = scan(spark, texts)
    assert [g[1:] for g in got] == [(["CC0-1.0"], 0), (["CC0-1.0"], 0), (["LicenseRef-All-Rights-Reserved"], 0),
                                    ([], 1), (["MIT"], 0)]
    texts += [APACHE, MIT, "No licence here.", *[x for _, p in licenses.PHRASES for x in examples(p)[:6]]]
    got = scan(spark, texts)
    monkeypatch.setattr(licenses, "CUES", ("",))
    assert scan(spark, texts) == got


BSD = '''Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation.
%s
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED. IN NO EVENT SHALL THE
COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES.'''
ENDORSE = '''3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
'''
GNU = '''This program is free software: you can redistribute it and/or modify
it under the terms of the GNU %(name)s as published by
the Free Software Foundation; either version %(version)s of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY. See the
GNU %(name)s for more details.

You should have received a copy of the GNU %(name)s
along with this program.'''
MPL = '''This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.'''
CC = {"": "Attribution", "-NC": "Attribution-NonCommercial", "-SA": "Attribution-ShareAlike",
      "-ND": "Attribution-NoDerivatives", "-NC-SA": "Attribution-NonCommercial-ShareAlike",
      "-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
NOTICES = [
    ("Apache-2.0", APACHE.replace("# ", "").replace("#", "")), ("MIT", MIT), ("BSD-2-Clause", BSD % ""),
    ("BSD-3-Clause", BSD % ENDORSE),
    *((f"{spdx}-or-later", GNU % {"name": f"{name}General Public License", "version": version}) for spdx, name, version in (
        ("AGPL-3.0", "Affero ", "3"), ("LGPL-3.0", "Lesser ", "3"), ("LGPL-2.1", "Lesser ", "2.1"),
        ("GPL-3.0", "", "3"), ("GPL-2.0", "", "2"))),
    ("MPL-2.0", MPL),
    ("EPL-2.0", "This program and the accompanying materials are made available under the\nterms of the Eclipse "
                "Public License 2.0 which is available at\nhttps://www.eclipse.org/legal/epl-2.0/"),
    ("EPL-2.0", "Made available under the terms of the Eclipse Public License v. 2.0 which is available at x"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0.\n(See file LICENSE_1_0.txt)"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee "
            "is hereby granted."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all\ncopyright and related or neighboring "
                "rights to this work."),
    *((f"CC-BY{kind}-{version}", text) for kind, full in CC.items() for version in ("4.0", "3.0") for text in (
        f"This work is licensed under a Creative Commons\n{full} {version} International License.",
        f"Licensed under CC-BY{kind}-{version}.", f"This is licensed under CC BY{kind} {version}.")),
    ("LicenseRef-All-Rights-Reserved", "All rights reserved."),
]


def test_published_notices_match_their_rules_in_any_comment(spark):
    wanted, texts = [], []
    for name, notice in NOTICES:
        lines = notice.split("\n")
        for text in (notice, *("\n".join(sign + line for line in lines) for sign in ("-- ", "# ", " * ", "// "))):
            wanted.append(([name], 0))
            texts.append(text)
    assert {n for n, _ in licenses.RULES} <= {n for n, _ in NOTICES} | {
        f"{n.removesuffix('-or-later')}{k}" for n, _ in NOTICES if n.endswith("-or-later") for k in ("", "-only")}
    got = [g[1:] for g in scan(spark, texts)]
    assert [(t, g) for t, g, w in zip(texts, got, wanted) if g != w] == []


def test_only_a_version_keeps_a_sentence_open(spark):
    got = scan(spark, ["Subject to the terms of the Mozilla Public License, v. 1.1.",
                       "Bought in Tel Aviv. 3 rights. All rights reserved. See v. all rights reserved."])
    assert got[0] == (0, [], 0) and got[1][0] == 2


SAID = [
    ("SPDX-License-Identifier: MIT", ["MIT"]),
    ("// SPDX-License-Identifier: Apache-2.0\nint main() { return 0; }", ["Apache-2.0"]),
    ("/* SPDX-License-Identifier: (GPL-2.0+ OR BSD-3-Clause) */", ["BSD-3-Clause", "GPL-2.0-or-later"]),
    ("SPDX-License-Identifier: GPL-2.0-only WITH Linux-syscall-note", ["GPL-2.0-only"]),
    ("<!-- SPDX-License-Identifier: CC-BY-SA-4.0 -->", ["CC-BY-SA-4.0"]),
    ("This crate is licensed under MIT.", ["MIT"]),
    ("Licensed under Apache 2.0", ["Apache-2.0"]),
    ("MIT License\n\nCopyright (c) 2020 A. Person", ["MIT"]),
    ("# MIT Licence\nCopyright (c) 2020 A Person", ["MIT"]),
    ("Distributed under the GPLv3.", ["GPL-3.0"]),
    ("Licensed under GPL-3.0-only.", ["GPL-3.0-only"]),
    ("Licensed under the GNU General Public License, version 2 or later.", ["GPL-2.0-or-later"]),
    ("Released under the GPL v2 (or, at your option, any later version).", ["GPL-2.0-or-later"]),
    ("Licensed under the LGPLv2.1+.", ["LGPL-2.1-or-later"]),
    ("Available under the terms of version 2 of the GNU General Public License.", ["GPL-2.0"]),
    ("Licensed under either of Apache License, Version 2.0 or MIT license at your option.", ["Apache-2.0", "MIT"]),
    ("Licensed under the BSD 3-Clause License.", ["BSD-3-Clause"]),
    ("This is not licensed under the MIT License.", []),
    ("The data isn't released under CC BY 4.0, but the code is released under the MIT License.", ["MIT"]),
    ("No longer distributed under the GPLv2.", []),
    ("Available under Python 3. He studied at MIT. Apache License talk was published under pressure.", []),
    ("Permitted by the GPL? Nobody was unlicensed under mitigation.", []),
    ("Copyright 2020 X. All rights reserved.\n\n" + BSD % "", ["BSD-2-Clause"]),
    ("Copyright 2020 X. All rights reserved.", ["LicenseRef-All-Rights-Reserved"]),
    ("Licensed under the Apache License.", ["LicenseRef-Apache"]),
]


def test_names_tags_headings_versions_and_negations(spark):
    got = scan(spark, [t for t, _ in SAID])
    assert [(t, g[1]) for (t, w), g in zip(SAID, got) if (g[1], g[2]) != (w, 0)] == []
    assert scan(spark, ["SPDX-License-Identifier: Foo-1.0"]) == [(1, [], 1)]


def test_every_name_and_tag_is_found(spark):
    texts = [(f"Released under the {key.split('|')[0]} {key.split('|')[1]}.", name)
             for key, name in license_names.NAMED.items()]
    texts += [(f"SPDX-License-Identifier: {tag.upper()}", name) for tag, name in license_names.TAGS.items()]
    got = scan(spark, [t for t, _ in texts])
    assert [(t, g[1], name) for (t, name), g in zip(texts, got) if g[1:] != ([name], 0)] == []


def test_names_are_found_without_cues_too(spark, monkeypatch):
    texts = [t for t, _ in SAID]
    got = scan(spark, texts)
    monkeypatch.setattr(licenses, "CUES", ("",))
    assert scan(spark, texts) == got


def test_expectations_agree_where_they_speak(spark):
    """The SQL knows no headings, no second name and no bare family; elsewhere it and the scan agree."""
    silent = ("MIT Licen", "# MIT", "either of", "(GPL-2.0+ OR", "BSD", "version 2 of", "Redistribution", "Apache License.")
    texts = [t for t, _ in SAID if not any(s in t for s in silent)]
    texts += [None, "", "Prose.", APACHE, MIT, "Released under the MIT License. All rights reserved. Released under the MIT License."]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [[i, t] for i, t in enumerate(texts)])
    want = con.execute(license_expectations.sql() + " ORDER BY doc_id").fetchall()
    got = [(i, n, ",".join(names), rest) for i, (n, names, rest) in enumerate(scan(spark, texts))]
    assert got == want


def test_edges_and_plan(spark, docs, corpus, no_docs):
    clash = docs.withColumn("licenses", F.lit(1)).withColumn("l_ids", F.lit("x"))
    out = licenses.scan_licenses(clash)
    assert out.columns == [*clash.columns, "n_license_sentences", "_licenses", "n_unmatched"]
    assert out.count() == len(corpus) and out.where("size(_licenses) > 0").isEmpty()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert licenses.scan_licenses(no_docs).isEmpty()
