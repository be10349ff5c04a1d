from lakeloom.llm import licenses
from lakeloom.llm.queries import SQL
from tests.oracle import TABLES, same


def test_rules(spark, documents, odd_rows):
    rows = [(100, "# Released under the MIT License."), (103, "Intro. Licensed under CC BY-NC 4.0.\nLicensed under the Apache License,\tVersion 2.0"), (104, "not licensed under cc by-nc 4.0 at all"), (105, "This work is licensed under a Creative Commons\nAttribution 4.0 International License. More."), (106, "v. 2 and v. x. All rights reserved!")]
    got = {r["doc_id"]: r["licenses"] for r in licenses.scan(documents(rows + odd_rows)).collect() if r["doc_id"]}
    assert got[100] == "MIT" and got[103] == "Apache-2.0,CC-BY-NC-4.0" and got[104] == "" and got[105] == "CC-BY-4.0" and got[106] == "Proprietary"
    assert all(got[i] == "" for i, _ in odd_rows if i)
    assert licenses.scan(documents(odd_rows)).count() == len(odd_rows) and licenses.scan(documents([])).count() == 0
    frame = documents(rows)
    for c in ("_marks", "_lines", "ids", "licenses"):
        frame = frame.withColumn(c, frame["lang"])
    assert {r["doc_id"]: r["licenses"] for r in licenses.scan(frame).collect()} == {i: got[i] for i, _ in rows}


def test_no_python_in_the_plan(spark, sf):
    text = licenses.op9_licenses(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text and "Exchange" not in text


def test_query(spark, sf):
    same(licenses.op9_licenses(spark, sf), SQL["op9_licenses"], sf)


MIT = """MIT License

Copyright (c) 2020 Someone

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
LIABILITY.
"""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
%s
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE.
"""
THIRD = """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
GPL = """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful.

    You should have received a copy of the GNU General Public License
    along with this program.  If not, see <https://www.gnu.org/licenses/>.
"""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.
"""


ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE.
"""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS.
"""
APACHE_BODY = """1. Definitions.

   "License" shall mean the terms and conditions for use, reproduction,
   and distribution as defined by Sections 1 through 9 of this document.

   "Licensor" shall mean the copyright owner or entity authorized by
   the copyright owner that is granting the License.

2. Grant of Copyright License. Subject to the terms and conditions of
   this License, each Contributor hereby grants to You a license.

3. Grant of Patent License. Subject to the terms and conditions of
   this License, each Contributor hereby grants to You a patent license.
"""
GPL_BODY = """                            Preamble

  The GNU General Public License is a free, copyleft license for
software and other kinds of works.

  The licenses for most software and other practical works are designed
to take away your freedom to share and change the works.  By contrast,
the GNU General Public License is intended to guarantee your freedom to
share and change all versions of a program--to make sure it remains free
software for all its users.  We use the GNU General Public License.
"""
MPL_BODY = """1. Definitions
--------------

1.1. "Contributor"
    means each individual or legal entity that creates, contributes to
    the creation of, or owns Covered Software.
"""
UNLICENSE = "This is free and unencumbered software released into the public domain.\n"
TEXTS = [("MIT", MIT), ("BSD-2-Clause", BSD % ""), ("BSD-3-Clause", BSD % THIRD), ("GPL-3.0", GPL), ("MPL-2.0", MPL), ("ISC", ISC), ("Apache-2.0", APACHE), ("Apache-2.0", APACHE_BODY), ("GPL-3.0", GPL_BODY), ("MPL-2.0", MPL_BODY), ("Unlicense", UNLICENSE)]


def variants():
    """The licences' own texts with their line ends, as comments of two kinds, within other text, and on one line."""
    rows = []
    for i, (name, t) in enumerate(TEXTS):
        lines = t.splitlines()
        for n, x in enumerate((t, "".join(f"# {x}\n" for x in lines), "/*\n" + "".join(f" * {x}\r\n" for x in lines) + " */", "Before it.\n\n" + t + "\nAfter it.", " ".join(t.split()))):
            rows.append((i * 10 + n, x, name))
    return rows


def test_own_texts(documents):
    got = {r["doc_id"]: r["licenses"] for r in licenses.scan(documents([r[:2] for r in variants()])).collect()}
    assert {i: got[i] for i, _, _ in variants()} == {i: name for i, _, name in variants()}


def test_sentences_far_apart(documents):
    """A rule's sentences count together only within a bounded number of sentences, and in order."""
    first, second = MIT.index("THE SOFTWARE IS"), MIT.index("Permission")
    near = MIT[second:first] + "And so on. " * 40 + "\n\n" + MIT[first:]
    far = MIT[second:first] + "And so on. " * 80 + "\n\n" + MIT[first:]
    turned = MIT[first:] + "\n\n" + MIT[second:first]
    got = {r["doc_id"]: (r["licenses"], r["sentence_ids"]) for r in licenses.scan(documents([(1, near), (2, far), (3, turned)])).collect()}
    assert got == {1: ("MIT", "18 19"), 2: ("", "18 19"), 3: ("", "19 18")}


def test_sql_agrees_on_own_texts(spark, documents, odd_rows, tmp_path):
    rows = [r[:2] for r in variants()] + odd_rows + [(900, "v. 2.0 x: y. All rights reserved.\n# Licensed under CC BY 4.0"), (901, "a\x1eb. c\x1fd")]
    for t in TABLES:
        documents(rows if t == "documents" else []).coalesce(1).write.parquet(str(tmp_path / "made" / t))
        next((tmp_path / "made" / t).glob("*.parquet")).rename(tmp_path / f"{t}.parquet")
    same(licenses.op9_licenses(spark, str(tmp_path)), SQL["op9_licenses"], str(tmp_path))
