import re

from adloom.llm.licences import LICENCE_FILE, TEMPLATES, laid_out, scan

FILES = "doc_id long, path string, text string, word string, licence string, notice string, dir string"


def scanned(spark, rows):
    df = spark.createDataFrame([(*r, "w", "l", "n", "d") for r in rows], FILES)
    return {r.doc_id: r for r in scan(df).collect()}


def test_notices_and_inheritance(spark):
    got = scanned(spark, [
        (1, "LICENSE", "Released under the MIT License."),
        (2, "a/b/c.txt", "no notice here"),
        (3, "a/LICENSE.md", "text\nLicensed under the Apache License, Version 2.0.\n"),
        (4, "a/x.py", "# licensed under CC BY-NC 4.0\ncode"),
        (5, "b/c/d/e.txt", "nothing"),
        (6, "a/bb/COPYING", "This work is licensed under the GNU General Public License, version 3."),
        (7, "a/bb/f", "plain"),
        (8, "a/b/licence_notes.txt", "All rights reserved."),
    ])
    short = {i: (r.licence, r.origin, r.licence_dir) for i, r in got.items()}
    assert short == {
        1: ("MIT", "notice", None), 2: ("Apache-2.0", "inherited", "a"), 3: ("Apache-2.0", "notice", None),
        4: ("CC-BY-NC-4.0", "notice", None), 5: ("MIT", "inherited", ""), 6: ("GPL-3.0", "notice", None),
        7: ("GPL-3.0", "inherited", "a/bb"), 8: ("Proprietary", "notice", None),
    }
    assert got[1].similarity == 1.0 and got[5].similarity is None


def test_every_template_finds_itself(spark):
    rows = [(i, f"d{i}/f", text) for i, text in enumerate(TEMPLATES.values())]
    got = scanned(spark, rows)
    assert [got[i].licence for i in range(len(rows))] == [re.sub("-(text|header|title|clause)$", "", name) for name in TEMPLATES]


GPL = """/*
 * Copyright (C) 2021 Somebody
 *
 * This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version 3 of the License, or
 * (at your option) any later version.
 *
 * This program is distributed in the hope that it will be useful,
 * but WITHOUT ANY WARRANTY; without even the implied warranty of
 * MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
 * GNU General Public License for more details.
 */
int main(void) { return 0; }
"""
MPL = """# Copyright 2020
# This Source Code Form is subject to the terms of the Mozilla Public
# License, v. 2.0. If a copy of the MPL was not distributed with this
# file, You can obtain one at https://mozilla.org/MPL/2.0/.
import os
import sys
print(os.path.join(sys.prefix, "somewhere", "else"), "written", "without", "any", "empty", "line", "between")
"""
APACHE = """// Licensed under the Apache License, Version 2.0 (the "License");
// you may not use this file except in compliance with the License.
// You may obtain a copy of the License at
//
//     http://www.apache.org/licenses/LICENSE-2.0
"""
MIT = """Copyright (c) 2019 Somebody

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
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.
"""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
"""
TITLE = "                    GNU GENERAL PUBLIC LICENSE\n                       Version 2, June 1991\n\n Copyright (C) 1989\n"


def test_wrapped_headers_texts_and_titles(spark):
    texts = {
        "GPL-3.0": GPL, "GPL-2.0": GPL.replace("version 3", "version 2"), "MPL-2.0": MPL, "Apache-2.0": APACHE, "MIT": MIT,
        "LGPL-3.0": GPL.replace("GNU General", "GNU Lesser General").replace("program", "library"), "BSD-3-Clause": BSD,
        "AGPL-3.0": GPL.replace("GNU General", "GNU Affero General"),
    }
    files = [(n, text, "x.c") for n, text in texts.items()] + [("MIT", MIT, "LICENSE"), ("GPL-2.0", TITLE, "COPYING")]
    files += [(n, text.replace("\n", "\r\n"), "y.c") for n, text in texts.items()]
    got = scanned(spark, [(i, f"d{i}/{name}", text) for i, (_, text, name) in enumerate(files)])
    assert [got[i].licence for i in range(len(files))] == [name for name, _, _ in files]
    assert got[0].similarity > 0.9 and got[2].similarity > 0.9


def test_identifiers(spark):
    names = {
        "# SPDX-License-Identifier: GPL-3.0-or-later": "GPL-3.0", "/* spdx-license-identifier:\tBSD-2-Clause */": "BSD-2-Clause",
        "SPDX-License-Identifier: LGPL-2.1+\n": "LGPL-2.1", "x\nSPDX-License-Identifier: (ISC OR Zlib)": "ISC",
        "Ends in SPDX-License-Identifier: MIT.": "MIT", "SPDX-License-Identifier:": None,
    }
    got = scanned(spark, [(i, f"d{i}/f", text) for i, text in enumerate(names)])
    assert [got[i].licence for i in range(len(names))] == list(names.values())
    assert got[0].similarity == 1.0 and got[0].origin == "notice"


def test_awkward_rows(spark):
    got = scanned(spark, [
        (1, None, "Released under the MIT License."), (2, None, None), (3, "x/y", None), (4, "x/LICENSE", ""),
        (5, "x/z", "long " * 50_000), (6, "q", "the the the"),
    ])
    assert got[1].licence == "MIT" and all(got[i].licence is None and got[i].origin is None for i in (2, 3, 4, 5, 6))
    twice = spark.createDataFrame([(7, "p/q", "All rights reserved.")] * 2, "doc_id long, path string, text string")
    assert [r.licence for r in scan(twice).collect()] == ["Proprietary"] * 2
    assert scan(twice.limit(0)).count() == 0


def test_best_notice_and_ties(spark):
    got = scanned(spark, [(1, "a", "All rights reserved.\nReleased under the MIT License."), (2, "b", "under the MIT License")])
    assert got[1].licence == "MIT" and got[2].licence == "MIT" and 0.6 <= got[2].similarity < 1


def test_native_plan(documents):
    df = scan(laid_out(documents))
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_layout(awkward, documents):
    rows = laid_out(documents).collect()
    assert len(rows) == documents.count() == len({r.path for r in rows})
    assert {r.path.count("/") for r in rows} <= {1, 2, 3}
    assert sum(bool(re.search(LICENCE_FILE, r.path)) for r in rows) == documents.count() // 10
    assert scan(laid_out(awkward)).count() == awkward.count()
