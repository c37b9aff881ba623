"""Whole licence texts as they stand in files, and prose that is none."""

import textwrap

import pytest

from barloom.llm import licenses

MIT = """MIT License

Copyright (c) 2020 Jo Doe

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
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS.
"""
BSD = """Copyright 2011 Jo Doe. All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

{0} Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
{1} Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
THIRD = """{2} Neither the name of the copyright holder nor the names of its contributors
   may be used to endorse or promote products derived from this software
   without specific prior written permission.
"""
GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU {0}General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.
"""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
"""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.
"""
ZLIB = """This software is provided 'as-is', without any express or implied
warranty. In no event will the authors be held liable for any damages
arising from the use of this software.
"""
EPL = """This program and the accompanying materials are made available under the
terms of the Eclipse Public License 2.0 which is available at
https://www.eclipse.org/legal/epl-2.0/

SPDX-License-Identifier: EPL-2.0
"""
BOOST = """Permission is hereby granted, free of charge, to any person or organization
obtaining a copy of the software and accompanying documentation covered by
this license (the "Software") to use, reproduce, display, distribute,
execute, and transmit the Software, and to prepare derivative works of the
Software, and to permit third-parties to whom the Software is furnished to
do so, all subject to the following:
"""
UNLICENSE = "This is free and unencumbered software released into the public\ndomain.\n"


def commented(text, mark):
    return textwrap.indent(text, mark, lambda line: True)


CASES = {
    MIT: "MIT",
    commented(MIT, "# "): "MIT",
    MIT.replace("\n", "\r\n"): "MIT",
    "/*\n" + commented(MIT, " * ") + " */\nint main;": "MIT",
    APACHE: "Apache-2.0",
    commented(APACHE, "// "): "Apache-2.0",
    commented(APACHE, "-- "): "Apache-2.0",
    "some prose before it\n\n" + APACHE + "\nand after": "Apache-2.0",
    BSD.format("1.", "2."): "BSD-2-Clause,Proprietary",
    (BSD + THIRD).format("1.", "2.", "3."): "BSD-3-Clause,Proprietary",
    (BSD + THIRD).format("*", "*", "*"): "BSD-3-Clause,Proprietary",
    commented((BSD + THIRD).format("(a)", "(b)", "(c)"), "; "): "BSD-3-Clause,Proprietary",
    GPL.format(""): "GPL",
    GPL.format("Affero "): "AGPL",
    GPL.format("Lesser "): "LGPL",
    ISC: "ISC",
    MPL: "MPL-2.0",
    commented(MPL, "# "): "MPL-2.0",
    ZLIB: "Zlib",
    EPL: "EPL",
    BOOST: "BSL-1.0",
    UNLICENSE: "Unlicense",
    "Licensed under the ISC License.": "ISC",
    "Distributed under the Boost Software License, Version 1.0.": "BSL-1.0",
    "// SPDX-License-Identifier: MIT\n// Copyright 2020\n": "MIT",
    "/* SPDX-License-Identifier: GPL-2.0-or-later */": "GPL",
    "# SPDX-License-Identifier: BSD-3-Clause\nimport os": "BSD-3-Clause",
    "# SPDX-License-Identifier: BSD-2-Clause": "BSD-2-Clause",
    "SPDX-License-Identifier: Nothing-1.0": "",
    "a line without an end\nReleased under the MIT License\nanother line": "MIT",
    "Shopping list:\n1. eggs\n2. milk": "",
    "Born in\n1984": "",
    "1984": "",
    "2.0": "",
    "v. 2.0": "",
    "Chapter 1.\n\n2\n\n3.1\n\nversion 3": "",
    "The Apache License, Version 2.0, is long": "",
    "# 1. # 2. #": "",
}


def test_licence_texts(spark):
    docs = spark.createDataFrame(list(enumerate(CASES)), "doc_id long, text string")
    got = {r["doc_id"]: ",".join(r["licenses"]) for r in licenses.scan_licenses(docs).collect()}
    wrong = {text[:60]: (got[i], want) for i, (text, want) in enumerate(CASES.items()) if got[i] != want}
    assert not wrong


def test_a_sentence_needs_words(monkeypatch):
    monkeypatch.setitem(licenses.SENTENCES, "bad_notice", ["Some Public License; 2.0"])
    with pytest.raises(ValueError, match="bad_notice"):
        licenses.known_sentences()


def test_no_sentence_is_known_by_a_part(spark):
    """Half of a sentence that holds an end of its own is no licence."""
    docs = spark.createDataFrame([(1, "This program is free software."), (2, "either version 2 of the License, or (at your option) any later version")], "doc_id long, text string")
    assert [r["licenses"] for r in licenses.scan_licenses(docs).collect()] == [[], []]
