"""Every rule by the notice that licences are given with, over lines as usual."""

import textwrap

import duckdb
import pytest
from test_operators import table

from lanewise.llm import licenses

HOPE = (
    "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the"
    " implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU General Public"
    " License for more details."
)


def gnu(what, kind, mark, comma, version):
    return (
        f"This {what} is free software{mark} you can redistribute it and/or modify it under the terms of the GNU"
        f" {kind}General Public License as published by the Free Software Foundation{comma} either version"
        f" {version} of the License, or (at your option) any later version."
    )


MPL = (
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL"
    " was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
)
APACHE = (
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in'
    " compliance with the License. You may obtain a copy of the License at"
)
UNLESS = (
    "Unless required by applicable law or agreed to in writing, software distributed under the License is"
    ' distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.'
)
URL = "    http://www.apache.org/licenses/LICENSE-2.0"
NOTICES = [
    ("GPL-3.0-or-later", [gnu("program", "", ":", ",", 3), HOPE]),
    ("GPL-3.0-or-later", [gnu("program", "", ";", ";", 3)]),
    ("GPL-2.0-or-later", [gnu("program", "", ";", ";", 2), HOPE]),
    ("GPL-2.0-or-later", [gnu("program", "", ":", ",", 2)]),
    ("LGPL-3.0-or-later", [gnu("library", "Lesser ", ";", ";", 3), HOPE.replace("program", "library")]),
    ("LGPL-3.0-or-later", [gnu("program", "Lesser ", ":", ",", 3), HOPE]),
    ("AGPL-3.0-or-later", [gnu("program", "Affero ", ":", ",", 3), HOPE]),
    ("MPL-2.0", [MPL]),
]


CLAUSES = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
    " the following conditions are met:\n\n1. Redistributions of source code must retain the above copyright"
    " notice, this list of conditions and the following disclaimer.\n\n2. Redistributions in binary form must"
    " reproduce the above copyright notice, this list of conditions and the following disclaimer in the"
    " documentation and/or other materials provided with the distribution.\n\n"
)
THIRD = (
    "3. Neither the name of {} nor the names of its contributors may be used to endorse or promote products"
    " derived from this software without specific prior written permission."
)
SHORT = [
    ("BSD-3-Clause", CLAUSES + THIRD.format("the copyright holder")),
    ("BSD-3-Clause", CLAUSES + THIRD.format("Example University, Inc.")),
    ("BSD-2-Clause", CLAUSES),
    ("MIT", "This file is licensed under the MIT License (see LICENSE)."),
    ("GPL-2.0-only", "// SPDX-License-Identifier: GPL-2.0-only"),
    ("MIT OR Apache-2.0", "# SPDX-License-Identifier: MIT OR Apache-2.0"),
    ("LGPL-2.1-or-later", "SPDX-License-Identifier: LGPL-2.1-or-later\nint main"),
]


def wrapped(parts, width, sign=""):
    lines = [[sign + line for line in textwrap.wrap(part, width)] for part in parts]
    return f"\n{sign.rstrip()}\n".join("\n".join(own) for own in lines)


def cases():
    for licence, parts in NOTICES:
        for width, sign in ((72, ""), (60, " * "), (66, "# "), (5000, "")):
            yield licence, wrapped(parts, width, sign)
    yield from SHORT
    for sign in ("", " * "):
        text = wrapped([APACHE, "URL", UNLESS], 70, sign).replace("URL", URL)
        yield "Apache-2.0", text


@pytest.fixture(scope="module")
def notices():
    found = list(cases())
    other = [
        "this program is free software\n\nyou can redistribute it",
        "Some program is free software: use it.\n" + wrapped([HOPE], 60),
        wrapped([gnu("program", "", ":", ",", 4)], 70),
    ]
    return [name for name, _ in found] + [None] * 3, [text for _, text in found] + other


def test_wrapped_notices(spark, notices):
    names, texts = notices
    got = {r.doc_id: r for r in licenses.scan_licences(table(spark, texts)).collect()}
    for i, (name, text) in enumerate(zip(names, texts, strict=True)):
        assert got[i].licences == ([name] if name else []), text
    apache = [set(got[i].sentences) for i, name in enumerate(names) if name == "Apache-2.0"]
    assert all(any(s.startswith("apache-obtain") for s in own) for own in apache)
    assert all(any(s.startswith("apache-url") for s in own) for own in apache)


def test_twin_of_wrapped_notices(spark, notices):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(notices[1])))
    expected = {r[0]: r[1:] for r in con.execute(licenses.duckdb_scan("documents")).fetchall()}
    for r in licenses.scan_licences(table(spark, notices[1])).collect():
        assert (",".join(r.sentences), ",".join(r.licences)) == expected[r.doc_id]
