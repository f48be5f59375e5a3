import re

import duckdb
import pandas as pd
import pytest

from meterlake.llm.licenses import SENTENCES, known_sentences, rules, scan, scan_sql
from tests.llm.conftest import DOC_SCHEMA

BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list
of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this
list of conditions and the following disclaimer in the documentation and/or other
materials provided with the distribution."""
ENDORSE = """
3. Neither the name of the copyright holder nor the names of its contributors may
be used to endorse or promote products derived from this software without specific
prior written permission."""
APACHE = """/* Licensed under the Apache License, Version 2.0 (the "License");
 you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0"""
GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version."""

CASES = [
    (None, [], []), ("", [], []), ("no terms here, only a license of words", [], []),
    ("Text.\nReleased under the MIT License.\nMore", ["mit-released"], ["MIT"]),
    ("x\nLicensed under CC BY-NC 4.0. Released under the MIT License. Licensed under CC BY-NC 4.0.",
     ["cc-by-nc", "mit-released", "cc-by-nc"], ["MIT", "CC-BY-NC-4.0"]),
    ("# SPDX-License-Identifier: GPL-3.0-or-later\ncode", ["spdx:GPL-3.0-or-later"], ["GPL-3.0-or-later"]),
    (BSD, ["bsd-grant", "bsd-source", "bsd-binary"], ["BSD-2-Clause"]),
    (BSD + ENDORSE, ["bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse"], ["BSD-3-Clause"]),
    (APACHE, ["apache2-header", "apache2-copy"], ["Apache-2.0"]),
    (GPL, ["gpl3-later"], ["GPL-3.0-or-later"]),
    ("LICENSED UNDER THE APACHE LICENSE, VERSION 2.0!! " + "w " * 100_000, ["apache2-notice"],
     ["Apache-2.0"]),
    (ENDORSE, ["bsd-endorse"], []),
]


def test_known_texts(stored_table):
    rows = [(i, t, "en", "s", 1) for i, (t, _, _) in enumerate(CASES)] + [(3, CASES[3][0], None, None, None)]
    found = scan(stored_table(rows, DOC_SCHEMA), ["doc_id", "text"]).collect()
    assert len(found) == len(rows)
    for r in found:
        _, ids, licences = CASES[r["doc_id"]]
        assert (r["sentence_ids"], r["licences"]) == (ids, licences)


APACHE_HEADER = """Copyright 2020 The Authors

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""
GPL_HEADER = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.

You should have received a copy of the GNU General Public License
along with this program.  If not, see <https://www.gnu.org/licenses/>."""
MIT_HEADER = """Copyright (c) 2020 Someone

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR"""
HEADERS = [
    (APACHE_HEADER, ["apache2-header", "apache2-copy", "apache2-unless", "apache2-see"], ["Apache-2.0"]),
    (GPL_HEADER, ["gpl3-later", "gpl-hope", "gpl-received"], ["GPL-3.0-or-later"]),
    (MIT_HEADER, ["mit-grant", "mit-notice"], ["MIT"]),
]
ENDORSE_BY = """
3. Neither the name of Example Inc. nor the
   names of its contributors may be used to endorse or promote products
   derived from this software without specific prior written permission."""


def commented(text, leader, first="", last=""):
    lines = [f"{leader}{line}".rstrip() for line in text.split("\n")]
    return "\n".join([*([first] if first else []), *lines, *([last] if last else []), "code = 1"])


def test_source_headers_with_and_without_comment_marks(stored_table):
    cases = [
        (way(text), ids, licences)
        for text, ids, licences in HEADERS
        for way in (
            str, lambda t: commented(t, "# "), lambda t: commented(t, "// "),
            lambda t: commented(t, " * ", "/*", " */"), lambda t: t.replace("\n", "\r\n"),
        )
    ]
    three = ["bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse"]
    cases += [(BSD + ENDORSE_BY, three, ["BSD-3-Clause"])]
    cases += [(commented(BSD + ENDORSE_BY, "# "), three, ["BSD-3-Clause"])]
    cases += [("# this project is\n# Licensed under the MIT License", ["mit-project"], ["MIT"])]
    rows = [(i, t, "en", "s", 1) for i, (t, _, _) in enumerate(cases)]
    for r in scan(stored_table(rows, DOC_SCHEMA), ["doc_id", "text"]).collect():
        _, ids, licences = cases[r["doc_id"]]
        assert (r["sentence_ids"], r["licences"]) == (ids, licences), r["text"]


MORE = [
    ("MIT License\n\nCopyright (c) 2020", ["name:MIT"], ["MIT"]),
    ("The MIT License (MIT)", ["name:MIT"], ["MIT"]),
    ("GNU GENERAL PUBLIC LICENSE\n   Version 3, 29 June 2007\n\nText", ["gpl3-title"], ["GPL-3.0-only"]),
    ("# GNU GENERAL PUBLIC LICENSE\n# Version 3\n", ["name:GPL-3.0-only"], ["GPL-3.0-only"]),
    ("Apache License\nVersion 2.0, January 2004\n\nText", ["apache2-title"], ["Apache-2.0"]),
    ("  Apache License\n Version 2.0, January 2004\n http://www.apache.org/licenses/\n\nTERMS", ["apache2-title-at"],
     ["Apache-2.0"]),
    ("All of this code is licensed under the Apache License 2.0.", ["name:Apache-2.0"], ["Apache-2.0"]),
    ("Foo is available under the terms of the\nMozilla Public License 2.0. Bar", ["name:MPL-2.0"], ["MPL-2.0"]),
    (GPL.replace("program", "library").replace("General", "Lesser General").replace("version 3", "version 2.1"),
     ["lgpl21-later"], ["LGPL-2.1-or-later"]),
    ("SPDX-License-Identifier: GPL-3.0", ["spdx:GPL-3.0"], ["GPL-3.0-only"]),
    ("// SPDX-License-Identifier: BSL-1.0\nint x;", ["spdx:BSL-1.0"], ["BSL-1.0"]),
    ("SPDX-License-Identifier: MIT OR Apache-2.0", ["spdx:MIT", "spdx:Apache-2.0"], ["MIT", "Apache-2.0"]),
    ("/* SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0 */",
     ["spdx:GPL-2.0-only", "spdx:Classpath-exception-2.0"], ["GPL-2.0-only"]),
    ("# SPDX-License-Identifier: (MIT AND (GPL-2.0+ OR BSD-3-Clause))\nMIT or not",
     ["spdx:MIT", "spdx:GPL-2.0-or-later", "spdx:BSD-3-Clause"], ["MIT", "BSD-3-Clause", "GPL-2.0-or-later"]),
    ("mit\ncc0\nunder the mit license of words", [], []),
    ("This is not licensed under the MIT License or any other.", [], []),
]


def test_titles_statements_and_expressions(stored_table):
    rows = [(i, t, "en", "s", 1) for i, (t, _, _) in enumerate(MORE)]
    for r in scan(stored_table(rows, DOC_SCHEMA), ["doc_id", "text"]).collect():
        _, ids, licences = MORE[r["doc_id"]]
        assert (r["sentence_ids"], sorted(r["licences"])) == (ids, sorted(licences)), r["text"]


def test_sql_finds_the_same(stored_table, sample):
    texts = [t for t, _, _ in (*CASES, *MORE)]
    texts += [way(t) for t, _, _ in HEADERS for way in (str, lambda t: commented(t, "# "), lambda t: t.replace("\n", "\r\n"))]
    texts += [commented(BSD + ENDORSE_BY, " * ", "/*", " */"), "x\x01y\x02z\x03 MIT License", "\n\nMIT License\n\n"]
    texts += ["İ K ſ licensed under the MIT licence", "a" * 50_000 + "\nMIT License\n" + "b, " * 50_000]
    texts += [t for _, t, _ in sample]
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(texts)]
    found = scan(stored_table(rows, DOC_SCHEMA), ["doc_id"]).collect()
    got = {r["doc_id"]: (",".join(r["sentence_ids"]), ",".join(r["licences"])) for r in found}
    documents = pd.DataFrame({"doc_id": range(len(texts)), "text": texts})
    with duckdb.connect() as con:
        con.register("documents", documents)
        want = {d: (ids, licences) for d, _, ids, licences in con.execute(scan_sql()).fetchall()}
    assert got == want
    assert sum(bool(ids) for ids, _ in got.values()) > 30


def test_empty_table_and_clashing_columns(stored_table):
    assert scan(stored_table([], DOC_SCHEMA), ["doc_id"]).collect() == []
    clash = stored_table([("Released under the MIT License.", "k")], "text string, found string")
    assert scan(clash, ["found"]).first()["licences"] == ["MIT"]


@pytest.mark.parametrize("name", list(SENTENCES))
def test_every_sentence_is_in_plain_form_and_takes_part(name):
    assert re.fullmatch(r"[a-z0-9]+( [a-z0-9]+)*", SENTENCES[name])
    assert len(known_sentences()) == len(set(known_sentences().values()))


def test_longer_rules_come_before_their_parts():
    seen = []
    for _, ids in rules():
        assert not any(earlier in ids and earlier != ids for earlier in seen)
        seen.append(ids)
