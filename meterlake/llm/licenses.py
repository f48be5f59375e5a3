"""Licence recognition by sentences, and by rules over their order."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of well-known licence texts and notices, in lower case with
# everything but letters and digits as one space.
SENTENCES = {
    "apache2-notice": "licensed under the apache license version 2 0",
    "apache2-header": (
        "licensed under the apache license version 2 0 the license you may not use this file "
        "except in compliance with the license"
    ),
    "apache2-copy": (
        "you may obtain a copy of the license at http www apache org licenses license 2 0"
    ),
    "apache2-unless": (
        "unless required by applicable law or agreed to in writing software distributed under "
        "the license is distributed on an as is basis without warranties or conditions of any "
        "kind either express or implied"
    ),
    "apache2-see": (
        "see the license for the specific language governing permissions and limitations under "
        "the license"
    ),
    "mit-released": "released under the mit license",
    "mit-licensed": "licensed under the mit license",
    "mit-project": "this project is licensed under the mit license",
    "mit-grant": (
        "permission is hereby granted free of charge to any person obtaining a copy of this "
        "software and associated documentation files the software to deal in the software "
        "without restriction including without limitation the rights to use copy modify merge "
        "publish distribute sublicense and or sell copies of the software and to permit persons "
        "to whom the software is furnished to do so subject to the following conditions"
    ),
    "mit-notice": (
        "the above copyright notice and this permission notice shall be included in all copies "
        "or substantial portions of the software"
    ),
    "isc-grant": (
        "permission to use copy modify and or distribute this software for any purpose with or "
        "without fee is hereby granted provided that the above copyright notice and this "
        "permission notice appear in all copies"
    ),
    "bsd-grant": (
        "redistribution and use in source and binary forms with or without modification are "
        "permitted provided that the following conditions are met"
    ),
    "bsd-source": (
        "redistributions of source code must retain the above copyright notice this list of "
        "conditions and the following disclaimer"
    ),
    "bsd-binary": (
        "redistributions in binary form must reproduce the above copyright notice this list of "
        "conditions and the following disclaimer in the documentation and or other materials "
        "provided with the distribution"
    ),
    "bsd-endorse": (
        "neither the name of the copyright holder nor the names of its contributors may be used "
        "to endorse or promote products derived from this software without specific prior "
        "written permission"
    ),
    "gpl3-work": "this work is licensed under the gnu general public license version 3",
    "gpl2-work": "this work is licensed under the gnu general public license version 2",
    "gpl3-later": (
        "this program is free software you can redistribute it and or modify it under the terms "
        "of the gnu general public license as published by the free software foundation either "
        "version 3 of the license or at your option any later version"
    ),
    "gpl2-later": (
        "this program is free software you can redistribute it and or modify it under the terms "
        "of the gnu general public license as published by the free software foundation either "
        "version 2 of the license or at your option any later version"
    ),
    "lgpl3-later": (
        "this program is free software you can redistribute it and or modify it under the terms "
        "of the gnu lesser general public license as published by the free software foundation "
        "either version 3 of the license or at your option any later version"
    ),
    "agpl3-later": (
        "this program is free software you can redistribute it and or modify it under the terms "
        "of the gnu affero general public license as published by the free software foundation "
        "either version 3 of the license or at your option any later version"
    ),
    "gpl-hope": (
        "this program is distributed in the hope that it will be useful but without any warranty "
        "without even the implied warranty of merchantability or fitness for a particular purpose"
    ),
    "gpl-received": (
        "you should have received a copy of the gnu general public license along with this program"
    ),
    "mpl2-form": (
        "this source code form is subject to the terms of the mozilla public license v"
    ),
    "mpl2-copy": (
        "if a copy of the mpl was not distributed with this file you can obtain one at http "
        "mozilla org mpl 2 0"
    ),
    "cc-by": "licensed under cc by 4 0",
    "cc-by-sa": "licensed under cc by sa 4 0",
    "cc-by-nc": "licensed under cc by nc 4 0",
    "cc-by-nd": "licensed under cc by nd 4 0",
    "cc-by-nc-sa": "licensed under cc by nc sa 4 0",
    "cc-by-nc-nd": "licensed under cc by nc nd 4 0",
    "cc-by-work": (
        "this work is licensed under a creative commons attribution 4 0 international license"
    ),
    "unlicense": "this is free and unencumbered software released into the public domain",
    "lgpl21-later": (
        "this library is free software you can redistribute it and or modify it under the terms "
        "of the gnu lesser general public license as published by the free software foundation "
        "either version 2 1 of the license or at your option any later version"
    ),
    "lgpl-hope": (
        "this library is distributed in the hope that it will be useful but without any warranty "
        "without even the implied warranty of merchantability or fitness for a particular purpose"
    ),
    "mpl1-contents": (
        "the contents of this file are subject to the mozilla public license version 1 1"
    ),
    "zlib-grant": (
        "permission is granted to anyone to use this software for any purpose including "
        "commercial applications and to alter it and redistribute it freely subject to the "
        "following restrictions"
    ),
    "boost-grant": (
        "permission is hereby granted free of charge to any person or organization obtaining a "
        "copy of the software and accompanying documentation covered by this license the "
        "software to use reproduce display distribute execute and transmit the software and to "
        "prepare derivative works of the software and to permit third parties to whom the "
        "software is furnished to do so all subject to the following"
    ),
    "bsl-see": "distributed under the boost software license version 1 0",
    "epl2-terms": (
        "this program and the accompanying materials are made available under the terms of the "
        "eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0"
    ),
    "cc0-waived": (
        "to the extent possible under law the author has waived all copyright and related or "
        "neighboring rights to this work"
    ),
    "apache2-title": "apache license version 2 0 january 2004",
    "apache2-title-at": "apache license version 2 0 january 2004 http www apache org licenses",
    "gpl3-title": "gnu general public license version 3 29 june 2007",
    "gpl2-title": "gnu general public license version 2 june 1991",
    "lgpl3-title": "gnu lesser general public license version 3 29 june 2007",
    "lgpl21-title": "gnu lesser general public license version 2 1 february 1999",
    "agpl3-title": "gnu affero general public license version 3 19 november 2007",
    "bsl-title": "boost software license version 1 0 august 17th 2003",
}
# Names of licences, in the same plain form, as they stand alone as a title or
# after "licensed under".
NAMES = {
    "MIT": ("mit license", "mit licence", "mit license mit", "mit"),
    "Apache-2.0": (
        "apache license version 2 0", "apache license 2 0", "apache 2 0 license", "apache 2 0",
        "apache license v2 0", "apache software license 2 0",
    ),
    "BSD-2-Clause": ("bsd 2 clause license", "2 clause bsd license", "simplified bsd license"),
    "BSD-3-Clause": (
        "bsd 3 clause license", "3 clause bsd license", "new bsd license", "modified bsd license",
        "revised bsd license",
    ),
    "ISC": ("isc license",),
    "GPL-2.0-only": (
        "gnu general public license version 2", "gnu general public license v2",
        "gnu general public license v2 0", "gnu gpl v2", "gpl v2", "gplv2",
    ),
    "GPL-3.0-only": (
        "gnu general public license version 3", "gnu general public license v3",
        "gnu general public license v3 0", "gnu gpl v3", "gpl v3", "gplv3",
    ),
    "LGPL-2.1-only": (
        "gnu lesser general public license version 2 1", "gnu lesser general public license v2 1",
        "lgpl v2 1", "lgplv2 1",
    ),
    "LGPL-3.0-only": (
        "gnu lesser general public license version 3", "gnu lesser general public license v3",
        "lgpl v3", "lgplv3",
    ),
    "AGPL-3.0-only": (
        "gnu affero general public license version 3", "gnu affero general public license v3",
        "agpl v3", "agplv3",
    ),
    "MPL-2.0": ("mozilla public license version 2 0", "mozilla public license 2 0", "mpl 2 0"),
    "EPL-2.0": ("eclipse public license 2 0", "eclipse public license v 2 0", "epl 2 0"),
    "BSL-1.0": ("boost software license 1 0", "boost software license version 1 0"),
    "Zlib": ("zlib license",),
    "Unlicense": ("unlicense",),
    "CC0-1.0": ("cc0 1 0 universal", "cc0 1 0", "cc0"),
    "CC-BY-4.0": ("creative commons attribution 4 0 international license",),
    "CC-BY-SA-4.0": ("creative commons attribution sharealike 4 0 international license",),
    "OFL-1.1": ("sil open font license version 1 1", "sil open font license 1 1"),
    "WTFPL": ("do what the fuck you want to public license",),
}
# Too short to say anything as a line of its own.
NOT_ALONE = frozenset(("mit", "cc0"))
# Identifiers that a line may name.
SPDX = (
    "MIT", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "ISC", "GPL-2.0-only",
    "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "LGPL-2.1-or-later",
    "LGPL-3.0-or-later", "AGPL-3.0-or-later", "MPL-2.0", "CC-BY-4.0", "CC-BY-SA-4.0",
    "CC-BY-NC-4.0", "CC0-1.0", "Unlicense", "0BSD", "AFL-3.0", "AGPL-3.0-only", "Apache-1.1",
    "Artistic-2.0", "BSD-4-Clause", "BSL-1.0", "CC-BY-3.0", "CC-BY-NC-ND-4.0",
    "CC-BY-NC-SA-4.0", "CC-BY-ND-4.0", "CC-BY-SA-3.0", "CDDL-1.0", "CDDL-1.1", "EPL-1.0",
    "EPL-2.0", "EUPL-1.2", "GPL-1.0-only", "GPL-1.0-or-later", "LGPL-2.0-only",
    "LGPL-2.0-or-later", "LGPL-2.1-only", "LGPL-3.0-only", "MIT-0", "MPL-1.1", "MS-PL", "NCSA",
    "ODbL-1.0", "OFL-1.1", "OpenSSL", "PHP-3.01", "PostgreSQL", "PSF-2.0", "Python-2.0", "Ruby",
    "UPL-1.0", "Vim", "WTFPL", "X11", "Zlib", "curl",
)
# Identifiers that were replaced, and the ones in use now.
DEPRECATED = {
    "GPL-1.0": "GPL-1.0-only", "GPL-2.0": "GPL-2.0-only", "GPL-3.0": "GPL-3.0-only",
    "LGPL-2.0": "LGPL-2.0-only", "LGPL-2.1": "LGPL-2.1-only", "LGPL-3.0": "LGPL-3.0-only",
    "AGPL-3.0": "AGPL-3.0-only",
}
# Exceptions that an identifier may be given with. They are no licences.
EXCEPTIONS = (
    "Classpath-exception-2.0", "LLVM-exception", "GCC-exception-3.1", "Autoconf-exception-3.0",
    "Bison-exception-2.2", "Linux-syscall-note", "OpenSSL-exception", "Font-exception-2.0",
)
# The licence that known sentences stand for, in this order. An earlier
# rule takes its sentences away from later ones, so the more special ones come first.
RULES = (
    ("Apache-2.0", ("apache2-header", "apache2-copy", "apache2-unless", "apache2-see")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("GPL-3.0-or-later", ("gpl3-later", "gpl-hope", "gpl-received")),
    ("GPL-2.0-or-later", ("gpl2-later", "gpl-hope", "gpl-received")),
    ("MIT", ("mit-grant", "mit-notice")),
    ("MPL-2.0", ("mpl2-form", "mpl2-copy")),
    ("LGPL-2.1-or-later", ("lgpl21-later", "lgpl-hope")),
    ("Apache-2.0", ("apache2-header",)),
    ("Apache-2.0", ("apache2-notice",)),
    ("MIT", ("mit-grant",)),
    ("MIT", ("mit-released",)),
    ("MIT", ("mit-licensed",)),
    ("MIT", ("mit-project",)),
    ("ISC", ("isc-grant",)),
    ("GPL-3.0-only", ("gpl3-work",)),
    ("GPL-2.0-only", ("gpl2-work",)),
    ("GPL-3.0-or-later", ("gpl3-later",)),
    ("GPL-2.0-or-later", ("gpl2-later",)),
    ("LGPL-3.0-or-later", ("lgpl3-later",)),
    ("AGPL-3.0-or-later", ("agpl3-later",)),
    ("MPL-2.0", ("mpl2-form",)),
    ("CC-BY-4.0", ("cc-by",)),
    ("CC-BY-SA-4.0", ("cc-by-sa",)),
    ("CC-BY-NC-4.0", ("cc-by-nc",)),
    ("CC-BY-ND-4.0", ("cc-by-nd",)),
    ("CC-BY-NC-SA-4.0", ("cc-by-nc-sa",)),
    ("CC-BY-NC-ND-4.0", ("cc-by-nc-nd",)),
    ("CC-BY-4.0", ("cc-by-work",)),
    ("Unlicense", ("unlicense",)),
    ("LGPL-2.1-or-later", ("lgpl21-later",)),
    ("MPL-1.1", ("mpl1-contents",)),
    ("Zlib", ("zlib-grant",)),
    ("BSL-1.0", ("boost-grant",)),
    ("BSL-1.0", ("bsl-see",)),
    ("EPL-2.0", ("epl2-terms",)),
    ("CC0-1.0", ("cc0-waived",)),
    ("Apache-2.0", ("apache2-title",)),
    ("Apache-2.0", ("apache2-title-at",)),
    ("GPL-3.0-only", ("gpl3-title",)),
    ("GPL-2.0-only", ("gpl2-title",)),
    ("LGPL-3.0-only", ("lgpl3-title",)),
    ("LGPL-2.1-only", ("lgpl21-title",)),
    ("AGPL-3.0-only", ("agpl3-title",)),
    ("BSL-1.0", ("bsl-title",)),
)
# A sentence without one of these is none of the above.
HINT = (
    r"(?i)licen[cs]e|permission|redistribut|free software|\bmpl\b|unencumbered|merchantab|"
    r"\bl?a?gpl|apache 2|cc0|waived|\bepl\b"
)
# The patterns below have no look-around and no possessive parts, so that another engine
# can apply them as they stand.
IDENTIFIER = r"(?i)spdx-license-identifier:"
# Operators of an expression, between identifiers; each of these gets a line's name.
OPERATOR = r"(?i)[ \t]+(?:or|and|with)[ \t]+"
NAMED_ALSO = ". SPDX-License-Identifier: "
LATER = r"([A-Za-z0-9])\+"
# What an identifier line names ends there.
NAMED = r"(?i)(spdx-license-identifier:[ \t]*[A-Za-z0-9.-]+)"
# A line that starts like the middle of a sentence goes on with one that has no end.
WRAPPED = r"([^.!?:\r\n])[ \t]*[\r\n]+[ \t]*([a-z0-9(])"
SENTENCE_END = r"([.!?])[^A-Za-z0-9_ \t\r\n]*[ \t\r\n]+"
OTHER = r"[^a-z0-9]+"
BARRIER = ";"
# Between sentences, and between lines that may be one sentence or two.
HARD, SOFT = "\x01", "\x02"
MARKS = r"[\x01-\x03]"
# A blank line, or one with a comment's marks only. What goes on in lower case may
# belong to what stands before it, as the address of a licence does.
BLANK = r"\n[^A-Za-z0-9\n]*\n[^A-Za-z0-9]*"
NEW_PART = r"\x03([^a-z0-9]|\z)"
NEWLINE = r"\n|\x03"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Whoever is named, the sentence is the same.
HOLDER = (
    r"(?is)\bneither[^a-z0-9]+the[^a-z0-9]+names?[^a-z0-9]+of\b.{1,200}?\bnor[^a-z0-9]+the"
    r"[^a-z0-9]+names?[^a-z0-9]+of[^a-z0-9]+(?:its|their|any|other)[^a-z0-9]+contributors\b"
)
ANY_HOLDER = (
    "neither the name of the copyright holder nor the names of its contributors"
)
# Whatever is licensed, the statement is the same.
STATEMENT = r"^(?:.* (?:is|are) )?(?:licensed|released|distributed|available) under (?:the )?(?:terms of (?:the )?)?"
_SUBJECT = r"(?:(?:[a-z0-9]+JOINT){0,12}?(?:is|are)JOINT)?"
_VERB = r"(?:licensed|released|distributed|available)JOINTunderJOINT(?:theJOINT)?(?:termsJOINTofJOINT(?:theJOINT)?)?"
_TITLE = "(?:theJOINT)?"


def _plain(name: str) -> str:
    return re.sub(OTHER, " ", name.lower()).strip()


def known_sentences() -> dict[str, str]:
    """Sentence to its identifier, the identifier lines of `SPDX` too."""
    known = {text: name for name, text in SENTENCES.items()}
    for name in (*SPDX, *EXCEPTIONS):
        known[f"spdx license identifier {_plain(name)}"] = f"spdx:{name}"
    for old, name in DEPRECATED.items():
        known[f"spdx license identifier {_plain(old)}"] = f"spdx:{old}"
    return known


def known_names() -> dict[str, str]:
    """Licence name, as in a title or a statement, to its identifier."""
    return {name: f"name:{licence}" for licence, names in NAMES.items() for name in names}


def rules() -> list[tuple[str, str]]:
    """(licence, identifiers as they follow one another in a sequence), in order."""
    spdx = [(name, (f"spdx:{name}",)) for name in SPDX]
    spdx += [(now, (f"spdx:{old}",)) for old, now in DEPRECATED.items()]
    named = [(licence, (f"name:{licence}",)) for licence in NAMES]
    return [
        (licence, "".join(f",{name}," for name in names))
        for licence, names in (*RULES, *spdx, *named)
    ]


def any_sentence() -> str:
    """Pattern of the known sentences, titles and statements between two line or sentence
    ends, longest first. Lines may end within a sentence, whatever the next one starts with.
    """

    def any_of(sentences) -> str:
        return "|".join(s.replace(" ", "JOINT") for s in sorted(sentences, key=lambda s: (-len(s), s)))

    names = any_of(known_names())
    alone = any_of(n for n in known_names() if n not in NOT_ALONE)
    parts = [any_of(known_sentences()), f"{_SUBJECT}{_VERB}(?:{names})", f"{_TITLE}(?:{alone})"]
    return rf"\x02({'|'.join(parts)})\x02".replace("JOINT", r"(?: |\x02\x02)")


def sentence_ids(text: Column) -> Column:
    """Identifiers of the known sentences of a text, in order.

    A known sentence starts and ends where a sentence or a line does. Lines within it
    may start with anything, such as the marks of a comment. An expression of several
    identifiers is a sentence for each.
    """
    lines = F.regexp_replace(F.regexp_replace(text, MARKS, " "), r"\r\n?", "\n")

    def expanded(line: Column) -> Column:
        plain = F.regexp_replace(F.regexp_replace(line, r"[()]", " "), LATER, "$1-or-later")
        each = F.regexp_replace(plain, OPERATOR, NAMED_ALSO)
        return F.when(line.rlike(IDENTIFIER), each).otherwise(line)

    apart = F.array_join(F.transform(F.split(lines, "\n", -1), expanded), "\n")
    spelled = F.when(lines.rlike(IDENTIFIER), apart).otherwise(lines)
    ended = F.regexp_replace(spelled, NAMED, "$1.")
    named = F.regexp_replace(ended, HOLDER, ANY_HOLDER)
    joined = F.regexp_replace(named, WRAPPED, "$1 $2")
    cut = F.regexp_replace(joined, SENTENCE_END, f"$1{HARD}")
    blank = F.regexp_replace(F.regexp_replace(cut, BLANK, "\x03"), NEW_PART, f"{HARD}$1")
    parts = F.split(F.regexp_replace(blank, NEWLINE, SOFT), HARD, -1)

    def plain(s: Column) -> Column:
        words = F.regexp_replace(F.translate(s, CAPITALS, CAPITALS.lower()), r"[^a-z0-9\x02]+", " ")
        lined = F.regexp_replace(words, r" ?\x02[ \x02]*", SOFT + SOFT)
        edge = F.lit(SOFT)
        return F.concat(edge, edge, F.trim(lined), edge, edge)

    pattern = F.lit(any_sentence())
    found = F.flatten(
        F.transform(
            F.filter(parts, lambda s: s.rlike(HINT)),
            lambda s: F.regexp_extract_all(plain(s), pattern, F.lit(1)),
        )
    )

    def table(pairs: dict[str, str]) -> Column:
        return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])

    def looked_up(s: Column) -> Column:
        sentence = F.replace(s, F.lit(SOFT + SOFT), F.lit(" "))
        name = F.regexp_replace(F.regexp_replace(sentence, STATEMENT, ""), "^the ", "")
        return F.coalesce(
            F.try_element_at(table(known_sentences()), sentence),
            F.try_element_at(table(known_names()), name),
        )

    return F.transform(found, looked_up)


def licences_of(ids: Column) -> Column:
    """Licences of a sequence of identifiers, in the order of the rules, each once.

    A rule matches where its identifiers follow one another; unknown sentences between
    them don't count. What it matched is cut out, and nothing matches across the cut.
    """
    sequence = F.array_join(F.transform(ids, lambda s: F.concat(F.lit(","), s, F.lit(","))), "")
    start = F.struct(
        sequence.alias("left"), F.array().cast("array<string>").alias("found")
    )
    table = F.array(
        *(F.struct(F.lit(n).alias("licence"), F.lit(p).alias("ids")) for n, p in rules())
    )

    def applied(state: Column, rule: Column) -> Column:
        hit = F.contains(state["left"], rule["ids"])
        found = F.when(hit, F.array_append(state["found"], rule["licence"]))
        return F.struct(
            F.replace(state["left"], rule["ids"], F.lit(BARRIER)).alias("left"),
            found.otherwise(state["found"]).alias("found"),
        )

    return F.array_distinct(F.aggregate(table, start, applied)["found"])


def scan(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Columns `keep` of `docs` with sentence_ids and licences, arrays of text.

    The whole of the column text is read. Null and empty texts, and texts without a
    known sentence, have empty arrays; a known sentence that no rule takes gives no
    licence. Repeated rows get equal answers, an empty table gives no rows. No row is
    shuffled: all that is known is a constant of the plan.
    """
    none = F.array().cast("array<string>")
    ids = F.when(F.col("text").rlike(HINT), sentence_ids(F.col("text"))).otherwise(none)
    found = docs.select(*keep, ids.alias("sentence_ids"))
    some = F.size("sentence_ids") > 0
    return found.withColumn(
        "licences", F.when(some, licences_of(F.col("sentence_ids"))).otherwise(none)
    )


def scan_sql(documents: str = "documents") -> str:
    """DuckDB SQL of `op9_licenses`: the same table of sentences, and a step a rule."""

    def quoted(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    def table(pairs: dict[str, str]) -> str:
        return "MAP {" + ", ".join(f"{quoted(k)}: {quoted(v)}" for k, v in pairs.items()) + "}"

    def swapped(text: str, pattern: str, by: str) -> str:
        return f"regexp_replace({text}, {quoted(pattern)}, {by}, 'g')"

    hard, soft, lines = "chr(1)", "chr(2)", swapped(swapped("text", MARKS, "' '"), r"\r\n?", "chr(10)")
    each = swapped(swapped(swapped("line", "[()]", "' '"), LATER, r"'\1-or-later'"), OPERATOR, quoted(NAMED_ALSO))
    apart = (
        f"array_to_string(list_transform(string_split(lines, chr(10)), lambda line: CASE WHEN "
        f"regexp_matches(line, {quoted(IDENTIFIER)}) THEN {each} ELSE line END), chr(10))"
    )
    spelled = f"CASE WHEN regexp_matches(lines, {quoted(IDENTIFIER)}) THEN {apart} ELSE lines END"
    joined = swapped(swapped(swapped(f"({spelled})", NAMED, r"'\1.'"), HOLDER, quoted(ANY_HOLDER)), WRAPPED, r"'\1 \2'")
    cut = swapped(joined, SENTENCE_END, rf"'\1' || {hard}")
    blank = swapped(swapped(cut, BLANK, "chr(3)"), NEW_PART, rf"{hard} || '\1'")
    words = swapped(f"translate(s, '{CAPITALS}', '{CAPITALS.lower()}')", r"[^a-z0-9\x02]+", "' '")
    lined = swapped(words, r" ?\x02[ \x02]*", f"{soft} || {soft}")
    plain = f"{soft} || {soft} || trim({lined}) || {soft} || {soft}"
    name = swapped(swapped("sentence", STATEMENT, "''"), "^the ", "''")
    steps, last = [], "r0"
    for i, (licence, ids) in enumerate(rules(), 1):
        steps.append(
            f"r{i} AS (SELECT r, replace(rest, {quoted(ids)}, '{BARRIER}') AS rest, "
            f"CASE WHEN contains(rest, {quoted(ids)}) AND NOT list_contains(found, "
            f"{quoted(licence)}) THEN list_append(found, {quoted(licence)}) ELSE found END "
            f"AS found FROM {last})"
        )
        last = f"r{i}"
    return rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, text FROM {documents}),
clean AS (
    SELECT r, {lines} AS lines FROM docs WHERE regexp_matches(text, {quoted(HINT)})
), parts AS (
    SELECT r, unnest(p) AS s, generate_subscripts(p, 1) AS nth
    FROM (SELECT r, string_split({swapped(blank, NEWLINE, soft)}, {hard}) AS p FROM clean)
), found AS (
    SELECT r, nth, unnest(f) AS f, generate_subscripts(f, 1) AS place
    FROM (SELECT r, nth, regexp_extract_all({plain}, {quoted(any_sentence())}, 1) AS f
          FROM parts WHERE regexp_matches(s, {quoted(HINT)}))
), sentences AS (
    SELECT r, nth, place, replace(f, {soft} || {soft}, ' ') AS sentence FROM found
), ids AS (
    SELECT r, nth, place, coalesce(known[sentence], names[{name}]) AS name
    FROM sentences, (SELECT {table(known_sentences())} AS known, {table(known_names())} AS names)
), r0 AS (
    SELECT r, string_agg(',' || name || ',', '' ORDER BY nth, place) AS rest,
           CAST([] AS VARCHAR[]) AS found
    FROM ids GROUP BY r
), {", ".join(steps)}, lists AS (
    SELECT r, string_agg(name, ',' ORDER BY nth, place) AS sentence_ids, count(*) AS n
    FROM ids GROUP BY r
)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_sentences,
       coalesce(sentence_ids, '') AS sentence_ids,
       coalesce(array_to_string(found, ','), '') AS licenses
FROM docs LEFT JOIN lists USING (r) LEFT JOIN {last} USING (r)
"""
