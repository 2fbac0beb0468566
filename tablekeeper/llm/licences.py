"""Licence scans by digests of whole normalised texts.

A text, each of its paragraphs, each of its lines, and each run of as many paragraphs as a known text has, is brought to a canonical
form: lower case, no copyright lines, no punctuation, one spelling for equivalent words. The digest of that form is joined with the digests of known licence texts and notices. All is
done in DataFrame functions; the known digests are a table of fixed size.
"""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekeeper.llm import repeats

#: Notices by which texts name their licence, with the licence's short name.
NOTICES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("Apache-2.0", "This project is licensed under the Apache License 2.0."),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
]
_PERMISSION = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_ISC_END = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD_START = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_THIRD = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission."""
_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO
EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS
INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR
OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
#: Whole licence texts.
TEXTS = [
    ("ISC", f"{_PERMISSION}, provided that the above copyright notice and this permission notice appear in all copies.\n\n{_ISC_END}"),
    ("0BSD", f"{_PERMISSION}.\n\n{_ISC_END}"),
    ("BSD-2-Clause", f"{_BSD_START}\n\n{_BSD_END}"),
    ("BSD-3-Clause", f"{_BSD_START}\n{_BSD_THIRD}\n\n{_BSD_END}"),
    (
        "MIT",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify,
merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to
do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR
ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH
THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ),
    (
        "Zlib",
        """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for
any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and
redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this
software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.""",
    ),
]
#: Titles that stand above the texts of TEXTS.
TITLES = {
    "ISC": ["ISC License", "The ISC License", "ISC License (ISC)"],
    "0BSD": ["Zero-Clause BSD", "BSD Zero Clause License", "Zero-Clause BSD License (0BSD)"],
    "BSD-2-Clause": [
        "BSD 2-Clause License",
        "The 2-Clause BSD License",
        'BSD 2-Clause "Simplified" License',
        "Simplified BSD License",
        "BSD License",
    ],
    "BSD-3-Clause": [
        "BSD 3-Clause License",
        "The 3-Clause BSD License",
        'BSD 3-Clause "New" or "Revised" License',
        "New BSD License",
        "Modified BSD License",
        "BSD License",
    ],
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)", "Expat License"],
    "Zlib": ["zlib License", "The zlib License", "zlib/libpng License"],
}
_GNU = """This {thing} is free software{colon} you can redistribute it and/or modify it under the terms of the GNU {kind}General Public License as
published by the Free Software Foundation, {version}."""
_GNU_ONCE = [("3", "either version 3 of the License, or (at your option) any later version", "or-later"), ("3", "version 3", "")]
_GNU_ONCE += [(v, f"either version {v} of the License, or (at your option) any later version", "or-later") for v in ("2", "2.1")]
_GNU_ONCE += [("3", "version 3 of the License", ""), ("2", "version 2", ""), ("2", "version 2 of the License", "")]
#: Notices that stand at the head of source files.
HEADERS = [
    (
        "Apache-2.0",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.
You may obtain a copy of the License at

http{s}://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions
and limitations under the License.""".replace("{s}", s),
    )
    for s in ("", "s")
]
HEADERS += [
    (
        "MPL-2.0",
        f"""This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with
this file, You can obtain one at http{s}://mozilla.org/MPL/2.0/.""",
    )
    for s in ("", "s")
]
HEADERS += [
    ("-".join(filter(None, [f"{short}-{v if '.' in v else v + '.0'}", later])), _GNU.format(thing=t, colon=c, kind=kind, version=text))
    for short, kind, versions in (("GPL", "", "23"), ("LGPL", "Lesser ", ("2.1", "3")), ("AGPL", "Affero ", "3"))
    for v, text, later in _GNU_ONCE
    if v in versions
    for t in ("program", "library", "software", "file")
    for c in (":", ";")
]
#: Whole texts, <name>.txt, and the SPDX identifiers, one a line.
FOLDER = Path(__file__).parent / "licence_texts"
_TERMS_END = "END OF TERMS AND CONDITIONS"
#: Lines that only state who holds the copyright, as a pattern of lower-case text.
COPYRIGHT_LINE = r"(?m)^[ \t]*(copyright|\(c\)|©|all rights reserved)[^\n]*$"
#: The holder's part of such a line alone. What a sentence of its own says after it stays, and so does a wrapped line
#: that goes on about "copyright notice", or an item (c).
_GOES_ON = "notice|holder|owner|law|licen|interest|statement|disclaimer|treat|protect|infring|permission|(and|or|to|in|on|is|of|as|that|for) "
_NEXT = "permission|redistribution|licen[sc]ed|released|distributed|this (work|project|program|software|file|source|library)|spdx-licen"
HOLDER = (
    rf"(?m)^[ \t]*(copyright[ \t]*(\(c\)|©)|(\(c\)|©)[ \t]*[0-9]{{4}}|copyright[ \t]+(?!{_GOES_ON})|all rights reserved)"
    rf"[^\n]*?([.,;]?[ \t]+(?=({_NEXT}))|$)"
)
#: Pattern of a spelling in canonical words, and the one it stands for.
SPELLINGS = [
    (r"\blicenc(e|ed|es|ing)\b", "licens$1"),
    (r"\b(sub) (licens)", "$1$2"),
    (r"\bnon (infringement|commercial)\b", "non$1"),
    (r"\b(acknowledg)ement", "$1ment"),
    (r"\b(author|organ)is", "$1iz"),
    (r"\b(favo|behavio)ur", "$1r"),
    (r"\bversion ([0-9])", "$1"),
    (r"\bv([0-9])", "$1"),
    (r"\bcopyright owner", "copyright holder"),
    (r"\band or\b", "or"),
    (r"\bcc by\b", "creative commons attribution"),
]


#: Beginnings of texts that a spelling may turn into another beginning; see SPELLINGS.
RESPELLED = ("and", "cc ", "ver", "v0", "v1", "v2", "v3", "v4", "v5", "v6", "v7", "v8", "v9")
START = 3
LONG_START = 8


def plain(text: Column, without: str = COPYRIGHT_LINE) -> Column:
    """Lower case, without copyright lines, and with spaces for all but letters, digits and line ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(text), without, ""), r"[^\p{L}\p{N}\n ]+", " ")


def versions(text: Column) -> Column:
    """The plain text without copyright lines and, where it has any, also the one without their holders only."""
    first = plain(text)
    return F.when(F.lower(text).rlike(COPYRIGHT_LINE), F.array(first, plain(text, HOLDER))).otherwise(F.array(first))


def canonical(part: Column) -> Column:
    """Plain text in one line and one spelling."""
    out = F.trim(F.regexp_replace(part, r"[ \n]+", " "))
    for pattern, spelling in SPELLINGS:
        out = F.regexp_replace(out, pattern, spelling)
    return out


def more_known() -> list[tuple[str, str]]:
    """Known texts beyond NOTICES and TEXTS: all SPDX identifiers, headers of source files, titled and long texts."""
    # A version "only" has the short name of the text.
    ids = [(i.removesuffix("-only"), f"SPDX-License-Identifier: {i}") for i in (FOLDER / "spdx_ids.txt").read_text().split() if "+" not in i]
    titled = [(name, f"{title}\n\n{text}") for name, text in TEXTS for title in TITLES[name]]
    whole = [(f.stem, f.read_text()) for f in sorted(FOLDER.glob("*.txt")) if f.stem != "spdx_ids"]
    whole += [(name, text[: text.index(_TERMS_END) + len(_TERMS_END)]) for name, text in whole if _TERMS_END in text]
    return ids + HEADERS + titled + whole


def known_licences(spark: SparkSession, known: list[tuple[str, str]] | None = None) -> DataFrame:
    """`_digest`, `licence`, `_start`, the first characters, and `_n`, the paragraphs, of the known texts; those that say the same are one."""
    rows = NOTICES + TEXTS + more_known() if known is None else known
    form = canonical(F.col("_form"))
    # Many lines begin with "the".
    start = F.substring(form, 1, F.when(form.startswith("the "), LONG_START).otherwise(START))
    frame = spark.createDataFrame(rows, "licence string, text string").select("licence", F.explode(versions(F.col("text"))).alias("_form"))
    n = F.size(paragraphs(F.col("_form")))
    return frame.select(F.md5(form).alias("_digest"), "licence", start.alias("_start"), n.alias("_n")).distinct()


def parts(text: Column) -> Column:
    """A plain text as a whole, its paragraphs (between lines without a letter or digit) and its lines."""
    return F.concat(F.array(text), F.split(text, r"\n *\n"), F.split(text, "\n"))


def paragraphs(text: Column) -> Column:
    """The paragraphs of a plain text that hold a letter or digit."""
    return F.filter(F.split(text, r"\n *\n"), lambda x: F.trim(F.translate(x, "\n", " ")) != "")


def identifiers(text: Column) -> Column:
    """The operands of the SPDX expressions of a text, each as a notice of its own and plain; of one that is a single id none.

    `X+` is X-or-later for the GNU licences, whose ids say so, and X for others. Exceptions behind WITH are no licences.
    """
    found = F.regexp_extract_all(text, F.lit(r"(?i)SPDX-License-Identifier:[ \t]*([^\n]*)"), F.lit(1))
    parted = F.transform(found, lambda e: F.split(e, r"(?i)[ \t]+(?:or|and|with)[ \t]+|[()]+"))
    several = F.filter(parted, lambda p: (F.size(p) > 1) | F.contains(p[0], F.lit("+")))

    def notice(operand: Column) -> Column:
        name = F.regexp_replace(F.trim(operand), r"(?i)^([al]?gpl-[0-9.]+|gfdl-[0-9.]+)\+.*$", "$1-or-later")
        return plain(F.concat(F.lit("SPDX-License-Identifier: "), F.regexp_replace(name, r"\+", "")))

    none = F.array().cast("array<string>")
    return F.when(F.contains(F.lower(text), F.lit("spdx-license-identifier:")), F.transform(F.flatten(several), notice)).otherwise(none)


def _begins(starts: list[str]) -> str:
    return "^(" + "|".join(re.escape(x).replace(r"\ ", " +") for x in starts if x) + ")"


def _flat(part: Column) -> Column:
    return F.ltrim(F.translate(part, "\n", " "))


def runs(of: Column, lengths: dict[str, list[int]]) -> Column:
    """Runs of paragraphs that begin like a known text of several paragraphs and have as many."""
    if not lengths:
        return F.array().cast("array<string>")

    def known(part: Column) -> Column:
        none = F.array().cast("array<int>")
        found = [F.when(_flat(part).rlike(_begins([s])), F.array(*map(F.lit, sorted(n)))).otherwise(none) for s, n in lengths.items()]
        return F.flatten(F.array(*found))

    def at(part: Column, i: Column) -> Column:
        fits = F.filter(known(part), lambda n: i + n <= F.size(of))
        joined = F.transform(fits, lambda n: F.array_join(F.slice(of, i + 1, n), "\n"))
        return F.when(_flat(part).rlike(_begins(list(lengths))), joined).otherwise(F.array().cast("array<string>"))

    return F.flatten(F.transform(of, at))


def scan(docs: DataFrame, known: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`doc_id`, `licences` (names in order, by commas), `n_licences` and `whole_text` (the text as a whole is a licence) per row.

    SPDX expressions count as the identifiers they hold. Null, empty and punctuation-only texts have none. A row of equal id and text as another has the same result. `known` has one row
    per known text and is broadcast: its size does not depend on the documents. Only parts that begin like a known text, or
    with what a spelling may change, are spelled and hashed; no other could match.
    """
    firsts = known.select("_start", "_n").distinct().collect()
    begins = _begins(sorted({r[0] for r in firsts} | set(RESPELLED)))
    lengths: dict[str, list[int]] = {}
    for start, n in sorted(firsts):
        if start and n > 1:
            lengths.setdefault(start, []).append(n)
    keyed = repeats.keyed(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "doc_id", "text")
    named = identifiers(F.col("text")).alias("_identifiers")
    whole = keyed.filter("text IS NOT NULL").select("_id", "_th", named, F.posexplode(versions(F.col("text"))).alias("_v", "_all"))
    whole = whole.select("_id", "_th", "_v", "_all", "_identifiers", paragraphs(F.col("_all")).alias("_paragraphs"))
    likely = F.filter(parts(F.col("_all")), lambda x: _flat(x).rlike(begins))
    likely = F.concat(likely, runs(F.col("_paragraphs"), lengths), F.col("_identifiers"))
    pieces = whole.select("_id", "_th", "_v", "_all", F.explode(likely).alias("_part"))
    is_all, digest = F.col("_part") == F.col("_all"), F.md5(canonical(F.col("_part")))
    pieces = pieces.select("_id", "_th", "_v", is_all.alias("_is_all"), digest.alias("_digest"))
    hits = pieces.join(F.broadcast(known.select("_digest", "licence").distinct()), "_digest")
    each = F.collect_set(F.struct("_v", "licence", "_is_all"))
    found = hits.groupBy("_id", "_th").agg(each.alias("_hits"), F.max("_is_all").alias("_whole"))
    # A whole text that is a licence is that licence, even where it quotes a notice, as the GPL does.
    own = F.filter("_hits", lambda h: h["_is_all"] | ~F.exists("_hits", lambda g: g["_is_all"] & (g["_v"] == h["_v"])))
    found = found.select("_id", "_th", F.array_distinct(F.transform(own, lambda h: h["licence"])).alias("_names"), "_whole")
    rows = keyed.select("doc_id", "_id", "_th").join(found, ["_id", "_th"], "left")
    names = F.coalesce(F.array_sort("_names"), F.array().cast("array<string>"))
    return rows.select(
        "doc_id",
        F.array_join(names, ",").alias("licences"),
        F.size(names).cast("long").alias("n_licences"),
        F.coalesce("_whole", F.lit(False)).alias("whole_text"),
    )


def scan_sql(known: list[tuple[str, str]] | None = None) -> str:
    """The scan for NOTICES and TEXTS of the table documents as SQL for DuckDB, which spells and hashes every part."""

    def flat(text: str) -> str:
        return rf"regexp_replace(regexp_replace(lower({text}), '{COPYRIGHT_LINE}', '', 'g'), '[^\p{{L}}\p{{N}}\n ]+', ' ', 'g')"

    def form(part: str) -> str:
        out = rf"trim(regexp_replace({part}, '[ \n]+', ' ', 'g'))"
        for pattern, spelling in SPELLINGS:
            out = f"regexp_replace({out}, '{pattern}', '{spelling.replace('$', chr(92))}', 'g')"
        return f"md5({out})"

    rows = ", ".join("('{}', '{}')".format(*(v.replace("'", "''") for v in r)) for r in (NOTICES + TEXTS if known is None else known))
    return rf"""WITH known AS (SELECT DISTINCT {form(flat("text"))} AS digest, licence FROM (VALUES {rows}) k(licence, text)),
    plain AS (SELECT doc_id, {flat("text")} AS whole FROM documents WHERE text IS NOT NULL),
    parts AS (SELECT doc_id, whole, unnest([whole] || regexp_split_to_array(whole, '\n *\n') || string_split(whole, chr(10))) AS part
        FROM plain),
    hits AS (
        SELECT doc_id, string_agg(DISTINCT licence, ',' ORDER BY licence) AS licences, count(DISTINCT licence) AS n_licences,
            bool_or(part = whole) AS whole_text FROM parts JOIN known ON {form("part")} = digest GROUP BY doc_id)
    SELECT d.doc_id, coalesce(licences, '') AS licences, coalesce(n_licences, 0) AS n_licences,
        coalesce(whole_text, false) AS whole_text FROM documents d LEFT JOIN hits ON hits.doc_id = d.doc_id"""
