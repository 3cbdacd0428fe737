"""Licence scan by canonical digests.

A text is normalised (case, punctuation, copyright lines, equivalent
spellings), its digest taken over the entire normalised text, and the digest
joined to those of known licences.  Units are whole documents, their
paragraphs (between blank lines) and their lines, so a notice that stands
alone on a line, or is wrapped over several, is found too.

``KNOWN`` holds short licences in full and the standard notices of the long
ones; the full texts of those come from a table of (license, text) rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import ascii_lower

#: Equivalent spellings, applied in this order after lower-casing.
SPELLINGS = [
    ("licence", "license"), ("sub-license", "sublicense"), ("non-commercial", "noncommercial"),
    ("copyright owner", "copyright holder"), ("organisation", "organization"), ("merchantibility", "merchantability"),
    ("per cent", "percent"), ("https", "http"), ("&", " and "), ("version ", "v"),
]

_NO_WARRANTY = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO
EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR
CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR
BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING
NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in
the documentation and/or other materials provided with the distribution.
"""
_BSD_NAMES = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from
this software without specific prior written permission.
"""


def _gnu(name: str, version: str, later: bool, work: str = "This program") -> list[str]:
    """The two paragraphs of the notice that the GNU licences ask for."""
    which = f"either version {version} of the License, or (at your option) any later version" if later else f"version {version} of the License"
    return [f"{work} is free software: you can redistribute it and/or modify it under the terms of the {name} as published by the Free "
            f"Software Foundation, {which}.",
            f"{work} is free software; you can redistribute it and/or modify it under the terms of the {name} as published by the Free "
            f"Software Foundation; {which}."]


#: Known notices and short licences (public texts).
KNOWN = [
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("MIT", "Released under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
with the License. You may obtain a copy of the License at"""),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"""),
    ("Apache-2.0", """Unless required by applicable law or agreed to in writing, software distributed under the License is distributed
on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
governing permissions and limitations under the License."""),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""),
    ("CC0-1.0", """To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this
software to the public domain worldwide. This software is distributed without any warranty."""),
    ("BSD-2-Clause", f"{_BSD}\n{_NO_WARRANTY}"), ("BSD-3-Clause", f"{_BSD}{_BSD_NAMES}\n{_NO_WARRANTY}"),
    ("Zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for
any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute
it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this
software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""),
    ("0BSD", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY
DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION,
ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("Unlicense", """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled
binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the
software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and
successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software
under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR
OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE
OR OTHER DEALINGS IN THE SOFTWARE.

For more information, please refer to <https://unlicense.org>"""),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software,
and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""),
    *[(f"{short}-{v if '.' in v else v + '.0'}-{'or-later' if later else 'only'}", text) for short, name, versions in (
        ("GPL", "GNU General Public License", ("2", "3")), ("LGPL", "GNU Lesser General Public License", ("2.1", "3")),
        ("AGPL", "GNU Affero General Public License", ("3",))) for v in versions for later in (True, False) for text in _gnu(name, v, later)],
    *[(name, f"SPDX-License-Identifier: {name}") for name in (
        "MIT", "ISC", "0BSD", "Zlib", "Unlicense", "CC0-1.0", "BSD-2-Clause", "BSD-3-Clause", "Apache-2.0", "MPL-2.0", "GPL-2.0-only",
        "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only",
        "LGPL-3.0-or-later", "AGPL-3.0-only", "AGPL-3.0-or-later", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0")],
]
SMALL = 100_000  # known digests that may be sent to every task


def canonical_lines(text: Column) -> Column:
    """Canonical form line by line: lower case, copyright lines emptied, spellings unified, punctuation to a space."""
    t = F.lower(text)
    t = F.regexp_replace(t, r"(?m)^[ \t*#/;-]*(?:copyright[ \t]*(?:\(c\)|©|[0-9:])|\(c\)|©)[^\n]*$", " ")
    for a, b in SPELLINGS:
        t = F.replace(t, F.lit(a), F.lit(b))
    return F.regexp_replace(t, r"[\x00-\x09\x0B-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", " ")


def digest(lines: Column) -> Column:
    """md5 of an entire canonical text on one line; NULL for NULL and for texts with nothing left."""
    t = F.trim(F.regexp_replace(F.replace(lines, F.lit("\n"), F.lit(" ")), "  +", " "))
    return F.md5(F.nullif(t, F.lit("")).cast("binary"))


def known_digests(spark: SparkSession, known: list[tuple[str, str]] | DataFrame = KNOWN) -> DataFrame:
    """(digest, license) of known texts, a list or a table (license, text); one digest keeps its smallest licence name."""
    rows = known if isinstance(known, DataFrame) else spark.createDataFrame(known, "license string, text string")
    return rows.select(digest(canonical_lines(F.col("text"))).alias("digest"), "license").filter("digest is not null").groupBy(
        "digest").agg(F.min("license").alias("license"))


def scan_units(units: DataFrame, known: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """Units whose entire text is a known licence: ``keys`` and license (digest equi-join)."""
    lines = units.select(*keys, canonical_lines(F.col(text)).alias("_lines"))
    return _matched(lines, _sized(known), keys, "_lines")


def _sized(known: DataFrame) -> DataFrame:
    """Known digests, sent to every task if they are few (counted), so that units stay where they are."""
    k = known.select(F.col("digest").alias("_digest"), F.col("license"))
    return F.broadcast(k) if known.limit(SMALL + 1).count() <= SMALL else k


def _matched(units: DataFrame, known: DataFrame, keys: list[str], lines: str) -> DataFrame:
    return units.select(*keys, digest(F.col(lines)).alias("_digest")).join(known, "_digest").select(*keys, "license")


def scan_documents(docs: DataFrame, known: DataFrame) -> DataFrame:
    """Per document: doc_id, whole_license (its entire text), line_licenses (sorted, distinct), n_lines_matched,
    and paragraph_licenses, n_paragraphs_matched of its paragraphs of several lines.

    Every input row gives one row, repeated rows too.  NULL and empty texts
    match nothing.  A line that occurs twice in a document counts twice.
    Paragraphs end at lines without anything but punctuation.
    """
    few = _sized(known)
    d = docs.select("doc_id", F.xxhash64("text").alias("h"), canonical_lines(F.col("text")).alias("c"))
    line = F.transform(F.split("c", "\n"), lambda x, i: F.struct(i.alias("i"), x.alias("unit"), F.lit(False).alias("wrapped")))
    part = F.transform(F.split("c", r"\n *(?:\n *)+"), lambda x, i: F.struct(i.alias("i"), x.alias("unit"), F.lit(True).alias("wrapped")))
    part = F.filter(part, lambda x: F.instr(x["unit"], "\n") > 0)
    units = d.select("doc_id", "h", F.explode(F.concat(line, part)).alias("u")).select("doc_id", "h", "u.*")
    found = _matched(units, few, ["doc_id", "h", "i", "wrapped"], "unit").groupBy("doc_id", "h")
    names = lambda which: F.sort_array(F.collect_set(F.when(which, F.col("license"))))
    wrapped = F.col("wrapped")
    found = found.agg(names(~wrapped).alias("line_licenses"), F.count_distinct(F.when(~wrapped, F.col("i"))).alias("n_lines_matched"),
                      names(wrapped).alias("paragraph_licenses"), F.count_distinct(F.when(wrapped, F.col("i"))).alias("n_paragraphs_matched"))
    whole = d.select("doc_id", "h", digest(F.col("c")).alias("_digest")).join(
        few.withColumnRenamed("license", "whole_license"), "_digest", "left")
    w, n = whole.alias("w"), found.alias("n")
    text = lambda c: F.coalesce(F.array_join(f"n.{c}", ","), F.lit("")).alias(c)
    number = lambda c: F.coalesce(f"n.{c}", F.lit(0)).cast("bigint").alias(c)
    return w.join(n, F.col("w.doc_id").eqNullSafe(F.col("n.doc_id")) & (F.col("w.h") == F.col("n.h")), "left").select(
        "w.doc_id", "w.whole_license", text("line_licenses"), number("n_lines_matched"), text("paragraph_licenses"),
        number("n_paragraphs_matched"))
