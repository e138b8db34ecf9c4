"""Licence scan: canonical digest lookup.

Known licence texts and statements, and the whole text, paragraphs and lines
of every document, are brought to one canonical form: lower case, copyright
lines dropped, punctuation and white space as one space, equivalent spellings
unified. Documents' units are hash-joined to the known texts by the SHA-256 of
that form, so a unit counts only if it equals a known text entirely.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortwise.functions.literals import literal_table

# Licence texts and statements, by their public identifiers.
_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES
OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE
FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION
WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_BSD_WARRANTY = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT
SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES
(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION)
HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING
IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_BSD_TWO = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
documentation and/or other materials provided with the distribution."""
_ISC_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE
OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""


def _gnu(name: str, versions: str, program: str = "This program") -> str:
    """The notice by which a file is put under a GNU licence."""
    return f"""{program} is free software: you can redistribute it and/or modify it under the terms of the {name} as published by the Free
Software Foundation, {versions}

{program} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {name} for more details.

You should have received a copy of the {name} along with this program. If not, see <https://www.gnu.org/licenses/>."""


KNOWN = [
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify,
merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to
do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

""" + _WARRANTY),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies.

""" + _ISC_WARRANTY),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions
and limitations under the License."""),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC0-1.0", "Released under CC0 1.0 Universal."),
    ("BSD-2-Clause", _BSD_TWO + "\n\n" + _BSD_WARRANTY),
    ("BSD-3-Clause", _BSD_TWO + """

3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this
software without specific prior written permission.

""" + _BSD_WARRANTY),
    ("0BSD", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.

""" + _ISC_WARRANTY),
    ("MIT-0", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify,
merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to
do so.

""" + _WARRANTY),
    ("Zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for
any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute
it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this
software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution."""),
    ("BSL-1.0", """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and
accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the
Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all
subject to the following:

The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following
disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such
copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE
DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR
IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("Unlicense", """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled
binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the
software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and
successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software
under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR
OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR
OTHER DEALINGS IN THE SOFTWARE.

For more information, please refer to <https://unlicense.org>"""),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""),
    ("GPL-3.0-or-later", _gnu("GNU General Public License", "either version 3 of the License, or (at your option) any later version.")),
    ("GPL-2.0-or-later", _gnu("GNU General Public License", "either version 2 of the License, or (at your option) any later version.")),
    ("LGPL-3.0-or-later", _gnu("GNU Lesser General Public License",
                               "either version 3 of the License, or (at your option) any later version.")),
    ("AGPL-3.0-or-later", _gnu("GNU Affero General Public License",
                               "either version 3 of the License, or (at your option) any later version.")),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under CC BY-SA 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    *[(name, f"SPDX-License-Identifier: {name}") for name in (
        "MIT", "ISC", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "0BSD", "MIT-0", "Zlib", "BSL-1.0", "Unlicense", "MPL-2.0",
        "GPL-2.0-or-later", "GPL-3.0-or-later", "LGPL-3.0-or-later", "AGPL-3.0-or-later", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0")],
]
# Spellings that count as equal, the second form being kept.
SPELLINGS = [("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("sub license", "sublicense"),
             ("sub licence", "sublicense"), ("acknowledgement", "acknowledgment"), ("favour", "favor"), ("honour", "honor"),
             ("whilst", "while"), ("non infringement", "noninfringement"), ("non commercial", "noncommercial"),
             ("copyright owner", "copyright holder"), ("copyright owners", "copyright holders"), ("per cent", "percent"),
             ("https", "http"), ("v2 0", "version 2 0"), ("v3", "version 3")]
COPYRIGHT_LINE = r"\n[ \t]*(copyright|\(c\)|©)[^\n]*"
# A notice names a year, a sign or a holder; a body line that happens to be wrapped before "copyright notice" is none.
_BODY = r"(?![ \t,]+(?:notices?|holders?|owners?|licen[cs]es?|statements?|laws?|patents?|and|or)\b)"
NOTICE_LINE = rf"\n[ \t]*(?:copyright\b(?![ \t]*(?:\n|$)){_BODY}|\(c\){_BODY}|©)[^\n]*"
# Title lines of the standard files.
TITLES = {"MIT": ["MIT License", "The MIT License", "The MIT License (MIT)"],
          "ISC": ["ISC License", "The ISC License", "ISC License (ISC)"],
          "BSD-2-Clause": ["BSD 2-Clause License", "The 2-Clause BSD License"],
          "BSD-3-Clause": ["BSD 3-Clause License", "The 3-Clause BSD License"],
          "MIT-0": ["MIT No Attribution"], "Zlib": ["zlib License", "The zlib License"], "0BSD": ["BSD Zero Clause License"],
          "BSL-1.0": ["Boost Software License - Version 1.0 - August 17th, 2003"]}


def unix_lines(text: Column) -> Column:
    return F.replace(text, F.lit("\r\n"), F.lit("\n"))


def plain(text: Column) -> Column:
    """Lower case without copyright notices, everything but letters, digits and
    line ends as single spaces. Starts with a line end."""
    kept = F.regexp_replace(F.concat(F.lit("\n"), F.lower(unix_lines(text))), NOTICE_LINE, "\n ")
    return F.regexp_replace(kept, r"[^\p{L}\p{N}\n]+", " ")


def unified(unit: Column) -> Column:
    """A plain line with equivalent spellings unified."""
    unit = F.concat(F.lit(" "), F.trim(unit), F.lit(" "))
    for variant, kept in SPELLINGS:
        unit = F.replace(unit, F.lit(f" {variant} "), F.lit(f" {kept} "))
    return F.trim(unit)


def one_line(unit: Column) -> Column:
    return F.regexp_replace(unit, "[ \n]+", " ")


def canonical(text: Column) -> Column:
    """The canonical form; empty if nothing but copyright lines and punctuation is left."""
    return unified(one_line(plain(text)))


def first_word(unit: Column) -> Column:
    return F.regexp_extract(unit, "[^ \\n]+", 0)


def known_digests(spark: SparkSession, known: list[tuple[str, str]] = KNOWN) -> DataFrame:
    """``licence, digest, first`` (its first word) of the known texts, full texts also under their titles."""
    titled = [(i, f"{title}\n\n{t}") for i, t in known if "\n\n" in t for title in TITLES.get(i, [])]
    given = literal_table(spark, known + titled, "licence string, text string")
    return given.select("licence", canonical(F.col("text")).alias("form")).select(
        "licence", F.sha2("form", 256).alias("digest"), first_word(F.col("form")).alias("first")).distinct()


def units(text: Column, form: Column) -> Column:
    """(kind, unit) structs of a text, given with its plain form: the whole,
    its paragraphs, its lines."""
    def of(kind, parts):
        return F.transform(parts, lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("unit")))

    paragraphs = F.when(F.contains(text, F.lit("\n\n")), F.split(form, "\n\n+")).otherwise(F.array().cast("array<string>"))
    return F.concat(of("whole", F.array(form)), of("paragraph", paragraphs),
                    of("line", F.split(F.substring(form, 2, 2**31 - 1), "\n")))


def scan(docs: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, whole_licence, licences, n_units``.

    ``whole_licence``: the licence that the whole text is, else null;
    ``licences``: sorted distinct licences of all its units, joined by commas;
    ``n_units``: units that are a known text. Null and empty texts match
    nothing. Rows that repeat, also with a null id, are each answered alike.
    If known texts of two licences agree, the first by name is the whole's.
    Texts of any length are canonicalised whole; an empty table gives an
    empty result; other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.withColumn("row", F.sha2(F.to_json(F.struct("doc_id", F.xxhash64("text").alias("x"), F.length("text").alias("n"))), 256))
    each = rows.select("row", "text", plain(F.coalesce("text", F.lit(""))).alias("form")).select(
        "row", F.posexplode(units(unix_lines(F.coalesce("text", F.lit(""))), F.col("form"))).alias("nth", "u")).select(
        "row", "nth", "u.kind", "u.unit", first_word(F.col("u.unit")).alias("word"))
    # a unit equal to a known text begins with its first word, or with a spelling that may become it
    begins = known.select("first").union(literal_table(
        docs.sparkSession, sorted({(variant.split()[0],) for variant, _ in SPELLINGS}), "first string")).distinct()
    # Null-safe keys: a plain one is first tested for null, below both joins, which would compute the digest of every unit
    some = each.join(F.broadcast(begins), F.col("word").eqNullSafe(F.col("first")), "left_semi")
    hits = some.select("row", "nth", "kind", F.sha2(unified(one_line(F.col("unit"))), 256).alias("form")).join(
        F.broadcast(known.select("licence", "digest")), F.col("form").eqNullSafe(F.col("digest")))
    # a repeated row finds its units as often as it occurs: count them once
    found = hits.select("row", "nth", "kind", "licence").distinct().groupBy("row").agg(
        F.min(F.when(F.col("kind") == "whole", F.col("licence"))).alias("whole_licence"),
        F.array_join(F.sort_array(F.collect_set("licence")), ",").alias("licences"), F.count(F.lit(1)).alias("n_units"))
    return rows.select("doc_id", "row").join(found, "row", "left").select(
        "doc_id", "whole_licence", F.coalesce("licences", F.lit("")).alias("licences"), F.coalesce("n_units", F.lit(0)).cast("long").alias("n_units"))


def oracle_sql(known: list[tuple[str, str]] = KNOWN) -> str:
    def form(x):
        x = f"regexp_replace(chr(10) || lower({x}), '{COPYRIGHT_LINE}', chr(10) || ' ', 'g')"
        x = f"' ' || trim(regexp_replace({x}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) || ' '"
        for variant, kept in SPELLINGS:
            x = f"replace({x}, ' {variant} ', ' {kept} ')"
        return f"trim({x})"

    values = ", ".join("('%s', '%s')" % (i, t.replace("'", "''")) for i, t in known)
    return f"""WITH known AS (SELECT DISTINCT licence, {form('text')} AS form FROM (VALUES {values}) v(licence, text)),
        d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
        units AS (SELECT doc_id, 'whole' AS kind, text AS unit FROM d
            UNION ALL SELECT doc_id, 'paragraph', unnest(regexp_split_to_array(text, '\\n\\n+')) FROM d WHERE contains(text, chr(10) || chr(10))
            UNION ALL SELECT doc_id, 'line', unnest(string_split(text, chr(10))) FROM d),
        hits AS (SELECT doc_id, kind, licence FROM (SELECT doc_id, kind, {form('unit')} AS form FROM units) JOIN known USING (form) WHERE form <> '')
        SELECT doc_id, min(licence) FILTER (kind = 'whole') AS whole_licence,
               coalesce(array_to_string(list_sort(list(DISTINCT licence) FILTER (licence IS NOT NULL)), ','), '') AS licences,
               count(licence) AS n_units
        FROM d LEFT JOIN hits USING (doc_id) GROUP BY doc_id"""
