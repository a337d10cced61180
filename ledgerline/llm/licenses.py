"""Licence scan by canonical digests.

A text is put into a canonical form (lower case, no copyright lines, one spelling of equivalent
words, no punctuation, single spaces) and hashed; entire units (the document, its paragraphs, its
lines) meet known licences only by an equality join on that digest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Spellings taken as equal, in canonical form (punctuation already blanked).
SPELLINGS = (
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("sub license", "sublicense"), ("sublicence", "sublicense"), ("non infringement", "noninfringement"),
    ("organisation", "organization"), ("merchantibility", "merchantability"), ("favour", "favor"), ("centre", "center"), ("fulfilment", "fulfillment"), ("per cent", "percent"),
)

#: Public licence texts and the notices by which works name them.
_GRANT = 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'
_ISC_END = 'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'
_REDISTRIBUTION = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n\n2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.\n\n"
_NO_ENDORSEMENT = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n\n"
_BSD_END = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'
_HOPE = "This {work} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {kind}General Public License for more details.\n\nYou should have received a copy of the GNU {kind}General Public License along with this {work}"
_GNU_3 = "This {work} is free software: you can redistribute it and/or modify it under the terms of the GNU {kind}General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.\n\n" + _HOPE + ". If not, see <https://www.gnu.org/licenses/>."
_GNU_2 = "This {work} is free software; you can redistribute it and/or modify it under the terms of the GNU {kind}General Public License as published by the Free Software Foundation; either version {version} of the License, or (at your option) any later version.\n\n" + _HOPE + "; if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA."
_PUBLIC_DOMAIN = 'This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.\n\nIn jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.\n\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.\n\nFor more information, please refer to <https://unlicense.org>'
_APACHE_HEADER = 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at\n\nhttp://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'
_ZLIB = "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.\n\nPermission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:\n\n1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.\n\n2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.\n\n3. This notice may not be removed or altered from any source distribution."
LICENSES = (
    ("MIT", _GRANT),
    ("MIT", "MIT License\n\n" + _GRANT),
    ("MIT", "The MIT License (MIT)\n\n" + _GRANT),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n\n" + _ISC_END),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n\n" + _ISC_END),
    ("WTFPL", "Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as long as the name is changed.\n\nDO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE TERMS AND CONDITIONS FOR COPYING, DISTRIBUTION AND MODIFICATION\n\n0. You just DO WHAT THE FUCK YOU WANT TO."),
    ("BSD-2-Clause", _REDISTRIBUTION + _BSD_END), ("BSD-2-Clause", "BSD 2-Clause License\n\n" + _REDISTRIBUTION + _BSD_END),
    ("BSD-3-Clause", _REDISTRIBUTION + _NO_ENDORSEMENT + _BSD_END), ("BSD-3-Clause", "BSD 3-Clause License\n\n" + _REDISTRIBUTION + _NO_ENDORSEMENT + _BSD_END),
    ("Unlicense", _PUBLIC_DOMAIN), ("Zlib", _ZLIB), ("Apache-2.0", _APACHE_HEADER),
    ("GPL-3.0", _GNU_3.format(work="program", kind="")), ("AGPL-3.0", _GNU_3.format(work="program", kind="Affero ")), ("LGPL-3.0", _GNU_3.format(work="program", kind="Lesser ")), ("LGPL-3.0", _GNU_3.format(work="library", kind="Lesser ")),
    ("GPL-2.0", _GNU_2.format(work="program", kind="", version="2")), ("LGPL-2.1", _GNU_2.format(work="library", kind="Lesser ", version="2.1")),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Released into the public domain under CC0 1.0."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
)

#: Known texts up to which the digest side is broadcast; beyond, the planner chooses the join.
MAX_KNOWN = 100_000
#: Spellings change a text's length by at most one character in seven, so these bound its length before them.
SHORTER, LONGER = 0.7, 1.3


def without_copyright(lowered: Column) -> Column:
    """Lower-cased text without its copyright lines: those that open with the word or sign and a year or mark."""
    pattern = r"(?m)^[^a-z0-9\n(©]*(copyright +(\(c\)|©|[0-9]{4})|\(c\) +[0-9]{4}|©)[^\n]*$"
    some = F.contains(lowered, F.lit("copyright")) | F.contains(lowered, F.lit("(c)")) | F.contains(lowered, F.lit("©"))
    return F.when(some, F.regexp_replace(lowered, pattern, " ")).otherwise(lowered)


def folded(lowered: Column) -> Column:
    """Letters and digits, with one space for whatever stands between them."""
    return F.trim(F.regexp_replace(lowered, r"[^\p{L}\p{N}]+", " "))


def respelt(fold: Column) -> Column:
    """One spelling of equivalent words in a folded text."""
    t = F.concat(F.lit(" "), fold, F.lit(" "))
    for other, one in SPELLINGS:
        t = F.replace(t, F.lit(f" {other} "), F.lit(f" {one} "))
    return F.trim(t)


def canonical(text: Column) -> Column:
    """The canonical form; null stays null."""
    return respelt(folded(without_copyright(F.lower(text))))


def known_digests(spark: SparkSession, licenses=LICENSES) -> DataFrame:
    """license_id, digest, length (of the canonical form): one row per digest, the first id in alphabetical order where several share it."""
    df = spark.range(1).select(F.inline(F.array(*[F.struct(F.lit(i).alias("license_id"), F.lit(t).alias("text")) for i, t in licenses])))
    known = df.select("license_id", canonical(F.col("text")).alias("c")).filter("c <> ''")
    return known.groupBy(F.sha2("c", 256).alias("digest")).agg(F.min("license_id").alias("license_id"), F.min(F.length("c")).alias("length"))


def license_units(docs: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Units that are entirely a known licence: id, kind (document, paragraph, line), position from 0, license_id.

    Null texts have no unit, and units without a letter or digit are none; paragraphs and lines count only
    where the text has several. Repeated rows give their units each; texts of any length are read whole;
    other columns, whatever their names, are not read. ``known`` is (license_id, digest, length).

    Each line is folded once, and the document is put together from its lines. Only units that have the length
    of a known text are respelt and hashed: no other can have its digest.
    """
    few = known.select("digest").limit(MAX_KNOWN + 1).count() <= MAX_KNOWN
    lengths = sorted(r[0] for r in known.select("length").distinct().collect()) if few else []
    low, high = (lengths[0], lengths[-1]) if lengths else (x or 0 for x in known.agg(F.min("length"), F.max("length")).first())
    fits = lambda n: n.isin(lengths) if lengths else (n >= low) & (n <= high)
    near = lambda n: (n >= max(1, int(low * SHORTER))) & (n <= int(high * LONGER) + 1)
    blank = r"\n[ \t\r]*\n"
    t = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("t")).filter("t is not null")
    lines = t.select("__id", "t", F.transform(F.split(without_copyright(F.lower("t")), "\n"), folded).alias("lines"))
    size = F.aggregate("lines", F.lit(-1), lambda n, x: n + F.length(x) + F.when(x != "", 1).otherwise(0))
    unit = lambda kind, at, fold: F.struct(F.lit(kind).alias("kind"), at.alias("position"), fold.alias("fold"))
    none = F.array().cast("array<struct<kind:string,position:int,fold:string>>")
    whole = F.when(near(size), F.array(unit("document", F.lit(0), F.array_join(F.filter("lines", lambda x: x != ""), " ")))).otherwise(none)
    each = F.when(F.size("lines") > 1, F.filter(F.transform("lines", lambda x, i: unit("line", i, x)), lambda u: near(F.length(u["fold"])))).otherwise(none)
    parts = F.transform(F.split("t", blank), lambda x, i: unit("paragraph", i, folded(without_copyright(F.lower(x)))))
    paragraphs = F.when(F.col("t").rlike(blank), F.filter(parts, lambda u: near(F.length(u["fold"])))).otherwise(none)
    respell = lambda u: F.struct(u["kind"].alias("kind"), u["position"].alias("position"), respelt(u["fold"]).alias("c"))
    units = F.filter(F.transform(F.concat(whole, each, paragraphs), respell), lambda u: fits(F.length(u["c"])))
    d = lines.select("__id", F.explode(units).alias("u")).select("__id", "u.kind", "u.position", F.sha2("u.c", 256).alias("digest"))
    keys = known.select("digest", "license_id")
    return d.join(F.broadcast(keys) if few else keys, "digest").select(F.col("__id").alias(id_col), "kind", "position", "license_id")


def license_report(docs: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: license_ids (sorted, comma-joined, '' if none), n_units, whole_license (null unless the whole text is one).

    Null and empty texts have none; rows that share an id share the units of all of them; an empty table gives no rows.
    """
    found = license_units(docs, known, id_col, text_col).groupBy(id_col).agg(
        F.array_join(F.array_sort(F.collect_set("license_id")), ",").alias("__ids"), F.count("*").alias("__n"), F.min(F.when(F.col("kind") == "document", F.col("license_id"))).alias("__whole"),
    )
    found = found.withColumnRenamed(id_col, "__found")
    return docs.select(F.col(id_col).alias("__id")).join(found, F.col("__id") == F.col("__found"), "left").select(
        F.col("__id").alias(id_col), F.coalesce("__ids", F.lit("")).alias("license_ids"), F.coalesce("__n", F.lit(0)).alias("n_units"), F.col("__whole").alias("whole_license"),
    )


def _sql_canonical(x: str) -> str:
    t = rf"regexp_replace(lower({x}), '(?m)^[^a-z0-9\n(©]*(copyright +(\(c\)|©|[0-9]{{4}})|\(c\) +[0-9]{{4}}|©)[^\n]*$', ' ', 'g')"
    t = rf"regexp_replace(' ' || regexp_replace({t}, '[^\p{{L}}\p{{N}}]+', ' ', 'g') || ' ', ' +', ' ', 'g')"
    for other, one in SPELLINGS:
        t = f"replace({t}, ' {other} ', ' {one} ')"
    return f"trim({t})"


_ROWS = ", ".join("('{}', '{}')".format(i, t.replace("'", "''")) for i, t in LICENSES)
ORACLE_SQL = rf"""
WITH k AS (SELECT d, min(i) AS i FROM (SELECT i, sha256({_sql_canonical("t")}) AS d FROM (VALUES {_ROWS}) v(i, t)) GROUP BY d),
u AS (
  SELECT doc_id, 'document' AS kind, text AS x FROM documents WHERE text IS NOT NULL
  UNION ALL SELECT doc_id, 'paragraph', unnest(regexp_split_to_array(text, '\n[ \t\r]*\n')) FROM documents WHERE regexp_matches(text, '\n[ \t\r]*\n')
  UNION ALL SELECT doc_id, 'line', unnest(string_split(text, chr(10))) FROM documents WHERE contains(text, chr(10))),
c AS (SELECT doc_id, kind, {_sql_canonical("x")} AS c FROM u),
f AS (SELECT doc_id, array_to_string(list_sort(list(DISTINCT i)), ',') AS ids, count(*) AS n, min(i) FILTER (kind = 'document') AS whole FROM c JOIN k ON sha256(c.c) = k.d WHERE c.c <> '' GROUP BY doc_id)
SELECT documents.doc_id, coalesce(ids, '') AS license_ids, coalesce(n, 0) AS n_units, whole AS whole_license FROM documents LEFT JOIN f ON documents.doc_id = f.doc_id
"""
