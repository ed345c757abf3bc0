"""License scans: canonical digests of texts, joined to those of known licences.

A text is brought to a canonical form: copyright lines go, letters are lower
case, everything but letters and digits is a gap, and spellings that mean the
same become one. Its digest is looked up among the digests of known licence
texts and notices by a hash join. What is looked up is each document's whole
text and each of its lines as a whole, so that a file that is a licence and a
notice above an article are both found.

Only digests are joined. The known side is a list in the caller's memory, so
the planner can send it to all tasks; the corpus is not shuffled for the join.
Spellings and digests are worked out only for texts that are not too long to
match; replaced words are at most twice as long as what they become.

Defined results: a null text counts as empty and matches nothing, as does a
text without letters and digits. A text that matches licences with one
canonical form names all of them. Repeated rows give repeated results.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import documents, row_key, whole
from tablewright.llm.registry import query

#: Notices and short licences as their stewards publish them.
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and
this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED
"AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT
HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS
PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL
DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by
applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
governing permissions and limitations under the License."""
_GPL = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more
details. You should have received a copy of the GNU General Public License along with this program. If not, see
<https://www.gnu.org/licenses/>."""
KNOWN: list[tuple[str, str]] = [
    ("MIT", _MIT),
    ("MIT", "MIT License\n\n" + _MIT),
    ("MIT", "The MIT License (MIT)\n\n" + _MIT),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("ISC", _ISC),
    ("ISC", "ISC License\n\n" + _ISC),
    ("Apache-2.0", _APACHE),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", _GPL),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("all-rights-reserved", "All rights reserved."),
]

#: Words of licence texts that count as the same (from, to).
SPELLINGS: list[tuple[str, str]] = [
    ("licence", "license"),
    ("licences", "licenses"),
    ("licenced", "licensed"),
    ("sublicence", "sublicense"),
    ("organisation", "organization"),
    ("authorised", "authorized"),
    ("recognised", "recognized"),
    ("acknowledgement", "acknowledgment"),
    ("merchantibility", "merchantability"),
    ("noninfringment", "noninfringement"),
    ("fulfil", "fulfill"),
    ("favour", "favor"),
    ("labour", "labor"),
    ("programme", "program"),
    ("whilst", "while"),
    ("https", "http"),
]

_COPYRIGHT = r"(?im)^[ \t]*(copyright|\(c\)|©)[^\n]*$"
_GAP = r"[^\p{L}\p{N}]+"


def canonical(text: Column, longest: Column | None = None) -> Column:
    """Canonical form; null where it has no word or, given ``longest``, can't be that short."""
    # two blanks between words, so that each has its own on either side
    words = F.concat(
        F.lit(" "), F.trim(F.regexp_replace(F.lower(F.regexp_replace(text, _COPYRIGHT, "")), _GAP, "  ")), F.lit(" ")
    )
    out = words
    for one, other in SPELLINGS:
        out = F.replace(out, F.lit(f" {one} "), F.lit(f" {other} "))
    fits = words != "  "
    return F.when(fits if longest is None else fits & (F.length(words) <= 2 * longest), out)


def license_hits(
    docs: DataFrame, known: Sequence[tuple[str, str]] = KNOWN, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, whole_license, line_licenses, n_license_lines) of every row; names are sorted, joined by commas."""
    spark = docs.sparkSession
    table = spark.createDataFrame(list(known), "license string, text string").select(
        "license", canonical(F.col("text")).alias("form")
    )
    table = table.where(F.col("form").isNotNull()).select("license", F.sha2("form", 256).alias("digest"), "form")
    longest = table.agg(F.coalesce(F.max(F.length("form")), F.lit(0))).first()[0]
    # a list from the caller's own memory: one digest per licence text
    table = F.broadcast(
        table.groupBy("digest").agg(F.array_join(F.sort_array(F.collect_set("license")), ",").alias("license"))
    )
    t = whole(F.col(text))
    rows = docs.select(
        row_key(F.col(doc_id), F.col(text)).alias("key"), F.col(doc_id).alias("doc_id"),
        F.posexplode(F.concat(F.array(t), F.split(t, "\n", -1))).alias("at", "unit"),
    )
    form = canonical(F.col("unit"), F.lit(longest))
    units = rows.select("key", "doc_id", "at", F.sha2(form, 256).alias("digest")).join(table, "digest", "left")
    line = F.when(F.col("at") > 0, F.col("license"))
    found = units.groupBy("key", "doc_id").agg(
        F.sum(F.when(F.col("at") == 0, 1).otherwise(0)).alias("copies"),
        F.max(F.when(F.col("at") == 0, F.col("license"))).alias("whole_license"),
        F.collect_set(line).alias("names"),
        F.count(line).alias("lines"),
    )
    names = F.array_join(F.array_sort(F.array_distinct(F.flatten(F.transform("names", lambda n: F.split(n, ","))))), ",")
    each = found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return each.select(
        "doc_id", "whole_license", names.alias("line_licenses"),
        F.expr("lines div copies").alias("n_license_lines"),
    )


def _sql_form(column: str) -> str:
    out = (
        f"' ' || trim(regexp_replace(lower(regexp_replace({column}, '{_COPYRIGHT}', '', 'g')), '{_GAP}', '  ', 'g')) || ' '"
    )
    for one, other in SPELLINGS:
        out = f"replace({out}, ' {one} ', ' {other} ')"
    return f"nullif({out}, '  ')"


def _sql_known() -> str:
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    return ", ".join(f"({quote(a)}, {quote(b)})" for a, b in KNOWN)


@query(
    "op6_license_scan",
    f"""
    WITH k AS (
        SELECT form, string_agg(DISTINCT license, ',' ORDER BY license) AS license
        FROM (SELECT license, {_sql_form("text")} AS form FROM (VALUES {_sql_known()}) AS v(license, text))
        GROUP BY form
    ),
    d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
    u AS (
        SELECT rid, 0 AS is_line, t AS unit FROM d
        UNION ALL SELECT rid, 1, unnest(string_split(t, chr(10))) FROM d
    ),
    h AS (SELECT rid, is_line, license FROM (SELECT rid, is_line, {_sql_form("unit")} AS form FROM u) JOIN k USING (form)),
    g AS (
        SELECT rid, max(license) FILTER (WHERE is_line = 0) AS whole_license,
            string_agg(DISTINCT license, ',' ORDER BY license) FILTER (WHERE is_line = 1) AS names,
            count(*) FILTER (WHERE is_line = 1) AS n
        FROM h GROUP BY rid
    )
    SELECT doc_id, whole_license, coalesce(names, '') AS line_licenses, coalesce(n, 0)::BIGINT AS n_license_lines
    FROM d LEFT JOIN g USING (rid)
    """,
)
def op6_license_scan(spark, sf_dir):
    return license_hits(documents(spark, sf_dir, "doc_id", "text"))
