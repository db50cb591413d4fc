"""License scans: canonical digest lookup.

A text is brought to a canonical form - lower case, copyright lines dropped,
equivalent spellings made one, punctuation and white space reduced to single
blanks - and its SHA-256 digest is joined by hash to those of known licence
texts. Whole texts are looked up, and so are the whole paragraphs and whole
lines of a text, by the same digests, so that a notice below prose is found.

Cases: a null or empty text, or one without letters or digits, has no
licence; a document of any length is one row; rows that share a ``doc_id``
(a null one too) give one row with the licences of all of them; an empty
table gives no rows; only the id and text columns are read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm.common import let, table

# Notices and short licence texts by SPDX identifier.
KNOWN = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "MIT License"),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\nTHE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0-only", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0-only", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC0-1.0", "Released under CC0 1.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
]

# Spellings that count as the same, in lower case and without
# punctuation, as rules (-ise and -ize, -our and -or, -ence and -ense, ...).
EQUIVALENT = [
    ("z", "s"), ("our", "or"), ("licence", "license"), ("logue", "log"), ("dgement", "dgment"), ("ll", "l"),
    ("centre", "center"), ("programme", "program"), ("whilst", "while"), ("non commercial", "noncommercial"),
    ("sub license", "sublicense"), ("per cent", "percent"), ("copyright owner", "copyright holder"),
    ("https", "http"),
]

# Typographic marks that count as punctuation.
MARKS = "‘’“”–—…•·«»©® "

#: A known list of more texts than this is joined without a broadcast.
MAX_BROADCAST_TEXTS = 10_000

COPYRIGHT = r"(?m)^[ \t*#/]*(copyright|\(c\)|\x{A9}|all rights reserved)[^\n]*$"
PUNCTUATION = rf"[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F{MARKS}]+"


def canonical(text: Column) -> Column:
    """The canonical form, line by line: its lines are those of ``text``."""
    c = F.regexp_replace(F.lower(text), COPYRIGHT, "")
    c = F.regexp_replace(c, PUNCTUATION, " ")
    return reduce(lambda x, pair: F.replace(x, F.lit(pair[0]), F.lit(pair[1])), EQUIVALENT, c)


def _block(lines: Column) -> Column:
    """One string of the lines of a block that have words."""
    return F.array_join(F.filter(F.transform(lines, F.trim), lambda x: x != ""), " ")


def _whole(canon: Column) -> Column:
    return _block(F.split(canon, "\n"))


def _units(canon: Column) -> Column:
    """array<struct(digest, is_whole)>: distinct digests of the whole text (the
    first), its paragraphs and its lines; none of a text without words."""
    def digests(lines: Column) -> Column:
        paragraphs = F.transform(F.split(canon, r"\n[ \n]*\n"), lambda p: _block(F.split(p, "\n")))
        parts = F.concat(F.array(_block(lines)), paragraphs, lines)
        parts = F.filter(F.array_distinct(parts), lambda p: p != "")
        return F.transform(parts, lambda p, i: F.struct(F.sha2(p, 256).alias("digest"), (i == 0).alias("is_whole")))

    return let(F.transform(F.split(canon, "\n"), F.trim), digests)


def known_digests(spark: SparkSession, known=None) -> DataFrame:
    """(digest, license): one row per canonical text, its names joined by blanks."""
    rows = spark.createDataFrame(list(known or KNOWN), "name string, text string")
    return (rows.select("name", F.sha2(_whole(canonical(F.col("text"))), 256).alias("known_digest"))
            .groupBy("known_digest")
            .agg(F.array_join(F.sort_array(F.collect_set("name")), " ").alias("license")))


def scan_licenses(docs: DataFrame, known=None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, whole_license, licenses): the licence that is the whole text, and
    all whose text is the whole of the text, a paragraph or a line, sorted."""
    lookup = known_digests(docs.sparkSession, known)
    if len(known or KNOWN) <= MAX_BROADCAST_TEXTS:
        lookup = F.broadcast(lookup)
    ids = docs.select(F.col(id_col).alias("doc_id"), F.lit(None).cast("string").alias("license"),
                      F.lit(None).cast("boolean").alias("is_whole"))
    units = (docs.select(F.col(id_col).alias("doc_id"),
                         F.explode(let(canonical(F.col(text_col)), _units)).alias("unit"))
             .select("doc_id", "unit.digest", "unit.is_whole"))
    found = units.join(lookup, F.col("digest") == F.col("known_digest")).select("doc_id", "license", "is_whole")
    return (ids.unionByName(found).groupBy("doc_id")
            .agg(F.min(F.when(F.col("is_whole"), F.col("license"))).alias("whole_license"),
                 F.sort_array(F.collect_set("license")).alias("licenses")))


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (scan_licenses(table(spark, sf_dir, "documents"))
            .select("doc_id", "whole_license", F.array_join("licenses", ",").alias("licenses"),
                    F.size("licenses").cast("long").alias("n_licenses")))


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _canon_sql(text: str) -> str:
    c = f"regexp_replace(lower({text}), '{COPYRIGHT}', '', 'g')"
    c = f"regexp_replace({c}, '{PUNCTUATION}', ' ', 'g')"
    for a, b in EQUIVALENT:
        c = f"replace({c}, {_quoted(a)}, {_quoted(b)})"
    return c


def _joined_sql(c: str) -> str:
    return f"trim(regexp_replace({c}, '[ \\n]+', ' ', 'g'))"


ORACLE = f"""
WITH known AS (
  SELECT DISTINCT name, {_joined_sql(_canon_sql('t'))} AS k
  FROM (VALUES {', '.join(f'({_quoted(n)}, {_quoted(t)})' for n, t in KNOWN)}) v(name, t)),
names AS (SELECT k, string_agg(name, ' ' ORDER BY name) AS license FROM known GROUP BY k),
canon AS (SELECT doc_id, {_canon_sql('text')} AS c FROM documents WHERE text IS NOT NULL),
parts AS (
  SELECT doc_id, {_joined_sql('c')} AS whole, {_joined_sql('c')} AS part FROM canon
  UNION SELECT doc_id, {_joined_sql('c')}, {_joined_sql("unnest(regexp_split_to_array(c, '\\n[ \\n]*\\n'))")} FROM canon
  UNION SELECT doc_id, {_joined_sql('c')}, {_joined_sql("unnest(string_split(c, chr(10)))")} FROM canon),
found AS (SELECT doc_id, whole = part AS is_whole, license FROM parts JOIN names ON part = k WHERE part <> ''),
per AS (SELECT doc_id, min(license) FILTER (is_whole) AS whole_license, count(DISTINCT license) AS n,
        string_agg(DISTINCT license, ',' ORDER BY license) AS licenses FROM found GROUP BY doc_id)
SELECT d.doc_id, whole_license, coalesce(licenses, '') AS licenses, coalesce(n, 0)::BIGINT AS n_licenses
FROM (SELECT DISTINCT doc_id FROM documents) d LEFT JOIN per ON d.doc_id IS NOT DISTINCT FROM per.doc_id
"""
