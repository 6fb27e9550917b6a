"""Licence scans by canonical digest.

A text is brought to a canonical form: A-Z lower-cased, copyright lines taken out, equivalent spellings made one, and
everything but letters and digits turned to single spaces. Its SHA-256 is looked up among the digests of known licence
texts. All of it is SQL expressions; the known texts are fixed files and rows of this module or a table that the caller
gives.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, written

# Spellings that count as equal, whole words of the lower-cased text.
SPELLINGS = [
    ("licence", "license"),
    ("licences", "licenses"),
    ("licenced", "licensed"),
    ("sublicence", "sublicense"),
    ("organisation", "organization"),
    ("organisations", "organizations"),
    ("recognise", "recognize"),
    ("authorised", "authorized"),
    ("favour", "favor"),
    ("honour", "honor"),
    ("fulfil", "fulfill"),
    ("non commercial", "noncommercial"),
    ("sub license", "sublicense"),
    ("copyright holder", "copyright owner"),
    ("copyright holders", "copyright owners"),
    ("https", "http"),
]

# Short known licence texts and notices by SPDX identifier. Whole texts lie in the folder licence_texts.
KNOWN = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'),
    ("MIT", "Released under the MIT License."),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]

#: Titles that stand before texts that have none of their own.
TITLES = {
    "0BSD": ["BSD Zero Clause License", "Zero-Clause BSD"],
    "BSD-2-Clause": ["BSD 2-Clause License", "The BSD 2-Clause License", 'BSD 2-Clause "Simplified" License'],
    "BSD-3-Clause": ["BSD 3-Clause License", "The BSD 3-Clause License", "BSD License", "New BSD License", 'BSD 3-Clause "New" or "Revised" License'],
    "ISC": ["ISC License", "The ISC License", "ISC License (ISC)"],
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)"],
    "Unlicense": ["The Unlicense", "Unlicense"],
}
#: What may follow this line (how to apply the licence) belongs to the file, not to the terms.
_END_OF_TERMS = "END OF TERMS AND CONDITIONS"


@cache
def known_texts() -> list[tuple[str, str]]:
    """Identifier and text of KNOWN and of the whole texts beside this module, these also with titles and as bare terms."""
    whole = [(p.stem, p.read_text("utf-8")) for p in sorted((Path(__file__).parent / "licence_texts").glob("*.txt"))]
    whole += [(i, t) for i, t in KNOWN if i in ("ISC", "MIT") and len(t) > 200]
    titled = [(i, f"{title}\n\n{t}") for i, t in whole for title in TITLES.get(i, ())]
    terms = [(i, t.partition(_END_OF_TERMS)[0] + end) for i, t in whole if _END_OF_TERMS in t for end in ("", _END_OF_TERMS)]
    return KNOWN + whole + titled + terms


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words after which "copyright" is part of a sentence and not before a holder's name.
_NO_HOLDER = "acts?|and|are|as|disclaimers?|for|holders?|if|in|information|infringements?|interests?|is|laws?|licen[cs]es?|licensors?|messages?|notices?|of|on|or|owners?|permissions?|protection|registration|rights?|shall|statements?|terms|that|to|treaty|treaties|under|which|will"
#: A line that only states a copyright: the word before a sign, a year or a holder, or a sign before a year.
COPYRIGHT_LINE = rf"(?m)^[ \t]*(portions |parts )?(©|\(c\)[ \t]*(?=copyright|\d{{4}})|copyright[ \t:]*(?=©|\(c\)|[\d\[<{{])|copyright[ \t:]+(?!({_NO_HOLDER})\b)(?=[\p{{L}}\"']))[^\n]*$|^[ \t]*all rights reserved\.?[ \t]*$"
#: The same in RE2's syntax, which can't look ahead: first the words that don't state a copyright are marked, then lines go.
_SQL_SAID = rf"(?m)^([ \t]*(?:portions |parts )?)copyright([ \t:]+(?:{_NO_HOLDER})\b)"
_SQL_COPYRIGHT_LINE = r"(?m)^[ \t]*(?:portions |parts )?(?:©|\(c\)[ \t]*(?:copyright|[0-9]{4})|copyright[ \t:]*(?:©|\(c\)|[0-9\[<{])|copyright[ \t:]+[\p{L}\"'])[^\n]*$|^[ \t]*all rights reserved\.?[ \t]*$"
OTHER = r"[^\p{L}\p{N}]+"


def canonical(text: Column) -> Column:
    """The canonical form; null stays null, a text without letters or digits becomes empty."""
    c = F.regexp_replace(F.translate(text, _UPPER, _LOWER), COPYRIGHT_LINE, " ")
    c = F.concat(F.lit(" "), F.regexp_replace(c, OTHER, " "), F.lit(" "))
    for a, b in SPELLINGS:
        c = F.replace(c, F.lit(f" {a} "), F.lit(f" {b} "))
    return F.trim(F.regexp_replace(c, " +", " "))


def digest(text: Column) -> Column:
    return F.sha2(canonical(text).cast("binary"), 256)


def known_licences(spark: SparkSession, rows: list[tuple[str, str]] | None = None) -> DataFrame:
    """digest, license_id: one row a digest (of several licences with one digest the first by name)."""
    known = spark.createDataFrame(known_texts() if rows is None else rows, "license_id string, text string")
    return known.select(digest(F.col("text")).alias("digest"), "license_id").groupBy("digest").agg(F.min("license_id").alias("license_id"))


def scan(docs: DataFrame, known: DataFrame, keep: list[str]) -> DataFrame:
    """The columns `keep` of docs with digest and license_id (null where the whole text is no known licence).

    A null text has neither. A kept column called like a new one gives way. The known table holds a row a licence; Spark
    broadcasts it only below its own threshold.
    """
    keep = [k for k in keep if k not in ("digest", "license_id")]
    rows = docs.select(*keep, digest(F.col("text")).alias("digest"))
    return rows.join(known, "digest", "left").select(*keep, "digest", "license_id")


def scan_lines(docs: DataFrame, known: DataFrame, keep: list[str], may_be: Callable[[Column], Column] | None = None) -> DataFrame:
    """As scan(), with notice_ids: comma-joined names of the licences that some whole line of the text is, empty if none.

    The digests of lines are exploded and hash-joined like those of whole texts, then gathered by row, which takes at most
    a name a licence. Rows are numbered in a written table, so that ids may be null or repeated; texts aren't shuffled.
    may_be: a cheap condition that every known text of one line meets; without it each line gets a digest.
    """
    new = ("digest", "license_id", "notice_ids")
    keep = [k for k in keep if k not in new]
    lines = F.split("text", "\n")
    lines = F.array_distinct(F.transform(lines if may_be is None else F.filter(lines, may_be), digest))
    rows = written(docs.select(F.monotonically_increasing_id().alias("row"), F.struct(*keep).alias("kept"), digest(F.col("text")).alias("digest"), lines.alias("lines")))
    found = rows.where(F.size("lines") > 0).select("row", F.explode("lines").alias("digest")).join(known, "digest")
    notices = found.groupBy("row").agg(F.array_join(F.array_sort(F.collect_set("license_id")), ",").alias("notice_ids"))
    out = rows.join(known, "digest", "left").join(notices, "row", "left")
    return out.select(*(F.col("kept").getField(k).alias(k) for k in keep), "digest", "license_id", F.coalesce("notice_ids", F.lit("")).alias("notice_ids"))


def may_be_notice(line: Column) -> Column:
    """Every text of this module's table mentions a licence, a permission or the public domain; other lines need no digest."""
    return F.translate(line, _UPPER, _LOWER).rlike(_NOTICE)


_NOTICE = "licen[cs]e|public domain|permission"


def op10_licence_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, digest, license_id, notice_ids, is_license of every document, see scan_lines.

    A row a row of documents, also for null or repeated ids; a null text has no digest and no notices. The table of known
    texts is the fixed one of this module (58 rows), so it is broadcast.
    """
    known = F.broadcast(known_licences(spark))
    found = scan_lines(table(spark, sf_dir, "documents"), known, ["doc_id"], may_be_notice)
    return found.select("doc_id", "digest", "license_id", "notice_ids", F.col("license_id").isNotNull().alias("is_license"))


def _sql_canonical(expression: str) -> str:
    c = f"regexp_replace(translate({expression}, '{_UPPER}', '{_LOWER}'), {_quoted(_SQL_SAID)}, '\\1c_opyright\\2', 'g')"
    c = f"regexp_replace({c}, {_quoted(_SQL_COPYRIGHT_LINE)}, ' ', 'g')"
    c = f"' ' || regexp_replace(replace({c}, 'c_opyright', 'copyright'), '{OTHER}', ' ', 'g') || ' '"
    for a, b in SPELLINGS:
        c = f"replace({c}, ' {a} ', ' {b} ')"
    return f"trim(regexp_replace({c}, ' +', ' ', 'g'))"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _oracle() -> str:
    known = ", ".join(f"({_quoted(i)}, {_quoted(t)})" for i, t in known_texts())
    return f"""
WITH known AS (SELECT sha256({_sql_canonical("t")}) AS digest, min(i) AS license_id FROM (VALUES {known}) v(i, t) GROUP BY 1),
docs AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
lines AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM docs),
notices AS (
  SELECT r, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS notice_ids
  FROM (SELECT r, sha256({_sql_canonical("line")}) AS digest FROM lines) l JOIN known USING (digest) GROUP BY 1)
SELECT d.doc_id, d.digest, k.license_id, coalesce(n.notice_ids, '') AS notice_ids, k.license_id IS NOT NULL AS is_license
FROM (SELECT r, doc_id, sha256({_sql_canonical("text")}) AS digest FROM docs) d
LEFT JOIN known k ON d.digest = k.digest LEFT JOIN notices n ON d.r = n.r
"""


ORACLE_SQL = {"op10_licence_digest": _oracle()}
