"""License scan: canonical digests of entire texts, looked up among the digests of known licence texts."""

from __future__ import annotations

from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docspark.session import materialize

# Equivalent spellings (those of the SPDX matching guidelines), and short licence texts and notices.
SPELLINGS = {
    "acknowledgement": "acknowledgment",
    "analogue": "analog",
    "analyse": "analyze",
    "artefact": "artifact",
    "authorisation": "authorization",
    "authorised": "authorized",
    "calibre": "caliber",
    "cancelled": "canceled",
    "capitalisations": "capitalizations",
    "catalogue": "catalog",
    "categorise": "categorize",
    "centre": "center",
    "copyright owner": "copyright holder",
    "emphasised": "emphasized",
    "favour": "favor",
    "favourite": "favorite",
    "fulfil": "fulfill",
    "fulfilment": "fulfillment",
    "initialise": "initialize",
    "judgement": "judgment",
    "labelling": "labeling",
    "labour": "labor",
    "licence": "license",
    "maximise": "maximize",
    "modelled": "modeled",
    "modelling": "modeling",
    "offence": "offense",
    "optimise": "optimize",
    "organisation": "organization",
    "organise": "organize",
    "practise": "practice",
    "programme": "program",
    "realise": "realize",
    "recognise": "recognize",
    "signalling": "signaling",
    "sub license": "sublicense",
    "utilisation": "utilization",
    "whilst": "while",
    "wilful": "wilfull",
    "non commercial": "noncommercial",
    "per cent": "percent",
}
KNOWN = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "This project is licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    (
        "MIT",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ),
    (
        "ISC",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE.""",
    ),
    (
        "0BSD",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE.""",
    ),
]
#: Read alike by Java and RE2: a copyright line (lower case), and what is not a letter or digit.
COPYRIGHT_LINE = r"^[^\p{L}\p{N}]*(copyright|\(c\)|©)[^\n]*[0-9]|^[^\p{L}\p{N}]*all rights reserved[^\p{L}\p{N}]*\z"
NO_WORD = r"[^\p{L}\p{N}]+"
#: Full texts as published, one file each, named by its licence.
TEXTS = Path(__file__).with_name("license_texts")
#: Where the appendix of a full text starts that copies often leave out (lines as plain_lines makes them).
APPENDICES = ("appendix how to apply", "how to apply these terms")
_NAMES = [
    "license", "mit license", "mit license mit", "expat license", "isc license", "isc license isc", "zero clause bsd license", "bsd zero clause license",
    "bsd zero clause license 0bsd", "0bsd", "0bsd license", "bsd license", "new bsd license", "modified bsd license", "revised bsd license", "simplified bsd license",
    "bsd 2 clause license", "bsd 2 clause simplified license", "2 clause bsd license", "bsd 3 clause license", "bsd 3 clause new or revised license", "3 clause bsd license",
    "apache license", "apache license 2 0", "apache license version 2 0", "apache license version 2 0 january 2004",
    "gnu general public license", "gnu lesser general public license", "gnu library general public license", "gnu affero general public license",
    "mozilla public license", "mozilla public license 2 0", "mozilla public license version 2 0", "mozilla public license version 1 1", "unlicense",
]
_REST = [
    "version 2 0", "version 2 0 january 2004", "http www apache org licenses", "https www apache org licenses", "version 1 february 1989", "version 2 june 1991",
    "version 2 1 february 1999", "version 3 29 june 2007", "version 3 19 november 2007", "version 1 1", "creative commons legal code", "cc0 1 0 universal",
    "creative commons cc0 1 0 universal", "attribution 4 0 international", "attribution sharealike 4 0 international", "attribution noncommercial 4 0 international",
]
#: Lines that are a licence's title, as plain_lines makes them.
TITLES = sorted({new for name in _NAMES for full in (name, f"the {name}") for new in (full, full.replace("license", "licence"))} | set(_REST))


def plain_lines(text: Column) -> Column:
    """The words of each line in lower case with single blanks; no words where it states a copyright."""
    words = lambda x: F.trim(F.regexp_replace(x, NO_WORD, " "))
    return F.transform(F.split(F.lower(text), "\n"), lambda x: F.when(x.rlike(COPYRIGHT_LINE), "").otherwise(words(x)))


def one_spelling(padded: Column) -> Column:
    """One of several equivalent spellings each; words with a blank before and after all."""
    found = reduce(lambda a, b: a | b, [F.contains(padded, F.lit(f" {old} ")) for old in SPELLINGS])
    # a fold over the pairs, not one call per pair: the generated method stays small enough to be compiled
    pairs = F.array(*[F.array(F.lit(f" {a.replace(' ', '  ')} "), F.lit(f" {b.replace(' ', '  ')} ")) for a, b in SPELLINGS.items()])
    doubled = F.replace(padded, F.lit(" "), F.lit("  "))  # two neighbours then have a blank each
    new = F.aggregate(pairs, doubled, lambda text, pair: F.replace(text, pair[0], pair[1]))
    return F.when(found, F.replace(new, F.lit("  "), F.lit(" "))).otherwise(padded)


def without_head(lines: Column) -> Column:
    """The lines from the first on that is no title, no copyright statement and not empty; no lines if only empty ones go.

    Before the body of a licence any line that starts with the word copyright states one, with or
    without a year; within it such a line may be running text, so that the others stay.
    """
    head = lambda x: (x == "") | x.isin(TITLES) | x.rlike("^(c )?copyright( |$)|^c ")
    first = F.array_position(F.transform(lines, head), F.lit(False)).cast("int")
    says = F.exists(F.slice(lines, 1, F.greatest(first - 1, F.lit(0))), lambda x: x != "")
    return F.when(says, F.slice(lines, F.greatest(first, F.lit(1)), F.size(lines))).otherwise(F.array().cast("array<string>"))


def digests(lines: Column) -> Column:
    """SHA-256 of the canonical entire text, of it without its head (if it has one), then of each line; null where no word is left.

    Each step is a transform of its own: a lambda works its argument out once, however often it is named.
    """
    joined = lambda x: F.array_join(F.filter(x, lambda y: y != ""), " ")
    units = F.get(F.transform(F.array(lines), lambda x: F.concat(F.array(joined(x), joined(without_head(x))), x)), F.lit(0))
    padded = F.transform(units, lambda x: F.concat(F.lit(" "), x, F.lit(" ")))
    words = F.transform(padded, lambda x: F.trim(one_spelling(x)))
    return F.transform(words, lambda x: F.unhex(F.sha2(F.nullif(x, F.lit("")), 256)))


def full_texts(folder: str | Path = TEXTS) -> list[tuple[str, str]]:
    """(license, text) of each file of a folder on the driver, named <license>.txt."""
    return [(p.stem, p.read_text(encoding="utf-8")) for p in sorted(Path(folder).glob("*.txt"))]


def known_digests(spark: SparkSession, known: list[tuple[str, str]] | DataFrame = KNOWN) -> DataFrame:
    """Rows (digest, license), one per digest (the first name by the alphabet) of the known licence texts.

    ``known``: pairs, or a table, of license and text, titles included or not. Each text counts with and
    without its head, its appendix on how to apply it, and the copyright line to be filled in there.
    """
    table = known if isinstance(known, DataFrame) else spark.createDataFrame(known, "license string, text string")
    table = table.select("license", plain_lines(F.col("text")).alias("lines"))
    starts = lambda x: reduce(lambda a, b: a | b, [x.contains(m) for m in APPENDICES])
    at = F.array_position(F.transform("lines", starts), F.lit(True)).cast("int")
    short = F.when(at > 1, F.slice("lines", 1, F.greatest(at - 1, F.lit(0)))).otherwise(F.col("lines"))
    blank = F.filter("lines", lambda x: ~x.rlike("^copyright (c )?(yyyy|year) "))
    table = table.select("license", F.explode(F.array("lines", short, blank)).alias("lines"))
    table = table.select("license", F.explode(F.slice(digests(F.col("lines")), 1, 2)).alias("digest"))
    return table.filter(F.col("digest").isNotNull()).groupBy("digest").agg(F.min("license").alias("license"))


def scan_licenses(docs: DataFrame, known: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """Rows (id, license, line_licenses), one per row of ``docs``: what each text is, and what its lines are.

    license is the licence (string) whose text the entire document is, by the digest of the canonical
    text: lower case, no copyright lines, no punctuation, one of several equivalent spellings; if that
    is not known, by the digest without title and copyright lines at the beginning. A line
    of a document may be a licence notice as a whole; line_licenses (sorted strings) has the licences
    whose text is that of one line. Both are equality joins of digests to ``known`` (digest, license;
    unique digests), whose size Spark checks before it broadcasts it; only ids, hashes and digests move.
    Null, empty and blank texts match nothing: license null, line_licenses empty. Rows that repeat an
    id and text get equal answers; equal ids with other texts, and null ids, each their own. Other
    columns are not read. No Python runs on the executors.
    """
    key = [F.col(id).alias("id"), F.xxhash64(text).alias("version")]
    # one pass over the texts leaves a narrow table, which both lookups read
    made = materialize(docs.select(*key, digests(plain_lines(F.col(text))).alias("digests")), "digests")
    lines = F.array_distinct(F.expr("slice(digests, 3, size(digests))"))
    found = made.select("id", "version", F.explode(lines).alias("digest")).join(known, "digest")
    found = found.groupBy("id", "version").agg(F.array_sort(F.collect_set("license")).alias("found"))
    found = found.select(F.col("id").alias("_id"), F.col("version").alias("_version"), "found")
    body = known.select(F.col("digest").alias("_body"), F.col("license").alias("_license"))
    rows = made.select("id", "version", F.get("digests", F.lit(0)).alias("digest"), F.get("digests", F.lit(1)).alias("_body"))
    rows = rows.join(known, "digest", "left").join(body, "_body", "left")
    rows = rows.join(found, F.col("id").eqNullSafe(F.col("_id")) & (F.col("version") == F.col("_version")), "left")
    none = F.array().cast("array<string>")
    return rows.select(F.col("id").alias(id), F.coalesce("license", "_license").alias("license"), F.coalesce("found", none).alias("line_licenses"))


def _sql_digest(text: str) -> str:
    x = f"(' ' || regexp_replace({text}, '{NO_WORD}', ' ', 'g') || ' ')"
    y = f"replace({x}, ' ', '  ')"
    for old, new in SPELLINGS.items():
        y = f"replace({y}, ' {old.replace(' ', '  ')} ', ' {new.replace(' ', '  ')} ')"
    x = f"trim(replace({y}, '  ', ' '))"
    return f"CASE WHEN length({x}) > 0 THEN sha256({x}) END"


def _sql_plain(text: str) -> str:
    return f"list_transform(string_split(lower({text}), chr(10)), lambda x: CASE WHEN regexp_matches(x, '{COPYRIGHT_LINE}') THEN '' ELSE x END)"


_VALUES = ", ".join("('{}', '{}')".format(name, text.replace("'", "''")) for name, text in KNOWN)
ORACLE = f"""
WITH texts AS (SELECT column0 AS license, {_sql_plain("column1")} AS plain FROM (VALUES {_VALUES}) AS t(column0, column1)),
known AS (SELECT digest, min(license) AS license FROM (SELECT {_sql_digest("array_to_string(plain, ' ')")} AS digest, license FROM texts) GROUP BY 1),
docs AS (SELECT doc_id, {_sql_plain("text")} AS plain FROM documents),
whole AS (SELECT doc_id, {_sql_digest("array_to_string(plain, ' ')")} AS digest FROM docs),
lines AS (SELECT doc_id, {_sql_digest("line")} AS digest FROM (SELECT doc_id, unnest(plain) AS line FROM docs)),
found AS (SELECT doc_id, list_sort(list(DISTINCT license)) AS names FROM lines JOIN known USING (digest) GROUP BY doc_id)
SELECT doc_id, known.license, coalesce(names, []::VARCHAR[]) AS line_licenses
FROM whole LEFT JOIN known USING (digest) LEFT JOIN found USING (doc_id)
"""
