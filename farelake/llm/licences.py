"""Licence scan by canonical digest lookup.

A text is brought to a canonical form (lower case, copyright lines dropped,
equivalent spellings unified, punctuation and white space collapsed) and its
md5 is looked up among the digests of known licences, canonicalised the same
way. Entire texts are looked up: the whole document, and each of its lines,
so that a notice on a line of its own is found. Nothing is grouped or
shuffled: the known digests are a bounded table (checked before the
broadcast), and the join keeps only units that match.

Results on odd input: null and empty texts, and units without a letter or
digit, match nothing; repeated rows repeat their matches; a null id is
carried; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.functions.joins import bounded
from farelake.llm.licence_texts import WHOLE

#: Spellings that licence matching treats as equal.
SPELLINGS = [
    ("licence", "license"), ("licenced", "licensed"), ("licences", "licenses"), ("sublicence", "sublicense"), ("sub licence", "sublicense"),
    ("sub license", "sublicense"), ("copyright holder", "copyright owner"),
    ("copyright holders", "copyright owners"), ("per cent", "percent"), ("favour", "favor"),
    ("organisation", "organization"), ("recognised", "recognized"), ("utilisation", "utilization"),
    ("merchantibility", "merchantability"), ("non commercial", "noncommercial"),
    ("acknowledgement", "acknowledgment"), ("wilful", "willful"), ("fulfil", "fulfill"), ("https", "http"),
]
#: Customary one-line notices of known licences.
NOTICES = [
    ("MIT", "MIT License."),
    ("MIT", "The MIT License (MIT)"),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This work is licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("ISC", "Licensed under the ISC License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "This work is licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
]
#: (licence, text): the whole texts, with and without their titles, and the notices.
KNOWN = [(name, f"{title} {text}".strip()) for name, titles, text in WHOLE for title in titles] + NOTICES
COPYRIGHT = r"^[^\p{L}\p{N}]*(copyright|\(c\)|©)([^\p{L}].*)?$"
#: Words after which a line that starts with "copyright" is a wrapped line of a licence's text.
BODY = (r"^[^\p{L}\p{N}]*copyright[^\p{L}\p{N}]+"
        r"(notices?|owners?|holders?|license|licence|laws?|interest|statement|and|patent|permission)([^\p{L}].*)?$")
KNOWN_MAX = 100_000


def clean_line(line: Column) -> Column:
    """One line in lower case without punctuation; '' when nothing counts, as in a copyright line."""
    low = F.lower(line)
    c = F.trim(F.regexp_replace(low, r"[^\p{L}\p{N}]+", " "))
    return F.when(low.rlike(COPYRIGHT) & ~low.rlike(BODY), F.lit("")).otherwise(c)


def unified(text: Column) -> Column:
    """A clean text with equivalent spellings unified."""
    c = F.concat(F.lit(" "), text, F.lit(" "))
    for a, b in SPELLINGS:
        c = F.replace(c, F.lit(f" {a} "), F.lit(f" {b} "))
    return F.trim(c)


def _units(text: Column) -> Column:
    """array<(unit, line_no, digest)> of a text: the whole, and each line."""
    lines = F.transform(F.split(F.regexp_replace(text, "\r\n?", "\n"), "\n"), clean_line)
    each = F.transform(lines, lambda c, i: F.struct(F.lit("line").alias("unit"), (i + 1).alias("line_no"),
                                                    unified(c).alias("canonical")))
    # Spellings of two words may be wrapped over two lines: the whole is unified as one.
    whole = F.struct(F.lit("document").alias("unit"), F.lit(0).alias("line_no"),
                     unified(F.array_join(F.filter(lines, lambda c: c != ""), " ")).alias("canonical"))
    return F.filter(F.concat(F.array(whole), each), lambda u: u["canonical"] != "")


def known_digests(spark: SparkSession, known: list[tuple[str, str]] | DataFrame = KNOWN) -> DataFrame:
    """(licence, digest), one row a digest, of (licence, text) pairs."""
    df = known if isinstance(known, DataFrame) else spark.createDataFrame(known, "licence string, text string")
    one = F.get(_units(F.col("text")), 0)["canonical"]
    return (df.select("licence", F.md5(one).alias("digest")).where("digest IS NOT NULL")
            .groupBy("digest").agg(F.min("licence").alias("licence")))


def licence_matches(spark: SparkSession, docs: DataFrame, known=KNOWN, key: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """(doc_id, unit, line_no, licence): units whose whole text is a known licence.

    ``unit`` is 'document' (line_no 0) or 'line' (line_no from 1).
    """
    units = (docs.select(F.col(key).alias("doc_id"), F.explode(_units(F.col(text))).alias("u"))
             .select("doc_id", "u.unit", "u.line_no", F.md5("u.canonical").alias("digest")))
    table = bounded(known_digests(spark, known), max_rows=KNOWN_MAX)
    return units.join(table, "digest").select("doc_id", "unit", "line_no", "licence")


def licence_sql(docs: str) -> str:
    """DuckDB SQL for ``licence_matches`` with the built-in texts."""
    def clean(c: str) -> str:
        x = f"trim(regexp_replace(lower({c}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"
        return (f"CASE WHEN regexp_matches(lower({c}), '{COPYRIGHT}') AND NOT regexp_matches(lower({c}), '{BODY}') "
                f"THEN '' ELSE {x} END")

    def unify(c: str) -> str:
        x = f"concat(' ', {c}, ' ')"
        for a, b in SPELLINGS:
            x = f"replace({x}, ' {a} ', ' {b} ')"
        return f"trim({x})"
    rows = ", ".join("('{}', '{}')".format(a, t.replace("'", "''")) for a, t in KNOWN)
    return f"""
WITH k AS (SELECT min(licence) AS licence, c FROM (SELECT licence, {unify(clean('t'))} AS c FROM
  (VALUES {rows}) v(licence, t)) GROUP BY c),
l AS (SELECT doc_id, row_number() OVER () AS r, string_split(replace(replace(text, chr(13) || chr(10), chr(10)),
  chr(13), chr(10)), chr(10)) AS ls FROM ({docs})),
s AS (SELECT doc_id, r, unnest(ls) AS line, CAST(generate_subscripts(ls, 1) AS INTEGER) AS line_no FROM l),
c AS (SELECT doc_id, r, line_no, {clean('line')} AS c FROM s),
u AS (SELECT doc_id, 'line' AS unit, line_no, {unify('c')} AS c FROM c WHERE c <> ''
  UNION ALL SELECT any_value(doc_id), 'document', 0, {unify("string_agg(c, ' ' ORDER BY line_no)")}
  FROM c WHERE c <> '' GROUP BY r)
SELECT doc_id, unit, line_no, licence FROM u JOIN k USING (c)"""
