"""Licence scan by canonical digest lookup, in DataFrame functions only.

A text is brought to a canonical form (case, punctuation, copyright lines, equivalent spellings), and the
SHA-256 of the whole form is hash-joined to the digests of known licences. The same lookup over whole
lines finds the notices by which a text names its licence.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.license_texts import DIGESTS, EQUIVALENT, LICENSES, MORE_NOTICES, NOTICES
from sparkloom.llm.shared import stage

#: The table of known digests is broadcast only up to so many rows; a larger one is joined by shuffle.
MOST_BROADCAST = 50_000

_COPYRIGHT = r"(?m)^[^\p{L}\p{N}\n©(]*(copyright[^\p{L}\n(©<]{0,5}(\(c\)|©|[0-9]|<|\[)|\(c\) *[0-9]|©)[^\n]*$"
_RESERVED = r"all rights reserved"
_NOT_WORD = r"[^\p{L}\p{N}]+"


def _steps() -> list[tuple[str, str]]:
    spelled = [(rf" {old} ", f" {new} ") for old, new in sorted(EQUIVALENT, key=lambda x: (x[0].count(" "), x[0]))]
    return [(_COPYRIGHT, " "), (_RESERVED, " "), (_NOT_WORD, " "), *spelled]


def canonical(text: Column) -> Column:
    """The canonical form: words of lower case letters and digits, one blank before, between and after them."""
    out = F.lower(F.coalesce(text, F.lit("")))
    for pattern, new in _steps()[:3]:
        out = F.regexp_replace(out, pattern, new)
    out = F.concat(F.lit(" "), F.trim(out), F.lit(" "))
    for old, new in _steps()[3:]:
        for _ in range(2):  # neighbours share a blank: the second time takes every other one
            out = F.replace(out, F.lit(old), F.lit(new))
    return out


def known(spark, texts: list[tuple[str, str]]) -> DataFrame:
    """(digest, license_id) of canonical texts; of several licences with one digest the least name counts."""
    table = spark.createDataFrame(texts, "license_id string, text string")
    return table.select(F.sha2(canonical(F.col("text")), 256).alias("digest"), "license_id").groupBy("digest").agg(F.min("license_id").alias("license_id"))


def _lookup(rows: DataFrame, table: DataFrame, size: int) -> DataFrame:
    return rows.join(F.broadcast(table) if size <= MOST_BROADCAST else table, "digest", "left")


def license_scan(
    docs: DataFrame, licenses: list[tuple[str, str]] = LICENSES, notices: list[tuple[str, str]] = NOTICES + MORE_NOTICES, digests: list[tuple[str, str]] = DIGESTS
) -> DataFrame:
    """One row per row of ``docs``: doc_id, license_id, is_license, notice_ids, n_notices, canonical_sha256.

    license_id is set where the entire text is a known licence, by its text or its canonical digest. notice_ids has the licences named by
    whole lines, sorted and joined by commas ('' if none); n_notices counts such lines. Null counts as
    empty, and an empty text is no licence. Repeated rows are scanned alike; an empty table gives an empty result; texts of any length are
    read whole; of licences with one canonical text the least name counts; other columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row"))
    # Where every notice has the word in one of its spellings, other lines need no canonical form.
    word = "licen" if all("licen" in text.lower() for _, text in notices) else ""
    lines = F.filter(F.split("text", "\n"), lambda x: F.lower(x).contains(word))
    marks = F.transform(lines, lambda x: F.sha2(canonical(x), 256))
    whole = stage(
        rows.select(
            "doc_id", "row", F.sha2(canonical(F.col("text")), 256).alias("digest"),
            F.when(F.lower("text").contains(word), marks).alias("marks"),
        ),
        "license",
    )
    found = (
        whole.select("row", F.explode("marks").alias("digest"))
        .join(F.broadcast(known(spark, notices)) if len(notices) <= MOST_BROADCAST else known(spark, notices), "digest")
        .groupBy("row").agg(F.array_join(F.sort_array(F.collect_set("license_id")), ",").alias("notice_ids"), F.count("*").alias("n_notices"))
    )
    long = spark.createDataFrame(digests, "license_id string, digest string").select("digest", "license_id")
    table = known(spark, licenses).unionByName(long).groupBy("digest").agg(F.min("license_id").alias("license_id"))
    return (
        _lookup(whole.select("doc_id", "row", "digest"), table, len(licenses) + len(digests))
        .join(found, "row", "left")
        .select(
            "doc_id", "license_id", F.col("license_id").isNotNull().alias("is_license"),
            F.coalesce("notice_ids", F.lit("")).alias("notice_ids"), F.coalesce("n_notices", F.lit(0)).cast("bigint").alias("n_notices"),
            F.col("digest").alias("canonical_sha256"),
        )
    )


def _sql_canonical(expr: str) -> str:
    out = f"lower(coalesce({expr}, ''))"
    for pattern, new in _steps()[:3]:
        out = f"regexp_replace({out}, '{pattern}', '{new}', 'g')"
    out = f"(' ' || trim({out}) || ' ')"
    for old, new in _steps()[3:]:
        for _ in range(2):
            out = f"replace({out}, '{old}', '{new}')"
    return out


def _values(texts: list[tuple[str, str]]) -> str:
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    return ", ".join(f"({quoted(a)}, {quoted(re.sub(chr(10), ' ', b))})" for a, b in texts)


def sql(licenses: list[tuple[str, str]] = LICENSES, notices: list[tuple[str, str]] = NOTICES + MORE_NOTICES, digests: list[tuple[str, str]] = DIGESTS) -> str:
    known_sql = "SELECT sha256({c}) AS digest, min(license_id) AS license_id FROM (VALUES {v}) AS t(license_id, text) GROUP BY 1"
    return f"""
WITH licenses AS (SELECT digest, min(license_id) AS license_id FROM (
  {known_sql.format(c=_sql_canonical('text'), v=_values(licenses))} UNION ALL SELECT digest, license_id FROM (VALUES {_values(digests)}) AS t(license_id, digest)) GROUP BY digest),
notices AS ({known_sql.format(c=_sql_canonical('text'), v=_values(notices))}),
d AS (SELECT doc_id, text, sha256({_sql_canonical('text')}) AS digest FROM documents),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents WHERE contains(lower(text), 'licen')),
m AS (SELECT doc_id, sha256({_sql_canonical('line')}) AS digest FROM l WHERE contains(lower(line), 'licen')),
n AS (SELECT doc_id, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS notice_ids, count(*) AS n_notices
      FROM m JOIN notices USING (digest) GROUP BY doc_id)
SELECT d.doc_id, licenses.license_id, licenses.license_id IS NOT NULL AS is_license, coalesce(n.notice_ids, '') AS notice_ids,
       CAST(coalesce(n.n_notices, 0) AS BIGINT) AS n_notices, d.digest AS canonical_sha256
FROM d LEFT JOIN licenses USING (digest) LEFT JOIN n ON n.doc_id = d.doc_id
"""
