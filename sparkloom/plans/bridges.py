"""The driver's tables in the shapes that the operators take."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkloom.functions.text import infer_category, sha

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function's name, with its SQL."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Keyword rules in order of priority, fitted to the vocabulary of the fixture's texts.
RULES = [
    ("troubleshooting", ["license", "scum", "trash"]),
    ("dockerfile", ["###", "$$$"]),
    ("generacion_yaml", ["!!"]),
    ("comando_cli", [" | "]),
    ("arquitectura", ["tionth", "schaft"]),
]
FALLBACK = "concepto"

#: Licence of each source of the fixture, in the spellings that sources use.
SOURCE_LICENSES = {"src0": "mit", "src1": "apache 2.0", "src2": "apache-2.0", "src3": "gpl-3.0", "src4": "cc-by-4.0", "src5": "bsd-3-clause"}
ALIASES = {"mit": "MIT", "apache 2.0": "Apache-2.0", "apache-2.0": "Apache-2.0", "bsd-3-clause": "BSD-3-Clause", "cc-by-4.0": "CC-BY-4.0", "gpl-3.0": "GPL-3.0-only"}
ALLOWED = ["Apache-2.0", "MIT", "BSD-2-Clause", "BSD-3-Clause", "ISC", "Zlib", "Unlicense", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0"]


def interim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as interim records."""
    return table(spark, sf_dir, "documents").select(
        F.col("source"), infer_category(F.col("text"), RULES, FALLBACK).alias("category"), F.col("text").alias("raw_content"),
        F.concat(F.lit("doc-"), "doc_id").alias("source_record_id"), F.col("lang").alias("language"), F.lit(0).alias("input_rank"), F.col("doc_id").alias("ordinal"),
    )


CATEGORY_SQL = "CASE " + " ".join(f"WHEN {' OR '.join(f'contains(lower(text), {chr(39)}{w}{chr(39)})' for w in words)} THEN '{c}'" for c, words in RULES) + f" ELSE '{FALLBACK}' END"


def exchanges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns with the assistant turn right after them, as chat records with a system prompt."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    t = table(spark, sf_dir, "conversations").withColumns({"next_role": F.lead("role").over(w), "next_text": F.lead("text").over(w), "first_role": F.first("role").over(w), "first_text": F.first("text").over(w)})
    system = F.when(F.col("first_role") == "system", F.col("first_text")).otherwise("You are a helpful assistant.")
    pairs = t.where("role = 'user' and next_role = 'assistant'").select("conv_id", "turn", system.alias("system"), F.col("text").alias("user"), F.col("next_text").alias("assistant"))
    m = lambda r: F.struct(F.lit(r).alias("role"), F.col(r).alias("content"))
    return pairs.withColumn("messages", F.array(m("system"), m("user"), m("assistant")))


EXCHANGES_SQL = """x AS (
  SELECT conv_id, turn, role, text AS "user", lead(role) OVER w AS next_role, lead(text) OVER w AS assistant,
         first_value(role) OVER w AS first_role, first_value(text) OVER w AS first_text
  FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
pairs AS (
  SELECT conv_id, turn, CASE WHEN first_role = 'system' THEN first_text ELSE 'You are a helpful assistant.' END AS system, "user", assistant
  FROM x WHERE role = 'user' AND next_role = 'assistant')"""


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as benchmark results."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.format_string("h%08d", "event_id").alias("content_hash"), F.col("event_type").alias("category"), F.col("value"), F.col("event_id"),
        (F.col("event_id") % 37 == 0).alias("truncated"), (F.col("event_id") % 5 == 0).cast("int").alias("retry_count"), (F.col("user_id") % 400).cast("int").alias("completion_tokens"),
    )


RESULTS_SQL = """r AS (
  SELECT 'h' || lpad(CAST(event_id AS VARCHAR), 8, '0') AS content_hash, event_type AS category, value, event_id,
         event_id % 37 = 0 AS truncated, CASE WHEN event_id % 5 = 0 THEN 1 ELSE 0 END AS retry_count, user_id % 400 AS completion_tokens
  FROM events)"""


def groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct document texts as groups of one for the split: (group, category, source, size)."""
    d = interim(spark, sf_dir).select(sha(F.col("raw_content")).alias("group"), "category", "source", "ordinal")
    first = d.groupBy("group").agg(F.min_by(F.struct("category", "source"), "ordinal").alias("f"))
    return first.select("group", "f.category", "f.source", F.lit(1).cast("bigint").alias("size"))


GROUPS_SQL = f"""d AS (SELECT sha256(text) AS "group", {CATEGORY_SQL} AS category, source, doc_id FROM documents),
g AS (SELECT "group", arg_min(category, doc_id) AS category, arg_min(source, doc_id) AS source, CAST(1 AS BIGINT) AS size FROM d GROUP BY 1)"""

SEED = 3407
#: A split by prefix sums in hash order, after GROUPS_SQL: s has group, category, source, size and split.
SPLIT_SQL = f"""k AS (
  SELECT *, CAST({SEED} AS BIGINT) + CAST('0x' || substr(sha256('{SEED}:' || category || '|' || source), 1, 8) AS BIGINT) AS seed FROM g),
o AS (
  SELECT *, sha256(CAST(seed AS VARCHAR) || ':' || "group") AS key, sum(size) OVER (PARTITION BY category, source) AS total FROM k),
b AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY category, source ORDER BY key, "group" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bef,
         greatest(CASE WHEN total < 40 THEN 1 ELSE 2 END, CAST(round_even(total * 0.05, 0) AS BIGINT)) AS t0 FROM o),
t AS (SELECT *, CASE WHEN 2 * t0 >= total THEN 1 ELSE t0 END AS t FROM b),
u AS (SELECT *, sum(CASE WHEN bef < t THEN size ELSE 0 END) OVER (PARTITION BY category, source) AS tests FROM t),
s AS (
  SELECT "group", category, source, size,
         CASE WHEN total < 3 THEN 'train' WHEN bef < t THEN 'test' WHEN bef - tests < t THEN 'validation' ELSE 'train' END AS split FROM u)"""
