"""Queries over documents: dedupe, cleaning, categories, samples, splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.functions import quality, text
from sparkloom.operators import cleaning, dedupe, language, split, stats, validation
from sparkloom.plans.bridges import ALIASES, ALLOWED, CATEGORY_SQL, GROUPS_SQL, SEED, SOURCE_LICENSES, SPLIT_SQL, groups, interim, query, table

CANONICAL_SQL = r"regexp_replace(regexp_replace(regexp_replace(text, '\r\n?', chr(10), 'g'), '[ \t]+(\n|$)', '\1', 'g'), '^\s+|\s+$', '', 'g')"


def canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = interim(spark, sf_dir)
    return dedupe.exact_dedupe(d.select(text.sha(text.canonical_text(F.col("raw_content"))).alias("content_hash"), "source", "input_rank", "ordinal"))


_EXACT = f"""WITH h AS (SELECT doc_id, source, sha256({CANONICAL_SQL}) AS content_hash FROM documents),
w AS (SELECT *, first_value(doc_id) OVER (PARTITION BY content_hash ORDER BY doc_id) AS kept_id FROM h)"""


@query(_EXACT + " SELECT content_hash, doc_id, source FROM w WHERE doc_id = kept_id")
def exact_dedupe_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical(spark, sf_dir).where("not is_duplicate").select("content_hash", F.col("ordinal").alias("doc_id"), "source")


@query(_EXACT + " SELECT content_hash, doc_id, kept_id FROM w WHERE doc_id <> kept_id")
def exact_dedupe_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical(spark, sf_dir).where("is_duplicate").select("content_hash", F.col("ordinal").alias("doc_id"), "kept_id")


@query(_EXACT + """ SELECT source, count(*) AS input, CAST(sum(CASE WHEN doc_id = kept_id THEN 1 ELSE 0 END) AS BIGINT) AS kept,
 CAST(sum(CASE WHEN doc_id = kept_id THEN 0 ELSE 1 END) AS BIGINT) AS removed FROM w GROUP BY source""")
def exact_dedupe_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.report_by(canonical(spark, sf_dir), "source")


# ---------------------------------------------------------------- cleaning

EMAIL_SQL = r"(?i)\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}\b"
IPV4_SQL = text.PII_PATTERNS["private_ipv4"]
AWS_SQL, GITHUB_SQL, JWT_SQL = (text.PII_PATTERNS[k] for k in ("aws_access_key", "github_token", "jwt"))
BEARER_SQL = r"(Bearer )[A-Za-z0-9._~+/-]{16,}={0,2}"

def _grams_sql(name: str, keys: str, rows: str) -> str:
    """name(keys, gram): all runs of one to three characters of the column ``x``."""
    return f"""{name} AS (SELECT {keys}, unnest([a, a || b, a || b || c]) AS gram FROM (
  SELECT {keys}, a, lead(a, 1) OVER w AS b, lead(a, 2) OVER w AS c FROM (SELECT {keys}, unnest(string_split(x, '')) AS a, generate_subscripts(string_split(x, ''), 1) AS i FROM {rows})
  WINDOW w AS (PARTITION BY {keys} ORDER BY i)))"""


_PREPARED_SQL = r"' ' || trim(regexp_replace(lower({c}), '[^\p{{L}}]+', ' ', 'g')) || ' '"
#: Profiles of n-grams learnt from texts and languages, then the language of what cleaning leaves, by sums of weights.
DETECTED_SQL = f"""labelled AS (SELECT lang, doc_id, {_PREPARED_SQL.format(c="text")} AS x FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY sha256(text), doc_id) AS r FROM documents WHERE lang IS NOT NULL AND text IS NOT NULL) WHERE r <= {language.TEXTS}),
{_grams_sql("seen", "lang, doc_id", "labelled")},
counted AS (SELECT lang, gram, count(*) AS n FROM seen WHERE gram IS NOT NULL GROUP BY ALL),
top AS (SELECT DISTINCT gram FROM (SELECT gram, row_number() OVER (PARTITION BY lang ORDER BY n DESC, gram) AS r FROM counted) WHERE r <= {language.GRAMS}),
totals AS (SELECT lang, sum(n) AS total FROM counted JOIN top USING (gram) GROUP BY lang),
weights AS MATERIALIZED (SELECT lang, gram, CAST(round(ln((coalesce(n, 0) + 0.5) / (total + 0.5 * (SELECT count(*) FROM top))) * {language.UNIT}) AS BIGINT) AS weight
  FROM top CROSS JOIN totals LEFT JOIN counted USING (lang, gram)),
shown AS (SELECT doc_id, {_PREPARED_SQL.format(c="content")} AS x FROM b),
{_grams_sql("parts", "doc_id", "shown")},
held AS (SELECT doc_id, gram, count(*) AS n FROM parts WHERE gram IS NOT NULL GROUP BY ALL),
sums AS (SELECT doc_id, lang, sum(n * weight) AS total, sum(n) AS known FROM held JOIN weights USING (gram) GROUP BY ALL),
ranked AS (SELECT *, total * (least(known, {language.EVIDENCE}) / known / {language.UNIT}) AS z, row_number() OVER (PARTITION BY doc_id ORDER BY total DESC, sha256('{SEED}:' || lang)) AS r FROM sums),
detected AS (SELECT doc_id, max(CASE WHEN r = 1 THEN lang END) AS told, 1 / sum(exp(z - top_z)) AS p
  FROM (SELECT *, max(CASE WHEN r = 1 THEN z END) OVER (PARTITION BY doc_id) AS top_z FROM ranked) GROUP BY doc_id)"""


#: Stages of cleaning in SQL: n normalised, e to b redacted one kind at a time, with counts.
CLEAN_SQL = rf"""n AS (
  SELECT doc_id, source, lang, {CATEGORY_SQL} AS category,
    regexp_replace(regexp_replace(array_to_string([regexp_replace(x, '\s+$', '') for x in string_split(regexp_replace(text, '\r\n?', chr(10), 'g'), chr(10))
      if NOT regexp_matches(x, '(?i)^\s*(edit this page|view page source|last modified|copyright)\b.*$') AND NOT regexp_matches(x, '(?i)^\s*(previous|next)\s*$')], chr(10)),
      '\n{{3,}}', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g') AS t FROM documents),
e AS (SELECT *, len(regexp_extract_all(t, '{EMAIL_SQL}')) AS email, regexp_replace(t, '{EMAIL_SQL}', '<REDACTED_EMAIL>', 'g') AS t1 FROM n),
i AS (SELECT *, len(regexp_extract_all(t1, '{IPV4_SQL}')) AS private_ipv4, regexp_replace(t1, '{IPV4_SQL}', '<REDACTED_PRIVATE_IPV4>', 'g') AS t2 FROM e),
a AS (SELECT *, len(regexp_extract_all(t2, '{AWS_SQL}')) AS aws_access_key, regexp_replace(t2, '{AWS_SQL}', '<REDACTED_AWS_ACCESS_KEY>', 'g') AS t3 FROM i),
h AS (SELECT *, len(regexp_extract_all(t3, '{GITHUB_SQL}')) AS github_token, regexp_replace(t3, '{GITHUB_SQL}', '<REDACTED_GITHUB_TOKEN>', 'g') AS t4 FROM a),
j AS (SELECT *, len(regexp_extract_all(t4, '{JWT_SQL}')) AS jwt, regexp_replace(t4, '{JWT_SQL}', '<REDACTED_JWT>', 'g') AS t5 FROM h),
b AS (SELECT *, len(regexp_extract_all(t5, '(?i){BEARER_SQL}')) AS bearer_token, regexp_replace(t5, '(?i){BEARER_SQL}', '\1<REDACTED_BEARER_TOKEN>', 'g') AS content FROM j),
{DETECTED_SQL},
c AS (
  SELECT *, CASE WHEN length(content) < 40 THEN 'too_short' WHEN length(content) > 50000 THEN 'too_long'
    WHEN category NOT IN ('comando_cli', 'generacion_yaml', 'dockerfile') AND (len(regexp_extract_all(content, '\p{{L}}')) < 80 OR coalesce(told, '') NOT IN ('en', 'es') OR p < 0.8) THEN 'language_not_allowed_or_uncertain' END AS reason
  FROM b LEFT JOIN detected USING (doc_id))"""


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned records without their language: for what doesn't ask for it."""
    return cleaning.clean(interim(spark, sf_dir))


def gated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned records, their language told from the text by profiles of labelled documents."""
    labelled = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text", F.col("lang").alias("language"))
    profile = language.profile_of(language.train(labelled), SEED)
    return cleaning.clean(interim(spark, sf_dir).drop("language"), detector=language.detector(profile))


@query(f"WITH {CLEAN_SQL} SELECT doc_id, told AS language, round(p, 6) AS probability FROM b JOIN detected USING (doc_id)")
def detected_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text", F.col("lang").alias("language"))
    told = language.detector(language.profile_of(language.train(labelled), SEED))
    found = cleaned(spark, sf_dir).select(F.col("ordinal").alias("doc_id"), told(F.col("content")).alias("t"))
    return found.where("t.language is not null").select("doc_id", "t.language", F.round("t.probability", 6).alias("probability"))


@query(f"WITH {CLEAN_SQL} SELECT doc_id, t AS content FROM n")
def clean_normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.normalize_text(F.col("text")).alias("content"))


@query(f"WITH {CLEAN_SQL} SELECT doc_id, content, CAST(email + private_ipv4 + aws_access_key + github_token + jwt + bearer_token AS BIGINT) AS redactions FROM b")
def pii_redact(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = F.aggregate(F.map_values("redactions"), F.lit(0).cast("bigint"), lambda a, x: a + x)
    return cleaned(spark, sf_dir).select(F.col("ordinal").alias("doc_id"), "content", total.alias("redactions"))


@query(f"""WITH {CLEAN_SQL}, k AS (
  SELECT 'email' AS kind, sum(email) AS n FROM b UNION ALL SELECT 'private_ipv4', sum(private_ipv4) FROM b UNION ALL SELECT 'aws_access_key', sum(aws_access_key) FROM b
  UNION ALL SELECT 'github_token', sum(github_token) FROM b UNION ALL SELECT 'jwt', sum(jwt) FROM b UNION ALL SELECT 'bearer_token', sum(bearer_token) FROM b)
SELECT kind, CAST(n AS BIGINT) AS n FROM k WHERE n > 0""")
def pii_counts_by_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.redaction_totals(cleaned(spark, sf_dir))


@query(f"WITH {CLEAN_SQL} SELECT doc_id, category, reason IS NULL AS accepted, coalesce(reason, '') AS reason FROM c")
def clean_accept_reject(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gated(spark, sf_dir).select(F.col("ordinal").alias("doc_id"), "category", F.col("reason").isNull().alias("accepted"), F.coalesce("reason", F.lit("")).alias("reason"))


@query(f"WITH {CLEAN_SQL} SELECT source, count(*) AS input, count(*) - count(reason) AS accepted, count(reason) AS rejected FROM c GROUP BY source")
def clean_report_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gated(spark, sf_dir).groupBy("source").agg(F.count("*").alias("input"), F.count_if(F.col("reason").isNull()).alias("accepted"), F.count("reason").alias("rejected"))


@query(f"WITH {CLEAN_SQL} SELECT reason, count(*) AS n FROM c WHERE reason IS NOT NULL GROUP BY reason")
def reject_reason_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gated(spark, sf_dir).where("reason is not null").groupBy("reason").agg(F.count("*").alias("n"))


@query(f"""WITH {CLEAN_SQL} SELECT doc_id, substr(content, 1, 500) AS excerpt FROM c
WHERE reason IS NULL AND email + private_ipv4 + aws_access_key + github_token + jwt + bearer_token > 0 ORDER BY doc_id LIMIT 100""")
def pii_review_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.review_sample(gated(spark, sf_dir), 100).withColumnRenamed("ordinal", "doc_id")


@query(f"SELECT {CATEGORY_SQL} AS category, count(*) AS n FROM documents GROUP BY 1")
def category_inference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interim(spark, sf_dir).groupBy("category").agg(F.count("*").alias("n"))


_LICENSE_SQL = "CASE source " + " ".join(f"WHEN '{s}' THEN '{ALIASES[a]}'" for s, a in SOURCE_LICENSES.items()) + " END"


@query(f"""WITH l AS (SELECT doc_id, {_LICENSE_SQL} AS license FROM documents)
SELECT doc_id, license, coalesce(license IN ({', '.join(f"'{x}'" for x in ALLOWED)}), false) AS allowed FROM l""")
def license_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.try_element_at(F.create_map(*(F.lit(x) for p in SOURCE_LICENSES.items() for x in p)), F.col("source"))
    ids = text.spdx(F.array(F.upper(raw), raw), ALIASES)
    return table(spark, sf_dir, "documents").select("doc_id", F.get(ids, 0).alias("license"), text.first_allowed(ids, ALLOWED).isNotNull().alias("allowed"))


@query(r"SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, length(html) AS chars, len(regexp_extract_all(html, '<a ')) AS links FROM pages")
def pages_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"), F.length("html").cast("bigint").alias("chars"), F.regexp_count("html", F.lit("<a ")).cast("bigint").alias("links"))


@query()
def html_to_text_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", "url", text.html_to_text(F.col("html")).alias("text"))


# ---------------------------------------------------------------- samples


@query(f"""WITH d AS (SELECT doc_id, source, {CATEGORY_SQL} AS category, 'doc-' || doc_id AS source_record_id FROM documents),
k AS (SELECT *, sha256('{SEED}:' || source_record_id) AS key FROM d),
a AS (SELECT *, row_number() OVER (PARTITION BY source, category ORDER BY key, source_record_id) AS r1 FROM k),
b AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY r1, category) AS r2 FROM a WHERE r1 <= 150)
SELECT source_record_id, source, category FROM b ORDER BY r2, source LIMIT 150""")
def reverse_candidate_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.round_robin(interim(spark, sf_dir), 150, SEED, "source_record_id").select("source_record_id", "source", "category")


@query("SELECT 'doc-' || doc_id AS source_record_id, sha256('doc-' || doc_id) AS sample_key FROM documents ORDER BY sample_key LIMIT 200")
def hash_sample_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.hash_sample(interim(spark, sf_dir), 200, "source_record_id").select("source_record_id", "sample_key")


# ---------------------------------------------------------------- splits


def allocated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.allocate(groups(spark, sf_dir), SEED)


@query(f'WITH {GROUPS_SQL}, {SPLIT_SQL} SELECT "group", category, source, split FROM s')
def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return allocated(spark, sf_dir).select("group", "category", "source", "split")


@query(f"""WITH {GROUPS_SQL}, {SPLIT_SQL}
SELECT split, category, source, count(*) AS n FROM s GROUP BY GROUPING SETS ((split), (split, category), (split, source))""")
def split_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.statistics(allocated(spark, sf_dir))


@query(f"""WITH {GROUPS_SQL}, {SPLIT_SQL} SELECT split, count(*) AS n, round(count(*) / (SELECT count(*) FROM s), 6) AS ratio,
 abs(count(*) / (SELECT count(*) FROM s) - CASE split WHEN 'train' THEN 0.9 ELSE 0.05 END) <= 0.005 AS within FROM s GROUP BY split""")
def split_ratio_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.ratio_gate(allocated(spark, sf_dir), {"train": 0.9, "validation": 0.05, "test": 0.05}, 0.005).withColumn("ratio", F.round("ratio", 6))


@query(f'WITH {GROUPS_SQL}, {SPLIT_SQL} SELECT "group", count(DISTINCT split) AS splits FROM s GROUP BY 1 HAVING count(DISTINCT split) > 1')
def split_overlap_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.overlaps(allocated(spark, sf_dir), "group")


@query(f"""WITH {GROUPS_SQL}, {SPLIT_SQL} SELECT "group", split,
 row_number() OVER (PARTITION BY split ORDER BY sha256('{SEED}:' || "group"), "group") - 1 AS position FROM s""")
def shuffle_within_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.shuffled(allocated(spark, sf_dir), SEED, "group").select("group", "split", F.col("position").cast("bigint").alias("position"))


@query(f"""WITH {GROUPS_SQL}, {SPLIT_SQL},
need AS (SELECT category, CASE WHEN category IN ('dockerfile', 'comando_cli') THEN 6 WHEN category = 'troubleshooting' THEN 8 ELSE 0 END AS req FROM (SELECT DISTINCT category FROM s)),
f AS (
  SELECT s."group", s.category, s.split, need.req - sum(CASE WHEN split = 'test' THEN 1 ELSE 0 END) OVER (PARTITION BY s.category) AS deficit,
    row_number() OVER (PARTITION BY s.category, split ORDER BY sha256('{SEED + 1}:' || "group"), "group") - 1 AS bef, need.req FROM s JOIN need USING (category)),
r AS (SELECT "group", category, req, CASE WHEN split = 'train' AND bef < deficit THEN 'test' ELSE split END AS split FROM f),
lv AS (SELECT "group", count(*) OVER (PARTITION BY category) - req - (row_number() OVER (PARTITION BY category ORDER BY sha256('{SEED}:' || "group"), "group") - 1) AS level FROM r WHERE split = 'test'),
ov AS (SELECT greatest(count(*) - 40, 0) AS n FROM r WHERE split = 'test'),
ev AS (SELECT "group", row_number() OVER (ORDER BY level DESC, sha256('{SEED}:' || "group"), "group") AS rk FROM lv WHERE level >= 1)
SELECT r."group", r.category, CASE WHEN ev.rk <= (SELECT n FROM ov) THEN 'train' ELSE r.split END AS split FROM r LEFT JOIN ev ON ev."group" = r."group" """)
def split_rebalanced(spark: SparkSession, sf_dir: str) -> DataFrame:
    required = {"dockerfile": 6, "comando_cli": 6, "troubleshooting": 8}
    return split.rebalance(allocated(spark, sf_dir), "test", required, 40, SEED, strict=False).select("group", "category", "split")


#: Sizes of one to five by the first digit of the hash.
_SIZE_SQL = """1 + instr('0123456789abcdef', substr("group", 1, 1)) % 5"""


@query(f"""WITH {GROUPS_SQL.replace("CAST(1 AS BIGINT) AS size", f"CAST({_SIZE_SQL.replace(chr(34) + 'group' + chr(34), 'd.' + chr(34) + 'group' + chr(34))} AS BIGINT) AS size")}, {SPLIT_SQL},
need AS (SELECT category, CASE WHEN category IN ('dockerfile', 'comando_cli') THEN 6 WHEN category = 'troubleshooting' THEN 8 ELSE 0 END AS req FROM (SELECT DISTINCT category FROM s)),
f AS (
  SELECT s."group", s.category, s.size, s.split, need.req, need.req - sum(CASE WHEN split = 'test' THEN size ELSE 0 END) OVER (PARTITION BY s.category) AS deficit,
    coalesce(sum(size) OVER (PARTITION BY s.category, split ORDER BY sha256('{SEED + 1}:' || "group"), "group" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bef FROM s JOIN need USING (category)),
r AS (SELECT "group", category, size, req, CASE WHEN split = 'train' AND bef < deficit THEN 'test' ELSE split END AS split FROM f),
lv AS (SELECT "group", size, sum(size) OVER (PARTITION BY category) - req - coalesce(sum(size) OVER (PARTITION BY category ORDER BY size, sha256('{SEED}:' || "group"), "group" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS surplus
       FROM r WHERE split = 'test'),
ev AS (SELECT "group", coalesce(sum(size) OVER (ORDER BY surplus DESC, size, sha256('{SEED}:' || "group"), "group" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS gone FROM lv WHERE surplus >= size)
SELECT r."group", r.category, r.size, CASE WHEN ev.gone < (SELECT sum(size) - 40 FROM r WHERE split = 'test') THEN 'train' ELSE r.split END AS split FROM r LEFT JOIN ev ON ev."group" = r."group" """)
def split_rebalanced_by_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = groups(spark, sf_dir).withColumn("size", (1 + F.expr("instr('0123456789abcdef', substr(group, 1, 1))") % 5).cast("bigint"))
    required = {"dockerfile": 6, "comando_cli": 6, "troubleshooting": 8}
    return split.rebalance(split.allocate(sized, SEED), "test", required, 40, SEED, strict=False).select("group", "category", "size", "split")


_HARD_SQL = "(CASE WHEN {c} >= 2 THEN 1 ELSE 0 END + {r})".format(
    c=" + ".join(f"CAST(contains(lower(text), '{w}') AS INTEGER)" for w in quality.COMPONENTS),
    r=" + ".join(
        f"CAST(regexp_matches(lower(text), '{p.replace('(?U)', '').replace(chr(92) + 'b', '(^|[^' + chr(92) + 'p{L}' + chr(92) + 'p{N}_]|$)')}'){' OR contains(text, ' + chr(39) + '```' + chr(39) + ')' if n == 'contains_logs_or_events' else ''} AS INTEGER)"
        for n, p in quality.HARD_FEATURES.items()
    ),
)


@query(f"SELECT doc_id, CAST({_HARD_SQL} AS INTEGER) AS score FROM documents")
def hard_complexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.size(quality.hard_features(F.col("text"))).alias("score"))


@query(f"""WITH h AS (SELECT 'doc-' || doc_id AS content_hash, source, doc_id % 29 = 0 AS explicit, {_HARD_SQL} AS score FROM documents)
SELECT content_hash, source, CAST(score AS INTEGER) AS score FROM h WHERE score >= 1 ORDER BY NOT explicit, score DESC, sha256('{SEED}:' || content_hash), content_hash
LIMIT (SELECT least(100, greatest(5, CAST(ceil(count(*) * 0.05) AS BIGINT))) FROM documents)""")
def hard_test_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    rows = d.select(F.concat(F.lit("doc-"), "doc_id").alias("content_hash"), "source", F.lit("any").alias("category"), (F.col("doc_id") % 29 == 0).alias("explicit"), F.size(quality.hard_features(F.col("text"))).alias("score"))
    return split.hard_test(rows, d.count(), "any", 5, 100, 0.05, 3, SEED).select("content_hash", "source", "score")


@query(f"""WITH d AS (SELECT 'doc-' || doc_id AS content_hash, source, {CATEGORY_SQL} AS category, n_chars > 4000 AS hard, sha256('{SEED}:doc-' || doc_id) AS key FROM documents),
h AS (SELECT content_hash FROM d WHERE hard ORDER BY key LIMIT 40),
r AS (SELECT *, row_number() OVER (PARTITION BY category, source ORDER BY key, content_hash) AS rn FROM d WHERE content_hash NOT IN (SELECT content_hash FROM h)),
q AS (SELECT content_hash FROM r ORDER BY rn, category, source LIMIT (SELECT 150 - count(*) FROM h))
SELECT content_hash, category, source, hard FROM d WHERE content_hash IN (SELECT content_hash FROM h UNION ALL SELECT content_hash FROM q)""")
def judge_manifest_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = interim(spark, sf_dir).select(F.col("source_record_id").alias("content_hash"), "category", "source", (F.length("raw_content") > 4000).alias("hard"))
    return split.judge_sample(d, 150, 40, SEED).select("content_hash", "category", "source", "hard")


# ---------------------------------------------------------------- quality



@query(r"""WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{M}\p{N}_]+|[^\p{L}\p{M}\p{N}_\s]') AS w FROM documents),
t AS (SELECT doc_id, unnest(w) AS tok, generate_subscripts(w, 1) AS pos FROM w),
g AS (SELECT doc_id, tok || ' ' || lead(tok, 1) OVER p || ' ' || lead(tok, 2) OVER p || ' ' || lead(tok, 3) OVER p || ' ' || lead(tok, 4) OVER p || ' ' ||
        lead(tok, 5) OVER p || ' ' || lead(tok, 6) OVER p || ' ' || lead(tok, 7) OVER p AS g FROM t WINDOW p AS (PARTITION BY doc_id ORDER BY pos)),
r AS (SELECT doc_id, count(g) AS n, count(DISTINCT g) AS d FROM g GROUP BY doc_id)
SELECT documents.doc_id, CASE WHEN coalesce(n, 0) = 0 THEN 0.0 ELSE round((n - d) / n, 9) END AS ratio FROM documents LEFT JOIN r USING (doc_id)""")
def ngram_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.round(quality.repeated_ngram_ratio(F.col("text"), 8), 9).alias("ratio"))


@query("""WITH h AS (SELECT sha256(text) AS h, count(*) AS n FROM documents GROUP BY 1)
SELECT count(*) AS groups, CAST(sum(CASE WHEN n > 1 THEN 1 ELSE 0 END) AS BIGINT) AS duplicate_groups, CAST(sum(n - 1) AS BIGINT) AS excess, CAST(max(n) AS BIGINT) AS max_frequency FROM h""")
def duplicate_group_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = table(spark, sf_dir, "documents").groupBy(text.sha(F.col("text")).alias("h")).agg(F.count("*").alias("n"))
    return h.agg(F.count("*").alias("groups"), F.count_if(F.col("n") > 1).alias("duplicate_groups"), F.sum(F.col("n") - 1).alias("excess"), F.max("n").alias("max_frequency"))


@query("""WITH r AS (SELECT source, n_chars, row_number() OVER (PARTITION BY source ORDER BY n_chars) - 1 AS rk, count(*) OVER (PARTITION BY source) AS n FROM documents)
SELECT source, max(n) AS count, min(n_chars) AS min, max(n_chars) AS max, max(CASE WHEN rk = CAST(round_even((n - 1) * 0.5, 0) AS BIGINT) THEN n_chars END) AS p50,
 max(CASE WHEN rk = CAST(round_even((n - 1) * 0.9, 0) AS BIGINT) THEN n_chars END) AS p90, max(CASE WHEN rk = CAST(round_even((n - 1) * 0.99, 0) AS BIGINT) THEN n_chars END) AS p99 FROM r GROUP BY source""")
def length_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.percentile_ranks(table(spark, sf_dir, "documents"), "n_chars", (0.5, 0.9, 0.99), "source")


@query("""SELECT count(*) AS input_records, CAST(sum(CASE WHEN n_chars <= 8192 THEN 1 ELSE 0 END) AS BIGINT) AS kept_records,
 CAST(sum(CASE WHEN n_chars > 8192 THEN 1 ELSE 0 END) AS BIGINT) AS excluded_records, round(avg(CASE WHEN n_chars > 8192 THEN 1.0 ELSE 0.0 END), 9) AS excluded_rate, max(n_chars) AS maximum FROM documents""")
def length_filter_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = validation.token_filter(table(spark, sf_dir, "documents"), 8192, "n_chars")
    return d.agg(F.count("*").alias("input_records"), F.count_if("kept").alias("kept_records"), F.count_if(~F.col("kept")).alias("excluded_records"), F.round(F.avg((~F.col("kept")).cast("double")), 9).alias("excluded_rate"), F.max("n_chars").alias("maximum"))


# ---------------------------------------------------------------- joins and gates over documents


@query("SELECT l.doc_id, d.source, l.quality FROM labels l JOIN documents d USING (doc_id)")
def manifest_order_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkloom.operators.relational import in_manifest_order

    manifest = table(spark, sf_dir, "labels").select("doc_id", F.col("doc_id").alias("position"), "quality")
    return in_manifest_order(manifest, table(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id").select("doc_id", "source", "quality")


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def excluded_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkloom.operators.relational import without

    return without(table(spark, sf_dir, "documents").select("doc_id", "source"), table(spark, sf_dir, "labels").where("toxic = 1"), "doc_id")


@query("SELECT count(*) AS overlap FROM benchmark WHERE sha256(text) IN (SELECT sha256(text) FROM documents)")
def holdout_overlap_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = lambda n: table(spark, sf_dir, n).select(text.sha(F.col("text")).alias("h"))
    return h("benchmark").join(h("documents"), "h", "left_semi").agg(F.count("*").alias("overlap"))


@query("""WITH l AS (SELECT DISTINCT doc_id FROM labels), d AS (SELECT DISTINCT doc_id FROM documents)
SELECT doc_id, 'left' AS side FROM l WHERE doc_id NOT IN (SELECT doc_id FROM d) UNION ALL SELECT doc_id, 'right' FROM d WHERE doc_id NOT IN (SELECT doc_id FROM l)""")
def set_equality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkloom.operators.relational import set_difference

    return set_difference(table(spark, sf_dir, "labels"), table(spark, sf_dir, "documents"), "doc_id")


@query()
def markdown_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkloom.sources.files import markdown_chunks as chunk

    d = table(spark, sf_dir, "documents").select(F.concat(F.lit("doc-"), "doc_id").alias("path"), F.concat(F.lit("# Title "), "doc_id", F.lit("\n\n"), F.regexp_replace("text", "\n", "\n\n")).alias("text"))
    return chunk(d, 200, 2000, 100)


@query(f"""WITH d AS (SELECT doc_id, source, {CATEGORY_SQL} AS category FROM documents)
SELECT source, category, count(*) AS n FROM d GROUP BY GROUPING SETS ((source), (category), ())""")
def datasheet_distributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    interim(spark, sf_dir).createOrReplaceTempView("_interim")
    return spark.sql("SELECT source, category, count(*) AS n FROM _interim GROUP BY GROUPING SETS ((source), (category), ())")
