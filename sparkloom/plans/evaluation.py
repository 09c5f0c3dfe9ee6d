"""Queries over conversations, embeddings, events and the order tables: chat records, similarity, benchmark statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkloom.functions import quality, text
from sparkloom.operators import dedupe, neighbours, probes, relational, repair, similarity, stats, validation
from sparkloom.plans.bridges import EXCHANGES_SQL, RESULTS_SQL, exchanges, query, results, table

# ---------------------------------------------------------------- chat records


@query(f'WITH {EXCHANGES_SQL} SELECT conv_id, turn, system, "user", assistant FROM pairs')
def chatml_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exchanges(spark, sf_dir).select("conv_id", "turn", "system", "user", "assistant")


@query(f"""WITH {EXCHANGES_SQL} SELECT CASE WHEN trim(system) = '' OR trim("user") = '' OR trim(assistant) = '' THEN 'blank_content' ELSE 'valid' END AS outcome, count(*) AS n FROM pairs GROUP BY 1""")
def chatml_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta = {"source": F.lit("conversations"), "category": F.lit("concepto"), "license": F.lit("CC0-1.0"), "url": F.lit("https://example.org")}
    problem = validation.chat_problem(F.col("messages"), meta)
    return exchanges(spark, sf_dir).groupBy(F.coalesce(problem, F.lit("valid")).alias("outcome")).agg(F.count("*").alias("n"))


_CANON = r"""regexp_replace(regexp_replace(regexp_replace(assistant, '[ \t]+', ' ', 'g'), '\s*\n\s*', chr(10), 'g'), '^\s+|\s+$', '', 'g')"""


@query(f"""WITH {EXCHANGES_SQL}, c AS (SELECT conv_id, turn, {_CANON} AS a FROM pairs), d AS (SELECT a, count(*) AS n FROM c GROUP BY a)
SELECT count(*) AS answers, CAST(sum(n) AS BIGINT) AS records, CAST(sum(CASE WHEN n > 1 THEN n ELSE 0 END) AS BIGINT) AS matched FROM d""")
def canonical_answer_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = exchanges(spark, sf_dir).groupBy(text.canonical_answer(F.col("assistant")).alias("a")).agg(F.count("*").alias("n"))
    return d.agg(F.count("*").alias("answers"), F.sum("n").alias("records"), F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).alias("matched"))


@query(f"""WITH {EXCHANGES_SQL} SELECT conv_id, turn, sha256(trim("user", E' \\n\\t\\r') || chr(10) || chr(10) || trim(assistant, E' \\n\\t\\r')) AS h FROM pairs""")
def semantic_text_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exchanges(spark, sf_dir).select("conv_id", "turn", text.sha(text.semantic_text(F.col("messages"))).alias("h"))


@query(f"""WITH {EXCHANGES_SQL}, k AS (SELECT conv_id, turn, length(assistant) % 3 AS k, trim(system, E' \\n\\t') AS system, "user" FROM pairs)
SELECT conv_id, turn, CASE k WHEN 0 THEN 2 WHEN 1 THEN 2 END AS messages, CASE k WHEN 0 THEN system || chr(10) || chr(10) || 'Be concise.' WHEN 1 THEN 'Be concise.' END AS first FROM k""")
def prompt_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompts of records with a system turn, without one, and with nothing that the user asks."""
    k = F.length("assistant") % 3
    turn = lambda r, c: F.struct(F.lit(r).alias("role"), c.alias("content"))
    e = exchanges(spark, sf_dir)
    shaped = F.when(k == 0, F.col("messages")).when(k == 1, F.array(turn("user", F.col("user")), turn("assistant", F.col("assistant")))).otherwise(F.array(turn("system", F.col("system")), turn("user", F.lit("  "))))
    made = e.select("conv_id", "turn", text.prompt_messages(shaped, "Be concise.").alias("m"))
    return made.select("conv_id", "turn", F.size("m").alias("messages"), F.get("m", 0)["content"].alias("first")).withColumn("messages", F.when(F.col("first").isNotNull(), F.col("messages")))


def measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = exchanges(spark, sf_dir)
    return e.withColumns(quality.measure(F.col("user"), F.col("assistant"), F.lit("concepto"))).withColumn("flags", quality.flags())


@query(rf"""WITH {EXCHANGES_SQL} SELECT conv_id, turn FROM pairs WHERE NOT (conv_id % 2 = 0 AND
 len([x for x in string_split(assistant, chr(10)) if regexp_matches(x, '^\s*(?:[-*+]|\d+[.)])\s+\S')]) >= 10)""")
def tier_a_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    tier = F.arrays_overlap("flags", F.array(*map(F.lit, quality.TIER_A)))
    return measured(spark, sf_dir).where(~((F.col("conv_id") % 2 == 0) & tier)).select("conv_id", "turn")


# ---------------------------------------------------------------- literal texts

_FENCE = "```"


@query()
def extract_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = exchanges(spark, sf_dir)
    wrapped = F.when(F.col("conv_id") % 3 == 0, F.concat(F.lit(f"{_FENCE}yaml\nkind: Pod\nname: "), F.col("conv_id"), F.lit(f"\n{_FENCE}"))).when(F.col("conv_id") % 3 == 1, F.lit(f"{_FENCE}\nFROM a\nRUN b\n{_FENCE}")).otherwise(F.col("assistant"))
    return e.withColumn("w", wrapped).select("conv_id", "turn", text.extract_yaml(F.col("w")).alias("yaml"), text.extract_dockerfile(F.col("w")).alias("dockerfile"))


@query(f"""WITH {EXCHANGES_SQL}, b AS (SELECT conv_id, turn, CASE WHEN length(assistant) % 3 = 0 THEN 'FROM a' || chr(10) || 'RUN b' ELSE assistant END AS a, CASE WHEN length("user") % 2 = 0 THEN 'dockerfile' WHEN length("user") % 3 = 0 THEN 'generacion_yaml' ELSE 'arquitectura' END AS category FROM pairs),
h AS (SELECT *, [upper(x) for x in regexp_extract_all(a, '(?mi)^\\s*(FROM|ARG|RUN|COPY|ADD|CMD|ENTRYPOINT|ENV|EXPOSE|WORKDIR|USER|VOLUME|LABEL|HEALTHCHECK|SHELL|STOPSIGNAL|ONBUILD)\\b', 1)] AS i FROM b),
d AS (SELECT *, len(i) >= 2 AND list_contains(i, 'FROM') AND i[1] IN ('ARG', 'FROM') AS has FROM h)
SELECT conv_id, turn, CASE WHEN has AND category = 'arquitectura' THEN 'dockerfile' WHEN category = 'dockerfile' AND NOT has THEN 'concepto' ELSE category END AS category,
 CASE WHEN has AND category = 'arquitectura' THEN 'dockerfile_block_detected' WHEN category = 'dockerfile' AND NOT has THEN 'dockerfile_block_missing' ELSE '' END AS reason FROM d""")
def category_reclassification(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Categories brought in line with whether the answer is a Dockerfile; SQL looks for instructions in the same texts."""
    n, m = F.length("assistant"), F.length("user")
    e = exchanges(spark, sf_dir).withColumn("category", F.when(m % 2 == 0, "dockerfile").when(m % 3 == 0, "generacion_yaml").otherwise("arquitectura"))
    e = e.withColumn("assistant", F.when(n % 3 == 0, F.lit("FROM a\nRUN b")).otherwise(F.col("assistant")))
    return validation.reclassify(e).select("conv_id", "turn", "category", F.coalesce("category_reclassification.reason", F.lit("")).alias("reason"))


#: What a generator may answer, by the length of the user's text: the text itself, a blank instruction, one that points to a document, the instruction in a fence.
_MADE = f"""CASE length("user") % 4 WHEN 0 THEN "user" WHEN 1 THEN '{{{{"user": "  "}}}}' WHEN 2 THEN '{{{{"user": "Explica según el documento la red"}}}}' ELSE '{_FENCE}json' || chr(10) || to_json({{{{'user': "user"}}}}) || chr(10) || '{_FENCE}' END""".replace("{{", "{").replace("}}", "}")


@query(f"""WITH {EXCHANGES_SQL}, t AS (SELECT conv_id, turn, {_MADE} AS made FROM pairs),
u AS (SELECT conv_id, turn, CASE WHEN starts_with(made, '{_FENCE}') THEN trim(regexp_replace(regexp_replace(made, '^{_FENCE}[^\\n]*\\n', ''), '\\n{_FENCE}$', '')) ELSE made END AS body FROM t),
v AS (SELECT conv_id, turn, json_valid(body) AS ok, CASE WHEN json_valid(body) AND json_type(body) = 'OBJECT' THEN trim(json_extract_string(body, '$.user'), E' \\n\\t') END AS said FROM u)
SELECT conv_id, turn, CASE WHEN NOT ok THEN 'invalid_json' WHEN coalesce(said, '') = '' THEN 'missing_user' WHEN regexp_matches(said, '(?i)según el (fragmento|referencia|contenido|documento|documentación|informe|ejemplo)') THEN 'not_self_contained' ELSE 'accepted' END AS outcome,
 CASE WHEN ok AND coalesce(said, '') <> '' AND NOT regexp_matches(said, '(?i)según el documento') THEN said END AS instruction FROM v""")
def generated_user_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What generators answer, parsed: the instruction, or why it is rejected."""
    k = F.length("user") % 4
    made = F.when(k == 0, F.col("user")).when(k == 1, '{"user": "  "}').when(k == 2, '{"user": "Explica según el documento la red"}').otherwise(F.concat(F.lit(f"{_FENCE}json\n"), F.to_json(F.struct("user")), F.lit(f"\n{_FENCE}")))
    return exchanges(spark, sf_dir).withColumn("p", text.parse_generated_user(made)).select("conv_id", "turn", F.coalesce("p.reason", F.lit("accepted")).alias("outcome"), F.col("p.user").alias("instruction"))


@query(f"""WITH {EXCHANGES_SQL}, t AS (SELECT conv_id, turn, '{{{{"correctness": ' || length("user") % 7 || ', "completeness": 3, "rationale": " r "}}}}' AS payload FROM pairs),
s AS (SELECT conv_id, turn, CAST(json_extract(payload, '$.correctness') AS DOUBLE) AS a, CAST(json_extract(payload, '$.completeness') AS DOUBLE) AS b, trim(json_extract_string(payload, '$.rationale')) AS r FROM t)
SELECT conv_id, turn, CASE WHEN a BETWEEN 1 AND 5 AND b BETWEEN 1 AND 5 THEN (a + b) / 2 END AS mean, CASE WHEN a BETWEEN 1 AND 5 AND b BETWEEN 1 AND 5 THEN r END AS rationale FROM s""".replace("{{", "{").replace("}}", "}"))
def judge_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores out of a judge's payloads; SQL parses the same payloads."""
    payload = F.format_string('{"correctness": %d, "completeness": 3, "rationale": " r "}', F.length("user") % 7)
    return exchanges(spark, sf_dir).select("conv_id", "turn", validation.judge(payload).alias("j")).select("conv_id", "turn", "j.mean", "j.rationale")


# ---------------------------------------------------------------- similarity

TAU = 0.4
_COS = "list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))"
_EDGES = f"e AS (SELECT a.vec_id AS src, b.vec_id AS dst, {_COS} AS score FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id WHERE {_COS} >= {TAU})"
_COMPONENTS = f"""{_EDGES}, u AS (SELECT src, dst FROM e UNION ALL SELECT dst, src FROM e),
reach(id, r) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT reach.id, u.dst FROM reach JOIN u ON u.src = reach.r),
c AS (SELECT id, min(r) AS component FROM reach GROUP BY id)"""


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), "label")


@query(f"WITH {_EDGES} SELECT src, dst, round(score, 6) AS score FROM e")
def knn_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity.cosine_pairs(vectors(spark, sf_dir).select("id", "vector"), TAU).withColumn("score", F.round("score", 6))


@query(f"""WITH s AS (SELECT a.vec_id AS query, b.vec_id AS reference, {_COS} AS score FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, reference) AS rank FROM s)
SELECT query, reference, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 5""")
def cosine_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = vectors(spark, sf_dir).select("id", "vector")
    return topk_others(v.where(F.col("id") % 100 == 0), v, 5).withColumns({"score": F.round("score", 6), "rank": F.col("rank").cast("int")})


def topk_others(queries: DataFrame, references: DataFrame, top: int) -> DataFrame:
    """``similarity.nearest`` of queries that are references too, without themselves."""
    found = similarity.nearest(queries, references, top + 1).where("query <> reference")
    rank = F.row_number().over(Window.partitionBy("query").orderBy("rank"))
    return found.withColumn("rank", rank).where(F.col("rank") <= top)


def _components(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = vectors(spark, sf_dir)
    return similarity.components(v, neighbours.exact_links(v.select("id", "vector"), TAU))


@query(f"WITH RECURSIVE {_COMPONENTS} SELECT id, component FROM c")
def near_dup_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _components(spark, sf_dir)


@query(f"""WITH RECURSIVE {_COMPONENTS}, m AS (SELECT component, 'vec-' || id AS h, CASE WHEN label <= 2 THEN label ELSE 99 END AS tier, id % 3 AS quality FROM c JOIN embeddings ON vec_id = id)
SELECT component, count(*) AS size, arg_min(h, lpad(CAST(100 - quality AS VARCHAR), 3, '0') || lpad(CAST(tier AS VARCHAR), 3, '0') || h) AS representative, sha256(string_agg(h, '|' ORDER BY h)) AS semantic_cluster_id FROM m GROUP BY component""")
def near_dup_representatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _components(spark, sf_dir).join(vectors(spark, sf_dir).select("id", "label"), "id")
    m = c.select("component", F.concat(F.lit("vec-"), "id").alias("content_hash"), F.when(F.col("label") <= 2, F.col("label")).otherwise(99).alias("tier"), (F.col("id") % 3).cast("double").alias("quality"))
    return dedupe.representatives(m)


@query(f"WITH RECURSIVE {_COMPONENTS}, z AS (SELECT component, count(*) AS size FROM c GROUP BY component) SELECT size, count(*) AS components FROM z GROUP BY size")
def cluster_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.size_histogram(_components(spark, sf_dir))


def assigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("id") % 20
    return vectors(spark, sf_dir).withColumns({"split": F.when(k == 0, "test").when(k == 1, "validation").otherwise("train"), "category": F.concat(F.lit("c"), F.col("label") % 2), "source": F.lit("s"), "hardness": F.lit(0)})


_SPLIT = "CASE vec_id % 20 WHEN 0 THEN 'test' WHEN 1 THEN 'validation' ELSE 'train' END"


@query(f"""WITH v AS (SELECT vec_id, embedding, {_SPLIT} AS split FROM embeddings),
p(q, r) AS (VALUES ('validation', 'train'), ('test', 'train'), ('test', 'validation')),
s AS (SELECT a.vec_id AS query, b.vec_id AS reference, p.q AS query_split, p.r AS reference_split, {_COS} AS score FROM p JOIN v a ON a.split = p.q JOIN v b ON b.split = p.r),
r AS (SELECT *, row_number() OVER (PARTITION BY query, reference_split ORDER BY score DESC, reference) AS rk FROM s)
SELECT query, reference, round(score, 6) AS score, query_split, reference_split FROM r WHERE rk = 1 AND score >= 0.4""")
def cross_split_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = [("train", "validation"), ("train", "test"), ("validation", "test")]
    return similarity.leaks(assigned(spark, sf_dir), pairs, 0.4).withColumn("score", F.round("score", 6))


def grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors in groups of one, two and three neighbours; every twentieth group is test, the one after it validation."""
    n = F.floor(F.col("id") / 6) * 3 + F.when(F.col("id") % 6 == 0, 0).when(F.col("id") % 6 < 3, 1).otherwise(2)
    v = assigned(spark, sf_dir).drop("split", "category").withColumn("n", n)
    return v.select("id", "vector", F.concat(F.lit("g"), "n").alias("group"), F.concat(F.lit("c"), F.floor(F.col("n") / 3) % 2).alias("category"), "source", "hardness", F.when(F.col("n") % 20 == 0, "test").when(F.col("n") % 20 == 1, "validation").otherwise("train").alias("split"))


def _repair_sql(threshold: float, rounds: int, seed: int = 3407) -> str:
    """The repair in SQL, round by round: links between groups, needs, pools in order, and a recursive walk through each stratum's needs."""
    n = "(id // 6) * 3 + CASE WHEN id % 6 = 0 THEN 0 WHEN id % 6 < 3 THEN 1 ELSE 2 END"
    out = f"""WITH RECURSIVE v AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS e, {n} AS n FROM (SELECT *, vec_id AS id FROM embeddings)),
links AS MATERIALIZED (SELECT DISTINCT a.n AS a, b.n AS b FROM v a JOIN v b ON a.n <> b.n AND list_cosine_similarity(a.e, b.e) >= {threshold}),
s0 AS (SELECT n, 'g' || n AS grp, 'c' || (n // 3) % 2 AS category, count(*) AS size, CASE n % 20 WHEN 0 THEN 'test' WHEN 1 THEN 'validation' ELSE 'train' END AS split, false AS blocked FROM v GROUP BY n)"""
    for r in range(1, rounds + 1):
        out += f""",
l{r} AS MATERIALIZED (SELECT DISTINCT x.n FROM links JOIN s{r - 1} x ON x.n = a JOIN s{r - 1} y ON y.n = b WHERE (x.split = 'validation' AND y.split = 'train') OR (x.split = 'test' AND y.split <> 'test')),
m{r} AS MATERIALIZED (SELECT n, grp, category, size, CASE WHEN n IN (FROM l{r}) THEN 'train' ELSE split END AS split, blocked OR n IN (FROM l{r}) AS blocked FROM s{r - 1}),
n{r} AS MATERIALIZED (SELECT category, split AS target, size, row_number() OVER (PARTITION BY category ORDER BY grp) AS k FROM s{r - 1} WHERE n IN (FROM l{r})),
p{r} AS MATERIALIZED (SELECT t.target, c.category, c.n, c.size, row_number() OVER (PARTITION BY t.target, c.category ORDER BY sha256('{seed + r}:' || c.grp), c.grp) AS place
  FROM m{r} c JOIN (SELECT target, category, max(size) AS largest FROM n{r} GROUP BY ALL) t ON t.category = c.category AND c.size <= t.largest
  WHERE c.split = 'train' AND NOT c.blocked AND NOT EXISTS (SELECT 1 FROM links JOIN m{r} o ON o.n = b WHERE a = c.n AND o.split <> t.target)),
w{r} AS (
  SELECT category, k, target, size AS unfilled, 0::BIGINT AS at, []::BIGINT[] AS taken, []::VARCHAR[] AS goes, 0 AS step FROM n{r} WHERE k = 1
  UNION ALL
  SELECT category, CASE WHEN chosen IS NULL THEN next.k ELSE q.k END, CASE WHEN chosen IS NULL THEN next.target ELSE q.target END, CASE WHEN chosen IS NULL THEN next.size ELSE q.unfilled - chosen.size END,
    CASE WHEN chosen IS NULL THEN 0 ELSE chosen.place END, CASE WHEN chosen IS NULL THEN taken ELSE list_append(taken, chosen.n) END, CASE WHEN chosen IS NULL THEN goes ELSE list_append(goes, q.target) END, step + 1
  FROM (SELECT w.*, (SELECT arg_min({{'n': p.n, 'size': p.size, 'place': p.place}}, p.place) FROM p{r} p
                     WHERE p.category = w.category AND p.target = w.target AND p.place > w.at AND p.size <= w.unfilled AND NOT list_contains(w.taken, p.n)) AS chosen FROM w{r} w) q
  LEFT JOIN n{r} next USING (category) WHERE (chosen IS NULL AND next.k = q.k + 1) OR (chosen IS NOT NULL AND next.k = q.k)),
f{r} AS (SELECT unnest(taken) AS n, unnest(goes) AS split FROM (SELECT arg_max(taken, step) AS taken, arg_max(goes, step) AS goes FROM w{r} GROUP BY category)),
s{r} AS MATERIALIZED (SELECT m.n, m.grp, m.category, m.size, coalesce(f.split, m.split) AS split, m.blocked FROM m{r} m LEFT JOIN f{r} f USING (n))"""
    return out + f"""
SELECT v.id, s.grp AS "group", s.split FROM v JOIN s{rounds} s USING (n)"""


#: Rounds of the repair.
_ROUNDS = 4


@query(_repair_sql(0.4, _ROUNDS))
def leak_repair_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = [("train", "validation"), ("train", "test"), ("validation", "test")]
    return repair.repair(grouped(spark, sf_dir), pairs, 0.4, most_rounds=_ROUNDS, strict=False).select("id", "group", "split")


@query("SELECT a.vec_id, round(list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) AS similarity FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1")
def paired_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = table(spark, sf_dir, "embeddings")
    other = v.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    dot = F.aggregate(F.zip_with("embedding", "other", lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda a, x: a + x)
    return v.join(other, "vec_id").select("vec_id", F.round(dot, 6).alias("similarity"))


# ---------------------------------------------------------------- benchmark statistics

_SD = "CASE WHEN count(v) = 1 THEN 0 ELSE stddev_samp(v) END"
_MARGIN = "1.96 * CASE WHEN count(v) = 1 THEN 0 ELSE stddev_samp(v) / sqrt(count(v)) END"
_CI = f"""count(v) AS count, round(round(avg(v), 8), 6) AS mean, round(round({_SD}, 8), 6) AS stddev,
 round(round(avg(v) - {_MARGIN}, 8), 6) AS ci95_low, round(round(avg(v) + {_MARGIN}, 8), 6) AS ci95_high"""


def _six(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in ("mean", "stddev", "ci95_low", "ci95_high")})


@query(f"WITH {RESULTS_SQL}, m AS (SELECT category, CASE WHEN isfinite(value) THEN value END AS v FROM r) SELECT category, 'value' AS metric, {_CI} FROM m GROUP BY category")
def metrics_mean_ci(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _six(stats.summarize(results(spark, sf_dir), ["value"], "category"))


_MEASURED = {
    "exact_match": "CASE WHEN category IN ('click', 'view') THEN CAST(completion_tokens % 2 AS DOUBLE) END", "semantic_similarity": "CAST(completion_tokens AS DOUBLE) / 400", "syntax_validity": "CASE WHEN completion_tokens < 50 THEN 1.0 END",
    "llm_judge": "CASE WHEN completion_tokens % 3 = 0 THEN 1 + CAST(completion_tokens % 5 AS DOUBLE) END", "truncation_rate": "CAST(CAST(truncated AS INTEGER) AS DOUBLE)", "retry_rate": "CASE WHEN retry_count > 0 THEN 1.0 ELSE 0.0 END",
    "generation_attempts": "CAST(greatest(retry_count + completion_tokens % 2, 1) AS DOUBLE)", "generated_completion_tokens_total": "CASE WHEN completion_tokens > 10 THEN CAST(completion_tokens * 2 AS DOUBLE) END", "latency_seconds": "value",
    "tokens_per_second": "CASE WHEN value > 0 THEN completion_tokens / value END", "batch_tokens_per_second": "CASE WHEN retry_count = 0 THEN CAST(completion_tokens AS DOUBLE) END", "generation_batch_size": "CAST(CASE WHEN retry_count = 0 THEN 4 ELSE 1 END AS DOUBLE)",
}


@query(f"""WITH {RESULTS_SQL}, x AS (SELECT *, completion_tokens % 50 = 7 AS bad FROM r), m AS ({' UNION ALL '.join(f"SELECT category, '{k}' AS metric, bad, CASE WHEN NOT bad AND isfinite({v}) THEN {v} END AS v FROM x" for k, v in _MEASURED.items())})
SELECT metric, category, count(*) AS records, CAST(sum(CAST(NOT bad AS INTEGER)) AS BIGINT) AS generated, CAST(sum(CAST(bad AS INTEGER)) AS BIGINT) AS errors, {_CI} FROM m GROUP BY GROUPING SETS ((metric, category), (metric))""")
def metrics_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All metrics with intervals, records, generated and errors, overall and by category."""
    n = F.col("completion_tokens")
    r = results(spark, sf_dir).select(
        "category", F.when(n % 50 == 7, "failed").alias("error"), F.when(F.col("category").isin("click", "view"), (n % 2).cast("double")).alias("exact_match"), (n.cast("double") / 400).alias("semantic_similarity"), F.when(n < 50, 1.0).alias("syntax_valid"),
        F.when(n % 3 == 0, F.struct((1 + n % 5).cast("double").alias("mean"))).alias("judge"), "truncated", "retry_count", (F.col("retry_count") + n % 2).alias("generation_attempts"), F.when(n > 10, n * 2).alias("generated_completion_tokens_total"),
        F.col("value").alias("latency_seconds"), F.when(F.col("value") > 0, n / F.col("value")).alias("tokens_per_second"), F.when(F.col("retry_count") == 0, n.cast("double")).alias("batch_tokens_per_second"), F.when(F.col("retry_count") == 0, 4).otherwise(1).alias("generation_batch_size"),
    )
    return _six(stats.aggregate_results(r))


_RUNS = """l AS (SELECT doc_id AS k, quality = 0 AS truncated, toxic AS retry_count FROM labels),
q AS (SELECT l.k, l.truncated AS lt, l.retry_count > 0 AS lr, (l.k % 11 = 0) AS rt, (l.k % 3 = 0) AS rr, CAST(l.k % 7 AS DOUBLE) / 7 AS ls, CAST(l.k % 5 AS DOUBLE) / 5 AS rs FROM l)"""


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = table(spark, sf_dir, "labels").withColumn("k", F.col("doc_id"))
    left = l.select("k", (F.col("quality") == 0).alias("truncated"), F.col("toxic").alias("retry_count"), ((F.col("k") % 7).cast("double") / 7).alias("similarity"))
    right = l.select("k", (F.col("k") % 11 == 0).alias("truncated"), (F.col("k") % 3 == 0).cast("int").alias("retry_count"), ((F.col("k") % 5).cast("double") / 5).alias("similarity"))
    return stats.pair_up(left, right, "k")


@query(f"""WITH {_RUNS}, c AS (SELECT
 sum(CASE WHEN NOT lt AND rt THEN 1 ELSE 0 END) AS a, sum(CASE WHEN lt AND NOT rt THEN 1 ELSE 0 END) AS b, sum(CASE WHEN lt AND rt THEN 1 ELSE 0 END) AS c,
 sum(CASE WHEN NOT lr AND rr THEN 1 ELSE 0 END) AS d, sum(CASE WHEN lr AND NOT rr THEN 1 ELSE 0 END) AS e, sum(CASE WHEN lr AND rr THEN 1 ELSE 0 END) AS f,
 sum(CAST(lt AS INTEGER)) AS g, sum(CAST(lr AS INTEGER)) AS h, sum(CAST(rt AS INTEGER)) AS i, sum(CAST(rr AS INTEGER)) AS j FROM q)
SELECT CAST(a AS BIGINT) AS new_truncations, CAST(b AS BIGINT) AS resolved_truncations, CAST(c AS BIGINT) AS both_truncated, CAST(d AS BIGINT) AS new_retries, CAST(e AS BIGINT) AS resolved_retries,
 CAST(f AS BIGINT) AS both_retried, coalesce(g / nullif(h, 0), 0) AS baseline_failure_rate, coalesce(i / nullif(j, 0), 0) AS finetuned_failure_rate FROM c""")
def paired_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.transitions(runs(spark, sf_dir))


@query(f"""WITH {_RUNS}, d AS (SELECT rs - ls AS d FROM q) SELECT count(*) AS n, round(avg(d), 6) AS mean_delta, round(median(d), 6) AS median_delta,
 CAST(sum(CASE WHEN d > 0 THEN 1 ELSE 0 END) AS BIGINT) AS wins, CAST(sum(CASE WHEN d < 0 THEN 1 ELSE 0 END) AS BIGINT) AS losses, CAST(sum(CASE WHEN d = 0 THEN 1 ELSE 0 END) AS BIGINT) AS ties FROM d""")
def paired_delta_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.deltas(runs(spark, sf_dir), "similarity")


@query(f"""WITH {RESULTS_SQL} SELECT category, count(*) AS count, round(avg(value), 6) AS mean_value, CAST(median(completion_tokens) AS DOUBLE) AS median_tokens,
 CAST(sum(retry_count) AS BIGINT) AS retries, CAST(sum(CAST(truncated AS INTEGER)) AS BIGINT) AS truncated FROM r GROUP BY GROUPING SETS ((category), ())""")
def probe_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return results(spark, sf_dir).rollup("category").agg(
        F.count("*").alias("count"), F.round(F.avg("value"), 6).alias("mean_value"), F.percentile("completion_tokens", 0.5).alias("median_tokens"), F.sum("retry_count").alias("retries"), F.count_if("truncated").alias("truncated"))


@query(f"""WITH {RESULTS_SQL}, k AS (SELECT content_hash, category, row_number() OVER (PARTITION BY category ORDER BY completion_tokens, content_hash) - 1 AS rank, count(*) OVER (PARTITION BY category) AS n FROM r)
SELECT content_hash, category, CAST(rank AS INTEGER) AS rank FROM k WHERE rank IN (SELECT CAST(round_even(i * (n - 1) / 9, 0) AS BIGINT) FROM range(10) t(i))""")
def quantile_probe_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return probes.quantile_probes(results(spark, sf_dir), 10, length="completion_tokens").select("content_hash", "category", F.col("rank").cast("int").alias("rank"))


@query(f"""WITH {RESULTS_SQL}, k AS (SELECT content_hash, row_number() OVER (ORDER BY completion_tokens, content_hash) - 1 AS rk FROM r)
SELECT content_hash, CAST(rk // 4 AS BIGINT) AS batch, CAST(rk % 4 AS INTEGER) AS position FROM k""")
def batch_grouping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return probes.batches(results(spark, sf_dir), 4, "completion_tokens").select("content_hash", "batch", "position")


@query(f"WITH {RESULTS_SQL} SELECT content_hash FROM r WHERE event_id < coalesce((SELECT (min(event_id) // 16 + 1) * 16 FROM r WHERE truncated), 9000000000000000000)")
def early_stop_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return probes.before_truncation(results(spark, sf_dir), 16, "event_id").select("content_hash")


@query(f"WITH {RESULTS_SQL} SELECT round(avg(CAST(truncated AS INTEGER)), 9) AS rate, avg(CAST(truncated AS INTEGER)) <= 0.01 AS passed FROM r")
def truncation_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.truncation_gate(results(spark, sf_dir).withColumn("error", F.lit(None).cast("string"))).withColumn("rate", F.round("rate", 9))


@query(f"WITH {RESULTS_SQL} SELECT category, min(content_hash) AS content_hash FROM r WHERE truncated GROUP BY category")
def first_truncated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return probes.first_truncated(results(spark, sf_dir))


@query(f"WITH {RESULTS_SQL} SELECT content_hash, CASE WHEN completion_tokens > 0 AND value > 0 THEN round(completion_tokens / value, 6) END AS tokens_per_second, completion_tokens >= 300 AND event_id % 2 = 1 AS truncated FROM r")
def throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    return results(spark, sf_dir).select("content_hash", F.round(validation.throughput(F.col("completion_tokens"), F.col("value")), 6).alias("tokens_per_second"), validation.truncated(F.col("completion_tokens"), 300, F.col("event_id") % 2 == 0).alias("truncated"))


@query("SELECT user_id % 50 AS run_id, max(value) AS peak, min(value) AS low FROM events GROUP BY 1")
def vram_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy((F.col("user_id") % 50).alias("run_id")).agg(F.max("value").alias("peak"), F.min("value").alias("low"))


# ---------------------------------------------------------------- questions and answers

_ANSWERS = """q AS (SELECT o_orderkey AS question_id, lower(o_orderpriority) AS tags, o_totalprice AS question_score FROM orders),
a AS (SELECT l_orderkey AS question_id, l_orderkey * 10 + l_linenumber AS answer_id, l_quantity AS answer_score, l_suppkey AS owner_user_id, l_linenumber = 1 AS accepted FROM lineitem)"""


@query(f"""WITH {_ANSWERS}, b AS (
  SELECT q.question_id, answer_id, answer_score, owner_user_id, question_score, s_name AS display_name,
    row_number() OVER (PARTITION BY q.question_id ORDER BY CASE WHEN accepted THEN 1 ELSE 0 END DESC, answer_score DESC, answer_id, owner_user_id) AS rk
  FROM q JOIN a ON a.question_id = q.question_id LEFT JOIN supplier ON s_suppkey = owner_user_id
  WHERE question_score >= 1000 AND answer_score >= 5 AND tags IN ('1-urgent', '2-high'))
SELECT question_id, answer_id, answer_score, display_name FROM b WHERE rk = 1 ORDER BY question_score DESC, answer_score DESC, question_id LIMIT 500""")
def top_answer_per_question(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("question_id"), F.col("o_orderpriority").alias("tags"), F.col("o_totalprice").alias("question_score"), (F.col("o_orderkey") * 10 + 1).alias("accepted_answer_id"))
    a = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("question_id"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("answer_id"), F.col("l_quantity").alias("answer_score"), F.col("l_suppkey").alias("owner_user_id"))
    u = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("user_id"), F.col("s_name").alias("display_name"))
    return relational.best_answers(q, a, u, ["1-urgent", "2-high"], 1000, 5, 500).select("question_id", "answer_id", "answer_score", "display_name")


@query(f"WITH {_ANSWERS} SELECT question_id FROM q WHERE tags IN ('1-urgent', '5-low')")
def tag_semi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("question_id"), F.explode(F.split(F.lower("o_orderpriority"), r"\|")).alias("tag"))
    return q.join(spark.createDataFrame([("1-urgent",), ("5-low",)], "tag string").hint("broadcast"), "tag", "left_semi").select("question_id").distinct()


@query("SELECT l_orderkey, l_linenumber, s_name AS display_name FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey AND s_acctbal > 0 WHERE l_linenumber = 1")
def answered_with_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = table(spark, sf_dir, "supplier").where("s_acctbal > 0").select("s_suppkey", F.col("s_name").alias("display_name"))
    return table(spark, sf_dir, "lineitem").where("l_linenumber = 1").join(u, F.col("l_suppkey") == F.col("s_suppkey"), "left").select("l_orderkey", "l_linenumber", "display_name")


@query("""WITH c AS (SELECT conv_id AS issue, conv_id * 1000 + turn AS comment_id, role = 'assistant' AS trusted, length(text) % 3 AS reactions, turn FROM conversations),
r AS (SELECT *, row_number() OVER (PARTITION BY issue ORDER BY trusted DESC, reactions DESC, turn DESC, comment_id DESC) AS rk FROM c)
SELECT issue, comment_id, trusted, CAST(reactions AS INTEGER) AS reactions FROM r WHERE rk = 1 AND (trusted OR reactions >= 1)""")
def resolution_comment_argmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("issue"), (F.col("conv_id") * 1000 + F.col("turn")).alias("comment_id"), F.when(F.col("role") == "assistant", "OWNER").otherwise("NONE").alias("author_association"), (F.length("text") % 3).alias("reactions"), F.col("turn").alias("created_at"))
    return relational.resolution_comments(c).select("issue", "comment_id", "trusted", "reactions")


@query("""WITH c AS (SELECT event_id % 5000 AS k, CAST(event_id % 900 AS INTEGER) AS tokens, event_id FROM events), f AS (SELECT k, min(event_id) AS e FROM c GROUP BY k)
SELECT d.doc_id, f.e IS NOT NULL AND f.e % 900 < 512 AS is_cached FROM documents d LEFT JOIN f ON f.k = d.doc_id""")
def generation_cache_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "events").groupBy((F.col("event_id") % 5000).alias("content_hash")).agg(F.min("event_id").alias("e"))
    cache = c.select("content_hash", F.lit("f").alias("fingerprint"), (F.col("e") % 900).cast("int").alias("completion_tokens"), F.lit(512).alias("prior_limit"))
    asked = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("content_hash"), F.lit("f").alias("fingerprint"))
    return relational.cached(asked, cache, 1024).select(F.col("content_hash").alias("doc_id"), "is_cached")
