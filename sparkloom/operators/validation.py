"""Record validation, category reclassification, syntax outcomes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.functions.text import extract_dockerfile, extract_yaml, py_strip

#: Categories of records, severities of the Dockerfile linter.
CATEGORIES = ("concepto", "comando_cli", "generacion_yaml", "troubleshooting", "dockerfile", "arquitectura")
SEVERITY = {"none": 0, "ignore": 0, "style": 1, "info": 2, "warning": 3, "error": 4}


def blank(c: Column) -> Column:
    return c.isNull() | (py_strip(c) == "")


def interim_problem(source: Column, content: Column, license_: Column, url: Column, retrieved: Column, category: Column) -> Column:
    """The first thing wrong with an interim record, or null."""
    out = None
    for name, c in (("source", source), ("raw_content", content), ("license", license_), ("url", url), ("retrieved_at", retrieved)):
        out = F.when(blank(c), f"missing_{name}") if out is None else out.when(blank(c), f"missing_{name}")
    return out.when(~category.isin(*CATEGORIES), "unknown_category")


def chat_problem(messages: Column, meta: dict[str, Column]) -> Column:
    """The first thing wrong with a chat record, or null: roles, blank contents, missing meta fields."""
    roles = F.transform(messages, lambda m: m["role"])
    full = F.forall(messages, lambda m: ~blank(m["content"]))
    out = F.when(messages.isNull() | (roles != F.array(F.lit("system"), F.lit("user"), F.lit("assistant"))), "roles").when(~full, "blank_content")
    for name, c in meta.items():
        out = out.when(blank(c), f"missing_{name}")
    return out


def reclassify(records: DataFrame, answer: str = "assistant", movable: Sequence[str] = ("troubleshooting", "concepto", "comando_cli", "arquitectura"), fallback: str = "concepto", has: Column | None = None) -> DataFrame:
    """``records`` with category brought in line with whether the answer holds a Dockerfile (``has``; else whether one can be extracted), and why."""
    has = extract_dockerfile(F.col(answer)).isNotNull() if has is None else has
    to = F.when(has & F.col("category").isin(list(movable)), "dockerfile").when((F.col("category") == "dockerfile") & ~has, fallback)
    why = F.when(to == "dockerfile", "dockerfile_block_detected").when(to.isNotNull(), "dockerfile_block_missing")
    change = F.when(to.isNotNull(), F.struct(F.col("category").alias("from"), to.alias("to"), why.alias("reason")))
    return records.withColumn("category_reclassification", change).withColumn("category", F.coalesce(to, F.col("category")))


def reclassification_counts(records: DataFrame) -> DataFrame:
    """(change, n) of ``reclassify``'s changes, ``from->to``."""
    c = F.col("category_reclassification")
    return records.where(c.isNotNull()).groupBy(F.concat(c["from"], F.lit("->"), c["to"]).alias("change")).agg(F.count("*").alias("n")).orderBy("change")


def syntax_candidates(
    records: DataFrame, answer: str = "assistant", ordinal: str = "ordinal", ident: str = "content_hash", has: Column | None = None, digits: int | None = None,
) -> DataFrame:
    """identifier, ordinal, name, content, validator and missing_reason of records that a validator looks at.

    YAML answers go to one validator, Dockerfiles to the other; where the answer holds no block, content is null and
    missing_reason says so. With ``has`` only answers that fulfil it are taken for Dockerfiles. ``digits`` is how many digits of the
    ordinal a name holds at most; else all.
    """
    yaml, docker = extract_yaml(F.col(answer)), extract_dockerfile(F.col(answer))
    docker = docker if has is None else F.when(has, docker)
    is_yaml, is_docker = F.col("category") == "generacion_yaml", F.col("category") == "dockerfile"
    content = F.when(is_yaml, yaml).when(is_docker, docker)
    name = F.when(is_yaml, candidate_name(F.col(ordinal), F.col(ident), ".yaml", digits)).otherwise(candidate_name(F.col(ordinal), F.col(ident), ".Dockerfile", digits))
    return records.where(is_yaml | is_docker).select(
        F.col(ident).alias("identifier"), F.col(ordinal).alias("ordinal"), name.alias("name"), F.concat(content, F.lit("\n")).alias("content"),
        F.when(is_yaml, "kubeconform").otherwise("hadolint").alias("validator"), F.when(content.isNull(), F.when(is_yaml, "yaml_block_missing").otherwise("dockerfile_block_missing")).alias("missing_reason"))


def candidate_name(ordinal: Column, ident: Column, extension: str, digits: int | None = None) -> Column:
    number = F.format_string("%06d", ordinal) if digits is None else F.lpad(ordinal.cast("string"), digits, "0")
    return F.concat(number, F.lit("-"), F.substring(ident, 1, 16), F.lit(extension))


def attach(records: DataFrame, failures: DataFrame, key: str = "identifier") -> DataFrame:
    """``records`` with status and reason: a validator's failure overrides a missing block."""
    f = failures.groupBy(key).agg(F.first("failure", ignorenulls=True).alias("failure"))
    out = records.join(f, key, "left")
    return out.withColumn("reason", F.coalesce("failure", "missing_reason")).withColumn(
        "status", F.when(F.col("reason").isNotNull(), "rejected").when(F.col("applicable"), "valid").otherwise("not_applicable")
    ).drop("failure")


def reaches(level: Column, threshold: str) -> Column:
    """Whether a severity is at or above a threshold; an unknown one counts as error."""
    table = F.create_map(*(F.lit(x) for pair in SEVERITY.items() for x in pair))
    return F.coalesce(F.try_element_at(table, F.lower(level)), F.lit(SEVERITY["error"])) >= SEVERITY[threshold]


def syntax_score(category: Column, prediction: Column, error: Column, yaml_ok) -> Column:
    """1.0 or 0.0 for YAML and Dockerfile answers, null for others and for failed generations."""
    yaml, docker = extract_yaml(prediction), extract_dockerfile(prediction)
    return F.when(error.isNotNull(), None).when(category == "generacion_yaml", F.when(yaml.isNull(), 0.0).otherwise(yaml_ok(yaml).cast("double"))).when(category == "dockerfile", docker.isNotNull().cast("double"))


def judge(payload: Column) -> Column:
    """struct(correctness, completeness, mean, rationale) of a judge's JSON, null unless both scores lie in 1 to 5."""
    v = F.try_parse_json(payload)
    a, b = (F.try_variant_get(v, f"$.{k}", "double") for k in ("correctness", "completeness"))
    ok = a.between(1, 5) & b.between(1, 5)
    return F.when(ok, F.struct(a.alias("correctness"), b.alias("completeness"), ((a + b) / 2).alias("mean"), F.coalesce(py_strip(F.try_variant_get(v, "$.rationale", "string")), F.lit("")).alias("rationale")))


def token_filter(records: DataFrame, most: int, length: str = "tokens") -> DataFrame:
    return records.withColumn("kept", F.col(length) <= most)


def truncated(tokens: Column, most: int, finished: Column) -> Column:
    return (tokens >= most) & ~F.coalesce(finished, F.lit(False))


def throughput(tokens: Column, seconds: Column) -> Column:
    """tokens / seconds, null where either is 0 or missing."""
    return F.when((tokens > 0) & (seconds > 0), F.try_divide(tokens, seconds))


def completion_length(ids: Column, end: int) -> Column:
    """How many ids up to and with the first end id; all if there is none."""
    at = F.array_position(ids, F.lit(end))
    return F.when(at > 0, at).otherwise(F.size(ids))
