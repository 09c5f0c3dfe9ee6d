"""Command line: one command per stage, over Parquet or JSON tables.

    python -m sparkloom.cli extract --config sources.yaml --output extracted
    python -m sparkloom.cli clean --input extracted --output cleaned
    python -m sparkloom.cli pipeline-status --root data clean dedupe split

Every stage writes a table and its manifest, which names its input's fingerprint. Expected problems end with 2, a chain
of stages that isn't ready with 1. Models and validators are given as ``module:function``, which makes the client.
"""

from __future__ import annotations

import argparse
import importlib
import json
import sys
from collections.abc import Callable
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom import config
from sparkloom.functions.text import canonical_content, canonical_text, role, sha
from sparkloom.operators import cleaning, dedupe, evaluation, extract, gates, models, normalize, similarity, split, stats, training, validation
from sparkloom.session import session
from sparkloom.sources import files, hadoop, sinks

Arguments = argparse.Namespace


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(path) if path.endswith((".json", ".jsonl")) else sinks.read_table(spark, path)


def client(name: str | None) -> Callable[[], Any]:
    """The function ``module:function`` that makes a client."""
    if not name or ":" not in name:
        raise ValueError("give the client as module:function")
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


# ---------------------------------------------------------------- sources

KINDS: dict[str, Callable[[SparkSession, dict], DataFrame]] = {
    "parquet": lambda spark, s: files.verified_parquet(spark, s["path"], s.get("sha256"), s.get("revision")),
    "jsonl": lambda spark, s: spark.read.json(s["path"]),
    "markdown": lambda spark, s: files.markdown_records(
        files.markdown_chunks(files.markdown_files(spark, s["path"], s.get("include", ["**/*.md"]), s.get("exclude", [])), **s.get("chunking", {}), revision=s.get("revision", "")),
        s["name"], s.get("repository", s["path"]), s.get("revision", ""), s.get("license", "unknown"), F.lit(s.get("category", "concepto")), s.get("license_url"), s.get("normalization"), s.get("max_records")),
    "index": lambda spark, s: files.index_records(spark, s["path"], s.get("fallback"), s["name"], s.get("repository", s["path"]), s.get("revision", "")),
}


def extract_sources(spark: SparkSession, a: Arguments) -> list[dict]:
    settings = config.load(a.config)
    sources = {k: v | {"name": k} for k, v in config.dotted(settings, "sources").items()}
    config.require(config.source_problems(sources, KINDS))
    chosen = normalize.select_sources(sources, a.source, a.include_quarantine)

    def sink(name: str, df: DataFrame) -> dict:
        return sinks.write_table(df, f"{a.output}/{name}", {"stage": "extract", "status": "complete"}, a.force, revision=sources[name].get("revision"), config=sources[name])

    return extract.extract({k: (lambda s, f=f: f(spark, dict(s))) for k, f in KINDS.items()}, sources, chosen, sink, a.dry_run)


# ---------------------------------------------------------------- stages over a table


def clean(spark: SparkSession, df: DataFrame, a: Arguments) -> DataFrame:
    return cleaning.clean(df, text=a.text if a.text in df.columns else "raw_content", pair=[c for c in ("system", "user", "assistant") if c in df.columns])


def normalized(spark: SparkSession, df: DataFrame, a: Arguments) -> DataFrame:
    """Direct pairs as chat records, or a sample of candidates for generation."""
    if a.mode == "prepare-sample":
        return split.round_robin(normalize.candidates(df), a.limit or 150, a.seed, "source_record_id")
    rows, _ = normalize.by_mode(df, "direct_pair")
    system = F.col("system") if "system" in df.columns else F.lit(None).cast("string")
    return normalize.chat(rows, F.col("user"), F.col("assistant"), system, a.system)


def generated(spark: SparkSession, df: DataFrame, a: Arguments) -> DataFrame:
    """Instructions for candidates by a client; all of them only after the sample's review."""
    if a.scope == "full":
        sample = hadoop.sha256_of_all(spark, hadoop.files_below(spark, a.sample)) if a.sample and hadoop.exists(spark, a.sample) else None
        config.require(training.review_problems(config.load(a.review), sample))
    return normalize.generate(df, client(a.client), in_flight=a.in_flight)


def exact(spark: SparkSession, df: DataFrame, a: Arguments) -> DataFrame:
    key = sha(canonical_content(F.col("messages"))) if "messages" in df.columns else sha(canonical_text(F.col(a.text)))
    order = tuple(a.order.split(","))
    return dedupe.exact_dedupe(df.withColumn("content_hash", key), order=order, ident=order[-1]).where("not is_duplicate")


def approximate(spark: SparkSession, df: DataFrame, a: Arguments) -> DataFrame:
    v = df.select(F.col("content_hash").alias("id"), F.col("embedding").alias("vector"))
    pairs = similarity.knn(v, a.top, a.threshold, tuple(a.index) if a.index else None).where("query <> reference").select(F.col("query").alias("src"), F.col("reference").alias("dst"))
    found = similarity.components(v, pairs)
    return df.join(found.withColumnRenamed("id", "content_hash"), "content_hash").withColumnRenamed("component", "semantic_cluster_id")


def deduped(spark: SparkSession, df: DataFrame, a: Arguments) -> DataFrame:
    return approximate(spark, df, a) if a.mode == "approximate" else exact(spark, df, a)


def validated(spark: SparkSession, df: DataFrame, a: Arguments) -> DataFrame:
    """Chat records with category, status and reason; blocks go to a validator where one is given."""
    rows = df if "assistant" in df.columns else df.withColumn("assistant", role(F.col("messages"), "assistant"))
    rows = validation.reclassify(rows)
    found = validation.syntax_candidates(rows).select(F.col("identifier").alias("content_hash"), "name", "content", "missing_reason")
    failed = None
    if a.client:
        tool, parse = client(a.client)()
        failed = models.check_files(found.where("content is not null"), lambda: tool, parse).where("failure is not null")
    out = rows.join(found.select("content_hash", "name", "missing_reason"), "content_hash", "left").withColumn("applicable", F.col("name").isNotNull())
    failed = failed if failed is not None else spark.createDataFrame([], "name string, failure string")
    return validation.attach(out, failed, "name").drop("applicable")


def splits(spark: SparkSession, df: DataFrame, a: Arguments) -> DataFrame:
    gates.must_be_empty(gates.mixed_groups(df, a.group), "a group has several categories or sources")
    groups = df.groupBy(F.col(a.group).alias("group")).agg(F.min("category").alias("category"), F.min("source").alias("source"), F.count("*").alias("size"))
    return df.join(split.allocate(groups, a.seed).select(F.col("group").alias(a.group), "split"), a.group)


def prepared(spark: SparkSession, df: DataFrame, a: Arguments) -> DataFrame:
    """The training input: valid chat records, rendered, those that are too long left out. Training itself is outside."""
    tokens = F.length("text") if a.client is None else client(a.client)()(F.col("text"))
    out = training.length_filter(training.formatted(training.load_chat(df, offset=a.offset, limit=a.limit)), tokens, a.most).where("kept").drop("kept")
    if out.isEmpty():
        raise ValueError("the length filter left nothing")
    return out


def benchmarked(spark: SparkSession, df: DataFrame, a: Arguments) -> DataFrame:
    rows = df if a.limit is None else df.orderBy("content_hash").limit(a.limit)
    answer = lambda r: models.generate(r, client(a.client), {"max_new_tokens": a.most}, a.penalty, a.batch)
    identity = {"client": a.client, "max_new_tokens": a.most, "penalty": a.penalty, "batch": a.batch, "variant": a.variant}
    return (models.in_slices(rows, a.log, answer, identity, a.slice) if a.log else answer(rows)).withColumn("variant", F.lit(a.variant))


def scored(spark: SparkSession, df: DataFrame, a: Arguments) -> DataFrame:
    """Results with syntax_valid, by whether their blocks are there and a validator accepts them."""
    ok = client(a.client)() if a.client else (lambda c: F.lit(True))
    return df.withColumn("syntax_valid", validation.syntax_score(F.col("category"), F.col("prediction"), F.col("error"), ok))


def judged(spark: SparkSession, df: DataFrame, a: Arguments) -> DataFrame:
    known = read(spark, a.known) if a.known else None
    asked = df.where("error is null").select("content_hash", "question", "reference", F.col("prediction").alias("candidate"))
    return models.judge(asked, known, client(a.client), a.runtime).withColumn("judge", validation.judge(F.col("payload")))


STAGES: dict[str, Callable[[SparkSession, DataFrame, Arguments], DataFrame]] = {
    "clean": clean, "normalize": normalized, "normalize-generate": generated, "dedupe": deduped, "validate-dataset": validated, "split": splits, "train": prepared,
    "benchmark": benchmarked, "benchmark-syntax": scored, "benchmark-judge": judged,
}


def report(spark: SparkSession, a: Arguments) -> dict:
    """The comparison of two variants' results as Markdown."""
    both = evaluation.combined({"baseline": read(spark, a.baseline), "finetuned": read(spark, a.finetuned)})
    out, gate = None, {}
    for name in ("baseline", "finetuned"):
        rows = both.where(F.col("variant") == name)
        one = stats.aggregate_results(evaluation.normalized_generation(rows)).withColumn("variant", F.lit(name))
        out = one if out is None else out.unionByName(one)
        gate[name] = (stats.truncation_gate(rows).first()["rate"], 0.01)
    if not a.allow_provisional and not gates_pass(gate):
        raise ValueError("the truncation gate did not pass; a provisional report must be asked for")
    sinks.write_text(spark, a.output, sinks.comparison(out, "baseline", "finetuned", gate))
    return {"report": a.output}


def gates_pass(gate: dict[str, tuple[float, float]]) -> bool:
    return all(rate <= most for rate, most in gate.values())


def validate_config(a: Arguments) -> list[str]:
    problems = []
    for path in a.files:
        settings = config.load(path)
        problems += [f"{path}: {p}" for p in (config.cleaning_problems(settings) if "pii" in settings else config.split_problems(settings) if "ratios" in settings else config.source_problems(settings.get("sources", {}), KINDS))]
    return problems


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="sparkloom")
    sub = p.add_subparsers(dest="command", required=True)
    for name in STAGES:
        c = sub.add_parser(name)
        c.add_argument("--input", required=True)
        c.add_argument("--output", required=True)
        c.add_argument("--force", action="store_true")
        c.add_argument("--text", default="content")
        c.add_argument("--order", default="input_rank,ordinal")
        c.add_argument("--group", default="semantic_cluster_id")
        c.add_argument("--threshold", type=float, default=0.92)
        c.add_argument("--top", type=int, default=50)
        c.add_argument("--index", type=int, nargs=2, metavar=("BITS", "TABLES"))
        c.add_argument("--seed", type=int, default=3407)
        c.add_argument("--mode", choices=("direct", "prepare-sample", "exact", "approximate"), default="exact" if name == "dedupe" else "direct")
        c.add_argument("--scope", choices=("sample", "full"), default="sample")
        c.add_argument("--client")
        c.add_argument("--system", default="You are a helpful assistant.")
        c.add_argument("--sample")
        c.add_argument("--review")
        c.add_argument("--known")
        c.add_argument("--runtime", default="")
        c.add_argument("--variant", default="baseline")
        c.add_argument("--offset", type=int, default=0)
        c.add_argument("--limit", type=int)
        c.add_argument("--most", type=int, default=8192)
        c.add_argument("--batch", type=int, default=4)
        c.add_argument("--penalty", type=float)
        c.add_argument("--in-flight", type=int, default=1, help="calls of normalize-generate at a time in each task")
        c.add_argument("--log", help="folder in which benchmark saves its answers slice by slice, to go on from there")
        c.add_argument("--slice", type=int, default=1000)
    e = sub.add_parser("extract")
    e.add_argument("--config", required=True)
    e.add_argument("--output", required=True)
    e.add_argument("--source", action="append")
    e.add_argument("--force", action="store_true")
    e.add_argument("--include-quarantine", action="store_true")
    e.add_argument("--dry-run", action="store_true")
    v = sub.add_parser("config-validate")
    v.add_argument("files", nargs="+")
    r = sub.add_parser("report")
    r.add_argument("--baseline", required=True)
    r.add_argument("--finetuned", required=True)
    r.add_argument("--output", required=True)
    r.add_argument("--allow-provisional", action="store_true")
    s = sub.add_parser("pipeline-status", aliases=["status"])
    s.add_argument("--root", required=True)
    s.add_argument("stages", nargs="+")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(argv)
    try:
        if a.command == "config-validate":
            problems = validate_config(a)
            print(json.dumps({"problems": problems}))
            return 2 if problems else 0
        spark = spark or session()
        if a.command in ("pipeline-status", "status"):
            issues = gates.lineage([(n, *sinks.read_report(spark, f"{a.root}/{n}.manifest.json")) for n in a.stages])
            print(json.dumps({"ready": not issues, "issues": issues}))
            return int(bool(issues))
        if a.command == "extract":
            rows = extract_sources(spark, a)
            print(json.dumps(rows, default=str))
            return 2 if any(r["status"] == "failed" for r in rows) else 0
        if a.command == "report":
            print(json.dumps(report(spark, a)))
            return 0
        known, _ = sinks.read_report(spark, f"{a.input}.manifest.json")
        out = STAGES[a.command](spark, read(spark, a.input), a)
        made = sinks.write_table(out, a.output, {"stage": a.command, "status": "complete", "input": (known or {}).get("fingerprint")}, a.force)
        print(json.dumps(made))
        return 0
    except (ValueError, OSError, ImportError, AttributeError, AnalysisException) as e:
        print(f"error: {e}", file=sys.stderr)
        return 2


if __name__ == "__main__":
    sys.exit(main())
