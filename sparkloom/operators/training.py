"""What a training run takes in: chat records by offset, rendered texts, length filter, fingerprints, and the gates before it."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.functions.text import CHATML, py_strip, render_chatml
from sparkloom.operators.split import page
from sparkloom.operators.validation import chat_problem


def load_chat(records: DataFrame, meta: Sequence[str] = ("source", "category", "license", "url"), offset: int = 0, limit: int | None = None, order: Sequence[str] = ("input_rank", "ordinal")) -> DataFrame:
    """Chat records (messages, meta) in order from ``offset`` on; blank lines were skipped when they were read.

    Raises where there are none, or one isn't valid, with its place.
    """
    out = page(records, order, offset, limit)
    problem = chat_problem(F.col("messages"), {m: F.col(f"meta.{m}") for m in meta})
    first = out.select(problem.alias("problem"), *order).agg(F.count("*").alias("n"), F.min_by("problem", F.when(F.col("problem").isNotNull(), F.struct(*order))).alias("problem")).first()
    if not first["n"]:
        raise ValueError("there are no chat records")
    bad = out.select(problem.alias("problem"), *order).where("problem is not null").orderBy(*order).limit(1).collect()
    if bad:
        raise ValueError(f"invalid chat record at {tuple(bad[0][c] for c in order)}: {bad[0]['problem']}")
    return out


def formatted(records: DataFrame, marks: tuple[str, str, str] = CHATML) -> DataFrame:
    """text and meta of chat records; a record that renders to nothing fails when it is reached."""
    text = render_chatml(F.col("messages"), marks)
    checked = F.when(F.coalesce(py_strip(text), F.lit("")) != "", text).otherwise(F.raise_error(F.lit("a record renders to an empty text")).cast("string"))
    return records.select(checked.alias("text"), "meta", *(c for c in records.columns if c not in ("messages", "meta", "text")))


def length_filter(records: DataFrame, tokens: Column, most: int) -> DataFrame:
    """``records`` with tokens and kept: what is too long is left out whole, never cut."""
    return records.withColumn("tokens", tokens).withColumn("kept", F.col("tokens") <= most)


def ordered_fingerprint(records: DataFrame, order: Sequence[str], key: str = "content_hash") -> str:
    """SHA-256 of the JSON list of the keys in order.

    The digest of a list is a chain, so keys (not records) pass the driver one partition after the other; it holds one partition of keys at a time.
    """
    digest, first = hashlib.sha256(b"["), True
    for row in records.orderBy(*order).select(key).toLocalIterator(prefetchPartitions=True):
        digest.update((b"" if first else b",") + json.dumps(row[0], ensure_ascii=False).encode())
        first = False
    digest.update(b"]")
    return digest.hexdigest()


def excluded_by(records: DataFrame, excluded: Column) -> DataFrame:
    """(source, category, records, excluded): one row for each (source, category), and one for each category with its kept records."""
    marked = records.withColumn("_gone", excluded)
    by_source = marked.groupBy("source", "category").agg(F.count_if("_gone").alias("excluded"), F.count_if(~F.col("_gone")).alias("kept"))
    return by_source.where("excluded > 0").select("source", "category", "excluded", F.lit(None).cast("bigint").alias("kept")).unionByName(
        by_source.groupBy("category").agg(F.sum("kept").alias("kept")).select(F.lit(None).cast("string").alias("source"), "category", F.lit(None).cast("bigint").alias("excluded"), "kept"))


def final_split_problems(statistics: Mapping, found: Mapping[str, str | None], train_derivation: Mapping | None = None, validation_redaction: Mapping | None = None) -> list[str]:
    """What bars a full training run, given the split's report and the SHA-256 of each split's file (None: missing).

    A provisional split; a file that is missing or differs from its record. Train may instead be the pinned derivation of
    the recorded parent (parent_sha256, sha256), validation the pinned redaction of the recorded file (original_sha256, sha256).
    """
    issues = ["provisional"] if statistics.get("provisional") else []
    for name in ("train", "validation", "test"):
        recorded = statistics.get("outputs", {}).get(name, {}).get("sha256")
        actual = found.get(name)
        if not actual or not recorded:
            issues.append(f"{name}:missing")
        elif name == "train" and train_derivation is not None:
            if train_derivation.get("parent_sha256") != recorded:
                issues.append("train:other_parent")
            elif train_derivation.get("sha256") != actual:
                issues.append("train:other_derivation")
        elif actual != recorded:
            pinned = validation_redaction if name == "validation" else None
            if pinned is None or pinned.get("original_sha256") != recorded or pinned.get("sha256") != actual:
                issues.append(f"{name}:changed")
    return issues


def baseline_problems(baseline: Mapping | None, statistics: Mapping) -> list[str]:
    """What bars training for want of a baseline: no results, provisional ones, or results of another test set."""
    if baseline is None:
        return ["baseline:missing"]
    issues = ["baseline:provisional"] if baseline.get("provisional", True) else []
    if baseline.get("test_sha256") != statistics.get("outputs", {}).get("test", {}).get("sha256"):
        issues.append("baseline:other_test")
    return issues


def review_problems(review: Mapping, sample_sha256: str | None) -> list[str]:
    """What bars full generation: a review that isn't approved, no sample, or another sample than the reviewed one."""
    issues = [] if review.get("status") == "approved" else ["review:not_approved"]
    if sample_sha256 is None:
        issues.append("sample:missing")
    elif review.get("sample_sha256") != sample_sha256:
        issues.append("sample:changed")
    return issues
