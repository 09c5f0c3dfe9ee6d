"""Sources to interim records: licences of repositories, issue and answer pairs, dispatch by kind."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.functions.text import py_strip
from sparkloom.operators.split import first_of_each


def repository_license(spdx: Column, aliases: Mapping[str, str]) -> Column:
    """The licence id that a repository states, aliases resolved; null where it states none, or that it can't say."""
    raw = py_strip(spdx)
    known = F.try_element_at(F.create_map(*(F.lit(x) for pair in aliases.items() for x in pair)), F.lower(raw)) if aliases else F.lit(None).cast("string")
    return F.when((raw != "") & (raw != "NOASSERTION"), F.coalesce(known, raw))


def licensed(issues: DataFrame, licenses: DataFrame, aliases: Mapping[str, str], allowed: Sequence[str]) -> DataFrame:
    """Issues of repositories whose licence (``licenses``: repository, spdx_id, html_url) is allowed, with license and license_url."""
    found = licenses.select("repository", repository_license(F.col("spdx_id"), aliases).alias("license"), F.col("html_url").alias("license_url"))
    return issues.join(found.where(F.col("license").isin(list(allowed))), "repository")


def pair_text(user: Column, assistant: Column) -> Column:
    return F.concat(F.lit("USER:\n"), user, F.lit("\n\nASSISTANT:\n"), assistant)


def issue_records(issues: DataFrame, source: str, most: int | None = None, category: str = "troubleshooting") -> DataFrame:
    """Issues with their resolving comment as interim records; blank questions and answers are left out.

    ``issues`` has repository, number, title, body, login, html_url, updated_at, resolution_body, resolution_url,
    labels, license, license_url and ordinal; ``most`` bounds the records of a repository, in scan order.
    """
    body, answer = py_strip(F.col("body")), py_strip(F.col("resolution_body"))
    rows = issues.where((F.coalesce(body, F.lit("")) != "") & (F.coalesce(answer, F.lit("")) != ""))
    rows = rows if most is None else first_of_each(rows, most, "repository", ["ordinal"])
    user = py_strip(F.concat(F.coalesce("title", F.lit("")), F.lit("\n\n"), body))
    number = F.col("number").cast("string")
    return rows.select(
        F.lit(source).alias("source"), F.lit(category).alias("category"), pair_text(user, answer).alias("raw_content"), "license", "license_url", F.col("html_url").alias("url"),
        F.concat("repository", F.lit("#"), number).alias("source_record_id"), F.col("updated_at").alias("source_revision"), "title",
        F.coalesce(F.when(F.col("login") != "", F.col("login")), F.lit("unknown")).alias("author"),
        F.concat("repository", F.lit(" issue #"), number, F.lit(" and resolving comment "), "resolution_url").alias("attribution"), F.lit("en").alias("language"),
        F.lit("issue_resolution_pair").alias("normalization"), F.struct(user.alias("user"), answer.alias("assistant")).alias("pair"), "labels", "resolution_url",
    )


def answer_records(answers: DataFrame, source: str, license_: str, license_url: str, base: str, site: str, category: str = "troubleshooting") -> DataFrame:
    """Questions with their answer as interim records.

    ``answers`` has question_id, answer_id, title, question_body, answer_body, display_name, owner_user_id, scores and tags.
    """
    user = py_strip(F.concat("title", F.lit("\n\n"), "question_body"))
    answer = py_strip(F.col("answer_body"))
    author = F.coalesce(F.when(F.col("display_name") != "", F.col("display_name")), F.col("owner_user_id").cast("string"), F.lit("deleted-user"))
    q, a = F.col("question_id").cast("string"), F.col("answer_id").cast("string")
    return answers.select(
        F.lit(source).alias("source"), F.lit(category).alias("category"), pair_text(user, answer).alias("raw_content"), F.lit(license_).alias("license"), F.lit(license_url).alias("license_url"),
        F.concat(F.lit(f"{base}/questions/"), q).alias("url"), F.concat(F.lit("q"), q, F.lit("-a"), a).alias("source_record_id"), "title", author.alias("author"),
        F.concat(F.lit(f"{site} question "), q, F.lit(", answer "), a, F.lit(", author "), author).alias("attribution"), F.lit("en").alias("language"), F.lit("direct_pair").alias("normalization"),
        F.struct(user.alias("user"), answer.alias("assistant")).alias("pair"), "question_score", "answer_score", "owner_user_id", "display_name", "tags",
    )


def extract(kinds: Mapping[str, Callable[[Mapping[str, Any]], DataFrame]], sources: Mapping[str, Mapping[str, Any]], chosen: Sequence[str], sink: Callable[[str, DataFrame], Mapping[str, Any]] | None = None, dry_run: bool = False) -> list[dict[str, Any]]:
    """Runs the extractor of each chosen source by its kind and gives its records to ``sink``; one that fails doesn't stop the others.

    Returns a row for each source: source, kind, status (planned, complete or failed), and the error or what the sink
    returned. An unknown kind is an error before anything runs.
    """
    if unknown := sorted({str(sources[s].get("kind")) for s in chosen} - {*kinds}):
        raise ValueError(f"unknown kinds: {', '.join(unknown)}")
    out = []
    for name in chosen:
        row = {"source": name, "kind": sources[name]["kind"]}
        if dry_run:
            out.append(row | {"status": "planned"})
            continue
        try:
            made = kinds[row["kind"]](sources[name])
            out.append(row | {"status": "complete"} | dict(sink(name, made) if sink else {"records": made.count()}))
        except Exception as e:  # noqa: BLE001 a source is isolated from the others, whatever its client raises
            out.append(row | {"status": "failed", "error": f"{type(e).__name__}: {e}"[:500]})
    return out
