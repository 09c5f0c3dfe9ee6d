"""Gates: each returns the rows that break it, so that an empty result passes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class GateError(ValueError):
    """A gate that must pass didn't."""


def must_be_empty(df: DataFrame, what: str) -> None:
    found = df.limit(1).collect()
    if found:
        raise GateError(f"{what}: {found[0].asDict()}")


def missing_fields(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """(field, rows) for every field, dotted ones too, that is null or empty in some row."""
    counts = df.agg(*(F.count_if(F.col(f).isNull() | (F.col(f).cast("string") == "")).alias(str(k)) for k, f in enumerate(fields)))
    pairs = F.array(*(F.struct(F.lit(f).alias("field"), F.col(str(k)).alias("rows")) for k, f in enumerate(fields)))
    return counts.select(F.explode(pairs).alias("p")).select("p.*").where("rows > 0")


def mixed_groups(df: DataFrame, group: str, columns: Sequence[str] = ("category", "source")) -> DataFrame:
    """Groups with more than one value in a column that must have one."""
    out = df.groupBy(group).agg(*(F.count_distinct(c).alias(c) for c in columns))
    return out.where(reduce(lambda a, b: a | b, (F.col(c) > 1 for c in columns)))


def missing_categories(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """(split, missing) for splits without some required category."""
    have = df.groupBy("split").agg(F.collect_set("category").alias("have"))
    return have.select("split", F.array_except(F.array(*map(F.lit, required)), "have").alias("missing")).where("size(missing) > 0")


def order_differences(a: DataFrame, b: DataFrame, key: str = "content_hash") -> DataFrame:
    """Positions at which two frozen orders (position, key) differ."""
    l, r = a.select("position", F.col(key).alias("left")), b.select("position", F.col(key).alias("right"))
    return l.join(r, "position", "full_outer").where(~F.col("left").eqNullSafe(F.col("right")))


def repeated_keys(df: DataFrame, key: str = "content_hash") -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def stale_hashes(df: DataFrame, recorded: str, actual) -> DataFrame:
    """Rows whose recorded hash isn't the one computed again."""
    return df.withColumn("actual_hash", actual).where(~F.col(recorded).eqNullSafe(F.col("actual_hash")))


def same_settings(left: Mapping, right: Mapping, keys: Sequence[str]) -> list[str]:
    """Names of settings in which two runs differ (a missing one counts as a difference)."""
    return [k for k in keys if k not in left or k not in right or left[k] != right[k]]


def lineage(stages: Sequence[tuple[str, Mapping | None, str | None]]) -> list[str]:
    """Issue codes of an ordered chain of stages (name, report, problem in reading it).

    Every report names its output's fingerprint and its input's, which must be the output of the stage before.
    """
    issues, before = [], None
    for name, report, problem in stages:
        if report is None:
            issues.append(f"{name}:{problem or 'missing'}")
        else:
            if report.get("status", "complete") != "complete":
                issues.append(f"{name}:incomplete")
            if not report.get("records"):
                issues.append(f"{name}:empty")
            if before is not None and report.get("input") != before:
                issues.append(f"{name}:input_changed")
        before = None if report is None else report.get("fingerprint")
    return issues
