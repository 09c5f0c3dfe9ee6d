"""Questions, answers and users: the best answer of each question, with its author."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.operators import skew


def scanned_bytes(df: DataFrame) -> int:
    """Bytes of all files that the optimised plan of ``df`` reads, a table twice where it is read twice; nothing runs."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(k).stats().sizeInBytes())) for k in range(leaves.size()) if leaves.apply(k).nodeName().startswith(("LogicalRelation", "Relation", "DataSourceV2", "HiveTableRelation")))


def within(df: DataFrame, most: int) -> DataFrame:
    """``df``; raises before anything runs where its plan reads more than ``most`` bytes."""
    size = scanned_bytes(df)
    if size > most:
        raise ValueError(f"the query reads {size} bytes, {most} are allowed")
    return df


def best_answers(questions: DataFrame, answers: DataFrame, users: DataFrame, tags: Sequence[str], least_question: float, least_answer: float, limit: int, most_bytes: int | None = None) -> DataFrame:
    """One row per question: its accepted answer, else the best scored, else the one of least id (and author); left joined to its author.

    questions: question_id, tags ('|' between), question_score, accepted_answer_id. answers: answer_id,
    question_id, answer_score, owner_user_id. users: user_id, display_name. Raises where the tables to read exceed ``most_bytes``.
    """
    tagged = questions.where((F.col("question_score") >= least_question) & F.arrays_overlap(F.split(F.lower("tags"), r"\|"), F.array(*map(F.lit, tags))))
    both = tagged.join(answers.where(F.col("answer_score") >= least_answer), "question_id")
    accepted = F.when(F.col("answer_id") == F.col("accepted_answer_id"), 1).otherwise(0)
    w = Window.partitionBy("question_id").orderBy(accepted.desc(), F.col("answer_score").desc(), "answer_id", "owner_user_id")
    best = both.withColumn("answer_rank", F.row_number().over(w)).where("answer_rank = 1").drop("answer_rank")
    named = best.join(users, best["owner_user_id"] == users["user_id"], "left").drop("user_id")
    out = named.orderBy(F.col("question_score").desc(), F.col("answer_score").desc(), "question_id").limit(limit)
    return out if most_bytes is None else within(out, most_bytes)


def resolution_comments(comments: DataFrame, trusted: Sequence[str] = ("OWNER", "MEMBER", "COLLABORATOR"), least_reactions: int = 1) -> DataFrame:
    """For each issue the comment that ranks first by (trusted author, reactions, time), if it is trusted or has reactions."""
    t = F.col("author_association").isin(list(trusted))
    best = comments.withColumn("trusted", t).groupBy("issue").agg(F.max_by(F.struct("comment_id", "trusted", "reactions", "created_at"), F.struct("trusted", "reactions", "created_at", "comment_id")).alias("c"))
    return best.select("issue", "c.*").where((F.col("trusted")) | (F.col("reactions") >= least_reactions))


def in_manifest_order(manifest: DataFrame, records: DataFrame, key: str = "content_hash") -> DataFrame:
    """Records of a manifest (position, key) in its order; raises where one is missing."""
    if not manifest.join(records, key, "left_anti").isEmpty():
        raise ValueError("the manifest names records that are not there")
    return manifest.join(records, key).orderBy("position")


def without(parent: DataFrame, excluded: DataFrame, key: str = "content_hash") -> DataFrame:
    """``parent`` without the excluded keys, heavy ones settled where they are read; raises where an excluded key isn't in the parent."""
    if not excluded.join(parent, key, "left_anti").isEmpty():
        raise ValueError("an excluded key is not in the parent")
    return skew.without(parent, excluded, [key])


def set_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(key, side) of keys on one side only: empty where both sides have the same keys."""
    l, r = left.select(key).distinct(), right.select(key).distinct()
    return l.join(r, key, "left_anti").withColumn("side", F.lit("left")).unionByName(r.join(l, key, "left_anti").withColumn("side", F.lit("right")))


def cached(requests: DataFrame, cache: DataFrame, limit: int) -> DataFrame:
    """Requests with their cached generation where a fingerprint matches and it stayed under its earlier limit."""
    usable = cache.where((F.col("completion_tokens") < F.col("prior_limit")) | (F.col("prior_limit") == limit))
    return requests.join(usable, ["content_hash", "fingerprint"], "left").withColumn("is_cached", F.col("completion_tokens").isNotNull())
