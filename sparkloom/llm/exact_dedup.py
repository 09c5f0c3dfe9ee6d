"""Exact dedup by heavy-hitter split, in DataFrame functions only.

A Misra-Gries summary (Spark's ``approx_top_k`` keeps one, mergeable and bounded) names the digests that
may be frequent. Their exact counts and winners are computed with map-side combining, and this table of
at most ``heavy`` rows is broadcast, so rows of frequent texts are settled where they are read.
The other digests are dealt out by an ordinary shuffle of (digest, length, doc_id), combined before it; texts never move.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.shared import stage

#: At most so many digests are broadcast (about 100 bytes each).
HEAVY = 2_000
#: Counters of the summary: a digest in more than about 1/20,000 of the rows is found.
COUNTERS = 20_000


def normalised(text: Column) -> Column:
    """The text without the characters of [\\x20\\x09-\\x0D]; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", "")


def exact_dedup(docs: DataFrame, heavy: int = HEAVY, counters: int = COUNTERS) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Rows are equal when their texts are, after ``normalised``. The row with the most code points in
    its original text stays, then the one with the smallest doc_id (null last); of rows that repeat even
    that, one. Null and empty texts form one group. An empty table gives an empty result. Texts of any length are
    read whole where they lie; only digests travel. Other columns of ``docs`` are ignored.
    """
    rows = stage(
        docs.select(
            "doc_id",
            F.sha2(normalised(F.col("text")), 256).alias("digest"),
            F.length(F.coalesce(F.col("text"), F.lit(""))).alias("n"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "digests",
    )
    order = F.struct((-F.col("n")).alias("n"), F.col("doc_id").isNull().alias("x"), F.col("doc_id").alias("id"), F.col("row").alias("row"))
    maybe = rows.select(F.explode(F.expr(f"approx_top_k(digest, {heavy}, {counters})")).alias("t")).select(F.col("t.item").alias("digest")).where("digest is not null")
    winners = (
        rows.join(F.broadcast(maybe), "digest")
        .groupBy("digest").agg(F.count("*").alias("group_size"), F.min(order).alias("best"))
        .where("group_size > 1")
    )
    winners = stage(winners, "winners")  # read twice; at most ``heavy`` rows
    settled = rows.join(F.broadcast(winners), "digest")
    rest = rows.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
    # Counted and compared before the shuffle; only digests that repeat are joined back, so no task needs all rows of one.
    repeated = rest.groupBy("digest").agg(F.count("*").alias("group_size"), F.min(order).alias("best")).where("group_size > 1")
    dealt = rest.join(repeated, "digest", "left").withColumns({"group_size": F.coalesce("group_size", F.lit(1)).cast("bigint"), "best": F.coalesce("best", order)})
    columns = ["digest", "doc_id", "row", "group_size", "best"]
    return settled.select(columns).unionByName(dealt.select(columns)).select(
        "doc_id",
        F.col("best.id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256
  FROM documents),
w AS (
  SELECT doc_id, text_sha256,
         first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM d)
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, doc_id = keep_id AS kept, text_sha256 FROM w
"""
