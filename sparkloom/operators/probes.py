"""Choice and order of benchmark records: probes by length, batches by prompt length, early stops."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.operators.ranks import at_ranks, before
from sparkloom.scratch import Staged


def quantile_probes(records: DataFrame, per_group: int, group: str = "category", length: str = "length", ident: str = "content_hash") -> DataFrame:
    """Evenly spaced ranks by length in each group: round(i (n - 1) / (k - 1)), half to even."""
    wanted = F.transform(F.sequence(F.lit(0), F.lit(per_group - 1)), lambda i: F.bround(i * (F.col("_n") - 1) / (per_group - 1), 0).cast("bigint"))
    return at_ranks(records, [group], length, ident, wanted)


def median_and_p90(records: DataFrame, group: str = "category", length: str = "length", ident: str = "content_hash") -> DataFrame:
    """The records at ranks (n - 1) // 2 and ceil(0.9 (n - 1)) of each group, the last where both are one."""
    middle = F.floor((F.col("_n") - 1) / 2)
    high = F.ceil(F.lit(0.9) * (F.col("_n") - 1))
    high = F.when(high == middle, F.col("_n") - 1).otherwise(high)
    return at_ranks(records, [group], length, ident, F.array(middle.cast("bigint"), high.cast("bigint")))


def probe_problems(records: DataFrame, required: Sequence[str], per_group: int, held_out: DataFrame, group: str = "category", ident: str = "content_hash") -> DataFrame:
    """(issue, rows) of what bars records from a probe: unknown or missing groups, blank or repeated ids, small groups, held-out ids."""
    blank = F.col(ident).isNull() | (F.col(ident) == "")
    unknown = records.agg(F.count_if(~F.coalesce(F.col(group).isin(list(required)), F.lit(False))).alias("unknown_group"), F.count_if(blank).alias("blank_id"))
    repeated = records.where(~blank).groupBy(ident).agg(F.count("*").alias("n")).where("n > 1").agg(F.count("*").alias("repeated_id"))
    sizes = records.sparkSession.createDataFrame([(r,) for r in required], f"{group} string").join(records.groupBy(group).agg(F.count("*").alias("n")), group, "left")
    small = sizes.agg(F.count_if(F.col("n").isNull()).alias("missing_group"), F.count_if(F.col("n") < per_group).alias("small_group"))
    held = records.join(held_out.select(ident), ident, "left_semi").agg(F.count("*").alias("held_out"))
    names = ["unknown_group", "blank_id", "repeated_id", "missing_group", "small_group", "held_out"]
    row = unknown.crossJoin(repeated).crossJoin(small).crossJoin(held)
    return row.select(F.explode(F.array(*(F.struct(F.lit(n).alias("issue"), F.col(n).alias("rows")) for n in names))).alias("p")).select("p.*").where("rows > 0")


def batches(records: DataFrame, size: int, prompt_length: str = "prompt_length", ident: str = "content_hash") -> DataFrame:
    """batch, position and group_hash of every record, in order of prompt length.

    Global ranks come from counts by length and by slices of the ids, so that no single task sorts all records. Records are computed once
    and written.
    """
    records = Staged(records, "records").df
    by = records.groupBy(prompt_length).agg(F.count("*").alias("_n"))
    base = by.withColumn("_base_n", F.coalesce(F.sum("_n").over(Window.orderBy(prompt_length).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    ranked = before(records, [prompt_length], ident, ident, name="_own", digits=6).join(base, prompt_length).withColumn("_rank", F.col("_own") + F.col("_base_n")).drop("_own", "_base_n")
    placed = ranked.withColumns({"batch": F.floor(F.col("_rank") / size).cast("bigint"), "position": (F.col("_rank") % size).cast("int")}).drop("_rank")
    placed = Staged(placed, "placed").df
    hashes = F.transform(F.sort_array(F.collect_list(F.struct("position", F.col(ident).alias("h")))), lambda x: x["h"])
    digest = F.sha2(F.to_json(F.struct(F.lit("prompt_length_ascending").alias("batch_order"), hashes.alias("content_hashes"))), 256)
    return placed.join(placed.groupBy("batch").agg(digest.alias("group_hash")), "batch")


def before_truncation(results: DataFrame, size: int, position: str = "position") -> DataFrame:
    """The records up to the end of the first batch in which one was truncated; all if none was."""
    end = results.where("truncated").agg(((F.floor(F.min(position) / size) + 1) * size).alias("_end"))
    return results.crossJoin(F.broadcast(end)).where(F.col("_end").isNull() | (F.col(position) < F.col("_end"))).drop("_end")


def first_truncated(results: DataFrame, group: str = "category", ident: str = "content_hash") -> DataFrame:
    return results.where("truncated").groupBy(group).agg(F.min(ident).alias(ident))


def same_prefix(stored: DataFrame, selection: DataFrame) -> bool:
    """Whether stored (position, content_hash) are a prefix of the selection, by position."""
    n = stored.count()
    head = selection.where(F.col("position") < n)
    return head.count() == n and stored.join(head, ["position", "content_hash"], "left_anti").isEmpty()
