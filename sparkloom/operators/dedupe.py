"""Exact dedupe: the first record of each canonical hash stays."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.operators.skew import lookup, matched_lookup
from sparkloom.scratch import Staged
from sparkloom.shipping import ship


def exact_dedupe(records: DataFrame, key: str = "content_hash", order: tuple[str, ...] = ("input_rank", "ordinal"), ident: str = "ordinal") -> DataFrame:
    """``records`` with is_duplicate and kept_id, the ``ident`` of the first record of the group.

    ``records`` is computed once and written, so pass the columns that are needed. The first of each group is found from (key, order, ident)
    alone, combined before the shuffle. It is looked up where a group has several records: for heavy keys in a broadcast, for the others by
    shuffle, so no task gets all records of a frequent text. The order is explicit and must be unique. Records with a null key are no
    duplicates.
    """
    mine = F.struct(*(F.col(c).alias(f"o{k}") for k, c in enumerate(order)), F.col(ident).alias("id"))
    records = Staged(records, "records").df
    best = records.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(mine).alias("_best"), F.count("*").alias("_n")).where(F.col("_n") > 1).drop("_n")
    both = lookup(records, best, [key])
    return both.select(*records.columns, F.coalesce(mine != F.col("_best"), F.lit(False)).alias("is_duplicate"), F.coalesce("_best.id", F.col(ident)).alias("kept_id"))


def in_order(records: DataFrame, order: tuple[str, ...] = ("input_rank", "ordinal")) -> DataFrame:
    """Kept records in their original order."""
    return records.where(~F.col("is_duplicate")).orderBy(*order)


def report_by(records: DataFrame, *keys: str) -> DataFrame:
    """input, kept and removed rows for each value of the keys, in order of the keys."""
    return records.groupBy(*keys).agg(
        F.count("*").alias("input"), F.count_if(~F.col("is_duplicate")).alias("kept"), F.count_if("is_duplicate").alias("removed")
    ).orderBy(*keys)


def cluster_ids(members: DataFrame, ident: str = "content_hash") -> DataFrame:
    """(component, semantic_cluster_id): SHA-256 over the sorted members, ``|`` between them.

    Members come to their task in order and go into the digest one by one, so a component of any size takes no memory.
    """
    ship(members.sparkSession)
    kind = members.schema["component"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None
        for batch in batches:
            out: list[tuple] = []
            for c, h in zip(batch.column("component").to_pylist(), batch.column("h").to_pylist(), strict=True):
                if digest is None or c != now:
                    if digest is not None:
                        out.append((now, digest.hexdigest()))
                    now, digest = c, hashlib.sha256(h.encode())
                else:
                    digest.update(b"|" + h.encode())
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], batch.column("component").type), pa.array([r[1] for r in out], pa.string())], ["component", "semantic_cluster_id"])
            type_ = batch.column("component").type
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], type_), pa.array([digest.hexdigest()])], ["component", "semantic_cluster_id"])

    rows = members.select("component", F.col(ident).cast("string").alias("h")).repartition("component").sortWithinPartitions("component", "h")
    return rows.mapInArrow(run, f"component {kind}, semantic_cluster_id string")


def representatives(members: DataFrame, tier: str = "tier", ident: str = "content_hash") -> DataFrame:
    """For each component: size, the member with the best (quality, tier, hash) and the id over all members."""
    best = F.min_by(F.col(ident), F.struct((-F.col("quality")).alias("q"), F.col(tier).alias("t"), F.col(ident).alias("h")))
    return members.groupBy("component").agg(F.count("*").alias("size"), best.alias("representative")).join(cluster_ids(members, ident), "component")


def with_tier(members: DataFrame, tiers: DataFrame, source: str = "source", otherwise: int = 99) -> DataFrame:
    """``members`` with the tier of their source (``tiers``: source, tier), ``otherwise`` where it has none."""
    return matched_lookup(members, tiers.select(source, "tier").dropDuplicates([source]), [source]).withColumn("tier", F.coalesce("tier", F.lit(otherwise)))


def size_histogram(members: DataFrame) -> DataFrame:
    return members.groupBy("component").agg(F.count("*").alias("size")).groupBy("size").agg(F.count("*").alias("components"))
