"""Joins on keys of which a few may hold a large share of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.scratch import Staged

#: At most so many keys are taken for heavy: 8 bytes each, broadcast.
MOST = 1_000
#: Counters of the sketch: a key in more than about 1/20,000 of the rows is found.
COUNTERS = 20_000
#: Heavy keys are dealt to so many parts each.
SALTS = 64


def heavy_hashes(rows: DataFrame, keys: list[str], most: int = MOST, counters: int = COUNTERS) -> DataFrame:
    """(heavy_hash,): hashes of the keys that may be the most frequent of ``rows``, at most ``most`` of them."""
    top = rows.where(_known(keys)).select(F.xxhash64(*keys).alias("h")).select(F.explode(F.expr(f"approx_top_k(h, {most}, {counters})")).alias("t"))
    return top.select(F.col("t.item").alias("heavy_hash")).where("heavy_hash is not null").distinct()


def _settled(rows: DataFrame, keys: list[str], most: int) -> DataFrame:
    """``heavy_hashes``, written: the sketch depends on the order in which parts are merged, and all branches of a join must mean the same keys."""
    return Staged(heavy_hashes(rows, keys, most), "heavy").df


def _known(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys))


def lookup(rows: DataFrame, table: DataFrame, keys: list[str], how: str = "left", most: int = MOST) -> DataFrame:
    """``rows`` joined to the row that ``table`` has for their keys, if any; ``table`` has one row at most for each.

    Rows of heavy keys find theirs in a broadcast of at most ``most`` rows (more only where hashes clash), so
    no task gets all rows of a key; the others are shuffled. Rows with a null key go round the join. For tables of narrow rows;
    ``salted`` takes wide ones. ``rows`` is read three times: pass a written table.
    """
    more = [c for c in table.columns if c not in keys]
    hashes = _settled(rows, keys, most)
    own = F.xxhash64(*keys)
    heavy_table = table.withColumn("heavy_hash", own).join(F.broadcast(hashes), "heavy_hash", "left_semi").drop("heavy_hash")
    marked = rows.where(_known(keys)).withColumn("heavy_hash", own).join(F.broadcast(hashes.withColumn("is_heavy", F.lit(True))), "heavy_hash", "left").drop("heavy_hash")
    settled = marked.where("is_heavy").drop("is_heavy").join(F.broadcast(heavy_table), keys, how)
    dealt = marked.where("is_heavy is null").drop("is_heavy").join(table, keys, how)
    columns = [*rows.columns, *more]
    out = settled.select(columns).unionByName(dealt.select(columns))
    if how == "left":
        nulls = rows.where(~_known(keys)).select(*rows.columns, *(F.lit(None).cast(table.schema[c].dataType).alias(c) for c in more))
        out = out.unionByName(nulls)
    return out


def salted(rows: DataFrame, table: DataFrame, keys: list[str], how: str = "left", most: int = MOST, salts: int = SALTS) -> DataFrame:
    """``rows`` joined to ``table``; the rows of heavy keys are dealt to ``salts`` parts each, where that key's rows of ``table`` are repeated.

    Only hashes of at most ``most`` keys are broadcast, whatever the rows' width. Rows with a null key go round the join.
    ``rows`` is read twice: pass a written table.
    """
    more = [c for c in table.columns if c not in keys]
    hashes = F.broadcast(_settled(rows, keys, most).withColumn("is_heavy", F.lit(True)))
    own = F.xxhash64(*keys)
    spread = F.when(F.col("is_heavy"), F.pmod(F.monotonically_increasing_id(), F.lit(salts))).otherwise(0).cast("int")
    left = rows.where(_known(keys)).withColumn("heavy_hash", own).join(hashes, "heavy_hash", "left").withColumn("salt", spread).drop("heavy_hash", "is_heavy")
    parts = F.when(F.col("is_heavy"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = table.withColumn("heavy_hash", own).join(hashes, "heavy_hash", "left").withColumn("salt", F.explode(parts)).drop("heavy_hash", "is_heavy")
    columns = [*rows.columns, *more]
    out = left.join(right, [*keys, "salt"], how).select(columns)
    if how == "left":
        nulls = rows.where(~_known(keys)).select(*rows.columns, *(F.lit(None).cast(table.schema[c].dataType).alias(c) for c in more))
        out = out.unionByName(nulls)
    return out


def without(rows: DataFrame, table: DataFrame, keys: list[str], most: int = MOST) -> DataFrame:
    """``rows`` whose keys ``table`` doesn't have; rows with a null key stay. Heavy keys go as in ``lookup``; ``rows`` is read three times."""
    had = table.select(*keys).distinct().withColumn("had", F.lit(True))
    return lookup(rows, had, keys, most=most).where("had is null").drop("had")


def matched_lookup(rows: DataFrame, table: DataFrame, keys: list[str], how: str = "left", most: int = MOST) -> DataFrame:
    """As ``lookup`` with nulls as equal as any other value, so that very many rows with a null key are a heavy key too."""
    both = F.struct(*keys)  # fields of a struct that are both null are equal
    named = table.withColumn("_keys", both).drop(*keys)
    return lookup(rows.withColumn("_keys", both), named, ["_keys"], how, most).drop("_keys")
