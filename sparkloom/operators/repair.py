"""Repair of leaks between splits by whole groups: a group of records, a semantic cluster say, moves as one."""

from __future__ import annotations

import heapq
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.functions.text import deterministic_key
from sparkloom.operators import similarity
from sparkloom.operators.ranks import before, matched
from sparkloom.operators.skew import lookup
from sparkloom.scratch import Staged
from sparkloom.shipping import ship

STRATUM = ["category", "source"]


def group_table(records: DataFrame, order: str = "id") -> DataFrame:
    """(group, size, category, source, hardness, split) of records; what describes a group is its first record's, by ``order``. Raises where a group is in several splits."""
    g = records.groupBy("group").agg(
        F.count("*").alias("size"), F.min_by(F.struct("category", "source", "hardness"), order).alias("first"), F.min("split").alias("split"), F.max("split").alias("last"))
    g = Staged(g, "groups").df
    broken = g.where("split <> last").select("group").limit(1).collect()
    if broken:
        raise ValueError(f"group {broken[0][0]} is in several splits")
    return g.select("group", "size", "first.category", "first.source", F.coalesce("first.hardness", F.lit(0)).alias("hardness"), "split")


def fill(needs: Sequence[tuple[str, str, int]], pools: dict[str, list[tuple[str, int]]]) -> tuple[list[tuple[str, str]], list[tuple[str, int]]]:
    """What is chosen, (group, target), and what stays unmet, (target, count), for the needs (group that left, target, size) of one stratum.

    Needs go in order of the group that left. Each walks its target's pool (group, size; in order of preference) and takes every group that
    is still free and no larger than what is left to fill. What has been passed over can't fit later, so the walk is: the first free
    group among those of fitting size, again and again.
    """
    queues: dict[str, dict[int, list[tuple[int, str]]]] = {}
    for target, pool in pools.items():
        for place, (group, size) in enumerate(pool):
            queues.setdefault(target, {}).setdefault(size, []).append((place, group))
    heads = {target: dict.fromkeys(by, 0) for target, by in queues.items()}
    taken: set[str] = set()
    chosen, unmet = [], []
    for _, target, left in sorted(needs):
        by, at = queues.get(target, {}), heads.get(target, {})
        open_: list[tuple[int, int]] = []
        for size in by:
            if size <= left:
                _next(by[size], at, size, taken, open_)
        heapq.heapify(open_)
        while left and open_:
            _, size = heapq.heappop(open_)
            if size > left:
                continue
            group = by[size][at[size]][1]
            if group not in taken:
                taken.add(group)
                chosen.append((group, target))
                left -= size
            more: list[tuple[int, int]] = []
            _next(by[size], at, size, taken, more)
            for x in more:
                heapq.heappush(open_, x)
        if left:
            unmet.append((target, left))
    return chosen, unmet


def _next(queue: list[tuple[int, str]], at: dict[int, int], size: int, taken: set[str], out: list[tuple[int, int]]) -> None:
    """Moves the head of a queue to its first free group and notes its place."""
    while at[size] < len(queue) and queue[at[size]][1] in taken:
        at[size] += 1
    if at[size] < len(queue):
        out.append((queue[at[size]][0], size))


def _filled(key: tuple, needs: pa.Table, pool: pa.Table) -> pa.Table:
    pools: dict[str, list[tuple[str, int]]] = {}
    rows = sorted(zip(*(pool.column(c).to_pylist() for c in ("target", "_key", "group", "size")), strict=True))
    for target, _, group, size in rows:
        pools.setdefault(target, []).append((group, size))
    chosen, unmet = fill(list(zip(*(needs.column(c).to_pylist() for c in ("group", "target", "size")), strict=True)), pools)
    n, m = len(chosen), len(unmet)
    columns = [[g for g, _ in chosen] + [None] * m, [t for _, t in chosen] + [t for t, _ in unmet], [0] * n + [k for _, k in unmet]]
    strata = [pa.array([key[i].as_py()] * (n + m), pa.string()) for i in (0, 1)]
    return pa.Table.from_arrays([*strata, pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.int64())], ["category", "source", "group", "target", "unmet"])


def backfill(free: DataFrame, links: DataFrame, needs: DataFrame, seed: int) -> DataFrame:
    """(category, source, group, target, unmet): groups of ``free`` that take the place of ``needs`` (group, category, source, target, size).

    A group can come where it is of the stratum, is no larger than the largest need, and has by ``links`` (group, split) none
    outside its target; hard ones first for test. Of each size only as many as all needs of the stratum together could take
    are looked at, found by prefix sums over the order; so a stratum's task holds what is to be filled, not the stratum.
    """
    ship(free.sparkSession)
    wanted = needs.groupBy(*STRATUM).agg(F.sum("size").alias("wanted"))
    largest = needs.groupBy("target", *STRATUM).agg(F.max("size").alias("largest"))
    pools = []
    for target in sorted(r["target"] for r in needs.select("target").distinct().collect()):
        could = matched(free.drop("split"), largest.where(F.col("target") == target).select(*STRATUM, "largest"), STRATUM).where("size <= largest")
        safe = could.join(links.where(F.col("split") != target).select("group"), "group", "left_anti")
        hard = F.when(F.col("category") == "troubleshooting", F.col("hardness")).otherwise(0) if target == "test" else F.lit(0)
        key = F.concat(F.lpad((9999 - hard).cast("string"), 4, "0"), deterministic_key(seed, F.col("group")))
        pools.append(safe.select("group", "size", *STRATUM, F.lit(target).alias("target"), key.alias("_key")))
    pool = pools[0]
    for more in pools[1:]:
        pool = pool.unionByName(more)
    placed = before(Staged(pool, "pool").df, ["target", *STRATUM, "size"], "_key", "group", digits=7)
    pool = matched(placed, wanted, STRATUM).where(F.col("_before") < F.floor(F.col("wanted") / F.col("size"))).select("category", "source", "target", "_key", "group", "size")
    left = needs.select("category", "source", "group", "target", "size").groupBy(*STRATUM)
    return left.cogroup(pool.groupBy(*STRATUM)).applyInArrow(_filled, "category string, source string, group string, target string, unmet bigint")


def repair(assigned: DataFrame, pairs: list[tuple[str, str]], threshold: float, seed: int = 3407, most_rounds: int = 10, order: str = "id", strict: bool = True) -> DataFrame:
    """``assigned`` (id, vector, category, source, hardness, split and group, or each record by itself) without leaks; no group is split.

    In each round the groups of leaking eval records go to train, and their places in their strata are filled with whole train
    groups that fit. A group that has leaked never comes back. Raises where a group is in several splits and, if ``strict``, where a stratum can't be
    filled to the record or leaks remain after ``most_rounds``; else places that no group fits stay empty, and what ``most_rounds`` have made
    is returned. Which groups leak, are lost or chosen are tables, never lists on the driver.

    All vectors meet once. A train group linked to another one can't go: neither is safe before the other has gone. So the first
    round leaves the ``lonely`` ones, and what has been chosen doesn't leak, as it is safe. From then on vectors that come to train meet what is left.
    """
    given = assigned.columns
    rows = assigned if "group" in given else assigned.withColumn("group", F.col("id").cast("string"))
    size = similarity.block_size(rows.count())
    pivots = similarity.pivots_of(rows, size * similarity.PER_BLOCK)  # one for each block
    records = Staged(similarity.deal(rows, pivots, size), "assigned").df
    now, lonely, joined = group_table(records, order), None, None
    blocks = similarity.Blocks(records, pivots, "group", "split")
    asks = [(left, right) if right == "train" else (right, left) for left, right in pairs]
    train = F.col("split") == "train"

    def packed(groups: DataFrame) -> similarity.Blocks:
        """Blocks of the records of groups (group, split)."""
        return similarity.Blocks(lookup(records.drop("split"), groups.select("group", "split"), ["group"], "inner"), pivots, "group", "split")

    for round_ in range(1, most_rounds + 1):
        answer = blocks if joined is None else joined.of(train)
        found = similarity.reached((joined or blocks).of(~train), answer, threshold, asks)
        leaking = Staged(found.select(F.col("label").alias("group")).distinct(), "leaking").df
        if leaking.isEmpty():
            return _with(records, now.select("group", F.col("split").alias("to"))).select(given)
        if strict and not leaking.where("group is null").isEmpty():
            raise ValueError("records without a group leak")
        needs = Staged(now.join(leaking, "group", "left_semi").withColumnRenamed("split", "target"), "needs").df
        if lonely is None:
            stuck = similarity.reached(blocks.of(train), blocks.of(train), threshold).withColumnRenamed("label", "group")
            lonely = Staged(now.where(train).join(stuck, "group", "left_anti"), "lonely").df
        moved = Staged(_changed(now, leaking.withColumn("to", F.lit("train"))), "moved").df
        joined = packed(moved.where(~train).unionByName(moved.join(leaking, "group", "left_semi")))
        links = Staged(similarity.reached(packed(lonely), joined, threshold).toDF("group", "split"), "links").df
        lonely = lonely.join(links.where(train), "group", "left_anti")
        filled = Staged(backfill(lonely, links, needs, seed + round_), "filled").df
        unmet = filled.where("unmet > 0").limit(1).collect() if strict else []
        if unmet:
            raise ValueError(f"cannot fill {unmet[0]['unmet']} {unmet[0]['target']} records of {unmet[0]['category']}/{unmet[0]['source']}")
        chosen = filled.where("group is not null").select("group", F.col("target").alias("to"))
        now = Staged(_changed(moved, chosen), "split").df
        lonely = Staged(lonely.join(chosen, "group", "left_anti"), "lonely").df
    if strict:
        raise RuntimeError(f"leaks remain after {most_rounds} rounds")
    return _with(records, now.select("group", F.col("split").alias("to"))).select(given)


def _changed(groups: DataFrame, changes: DataFrame) -> DataFrame:
    """``groups`` with the split of those in ``changes`` (group, to) changed."""
    return groups.join(changes, "group", "left").withColumn("split", F.coalesce("to", "split")).drop("to")


def _with(records: DataFrame, changes: DataFrame) -> DataFrame:
    """``records`` with the split of the groups in ``changes`` (group, to) changed."""
    return lookup(records, changes, ["group"]).withColumn("split", F.coalesce("to", "split")).drop("to")
