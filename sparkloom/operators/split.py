"""Deterministic stratified group splits, by prefix sums over hash order instead of greedy loops."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.functions.text import deterministic_key
from sparkloom.operators.ranks import before, matched
from sparkloom.scratch import Staged


def stratum_seed(seed: int, category: Column, source: Column) -> Column:
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), category, F.lit("|"), source), 256)
    return F.lit(seed).cast("bigint") + F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def allocate(groups: DataFrame, seed: int = 3407, test: float = 0.05, validation: float = 0.05, minimum: int = 2, rare: int = 40) -> DataFrame:
    """``groups`` (group, category, source, size) with split.

    In each stratum, groups in hash order go to test until its target is met, then to validation, then
    to train. A stratum of fewer than 3 is all train; targets round half to even. ``groups`` is read once: keys and sizes are written.
    """
    stratum = ["category", "source"]
    key = F.sha2(F.concat(stratum_seed(seed, F.col("category"), F.col("source")).cast("string"), F.lit(":"), F.col("group")), 256)
    groups = Staged(groups.withColumn("_key", key), "groups").df
    out = before(groups, stratum, "_key", "group", F.col("size"))
    least = F.when(F.col("_total") < rare, 1).otherwise(minimum)
    t = F.greatest(least, F.bround(F.col("_total") * test, 0).cast("bigint"))
    v = F.greatest(least, F.bround(F.col("_total") * validation, 0).cast("bigint"))
    totals = groups.groupBy(*stratum).agg(F.sum("size").alias("_total"))
    totals = totals.withColumns({"_t": F.when(t + v >= F.col("_total"), 1).otherwise(t), "_v": F.when(t + v >= F.col("_total"), 1).otherwise(v)})
    out = Staged(matched(out, totals, stratum), "ranked").df
    tests = out.groupBy(*stratum).agg(F.sum(F.when(F.col("_before") < F.col("_t"), F.col("size")).otherwise(0)).alias("_tests"))
    out = matched(out, tests, stratum)
    split = (
        F.when(F.col("_total") < 3, "train").when(F.col("_before") < F.col("_t"), "test")
        .when(F.col("_before") - F.col("_tests") < F.col("_v"), "validation").otherwise("train")
    )
    return out.withColumn("split", split).select(*(c for c in groups.columns if c != "_key"), "split")


#: Slices of the order in which groups are evicted.
LEVELS = 4096


def rebalance(groups: DataFrame, name: str, required: Mapping[str, int], target: int, seed: int, strict: bool = True) -> DataFrame:
    """Category minima of one split filled from train in hash order, then its overflow sent back to train, group by group.

    ``groups`` has group, category, size (1 at least) and split. Where train can't fill a minimum it raises, or, if not ``strict``, gives what it
    has. While the split is too large, a group of the category with the largest surplus over its minimum goes, the smallest first, then by hash, as long
    as its category stays above the minimum. The surplus that a category has when a group's turn comes is known beforehand, from
    the sizes that go before it; so the order of leaving is by that surplus, and who leaves is a prefix of it: two prefix sums by slices, no loop.
    """
    if not required:
        return groups
    columns = groups.columns
    need = F.create_map(*(F.lit(x) for pair in required.items() for x in pair))
    minimum = F.coalesce(F.try_element_at(need, F.col("category")), F.lit(0))
    keyed = groups.withColumns({"_key": deterministic_key(seed + (1 if name == "test" else 2), F.col("group")), "_own": deterministic_key(seed, F.col("group"))})
    keyed = Staged(keyed, "keyed").df
    have = keyed.groupBy("category").agg(
        F.sum(F.when(F.col("split") == name, F.col("size")).otherwise(0)).alias("_have"), F.sum(F.when(F.col("split").isin(name, "train"), F.col("size")).otherwise(0)).alias("_could"))
    short = have.where((minimum > F.col("_have")) & (F.col("_could") < minimum)).select("category").limit(1).collect() if strict else []
    if short:
        raise ValueError(f"train cannot fill the minimum of {short[0][0]}")
    filled = matched(before(keyed, ["category", "split"], "_key", "group", F.col("size")), have.select("category", "_have"), ["category"])
    filled = filled.withColumn("split", F.when((F.col("split") == "train") & (F.col("_before") < minimum - F.col("_have")), name).otherwise(F.col("split")))
    filled = Staged(filled.select(*columns, "_own"), "filled").df
    inside = filled.where(F.col("split") == name)
    over = (inside.agg(F.sum("size")).first()[0] or 0) - target
    if over <= 0:
        return filled.drop("_own")
    counts = inside.groupBy("category").agg(F.sum("size").alias("_many"))
    runs = inside.withColumn("_run", F.concat(F.lpad(F.col("size").cast("string"), 12, "0"), "_own"))
    surplus = matched(before(runs, ["category"], "_run", "group", F.col("size"), digits=15), counts, ["category"]).withColumn("_surplus", F.col("_many") - minimum - F.col("_before"))
    able = Staged(surplus.where(F.col("_surplus") >= F.col("size")).select("group", "size", "_run", "_surplus"), "able").df
    most = able.agg(F.max("_surplus").alias("_most"))
    level = F.lit(LEVELS - 1) - F.floor(F.col("_surplus") * LEVELS / (F.col("_most") + 1))
    order = F.concat(F.lpad(level.cast("string"), 4, "0"), F.lpad((F.col("_most") - F.col("_surplus")).cast("string"), 19, "0"), F.col("_run"))
    turns = before(able.crossJoin(F.broadcast(most)).select("group", "size", order.alias("_turn")), [], "_turn", "group", F.col("size"), digits=4)
    gone = turns.where(F.col("_before") < over).select(F.col("group").alias("_gone"))
    back = filled.join(gone, F.col("group") == F.col("_gone"), "left")
    return back.withColumn("split", F.when(F.col("_gone").isNotNull(), "train").otherwise(F.col("split"))).drop("_gone", "_own")


def hard_target(tests: int, minimum: int, maximum: int, fraction: float) -> int:
    """How many hard records a test set of so many records has: a share of it, rounded up, within bounds."""
    return min(maximum, max(minimum, math.ceil(tests * fraction)))


def hard_test(records: DataFrame, tests: int, category: str, minimum: int, maximum: int, fraction: float, least_sources: int, seed: int, least_score: int = 1, key: str = "content_hash") -> DataFrame:
    """The hard records of a test set: (explicit first, score, hash) order; raises if too few, or from too few sources.

    ``records`` has category, source, score, explicit (boolean) and the key.
    """
    wanted = hard_target(tests, minimum, maximum, fraction)
    able = records.where((F.col("category") == category) & (F.col("score") >= least_score)).withColumn("_key", deterministic_key(seed, F.col(key)))
    chosen = able.orderBy(~F.coalesce("explicit", F.lit(False)), F.col("score").desc(), "_key", key).limit(wanted).drop("_key")
    chosen = Staged(chosen, "hard").df  # scores are computed once; ``maximum`` rows
    n = chosen.agg(F.count("*").alias("n"), F.count_distinct("source").alias("s")).first()
    if n["n"] < wanted:
        raise ValueError(f"only {n['n']} hard records, {wanted} are required")
    if n["s"] < least_sources:
        raise ValueError(f"the hard records come from {n['s']} sources only")
    return chosen.orderBy(~F.coalesce("explicit", F.lit(False)), F.col("score").desc(), deterministic_key(seed, F.col(key)), key)


def statistics(records: DataFrame) -> DataFrame:
    """Counts by split, by split and category, and by split and source, in one pass over grouping sets."""
    records.createOrReplaceTempView("_split_records")
    return records.sparkSession.sql(
        "SELECT split, category, source, count(*) AS n FROM _split_records GROUP BY GROUPING SETS ((split), (split, category), (split, source))"
    )


def ratio_gate(records: DataFrame, targets: Mapping[str, float], tolerance: float) -> DataFrame:
    """(split, n, ratio, within): each split's share of the records, and whether it lies within the tolerance of its target; a split without a target doesn't."""
    counts = records.groupBy("split").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("_total"))
    wanted = F.create_map(*(F.lit(x) for pair in targets.items() for x in pair))
    share = F.col("n") / F.col("_total")
    within = F.coalesce(F.abs(share - F.try_element_at(wanted, F.col("split"))) <= tolerance, F.lit(False))
    return counts.crossJoin(F.broadcast(total)).select("split", "n", share.alias("ratio"), within.alias("within"))


def overlaps(records: DataFrame, key: str) -> DataFrame:
    """Values of a key that lie in more than one split (must be empty)."""
    return records.groupBy(key).agg(F.count_distinct("split").alias("splits")).where("splits > 1")


def shuffled(records: DataFrame, seed: int = 3407, key: str = "content_hash") -> DataFrame:
    """position of every record within its split, in hash order."""
    return before(records.withColumn("_key", deterministic_key(seed, F.col(key))), ["split"], "_key", key, name="position").drop("_key")


def round_robin(records: DataFrame, size: int, seed: int, ident: str) -> DataFrame:
    """``size`` records, dealt over sources and, within a source, over categories, each by hash."""
    key = deterministic_key(seed, F.col(ident))
    r1 = F.row_number().over(Window.partitionBy("source", "category").orderBy(key, ident))
    r2 = F.row_number().over(Window.partitionBy("source").orderBy("_r1", "category"))
    ranked = records.withColumn("_r1", r1).where(F.col("_r1") <= size).withColumn("_r2", r2)
    return ranked.orderBy("_r2", "source").limit(size).drop("_r1", "_r2")


def hash_sample(records: DataFrame, size: int, ident: str) -> DataFrame:
    """The ``size`` records with the least hash of their id, with it as sample_key."""
    return records.withColumn("sample_key", F.sha2(F.col(ident), 256)).orderBy("sample_key", ident).limit(size)


def judge_sample(test: DataFrame, size: int, hard_minimum: int, seed: int, key: str = "content_hash") -> DataFrame:
    """Hard records first by hash, then the rest dealt over (category, source)."""
    order = deterministic_key(seed, F.col(key))
    hard = test.where("hard").orderBy(order).limit(hard_minimum)
    rest = test.join(hard.select(key), key, "left_anti")
    rn = F.row_number().over(Window.partitionBy("category", "source").orderBy(order, key))
    # The quota of the rest depends on how many hard records there are: a bounded count.
    left = size - min(hard_minimum, hard.count())
    return hard.unionByName(rest.withColumn("_rn", rn).where(F.col("_rn") <= left).orderBy("_rn", "category", "source").limit(left).drop("_rn"))


def first_of_each(records: DataFrame, most: int, group: str, order: Sequence[str]) -> DataFrame:
    """The first ``most`` records of each group (a repository, say) in scan order."""
    return records.withColumn("_rank", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("_rank") <= most).drop("_rank")


def page(records: DataFrame, order: Sequence[str], offset: int = 0, limit: int | None = None) -> DataFrame:
    """Records in order from ``offset`` on, ``limit`` of them."""
    out = records.orderBy(*order).offset(offset)
    return out if limit is None else out.limit(limit)


def sorted_map(counts: DataFrame, key: str, value: str) -> DataFrame:
    """One row with the counts of a report as a list of (key, value) in order of the key: as many entries as the report has keys."""
    return counts.agg(F.sort_array(F.collect_list(F.struct(F.col(key).alias("key"), F.col(value).alias("value")))).alias("entries"))
