"""Ranks and prefix sums in two levels, so that no task holds a whole category, split or length.

Rows are dealt to slices by a prefix of their order key, slices are summed (a row for each slice), and what
stands before a slice is added to the sums within it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Characters of the order key that make a slice: 4096 slices of a hexadecimal hash.
DIGITS = 3


def same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Equality of keys, nulls being equal."""
    return reduce(lambda a, b: a & b, (left[k].eqNullSafe(right[k]) for k in keys), F.lit(True))


def matched(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """``left`` joined to ``right`` by keys of which nulls are equal; the keys stay those of ``left``."""
    if not keys:
        return left.crossJoin(F.broadcast(right))
    l, r = left.alias("l"), right.alias("r")
    on = reduce(lambda a, b: a & b, (F.col(f"l.`{k}`").eqNullSafe(F.col(f"r.`{k}`")) for k in keys))
    return l.join(r, on, how).select("l.*", *(F.col(f"r.`{c}`") for c in right.columns if c not in keys))


def before(df: DataFrame, keys: Sequence[str], key: str, tie: str, value: Column | None = None, name: str = "_before", digits: int = DIGITS) -> DataFrame:
    """``df`` with the sum of ``value`` (1 by default) over the rows that come before, by (key, tie), among those of equal ``keys``.

    ``key`` is a string whose first characters spread the rows; any string gives right sums.
    """
    value = F.lit(1).cast("bigint") if value is None else value
    own = df.withColumns({"_slice": F.substring(key, 1, digits), "_value": value})
    sums = own.groupBy(*keys, "_slice").agg(F.sum("_value").alias("_sum"))
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select(*keys, "_slice", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base"))
    inside = Window.partitionBy(*keys, "_slice").orderBy(key, tie).rowsBetween(Window.unboundedPreceding, -1)
    out = own.withColumn("_inside", F.coalesce(F.sum("_value").over(inside), F.lit(0)))
    return matched(out, bases, [*keys, "_slice"]).withColumn(name, F.col("_base") + F.col("_inside")).drop("_slice", "_value", "_base", "_inside")


def at_ranks(df: DataFrame, keys: Sequence[str], value: str, ident: str, wanted: Column) -> DataFrame:
    """The rows at the ranks ``wanted`` (an array, given the group's size ``_n``) by (value, ident) in their group, with rank.

    Ranks come from counts by value: only rows whose value holds a wanted rank are ordered.
    """
    counts = df.groupBy(*keys, value).agg(F.count("*").alias("_many"))
    group = Window.partitionBy(*keys)
    upto = counts.withColumns({"_end": F.sum("_many").over(group.orderBy(value)), "_n": F.sum("_many").over(group)}).withColumn("_start", F.col("_end") - F.col("_many"))
    cells = upto.withColumn("_ranks", F.filter(F.array_distinct(wanted), lambda r: (r >= F.col("_start")) & (r < F.col("_end")))).where(F.size("_ranks") > 0)
    near = matched(df, cells.select(*keys, value, "_ranks", "_start"), [*keys, value])
    order = F.row_number().over(Window.partitionBy(*keys, value).orderBy(ident)) - 1 + F.col("_start")
    return near.withColumn("rank", order).where(F.array_contains("_ranks", F.col("rank"))).drop("_ranks", "_start")


def percentiles(df: DataFrame, value: str, picks: dict[str, tuple[str, float]], *keys: str) -> DataFrame:
    """count, min, max, mean and index-based percentiles of a column by group, from counts by value.

    ``picks`` names each percentile and its rule: ``rank`` is sorted[round((n - 1) p)], halves to even; ``share`` is
    sorted[min(n - 1, int(n p))]; ``median`` the mean of the middle two. Null values don't count; groups without values are left out.
    """
    one = keys or ("_all",)
    df = df.where(F.col(value).isNotNull())
    df = df if keys else df.withColumn("_all", F.lit(0))
    counts = df.groupBy(*one, value).agg(F.count("*").alias("_many"))
    group = Window.partitionBy(*one)
    upto = counts.withColumns({"_end": F.sum("_many").over(group.orderBy(value)), "_n": F.sum("_many").over(group)})
    start = F.col("_end") - F.col("_many")

    def at(rank: Column) -> Column:
        return F.max(F.when((rank >= start) & (rank < F.col("_end")), F.col(value)))

    out = {}
    for name, (rule, p) in picks.items():
        if rule == "rank":
            out[name] = at(F.bround((F.col("_n") - 1) * p, 0))
        elif rule == "share":
            out[name] = at(F.least(F.col("_n") - 1, F.floor(F.col("_n") * p)))
        else:
            out[name] = (at(F.floor((F.col("_n") - 1) / 2)).cast("double") + at(F.floor(F.col("_n") / 2)).cast("double")) / 2
    got = upto.groupBy(*one).agg(
        F.max("_n").alias("count"), F.min(value).alias("min"), F.max(value).alias("max"), (F.sum(F.col(value).cast("double") * F.col("_many")) / F.sum("_many")).alias("mean"), *(c.alias(n) for n, c in out.items()))
    return got if keys else got.drop("_all")
