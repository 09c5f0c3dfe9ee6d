"""Joins on keys of which one has half the rows."""

from pyspark.sql import functions as F

from sparkloom.operators import skew


def tables(spark):
    rows = spark.range(40_000).select("id", F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 97 == 1, None).otherwise(F.concat(F.lit("k"), F.col("id") % 501)).alias("k"))
    table = spark.range(501).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").alias("v")).where("v % 5 <> 0").unionByName(spark.createDataFrame([("hot", -1)], "k string, v bigint"))
    return rows.cache(), table.cache()


def largest_part(df):
    return max(r["n"] for r in df.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect())


def test_lookup_and_salted_equal_a_plain_join(spark):
    rows, table = tables(spark)
    for how in ("left", "inner"):
        want = sorted(map(tuple, rows.join(table, "k", how).select("id", "k", "v").collect()), key=str)
        for join in (skew.lookup, skew.salted):
            got = join(rows, table, ["k"], how)
            assert got.columns == ["id", "k", "v"]
            assert sorted(map(tuple, got.collect()), key=str) == want


def test_no_part_gets_all_rows_of_a_hot_key(spark):
    rows, table = tables(spark)
    rows = rows.repartition(8, "id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        assert largest_part(rows.join(table, "k", "left")) >= 20_000
        assert largest_part(skew.lookup(rows, table, ["k"], most=1)) < 8_000
        assert largest_part(skew.salted(rows, table, ["k"], most=1)) < 8_000
    finally:
        for name in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions"):
            spark.conf.unset(name)
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_several_keys_and_empty_tables(spark):
    rows = spark.createDataFrame([(1, "a", 1), (1, None, 2), (2, "a", 3)], "x int, y string, id int")
    table = spark.createDataFrame([(1, "a", "hit")], "x int, y string, v string")
    for join in (skew.lookup, skew.salted):
        assert sorted((r["id"], r["v"]) for r in join(rows, table, ["x", "y"]).collect()) == [(1, "hit"), (2, None), (3, None)]
        assert join(rows.limit(0), table, ["x", "y"]).count() == 0
        assert join(rows, table.limit(0), ["x", "y"], "inner").count() == 0


def test_without_and_nulls_as_keys(spark):
    rows, table = tables(spark)
    gone = skew.without(rows, table, ["k"]).collect()
    want = rows.join(table, "k", "left_anti").collect()
    assert sorted(r["id"] for r in gone) == sorted(r["id"] for r in want) and any(r["k"] is None for r in gone)
    some = spark.createDataFrame([("a", 1), (None, 2), (None, 3), ("b", 4)], "k string, id int")
    named = spark.createDataFrame([("a", "A"), (None, "N")], "k string, v string")
    assert sorted((r["id"], r["v"]) for r in skew.matched_lookup(some, named, ["k"]).collect()) == [(1, "A"), (2, "N"), (3, "N"), (4, None)]


def test_exact_dedupe_spreads_a_frequent_text(spark):
    from sparkloom.operators.dedupe import exact_dedupe

    rows = spark.range(20_000).select((F.col("id") % 3).alias("input_rank"), F.col("id").alias("ordinal"), F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 11 == 1, None).otherwise(F.concat(F.lit("k"), F.col("id") % 3001)).alias("content_hash"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = exact_dedupe(rows)
        assert largest_part(out) < 8_000
        got = {r["ordinal"]: (r["is_duplicate"], r["kept_id"]) for r in out.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    first = {}
    for r in sorted(rows.collect()):
        first.setdefault(r["content_hash"], r["ordinal"])
    assert got == {r["ordinal"]: (False, r["ordinal"]) if r["content_hash"] is None else (first[r["content_hash"]] != r["ordinal"], first[r["content_hash"]]) for r in rows.collect()}


def test_a_sketch_that_answers_differently_each_time_changes_nothing(spark, monkeypatch):
    import random

    rows, table = tables(spark)
    coin = F.udf(lambda h: random.random() < 0.5, "boolean").asNondeterministic()
    exact = skew.heavy_hashes
    monkeypatch.setattr(skew, "heavy_hashes", lambda *a: exact(*a).where(coin("heavy_hash")))
    for how in ("left", "inner"):
        want = sorted(map(tuple, rows.join(table, "k", how).select("id", "k", "v").collect()), key=str)
        for join in (skew.lookup, skew.salted):
            assert sorted(map(tuple, join(rows, table, ["k"], how).collect()), key=str) == want
