"""Summary statistics: means with intervals, index-based percentiles, paired comparisons, rollups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.operators.ranks import matched, percentiles
from sparkloom.scratch import Staged


def finite(c: Column) -> Column:
    """The value as a double, null where it is not a finite number."""
    c = c.cast("double")
    return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)


def mean_ci(c: Column) -> dict[str, Column]:
    """count, mean, stddev and a 95 % interval of the finite values, to 8 places; all null but the count for none."""
    x = finite(c)
    n, mean = F.count(x), F.avg(x)
    sd = F.when(n > 1, F.stddev_samp(x)).when(n == 1, 0.0)
    margin = F.when(n > 1, 1.96 * sd / F.sqrt(n)).when(n == 1, 0.0)
    return {"count": n, "mean": F.bround(mean, 8), "stddev": F.bround(sd, 8), "ci95_low": F.bround(mean - margin, 8), "ci95_high": F.bround(mean + margin, 8)}


def summarize(df: DataFrame, metrics: Sequence[str], *keys: str) -> DataFrame:
    """One row per group and metric with ``mean_ci``: a long table, whatever the number of metrics."""
    long = df.select(*keys, F.explode(F.array(*(F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics))).alias("m"))
    return long.select(*keys, "m.metric", "m.value").groupBy(*keys, "metric").agg(*(v.alias(k) for k, v in mean_ci(F.col("value")).items()))


def percentile_ranks(df: DataFrame, value: str, shares: Sequence[float], *keys: str) -> DataFrame:
    """count, min, max and sorted[round((n - 1) * share)] for several shares, halves to even, from counts by value."""
    return percentiles(df, value, {f"p{round(s * 100)}": ("rank", s) for s in shares}, *keys).drop("mean")


def rate(n: Column, of: Column) -> Column:
    """n / of, 0 where ``of`` is 0."""
    return F.coalesce(F.try_divide(n, of), F.lit(0.0))


def pair_up(left: DataFrame, right: DataFrame, key: str, *same: str) -> DataFrame:
    """Two runs joined by key, columns prefixed l_ and r_; raises if the keys or the columns in ``same`` differ."""
    l = left.select(*(F.col(c).alias(f"l_{c}") for c in left.columns))
    r = right.select(*(F.col(c).alias(f"r_{c}") for c in right.columns))
    both = l.join(r, F.col(f"l_{key}") == F.col(f"r_{key}"), "full_outer")
    differs = F.col(f"l_{key}").isNull() | F.col(f"r_{key}").isNull()
    for c in same:
        differs = differs | ~F.col(f"l_{c}").eqNullSafe(F.col(f"r_{c}"))
    if not both.where(differs).isEmpty():
        raise ValueError("the runs are not paired")
    return both


def transitions(pairs: DataFrame) -> DataFrame:
    """new, resolved and shared truncations and retries, and failures among retried, of two paired runs."""
    t = lambda a, b, c: F.count_if((F.col(f"l_{c}") == a) & (F.col(f"r_{c}") == b))
    return pairs.withColumns({"l_retried": F.col("l_retry_count") > 0, "r_retried": F.col("r_retry_count") > 0}).agg(
        t(False, True, "truncated").alias("new_truncations"), t(True, False, "truncated").alias("resolved_truncations"), t(True, True, "truncated").alias("both_truncated"),
        t(False, True, "retried").alias("new_retries"), t(True, False, "retried").alias("resolved_retries"), t(True, True, "retried").alias("both_retried"),
        rate(F.count_if("l_truncated"), F.count_if("l_retried")).alias("baseline_failure_rate"),
        rate(F.count_if("r_truncated"), F.count_if("r_retried")).alias("finetuned_failure_rate"),
    )


def deltas(pairs: DataFrame, metric: str) -> DataFrame:
    d = F.col(f"r_{metric}") - F.col(f"l_{metric}")
    return pairs.withColumn("d", d).agg(
        F.count("*").alias("n"), F.bround(F.avg("d"), 6).alias("mean_delta"), F.bround(F.percentile("d", 0.5), 6).alias("median_delta"),
        F.count_if(F.col("d") > 0).alias("wins"), F.count_if(F.col("d") < 0).alias("losses"), F.count_if(F.col("d") == 0).alias("ties"),
    )


#: The metrics of a benchmark result, in order.
METRICS = (
    "exact_match", "semantic_similarity", "syntax_validity", "llm_judge", "truncation_rate", "retry_rate", "generation_attempts", "generated_completion_tokens_total",
    "latency_seconds", "tokens_per_second", "batch_tokens_per_second", "generation_batch_size",
)


def aggregate_results(results: DataFrame) -> DataFrame:
    """Twelve metrics with intervals, and records, generated and errors, overall (category null) and by category.

    A row for each metric and group. Errors count but are not measured, nor are missing values; one pass over a rollup.
    """
    ok = F.col("error").isNull() | (F.col("error") == "")
    at_least_one = lambda c: F.coalesce(F.when(F.col(c) != 0, F.col(c)), F.lit(1))
    values = dict(zip(METRICS, (
        F.col("exact_match"), F.col("semantic_similarity"), F.col("syntax_valid"), F.col("judge.mean"), F.col("truncated").cast("double"), (F.coalesce("retry_count", F.lit(0)) > 0).cast("double"),
        at_least_one("generation_attempts"), F.col("generated_completion_tokens_total"), F.col("latency_seconds"), F.col("tokens_per_second"), F.col("batch_tokens_per_second"), at_least_one("generation_batch_size"),
    ), strict=True))
    cells = F.array(*(F.struct(F.lit(k).alias("metric"), F.when(ok, v.cast("double")).alias("value")) for k, v in values.items()))
    long = results.select("category", ok.alias("ok"), F.explode(cells).alias("m")).select("category", "ok", "m.metric", "m.value")
    summary = [v.alias(k) for k, v in mean_ci(F.col("value")).items()]
    return long.rollup("metric", "category").agg(F.count("*").alias("records"), F.count_if("ok").alias("generated"), F.count_if(~F.col("ok")).alias("errors"), *summary).where("metric is not null")


def audit_summary(measured: DataFrame, keys: Sequence[str], flag_names: Sequence[str], least_recall: float = 0.3) -> DataFrame:
    """Rates, medians and p90 of measured pairs (with the column flags) by group: a row for each group.

    Medians are means of the middle two, p90 is sorted[min(n - 1, int(0.9 n))]; term recall and its low rate leave
    pairs out that have none. flag_rates has a rate for every flag that occurs in the group. ``measured`` is computed once; its measures are written.
    """
    measures = ("answer_words", "length_ratio", "bullets", "term_recall")
    kinds = {c: measured.schema[c].dataType for c in measures}
    measured = Staged(measured.select(*keys, "flags", "starts_with_heading", *measures), "measured").df
    many = F.count("*")
    rates = F.create_map(*(x for f in flag_names for x in (F.lit(f), F.avg(F.array_contains("flags", f).cast("double")))))
    out = measured.groupBy(*keys).agg(
        many.alias("records"), F.avg((F.col("term_recall") < least_recall).cast("double")).alias("low_term_recall_rate"), F.avg(F.col("starts_with_heading").cast("double")).alias("starts_with_heading_rate"),
        F.map_filter(rates, lambda _, r: r > 0).alias("flag_rates"), F.avg((F.size("flags") > 0).cast("double")).alias("any_flag_rate"), F.avg((F.size("flags") >= 2).cast("double")).alias("two_or_more_flags_rate"),
    )
    cells = F.array(*(F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias("value")) for c in measures))
    long = measured.select(*keys, F.explode(cells).alias("_m")).select(*keys, F.col("_m.measure").alias("_measure"), F.col("_m.value").alias("_value"))
    found = percentiles(long, "_value", {"median": ("median", 0.5), "p90": ("share", 0.9)}, *keys, "_measure")
    at = lambda c, x: F.max(F.when(F.col("_measure") == c, F.col(x)))
    wide = found.groupBy(*keys).agg(*(x for c in measures for x in (at(c, "median").alias(f"{c}_median"), at(c, "p90").cast(kinds[c]).alias(f"{c}_p90"))))
    return matched(out, wide, list(keys), "left")


def repetition_groups(records: DataFrame, ratio: Column, words: Column, threshold: float = 0.2, long: int = 1000, keys: Sequence[str] = ("source", "category")) -> DataFrame:
    """records, high_repetition, long_responses and their rates by group, in order."""
    out = records.withColumns({"_high": ratio >= threshold, "_long": words >= long}).groupBy(*keys).agg(
        F.count("*").alias("records"), F.count_if("_high").alias("high_repetition"), F.count_if("_long").alias("long_responses"))
    return out.withColumns({"high_repetition_rate": F.col("high_repetition") / F.col("records"), "long_response_rate": F.col("long_responses") / F.col("records")}).orderBy(*keys)


def length_summary(records: DataFrame, length: str, limit: int, *keys: str) -> DataFrame:
    """records, minimum, mean, p50 to p99, maximum, over_limit and its rate, overall (keys null) or by group."""
    over = records.groupBy(*keys).agg(F.count_if(F.col(length) > limit).alias("over_limit")) if keys else records.agg(F.count_if(F.col(length) > limit).alias("over_limit"))
    found = percentiles(records, length, {f"p{p}": ("rank", p / 100) for p in (50, 90, 95, 99)}, *keys)
    found = found.withColumnsRenamed({"count": "records", "min": "minimum", "max": "maximum"}).withColumn("mean", F.bround("mean", 2))
    return matched(found, over, list(keys)).withColumn("over_limit_rate", F.bround(F.col("over_limit") / F.col("records"), 8))


def truncation_gate(results: DataFrame, most: float = 0.01) -> DataFrame:
    """rate and passed; nothing generated counts as a rate of 1."""
    made = results.where("error is null").agg(F.coalesce(F.avg(F.coalesce("truncated", F.lit(False)).cast("double")), F.lit(1.0)).alias("rate"))
    return made.withColumn("passed", F.col("rate") <= most)


def completion(results: DataFrame, full: bool, syntax: bool, judged: bool, most_truncated: float = 0.01) -> DataFrame:
    """One row: full_test, generation (no error, truncation gate passed), syntax, judge, and provisional unless all hold."""
    gate = truncation_gate(results, most_truncated)
    made = results.agg(F.coalesce(F.bool_and(F.col("error").isNull() | (F.col("error") == "")), F.lit(True)).alias("no_errors"))
    row = made.crossJoin(gate).select(F.lit(full).alias("full_test"), (F.col("no_errors") & F.col("passed")).alias("generation"), F.lit(syntax).alias("syntax"), F.lit(judged).alias("judge"))
    return row.withColumn("provisional", ~(F.col("full_test") & F.col("generation") & F.col("syntax") & F.col("judge")))
