"""Benchmark results: defaults, caches, retries, unions of variants, and the model that was served."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Settings that don't change what is generated.
NOT_REQUESTED = ("max_truncation_rate", "cache_compatible_prior_max_new_tokens")


def normalized_generation(results: DataFrame) -> DataFrame:
    """Results with what older ones lack: one attempt, no retry, its own tokens as the total, a batch of one, unknown end."""
    have = set(results.columns)
    col = lambda c, kind: F.col(c) if c in have else F.lit(None).cast(kind)
    return results.withColumns({
        "generation_attempts": F.coalesce(col("generation_attempts", "int"), F.lit(1)), "retry_count": F.coalesce(col("retry_count", "int"), F.lit(0)),
        "generated_completion_tokens_total": F.coalesce(col("generated_completion_tokens_total", "int"), F.col("completion_tokens")),
        "generation_batch_size": F.coalesce(col("generation_batch_size", "int"), F.lit(1)), "finished_eos": col("finished_eos", "boolean"),
    })


def fingerprint(variant: Column, backend: Column, settings: Mapping[str, Column], content_hash: Column, messages: Column) -> Column:
    """SHA-256 over the JSON, keys in order, of what determines a generation."""
    asked = F.struct(*(settings[k].alias(k) for k in sorted(settings) if k not in NOT_REQUESTED))
    return F.sha2(F.to_json(F.struct(backend.alias("backend"), content_hash.alias("content_hash"), asked.alias("generation"), messages.alias("messages"), variant.alias("variant")), {"ignoreNullFields": "false"}), 256)


def reusable(requests: DataFrame, cache: DataFrame, current: str, priors: Mapping[int, str], limit: int) -> DataFrame:
    """``requests`` with reuse: ``current``, ``prior``, ``retry`` or null, and the completion_tokens and prior_limit of what is reused.

    ``requests`` has content_hash, a column ``current`` with the fingerprint of the present settings, and for each earlier limit of
    ``priors`` a column with the fingerprint that it would have had. A generation under an earlier limit is reused where it
    stayed below that limit; at the present limit without a retry policy (a prior of ``limit``) it is done again.
    """
    options = F.array(F.struct(F.col(current).alias("fingerprint"), F.lit(None).cast("int").alias("prior_limit")), *(F.struct(F.col(c).alias("fingerprint"), F.lit(n).alias("prior_limit")) for n, c in priors.items()))
    wide = requests.select("content_hash", F.posexplode(options).alias("place", "o")).select("content_hash", "place", "o.*")
    hit = wide.join(cache.select("content_hash", "fingerprint", "completion_tokens"), ["content_hash", "fingerprint"])
    kind = (
        F.when(F.col("prior_limit").isNull(), "current").when(F.col("completion_tokens") < F.col("prior_limit"), "prior").when(F.col("prior_limit") == limit, "retry")
    )
    best = hit.withColumn("reuse", kind).where("reuse is not null").groupBy("content_hash").agg(F.min_by(F.struct("reuse", "completion_tokens", "prior_limit"), "place").alias("b"))
    return requests.join(best, "content_hash", "left").select(*requests.columns, "b.reuse", "b.completion_tokens", "b.prior_limit")


def to_retry(results: DataFrame) -> DataFrame:
    """The results that a selective retry generates again."""
    return results.where(F.coalesce("retry_count", F.lit(0)) > 0)


def merge_retries(results: DataFrame, generated: DataFrame, most_tokens: int, key: str = "content_hash") -> DataFrame:
    """``results`` in which those with a retry have what was ``generated`` (prediction, completion_tokens, finished_eos) for them.

    Others are copied. A retried result counts its first attempt's tokens (``most_tokens``) and its own, and is truncated where it reached the
    limit without an end. selective_retry_applied tells which is which; raises where a result to retry wasn't generated, or another was.
    """
    again = F.coalesce("retry_count", F.lit(0)) > 0
    wanted = to_retry(results).select(key)
    if not wanted.join(generated, key, "left_anti").isEmpty() or not generated.join(wanted, key, "left_anti").isEmpty():
        raise ValueError("the generated retries are not those of the results")
    new = generated.select(key, *(F.col(c).alias(f"_{c}") for c in ("prediction", "completion_tokens", "finished_eos")))
    both = results.join(new, key, "left")
    tokens = F.col("_completion_tokens")
    pick = lambda c, then: F.when(again, then).otherwise(F.col(c)).alias(c)
    done = {
        "prediction": F.col("_prediction"), "completion_tokens": tokens, "finished_eos": F.col("_finished_eos"), "retry_count": F.lit(1),
        "generated_completion_tokens_total": F.lit(most_tokens) + F.coalesce(tokens, F.lit(0)),
        "truncated": F.coalesce(tokens >= most_tokens, F.lit(False)) & ~F.coalesce("_finished_eos", F.lit(False)),
    }
    return both.select(*(pick(c, done[c]) if c in done else F.col(c) for c in results.columns), again.alias("selective_retry_applied"))


def combined(variants: Mapping[str, DataFrame | None]) -> DataFrame:
    """Results of several variants as one table with the column variant; variants that are missing are left out."""
    out = None
    for name, df in variants.items():
        if df is not None:
            one = df.withColumn("variant", F.lit(name))
            out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    if out is None:
        raise ValueError("there are no results")
    return out


def normal_path(c: Column) -> Column:
    """Slashes forward, none at the ends, lower case."""
    return F.lower(F.regexp_replace(F.replace(c, F.lit("\\"), F.lit("/")), r"^/+|/+$", ""))


def served_entries(manifest: DataFrame, served: str, path: str = "path") -> DataFrame:
    """The entries of a file manifest whose whole path ends the served model's path; exactly one proves what is served."""
    whole = F.concat(F.lit("/"), normal_path(F.lit(served)))
    return manifest.where(whole.endswith(F.concat(F.lit("/"), normal_path(F.col(path)))))


def served_entry(manifest: DataFrame, served: str) -> dict:
    if not served.strip():
        raise ValueError("the server did not name its model")
    found = served_entries(manifest, served).limit(2).collect()
    if len(found) != 1:
        raise ValueError(f"the served model is not in the manifest: {served}")
    return found[0].asDict()


def judged_hashes_problems(manifest: DataFrame, records: DataFrame, expected: int, key: str = "content_hash") -> DataFrame:
    """(issue, rows) of a judge manifest: another count than recorded, blank, repeated or unknown keys."""
    blank = F.col(key).isNull() | (F.col(key) == "")
    one = manifest.agg(F.abs(F.count("*") - expected).alias("other_count"), F.count_if(blank).alias("blank"))
    repeated = manifest.where(~blank).groupBy(key).agg(F.count("*").alias("n")).where("n > 1").agg(F.count("*").alias("repeated"))
    unknown = manifest.where(~blank).join(records, key, "left_anti").agg(F.count("*").alias("unknown"))
    names: Sequence[str] = ("other_count", "blank", "repeated", "unknown")
    row = one.crossJoin(repeated).crossJoin(unknown)
    return row.select(F.explode(F.array(*(F.struct(F.lit(n).alias("issue"), F.col(n).cast("bigint").alias("rows")) for n in names))).alias("p")).select("p.*").where("rows > 0")


def score_coverage(predictions: DataFrame, scores: DataFrame, categories: Sequence[str], key: str = "content_hash") -> DataFrame:
    """(key, issue) where saved syntax scores don't cover exactly the predictions of the categories, or aren't 0 or 1."""
    due = predictions.where(F.col("category").isin(list(categories)) & (F.col("error").isNull() | (F.col("error") == ""))).select(key)
    have = scores.select(key, "syntax_valid")
    out = due.join(have, key, "left_anti").select(key, F.lit("missing").alias("issue")).unionByName(have.join(due, key, "left_anti").select(key, F.lit("unexpected").alias("issue")))
    return out.unionByName(have.where(~F.coalesce(F.col("syntax_valid").isin(0.0, 1.0), F.lit(False))).select(key, F.lit("not_binary").alias("issue")))
