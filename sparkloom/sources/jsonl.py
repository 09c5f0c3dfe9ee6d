"""JSON lines with their order: read with ordinals and strict errors, written with digests of the bytes."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkloom.scratch import Staged
from sparkloom.sources import hadoop


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file_name, ordinal, value): every line of the files of a path with its place in its file, from 0.

    A place is the number of lines in the file's earlier blocks and the place in its own block: one pass that counts
    lines by block, then a sum over blocks. No record goes through Python.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file_name"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_id"))
    blocks = Staged(lines.groupBy("file_name", "_block").agg(F.count("*").alias("_n"), F.min("_id").alias("_first")), "blocks").df
    before = F.coalesce(F.sum("_n").over(Window.partitionBy("file_name").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = blocks.select("file_name", "_block", "_first", before.alias("_before"))
    return lines.join(starts, ["file_name", "_block"]).select("file_name", (F.col("_before") + F.col("_id") - F.col("_first")).alias("ordinal"), "value")


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str, rank: int = 0) -> DataFrame:
    """The records of a file with input_rank and ordinal (the place among all lines); blank lines are skipped.

    A line that isn't a JSON object fails the read when it is reached, with its place.
    """
    schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    lines = numbered_lines(spark, path).select("ordinal", "value")
    return _parse(lines.where(F.trim("value") != ""), schema, F.lit(path)).withColumn("input_rank", F.lit(rank))


def _parse(lines: DataFrame, schema: T.StructType, path: Column, *more: str) -> DataFrame:
    kind = F.schema_of_variant(F.try_parse_json("value"))
    ok = F.coalesce(kind.startswith("OBJECT"), F.lit(False))
    checked = F.when(ok, F.col("value")).otherwise(F.raise_error(F.concat(path, F.lit(":"), (F.col("ordinal") + 1).cast("string"), F.lit(": not a JSON object"))))
    return lines.select("ordinal", *more, F.from_json(checked, schema).alias("r")).select("r.*", "ordinal", *more)


def read_many(spark: SparkSession, paths: list[str], schema: T.StructType | str, allow_missing: bool = True) -> tuple[DataFrame, list[str]]:
    """All files in the order given, and those that aren't there; raises if none is, or one isn't and that is not allowed."""
    missing = [p for p in paths if not hadoop.exists(spark, p)]
    there = [p for p in paths if p not in missing]
    if not there or (missing and not allow_missing):
        raise FileNotFoundError(", ".join(missing or paths))
    out = None
    for p in there:
        df = read_jsonl(spark, p, schema, paths.index(p))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out, missing


def read_glob(spark: SparkSession, pattern: str, schema: T.StructType | str) -> DataFrame:
    """Files of a pattern by name, each record with file_name, input_rank (the file's place by name) and ordinal.

    Lines that aren't objects fail the read; a pattern without files is an error.
    """
    schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    lines = numbered_lines(spark, pattern)
    df = _parse(lines.where(F.trim("value") != ""), schema, F.col("file_name"), "file_name")
    names = lines.select("file_name").distinct()
    ranked = names.withColumn("input_rank", F.row_number().over(Window.orderBy("file_name")) - 1)
    return df.join(F.broadcast(ranked), "file_name")


def stable_json(columns: list[Column]) -> Column:
    """A struct as JSON without blanks; give the columns in order of their names."""
    return F.to_json(F.struct(*columns))


@F.pandas_udf(T.StringType())
def spaced(s: pd.Series) -> pd.Series:
    """JSON with a blank after commas and colons, keys in order, as files have it."""
    return s.map(lambda x: None if x is None else json.dumps(json.loads(x), ensure_ascii=False, sort_keys=True))


def write_jsonl(df: DataFrame, path: str, order: list[str], single: bool = False) -> dict:
    """Writes all columns of the records, in order, keys sorted; returns count, bytes and SHA-256 of the bytes written.

    Files are ranges of the order, named in order, so the records of all files one after the other are the
    records in order; sha256 is that of the files' bytes one after the other, parts has each file's own. The digest
    is taken by the JVM from the files, in pieces. ``single`` writes one file. The folder is written beside and renamed, so no reader
    sees a part of it; where there was one before, that is renamed out of the way first, and ``recovered`` puts it back if
    the writer stops between the two renames.
    """
    spark = df.sparkSession
    lines = df.select(*order, spaced(F.to_json(F.struct(*sorted(df.columns)))).alias("value"))
    dealt = lines.orderBy(*order).coalesce(1) if single else lines.repartitionByRange(*order).sortWithinPartitions(*order)
    recovered(spark, path)
    new, old = f"{path}.new", f"{path}.old"
    dealt.select("value").write.mode("overwrite").text(new)
    if hadoop.exists(spark, path):
        hadoop.rename(spark, path, old)
    hadoop.rename(spark, new, path)
    hadoop.delete(spark, old)
    parts = hadoop.files_below(spark, path)
    each = [{"name": p.rsplit("/", 1)[1], "bytes": hadoop.size_of(spark, p), "sha256": hadoop.sha256_of(spark, p)} for p in parts]
    return {"records": spark.read.text(path).count(), "bytes": sum(p["bytes"] for p in each), "sha256": hadoop.sha256_of_all(spark, parts), "parts": each}


def recovered(spark: SparkSession, path: str) -> str:
    """``path``, with what a writer that was stopped left put right: the former folder comes back, or goes if the new one is there."""
    if hadoop.exists(spark, f"{path}.old"):
        if hadoop.exists(spark, path):
            hadoop.delete(spark, f"{path}.old")
        else:
            hadoop.rename(spark, f"{path}.old", path)
    return path


def derive(spark: SparkSession, parent: str, excluded: DataFrame, path: str, key: str = "$.meta.content_hash") -> dict:
    """Writes the lines of ``parent`` whose key isn't in ``excluded`` (key), byte for byte and in order; returns counts and digests.

    Blank lines go. Each excluded key must be in the parent.
    """
    lines = numbered_lines(spark, parent).where(F.trim("value") != "").withColumn("key", F.get_json_object("value", key))
    keys = excluded.select("key").distinct()
    if not keys.join(lines, "key", "left_anti").isEmpty():
        raise ValueError("an excluded key is not in the parent")
    kept = lines.join(keys, "key", "left_anti")
    kept.repartitionByRange("file_name", "ordinal").sortWithinPartitions("file_name", "ordinal").select("value").write.mode("overwrite").text(path)
    parts = hadoop.files_below(spark, path)
    parents = hadoop.files_below(spark, parent)
    n, m = lines.count(), spark.read.text(path).count()
    return {
        "parent": {"records": n, "bytes": sum(hadoop.size_of(spark, p) for p in parents), "sha256": hadoop.sha256_of_all(spark, parents)},
        "excluded": {"records": n - m, "unique_hashes": keys.count()},
        "output": {"records": m, "bytes": sum(hadoop.size_of(spark, p) for p in parts), "sha256": hadoop.sha256_of_all(spark, parts)},
    }


def proves_derivation(spark: SparkSession, manifest: dict, parent: str, excluded: DataFrame, output: str, again: str) -> list[str]:
    """What is wrong with a derived file: other identities than the manifest's, or other bytes than a rebuild in ``again`` has."""
    issues = []
    for name, path in (("parent", parent), ("output", output)):
        if hadoop.sha256_of_all(spark, hadoop.files_below(spark, path)) != manifest[name]["sha256"]:
            issues.append(f"{name}_changed")
    if excluded.select("key").distinct().count() != manifest["excluded"]["unique_hashes"]:
        issues.append("excluded_changed")
    if not issues and derive(spark, parent, excluded, again)["output"]["sha256"] != manifest["output"]["sha256"]:
        issues.append("rebuild_differs")
    return issues
