"""Upstream rows to interim records, interim records to chat records or generation candidates."""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.functions.text import first_allowed, first_present, py_strip, spdx
from sparkloom.operators import models
from sparkloom.shipping import ship


def direct_pair(df: DataFrame, user: Sequence[str], assistant: Sequence[str], title: str | None = None) -> tuple[Column, Column]:
    """(user, assistant) from candidate columns; a title goes before a body that it isn't part of already."""
    here = lambda names: [F.col(c) for c in names if c in df.columns]
    u, a = first_present(*here(user)), first_present(*here(assistant))
    if title and title in df.columns:
        t = py_strip(F.col(title))
        u = F.when(blank(t) | (F.instr(t, py_strip(u)) > 0), F.coalesce(F.when(~blank(t), t), u)).when(blank(u), t).otherwise(F.concat_ws("\n\n", t, py_strip(u)))
    return u, a


def blank(c: Column) -> Column:
    return c.isNull() | (py_strip(c) == "")


def row_url(base: str, *candidates: Column) -> Column:
    """The first link that a row has, else the dataset's page with the row's place."""
    return F.coalesce(first_present(*candidates), F.concat(F.lit(f"{base}?row="), F.col("dataset_row").cast("string")))


def records(df: DataFrame, pair: tuple[Column, Column] | None, fields: Sequence[str] = (), most: int = 50_000) -> DataFrame:
    """``df`` with raw_content (and pair): the exchange, one field, or several fields as JSON with sorted keys.

    Rows whose content is empty or longer than ``most`` are left out.
    """
    if pair is not None:
        u, a = (py_strip(c) for c in pair)
        text = F.when(~blank(u) & ~blank(a), F.concat(F.lit("USER:\n"), u, F.lit("\n\nASSISTANT:\n"), a))
        df = df.withColumn("pair", F.struct(u.alias("user"), a.alias("assistant")))
    elif len(fields) == 1:
        text = py_strip(F.col(fields[0]))
    else:
        text = F.to_json(F.struct(*sorted(fields)))
    return df.withColumn("raw_content", text).where((F.col("raw_content") != "") & (F.length("raw_content") <= most))


def by_license(df: DataFrame, columns: Sequence[Column], aliases: Mapping[str, str], allowed: Sequence[str]) -> DataFrame:
    """``df`` with license (null where none is allowed) and reject_reason."""
    ids = F.flatten(F.array(*(spdx(c, aliases) for c in columns)))
    return df.withColumn("license", first_allowed(ids, allowed)).withColumn("reject_reason", F.when(F.col("license").isNull(), "license_not_allowed"))


def by_labels(df: DataFrame, exclude: str | None, require: str | None, labels: str = "labels") -> DataFrame:
    """Rows none of whose labels matches ``exclude`` and one of whose labels matches ``require``."""
    if exclude:
        df = df.where(~F.exists(labels, lambda x: x.rlike(f"(?i){exclude}")))
    return df.where(F.exists(labels, lambda x: x.rlike(f"(?i){require}"))) if require else df


def select_sources(known: Mapping[str, Mapping], asked: Sequence[str] | None, quarantined: bool = False) -> list[str]:
    """Source ids in order: those asked for, else the enabled ones; unknown ids are an error."""
    if asked:
        if missing := sorted({*asked} - {*known}):
            raise ValueError(f"unknown sources: {', '.join(missing)}")
        return list(dict.fromkeys(asked))
    return [k for k, v in known.items() if v.get("enabled", True) and (quarantined or v.get("tier") != "quarantine")]


_META = ("source", "category", "license", "url", "attribution", "license_url", "source_record_id", "source_revision", "language", "normalization", "generator_model")


def chat(df: DataFrame, user: Column, assistant: Column, system: Column, default_system: str) -> DataFrame:
    """messages and meta of interim rows; meta holds whichever of the known columns ``df`` has."""
    turn = lambda role, c: F.struct(F.lit(role).alias("role"), py_strip(c).alias("content"))
    meta = F.struct(*(F.col(c) for c in _META if c in df.columns))
    messages = F.array(turn("system", F.coalesce(F.when(~blank(system), system), F.lit(default_system))), turn("user", user), turn("assistant", assistant))
    return df.where(~blank(user) & ~blank(assistant)).select(messages.alias("messages"), meta.alias("meta"))


def by_mode(df: DataFrame, mode: str, column: str = "normalization") -> tuple[DataFrame, DataFrame]:
    """(rows of a normalization mode, one row with how many are skipped)."""
    return df.where(F.col(column) == mode), df.agg(F.count_if(~F.col(column).eqNullSafe(F.lit(mode))).alias("skipped"))


def candidates(df: DataFrame) -> DataFrame:
    """Generation candidates with the fingerprint under which their result is cached."""
    out = df.where("normalization = 'reverse_instruction'")
    return out.withColumn("fingerprint", F.sha2(F.to_json(F.struct("category", "raw_content", "source", "source_record_id")), 256))


def with_generated(candidates_: DataFrame, cache: DataFrame) -> DataFrame:
    """Candidates with user and reject_reason of their cached generation; a stale fingerprint is a miss."""
    return candidates_.join(cache.select("source_record_id", "fingerprint", "user", "reject_reason"), ["source_record_id", "fingerprint"], "left").withColumn(
        "state", F.when(F.col("user").isNotNull(), "generated").when(F.col("reject_reason").isNotNull(), "rejected").otherwise("missing")
    )


def generate(df: DataFrame, make_client, attempts: int = 3, in_flight: int = 1) -> DataFrame:
    """(source_record_id, user, reject_reason, error) of candidates, through a client that each task makes for itself, in the order of the candidates.

    ``client(text, attempt)`` returns (user, reason); with ``in_flight`` over 1 as many calls are made at a time, from threads. A reason is a
    quality reject, an exception a transport error; both are tried again, and what stays is told apart: the candidate has a reject_reason or
    an error, and the others' answers are kept.
    """
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        client = make_client()

        def ask(candidate: tuple) -> tuple:
            reason = error = None
            for k in range(attempts):
                try:
                    user, reason = client(candidate[1], k)
                    error = None
                except Exception as e:  # noqa: BLE001 whatever the transport raises
                    reason, error = None, f"{type(e).__name__}: {e}"[:500]
                    continue
                if reason is None:
                    return candidate[0], user, None, None
            return candidate[0], None, reason, error

        def all_of() -> Iterator[tuple]:
            for batch in batches:
                kinds.append(batch.column("source_record_id").type)
                yield from zip(batch.column("source_record_id").to_pylist(), batch.column("raw_content").to_pylist(), strict=True)

        kinds: list[pa.DataType] = []
        answers = models.in_order(ask, all_of(), in_flight)
        while some := list(itertools.islice(answers, 64)):
            columns = zip(*some, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (kinds[0], pa.string(), pa.string(), pa.string()), strict=True)], ["source_record_id", "user", "reject_reason", "error"])

    kind = df.schema["source_record_id"].dataType.simpleString()
    return df.select("source_record_id", "raw_content").mapInArrow(run, f"source_record_id {kind}, user string, reject_reason string, error string")
