"""Boundaries to models and tools: each takes a client that its task makes for itself, so that none is pickled or shared.

The engine fixes what goes in and out, the batches, the retries and the resumption; what answers is injected.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.operators.ranks import before
from sparkloom.operators.relational import set_difference
from sparkloom.scratch import Staged
from sparkloom.shipping import ship
from sparkloom.sources import hadoop, sinks


def in_order(function: Callable[[Any], Any], values: Iterator[Any], most: int) -> Iterator[Any]:
    """function(value) for each value, in the order of the values, with ``most`` calls at a time at most. What a call raises is raised in its turn."""
    if most <= 1:
        yield from map(function, values)
        return
    with ThreadPoolExecutor(most) as pool:
        flying: deque = deque()
        for value in values:
            if len(flying) == most:
                yield flying.popleft().result()
            flying.append(pool.submit(function, value))
        while flying:
            yield flying.popleft().result()


def in_slices(requests: DataFrame, path: str, answer: Callable[[DataFrame], DataFrame], identity: dict, size: int = 1000, key: str = "content_hash") -> DataFrame:
    """``answer(requests)``, made and saved slice by slice in the folder ``path``; what is there already isn't asked again.

    Requests (unique by ``key``) are dealt to slices of about ``size`` in the order of their key's hash, so a run that stops loses one slice at most. A
    slice counts once Spark has committed it. ``identity`` (settings, model, revision) and the requests must be those of the run
    that began the folder, and each slice must hold answers to its own requests; else it raises.
    """
    spark = requests.sparkSession
    keyed = requests.withColumn("_hash", F.sha2(F.col(key).cast("string"), 256))
    placed = Staged(before(keyed, [], "_hash", key, name="_place").withColumn("_slice", F.floor(F.col("_place") / size).cast("int")).drop("_hash", "_place"), "requests").df
    whole = placed.agg(F.count("*").alias("n"), F.sum(F.xxhash64(key).cast("decimal(38,0)")).cast("string").alias("h")).first()
    mine = {"identity": identity, "size": size, "requests": whole["n"], "fingerprint": whole["h"]}
    known, issue = sinks.read_report(spark, f"{path}/run.json")
    if known is None:
        if issue == "corrupt":
            raise ValueError(f"{path} has a broken description")
        hadoop.fs_of(spark, path)[0].mkdirs(hadoop.fs_of(spark, path)[1])
        sinks.write_json(spark, f"{path}/run.json", mine)
    elif known != json.loads(json.dumps(mine)):
        raise ValueError(f"{path} was begun with other settings or requests")
    out = []
    for k in range(-(-whole["n"] // size)):
        at, asked = f"{path}/slice-{k:06d}", placed.where(F.col("_slice") == k).drop("_slice")
        if not hadoop.exists(spark, f"{at}/_SUCCESS"):
            answer(asked).write.mode("overwrite").parquet(at)
        saved = spark.read.parquet(at)
        if not set_difference(saved, asked, key).isEmpty():
            raise ValueError(f"{at} does not answer its requests")
        out.append(at)
    return spark.read.parquet(*out) if out else answer(placed.drop("_slice"))


def in_batches(df: DataFrame, columns: Sequence[str], make: Callable[[], Callable[[list[dict]], list[dict]]], schema: str, size: int) -> DataFrame:
    """``make()`` gives a function from up to ``size`` rows (dicts of ``columns``) to as many results; results have ``schema``."""
    ship(df.sparkSession)
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    out = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call, held = make(), []

        def flush() -> pa.RecordBatch:
            got = call(held)
            if len(got) != len(held):
                raise ValueError(f"the client gave {len(got)} results for {len(held)} rows")
            return pa.RecordBatch.from_pylist(got, schema=out)

        for batch in batches:
            for row in batch.to_pylist():
                held.append(row)
                if len(held) == size:
                    yield flush()
                    held = []
        if held:
            yield flush()

    return df.select(*columns).mapInArrow(run, schema)


def encode(texts: DataFrame, make: Callable[[], Callable[[list[str]], list[list[float]]]], ident: str = "content_hash", text: str = "text", size: int = 64) -> DataFrame:
    """(id, embedding) by a sentence encoder, in batches, each vector brought to length 1."""

    def client() -> Callable[[list[dict]], list[dict]]:
        model = make()

        def call(rows: list[dict]) -> list[dict]:
            import numpy as np

            v = np.asarray(model([r[text] or "" for r in rows]), np.float64)
            v = v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
            return [{ident: r[ident], "embedding": x.tolist()} for r, x in zip(rows, v, strict=True)]

        return call

    return in_batches(texts, [ident, text], client, f"{ident} {texts.schema[ident].dataType.simpleString()}, embedding array<double>", size)


def check_files(candidates: DataFrame, make: Callable[[], Callable[[list[tuple[str, str]]], tuple[int, str]]], read: Callable[[str], list[tuple[str, str]]], size: int = 200) -> DataFrame:
    """(name, failure) of candidates (name, content) by a command line validator, ``size`` files a call.

    The validator gets (name, content) and returns its exit code and output. Codes 0 and 1 are results (0: none fails); any
    other is the tool's own failure and fails the task. ``read`` turns an output into (name, failure); names it was
    not given are an error.
    """

    def client() -> Callable[[list[dict]], list[dict]]:
        tool = make()

        def call(rows: list[dict]) -> list[dict]:
            code, output = tool([(r["name"], r["content"]) for r in rows])
            if code not in (0, 1):
                raise RuntimeError(f"the validator ended with {code}: {output[:300]}")
            failed = dict(read(output)) if code else {}
            if extra := sorted({*failed} - {r["name"] for r in rows}):
                raise ValueError(f"the validator named other files: {', '.join(extra[:5])}")
            return [{"name": r["name"], "failure": failed.get(r["name"])} for r in rows]

        return call

    return in_batches(candidates, ["name", "content"], client, "name string, failure string", size)


_GENERATED = "content_hash string, prediction string, prompt_tokens int, completion_tokens int, latency_seconds double, finished_eos boolean, generation_attempts int, retry_count int, generated_completion_tokens_total int, generation_batch_size int, truncated boolean, error string"


def generate(requests: DataFrame, make: Callable[[], Callable[[list[Any], dict], list[dict]]], settings: dict, retry_penalty: float | None = None, size: int = 4) -> DataFrame:
    """Generations of requests (content_hash, messages) in batches; what is truncated is tried once more with a penalty.

    The backend takes messages and settings and returns prediction, prompt_tokens, completion_tokens, latency_seconds and finished_eos.
    Latency and tokens of both attempts add up. A batch that fails gives rows with an error, and the next goes on.
    """
    most = int(settings["max_new_tokens"])

    def client() -> Callable[[list[dict]], list[dict]]:
        backend = make()
        cut = lambda g: g["completion_tokens"] is not None and g["completion_tokens"] >= most and g.get("finished_eos") is not True

        def call(rows: list[dict]) -> list[dict]:
            try:
                got = backend([r["messages"] for r in rows], settings)
            except Exception as e:  # noqa: BLE001 a failed batch is a result of its own
                return [{"content_hash": r["content_hash"], "error": f"{type(e).__name__}: {e}"[:500]} for r in rows]
            out = []
            for r, first in zip(rows, got, strict=True):
                g, seconds, tokens, tries = first, first["latency_seconds"], first["completion_tokens"] or 0, 1
                if cut(first) and retry_penalty is not None:
                    g = backend([r["messages"]], settings | {"repetition_penalty": retry_penalty})[0]
                    seconds, tokens, tries = seconds + g["latency_seconds"], tokens + (g["completion_tokens"] or 0), 2
                out.append({
                    "content_hash": r["content_hash"], "prediction": g["prediction"], "prompt_tokens": g["prompt_tokens"], "completion_tokens": g["completion_tokens"], "latency_seconds": seconds,
                    "finished_eos": g.get("finished_eos"), "generation_attempts": tries, "retry_count": tries - 1, "generated_completion_tokens_total": tokens, "generation_batch_size": len(rows), "truncated": cut(g),
                })
            return out

        return call

    return in_batches(requests, ["content_hash", "messages"], client, _GENERATED, size)


def judge(requests: DataFrame, known: DataFrame | None, make: Callable[[], Callable[[dict], str]], runtime: str, served: Callable[[Any], Sequence[str]] | None = None, wanted: str | None = None) -> DataFrame:
    """(content_hash, runtime, payload) of a judge for (content_hash, question, reference, candidate).

    What ``known`` has from the same runtime is kept; scores of another runtime are judged again. With ``served`` (client -> names of the models
    that its server has) a task raises before its first question where ``wanted`` isn't among them.
    """

    def client() -> Callable[[list[dict]], list[dict]]:
        model = make()
        if served is not None and wanted not in (names := list(served(model))):
            raise ValueError(f"the judge's server has {', '.join(sorted(names)) or 'no model'}, not {wanted}")
        return lambda rows: [{"content_hash": r["content_hash"], "runtime": runtime, "payload": model(r)} for r in rows]

    columns = ["content_hash", "question", "reference", "candidate"]
    schema = "content_hash string, runtime string, payload string"
    if known is None:
        return in_batches(requests, columns, client, schema, 16)
    valid = known.where(F.col("runtime") == runtime).select("content_hash", "runtime", "payload").join(requests.select("content_hash"), "content_hash", "left_semi")
    return valid.unionByName(in_batches(requests.join(valid, "content_hash", "left_anti"), columns, client, schema, 16))
