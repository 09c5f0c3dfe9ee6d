"""Reports, manifests and documents written on the driver, and tables that become visible by one rename of their manifest."""

from __future__ import annotations

import hashlib
import json
import os
import posixpath
import urllib.parse
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.shipping import ship
from sparkloom.sources import hadoop


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Writes beside the path and renames over it, in any file system that Spark knows: there is the old text or the new one, always."""
    fs, _ = hadoop.fs_of(spark, path)
    temp = f"{path}.{uuid.uuid4().hex}.part"
    out = fs.create(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(temp), False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    hadoop.replace(spark, temp, path)


def write_json(spark: SparkSession, path: str, value: Mapping[str, Any]) -> None:
    write_text(spark, path, json.dumps(value, ensure_ascii=False, indent=2, sort_keys=True) + "\n")


def read_report(spark: SparkSession, path: str) -> tuple[dict | None, str | None]:
    """(report, issue): a missing or broken report is an issue, not an error."""
    fs, p = hadoop.fs_of(spark, path)
    if not fs.exists(p):
        return None, "missing"
    try:
        value = json.loads("\n".join(r[0] for r in spark.read.text(path).collect()))
    except json.JSONDecodeError:
        return None, "corrupt"
    return (value, None) if isinstance(value, dict) else (None, "corrupt")


def config_hash(config: Mapping[str, Any]) -> str:
    """SHA-256 of a configuration as JSON with sorted keys."""
    return hashlib.sha256(json.dumps(config, ensure_ascii=False, sort_keys=True, separators=(",", ":"), default=str).encode()).hexdigest()


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The table that ``path``'s manifest points to; a plain Parquet path without a manifest as it is."""
    known, _ = read_report(spark, f"{path}.manifest.json")
    return spark.read.parquet((known or {}).get("data", path))


def write_table(df: DataFrame, path: str, manifest: Mapping[str, Any], force: bool = False, quarantined: DataFrame | None = None, revision: str | None = None, config: Mapping[str, Any] | None = None) -> dict:
    """A Parquet table and its manifest; done before, and not forced, it is left as it is.

    The manifest has records, an order-free fingerprint of the rows, name, bytes and SHA-256 of every file, the rows set aside, the
    source's revision, the configuration's hash, and where the rows are: ``path`` at first, a folder of their own below
    ``<path>.versions`` for what comes later. It is the pointer by which ``read_table`` goes and is renamed into place last, so whatever
    stops a write, there is the former table with its manifest or the new one with its own. The former rows go after that.
    """
    spark = df.sparkSession
    pointer = f"{path}.manifest.json"
    known, _ = read_report(spark, pointer)
    before = (known or {}).get("data", path)
    if known is not None and not force and hadoop.exists(spark, before):
        return known | {"skipped": True}
    data = f"{path}.versions/{uuid.uuid4().hex}" if hadoop.exists(spark, path) or known is not None else path
    df.write.mode("error").option("compression", "zstd").parquet(data)
    aside = 0
    if quarantined is not None:
        quarantined.write.mode("error").option("compression", "zstd").parquet(f"{data}.quarantine")
        aside = spark.read.parquet(f"{data}.quarantine").count()
    # Order-free fingerprint: a sum of row hashes, so that it distributes.
    row = F.xxhash64(*[F.to_json(F.struct(c)) for c in sorted(df.columns)])
    stats = spark.read.parquet(data).agg(F.count("*").alias("n"), F.sum(row.cast("decimal(38,0)")).cast("string").alias("h")).first()
    files = [{"name": f.rsplit("/", 1)[1], "bytes": hadoop.size_of(spark, f), "sha256": hadoop.sha256_of(spark, f)} for f in hadoop.files_below(spark, data)]
    value = dict(manifest) | {"records": stats["n"], "fingerprint": stats["h"] or "0", "quarantined": aside, "files": files, "data": data}
    value |= ({"revision": revision} if revision else {}) | ({"config_hash": config_hash(config)} if config is not None else {})
    write_json(spark, pointer, value)
    if before != data:
        hadoop.delete(spark, before)
        hadoop.delete(spark, f"{before}.quarantine")
    return value | {"skipped": False}


def cached_vectors(spark: SparkSession, path: str, texts: DataFrame, encode: Callable[[DataFrame], DataFrame], key: str = "content_hash") -> DataFrame:
    """(key, embedding) of ``texts`` (key, text) from the cache at ``path``, what it lacks encoded and added to it first."""
    wanted = texts.dropDuplicates([key])
    if hadoop.exists(spark, path):
        wanted = wanted.join(spark.read.parquet(path).select(key), key, "left_anti")
    encode(wanted).select(key, "embedding").write.mode("append").option("compression", "zstd").parquet(path)
    return spark.read.parquet(path).join(texts.select(key).distinct(), key, "left_semi")


def recreate(spark: SparkSession, path: str, root: str) -> None:
    """An empty folder at ``path``, which must lie strictly inside ``root``."""
    fs, p = hadoop.fs_of(spark, path)
    _, r = hadoop.fs_of(spark, root)
    inner, outer = (urllib.parse.urlsplit(fs.makeQualified(x).toString()) for x in (p, r))
    at, above = (posixpath.normpath(x.path) for x in (inner, outer))
    if (inner.scheme, inner.netloc) != (outer.scheme, outer.netloc) or not at.startswith(above.rstrip("/") + "/"):
        raise ValueError(f"{path} does not lie inside {root}")
    fs.delete(p, True)
    fs.mkdirs(p)


def write_candidates(candidates: DataFrame, path: str, root: str) -> int:
    """The contents of candidates (name, content) as files of a fresh folder; returns how many.

    Tasks write them, each file beside its name and renamed, so a task that is tried again leaves no half file. The folder must be on a file
    system that all machines mount, as the tool that reads the files needs it too.
    """
    spark = candidates.sparkSession
    recreate(spark, path, root)
    folder = urllib.parse.urlsplit(hadoop.fs_of(spark, path)[0].makeQualified(hadoop.fs_of(spark, path)[1]).toString())
    if folder.scheme != "file":
        raise ValueError(f"{path} is not on a mounted file system")
    where = urllib.parse.unquote(folder.path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("name").to_pylist(), batch.column("content").to_pylist(), strict=True):
                target = os.path.normpath(os.path.join(where, name))
                if not target.startswith(where.rstrip("/") + "/"):
                    raise ValueError(f"{name} leads out of the folder")
                temp = f"{target}.{uuid.uuid4().hex}.part"
                with open(temp, "w", encoding="utf-8", newline="") as f:
                    f.write(content)
                os.replace(temp, target)
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    ship(spark)
    rows = candidates.where("content is not null").select("name", "content")
    return rows.mapInArrow(run, "n bigint").agg(F.sum("n")).first()[0] or 0


def licenses_section(records: DataFrame, urls: Mapping[str, str]) -> str:
    """Markdown table of licences with their page (``n/a`` where unknown) and how many records have them."""
    rows = records.groupBy("license").agg(F.count("*").alias("n")).orderBy("license").collect()
    return "\n".join(["## Licences", "", "| licence | page | records |", "|-|-|-|", *(f"| {r['license']} | {urls.get(r['license'], 'n/a')} | {r['n']} |" for r in rows)]) + "\n"


def datasheet(statistics: DataFrame, title: str) -> str:
    """Markdown over ``split.statistics``: totals, then counts by category and source (a bounded number of groups)."""
    rows = statistics.orderBy("split", "category", "source").collect()
    out = [f"# {title}", "", "| split | records |", "|-|-|"]
    out += [f"| {r['split']} | {r['n']} |" for r in rows if r["category"] is None and r["source"] is None]
    for name in ("category", "source"):
        out += ["", f"| split | {name} | records |", "|-|-|-|"]
        out += [f"| {r['split']} | {r[name]} | {r['n']} |" for r in rows if r[name] is not None]
    return "\n".join(out) + "\n"


def change_text(before: float | None, after: float | None, points: bool = False) -> str:
    """The change of a mean: relative, or in percentage points; ``n/a`` where it can't be said."""
    if before is None or after is None or (not points and before == 0):
        return "n/a"
    return f"{(after - before) * 100:+.2f} pp" if points else f"{(after - before) / before:+.2%}"


def interval_text(mean: float | None, low: float | None, high: float | None) -> str:
    return "n/a" if mean is None else f"{mean:.4f}" if low is None or high is None else f"{mean:.4f} [{low:.4f}, {high:.4f}]"


def gate_text(rate: float | None, most: float) -> str:
    """PASS or FAIL of the truncation gate, with both rates."""
    return "n/a" if rate is None else f"{'PASS' if rate <= most else 'FAIL'} ({rate:.2%} of at most {most:.2%})"


def runtime_text(runtime: Mapping[str, Any] | None) -> str:
    """A run's backend, device and versions in one line."""
    if not runtime:
        return "unknown"
    versions = ", ".join(f"{k} {v}" for k, v in sorted((runtime.get("versions") or {}).items()))
    return " / ".join(str(x) for x in (runtime.get("backend"), runtime.get("device"), versions) if x) or "unknown"


#: Metrics of which less is better, and those that are shares.
LESS_IS_BETTER = ("truncation_rate", "retry_rate", "generation_attempts", "generated_completion_tokens_total", "latency_seconds")
SHARES = ("exact_match", "syntax_validity", "truncation_rate", "retry_rate")


def comparison(metrics: DataFrame, left: str, right: str, gates: Mapping[str, tuple[float | None, float]] | None = None, runtimes: Mapping[str, Mapping[str, Any]] | None = None) -> str:
    """Markdown report on two variants: means with intervals overall and by category, changes, regressions, gates and runtimes.

    ``metrics`` has variant, metric, category (null overall), mean, ci95_low and ci95_high.
    """
    by: dict[tuple[str, str], dict[str, Any]] = {}
    columns = [c for c in ("category", "ci95_low", "ci95_high") if c in metrics.columns]
    for r in metrics.select("variant", "metric", "mean", *columns).collect():
        row = r.asDict()
        by.setdefault((row.get("category") or "", row["metric"]), {})[row["variant"]] = row
    out = []
    for category in sorted({c for c, _ in by}):
        out += [f"## {category or 'Overall'}", "", f"| metric | {left} | {right} | change | regression |", "|-|-|-|-|-|"]
        for (c, name), v in sorted(by.items()):
            if c != category:
                continue
            a, b = v.get(left) or {}, v.get(right) or {}
            x, y = a.get("mean"), b.get("mean")
            worse = x is not None and y is not None and (y > x if name in LESS_IS_BETTER else y < x)
            text = lambda r: interval_text(r.get("mean"), r.get("ci95_low"), r.get("ci95_high"))
            out.append(f"| {name} | {text(a)} | {text(b)} | {change_text(x, y, name in SHARES)} | {'yes' if worse else 'no'} |")
        out.append("")
    for name, (rate, most) in sorted((gates or {}).items()):
        out.append(f"- truncation gate of {name}: {gate_text(rate, most)}")
    for name, runtime in sorted((runtimes or {}).items()):
        out.append(f"- runtime of {name}: {runtime_text(runtime)}")
    return "\n".join(out) + "\n"


def loss_chart(steps: Sequence[tuple[float, float]], width: int = 640, height: int = 240) -> str:
    """An SVG polyline of (step, loss)."""
    if not steps:
        return f'<svg xmlns="http://www.w3.org/2000/svg" width="{width}" height="{height}"/>'
    xs, ys = zip(*steps, strict=True)
    spread = lambda v: (max(v) - min(v)) or 1
    points = " ".join(f"{20 + (x - min(xs)) / spread(xs) * (width - 40):.1f},{height - 20 - (y - min(ys)) / spread(ys) * (height - 40):.1f}" for x, y in steps)
    return f'<svg xmlns="http://www.w3.org/2000/svg" width="{width}" height="{height}"><polyline fill="none" stroke="currentColor" points="{points}"/></svg>'
