"""Secret scans with an incremental blob ledger, in DataFrame functions only.

Every version of every text is a blob, addressed by its SHA-256. A ledger on the shared file system says which
rules, in which version, have read which blob, and what they found. An update scans only pairs of blob and
rule version that the ledger lacks; findings are joined back to every path whose content is the blob.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkloom.llm.shared import scratch_dir, stage
from sparkloom.operators.skew import salted
from sparkloom.sources.hadoop import fs_of

#: So many blobs at most are broadcast (64 bytes and the rules' names each) to pick the texts of unseen ones.
MOST_BROADCAST = 50_000


class Rule(NamedTuple):
    """Leftmost matches of ``pattern`` that don't overlap count where ``group`` has ``least`` characters at least."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(map(_either_case, ("password", "passwd", "secret", "token", "api_?key")))
#: The base kinds. Letters of both cases are spelled out: a flag would fold letters beyond ASCII in some engines.
#: Of ``AKIA[A-Z0-9]+`` and ``[0-9a-f]+`` matches are whole runs, so the least length can stand in the pattern.
BASE = (
    Rule("assign", 1, rf"({_NAMES})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 8),
    Rule("access", 1, "AKIA[A-Z0-9]{12,}"),
    Rule("hex", 1, "[0-9a-f]{32,}"),
)
#: Further kinds that a provider's prefix or an envelope tells.
PROVIDERS = (
    Rule("private_key", 1, "-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("github", 1, "(gh[pousr]_[A-Za-z0-9]{20,255}|github_pat_[A-Za-z0-9_]{20,255})"),
    Rule("jwt", 1, "eyJ[A-Za-z0-9_-]{8,}[.][A-Za-z0-9_-]{8,}[.][A-Za-z0-9_-]{8,}"),
    Rule("slack", 1, "xox[abprs]-[A-Za-z0-9-]{10,}"),
)
RULES = BASE + PROVIDERS


def blob_of(text: Column) -> Column:
    """The address of a text: SHA-256 of its bytes, null being empty."""
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def _hits(text: Column, rule: Rule) -> Column:
    """Lengths of what stands before each match, of the matches and of the group that is measured; null without a match."""
    sizes = lambda group: F.transform(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(group)), lambda m: F.length(m))
    gaps = F.transform(F.split(text, rule.pattern, -1), lambda part: F.length(part))
    return F.struct(F.lit(rule.name).alias("rule"), gaps.alias("gaps"), sizes(0).alias("sizes"), sizes(rule.group).alias("measured"))


def scan(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> tuple[DataFrame, DataFrame]:
    """(blob, todo) and (blob, rule, spans) of a table (blob, text, todo), todo being names of the rules to apply.

    One pass over the texts notes lengths only; places are running sums of them, made by rows, so that a text with very many
    matches costs no more than its length. spans has (start, stop) in code points, in order; pairs without a match have no row.
    """
    text = F.col("text")
    tried = [F.when(F.array_contains("todo", r.name) & text.rlike(r.pattern), _hits(text, r)) for r in rules]
    noted = stage(blobs.select("blob", "todo", F.array_compact(F.array(*tried)).alias("hits")), "hits")
    each = noted.select("blob", F.explode("hits").alias("h")).select("blob", "h.rule", F.posexplode(F.arrays_zip("h.gaps", "h.sizes", "h.measured")).alias("i", "z"))
    so_far = Window.partitionBy("blob", "rule").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = each.select("blob", "rule", F.col("z.sizes").alias("size"), F.col("z.measured").alias("measured"), F.sum(F.col("z.gaps") + F.coalesce("z.sizes", F.lit(0))).over(so_far).alias("stop"))
    least = F.create_map(*(x for r in rules for x in (F.lit(r.name), F.lit(r.least))))
    kept = placed.where("size is not null").where(F.col("measured") >= least[F.col("rule")])
    spans = kept.groupBy("blob", "rule").agg(F.sort_array(F.collect_list(F.struct((F.col("stop") - F.col("size")).alias("start"), "stop"))).alias("spans"))
    return noted.select("blob", "todo"), spans


class Ledger:
    """What has been scanned, and found, in a folder on a file system that all machines share.

    Each update is a folder of its own (``batch=NAME``): ``findings`` first, then ``scanned``, whose success mark commits it.
    What a broken update left is no part of the ledger and is overwritten when the update is tried again; a batch that is
    there already is not made again.
    """

    SCANNED, FINDINGS = "blob string, todo array<string>", "blob string, rule string, spans array<struct<start: bigint, stop: bigint>>"

    def __init__(self, spark: SparkSession, where: str):
        self.spark, self.where = spark, where.rstrip("/")

    @classmethod
    def scratch(cls, spark: SparkSession) -> Ledger:
        """An empty one in the scratch folder, which goes with the driver's JVM."""
        where = f"{scratch_dir(spark)}/ledger-{uuid.uuid4().hex}"
        fs, path = fs_of(spark, where)
        fs.deleteOnExit(path)
        return cls(spark, where)

    def batches(self) -> list[str]:
        fs, root = fs_of(self.spark, self.where)
        found = [s.getPath().toString() for s in fs.listStatus(root)] if fs.exists(root) else []
        return sorted(b for b in found if "/batch=" in b and fs.exists(fs_of(self.spark, f"{b}/scanned/_SUCCESS")[1]))

    def _read(self, part: str, schema: str) -> DataFrame:
        paths = [f"{b}/{part}" for b in self.batches()]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def scanned(self) -> DataFrame:
        """(blob, rules): the names of the rules that have read each blob."""
        return self._read("scanned", self.SCANNED).groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("todo"))).alias("rules"))

    def findings(self, rules: tuple[Rule, ...] = RULES) -> DataFrame:
        """(blob, rule, spans) of the rules in their present versions."""
        return self._read("findings", self.FINDINGS).where(F.col("rule").isin([r.name for r in rules]))

    def update(self, versions: DataFrame, batch: str, rules: tuple[Rule, ...] = RULES, text: str = "text") -> None:
        """Scan what the ledger lacks of the texts of ``versions`` (any columns beside ``text``) by ``rules``.

        A text that many rows hold is scanned once. Texts move once, to the task of their blob, copies combined before.
        """
        if any(b.endswith(f"/batch={batch}") for b in self.batches()):
            return
        names = F.array(*(F.lit(r.name) for r in rules))
        found = versions.select(blob_of(F.col(text)).alias("blob"), F.coalesce(F.col(text), F.lit("")).alias("text"))
        once = lambda rows: rows.groupBy("blob").agg(F.first("text").alias("text"))
        if not self.batches():
            unseen = once(found).withColumn("todo", names)
        else:
            lacking = F.array_except(names, F.coalesce("rules", F.array().cast("array<string>")))
            pairs = found.select("blob").distinct().join(self.scanned(), "blob", "left").select("blob", lacking.alias("todo")).where(F.size("todo") > 0)
            pairs = stage(pairs, "unseen")
            few = pairs.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST
            unseen = (once(found.join(F.broadcast(pairs.select("blob")), "blob", "left_semi")) if few else once(found)).join(pairs, "blob")
        scanned, findings = scan(unseen, rules)
        findings.write.mode("overwrite").parquet(f"{self.where}/batch={batch}/findings")
        scanned.write.mode("overwrite").parquet(f"{self.where}/batch={batch}/scanned")

    def by_path(self, versions: DataFrame, path: list[str], rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
        """``path`` columns of every row of ``versions``, its blob and hits: (start, rank, kind, stop) by place, rank by the order of the rules.

        A blob that very many paths hold is dealt to several tasks.
        """
        rank = F.create_map(*(x for k, r in enumerate(rules) for x in (F.lit(r.name), F.lit(k))))
        hit = lambda s: F.struct(s["start"].alias("start"), rank[F.col("rule")].alias("rank"), F.substring_index("rule", "@", 1).alias("kind"), s["stop"].alias("stop"))
        hits = self.findings(rules).select("blob", F.transform("spans", hit).alias("hits")).groupBy("blob").agg(F.sort_array(F.flatten(F.collect_list("hits"))).alias("hits"))
        rows = stage(versions.select(*path, blob_of(F.col(text)).alias("blob")), "paths")
        return salted(rows, hits, ["blob"]).withColumn("hits", F.coalesce("hits", F.array().cast(hits.schema["hits"].dataType)))


def secrets(docs: DataFrame, ledger: Ledger | None = None, batch: str = "documents") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_assign, n_access, n_hex, base_sha256, spans, blob.

    spans names all spans as kind:start:end by start, then kind in the order of RULES, joined by commas ('' if none); base_sha256 is
    the SHA-256 of those of the three base kinds. A span is the whole match, in code points, the end exclusive. Without a ledger an empty
    one in the scratch folder is filled. Null counts as empty and holds nothing; texts of any length are read whole; repeated rows
    have a result each, from one scan; an empty table gives an empty result; other columns of ``docs`` are ignored.
    """
    ledger = ledger or Ledger.scratch(docs.sparkSession)
    ledger.update(docs, batch)
    found = ledger.by_path(docs, ["doc_id"])
    named = lambda hits: F.array_join(F.transform(hits, lambda h: F.concat_ws(":", h["kind"], h["start"], h["stop"])), ",")
    count = lambda kind: F.size(F.filter("hits", lambda h: h["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    base = F.filter("hits", lambda h: h["rank"] < len(BASE))
    return found.select("doc_id", *(count(r.kind) for r in BASE), F.sha2(named(base), 256).alias("base_sha256"), named(F.col("hits")).alias("spans"), "blob")


def sql(rules: tuple[Rule, ...] = RULES) -> str:
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    each = "\nUNION ALL\n".join(
        f"SELECT blob, {k} AS rank, {quoted(r.kind)} AS kind, {r.least} AS least, string_split_regex(text, {quoted(r.pattern)}) AS gaps,"
        f" regexp_extract_all(text, {quoted(r.pattern)}) AS found, regexp_extract_all(text, {quoted(r.pattern)}, {r.group}) AS measured"
        f" FROM b WHERE regexp_matches(text, {quoted(r.pattern)})"
        for k, r in enumerate(rules))
    counts = ", ".join(f"CAST(coalesce(list_count(list_filter(hits, lambda h: h.kind = '{r.kind}')), 0) AS BIGINT) AS n_{r.kind}" for r in BASE)
    named = "coalesce(array_to_string(list_transform({}, lambda h: h.kind || ':' || h.start || ':' || h.stop), ','), '')"
    return f"""
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS blob, coalesce(text, '') AS text FROM documents),
b AS (SELECT blob, any_value(text) AS text FROM d GROUP BY blob),
m AS ({each}),
r AS (SELECT blob, rank, kind, least, unnest(list_zip(gaps[:len(found)], found, measured)) AS z, generate_subscripts(found, 1) AS i FROM m),
p AS (SELECT blob, rank, kind, least, length(z[2]) AS size, length(z[3]) AS measured,
             sum(length(z[1]) + length(z[2])) OVER (PARTITION BY blob, rank ORDER BY i) AS stop FROM r),
h AS (SELECT blob, list({{'start': CAST(stop - size AS BIGINT), 'kind': kind, 'stop': CAST(stop AS BIGINT), 'base': rank < {len(BASE)}}} ORDER BY stop - size, rank) AS hits
      FROM p WHERE measured >= least GROUP BY blob)
SELECT d.doc_id, {counts}, sha256({named.format("list_filter(hits, lambda h: h.base)")}) AS base_sha256, {named.format("hits")} AS spans, d.blob
FROM d LEFT JOIN h USING (blob)
"""
