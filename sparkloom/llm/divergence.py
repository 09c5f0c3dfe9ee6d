"""Source divergence audit: how the sources of a language differ in their terms, by dense matrices of term blocks.

Terms are counted by language and source, and the terms of a language are dealt to blocks by hash. Each
block becomes an int64 matrix of groups by terms; all pairs of groups are compared by broadcasting, tile by tile. Partial pair
matrices are summed by Spark, combined before the shuffle, and each block's best terms of each group are merged.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.llm.shared import map_arrow, stage
from sparkloom.operators.skew import lookup
from sparkloom.shipping import ship

#: A term is kept where so many documents of its language have it.
LEAST_DOCUMENTS = 30
#: Terms of a group in the result.
TOP = 50
#: Cells (groups x terms) of a block, about: 1 MB, so that a language's terms go to many tasks.
CELLS = 1 << 17
#: Groups of a tile, about.
SIDE = 256
#: Differences that one broadcast makes: 8 MB.
TILE = 1 << 20
#: Distinct (language, source, term) that a task gathers before it hands them on.
HELD = 300_000

#: ASCII capitals become small, other ASCII characters but letters become blanks, other bytes stay.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or 97 <= b <= 122 else 32 for b in range(256))


def terms_of(text: bytes, most: int = 1 << 20) -> Iterator[list[bytes]]:
    """The terms of a text in UTF-8, by pieces of about ``most`` bytes: runs of ASCII letters and of all characters beyond ASCII, A-Z in lower case."""
    plain, at = text.translate(_TERM_BYTES), 0
    while at < len(plain):
        end = plain.find(b" ", at + most)
        end = len(plain) if end < 0 else end
        yield plain[at:end].split()
        at = end


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[tuple, tuple[Counter, Counter]] = {}
    held = 0

    def out() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, df) in counts.items():
            words = list(n)
            for at in range(0, max(1, len(words)), 50_000):  # a group without a term has one row, without a term
                part = words[at : at + 50_000]
                term = pa.array(part or [None], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(term)), pa.array([source] * len(term)), term, pa.array([n[w] for w in part] or [0], pa.int64()), pa.array([df[w] for w in part] or [0], pa.int64())],
                    ["lang", "source", "term", "n", "df"])

    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), texts, strict=True):
            n, df = counts.setdefault((lang, source), (Counter(), Counter()))
            seen, before = set(), len(n)
            for words in terms_of(text.as_py()):
                n.update(words)
                seen.update(words)
            df.update(seen)
            held += len(n) - before
            if held > HELD:
                yield from out()
                counts, held = {}, 0
    yield from out()


def shares(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """1 + floor(1e9 a / b), a below b, exactly: three digits at a time, so nothing overflows for b up to 9e15."""
    if np.max(totals, initial=0) > 9 * 10**15:
        raise OverflowError("more than 9e15 terms in a group")
    rest, whole = counts.astype(np.int64), np.zeros(np.broadcast_shapes(counts.shape, totals.shape), np.int64)
    for _ in range(3):
        more, rest = np.divmod(rest * 1000, totals)
        whole = whole * 1000 + more
    return whole + 1


def pair_sums(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sums of |a[i] - b[j]| over the columns for all pairs of rows: broadcast in tiles of bounded size."""
    out = np.zeros((len(a), len(b)), np.int64)
    side = max(1, int(np.sqrt(TILE / max(1, min(a.shape[1], 1024)))))
    for i in range(0, len(a), side):
        for j in range(0, len(b), side):
            for k in range(0, a.shape[1], 1024):
                out[i : i + side, j : j + side] += np.abs(a[i : i + side, None, k : k + 1024] - b[None, j : j + side, k : k + 1024]).sum(2)
    return out


_BLOCK = "lang string, part string, source string, item string, value bigint"


def _block(key: tuple, counts: pa.Table, groups: pa.Table) -> pa.Table:
    """Pair sums and best terms of one block of terms of a language, for the groups of one tile or between those of two.

    A pair's sum starts from the difference of the shares that a term without occurrences has, times all kept terms
    (added by block 0), so terms that no group here has need no column.
    """
    lang, block, low, high = (x.as_py() for x in key)
    names, tile = groups.column("source").to_pylist(), groups.column("tile").to_pylist()
    order = sorted(range(len(names)), key=lambda i: (tile[i], names[i].encode()))
    names = [names[i] for i in order]
    first = sum(t == low for t in tile)
    totals = groups.column("total").to_numpy()[order]
    of_lang, kept = np.int64(groups.column("lang_total")[0].as_py()), groups.column("v")[0].as_py()
    coded = pa.chunked_array(counts.column("term")).combine_chunks().dictionary_encode()
    terms, at = coded.dictionary.to_pylist(), coded.indices.to_numpy()
    row = pc.index_in(counts.column("source"), value_set=pa.array(names, pa.string())).to_numpy()
    many = np.zeros((len(names), len(terms)), np.int64)
    np.add.at(many, (row, at), counts.column("n").to_numpy())
    every = np.maximum(totals, 1)[:, None]
    p, none = shares(many + 5, every), shares(np.full((len(names), 1), 5), every)
    cut = (slice(None), slice(None)) if low == high else (slice(0, first), slice(first, None))
    sums = pair_sums(p[cut[0]], p[cut[1]]) + np.abs(none[cut[0]] - none[cut[1]].T) * ((kept if block == 0 else 0) - len(terms))
    i, j = np.triu_indices(len(names), 1) if low == high else np.indices(sums.shape).reshape(2, -1)
    listed = pa.array(names, pa.string())
    parts = [pa.table({"lang": pa.array([lang] * len(i), pa.string()), "part": pa.array(["pair"] * len(i), pa.string()), "source": listed.take(pa.array(i)), "item": listed.take(pa.array(j + (0 if low == high else first))), "value": sums[i, j]})]
    if low == high and terms:
        in_lang = np.zeros(len(terms), np.int64)
        in_lang[at] = counts.column("lang_n").to_numpy()
        q, encoded = shares(in_lang + 5, np.maximum(of_lang, 1)), [t.encode() for t in terms]
        for g, name in enumerate(names):
            over = np.flatnonzero((many[g] > 0) & (p[g] > q))
            best = heapq.nsmallest(TOP, over.tolist(), key=lambda t, g=g: (q[t] - p[g, t], encoded[t]))
            parts.append(pa.table({"lang": pa.array([lang] * len(best), pa.string()), "part": pa.array(["term"] * len(best), pa.string()), "source": pa.array([name] * len(best), pa.string()), "item": pa.array([terms[t] for t in best], pa.string()), "value": (p[g] - q)[best].astype(np.int64)}))
    return pa.concat_tables(parts)


def divergence(docs: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """lang, source, part, item, value, rank: see the module; part 'pair' has all other sources of the language, 'term' the first TOP terms.

    Null text, language and source count as ''. A language without a kept term has pairs of value 0; a source alone in its language has
    no pairs; an empty table gives an empty result. Every row is a document, repeated ones too; texts are read whole; other columns are ignored. Ranks go by
    falling value, ties by the item's UTF-8 bytes. All numbers are whole: counts, shares in billionths and their differences.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    counted = map_arrow(docs.select(blank("lang"), blank("source"), blank("text")), _counted, "lang string, source string, term string, n bigint, df bigint")
    counts = stage(counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df")), "counts")
    of_term = Window.partitionBy("lang", "term")
    kept = counts.where("term is not null").withColumns({"df": F.sum("df").over(of_term), "lang_n": F.sum("n").over(of_term)}).where(F.col("df") >= least).drop("df")
    kept = stage(kept, "kept")
    terms = kept.select("lang", "term").distinct().groupBy("lang").agg(F.count("*").alias("v"))
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    groups = counts.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").join(terms, "lang", "left").na.fill(0, ["n", "v"])
    per = Window.partitionBy("lang")
    groups = groups.select("lang", "source", "v", (F.col("n") + 5 * F.col("v")).alias("total"), (F.sum("n").over(per) + 5 * F.col("v")).alias("lang_total"), F.count("*").over(per).alias("many"))
    # Groups are dealt to tiles of about SIDE, terms to blocks, so that two tiles' rows of a block have about CELLS cells.
    wide = F.least("many", F.lit(2 * SIDE))
    groups = groups.withColumns({"blocks": F.greatest(F.lit(1), F.ceil(F.col("v") * wide / CELLS)).cast("int"), "tiles": F.ceil(F.col("many") / SIDE).cast("int")}).drop("many")
    groups = stage(groups, "groups")
    tile, block = F.pmod(F.xxhash64("source"), F.col("tiles")).cast("int"), F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int")
    meets = lambda df: df.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).withColumns({"low": F.least("tile", "other"), "high": F.greatest("tile", "other")})
    dealt = meets(groups.withColumn("tile", tile).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    of_lang = groups.groupBy("lang").agg(F.max("blocks").alias("blocks"), F.max("tiles").alias("tiles"))
    placed = meets(lookup(kept, of_lang, ["lang"]).withColumns({"tile": tile, "block": block}))
    keys = ["lang", "block", "low", "high"]
    ship(docs.sparkSession)
    left = placed.select(*keys, "source", "term", "n", "lang_n").groupBy(*keys)
    right = dealt.select(*keys, "source", "tile", "total", "lang_total", "v").groupBy(*keys)
    found = stage(left.cogroup(right).applyInArrow(_block, _BLOCK), "blocks")
    half = found.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    pairs = half.unionByName(half.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    ranked = lambda df: df.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    best = ranked(found.where("part = 'term'")).where(F.col("rank") <= TOP)
    return ranked(pairs.withColumn("part", F.lit("pair"))).select(columns).unionByName(best.select(columns))


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
w AS (SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT id) >= 30),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN k USING (lang, term) GROUP BY ALL),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
g AS (SELECT lang, source FROM d GROUP BY lang, source),
t AS (SELECT g.lang, g.source, coalesce(v.v, 0) AS v, CAST(coalesce(sum(c.n), 0) AS HUGEINT) AS n
      FROM g LEFT JOIN v USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source GROUP BY ALL),
p AS (SELECT t.lang, t.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (t.n + 5 * t.v) AS p
      FROM t JOIN k USING (lang) LEFT JOIN c ON c.lang = t.lang AND c.source = t.source AND c.term = k.term),
l AS (SELECT lang, sum(n) AS n, max(v) AS v FROM t GROUP BY lang),
q AS (SELECT k.lang, k.term, 1 + (1000000000::HUGEINT * (sum(c.n) + 5)) // (l.n + 5 * l.v) AS q
      FROM k JOIN c USING (lang, term) JOIN l ON l.lang = k.lang GROUP BY k.lang, k.term, l.n, l.v),
s AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT p.lang, p.source, 'term' AS part, p.term AS item, CAST(p.p - q.q AS BIGINT) AS value FROM p JOIN q USING (lang, term) WHERE p.n > 0 AND p.p > q.q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
           FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value, CAST(rank AS INT) AS rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""
