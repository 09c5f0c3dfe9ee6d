"""Fuzzy line dedup by MinHash.

A line, in lower case and with single blanks, is the set of its runs of eight characters. One-permutation
MinHash with densification gives its signature; bands of it are dealt out as packed arrays, lines
that share a band are candidates, and the exact Jaccard similarity decides. Distributed union-find makes
components of the links, and of each component the line that comes first stays in its text.

Lines that are equal are one node throughout.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.shared import Staged, bloom_bits, bloom_has, chunks, classes, free_name, group_arrow, map_arrow, mix, partitions_for, stage, with_row_key

#: Characters of a shingle, least similarity, bands, values in a band.
SHINGLE, SIMILARITY, BANDS, ROWS = 8, 0.8, 10, 4
#: Bytes of packed bands that one task may get, on average.
PART = 16 << 20


def normal(line: str) -> str:
    """Lower case, single blanks, none at the ends."""
    return " ".join(line.lower().split())


def line_ids(lines: list[str]) -> np.ndarray:
    """(lines, 2): a 64-bit id of each normalised line, and a second one that tells lines of one id by chance apart."""
    digests = b"".join([xxhash.xxh3_128_digest(x.encode("utf-8", "replace")) for x in lines])
    return np.frombuffer(digests, "<i8").reshape(-1, 2)


def line_shingles(lines: list[str], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``size`` (at most 8) characters of each line and the line's index; a shorter line is one run.

    The low bytes of eight characters are one number; what lies above the low byte goes in by a polynomial.
    """
    n = np.array([len(x) for x in lines], np.int64)
    data = np.frombuffer(("".join(lines) + "\0" * 8).encode("utf-32-le", "replace"), np.uint32)
    at = np.concatenate((np.zeros(1, np.int64), np.cumsum(n)))
    runs = np.maximum(n - size + 1, np.minimum(n, 1))
    line = np.repeat(np.arange(len(lines)), runs)
    starts = np.arange(len(line)) - np.repeat(np.cumsum(runs) - runs, runs) + at[line]
    low = data.astype(np.uint8)
    h = np.ndarray((len(data) - 7,), "<u8", buffer=low, strides=(1,))[starts]
    if size < 8:
        h &= np.uint64((1 << 8 * size) - 1)
    short = np.flatnonzero(n[line] < size)
    if len(short):
        h[short] &= (np.uint64(1) << (np.uint64(8) * n[line[short]].astype(np.uint64))) - np.uint64(1)
        h[short] += n[line[short]].astype(np.uint64) * np.uint64(0xA24BAED4963EE407)
    high = data >> np.uint32(8)
    if high.any():  # few runs as a rule: only those that hold such a character
        upto = np.concatenate((np.zeros(1, np.int64), np.cumsum(high > 0)))
        some = np.flatnonzero(upto[np.minimum(starts + size, at[line + 1])] > upto[starts])
        begin, end = starts[some], at[line[some] + 1]
        more = np.zeros(len(some), np.uint64)
        for k in range(size):
            part = np.where(begin + k < end, high[np.minimum(begin + k, len(high) - 1)], np.uint32(0)).astype(np.uint64)
            more = more * np.uint64(0x9FB21C651E98DF25) + part
        h[some] += more * np.uint64(0xC2B2AE3D27D4EB4F)
    return mix(h), line


def _detours(bins: int, tries: int = 256) -> np.ndarray:
    """For each try, the bin that an empty bin borrows from: the same for all lines."""
    place = np.arange(tries * bins, dtype=np.uint64)
    out = (mix(place * np.uint64(0x9E3779B97F4A7C15) + np.uint64(99)) % np.uint64(bins)).astype(np.int64).reshape(tries, bins)
    # At last every bin in turn, so that a borrower always ends.
    return np.concatenate((out, (np.arange(bins)[None, :] + np.arange(1, bins)[:, None]) % bins))


def signatures(hashes: np.ndarray, line: np.ndarray, lines: int, bins: int) -> np.ndarray:
    """(lines, bins) of 32-bit values: the least of each bin of one permutation, empty bins filled from others."""
    empty = np.uint32(0xFFFFFFFF)
    out = np.full(lines * bins, empty, np.uint32)
    bin_ = ((hashes >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)
    value = np.minimum(hashes & np.uint64(0xFFFFFFFF), np.uint64(0xFFFFFFFE)).astype(np.uint32)
    np.minimum.at(out, line * bins + bin_.astype(np.int64), value)
    out = out.reshape(lines, bins)
    filled = out.copy()
    row, col = np.nonzero((out == empty) & (out != empty).any(axis=1)[:, None])
    for detour in _detours(bins):
        if not len(row):
            break
        got = out[row, detour[col]]
        ok = got != empty
        filled[row[ok], col[ok]] = got[ok]
        row, col = row[~ok], col[~ok]
    return filled


def band_keys(signature: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """(lines, bands) of 64-bit keys."""
    s = signature.reshape(len(signature), bands, rows).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), s.shape[:2])
    for k in range(rows):
        key = mix(key * np.uint64(0x9FB21C651E98DF25) + s[:, :, k])
    return key


def line_elements(size: int = SHINGLE):
    """Normalised lines to (hash, line, weight): distinct runs of characters, as hashes of 40 bits, each of weight 1."""

    def elements(lines: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        h, line = line_shingles(lines, size)
        key = np.sort((line.astype(np.uint64) << np.uint64(40)) | (h >> np.uint64(24)))
        key = key[np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))[: len(key)])]
        return key & np.uint64((1 << 40) - 1), (key >> np.uint64(40)).astype(np.int64), np.ones(len(key))

    return elements


def duplicate_lines(docs: DataFrame, similar: float = SIMILARITY, size: int = SHINGLE, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(row_key, doc_id, removed): the places (from 0) of the lines that a text loses; only texts that lose some.

    A line that is blank is never removed. Of a component the line that comes first by (doc_id, place)
    stays; null ids come last. Rows that repeat both id and text lose the same lines.
    """
    spark = docs.sparkSession
    keyed = with_row_key(docs)
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["line", "proof", "row_key", "doc_id", "place", "part", "keys", "ids"]
    # A line has some 40 bytes at least on average; its bands take 12 bytes each.
    length = keyed.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = partitions_for(spark, -(-length // 40 * bands * 12 // PART))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The place of every line; and, for some 8 MB of text at once, the bands of its distinct lines, dealt to parts."""
        held: dict[int, str] = {}
        weight = 0

        def flush() -> pa.RecordBatch:
            key = []
            lines = list(held.values())
            for lo in range(0, len(lines), 4000):
                h, line = line_shingles(lines[lo : lo + 4000], size)
                key.append(band_keys(signatures(h, line, len(lines[lo : lo + 4000]), bands * rows), bands, rows))
            key, id_ = np.concatenate(key).reshape(-1), np.repeat(np.fromiter(held, np.int64, len(held)), bands)
            part = ((key >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
            by = np.argsort(part.astype(np.uint16) if parts < 1 << 16 else part, kind="stable")
            part, low, id_ = part[by], key[by].astype(np.uint32), id_[by]
            cut = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1], [True])))
            n = len(cut) - 1
            empty = [pa.nulls(n, t) for t in (pa.int64(), pa.int64(), pa.int64(), doc_type, pa.int32())]
            packed = [pa.array([x[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary()) for x in (low, id_)]
            return pa.RecordBatch.from_arrays([*empty, pa.array(part[cut[:-1]].astype(np.int32)), *packed], names)

        for batch in batches:
            doc_type = batch.schema.field("doc_id").type
            for chunk in chunks(batch):
                lines, row, place = [], [], []
                for i, text in enumerate(chunk.column("text").to_pylist()):
                    for k, x in enumerate(text.split("\n")):
                        if x := normal(x):
                            lines.append(x)
                            row.append(i)
                            place.append(k)
                if not lines:
                    continue
                ids, at = line_ids(lines), pa.array(row, pa.int64())
                held.update(zip(ids[:, 0].tolist(), lines, strict=True))
                weight += sum(map(len, lines))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[:, 0]), pa.array(ids[:, 1]), chunk.column("row_key").take(at), chunk.column("doc_id").take(at), pa.array(place, pa.int32()), pa.nulls(len(row), pa.int32()), pa.nulls(len(row), pa.binary()), pa.nulls(len(row), pa.binary())],
                    names,
                )
                if weight > 8 << 20:
                    yield flush()
                    held, weight = {}, 0
        if held:
            yield flush()

    def meet(table: pa.Table) -> pa.Table:
        key = np.frombuffer(b"".join(table.column("keys").to_pylist()), np.uint32)
        id_ = np.frombuffer(b"".join(table.column("ids").to_pylist()), np.int64)
        by = np.lexsort((id_, key))
        key, id_ = key[by], id_[by]
        new = np.concatenate(([True], (key[1:] != key[:-1]) | (id_[1:] != id_[:-1])))
        key, id_ = key[new], id_[new]
        same = key[1:] == key[:-1]
        several = np.concatenate((same, [False])) | np.concatenate(([False], same))
        part = table.column("part")[0].as_py()
        return pa.table({"bucket": (np.int64(part) << np.int64(32)) | key[several].astype(np.int64), "node": id_[several]})

    both = Staged(map_arrow(keyed, read, f"line bigint, proof bigint, row_key bigint, doc_id {kind}, place int, part int, keys binary, ids binary"), "lines")
    every = both.df.where("part is null").select("line", "proof", "row_key", "doc_id", "place")
    # Of lines that share an id by chance the ones of the least proof are the line; the others are left alone.
    order = F.struct(F.col("doc_id").isNull().alias("x"), "doc_id", "row_key", "place")
    equal = every.groupBy("line").agg(F.min(F.struct("proof", order.alias("first"))).alias("f"), F.count("*").alias("n"))
    equal = Staged(equal.select("line", "f.proof", "f.first", "n"), "equal")
    dealt = both.df.where("part is not null").select("part", "keys", "ids")
    members = Staged(group_arrow(dealt, "part", meet, "bucket bigint, node bigint"), "members")

    wanted = members.df.select(F.col("node").alias("line")).distinct().join(equal.df, "line").select("line", F.col("first.row_key").alias("row_key"), F.col("first.doc_id").alias("id"), F.col("first.place").alias("place"))
    wanted = Staged(wanted, "wanted")
    bits, length = bloom_bits(wanted.df.select(F.xxhash64("row_key").alias("k")), "k")
    filter_ = spark.sparkContext.broadcast((bits, length))

    def maybe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, length = filter_.value
        for batch in batches:
            yield batch.filter(pa.array(bloom_has(bits, length, batch.column("k").to_numpy()))).select(["row_key", "doc_id", "text"])

    holders = map_arrow(keyed.withColumn("k", F.xxhash64("row_key")), maybe, f"row_key bigint, doc_id {kind}, text string").dropDuplicates(["row_key", "doc_id"]).alias("a")
    asked = wanted.df.groupBy("row_key", "id").agg(F.collect_list(F.struct("line", "place")).alias("asked")).alias("b")
    shown = holders.join(asked, (F.col("a.row_key") == F.col("b.row_key")) & F.col("a.doc_id").eqNullSafe(F.col("b.id")))

    def show(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, text = [], []
            for t, asked in zip(batch.column("text").to_pylist(), batch.column("asked").to_pylist(), strict=True):
                lines = t.split("\n")
                node += [a["line"] for a in asked]
                text += [normal(lines[a["place"]]) for a in asked]
            yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(text, pa.string())], ["node", "text"])

    texts = Staged(map_arrow(shown.select("text", "asked"), show, "node bigint, text string"), "texts")

    found = classes(members.df, texts.df, line_elements(size), similar, "lines")
    linked = Staged(found.withColumnRenamed("node", "line").join(equal.df, "line").select("line", "proof", "component", "first"), "linked")
    first = linked.df.groupBy("component").agg(F.min("first").alias("stays"))
    similar_lines = linked.df.join(first, "component").select("line", F.col("proof").alias("p"), "stays")
    rest = equal.df.where("n > 1").join(similar_lines.select("line"), "line", "left_anti").select("line", F.col("proof").alias("p"), F.col("first").alias("stays"))
    doubles = similar_lines.unionByName(rest)
    gone = every.join(doubles, "line").where("proof = p and not (row_key = stays.row_key and doc_id <=> stays.doc_id and place = stays.place)")
    out = stage(gone.groupBy("row_key", "doc_id").agg(F.collect_set("place").alias("removed")), "removed")
    for x in (both, equal, members, wanted, texts, linked):
        x.drop()
    return out


def dedup_lines(docs: DataFrame, similar: float = SIMILARITY) -> DataFrame:
    """``docs`` with the text of the remaining lines, and the columns n_lines and n_removed.

    Null texts stay null and have no lines; empty texts have one, which is blank. Columns already called n_lines or n_removed
    are replaced, all others pass through. Line ends are line feeds; blank lines stay, and count among n_lines. An empty table stays empty.
    """
    removed = duplicate_lines(docs, similar)
    docs = docs.drop("n_lines", "n_removed")
    key, gone = free_name(docs, "_row_key"), free_name(docs, "_removed")
    named = docs.withColumn(key, F.xxhash64(F.col("doc_id"), F.coalesce(F.col("text"), F.lit(""))))
    removed = removed.select(F.col("row_key").alias("_k"), F.col("doc_id").alias("_id"), F.sort_array("removed").alias(gone))
    joined = named.join(removed, (named[key] == removed["_k"]) & named["doc_id"].eqNullSafe(removed["_id"]), "left").select(*(named[c] for c in named.columns), removed[gone])
    lines = F.split(F.col("text"), "\n")
    # Places that stay as a difference of sets: one look at each line, however many go.
    pair = F.struct(lines.alias("l"), F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone)).alias("k"))
    kept = F.get(F.transform(F.array(pair), lambda x: F.array_join(F.transform(x["k"], lambda i: F.get(x["l"], i)), "\n")), 0)
    return (
        joined.withColumn("n_lines", F.coalesce(F.array_size(lines), F.lit(0)).cast("bigint"))
        .withColumn("n_removed", F.coalesce(F.array_size(gone), F.lit(0)).cast("bigint"))
        .withColumn("text", F.when(F.col(gone).isNotNull(), kept).otherwise(F.col("text")))
        .drop(key, gone)
    )


def line_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_removed, kept_chars, kept_sha256 of every row (null text: as empty); repeated rows are alike."""
    out = dedup_lines(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")))
    return out.select("doc_id", "n_lines", "n_removed", F.length("text").cast("bigint").alias("kept_chars"), F.sha2("text", 256).alias("kept_sha256"))


def drop_repeated_lines(docs: DataFrame) -> DataFrame:
    """``docs`` without repeated lines, with its columns, n_chars (if there) brought up to date; texts that lose all they had are dropped.

    Null, empty and blank texts stay as they are; so do clashing columns: what the operator adds has names of its own.
    """
    ids = free_name(docs, "_place")
    own = docs.withColumn(ids, F.struct(*(c for c in docs.columns if c.lower() in ("n_lines", "n_removed"))) if {c.lower() for c in docs.columns} & {"n_lines", "n_removed"} else F.lit(0))
    out = dedup_lines(own)
    out = out.where((F.col("n_removed") == 0) | F.trim(F.col("text")).rlike(r"\S")).drop("n_lines", "n_removed")
    out = out.withColumns({c: F.col(ids)[c] for c in docs.columns if c.lower() in ("n_lines", "n_removed")})
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length(F.coalesce("text", F.lit(""))).cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)
