"""Near-duplicate documents by improved consistent weighted sampling over TF-IDF shingles.

A document is the multiset of its runs of five words, each weighted by its count times its inverse document
frequency. Ioffe's improved consistent weighted sampling draws shingles so that two documents draw the
same one with probability equal to their weighted Jaccard similarity; draws are grouped in bands, documents
that share a band are candidates, and the exact weighted Jaccard similarity decides. Classes are the
components of the verified links.

Documents whose words are the same are one node throughout, so copies cost one comparison in all.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.shared import Staged, bloom_bits, bloom_has, chunks, classes, free_name, group_arrow, map_arrow, mix, shingle_hashes, stage, with_row_key, word_hashes
from sparkloom.shipping import ship

#: Words of a shingle, least similarity, bands, draws in a band.
SHINGLE, SIMILARITY, BANDS, ROWS = 5, 0.8, 12, 3
#: Bytes of text of a block of documents, and of the text whose shingles are counted in one bucket.
BLOCK, BUCKET = 4 << 20, 12 << 20

#: Of the greatest idf, the least that a shingle has in draws where similarity without idf counts too.
FLOOR = 0.1

_DRAWS = 1 << 16


@lru_cache(maxsize=2)
def _draws(many: int) -> Draws:
    return Draws(many)


class Draws:
    """Gamma and uniform variates; each of the three is looked up by bits of its own of a shingle's hash and the draw's number."""

    def __init__(self, many: int, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.r = rng.gamma(2, 1, _DRAWS).astype(np.float32)
        self.log_c = np.log(rng.gamma(2, 1, _DRAWS)).astype(np.float32)
        self.beta = rng.random(_DRAWS).astype(np.float32)
        self.by = rng.integers(1, 1 << 63, many, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def of(self, hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(r, log c, beta) of draw k for each hash."""
        h = hashes * self.by[k]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        parts = h.view(np.uint16).reshape(-1, 4)
        return self.r[parts[:, 3]], self.log_c[parts[:, 2]], self.beta[parts[:, 1]]


class Vectors:
    """Distinct shingles (sorted) and their counts, for many texts at once."""

    def __init__(self, texts: list[str | None], size: int = SHINGLE):
        self.words, self.word_at = word_hashes(texts)
        h, text = shingle_hashes(self.words, self.word_at, size)
        order = np.lexsort((h, text))
        h, text = h[order], text[order]
        new = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (text[1:] != text[:-1])))[: len(h)])
        self.hash, self.count = h[new], np.diff(np.append(new, len(h)))
        self.at = np.searchsorted(text[new], np.arange(len(texts) + 1))


def node_ids(words: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit ids of each text's sequence of words, as signed numbers."""
    place = np.arange(len(words), dtype=np.int64) - np.repeat(at[:-1], np.diff(at))
    out = []
    for turn in (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)):
        part = mix(words + place.astype(np.uint64) * turn)
        sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(part, out=sums[1:])
        out.append(mix(sums[at[1:]] - sums[at[:-1]] + np.diff(at).astype(np.uint64)).view(np.int64))
    return out[0], out[1]


def idf_of(counts: np.ndarray, documents: int) -> np.ndarray:
    """The idf of shingles by the number of documents that hold them, of so many in all."""
    return (np.log((documents + 1) / (counts.astype(np.float64) + 1)) + 1e-3).astype(np.float32)


def _planes(x: np.ndarray) -> bytes:
    """Numbers by planes of bytes, so that the high ones, mostly zero, take no room once compressed."""
    return x.view(np.uint8).reshape(-1, x.itemsize).T.tobytes()


def _numbers(x: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(x, np.uint8).reshape(size, -1).T).reshape(-1).view(kind)


def _pack(h: np.ndarray) -> bytes:
    """Rising hashes as differences."""
    return _planes(np.diff(h, prepend=np.uint64(0)))


def _unpack(x: bytes) -> np.ndarray:
    return np.cumsum(_numbers(x, np.uint64), dtype=np.uint64)


def _squeeze(x: bytes, level: int = 3) -> bytes:
    return zstandard.ZstdCompressor(level=level).compress(x)


def _full(x: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(x)


def _batch(columns: list, names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def blocked(keyed: DataFrame) -> Staged:
    """(block, row_key, doc_id, sizes, texts): a row for each block of about BLOCK bytes of text of ``keyed``, written.

    row_key and doc_id are arrays; texts are compressed together, sizes are their lengths in bytes.
    """
    doc_id = pa.list_

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in chunks(batch, most=BLOCK):
                texts = [t.encode("utf-8", "replace") for t in part.column("text").to_pylist()]
                ids = part.column("doc_id")
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([n], pa.int64()), pa.array([part.column("row_key").to_pylist()], doc_id(pa.int64())), pa.array([ids.to_pylist()], doc_id(ids.type)),
                        pa.array([[len(t) for t in texts]], doc_id(pa.int64())), pa.array([_squeeze(b"".join(texts))], pa.binary()),
                    ],
                    ["block", "row_key", "doc_id", "sizes", "texts"],
                )
                n += 1

    kind = keyed.schema["doc_id"].dataType.simpleString()
    return Staged(map_arrow(keyed, number, f"block bigint, row_key array<bigint>, doc_id array<{kind}>, sizes array<bigint>, texts binary"), "blocks")


def block_texts(sizes: list[int], texts: bytes, most: int = 1 << 20) -> Iterator[tuple[int, list[str]]]:
    """(first number, texts) of a block, about ``most`` bytes of text at a time."""
    data, held, first, weight, at = _full(texts), [], 0, 0, 0
    for k, n in enumerate(sizes):
        if held and weight + n > most:
            yield first, held
            held, first, weight = [], k, 0
        held.append(data[at : at + n].decode("utf-8", "replace"))
        at, weight = at + n, weight + n
    if held:
        yield first, held


def block_shingles(sizes: list[int], texts: bytes, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of a block, in order, and in how many of its documents each is."""
    h = np.concatenate([np.zeros(0, np.uint64), *(Vectors(part, size).hash for _, part in block_texts(sizes, texts))])
    h.sort(kind="stable")
    new = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))[: len(h)])
    return h[new], np.diff(np.append(new, len(h))).astype(np.uint32)


def _edges(many: int) -> np.ndarray:
    """The hashes at which the second, third, ... of so many buckets begins."""
    return np.array([-((-k << 64) // many) for k in range(1, many)], np.uint64)


def bucket_count(blocks: DataFrame) -> int:
    """How many buckets shingles are dealt to, by the bytes of text."""
    length = blocks.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("bigint"), lambda a, x: a + x))).first()[0] or 0
    return max(1, math.ceil(length / BUCKET))


def document_frequencies(blocks: DataFrame, many: int, size: int = SHINGLE) -> DataFrame:
    """(block, bucket, counts): for each distinct shingle of a block, in order, in how many documents of all it is.

    Blocks send each of their shingles once, with a partial count, to the bucket of its hash; a bucket adds
    up and answers with the totals alone, in the order in which it was asked. So counts are exact for
    every shingle and don't depend on the layout, and a shingle of very many documents is one number a block.
    """
    names, kinds = ["bucket", "block", "h", "c"], [pa.int32(), pa.int64(), pa.binary(), pa.binary()]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = _edges(many)
        for batch in batches:
            for block, sizes, texts in zip(*(batch.column(c).to_pylist() for c in ("block", "sizes", "texts")), strict=True):
                h, c = block_shingles(sizes, texts, size)
                at = [0, *np.searchsorted(h, edges).tolist(), len(h)]
                pieces = [(k, at[k], at[k + 1]) for k in range(many) if at[k] < at[k + 1]]
                yield _batch([[k for k, _, _ in pieces], [block] * len(pieces), [_pack(h[a:b]) for _, a, b in pieces], [_squeeze(_planes(c[a:b]), 1) for _, a, b in pieces]], names, kinds)

    def answer(table: pa.Table) -> pa.Table:
        asked = [_unpack(x) for x in table.column("h").to_pylist()]
        c = np.concatenate([_numbers(_full(x), np.uint32) for x in table.column("c").to_pylist()])
        h = np.concatenate(asked)
        order = np.argsort(h, kind="stable")
        sorted_ = h[order]
        new = np.flatnonzero(np.concatenate(([True], sorted_[1:] != sorted_[:-1])))
        sums = np.add.reduceat(c[order].astype(np.uint64), new)
        total = np.empty(len(h), np.uint32)
        total[order] = np.repeat(np.minimum(sums, 0xFFFFFFFF).astype(np.uint32), np.diff(np.append(new, len(h))))
        ends = np.cumsum([len(x) for x in asked])
        counts = [_squeeze(_planes(total[b - len(x) : b]), 1) for x, b in zip(asked, ends, strict=True)]
        return pa.Table.from_arrays([table.column("block").combine_chunks(), table.column("bucket").combine_chunks(), pa.array(counts, pa.binary())], ["block", "bucket", "counts"])

    rows = map_arrow(blocks.select("block", "sizes", "texts"), partial, "bucket int, block bigint, h binary, c binary")
    return group_arrow(rows, "bucket", answer, "block bigint, bucket int, counts binary")


def bands(v: Vectors, idf: np.ndarray, draws: Draws, many: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """(texts, bands) of bucket hashes, by the idf of each shingle of ``v``; only meaningful for texts with a shingle."""
    full = np.flatnonzero(np.diff(v.at) > 0)
    starts, sizes = v.at[:-1][full], np.diff(v.at)[full]
    out = np.zeros((len(v.at) - 1, many), np.uint64)
    if not len(full):
        return out.view(np.int64)
    log_w = np.log(v.count.astype(np.float32) * idf)
    for b in range(many):
        key = np.full(len(full), b + 1, np.uint64)
        for k in range(b * rows, b * rows + rows):
            r, log_c, beta = draws.of(v.hash, k)
            t = np.floor(log_w / r + beta)
            log_a = log_c - r * (t - beta) - r
            least = np.minimum.reduceat(log_a, starts)
            hits = np.flatnonzero(log_a == np.repeat(least, sizes))
            first = hits[np.searchsorted(hits, starts)]
            key = mix(key * np.uint64(0x9FB21C651E98DF25) + v.hash[first] + t[first].astype(np.int64).view(np.uint64) * np.uint64(0xA24BAED4963EE407))
        out[full, b] = key
    return out.view(np.int64)


def weighted_elements(documents: int, size: int = SHINGLE):
    """Texts to (hash, text, weight): a shingle that occurs n times is n elements, each with its idf.

    Each text comes with its frequencies: their packed length (4 bytes), the packed numbers of documents that
    hold its distinct shingles, in order, and the text.
    """

    def elements(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ends = [4 + int.from_bytes(t[:4], "big") for t in texts]
        v = Vectors([t[end:].decode("utf-8", "replace") for t, end in zip(texts, ends, strict=True)], size)
        counts = np.concatenate([np.zeros(0, np.uint32)] + [_numbers(_full(t[4:end]), np.uint32) for t, end in zip(texts, ends, strict=True)])
        text = np.repeat(np.arange(len(texts)), np.diff(v.at))
        h, owner, w = np.repeat(v.hash, v.count), np.repeat(text, v.count), np.repeat(idf_of(counts, documents).astype(np.float64), v.count)
        copy = np.arange(len(h)) - np.repeat(np.cumsum(v.count) - v.count, v.count)
        h = np.where(copy > 0, mix(h + copy.astype(np.uint64) * np.uint64(0xA24BAED4963EE407)), h)
        by = np.lexsort((h, owner))
        return h[by], owner[by], w[by]

    return elements


def near_classes(docs: DataFrame, similar: float = SIMILARITY, size: int = SHINGLE, many: int = BANDS, rows: int = ROWS, plain: bool = False) -> DataFrame:
    """(row_key, doc_id, class_id, kept) of every row of ``docs``; class_id is the least doc_id of the class, kept tells the class's first row.

    The first row has the least doc_id (null last), then the least row_key, xxhash64(doc_id, text); rows that repeat
    both id and text are in one class and alike. Null and empty texts, and texts without a word, are alone in
    their class (class_id = doc_id) and kept. Texts of fewer than ``size`` words are one shingle. Texts are
    read whole, whatever their length; an empty table gives an empty result; other columns are ignored.

    What a large group of near copies has in common weighs little by its idf, so two of them can be unlike by weights and alike
    by words. With ``plain`` a Jaccard similarity of ``similar`` without idf is a link too, and no shingle's idf counts for less
    than FLOOR of the greatest when draws are made.
    """
    keyed = with_row_key(docs)
    spark = docs.sparkSession
    blocks = blocked(keyed)
    documents = blocks.df.agg(F.sum(F.size("row_key"))).first()[0] or 0
    buckets = bucket_count(blocks.df)
    ship(spark)
    kind = docs.schema["doc_id"].dataType
    names = ["row_key", "doc_id", "node", "proof", "keys", "frequencies"]

    def sign(block: pa.Table, answers: pa.Table) -> pa.Table:
        draws, out = _draws(many * rows), []
        parts = sorted(zip(answers.column("bucket").to_pylist(), answers.column("counts").to_pylist(), strict=True))
        counts = np.concatenate([np.zeros(0, np.uint32), *(_numbers(_full(x), np.uint32) for _, x in parts)])
        for k in range(block.num_rows):
            sizes, texts = block.column("sizes")[k].as_py(), block.column("texts")[k].as_py()
            keys, ids = (block.column(c)[k].values for c in ("row_key", "doc_id"))
            h, _ = block_shingles(sizes, texts, size)
            for first, part in block_texts(sizes, texts):
                v = Vectors(part, size)
                df = counts[np.searchsorted(h, v.hash)]
                idf = idf_of(df, documents)
                if plain:
                    idf = np.maximum(idf, np.float32(FLOOR * math.log(documents + 1)))
                key, (node, proof) = bands(v, idf, draws, many, rows), node_ids(v.words, v.word_at)
                none = np.diff(v.at) == 0
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(key) + 1, dtype=np.int32) * many), pa.array(key.reshape(-1)))
                packed = [_squeeze(_planes(df[i:j]), 1) for i, j in zip(v.at[:-1], v.at[1:], strict=True)]
                out.append(pa.RecordBatch.from_arrays([keys.slice(first, len(part)), ids.slice(first, len(part)), pa.array(node, mask=none), pa.array(proof), lists, pa.array(packed, pa.binary())], names))
        return pa.Table.from_batches(out)

    answered = document_frequencies(blocks.df, buckets, size).groupBy("block")
    signed = stage(blocks.df.groupBy("block").cogroup(answered).applyInArrow(sign, f"row_key bigint, doc_id {kind.simpleString()}, node bigint, proof bigint, keys array<bigint>, frequencies binary"), "signed")
    blocks.drop()
    who = F.struct(F.col("doc_id").isNull().alias("x"), "doc_id", "row_key")
    # Of texts with one id by chance (their proofs differ) the one of least proof is the node, the others are alone.
    one = signed.where("node is not null").groupBy("node", "proof").agg(F.first("keys").alias("keys"), F.first("frequencies").alias("frequencies"), F.min(who).alias("first"))
    one = one.groupBy("node").agg(F.min_by(F.struct("proof", "keys", "frequencies", "first"), "proof").alias("o")).select("node", "o.*")
    one = Staged(one, "nodes")
    members = one.df.select(F.explode("keys").alias("bucket"), "node")
    multi = members.groupBy("bucket").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo <> hi").select("bucket")
    members = Staged(members.join(multi, "bucket"), "members")
    wanted = Staged(one.df.join(members.df.select("node").distinct(), "node", "left_semi").select("node", F.col("first.row_key").alias("row_key"), F.col("first.doc_id").alias("doc_id"), "frequencies"), "wanted")

    bits, length = bloom_bits(wanted.df, "row_key")
    filter_ = spark.sparkContext.broadcast((bits, length))

    def maybe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, length = filter_.value
        for batch in batches:
            yield batch.filter(pa.array(bloom_has(bits, length, batch.column("row_key").to_numpy())))

    held = map_arrow(keyed, maybe, f"row_key bigint, doc_id {kind.simpleString()}, text string").alias("a")
    both = held.join(wanted.df.alias("b"), (F.col("a.row_key") == F.col("b.row_key")) & F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")))
    texts = Staged(
        both.groupBy("node").agg(F.first("text").alias("text"), F.first("frequencies").alias("f"))
        .select("node", F.expr("concat(unhex(lpad(hex(length(f)), 8, '0')), f, cast(text as binary))").alias("text")),
        "texts",
    )

    found = classes(members.df, texts.df, weighted_elements(documents, size), similar, "near", plain=plain)
    named = stage(one.df.select("node", "proof", "first").join(found, "node", "left").withColumn("component", F.coalesce("component", "node")), "named")
    best = named.groupBy("component").agg(F.min("first").alias("best"))
    by_node = named.join(best, "component").select("node", "proof", F.col("best.doc_id").alias("class_id"), F.col("best.row_key").alias("best"), F.lit(True).alias("hit"))
    for x in (one, members, wanted, texts):
        x.drop()
    return signed.join(by_node, ["node", "proof"], "left").select(
        "row_key", "doc_id", F.when(F.col("hit"), F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
        (F.col("hit").isNull() | ((F.col("row_key") == F.col("best")) & F.col("doc_id").eqNullSafe(F.col("class_id")))).alias("kept"),
    )


def near_duplicates(docs: DataFrame, plain: bool = False) -> DataFrame:
    """doc_id, class_id, kept of every row, as ``near_classes`` has them: null, wordless and empty texts are alone, repeated rows alike."""
    return near_classes(docs, plain=plain).select("doc_id", "class_id", "kept")


def keep_one_of_each(docs: DataFrame, similar: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` that are first of their near-duplicate class, with all their columns.

    Of rows that repeat both doc_id and text, one stays. Wordless and null texts stay. An empty table stays empty.
    """
    found = stage(near_classes(docs, similar), "classes")
    name, key, ident = (free_name(docs, c) for c in ("_row_key", "_kept_key", "_kept_id"))
    keep = found.where("kept").select(F.col("row_key").alias(key), F.col("doc_id").alias(ident)).distinct()
    named = docs.withColumn(name, F.xxhash64(F.col("doc_id"), F.coalesce(F.col("text"), F.lit(""))))
    out = named.join(keep, (F.col(name) == F.col(key)) & F.col("doc_id").eqNullSafe(F.col(ident)), "left_semi")
    if found.groupBy("row_key", "doc_id").count().where("count > 1").isEmpty():
        return out.drop(name)
    return out.dropDuplicates([name, "doc_id"]).drop(name)
