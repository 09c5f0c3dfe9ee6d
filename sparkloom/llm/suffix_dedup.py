"""Repeated byte strings, found by merging shard Burrows-Wheeler transforms.

A byte is removed when a string of 50 bytes that covers it also starts in a document with a smaller id.

The suffixes that matter are first brought together. The 50 bytes from any place on contain a minimiser, the
24-byte string of least hash among the 27 they hold, so equal strings have equal minimisers. The places
whose strings share one minimiser form a run; runs whose minimiser occurs in one document only hold no
repeated string. The bytes of the other runs (their context) are dealt out by minimiser. Contexts with the same
bytes are one, with the documents that hold them: a transform of copies would have nothing but intervals of all
copies. Where a minimiser has different contexts, these are cut into shards, each shard gets its
transform, and the transforms are merged by iterative interleave refinement (Holt and McMillan): the order
of the suffixes by their first j bytes gives the order by j + 1, and the blocks that are still together
after j rounds are those with a common prefix of j bytes. Blocks left after 50 rounds are the repeated
intervals; the suffixes are never sorted again.

Texts lie in numbered blocks. What a block asks and what it is told are arrays in an order that both sides know, so
ids and places don't travel, and rows are as many as blocks times parts at most.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkloom.llm.shared import Staged, chunks, group_arrow, map_arrow, mix, partitions_for, span_hashes
from sparkloom.shipping import ship

#: Bytes of a repeated string, and of the string whose hash picks the minimiser.
LENGTH, GRAM = 50, 24
#: Bytes of contexts in a shard, and in the shards that are merged together (more only for one minimiser alone).
SHARD, MERGE = 1 << 17, 1 << 20
#: Bytes of text of a block, and runs of a minimiser from which its strings are dealt out one by one.
BLOCK, HEAVY = 8 << 20, 4096
#: Strings of hot minimisers that a block holds at once.
STRINGS = 1 << 17
#: Bytes that one task gets when runs and contexts are dealt out, on average.
PART = 12 << 20
#: Bytes of a context and what goes with it, on average.
CONTEXT = 96
LAST = (1 << 63) - 1  # order of a null id


# ---------------------------------------------------------------- runs


def runs(data: np.ndarray, at: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash of the minimiser, document, first place, number of places) of every run of every document.

    Places are relative to the document. The documents' bytes are ``data[at[i]:at[i + 1]]``.
    """
    window = length - gram + 1
    n = len(data) - length + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none.view(np.uint64), none, none, none
    data = np.ascontiguousarray(data)
    m = len(data) - gram + 1
    word = lambda k: np.ndarray((m,), "<u8", buffer=data, offset=k, strides=(1,))
    h = word(0) * np.uint64(0x9E3779B97F4A7C15)
    for k in (*range(8, gram - 8, 8), gram - 8):
        h ^= h >> np.uint64(29)
        h += word(k)
        h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    low = np.uint64(127)
    # Of equal hashes the place in the document, modulo 128, decides, whatever stands before the document.
    doc = np.repeat(np.arange(len(at) - 1), np.diff(at))
    own = np.arange(len(data)) - at[doc]
    least = (h & ~low) | (own[:m].astype(np.uint64) & low)
    width = 1
    while width * 2 <= window:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < window:
        least = np.minimum(least[: len(least) - (window - width)], least[window - width :])
    start = np.arange(n)
    place = start + (((least[:n] & low).astype(np.int64) - own[:n]) & 127)
    doc = doc[:n]
    inside = start + length <= at[1:][doc]
    cut = np.ones(n + 1, bool)
    cut[1:n] = (place[1:] != place[:-1]) | (doc[1:] != doc[:-1]) | (inside[1:] != inside[:-1])
    first = np.flatnonzero(cut)
    first, many = first[:-1], np.diff(first)
    ok = inside[first]
    first, many = first[ok], many[ok]
    # The least of several hashes is small: mixed again, they spread evenly.
    return mix(h[place[first]]), doc[first], first - at[doc[first]], many


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... for each start, as many as its size."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes) + np.repeat(starts, sizes)


def context_hashes(data: np.ndarray, start: np.ndarray, size: np.ndarray, block: int = 1 << 19) -> np.ndarray:
    """``span_hashes`` of contexts, about ``block`` bytes of them at a time, so that its arrays stay small."""
    out = np.zeros(len(start), np.uint64)
    ends = np.cumsum(size, dtype=np.int64)
    lo = 0
    while lo < len(start):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + block)))
        n = size[lo:hi].astype(np.int64)
        at = np.concatenate((np.zeros(1, np.int64), np.cumsum(n)))
        out[lo:hi] = span_hashes(data[_ragged(start[lo:hi], n)], at[:-1], at[1:])
        lo = hi
    return out


# ---------------------------------------------------------------- transforms


class Shard:
    """Suffixes of some contexts in the order of their first ``depth`` bytes, and the byte before each.

    Symbols are bytes plus 1; 0 ends a context, and comes before its first byte. ``back`` is the row of the suffix
    that starts one symbol before (the LF mapping).
    """

    def __init__(self, data: np.ndarray, at: np.ndarray, depth: int = LENGTH):
        self.size = len(data) + len(at) - 1
        symbols = np.zeros(self.size, np.uint16)
        context = np.repeat(np.arange(len(at) - 1), np.diff(at))
        symbols[np.arange(len(data)) + context] = data.astype(np.uint16) + 1
        end = np.flatnonzero(symbols == 0)
        left = np.repeat(end, np.diff(end, prepend=-1)) - np.arange(self.size)  # bytes up to the end

        def ahead(x: np.ndarray, k: int) -> np.ndarray:
            out = np.zeros(self.size, np.int64)
            out[:-k] = x[k:]
            out[left < k] = 0
            return out

        # Seven symbols of nine bits are one number; then twice as many a step.
        key = symbols.astype(np.int64)
        key = key << 9 | ahead(key, 1)
        key = key << 18 | ahead(key, 2)
        key = key << 27 | ahead(key >> 9, 4)
        k = 7
        while True:
            self.order = np.argsort(key)
            key = key[self.order]
            step = np.concatenate(([0], np.cumsum(key[1:] != key[:-1])))
            if k >= depth or step[-1] == self.size - 1:
                break
            rank = np.empty(self.size, np.int64)
            rank[self.order] = step
            key = rank * (self.size + 1) + ahead(rank + 1, k)
            k *= 2
        row = np.empty(self.size, np.int64)
        row[self.order] = np.arange(self.size)
        self.bwt, self.back = np.roll(symbols, 1)[self.order], row[self.order - 1]
        self.bwt[row[0]] = 0


def merge(shards: list[Shard], row: np.ndarray, block: np.ndarray, depth: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(row, block) of suffixes that ``depth`` symbols lead to from the rows given; a block's suffixes share these symbols and their first block.

    Rows are numbered through the shards, and given in the order of their blocks. Interleave refinement: if the rows are in
    order by their first j symbols, then dealing them stably by the symbol before each row gives the order by j + 1 of the
    rows reached that way. A block of one row is settled, and a row before which its context starts leads nowhere: both leave.
    """
    first = np.cumsum([0, *(s.size for s in shards)])
    bwt = np.concatenate([s.bwt for s in shards])
    back = np.concatenate([s.back + a for s, a in zip(shards, first, strict=False)])
    for _ in range(depth):
        symbol = bwt[row]
        order = np.argsort(symbol, kind="stable")
        order = order[np.searchsorted(symbol[order], 1) :]
        old, symbol = block[order], symbol[order]
        new = np.concatenate(([True], (symbol[1:] != symbol[:-1]) | (old[1:] != old[:-1])))[: len(order)]
        alone = new & np.append(new[1:], True)[: len(order)]
        row, block = back[row[order[~alone]]], np.cumsum(new[~alone])
    return row, block


def repeated(data: np.ndarray, at: np.ndarray, doc: np.ndarray, length: int = LENGTH, shard: int = SHARD, group: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(context, place) of the strings of ``length`` that also start in a context of a smaller document.

    Contexts of different numbers in ``group``, which rise, share no string.
    """
    cuts = [0]
    for i in range(1, len(at) - 1):
        if at[i + 1] - at[cuts[-1]] > shard:
            cuts.append(i)
    cuts.append(len(at) - 1)
    shards = [Shard(data[at[a] : at[b]], at[a : b + 1] - at[a], length) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    first = np.cumsum([0, *(s.size for s in shards)])
    suffix = np.concatenate([s.order + a for s, a in zip(shards, first, strict=False)])  # by row: its place in all symbols
    context = np.repeat(np.arange(len(at) - 1), np.diff(at) + 1)
    place = np.arange(len(suffix)) - (at[:-1] + np.arange(len(at) - 1))[context]
    # A string is reached from the suffix after it.
    row = np.flatnonzero((place >= length)[suffix])
    block = np.zeros(len(row), np.int64) if group is None else group[context[suffix[row]]]
    by = np.argsort(block, kind="stable")
    row, block = merge(shards, row[by], block[by], length)
    if not len(block):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    context, place = context[suffix[row]], place[suffix[row]]
    start = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1])))
    least = np.repeat(np.minimum.reduceat(doc[context], start), np.diff(np.append(start, len(block))))
    gone = least < doc[context]
    return context[gone], place[gone]


# ---------------------------------------------------------------- the operator


def _numbers(x: bytes, kind: type) -> np.ndarray:
    """The inverse of ``_planes``."""
    size = np.dtype(kind).itemsize
    out = np.empty((len(x) // size, size), np.uint8)
    for k, plane in enumerate(np.frombuffer(x, np.uint8).reshape(size, -1)):
        out[:, k] = plane
    return out.reshape(-1).view(kind)


def _planes(x: np.ndarray) -> bytes:
    """Numbers by planes of bytes, so that the high ones, mostly zero, take no room once compressed."""
    return np.ascontiguousarray(np.ascontiguousarray(x).view(np.uint8).reshape(-1, x.itemsize).T).tobytes()


_codecs: dict[int, zstandard.ZstdCompressor] = {}


def _squeeze(x: bytes, level: int = 1) -> bytes:
    if level not in _codecs:
        _codecs[level] = zstandard.ZstdCompressor(level=level)
    return _codecs[level].compress(x)


def _full(x: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(x)


def _pack(*columns: np.ndarray) -> bytes:
    """Columns of numbers in one: rows are as many as blocks times parts, so each should be cheap."""
    return _squeeze(np.array([len(x) for x in columns], np.int64).tobytes() + b"".join(_planes(x) for x in columns))


def _unpack(x: bytes, *kinds: type) -> list[np.ndarray]:
    """The columns of ``_pack``."""
    x, out = _full(x), []
    begin = 8 * len(kinds)
    for n, kind in zip(np.frombuffer(x, np.int64, len(kinds)).tolist(), kinds, strict=True):
        end = begin + n * np.dtype(kind).itemsize
        out.append(_numbers(x[begin:end], kind))
        begin = end
    return out


def _table(columns: list, names: list[str], kinds: list[pa.DataType]) -> pa.Table:
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _all(table: pa.Table, name: str, *kinds: type) -> list[np.ndarray]:
    """The columns of all packed values of a column, each as one array."""
    rows = [_unpack(x, *kinds) for x in table.column(name).to_pylist()]
    return [np.concatenate([np.zeros(0, kind), *(r[k] for r in rows)]) for k, kind in enumerate(kinds)]


def _bits(parts: int) -> int:
    """Parts are powers of two, so that the high bits of a key are its part."""
    return max(1, (parts - 1).bit_length())


def _cuts(keys: np.ndarray, bits: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """The part of each of the rising keys, and (part, from, to) of those that have some."""
    part = (keys >> np.uint64(64 - bits)).astype(np.int64)
    edge = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1], [True]))) if len(part) else np.zeros(1, np.int64)
    return part, [(int(part[a]), int(a), int(b)) for a, b in zip(edge[:-1], edge[1:], strict=True)]


def blocked(docs: DataFrame) -> Staged:
    """(block, ids, docs, sizes, texts): a row for each block of about BLOCK bytes of text, written.

    ids are the doc_ids, docs their order (null ids last), sizes the lengths in bytes of the texts, which
    are compressed together. Null texts are empty.
    """
    if not isinstance(docs.schema["doc_id"].dataType, T.IntegralType):
        raise TypeError("doc_id must be a whole number: repeats are judged by its order")
    kind = docs.schema["doc_id"].dataType.simpleString()
    text = F.coalesce(F.col("text").cast("binary"), F.lit("").cast("binary"))
    rows = docs.select("doc_id", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST)).alias("doc"), text.alias("text"))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in chunks(batch, most=BLOCK):
                texts, ids = part.column("text").to_pylist(), part.column("doc_id")
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([n], pa.int64()), pa.array([ids.to_pylist()], pa.list_(ids.type)), pa.array([part.column("doc").to_pylist()], pa.list_(pa.int64())),
                        pa.array([[len(t) for t in texts]], pa.list_(pa.int64())), pa.array([_squeeze(b"".join(texts), 3)], pa.binary()),
                    ],
                    ["block", "ids", "docs", "sizes", "texts"],
                )
                n += 1

    return Staged(map_arrow(rows, number, f"block bigint, ids array<{kind}>, docs array<bigint>, sizes array<bigint>, texts binary"), "suffix-blocks")


def _block(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, where each text starts and one more, order of each text's id)."""
    at = np.concatenate((np.zeros(1, np.int64), np.cumsum(np.array(row["sizes"], np.int64))))
    return np.frombuffer(_full(row["texts"]), np.uint8), at, np.array(row["docs"], np.int64)


def block_runs(data: np.ndarray, at: np.ndarray, length: int, gram: int, most: int = 1 << 18) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``runs`` of a block, about ``most`` bytes at a time; a longer text goes in slices that overlap, so a run may be cut there."""
    held = []
    lo, n = 0, len(at) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + most, "right")) - 1)
        if at[hi] - at[lo] <= 2 * most:
            h, row, first, many = runs(data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo], length, gram)
            held.append((h, row + lo, first, many))
        else:  # one long text
            for start in range(0, int(at[hi] - at[lo]), most):
                piece = data[at[lo] + start : min(at[lo] + start + most + length - 1, at[hi])]
                h, row, first, many = runs(piece, np.array([0, len(piece)]), length, gram)
                held.append((h, row + lo, first + start, many))
        lo = hi
    return tuple(np.concatenate(x) for x in zip(*held, strict=True)) if held else (np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3)


def _by_minimiser(h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order of the runs by minimiser, where each distinct one starts in it, runs of each)."""
    order = np.argsort(h, kind="stable")
    new = np.flatnonzero(np.concatenate(([True], h[order][1:] != h[order][:-1]))[: len(h)])
    return order, new, np.diff(np.append(new, len(h)))


def distinct(data: np.ndarray, start: np.ndarray, size: np.ndarray, key: np.ndarray, doc: np.ndarray, block: int = 1 << 19) -> tuple[np.ndarray, np.ndarray]:
    """(order by key, context and document; whether each is the first of its context in that order).

    Hashes only bring equal contexts together; contexts are equal when their bytes are.
    """
    same = context_hashes(data, start, size)
    by = np.lexsort((doc, size, same, key))
    k, s, n, at = key[by], same[by], size[by], start[by]
    new = np.ones(len(by), bool)
    new[1:] = (k[1:] != k[:-1]) | (s[1:] != s[:-1]) | (n[1:] != n[:-1])
    maybe = np.flatnonzero(~new)
    ends = np.cumsum(n[maybe], dtype=np.int64)
    lo = 0
    while lo < len(maybe):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + block)))
        i = maybe[lo:hi]
        unlike = data[_ragged(at[i], n[i])] != data[_ragged(at[i - 1], n[i])]
        new[i] = np.logical_or.reduceat(unlike, np.cumsum(n[i]) - n[i])
        lo = hi
    return by, new


#: Row, start and end of spans.
SPANS = (np.int32, np.int32, np.int32)


def _spans(row: np.ndarray, start: np.ndarray, end: np.ndarray) -> bytes:
    return _pack(*(x.astype(k) for x, k in zip(union(row, start, end), SPANS, strict=True)))


def removals(blocks: DataFrame, length: int = LENGTH, gram: int = GRAM, heavy: int = HEAVY) -> DataFrame:
    """(block, spans): what the texts of each block lose, packed; spans may overlap between rows of the result.

    Blocks tell each part the minimisers they hold; parts answer, in the order in which they were asked, which
    ones several documents hold. Blocks then send the contexts of those, one copy of each, to the part of the
    minimiser, which answers with the bytes to remove. A minimiser of more than ``heavy`` runs is
    split: its strings go one by one to the parts of their own hashes.
    """
    spark = blocks.sparkSession
    ship(spark)
    size = blocks.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("bigint"), lambda a, x: a + x))).first()[0] or 0
    bits = _bits(partitions_for(spark, -(-size // 14 * 8 // PART)))
    names, kinds = ["part", "block", "low", "many"], [pa.int32(), pa.int64(), pa.binary(), pa.binary()]

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                data, at, docs = _block(r)
                h, row, _, _ = block_runs(data, at, length, gram)
                order, new, many = _by_minimiser(h)
                doc = docs[row[order]]
                several = np.minimum.reduceat(doc, new) != np.maximum.reduceat(doc, new) if len(new) else np.zeros(0, bool)
                own = h[order][new]
                low = ((own << np.uint64(bits)) >> np.uint64(32)).astype(np.uint32)
                many = (np.minimum(many, 0x7FFF) | (several * 0x8000)).astype(np.uint16)
                _, cuts = _cuts(own, bits)
                rows = [(p, r["block"], _planes(np.diff(low[a:b], prepend=np.uint32(0))), _planes(many[a:b])) for p, a, b in cuts]
                if rows:
                    yield _table(list(zip(*rows, strict=True)), names, kinds).to_batches()[0]

    def meet(table: pa.Table) -> pa.Table:
        asked = [np.cumsum(_numbers(x, np.uint32), dtype=np.uint32) for x in table.column("low").to_pylist()]
        many = np.concatenate([_numbers(x, np.uint16) for x in table.column("many").to_pylist()])
        low = np.concatenate(asked)
        order = np.argsort(low, kind="stable")
        new = np.flatnonzero(np.concatenate(([True], low[order][1:] != low[order][:-1])))
        blocks_ = np.diff(np.append(new, len(low)))
        total = np.add.reduceat((many & 0x7FFF)[order].astype(np.int64), new)
        several = np.bitwise_or.reduceat(many[order], new) >= 0x8000
        state = np.empty(len(low), np.uint8)
        state[order] = np.repeat(np.where((blocks_ > 1) | several, np.where(total > heavy, 2, 1), 0).astype(np.uint8), blocks_)
        ends = np.cumsum([len(x) for x in asked])
        mine = [slice(b - len(x), b) for x, b in zip(asked, ends, strict=True)]
        return _table(
            [table.column("block").to_pylist(), table.column("part").to_pylist(), [_squeeze(state[s].tobytes()) for s in mine]],
            ["block", "part", "state"], [pa.int64(), pa.int32(), pa.binary()],
        )

    sent = map_arrow(blocks.select("block", "docs", "sizes", "texts"), ask, "part int, block bigint, low binary, many binary")
    answers = group_arrow(sent, "part", meet, "block bigint, part int, state binary")
    # At most every run is asked for; half of them is a great deal.
    wide = _bits(partitions_for(spark, -(-size // 28 * CONTEXT // PART)))
    # Contexts: rising keys, orders of documents, sizes, places of each, rows and places. Spans: what is lost already.
    fields, types = ["part", "block", "contexts", "bytes", "spans"], [pa.int32(), pa.int64(), *[pa.binary()] * 3]
    numbers = (np.uint64, np.int64, *[np.int32] * 4)

    def send(block: pa.Table, answer: pa.Table) -> pa.Table:
        out = []
        by_part = sorted(zip(answer.column("part").to_pylist(), answer.column("state").to_pylist(), strict=True))
        for r in block.to_pylist():
            data, at, docs = _block(r)
            h, row, first, many = block_runs(data, at, length, gram)
            order, _, times = _by_minimiser(h)
            states = np.concatenate([np.zeros(0, np.uint8), *(np.frombuffer(_full(x), np.uint8) for _, x in by_part)])
            state = np.empty(len(h), np.uint8)
            state[order] = np.repeat(states, times)
            use = np.flatnonzero(state > 0)
            h, row, first, size, state = h[use], row[use], first[use], many[use] + length - 1, state[use]
            by, new = distinct(data, at[row] + first, size, h, docs[row])
            h, row, first, size, state = (x[by] for x in (h, row, first, size, state))
            start, doc = at[row] + first, docs[row]
            lead = np.flatnonzero(new)
            of = np.cumsum(new) - 1
            # Later documents here lose all of theirs at once; one copy of each context goes on, with its places in its first document.
            late = doc > doc[lead][of] if len(lead) else np.zeros(0, bool)
            gone = [(row[late], first[late], first[late] + size[late])]
            early = np.flatnonzero(~late)
            where = np.searchsorted(of[early], np.arange(len(lead) + 1))

            # What waits to be sent: key, document, start and size of contexts, how often they occur, and where.
            held: list[tuple[np.ndarray, ...]] = []

            def emit(block: int) -> None:
                key, doc, start, size, times, row, first = (np.concatenate(x) for x in zip(*held, strict=True))
                held.clear()
                by = np.argsort(key, kind="stable")
                who = _ragged((np.cumsum(times) - times)[by], times[by])
                key, doc, start, size, times, row, first = key[by], doc[by], start[by], size[by].astype(np.int32), times[by].astype(np.int32), row[who].astype(np.int32), first[who].astype(np.int32)
                ends = np.concatenate((np.zeros(1, np.int64), np.cumsum(times)))
                for p, a, b in _cuts(key, wide)[1]:
                    who = slice(ends[a], ends[b])
                    packed = _pack(np.diff(key[a:b], prepend=np.uint64(0)), doc[a:b], size[a:b], times[a:b], row[who], first[who])
                    out.append((p, block, packed, _squeeze(data[_ragged(start[a:b], size[a:b])].tobytes(), 4), None))

            some = np.flatnonzero(state[lead] == 1)
            times = where[some + 1] - where[some]
            who = early[_ragged(where[some], times)]
            held.append((h[lead[some]], doc[lead[some]], start[lead[some]], size[lead[some]], times, row[who], first[who]))
            # Of hot minimisers the strings go one by one, by their own hash; some at a time, whole minimisers as a rule.
            hot = np.flatnonzero(state[lead] == 2)
            weight = np.cumsum(size[lead[hot]] - length + 1)
            lo = 0
            while lo < len(hot):
                hi = max(lo + 1, int(np.searchsorted(weight, (weight[lo - 1] if lo else 0) + STRINGS)))
                own = lead[hot[lo:hi]]
                each = size[own] - length + 1
                context = np.repeat(hot[lo:hi], each)
                place = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
                from_, its = start[lead[context]] + place, doc[lead[context]]
                width = np.full(len(context), length)
                key = mix(context_hashes(data, from_, width) + np.uint64(1))
                by, new = distinct(data, from_, width, key, its)
                key, context, place, from_, its = (x[by] for x in (key, context, place, from_, its))
                head = np.flatnonzero(new)
                string = np.cumsum(new) - 1
                n = where[context + 1] - where[context]
                after = its > its[head][string]
                who = early[_ragged(where[context[after]], n[after])]
                begin = first[who] + np.repeat(place[after], n[after])
                gone.append((row[who], begin, begin + length))
                on = np.flatnonzero(~after)
                who = early[_ragged(where[context[on]], n[on])]
                times = np.bincount(string[on], n[on], len(head)).astype(np.int64)
                held.append((key[head], its[head], from_[head], width[: len(head)], times, row[who], first[who] + np.repeat(place[on], n[on])))
                emit(r["block"])
                lo = hi
            if held:
                emit(r["block"])
            out.append((zlib.crc32(str(r["block"]).encode()) % (1 << wide), r["block"], None, None, _spans(*(np.concatenate(x) for x in zip(*gone, strict=True)))))
        return _table(list(zip(*out, strict=True)) if out else [[] for _ in fields], fields, types)

    def settle(table: pa.Table) -> pa.Table:
        direct = table.filter(pc.is_valid(table.column("spans")))
        out = [direct.column(c).to_pylist() for c in ("block", "spans")]
        table = table.filter(pc.is_valid(table.column("contexts")))
        if table.num_rows:
            sent = [_unpack(x, *numbers) for x in table.column("contexts").to_pylist()]
            data = np.frombuffer(b"".join(_full(x) for x in table.column("bytes").to_pylist()), np.uint8)
            key = np.concatenate([np.cumsum(x[0], dtype=np.uint64) for x in sent])
            sender = np.repeat(np.arange(len(sent)), [len(x[0]) for x in sent])
            doc, size, times, row, first = (np.concatenate([x[k] for x in sent]) for k in range(1, 6))
            del sent
            size, times, row, first = (x.astype(np.int64) for x in (size, times, row, first))
            start, place_of = np.cumsum(size) - size, np.cumsum(times) - times
            by, new = distinct(data, start, size, key, doc)
            lead = np.flatnonzero(new)  # in order: the first sender of each context has its least document
            of = np.cumsum(new) - 1
            late = doc[by] > doc[by[lead]][of]
            gone: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []

            def lose(contexts: np.ndarray, begin: np.ndarray, end: np.ndarray) -> None:
                """Every occurrence of these contexts loses its bytes from ``begin`` to ``end``."""
                n = times[contexts]
                who = _ragged(place_of[contexts], n)
                gone.append((np.repeat(sender[contexts], n), row[who], first[who] + np.repeat(begin, n), first[who] + np.repeat(end, n)))

            lose(by[late], np.zeros(int(late.sum()), np.int64), size[by[late]])
            # Minimisers with several contexts: merge the transforms of their shards.
            anchor = key[by[lead]]
            begin = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
            many = np.diff(np.append(begin, len(anchor)))
            mixed = np.flatnonzero(np.repeat(many > 1, many))
            ids = np.repeat(np.arange(len(begin)), many)[mixed]
            weight = np.cumsum(size[by[lead[mixed]]])
            early = np.flatnonzero(~late)
            by_context = np.searchsorted(of[early], np.arange(len(lead) + 1))
            lo = 0
            while lo < len(mixed):
                hi = max(lo + 1, int(np.searchsorted(weight, (weight[lo - 1] if lo else 0) + MERGE)))
                hi = int(np.searchsorted(ids, ids[hi - 1], "right"))  # whole minimisers; of at most ``heavy`` runs each
                some = by[lead[mixed[lo:hi]]]
                at = np.concatenate((np.zeros(1, np.int64), np.cumsum(size[some])))
                context, place = repeated(data[_ragged(start[some], size[some])], at, doc[some], length, group=ids[lo:hi])
                c = mixed[lo:hi][context]
                n = by_context[c + 1] - by_context[c]
                who = by[early[_ragged(by_context[c], n)]]
                place = np.repeat(place, n)
                lose(who, place, place + length)
                lo = hi
            sender_, row_, a, b = (np.concatenate(x) for x in zip(*gone, strict=True))
            names_ = table.column("block").to_pylist()
            order = np.argsort(sender_, kind="stable")
            edge = np.flatnonzero(np.concatenate(([True], sender_[order][1:] != sender_[order][:-1], [True]))) if len(order) else np.zeros(1, np.int64)
            for x, y in zip(edge[:-1], edge[1:], strict=True):
                mine = order[x:y]
                out[0].append(names_[sender_[mine[0]]])
                out[1].append(_spans(row_[mine], a[mine], b[mine]))
        return _table(out, ["block", "spans"], [pa.int64(), pa.binary()])

    contexts = blocks.select("block", "docs", "sizes", "texts").groupBy("block").cogroup(answers.select("block", "part", "state").groupBy("block")).applyInArrow(send, "part int, block bigint, contexts binary, bytes binary, spans binary")
    return group_arrow(contexts, "part", settle, "block bigint, spans binary")


def union(key: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping or touching spans of each key as one."""
    if not len(key):
        return key, start, end
    by = np.lexsort((start, key))
    key, start, end = key[by], start[by].astype(np.int64), end[by].astype(np.int64)
    # Spans of different keys are kept apart by an offset for each key.
    number = np.concatenate(([0], np.cumsum(key[1:] != key[:-1])))
    gap = int(end.max()) + 2
    s, e = start + number * gap, np.maximum.accumulate(end + number * gap)
    new = np.flatnonzero(np.concatenate(([True], s[1:] > e[:-1])))
    last = np.append(new[1:], len(s)) - 1
    return key[new], start[new], e[last] - number[new] * gap


def without_repeats(docs: DataFrame, texts: bool = True, length: int = LENGTH, gram: int = GRAM, heavy: int = HEAVY) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, starts, ends and (with ``texts``) kept of every row of ``docs``.

    starts and ends are the maximal runs of bytes that the text loses, kept is what remains, as binary. Null
    texts are empty and lose nothing, as do texts shorter than ``length``; null ids come after all others;
    rows with one id, repeated rows too, never remove each other's bytes. Bytes are judged on the input, over whole
    texts of any length. An empty table gives an empty result; other columns of ``docs`` are ignored.
    doc_id must be of a whole-number type, else TypeError.
    """
    blocks = blocked(docs)
    spans = removals(blocks.df, length, gram, heavy)
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "starts", "ends", *["kept"] * texts]

    def cut(block: pa.Table, spans: pa.Table) -> pa.Table:
        out = []
        rows, starts, ends = union(*(x.astype(np.int64) for x in _all(spans, "spans", *SPANS)))
        for k in range(block.num_rows):
            ids, sizes, data = block.column("ids")[k].values, block.column("sizes")[k].as_py(), _full(block.column("texts")[k].as_py())
            at = np.searchsorted(rows, np.arange(len(sizes) + 1))
            held, begin = [], 0
            for i, n in enumerate(sizes):
                text = data[begin : begin + n]
                begin += n
                a, b = starts[at[i] : at[i + 1]].tolist(), ends[at[i] : at[i + 1]].tolist()
                edges = [0, *(x for pair in zip(a, b, strict=True) for x in pair), n]
                kept = b"".join(text[x:y] for x, y in zip(edges[::2], edges[1::2], strict=True)) if a else text
                held.append((n, n - len(kept), len(a), hashlib.sha256(kept).hexdigest(), a, b, *[kept] * texts))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()), *[pa.binary()] * texts]
            out.append(pa.Table.from_arrays([ids, *(pa.array(c, t) for c, t in zip(zip(*held, strict=True), kinds, strict=True))], names))
        return pa.concat_tables(out)

    schema = f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, starts array<int>, ends array<int>" + ", kept binary" * texts
    return blocks.df.groupBy("block").cogroup(spans.groupBy("block")).applyInArrow(cut, schema)


def repeats_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row, as ``without_repeats`` has them."""
    return without_repeats(docs, texts=False).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
