"""Best-fit packing of tokenised documents into sequences of fixed capacity.

Lengths are whole numbers up to the capacity, so the whole instance is a histogram of at most ``capacity``
counts, whatever the number of documents. On it, Martello-Toth dominance fixes the sets that provably
dominate every alternative, the instance shrinks, and the rest is packed best-fit, longest first, in runs
of equal bins. The plan that comes out has a few rows for each length; documents find their place in it
by their rank among those of equal length, which is computed by a distributed prefix sum.
"""

from __future__ import annotations

import json
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.llm.shared import chunks, map_arrow, partitions_for, stage

CAPACITY = 1024
END_ID = 2
#: Pieces that are ranked together, on average.
DEAL = 1 << 19

#: Fixed value: how the byte-level vocabulary splits text before merging.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


# ---------------------------------------------------------------- tokens


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies: itself where printable, else from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def encoder(path: str):
    """text -> ids, by the vocabulary of a byte-level ``tokenizers`` file, as that library gives them without special tokens around.

    In such a file the ids are the merge ranks, so the ranks are all that tiktoken needs; it gives the ids
    that ``tokenizers`` gives, in about a quarter of its time (the tests compare the two). A text that holds the string of an
    added token gets that token's id there. Files whose added tokens take blanks with them, stand for whole words only, or begin alike
    go through ``tokenizers`` itself.
    """
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    back = byte_alphabet()
    added = spec.get("added_tokens", [])
    names = [t["content"] for t in added]
    if any(t.get(flag) for t in added for flag in ("single_word", "lstrip", "rstrip")) or any(x != y and y.startswith(x) for x in names for y in names):
        from tokenizers import Tokenizer

        whole = Tokenizer.from_file(path)
        return lambda text: whole.encode(text, add_special_tokens=False).ids
    special = {t["content"]: t["id"] for t in added}
    ranks = {bytes(back[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
    plain = tiktoken.Encoding("bytes", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=special)
    return lambda text: plain.encode(text, allowed_special="all")


_encoders: dict[str, object] = {}


def tokenise(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids (little-endian unsigned 32-bit, as binary).

    A document is its ids and then ``end_id``; a longer one than ``capacity`` is cut into pieces of exactly
    ``capacity``, but for the first, which has the rest. Null text counts as empty (just ``end_id``).
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _encoders:
            _encoders[path] = encoder(path)
        encode = _encoders[path]
        for batch in batches:
            for part in chunks(batch):
                rows: list[tuple] = []
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                    ids = np.array([*encode(text or ""), end_id], "<u4")
                    n = len(ids)
                    first = (n - 1) % capacity + 1
                    starts = [0, *range(first, n, capacity)]
                    ends = [*starts[1:], n]
                    rows += [(doc_id, k, a, b - a, ids[a:b].tobytes()) for k, (a, b) in enumerate(zip(starts, ends, strict=True))]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (id_type(part), pa.int32(), pa.int64(), pa.int64(), pa.binary()), strict=True)], ["doc_id", "piece", "start", "length", "ids"])

    def id_type(part: pa.RecordBatch) -> pa.DataType:
        return part.schema.field("doc_id").type

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(docs.select("doc_id", "text"), cut, f"doc_id {kind}, piece int, start bigint, length bigint, ids binary")


# ---------------------------------------------------------------- the plan, on the histogram

Run = tuple[tuple[int, ...], int]


def dominance(counts: dict[int, int], capacity: int) -> list[Run]:
    """Martello-Toth reduction: takes sets that dominate every alternative out of ``counts``.

    For an item j, in falling size: if nothing fits beside it, {j} is fixed. If at most one more item
    fits, or one fills the bin exactly, j goes with the largest that fits. If two fit, the largest single
    partner is fixed when it is at least as large as the best pair, and the best pair is when it holds that
    partner and no two items between its members fit instead. Some optimal packing has every fixed set.
    """
    fixed: list[Run] = []
    again = True

    def take(pattern: tuple[int, ...], times: int) -> None:
        for s in pattern:
            counts[s] -= times
            if not counts[s]:
                del counts[s]
        fixed.append((pattern, times))

    while again:
        again = False
        for j in sorted(counts, reverse=True):
            while counts.get(j):
                room = capacity - j
                counts[j] -= 1
                sizes = sorted(s for s, c in counts.items() if c)
                counts[j] += 1
                # how many of the smallest others fit beside j, up to three
                k, left = 0, room
                for s in sizes:
                    n = min(counts[s] - (s == j), left // s, 3 - k)
                    k, left = k + n, left - n * s
                    if k == 3 or n < counts[s] - (s == j):
                        break
                if k == 0:
                    take((j,), counts[j] if 2 * j > capacity else 1)
                    again = True
                    continue
                best = sizes[bisect_right(sizes, room) - 1]
                pair_times = counts[j] // 2 if best == j else min(counts[j], counts[best])
                if k == 1 or best == room:
                    take((j, best), pair_times)
                    again = True
                    continue
                if k > 2:
                    break
                have = {s: counts[s] - (s == j) for s in sizes}
                top = (0, 0)
                for a in sizes[::-1]:
                    if a >= room or 2 * a <= sum(top):
                        if 2 * a <= sum(top):
                            break
                        continue
                    at = bisect_right(sizes, min(a, room - a)) - 1
                    while at >= 0 and sizes[at] == a and have[a] < 2:
                        at -= 1
                    if at >= 0 and a + sizes[at] > sum(top):
                        top = (a, sizes[at])
                a, b = top
                if best >= a + b:
                    take((j, best), pair_times)
                    again = True
                    continue
                if best == a and a > b:
                    between = [s for s in sizes if b < s < a]
                    n = sum(have[s] for s in between)
                    small = [s for s in between[:2] for _ in range(min(2, have[s]))][:2]
                    if n <= 1 or j + sum(small) > capacity:
                        take((j, a, b), min(counts[j] // 2, counts[b]) if a == j else min(counts[j], counts[a], counts[b]) if b != j else min(counts[j] // 2, counts[a]))
                        again = True
                        continue
                break
    return fixed


def best_fit(counts: dict[int, int], capacity: int) -> list[Run]:
    """Best-fit decreasing over a histogram: each item goes to the fullest bin that has room.

    Bins with equal content are one run, so the work depends on the number of lengths, not of items.
    """
    bins: dict[int, list[Run]] = {}
    open_rooms: list[int] = []  # sorted rooms that have bins

    def put(pattern: tuple[int, ...], times: int, room: int) -> None:
        if room not in bins:
            bins[room] = []
            open_rooms.insert(bisect_left(open_rooms, room), room)
        bins[room].append((pattern, times))

    for s in sorted(counts, reverse=True):
        c = counts[s]
        while c:
            at = bisect_left(open_rooms, s)
            room = open_rooms[at] if at < len(open_rooms) else capacity
            if at < len(open_rooms):
                pattern, times = bins[room].pop()
                if not bins[room]:
                    del bins[room]
                    open_rooms.pop(at)
            else:
                pattern, times = (), c
            each = room // s
            full = min(times, c // each)
            if full:
                put(pattern + (s,) * each, full, room - each * s)
                c -= full * each
            if full < times and pattern and c and c < each:
                put(pattern + (s,) * c, 1, room - c * s)
                full, c = full + 1, 0
            elif not pattern and c:
                put((s,) * c, 1, room - c * s)
                c = 0
            if pattern and full < times:
                put(pattern, times - full, room)
    return [run for runs in bins.values() for run in runs]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[Run]:
    """(lengths of the pieces of a sequence, how many such sequences), for all pieces of the histogram."""
    rest = {s: c for s, c in counts.items() if c}
    fixed = dominance(rest, capacity)
    return fixed + best_fit(rest, capacity)


# ---------------------------------------------------------------- placing


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (at least doc_id, piece, length) with sequence_id and offset.

    Sequences are gapless from 0 and hold at most ``capacity``; lengths must lie in 1..capacity. The driver
    gets at most ``capacity`` counts. The table of pieces is staged once, so it is computed once.
    """
    spark = pieces.sparkSession
    pieces = stage(pieces, "pieces")
    many = partitions_for(spark, -(-pieces.count() // DEAL))  # a count from the files' footers
    pieces = pieces.withColumn("_deal", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(many)).cast("int"))
    by = pieces.groupBy("_deal", "length").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in by.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    if any(not 1 <= s <= capacity for s in histogram):
        raise ValueError("a piece is longer than a sequence, or empty")
    runs = plan(histogram, capacity)

    # Where the slots of each length are: from rank `lo` on, sequences from `seq` on, at one offset.
    slots: dict[int, list[tuple[int, int]]] = {}
    seq = 0
    for pattern, times in runs:
        at = 0
        for s in pattern:
            slots.setdefault(s, []).append((seq, times, at))
            at += s
        seq += times
    table = {}
    for s, found in slots.items():
        a = np.array(found, np.int64)
        table[s] = (np.cumsum(a[:, 1]) - a[:, 1], a[:, 0], a[:, 2])
    shared = spark.sparkContext.broadcast(table)

    before = by.withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("_deal").rowsBetween(Window.unboundedPreceding, -1))).select("_deal", "length", "before")
    rank = F.row_number().over(Window.partitionBy("_deal", "length").orderBy("doc_id", "piece")) - 1
    ranked = pieces.withColumn("_rank", rank).join(before, ["_deal", "length"]).withColumn("_rank", F.col("_rank") + F.coalesce("before", F.lit(0))).drop("before", "_deal")
    names = [c for c in pieces.columns if c != "_deal"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, at = batch.column("length").to_numpy(), batch.column("_rank").to_numpy()
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for s in np.unique(length):
                rows = np.flatnonzero(length == s)
                lo, first, where = shared.value[int(s)]
                k = np.searchsorted(lo, at[rows], "right") - 1
                sequence[rows], offset[rows] = first[k] + at[rows] - lo[k], where[k]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    schema = ", ".join(f"`{c}` {pieces.schema[c].dataType.simpleString()}" for c in names)
    return map_arrow(ranked.select(*names, "_rank"), place, f"{schema}, sequence_id bigint, offset bigint")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, length, ids) of ``pack(tokenise(...))``: the sequences themselves, ids joined in order."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), F.aggregate(parts, F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"))


def packed_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of every document.

    Empty and null texts are a piece with just ``end_id``; repeated rows are packed once each; very long
    texts are many pieces; an empty table gives an empty result. Other columns of ``docs`` are ignored.
    """
    pieces = tokenise(docs, path, capacity, end_id).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return pack(pieces, capacity).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
