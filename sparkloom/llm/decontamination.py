"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

Texts and benchmark items are compared as words of lower case letters and digits, one blank between.
A window of an item is found in a text when some stretch of the text is within an edit budget of it.
By the q-gram lemma such a stretch shares a least number of q-grams with the window, all within a
band of diagonals; shared q-grams are counted in overlapping bands, and only regions that reach the number
are aligned. Items too short for the lemma to say anything are found whole, word for word, by the hashes of
their words. Texts are read once, in place: nothing is shuffled, whatever a source or an item holds.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.shared import WORD_BYTE, chunks, free_name, joined, map_arrow, word_hashes

#: Length of a window, edits allowed in it, q-gram length, and the bytes from one window's start to the next: with 1 every window of an
#: item is tried, so no passage within the edits is lost wherever it starts.
WINDOW, EDITS, Q, STEP = 100, 8, 10, 1
#: Items shorter than this (in normalised bytes) are sought whole, word for word: with edits, chance would find them.
LEAST = 40
#: Pairs of a place in a text and a place in an item that are held at once.
PAIRS = 1 << 20
#: Windows that are aligned at once.
BATCH = 2048
#: Diagonals of a band besides its overlap.
BAND = 16
#: Benchmark bytes that one broadcast index may hold; larger benchmarks go in blocks, one pass each.
BLOCK = 8 << 20

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def normalised(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """All texts as normalised bytes, a blank after each, and where each starts (one more at the end)."""
    data, at = joined(texts)
    inside = WORD_BYTE[data]
    keep = inside.copy()
    keep[1:] |= inside[:-1]
    keep[at[1:] - 1] = True  # the text's end
    out = np.where(inside, data, np.uint8(32))[keep]
    return out, np.concatenate(([0], np.cumsum(keep)))[at]


def grams(data: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit code of the q bytes (8 to 16) from each position on."""
    n = len(data) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    data = np.ascontiguousarray(data)
    first = np.ndarray((n,), "<u8", buffer=data, strides=(1,))
    last = np.ndarray((n,), "<u8", buffer=data, offset=q - 8, strides=(1,))
    return first * _M1 + last


def edits_and_windows(length: int, window: int = WINDOW, edits: int = EDITS, q: int = Q, step: int = STEP) -> tuple[int, int, int, list[int]]:
    """For an item of a length: window length, edits allowed, least shared q-grams, window starts.

    A shorter item is one window, with edits in proportion, lowered until the lemma asks for a q-gram at least.
    """
    n = min(window, length)
    k = edits * n // window
    while k and n - q + 1 - q * k < 1:
        k -= 1
    return n, k, n - q + 1 - q * k, sorted({*range(0, length - n, step), length - n})


class Index(NamedTuple):
    ids: np.ndarray  # item ids
    data: np.ndarray  # normalised bytes of all items
    at: np.ndarray  # where each item starts
    codes: np.ndarray  # sorted distinct q-gram codes
    first: np.ndarray  # where each code's places start (one more at the end)
    item: np.ndarray  # item of each place
    place: np.ndarray  # position of each place in its item
    table: np.ndarray  # bit table over the codes
    shift: int
    words: np.ndarray  # hashes of all items' words
    word_at: np.ndarray  # where each item's words start (one more at the end)
    short: np.ndarray  # items that are sought whole
    openings: np.ndarray  # hashes of their first words, in order
    opened: np.ndarray  # the item of each opening


def build(items: list[tuple[int, str | None]], q: int = Q, least: int = LEAST) -> Index | None:
    """The q-gram index of the items, and the words of the short ones; items without a word are left out."""
    texts = [t for _, t in items]
    data, at = normalised(texts)
    words, word_at = word_hashes(texts)
    length = np.diff(at) - 1
    # a normalised text may start with blanks; they are part of it on both sides
    use = np.flatnonzero(length >= max(least, q))
    short = np.flatnonzero((length < max(least, q)) & (np.diff(word_at) > 0))
    opened = short[np.argsort(words[word_at[short]], kind="stable")]
    openings = words[word_at[opened]]
    rest = (words, word_at, short, openings, opened)
    ids = np.array([i for i, _ in items])
    if not len(use):
        none = np.zeros(0, np.int64)
        return Index(ids, data, at, none.view(np.uint64), np.zeros(1, np.int64), none, none, np.zeros(2, bool), 63, *rest) if len(short) else None
    code, item, place = [], [], []
    all_codes = grams(data, q)
    for i in use:
        n = length[i] - q + 1
        code.append(all_codes[at[i] : at[i] + n])
        item.append(np.full(n, i))
        place.append(np.arange(n))
    code, item, place = np.concatenate(code), np.concatenate(item), np.concatenate(place)
    order = np.argsort(code, kind="stable")
    codes, first = np.unique(code[order], return_index=True)
    bits = max(12, int(np.ceil(np.log2(len(codes) * 32))))
    table = np.zeros(1 << bits, bool)
    table[(codes * _M2) >> np.uint64(64 - bits)] = True
    return Index(ids, data, at, codes, np.append(first, len(code)), item[order], place[order], table, 64 - bits, *rest)


def align(patterns: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Least edits between each pattern and any stretch of its text, within the band.

    patterns: (c, n) bytes; texts: (c, n + b - 1) bytes, so that diagonals 0 to b - 1 make up the band.
    """
    c, n = patterns.shape
    b = texts.shape[1] - n + 1
    ramp = np.arange(b, dtype=np.int16)
    cost = np.zeros((c, b), np.int16)
    for i in range(n):
        new = cost + (texts[:, i : i + b] != patterns[:, i : i + 1])
        np.minimum(new[:, :-1], cost[:, 1:] + 1, out=new[:, :-1])
        cost = np.minimum.accumulate(new - ramp, axis=1) + ramp
    return cost.min(axis=1)


def whole_items(texts: list[str | None], index: Index) -> set[tuple[int, int]]:
    """(text, item) where all words of a short item stand in the text, one after the other."""
    if not len(index.short):
        return set()
    words, at = word_hashes(texts)
    lo, hi = np.searchsorted(index.openings, words, "left"), np.searchsorted(index.openings, words, "right")
    hit = np.flatnonzero(lo < hi)
    out: set[tuple[int, int]] = set()
    step = max(1, PAIRS // max(1, int((hi - lo).max(initial=1))))
    for a in range(0, len(hit), step):
        some = hit[a : a + step]
        many = hi[some] - lo[some]
        place = np.repeat(some, many)
        item = index.opened[np.repeat(lo[some] - np.cumsum(many) + many, many) + np.arange(many.sum())]
        text = np.searchsorted(at, place, "right") - 1
        size = np.diff(index.word_at)[item]
        ok = place + size <= at[text + 1]
        place, item, text, size = (x[ok] for x in (place, item, text, size))
        for k in range(1, int(size.max(initial=0))):
            far = size > k
            same = np.ones(len(place), bool)
            same[far] = words[place[far] + k] == index.words[index.word_at[item[far]] + k]
            place, item, text, size = (x[same] for x in (place, item, text, size))
        out |= set(zip(text.tolist(), item.tolist(), strict=True))
    return out


def hits(codes: np.ndarray, at: np.ndarray, index: Index, q: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, text, number of the code) of the q-grams of the texts that some item has."""
    hit = np.flatnonzero(index.table[(codes * _M2) >> np.uint64(index.shift)])
    if not len(hit) or not len(index.codes):
        return hit[:0], hit[:0], hit[:0]
    k = np.searchsorted(index.codes, codes[hit])
    k[k == len(index.codes)] = 0
    same = index.codes[k] == codes[hit]
    hit, k = hit[same], k[same]
    text = np.searchsorted(at, hit, "right") - 1
    inside = hit + q < at[text + 1]
    return hit[inside], text[inside], k[inside]


def _slices(hit: np.ndarray, weight: np.ndarray, reach: int) -> Iterator[tuple[int, int, int, int]]:
    """(from, to, first, last): hits from ``from`` to ``to`` that settle the bands which start in places first to last.

    A band's hits lie within ``reach`` of its start, so slices overlap by that; each holds about PAIRS pairs.
    """
    total = np.cumsum(weight)
    lo = 0
    while lo < len(hit):
        hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + PAIRS)))
        hi = int(np.searchsorted(hit, hit[hi - 1] + 1))
        last = int(hit[hi - 1])
        yield int(np.searchsorted(hit, hit[lo] - reach)), int(np.searchsorted(hit, last + reach + 1)), int(hit[lo]), last
        lo = hi


def found(texts: list[str | None], index: Index, window: int = WINDOW, edits: int = EDITS, q: int = Q, step: int = STEP) -> tuple[np.ndarray, np.ndarray, int]:
    """(text, item) pairs where a window of the item is within the edit budget of a stretch of the text; regions aligned.

    Shared q-grams are counted in slices of the hits, so memory doesn't grow with how often a q-gram repeats.
    """
    pairs = whole_items(texts, index)
    data, at = normalised(texts)
    hit, text, code = hits(grams(data, q), at, index, q)
    many = np.diff(index.first)[code] if len(code) else code
    need = least_shared(index, window, edits, q)
    longest = int(np.diff(index.at).max(initial=1))
    aligned = 0
    # A band of 16 diagonals and its overlap: hits of one band lie within the item's length and the band's width of each other.
    for a, z, lo, hi in _slices(hit, many, longest + BAND + edits):
        aligned += _settle(data, at, hit[a:z], text[a:z], code[a:z], many[a:z], lo, hi, index, need, window, edits, q, step, pairs)
    both = np.array(sorted(pairs), np.int64).reshape(-1, 2)
    return both[:, 0], both[:, 1], aligned


def _settle(data, at, hit, text, code, many, lo, hi, index, need, window, edits, q, step, pairs) -> int:
    """Adds to ``pairs`` what the bands that hold a hit in places lo to hi show; returns how many regions were aligned."""
    # Hits outside lo..hi matter for bands that reach inside only; of those, items that have a hit inside.
    places = np.repeat(index.first[code] - np.cumsum(many) + many, many) + np.arange(many.sum())
    item, place = index.item[places].astype(np.int32), index.place[places].astype(np.int32)
    del places
    where, text = np.repeat(hit, many), np.repeat(text, many)
    # Overlapping bands: a hit counts for its own band and, in the overlap, for the one before.
    diagonal = where - at[text] - place + (1 << 40)
    band, over = diagonal // BAND, diagonal % BAND < edits
    own = (where >= lo) & (where <= hi)
    del where, diagonal
    text, item, place, own, band = (np.concatenate((x, x[over])) for x in (text, item, place, own, band))
    band[len(over) :] -= 1
    order = np.lexsort((band, item, text))
    text, item, band, place, own = text[order], item[order], band[order], place[order], own[order]
    new = np.flatnonzero(np.concatenate(([True], (text[1:] != text[:-1]) | (item[1:] != item[:-1]) | (band[1:] != band[:-1])))[: len(text)])
    if not len(new):
        return 0
    count = np.diff(np.append(new, len(text)))
    inside = np.logical_or.reduceat(own, new)
    regions: dict[tuple[int, int], list[tuple[int, int, int, np.ndarray]]] = {}
    for g in np.flatnonzero(inside & (count >= need[item[new]])):
        t, i = int(text[new[g]]), int(item[new[g]])
        if (t, i) in pairs:
            continue
        n, e, least, starts = edits_and_windows(int(index.at[i + 1] - index.at[i] - 1), window, edits, q, step)
        # a q-gram at one place of the item counts once
        places_here = np.unique(place[new[g] : new[g] + count[g]])
        from_ = np.array(starts)
        shared = np.searchsorted(places_here, from_ + n - q + 1) - np.searchsorted(places_here, from_)
        good = np.flatnonzero(shared >= least)
        if len(good):  # the likeliest windows first: once one is found the others needn't be aligned
            first = int(at[t]) + int(band[new[g]] * BAND - (1 << 40)) - e
            regions.setdefault((n, e), []).append((t, i, first, from_[good[np.argsort(-shared[good], kind="stable")]]))
    aligned = 0
    for (n, e), live in sorted(regions.items()):
        turn, turns = 0, 1  # the first window of each region, then several
        while live := [r for r in live if len(r[3]) > turn and (r[0], r[1]) not in pairs]:
            for some in _batches(live, turn, turns):
                some = [r for r in some if (r[0], r[1]) not in pairs]
                if some:
                    cost = align(np.array([index.data[index.at[i] + s : index.at[i] + s + n] for _, i, _, s in some]), np.array([_stretch(data, at, t, first + s, n + BAND + 3 * e + edits) for t, _, first, s in some]))
                    aligned += len(some)
                    pairs |= {(r[0], r[1]) for r, c in zip(some, cost, strict=True) if c <= e}
            turn += turns
            turns = max(1, BATCH // len(live))
    return aligned


def _batches(live: list[tuple[int, int, int, np.ndarray]], turn: int, turns: int) -> Iterator[list[tuple[int, int, int, int]]]:
    """(text, item, first place, window start) of the windows number ``turn`` to ``turn + turns`` of each region, BATCH at once."""
    some: list[tuple[int, int, int, int]] = []
    for t, i, first, starts in live:
        for s in starts[turn : turn + turns].tolist():
            some.append((t, i, first, s))
            if len(some) == BATCH:
                yield some
                some = []
    yield some


def _stretch(data: np.ndarray, at: np.ndarray, text: int, left: int, width: int) -> np.ndarray:
    """The bytes of a text from a place on, zeros outside it."""
    piece = np.zeros(width, np.uint8)
    a, z = max(left, int(at[text])), min(left + width, int(at[text + 1]) - 1)
    if z > a:
        piece[a - left : z - left] = data[a:z]
    return piece


def least_shared(index: Index, window: int = WINDOW, edits: int = EDITS, q: int = Q) -> np.ndarray:
    """For each item, the least q-grams that a window within the edit budget shares."""
    length = np.diff(index.at) - 1
    by = {n: edits_and_windows(n, window, edits, q)[2] for n in set(length.tolist()) if n >= q}
    return np.array([by.get(n, 1 << 30) for n in length.tolist()])


def mark(docs: DataFrame, benchmark: DataFrame, column: str = "benchmark_items", window: int = WINDOW, edits: int = EDITS, q: int = Q, step: int = STEP, least: int = LEAST) -> DataFrame:
    """``docs`` with one more column: the item ids found in the text, in rising order. A column already called so is replaced.

    Null and empty texts have none; so has every text when the benchmark is empty. Items with null text or id, or without
    a word, are never found. Repeated rows are marked alike. All other columns of ``docs`` pass through. Texts
    are read whole. A benchmark of more than BLOCK bytes goes in blocks, with a pass over the texts for each.
    """
    spark = docs.sparkSession
    docs = docs.drop(column)
    items = benchmark.select("item_id", "text").where("item_id is not null and text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK))
    out = docs.withColumn(column, F.array().cast("array<bigint>"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema.fields)
    for b in range(blocks):
        here = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).orderBy("item_id", "text").collect()
        index = build([(r["item_id"], r["text"]) for r in here], q, least) if here else None
        if index is None:
            continue
        shared = spark.sparkContext.broadcast(tuple(index))

        def scan(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = Index(*shared.value)
            for batch in batches:
                for part in chunks(batch):
                    before = part.column(column).to_pylist()
                    text, item, _ = found(part.column("text").to_pylist(), index, window, edits, q, step)
                    for t, i in zip(text.tolist(), item.tolist(), strict=True):
                        before[t] = sorted({*before[t], int(index.ids[i])})
                    yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(before, pa.list_(pa.int64()))], part.schema.names)

        out = map_arrow(out, scan, schema)
    return out


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, contaminated, n_items, item_ids (rising, joined by commas).

    Null and empty texts, and all texts where the benchmark is empty, are clean; repeated rows are alike.
    """
    marked = mark(docs.select("doc_id", "text"), benchmark)
    return marked.select("doc_id", (F.size("benchmark_items") > 0).alias("contaminated"), F.size("benchmark_items").alias("n_items"), F.array_join(F.col("benchmark_items").cast("array<string>"), ",").alias("item_ids"))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no benchmark item is found, with all their columns; null and empty texts stay, repeated rows too."""
    name = free_name(docs, "benchmark_items")
    return mark(docs, benchmark, name).where(F.size(name) == 0).drop(name)
