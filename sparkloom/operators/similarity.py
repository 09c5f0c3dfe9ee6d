"""Cosine joins in blocks that angles prune, connected components, and the search for leaks between splits.

Vectors go to the nearest of a bounded number of pivots and, in a large cell, to shells by their angle to it. The triangle
inequality of angles bounds the dot products between two blocks; only pairs of blocks whose bound reaches what is looked for
are joined, and each is one matrix product in numpy. No side is ever broadcast, and memory is two blocks a task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.operators import graph
from sparkloom.scratch import Staged
from sparkloom.shipping import ship

#: Vectors of a block, about.
BLOCK = 2048
#: Pivots at most, and the share of a block that falls to each.
PIVOTS, PER_BLOCK = 4096, 4
#: Angles are known to about this.
SLACK = 1e-6
_CELL = ["pivot", "shell", "part"]


def _flat(column: pa.Array, many: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(many, -1)


def _unit(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    norm = np.linalg.norm(x, axis=1)
    return x / np.where(norm > 0, norm, 1)[:, None], norm


def pivots_of(vectors: DataFrame, size: int = BLOCK, seed: int = 42) -> np.ndarray:
    """Unit vectors of a sample in hash order: PER_BLOCK for each block that the table makes, PIVOTS at most, equal ones once."""
    many = min(PIVOTS, max(1, math.ceil(vectors.count() / size * PER_BLOCK)))
    rows = vectors.orderBy(F.xxhash64(F.col("id"), F.lit(seed)), "id").limit(many).select("vector").collect()
    return np.unique(_unit(np.array([r[0] for r in rows], np.float64).reshape(len(rows), -1))[0], axis=0) if rows else np.zeros((0, 0))


#: Shells of a cell at most; a larger cell is also cut by hash.
SHELLS = 64


def deal(vectors: DataFrame, pivots: np.ndarray, size: int = BLOCK) -> DataFrame:
    """``vectors`` (id, vector and any others), written, with the cell each belongs to (pivot, shell, part), its angle to the pivot and its norm.

    Shells are ranges of angles with about equal numbers of vectors; vectors at one angle are spread over the shells that it spans.
    """
    spark = vectors.sparkSession
    ship(spark)
    names = vectors.columns
    shared = spark.sparkContext.broadcast(pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                unit, norm = _unit(_flat(batch.column("vector"), batch.num_rows))
                cosine = unit @ shared.value.T
                best = np.argmax(cosine, axis=1)
                angle = np.arccos(np.clip(cosine[np.arange(len(best)), best], -1, 1))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(best.astype(np.int32)), pa.array(angle), pa.array(norm)], [*names, "pivot", "angle", "norm"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in vectors.schema.fields)
    placed = Staged(vectors.mapInArrow(run, f"{schema}, pivot int, angle double, norm double"), "placed").df
    cells = placed.groupBy("pivot").agg(F.count("*").alias("_n"), F.percentile_approx("angle", [k / SHELLS for k in range(1, SHELLS)], 1000).alias("_cuts"))
    cells = cells.withColumns({"_shells": F.least(F.lit(SHELLS), F.ceil(F.col("_n") / size)).cast("int"), "_parts": F.ceil(F.col("_n") / (size * SHELLS)).cast("int")})
    both = placed.join(F.broadcast(cells), "pivot")  # at most PIVOTS rows
    below, upto = F.size(F.filter("_cuts", lambda c: c < F.col("angle"))), F.size(F.filter("_cuts", lambda c: c <= F.col("angle")))
    among = below + F.pmod(F.xxhash64("id"), upto - below + 1)
    cell = {"shell": F.floor(among * F.col("_shells") / SHELLS).cast("int"), "part": F.pmod(F.xxhash64("id", F.lit(1)), F.col("_parts")).cast("int")}
    return both.withColumns(cell).select(*names, *_CELL, "angle", "norm")


class Blocks:
    """Dealt vectors gathered by cell, and by ``side`` where given: ``packed`` (ids, vectors, labels) and ``summary`` (angles and norms)."""

    def __init__(self, dealt: DataFrame, pivots: np.ndarray, label: str | None = None, side: str | None = None):
        more = [F.col(label).cast("string").alias("l")] if label else []
        sides = [side] if side else []
        packed = dealt.groupBy(*sides, *_CELL).agg(
            F.collect_list(F.struct(F.col("id").alias("i"), F.col("vector").alias("v"), *more)).alias("rows"), F.min("angle").alias("low"), F.max("angle").alias("high"), F.max("norm").alias("norm"))
        lists = [F.col("rows.i").alias("ids"), F.col("rows.v").alias("vectors"), *(F.col("rows.l").alias("labels") for _ in more)]
        self.packed, self.pivots = Staged(packed.select(*sides, *_CELL, *lists, "low", "high", "norm"), "blocks").df, pivots

    @property
    def summary(self) -> DataFrame:
        return self.packed.select(*_CELL, "low", "high", "norm")

    def of(self, condition: Column) -> Blocks:
        """The blocks whose side fulfils a condition."""
        out = object.__new__(Blocks)
        out.packed, out.pivots = self.packed.where(condition), self.pivots
        return out


def _ends(df: DataFrame, end: str) -> DataFrame:
    return df.select(*(F.col(c).alias(f"{c}_{end}") for c in df.columns))


def _bound(apart: Column, low_a: Column, high_a: Column, low_b: Column, high_b: Column) -> Column:
    """The least angle between a member of one block and one of another, from the angle of their pivots and those to the pivots."""
    least = F.greatest(apart - high_a - high_b, low_a - apart - high_b, low_b - apart - high_a)
    return F.greatest(least - SLACK, F.lit(0.0))


def block_pairs(left: Blocks, right: Blocks, least: float | None, floors: DataFrame | None = None) -> DataFrame:
    """Pairs of blocks whose vectors can have a dot product of ``least`` (of their row in ``floors``, by the left block): keys with _a and _b, and the bound.

    Pairs of cells are sifted first, then their blocks; the pairs of pivots are at most PIVOTS squared rows, made by the tasks.
    """
    spark = left.packed.sparkSession
    shared = spark.sparkContext.broadcast(left.pivots)

    def angles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shared.value
        for batch in batches:
            for k in batch.column("id").to_pylist():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(p), k, np.int32)), pa.array(np.arange(len(p), dtype=np.int32)), pa.array(np.arccos(np.clip(p @ p[k], -1, 1)))], ["pivot_a", "pivot_b", "apart"])

    many = len(left.pivots)
    cells = lambda b, end: _ends(b.summary.groupBy("pivot").agg(F.min("low").alias("least"), F.max("high").alias("most"), F.max("norm").alias("largest")), end)
    wanted = F.lit(float("-inf") if least is None else least)
    dot = lambda angle, a, b: a * b * F.greatest(F.cos(F.least(angle, F.lit(math.pi))), F.lit(0.0)) + SLACK
    pairs = spark.range(0, many, 1, max(1, min(many, 64))).mapInArrow(angles, "pivot_a int, pivot_b int, apart double")
    pairs = pairs.join(F.broadcast(cells(left, "a")), "pivot_a").join(F.broadcast(cells(right, "b")), "pivot_b")
    near = pairs.where(dot(_bound(F.col("apart"), F.col("least_a"), F.col("most_a"), F.col("least_b"), F.col("most_b")), F.col("largest_a"), F.col("largest_b")) >= wanted).select("pivot_a", "pivot_b", "apart")
    both = near.join(_ends(left.summary, "a"), "pivot_a").join(_ends(right.summary, "b"), "pivot_b")
    both = both.withColumn("bound", dot(_bound(F.col("apart"), F.col("low_a"), F.col("high_a"), F.col("low_b"), F.col("high_b")), F.col("norm_a"), F.col("norm_b"))).where(F.col("bound") >= wanted)
    if floors is not None:
        both = both.join(_ends(floors, "a"), [f"{c}_a" for c in _CELL], "left").where(F.col("bound") >= F.coalesce("floor_a", F.lit(float("-inf"))))
    return both.select(*(f"{c}_{end}" for end in "ab" for c in _CELL), "bound")


def _met(pairs: DataFrame, left: Blocks, right: Blocks) -> DataFrame:
    content = lambda b, end: _ends(b.packed.select(*_CELL, *(c for c in b.packed.columns if c in ("ids", "vectors", "labels"))), end)
    return pairs.drop("bound").join(content(left, "a"), [f"{c}_a" for c in _CELL]).join(content(right, "b"), [f"{c}_b" for c in _CELL])


def _matrix(column: pa.Array, row: int) -> np.ndarray:
    """The vectors of a block without a Python object for each number."""
    vectors = column[row].values
    return _flat(vectors, len(vectors))


def _labels(column: pa.Array, row: int) -> np.ndarray:
    return column[row].values.to_numpy(zero_copy_only=False)


def _products(batch: pa.RecordBatch, row: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of both blocks, those of the second in order, and their dot products; -inf where labels are equal."""
    a, b = (np.array(batch.column(c)[row].as_py()) for c in ("ids_a", "ids_b"))
    by = np.argsort(b, kind="stable")
    s = _matrix(batch.column("vectors_a"), row) @ _matrix(batch.column("vectors_b"), row)[by].T
    if "labels_a" in batch.schema.names:
        x, y = (np.array(batch.column(c)[row].as_py(), object) for c in ("labels_a", "labels_b"))
        s[x[:, None] == y[by][None, :]] = -np.inf
    return a, b[by], s


#: A join of a table with itself has so many blocks' worth at most, so that what it moves grows with the table; and vectors of a block at most.
SPREAD, LARGEST = 32, 1 << 17
#: Dot products that are made at once.
PRODUCTS = 1 << 22


def block_size(many: int) -> int:
    """Vectors of a block for a join of a table of so many with itself."""
    return min(LARGEST, max(BLOCK, math.ceil(many / SPREAD)))


def _tiles(batch: pa.RecordBatch, row: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ids of both sides and dot products of a pair of blocks, about PRODUCTS at a time."""
    a, b = (np.array(batch.column(c)[row].as_py()) for c in ("ids_a", "ids_b"))
    x, y = _matrix(batch.column("vectors_a"), row), _matrix(batch.column("vectors_b"), row)
    step = max(1, PRODUCTS // len(b))
    for lo in range(0, len(a), step):
        yield a[lo : lo + step], b, x[lo : lo + step] @ y.T


def cosine_pairs(vectors: DataFrame, threshold: float, size: int | None = None, forest: bool = False) -> DataFrame:
    """(src, dst, score) of all pairs of (id, vector) with a dot product of ``threshold`` or more, src < dst.

    With ``forest`` (src, dst) of as few of these pairs' components: what hangs together within a pair of blocks, by its least id, so that rows
    are no more than the vectors of a pair of blocks. Without ``size`` blocks grow with the table, up to LARGEST.
    """
    kind = vectors.schema["id"].dataType.simpleString()
    if size is None:
        size = block_size(vectors.count())
    pivots = pivots_of(vectors, size)
    table = Blocks(deal(vectors.select("id", "vector"), pivots, size), pivots)
    here, there = (F.struct(*(F.col(f"{c}_{end}").alias(c) for c in _CELL)) for end in "ab")
    pairs = block_pairs(table, table, threshold).withColumn("own", here == there).where(here <= there)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                own, type_ = batch.column("own")[row].as_py(), batch.schema.field("ids_a").type.value_type
                src, dst = (np.zeros(0, np.int64),) * 2
                for a, b, s in _tiles(batch, row):
                    i, j = np.nonzero(s >= threshold)
                    keep = a[i] < b[j] if own else np.ones(len(i), bool)
                    i, j = i[keep], j[keep]
                    lo, hi = np.where(a[i] < b[j], a[i], b[j]), np.where(a[i] < b[j], b[j], a[i])
                    if not forest:
                        yield pa.RecordBatch.from_arrays([pa.array(lo.tolist(), type_), pa.array(hi.tolist(), type_), pa.array(s[i, j])], ["src", "dst", "score"])
                    elif len(lo):
                        src, dst = graph.least_labels(*((np.concatenate((src, lo)), np.concatenate((dst, hi))) if len(src) else (lo, hi)))
                if forest and len(src):
                    more = src != dst
                    yield pa.RecordBatch.from_arrays([pa.array(dst[more].tolist(), type_), pa.array(src[more].tolist(), type_)], ["src", "dst"])

    return _met(pairs, table, table).mapInArrow(run, f"src {kind}, dst {kind}" + ("" if forest else ", score double"))


def meet(pairs: DataFrame, left: Blocks, right: Blocks, top: int, least: float | None) -> DataFrame:
    """(query, reference, score) of the best ``top`` of each vector of the left blocks in each pair of blocks, of those that reach ``least``."""
    kind, other = (b.packed.schema["ids"].dataType.elementType.simpleString() for b in (left, right))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                a, b, s = _products(batch, row)
                best = np.argsort(-s, axis=1, kind="stable")[:, :top] if top > 1 else np.argmax(s, axis=1)[:, None]
                score = np.take_along_axis(s, best, 1)
                i, j = np.nonzero(score >= (np.finfo(float).min if least is None else least))
                yield pa.RecordBatch.from_arrays([pa.array(a[i].tolist(), batch.schema.field("ids_a").type.value_type), pa.array(b[best[i, j]].tolist(), batch.schema.field("ids_b").type.value_type), pa.array(score[i, j])], ["query", "reference", "score"])

    return _met(pairs, left, right).mapInArrow(run, f"query {kind}, reference {other}, score double")


def _can_reach(apart: float, a: tuple[float, float, float], b: tuple[float, float, float], least: float) -> bool:
    """Whether vectors of two blocks, each (least angle to its pivot, largest, largest norm), can have a dot product of ``least``, by the angle of their pivots."""
    angle = max(apart - a[1] - b[1], a[0] - apart - b[1], b[0] - apart - a[1]) - SLACK
    return not a[2] * b[2] * max(math.cos(min(max(angle, 0.0), math.pi)), 0.0) + SLACK < least  # norms that are no numbers rule nothing out


def _links(x: np.ndarray, y: np.ndarray, least: float, norms: tuple[float, float]) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs of rows with a dot product of ``least``; ``norms`` are the largest of both sides. Single precision tells all pairs but those near ``least``."""
    if not all(1e-10 < n < 1e10 for n in norms):
        return np.nonzero(x @ y.T >= least)
    slack = (x.shape[1] + 8) * 2.0**-22 * (norms[0] * norms[1] + abs(least))  # more than rounding can make
    s = (x.astype(np.float32) @ y.astype(np.float32).T).ravel()
    at = np.flatnonzero(s >= np.float32(least - slack))
    i, j = np.divmod(at, len(y))
    near = np.flatnonzero(s[at] < np.float32(least + slack))
    sure = np.ones(len(at), bool)
    for lo in range(0, len(near), 1 << 14):
        k = near[lo : lo + (1 << 14)]
        sure[k] = np.einsum("ij,ij->i", x[i[k]], y[j[k]]) >= least
    return i[sure], j[sure]


def reached(left: Blocks, right: Blocks, least: float, sides: list[tuple[str, str]] | None = None) -> DataFrame:
    """(label, side): labels of the left blocks of which a vector has a dot product of ``least`` with one of another label on that side (split) of the right blocks.

    ``sides`` (left, right) are the pairs of splits to compare, without them all. For whether there is a link, not which: a vector that has reached a side
    isn't compared with it again in its task. No block is shuffled or written anew: each part of the left table reads each part of the right one,
    so the disk that it takes doesn't grow with the pairs of blocks.
    """
    shared = left.packed.sparkSession.sparkContext.broadcast(left.pivots)
    keys = [f"{c}_a" for c in left.packed.columns if c in (*_CELL, "split")]
    a, b = (_ends(x.packed.drop("ids"), end) for x, end in ((left, "a"), (right, "b")))
    b = b.hint("shuffle_replicate_nl")
    both = a.crossJoin(b) if sides is None else a.join(b, reduce(or_, ((F.col("split_a") == x) & (F.col("split_b") == y) for x, y in sides), F.lit(False)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots, own, x, names, unsettled = shared.value, None, None, None, {}
        for batch in batches:
            of = {c: batch.column(c).to_pylist() for c in (*keys, "split_b", "pivot_b", *(f"{c}_{end}" for c in ("low", "high", "norm") for end in "ab"))}
            for row in range(batch.num_rows):
                key, side = tuple(of[c][row] for c in keys), of["split_b"][row]
                if key != own:
                    own, x, names, unsettled = key, _matrix(batch.column("vectors_a"), row), _labels(batch.column("labels_a"), row), {}
                rest = unsettled.get(side, np.arange(len(x)))
                apart = math.acos(min(1.0, max(-1.0, float(pivots[of["pivot_a"][row]] @ pivots[of["pivot_b"][row]]))))
                if not len(rest) or not _can_reach(apart, *(tuple(of[f"{c}_{end}"][row] for c in ("low", "high", "norm")) for end in "ab"), least):
                    continue
                y, others, hit = _matrix(batch.column("vectors_b"), row), _labels(batch.column("labels_b"), row), np.zeros(len(x), bool)
                step = max(1, PRODUCTS // len(y))
                for lo in range(0, len(rest), step):
                    some = rest[lo : lo + step]
                    i, j = _links(x[some], y, least, (of["norm_a"][row], of["norm_b"][row]))
                    hit[some[i[names[some[i]] != others[j]]]] = True
                unsettled[side] = rest[~hit[rest]]
                found = list(dict.fromkeys(names[hit].tolist()))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array([side] * len(found), pa.string())], ["label", "side"])

    return both.mapInArrow(run, "label string, side string").distinct()


def nearest(queries: DataFrame, references: DataFrame, top: int = 1, size: int = BLOCK, least: float | None = None) -> DataFrame:
    """(query, reference, score, rank): the ``top`` references of each query by dot product, ties by least id; with ``least`` those that reach it.

    Without ``least`` a first pass joins blocks of the same cell; from then on a block of queries meets only blocks whose bound reaches
    the score that its weakest query already has at rank ``top``.
    """
    pivots = pivots_of(references, size)
    if not len(pivots):
        kind, other = queries.schema["id"].dataType.simpleString(), references.schema["id"].dataType.simpleString()
        return queries.sparkSession.createDataFrame([], f"query {kind}, reference {other}, score double, rank int")
    q, r = (Blocks(deal(v.select("id", "vector"), pivots, size), pivots) for v in (queries, references))
    if least is not None:
        return _best(meet(block_pairs(q, r, least), q, r, top, least), top)
    same = F.col("pivot_a") == F.col("pivot_b")
    own = Staged(meet(block_pairs(q, r, None).where(same), q, r, top, None), "own").df
    kth = _best(own, top).groupBy("query").agg(F.count("*").alias("many"), F.min("score").alias("kth")).where(F.col("many") >= top)
    reached = q.packed.select(*_CELL, F.explode("ids").alias("query")).join(kth, "query", "left")
    floors = Staged(reached.groupBy(*_CELL).agg(F.min(F.coalesce("kth", F.lit(float("-inf")))).alias("floor")), "floors").df
    return _best(own.unionByName(meet(block_pairs(q, r, None, floors).where(~same), q, r, top, None)), top)


def _best(found: DataFrame, top: int) -> DataFrame:
    """The ``top`` references of each query, with their rank; what can't be among them goes before the shuffle."""
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.col("score").desc(), "reference"))
    return found.withColumn("rank", rank).where(F.col("rank") <= top).select("query", "reference", "score", "rank")


def knn(vectors: DataFrame, top: int = 50, threshold: float = 0.92, index: tuple[int, int] | None = None, seed: int = 5, size: int = 512) -> DataFrame:
    """(query, reference, score, rank) of the ``top`` nearest of each vector (itself among them) that reach the threshold.

    Vectors (id, vector) are normalised by the caller. Without an ``index`` the search is exact, by blocks that angles prune. ``index`` = (bits, tables) deals each vector to a bucket by the signs of ``bits`` random projections, in
    ``tables`` ways, and compares within buckets only: of pairs at cosine c a share 1 - (1 - (1 - acos(c) / pi) ** bits) ** tables
    is found. Every vector is indexed; a large bucket is cut into blocks of which every pair is a row of its own, dealt
    by its blocks; each pair of blocks returns at most ``top`` for each vector.
    """
    if index is None:
        return nearest(vectors, vectors, top, BLOCK, threshold)
    ship(vectors.sparkSession)
    bits, tables = index
    kind = vectors.schema["id"].dataType.simpleString()
    # Equal vectors are one: their ids come back at the end, so a group of copies is compared once.
    own = vectors.withColumn("code", F.xxhash64("vector"))
    one = Staged(own.groupBy("code").agg(F.first("vector").alias("vector"), F.count("*").alias("many")), "vectors").df

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = None
        for batch in batches:
            if not batch.num_rows:
                continue
            flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(batch.num_rows, -1)
            if planes is None:
                planes = np.random.default_rng(seed).normal(size=(flat.shape[1], bits * tables))
            signs = (flat @ planes > 0).reshape(batch.num_rows, tables, bits)
            key = (signs * (1 << np.arange(bits, dtype=np.int64))).sum(axis=2) + (np.arange(tables, dtype=np.int64) << bits)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(batch.column("code").to_numpy(), tables)), pa.array(key.reshape(-1))], ["code", "bucket"])

    members = one.select("code", "vector").mapInArrow(deal, "code bigint, bucket bigint")
    sizes = members.groupBy("bucket").agg(F.count("*").alias("n"))
    dealt = members.join(sizes.where("n > 1"), "bucket").select("bucket", "code", F.pmod(F.xxhash64("code"), F.ceil(F.col("n") / size)).cast("int").alias("block"))
    packed = Staged(dealt.join(one.select("code", "vector"), "code").groupBy("bucket", "block").agg(F.collect_list("code").alias("ids"), F.collect_list("vector").alias("vectors")), "buckets").df
    name = lambda x: packed.select("bucket", *(F.col(c).alias(f"{c}_{x}") for c in ("block", "ids", "vectors")))
    plan = packed.select("bucket", F.col("block").alias("block_a")).join(packed.select("bucket", F.col("block").alias("block_b")), "bucket")
    both = plan.join(name("a"), ["bucket", "block_a"]).join(name("b"), ["bucket", "block_b"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                a, b = (batch.column(c)[row].values.to_numpy() for c in ("ids_a", "ids_b"))
                s = _matrix(batch.column("vectors_a"), row) @ _matrix(batch.column("vectors_b"), row).T
                s[a[:, None] == b[None, :]] = -2  # itself comes back by its code
                best = np.argsort(-s, axis=1, kind="stable")[:, :top]
                score = np.take_along_axis(s, best, 1)
                i, j = np.nonzero(score >= threshold)
                yield pa.RecordBatch.from_arrays([pa.array(a[i]), pa.array(b[best[i, j]]), pa.array(score[i, j])], ["query", "reference", "score"])

    near = both.select("ids_a", "ids_b", "vectors_a", "vectors_b").mapInArrow(compare, "query bigint, reference bigint, score double").distinct()
    itself = one.select(F.col("code").alias("query"), F.col("code").alias("reference"), F.lit(1.0).alias("score"))
    links = _best(near, top).drop("rank").unionByName(itself)
    # Of the ids of a code the first ``top`` can be among the nearest of another.
    ranked = own.select("id", "code").withColumn("rank", F.row_number().over(Window.partitionBy("code").orderBy("id"))).where(F.col("rank") <= top)
    ids = ranked.select(F.col("code").alias("reference"), F.col("id").alias("other"))
    out = own.select(F.col("id").alias("asks"), F.col("code").alias("query")).join(links, "query").join(ids, "reference")
    return _best(out.select(F.col("asks").cast(kind).alias("query"), F.col("other").alias("reference"), "score"), top)


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, component) for all nodes; a component is named by its least node."""
    found = graph.components(edges)
    return nodes.select("id").join(found, F.col("id") == F.col("node"), "left").select("id", F.coalesce("component", "id").alias("component"))


def leaks(assigned: DataFrame, pairs: list[tuple[str, str]], threshold: float) -> DataFrame:
    """(query, reference, score, query_split, reference_split): best matches across splits at or over the threshold.

    ``assigned`` has id, vector and split. The split that isn't train asks; of two others, the second. Vectors are dealt to blocks once for all pairs.
    """
    pivots = pivots_of(assigned)
    return leaks_between(Blocks(deal(assigned.select("id", "vector", "split"), pivots), pivots, side="split"), pairs, threshold)


def leaks_between(blocks: Blocks, pairs: list[tuple[str, str]], threshold: float) -> DataFrame:
    """As ``leaks``, of blocks by split."""
    out = None
    for left, right in pairs:
        ask, answer = (left, right) if right == "train" else (right, left)
        q, r = (blocks.of(F.col("split") == s) for s in (ask, answer))
        found = _best(meet(block_pairs(q, r, threshold), q, r, 1, threshold), 1)
        found = found.select("query", "reference", "score", F.lit(ask).alias("query_split"), F.lit(answer).alias("reference_split"))
        out = found if out is None else out.unionByName(found)
    return out


def cache_problems(cache: DataFrame, key: str = "content_hash", vector: str = "embedding") -> DataFrame:
    """(issue, rows) of a vector cache: repeated or missing keys, vectors of another length than most, numbers that aren't finite."""
    sizes = cache.groupBy(F.size(vector).alias("size")).agg(F.count("*").alias("n"))
    usual = sizes.agg(F.max_by("size", F.struct("n", "size")).alias("usual"))
    shape = cache.crossJoin(F.broadcast(usual)).agg(
        F.count_if(F.col(key).isNull()).alias("missing_key"), F.count_if(~F.size(vector).eqNullSafe(F.col("usual")) | F.col(vector).isNull()).alias("other_length"),
        F.count_if(F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))).alias("not_finite"))
    repeated = cache.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")).where("n > 1").agg(F.count("*").alias("repeated_key"))
    names = ["missing_key", "other_length", "not_finite", "repeated_key"]
    return shape.crossJoin(repeated).select(F.explode(F.array(*(F.struct(F.lit(n).alias("issue"), F.col(n).alias("rows")) for n in names))).alias("p")).select("p.*").where("rows > 0")
