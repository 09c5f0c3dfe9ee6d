"""A graph of near neighbours, refined by what neighbours know: descent on neighbours of neighbours.

Each vector starts with the nearest of its own block in several dealings round different pivots (``similarity.deal``), so that blocks
overlap. In a round every vector introduces its neighbours, both those it
names and those that name it, to each other; each keeps the best it has met. Rounds end when few edges change. Work is a
constant number of comparisons a vector and round, whatever the size of the table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.operators import similarity
from sparkloom.scratch import Staged

#: Neighbours of each vector, rounds at most, and the share of edges below which changes end the search.
NEIGHBOURS, ROUNDS, STOP = 20, 12, 0.002
#: Vectors of a starting block, about, and dealings.
START, DEALINGS = 2048, 3


def distinct_vectors(vectors: DataFrame) -> DataFrame:
    """(id, vector, copies): the least id of each distinct vector, and all ids that have it where there are several."""
    return vectors.groupBy("vector").agg(F.min("id").alias("id"), F.count("*").alias("copies")).select("id", "vector", "copies")


def _introduced(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """From (ids, fresh, vectors) of those around a vector: for each the best k of the others, where one of the two is fresh."""
    for batch in batches:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for row in range(batch.num_rows):
            ids, fresh = np.array(batch.column("ids")[row].as_py()), batch.column("fresh")[row].values.to_numpy(zero_copy_only=False)
            x = similarity._matrix(batch.column("vectors"), row)
            s = x @ x.T
            s[~(fresh[:, None] | fresh[None, :])] = -np.inf
            s[ids[:, None] == ids[None, :]] = -np.inf
            best = np.argsort(-s, axis=1, kind="stable")[:, :k]
            score = np.take_along_axis(s, best, 1)
            i, j = np.nonzero(score > -np.inf)
            out.append((ids[i], ids[best[i, j]], score[i, j]))
        if out:
            type_ = batch.schema.field("ids").type.value_type
            src, dst, score = (np.concatenate(x) for x in zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(src.tolist(), type_), pa.array(dst.tolist(), type_), pa.array(score)], ["src", "dst", "score"])


def _best(edges: DataFrame, k: int, by: str = "src", other: str = "dst") -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(by).orderBy(F.col("score").desc(), other))
    return edges.withColumn("_rank", rank).where(F.col("_rank") <= k).drop("_rank")


def graph(vectors: DataFrame, k: int = NEIGHBOURS, rounds: int = ROUNDS, stop: float = STOP, start: int = START) -> DataFrame:
    """(src, dst, score): about the ``k`` nearest others of each vector (id, vector; ids unique) by dot product, written.

    Equal vectors should come once (``distinct_vectors``): a group of more than k copies would know only itself.
    """
    kind = vectors.schema["id"].dataType.simpleString()
    schema = f"src {kind}, dst {kind}, score double"
    first = dealt = None
    for seed in range(DEALINGS):
        pivots = similarity.pivots_of(vectors, start * similarity.PER_BLOCK, seed)  # one for each block
        if not len(pivots):
            return vectors.sparkSession.createDataFrame([], schema)
        dealt = similarity.deal(vectors.select("id", "vector"), pivots, start)
        blocks = similarity.Blocks(dealt, pivots).packed
        near = blocks.select("ids", F.transform("ids", lambda _: F.lit(True)).alias("fresh"), "vectors").mapInArrow(lambda b: _introduced(b, k), schema)
        first = near if first is None else first.unionByName(near)
        if blocks.count() == 1:  # everyone has met everyone
            return Staged(_best(first, k), "graph").df
    now = Staged(_best(first.groupBy("src", "dst").agg(F.max("score").alias("score")), k).withColumn("fresh", F.lit(True)), "graph")
    for _ in range(rounds):
        back = _best(now.df.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "score", "fresh"), k)  # of those that name a vector, the nearest k
        around = now.df.unionByName(back).groupBy("src", "dst").agg(F.max("fresh").alias("fresh"))
        met = around.join(dealt.select(F.col("id").alias("dst"), "vector"), "dst").groupBy("src").agg(F.collect_list(F.struct("dst", "fresh", "vector")).alias("all"))
        found = met.select(F.col("all.dst").alias("ids"), F.col("all.fresh").alias("fresh"), F.col("all.vector").alias("vectors")).mapInArrow(lambda b: _introduced(b, k), schema)
        both = now.df.select("src", "dst", "score", F.lit(False).alias("fresh")).unionByName(found.withColumn("fresh", F.lit(True)))
        # an edge that was known isn't fresh
        after = Staged(_best(both.groupBy("src", "dst").agg(F.max("score").alias("score"), F.min("fresh").alias("fresh")), k), "graph")
        counts = after.df.agg(F.count("*").alias("all"), F.count_if("fresh").alias("fresh")).first()
        now.drop()
        now = after
        if counts["fresh"] <= stop * counts["all"]:
            break
    return now.df.drop("fresh")


def exact_links(vectors: DataFrame, threshold: float) -> DataFrame:
    """(src, dst) that hang together what ``threshold`` links, none lost: within pairs of blocks of distinct vectors, and each copy with its first."""
    one = Staged(distinct_vectors(vectors), "distinct").df
    near = similarity.cosine_pairs(one.select("id", "vector"), threshold, forest=True)
    return near.unionByName(_copies(vectors, one, threshold))


def _copies(vectors: DataFrame, one: DataFrame, threshold: float) -> DataFrame:
    again = one.where("copies > 1").select("vector", F.col("id").alias("dst"))
    length = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    return vectors.join(again, "vector").where((F.col("id") != F.col("dst")) & (length >= threshold)).select(F.col("id").alias("src"), "dst")


def links(vectors: DataFrame, threshold: float, k: int = NEIGHBOURS) -> DataFrame:
    """(src, dst): neighbours of the graph at or over the threshold, and each copy of a vector with the first of its copies.

    ``vectors`` has id and vector. Of more than k neighbours over the threshold the nearest k are named, which keeps a dense group
    together; a link is lost where descent misses it (the tests measure how many).
    """
    one = Staged(distinct_vectors(vectors), "distinct").df
    near = graph(one.select("id", "vector"), k).where(F.col("score") >= threshold).select("src", "dst")
    return near.unionByName(_copies(vectors, one, threshold))
