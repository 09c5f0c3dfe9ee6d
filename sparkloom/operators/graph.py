"""Connected components by contraction."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.scratch import Staged
from sparkloom.shipping import ship

#: Edges that one task settles alone (some 16 bytes each); more are contracted by rounds first.
FEW_EDGES = 1 << 18


def least_labels(src: np.ndarray, dst: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, least node of its component), by hooking roots and halving paths."""
    nodes, place = np.unique(np.concatenate((src, dst)), return_inverse=True)
    a, b = place[: len(src)], place[len(src) :]
    label = np.arange(len(nodes))
    while True:
        x, y = label[a], label[b]
        open_ = x != y
        if not open_.any():
            return nodes, nodes[label]
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (label != label[label]).any():
            label = label[label]


def components(edges: DataFrame, tag: str = "cc", few: int = FEW_EDGES) -> DataFrame:
    """(node, component) for every node that has an edge (src, dst) to another; a component is named by its least node.

    Distributed union-find by contraction: in a round every node moves to the first of its neighbours and
    itself (by value, in every second round by a hash, which bounds the rounds of long chains), edges are
    renamed, and loops and repeated edges go. So a component that has become one node takes no part in
    later rounds, and what remains shrinks. Once ``few`` edges remain one task settles them. The moves of
    the rounds, read backwards, give the components. Everything lies in the scratch folder. Nulls and
    self-loops are ignored.
    """
    ship(edges.sparkSession)
    kind = edges.schema["src"].dataType.simpleString()
    pair = (F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"))
    now = Staged(edges.where("src is not null and dst is not null and src <> dst").select(*pair).distinct(), f"{tag}-edges")
    moves: list[Staged] = []
    mixed = False

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(b.column("src"), b.column("dst")) for b in batches]
        if held:
            type_ = held[0][0].type
            numbers = pa.types.is_integer(type_)
            src, dst = (np.concatenate([x[k].to_numpy(zero_copy_only=False) for x in held]) for k in (0, 1))
            node, least = least_labels(src, dst) if numbers else least_labels(src.astype(object), dst.astype(object))
            for lo in range(0, len(node), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(x[lo : lo + (1 << 16)] if numbers else x[lo : lo + (1 << 16)].tolist(), type_) for x in (node, least)], ["node", "to"])

    while True:
        if now.df.count() <= few:
            moves.append(Staged(now.df.coalesce(1).mapInArrow(settle, f"node {kind}, to {kind}"), f"{tag}-moves"))
            now.drop()
            break
        by_hash = len(moves) % 2 == 1
        mixed |= by_hash
        first = lambda c: F.struct((F.xxhash64(c, F.lit(len(moves))) if by_hash else F.col(c)).alias("h"), F.col(c).alias("n"))  # noqa: B023, E731
        both = now.df.union(now.df.select("dst", "src"))
        near = both.groupBy("src").agg(F.min(first("dst")).alias("near"))
        move = Staged(near.select(F.col("src").alias("node"), F.least("near", first("src"))["n"].alias("to")), f"{tag}-moves")
        moves.append(move)
        a, b = (move.df.select(F.col("node").alias(c), F.col("to").alias(f"to_{c}")) for c in ("src", "dst"))
        moved = now.df.join(a, "src").join(b, "dst").select(F.col("to_src").alias("src"), F.col("to_dst").alias("dst"))
        after = Staged(moved.where("src <> dst").select(*pair).distinct(), f"{tag}-edges")
        now.drop()
        now = after
    out = moves[-1].df.withColumnRenamed("to", "component")
    for move in reversed(moves[:-1]):
        later = out.select(F.col("node").alias("to"), "component")
        out = move.df.join(later, "to", "left").select("node", F.coalesce("component", "to").alias("component"))
    if mixed:
        names = out.groupBy("component").agg(F.min("node").alias("least"))
        out = out.join(names, "component").select("node", F.col("least").alias("component"))
    if len(moves) == 1:
        return out
    done = Staged(out, f"{tag}-components").df
    for move in moves:
        move.drop()
    return done
