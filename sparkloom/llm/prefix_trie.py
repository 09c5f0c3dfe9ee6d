"""Prefix trie of conversations, as succinct level-order tries over shards of the sorted sequences.

A conversation is the sequence of its turns' digests. Distinct sequences are dealt to shards by range, so a shard is a run of
neighbours in their order and a subtree lies in one shard, but for the nodes on the paths of a shard's first and last
sequence. In a shard, numpy builds the trie's LOUDS bits and labels and rolls up its nodes level by level from the deepest. The
nodes on those border paths, heavy upper levels among them, are merged by their prefixes afterwards.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.llm.shared import map_arrow, partitions_for, stage
from sparkloom.operators.skew import lookup

#: Bytes of a turn in a sequence: 16 of its digest, 4 that count its words.
TURN = 20
#: Turns of a shard, about; a longer sequence is a shard of its own.
SHARD = 1 << 20
#: A family is so many neighbouring ids; the first lends its beginning to the others.
FAMILY = 20
NO_ENDS = hashlib.sha256(b"").hexdigest()

# ---------------------------------------------------------------- sequences


def turn_code(role: Column, text: Column) -> Column:
    """Hexadecimal digits of a turn in a sequence: 128 bits of SHA-256 over role and text, and the number of words."""
    r, t = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    digest = F.sha2(F.concat(F.length(r).cast("string"), F.lit(":"), r, t), 256)
    return F.concat(F.substring(digest, 1, 32), F.lpad(F.hex(F.regexp_count(t, F.lit(r"[^\x20\x09-\x0D]+"))), 8, "0"))


def sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, seq): every conversation as rebuilt, TURN bytes a turn.

    Turns go by number, null first; turns of one number by role, then by digest. The first h turns, h = crc32(id) % 4, are those of the
    first conversation of its family (id - id % 20), where there are so many; its own turns after its first h follow.
    """
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), turn_code(F.col("role"), F.col("text")).alias("code")).alias("t"))
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    whole = stage(whole.select("conv_id", F.transform("ts", lambda t: t["code"]).alias("codes")), "turns")
    first = whole.where(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("family"), F.slice("codes", 1, 3).alias("lent"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4).cast("int")
    both = whole.withColumns({"family": F.col("conv_id") - F.col("conv_id") % FAMILY, "h": h}).join(first, "family", "left")
    lent = F.slice(F.coalesce("lent", F.array().cast("array<string>")), F.lit(1), F.col("h"))
    own = F.slice("codes", F.col("h") + 1, F.greatest(F.size("codes") - F.col("h"), F.lit(0)))
    return both.select("conv_id", F.unhex(F.array_join(F.concat(lent, own), "")).alias("seq"))


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (seq_id, conv_id) in order: seq_id and the digest of its ids, each id seen once and let go."""
    now, digest = None, None
    for batch in batches:
        ids, digests = [], []
        for s, c in zip(batch.column("seq_id").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
            if s != now:
                if digest is not None:
                    ids.append(now)
                    digests.append(digest.hexdigest())
                now, digest = s, hashlib.sha256(b"%d" % c)
            else:
                digest.update(b",%d" % c)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(digests, pa.string())], ["seq_id", "ends"])
    if digest is not None:
        yield pa.RecordBatch.from_arrays([pa.array([now], pa.string()), pa.array([digest.hexdigest()], pa.string())], ["seq_id", "ends"])


# ---------------------------------------------------------------- one shard


class Louds:
    """A trie in level order: ``bits`` has a one for each child and a zero after each node's children, behind '10' for the top.

    ``labels`` are the turns' bytes in the same order, without the top's.
    """

    def __init__(self, degrees: np.ndarray, labels: np.ndarray):
        places = np.cumsum(degrees + 1) + 1  # of each node's zero
        bits = np.ones(2 + len(degrees) + int(degrees.sum()), bool)
        bits[1] = False
        bits[places] = False
        self.bits, self.many, self.labels = np.packbits(bits), len(bits), labels

    def parents(self) -> np.ndarray:
        """Of each node but the top: the zeros before its one (rank of select), less that of the top."""
        ones = np.flatnonzero(np.unpackbits(self.bits, count=self.many))
        return ones[1:] - np.arange(1, len(ones)) - 1

    def degrees(self) -> np.ndarray:
        zeros = np.flatnonzero(np.unpackbits(self.bits, count=self.many) == 0)
        return np.diff(zeros) - 1


def _shared(turns: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Turns that each sequence shares with the one before (0 for the first)."""
    out = np.zeros(len(lengths), np.int64)
    least = np.minimum(lengths[1:], lengths[:-1])
    at = np.zeros(len(least) + 1, np.int64)
    np.cumsum(least, out=at[1:])
    inside = np.arange(at[-1]) - np.repeat(at[:-1], least)
    a, b = np.repeat(starts[:-2], least) + inside, np.repeat(starts[1:-1], least) + inside
    differs = np.where(turns[a] != turns[b], inside, np.iinfo(np.int64).max)
    some = np.flatnonzero(least)
    if len(some):
        first = np.minimum.reduceat(differs, at[some])
        out[some + 1] = np.minimum(first, least[some])
    return out


def build(turns: np.ndarray, lengths: np.ndarray) -> tuple[Louds, np.ndarray, np.ndarray, np.ndarray]:
    """The trie of sorted distinct sequences: LOUDS, depth and first sequence of each node in level order, and each sequence's own node."""
    starts = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=starts[1:])
    common = _shared(turns, starts, lengths)
    new = lengths - common
    seq = np.repeat(np.arange(len(lengths)), new)
    depth = np.arange(len(seq)) - np.repeat(np.cumsum(new) - new, new) + np.repeat(common, new) + 1
    pre = np.arange(1, len(seq) + 1)  # place in depth-first order, the top being 0
    level = np.argsort(depth, kind="stable")
    width = len(seq) + 1
    keys = np.concatenate([[0], depth[level] * width + pre[level]])
    up = np.searchsorted(keys, keys[1:] - width, side="right") - 1  # the last node above that comes before
    degrees = np.bincount(up, minlength=width)
    depth_of, seq_of = np.concatenate([[0], depth[level]]), np.concatenate([[0], seq[level]])
    own = np.searchsorted(keys, lengths * width + np.cumsum(new), side="right") - 1
    labels = turns[starts[seq_of[1:]] + depth_of[1:] - 1]
    return Louds(degrees, labels), depth_of, seq_of, own


_NODE = "kind string, path string, depth bigint, key binary, parent_key binary, parent_conv_id bigint, conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, words bigint, ends string"


def _keys(seq: np.ndarray) -> list[bytes]:
    """A key for each prefix of a sequence, the empty one too: 128 bits of SHA-256."""
    h, out = hashlib.sha256(), [hashlib.sha256().digest()[:16]]
    for turn in seq.tolist():
        h.update(turn)
        out.append(h.copy().digest()[:16])
    return out


def _shard(seqs: list[bytes], n: np.ndarray, least: np.ndarray, ends: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows of one shard: kind 'node' is final but for the parent of a border's child, 'border' is a partial node on a border path."""
    lengths = np.array([len(s) // TURN for s in seqs], np.int64)
    turns = np.frombuffer(b"".join(seqs), np.dtype((np.void, TURN)))
    trie, depth, seq_of, own = build(turns, lengths)
    parent, degree = trie.parents(), trie.degrees()
    many = len(depth)
    words = np.zeros(many, np.int64)
    if many > 1:
        words[1:] = np.ascontiguousarray(trie.labels).view(np.uint8).reshape(-1, TURN)[:, 16:].copy().view(">u4").ravel()
    members, smallest = np.zeros(many, np.int64), np.full(many, np.iinfo(np.int64).max)
    members[own], smallest[own] = n, least
    ending = np.array([NO_ENDS] * many, object)
    ending[own] = ends
    level = np.concatenate([[0], np.flatnonzero(np.diff(depth)) + 1, [many]])
    levels = [slice(a, b) for a, b in zip(level[:-1], level[1:], strict=True)]
    for s in levels[:0:-1]:  # from the deepest level up
        up = parent[s.start - 1 : s.stop - 1]
        np.add.at(members, up, members[s])
        np.minimum.at(smallest, up, smallest[s])

    def path(k: int) -> np.ndarray:
        """Nodes from the top to the end of sequence k."""
        at, out = own[k], []
        while at > 0:
            out.append(at)
            at = parent[at - 1]
        return np.array([0, *out[::-1]])

    first, last = path(0), path(len(seqs) - 1)
    border = np.zeros(many, bool)
    border[first] = border[last] = True
    leaves, saved = ((degree == 0) & ~border).astype(np.int64), np.where(border, 0, (members - 1) * words)
    inner = np.bincount(parent[~border[1:]], minlength=many)  # children that are no border nodes
    for s in levels[:0:-1]:
        up = parent[s.start - 1 : s.stop - 1]
        np.add.at(leaves, up, leaves[s])
        np.add.at(saved, up, saved[s])
    starts = np.concatenate([[0], np.cumsum(lengths)])
    at_border = {}
    paths = [(first, 0)] if len(seqs) == 1 else [(first, 0), (last, len(seqs) - 1)]
    for nodes, k in paths:
        keys = _keys(turns[starts[k] : starts[k + 1]])
        mine = np.array([node not in at_border for node in nodes])  # a node on both paths counts once
        at_border |= dict(zip(nodes.tolist(), keys, strict=True))
        count = lambda x, nodes=nodes, mine=mine: np.where(mine, x[nodes], 0)
        for a in range(0, len(nodes), 50_000):
            b, some = slice(a, a + 50_000), nodes[a : a + 50_000]
            yield _rows(
                len(some), kind=["border"] * len(some), path=[keys[-1].hex()] * len(some), depth=depth[some], key=keys[b], parent_key=[None, *keys[:-1]][b], conv_id=smallest[some], n_convs=count(members)[b],
                n_children=count(inner)[b], n_leaves=count(leaves)[b], saved_tokens=count(saved)[b], words=words[some], ends=ending[some].tolist())
    rest = np.flatnonzero(~border)
    for a in range(0, len(rest), 50_000):
        part = rest[a : a + 50_000]
        up = parent[part - 1]
        under = border[up]
        yield _rows(
            len(part), kind=["node"] * len(part), depth=depth[part], parent_key=[at_border[u] if x else None for u, x in zip(up.tolist(), under, strict=True)],
            parent_conv_id=pa.array(smallest[up], pa.int64(), mask=under), conv_id=smallest[part], n_convs=members[part], n_children=degree[part], n_leaves=leaves[part], saved_tokens=saved[part], ends=ending[part].tolist())


def _rows(n: int, **columns) -> pa.RecordBatch:
    """A batch of ``n`` rows of _NODE; columns not given are null."""
    kinds = {"string": pa.string(), "binary": pa.binary(), "bigint": pa.int64()}
    of = dict(c.split() for c in _NODE.split(", "))
    return pa.RecordBatch.from_arrays([pa.array(columns[c], kinds[k]) if c in columns else pa.nulls(n, kinds[k]) for c, k in of.items()], list(of))


def _shards(batches: Iterator[pa.RecordBatch], most: int = SHARD) -> Iterator[pa.RecordBatch]:
    """Sorted sequences of a partition, cut into shards of about ``most`` turns."""
    held: list[tuple] = []
    total = 0
    for batch in batches:
        for row in zip(batch.column("seq").to_pylist(), batch.column("n").to_pylist(), batch.column("least").to_pylist(), batch.column("ends").to_pylist(), strict=True):
            size = len(row[0]) // TURN + 1
            if held and total + size > most:
                yield from _made(held)
                held, total = [], 0
            held.append(row)
            total += size
    if held:
        yield from _made(held)


def _made(held: list[tuple]) -> Iterator[pa.RecordBatch]:
    seqs, n, least, ends = zip(*held, strict=True)
    yield from _shard(list(seqs), np.array(n, np.int64), np.array(least, np.int64), list(ends))


# ---------------------------------------------------------------- all shards


def prefix_trie(conversations: DataFrame, shard: int = SHARD) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Conversations are rebuilt as in ``sequences``; null role or text counts as empty; turns without a conv_id belong to no conversation;
    repeated rows are turns of their own. A rebuilt conversation may have no turn: it ends at the top. An empty table gives an empty result. Texts of any
    length count by digest; other columns are ignored. A conversation is a row of TURN bytes a turn; identical ones become one row before
    they are dealt to shards, and the digest of all that end at a node is taken from their sorted ids one by one, in the task of that node.
    """
    spark = conversations.sparkSession
    each = stage(sequences(conversations).withColumn("seq_id", F.sha2("seq", 256)), "sequences")
    ends = map_arrow(each.select("seq_id", "conv_id").repartition("seq_id").sortWithinPartitions("seq_id", "conv_id"), _ends, "seq_id string, ends string")
    once = each.groupBy("seq_id", "seq").agg(F.count("*").alias("n"), F.min("conv_id").alias("least")).join(ends, "seq_id")
    ordered = once.select("seq", "n", "least", "ends").repartitionByRange(partitions_for(spark), "seq").sortWithinPartitions("seq")
    rows = stage(map_arrow(ordered, lambda batches: _shards(batches, shard), _NODE), "shards")

    # Border nodes: partial counts are summed by prefix; what a node adds to those above it is summed along one path that holds it.
    paths = rows.where("kind = 'border'")
    merged = paths.groupBy("key").agg(
        F.first("depth").alias("depth"), F.first("parent_key").alias("parent_key"), F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("inner"),
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved"), F.first("words").alias("words"), F.max(F.when(F.col("ends") != NO_ENDS, F.col("ends"))).alias("ends"), F.min("path").alias("path"))
    merged = stage(merged, "merged")
    children = merged.where("parent_key is not null").groupBy(F.col("parent_key").alias("key")).agg(F.count("*").alias("outer"))
    merged = merged.join(children, "key", "left").withColumn("n_children", F.col("inner") + F.coalesce("outer", F.lit(0)))
    merged = stage(merged.withColumns({"leaf": (F.col("n_children") == 0).cast("bigint"), "own": (F.col("n_convs") - 1) * F.col("words")}), "upper")
    below = Window.partitionBy("path").orderBy(F.col("depth").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    places = paths.select("path", "key", "depth").distinct().join(merged.select("path", "key", "leaf", "own"), ["path", "key"], "left")
    over = places.select("key", F.sum(F.coalesce("leaf", F.lit(0))).over(below).alias("more_leaves"), F.sum(F.coalesce("own", F.lit(0))).over(below).alias("more_saved"))
    over = over.groupBy("key").agg(F.sum("more_leaves").alias("more_leaves"), F.sum("more_saved").alias("more_saved"))
    upper = merged.join(over, "key").select(
        "conv_id", "depth", "parent_key", F.lit(None).cast("bigint").alias("parent_conv_id"), "n_convs", "n_children", (F.col("n_leaves") + F.col("more_leaves")).alias("n_leaves"),
        (F.col("saved") + F.col("more_saved")).alias("saved_tokens"), F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"))
    lower = rows.where("kind = 'node'").select(*upper.columns[:-1], F.col("ends").alias("ends_sha256"))
    above = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("above"))
    both = stage(lower.where("parent_key is not null").unionByName(upper), "unnamed")
    named = lookup(both, above, ["parent_key"]).withColumn("parent_conv_id", F.col("above"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return named.select(columns).unionByName(lower.where("parent_key is null").select(columns))


#: crc32 of the decimal id, bit by bit.
_CRC = "xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST({c} AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))), lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda z, k: xor(z >> 1, 3988292384 * (z & 1)))), 4294967295)"

SQL = r"""
WITH o AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS i
           FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 20 AS family, CRC % 4 AS h FROM (SELECT DISTINCT conv_id FROM o)),
r AS (SELECT c.conv_id, o.i, o.role, o.text FROM c JOIN o ON o.conv_id = c.family WHERE o.i <= c.h
      UNION ALL SELECT c.conv_id, 1000000 + o.i, o.role, o.text FROM c JOIN o ON o.conv_id = c.conv_id WHERE o.i > c.h),
t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY i) AS d, role, text, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words FROM r),
p AS (SELECT conv_id, d, words, sha256(string_agg(sha256(length(role) || ':' || role || text), '' ORDER BY d) OVER (PARTITION BY conv_id ORDER BY d)) AS k FROM t
      UNION ALL SELECT conv_id, 0, 0, '' FROM c),
up AS (SELECT a.conv_id, a.d, a.k, a.words, b.k AS above FROM p a LEFT JOIN p b ON b.conv_id = a.conv_id AND b.d = a.d - 1),
e AS (SELECT k, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids FROM (SELECT conv_id, arg_max(k, d) AS k FROM p GROUP BY conv_id) GROUP BY k),
n AS (SELECT k, min(conv_id) AS conv_id, min(d) AS depth, min(above) AS above, count(*) AS n_convs, min(words) AS words FROM up GROUP BY k),
s AS (SELECT above AS k, count(*) AS n_children FROM n WHERE above IS NOT NULL GROUP BY above),
x AS (SELECT n.*, coalesce(s.n_children, 0) AS n_children FROM n LEFT JOIN s USING (k)),
below AS (SELECT DISTINCT a.k, b.k AS u FROM p a JOIN p b ON a.conv_id = b.conv_id AND b.d >= a.d),
roll AS (SELECT below.k, sum((x.n_children = 0)::BIGINT) AS n_leaves, sum((x.n_convs - 1) * x.words) AS saved_tokens FROM below JOIN x ON x.k = below.u GROUP BY below.k)
SELECT x.conv_id, CAST(x.depth AS BIGINT) AS depth, y.conv_id AS parent_conv_id, CAST(x.n_convs AS BIGINT) AS n_convs, CAST(x.n_children AS BIGINT) AS n_children,
       CAST(roll.n_leaves AS BIGINT) AS n_leaves, CAST(roll.saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM x JOIN roll USING (k) LEFT JOIN x y ON y.k = x.above LEFT JOIN e ON e.k = x.k
""".replace("CRC", _CRC.format(c="conv_id"))
