"""What several operators share: scratch tables, text chunks, word hashes, components.

Scratch tables are Parquet under the folder that ``spark.checkpoint.dir`` names, so that a lost
executor never takes an intermediate result with it. Only where the setting is absent (tests, a laptop)
is a local folder used.
"""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkloom.operators.graph import components
from sparkloom.shipping import ship

# ---------------------------------------------------------------- scratch tables


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        found = spark.sparkContext._jsc.sc().getCheckpointDir()
        if found.isDefined():
            base = found.get()
        elif not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        else:
            base = "file://" + tempfile.mkdtemp(prefix="sparkloom-")
            spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def _path(spark: SparkSession, where: str):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(where)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


class Staged:
    """A table written once to the scratch folder and read back, which cuts the lineage.

    The files go when ``drop`` is called, or when the driver's JVM ends.
    """

    def __init__(self, df: DataFrame, tag: str):
        spark = df.sparkSession
        self.spark, self.where = spark, f"{scratch_dir(spark)}/stage-{tag}-{uuid.uuid4().hex}"
        df.write.parquet(self.where)
        fs, path = _path(spark, self.where)
        fs.deleteOnExit(path)
        self.schema = df.schema
        self.df = spark.read.schema(df.schema).parquet(self.where)

    def drop(self) -> None:
        fs, path = _path(self.spark, self.where)
        fs.delete(path, True)


_scopes: list[list[Staged]] = []


@contextmanager
def scope() -> Iterator[None]:
    """Tables that ``stage`` makes inside are dropped at the end; for a caller that has written the result by then."""
    _scopes.append([])
    try:
        yield
    finally:
        for made in _scopes.pop():
            made.drop()


def stage(df: DataFrame, tag: str) -> DataFrame:
    """``Staged(df, tag).df``: for tables that a lazily returned result still reads. They go with the scope, or with the driver's JVM."""
    made = Staged(df, tag)
    if _scopes:
        _scopes[-1].append(made)
    return made.df


def partitions_for(spark: SparkSession, at_least: int = 1) -> int:
    """How many parts to deal keyed work to: the session's shuffle partitions."""
    return max(at_least, int(spark.conf.get("spark.sql.shuffle.partitions")))


def give_back() -> None:
    """Hands memory that nothing uses back to the system: a worker lives on between tasks and would keep what its largest one took."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def map_arrow(df: DataFrame, fn, schema: str) -> DataFrame:
    """``df.mapInArrow``, with this package shipped to the executors and memory given back at the end of each task."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from fn(batches)
        give_back()

    return df.mapInArrow(run, schema)


def group_arrow(df: DataFrame, key: str, fn, schema: str) -> DataFrame:
    """``df.groupBy(key).applyInArrow``, with this package shipped to the executors."""
    ship(df.sparkSession)
    return df.groupBy(key).applyInArrow(fn, schema)


# ---------------------------------------------------------------- documents


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores after it until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_row_key(docs: DataFrame) -> DataFrame:
    """(row_key, doc_id, text): row_key identifies a row by its id and text.

    Identical rows share a key and so get identical results; rows that repeat an id with another text
    don't. Null text counts as empty.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.xxhash64(F.col("doc_id"), text).alias("row_key"), F.col("doc_id"), text.alias("text"))


def chunks(batch: pa.RecordBatch, column: str = "text", most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``most`` bytes of text each; a longer text is a slice of its own.

    Texts are never cut: this only bounds the temporary arrays.
    """
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and (total + n > most or i - start >= 60_000):
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += int(n)
    if len(sizes) > start:
        yield batch.slice(start)


# ---------------------------------------------------------------- hashing in numpy


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power_table(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        have = _powers[base] = np.multiply.accumulate(steps)
    return have[:n]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[start:end], one polynomial prefix sum for all spans."""
    n = len(data)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power_table(_BASE, n), out=prefix[1:])
    h = (prefix[ends] - prefix[starts]) * _power_table(_BASE_INVERSE, n + 1)[starts]
    return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))


#: Bytes that belong to a word: letters, digits and every byte of a non-ASCII character.
WORD_BYTE = np.zeros(256, bool)
WORD_BYTE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of word bytes."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = WORD_BYTE[data]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def joined(texts: list[str | None], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one byte array, a line feed after each, and where each starts (one more at the end)."""
    parts = [(t or "").lower().encode("utf-8", "replace") if lower else (t or "").encode("utf-8", "replace") for t in texts]
    at = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) + 1 for p in parts], out=at[1:])
    return np.frombuffer(b"\n".join([*parts, b""]), np.uint8), at


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of every text in order, and where each text's words start (one more at the end)."""
    data, at = joined(texts)
    starts, ends = word_spans(data)
    return span_hashes(data, starts, ends), np.searchsorted(starts, at)


def shingle_hashes(words: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of runs of ``size`` words and the index of their text; a shorter text is one shingle, an empty one none."""
    n = np.diff(at)
    doc = np.repeat(np.arange(len(n)), n)
    left = at[1:][doc] - np.arange(len(words))  # words of the text from here on
    h = np.zeros(len(words), np.uint64)
    keep = (left >= size) | (np.arange(len(words)) == at[:-1][doc])
    for k in range(size):
        part = np.zeros(len(words), np.uint64)
        part[: max(0, len(words) - k)] = words[k:]
        part[left <= k] = 0
        h = h * np.uint64(0x9FB21C651E98DF25) + part
    return mix(h[keep]), doc[keep]


# ---------------------------------------------------------------- bounded filters


def bloom_bits(keys: DataFrame, column: str, most_bits: int = 1 << 25) -> tuple[np.ndarray, int]:
    """A one-hash bit filter over a column of mixed 64-bit keys, at most ``most_bits`` long (4 MB).

    It only spares work before a join that stays exact: beyond the bound it lets more rows through.
    """
    n = keys.count()
    bits = min(most_bits, max(1 << 13, 1 << (16 * n - 1).bit_length() if n else 0))
    bit = F.col(column).bitwiseAND(F.lit(bits - 1))
    words = keys.select(F.shiftright(bit, 5).alias("w"), F.expr(f"shiftleft(1L, cast({column} & 31 as int))").alias("b")).groupBy("w").agg(F.bit_or("b").alias("b"))
    table = words.toArrow()
    out = np.zeros(bits // 32, np.uint32)
    out[table.column("w").to_numpy()] = table.column("b").to_numpy().astype(np.uint32)
    return out, bits


def bloom_has(bits: np.ndarray, size: int, keys: np.ndarray) -> np.ndarray:
    at = keys.astype(np.int64) & (size - 1)
    return (bits[at >> 5] >> (at & 31).astype(np.uint32)) & 1 == 1


# ---------------------------------------------------------------- bounded samples of labelled rows


def folds(doc_id, of: int):
    """crc32 of the id as text, modulo ``of``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % of


#: Bytes of text that a sample brings to the driver at most.
SAMPLE_BYTES = 96 << 20


def below(rows: DataFrame, per_label: int, tag: str) -> DataFrame:
    """``rows`` (label, k, ...) with h, of each label those of least h: about twice ``per_label`` distinct k, or all where there are fewer.

    h is k without its sign. The bound comes from the (mergeable) approximate number of distinct k of the label.
    """
    many = Staged(rows.groupBy("label").agg(F.approx_count_distinct("k", 0.02).alias("many")), tag).df
    top = F.lit(2.0 * per_label) / F.greatest("many", F.lit(1)) * float(1 << 63)
    return rows.join(F.broadcast(many), "label").withColumn("h", F.shiftrightunsigned("k", 1)).where(F.col("h") <= top).drop("many")


def sampled_texts(rows: DataFrame, per_label: int, most_bytes: int = SAMPLE_BYTES) -> list[tuple[str, object]]:
    """(text, label) of at most ``per_label`` rows of each label of ``rows`` (doc_id, label, text), by the hash of id and text.

    Rows, not ids, are bounded, and so are bytes: a label takes rows in order of their hash as long as their texts fit in its
    share of ``most_bytes``. Equal rows are counted before anything is ordered, and only rows below a bound on the hash
    are, so no task gets more than some multiple of ``per_label``. The layout doesn't matter. A text
    longer than a label's share is left out of the sample.
    """
    near = below(rows.withColumn("k", F.xxhash64("doc_id", "text")), per_label, "sample")
    each = Staged(near.groupBy("label", "doc_id", "h", "k").agg(F.first("text").alias("text"), F.count("*").alias("times")), "sample")
    labels = each.df.select("label").distinct().count()
    if not labels:
        return []
    share = most_bytes // labels
    w = Window.partitionBy("label").orderBy("h", "doc_id", "k").rowsBetween(Window.unboundedPreceding, 0)
    some = each.df.withColumns({"times": F.least("times", F.lit(per_label)), "n": F.octet_length("text")}).withColumn("n", F.col("n") * F.col("times")).where(F.col("n") <= share)
    table = some.withColumns({"rank": F.sum("times").over(w), "bytes": F.sum("n").over(w)}).where((F.col("rank") <= per_label) & (F.col("bytes") <= share))
    out = table.select("doc_id", "label", "k", "text", "times").toArrow().to_pylist()
    each.drop()
    out.sort(key=lambda r: (r["doc_id"], str(r["label"]), r["k"]))
    return [(r["text"], r["label"]) for r in out for _ in range(r["times"])]


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, fold: int, of: int, per_label: int) -> tuple[list[str], np.ndarray]:
    """Texts and 0/1 labels of a bounded sample of labelled rows outside fold ``fold``, in order of id.

    An id with conflicting labels counts by the greater one; null texts count as empty. Ids are chosen first, from ``labels`` alone;
    then the rows that they have in ``docs`` are bounded, as an id may have many.
    """
    rows = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & (folds(F.col("doc_id"), of) != fold))
    rows = rows.groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("label")).withColumn("k", F.xxhash64("doc_id"))
    w = Window.partitionBy("label").orderBy("h", "doc_id")
    chosen = stage(below(rows, per_label, "labels").withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= per_label).select("doc_id", "label"), "labels")
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    got = sampled_texts(texts.select("doc_id", "label", "text"), per_label)
    return [t for t, _ in got], np.array([y for _, y in got], np.int64)


# ---------------------------------------------------------------- classes from candidate buckets


class Sets:
    """Texts as sets of weighted elements: hashes in rising order for each text, and each text's total weight."""

    def __init__(self, texts: list[str], elements):
        self.hash, owner, self.weight = elements(texts)
        self.at = np.searchsorted(owner, np.arange(len(texts) + 1))
        self.owner = owner
        sums = np.concatenate((np.zeros(1), np.cumsum(self.weight)))
        self.total = sums[self.at[1:]] - sums[self.at[:-1]]

    def counted(self) -> Sets:
        """The same sets with every element's weight 1."""
        out = object.__new__(Sets)
        out.hash, out.owner, out.at, out.weight, out.total = self.hash, self.owner, self.at, np.ones(len(self.hash)), np.diff(self.at).astype(np.float64)
        return out

    def linked(self, i: np.ndarray, j: np.ndarray, similar: float, plain: bool = False) -> np.ndarray:
        """Whether text i[k] and text j[k] have a Jaccard similarity of ``similar``, weighted or, if ``plain``, with weights of 1, for all k."""
        out = np.zeros(len(i), bool)
        for sets in (self, self.counted()) if plain else (self,):
            x, y = sets.total[i], sets.total[j]
            some = np.flatnonzero(~out & (np.minimum(x, y) >= (similar - 1e-9) * np.maximum(x, y)))
            both = sets.pairs_shared(i[some], j[some])
            out[some] = both >= (similar - 1e-9) * (x[some] + y[some] - both)
        return out

    def shared(self, i: int, other: Sets, j: int) -> float:
        """Weight of what text i has in common with text j of ``other``."""
        a, b = slice(self.at[i], self.at[i + 1]), slice(other.at[j], other.at[j + 1])
        if a.start == a.stop or b.start == b.stop:
            return 0.0
        k = np.searchsorted(other.hash[b], self.hash[a])
        k[k == b.stop - b.start] = 0
        return float(self.weight[a][other.hash[b][k] == self.hash[a]].sum())

    def pairs_shared(self, i: np.ndarray, j: np.ndarray, most: int = 1 << 20) -> np.ndarray:
        """``shared`` of text i[k] with text j[k], both of this, for all k; about ``most`` elements are looked up at a time."""
        if len(self.total) < 1 << 23 and (not len(self.hash) or self.hash.max() < 1 << 40):
            rank, width = self.hash.astype(np.int64), 1 << 40
        else:
            distinct, rank = np.unique(self.hash, return_inverse=True)
            width = max(1, len(distinct))
        keys = self.owner.astype(np.int64) * width + rank  # rising
        sizes = np.diff(self.at)
        swap = sizes[i] > sizes[j]
        few, many = np.where(swap, j, i), np.where(swap, i, j)
        n, out = sizes[few], np.zeros(len(i))
        ends, lo = np.cumsum(n), 0
        while lo < len(i):
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + most)))
            size = n[lo:hi]
            pair = np.repeat(np.arange(hi - lo), size)
            at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + self.at[few[lo:hi]][pair]
            key = many[lo:hi].astype(np.int64)[pair] * width + rank[at]
            k = np.searchsorted(keys, key)
            k[k == len(keys)] = 0
            hit = keys[k] == key if len(keys) else np.zeros(0, bool)
            out[lo:hi] = np.bincount(pair[hit], self.weight[at[hit]], hi - lo)
            lo = hi
        return out

    def all_shared(self, other: Sets, columns: int = 8192) -> np.ndarray:
        """``shared`` of all texts with all texts of ``other``, as matrix products over slices of the common elements."""
        out = np.zeros((len(self.total), len(other.total)))
        common = np.intersect1d(self.hash, other.hash)
        mine, theirs = np.searchsorted(common, self.hash), np.searchsorted(common, other.hash)
        if not len(common):
            return out
        mine[mine == len(common)] = 0
        theirs[theirs == len(common)] = 0
        a, b = common[mine] == self.hash, common[theirs] == other.hash
        for lo in range(0, len(common), columns):
            width = min(columns, len(common) - lo)
            x, y = np.zeros((len(self.total), width), np.float32), np.zeros((len(other.total), width), np.float32)
            i = np.flatnonzero(a & (mine >= lo) & (mine < lo + width))
            j = np.flatnonzero(b & (theirs >= lo) & (theirs < lo + width))
            x[self.owner[i], mine[i] - lo] = self.weight[i]
            y[other.owner[j], theirs[j] - lo] = 1
            out += x @ y.T
        return out


def linked_pairs(pairs: DataFrame, texts: DataFrame, elements, similar: float, plain: bool = False) -> DataFrame:
    """(src, dst): the columns ``from`` and ``to`` of the ``pairs`` whose texts have a weighted Jaccard similarity of ``similar`` or more, or one without weights if ``plain``.

    ``pairs`` has (a, b, from, to), ``texts`` (node, text) for the nodes a and b.
    """
    one = lambda n: texts.select(F.col("node").alias(n), F.col("text").alias(f"text_{n}"))
    both = pairs.join(one("a"), "a").join(one("b"), "b")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text_a"):
                src, dst = part.column("a").to_numpy(), part.column("b").to_numpy()
                known = dict(zip(src.tolist(), part.column("text_a").to_pylist(), strict=True)) | dict(zip(dst.tolist(), part.column("text_b").to_pylist(), strict=True))
                place = {n: k for k, n in enumerate(known)}
                sets = Sets(list(known.values()), elements)
                i, j = (np.array([place[n] for n in side.tolist()], np.int64) for side in (src, dst))
                keep = sets.linked(i, j, similar, plain)
                yield pa.RecordBatch.from_arrays([pa.array(part.column(c).to_numpy()[keep]) for c in ("from", "to")], ["src", "dst"])

    return map_arrow(both.select("a", "b", "from", "to", "text_a", "text_b"), check, "src bigint, dst bigint")


def links_in_blocks(few: DataFrame, many: DataFrame, texts: DataFrame, elements, similar: float, block: int = 64, plain: bool = False) -> DataFrame:
    """Links (src, dst) between different components of a bucket; one for each node of ``few``, component and block.

    ``few`` and ``many`` have (bucket, node, component). Nodes of a bucket go in blocks with their texts, and
    blocks are compared with blocks by matrix products, so pairs of nodes are never rows. Each pair of
    blocks is a row of its own, dealt by its blocks, so a large bucket is spread over all tasks.
    """

    def packed(side: DataFrame, name: str) -> DataFrame:
        sizes = side.groupBy("bucket").agg(F.ceil(F.count("*") / block).cast("int").alias("_blocks"))
        dealt = side.join(sizes, "bucket").withColumn(f"{name}_block", F.pmod(F.xxhash64("node"), F.col("_blocks")))
        return dealt.join(texts, "node").groupBy("bucket", f"{name}_block").agg(F.collect_list(F.struct("node", "component", "text")).alias(name))

    def small(rows: list[tuple[list[dict], list[dict]]]) -> list[tuple[int, int]]:
        """Links of many small blocks at once: their texts are taken apart together."""
        place: dict[int, int] = {}
        texts: list = []
        for side in (x for row in rows for x in row):
            for r in side:
                if place.setdefault(r["node"], len(texts)) == len(texts):
                    texts.append(r["text"])
        pairs = sorted({(place[x["node"]], place[y["node"]], x["component"], y["component"]) for a, b in rows for x in a for y in b if x["component"] != y["component"]})
        if not pairs:
            return []
        sets = Sets(texts, elements)
        i, j = (np.array([p[k] for p in pairs], np.int64) for k in (0, 1))
        return sorted({pairs[k][2:] for k in np.flatnonzero(sets.linked(i, j, similar, plain))})

    def out(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], ["src", "dst"])

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: list[tuple[list[dict], list[dict]]] = []
            weight = 0
            for row in range(batch.num_rows):
                a, b = batch.column("few")[row].as_py(), batch.column("many")[row].as_py()
                if len(a) * len(b) <= 256:
                    held.append((a, b))
                    weight += sum(len(r["text"]) for r in (*a, *b)) + 100 * len(a) * len(b)
                    if weight > 2 << 20:
                        yield out(small(held))
                        held, weight = [], 0
                    continue
                x, y = Sets([r["text"] for r in a], elements), Sets([r["text"] for r in b], elements)
                measures = [(x, y), (x.counted(), y.counted())] if plain else [(x, y)]
                near = np.zeros((len(a), len(b)), bool)
                for p, q in measures:
                    both = p.all_shared(q)
                    near |= both >= (similar - 1e-6) * (p.total[:, None] + q.total[None, :] - both)
                found: dict[tuple[int, int], tuple[int, int]] = {}
                for i, j in zip(*np.nonzero(near), strict=True):
                    i, j = int(i), int(j)
                    key = a[i]["component"], b[j]["component"]
                    if key[0] == key[1] or (a[i]["node"], key[1]) in found:
                        continue
                    for p, q in measures:
                        exact = p.shared(i, q, j)
                        if exact >= (similar - 1e-9) * (p.total[i] + q.total[j] - exact):
                            found[a[i]["node"], key[1]] = key
                yield out(sorted(set(found.values())))
            if held:
                yield out(small(held))

    left, right = Staged(packed(few, "few"), "few"), Staged(packed(many, "many"), "many")
    plan = left.df.select("bucket", "few_block").join(right.df.select("bucket", "many_block"), "bucket")
    both = plan.join(left.df, ["bucket", "few_block"]).join(right.df, ["bucket", "many_block"])
    links = stage(map_arrow(both.select("few", "many"), check, "src bigint, dst bigint"), "block-links")
    left.drop()
    right.drop()
    return links


def classes(members: DataFrame, texts: DataFrame, elements, similar: float, tag: str, leaders: int = 3, rounds: int = 2, plain: bool = False) -> DataFrame:
    """(node, component) of every node with a link: components of the links between nodes that share a bucket.

    ``members`` has (bucket, node), ``texts`` (node, text); ``elements`` maps texts to (hash, text's index,
    weight), distinct and in order for each text; a link is a weighted Jaccard similarity of ``similar``, or one without weights if ``plain``.
    No link that would join two components is lost, yet pairs of a bucket are never listed. Every member
    is compared with one leader of its bucket. Where a bucket then lies in several components, members
    outside its largest are compared with some more leaders from that one, ``rounds`` times. Those
    still outside meet all other components of their bucket in blocks. Later turns see only
    buckets of three or more that are still open (two have been compared), only pairs that
    have not been, and only links between components.
    """
    ends = members.groupBy("bucket").agg(F.min("node").alias("leader"), F.count("*").alias("size")).where("size > 1")
    table = Staged(members.join(ends, "bucket"), f"{tag}-members")
    pairs = table.df.where("node <> leader").select(F.col("node").alias("a"), F.col("leader").alias("b")).distinct()
    links = [Staged(linked_pairs(pairs.withColumns({"from": F.col("a"), "to": F.col("b")}), texts, elements, similar, plain), f"{tag}-links")]
    found = components(links[0].df, tag)
    now = table.df.where("size > 2").join(found, "node", "left").select("bucket", "leader", "node", F.coalesce("component", "node").alias("component"))
    held = [table]
    for turn in range(rounds + 1):
        sizes = now.groupBy("bucket", "component").agg(F.count("*").alias("n"))
        largest = sizes.groupBy("bucket").agg(F.max_by("component", F.struct("n", "component")).alias("largest"), F.count("*").alias("components")).where("components > 1").select("bucket", "largest")
        still = Staged(now.join(largest, "bucket"), f"{tag}-open")
        held.append(still)
        if still.df.isEmpty():
            break
        outside = still.df.where("component <> largest")
        if turn < rounds:
            lead = still.df.where("component = largest").groupBy("bucket").agg(*(F.min_by("node", F.xxhash64("node", F.lit(turn * leaders + k))).alias(f"l{k}") for k in range(leaders)))
            pairs = outside.join(lead, "bucket").select("leader", F.col("node").alias("a"), F.col("component").alias("from"), F.col("largest").alias("to"), F.explode(F.array_distinct(F.array(*(F.col(f"l{k}") for k in range(leaders))))).alias("b"))
            fresh = pairs.where("b <> leader and a <> leader").drop("leader").dropDuplicates(["a", "b"])
            more = linked_pairs(fresh, texts, elements, similar, plain)
        else:
            more = links_in_blocks(outside.select("bucket", "node", "component"), still.df.select("bucket", "node", "component"), texts, elements, similar, plain=plain)
        links.append(Staged(more, f"{tag}-links"))
        now = still.df.select("bucket", "leader", "node", "component")
        if turn < rounds:
            joined = components(links[-1].df, tag).select(F.col("node").alias("component"), F.col("component").alias("after"))
            now = now.join(joined, "component", "left").select("bucket", "leader", "node", F.coalesce("after", "component").alias("component"))
    if len(links) > 1:
        every = found.select(F.col("node").alias("src"), F.col("component").alias("dst"))
        for x in links[1:]:
            every = every.unionByName(x.df)
        found = components(every, tag)
    for x in (*held, *links):
        x.drop()
    return found
