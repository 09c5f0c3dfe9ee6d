"""Language detection by profiles of character n-grams, learnt from labelled texts."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.scratch import Staged
from sparkloom.shipping import ship

#: Longest n-gram, n-grams of a profile, labelled texts of each language that are learnt from (in hash order).
LONGEST, GRAMS, TEXTS = 3, 2000, 2000
#: Weights are whole numbers of so many parts, so that sums don't depend on their order.
UNIT = 1_000_000
#: So many n-grams count at most as evidence: probabilities of long texts stay apart from 1.
EVIDENCE = 100
#: Characters that are scored at once.
AT_ONCE = 1 << 18


def prepared(text: Column) -> Column:
    """Words of lower case letters, one blank before, between and after them."""
    return F.concat(F.lit(" "), F.btrim(F.regexp_replace(F.lower(text), r"[^\p{L}]+", " ")), F.lit(" "))


def _points(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts in a row, and where each starts (one more at the end)."""
    parts = [(t or "").encode("utf-32-le", "replace") for t in texts]
    at = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) // 4 for p in parts], out=at[1:])
    return np.frombuffer(b"".join(parts), "<u4").astype(np.int64), at


def _codes(points: np.ndarray, n: int) -> np.ndarray:
    """The n code points from each place on as one number, 21 bits each, the first lowest."""
    out = points[: max(0, len(points) - n + 1)].copy()
    for k in range(1, n):
        out |= (points[k : k + len(out)] + 1) << (21 * k)
    return out


def _gram(code: int) -> str:
    first, rest = code & 0x1FFFFF, code >> 21
    out = chr(first)
    while rest:
        out += chr((rest & 0x1FFFFF) - 1)
        rest >>= 21
    return out


def _code(gram: str) -> int:
    return ord(gram[0]) | sum((ord(c) + 1) << (21 * k) for k, c in enumerate(gram[1:], 1))


class Profile(NamedTuple):
    languages: list[str]
    codes: np.ndarray  # n-grams of all profiles, as numbers in order
    weights: np.ndarray  # logarithm of each n-gram's share by language, in UNITs

    def score(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(sums of weights by text and language, known n-grams by text) of prepared texts; whole texts of about 16 AT_ONCE characters are decoded at once."""
        ends = np.cumsum([len(t or "") for t in texts])
        held, lo = [(np.zeros((0, len(self.languages))), np.zeros(0, np.int64))], 0
        while lo < len(texts):
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + 16 * AT_ONCE, "right")))
            held.append(self._score(texts[lo:hi]))
            lo = hi
        total, known = zip(*held, strict=True)
        return np.concatenate(total), np.concatenate(known)

    def _score(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        points, at = _points(texts)
        total, known = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts), np.int64)
        for lo in range(0, len(points), AT_ONCE):
            place = np.arange(lo, min(lo + AT_ONCE, len(points)))
            text = np.searchsorted(at, place, "right") - 1
            for n in range(1, LONGEST + 1):
                code = _codes(points[lo : lo + AT_ONCE + n - 1], n)
                whole = np.flatnonzero(place[: len(code)] + n <= at[text[: len(code)] + 1])
                k = np.searchsorted(self.codes, code[whole])
                k[k == len(self.codes)] = 0
                hit = self.codes[k] == code[whole]
                doc, k = text[whole[hit]], k[hit]
                known += np.bincount(doc, minlength=len(texts))
                for j in range(len(self.languages)):
                    total[:, j] += np.bincount(doc, self.weights[k, j], minlength=len(texts))
        return total, known

    def tell(self, texts: list[str | None]) -> tuple[list[str | None], np.ndarray]:
        """The likeliest language of each prepared text and its probability; no language and 0 where no n-gram is known. ``languages`` come in order of preference."""
        total, known = self.score(texts)
        z = total * (np.minimum(known, EVIDENCE) / np.maximum(known, 1) / UNIT)[:, None]
        best = np.argmax(total, axis=1)
        p = 1 / np.exp(z - z[np.arange(len(z)), best][:, None]).sum(axis=1)
        return [self.languages[b] if n else None for b, n in zip(best, known, strict=True)], np.where(known > 0, p, 0.0)


def first_texts(labelled: DataFrame, texts: int = TEXTS) -> DataFrame:
    """(language, text): the first ``texts`` rows of each language by hash, of rows (id, text, language) with both.

    Rows of one hash have one text, so they count together; a histogram by the first digits of the hash tells which few hashes
    come into question, and only those are ranked. Only the texts that are chosen move.
    """
    known = labelled.where("text is not null and language is not null").select("language", "id", "text", F.sha2(F.col("text").cast("binary"), 256).alias("hash"))
    bin_ = F.conv(F.substring("hash", 1, 4), 16, 10).cast("int").alias("bin")
    counts = Staged(known.groupBy("language", "hash").agg(F.count("*").alias("times"), F.min("id").alias("id")), "hashes")
    order = Window.partitionBy("language").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)  # 65,536 bins a language
    bins = counts.df.groupBy("language", bin_).agg(F.sum("times").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(order), F.lit(0)))
    few = counts.df.withColumn("bin", bin_).join(F.broadcast(bins.where(F.col("before") < texts).drop("n")), ["language", "bin"])
    upto = F.col("before") + F.coalesce(F.sum("times").over(Window.partitionBy("language", "bin").orderBy("hash").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    some = few.withColumn("upto", upto).where(F.col("upto") < texts)
    chosen = Staged(some.select("language", "hash", "id", F.least("times", F.lit(texts) - F.col("upto")).cast("int").alias("times")), "chosen").df  # ``texts`` a language
    counts.drop()
    same = F.col("k.language").eqNullSafe(F.col("c.language")) & (F.col("k.hash") == F.col("c.hash")) & F.col("k.id").eqNullSafe(F.col("c.id"))
    met = known.alias("k").join(F.broadcast(chosen).alias("c"), same).select("k.language", "k.hash", "k.text", "c.times")
    one = met.dropDuplicates(["language", "hash"])
    return one.select("language", "text", F.explode(F.array_repeat(F.lit(True), F.col("times"))).alias("_")).drop("_")


def counted(labelled: DataFrame, texts: int = TEXTS) -> DataFrame:
    """(language, gram, n) over ``first_texts``."""
    ship(labelled.sparkSession)
    some = first_texts(labelled, texts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            language = np.array(batch.column("language").to_pylist(), object)
            for name in dict.fromkeys(language.tolist()):
                points, at = _points(batch.column("text").filter(pa.array(language == name)).to_pylist())
                place = np.arange(len(points))
                end = at[np.searchsorted(at, place, "right")] if len(points) else place
                codes = [_codes(points, n)[(place + n <= end)[: max(0, len(points) - n + 1)]] for n in range(1, LONGEST + 1)]
                code, n = np.unique(np.concatenate(codes), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(code), pa.string()), pa.array([_gram(c) for c in code.tolist()], pa.string()), pa.array(n.astype(np.int64))], ["language", "gram", "n"])

    return some.select("language", prepared(F.col("text")).alias("text")).mapInArrow(run, "language string, gram string, n bigint").groupBy("language", "gram").agg(F.sum("n").alias("n"))


def train(labelled: DataFrame, texts: int = TEXTS, grams: int = GRAMS) -> DataFrame:
    """The profiles: (language, gram, weight) for each language and each of the ``grams`` most frequent n-grams of any, ties by the n-gram.

    ``labelled`` has id, text and language. A weight is the rounded logarithm of (n + 1/2) / (all + 1/2 of the n-grams), in UNITs.
    """
    counts = Staged(counted(labelled, texts), "grams").df
    rank = F.row_number().over(Window.partitionBy("language").orderBy(F.col("n").desc(), "gram"))
    top = counts.withColumn("rank", rank).where(F.col("rank") <= grams).select("gram").distinct()
    kept = counts.join(top, "gram")
    totals = kept.groupBy("language").agg(F.sum("n").alias("total"))
    size = top.agg(F.count("*").alias("size"))
    every = top.crossJoin(F.broadcast(totals)).crossJoin(F.broadcast(size))  # languages and a number, each a row
    n = F.coalesce("n", F.lit(0))
    weight = F.round(F.log((n + 0.5) / (F.col("total") + 0.5 * F.col("size"))) * UNIT).cast("bigint")
    return every.join(counts, ["language", "gram"], "left").select("language", "gram", weight.alias("weight"))


def profile_of(weights: DataFrame, seed: int = 3407) -> Profile | None:
    """The profiles as arrays: GRAMS rows of each language times the languages at most. Languages go in the order of a seeded hash, which settles ties."""
    rows = weights.collect()
    languages = sorted({r["language"] for r in rows}, key=lambda x: (hashlib.sha256(f"{seed}:{x}".encode()).hexdigest(), x))
    codes = np.array(sorted({_code(r["gram"]) for r in rows}), np.int64)
    out = np.zeros((len(codes), len(languages)))
    at = {x: k for k, x in enumerate(languages)}
    for r in rows:
        out[np.searchsorted(codes, _code(r["gram"])), at[r["language"]]] = r["weight"]
    return Profile(languages, codes, out) if rows else None


def detector(profile: Profile | None) -> Callable[[Column], Column]:
    """Text column -> struct(language, probability), for ``cleaning.clean``; null texts and those without a known n-gram get (null, 0)."""
    if profile is None:
        return lambda _: F.struct(F.lit(None).cast("string").alias("language"), F.lit(0.0).alias("probability"))

    @F.pandas_udf("language string, probability double")
    def told(texts: pd.Series) -> pd.DataFrame:
        languages, p = profile.tell([None if x is None else x for x in texts])
        return pd.DataFrame({"language": languages, "probability": p})

    return lambda text: told(prepared(text))
