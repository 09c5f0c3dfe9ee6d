"""Quality classifier: supervised subword embeddings.

A text is the average of learned vectors of its words and character n-grams, all hashed; a softmax layer
gives the class. Vectors and layer are trained together by stochastic gradient descent in numpy. Since the
average and the layer are linear, scoring needs one number for each bucket: its vector times the
difference of the class weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.shared import chunks, folds, labelled_texts, map_arrow, mix

#: Hash buckets, vector length, n-gram lengths, training rows of each label at most, passes, first step length.
BUCKETS, DIM, NGRAMS, PER_LABEL, EPOCHS, RATE = 1 << 16, 12, (3, 4), 2000, 4, 0.5


class Model(NamedTuple):
    weight: np.ndarray  # of each bucket: its vector times the difference of the class weights
    bias: float
    buckets: int
    ngrams: tuple[int, ...]


def features(texts: list[str | None], buckets: int = BUCKETS, ngrams: tuple[int, ...] = NGRAMS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, bucket) of every word, then of every character n-gram of each length.

    Words are runs without white space, case and punctuation kept; an n-gram may hold the white space before
    or after a word, none inside.
    """
    parts = [(t or "").encode("utf-32-le", "replace") for t in texts]
    at = np.cumsum([0, *(len(p) // 4 + 1 for p in parts)])
    blank = b" \0\0\0"
    data = np.frombuffer(blank.join([*parts, b""]), "<u4")
    space = (data == 32) | ((data >= 9) & (data <= 13)) | (data == 0xA0) | (data == 0x3000)
    code = np.where(space, np.uint64(32), data.astype(np.uint64))
    text = np.repeat(np.arange(len(parts)), np.diff(at))
    step = np.diff(np.concatenate(([True], space, [True])).astype(np.int8))
    starts, ends = np.flatnonzero(step == -1), np.flatnonzero(step == 1)
    # A word's hash: its characters' hashes, weighted by their place in the word.
    each = mix(code * np.uint64(0xBF58476D1CE4E5B9))
    plain, sums = np.zeros((2, len(code) + 1), np.uint64)
    np.cumsum(each, out=plain[1:])
    np.cumsum(each * (2 * np.arange(len(code), dtype=np.uint64) + np.uint64(1)), out=sums[1:])
    h = (sums[ends] - sums[starts]) - (plain[ends] - plain[starts]) * (np.uint64(2) * starts.astype(np.uint64))
    mask = np.uint64(buckets - 1)
    yield text[starts], (mix(h) & mask).astype(np.int64)
    inner = np.concatenate(([0], np.cumsum(space, dtype=np.int64)))
    for n in ngrams:
        size = len(code) - n + 1
        if size <= 0:
            continue
        ok = np.flatnonzero((inner[n - 1 : n - 1 + size] == inner[1 : 1 + size]) & (text[:size] == text[n - 1 :]))
        g = np.zeros(size, np.uint64)
        for k in range(n):
            g = g * np.uint64(0x9E3779B97F4A7C15) + code[k : k + size]
        yield text[ok], ((g[ok] * np.uint64(0xD6E8FEB86659FD93) + np.uint64(n)) >> np.uint64(40)).astype(np.int64) & (buckets - 1)


def by_text(texts: list[str | None], buckets: int, ngrams: tuple[int, ...]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Distinct buckets of each text and how often each occurs."""
    found = list(features(texts, buckets, ngrams))
    key = np.concatenate([t * buckets + b for t, b in found])
    keys, n = np.unique(key, return_counts=True)
    cut = np.searchsorted(keys, np.arange(len(texts) + 1) * buckets)
    return [(keys[a:b] % buckets, n[a:b].astype(np.float32)) for a, b in zip(cut[:-1], cut[1:], strict=True)]


def fit(texts: list[str], labels: np.ndarray, buckets: int = BUCKETS, dim: int = DIM, ngrams: tuple[int, ...] = NGRAMS, epochs: int = EPOCHS, rate: float = RATE, seed: int = 7) -> Model | None:
    """A model of two classes; None unless both are there."""
    if len(set(labels.tolist())) < 2:
        return None
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dim, 1 / dim, (buckets, dim)).astype(np.float32)
    layer, bias = np.zeros((dim, 2), np.float32), np.zeros(2, np.float32)
    rows = [f for lo in range(0, len(texts), 200) for f in by_text(texts[lo : lo + 200], buckets, ngrams)]
    done, total = 0, epochs * len(rows)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            lr = rate * (1 - done / total)
            done += 1
            b, n = rows[i]
            share = n / n.sum() if len(n) else n
            hidden = share @ vectors[b] if len(b) else np.zeros(dim, np.float32)
            z = hidden @ layer + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[labels[i]] -= 1
            back = layer @ p
            layer -= lr * np.outer(hidden, p)
            bias -= lr * 0.1 * p
            if len(b):
                # An average spreads its gradient thinly; scaled up by the number of features, as each counts as one word.
                vectors[b] -= lr * np.outer(np.minimum(n, 8) / min(len(n), 64), back)
    return Model((vectors @ (layer[:, 1] - layer[:, 0])).astype(np.float64), float(bias[1] - bias[0]), buckets, ngrams)


def score(texts: list[str | None], model: Model) -> np.ndarray:
    """Probability of label 1 for each text."""
    total, count = np.zeros(len(texts)), np.zeros(len(texts))
    for text, bucket in features(texts, model.buckets, model.ngrams):
        total += np.bincount(text, model.weight[bucket], len(texts))
        count += np.bincount(text, minlength=len(texts))
    return 1 / (1 + np.exp(-np.clip(total / np.maximum(count, 1) + model.bias, -50, 50)))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", fold: int = 0, of: int = 5, per_label: int = PER_LABEL) -> Model | None:
    texts, y = labelled_texts(docs, labels, label, fold, of, per_label)
    return fit(texts, y)


def scored(docs: DataFrame, model: Model | None, least: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted of every row.

    Null and empty texts get the score of the bias alone; without a model (no labelled rows, or of one
    class) every score is 0.5. Repeated rows are scored alike; texts are read whole.
    """
    docs = docs.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    if model is None:
        out = docs.select("doc_id", F.lit(0.5).alias("score"))
    else:
        shared = docs.sparkSession.sparkContext.broadcast(tuple(model))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model = Model(*shared.value)
            for batch in batches:
                for part in chunks(batch):
                    yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(score(part.column("text").to_pylist(), model))], ["doc_id", "score"])

        out = map_arrow(docs, run, f"doc_id {kind}, score double")
    held = F.coalesce(folds(F.col("doc_id"), 5) == 0, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= least).cast("int").alias("predicted"))


def quality_of_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row, by a model learnt from labels.quality outside fold 0 of five.

    Null and empty texts get the score of the bias alone, repeated rows the same score; an empty table gives an empty result,
    and without labels of both classes every score is 0.5. Other columns of ``docs`` are ignored.
    """
    return scored(docs, train(docs, labels))
