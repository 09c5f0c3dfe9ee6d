"""Toxicity: a convolutional text classifier, trained in numpy.

Hashed word embeddings, filters of several widths, rectified and pooled by their maximum over the text, and
one output. For scoring, embeddings times filters are tabulated once, so a filter at a place is a sum of a
few table rows. The threshold is calibrated for each language, which is told from the text's function
words alone; scores are shifted so that every language's threshold lies at 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.shared import chunks, labelled_texts, folds, map_arrow, span_hashes, word_hashes

#: Hash buckets, embedding length, filter widths, filters of each width, training rows of each label at most, passes, step length.
BUCKETS, DIM, WIDTHS, FILTERS, PER_LABEL, EPOCHS, RATE = 1 << 15, 12, (1, 2, 3), 12, 2500, 8, 0.1
#: Training rows that a language needs for a threshold of its own.
LEAST_ROWS = 60

#: Frequent function words of each language.
FUNCTION_WORDS = {
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei".split(),
    "en": "the of and to in is that it was for on are as with his they be at this have from or by not but what all were we when your can".split(),
    "es": "de la que el en y a los del se las por un para con no una su al lo como más pero sus le ya o este sí porque esta".split(),
    "fr": "le la les de des du et un une est en que qui dans pour pas sur au avec ce il sont par plus ne se son sa ou aux mais".split(),
}
LANGUAGES = sorted(FUNCTION_WORDS)


class Model(NamedTuple):
    tables: list[list[np.ndarray]]  # for each width, for each place in the filter: (buckets, filters)
    bias: np.ndarray  # (widths, filters)
    out: np.ndarray  # (widths, filters)
    out_bias: float
    shift: np.ndarray  # logit of the threshold of each language, and of the rest


def _function_hashes() -> tuple[np.ndarray, np.ndarray]:
    words = [(w, k) for k, lang in enumerate(LANGUAGES) for w in FUNCTION_WORDS[lang]]
    data = np.frombuffer("".join(w for w, _ in words).encode(), np.uint8)
    at = np.cumsum([0, *(len(w.encode()) for w, _ in words)])
    h = span_hashes(data, at[:-1], at[1:])
    order = np.argsort(h, kind="stable")
    return h[order], np.array([k for _, k in words])[order]


_FUNCTION, _FUNCTION_LANGUAGE = _function_hashes()


def languages(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Index of the language with most function words in each text; one past the last if there are none."""
    n = len(at) - 1
    votes = np.zeros((n, len(LANGUAGES)))
    text = np.repeat(np.arange(n), np.diff(at))
    lo, hi = np.searchsorted(_FUNCTION, words, "left"), np.searchsorted(_FUNCTION, words, "right")
    for k in range(int((hi - lo).max(initial=0))):
        hit = np.flatnonzero(lo + k < hi)
        np.add.at(votes, (text[hit], _FUNCTION_LANGUAGE[lo[hit] + k]), 1 / (hi - lo)[hit])
    return np.where(votes.sum(axis=1) > 0, votes.argmax(axis=1), len(LANGUAGES))


def pooled(ids: np.ndarray, at: np.ndarray, tables: list[list[np.ndarray]], bias: np.ndarray) -> np.ndarray:
    """(texts, widths, filters): each filter's maximum over the text after rectifying; 0 where the text is shorter than the filter."""
    n, text = len(at) - 1, np.repeat(np.arange(len(at) - 1), np.diff(at))
    out = np.zeros((n, len(tables), bias.shape[1]), np.float32)
    for w, places in enumerate(tables):
        size = len(ids) - len(places) + 1
        if size <= 0:
            continue
        z = places[0][ids[:size]].copy()
        for k, t in enumerate(places[1:], 1):
            z += t[ids[k : k + size]]
        z[text[:size] != text[len(places) - 1 :]] = -np.inf
        full = np.flatnonzero((np.diff(at) > 0) & (at[:-1] < size))
        if len(full):
            out[full, w] = np.maximum(np.maximum.reduceat(z, at[:-1][full], axis=0) + bias[w], 0)
    return out


def logits(texts: list[str | None], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Uncalibrated logit and language of each text."""
    words, at = word_hashes(texts)
    ids = (words & np.uint64(len(model.tables[0][0]) - 1)).astype(np.int64)
    z = (pooled(ids, at, model.tables, model.bias) * model.out).sum(axis=(1, 2)) + model.out_bias
    return z.astype(np.float64), languages(words, at)


def score(texts: list[str | None], model: Model) -> np.ndarray:
    z, lang = logits(texts, model)
    return 1 / (1 + np.exp(-np.clip(z - model.shift[lang], -50, 50)))


def fit(texts: list[str], labels: np.ndarray, seed: int = 11, epochs: int = EPOCHS, rate: float = RATE) -> Model | None:
    """A model of two classes, thresholds calibrated on a fifth of the rows; None unless both classes are there."""
    if len(set(labels.tolist())) < 2:
        return None
    rng = np.random.default_rng(seed)
    # By small groups of texts, so that the driver never holds hashing arrays of the whole sample.
    parts = [word_hashes(texts[lo : lo + 100]) for lo in range(0, len(texts), 100)]
    ids = np.concatenate([(words & np.uint64(BUCKETS - 1)).astype(np.int32) for words, _ in parts])
    at = np.concatenate((np.zeros(1, np.int64), np.cumsum(np.concatenate([np.diff(a) for _, a in parts]))))
    embed = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    filters = [rng.normal(0, 0.3, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
    bias = np.zeros((len(WIDTHS), FILTERS), np.float32)
    out, out_bias = rng.normal(0, 0.1, (len(WIDTHS), FILTERS)).astype(np.float32), np.float32(0)
    seen = [np.full(x.shape, 1e-3, np.float32) for x in (embed, *filters, bias, out)]
    calibrate = np.arange(len(texts)) % 5 == 4
    positive = max(1, int(labels[~calibrate].sum()))
    weight = min(8.0, max(1.0, (len(labels) - positive) / positive / 2))

    def step(value: np.ndarray, sums: np.ndarray, grad: np.ndarray, where=...) -> None:
        sums[where] += grad * grad
        value[where] -= rate * grad / np.sqrt(sums[where])

    for _ in range(epochs):
        for i in rng.permutation(np.flatnonzero(~calibrate)):
            x = ids[at[i] : at[i + 1]]
            if not len(x):
                continue
            e = embed[x]
            top, best = np.zeros_like(out), np.zeros(out.shape, np.int64)
            for w, f in enumerate(filters):
                size = len(x) - len(f) + 1
                if size <= 0:
                    continue
                z = e[:size] @ f[0]
                for k in range(1, len(f)):
                    z += e[k : k + size] @ f[k]
                best[w] = z.argmax(axis=0)
                top[w] = np.maximum(z[best[w], np.arange(FILTERS)] + bias[w], 0)
            keep = rng.random(top.shape) < 0.7  # dropout
            top = top * keep / 0.7
            z = float((top * out).sum() + out_bias)
            g = (1 / (1 + np.exp(-max(-30, min(30, z)))) - labels[i]) * (weight if labels[i] else 1)
            back = g * out * (top > 0) / 0.7
            step(out, seen[-1], g * top + 1e-4 * out)
            out_bias -= np.float32(0.02 * g)
            step(bias, seen[-2], back)
            grad_e: dict[int, np.ndarray] = {}
            for w, f in enumerate(filters):
                live = np.flatnonzero(back[w])
                if not len(live):
                    continue
                grad = np.zeros_like(f)
                for k in range(len(f)):
                    rows = best[w][live] + k
                    grad[k][:, live] = e[rows].T * back[w][live]
                    part = f[k][:, live].T * back[w][live][:, None]
                    for r, p in zip(x[rows].tolist(), part, strict=True):
                        grad_e[r] = grad_e[r] + p if r in grad_e else p
                step(f, seen[1 + w], grad)
            if grad_e:
                rows = np.array(list(grad_e))
                step(embed, seen[0], np.array(list(grad_e.values())), rows)
    tables = [[(embed @ f[k]).astype(np.float32) for k in range(len(f))] for f in filters]
    model = Model(tables, bias, out, float(out_bias), np.zeros(len(LANGUAGES) + 1))
    z, lang = (np.concatenate(x) for x in zip(*(logits(texts[lo : lo + 200], model) for lo in range(0, len(texts), 200)), strict=True))
    return model._replace(shift=thresholds(z, lang, labels, calibrate))


def thresholds(z: np.ndarray, lang: np.ndarray, labels: np.ndarray, calibrate: np.ndarray) -> np.ndarray:
    """The logit that tells the classes apart best, for each language with enough rows; else for all rows."""
    def best(rows: np.ndarray) -> float:
        held = rows & calibrate
        use = held if labels[held].sum() >= 8 else rows
        order = np.argsort(z[use])
        v, y = z[use][order], labels[use][order]
        wrong = np.concatenate(([0], np.cumsum(y == 1))) + np.concatenate((np.cumsum((y == 0)[::-1])[::-1], [0]))
        good = np.flatnonzero(wrong == wrong.min())
        cut = np.concatenate(([v[0] - 2], (v[1:] + v[:-1]) / 2, [v[-1] + 2]))
        gap = np.concatenate(([0], np.diff(v), [0]))
        return float(cut[good[gap[good].argmax()]])

    every = best(np.ones(len(z), bool))
    return np.array([best(lang == k) if (lang == k).sum() >= LEAST_ROWS and 8 <= labels[lang == k].sum() < (lang == k).sum() else every for k in range(len(LANGUAGES) + 1)])


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", fold: int = 0, of: int = 5, per_label: int = PER_LABEL) -> Model | None:
    texts, y = labelled_texts(docs, labels, label, fold, of, per_label)
    return fit(texts, y)


def scored(docs: DataFrame, model: Model | None, least: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted of every row.

    Null and empty texts get the score of a text without words; without a model every score is 0.
    Repeated rows are scored alike; texts are read whole.
    """
    docs = docs.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    if model is None:
        out = docs.select("doc_id", F.lit(0.0).alias("score"))
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


def toxicity_of_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row, by a model learnt from labels.toxic outside fold 0 of five.

    Null and empty texts get the score of a text without words, repeated rows the same score; an empty table gives an empty result,
    and without labels of both classes every score is 0. Other columns of ``docs`` are ignored.
    """
    return scored(docs, train(docs, labels))
