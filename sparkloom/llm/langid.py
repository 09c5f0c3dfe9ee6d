"""Language identification by segmentation-marginalised unigrams.

The pieces are those of a fixed public vocabulary. Each language has a probability for each piece, and a
word's probability under a language is the sum over all its segmentations into pieces, by the
forward algorithm; a text's is the product over its words. Piece probabilities are fitted by expectation
maximisation over the same lattices. Words are scored once for each block of text, all languages and all
words of a length at a time.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator
from itertools import islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.shared import chunks, folds, free_name, map_arrow, sampled_texts

#: Training rows for each language at most, rounds of expectation maximisation, pseudo-count of a piece.
PER_LANGUAGE, ROUNDS, PSEUDO = 300, 3, 0.05
#: Probability of a character outside the vocabulary, in every language.
UNKNOWN = 1e-7
WORD_START = "▁"


class Model(NamedTuple):
    languages: list[str]
    edges: np.ndarray  # sorted (node << 21 | code point) of the trie of pieces
    child: np.ndarray  # the node each edge leads to
    piece: np.ndarray  # piece that ends at a node, or -1
    p: np.ndarray  # (pieces, languages)
    prior: np.ndarray  # log prior of each language


def vocabulary(path: str) -> list[str]:
    """The ordinary pieces of a SentencePiece model, in lower case, without repetition."""
    import sentencepiece

    s = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [s.id_to_piece(i) for i in range(s.get_piece_size()) if not (s.is_control(i) or s.is_unknown(i) or s.is_byte(i) or s.is_unused(i))]
    return list(dict.fromkeys(p.lower() for p in pieces if p))


def trie(pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    nodes: dict[tuple[int, int], int] = {}
    ends = {0: -1}
    for k, p in enumerate(pieces):
        at = 0
        for c in p:
            nxt = nodes.setdefault((at, ord(c)), len(nodes) + 1)
            ends.setdefault(nxt, -1)
            at = nxt
        ends[at] = k
    edges = np.array([(a << 21) | c for a, c in nodes], np.int64)
    child = np.array(list(nodes.values()), np.int64)
    order = np.argsort(edges)
    return edges[order], child[order], np.array([ends[i] for i in range(len(nodes) + 1)], np.int64)


_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    """Runs of letters in lower case."""
    return _WORD.findall((text or "").lower())


class Lattice:
    """The arcs of all segmentations of words of one length (in code points)."""

    def __init__(self, words: list[str], edges: np.ndarray, child: np.ndarray, piece: np.ndarray):
        self.n, self.size = len(words), len(words[0])
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").reshape(self.n, self.size).astype(np.int64)
        self.by_start: list[tuple[int, list[tuple[int, np.ndarray, np.ndarray]]]] = []  # start; end, words, pieces
        for start in range(self.size):
            arcs: list[tuple[int, np.ndarray, np.ndarray]] = []
            self.by_start.append((start, arcs))
            rows, node = np.arange(self.n), np.zeros(self.n, np.int64)
            single = np.zeros(self.n, bool)
            for end in range(start + 1, self.size + 1):
                key = (node << 21) | codes[rows, end - 1]
                k = np.searchsorted(edges, key)
                k[k == len(edges)] = 0
                ok = edges[k] == key
                rows, node = rows[ok], child[k[ok]]
                if not len(rows):
                    break
                done = piece[node] >= 0
                if done.any():
                    arcs.append((end, rows[done], piece[node[done]]))
                    if end == start + 1:
                        single[rows[done]] = True
            lone = np.flatnonzero(~single)
            if len(lone):
                arcs.append((start + 1, lone, np.full(len(lone), -1)))

    def forward(self, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(alpha, log scale): alpha[i] for the prefix of i code points, times exp(scale[i]); p has a last row for unknown characters.

        Every 24 code points the numbers are brought back into range, so words may be of any length.
        """
        alpha = np.zeros((self.size + 1, self.n, p.shape[1]))
        scale = np.zeros((self.size + 1, self.n, p.shape[1]))
        alpha[0] = 1
        for start, arcs in self.by_start:
            if start and start % 24 == 0:
                top = np.maximum(alpha[start:].max(axis=0), 1e-300)
                alpha[start:] /= top
                scale[start:] += np.log(top)
            for end, rows, pieces in arcs:
                alpha[end, rows] += alpha[start, rows] * p[pieces]
        return alpha, scale

    def log_likelihood(self, p: np.ndarray) -> np.ndarray:
        alpha, scale = self.forward(p)
        return np.log(np.maximum(alpha[self.size], 1e-300)) + scale[self.size]

    def expected(self, p: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Expected uses of each piece, by language, given how often each word occurs."""
        alpha, scale = self.forward(p)
        # beta[i] times exp(scale[size] - scale[i]) is the probability of what follows i, in the scale of the forward pass.
        beta = np.zeros_like(alpha)
        beta[self.size] = 1
        for start, arcs in reversed(self.by_start):
            for end, rows, pieces in arcs:
                beta[start, rows] += beta[end, rows] * p[pieces] * np.exp(scale[start, rows] - scale[end, rows])
        weight = counts / np.maximum(alpha[self.size], 1e-300)
        out = np.zeros_like(p)
        for start, arcs in self.by_start:
            for end, rows, pieces in arcs:
                use = alpha[start, rows] * p[pieces] * np.exp(scale[start, rows] - scale[end, rows]) * beta[end, rows] * weight[rows]
                for k in range(p.shape[1]):
                    out[:, k] += np.bincount(pieces % len(p), use[:, k], len(p))
        return out


def lattices(words: list[str], model_trie) -> Iterator[tuple[np.ndarray, Lattice]]:
    """Words by length, in blocks whose arrays stay small, with their positions."""
    sizes = np.array([len(w) for w in words])
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        step = max(1, (1 << 17) // int(size))
        for lo in range(0, len(rows), step):
            some = rows[lo : lo + step]
            yield some, Lattice([WORD_START + words[i] for i in some], *model_trie)


def fit(texts: list[str], languages: list[str], pieces: list[str], rounds: int = ROUNDS, pseudo: float = PSEUDO) -> Model:
    """Piece probabilities by language from texts of known language."""
    known = sorted(set(languages))
    at = {lang: k for k, lang in enumerate(known)}
    seen: dict[str, np.ndarray] = {}
    for text, lang in zip(texts, languages, strict=True):
        for w, n in Counter(words_of(text)).items():
            seen.setdefault(w, np.zeros(len(known)))[at[lang]] += n
    edges, child, piece = trie(pieces)
    words = sorted(seen)
    counts = np.array([seen[w] for w in words]).reshape(len(words), len(known))
    blocks = list(lattices(words, (edges, child, piece))) if words else []
    p = np.full((len(pieces) + 1, len(known)), 1 / len(pieces))
    for _ in range(rounds):
        p[-1] = UNKNOWN
        use = np.full_like(p, pseudo)
        for rows, lattice in blocks:
            use += lattice.expected(p, counts[rows])
        use[-1] = 0
        p = use / use.sum(axis=0)
    p[-1] = UNKNOWN
    return Model(known, edges, child, piece, p, np.zeros(len(known)))


class _Index(dict):
    """Numbers words in order of first use."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


class Scorer:
    """Scores texts by a model, remembering the scores of up to ``most`` words between calls."""

    def __init__(self, model: Model, most: int = 400_000):
        self.model, self.most = model, most
        self.index, self.by_word = _Index(), np.zeros((0, len(model.languages)))

    def score(self, texts: list[str | None]) -> np.ndarray:
        """Log-likelihood of each text under each language."""
        if len(self.index) > self.most:
            self.index, self.by_word = _Index(), self.by_word[:0]
        known, number = len(self.index), self.index.__getitem__
        ids, sizes = [], []
        for text in texts:
            found = words_of(text)
            ids += map(number, found)
            sizes.append(len(found))
        words = list(islice(self.index, known, None))
        fresh = np.zeros((len(words), len(self.model.languages)))
        if words:
            for rows, lattice in lattices(words, (self.model.edges, self.model.child, self.model.piece)):
                fresh[rows] = lattice.log_likelihood(self.model.p)
        self.by_word = np.concatenate((self.by_word, fresh))
        doc, ids = np.repeat(np.arange(len(texts)), sizes), np.array(ids, np.int64)
        return np.stack([np.bincount(doc, self.by_word[ids, k], len(texts)) for k in range(len(self.model.languages))], axis=1)


def score(texts: list[str | None], model: Model) -> np.ndarray:
    return Scorer(model).score(texts)


_scorers: dict[str, Scorer] = {}


def train(docs: DataFrame, vocabulary_path: str, fold: int = 2, of: int = 4, per_language: int = PER_LANGUAGE) -> Model | None:
    """A model from a bounded sample (``sampled_texts``) of the rows with a text and a language outside fold ``fold``; None where there are none."""
    rows = docs.where("doc_id is not null and lang is not null and text is not null").where(folds(F.col("doc_id"), of) != fold)
    got = sampled_texts(rows.select("doc_id", F.col("lang").alias("label"), "text"), per_language)
    return fit([t for t, _ in got], [lang for _, lang in got], vocabulary(vocabulary_path)) if got else None


def identify(docs: DataFrame, model: Model | None, pred: str = "lang_pred", score: str = "lang_score") -> DataFrame:
    """``docs`` with the columns ``pred`` and ``score`` (columns of these names are replaced).

    Null texts, texts without a letter, and all texts where there is no model, are ``und`` with score 0.
    Otherwise ``score`` is the posterior probability of ``pred``, languages being equally likely before.
    Texts are read whole; repeated rows are scored alike.
    """
    docs = docs.drop(pred, score)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields) + f", `{pred}` string, `{score}` double"
    if model is None:
        return docs.withColumns({pred: F.lit("und"), score: F.lit(0.0)})
    shared, name = docs.sparkSession.sparkContext.broadcast(tuple(model)), uuid.uuid4().hex

    def tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _scorers:
            _scorers.clear()
            _scorers[name] = Scorer(Model(*shared.value))
        scorer, model = _scorers[name], _scorers[name].model
        for batch in batches:
            for part in chunks(batch, most=2 << 20):
                texts = part.column("text").to_pylist()
                like = scorer.score(texts) + model.prior
                best = like.argmax(axis=1)
                share = 1 / np.exp(like - like.max(axis=1, keepdims=True)).sum(axis=1)
                letters = [t is not None and any(c.isalpha() for c in t) for t in texts]
                found = [model.languages[k] if ok else "und" for k, ok in zip(best, letters, strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.string()), pa.array(np.where(letters, share, 0.0), pa.float64())], [*part.schema.names, pred, score])

    return map_arrow(docs, tag, schema)


def language_of_documents(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row; learnt from folds 0, 1 and 3 of four.

    Null texts and texts without a letter are ``und`` with score 0, as are all where nothing can be learnt; repeated rows are alike; an empty
    table gives an empty result. Other columns of ``docs`` are ignored.
    """
    model = train(docs, vocabulary_path)
    return identify(docs.select("doc_id", "text"), model).select("doc_id", F.coalesce(folds(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


def keep_identified(docs: DataFrame, model: Model | None, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose text has a language with posterior ``least`` or more, with all their columns.

    Null texts and texts without a letter go. Without a model (no row to learn from) every text with a letter stays.
    Repeated rows are treated alike; an empty table stays empty.
    """
    if model is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    pred, score_ = free_name(docs, "lang_pred"), free_name(docs, "lang_score")
    return identify(docs, model, pred, score_).where((F.col(pred) != "und") & (F.col(score_) >= least)).drop(pred, score_)
