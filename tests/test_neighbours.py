"""The graph of near neighbours against all pairs."""

import numpy as np
import pytest

from sparkloom.operators import neighbours, similarity

SF = "/root/testdata/sf0.1"


def frame(spark, x):
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id bigint, vector array<double>").cache()


def test_recall_of_neighbours(spark):
    """Of the true ten nearest at least 0.95 are found, in blocks much smaller than the table."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(30, 12))[rng.integers(30, size=2500)] + rng.normal(size=(2500, 12)) * 0.4
    x /= np.linalg.norm(x, axis=1)[:, None]
    s = x @ x.T
    np.fill_diagonal(s, -2)
    want = {(i, j) for i, row in enumerate(np.argsort(-s, axis=1)[:, :10].tolist()) for j in row}
    found = neighbours.graph(frame(spark, x), 20, start=64).collect()
    assert all(abs(s[r["src"], r["dst"]] - r["score"]) < 1e-9 for r in found)
    got = {(r["src"], r["dst"]) for r in found}
    assert len(want & got) >= 0.95 * len(want), len(want & got) / len(want)
    assert max(np.bincount([r["src"] for r in found])) <= 20


def test_links_of_the_table_and_copies(spark):
    from sparkloom.plans.evaluation import TAU, vectors

    v = vectors(spark, SF).select("id", "vector")
    exact = {(r["src"], r["dst"]) for r in similarity.cosine_pairs(v, TAU).collect()}
    got = {tuple(sorted(r)) for r in neighbours.links(v, TAU).collect()}
    assert got <= exact and len(got) >= 0.95 * len(exact)
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 8))
    x[50:200] = x[50]  # a group of copies larger than k
    x[250] = 0
    df = frame(spark, x / np.maximum(np.linalg.norm(x, axis=1), 1e-9)[:, None])
    parts = {r["id"]: r["component"] for r in similarity.components(df, neighbours.links(df, 0.999)).collect()}
    assert {parts[i] for i in range(50, 200)} == {50} and len(set(parts.values())) == 151
    assert neighbours.links(df.limit(0), 0.9).isEmpty()


def test_no_link_of_components_is_lost(spark):
    """More weak neighbours over the threshold than a graph of 20 names, copies, and blocks of several tiles."""
    from sparkloom.operators import graph

    rng = np.random.default_rng(6)
    x = rng.normal(size=(700, 24))
    x[100:180] = x[100]
    x /= np.linalg.norm(x, axis=1)[:, None]
    i, j = np.nonzero(np.triu(x @ x.T >= 0.62, 1))
    node, least = graph.least_labels(i, j)
    want = {k: k for k in range(700)} | dict(zip(node.tolist(), least.tolist(), strict=True))
    df = frame(spark, x)
    for size in (None, 64):
        got = similarity.components(df, similarity.cosine_pairs(df, 0.62, size, forest=True)).collect()
        assert {r["id"]: r["component"] for r in got} == want
    assert {r["id"]: r["component"] for r in similarity.components(df, neighbours.exact_links(df, 0.62)).collect()} == want


def test_blocks_of_a_join_do_not_multiply_with_the_table(spark, monkeypatch):
    monkeypatch.setattr(similarity, "BLOCK", 8)
    monkeypatch.setattr(similarity, "SPREAD", 4)
    made = []
    exact = similarity.Blocks
    monkeypatch.setattr(similarity, "Blocks", lambda *a: made.append(exact(*a)) or made[-1])
    x = np.random.default_rng(2).normal(size=(600, 6))
    x /= np.linalg.norm(x, axis=1)[:, None]
    got = {(r["src"], r["dst"]) for r in similarity.cosine_pairs(frame(spark, x), 0.9).collect()}
    assert got == set(zip(*(k.tolist() for k in np.nonzero(np.triu(x @ x.T >= 0.9, 1))), strict=True))
    assert made[0].packed.count() <= 4 * 4 * 2
