"""Repair of leaks by whole groups, against a walk in plain Python."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkloom.operators import repair, similarity
from sparkloom.plans import catalogue
from sparkloom.plans.evaluation import grouped

SF = "/root/testdata/sf0.001"
PAIRS = [("train", "validation"), ("train", "test"), ("validation", "test")]


def key(seed, group):
    return hashlib.sha256(f"{seed}:{group}".encode()).hexdigest()


def walk(needs, pools):
    """One candidate after the other, as the rule says; what is larger than the rest to fill is passed over."""
    taken, chosen, unmet = set(), [], []
    for _, target, left in sorted(needs):
        for group, size in pools.get(target, []):
            if group not in taken and size <= left:
                taken.add(group)
                chosen.append((group, target))
                left -= size
        if left:
            unmet.append((target, left))
    return chosen, unmet


def plain_repair(rows, threshold, seed=3407, rounds=10):
    """rows: id -> (vector, group, category, source, hardness, split)."""
    members = defaultdict(list)
    for i in sorted(rows):
        members[rows[i][1]].append(i)
    split = {g: rows[m[0]][5] for g, m in members.items()}
    vectors, blocked = {i: np.array(r[0]) for i, r in rows.items()}, set()
    for round_ in range(1, rounds + 1):
        leaking = set()
        for left, right in PAIRS:
            ask, answer = (left, right) if right == "train" else (right, left)
            there = [vectors[i] for i in rows if split[rows[i][1]] == answer]
            if there:
                leaking |= {rows[i][1] for i in rows if split[rows[i][1]] == ask and np.max(np.array(there) @ vectors[i]) >= threshold}
        if not leaking:
            return {i: split[r[1]] for i, r in rows.items()}
        needs = [(g, split[g], len(members[g]), rows[members[g][0]][2:4]) for g in leaking]
        for g in leaking:
            split[g] = "train"
        blocked |= leaking
        before, chosen = dict(split), []
        for stratum in {n[3] for n in needs}:
            pools = {}
            for target in {n[1] for n in needs if n[3] == stratum}:
                largest, could = max(n[2] for n in needs if n[3] == stratum and n[1] == target), []
                for g, m in members.items():
                    if before[g] != "train" or g in blocked or rows[m[0]][2:4] != stratum or len(m) > largest:
                        continue
                    others = [vectors[i] for i in rows if rows[i][1] != g and before[rows[i][1]] != target]
                    if not others or max(np.max(np.array(others) @ vectors[i]) for i in m) < threshold:
                        hard = rows[m[0]][4] if target == "test" and stratum[0] == "troubleshooting" else 0
                        could.append((-hard, key(seed + round_, g), g, len(m)))
                pools[target] = [(g, n) for _, _, g, n in sorted(could)]
            got, unmet = walk([n[:3] for n in needs if n[3] == stratum], pools)
            if unmet:
                raise ValueError(unmet)
            chosen += got
        split |= dict(chosen)
    raise RuntimeError


def test_fill_equals_the_walk():
    rng = random.Random(2)
    for _ in range(400):
        pools = {t: [(f"g{rng.randrange(40)}", 0) for _ in range(rng.randrange(30))] for t in ("test", "validation")}
        pools = {t: [(g, int(g[1:]) % 5 + 1) for g in dict.fromkeys(g for g, _ in p)] for t, p in pools.items()}
        needs = [(f"n{k}", rng.choice(["test", "validation"]), rng.randrange(1, 9)) for k in range(rng.randrange(6))]
        chosen, unmet = repair.fill(needs, pools)
        assert (chosen, unmet) == walk(needs, pools), (needs, pools)


def clustered(seed, many=320):
    """Groups of one to five near vectors; some groups lie near a group of another split."""
    rng = np.random.default_rng(seed)
    rows, i = {}, 0
    for g in range(many):
        centre = rng.normal(size=24)
        if g and g % 7 == 0:
            centre = last + rng.normal(size=24) * 0.05
        last = centre
        size = 1 + int(rng.integers(5))
        split = "test" if g % 10 == 0 else "validation" if g % 10 == 3 else "train"
        category = "troubleshooting" if g % 4 else "other"
        for _ in range(size):
            v = centre + rng.normal(size=24) * 0.05
            rows[i] = ((v / np.linalg.norm(v)).tolist(), f"g{g}", category, "s" if g % 3 else None, g % 6, split)
            i += 1
    return rows


@pytest.mark.parametrize("seed", [1])
def test_groups_move_as_the_plain_walk_moves_them(spark, seed):
    rows = clustered(seed)
    df = spark.createDataFrame([(i, *r) for i, r in rows.items()], "id bigint, vector array<double>, group string, category string, source string, hardness int, split string")
    out = repair.repair(df, PAIRS, 0.9)
    assert out.columns == df.columns
    got = {r["id"]: r["split"] for r in out.collect()}
    assert got == plain_repair(rows, 0.9) and got != {i: r[5] for i, r in rows.items()}
    assert similarity.leaks(out, PAIRS, 0.9).isEmpty()
    assert out.groupBy("group").agg(F.count_distinct("split").alias("n")).where("n > 1").isEmpty()


def test_the_query_splits_no_group_and_keeps_the_counts(spark):
    before = grouped(spark, SF)
    after = before.drop("split").join(catalogue.QUERIES["leak_repair_result"](spark, SF).select("id", "split"), "id").cache()
    counts = lambda df: {tuple(r) for r in df.groupBy("split", "category").count().collect()}
    assert counts(before) == counts(after)
    assert similarity.leaks(after, PAIRS, 0.4).isEmpty()
    assert after.groupBy("group").agg(F.count_distinct("split").alias("n")).where("n > 1").isEmpty()
    rows = {r["id"]: (r["vector"], r["group"], r["category"], r["source"], r["hardness"], r["split"]) for r in before.collect()}
    assert {r["id"]: r["split"] for r in after.collect()} == plain_repair(rows, 0.4)


def test_split_groups_and_hopeless_strata_are_refused(spark):
    schema = "id int, vector array<double>, group string, category string, source string, hardness int, split string"
    rows = [(1, [1.0, 0.0], "a", "c", "s", 0, "train"), (2, [1.0, 0.0], "b", "c", "s", 0, "test")]
    with pytest.raises(ValueError, match="cannot fill 1 test"):
        repair.repair(spark.createDataFrame(rows, schema), PAIRS, 0.9)
    with pytest.raises(ValueError, match="several splits"):
        repair.repair(spark.createDataFrame([*rows, (3, [0.0, 1.0], "b", "c", "s", 0, "train")], schema), PAIRS, 0.9)
    # the only free group is larger than what is needed
    large = [*rows, (3, [0.0, 1.0], "big", "c", "s", 0, "train"), (4, [0.0, 1.0], "big", "c", "s", 0, "train")]
    with pytest.raises(ValueError, match="cannot fill"):
        repair.repair(spark.createDataFrame(large, schema), PAIRS, 0.9)


def test_angles_spare_most_pairs_of_blocks(spark):
    """On clustered vectors fewer than a fifth of the pairs of blocks are joined, and nothing is lost."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(40, 16))
    x = centres[rng.integers(40, size=3000)] + rng.normal(size=(3000, 16)) * 0.08
    x[:400] = x[0]  # a hot vector
    x[400] = 0
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x / np.maximum(np.linalg.norm(x, axis=1), 1e-9)[:, None])], "id bigint, vector array<double>").cache()
    pivots = similarity.pivots_of(df, 64)
    blocks = similarity.Blocks(similarity.deal(df, pivots, 64), pivots)
    assert max(len(r["ids"]) for r in blocks.packed.select("ids").collect()) <= 160
    joined, all_pairs = similarity.block_pairs(blocks, blocks, 0.9).count(), blocks.packed.count() ** 2
    assert joined < all_pairs / 5, (joined, all_pairs)
    unit = np.array([r["vector"] for r in df.orderBy("id").collect()])
    s = unit @ unit.T
    got = {(r["src"], r["dst"]) for r in similarity.cosine_pairs(df, 0.9, 64).collect()}
    i, j = np.nonzero(np.triu(s, 1) >= 0.9)
    assert got == set(zip(i.tolist(), j.tolist(), strict=True))
    q = df.where("id % 100 = 7")
    for least in (None, 0.8):
        found = {(r["query"], r["rank"]): r["score"] for r in similarity.nearest(q, df, 3, 64, least).collect()}
        want = {(i, k + 1): v for i in range(7, 3000, 100) for k, v in enumerate(sorted(s[i], reverse=True)[:3]) if least is None or v >= least}
        assert found.keys() == want.keys() and all(abs(found[k] - want[k]) < 1e-9 for k in want)


def test_places_that_no_group_fits_can_stay_empty(spark):
    schema = "id int, vector array<double>, group string, category string, source string, hardness int, split string"
    rows = [(1, [1.0, 0.0], "a", "c", "s", 0, "train"), (2, [1.0, 0.0], "b", "c", "s", 0, "test"), (3, [0.0, 1.0], "d", "e", "s", 0, "test")]
    got = repair.repair(spark.createDataFrame(rows, schema), PAIRS, 0.9, strict=False).select("id", "split").collect()
    assert dict(map(tuple, got)) == {1: "train", 2: "train", 3: "test"}
    none = repair.repair(spark.createDataFrame(rows, schema), PAIRS, 0.9, most_rounds=0, strict=False).select("id", "split").collect()
    assert dict(map(tuple, none)) == {1: "train", 2: "test", 3: "test"}


def shuffled(spark):
    """Bytes that all shuffles so far have written."""
    executors = spark.sparkContext._jsc.sc().statusStore().executorList(False)
    return sum(executors.apply(i).totalShuffleWrite() for i in range(executors.size()))


def test_pairs_of_blocks_take_no_disk(spark, tmp_path):
    """Vectors without structure, of which no pair of blocks is ruled out: what is shuffled stays within a few times the table."""
    x = np.random.default_rng(3).normal(size=(6000, 48))
    x /= np.linalg.norm(x, axis=1)[:, None]
    split = lambda i: "test" if i % 10 == 0 else "validation" if i % 10 == 3 else "train"
    rows = [(i, v.tolist(), f"g{i}", "c", "s", 0, split(i)) for i, v in enumerate(x)]
    spark.createDataFrame(rows, "id bigint, vector array<double>, group string, category string, source string, hardness int, split string").write.parquet(f"{tmp_path}/x")
    usual, before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), shuffled(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for a table that is too large
    try:
        out = repair.repair(spark.read.parquet(f"{tmp_path}/x"), PAIRS, 0.55, most_rounds=1, strict=False).select("id", "split").collect()
        grown = shuffled(spark) - before
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual)
    assert {r["id"]: r["split"] for r in out} != {r[0]: r[6] for r in rows}
    assert grown < 10 * x.nbytes, grown / x.nbytes


def test_reached_finds_every_link_and_no_other(spark):
    """Also where dot products lie at the threshold, where norms are very large or zero, and within a label."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(700, 8)).astype(np.float32).astype(np.float64)
    x /= np.linalg.norm(x, axis=1)[:, None]
    x[:300, 0] = 0.5
    x[300] = [1.0, *[0.0] * 7]  # 0.5 to the first ones
    x[301], x[302:304], x[304] = [1 - 1e-12, *[0.0] * 7], 0, x[5] * 1e12
    sides, names = ["a" if i % 3 else "b" for i in range(700)], [f"l{i // 2}" for i in range(700)]
    df = spark.createDataFrame([(i, v.tolist(), names[i], sides[i]) for i, v in enumerate(x)], "id int, vector array<double>, name string, split string")
    pivots = similarity.pivots_of(df, 64)
    blocks = similarity.Blocks(similarity.deal(df, pivots, 64), pivots, "name", "split")
    for least, rule in ((0.5, None), (0.5, [("a", "b")]), (0.97, None), (-0.2, None)):
        s = x @ x.T
        want = {(names[i], sides[j]) for i, j in zip(*np.nonzero(s >= least), strict=True) if names[i] != names[j] and (rule is None or (sides[i], sides[j]) in rule)}
        got = [tuple(r) for r in similarity.reached(blocks, blocks, least, rule).collect()]
        assert len(got) == len(set(got)) and set(got) == want, least
    assert "CartesianProduct" in similarity.reached(blocks, blocks, 0.5)._jdf.queryExecution().executedPlan().toString()
