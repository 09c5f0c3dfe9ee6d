"""Every query with SQL against that SQL; the others must run."""

import oracle
import pytest

from sparkloom.plans import catalogue

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, con, name):
    df = catalogue.QUERIES[name](spark, SF)
    if name in catalogue.SQL:
        oracle.compare(df, con, catalogue.SQL[name])
    else:
        assert df.count() > 0


def test_partitioning_does_not_change_results(spark, con):
    from pyspark.sql import functions as F

    from sparkloom.operators import split
    from sparkloom.plans.bridges import groups

    g = groups(spark, SF)
    a = {r["group"]: r["split"] for r in split.allocate(g).collect()}
    b = {r["group"]: r["split"] for r in split.allocate(g.repartition(7, F.rand(3))).collect()}
    assert a == b


def test_topk_finds_rows_that_ask_too(spark, tmp_path):
    rows = [(i, [1.0, 0.0] if i in (0, 100) else [0.5, i / 1000], 0) for i in range(201)]
    spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {(r["query"], r["rank"]): r["reference"] for r in catalogue.QUERIES["cosine_topk"](spark, str(tmp_path)).collect()}
    assert [got[0, k] for k in range(1, 6)] == [100, 1, 2, 3, 4] and got[100, 1] == 0 and len(got) == 15
    assert all(q != r for (q, _), r in got.items())
