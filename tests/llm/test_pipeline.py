"""The pipeline's stages one after the other, and the queries with SQL."""

import oracle
import pytest

import corpus_pipeline
from sparkloom.llm import decontamination, line_dedup, near_dedup, queries
from sparkloom.llm.shared import stage

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_its_sql(spark, name):
    oracle.compare(queries.QUERIES[name](spark, SF), oracle.connect(SF), queries.SQL[name])


def test_every_operator_has_a_query():
    assert {int(n[2:].split("_")[0]) for n in queries.QUERIES} == set(range(1, 14))


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for name, apply in corpus_pipeline.STAGES[:-1]:
        after = stage(apply(spark, docs, SF), name)
        assert after.columns == columns
        if name == "language_id":
            assert after.count() == docs.where("text rlike '[A-Za-z]'").count()
        if name == "line_dedup":
            report = line_dedup.dedup_lines(docs)
            assert after.count() == report.where("n_removed = 0 or text rlike '\\\\S'").count()
            assert after.where("n_chars <> length(text)").count() == 0
        if name == "near_dedup":
            assert sorted(r[0] for r in after.select("doc_id").collect()) == sorted(r[0] for r in near_dedup.near_duplicates(docs).where("kept").select("doc_id").collect())
        if name == "decontaminate":
            marked = decontamination.contamination(docs, spark.read.parquet(f"{SF}/benchmark.parquet"))
            assert after.count() == marked.where("not contaminated").count()
        docs = after
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == docs.count()
    assert packed.groupBy("sequence_id").agg({"length": "sum"}).where("`sum(length)` > 1024").count() == 0
