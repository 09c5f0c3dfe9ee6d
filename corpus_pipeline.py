"""The corpus pipeline: five stages over ``documents``, each one operator of ``sparkloom.llm``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
``documents``. Each works on all rows that the stage before it kept:

1. language_id: documents without a letter, or whose language is in doubt, go;
2. line_dedup: of lines that are alike one stays; documents that lose all their lines go;
3. near_dedup: of near-duplicate documents the one with the least id stays;
4. decontaminate: documents that hold a benchmark item go;
5. pack: the rest is packed into sequences of 1024 tokens.

Empty tables give empty results; null texts are rejected by the first stage. Where no row tells a language, the first stage keeps
every text with a letter. Repeated rows are alike up to the third stage, which keeps one of them. All columns of ``documents`` pass
through, whatever their names; n_chars follows the text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sparkloom.llm import decontamination, langid, line_dedup, near_dedup, packing
from sparkloom.llm.shared import Staged, scope


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = langid.train(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return langid.keep_identified(docs, model)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.drop_repeated_lines(docs)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep_one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", dedup_lines),
    ("near_dedup", dedup_documents),
    ("decontaminate", decontaminate),
    ("pack", pack),
]

#: Line and near dedup, and the tokens, can't be told in SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage over all documents; each stage is written to the scratch folder and read again."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, apply in STAGES[:-1]:
        with scope():  # what a stage needed on its way goes once its result is written
            now = Staged(apply(spark, docs, sf_dir), name)
        if before is not None:
            before.drop()
        docs, before = now.df, now
    return STAGES[-1][1](spark, docs, sf_dir)
