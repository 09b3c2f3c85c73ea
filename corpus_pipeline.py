"""Corpus preparation: STAGES in order, each written as Parquet and read again before the next.

1. language      texts without a language (null, or no letter at all) go; the classifier learns
                 from the language column of what it is given
2. near_copies   one document of each SimHash component stays: the smallest id
3. benchmark     documents that hold a window of a benchmark item go
4. secrets       live-looking credentials become ``[secret]``; copied examples stay
5. tokens        ids and decoded text of what is left, as digests

All but the last return the columns of ``documents``.  Rows with null ids, repeated rows, empty
tables and further columns pass through as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltframe.llm import bpe, decontaminate, langid, secrets, simhash
from voltframe.llm.common import prepare, stage, table
from voltframe.llm.queries import WORD_BPE


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return langid.keep_known(docs, langid.fit(docs, F.lit(True)))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return simhash.keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), how="drop")


def masked_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    out = secrets.redact(docs)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return bpe.digests(docs.select("doc_id", "text"), WORD_BPE, drop=("text",))


STAGES = [("language", language), ("near_copies", near_copies), ("benchmark", benchmark), ("secrets", masked_secrets),
          ("tokens", encoded)]

# Encoding and the trained classifier have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"corpus-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
