"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes the documents that its predecessor left, written as Parquet and read back.
All but the last return the columns of documents. What a stage does with nulls, empty
texts, repeated rows, empty tables and further columns is stated by its operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.llm import decontaminate, jaccard, packing, pii, quality
from ledgerlens.llm.common import load, saved

#: Rows and bytes that go to a Python worker at once, set on the session by every stage. Whole
#: texts stand in these frames, on both sides, so they are kept small; no result depends on them.
FRAMES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}


def small_frames(spark: SparkSession) -> None:
    for key, value in FRAMES.items():
        spark.conf.set(key, value)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the production policy."""
    small_frames(spark)
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group connected by similar texts."""
    small_frames(spark)
    return jaccard.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages cut out; documents that are mostly benchmark go."""
    small_frames(spark)
    return decontaminate.remove(docs, load(spark, sf_dir, "benchmark"))


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal values replaced by keyed pseudonyms."""
    small_frames(spark)
    return pii.pseudonymize(docs, pii.PRODUCTION_KEY)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of a document with its place in a training sequence."""
    small_frames(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("pseudonyms", pseudonyms),
    ("best_fit_packing", best_fit_packing),
]

#: SQL has no tokenizer and no keyed permutation; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
