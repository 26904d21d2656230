"""From documents to packed token sequences: five stages, each an operator of ``wharfline.llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wharfline.llm.common import store
from wharfline.llm.decontaminate import drop_contaminated
from wharfline.llm.line_dedup import clean_documents
from wharfline.llm.ngram_join import drop_near_copies
from wharfline.llm.packing import default_tokenizer, pack_documents
from wharfline.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from ``labels``, doesn't reject."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the line chunks that an earlier place holds."""
    return clean_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is similar on shingles of five words, at 0.8 or more."""
    return drop_near_copies(docs, k=5, num=80, den=100)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of full token sequences."""
    return pack_documents(docs, default_tokenizer())


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packing),
]

# A trained classifier and a BPE tokenizer have no SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    *first, (_, last) = STAGES
    for name, stage in first:
        docs = store(stage(spark, docs, sf_dir), name)
    return last(spark, docs, sf_dir)
