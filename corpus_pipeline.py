"""From documents to packed training sequences: toxicity, exact and near copies, source mix, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of documents, and each works on what the one before
kept.  ``run`` writes a stage as Parquet and reads it again as the next one's
docs.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trajlake.llm.common import stored
from trajlake.llm.exact_dedup import drop_copies
from trajlake.llm.minhash import drop_near_duplicates
from trajlake.llm.mixing import mix_documents
from trajlake.llm.packing import pack_documents
from trajlake.llm.toxicity import drop_toxic, fit_toxicity


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below a half, learned from the labels of documents still there."""
    return drop_toxic(docs, fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the largest id."""
    return drop_copies(docs, keep="max")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles), the one with the smallest id."""
    return drop_near_duplicates(docs, words_each=5, percent=80)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mix_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with the sequence and offset each goes to."""
    return pack_documents(docs)


STAGES = [("toxicity", toxicity), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("source_mix", source_mix),
          ("packing", packing)]

# tokenising, classifying and random rounding can't be said in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = stored(docs)
    return docs
