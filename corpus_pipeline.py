"""Raw documents to packed training sequences, in five stages.

Each stage takes all documents that the one before it left; every stage but the last
returns the columns of ``documents``, with ``n_chars`` following the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.llm.fertility import kept_documents
from feedlens.llm.near_dedup import one_of_each
from feedlens.llm.packing import pack_documents
from feedlens.llm.personal_data import mask
from feedlens.llm.suffix_dedup import without_repeats
from feedlens.session import stored


def _measured(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the text as it is now."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.coalesce(F.char_length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the fertility rules keep."""
    return kept_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, that with the smallest id."""
    return one_of_each(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that a document with a smaller id has."""
    return _measured(without_repeats(docs))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data masked."""
    return _measured(mask(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of packed sequences."""
    return pack_documents(docs)


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("personal_data", personal_data),
    ("packing", packing),
]

#: The stages run fitted models and library tokenizers, which SQL does not have.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over ``documents``; each result is stored and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
