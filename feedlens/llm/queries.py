"""The registered queries of this subpackage: ``name -> function(spark, sf_dir)``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from feedlens.llm import (
    byte_bpe, collocations, fertility, fill_middle, language, near_dedup, neighbours, packing, personal_data,
    preferences, suffix_dedup, token_counts, vector_dedup,
)
from feedlens.llm.common import documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_language(spark, sf_dir):
    return language.identify(documents(spark, sf_dir))


@query
def op2_personal_data(spark, sf_dir):
    return personal_data.personal_data(documents(spark, sf_dir))


@query
def op3_token_counts(spark, sf_dir):
    return token_counts.count_tokens(documents(spark, sf_dir))


@query
def op4_preferences(spark, sf_dir):
    return preferences.preferences(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


ORACLES["op4_preferences"] = preferences.PREFERENCES_SQL


@query
def op5_quality(spark, sf_dir):
    return fertility.quality(documents(spark, sf_dir))


@query
def op6_packing(spark, sf_dir):
    return packing.pack_documents(documents(spark, sf_dir))


@query
def op7_suffix_dedup(spark, sf_dir):
    return suffix_dedup.removal_digests(documents(spark, sf_dir))


ORACLES["op7_suffix_dedup"] = suffix_dedup.REMOVAL_SQL


@query
def op8_neighbours(spark, sf_dir):
    return neighbours.search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query
def op9_near_dedup(spark, sf_dir):
    return near_dedup.classes(documents(spark, sf_dir))


ORACLES["op9_near_dedup"] = near_dedup.NEAR_DEDUP_SQL


@query
def op10_byte_bpe(spark, sf_dir):
    return byte_bpe.encode_digests(documents(spark, sf_dir))


@query
def op11_fill_middle(spark, sf_dir):
    return fill_middle.digests(documents(spark, sf_dir))


ORACLES["op11_fill_middle"] = fill_middle.FILL_MIDDLE_SQL


@query
def op12_vector_dedup(spark, sf_dir):
    return vector_dedup.classes(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


ORACLES["op12_vector_dedup"] = vector_dedup.VECTOR_DEDUP_SQL


@query
def op13_collocations(spark, sf_dir):
    return collocations.collocations(documents(spark, sf_dir))


ORACLES["op13_collocations"] = collocations.COLLOCATIONS_SQL
