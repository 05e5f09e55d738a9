"""The corpus pipeline: two filters, two kinds of duplicates, packing; stage by stage over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from surelake import session
from surelake.llm import exact_dedup, packing, quality, simhash, toxicity
from surelake.llm.common import table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject. It learns from the labelled documents among those given."""
    return quality.score(docs, table(spark, sf_dir, "labels")).where("predicted = 1").select(*docs.columns)


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject, learned likewise."""
    return toxicity.score(docs, table(spark, sf_dir, "labels")).where("predicted = 0").select(*docs.columns)


def unique_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.keep_unique(docs)


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of near copies."""
    return simhash.keep_one_of_each(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the token sequences of the documents left."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", good_quality),
    ("toxicity", not_toxic),
    ("exact dedup", unique_texts),
    ("SimHash near-dedup", no_near_copies),
    ("packing", packed),
]

#: SQL cannot express the trained models, the links between fingerprints or the tokens.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = session.materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
