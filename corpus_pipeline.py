"""The corpus pipeline: documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``documents``.  ``run`` writes every stage's result
as Parquet in the shared work folder and reads it back for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

import public_tokenizers

from fintide.llm import line_dedup, mixing, packing, quality, simhash
from fintide.llm.common import read_table, staged


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the n-gram likelihood ratio."""
    return quality.quality_filter(docs, read_table(spark, sf_dir, "labels"))


def site_line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that make up their source's boilerplate."""
    return line_dedup.drop_boilerplate(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash.near_dedup(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target weight asks for."""
    return mixing.mix(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, with their token ids, placed in sequences of at most 4096 tokens."""
    # Token ids are shuffled with their pieces: a smaller memory for known chunks leaves room for that.
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), memory=packing.CACHE_ENTRIES // 4)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", site_line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("mix_sources", mix_sources),
    ("best_fit_packing", best_fit_packing),
]

#: Hashed weights, 64-bit fingerprints, random rounding and token ids are not SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
