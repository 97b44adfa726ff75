"""The corpus pipeline: language ID, line dedup, SimHash near-dedup, benchmark
decontamination, packing.  Each stage takes (spark, docs, sf_dir), its predecessor's
rows as docs, and returns a DataFrame; all but the last keep documents' columns.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from riskspark.llm import decontam, langid, linededup, packing, simhash
from riskspark.llm.common import cut


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go; profiles come from the same documents."""
    return langid.keep_identified(docs, langid.ranker(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines whose like occurs at an earlier place go."""
    return linededup.dedup(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the smallest doc_id stays."""
    return simhash.keep_one(docs, n=4, radius=4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontam.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), window=10)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, a row each."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end=2, size=4096)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("decontamination", decontamination),
    ("packing", pack),
]

#: Profiles, edit distances, SimHash and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), name)
    return docs
