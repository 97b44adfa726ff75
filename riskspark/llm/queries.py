"""The registered queries of this package: thin bindings of the operators to
the given tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.llm import ann, chat, decontam, langid, licences, linededup, negatives, packing, periodic, quality, simhash, toxicity, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_warc(spark, sf_dir):
    return warc.round_trip(table(spark, sf_dir, "pages"))


SQL["op1_warc"] = warc.SQL


@query
def op2_quality_classifier(spark, sf_dir):
    return quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), mod=5, rest=0)


@query
def op3_benchmark_decontamination(spark, sf_dir):
    return decontam.digest(decontam.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10))


SQL["op3_benchmark_decontamination"] = decontam.SQL


@query
def op4_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.ranker(docs))


@query
def op5_inverted_multi_index(spark, sf_dir):
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, top=20)


@query
def op6_toxicity(spark, sf_dir):
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), mod=4, rest=2)


@query
def op7_chat_formatting(spark, sf_dir):
    said = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    convs = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(own)
    template = chat.Instruct()
    return chat.read_back(chat.format_conversations(convs, template), template)


SQL["op7_chat_formatting"] = chat.SQL


@query
def op8_line_dedup(spark, sf_dir):
    return linededup.report(table(spark, sf_dir, "documents"))


@query
def op9_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end=2, size=4096)


@query
def op10_simhash_near_dedup(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), n=4, radius=4)


@query
def op11_license_scan(spark, sf_dir):
    return licences.digest(licences.scan(table(spark, sf_dir, "documents")))


@query
def op12_hard_negatives(spark, sf_dir):
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, sf_dir, "embeddings").withColumn("label", moved), F.col("vec_id") % 100 == 0)


SQL["op12_hard_negatives"] = negatives.SQL


@query
def op13_periodic_runs(spark, sf_dir):
    return periodic.digest(periodic.detect(periodic.planted(table(spark, sf_dir, "documents"))))
