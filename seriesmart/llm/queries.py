"""One registered query per operator, with production parameters, over its whole table."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from seriesmart.llm import (
    chat,
    dedup,
    fingerprint,
    infill,
    language,
    lexical,
    mixing,
    packing,
    quality,
    scoring,
    simhash,
    topk,
    toxicity,
)
from seriesmart.llm.common import table

BYTE_VOCABULARY = "byte_bpe_50k.json"


def tokenizer() -> str:
    return public_tokenizers.path(BYTE_VOCABULARY)


def op1_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprint.edited_fingerprints(table(spark, folder, "documents"))


def op2_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op3_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    found = dedup.near_duplicates(table(spark, folder, "documents"), width=2)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op4_top_products(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_products(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return toxicity.score(docs, toxicity.learn(docs, table(spark, folder, "labels")))


def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), tokenizer())


def op7_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.score(table(spark, folder, "documents"))


def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return quality.score(docs, quality.learn(docs, table(spark, folder, "labels")))


def op9_chat(spark: SparkSession, folder: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    more = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    return chat.read_back(chat.format_chats(turns, tokenizer()), tokenizer())


def op10_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return language.identify(docs, language.learn(docs))


def op11_lexical(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.ranked_documents(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op12_infill(spark: SparkSession, folder: str) -> DataFrame:
    return infill.digests(infill.fill_in_middle(table(spark, folder, "documents")))


def op13_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", simhash.hexadecimal(F.col("fingerprint")).alias("fingerprint"), "component_id")


QUERIES = {
    name: run for name, run in sorted(globals().items(), key=lambda item: len(item[0])) if name.startswith("op")
}
SQL = {
    "op2_source_mix": mixing.SQL,
    "op3_near_duplicates": dedup.SQL,
    "op4_top_products": topk.SQL,
    "op9_chat": chat.SQL,
    "op11_lexical": lexical.SQL,
    "op12_infill": infill.SQL,
}
