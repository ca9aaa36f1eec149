"""The operators as registered queries, each over its whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crosstally.llm import (
    chat_format,
    decontamination,
    language_id,
    license_scan,
    lm_scoring,
    merkle_manifest,
    minhash_dedup,
    periodic_runs,
    source_mixing,
    token_counts,
    token_output,
    topk_search,
    toxicity,
)
from crosstally.llm.common import table


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(table(spark, sf_dir, "documents"))


def op2_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return token_output.token_output(spark, table(spark, sf_dir, "documents"), path)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.size("sentences").cast("long").alias("n_known"),
        F.array_join("sentences", ",").alias("sentences"),
        F.array_join("licences", ",").alias("licences"),
    )


def op5_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"), width=2, percent=80)


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    one = spark.range(1).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.explode(F.map_from_arrays(*(F.array(*map(F.lit, x)) for x in ((0, 1), ("user", "assistant"))))).alias("turn", "role"),
        F.lit(said).alias("text"),
    )
    return chat_format.digests(chat_format.format_chats(turns.unionByName(one)))


def op8_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk_search.quantised(table(spark, sf_dir, "embeddings"))
    return topk_search.top_k(vectors.where(F.col("vec_id") % 20 == 0), vectors, 20)


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = source_mixing.mix(table(spark, sf_dir, "documents"))
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return mix.select("doc_id", "size", "source_size", "target", taken)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts.token_counts(table(spark, sf_dir, "documents"), path)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic_runs.made_periodic(table(spark, sf_dir, "documents"))
    return periodic_runs.digests(periodic_runs.periodic_runs(docs))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = merkle_manifest.without_line_breaks()
    found = merkle_manifest.manifest(table(spark, sf_dir, "documents"), tampered=tampered)
    return merkle_manifest.digests(found)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_token_output": op2_token_output,
    "op3_language_id": op3_language_id,
    "op4_license_scan": op4_license_scan,
    "op5_minhash_dedup": op5_minhash_dedup,
    "op6_decontamination": op6_decontamination,
    "op7_chat_format": op7_chat_format,
    "op8_topk_search": op8_topk_search,
    "op9_source_mixing": op9_source_mixing,
    "op10_token_counts": op10_token_counts,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_toxicity": op12_toxicity,
    "op13_merkle_manifest": op13_merkle_manifest,
}

#: The same in SQL, where SQL can express it.
SQL: dict[str, str] = {
    "op4_license_scan": license_scan.scan_sql(),
    "op7_chat_format": chat_format.CHAT_SQL,
    "op8_topk_search": topk_search.TOP_K_SQL,
    "op9_source_mixing": source_mixing.MIX_SQL,
    "op13_merkle_manifest": merkle_manifest.MANIFEST_SQL,
}
