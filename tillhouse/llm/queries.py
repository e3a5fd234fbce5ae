"""One query per operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.llm import (
    chunk_encoding,
    conversations,
    decontamination,
    fill_in_middle,
    language_id,
    license_scan,
    packing,
    personal_data,
    secrets,
    simhash,
    token_counts,
    url_filter,
    vector_links,
)
from tillhouse.staging import Staging


def op1_embedding_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return vector_links.vector_links(vectors, Staging(spark))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return token_counts.token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.contaminated(docs, benchmark, Staging(spark)).drop("id", "digest")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held = language_id.held_out()
    model = language_id.train(docs.where(~held))
    named = docs.select("doc_id", "text", F.coalesce(held, F.lit(False)).alias("held_out"))
    return language_id.predict(named, model, ["doc_id", "held_out"])


def op5_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return simhash.simhash_groups(docs, Staging(spark)).select("doc_id", "fingerprint", "component_id", "kept")


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return license_scan.find_licences(docs, license_scan.train(docs, Staging(spark)))


def op7_chunk_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = public_tokenizers.path("word_bpe_49k.json")
    return chunk_encoding.encode_documents(docs, Staging(spark), path, digests=True)


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = personal_data.train(docs, Staging(spark))
    return personal_data.digest(personal_data.find_personal_data(docs, model, ["doc_id"]))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    return secrets.find_secrets(docs, Staging(spark)).select(*columns)


def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack_documents(docs, Staging(spark), path, keep_ids=False)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    edits = conversations.repair(conversations.damage(table), Staging(spark))
    return conversations.repaired_summary(table, edits)


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return fill_in_middle.digest(fill_in_middle.fill_in_middle(docs))


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [
        op1_embedding_links,
        op2_token_counts,
        op3_decontamination,
        op4_language_id,
        op5_simhash_groups,
        op6_license_scan,
        op7_chunk_encoding,
        op8_url_filter,
        op9_personal_data,
        op10_secrets,
        op11_best_fit_packing,
        op12_conversation_repair,
        op13_fill_in_middle,
    ]
    return {query.__name__: query for query in found}
