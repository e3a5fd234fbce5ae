"""The corpus pipeline: documents in, token digests of what is kept out.

Each stage calls one operator of `tillhouse.llm` on all that the stage before it
kept. Null and empty texts leave at the first stage, as they have no letters;
repeated rows leave at the second, as copies. All stages but the last return the
columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tillhouse.llm import chunk_encoding, decontamination, language_id, personal_data, simhash
from tillhouse.staging import Staging


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents whose language is recognised; learns from those that are not held out."""
    model = language_id.train(docs.where(~language_id.held_out()))
    return language_id.predict(docs, model).where("NOT rejected").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of linked fingerprints, that with the smallest doc_id."""
    return simhash.keep_one(docs, Staging(spark))


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that hold no benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.without_contaminated(docs, benchmark, Staging(spark))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in the texts; n_chars follows the new text."""
    return personal_data.redacted(docs, personal_data.train(docs, Staging(spark)))


def encode_and_decode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of each document and what they decode to, as digests."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return chunk_encoding.encode_documents(docs, Staging(spark), path, digests=True)


STAGES = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("pii", redact_personal_data),
    ("bpe", encode_and_decode),
]

# SQL expresses none of hashing shingles, aligning passages or merging tokens.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents, each one's result written and read again."""
    staging = Staging(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staging.save(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
