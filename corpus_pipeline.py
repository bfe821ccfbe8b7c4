"""From raw documents to training tokens: the stages, one after another, each on all that the one before it kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stackroom.llm import byte_bpe, decontaminate, jaccard_join, quality_cnn, secret_scan
from stackroom.llm.common import materialize, shared_folder, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the byte network rejects go."""
    return quality_cnn.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of linked documents the one with the least id stays."""
    return jaccard_join.keep_one(docs)


def contamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a twentieth or more of their words from benchmark items go."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays, with secrets replaced."""
    return secret_scan.redact_documents(docs, shared_folder(spark, "secret-ledger"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang and source, n_tokens and the ids, and the SHA-256 of what the ids decode to."""
    spec = byte_bpe.BpeSpec(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    coded = byte_bpe.encode_documents(docs, spec, ("lang", "source"))
    return coded.withColumn("decoded_sha256", F.sha2("decoded", 256)).drop("decoded")


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("contamination", contamination),
    ("secrets", secrets),
    ("tokens", tokens),
]

#: Learned scores and folded merges have no SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
