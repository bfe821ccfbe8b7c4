"""The registered query of each operator: it reads whole tables, applies the operator, and derives digest columns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bwt_dedup, byte_bpe, compact_windows, conversation_trie, decontaminate, fim, hmm_score, jaccard_join, license_scan, quality_cnn, quality_rules, secret_scan, warc
from .common import shared_folder, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


@query
def op1_risk_rules(spark, folder):
    judged = quality_rules.judge(table(spark, folder, "documents"), table(spark, folder, "labels"))
    first = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return judged.select(*first, *quality_rules.LADDERS, *(f"{rule}_cutoff" for rule in quality_rules.LADDERS))


@query
def op3_blob_ledger(spark, folder):
    """The table arrives in two deliveries, the English documents and then all; ``scan`` tells which of the two scanned a content."""
    documents, ledger = table(spark, folder, "documents"), shared_folder(spark, "secret-ledger")
    secret_scan.update_ledger(documents.where("lang = 'en'"), ledger)
    found = secret_scan.scan_versions(documents, ledger)
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "blob", "scan")


@query
def op2_byte_cnn(spark, folder):
    return quality_cnn.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op7_prefix_windows(spark, folder):
    found = decontaminate.decontaminate(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    items = F.size("items").cast("long").alias("n_items")
    digest = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", items, digest, "contaminated")


@query
def op8_dictionary_warc(spark, folder):
    read = warc.new_archive(table(spark, folder, "pages"), shared_folder(spark, "warc"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


@query
def op10_folded_bpe(spark, folder):
    spec = byte_bpe.BpeSpec(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    coded = byte_bpe.encode_documents(table(spark, folder, "documents"), spec)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op5_heavy_light_join(spark, folder):
    return jaccard_join.link_classes(table(spark, folder, "documents"))


@query
def op4_bwt_merge(spark, folder):
    left = bwt_dedup.remove_repeats(table(spark, folder, "documents"))
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op6_compact_windows(spark, folder):
    return compact_windows.repeated_passages(table(spark, folder, "documents"))


@query
def op9_patience_licenses(spark, folder):
    return license_scan.scan_licenses(table(spark, folder, "documents"))


@query
def op11_rank_index_fim(spark, folder):
    cut = fim.rearrange(table(spark, folder, "documents"))
    digests = F.sha2("output", 256).alias("output_sha256"), F.sha2(fim.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256")
    return cut.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


@query
def op12_hidden_markov(spark, folder):
    return hmm_score.score_documents(table(spark, folder, "documents"))


@query
def op13_block_trie(spark, folder):
    return conversation_trie.rebuilt_trie(table(spark, folder, "conversations"))
