"""The registered queries of the training-data operators and their expected SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from wardflow.llm import (
    conversation_repair, decontaminate, exact_dedup, html_text, merkle, near_join, packing, pii, prefix_hash, quality, token_counts, token_ids, warc_zip)
from wardflow.llm.common import table, vocabulary

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {"op4_benchmark_decontamination": decontaminate.ORACLE, "op6_exact_dedup": exact_dedup.ORACLE, "op9_warc_zip": warc_zip.ORACLE,
                          "op12_conversation_repair": conversation_repair.ORACLE, "op13_merkle_manifest": merkle.ORACLE}
if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL


def _register(make: Callable[[SparkSession, str], DataFrame]):
    QUERIES[make.__name__] = make
    return make


@_register
def op6_exact_dedup(spark, folder):
    return exact_dedup.exact_groups(table(spark, folder, "documents"))


@_register
def op1_token_counts(spark, folder):
    counted = token_counts.token_prefixes(table(spark, folder, "documents"), vocabulary("byte_bpe_50k.json"), budget=1024,
                                          tables=False)
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"), "fit_chars")


@_register
def op2_ngram_jaccard_join(spark, folder):
    return near_join.near_duplicates(table(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id", "class_id")


@_register
def op3_html_extraction(spark, folder):
    return html_text.main_texts(table(spark, folder, "pages"))


@_register
def op4_benchmark_decontamination(spark, folder):
    return decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@_register
def op5_best_fit_packing(spark, folder):
    return packing.pack(table(spark, folder, "documents"), vocabulary("byte_bpe_50k.json"))


@_register
def op7_quality_classifier(spark, folder):
    return quality.scored(table(spark, folder, "documents"), table(spark, folder, "labels"))


@_register
def op8_token_ids_orc(spark, folder):
    return token_ids.written_positions(table(spark, folder, "documents"), vocabulary("word_bpe_49k.json"))


@_register
def op9_warc_zip(spark, folder):
    return warc_zip.archive_pages(table(spark, folder, "pages"), payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def _equals(value: str):
    return lambda element: element == value


@_register
def op10_pii(spark, folder):
    docs = table(spark, folder, "documents")
    found = pii.personal_data(docs, pii.train(docs))
    counts = [F.size(F.filter(F.transform("base", lambda s: s["kind"]), _equals(kind))).cast("long").alias(f"n_{kind}") for kind in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(pii.as_text("base"), 256).alias("base_sha256"), pii.as_text("spans").alias("spans"))


@_register
def op11_prefix_hash_fingerprints(spark, folder):
    return prefix_hash.fingerprints(table(spark, folder, "documents"))


@_register
def op12_conversation_repair(spark, folder):
    return conversation_repair.repair_drill(table(spark, folder, "conversations"))


@_register
def op13_merkle_manifest(spark, folder):
    return merkle.manifest(table(spark, folder, "documents")).drop("n_levels")


@_register
def pipeline(spark, folder):
    return corpus_pipeline.run(spark, folder)
