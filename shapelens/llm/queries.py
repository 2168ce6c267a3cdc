"""Registered queries of the training-data operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shapelens.llm import centroids, chat, decontam, langid, lm, mixing, near_dup, pivot_search, prefix_trie, secret_scan, simhash, toxicity, urls
from shapelens.llm.texts import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": lambda spark, d: simhash.fingerprint_report(table(spark, d, "documents")),
    "op2_mixing": lambda spark, d: mixing.mix_report(table(spark, d, "documents")),
    "op3_decontamination": lambda spark, d: decontam.contamination_report(table(spark, d, "documents"), table(spark, d, "benchmark")),
    "op4_language": lambda spark, d: langid.language_report(table(spark, d, "documents")),
    "op5_lm_scores": lambda spark, d: lm.lm_report(table(spark, d, "documents")),
    "op6_url_rules": lambda spark, d: urls.url_report(table(spark, d, "pages")),
    "op7_near_duplicates": lambda spark, d: near_dup.near_duplicate_report(table(spark, d, "documents")),
    "op8_toxicity": lambda spark, d: toxicity.toxicity_report(table(spark, d, "documents"), table(spark, d, "labels")),
    "op9_chat_format": lambda spark, d: chat.chat_report(table(spark, d, "conversations")),
    "op10_secrets": lambda spark, d: secret_scan.secret_report(table(spark, d, "documents")),
    "op11_prefix_trie": lambda spark, d: prefix_trie.trie_report(table(spark, d, "conversations")),
    "op12_centroids": lambda spark, d: centroids.cluster_report(table(spark, d, "embeddings")),
    "op13_top_k": lambda spark, d: pivot_search.search_report(table(spark, d, "embeddings")),
}
