"""The registered queries of the training-data operators (contracts of opN_<name>)."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from autolake.llm import bestfit, conversations, decontaminate, divergence, license_scan, near_dedup, oracles, packing, quality_rules, substring_dedup, token_blocks, tokens, toxicity, url_cascade, warc
from autolake.session import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*cols)


def op1_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = tokens.read_vocabulary(public_tokenizers.path("word_bpe_49k.json"))
    files, index = scratch_path(spark, "op1-blocks"), scratch_path(spark, "op1-index")
    token_blocks.write(_table(spark, sf_dir, "documents", "doc_id", "text"), files, vocabulary, special=True)
    token_blocks.read(spark, files).write.parquet(index)
    return token_blocks.with_starts(spark.read.parquet(index)).select("doc_id", "start", "n_tokens", "ids_crc32")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.annotate(_table(spark, sf_dir, "documents", "doc_id", "text"),
                                   _table(spark, sf_dir, "benchmark", "item_id", "text"))
    return found.select("doc_id", "found.n_words", "found.n_hit", "found.n_items",
                        F.sha2(F.concat_ws(",", "found.items"), 256).alias("items_sha256"),
                        decontaminate.contaminated("found").alias("contaminated"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = tokens.read_vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    return packing.pack(_table(spark, sf_dir, "documents", "doc_id", "text"), vocabulary, special=True)


RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op4_url_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_cascade.judge(_table(spark, sf_dir, "pages", "page_id", "url"), url_cascade.rule_table(spark, RULES))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels", "doc_id", "toxic"))
    return toxicity.score(docs, model).select("doc_id", (toxicity.fold("doc_id") == 0).alias("held_out"), "score", "predicted")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = scratch_path(spark, "op6-counts")
    quality_rules.with_counts(_table(spark, sf_dir, "documents", "doc_id", "text")).write.parquet(counted)
    return quality_rules.judge(spark.read.parquet(counted)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring_dedup.remove_repeats(_table(spark, sf_dir, "documents", "doc_id", "text"))
    words = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " "))
    return cut.select("doc_id", "repeats.n_words", "repeats.n_removed", F.sha2(words, 256).alias("kept_sha256"))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.classes(_table(spark, sf_dir, "documents", "doc_id", "text"), percent=85)


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(_table(spark, sf_dir, "documents", "doc_id", "text"))
    base = F.filter("found", lambda x: x["base"])
    places = F.transform(base, lambda x: x["word"])
    labels = lambda of: F.concat_ws(",", F.array_sort(F.array_distinct(F.transform(of, lambda x: x["label"]))))
    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(places).alias("first_word"), F.array_max(places).alias("last_word"),
        labels(base).alias("base_labels"), labels(F.col("found")).alias("labels"),
        F.coalesce(F.array_max(F.transform("found", lambda x: x["score"])), F.lit(0.0)).alias("score"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive = scratch_path(spark, "op10-warc")
    pages = _table(spark, sf_dir, "pages", "page_id", "url", "html")
    warc.write(pages.select("page_id", "url", F.col("html").cast("binary").alias("payload")), archive)
    return warc.resolve(warc.read(spark, archive)).drop("url")


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents", "lang", "source", "text"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return conversations.repair(conversations.damaged(rows), rows)


def op13_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = tokens.read_vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    return bestfit.pack(_table(spark, sf_dir, "documents", "doc_id", "text"), vocabulary, special=True)


QUERIES = {
    "op1_token_blocks": op1_token_blocks,
    "op2_decontamination": op2_decontamination,
    "op3_packing": op3_packing,
    "op4_url_cascade": op4_url_cascade,
    "op5_toxicity": op5_toxicity,
    "op6_quality_rules": op6_quality_rules,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_near_dedup": op8_near_dedup,
    "op9_license_scan": op9_license_scan,
    "op10_warc": op10_warc,
    "op11_source_divergence": op11_source_divergence,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_best_fit": op13_best_fit,
}

ORACLE: dict[str, str] = {
    "op2_decontamination": oracles.OP2,
    "op4_url_cascade": oracles.OP4,
    "op7_substring_dedup": oracles.OP7,
    "op8_near_dedup": oracles.OP8,
    "op10_warc": oracles.OP10,
    "op11_source_divergence": oracles.OP11,
    "op12_conversation_repair": oracles.OP12,
}
