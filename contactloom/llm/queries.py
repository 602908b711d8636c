"""The registered queries of this subpackage: thin digests of the operators' results."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ctw, decontam, html_template, merkle, oracle, packing, rules, secret_scan, sharding, simhash, token_counts, toxicity, tput, zstd_quality


TOKENIZER = "byte_bpe_50k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicate_groups(_table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op2_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op3_context_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    return ctw.score_texts(_table(spark, sf_dir, "documents"), held_out)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"))


def op5_exact_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    shuffled = sharding.exact_shuffle(_table(spark, sf_dir, "documents"), shards=16)
    text = F.coalesce(F.col("text"), F.lit(""))
    return shuffled.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_template.extract_main_text(_table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = rules.apply_policy(rules.ledger(_table(spark, sf_dir, "documents")), "v2")
    base = F.col("failures").bitwiseAND(F.lit(rules.mask_of(rules.BASE)).cast("long")) != 0
    return entries.select("doc_id", *[f"measures.{m}" for m in rules.MEASURES[:5]], base.alias("base_failed"), (~base & F.col("kept")).alias("kept"), "failures")


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(_table(spark, sf_dir, "documents"))
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("found", lambda s: s["kind"].isin("assign", "access", "hex"))
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.find_contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontam.is_contaminated().alias("contaminated"), F.size("near_items").cast("long").alias("n_near_items"))


def op10_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = zstd_quality.fit(docs, _table(spark, sf_dir, "labels").where(zstd_quality.in_training()))
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return zstd_quality.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op11_tput_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tput.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), k=20)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    manifest = merkle.manifest(_table(spark, sf_dir, "documents"), ["doc_id", "source", "lang", "n_chars", "text"], "lang", "doc_id", {"text": F.when(tampered, lower).otherwise(F.col("text"))})
    return manifest.audit().withColumnRenamed("id", "doc_id")


def op13_ftrl_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels").where(toxicity.in_training()))
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    return toxicity.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


QUERIES = {f.__name__: f for f in (
    op1_simhash_near_dedup, op2_curve_packing, op3_context_tree_scores, op4_token_counts, op5_exact_sharding, op6_main_text, op7_quality_rules, op8_secret_scan, op9_decontamination, op10_compression_quality, op11_tput_search, op12_merkle_manifest,
    op13_ftrl_toxicity)}
ORACLE_SQL = {"op7_quality_rules": oracle.RULES_SQL, "op9_decontamination": oracle.DECONTAMINATION_SQL, "op11_tput_search": oracle.SEARCH_SQL, "op12_merkle_manifest": oracle.MERKLE_SQL}
