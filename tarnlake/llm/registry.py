"""The registered queries of the text operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlake.llm import decontaminate, domain_mix, minhash_dedup, neighbour_quality, page_text, paragraph_dedup, prefix_trie, quality_rules, sharding, shingle_join, token_alignment, token_counts, token_shards
from tarnlake.llm.common import bounded_batches, table

Query = Callable[[SparkSession, str], DataFrame]
QUALITY = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents")).select(*QUALITY)


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return page_text.extract(table(spark, sf_dir, "pages")).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return shingle_join.join_documents(table(spark, sf_dir, "documents"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontaminate.digest(found)


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    return sharding.place(docs, "doc_id", [f"shard-{k:03d}" for k in range(128)])


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"), "text")
    counted = token_counts.count_tokens(docs, public_tokenizers.path("word_bpe_49k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit"))


def op7_domain_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Domains are the cells of the labelled table: poor, poor and toxic, good, good and toxic."""
    bounded_batches(spark)
    labels = table(spark, sf_dir, "labels").select("doc_id", (F.col("quality") * 2 + F.col("toxic")).alias("domain"))
    mixed = domain_mix.mix(table(spark, sf_dir, "documents").select("doc_id", "text"), labels, (0.04, 0.01, 0.9, 0.05))
    return mixed.select("doc_id", "n_tokens", F.transform("posteriors", lambda x: F.round(x, 6)).alias("posteriors"), "rate")


def op8_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    sequences, _ = token_shards.write_shards(
        table(spark, sf_dir, "documents"), token_shards.shard_folder(spark),
        public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return sequences


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    docs = table(spark, sf_dir, "documents")
    return paragraph_dedup.repeated_paragraphs(docs).unionByName(paragraph_dedup.repeated_passages(docs))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    docs, sample = table(spark, sf_dir, "documents"), 3000
    labelled = neighbour_quality.training_rows(docs, table(spark, sf_dir, "labels"), "quality", sample)
    space = neighbour_quality.fit(labelled, "quality", sample=sample)
    scored = neighbour_quality.score(docs.select("doc_id", "text"), space)
    return scored.select(
        "doc_id", neighbour_quality.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return prefix_trie.prefix_nodes(table(spark, sf_dir, "conversations"))


def op12_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return minhash_dedup.near_copies(table(spark, sf_dir, "documents"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return token_alignment.alignment(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN,
        public_tokenizers.path("piece_bpe_32k.model"))


QUERIES: dict[str, Query] = {
    "op1_html_extraction": op1_html_extraction,
    "op2_ngram_jaccard": op2_ngram_jaccard,
    "op3_decontaminate": op3_decontaminate,
    "op4_sharding": op4_sharding,
    "op5_token_counts": op5_token_counts,
    "op6_quality_rules": op6_quality_rules,
    "op7_domain_mix": op7_domain_mix,
    "op8_token_shards": op8_token_shards,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_minhash_dedup": op12_minhash_dedup,
    "op13_token_alignment": op13_token_alignment,
}
ORACLES: dict[str, str] = {
    "op2_ngram_jaccard": shingle_join.ORACLE,
    "op3_decontaminate": decontaminate.ORACLE,
    "op11_prefix_trie": prefix_trie.ORACLE,
    "op12_minhash_dedup": minhash_dedup.ORACLE,
    "op6_quality_rules": f"SELECT {', '.join(QUALITY)} FROM ({quality_rules.judged_sql()}) AS q",
}
