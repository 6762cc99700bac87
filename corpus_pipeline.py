"""From raw documents to training shards, in stages that each keep whole results.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last return the columns of
documents. Nulls, empty texts, repeated rows and empty tables are treated as the operators of the stages say.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlake.llm import decontaminate, domain_mix, quality_rules, shingle_join, token_shards
from tarnlake.llm.common import bounded_batches, freed, scratch, small, stored, table

#: Shares of tokens that the training text should have: clean, toxic.
TARGETS = (0.97, 0.03)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    return quality_rules.kept_documents(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    bounded_batches(spark)
    return shingle_join.representatives(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document comes as often as its rate towards the target shares says: clean ones once or more.

    A document is clean by its label or, without one, if its clean posterior prevails; toxic ones are not repeated to reach their share."""
    bounded_batches(spark)
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("domain"))
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("domain").isin(0, 1)).groupBy(F.col("doc_id").alias("_d")).agg(F.min("domain").alias("_toxic"))
    known = small(stored(known, "known-labels"), domain_mix.BROADCAST_ROWS)
    mixed = domain_mix.mix(docs, labels, TARGETS, capped=(1,))
    clean = F.coalesce(F.col("_toxic") == 0, F.col("posteriors")[0] >= 0.5)
    return domain_mix.drawn(mixed.join(known, mixed["doc_id"] == known["_d"], "left"), keep=clean).select(*docs.columns)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards in training order; returns where each sequence is."""
    bounded_batches(spark)
    sequences, _ = token_shards.write_shards(
        docs, token_shards.shard_folder(spark), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return sequences


STAGES = [
    ("quality_rules", quality), ("ngram_jaccard", near_copies), ("decontaminate", benchmark),
    ("domain_mix", mixture), ("token_shards", shards),
]

#: Similarity components, a fitted mixture and token ids of a trained vocabulary cannot be had in one SQL query.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. What the others stored on their way is deleted as soon as the next one has its input."""
    docs, given = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        with scratch():
            docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}", keep=True)
        freed(*given or ())
        given = [docs]
    out = STAGES[-1][1](spark, docs, sf_dir)
    # Its shards and rows are written by now.
    freed(*given or ())
    return out
