"""A training-data pipeline over ``documents``.

Every stage takes ``(spark, docs, sf_dir)``, works on all that its predecessor
kept and returns a DataFrame; it is written as Parquet and read again as the
next stage's ``docs``.  All stages but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from regcorpus.llm import bpe, exact_dedup, mixing, ngram_join, toxicity
from regcorpus.llm.store import TABLES, drop_written, written


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxicity: documents predicted toxic go; the machine is fitted on the
    labelled rows among ``docs`` that are not held out."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return toxicity.without_toxic(docs, toxicity.fit(docs, labels))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exact dedup: one document of each group of equal texts stays."""
    return exact_dedup.without_copies(docs)


def dissimilar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: one document of each group of near copies stays."""
    return ngram_join.one_of_each(docs)


def blended(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: documents as often as the target weights of their source take
    them."""
    return mixing.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE: tokens of every document, checked by decoding."""
    import public_tokenizers
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.round_trip(docs, ranks, public_tokenizers.PATTERN)


STAGES = [("toxicity", clean), ("exact dedup", distinct), ("n-gram Jaccard join", dissimilar),
          ("mixing sources", blended), ("byte-level BPE", tokens)]

# Scores of a fitted machine and token ids have no SQL; tests hold the stages
# against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows.  A stage's result is
    written, then its intermediates and the table it read are removed."""
    docs, mark = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet"), len(TABLES)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        drop_written(spark, mark)
    return STAGES[-1][1](spark, docs, sf_dir)
