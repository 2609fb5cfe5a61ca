"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir), with the columns of ``documents``, and returns a
DataFrame that is written as Parquet and read again as the next one's ``docs``.

Rows need not have distinct ids: those that repeat a doc_id, or have none, are told apart by
their text, and each is judged as a document of its own. An empty table gives an empty result,
and columns beyond those of ``documents`` are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import exact_dedup, langid, mixing, near_dedup, packing
from tidemark.llm.registry import tokenizer_path
from tidemark.llm.shared import Scratch, small_batches, sweeping, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language: null texts, texts without a letter, and those
    of which no language has three tenths. Each row is judged by itself; of languages with equal
    shares the first by name counts."""
    small_batches(spark)
    return langid.accepted(docs, langid.train(docs))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of equal texts: that with the least doc_id, null being last."""
    small_batches(spark)
    return exact_dedup.without_copies(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each component of texts with five-word shingles of similarity 0.8: that
    with the least doc_id, null being last. Rows without words stay."""
    small_batches(spark)
    return near_dedup.without_near_copies(docs, words=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out whole documents until each source has its share of words; only rows
    equal in id and text share a place in the order, and are taken or left together."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids, each with its place in a sequence; each row is packed as often as it stands."""
    small_batches(spark)
    return packing.pack(packing.tokenised_pieces(docs, tokenizer_path()))


STAGES = [
    ("language_id", language_id),
    ("exact_duplicates", exact_duplicates),
    ("near_duplicates", near_duplicates),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]
ORACLE_SQL = None  # hashes of the tokenizer's ids are beyond SQL; tests hold the rows against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, scratch = table(spark, sf_dir, "documents"), Scratch(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        with sweeping(spark):  # what the stage itself wrote is not read after it
            docs = scratch.write(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
