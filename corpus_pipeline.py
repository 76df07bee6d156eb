"""The corpus pipeline: five of the training-data operators, one after the other, over all documents.

Each stage works on the rows that the one before it kept, and what it decides takes effect: the quality classifier drops
what it predicts to be bad, exact dedup and the n-gram Jaccard join keep one document of each group, decontamination
drops documents that hold a benchmark item, and packing turns the rest into pieces of 2048-token sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from potsherd.llm import decontamination, exact_dedup, ngram_jaccard, packing, quality
from potsherd.llm.common import Scratch, table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier predicts to be good; it learns from the labelled ones that aren't held out.

    Null and empty texts score 0, so they go. Equal texts, repeated rows among them, stay or go together.
    """
    model = quality.learn(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: that of the smallest id, a null id last, repeated rows cut down to one."""
    return exact_dedup.drop_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that of the smallest id, a null id last."""
    return ngram_jaccard.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no benchmark item; null and empty items are held by nothing."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of 2048-token sequences that hold each token of each document once."""
    return packing.with_checksums(packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("quality_classifier", keep_good),
    ("exact_dedup", drop_exact_copies),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("packing", pack),
]

#: The classifier and the packing can't be expressed in SQL; tests hold the pipeline against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Null and empty texts are dropped by the classifier, repeated rows leave one, and a row with a null doc_id is packed
    under that null if its text stands nowhere else. Very long texts are read, compared and packed whole. Further columns,
    whatever their names, travel along up to the packing and play no part. Without documents, or without any label of a
    document to learn from, no document is good and there are no pieces; without a benchmark none is contaminated.
    """
    scratch, docs = Scratch(spark), table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
