"""A corpus pipeline over the documents: each stage works on all that the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.llm import decontaminate, langid, passages, sentencepieces, simhash
from wattline.llm.common import crc_part, table
from wattline.sources.scratch import written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; the network learns from the labelled ones outside the held-out third."""
    return langid.keep_identified(docs, langid.train(docs.where(crc_part("doc_id", 3) != 1)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints (four-word shingles) are linked by 4 or fewer differing bits: the one with the
    smallest id."""
    return simhash.one_per_group(docs, shingle=4, distance=4)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 50 words or more that another place holds too."""
    cut = passages.without_repeats(docs)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document, with the hashes of the ids and of the text decoded from them."""
    return sentencepieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model"), digests=True)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("benchmark_leaks", benchmark_leaks),
    ("encoded", encoded),
]
#: Trained models, shingles by XXH64 and piece encoding have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each stage's result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
