"""The operators applied to their whole tables with production settings."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from wattline.llm import collocations, decontaminate, hmm, langid, lexical, packing, pages, passages, sentencepieces, simhash, suffixes, tokenfiles, vectors
from wattline.llm.common import crc_part, table
from wattline.llm.oracles import ORACLES  # noqa: F401  (registered beside the queries)


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = crc_part("doc_id", 3) == 1
    predicted = langid.identify(docs, langid.train(docs.where(~held_out)))
    return predicted.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op2_wrapper_text(spark: SparkSession, folder: str) -> DataFrame:
    return pages.main_text(table(spark, folder, "pages"))


def op3_adaptive_scan(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings")
    return vectors.search(rows, rows.where("vec_id % 20 = 0"), k=20)


def op4_collinear_passages(spark: SparkSession, folder: str) -> DataFrame:
    return passages.repeated_passages(table(spark, folder, "documents")).drop("doc_key")


def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op6_pigeonhole_edits(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.matches(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op7_hidden_markov(spark: SparkSession, folder: str) -> DataFrame:
    return hmm.score_texts(table(spark, folder, "documents"), crc_part("doc_id", 7) == 2)


def op8_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    return sentencepieces.encode(table(spark, folder, "documents"), model, digests=True)


def op9_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return tokenfiles.round_trip(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2)


def op10_suffix_groups(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.remove_repeats(table(spark, folder, "documents"), digests=True)


def op11_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=0, digests=True)


def op12_lexical(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"), k=20)


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_language_id, op2_wrapper_text, op3_adaptive_scan, op4_collinear_passages, op5_simhash, op6_pigeonhole_edits, op7_hidden_markov, op8_sentencepiece,
        op9_token_files, op10_suffix_groups, op11_packing, op12_lexical, op13_collocations,
    )
}
