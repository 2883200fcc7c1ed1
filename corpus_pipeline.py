"""Corpus pipeline: language identification, fuzzy line dedup, near-duplicate
documents, benchmark decontamination, BPE encoding and decoding.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each
one's result as Parquet to the shared folder and reads it back as the next
one's ``docs``. All stages but the last return the columns of ``documents``.

Defined results, in every stage: rows are judged one by one, also those that
share an id or have none. Null texts, and texts without a letter, go in the
first stage; a text that line dedup leaves without lines goes, while empty and
blank texts that come to it stay, and near dedup and decontamination keep texts
without words; of rows with one id and one text, which are alike, near dedup
keeps one, so of any group of near duplicates the row with the smallest id (rows
without an id last) stays. An empty table gives an empty result; extra columns,
whatever their names, are carried along; texts are whole, however long.
"""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from balances.llm import chunk_bpe, decontaminate, hyperminhash, langid, line_dedup
from balances.llm.common import prepare, table, text_key, without_texts, written

#: A document goes if no language reaches this calibrated probability.
LEAST_LANGUAGE_SCORE = 0.4
#: Per cent of common word shingles from which documents are near duplicates.
NEAR_PERCENT = 80


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a recognised language; the model learns from ``docs``."""
    prepare(spark)
    model = langid.train(docs.selectExpr("cast(doc_id AS long) AS doc_id", "text", "lang"))
    return langid.keep_identified(docs, model, LEAST_LANGUAGE_SCORE)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that an earlier line nearly equals."""
    prepare(spark)
    return line_dedup.deduplicated(docs)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each near-duplicate group."""
    prepare(spark)
    return hyperminhash.without_duplicates(docs, NEAR_PERCENT)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    texts = docs.select(text_key().alias("key"), "text")
    leaks = decontaminate.overlaps(texts, table(spark, sf_dir, "benchmark"), id_col="key")
    return without_texts(docs, leaks.select("doc_id"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of ids and decoded text."""
    prepare(spark)
    return chunk_bpe.encode_digests(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("minhash_near_dedup", dedup_documents),
    ("decontamination", drop_leaks),
    ("bpe_round_trip", encode),
]

#: The stages hold a trained model and hashed candidate searches: no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
