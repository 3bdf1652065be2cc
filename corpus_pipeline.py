"""A training corpus from raw documents: filter, deduplicate, cut repeats, mix, encode.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it
kept.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from vigilpay.llm import mixing, pieces, quality, simhash, substring
from vigilpay.session import stage

#: The SentencePiece model of the last stage.
PIECE_MODEL = os.environ.get("VIGILPAY_PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")

#: No SQL: fingerprints, Newton steps and the encoding have no DuckDB form.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule rejects."""
    return quality.quality_filter(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near-duplicates."""
    return simhash.drop_near_duplicates(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 13 words and more that a document with a smaller id has are cut out; ``n_chars`` follows the text."""
    cut = substring.remove_repeats(docs)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, once or twice."""
    return mixing.mix_documents(docs)


def sentencepiece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document of the mix, and whether decoding them gives the text back."""
    model = pieces.load_model(PIECE_MODEL)
    encoded = pieces.encode(docs.select("doc_id", "source", "lang", "text"), model, check="round_trip")
    return encoded.select("doc_id", "source", "lang", F.size("ids").alias("n_ids"), "ids", "round_trip")


STAGES = [
    ("quality rules", quality_rules),
    ("simhash near-dedup", simhash_dedup),
    ("substring dedup", substring_dedup),
    ("source mixing", source_mixing),
    ("sentencepiece encoding", sentencepiece_encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; between two stages the documents are written and read again.

    The folders belong to the application until ``session.drop_staged``.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
