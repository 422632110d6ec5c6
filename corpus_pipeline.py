"""The corpus pipeline: documents in, tokens out, one operator a stage."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from thermowatt.llm import bpe, language, lines, mixing, simhash
from thermowatt.llm.common import stored, table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; those that language ID rejects go."""
    return language.identify(docs).where("NOT rejected").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that repeat an earlier one or nearly so."""
    return lines.drop_repeated_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.drop_near_duplicates(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in an order that mixes sources by their target weights throughout."""
    return mixing.mixed_order(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their token ids, and whether these decode to the text."""
    shared = bpe.codec(spark, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    return bpe.encode_documents(docs, shared)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing_stage),
    ("byte_bpe", encoding),
]

#: Character models, MinHash, SimHash, scheduling and BPE are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of the last stage, with mix_position: the mixed order they are to be read in."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if stage is mixing_stage:
            docs = mixing.positioned(docs)
    return docs
