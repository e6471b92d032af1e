"""Corpus pipeline: from raw documents to coded training tokens.

Each stage takes the session, the documents that the stage before kept and the folder of tables,
and returns a DataFrame; ``run`` writes what a stage returns as Parquet to the shared folder and
hands the next stage what it reads back.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from palletrail.llm import decontam, mixing, quality, simhash, tokens
from palletrail.llm.common import stored, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the cut; learned from the labels of the given documents."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that fingerprints of four-word shingles within 4 bits link, that of the smallest id."""
    return simhash.keep_one(docs, size=4, radius=4)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them; a part is the first words of its document."""
    return mixing.mixed_documents(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place, length and checksum of each document in the written blocks of token ids."""
    return tokens.token_output(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", quality_stage),
    ("simhash_dedup", dedup_stage),
    ("decontamination", decontamination_stage),
    ("source_mix", mixing_stage),
    ("token_blocks", token_stage),
]

# The classifier and the tokenizer cannot be expressed in SQL; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
