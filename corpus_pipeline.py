"""Corpus pipeline: language ID, exact and near deduplication, mixing of
sources, packing. Every stage is written and read again before the next.

Each function takes (spark, docs, sf_dir) and returns a DataFrame. All but
the last return the columns of ``docs``. Row order carries no meaning.
Nulls, empty and repeated rows and empty tables follow the operators'
docstrings: texts without a letter go in the first stage, documents without
a word are not drawn by the mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridewx.llm import bagminhash, golomb_dedup, langid, mixing, pow2_pack
from ridewx.llm.common import cut, without_rows
from ridewx.llm.queries import fold, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose language is known, however close the next one."""
    model = langid.train(docs, ~fold("doc_id", 4, 2))
    return without_rows(docs, langid.predict(docs, model).filter(F.col("lang_pred") == langid.UNKNOWN))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the first document of each group of equal texts."""
    return golomb_dedup.drop_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each near-duplicate class."""
    return bagminhash.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Draw documents until every source meets its target; the one that
    meets it is cut there."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of power-of-two length, one sequence each, with their ids
    (little-endian unsigned 32-bit)."""
    return pow2_pack.pack(docs).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "ids")


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Learned models, hashing and tokenizers: not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), name)
    return docs
