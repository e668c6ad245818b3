"""A training corpus from raw documents: quality, exact and near duplicates, mixing, packing.

Each stage takes what its predecessor kept, stored as Parquet and read back, and all
but the last return the columns of ``documents``. Rows are told apart by a number
stored with them, so null or repeated ids lose nothing, however a table is split.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

import public_tokenizers

from ledgerflow.llm.exact_dedup import exact_duplicates
from ledgerflow.llm.minhash import near_duplicates
from ledgerflow.llm.mixing import repeated
from ledgerflow.llm.packing import checksums, pack
from ledgerflow.llm.quality import selected
from ledgerflow.llm.queries import TARGETS, quality_model, table
from ledgerflow.llm.store import settled, small_batches, without, written

LONG_ROWS = 250  # documents of the mix that a Python task gets at once


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on the labels, selects."""
    return selected(docs, quality_model(docs, spark, sf_dir))


def _kept(docs: DataFrame, duplicates: Callable[..., DataFrame]) -> DataFrame:
    """``docs`` without the rows that ``duplicates`` drops; both read the same stored numbers."""
    number = "_row"
    while number.lower() in map(str.lower, docs.columns):
        number += "_"
    docs = written(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
    dropped = written(duplicates(docs, row_col=number).where("not kept").select(F.col("row").alias(number)), "dropped")
    return without(docs, dropped, number).drop(number)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal normalised texts."""
    return _kept(docs, exact_duplicates)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a similarity of 0.8 on five-word shingles."""
    return _kept(docs, near_duplicates)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many tokens with the target shares of sources, languages and topics: documents
    come as often as their cell's share asks, which may be not at all or repeatedly."""
    return repeated(docs, TARGETS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The tokenised documents as pieces of packed sequences.

    The mix is rich in long documents, so the session's Python tasks get fewer at once.
    """
    small_batches(spark, LONG_ROWS)
    return checksums(pack(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [("quality", quality), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("mixing", mixing), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's own tables are removed once its result is stored."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settled(spark, lambda stage=stage, docs=docs: stage(spark, docs, sf_dir), name)
    return docs


# The classifier is trained and the tokenizer isn't SQL.
ORACLE_SQL = None
