"""From raw documents to packed training sequences, in five stages.

Each stage works on all rows its predecessor kept, and its result is written as Parquet
and read again as the next one's documents. All but the last return the columns of the
documents table. Null texts, empty texts and repeated rows are handled as the operators
state; an empty table passes through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripstar.llm.common import stored, table
from tripstar.llm.line_dedup import without_duplicate_lines
from tripstar.llm.mixing import mixed_documents
from tripstar.llm.ngram_join import one_of_each_group
from tripstar.llm.packing import pack, tokenised_pieces
from tripstar.llm.toxicity import drop_toxic, fit_model


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold; learned from the labels of those at hand."""
    return drop_toxic(docs, fit_model(docs, table(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines equal or close to an earlier line go; so do documents left without a line."""
    return without_duplicate_lines(docs)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a similarity of 0.8."""
    return one_of_each_group(docs, width=5, percent=80)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents taken to the sources' target weights, repeated where the mix repeats them."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens, each with its sequence and its place there."""
    return pack(stored(tokenised_pieces(docs), "pieces"))


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("ngram_join", ngram_join),
    ("mixing", mixing),
    ("packing", packing),
]

# models, tokens and a packing search are beyond SQL; tests compare with a plain version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
