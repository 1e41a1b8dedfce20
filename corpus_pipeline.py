"""From raw documents to packed sequences: rules, toxicity, lines, near copies, packing.

Each stage takes (spark, docs, sf_dir), works on every row it is given and returns the documents it
keeps with their own columns; the last returns the pieces of the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from appkpi.llm import lines, packing, quality, simhash, toxicity
from appkpi.llm.common import read_table, settle
from appkpi.llm.queries import WORD_VOCABULARY, ship
from appkpi.llm.tokens import vocabulary_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the fixed limits and the classifier.

    A null or empty text has too few words and goes. Repeated rows stay or go together, whatever their id.
    """
    ship(spark)
    return quality.keep_good(docs, quality.train(docs, read_table(spark, sf_dir, "labels")))


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not flag.

    A null text is scored as an empty one, a null language by the threshold of all. Repeated rows stay or
    go together.
    """
    ship(spark)
    return toxicity.keep_clean(docs, toxicity.train(docs, read_table(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that stand earlier; ``n_chars`` follows the text.

    A null text stays null. Rows equal in doc_id and text lose the same lines.
    """
    names = docs.columns
    cut = lines.dedup_lines(docs)
    if "n_chars" in names:
        cut = cut.withColumn(
            "n_chars",
            F.when(F.col("lines_removed") > 0, F.length("text"))
            .otherwise(F.col("n_chars"))
            .cast(docs.schema["n_chars"].dataType),
        )
    return cut.select(*names)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies by the operator of op1_simhash: the one with the smallest id.

    Null texts and those without words are one group; rows equal in id and text are one document.
    """
    ship(spark)
    return simhash.keep_first(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 token ids, along the curve.

    A null text is an empty one and has the end id alone; rows with one id are packed each.
    """
    ship(spark)
    return packing.piece_digests(packing.pack(docs, vocabulary_path(WORD_VOCABULARY)))


STAGES = [
    ("quality_rules", quality_rules),
    ("toxicity", toxicity_filter),
    ("line_dedup", line_dedup),
    ("simhash_dedup", simhash_dedup),
    ("packing", pack_sequences),
]

# Trained models and token ids are beyond SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written to the shared folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
