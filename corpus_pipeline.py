"""The training-data pipeline over documents: rules, line dedup, near copies, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame; it is written as Parquet and
read again as the next stage's docs. All stages but the last return the columns of documents.
Null, empty, repeated and oddly named input is treated as the operators' modules say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forumtide.llm import bpe, jaccard_tree, line_dedup, mixing, quality_rules
from forumtide.llm.common import table
from forumtide.session import materialize

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rule_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the production policy rejects go."""
    return quality_rules.filter_documents(docs.select(*COLUMNS))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines shared by three documents stay in one of them; n_chars follows the new text."""
    lines = line_dedup.deduplicated_lines(docs.select(*COLUMNS))
    return lines.withColumn(
        "n_chars", F.when(F.col("n_dropped") > 0, F.char_length("text")).otherwise(F.col("n_chars"))
    ).select(*COLUMNS)


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five words, similarity 0.8."""
    return jaccard_tree.one_per_component(docs.select(*COLUMNS), words=5, percent=80)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All sources get equal shares of bytes; a document appears once per drawn copy."""
    return mixing.poisson_mix(docs.select(*COLUMNS)).select(*COLUMNS)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each copy's tokens, and the digest of what they decode to."""
    return bpe.round_trip(
        docs.select("doc_id", "text", "lang", "source"), bpe.public_tokenizer(spark)
    )


STAGES = [
    ("quality rules", quality_rule_stage),
    ("line dedup", line_dedup_stage),
    ("n-gram Jaccard join", near_copy_stage),
    ("mixing sources to target weights", mixing_stage),
    ("byte-level BPE encoding and decoding", token_stage),
]

# Token ids cannot be computed in SQL; tests compare the pipeline with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
