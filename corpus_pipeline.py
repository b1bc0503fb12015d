"""From raw documents to packed training sequences, one stored table per stage.

Defined results: null, empty and short texts fail the quality rules, so no stage after the first sees
them. Rows that are equal in all columns stay once, and of documents with one id and similar texts one
stays; documents without an id give way to those with one. Columns beside those of documents pass through
all stages but the last. An empty benchmark drops nothing; empty documents give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankstream.llm import catalog, decontaminate, packing, pii, quality_rules, simhash
from rankstream.llm.common import settle, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the adaptive thresholds keep."""
    return quality_rules.filtered(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-duplicate group."""
    return simhash.deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with pseudonyms in place of personal values; n_chars follows the text."""
    made = pii.pseudonymised(docs)
    return made.withColumn("n_chars", F.char_length("text").cast("long"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, each with its place in a sequence."""
    return packing.packed(docs, catalog.tokenizer_file())


STAGES = [
    ("quality_rules", quality),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("pii", pseudonyms),
    ("packing", pack),
]

# The fingerprints' components, the alignment and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage but the last is written and read back."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
