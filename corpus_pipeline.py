"""documents through quality rules, exact and near deduplication, mixing and tokenization.

Every stage takes the rows that the one before kept, read from Parquet. A row is known by its place in
that table, so rows without doc_id and repeated rows are each treated as rows of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phasediff.llm import exact_dedup, mixing, ngram_join, quality_rules
from phasediff.llm.queries import bpe_digests, documents
from phasediff.llm.store import shipped, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

#: Every document once at most; a fifth of the tokens goes, most of it from sources above their weight.
MIX = mixing.Mix(weights={"lang": {"en": 6, "de": 2, "fr": 2}, "source": {"src0": 4}}, budget_percent=80, max_epochs=1)

#: Not all stages can be written in SQL (subword ids); tests hold the rows against brute force.
ORACLE_SQL = None


def chosen(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows of docs whose number is in rows (row: monotonically_increasing_id() of docs)."""
    numbered = docs.select(F.monotonically_increasing_id().alias("_row"), *COLUMNS)
    return numbered.join(rows.select(F.col("row").alias("_row")), "_row", "left_semi").select(*COLUMNS)


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(docs.select(*COLUMNS)).filter("kept").select(*COLUMNS)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    shipped(spark)
    return chosen(docs, exact_dedup.exact_dedup(docs).filter("kept"))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest doc_id stays."""
    shipped(spark)
    linked = ngram_join.ngram_join(docs, ngram_join.Join(shingle=5, percent=80))
    return chosen(docs, linked.filter("row = component_row"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document that a leaf's prefix ends in stays whole."""
    return chosen(docs, mixing.mixed_sources(docs, MIX).filter("take_tokens > 0"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    shipped(spark)
    return bpe_digests(docs)


STAGES = [
    ("quality rules", rules),
    ("exact dedup", exact),
    ("n-gram Jaccard join", near),
    ("mixing", mixed),
    ("byte-level BPE", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
