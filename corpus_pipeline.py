"""A training corpus from `documents`, in five stages.

Each stage takes (spark, docs, sf_dir), reads every row its predecessor kept, and returns the columns of
documents; the last adds what the mix takes. A null text counts as an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eodlake.llm import decontaminate, line_dedup, mixing, ngram_join, quality_rules
from eodlake.llm.common import DOCUMENT_COLUMNS, cut, table

SEED = 11


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality_rules.cascade(docs.select(*DOCUMENT_COLUMNS), "text").where("kept").select(*DOCUMENT_COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier line matches; n_chars follows the text."""
    return line_dedup.dedup(docs.select(*DOCUMENT_COLUMNS), n_chars="n_chars").select(*DOCUMENT_COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, 0.8), the one with the smallest id."""
    return ngram_join.keep_one(docs.select(*DOCUMENT_COLUMNS), words=5, num=80, den=100).select(*DOCUMENT_COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean(docs.select(*DOCUMENT_COLUMNS), table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with the words taken and the copies."""
    docs = docs.select(*DOCUMENT_COLUMNS).withColumns(
        {"words": mixing.text_size("text"), "place": mixing.seeded(SEED, "doc_id", "text")}
    )
    mixed = mixing.mix(docs, F.col("words"), F.array("source"), F.col("place"), tie=("doc_id",)).where("copies > 0")
    return mixed.select(*[f"row.{c}" for c in DOCUMENT_COLUMNS], "size", F.col("target")[0].alias("target"), "copies", "taken")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", decontamination),
    ("source mixing", mixture),
]

#: SQL can't express the joins by similarity; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared checkpoint folder before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
