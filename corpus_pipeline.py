"""Text for training from `documents`: five stages, each a table of its own.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last return the columns
of documents, and further columns of docs stay whatever their names. Rows are rows: those that repeat an id, or have none, are
each looked at with their own text. Empty tables give empty tables; a labels or benchmark table that is missing counts as empty.
Texts are read whole; one text must fit into a task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickfuse.llm import decontamination, line_dedup, mixing, near_dup, quality
from tickfuse.llm.common import read, read_or_empty, table

LABELS = "doc_id bigint, quality int, toxic int"


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go: null and empty texts, and those whose nearest labelled neighbours say 0 by more
    than 30 %. Without labels only texts without a word go. Rows of equal texts stay or go together."""
    return quality.accept(docs, quality.fit(docs, read_or_empty(spark, sf_dir, "labels", LABELS)))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that are boilerplate of their source (null: a source of its own) go, counted by distinct texts, so that copies don't
    empty each other; every document stays, with n_chars anew. A null text stays null."""
    return line_dedup.clean_documents(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near duplicates stays, that of the smallest id; rows without an id come last. Of rows that are
    alike in id and text one stays. Texts without words have no class and stay."""
    return near_dup.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item within its edit budget go. Null texts hold none; items without a letter or digit
    are in no text."""
    return decontamination.clean(docs, read_or_empty(spark, sf_dir, "benchmark", "item_id bigint, text string"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each row, by target weights of the sources (null last). Rows without words have size 0 and give
    none; equal rows may give different numbers of words, as a block may end between them."""
    return mixing.mix(docs)


STAGES = [
    ("quality", quality_stage),
    ("lines", line_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
]

#: The classifier and the near-duplicate search aren't SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
