"""From documents to packed training sequences: language, recurring lines, near duplicates, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again for the next
one. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import language, line_templates, near_dedup, packing
from millrace.llm.common import free_name, staged, table

#: Share of the best language below which a document's language counts as unsure.
LEAST_SCORE = 0.5

#: The packing's arrangement depends on partitions, so no SQL states the rows.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told from their text: those without letters and unsure ones go.

    The model learns from the rows with a label. Without any, no language can be told and all rows go.
    """
    lang, score = free_name(docs, "lang_pred"), free_name(docs, "score")
    found = language.with_language(docs, language.fit(docs), lang_out=lang, score_out=score)
    return found.where((F.col(lang) != language.UNKNOWN) & (F.col(score) >= LEAST_SCORE)).select(docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Recurring lines of any length stay in their first document; a document that loses all its words goes.

    Null, empty and blank texts lose nothing and stay. No rows give none."""
    dropped = free_name(docs, "n_dropped")
    left = line_templates.drop_recurring_lines(docs, dropped_out=dropped)
    return left.where((F.col(dropped) == 0) | F.col("text").rlike(line_templates.WORD)).select(docs.columns)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, a similarity of 0.8.

    Of a group the row with the smallest id stays, rows without an id only where none has one. Null, empty and blank texts are
    alike with nothing and stay. No rows give none."""
    return near_dedup.drop_near_duplicates(docs, k=5, percent=80).select(docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequence and place. Null and empty texts are one end mark; no rows give none."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup_stage),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
