"""The corpus pipeline: language, near-duplicates, personal data, mixture, windows.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; the result is
written as Parquet and read again for the next one. All but the last return the columns of
``documents``. No stage has a SQL equivalent. The operators' tests hold what the stages do against
brute force, round trips and held-out rows; the pipeline's own test looks at columns and windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from brightmere.llm import lang_id, minhash, mixing, packing, pii
from brightmere.llm.common import remainder, staged
from brightmere.llm.queries import table, tokenizer


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language: those without a letter or like no language go."""
    return lang_id.reject(docs, lang_id.fit(docs.where(remainder("doc_id", 4) != 2)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return minhash.deduplicate(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their personal data replaced by its kind."""
    return pii.mask(docs, pii.fit(docs))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture wants them. Clean documents, those labelled so and those
    without a label that are likelier clean than anything else, have rates of one or more and
    stay; poor and toxic ones are thinned out or repeated, as far as the targets then allow."""
    labelled = mixing.by_labels(table(spark, sf_dir, "labels"))
    return mixing.mix(docs, labelled, {"clean": 0.9, "poor": 0.08, "toxic": 0.02}, "clean", 1.1)


def windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in windows of 2048 tokens that keep the sources' shares."""
    return packing.digests(packing.pack(docs, tokenizer()))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mixture", mixture),
    ("windows", windows),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
