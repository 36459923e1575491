"""A corpus pipeline: five stages, each written as Parquet and read again by the next.

run(spark, sf_dir) applies STAGES to the table documents. All stages but the last return the
columns of documents; the last returns these columns, text masked, and mix_block, mix_order
and mix_tokens: a row for each time a document is drawn into the mixture.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plaza.llm import decontaminate, jaccard_join, language_id, mixing, pii
from plaza.llm.common import load, stored
from plaza.llm.queries import train_languages


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is certain; lang becomes the language found."""
    found = language_id.identify(docs, train_languages(docs))
    return found.where(~F.col("lang_rejected")).withColumn("lang", F.col("lang_pred")).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return jaccard_join.keep_first(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window."""
    return decontaminate.without_contaminated(docs, load(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; n_chars follows the text."""
    masked = pii.mask(docs, pii.train(docs))
    return masked.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The draws of a mixture that repeats no source more than the limit."""
    return mixing.mix(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("jaccard_join", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("pii", mask_personal_data),
    ("mixing", mix_sources),
]

#: Compression, labelers and their EM can't be expressed in SQL; tests/llm/test_pipeline.py runs the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
