"""A training corpus from ``documents``: toxic texts out, one of each near-duplicate group, mixed, encoded.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; its rows are written as Parquet and read
again as the next stage's docs. All but the last return the columns of documents. Null and empty texts
pass the toxicity stage, equal ones among them leave one row, and texts without words are never repeated
beyond the whole turns of their source. An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablewarden.llm import bpe, mixture, neardup, queries, toxicity
from tablewarden.llm.registry import table
from tablewarden.session import materialize


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic; learned from the labels of what came in."""
    return toxicity.reject(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return neardup.deduplicated(docs)


def mixture_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixture.repeated(docs, mixture.mix(docs))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document as digests, with its source."""
    return bpe.digests(docs, queries.vocabulary(), keep=("doc_id", "source"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("mixture", mixture_stage),
    ("byte_bpe", encoding_stage),
]

# Trained scores, similarity components and token ids have no SQL; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
