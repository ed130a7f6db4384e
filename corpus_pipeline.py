"""A corpus pipeline: quality, line dedup, near-duplicate documents, source weights, token ids.

Each stage reads what the one before has kept, written as Parquet in the
folder that all executors share.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tremor.llm import bpe, line_dedup, mixing, ngram_join, quality_lr
from tremor.session import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose whole text the classifier takes for good (4).

    Null and empty texts have the score of the bias; repeated rows stay as
    often; null doc_ids are scored like others; an empty table stays empty.
    """
    return quality_lr.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that occur earlier; documents left without any line go (9).

    Null texts and texts without words stay; repeated rows lose the same lines
    and stay as often; an empty table stays empty.
    """
    return line_dedup.keep_first_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least doc_id, of each group of near-duplicates (3).

    Null doc_ids and documents without words stay; rows of one doc_id stay as
    often; an empty table stays empty.
    """
    return ngram_join.keep_one(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the weights of their sources ask (2).

    A null source is a source of its own; documents without words are read
    once an epoch of their source; an empty table stays empty.
    """
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the bytes they decode to (6).

    One row per row; a null text counts as empty; an empty table gives no rows.
    """
    return bpe.round_trip(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_duplicates),
    ("source mixing", mixture),
    ("byte-level BPE", tokens),
]

#: The classifier's trained weights and the hash orders have no SQL form.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialize(docs, f"stage{i + 1}")
    return docs
