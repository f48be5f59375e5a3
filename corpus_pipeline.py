"""A corpus from raw documents to packed sequences, in stages.

Each stage takes (spark, docs, sf_dir), docs being a stored table with the columns of
`documents`, and returns a DataFrame. `run` writes each result as Parquet below the
shared folder and reads it again as the next stage's docs. A stage works on all rows its
predecessor kept, and what it decides takes effect: rejected rows are gone, redacted
texts are replaced. Nulls, empty texts, empty tables and further columns are handled as
the operators say; all but the last stage keep every column.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from meterlake.llm.common import ship_package, table
from meterlake.llm.exact_dedup import drop_duplicates
from meterlake.llm.language import keep_known
from meterlake.llm.packing import pack
from meterlake.llm.pii import redact
from meterlake.llm.shingle_join import drop_near_duplicates
from meterlake.session import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the model knows."""
    return keep_known(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return drop_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by near-equal texts."""
    return drop_near_duplicates(docs)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 tokens, with their ids."""
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return pack(docs, tokenizer, ["doc_id"], with_ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("pii", pii),
    ("packing", packing),
]

# Learned scores, trees and a packing heuristic have no SQL form.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to `documents`, one after the other."""
    ship_package(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
