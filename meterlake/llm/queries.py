"""The operators as queries over the test tables, in the form their contracts ask for."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm import language, licenses, main_text, quality
from meterlake.llm.byte_bpe import encode
from meterlake.llm.common import held_out, ship_package, table
from meterlake.llm.concat_cut import concat_and_cut
from meterlake.llm.exact_dedup import exact_duplicates
from meterlake.llm.packing import pack
from meterlake.llm.pii import summarised
from meterlake.llm.shingle_join import near_duplicates
from meterlake.llm.spelling import variants
from meterlake.llm.top_k import top_k
from meterlake.llm.whitening import whiten

Query = Callable[[SparkSession, str], DataFrame]


def as_long(column: str) -> Column:
    """An exact whole number as a long; null where it is no 64-bit number."""
    return F.col(column).try_cast("bigint")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model, ["doc_id"]).select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return pack(table(spark, sf_dir, "documents"), tokenizer, ["doc_id"])


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    found = main_text.extract(pages, main_text.train(pages), ["page_id", "url"])
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("row", "first_row")


def op5_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, 10)
    return found.withColumn("score", as_long("score"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    said = language.identify(docs.select("doc_id", "text"), language.train(docs), ["doc_id"])
    return said.select(
        "doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score", "ambiguous"
    )


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"), digest=True).drop("row")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summarised(table(spark, sf_dir, "documents"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"), ["doc_id"])
    return found.select(
        "doc_id",
        F.size("sentence_ids").cast("long").alias("n_sentences"),
        F.array_join("sentence_ids", ",").alias("sentence_ids"),
        F.array_join("licences", ",").alias("licenses"),
    )


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = table(spark, sf_dir, "documents")
    return encode(docs, ranks, public_tokenizers.PATTERN, ["doc_id"])


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(table(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whiten(table(spark, sf_dir, "embeddings"), ["vec_id"])
    return found.withColumn("deviation", as_long("deviation"))


def op13_concat_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return concat_and_cut(table(spark, sf_dir, "documents"), tokenizer, ["doc_id"])


def ready(build: Query) -> Query:
    """The query, once executors can import what it sends them."""

    @wraps(build)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return build(spark, sf_dir)

    return run


_QUERIES: dict[str, Query] = {
    "op1_quality": op1_quality,
    "op2_packing": op2_packing,
    "op3_main_text": op3_main_text,
    "op4_ngram_join": op4_ngram_join,
    "op5_top_k": op5_top_k,
    "op6_language": op6_language,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_pii": op8_pii,
    "op9_licenses": op9_licenses,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_spelling": op11_spelling,
    "op12_whitening": op12_whitening,
    "op13_concat_cut": op13_concat_cut,
}

LLM_QUERIES = {name: ready(build) for name, build in _QUERIES.items()}
