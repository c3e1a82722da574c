"""The queries of this folder: each runs one operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, chat, embeddings, oph, oracle, packing, quality, simhash, suffixes, toxicity, warc


def tokenizer(name: str) -> str:
    """Where a public vocabulary file lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.digests(table(spark, folder, "documents"), tokenizer("byte_bpe_50k.json"))


def op2_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(table(spark, folder, "pages"))


def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op5_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, folder, "embeddings"))


def op6_chat(spark: SparkSession, folder: str) -> DataFrame:
    return chat.digests(chat.with_adversary(table(spark, folder, "conversations")))


def op7_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return oph.with_next(table(spark, folder, "documents"))


def op8_suffixes(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.digests(table(spark, folder, "documents"))


def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pieces(table(spark, folder, "documents"), tokenizer("word_bpe_49k.json"))


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_bpe, op2_warc, op3_simhash, op4_quality, op5_embeddings, op6_chat, op7_fingerprints, op8_suffixes, op9_packing, op10_toxicity)}


def oracle_sql() -> dict[str, str]:
    return oracle.oracle_sql()
