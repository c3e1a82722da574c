"""A corpus pipeline of five stages; each calls one operator of voxelloom.llm and keeps what it decides."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelloom.llm import common, packing, quality, queries, shingles, suffixes, toxicity


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go; null, empty and repeated rows, empty tables and other columns as in quality.accepted."""
    return quality.accepted(docs, queries.table(spark, sf_dir, "labels"))


def harmless(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are predicted toxic go; null, empty and repeated rows, empty tables and other columns as in toxicity.accepted."""
    return toxicity.accepted(docs, queries.table(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies (0.8 or more of their five-word shingles shared) stays: the one with the smallest doc_id.

    Null ids come last; of rows of one id the smallest hash of the text stays, and of rows repeated whole any one. Null and
    empty texts are one group. An empty table stays empty. Other columns may have any name.
    """
    named = docs.toDF(*[c if c in ("doc_id", "text") else f"c{i}" for i, c in enumerate(docs.columns)])
    numbered, _ = common.written(named.withColumn("row_no", F.monotonically_increasing_id()), "numbered")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.xxhash64("text").alias("hash"), "row_no")
    groups = shingles.near_duplicates(numbered.select("doc_id", "text", "row_no"))
    best = groups.groupBy("component").agg(F.min(order).alias("best")).select(F.col("best.row_no").alias("row_no"))
    return numbered.join(best, "row_no", "left_semi").select(*named.columns).toDF(*docs.columns)


def unrepeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 100 bytes that also start earlier go from the texts; n_chars, where docs has it, follows the text.

    Null texts become empty; ties, repeated rows, empty tables and other columns are as in suffixes.deduplicated.
    """
    out = suffixes.deduplicated(docs)
    return out.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else out


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences; null, empty and repeated rows, empty tables and other columns as in packing.pack."""
    return packing.pieces(docs, queries.tokenizer("word_bpe_49k.json"))


STAGES = [("quality", good), ("toxicity", harmless), ("near copies", near_copies), ("repeated strings", unrepeated), ("packing", packed)]

ORACLE_SQL = None  # tokens, trained scores and fingerprints are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents; each result is written to the shared folder and read back for the next. An empty table gives no pieces."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs, _ = common.written(docs, name.replace(" ", "-"))
    return docs
