"""Read the given tables as corpora and query tables.

A corpus is ``(id STRING, header_key STRING, text STRING)``; only the three
columns are read (column pruning reaches the Parquet scan)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.tokenize import cjk_letter_map
#: session setting for callers whose tables are single-row-group files (the
#: bench): deal the rows out to so many partitions. Unset, a table is read in
#: the splits of its files.
PARTITIONS = "lexispark.table.partitions"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, read in the splits of its files (or see PARTITIONS)."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    n = spark.conf.get(PARTITIONS, None)
    return df.repartition(int(n)) if n else df


def documents_corpus(spark: SparkSession, sf_dir: str, header: str = "lang") -> DataFrame:
    """``documents``: id = doc_id as string, header_key = ``lang`` (or
    ``source``), text. NULLs become empty strings (the schema is non-null)."""
    d = table(spark, sf_dir, "documents")
    return d.select(
        F.col("doc_id").cast("string").alias("id"),
        F.coalesce(F.col(header), F.lit("")).alias("header_key"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )


def cjk_documents_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` with the fixed letter map applied: CJK text at scale."""
    return documents_corpus(spark, sf_dir).withColumn("text", cjk_letter_map(F.col("text")))


def conversations_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``conversations``: id = ``conv_id-turn``, header_key = role."""
    c = table(spark, sf_dir, "conversations")
    return c.select(
        F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("id"),
        F.coalesce(F.col("role"), F.lit("")).alias("header_key"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )


def pages_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pages``: raw HTML as text (markup kept, long unbroken strings),
    id = page_id, header_key = the URL's host."""
    p = table(spark, sf_dir, "pages")
    return p.select(
        F.col("page_id").cast("string").alias("id"),
        F.coalesce(F.regexp_extract(F.col("url"), "://([^/]+)", 1), F.lit("")).alias("header_key"),
        F.coalesce(F.col("html"), F.lit("")).alias("text"),
    )


def benchmark_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``benchmark``: every item's whole text is one query."""
    b = table(spark, sf_dir, "benchmark")
    return b.select(F.col("item_id").cast("string").alias("query_id"), F.col("text").alias("query"))


def user_turn_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``conversations`` user turns as queries, id ``conv_id-turn``."""
    c = table(spark, sf_dir, "conversations").filter(F.col("role") == "user")
    return c.select(
        F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("query_id"),
        F.col("text").alias("query"),
    )
