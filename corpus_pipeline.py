"""The corpus pipeline: from ``documents`` to sampled token ids.

Five stages, each a function (spark, docs, sf_dir) -> DataFrame that calls
one operator of ``lexispark.llm``; its result is written as Parquet and read
again as the next one's docs. All but the last return the columns of
``documents`` (and any extra ones) of the rows they keep:

1. language: rows whose languages can't be identified (no letters, or a worse
   fit than a uniform guess among the known letters) go;
2. quality: rows above their language's perplexity threshold go;
3. near_duplicates: one row of each class of near copies stays;
4. decontamination: rows that hold a benchmark window go;
5. sentencepiece: two distinct sampled segmentations of every row that is
   left: doc_id, sample, ids, logp, log_inclusion, decoded.

Nulls, empty texts, ties, repeated rows and empty tables: see the operators;
a row without text doesn't pass stage 1.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexispark.llm import decontaminate, langid, neardup, pieces, quality
from lexispark.llm.common import stored, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_identified(docs)


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.sample_segmentations(docs, k=2)


STAGES = [
    ("language", language),
    ("quality", good),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("sentencepiece", sentencepiece),
]

#: Mixture inference and the trained models can't be said in SQL; the tests
#: hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
