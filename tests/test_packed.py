"""Shuffles of compressed columns: the rows that went in, where they belong."""

import pytest
from pyspark.sql import functions as F

from lexispark.functions import packed
from lexispark.operators.indexing import postings_of, with_doc_key, with_terms
from lexispark.session import fresh_path
from lexispark.sources.corpus import Corpus
from lexispark.sources.tables import documents_corpus

SF = "/root/testdata/sf0.001"


def awkward(spark):
    rows = [(i, f"t{i % 7}" if i % 5 else None, "山é\U00020003" * (i % 3), [i % 4, 3 + i, 2_000_000_000][: i % 4], float(i) if i % 6 else None) for i in range(2000)]
    return spark.createDataFrame(rows, "n long, a string, b string, positions array<int>, x double").repartition(3, "n")


def lines(df):
    return sorted(str(tuple(r)) for r in df.collect())


def test_rows_go_through_unchanged(spark, monkeypatch):
    df = awkward(spark)
    out = packed.dealt(df, 5, F.col("n") % 5)
    assert out.schema == df.schema and lines(out) == lines(df)
    at = out.select((F.col("n") % 5).alias("to"), F.spark_partition_id().alias("at")).distinct()
    assert at.count() == 5 == at.select("at").distinct().count()
    assert lines(packed.dealt(df.drop("positions"), 1, F.lit(0))) == lines(df.drop("positions"))
    assert packed.dealt(df.where("n < 0"), 4, F.lit(2)).count() == 0


@pytest.mark.parametrize("spread", [True, False])
def test_a_hot_partition_passes_rows_on(spread, spark):
    df = spark.range(0, 200_000, 1, 2).select(F.col("id").alias("n"), F.array(F.lit(1), F.col("id").cast("int") + 2).alias("positions"))
    out = packed.dealt(df, 40, F.lit(7), spread)
    assert out.agg(F.count(F.lit(1)), F.sum("n"), F.sum(F.element_at("positions", 2))).first() == (200_000, 19_999_900_000, 20_000_300_000)
    most = max(r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect())
    assert (most <= 40_000) if spread else (most == 200_000)


def test_postings_of_the_build_are_small_in_the_shuffle(spark):
    rows = postings_of(with_terms(with_doc_key(documents_corpus(spark, SF))), 64, False)
    n = rows.count()
    blocks = rows.select("*", F.lit(0).alias("_part")).mapInArrow(lambda b: packed.pack(b, 1, False), "part int, rows binary, lists binary")
    assert blocks.agg(F.sum(F.octet_length("rows") + F.octet_length("lists"))).first()[0] < 16 * n


def test_stored_tables_are_dealt_as_compressed_columns(spark, monkeypatch):
    seen = []
    from lexispark.sources import corpus

    monkeypatch.setattr(corpus, "POSTINGS_BYTES", 2_000)
    monkeypatch.setattr(corpus, "packed_to", lambda rows, n, *a, **b: seen.append((rows.columns, n)) or packed.dealt(rows, n, *a, **b))
    c = Corpus(spark, fresh_path(spark, "packed"), n_buckets=8, create=True)
    docs = documents_corpus(spark, SF).limit(40)
    c.rebuild(docs)
    assert ["text" in cols for cols, _ in seen] == [True, False] and "positions" in seen[1][0] and seen[1][1] > 8
    want = postings_of(with_terms(with_doc_key(docs)), 8).select("bucket", "term", "id", "tf", "copies", "positions")
    assert lines(c.index().postings.select(*want.columns)) == lines(want)
    files = spark.read.parquet(f"{c.path}/postings").inputFiles()
    assert all(f.endswith(".zstd.parquet") for f in files) and len(files) >= 8
