import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from lexispark.llm import sharding
from lexispark.session import fresh_path

from .helpers import awkward, frame, with_clashes


def got(df):
    return [r.asDict() for r in df.collect()]


def test_every_row_has_a_slot_and_the_key_law_holds(spark):
    docs = frame(spark)
    rows = got(sharding.shard_rows(docs, 5, bucket_bytes=2000))
    assert Counter((r["doc_id"], r["text"]) for r in rows) == Counter((d[0], d[1]) for d in awkward())
    by = defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r["slot"])
        text = (r["text"] or "").encode()
        assert r["size"] == len(text) + 8 and r["text_crc32"] == zlib.crc32(text)
        assert r["grown_shard"] in (r["shard"], 5)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert len({r["bucket"] for r in rows}) > 5  # the long text needs buckets of its own
    home = defaultdict(set)
    for r in rows:
        home[r["doc_id"]].add((r["shard"], r["grown_shard"]))
    assert all(len(x) == 1 for x in home.values())
    grown = {r["doc_id"]: r["shard"] for r in got(sharding.shard_rows(docs, 6, bucket_bytes=2000))}
    assert all(grown[r["doc_id"]] == r["grown_shard"] for r in rows)


def test_shuffle_is_seeded_and_moves_rows(spark):
    docs = frame(spark, [(i, f"t{i}", "en", "s", 1) for i in range(200)])
    order = lambda seed: [r["doc_id"] for r in sorted(got(sharding.shard_rows(docs, 1, 1 << 20, seed)), key=lambda r: r["slot"])]
    one = order(1)
    assert one == order(1) and one != order(2) and one != sorted(one)


def test_equal_rows_spread_over_buckets(spark):
    docs = spark.range(0, 400, 1, 8).select(F.lit(7).cast("long").alias("doc_id"), F.lit("same text here").alias("text"))
    rows = got(sharding.shard_rows(docs, 2, bucket_bytes=1000))
    assert len({r["shard"] for r in rows}) == 1 and len({r["bucket"] for r in rows}) > 1
    assert sorted(r["slot"] for r in rows) == list(range(400))


def test_written_shards_keep_the_slot_order(spark):
    path = fresh_path(spark, "shards")
    sharding.write_shards(sharding.shard_rows(frame(spark), 3, 2000), path)
    back = spark.read.parquet(path)
    assert back.count() == len(awkward()) and {r.shard for r in back.select("shard").distinct().collect()} <= {0, 1, 2}


def test_empty_table_and_clashing_columns(spark):
    assert sharding.shard_rows(frame(spark, []), 4).count() == 0
    out = sharding.shard_rows(with_clashes(frame(spark)), 4)
    assert out.count() == len(awkward()) and {"score", "keep", "shard"} <= set(out.columns)
    with pytest.raises(ValueError):
        sharding.shard_rows(frame(spark), 0)


def test_no_python_in_the_plan(spark):
    plan = sharding.shard_rows(frame(spark).drop("n_chars").limit(5), 2)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
