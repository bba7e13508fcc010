"""Sharding by a two-pass external shuffle, DataFrame functions only.

Pass 1 scatters: a row's shard is the one with the highest seeded hash of
(key, shard number) -- so key and shard count decide, and one more shard
takes rows only into itself -- and its bucket, of as many as the shard's
bytes need for ``bucket_bytes`` each, follows from a seeded hash of all its
columns. Rows equal in every column are spread over buckets by the input
partition they lie in. The scattered rows are written to the shared folder,
so both later reads see the same buckets.

Pass 2 shuffles: one partition for each bucket; its rows, in a fixed order,
become an array that Spark's ``shuffle`` permutes by Fisher-Yates with the
given seed. A row's slot is its place in the array plus the rows of the
shard's earlier buckets.

Nulls: a null text has no bytes; rows without a key hash as one key. Copies
and repeated rows keep their own slots. An empty table gives no rows. Other
columns are carried along; those named like a result column (``size``,
``text_crc32``, ``shard``, ``grown_shard``, ``bucket``, ``slot``) go.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, text_bytes, without

RESULT = ["size", "text_crc32", "shard", "grown_shard", "bucket", "slot"]


def shard_of(key: Column, n_shards: int, seed: int) -> Column:
    """The shard with the highest hash; adding one moves only the keys whose
    highest hash is the new one's."""
    ranked = F.transform(
        F.sequence(F.lit(0), F.lit(n_shards - 1)),
        lambda s: F.struct(F.xxhash64(F.lit(seed), key, s).alias("h"), s.alias("s")),
    )
    return F.array_max(ranked)["s"].cast("int")


def scatter(docs: DataFrame, n_shards: int, bucket_bytes: int, seed: int, key: str, text: str) -> DataFrame:
    """Pass 1: ``docs`` with size, text_crc32, shard, grown_shard and a
    global ``bucket`` number, stored."""
    base = without(docs, RESULT)
    sized = base.select(
        "*",
        (text_bytes(F.col(text)) + 8).alias("size"),
        F.coalesce(F.crc32(F.col(text).cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        shard_of(F.col(key), n_shards, seed).alias("shard"),
        shard_of(F.col(key), n_shards + 1, seed).alias("grown_shard"),
    )
    per_shard = dict(sized.groupBy("shard").agg(F.sum("size")).collect())  # n_shards rows at most
    counts = [max(1, -(-per_shard.get(s, 0) // bucket_bytes)) for s in range(n_shards)]
    first = [sum(counts[:s]) for s in range(n_shards)]
    at = F.col("shard") + 1
    spread = F.xxhash64(F.lit(seed + 1), *[F.col(f"`{c}`") for c in base.columns if not _unhashable(base, c)], F.spark_partition_id())
    bucket = F.element_at(F.lit(first), at) + F.pmod(spread, F.element_at(F.lit(counts), at))
    return stored(sized.withColumn("bucket", bucket.cast("int")), "scatter")


def _unhashable(df: DataFrame, name: str) -> bool:
    return any(x in df.schema[name].dataType.simpleString() for x in ("map<", "variant"))


def shuffle_buckets(scattered: DataFrame, seed: int) -> DataFrame:
    """Pass 2: the rows of ``scattered`` in slot order inside each bucket."""
    carried = [c for c in scattered.columns if c not in ("shard", "bucket")]
    counts = scattered.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    n_buckets = (counts.agg(F.max("bucket")).first()[0] or 0) + 1
    earlier = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(F.col("bucket").alias("_at"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before"))
    row = F.struct(F.xxhash64(*[F.col(f"`{c}`") for c in carried if not _unhashable(scattered, c)]).alias("_order"), *[F.col(f"`{c}`") for c in carried])
    dealt = scattered.repartitionById(n_buckets, F.col("bucket"))
    arrays = dealt.groupBy("bucket", "shard").agg(F.collect_list(row).alias("_rows"))
    in_order = F.array_sort(F.col("_rows"), lambda a, b: F.when(a["_order"] < b["_order"], -1).when(a["_order"] > b["_order"], 1).otherwise(0))
    out = arrays.select("bucket", "shard", F.posexplode(F.shuffle(in_order, F.lit(seed))).alias("_place", "_row"))
    out = out.join(before, F.col("bucket") == F.col("_at"))
    return out.select(*[F.col("_row")[c].alias(c) for c in carried], "shard", "bucket", (F.col("_before") + F.col("_place")).cast("long").alias("slot"))


def shard_rows(docs: DataFrame, n_shards: int = 24, bucket_bytes: int = 16 << 20, seed: int = 17, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows of ``docs`` with shard, slot (from 0, gapless in a shard),
    bucket, grown_shard (the shard with one more), size and text_crc32."""
    if n_shards < 1 or bucket_bytes < 1:
        raise ValueError("n_shards and bucket_bytes must be positive")
    return shuffle_buckets(scatter(docs, n_shards, bucket_bytes, seed, key, text), seed)


def write_shards(rows: DataFrame, path: str) -> None:
    """Write sharded rows to ``path/shard=N``, each file in slot order."""
    rows.repartition("shard", "bucket").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
