"""Training-order materialisation of token sequences.

1. Every task turns its documents into token ids, ends each with the end
   mark, and cuts the stream into sequences of ``length`` ids; a task's last
   one is filled up with end marks. The sequences are stored, so what
   follows sees one numbering: the sequences of earlier partitions, plus the
   place in the own one.
2. A keyed Feistel permutation of the numbers 0 to N - 1 gives every sequence
   its global slot: four rounds over the smallest even number of bits that
   holds N, walking on (permuting again) while the result is N or more. It
   is a bijection, needs no table and no sort, and its inverse finds the
   sequence of a slot.
3. Shard s holds the slots from s * per_shard on: the sequences go straight
   to their shard's partition, are sorted by slot, and become one blob of
   fixed-stride records (``length`` little-endian 16-bit ids each). A reader
   that stopped at any slot goes on at byte (slot - first) * stride.

Null and empty texts have no tokens and leave nothing; copies and repeated
rows are as many documents as rows. An empty table gives no shards. Other
columns are not read. The vocabulary must have at most 65,536 ids.
"""

from __future__ import annotations

import array
import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import chunks, stored

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: fixed value: how the vocabulary's texts are cut into words
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
END = 50256
ROUNDS = 4
#: offsets of more input partitions than this (some MB) are not broadcast
MOST_PARTS = 200_000

_ENCODERS: dict[bytes, tiktoken.Encoding] = {}


def encoder(ranks: bytes) -> tiktoken.Encoding:
    """The tokenizer of a rank file, made once a worker."""
    if ranks not in _ENCODERS:
        _ENCODERS.clear()
        pairs = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        _ENCODERS[ranks] = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=pairs, special_tokens={})
    return _ENCODERS[ranks]


def ids(tokenizer: tiktoken.Encoding, text: str) -> bytes:
    """Token ids as little-endian 16-bit numbers."""
    return array.array("H", tokenizer.encode_ordinary(text)).tobytes()


def sequences(docs: DataFrame, length: int, vocabulary: str) -> DataFrame:
    """(part, place, n_tokens, tokens): the packed sequences of each input
    partition; n_tokens leaves the filling out."""
    with open(vocabulary, "rb") as f:  # on the driver; a vocabulary's size is fixed
        send = docs.sparkSession.sparkContext.broadcast(f.read())
    end, stride = array.array("H", [END]).tobytes(), 2 * length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, part, place, held = encoder(send.value), TaskContext.get().partitionId(), 0, b""

        def rows(cut: list[bytes], sizes: list[int]) -> pa.RecordBatch:
            n = len(cut)
            kinds = (pa.int32(), pa.int64(), pa.int32(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(([part] * n, list(range(place, place + n)), sizes, cut), kinds, strict=True)], names=["part", "place", "n_tokens", "tokens"])

        for batch in batches:
            for piece in chunks(batch, 0, 1_000_000):
                made = [ids(tokenizer, t) + end for t in piece.column(0).to_pylist() if t]
                held += b"".join(made)
                n = len(held) // stride
                if n:
                    yield rows([held[i * stride : (i + 1) * stride] for i in range(n)], [length] * n)
                    place, held = place + n, held[n * stride :]
        if held:
            yield rows([held + end * ((stride - len(held)) // 2)], [len(held) // 2])

    return docs.select("text").mapInArrow(run, "part int, place long, n_tokens int, tokens binary")


def _round(x: np.ndarray, key: int, mask: int) -> np.ndarray:
    x = (x + np.uint64(key)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(32))) & np.uint64(mask)


def _keys(seed: int) -> list[int]:
    return np.random.default_rng(seed).integers(0, 1 << 63, ROUNDS).tolist()


def permute(numbers: np.ndarray, n: int, seed: int, inverse: bool = False) -> np.ndarray:
    """The slot of each number below ``n`` (or, ``inverse``, the number of
    each slot)."""
    half = max(1, ((max(n - 1, 1)).bit_length() + 1) // 2)
    mask, keys = (1 << half) - 1, _keys(seed)
    out = np.asarray(numbers, dtype=np.uint64).copy()
    todo = np.arange(len(out))
    while len(todo):
        x = out[todo]
        left, right = x >> np.uint64(half), x & np.uint64(mask)
        for key in reversed(keys) if inverse else keys:
            if inverse:
                left, right = right ^ _round(left, key, mask), left
            else:
                left, right = right, left ^ _round(right, key, mask)
        out[todo] = (left << np.uint64(half)) | right
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


def slotted(packed: DataFrame, seed: int) -> tuple[DataFrame, int]:
    """(slot, n_tokens, tokens) of stored sequences, and their number."""
    parts = packed.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    size = parts.agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("parts")).first()
    total = size.total or 0
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = parts.select("part", before.alias("before"))  # a row for each input partition
    numbered = packed.join(F.broadcast(offsets) if size.parts <= MOST_PARTS else offsets, "part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(permute(b.column(0).to_numpy(), total, seed)), b.column(1), b.column(2)], names=["slot", "n_tokens", "tokens"])

    return numbered.select((F.col("before") + F.col("place")).alias("number"), "n_tokens", "tokens").mapInArrow(run, "slot long, n_tokens int, tokens binary"), total


def shards(docs: DataFrame, length: int = 2048, per_shard: int = 256, seed: int = 11, vocabulary: str = VOCABULARY) -> DataFrame:
    """(shard, first_slot, n_sequences, n_tokens, sizes, data): the shards of
    ``docs`` in training order. ``sizes`` are the records' real tokens."""
    slots, total = slotted(stored(sequences(docs, length, vocabulary), "sequences", "zstd"), seed)
    dealt = slots.withColumn("shard", (F.col("slot") / per_shard).cast("int"))
    dealt = dealt.repartitionById(max(1, -(-total // per_shard)), "shard").sortWithinPartitions("slot")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, first, sizes, data = None, 0, [], []

        def row() -> pa.RecordBatch:
            kinds = (pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int32()), pa.binary())
            values = (shard, first, len(data), sum(sizes), sizes, b"".join(data))
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names=["shard", "first_slot", "n_sequences", "n_tokens", "sizes", "data"])

        for b in batches:
            for slot, n, tokens, own in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if own != shard:
                    if data:
                        yield row()
                    shard, first, sizes, data = own, slot, [], []
                sizes.append(n)
                data.append(tokens)
        if data:
            yield row()

    return dealt.select("slot", "n_tokens", "tokens", "shard").mapInArrow(run, "shard int, first_slot long, n_sequences int, n_tokens long, sizes array<int>, data binary")


def write_shards(docs: DataFrame, path: str, **how) -> None:
    """The shards of ``docs`` as a table under ``path``."""
    shards(docs, **how).write.parquet(path)


def read_slots(spark: SparkSession, path: str, start: int, length: int = 2048) -> DataFrame:
    """(slot, shard, byte_offset, n_tokens, tokens) from slot ``start`` on:
    shards before it are skipped, the first one is entered at its offset."""
    kept = spark.read.parquet(path).where(F.col("first_slot") + F.col("n_sequences") > start)
    return records(kept, length).where(F.col("slot") >= start)


def records(kept: DataFrame, length: int = 2048) -> DataFrame:
    """The fixed-stride records of shards."""
    stride = 2 * length
    cut = F.transform("sizes", lambda size, i: F.struct(size.alias("n"), F.substring(F.col("data"), i * stride + 1, F.lit(stride)).alias("tokens")))
    each = kept.select("shard", "first_slot", F.posexplode(cut).alias("place", "r"))
    return each.select(
        (F.col("first_slot") + F.col("place")).alias("slot"),
        "shard",
        (F.col("place") * stride).cast("long").alias("byte_offset"),
        F.col("r.n").alias("n_tokens"),
        F.col("r.tokens").alias("tokens"),
    )
