"""Document fingerprints: a homomorphic multiset hash of paragraphs.

A text is the multiset of its paragraphs (the pieces between line feeds,
empty ones included). Each is hashed to a wide vector and the vectors are
summed, so the order of paragraphs doesn't matter, equal texts have equal
fingerprints, and a paragraph is inserted or deleted by one addition or
subtraction. A fingerprint has two parts, summed modulo two powers:

* 16 lanes modulo 2^64: the whole paragraph's hash (1024 bits in all).
  Different multisets give different sums but for a hash collision;
* 512 lanes modulo 2^16: +1 or -1 for each sentence of the paragraph (pieces
  between sentence ends, trimmed, one of over 400 bytes cut after words whose
  hash says so). The inner product of two such sums estimates how many
  sentences two documents share, so likeness = 2ab / (aa + bb), cut to
  0 .. 1, is the share of common sentences with a standard error of about
  1 / sqrt(512). Equal fingerprints have likeness 1. Lanes that pass 2^15
  (a line repeated that often) wrap round, alike on both sides.

``neighbours_in_order`` gives each row the next one by descending id with one
shuffle of the texts and no global window: split points are keys of a
bounded sample, so each block starts with a known row, whose text is sent to
the block before. Rows of a block stream through their task in sorted order.

Nulls: a null text is empty (one empty paragraph). Rows without id come
last. Ties: rows of one id are ordered by their text's hash, then text;
repeated rows (id and text) are counted in each batch before the shuffle and
expanded at the end, each copy but the last having itself as the next. A
table of one row has itself as the next. An empty table gives no rows. Very
long texts are hashed in slices. Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_columns

#: lanes modulo 2^64 of whole paragraphs, and modulo 2^16 of their sentences
WIDE, SIGNS = 16, 512
#: sentence ends become line feeds
ENDS = bytes(10 if b in b".!?\r\f\v" else b for b in range(256))
#: a sentence of more bytes is cut at its own words; sentences hashed at once
LONG, SLICE = 400, 16_384


def paragraphs(text: str | None) -> list[str]:
    return (text or "").split("\n")


def _encoded(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def sentences(paragraph: bytes) -> list[bytes]:
    """The trimmed sentences of a paragraph, without empty ones."""
    found = [s for x in paragraph.replace("。".encode(), b"\n").translate(ENDS).split(b"\n") if (s := x.strip())]
    if any(len(s) > LONG for s in found):
        return [piece for s in found for piece in (_cut(s) if len(s) > LONG else [s])]
    return found


def _cut(sentence: bytes) -> list[bytes]:
    """A long sentence in runs of about 16 words: a run ends with a word
    whose hash says so, so an edit changes the runs that it touches only."""
    out: list[bytes] = []
    held: list[bytes] = []
    for word in sentence.split():
        held.append(word)
        if crc32(word) % 16 == 0:
            out.append(b" ".join(held))
            held = []
    return [*out, b" ".join(held)] if held else out


class Sums:
    """Fingerprint vectors of ``n`` multisets."""

    def __init__(self, n: int):
        self.wide = np.zeros((n, WIDE), np.uint64)
        self.signs = np.zeros((n, SIGNS), np.int16)

    @classmethod
    def of(cls, groups: Iterable[list[str]], n: int) -> Sums:
        """The sums of ``n`` lists of paragraphs."""
        out = cls(n)
        wide: list[bytes] = []
        signs: list[bytes] = []
        wide_at: list[int] = []
        signs_at: list[int] = []
        for i, group in enumerate(groups):
            for paragraph in group:
                raw = _encoded(paragraph)
                wide.append(hashlib.shake_128(raw).digest(WIDE * 8))
                wide_at.append(i)
                own = [hashlib.blake2b(s, digest_size=SIGNS // 8).digest() for s in sentences(raw)]
                signs += own
                signs_at += [i] * len(own)
                if len(signs) >= SLICE or len(wide) >= SLICE:
                    out._take(wide, wide_at, signs, signs_at)
                    wide, wide_at, signs, signs_at = [], [], [], []
        out._take(wide, wide_at, signs, signs_at)
        return out

    def _take(self, wide: list[bytes], wide_at: list[int], signs: list[bytes], signs_at: list[int]) -> None:
        if wide:
            own, first = np.unique(wide_at, return_index=True)
            self.wide[own] += np.add.reduceat(np.frombuffer(b"".join(wide), "<u8").reshape(-1, WIDE), first, axis=0)
        for lo in range(0, len(signs), SLICE):
            own, first, n = np.unique(signs_at[lo : lo + SLICE], return_index=True, return_counts=True)
            bits = np.unpackbits(np.frombuffer(b"".join(signs[lo : lo + SLICE]), np.uint8).reshape(-1, SIGNS // 8), axis=1)
            ones = np.add.reduceat(bits, first, axis=0, dtype=np.int16)
            self.signs[own] += 2 * ones - n[:, None].astype(np.int16)

    def _like(self, wide: np.ndarray, signs: np.ndarray) -> Sums:
        out = Sums(0)
        out.wide, out.signs = wide, signs
        return out

    def __add__(self, other: Sums) -> Sums:
        """Insertion of the other multisets, row by row."""
        return self._like(self.wide + other.wide, self.signs + other.signs)

    def __sub__(self, other: Sums) -> Sums:
        """Deletion."""
        return self._like(self.wide - other.wide, self.signs - other.signs)

    def __getitem__(self, rows: slice | np.ndarray) -> Sums:
        return self._like(self.wide[rows], self.signs[rows])

    def strings(self) -> list[str]:
        both = np.concatenate([self.wide.astype("<u8").view(np.uint8).reshape(len(self.wide), -1), self.signs.astype("<i2").view(np.uint8).reshape(len(self.signs), -1)], axis=1)
        return [base64.b64encode(row).decode() for row in both]

    @classmethod
    def read(cls, strings: list[str]) -> Sums:
        out = cls(0)
        raw = np.frombuffer(b"".join(map(base64.b64decode, strings)), np.uint8).reshape(len(strings), WIDE * 8 + SIGNS * 2)
        out.wide = np.ascontiguousarray(raw[:, : WIDE * 8]).view("<u8")
        out.signs = np.ascontiguousarray(raw[:, WIDE * 8 :]).view("<i2")
        return out

    def likeness(self, other: Sums) -> np.ndarray:
        a, b = self.signs.astype(np.float64), other.signs.astype(np.float64)
        both = (a * a).sum(axis=1) + (b * b).sum(axis=1)
        shared = 2 * (a * b).sum(axis=1) / np.where(both > 0, both, 1)
        return np.where((self.wide == other.wide).all(axis=1) & (self.signs == other.signs).all(axis=1), 1.0, np.clip(shared, 0.0, 1.0))


def fingerprint(text: str | None) -> str:
    return Sums.of([paragraphs(text)], 1).strings()[0]


def inserted(known: str, *added: str) -> str:
    """The fingerprint with more paragraphs; the document isn't read."""
    return (Sums.read([known]) + Sums.of([list(added)], 1)).strings()[0]


def deleted(known: str, *gone: str) -> str:
    """The fingerprint without some of its paragraphs."""
    return (Sums.read([known]) - Sums.of([list(gone)], 1)).strings()[0]


def likeness(a: str, b: str) -> float:
    return float(Sums.read([a]).likeness(Sums.read([b]))[0])


def fingerprints(docs: DataFrame, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint of each text; a map, no shuffle. A
    column already called ``name`` goes."""
    def run(texts: list[str | None]) -> tuple[list[pa.Array], None]:
        return [pa.array(Sums.of(map(paragraphs, texts), len(texts)).strings(), pa.string())], None

    return add_columns(docs, text, [T.StructField(name, T.StringType())], run)


def neighbours_in_order(docs: DataFrame, block_bytes: int, most_blocks: int, seed: int) -> DataFrame:
    """(block, tail, doc_id, text, copies), one partition for each block, in
    descending order of ids; the ``tail`` row that ends a block is the first
    row of the next one (of the first block, for the last)."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    order = [F.col("doc_id").isNull().cast("int").alias("a"), F.coalesce(F.bitwise_not("doc_id"), F.lit(0)).alias("b"), F.xxhash64("text").alias("c")]
    keyed = rows.select(*order, "doc_id", "text")
    size = keyed.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes"), F.min(F.struct("a", "b", "c")).alias("first")).first()
    n_blocks = max(1, min(most_blocks, -(-(size.bytes or 0) // block_bytes)))
    share = min(1.0, 32.0 * n_blocks / max(1, size.n))
    picked = keyed.select("a", "b", "c").sample(share, seed).collect() if n_blocks > 1 else []  # about 32 keys a block
    keys = sorted(tuple(r) for r in picked)
    starts = sorted({tuple(size.first or (0, 0, 0)), *(keys[i * len(keys) // n_blocks] for i in range(1, n_blocks) if keys)})

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[tuple, int] = {}
            count: list[int] = []
            first: list[int] = []
            for i, key in enumerate(zip(*(batch.column(k).to_pylist() for k in (0, 1, 2, 4)), strict=True)):
                if (at := seen.setdefault(key, len(count))) == len(count):
                    count.append(0)
                    first.append(i)
                count[at] += 1
            kept = batch.take(pa.array(first, pa.int64()))
            block = [bisect_right(starts, key) - 1 for key in zip(*(kept.column(k).to_pylist() for k in (0, 1, 2)), strict=True)]
            extra = [pa.array(count, pa.int64()), pa.array(block, pa.int32()), pa.array([False] * len(block), pa.bool_())]
            yield pa.RecordBatch.from_arrays([*kept.columns, *extra], names=[*kept.schema.names, "copies", "block", "tail"])

    schema = "a int, b long, c long, doc_id long, text string, copies long, block int, tail boolean"
    placed = keyed.mapInArrow(place, schema)
    ends = spark.createDataFrame([(*key, (i - 1) % len(starts)) for i, key in enumerate(starts)], "a int, b long, c long, block int")
    heads = keyed.join(F.broadcast(ends), ["a", "b", "c"]).groupBy("block").agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"))
    tails = heads.select(F.lit(2).alias("a"), F.lit(0).cast("long").alias("b"), F.lit(0).cast("long").alias("c"), "doc_id", "text", F.lit(1).cast("long").alias("copies"), "block", F.lit(True).alias("tail"))
    dealt = placed.unionByName(tails).repartitionById(len(starts), F.col("block"))
    return dealt.sortWithinPartitions("block", "a", "b", "c", "text").select("block", "tail", "doc_id", "text", "copies")


def _pairs(batches: Iterator[pa.RecordBatch], most_chars: int) -> Iterator[list[tuple[int | None, str, str]]]:
    """Lists of (doc_id, text, text of the next row), one for each row; rows
    of equal id and text are merged and then repeated."""
    held: tuple | None = None
    copies = chars = 0
    out: list[tuple[int | None, str, str]] = []
    for batch in batches:
        for _, tail, doc_id, text, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held is not None and not tail and held == (doc_id, text):
                copies += n
                continue
            if held is not None:
                for k in range(copies):
                    out.append((*held, held[1] if k < copies - 1 else text))
                    chars += 2 * len(held[1])
                    if chars > most_chars:
                        yield out
                        out, chars = [], 0
            held, copies = (None, 0) if tail else ((doc_id, text), n)
    if out:
        yield out


def compare_with_next(docs: DataFrame, block_bytes: int = 16 << 20, most_blocks: int = 20_000, most_chars: int = 4_000_000, seed: int = 23) -> DataFrame:
    """Each row's fingerprint, that of the row edited (its last half replaced
    by the first as many code points of the next row), and their likeness.
    The edited fingerprint is the first one less the paragraphs that the cut
    touches plus those that come."""
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _pairs(batches, most_chars):
            kept, gone, come, shas = [], [], [], []
            for _, text, following in rows:
                half = len(text) // 2
                stay, new = text[: len(text) - half], following[:half]
                own, n = text.split("\n"), stay.count("\n")
                kept.append(own[:n])
                gone.append(own[n:])
                come.append((stay[stay.rfind("\n") + 1 :] + new).split("\n"))
                shas.append(hashlib.sha256(_encoded(stay + new)).hexdigest())
            m = len(rows)
            parts = Sums.of([*kept, *gone, *come], 3 * m)
            whole = parts[:m] + parts[m : 2 * m]
            edited = whole - parts[m : 2 * m] + parts[2 * m :]
            # the next row is mostly the following one of this list
            lone = [i for i in range(m) if i == m - 1 or rows[i][2] != rows[i + 1][1]]
            after = np.arange(1, m + 1)
            after[lone] = m + np.arange(len(lone))
            extra = Sums.of([paragraphs(rows[i][2]) for i in lone], len(lone))
            following = whole._like(np.concatenate([whole.wide, extra.wide])[after], np.concatenate([whole.signs, extra.signs])[after])
            made = [[r[0] for r in rows], [len(r[1]) for r in rows], shas, whole.strings(), edited.strings(), whole.likeness(edited), whole.likeness(following)]
            for lo in range(0, m, 4096):
                yield pa.RecordBatch.from_arrays([pa.array(x[lo : lo + 4096], k) for x, k in zip(made, kinds, strict=True)], names=names)

    ordered = neighbours_in_order(docs, block_bytes, most_blocks, seed)
    return ordered.mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
