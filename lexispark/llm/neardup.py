"""N-gram Jaccard self join by MinHash banding with exact verification.

A text's shingles are the hashes of its runs of five words (of all its
words, if it has fewer). Equal texts are one entry, known by the MD5 of the
text. Fixed banding stands in for the LSH forest: each entry has ``trees``
bands of as many MinHash values as ``prefix_length`` works out beforehand
from ``trees``, ``threshold`` and ``recall`` (20, 0.8 and 0.9999 give 4
values, recall 0.99997); entries that agree on a band meet in a bucket.
There are no sorted lists or tries, and nothing adapts to the data: a
self join needs every pair at one threshold, not an entry's nearest few, so
one length serves all entries. A band is called a tree below.

A pair is looked at in the first tree whose prefix it shares, in no other,
so nothing has to be de-duplicated. Buckets of more than ``block`` entries
are dealt out in pairs of parts of that size. Pass 1 finds, from the
signatures alone, the entries with such a pair whose agreement is not below
``threshold`` by five standard errors; pass 2 fetches the shingles of these
entries only and counts each pair's common shingles exactly. It returns per
entry the number of links and one union-find root of its block, so what is
emitted grows with entries, not with pairs. Roots are joined to classes by
min-label steps, each written to the shared folder.

Result per document: class_id (the smallest doc_id of the class), n_links
(different texts at ``threshold`` or above), n_copies (documents with the
same text, itself included).

A null text is a class of its own (n_links 0, n_copies 1); texts without
words, "" among them, only join their exact copies. Repeated rows count as
copies. Without any doc_id a class has a null class_id. An empty table
gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD_BYTES, chunks, stored

SHINGLE = 5
MAX_DEPTH = 8
SEED = 0x5EED
_U = np.uint64
_LOWER = np.frombuffer(bytes(range(256)).lower().translate(WORD_BYTES), dtype=np.uint8)
_RANDOM = np.random.default_rng(SEED)
_BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) | _U(1)
_BASE = 0x9E3779B97F4A7C15
_STEP = [_U(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _STEP[0]
    x = (x ^ (x >> _U(27))) * _STEP[1]
    return x ^ (x >> _U(31))


def _powers(n: int) -> np.ndarray:
    """The first ``n`` powers of an odd base modulo 2 ** 64."""
    return np.cumprod(np.concatenate(([_U(1)], np.full(n, _U(_BASE)))), dtype=np.uint64)[:n]


def shingles(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The shingle hashes of all texts, one after the other, and the number
    of each text's."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    data = _LOWER[np.frombuffer(b" ".join(raw) + b" ", dtype=np.uint8)]
    ends = np.cumsum(np.fromiter((len(r) + 1 for r in raw), dtype=np.int64, count=len(raw)))
    inside = data != 32
    edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
    lo, hi = edge[::2], edge[1::2]
    size = hi - lo
    begin = np.cumsum(size) - size
    place = np.arange(int(size.sum())) - np.repeat(begin, size)
    letters = _BYTE[data[inside]] * _powers(int(size.max(initial=0)))[place]
    word = _mix((np.add.reduceat(letters, begin) if len(lo) else letters) + size.astype(np.uint64))
    n_words = np.diff(np.concatenate(([0], np.searchsorted(lo, ends))))
    first = np.concatenate(([0], np.cumsum(n_words)))
    run = np.zeros(len(word), dtype=np.uint64)
    left = np.repeat(first[1:], n_words) - np.arange(len(word))  # words from here to the text's end
    for k in range(SHINGLE):
        there = left > k
        run[there] += _mix(word[np.flatnonzero(there) + k] ^ _STEP[k])
    begins = np.repeat(np.minimum(n_words, SHINGLE), n_words) <= left
    return _mix(run[begins]), np.where(n_words >= SHINGLE, n_words - SHINGLE + 1, np.minimum(n_words, 1))


def prefix_length(trees: int, threshold: float, recall: float) -> int:
    """The most values, MAX_DEPTH at most, that a band can have while pairs
    at the threshold still meet with the given chance."""
    depth = MAX_DEPTH
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < recall:
        depth -= 1
    return depth


def signatures(hashes: np.ndarray, sizes: np.ndarray, values: int) -> np.ndarray:
    """(texts with shingles, values): 16 bits of each MinHash value."""
    rng = np.random.default_rng(SEED + 1)
    mult = rng.integers(1, 1 << 63, values, dtype=np.uint64) | _U(1)
    add = rng.integers(0, 1 << 63, values, dtype=np.uint64)
    own = sizes[sizes > 0]
    starts = np.concatenate(([0], np.cumsum(own)[:-1])).astype(np.int64)
    out = np.empty((len(own), values), dtype=np.uint16)
    for v in range(values):
        low = np.minimum.reduceat((hashes * mult[v] + add[v]) >> _U(16), starts) if len(own) else np.zeros(0, np.uint64)
        out[:, v] = _mix(low).astype(np.uint16)
    return out


def text_key(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def sign(docs: DataFrame, trees: int, depth: int) -> DataFrame:
    """(tid, sig, labels): one row for each different text with words; a
    label names a tree's bucket."""
    values = trees * depth

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.random.default_rng(SEED + 2).integers(1, 1 << 63, values, dtype=np.uint64) | _U(1)
        for batch in batches:
            for part in chunks(batch, 1, 1_000_000):
                hashes, sizes = shingles(part.column(1).to_pylist())
                sig = signatures(hashes, sizes, values)
                label = _mix((sig.astype(np.uint64) * weights).reshape(-1, trees, depth).sum(axis=2) + np.arange(trees, dtype=np.uint64) * _STEP[3])
                cut = pa.array(np.arange(len(sig) + 1) * trees, pa.int32())
                keep = pa.array(sizes > 0)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).filter(keep), pa.array([row.tobytes() for row in sig], pa.binary()), pa.ListArray.from_arrays(cut, pa.array(label.reshape(-1).view(np.int64)))],
                    names=["tid", "sig", "labels"],
                )

    signed = docs.where(F.col("text").isNotNull()).select(text_key(F.col("text")).alias("tid"), "text").mapInArrow(run, "tid binary, sig binary, labels array<long>")
    return signed.groupBy("tid").agg(F.first("sig").alias("sig"), F.first("labels").alias("labels"))


def members(signed: DataFrame, block: int) -> DataFrame:
    """(label, tree, i, j, side, tid): the entries of buckets with more than
    one, in pairs (i, j) of parts of about ``block`` entries; in a pair of
    different parts, ``side`` tells which."""
    each = signed.select("tid", F.posexplode("labels").alias("tree", "label"))
    full = each.groupBy("label").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = each.join(full, "label").withColumn("p", F.ceil(F.col("n") / block).cast("int"))
    met = met.withColumn("own", F.pmod(F.xxhash64(F.lit(3), "tid"), "p").cast("int"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("p") - 1)))
    return met.select("label", "tree", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).alias("side"), "tid")


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """The rows of sorted batches, cut where one of the first ``keys``
    columns changes; several whole groups at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows, dtype=bool)
        for c in range(keys):
            v = batch.column(c).to_numpy(zero_copy_only=False)
            change[1:] |= v[1:] != v[:-1]
            if held:
                change[0] |= v[0] != held[-1].column(c)[-1].as_py()
        at = np.flatnonzero(change)
        if not len(at):
            held.append(batch)
            continue
        if held or at[-1] > 0:
            yield pa.Table.from_batches([*held, batch.slice(0, at[-1])])
        held = [batch.slice(at[-1])]
    if held:
        yield pa.Table.from_batches(held)


def _bounds(t: pa.Table, keys: int) -> np.ndarray:
    change = np.zeros(t.num_rows, dtype=bool)
    change[:1] = True
    for c in range(keys):
        v = t.column(c).to_numpy()
        change[1:] |= v[1:] != v[:-1]
    return np.append(np.flatnonzero(change), t.num_rows)


def _own_pairs(sig: np.ndarray, side: np.ndarray, split: bool, tree: int, trees: int, floor: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a block that share this tree's prefix and no earlier one's,
    with an agreement of ``floor`` or more."""
    a, b = (np.flatnonzero(~side), np.flatnonzero(side)) if split else (np.arange(len(sig)),) * 2
    left, right = [], []
    for lo in range(0, len(a), 64):
        same = sig[a[lo : lo + 64], None, :] == sig[None, b, :]
        near = same.mean(axis=2) >= floor
        whole = same.reshape(*near.shape, trees, -1).all(axis=3)
        near &= whole[..., tree] & ~whole[..., :tree].any(axis=2)
        x, y = np.nonzero(near)
        left.append(a[x + lo])
        right.append(b[y])
    x, y = np.concatenate(left or [a[:0]]), np.concatenate(right or [a[:0]])
    return (x, y) if split else (x[x < y], y[x < y])


def _floor(threshold: float, values: int) -> float:
    return threshold - 5 * (threshold * (1 - threshold) / values) ** 0.5


def _signature_matrix(column: pa.ChunkedArray, values: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint16).reshape(-1, values)


def participants(blocks: DataFrame, trees: int, depth: int, threshold: float) -> DataFrame:
    """Pass 1: the rows of ``blocks`` (with sig) that have a pair there."""
    values = trees * depth

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches, 3):
            bounds, used = _bounds(t, 3), np.zeros(t.num_rows, dtype=bool)
            sig, side = _signature_matrix(t["sig"], values), t["side"].to_numpy()
            tree, split = t["tree"].to_numpy(), t["i"].to_numpy() != t["j"].to_numpy()
            for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
                if hi - lo > 1:
                    x, y = _own_pairs(sig[lo:hi], side[lo:hi], split[lo], tree[lo], trees, _floor(threshold, values))
                    used[lo + x] = used[lo + y] = True
            if used.any():
                yield from t.filter(pa.array(used)).to_batches()

    keys = ["label", "i", "j"]
    rows = blocks.select(*keys, "tree", "side", "tid", "sig").repartition(*keys).sortWithinPartitions(*keys)
    return rows.mapInArrow(run, rows.schema)


def shingle_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(tid, sh): the sorted distinct shingles of the wanted texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, 1, 1_000_000):
                hashes, sizes = shingles(part.column(1).to_pylist())
                sets = [np.unique(h).tobytes() for h in np.split(hashes, np.cumsum(sizes)[:-1])]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.binary())], names=["tid", "sh"])

    texts = docs.where(F.col("text").isNotNull()).groupBy(text_key(F.col("text")).alias("tid")).agg(F.first("text").alias("text"))
    return texts.join(wanted, "tid", "left_semi").mapInArrow(run, "tid binary, sh binary")


def common_counts(sets: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """|sets[x] & sets[y]| for each pair. Many pairs among few sets: products
    of 0/1 matrices over the shingles that occur twice, in column blocks."""
    if len(x) < 4 * len(sets):
        return np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(x, y, strict=True)], dtype=np.int64)
    sizes = np.array([len(s) for s in sets])
    _, column, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), sizes)
    shared = seen[column] > 1
    row, column = row[shared], (np.cumsum(seen > 1) - 1)[column[shared]]
    total, width = np.zeros((len(sets), len(sets)), dtype=np.float32), 4096
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [lo, lo + width])
        m = np.zeros((len(sets), width), dtype=np.float32)
        m[row[a:b], column[a:b] - lo] = 1
        total += m @ m.T
    return total[x, y].astype(np.int64)


def _roots(n: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The smallest member of each one's component."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def verified(rows: DataFrame, trees: int, depth: int, threshold: float) -> DataFrame:
    """Pass 2: (tid, n, root) for each entry of a block that has a link
    there: how many, and the entry that stands for its component."""
    values = trees * depth
    names, kinds = ["tid", "n", "root"], [pa.binary(), pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches, 3):
            bounds = _bounds(t, 3)
            sig, side, tids, raw = _signature_matrix(t["sig"], values), t["side"].to_numpy(), t["tid"].to_pylist(), t["sh"]
            tree, split = t["tree"].to_numpy(), t["i"].to_numpy() != t["j"].to_numpy()
            out: tuple[list, list, list] = ([], [], [])
            for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
                x, y = _own_pairs(sig[lo:hi], side[lo:hi], split[lo], tree[lo], trees, _floor(threshold, values))
                if not len(x):
                    continue
                sets = [np.frombuffer(s.as_py(), dtype=np.uint64) for s in raw.slice(lo, hi - lo)]
                size = np.array([len(s) for s in sets])
                both = common_counts(sets, x, y)
                # J >= threshold in whole numbers, threshold = num / 1000
                link = both * 1000 >= round(threshold * 1000) * (size[x] + size[y] - both)
                x, y = x[link], y[link]
                n = np.bincount(np.concatenate((x, y)), minlength=hi - lo)
                root = _roots(hi - lo, x, y)
                for at in np.flatnonzero(n).tolist():
                    out[0].append(tids[lo + at])
                    out[1].append(int(n[at]))
                    out[2].append(tids[lo + int(root[at])])
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds, strict=True)], names=names)

    keys = ["label", "i", "j"]
    ordered = rows.select(*keys, "tree", "side", "tid", "sig", "sh").repartition(*keys).sortWithinPartitions(*keys)
    return ordered.mapInArrow(run, "tid binary, n long, root binary")


def components(edges: DataFrame) -> DataFrame:
    """(tid, comp) for the entries of ``edges`` (tid, root): the smallest
    entry that is reached, by rounds of smallest neighbour and two jumps."""
    both = edges.where("tid != root").select("tid", "root")
    both = stored(both.unionByName(both.select(F.col("root").alias("tid"), F.col("tid").alias("root"))).distinct(), "edges")
    comp = stored(both.groupBy("tid").agg(F.min("root").alias("low")).select("tid", F.least("tid", "low").alias("comp")), "comp")
    while True:
        near = both.join(comp.withColumnRenamed("tid", "root"), "root").groupBy("tid").agg(F.min("comp").alias("low"))
        step = comp.join(near, "tid").select("tid", F.least("comp", "low").alias("comp"), F.col("comp").alias("was"))
        jump = step.select(F.col("tid").alias("comp"), F.col("comp").alias("next"))
        new = stored(step.join(jump, "comp").select("tid", F.least("comp", "next").alias("comp"), "was"), "comp")
        moved = new.where("comp != was").limit(1).count()
        comp = new.select("tid", "comp")
        if not moved:
            return comp


def text_classes(docs: DataFrame, threshold: float = 0.8, trees: int = 20, recall: float = 0.9999, block: int = 512) -> DataFrame:
    """(tid, comp, n_links) of the texts that have a link."""
    depth = prefix_length(trees, threshold, recall)
    signed = stored(sign(docs, trees, depth), "signatures")
    sigs = signed.select("tid", "sig")
    blocks = stored(participants(members(signed, block).join(sigs, "tid"), trees, depth, threshold), "blocks")
    sets = stored(shingle_sets(docs, blocks.select("tid").distinct()), "shingles")
    links = stored(verified(blocks.join(sets, "tid"), trees, depth, threshold), "links")
    counts = links.groupBy("tid").agg(F.sum("n").alias("n_links"))
    return counts.join(components(links), "tid", "left").select("tid", F.coalesce("comp", "tid").alias("comp"), "n_links")


def _classes(docs: DataFrame, threshold: float = 0.8, **how) -> DataFrame:
    """(doc_id, tid, comp, class_id, n_links, n_copies) of the rows of
    ``docs`` with a text; ``comp`` names the class."""
    found = text_classes(docs, threshold, **how)
    rows = docs.where(F.col("text").isNotNull()).select("doc_id", text_key(F.col("text")).alias("tid"))
    per_text = rows.groupBy("tid").agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("n_copies")).join(found, "tid", "left")
    per_text = stored(per_text.withColumn("comp", F.coalesce("comp", "tid")).withColumn("n_links", F.coalesce("n_links", F.lit(0)).cast("long")), "texts")
    lowest = per_text.groupBy("comp").agg(F.min("low").alias("class_id"))
    return rows.join(per_text.join(lowest, "comp").select("tid", "comp", "class_id", "n_links", "n_copies"), "tid")


def document_classes(docs: DataFrame, threshold: float = 0.8, **how) -> DataFrame:
    """(doc_id, class_id, n_links, n_copies) for each row of ``docs``."""
    lone = docs.where(F.col("text").isNull()).select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.lit(1).cast("long").alias("n_copies"))
    return _classes(docs, threshold, **how).select("doc_id", "class_id", "n_links", "n_copies").unionByName(lone)


def keep_one(docs: DataFrame, threshold: float = 0.8, **how) -> DataFrame:
    """One row of ``docs`` for each class, with all its columns: the one with
    the smallest doc_id (rows without come last; then the smallest text
    hash). Rows with null text all stay."""
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tid")
    first = _classes(docs, threshold, **how).groupBy("comp").agg(F.min(rank).alias("r")).select(F.col("r.doc_id").alias("_lx_id"), F.col("r.tid").alias("_lx_keep"))
    held = docs.where(F.col("text").isNotNull()).withColumn("_lx_tid", text_key(F.col("text")))
    held = held.join(first, (F.col("_lx_tid") == F.col("_lx_keep")) & F.col("doc_id").eqNullSafe(F.col("_lx_id")))
    return held.dropDuplicates(["_lx_tid"]).select(*[F.col(f"`{c}`") for c in docs.columns]).unionByName(docs.where(F.col("text").isNull()))
