"""Benchmark decontamination with a positional inverted index.

A window is ``window`` consecutive words of an item (all its words, if it
has fewer). Items are taken in blocks of bounded size; for each block:

1. one pass counts how often each word of the items occurs in the
   documents, added up in each partition first;
2. windows with a word that never occurs are gone; each other window gets
   its rarest two words as anchors;
3. one pass stores the postings (word, position) of the anchor words, by
   document;
4. postings meet the anchors by word; position less offset is where the
   item would start, and the lists of a window's anchors are intersected on
   (document, item, start): what is left are the starts where all anchors of
   some window stand at their offsets;
5. the words of the documents at these starts are compared with the item's,
   which makes the match exact and gives the hit spans.

``near_matches`` answers proximity: all words of a phrase within a span.

Words: see ``common.words``. Null or empty texts have no words and no hits;
items without words match nothing; items with one id count once. A document
is known by its id and its text's hash, so repeated rows get equal results.
Empty tables give no rows, an empty benchmark no hits. Other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chunks, stored, text_bytes, words

BLOCK_BYTES = 4 << 20
KEY = ["doc_id", "h"]


def item_blocks(items: DataFrame, block_bytes: int) -> Iterator[list[tuple[str, list[bytes]]]]:
    """(item id, words) in blocks of about ``block_bytes`` of text."""
    own = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    total = own.agg(F.sum(text_bytes(F.col("text")) + 16)).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    for b in range(n):
        rows = own.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b).distinct().collect()
        yield sorted((r.item_id, w) for r in rows if (w := words(r.text)))


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64("text").alias("h"), "text")


def word_counts(docs: DataFrame, vocabulary: list[bytes]) -> np.ndarray:
    """How often each word of the vocabulary occurs in the documents."""
    send = docs.sparkSession.sparkContext.broadcast({w: i for i, w in enumerate(vocabulary)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get, total = send.value.get, np.zeros(len(vocabulary) + 1, dtype=np.int64)
        for batch in batches:
            for part in chunks(batch, 0, 2_000_000):
                ids = [get(w, -1) for t in part.column(0).to_pylist() for w in words(t)]
                total += np.bincount(np.array(ids, dtype=np.int64) + 1, minlength=len(total))
        at = np.flatnonzero(total[1:])
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[1:][at], pa.int64())], names=["word", "n"])

    out = np.zeros(len(vocabulary), dtype=np.int64)
    for r in docs.select("text").mapInArrow(run, "word int, n long").groupBy("word").agg(F.sum("n").alias("n")).collect():
        out[r.word] = r.n  # at most one row for each word of the block
    return out


def anchors(item: list[int], counts: np.ndarray, window: int) -> list[list[int]]:
    """For each window of the item that can occur: the offsets of its rarest
    two words."""
    n, found = min(window, len(item)), set()
    for at in range(len(item) - n + 1):
        offsets = range(at, at + n)
        if all(counts[item[o]] for o in offsets):
            found.add(tuple(sorted(sorted(offsets, key=lambda o: (counts[item[o]], o))[:2])))
    return [list(x) for x in sorted(found)]


def postings(docs: DataFrame, terms: dict[bytes, int]) -> DataFrame:
    """(doc_id, h, n_words, word array, pos array): for every document where
    the given words stand."""
    send = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = send.value.get
        for batch in batches:
            for part in chunks(batch, 2, 2_000_000):
                sizes, ids = [], []
                for t in part.column(2).to_pylist():
                    own = words(t)
                    sizes.append(len(own))
                    ids.extend([get(w, -1) for w in own])
                ids, n = np.array(ids, dtype=np.int32), np.array(sizes, dtype=np.int64)
                start = np.concatenate(([0], np.cumsum(n)))
                at = np.flatnonzero(ids >= 0)
                cut = pa.array(np.searchsorted(at, start), pa.int32())
                pos = at - np.repeat(start[:-1], n)[at] if len(at) else at
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(n), pa.ListArray.from_arrays(cut, pa.array(ids[at])), pa.ListArray.from_arrays(cut, pa.array(pos, pa.int32()))],
                    names=["doc_id", "h", "n_words", "word", "pos"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return _keyed(docs).mapInArrow(run, f"doc_id {kind}, h long, n_words long, word array<int>, pos array<int>")


def _same(a: str, b: str) -> Column:
    return F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (F.col(f"{a}.h") == F.col(f"{b}.h"))


def starts(index: DataFrame, plan: list[tuple[list[int], list[list[int]]]]) -> DataFrame:
    """(doc_id, h, cands array of (item, start)): where all anchors of some
    window of an item stand at their offsets. ``plan``: each item's words
    and its windows' anchor offsets."""
    spark = index.sparkSession
    wanted = [(item[o], i, o) for i, (item, pairs) in enumerate(plan) for o in sorted({o for p in pairs for o in p})]
    pairs = [(i, p) for i, (_, p) in enumerate(plan) if p]
    lists = spark.createDataFrame(wanted, "word int, item int, off int")
    needed = spark.createDataFrame(pairs, "item int, pairs array<array<int>>")
    met = index.select(*KEY, F.explode(F.arrays_zip("word", "pos")).alias("p")).select(*KEY, F.col("p.word").alias("word"), F.col("p.pos").alias("pos"))
    met = met.join(lists, "word").groupBy(*KEY, "item", (F.col("pos") - F.col("off")).alias("start")).agg(F.collect_set("off").alias("offs"))
    whole = met.join(needed, "item").where(F.exists("pairs", lambda p: F.size(F.array_except(p, "offs")) == 0))
    return whole.groupBy(*KEY).agg(F.array_sort(F.collect_list(F.struct("item", "start"))).alias("cands"))


def runs(doc: list[bytes], item: list[bytes], start: int, window: int) -> list[tuple[int, int]]:
    """Spans [from, to) of ``doc`` that equal ``item`` laid at ``start``, of
    ``window`` words or more (of all, if the item has fewer)."""
    need, out, begun = min(window, len(item)), [], None
    lo, hi = max(0, start), min(len(doc), start + len(item))
    for at in range(lo, hi + 1):
        if at < hi and doc[at] == item[at - start]:
            begun = at if begun is None else begun
        elif begun is not None:
            if at - begun >= need:
                out.append((begun, at))
            begun = None
    return out


def verify(docs: DataFrame, found: DataFrame, block: list[tuple[str, list[bytes]]], window: int) -> DataFrame:
    """(doc_id, h, spans, items): the exact matches among the starts."""
    send = docs.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, items = [], []
            for text, cands in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                own, hit, ids = words(text), set(), set()
                for c in cands:
                    name, item = send.value[c["item"]]
                    if got := runs(own, item, c["start"], window):
                        hit.update(got)
                        ids.add(name)
                spans.append([{"lo": a, "hi": b} for a, b in sorted(hit)])
                items.append(sorted(ids))
            kind = pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(spans, kind), pa.array(items, pa.list_(pa.string()))], names=[*KEY, "spans", "items"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    both = _keyed(docs).alias("d").join(found.alias("f"), _same("d", "f")).select("d.doc_id", "d.h", "text", "cands")
    return both.mapInArrow(run, f"doc_id {kind}, h long, spans array<struct<lo:int,hi:int>>, items array<string>").where(F.size("items") > 0)


def covered(spans: Column) -> Column:
    """How many places the spans cover together."""
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("to"))
    step = lambda a, s: F.struct((a["n"] + F.greatest(F.lit(0), s["hi"] - F.greatest(s["lo"], a["to"]))).alias("n"), F.greatest(a["to"], s["hi"]).alias("to"))
    return F.aggregate(F.array_sort(spans), zero, step)["n"].cast("long")


def matches(docs: DataFrame, items: DataFrame, window: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, h, n_words, n_hit, items, spans) for each row of ``docs``."""
    hits, sizes = None, None
    for block in item_blocks(items, block_bytes):
        vocabulary = sorted({w for _, item in block for w in item})
        number = {w: i for i, w in enumerate(vocabulary)}
        counts = word_counts(docs, vocabulary) if vocabulary else np.zeros(0, np.int64)
        coded = [[number[w] for w in item] for _, item in block]
        plan = [(item, anchors(item, counts, window)) for item in coded]
        used = {item[o] for item, pairs in plan for p in pairs for o in p}
        index = stored(postings(docs, {vocabulary[i]: i for i in used}), "postings")
        if sizes is None:
            sizes = index.select(*KEY, "n_words")
        if used:
            got = verify(docs, starts(index, plan), block, window)
            hits = got if hits is None else hits.unionByName(got)
    if hits is None:
        empty = "array<struct<lo:int,hi:int>>"
        return sizes.select(*KEY, "n_words", F.lit(0).cast("long").alias("n_hit"), F.lit(None).cast("array<string>").alias("items"), F.lit(None).cast(empty).alias("spans"))
    # sets: repeated rows have equal spans and add nothing
    by_doc = hits.groupBy(*KEY).agg(F.array_distinct(F.flatten(F.collect_set("spans"))).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    out = sizes.alias("d").join(by_doc.alias("f"), _same("d", "f"), "left")
    return out.select("d.doc_id", "d.h", "n_words", F.coalesce(covered(F.col("spans")), F.lit(0).cast("long")).alias("n_hit"), "items", "spans")


def report(docs: DataFrame, items: DataFrame, window: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans)."""
    ids = F.coalesce(F.col("items"), F.array().cast("array<string>"))
    return matches(docs, items, window, block_bytes).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", ids), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        "spans",
    )


def keep_clean(docs: DataFrame, items: DataFrame, window: int = 10) -> DataFrame:
    """The rows of ``docs``, all columns, without any hit."""
    bad = matches(docs, items, window).where("n_hit > 0").select(*KEY).distinct().alias("b")
    held = docs.withColumn("_lx_h", F.xxhash64("text")).alias("a")
    hit = F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a._lx_h") == F.col("b.h"))
    return held.join(bad, hit, "left_anti").select(*[f"`{c}`" for c in docs.columns])


def near_matches(docs: DataFrame, phrase: str, span: int) -> DataFrame:
    """(doc_id, h, lo): where ``span`` consecutive words, the first of them
    of the phrase, hold all its words in any order. A phrase without words
    is nowhere."""
    wanted = {w: i for i, w in enumerate(dict.fromkeys(words(phrase)))}
    if not wanted:
        return docs.limit(0).select("doc_id", F.xxhash64("text").alias("h"), F.lit(0).alias("lo"))
    index = postings(docs, wanted)
    here = lambda i: F.filter("all", lambda x: (x["word"] == i) & (x["pos"] >= F.col("p.pos")))
    last = [F.array_min(F.transform(here(i), lambda x: x["pos"])) for i in range(len(wanted))]
    at = index.select(*KEY, F.arrays_zip("word", "pos").alias("all")).select("*", F.explode("all").alias("p"))
    inside = [F.coalesce(x < F.col("p.pos") + span, F.lit(False)) for x in last]
    return at.where(F.array_min(F.array(*inside))).select(*KEY, F.col("p.pos").alias("lo"))
