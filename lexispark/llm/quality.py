"""Quality classifier: an interpolated modified Kneser-Ney model of character
n-grams (order 4), trained on trusted text.

Every character of the trusted text is a class of its own, as many as there
are; characters that trusted text never has share one class (no n-gram
tells them apart), and one more marks the start of a text. An n-gram is a
string of its characters, so the tables grow with the corpus.

Counting and scoring are joins of count tables, sharded by n-gram:

1. every partition adds up the 4-grams of its trusted texts; sums by 4-gram
   give the counts, and grouping their suffixes gives the continuation
   counts of the lower orders;
2. every order's discounts come from its counts of counts, every history's
   total and reserved mass from a sum over its n-grams;
3. the 4-grams of all documents, reduced to their types, are joined with the
   counts and histories of each order, which gives each type's interpolated
   log probability; this table is stored and counted;
4. a document's perplexity is the exponential of its mean negative log
   probability. A table of at most ``MOST_SENT`` types is sent to the tasks.
   A larger one is never gathered: documents are dealt by hash into slices
   of about ``SLICE`` bytes, the types of each slice are joined with the
   table, and each slice meets its own types' probabilities in one task.
   Both ways give the same values.

A document is kept if its perplexity does not exceed its language's
threshold: ``quantile`` of trusted documents' perplexities in that language
(``lang``), read from an exact count of values rounded to 0.001 bits. The
model hasn't seen these documents: of the trusted texts one in ``folds``, by
a hash of the text (so copies stay together), is left out of the counts and
sets the thresholds; perplexities of texts that were counted are lower, and
a threshold read from them would cost clean documents. Languages without
such text take the threshold of all; if there is none at all, the counted
texts set it.

Null or empty texts have no perplexity and are not kept. Copies get equal
results. Rows that ``labels`` names twice train once. Without any trusted
text every document with text is kept (perplexity ``CLASSES``, as of a uniform
guess, threshold infinite). An empty table gives no rows; input columns named like a result
column go, others stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_columns, chunks, stored, text_bytes, without

ORDER = 4
#: Code points: the lowest order's uniform guess.
CLASSES = 0x110000
#: All characters that trusted text never has; the last code point names no character.
OTHER = CLASSES - 1
N_CODES = CLASSES**ORDER
PAD = "\0" * (ORDER - 1)
#: Types of a table that is sent to every task (16 bytes a key and 4 a value).
MOST_SENT = 2_000_000
#: Bytes of text in a slice, where the table is not sent.
SLICE = 16_000_000
#: Share of clean documents, of those the model hasn't seen, below the threshold.
QUANTILE = 0.98
#: Rows of count tables that a task holds before it passes them on.
HELD = 500_000


def _points(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Code points with the start marks before each text, and each start."""
    own = [t.replace("\0", "�") if t else "" for t in texts]
    points = np.frombuffer((PAD + PAD.join(own)).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    sizes = np.fromiter((len(t) + ORDER - 1 for t in own), dtype=np.int64, count=len(own))
    return points, np.concatenate(([0], np.cumsum(sizes)[:-1]))


def class_table(alphabet: list[int]) -> np.ndarray:
    table = np.full(CLASSES, OTHER, dtype=np.uint32)
    table[0] = 0
    table[alphabet] = alphabet
    return table


def _codes(points: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for the 4-gram that ends at each place, exact within
    ``points``, and whether it ends in a character (not a start mark)."""
    c = table[points]
    seen = np.zeros(CLASSES, dtype=bool)
    seen[c] = True
    n = int(seen.sum())
    if n <= 1 << 16:
        own = (np.cumsum(seen) - 1).astype(np.uint16 if n > 256 else np.uint8)[c]
        kind, bits = (np.uint32, 8) if n <= 256 else (np.uint64, 16)
        code = own.astype(kind)
        for back in range(1, ORDER):
            code[back:] |= own[:-back].astype(kind) << kind(bits * back)
        return code, c > 0
    pair = c.astype(np.uint64)
    pair[1:] |= c[:-1].astype(np.uint64) << np.uint64(32)
    own = np.unique(pair, return_inverse=True)[1].astype(np.uint64)
    code = own.copy()
    code[2:] |= own[:-2] << np.uint64(32)
    return code, c > 0


def _types(points: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct 4-grams of ``points`` as strings, the counts of each, the
    number of its own at each place, and whether that ends in a character."""
    code, real = _codes(points, table)
    kinds, n = np.unique(code[real], return_counts=True)
    if not len(kinds):
        return np.zeros(0, "<U4"), n, np.zeros(len(points), dtype=np.int64), real
    at = np.minimum(np.searchsorted(kinds, code), len(kinds) - 1)
    last = np.zeros(len(kinds), dtype=np.int64)
    ends = np.flatnonzero(real)
    last[at[ends]] = ends
    grams = table[points[last[:, None] + np.arange(1 - ORDER, 1)]].astype("<u4")
    return np.ascontiguousarray(grams).view(f"<U{ORDER}")[:, 0], n, at, real


def alphabet_of(texts: DataFrame) -> list[int]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0x110000, dtype=np.int64)
        for batch in batches:
            for part in chunks(batch, 0, 2_000_000):
                seen = np.bincount(_points(part.column(0).to_pylist())[0])
                total[: len(seen)] += seen
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], names=["point", "n"])

    counts = texts.select("text").mapInArrow(run, "point int, n long").where("point > 0").groupBy("point").agg(F.sum("n").alias("n"))
    return [r.point for r in counts.orderBy(F.desc("n"), "point").collect()]  # at most all of Unicode


def _folded(held: list[pa.Table], keys: list[str]) -> pa.Table:
    return pa.concat_tables(held).group_by(keys).aggregate([("n", "sum")]).rename_columns([*keys, "n"])


def ngram_counts(texts: DataFrame, alphabet: list[int], by: str | None = None) -> DataFrame:
    """(gram, n) of the 4-grams, added up in each partition first; with
    ``by`` (by, gram, n), for each value of that integer column."""
    keys = ["gram"] if by is None else [by, "gram"]
    send = texts.sparkSession.sparkContext.broadcast(alphabet)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, held = class_table(send.value), []
        for batch in batches:
            own = [(None, batch)] if by is None else [(v, batch.filter(pc.equal(batch.column(1), v))) for v in pc.unique(batch.column(1))]
            for value, rows in own:
                for part in chunks(rows, 0, 2_000_000):
                    grams, n, _, _ = _types(_points(part.column(0).to_pylist())[0], table)
                    columns = {"gram": pa.array(grams.tolist(), pa.string()), "n": pa.array(n, pa.int64())}
                    held.append(pa.table(columns if by is None else {by: pa.array([value.as_py()] * len(n), pa.int64()), **columns}))
            if sum(map(len, held)) > HELD:
                held = [_folded(held, keys)]
                if len(held[0]) > HELD // 2:
                    yield from held.pop().to_batches(max_chunksize=100_000)
        if held:
            yield from _folded(held, keys).to_batches(max_chunksize=100_000)

    schema = ("" if by is None else f"{by} long, ") + "gram string, n long"
    return texts.select("text", *([] if by is None else [F.col(by).cast("long").alias(by)])).mapInArrow(run, schema).groupBy(*keys).agg(F.sum("n").alias("n"))


def _suffix(gram: Column, order: int) -> Column:
    return F.substring(gram, -order, order)


def _history(gram: Column, order: int) -> Column:
    return F.substring(gram, 1, order - 1)


def order_tables(counts: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """For the orders 1 to ORDER: (n-gram, discounted count) and (history,
    total, reserved), modified Kneser-Ney."""
    levels = [counts]
    for order in range(ORDER - 1, 0, -1):  # distinct left neighbours
        levels.insert(0, levels[0].groupBy(_suffix(F.col("gram"), order).alias("gram")).agg(F.count(F.lit(1)).alias("n")))
    out = []
    for order, level in enumerate(levels, start=1):
        level = stored(level, f"kn{order}")
        d = discounts({r.n: r["count"] for r in level.where("n <= 4").groupBy("n").count().collect()})
        by = F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])
        grams = level.select("gram", (F.col("n") - by).alias("held"))
        hist = level.groupBy(_history(F.col("gram"), order).alias("gram")).agg(F.sum("n").alias("total"), F.sum(by).alias("reserved"))
        out.append((grams, hist))
    return out


def discounts(n: dict[int, int]) -> tuple[float, float, float]:
    """D1, D2, D3+ from the counts of counts; 0.5, 1, 1.5 where a count of
    counts that they need is missing."""
    n1, n2, n3, n4 = (n.get(i, 0) for i in range(1, 5))
    if not (n1 and n2 and n3 and n4):
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    d = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(min(max(x, 0.05), i + 0.95) for i, x in enumerate(d))


def log_probabilities(types: DataFrame, tables: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """(gram, logp) for each 4-gram of ``types``: joins with each order's
    counts and histories, lowest order first."""
    out, p = types.select("gram"), F.lit(1.0 / CLASSES)
    for order, (grams, hist) in enumerate(tables, start=1):
        own = _suffix(F.col("gram"), order)
        out = out.select("*", own.alias("_g"), _history(own, order).alias("_h"))
        hist = F.broadcast(hist) if order == 1 else hist  # one row
        out = out.join(grams.withColumnRenamed("gram", "_g"), "_g", "left").join(hist.withColumnRenamed("gram", "_h"), "_h", "left")
        p = F.when(F.col("total").isNull(), p).otherwise((F.coalesce(F.col("held"), F.lit(0.0)) + F.col("reserved") * p) / F.col("total"))
        out = out.select("gram", p.alias("_p"))
        p = F.col("_p")
    return out.select("gram", F.log(p).alias("logp"))


def trusted_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of ``docs`` labelled good and not toxic. The labels grow with the
    documents, so the join is a merge join at every size."""
    good = labels.where("quality = 1 and coalesce(toxic, 0) = 0").select("doc_id").distinct().hint("merge")
    return docs.where(F.col("text").isNotNull()).join(good, "doc_id", "left_semi")


class Model:
    """The alphabet, the stored table (gram, logp) of the 4-gram types of the
    documents to be scored, and the table's rows if they are few enough to
    be sent: sorted grams and their log probabilities."""

    def __init__(self, alphabet: list[int], table: DataFrame | None, sent: tuple[np.ndarray, np.ndarray] | None):
        self.alphabet, self.table, self.sent = alphabet, table, sent


def _lookup(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    grams = np.array(rows["gram"].to_pylist(), dtype=f"<U{ORDER}")
    order = np.argsort(grams)
    return grams[order], rows["logp"].to_numpy().astype(np.float32)[order]


def train(docs: DataFrame, trusted: DataFrame, most_sent: int = MOST_SENT) -> Model:
    """Fit on ``trusted`` (text), for scoring ``docs`` (text)."""
    alphabet = alphabet_of(trusted)
    if not alphabet:
        return Model([], None, (np.zeros(0, f"<U{ORDER}"), np.zeros(0, np.float32)))
    tables = order_tables(ngram_counts(trusted, alphabet))
    found = stored(log_probabilities(ngram_counts(docs, alphabet), tables), "logp")
    return Model(alphabet, found, _lookup(found.toArrow()) if found.count() <= most_sent else None)


def perplexities(texts: list[str | None], table: np.ndarray, grams: np.ndarray, logp: np.ndarray) -> np.ndarray:
    """Perplexity of each text; NaN where there is none."""
    points, starts = _points(texts)
    kinds, _, at, real = _types(points, table)
    own = np.full(max(1, len(kinds)), -np.log(CLASSES), dtype=np.float32)
    if len(grams) and len(kinds):
        found = np.minimum(np.searchsorted(grams, kinds), len(grams) - 1)
        own = np.where(grams[found] == kinds, logp[found], own)
    n = np.add.reduceat(real, starts, dtype=np.int64)
    lost = np.add.reduceat(np.where(real, own[at], np.float32(0)), starts, dtype=np.float64)
    return np.exp(-lost / np.where(n, n, np.nan))


def score(docs: DataFrame, model: Model, prefix: str = "") -> DataFrame:
    """``docs`` with ``perplexity`` (null without text; after ``prefix``)."""
    if model.sent is None:
        return score_slices(docs, model, prefix)
    send = docs.sparkSession.sparkContext.broadcast((model.alphabet, *model.sent))
    state: dict[str, np.ndarray] = {}

    def fn(texts: list[str | None]):
        if not state:
            state["table"] = class_table(send.value[0])
        found = perplexities(texts, state["table"], *send.value[1:]) if texts else np.zeros(0)
        return [pa.array(found, pa.float64(), mask=np.isnan(found))], None

    return add_columns(docs, "text", [T.StructField(f"{prefix}perplexity", T.DoubleType())], fn)


def score_slices(docs: DataFrame, model: Model, prefix: str = "", size: int = SLICE) -> DataFrame:
    """``score`` without gathering the table: each slice of documents meets
    the log probabilities of its own types."""
    name = f"{prefix}perplexity"
    base = without(docs, [name])
    total = base.agg(F.sum(text_bytes(F.col("text")))).first()[0] or 0
    key = F.pmod(F.xxhash64(*[F.col(f"`{f.name}`") for f in base.schema.fields if isinstance(f.dataType, T.AtomicType)]), F.lit(total // size + 1))
    dealt = base.select(key.alias("_slice"), *[F.col(f"`{c}`") for c in base.columns])
    types = ngram_counts(dealt, model.alphabet, by="_slice").join(model.table, "gram").select("_slice", "gram", "logp")
    send = docs.sparkSession.sparkContext.broadcast(model.alphabet)
    at = base.columns.index("text")

    def run(rows: pa.Table, own: pa.Table) -> pa.Table:
        rows, table, lookup = rows.drop_columns(["_slice"]), class_table(send.value), _lookup(own)
        found = [perplexities(part.column(at).to_pylist(), table, *lookup) for batch in rows.to_batches() for part in chunks(batch, at, 2_000_000)]
        found = np.concatenate(found) if found else np.zeros(0)
        return rows.append_column(name, pa.array(found, pa.float64(), mask=np.isnan(found)))

    schema = T.StructType([*base.schema.fields, T.StructField(name, T.DoubleType())])
    return dealt.groupBy("_slice").cogroup(types.groupBy("_slice")).applyInArrow(run, schema)


def thresholds(scored: DataFrame, quantile: float) -> dict[str | None, float]:
    """Per language, and under None for all: the ``quantile`` of the
    perplexities in ``scored`` (lang, perplexity)."""
    bins = scored.where("perplexity is not null").select(F.coalesce("lang", F.lit("")).alias("lang"), F.ceil(F.log2("perplexity") * 1000).alias("bin"))
    bins = bins.groupBy("lang", "bin").count()
    both = bins.unionByName(bins.groupBy("bin").agg(F.sum("count").alias("count")).select(F.lit(None).cast("string").alias("lang"), "bin", "count"))
    own = Window.partitionBy("lang")
    ranked = both.select("lang", "bin", F.sum("count").over(own.orderBy("bin")).alias("upto"), F.sum("count").over(own).alias("all"))
    cut = ranked.where(F.col("upto") >= quantile * F.col("all")).groupBy("lang").agg(F.min("bin").alias("bin"))
    return {r.lang: 2.0 ** (r.bin / 1000) for r in cut.collect()}


def left_out(text: Column, folds: int) -> Column:
    """Is a trusted text kept out of the counts, to set the thresholds?"""
    return F.pmod(F.xxhash64(text), F.lit(folds)) == 0


def classify(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, folds: int = 3, prefix: str = "") -> DataFrame:
    """``docs`` (doc_id, text, lang, ...) with perplexity, threshold and keep
    (after ``prefix``)."""
    names = [f"{prefix}{n}" for n in ("perplexity", "threshold", "keep")]
    base = without(docs, names)
    trusted = stored(trusted_rows(base.select("doc_id", "text", "lang"), labels).withColumn("apart", left_out(F.col("text"), folds)), "trusted")
    counted, apart = trusted.where("not apart"), trusted.where("apart")
    kinds = {r.apart for r in trusted.where("text <> ''").select("apart").distinct().collect()}
    if kinds == {True}:
        counted = apart
    elif kinds == {False}:
        apart = counted
    model = train(base, counted)
    cuts = thresholds(score(apart.select("text", "lang"), model), quantile) if model.alphabet else {}
    rest = F.lit(cuts.get(None, float("inf")))
    own = {k: v for k, v in cuts.items() if k is not None}
    cut = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in sorted(own.items()) for x in pair]), F.coalesce(F.col("lang"), F.lit(""))), rest) if own else rest
    out = score(base, model, prefix).withColumn(names[1], cut)
    return out.withColumn(names[2], F.coalesce(F.col(names[0]) <= F.col(names[1]), F.lit(False)))


def keep_good(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """The kept rows of ``docs``, all columns."""
    return classify(docs, labels, prefix="_lx_", **how).where("_lx_keep").select(*[f"`{c}`" for c in docs.columns])
