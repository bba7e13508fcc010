"""Composable queries.

The reference hands a query string to its engine's parser; here the same
capabilities are small Python objects that compile to DataFrames of scored
hits ``(query_id, doc_key, id, header_key, copies, score)``, one row per
matching document. No parser: structure is built in code.

* ``Match(text)``            plain text: white-space literals OR-ed (E1/E2)
* ``Phrase(text, slop, prefix)``  exact, sloppy (in order, total gap <= slop)
  or last-token-prefix phrase (F6-F8)
* ``Fuzzy(text, distance)``  (E4)
* ``Field(field, value)``    keyword term on ``id`` / ``header_key`` (F5)
* ``Range(field, ...)``      keyword or text-term range, constant score (F10)
* ``InSet(field, values)``   constant score (F11)
* ``MatchAll()``             every document, score 1.0 (F12)
* ``Bool(must, should, must_not)``  (F1-F4); ``Boost(query, factor)`` (F9)

A ``Bool`` is one aggregation: the children's hits are unioned with flags and
grouped by document once -- no join per clause.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.fuzzy import fuzzy_hits
from ..operators.indexing import Index, keyword_rows, term_bucket
from ..operators.scoring import idf, tf_norm
from ..operators.search import (
    HIT_COLS,
    phrase_starts,
    prune_postings,
    search_hits,
    single_clause_scores,
    single_query,
    sum_by_doc,
    top_k,
    terms_with_buckets,
)

KEYWORD_FIELDS = ("id", "header_key")
QID = "q"
#: a set of more values is joined, not written into the plan
MOST_LITERALS = 1000


class Query:
    def hits(self, index: Index) -> DataFrame:  # pragma: no cover - interface
        raise NotImplementedError


@dataclass(frozen=True)
class Match(Query):
    text: str

    def hits(self, index: Index) -> DataFrame:
        return search_hits(index, self.text)


@dataclass(frozen=True)
class Phrase(Query):
    text: str
    slop: int = 0
    prefix: bool = False

    def hits(self, index: Index) -> DataFrame:
        if self.slop < 0:
            raise ValueError("slop must be >= 0")
        if self.prefix:
            return _prefix_phrase_hits(index, self.text)
        if self.slop == 0:
            return sum_by_doc(single_clause_scores(index, self.text, whole_phrase=True))
        return _sloppy_phrase_hits(index, self.text, self.slop)


@dataclass(frozen=True)
class Fuzzy(Query):
    text: str
    distance: int = 1

    def hits(self, index: Index) -> DataFrame:
        q = single_query(index.spark, self.text, QID)
        return fuzzy_hits(index, q, self.distance)


@dataclass(frozen=True)
class Field(Query):
    """Keyword term; scored by idf over the field (tf part is 1)."""

    field: str
    value: str

    def hits(self, index: Index) -> DataFrame:
        if self.field == "text":
            return Match(self.value).hits(index)
        _check_field(self.field)
        m = keyword_rows(index).filter(F.col(self.field) == self.value)
        # one row: the field value's document frequency
        dfv = m.groupBy(self.field).agg(F.sum("copies").alias("df"))
        st = index.stats()
        return (
            m.join(F.broadcast(dfv), self.field)
            .withColumn("query_id", F.lit(QID))
            .select(*HIT_COLS, idf(F.col("df"), st).alias("score"))
        )


@dataclass(frozen=True)
class Range(Query):
    """Range on ``id`` / ``header_key`` (string order) or on text terms."""

    field: str
    lower: str | None = None
    upper: str | None = None
    include_lower: bool = True
    include_upper: bool = True

    def _cond(self, c: Column) -> Column:
        cond = F.lit(True)
        if self.lower is not None:
            cond = cond & ((c >= self.lower) if self.include_lower else (c > self.lower))
        if self.upper is not None:
            cond = cond & ((c <= self.upper) if self.include_upper else (c < self.upper))
        return cond

    def hits(self, index: Index) -> DataFrame:
        if self.field == "text":
            rows = _postings_where(index, self._cond(F.col("term")))
            return _constant(rows.select("doc_key", "id", "header_key", "copies").distinct())
        _check_field(self.field)
        return _constant(keyword_rows(index).filter(self._cond(F.col(self.field))))


@dataclass(frozen=True)
class InSet(Query):
    field: str
    values: tuple[str, ...]

    def hits(self, index: Index) -> DataFrame:
        vals = list(self.values)
        if self.field == "text":
            # the values are driver-side literals: prune buckets, push term IN
            if len(vals) > MOST_LITERALS:
                terms = index.spark.createDataFrame([(v,) for v in set(vals)], "term string").withColumn("bucket", term_bucket(F.col("term"), index.n_buckets))
                post = index.postings.join(terms, ["bucket", "term"], "left_semi")
                return _constant(post.select("doc_key", "id", "header_key", "copies").distinct())
            tb = terms_with_buckets(index.spark, [[v] for v in vals], index.n_buckets)
            post, _ = prune_postings(index, tb)
            return _constant(post.select("doc_key", "id", "header_key", "copies").distinct())
        _check_field(self.field)
        rows = keyword_rows(index)
        if len(vals) > MOST_LITERALS:
            return _constant(rows.join(index.spark.createDataFrame([(v,) for v in set(vals)], f"{self.field} string"), self.field, "left_semi"))
        return _constant(rows.filter(F.col(self.field).isin(vals)))


@dataclass(frozen=True)
class MatchAll(Query):
    def hits(self, index: Index) -> DataFrame:
        return _constant(keyword_rows(index))


@dataclass(frozen=True)
class Boost(Query):
    query: Query
    factor: float

    def hits(self, index: Index) -> DataFrame:
        return self.query.hits(index).withColumn("score", F.col("score") * F.lit(float(self.factor)))


@dataclass(frozen=True)
class Bool(Query):
    must: tuple[Query, ...] = field(default_factory=tuple)
    should: tuple[Query, ...] = field(default_factory=tuple)
    must_not: tuple[Query, ...] = field(default_factory=tuple)

    def hits(self, index: Index) -> DataFrame:
        if not self.must and not self.should:
            raise ValueError("a boolean query needs at least one must or should clause")
        parts = []
        for role, qs in (("must", self.must), ("should", self.should), ("not", self.must_not)):
            for qq in qs:
                h = qq.hits(index).select(*HIT_COLS, "score")
                parts.append(h.withColumn("_role", F.lit(role)))
        u = parts[0]
        for p in parts[1:]:
            u = u.unionByName(p)
        g = u.groupBy(*HIT_COLS).agg(
            F.sum(F.when(F.col("_role") != "not", F.col("score")).otherwise(F.lit(0.0))).alias("score"),
            F.sum(F.when(F.col("_role") == "must", 1).otherwise(0)).alias("_n_must"),
            F.sum(F.when(F.col("_role") == "should", 1).otherwise(0)).alias("_n_should"),
            F.sum(F.when(F.col("_role") == "not", 1).otherwise(0)).alias("_n_not"),
        )
        cond = (F.col("_n_must") == len(self.must)) & (F.col("_n_not") == 0)
        if not self.must:
            cond = cond & (F.col("_n_should") > 0)
        return g.filter(cond).select(*HIT_COLS, "score")


def run(index: Index, query: Query, k: int | None = 10) -> DataFrame:
    """Top-k (or, with ``k=None``, every hit) of a composed query:
    ``rank, id, score`` / ``id, header_key, score``."""
    index.check_open()
    h = query.hits(index)
    if k is None:
        return h.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(
            "id", "header_key", "score"
        )
    return top_k(h, k, one_query=True).select("rank", "id", "score")


# --------------------------------------------------------------------------


def _check_field(f: str) -> None:
    if f not in KEYWORD_FIELDS:
        raise ValueError(f"unknown field {f!r}; expected one of {KEYWORD_FIELDS + ('text',)}")


def _postings_where(index: Index, cond: Column) -> DataFrame:
    """Postings of the terms that ``cond`` (a range, a prefix) selects. The
    dictionary, which is narrow, tells their buckets (``n_buckets`` numbers
    at most); only these are opened, and there the condition is pushed to
    Parquet, where files sorted by term skip row groups out of range."""
    if index.lazy:
        return index.postings.filter(cond)
    buckets = [r[0] for r in index.term_stats.where(cond).select("bucket").distinct().collect()]
    return index.table("postings", sorted(buckets)).filter(F.col("bucket").isin(sorted(buckets)) & cond)


def _constant(doc_rows: DataFrame) -> DataFrame:
    return doc_rows.withColumn("query_id", F.lit(QID)).select(*HIT_COLS, F.lit(1.0).alias("score"))


def _phrase_tokens(index: Index, text: str) -> list[str]:
    """A phrase's tokens (bounded by the text), by the corpus's analyzer."""
    q = single_query(index.spark, text, QID)
    return list(q.select(index.tokenizer(F.col("query")).alias("t")).first().t)


def _positions(index: Index, toks: list[str]) -> DataFrame:
    """``doc, off, positions`` of the tokens: postings pruned to their buckets
    and terms, joined with their offsets."""
    tb = dict(terms_with_buckets(index.spark, [toks], index.n_buckets)) if toks else {}
    post, _ = prune_postings(index, sorted(tb.items()))
    rows = index.spark.range(1).select(F.inline(F.array(*[F.struct(F.lit(i).alias("off"), F.lit(t).alias("term"), F.lit(tb[t]).alias("bucket")) for i, t in enumerate(toks)]))) if toks else None
    if rows is None:
        return post.select(*DOC, F.lit(0).alias("off"), "positions").limit(0)
    return post.join(F.broadcast(rows), ["bucket", "term"]).select(*DOC, "off", "positions")


DOC = ["doc_key", "id", "header_key", "copies", "dl"]


def _idf_sum(index: Index, toks: list[str], st) -> float:
    """Sum of idf over the phrase's tokens (repeats included): looked up in
    the term dictionary, at most one row per token."""
    tb = terms_with_buckets(index.spark, [toks], index.n_buckets)
    _, ts = prune_postings(index, tb)
    by = {r.term: float(r.w) for r in ts.select("term", idf(F.col("df"), st).alias("w")).collect()}
    return sum(by.get(t, 0.0) for t in toks)


def _prefix_phrase_hits(index: Index, text: str) -> DataFrame:
    """F8: all tokens fixed but the last, which matches any term starting
    with it. Weight: sum of the fixed tokens' idf (1.0 when only the prefix
    is given), times tfnorm of the number of matching starts."""
    toks = _phrase_tokens(index, text)
    if not toks:
        return _constant(index.doc_stats.limit(0))
    n, fixed = len(toks), toks[:-1]
    # the expansions of the last token: a range of terms, pushed to the scan
    last = _postings_where(index, F.col("term").startswith(toks[-1])).groupBy(*DOC).agg(F.flatten(F.collect_list("positions")).alias("positions"))
    per_off = _positions(index, fixed).unionByName(last.select(*DOC, F.lit(n - 1).alias("off"), "positions"))
    st = index.stats()
    per_doc = per_off.groupBy("doc_key", "id", "header_key", "copies", "dl").agg(
        F.collect_list(F.struct("off", "positions")).alias("pl")
    )
    per_doc = per_doc.filter(F.size("pl") == n).withColumn("ptf", F.size(phrase_starts(F.col("pl"))))
    per_doc = per_doc.filter(F.col("ptf") > 0)
    if n == 1:
        return _constant(per_doc)
    w = _idf_sum(index, fixed, st)
    return per_doc.withColumn("query_id", F.lit(QID)).select(
        *HIT_COLS, (F.lit(w) * tf_norm(F.col("ptf"), F.col("dl"), st)).alias("score")
    )


def sloppy_starts(pl: Column, n: int, slop: int) -> Column:
    """How many positions of the first of ``n`` tokens start a match.
    ``pl``: (off, positions) of each token.

    One walk over all positions from the last to the first: ``ends[j]`` is
    where the chain from the nearest position of token j ends, that is the
    chain of the nearest next position of token j + 1. At one position (a
    token that the phrase repeats) lower tokens go first, as the next token's
    position must be larger. Work grows with the number of positions."""
    events = F.array_sort(F.flatten(F.transform(pl, lambda x: F.transform(x["positions"], lambda p: F.struct((-p).alias("back"), x["off"].alias("off"))))))
    none = F.lit(-1)

    def step(held: Column, e: Column) -> Column:
        at = -e["back"]
        end = F.when(e["off"] == n - 1, at).otherwise(F.get(held["ends"], e["off"] + 1))
        ends = F.transform(held["ends"], lambda x, j: F.when(j == e["off"], end).otherwise(x))
        fits = (e["off"] == 0) & (end >= 0) & (end - at - F.lit(n - 1) <= slop)
        return F.struct(ends.alias("ends"), (held["n"] + F.when(fits, 1).otherwise(0)).alias("n"))

    start = F.struct(F.array_repeat(none, n).alias("ends"), F.lit(0).alias("n"))
    return F.aggregate(events, start, step, lambda held: held["n"])


def _sloppy_phrase_hits(index: Index, text: str, slop: int) -> DataFrame:
    """tokens in order at increasing positions whose total gap
    ``p_last - p_first - (n - 1)`` is at most ``slop``. For each position of
    the first token the chain takes the nearest next position of each
    following token (the greedy chain minimises the end). Frequency = number
    of first positions that start a match; weight = sum of idf."""
    toks = _phrase_tokens(index, text)
    n = len(toks)
    if n == 0:
        return _constant(index.doc_stats.limit(0))
    st = index.stats()
    per_doc = _positions(index, toks).groupBy(*DOC).agg(F.collect_list(F.struct("off", "positions")).alias("pl"))
    per_doc = per_doc.filter(F.size("pl") == n).withColumn("ptf", sloppy_starts(F.col("pl"), n, slop))
    per_doc = per_doc.filter(F.col("ptf") > 0)
    w = _idf_sum(index, toks, st)
    return per_doc.withColumn("query_id", F.lit(QID)).select(
        *HIT_COLS, (F.lit(w) * tf_norm(F.col("ptf"), F.col("dl"), st)).alias("score")
    )
