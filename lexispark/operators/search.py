"""Term and phrase clauses, BM25, top-k.

Every search is expressed over a *clause table* keyed by ``query_id``, so a
single query and a table of a million queries run the same plan:

``clauses(query_id, clause_id, kind, n_tok, off, term, boost)``

* ``kind = 'term'``: one token; score ``boost * idf * tfnorm(tf)``.
* ``kind = 'phrase'``: ``n_tok`` tokens at offsets ``off``; matches where all
  tokens sit at ``start + off``; score ``boost * sum(idf) * tfnorm(#starts)``.

Plan: postings (pruned to the query terms' buckets) join the clause table
and the terms' document frequencies -- broadcast for a query string of
bounded length, left to Spark's own size rule for a table of queries; term
clauses score per posting row, phrase clauses group the at most ``n_tok``
postings of one (clause, document) and intersect shifted position arrays;
the clause scores of a document are summed (one shuffle of hits by
document), and the best k per query are kept with a window whose partial
group limit runs before the shuffle. A table of queries first finds, for
each, a score that the k-th result surely has, and then leaves out the pairs
that common words and phrases alone can't lift to it (``pruned_hits``).
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.blocks import best_of_block
from ..functions.tokenize import WS_CLASS, tokens
from ..schema import BM25_K1
from ..session import fresh_path
from .indexing import CorpusStats, Index, term_bucket
from .scoring import idf, order_key, tf_norm

HIT_COLS = ["query_id", "doc_key", "id", "header_key", "copies"]
LITERAL_PATTERN = f"[^{WS_CLASS}]+"
#: a query string up to this many characters becomes literals of the plan; a
#: longer one goes the way of a table of queries
LONGEST_LITERAL = 10_000
#: Spark limits groups before the shuffle up to this k (its default of
#: spark.sql.window.group.limit.threshold); beyond, groups are split by SALTS
WINDOW_LIMIT = 1000
SALTS = 256
#: rows of a query-sized table that are sent to every task at a time; what is
#: larger goes in slices of the queries, or is joined by Spark's own rule
MOST_SENT = 500_000
#: (clause, document) matches that one task adds up
TASK_MATCHES = 4_000_000
#: of a table of term queries: postings in a block of documents, clauses in a
#: block of queries, and postings that are not worth another task
BLOCK_POSTINGS = 2_000_000
BLOCK_CLAUSES = 2_000_000
FEW_POSTINGS = 20_000


def _check_k(k: int) -> None:
    if not isinstance(k, int) or k < 1:
        raise ValueError(f"top_k must be a positive integer, got {k!r}")


# --------------------------------------------------------------------------
# clause tables
# --------------------------------------------------------------------------


def literal_clauses(queries: DataFrame, boost: float = 1.0, tokenizer=tokens) -> DataFrame:
    """Split each query on white space into literals; a literal with
    one token is a term clause, a literal with more (CJK) a phrase clause."""
    lits = queries.select(
        F.col("query_id").cast("string").alias("query_id"),
        F.posexplode(
            F.regexp_extract_all(F.coalesce(F.col("query"), F.lit("")), F.lit(LITERAL_PATTERN), 0)
        ).alias("clause_id", "lit"),
    )
    toks = lits.select("query_id", "clause_id", tokenizer(F.col("lit")).alias("toks"))
    return _explode_clause_tokens(toks, boost)


def phrase_clauses(queries: DataFrame, boost: float = 1.0, tokenizer=tokens) -> DataFrame:
    """The whole query is one phrase (a single token is a term clause)."""
    toks = queries.select(
        F.col("query_id").cast("string").alias("query_id"),
        F.lit(0).alias("clause_id"),
        tokenizer(F.col("query")).alias("toks"),
    )
    return _explode_clause_tokens(toks, boost)


def _explode_clause_tokens(toks: DataFrame, boost: float) -> DataFrame:
    return toks.select(
        "query_id",
        F.col("clause_id").cast("int").alias("clause_id"),
        F.size("toks").cast("int").alias("n_tok"),
        F.posexplode("toks").alias("off", "term"),
    ).select(
        "query_id",
        "clause_id",
        F.when(F.col("n_tok") == 1, F.lit("term")).otherwise(F.lit("phrase")).alias("kind"),
        "n_tok",
        F.col("off").cast("int").alias("off"),
        "term",
        F.lit(float(boost)).alias("boost"),
    )


def single_query(spark: SparkSession, query: str, query_id: str = "q") -> DataFrame:
    """A one-row query table (a JVM literal: no Python round trip)."""
    return spark.range(1).select(
        F.lit(query_id).cast("string").alias("query_id"), F.lit(query).cast("string").alias("query")
    )


def clauses_literal(
    spark: SparkSession, clause_tokens: list[list[str]], boost: float | list[float] = 1.0, query_id: str = "q"
) -> DataFrame:
    """Clause table of one query from driver-side token lists, as a literal
    ``inline`` (constant-folded, no Python data path)."""
    boosts = boost if isinstance(boost, list) else [boost] * len(clause_tokens)
    rows = [
        F.struct(
            F.lit(query_id).alias("query_id"),
            F.lit(ci).alias("clause_id"),
            F.lit("term" if len(toks) == 1 else "phrase").alias("kind"),
            F.lit(len(toks)).alias("n_tok"),
            F.lit(off).alias("off"),
            F.lit(t).alias("term"),
            F.lit(float(boosts[ci])).alias("boost"),
        )
        for ci, toks in enumerate(clause_tokens)
        for off, t in enumerate(toks)
    ]
    if not rows:
        return spark.range(0).select(
            F.lit(query_id).alias("query_id"), F.lit(0).alias("clause_id"), F.lit("term").alias("kind"),
            F.lit(1).alias("n_tok"), F.lit(0).alias("off"), F.lit("").alias("term"), F.lit(1.0).alias("boost"),
        )
    return spark.range(1).select(F.inline(F.array(*rows)))


def terms_with_buckets(spark: SparkSession, clause_tokens: list[list[str]], n_buckets: int) -> list[tuple[str, int]]:
    """(term, bucket) of driver-side tokens; the bucket is computed by the
    same Spark expression the index used (one constant-folded row)."""
    uniq = sorted({t for toks in clause_tokens for t in toks})
    if not uniq:
        return []
    arr = F.array(*[F.lit(t) for t in uniq])
    row = spark.range(1).select(F.transform(arr, lambda t: term_bucket(t, n_buckets)).alias("b")).first()
    return list(zip(uniq, [int(b) for b in row.b]))


# --------------------------------------------------------------------------
# scoring
# --------------------------------------------------------------------------


def prune_postings(index: Index, terms: list[tuple[str, int]] | None) -> tuple[DataFrame, DataFrame]:
    """Postings and term statistics restricted to the given (term, bucket)s."""
    if terms is None:
        return index.postings, index.term_stats.select("bucket", "term", "df")
    bks = sorted({b for _, b in terms})
    cond = F.col("bucket").isin(bks) & F.col("term").isin(sorted({t for t, _ in terms}))
    post, ts = index.table("postings", bks), index.table("term_stats", bks)
    return post.filter(cond), ts.select("bucket", "term", "df").filter(cond)


def clause_scores(
    index: Index,
    clauses: DataFrame,
    stats: CorpusStats | None = None,
    terms: list[tuple[str, int]] | None = None,
    kinds: set[str] | None = None,
    terms_merged: bool = False,
) -> DataFrame:
    """Score every (clause, document) match: ``HIT_COLS + clause_id, score``.

    ``terms`` (of a query string, at most ``LONGEST_LITERAL`` characters)
    prunes postings to the query's buckets and terms and bounds what is
    broadcast; ``kinds`` (when known) skips the branch a query doesn't use."""
    stats = stats or index.stats()
    c = clauses.withColumn("bucket", term_bucket(F.col("term"), index.n_buckets))
    kinds = kinds or {"term", "phrase"}
    post, ts = prune_postings(index, terms)
    send = F.broadcast if terms is not None else (lambda df: df)
    if terms is None:
        ts = ts.join(c.select("bucket", "term").distinct(), ["bucket", "term"], "left_semi")
    w = idf(F.col("df"), stats)

    out = []
    if "term" in kinds:
        ct = c.filter(F.col("kind") == "term")
        if not terms_merged:
            ct = merged_terms(ct)
        # the query side first: its rows get their df, then meet the postings
        ct = known(index.spark, ct.join(ts, ["bucket", "term"])) if terms is None else ct
        jt = post.join(send(ct), ["bucket", "term"])
        jt = jt if terms is None else jt.join(send(ts), ["bucket", "term"])
        out.append(
            jt.select(
                *HIT_COLS,
                "clause_id",
                F.col("tf").alias("occurrences"),
                (F.col("boost") * w * tf_norm(F.col("tf"), F.col("dl"), stats)).alias("score"),
            )
        )
    if "phrase" in kinds:
        cp = c.filter(F.col("kind") == "phrase")
        if terms is None:
            out.append(phrase_matches(index, cp.join(ts, ["bucket", "term"]).withColumn("w", w), stats))
        else:
            jp = post.join(send(cp), ["bucket", "term"]).join(send(ts), ["bucket", "term"])
            out.append(phrase_scores(jp.withColumn("w", w), stats))
    return out[0] if len(out) == 1 else out[0].unionByName(out[1])


def merged_terms(term_clauses: DataFrame) -> DataFrame:
    """A term written k times in one query is one clause of boost k (same
    score, k times fewer joined posting rows)."""
    return term_clauses.groupBy("query_id", "bucket", "term").agg(
        F.sum("boost").alias("boost"), F.min("clause_id").alias("clause_id")
    )


def phrase_scores(tokens_of: DataFrame, stats: CorpusStats) -> DataFrame:
    """Matches of phrase clauses, from the postings of their tokens (with the
    clause's n_tok and boost, the token's off and its idf ``w``), scored where
    the shifted positions meet: ``HIT_COLS, clause_id, occurrences, score``."""
    ph = (
        tokens_of.groupBy(*HIT_COLS, "clause_id", "n_tok", "boost", "dl")
        .agg(F.collect_list(F.struct("off", "positions")).alias("pl"), F.sum("w").alias("w"))
        .filter(F.size("pl") == F.col("n_tok"))
        .withColumn("ptf", F.size(phrase_starts(F.col("pl"))))
        .filter(F.col("ptf") > 0)
    )
    score = F.col("boost") * F.col("w") * tf_norm(F.col("ptf"), F.col("dl"), stats)
    return ph.select(*HIT_COLS, "clause_id", F.col("ptf").alias("occurrences"), score.alias("score"))


def known(spark: SparkSession, df: DataFrame) -> DataFrame:
    """A query-sized table that is used several times: written once, then of
    known size."""
    path = fresh_path(spark, "clauses")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def phrase_matches(index: Index, ct: DataFrame, stats: CorpusStats) -> DataFrame:
    """Like ``phrase_scores``, for a table of phrases (one row for each token
    that the corpus has, with its ``df`` and idf ``w``): a phrase's two rarest
    tokens are put together first, and only the documents where they stand at
    the right distance are looked up for the other tokens. So a common token's
    postings never meet all phrases that hold it."""
    spark = index.spark
    clause = Window.partitionBy("query_id", "clause_id")
    cols = ["query_id", "clause_id", "bucket", "term", "n_tok", "off", "boost"]
    ct = ct.withColumn("present", F.count(F.lit(1)).over(clause)).where("present = n_tok")
    ct = ct.select(*cols, F.sum("w").over(clause).alias("w"), F.row_number().over(clause.orderBy("df", "off")).alias("place"))
    ct = known(spark, ct)
    placed = index.postings.select("bucket", "term", "doc_key", "id", "header_key", "copies", "dl", "positions")
    match = [*HIT_COLS, "dl", "clause_id", "n_tok", "boost", "w"]
    at = F.collect_list(F.struct("off", "positions")).alias("pl")
    two = placed.join(ct.where("place <= 2"), ["bucket", "term"]).groupBy(*match).agg(at).where("size(pl) = 2")
    two = two.select(*match, phrase_starts(F.col("pl")).alias("starts")).where("size(starts) > 0")
    two = known(spark, two)
    asked = two.join(ct.where("place > 2").select("query_id", "clause_id", "bucket", "term", "off"), ["query_id", "clause_id"])
    n_asked = two.agg(F.sum(F.col("n_tok") - 2)).first()[0] or 0
    asked = F.broadcast(asked) if n_asked <= MOST_SENT else asked
    rest = placed.drop("header_key", "copies", "dl").join(asked, ["bucket", "term", "doc_key", "id"])
    rest = rest.groupBy(*match).agg(at, F.first("starts").alias("starts")).where("size(pl) = n_tok - 2")
    begun = F.array(F.struct(F.lit(0).alias("off"), F.col("starts").alias("positions")))
    rest = rest.select(*match, phrase_starts(F.concat(begun, "pl")).alias("starts")).where("size(starts) > 0")
    every = two.where("n_tok = 2").unionByName(rest).withColumn("ptf", F.size("starts"))
    score = F.col("boost") * F.col("w") * tf_norm(F.col("ptf"), F.col("dl"), stats)
    return every.select(*HIT_COLS, "clause_id", F.col("ptf").alias("occurrences"), score.alias("score"))


def numbered(spark: SparkSession, rows: DataFrame, number: str) -> DataFrame:
    """Distinct rows of a query-sized table, each with a number."""
    return known(spark, rows.distinct().withColumn(number, F.monotonically_increasing_id()))


def in_slices(index: Index, clauses: DataFrame, n_rows: int, matches: int, best) -> DataFrame:
    """``best(clauses, n)`` for as many slices of the queries as it takes to
    send ``n_rows`` rows to the tasks MOST_SENT at a time; n: partitions of
    the documents. A slice's results are the best k of its queries only."""
    spark = index.spark
    slices = max(1, -(-n_rows // MOST_SENT))
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(50_000, matches // (TASK_MATCHES * slices)))
    if slices == 1:
        return best(clauses, n)
    mine = F.pmod(F.xxhash64("query_id"), F.lit(slices))
    done = [known(spark, best(clauses.where(mine == i), n)) for i in range(slices)]
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def held_terms(index: Index, terms: DataFrame, n: int, *cols: Column) -> DataFrame:
    """``t, doc_key, id, copies`` and ``cols`` of the postings of the terms
    (bucket, term, t), all of a document in one of ``n`` partitions: what is
    joined and summed by document from here on is not shuffled."""
    post = index.postings.select("bucket", "term", "doc_key", "id", "copies", "tf", "dl")
    return post.join(terms, ["bucket", "term"]).select("t", "doc_key", "id", "copies", *cols).repartition(n, "doc_key", "id")


def best_by_terms(index: Index, clauses: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of each query of a table of term clauses: the documents
    (the queried terms' postings of each) and the queries (their clauses) are
    dealt out to blocks, and each pair of blocks meets in a task of its own,
    which adds up the many (clause, document) matches by array operations
    (``functions.blocks``) and gives the block's best k of its queries. The
    work grows with the matches; a task's share doesn't, nor its memory."""
    stats, spark = index.stats(), index.spark
    c = merged_terms(clauses.withColumn("bucket", term_bucket(F.col("term"), index.n_buckets)))
    c = c.join(index.term_stats.select("bucket", "term", "df"), ["bucket", "term"])
    c = known(spark, c.select("query_id", "bucket", "term", "df", (F.col("boost") * idf(F.col("df"), stats)).alias("w")))
    terms = numbered(spark, c.select("bucket", "term", "df"), "t")
    n_clauses = c.count()
    n_postings = int(terms.agg(F.sum("df")).first()[0] or 0)
    slices = max(1, -(-n_clauses // BLOCK_CLAUSES))
    spread = -(-4 * spark.sparkContext.defaultParallelism // slices)
    blocks = max(2, -(-n_postings // BLOCK_POSTINGS), min(spread, n_postings // FEW_POSTINGS))

    post = index.postings.select("bucket", "term", "doc_key", "id", "copies", "tf", "dl")
    part = tf_norm(F.col("tf"), F.col("dl"), stats).alias("x")
    own = F.pmod(F.xxhash64("doc_key", "id"), F.lit(blocks)).cast("int").alias("own")
    rows = post.join(terms.drop("df"), ["bucket", "term"]).select("t", part, "id", "doc_key", "copies", own)
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))) if slices > 1 else rows.withColumn("other", F.lit(0))
    asked = c.join(terms.drop("df"), ["bucket", "term"]).select(
        "t",
        F.col("w").alias("x"),
        F.col("query_id").alias("id"),
        F.lit(None).cast("long").alias("doc_key"),
        F.lit(None).cast("int").alias("copies"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("own"),
        F.pmod(F.xxhash64("query_id"), F.lit(slices)).cast("int").alias("other"),
    )
    both = rows.unionByName(asked).repartitionById(blocks * slices, F.col("own") * slices + F.col("other"))
    both = both.select("t", "x", "id", "doc_key", "copies")
    hits = both.mapInArrow(partial(best_of_block, k=k), "query_id string, doc_key long, id string, copies int, score double")
    return top_k(hits, k)


def pruned_hits(index: Index, clauses: DataFrame, k: int, kinds: set[str]) -> DataFrame:
    """The hits of a table of clauses, less pairs that can't be among the
    best ``k`` of their query: exact, by score bounds, query by query.

    A clause adds at most ``boost * w * (k1 + 1)``, w being the term's idf or
    the sum of the phrase's. 1. Each query's leading terms (by that bound,
    until their documents number k) are scored alone; the k best documents by
    these partial scores are scored by all terms, and the least of the k is a
    floor of the final k-th score. 2. Going up from the
    smallest bound, clauses whose bounds together stay below the floor can't
    make a result by themselves. 3. Documents with any other clause are the
    candidates; they meet the clauses of step 2 by (term, document), so a
    common word is looked up, not expanded. A query without terms of its own
    has no floor, and its phrases are all matched; ``kinds``: those that
    occur in the table at all."""
    stats = index.stats()
    all_c = clauses.withColumn("bucket", term_bucket(F.col("term"), index.n_buckets))
    ts = index.term_stats.select("bucket", "term", "df")
    c = merged_terms(all_c.where("kind = 'term'")).join(ts, ["bucket", "term"]).withColumn("w", idf(F.col("df"), stats))
    post = index.postings.select("bucket", "term", "doc_key", "id", "header_key", "copies", "tf", "dl")
    add = F.col("boost") * F.col("w") * tf_norm(F.col("tf"), F.col("dl"), stats)
    down = Window.partitionBy("query_id").orderBy(F.desc("bound"), "term").rowsBetween(Window.unboundedPreceding, -1)
    up = Window.partitionBy("query_id").orderBy("bound", F.desc("clause_id")).rowsBetween(Window.unboundedPreceding, 0)
    c = c.withColumn("bound", F.col("boost") * F.col("w") * (BM25_K1 + 1))
    c = c.withColumn("lead", F.coalesce(F.sum("df").over(down), F.lit(0)) < k)
    keys = ["query_id", "clause_id", "bound", "kind"]
    bounds = c.withColumn("kind", F.lit("term")).select(*keys)
    if "phrase" in kinds:
        ct = all_c.where("kind = 'phrase'").join(ts, ["bucket", "term"]).withColumn("w", idf(F.col("df"), stats))
        whole = ct.groupBy("query_id", "clause_id", "n_tok", "boost").agg(F.sum("w").alias("w"), F.count(F.lit(1)).alias("n"))
        whole = whole.where("n = n_tok").withColumn("bound", F.col("boost") * F.col("w") * (BM25_K1 + 1))
        bounds = bounds.unionByName(whole.withColumn("kind", F.lit("phrase")).select(*keys))

    first = post.join(c.where("lead"), ["bucket", "term"]).groupBy("query_id", "doc_key", "id").agg(F.sum(add).alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"))
    some = first.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k).select("query_id", "doc_key", "id")
    some = some.join(c.select("query_id", "bucket", "term", "boost", "w"), "query_id")
    full = post.join(some, ["bucket", "term", "doc_key", "id"]).groupBy("query_id", "doc_key", "id").agg(F.sum(add).alias("score"))
    floor = full.groupBy("query_id").agg(F.min("score").alias("floor"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= k)
    weak = bounds.withColumn("below", F.sum("bound").over(up)).join(floor, "query_id", "left")
    weak = weak.select("query_id", "clause_id", "kind", F.coalesce(F.col("below") + 1e-6 < F.col("floor"), F.lit(False)).alias("weak"))

    weak = known(index.spark, weak)
    c = known(index.spark, c.join(weak.where("kind = 'term'"), ["query_id", "clause_id"]).select("query_id", "bucket", "term", "boost", "w", "weak"))
    strong = post.join(c.where("not weak").drop("weak"), ["bucket", "term"]).select(*HIT_COLS, add.alias("score"))
    if "phrase" in kinds:
        ct = known(
            index.spark,
            ct.join(weak.where("kind = 'phrase'"), ["query_id", "clause_id"]).select("query_id", "clause_id", "bucket", "term", "n_tok", "off", "boost", "df", "w", "weak"),
        )
        placed = index.postings.select("bucket", "term", "doc_key", "id", "header_key", "copies", "dl", "positions")
        found = phrase_matches(index, ct.where("not weak").drop("weak"), stats)
        strong = strong.unionByName(found.select(*HIT_COLS, "score"))
    seen = strong.select(*HIT_COLS).distinct()
    at = ["bucket", "term", "doc_key", "id"]
    rest = post.drop("header_key", "copies").join(seen.join(c.where("weak").drop("weak"), "query_id"), at).select(*HIT_COLS, add.alias("score"))
    out = strong.unionByName(rest)
    if "phrase" in kinds:
        looked = placed.drop("header_key", "copies").join(seen.join(ct.where("weak").drop("weak", "df"), "query_id"), at)
        out = out.unionByName(phrase_scores(looked, stats).select(*HIT_COLS, "score"))
    return out


_QUERY_EXPR_CACHE: dict[tuple, Column] = {}


def _query_token_expr(spark: SparkSession, whole_phrase: bool, n_buckets: int, tokenizer=tokens) -> Column:
    """Per-clause ``(token, bucket)`` lists of column ``q``; built once per
    JVM and mode (building the lambdas costs hundreds of py4j calls)."""
    key = (id(spark.sparkContext._gateway), whole_phrase, n_buckets, tokenizer)
    if key not in _QUERY_EXPR_CACHE:
        q = F.col("q")
        if whole_phrase:
            per_clause = F.array(tokenizer(q))
        else:
            per_clause = F.transform(F.regexp_extract_all(q, F.lit(LITERAL_PATTERN), 0), lambda x: tokenizer(x))
        _QUERY_EXPR_CACHE[key] = F.transform(
            per_clause,
            lambda ts: F.transform(ts, lambda t: F.struct(t.alias("t"), term_bucket(t, n_buckets).alias("b"))),
        ).alias("c")
    return _QUERY_EXPR_CACHE[key]


def single_clause_scores(index: Index, text: str, whole_phrase: bool = False, boost: float = 1.0) -> DataFrame:
    """``clause_scores`` of one query string with everything the driver can
    know up front: literal clause table, pruned buckets/terms, used branch.

    One small job tokenises the query (the documents' expression, bounded by
    the query length) and computes the terms' buckets."""
    spark = index.spark
    if len(text) > LONGEST_LITERAL:
        make = phrase_clauses if whole_phrase else literal_clauses
        return clause_scores(index, make(single_query(spark, text), boost, index.tokenizer))
    expr = _query_token_expr(spark, whole_phrase, index.n_buckets, index.tokenizer)
    row = spark.range(1).select(F.lit(text).alias("q")).select(expr).first()
    all_toks = [[e.t for e in cl] for cl in row.c if cl]
    terms = sorted({(e.t, int(e.b)) for cl in row.c for e in cl})
    # a term written k times is one clause of boost k (same score)
    ctoks: list[list[str]] = []
    boosts: list[float] = []
    seen: dict[str, int] = {}
    for t in all_toks:
        if len(t) == 1 and t[0] in seen:
            boosts[seen[t[0]]] += boost
            continue
        if len(t) == 1:
            seen[t[0]] = len(ctoks)
        ctoks.append(t)
        boosts.append(boost)
    kinds = {"term" if len(t) == 1 else "phrase" for t in ctoks} or {"term"}
    return clause_scores(
        index,
        clauses_literal(spark, ctoks, boosts),
        terms=terms,
        kinds=kinds,
        terms_merged=True,
    )


def phrase_starts(pl: Column) -> Column:
    """Start positions where every (off, positions) entry has a token at
    ``start + off``: intersection of the shifted position arrays."""
    s = F.array_sort(pl)
    first = F.transform(s[0]["positions"], lambda p: p - s[0]["off"])
    return F.aggregate(
        F.slice(s, 2, F.size(s) - 1),
        first,
        lambda acc, x: F.array_intersect(acc, F.transform(x["positions"], lambda p: p - x["off"])),
    )


def sum_by_doc(clause_hits: DataFrame, with_header: bool = True) -> DataFrame:
    """Sum of clause scores per (query, document). ``with_header=False``
    leaves ``header_key`` out of the shuffled key when no facet needs it."""
    keys = HIT_COLS if with_header else [c for c in HIT_COLS if c != "header_key"]
    return clause_hits.groupBy(*keys).agg(F.sum("score").alias("score"))


def top_k(hits: DataFrame, k: int, one_query: bool = False) -> DataFrame:
    """Best ``k`` per query by ``score desc, id, doc_key``; exact copies
    count as separate results. ``row_number() <= k`` is planned with a
    partial group limit before the shuffle. For a larger k than Spark does
    that for, one query's hits are a sorted limit, and those of many queries
    are first ranked in SALTS parts each: no task gets all hits of a query."""
    _check_k(k)
    ex = hits.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least(F.col("copies"), F.lit(k)))))
    order = [*order_key(), F.col("copy")]
    if k > WINDOW_LIMIT and one_query:
        ex = ex.orderBy(*order).limit(k)
    elif k > WINDOW_LIMIT:
        part = Window.partitionBy("query_id", F.pmod(F.xxhash64("doc_key", "id", "copy"), F.lit(SALTS))).orderBy(*order)
        ex = ex.withColumn("_r", F.row_number().over(part)).filter(F.col("_r") <= k).drop("_r")
    w = Window.partitionBy("query_id").orderBy(*order)
    return ex.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).drop("copy")


def all_hits(hits: DataFrame) -> DataFrame:
    """Every match, one row per stored document (copies expanded)."""
    return hits.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("copy")


def search_batch(index: Index, queries: DataFrame, k: int = 5) -> DataFrame:
    """``queries(query_id, query)`` -> ``query_id, rank, id, score``."""
    index.check_open()
    _check_k(k)
    clauses = literal_clauses(queries, tokenizer=index.tokenizer)
    kinds = {r.kind for r in clauses.select("kind").distinct().collect()}  # two at most
    if "phrase" not in kinds:
        return best_by_terms(index, clauses, k).select("query_id", "rank", "id", "score")
    rows = pruned_hits(index, clauses, k, kinds)
    return top_k(sum_by_doc(rows, with_header=False), k).select("query_id", "rank", "id", "score")


def search_hits(index: Index, query: str) -> DataFrame:
    """All scored matches of one plain query (before top-k)."""
    index.check_open()
    return sum_by_doc(single_clause_scores(index, query))


def search(index: Index, query: str, k: int = 5) -> DataFrame:
    """BM25 top-k of a plain query -> ``rank, id, score``.

    A blank query gives an empty result with the full schema."""
    _check_k(k)
    return top_k(search_hits(index, query), k, one_query=True).select("rank", "id", "score")


def phrase_hits(index: Index, phrase: str) -> DataFrame:
    """E3 matches of one phrase: ``HIT_COLS, occurrences, score``."""
    index.check_open()
    ch = single_clause_scores(index, phrase, whole_phrase=True)
    return ch.groupBy(*HIT_COLS).agg(
        F.sum("occurrences").alias("occurrences"), F.sum("score").alias("score")
    )


def search_phrase(index: Index, phrase: str, k: int = 5) -> DataFrame:
    """Exact phrase, top-k -> ``rank, id, score``."""
    _check_k(k)
    return top_k(phrase_hits(index, phrase), k, one_query=True).select("rank", "id", "score")


def phrase_search_batch(index: Index, queries: DataFrame, k: int = 5) -> DataFrame:
    """E3 for a table of phrases: ``query_id, rank, id, score``."""
    index.check_open()
    clauses = phrase_clauses(queries, tokenizer=index.tokenizer)
    kinds = {r.kind for r in clauses.select("kind").distinct().collect()}  # two at most
    hits = sum_by_doc(clause_scores(index, clauses, kinds=kinds))
    return top_k(hits, k).select("query_id", "rank", "id", "score")


def as_map(results: DataFrame) -> DataFrame:
    """Top-k rows -> one ``MAP<id, score>`` per query (after top-k only;
    like a map, a repeated id keeps one entry)."""
    last = results.groupBy("query_id", "id").agg(F.max_by("score", "rank").alias("score"))
    return last.groupBy("query_id").agg(
        F.map_from_entries(F.collect_list(F.struct("id", "score"))).alias("results")
    )


def restrict(hits: DataFrame, allowed: DataFrame, on: str = "id") -> DataFrame:
    """Keep hits whose ``on`` value appears in ``allowed`` (e.g. a label
    table): a left-semi join."""
    return hits.join(allowed.select(on).distinct(), on, "left_semi")
