"""Fuzzy search.

Every query token is a clause matching vocabulary terms within edit distance
``d`` (adjacent transposition costs 1); a document scores 1.0 per matching
clause (constant-score clauses, summed), so the score counts the query
tokens it matches.

Plan, all joins equi-joins, each distinct query token matched once:

1. of two strings within distance d both keep their matched characters when
   at most d are deleted from each, and the same holds for their first
   ``PREFIX`` characters (where the alignment leaves the one prefix, it has
   used up as many characters of the other). So each distinct prefix with 0,
   1 and 2 characters deleted, at most 29 strings however long the terms, is
   stored by its hash (``variants``), and joined by equality with those of
   the query tokens' prefixes, in their buckets only; then the vocabulary is
   joined by prefix.
2. lengths at most d apart and ``levenshtein(term, qterm, 2d) >= 0`` (JVM
   builtin with early exit). A Levenshtein distance within d is a match;
   only pairs above it, whose characters are nearly the same in another
   order, need the exact transposition distance.
3. the matched (token, term) pairs are written to the shared folder, so that
   Spark knows their size when it joins them with the postings (and prunes
   buckets where it broadcasts them).
4. a document counts once for each token, times the clauses of that token,
   summed per query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.distance import chars, osa_distance
from ..functions.tokenize import tokens
from ..schema import MAX_FUZZY_DISTANCE
from ..session import fresh_path
from .indexing import Index, prefix_of, term_bucket, variant_rows
from .search import HIT_COLS, _check_k, held_terms, in_slices, known, numbered, single_query, top_k


def _check_distance(d: int) -> None:
    if not isinstance(d, int) or d < 0 or d > MAX_FUZZY_DISTANCE:
        raise ValueError(f"distance must be an integer in 0..{MAX_FUZZY_DISTANCE}, got {d!r}")


def fuzzy_clauses(queries: DataFrame, tokenizer=tokens) -> DataFrame:
    """One clause per query token (repeats are separate clauses)."""
    return queries.select(
        F.col("query_id").cast("string").alias("query_id"),
        F.posexplode(tokenizer(F.col("query"))).alias("clause_id", "qterm"),
    )


def candidate_terms(index: Index, qterms: DataFrame, distance: int) -> DataFrame:
    """Stage 1: a superset of the vocabulary terms within ``distance`` of the
    distinct tokens ``qterms(qterm)``: ``qterm, bucket, term``."""
    _check_distance(distance)
    if distance == 0:
        return qterms.select("qterm", F.col("qterm").alias("term"), term_bucket(F.col("qterm"), index.n_buckets).alias("bucket")).join(
            index.term_stats.select("bucket", "term"), ["bucket", "term"]
        )
    asked = variant_rows(qterms, "qterm", distance, index.n_buckets)
    buckets = [r[0] for r in asked.select("bucket").distinct().collect()]  # n_buckets numbers at most
    known = index.table("variants", buckets).where(F.col("deleted") <= distance).select("bucket", "variant", "prefix")
    near = known.join(asked.select("bucket", "variant", F.col("prefix").alias("qprefix")), ["bucket", "variant"]).select("prefix", "qprefix").distinct()
    near = near.join(qterms.select("qterm", prefix_of(F.col("qterm")).alias("qprefix")), "qprefix").select("prefix", "qterm")
    vocab = index.term_stats.select("bucket", "term", prefix_of(F.col("term")).alias("prefix"))
    both = vocab.join(near, "prefix").select("qterm", "bucket", "term")
    return both.where(F.abs(F.char_length("term") - F.char_length("qterm")) <= distance)


def matched_terms(index: Index, qterms: DataFrame, distance: int) -> DataFrame:
    """Stage 2: the transposition distance of the candidates, once for each
    pair: ``qterm, bucket, term``."""
    cand = candidate_terms(index, qterms, distance)
    if distance > 0:
        cand = cand.withColumn("_l", F.levenshtein("term", "qterm", 2 * distance)).where("_l >= 0")
        cand = cand.withColumn("_ca", chars(F.col("term"))).withColumn("_cb", chars(F.col("qterm")))
        # below a Levenshtein distance there is a swap, so at most distance - 1
        # characters differ when order doesn't count: two edits each, if sorted
        alike = F.levenshtein(F.array_join(F.array_sort("_ca"), ""), F.array_join(F.array_sort("_cb"), ""), 2 * (distance - 1)) >= 0
        cand = cand.filter(F.when(F.col("_l") <= distance, F.lit(True)).when(alike, osa_distance("_ca", "_cb") <= distance).otherwise(F.lit(False)))
    return cand.select("qterm", "bucket", "term")


def fuzzy_hits(index: Index, queries: DataFrame, distance: int) -> DataFrame:
    """``HIT_COLS, score``: number of matching clauses per document."""
    index.check_open()
    clauses = fuzzy_clauses(queries, index.tokenizer).groupBy("query_id", "qterm").agg(F.count(F.lit(1)).alias("n"))
    path = fresh_path(index.spark, "matched")
    matched_terms(index, clauses.select("qterm").distinct(), distance).write.parquet(path)
    matched = index.spark.read.schema("qterm string, bucket int, term string").parquet(path)
    post = index.postings.select("bucket", "term", "doc_key", "id", "header_key", "copies")
    once = post.join(matched, ["bucket", "term"]).select("qterm", "doc_key", "id", "header_key", "copies").distinct()
    return once.join(clauses, "qterm").groupBy(*HIT_COLS).agg(F.sum("n").cast("double").alias("score"))


def search_fuzzy(index: Index, query: str, distance: int = 1, k: int = 5) -> DataFrame:
    """E4 for one query string -> ``rank, id, score``."""
    _check_k(k)
    _check_distance(distance)
    hits = fuzzy_hits(index, single_query(index.spark, query), distance)
    return top_k(hits, k, one_query=True).select("rank", "id", "score")


def search_fuzzy_batch(index: Index, queries: DataFrame, distance: int = 1, k: int = 5) -> DataFrame:
    """E4 for a table of queries, document by document: the matched terms'
    postings are dealt out by document once, the matches and the clauses are
    sent there, and only each task's best k of a query are shuffled."""
    index.check_open()
    _check_k(k)
    _check_distance(distance)
    spark = index.spark
    clauses = fuzzy_clauses(queries, index.tokenizer).groupBy("query_id", "qterm").agg(F.count(F.lit(1)).alias("n"))
    asked = numbered(spark, clauses.select("qterm"), "q")
    clauses = known(spark, clauses.join(asked, "qterm").select("query_id", "q", "n"))
    matched = known(spark, matched_terms(index, asked.select("qterm"), distance).join(asked, "qterm").select("q", "bucket", "term"))
    terms = numbered(spark, matched.select("bucket", "term"), "t")
    matched = known(spark, matched.join(terms, ["bucket", "term"]).join(index.term_stats.select("bucket", "term", "df"), ["bucket", "term"]).select("t", "q", "df"))
    per_token = matched.groupBy("q").agg(F.sum("df").alias("df"))
    matches = clauses.join(per_token, "q").agg(F.sum("df")).first()[0] or 0
    matched = matched.select("t", "q")

    def best(mine: DataFrame, n: int) -> DataFrame:
        pairs = matched.join(mine.select("q").distinct(), "q", "left_semi")
        once = held_terms(index, terms, n).join(F.broadcast(pairs), "t").select("q", "doc_key", "id", "copies").distinct()
        hits = once.join(F.broadcast(mine), "q").groupBy("query_id", "doc_key", "id", "copies").agg(F.sum("n").cast("double").alias("score"))
        return top_k(hits, k)

    return in_slices(index, clauses, max(clauses.count(), matched.count()), int(matches), best).select("query_id", "rank", "id", "score")
