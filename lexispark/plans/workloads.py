"""The registered queries: each reads the given tables at ``sf_dir`` and runs
one operator of the inventory over the whole tables.

Every function takes ``(spark, sf_dir)`` and returns a DataFrame whose
columns are named exactly as in the matching SQL of ``plans.oracle``.
Scores are rounded to 6 digits for comparison.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.tokenize import is_cjk, lowercase_tokens, runs, token_table_with_offsets, tokens
from ..operators import changes as C
from ..operators import facets as FC
from ..operators import fuzzy as FZ
from ..operators import search as S
from ..operators.indexing import Index, build_index, corpus_stats_df
from ..sources.tables import (
    benchmark_queries,
    cjk_documents_corpus,
    documents_corpus,
    table,
)
from ..session import fresh_path, path_exists
from ..sources.corpus import Corpus
from ..sources.tables import conversations_corpus, pages_corpus, user_turn_queries
from ..streaming.maintain import change_stream, maintain
from . import query as Q

#: fixed query strings of the registered searches
BM25_QUERY = "the and anble"
PHRASE_QUERY = "of the"
CJK_QUERY = "北京 天気 学校"
TOP_K = 10
FUZZY_D1_QUERY = "thtion anble"
FUZZY_D2_QUERY = "thtion"
DELETED_HEADER = "en"


#: the corpora that registered queries search, by name
CORPORA = {
    "documents": documents_corpus,
    "cjk": cjk_documents_corpus,
    "conversations": conversations_corpus,
    "pages": pages_corpus,
}
_STORED: dict[tuple[str, str, str], str] = {}


def stored(spark: SparkSession, sf_dir: str, name: str = "documents") -> Index:
    """The stored index of a corpus: built once a session, then read."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STORED or not path_exists(spark, _STORED[key]):
        path = fresh_path(spark, f"corpus-{name}")
        Corpus(spark, path, create=True).rebuild(CORPORA[name](spark, sf_dir))
        _STORED[key] = path
    return Corpus(spark, _STORED[key]).index()


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumn("score", F.round("score", 6))


# ---- C: tokens --------------------------------------------------------------


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = documents_corpus(spark, sf_dir)
    t = d.select("id", "header_key", tokens("text").alias("toks"))
    return t.select(
        "id",
        "header_key",
        F.size("toks").cast("long").alias("n_tokens"),
        F.size(F.array_distinct("toks")).cast("long").alias("n_terms"),
    )


def token_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = documents_corpus(spark, sf_dir)
    return token_table_with_offsets(d, ["id"])


def cjk_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = cjk_documents_corpus(spark, sf_dir)
    idx = build_index(d)
    return idx.term_stats.select("term", F.col("df").cast("long").alias("df"), F.col("cf").cast("long").alias("cf"))


# ---- D: index tables --------------------------------------------------------


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    idx = build_index(documents_corpus(spark, sf_dir))
    return idx.postings.select(
        "term",
        "id",
        F.col("tf").cast("long").alias("tf"),
        F.array_join(F.transform("positions", lambda p: p.cast("string")), ",").alias("positions"),
    )


def term_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    idx = stored(spark, sf_dir)
    return idx.term_stats.select("term", F.col("df").cast("long").alias("df"), F.col("cf").cast("long").alias("cf"))


def doc_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    idx = stored(spark, sf_dir)
    return S.all_hits(idx.doc_stats.withColumn("query_id", F.lit("q"))).select(
        "id", "header_key", F.col("dl").cast("long").alias("dl")
    )


def corpus_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    idx = stored(spark, sf_dir)
    return corpus_stats_df(idx.doc_stats).select(
        "n_docs", "total_tokens", F.round("avgdl", 6).alias("avgdl")
    )


# ---- E: searches ------------------------------------------------------------


def bm25_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    idx = stored(spark, sf_dir)
    return _rounded(S.search(idx, BM25_QUERY, TOP_K))


def bm25_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    idx = stored(spark, sf_dir)
    return _rounded(S.search_batch(idx, benchmark_queries(spark, sf_dir), TOP_K))


def cjk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    idx = stored(spark, sf_dir, "cjk")
    return _rounded(S.search(idx, CJK_QUERY, TOP_K))


def phrase_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document holding the phrase, with its occurrences and score."""
    idx = stored(spark, sf_dir)
    hits = S.phrase_hits(idx, PHRASE_QUERY)
    return _rounded(S.all_hits(hits).select("id", "occurrences", "score"))




# ---- E5/E7/E9 ---------------------------------------------------------------


def facets(spark: SparkSession, sf_dir: str) -> DataFrame:
    idx = stored(spark, sf_dir)
    return FC.facet_counts(S.search_hits(idx, BM25_QUERY)).select("header_key", "count")


def result_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    idx = stored(spark, sf_dir)
    top = S.search(idx, BM25_QUERY, TOP_K).withColumn("query_id", F.lit("q"))
    m = S.as_map(top)
    return _rounded(m.select(F.explode("results").alias("id", "score")))


# ---- E4 ---------------------------------------------------------------------


def _fuzzy_all(spark: SparkSession, sf_dir: str, text: str, d: int) -> DataFrame:
    idx = stored(spark, sf_dir)
    hits = FZ.fuzzy_hits(idx, S.single_query(spark, text), d)
    return S.all_hits(hits).select("id", "score")


def fuzzy_search_d1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fuzzy_all(spark, sf_dir, FUZZY_D1_QUERY, 1)


def fuzzy_search_d2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fuzzy_all(spark, sf_dir, FUZZY_D2_QUERY, 2)


def fuzzy_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    idx = stored(spark, sf_dir)
    return FZ.search_fuzzy(idx, FUZZY_D1_QUERY, 1, TOP_K)


# ---- B: data change ---------------------------------------------------------


def conversation_upserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation turn re-files document ``conv_id``: id = conv_id,
    header_key = role, text = the turn, seq = conv_id * 1000 + turn."""
    c = table(spark, sf_dir, "conversations")
    return c.select(
        (F.col("conv_id") * 1000 + F.col("turn")).cast("long").alias("seq"),
        F.col("conv_id").cast("string").alias("id"),
        F.coalesce(F.col("role"), F.lit("")).alias("header_key"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )


def conversation_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A change feed from ``conversations``: user / assistant turns upsert
    document ``conv_id``; a system turn retracts every ``assistant`` document
    filed so far (delete by category)."""
    u = conversation_upserts(spark, sf_dir)
    is_sys = F.col("header_key") == "system"
    return u.select(
        "seq",
        F.when(is_sys, F.lit("delete_header")).otherwise(F.lit("upsert")).alias("op"),
        F.when(is_sys, F.lit(None).cast("string")).otherwise(F.col("id")).alias("id"),
        F.when(is_sys, F.lit("assistant")).otherwise(F.col("header_key")).alias("header_key"),
        F.when(is_sys, F.lit(None).cast("string")).otherwise(F.col("text")).alias("text"),
    )


def _corpus_digest(df: DataFrame) -> DataFrame:
    return df.select("id", "header_key", F.md5("text").alias("text_md5"))


def upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _corpus_digest(C.upsert(documents_corpus(spark, sf_dir), conversation_upserts(spark, sf_dir)))


def delete_by_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delete one language, then search the rest (statistics follow)."""
    rest = C.delete_by_header(documents_corpus(spark, sf_dir), [DELETED_HEADER])
    return _rounded(S.search(build_index(rest), BM25_QUERY, TOP_K))


def change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _corpus_digest(C.apply_changes(documents_corpus(spark, sf_dir), conversation_changes(spark, sf_dir)))


# ---- F: composed queries ----------------------------------------------------


def _all(spark: SparkSession, sf_dir: str, query: Q.Query) -> DataFrame:
    idx = stored(spark, sf_dir)
    return _rounded(Q.run(idx, query, k=None))


COMPOSED = {
    "bool_must": Q.Bool(must=(Q.Match("the"), Q.Match("and")), should=(Q.Match("anble"),)),
    "bool_must_not": Q.Bool(should=(Q.Match("the"),), must_not=(Q.Match("and"),)),
    "bool_nested": Q.Bool(
        must=(Q.Bool(should=(Q.Match("of"), Q.Match("anble"))),),
        must_not=(Q.Bool(must=(Q.Match("the"), Q.Match("in"))),),
    ),
    "field_term": Q.Bool(must=(Q.Field("header_key", "fr"),), should=(Q.Match("le"),)),
    "quoted_phrase_clause": Q.Bool(should=(Q.Phrase("of the"), Q.Match("and"))),
    "boost": Q.Bool(should=(Q.Boost(Q.Match("the"), 2.0), Q.Match("and"))),
    "range_keyword": Q.Bool(must=(Q.Range("header_key", "de", "es", True, False),), should=(Q.Match("the"),)),
    "range_term": Q.Range("text", "thea", "then"),
    "in_set": Q.Bool(must=(Q.InSet("header_key", ("fr", "es")),), should=(Q.Match("la"),)),
    "match_all": Q.MatchAll(),
    "phrase_prefix": Q.Phrase("of th", prefix=True),
    "phrase_slop": Q.Phrase("of in", slop=3),
    "phrase_slop_three": Q.Phrase("the of and", slop=8),
    "in_set_text": Q.InSet("text", ("anble", "thtion")),
}


def _composed(name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _all(spark, sf_dir, COMPOSED[name])

    run.__name__ = name
    return run


# ---- A / G1: durable corpus, versions, stream --------------------------------

STREAM_BATCHES = 3


def corpus_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 + A3 + A5: build a durable corpus version from ``documents`` and
    search the committed snapshot."""
    c = Corpus(spark, fresh_path(spark, "corpus"), create=True)
    c.rebuild(documents_corpus(spark, sf_dir))
    return _rounded(c.search(BM25_QUERY, TOP_K))


def open_or_create(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: create, fill with ``conversations``, open again from the path and
    read the statistics there."""
    path = fresh_path(spark, "corpus")
    Corpus(spark, path, create=True).rebuild(conversations_corpus(spark, sf_dir))
    return corpus_stats_df(Corpus(spark, path).index().doc_stats).withColumn("avgdl", F.round("avgdl", 6))


def snapshot_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: version 1 (``documents``) stays readable after version 2 (the
    conversation change feed) commits; documents per header_key in both."""
    c = Corpus(spark, fresh_path(spark, "corpus"), create=True)
    c.rebuild(documents_corpus(spark, sf_dir))
    v1 = c.current_version()
    c.apply_changes(conversation_changes(spark, sf_dir))
    v2 = c.current_version()
    parts = [
        S.all_hits(c.index(v).doc_stats.withColumn("query_id", F.lit("q")))
        .groupBy("header_key")
        .agg(F.count(F.lit(1)).alias("n_docs"))
        .withColumn("version", F.lit(i + 1))
        for i, v in enumerate([v1, v2])
    ]
    return parts[0].unionByName(parts[1]).select("version", "header_key", "n_docs")


def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1: the conversation change feed arrives as files in ``seq`` order;
    each arrival is drained by an ``availableNow`` run of the maintenance
    stream (restarting from its checkpoint). Equal to the batch feed."""
    changes = conversation_changes(spark, sf_dir)
    # approximate cut points are enough: they only split the feed into arrivals
    cuts = changes.approxQuantile("seq", [i / STREAM_BATCHES for i in range(1, STREAM_BATCHES)], 0.01)
    bounds = [None, *cuts, None]
    base = fresh_path(spark, "stream")
    c = Corpus(spark, f"{base}/corpus", create=True)
    c.rebuild(documents_corpus(spark, sf_dir))
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        part = changes
        if lo is not None:
            part = part.filter(F.col("seq") > lo)
        if hi is not None:
            part = part.filter(F.col("seq") <= hi)
        part.write.mode("append").parquet(f"{base}/changes")
        q = maintain(c, change_stream(spark, f"{base}/changes"), f"{base}/checkpoint")
        q.awaitTermination()
    return _corpus_digest(c.documents())


SHUFFLED_BATCHES = 4


def shuffled_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B3 out of order: the feed's changes are dealt to batches by a hash, so
    each commit holds changes older than those of earlier commits. Equal to
    the one-by-one replay; the parts are folded between two of them, and one
    batch comes twice."""
    changes = conversation_changes(spark, sf_dir)
    c = Corpus(spark, fresh_path(spark, "corpus"), create=True)
    c.rebuild(documents_corpus(spark, sf_dir))
    for i in range(SHUFFLED_BATCHES):
        batch = changes.where(F.pmod(F.xxhash64("seq"), F.lit(SHUFFLED_BATCHES)) == i)
        c.apply_changes(batch)
        if i == 1:
            c.compact()
            c.apply_changes(batch)
    return _corpus_digest(c.documents())


def refused_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6 + E10: calls that must raise, as rows (call, error, n_docs)."""
    c = Corpus(spark)
    c.rebuild(documents_corpus(spark, sf_dir))
    held = c.index()
    n_docs = c.stats().n_docs
    calls = {
        "top_k of 0": lambda: c.search(BM25_QUERY, 0),
        "distance of 3": lambda: c.search_fuzzy(BM25_QUERY, 3, TOP_K),
        "distance of -1": lambda: c.search_fuzzy(BM25_QUERY, -1, TOP_K),
        "only must_not": lambda: c.query(Q.Bool(must_not=(Q.Match("the"),))),
        "search after close": lambda: (c.close(), c.close(), c.search(BM25_QUERY, TOP_K)),
        "change after close": lambda: c.remove_by_header(DELETED_HEADER),
        "snapshot after close": lambda: S.search(held, BM25_QUERY, TOP_K),
    }
    rows = []
    for name, call in calls.items():
        try:
            call()
            rows.append((name, "none", n_docs))
        except (ValueError, RuntimeError) as e:
            rows.append((name, type(e).__name__, n_docs))
    return spark.createDataFrame(rows, "call string, error string, n_docs long")


# ---- more corpora / query tables ---------------------------------------------

CONVERSATION_K = 5


def conversation_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E11 on the second corpus: every user turn of ``conversations`` is a
    query against all turns; top 5 each."""
    idx = stored(spark, sf_dir, "conversations")
    return _rounded(S.search_batch(idx, user_turn_queries(spark, sf_dir), CONVERSATION_K))


def filtered_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """BM25 restricted to documents labelled good quality (``labels`` as the
    join target), top 10."""
    idx = stored(spark, sf_dir)
    good = table(spark, sf_dir, "labels").filter(F.col("quality") == 1).select(
        F.col("doc_id").cast("string").alias("id")
    )
    hits = S.restrict(S.search_hits(idx, BM25_QUERY), good)
    return _rounded(S.top_k(hits, TOP_K).select("rank", "id", "score"))


def fuzzy_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E4 + E11: every ``benchmark`` text as a fuzzy query (distance 1)."""
    idx = stored(spark, sf_dir)
    return FZ.search_fuzzy_batch(idx, benchmark_queries(spark, sf_dir), 1, TOP_K)


PAGES_QUERY = "the and"


def pages_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E1 on the markup corpus: whole raw pages as documents, top 10."""
    idx = stored(spark, sf_dir, "pages")
    return _rounded(S.search(idx, PAGES_QUERY, TOP_K))


# ---- more operators ------------------------------------------------------------


def cjk_characters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every character of the CJK corpus with its class."""
    d = cjk_documents_corpus(spark, sf_dir)
    ch = d.select(F.explode(F.split("text", "")).alias("ch")).where("ch <> ''").groupBy("ch").agg(F.count(F.lit(1)).alias("n"))
    return ch.select("ch", "n", is_cjk("ch").alias("cjk"))


def text_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs of every text of the CJK corpus."""
    d = cjk_documents_corpus(spark, sf_dir).select("id", runs("text").alias("r"))
    return d.select("id", F.size("r").cast("long").alias("n_runs"), F.md5(F.array_join("r", "|")).alias("runs_md5"))


def token_table_cjk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C6 on CJK text: bigrams, multi-byte offsets."""
    return token_table_with_offsets(cjk_documents_corpus(spark, sf_dir), ["id"])


def stored_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 as stored: one row per (term, document) of the committed version."""
    return stored(spark, sf_dir).postings.select(
        "term", "id", F.col("tf").cast("long").alias("tf"), F.array_join(F.transform("positions", lambda p: p.cast("string")), ",").alias("positions")
    )


def blank_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A blank query finds nothing."""
    return _rounded(S.search(stored(spark, sf_dir), "  ", TOP_K))


def blank_in_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C9 among others: results per query of a table that holds blank ones."""
    asked = benchmark_queries(spark, sf_dir)
    blank = asked.select(F.concat(F.lit("blank-"), "query_id").alias("query_id"), F.lit(" \u3000 ").alias("query"))
    found = S.search_batch(stored(spark, sf_dir), asked.unionByName(blank), TOP_K).groupBy("query_id").agg(F.count(F.lit(1)).alias("n"))
    both = asked.unionByName(blank).select("query_id").distinct()
    return both.join(found, "query_id", "left").select("query_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_results"))


LOWERCASE_QUERY = "THE And anble"


def analyzer_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A corpus with another analyzer (lower case)."""
    c = Corpus(spark, fresh_path(spark, "corpus"), tokenizer=lowercase_tokens, create=True)
    c.rebuild(documents_corpus(spark, sf_dir))
    return _rounded(c.search(LOWERCASE_QUERY, TOP_K))


def ephemeral_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: the ephemeral corpus."""
    c = Corpus(spark)
    c.rebuild(documents_corpus(spark, sf_dir))
    return _rounded(c.search(BM25_QUERY, TOP_K))


def truncated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: documents before and after the corpus is emptied."""
    c = Corpus(spark, fresh_path(spark, "corpus"), create=True)
    c.rebuild(documents_corpus(spark, sf_dir))
    before = c.index().docs.agg(F.count(F.lit(1)).alias("n_docs")).withColumn("version", F.lit(1))
    c.truncate()
    return before.unionByName(c.index().docs.agg(F.count(F.lit(1)).alias("n_docs")).withColumn("version", F.lit(2)))


def search_facets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E5: results and facets of one scoring."""
    r = FC.search_with_facets(stored(spark, sf_dir), BM25_QUERY, TOP_K, persist=False)
    res = _rounded(r.results).select(F.lit("result").alias("kind"), "rank", F.col("id").alias("name"), "score", F.lit(None).cast("long").alias("count"))
    return res.unionByName(r.facets.select(F.lit("facet").alias("kind"), F.lit(None).cast("int").alias("rank"), F.col("header_key").alias("name"), F.lit(None).cast("double").alias("score"), "count"))


def phrase_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E3, best k."""
    return _rounded(S.search_phrase(stored(spark, sf_dir), PHRASE_QUERY, TOP_K))


def phrase_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E3 + E11: every benchmark text as one phrase."""
    return _rounded(S.phrase_search_batch(stored(spark, sf_dir), benchmark_queries(spark, sf_dir), TOP_K))


REPEATED_QUERY = "the and"


def repeated_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: ids may repeat (``conv_id``: one for all its turns); every row is
    a document of its own."""
    turns = conversations_corpus(spark, sf_dir).withColumn("id", F.regexp_replace("id", "-[0-9]+$", ""))
    c = Corpus(spark, fresh_path(spark, "corpus"), create=True)
    c.rebuild(turns)
    return _rounded(S.all_hits(S.search_hits(c.index(), REPEATED_QUERY)).select("id", "score"))


def search_after_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B3 + E1: the change feed on a durable corpus, then a search."""
    c = Corpus(spark, fresh_path(spark, "corpus"), create=True)
    c.rebuild(documents_corpus(spark, sf_dir))
    c.apply_changes(conversation_changes(spark, sf_dir))
    return _rounded(c.search(BM25_QUERY, TOP_K))


REGISTRY = {
    "cjk_characters": cjk_characters,
    "text_runs": text_runs,
    "token_table_cjk": token_table_cjk,
    "stored_postings": stored_postings,
    "blank_search": blank_search,
    "blank_in_batch": blank_in_batch,
    "refused_calls": refused_calls,
    "shuffled_feed": shuffled_feed,
    "analyzer_search": analyzer_search,
    "ephemeral_search": ephemeral_search,
    "truncated": truncated,
    "search_facets": search_facets,
    "phrase_top10": phrase_top10,
    "phrase_batch": phrase_batch,
    "repeated_ids": repeated_ids,
    "search_after_changes": search_after_changes,
    "token_counts": token_counts,
    "token_table": token_table,
    "cjk_tokens": cjk_tokens,
    "postings": postings,
    "term_df": term_df,
    "doc_length": doc_length,
    "corpus_stats": corpus_stats,
    "bm25_search": bm25_search,
    "bm25_batch": bm25_batch,
    "cjk_search": cjk_search,
    "phrase_search": phrase_search,
    "facets": facets,
    "result_map": result_map,
    "fuzzy_search_d1": fuzzy_search_d1,
    "fuzzy_search_d2": fuzzy_search_d2,
    "fuzzy_top10": fuzzy_top10,
    "upsert": upsert,
    "delete_by_header": delete_by_header,
    "change_feed": change_feed,
    **{name: _composed(name) for name in COMPOSED},
    "corpus_rebuild": corpus_rebuild,
    "open_or_create": open_or_create,
    "snapshot_read": snapshot_read,
    "stream_upsert": stream_upsert,
    "conversation_search": conversation_search,
    "filtered_search": filtered_search,
    "fuzzy_batch": fuzzy_batch,
    "pages_search": pages_search,
}
