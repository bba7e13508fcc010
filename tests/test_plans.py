"""The physical plans keep the properties the design relies on at scale."""

import io
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from lexispark.operators import search as S
from lexispark.operators.indexing import build_index, postings_of, with_doc_key, with_terms
from lexispark.session import fresh_path
from lexispark.sources.corpus import Corpus
from lexispark.sources.tables import benchmark_queries, documents_corpus

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def stored(spark):
    c = Corpus(spark, fresh_path(spark, "plans"), create=True)
    c.rebuild(documents_corpus(spark, SF))
    return c.index()


def test_single_search_prunes_buckets_and_pushes_terms(stored):
    p = plan(S.search(stored, "the and anble", 10))
    assert "PartitionFilters: [bucket" in p and " IN (" in p
    assert "PushedFilters: [In(term, [anble,and,the])" in p
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p
    # positions are not read for term clauses
    assert "positions" not in [ln for ln in p.splitlines() if ln.startswith("ReadSchema")][0]


def test_batch_prunes_pairs_and_limits_before_the_shuffle(spark, stored):
    p = plan(S.search_batch(stored, benchmark_queries(spark, SF), 10))
    tree = p.split("\n\n")[0]
    assert "WindowGroupLimit" in tree  # partial below the exchange, final above
    lines = tree.splitlines()
    partial = max(i for i, ln in enumerate(lines) if "WindowGroupLimit" in ln)
    assert any("Exchange" in ln for ln in lines[:partial])
    assert "positions" not in "".join(ln for ln in p.splitlines() if ln.startswith("ReadSchema"))  # term clauses don't read them


def test_postings_build_has_no_token_shuffle(spark):
    p = plan(postings_of(with_terms(with_doc_key(documents_corpus(spark, SF))), 64, copies_possible=False))
    tree = p.split("\n\n")[0]
    assert "Exchange" not in tree and "HashAggregate" not in tree


def test_building_an_index_starts_no_job(spark):
    docs = documents_corpus(spark, SF).join(spark.range(3), "id", "left_anti").groupBy("id", "header_key", "text").count()
    spark.sparkContext.setJobGroup("lazy", "lazy")
    try:
        build_index(docs.select("id", "header_key", "text"))
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("lazy")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_large_k_has_no_single_task_window_over_all_hits(stored, spark):
    tree = plan(S.search(stored, "the and", 5000)).split("\n\n")[0]
    assert "TakeOrdered" in tree or "LocalLimit" in tree or "GlobalLimit" in tree
    many = plan(S.search_batch(stored, benchmark_queries(spark, SF), 5000))
    assert many.count("pmod(xxhash64") >= 1


def test_sloppy_and_prefix_phrases_are_pruned(stored):
    from lexispark.plans import query as Q

    p = plan(Q.run(stored, Q.Phrase("of in", slop=3), k=None))
    assert "PartitionFilters: [bucket" in p and "In(term, [in,of])" in p
    p = plan(Q.run(stored, Q.Phrase("of th", prefix=True), k=None))
    assert "StringStartsWith(term,th)" in p and "EqualTo(term,of)" in p and "(bucket#" in p


def test_no_token_filter_pushed_into_the_scan(spark):
    idx = build_index(documents_corpus(spark, SF))
    p = plan(S.search_hits(idx, "of the"))
    scans = [ln for ln in p.splitlines() if "DataFilters" in ln or ln.startswith("PushedFilters")]
    assert not any("size(" in ln for ln in scans)


def test_text_range_is_pushed_to_the_postings_scan(stored):
    from lexispark.plans import query as Q

    p = plan(Q.run(stored, Q.Range("text", "thea", "then"), k=None))
    pushed = [ln for ln in p.splitlines() if ln.startswith("PushedFilters")]
    assert any("GreaterThanOrEqual(term,thea)" in ln and "LessThanOrEqual(term,then)" in ln for ln in pushed)


def test_results_and_facets_share_one_scoring(spark, stored):
    from lexispark.operators import facets as FC

    r = FC.search_with_facets(stored, "the and", 5, persist=False)
    both = r.results.selectExpr("id", "score", "cast(null as long) n").unionByName(r.facets.selectExpr("header_key id", "cast(null as double) score", "count n"))
    both.collect()
    ran = both._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in ran and ran.count("FileScan") <= 2  # postings and their term statistics, once


def test_ranges_and_prefixes_open_the_buckets_of_their_terms(spark, stored):
    from lexispark.plans import query as Q

    every = len({f.split("/bucket=")[1].split("/")[0] for f in stored.postings.inputFiles()})
    opened = Q._postings_where(stored, F.col("term").startswith("anble")).inputFiles()
    few = {f.split("/bucket=")[1].split("/")[0] for f in opened}
    assert 0 < len(few) < every / 2
    assert Q._postings_where(stored, F.col("term") > "\U0010ffff").inputFiles() == []


def test_batch_prunes_term_queries_beside_a_phrase(spark, stored):
    asked = spark.createDataFrame([("a", "the and anble thtion"), ("b", "of in there"), ("c", "北京 the")], "query_id string, query string")
    clauses = S.literal_clauses(asked)
    kinds = {r.kind for r in clauses.select("kind").distinct().collect()}
    assert kinds == {"term", "phrase"}
    p = plan(S.sum_by_doc(S.pruned_hits(stored, clauses, 3, kinds)))
    assert "weak" in p and "floor" not in p  # the floor is found before, clauses are split by it
    got = {(r.query_id, r.id): round(r.score, 9) for r in S.search_batch(stored, asked, 3).collect()}
    want = {(q.query_id, r.id): round(r.score, 9) for q in asked.collect() for r in S.search(stored, q.query, 3).collect()}
    assert got == want


def test_fuzzy_candidates_are_few(stored):
    from lexispark.operators import fuzzy as FZ

    terms = stored.term_stats
    asked = terms.where("term_len between 4 and 12").orderBy("term").limit(4000).where(F.xxhash64("term") % 20 == 0).select(F.col("term").alias("qterm"))
    n, cand = asked.count(), FZ.candidate_terms(stored, asked, 2)
    assert n > 50 and cand.count() < 0.01 * n * terms.count()
    found = FZ.matched_terms(stored, asked, 2)
    every = terms.crossJoin(asked).where(F.levenshtein("term", "qterm", 2) >= 0).select("qterm", "bucket", "term")  # in a test, on few rows
    assert every.join(found, ["qterm", "term"], "left_anti").count() == 0


def test_each_piece_of_the_documents_has_a_task_of_its_own(spark):
    c = Corpus(spark, fresh_path(spark, "pieces"), create=True, doc_bucket_bytes=20_000)
    c.rebuild(documents_corpus(spark, SF))
    files = c._part(c._read(c._last())["parts"][0])["files"]["docs"]
    tasks = [f.split("part-")[1].split("-")[0] for names in files.values() for f in names]
    assert len(tasks) > 8 and len(set(tasks)) == len(tasks)
