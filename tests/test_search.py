"""E1-E11 on small corpora; expected scores follow from the BM25 formula."""

import math
import re

import pytest
from pyspark.sql import functions as F

from lexispark.operators import facets as FC
from lexispark.operators import fuzzy as FZ
from lexispark.operators import search as S

from .conftest import ids, rows

TREES = [
    ("t1", "leaf", "oak ash oak elm"),
    ("t2", "leaf", "elm ash"),
    ("t3", "pine", "larch ash spruce fir yew"),
    ("t4", "pine", "fir oak"),
    ("t5", "palm", "date"),
]


def bm25(docs, clauses):
    """{id: score}: clauses are lists of tokens that stand together."""
    texts = {i: t.split() for i, _, t in docs}
    n, avg = len(texts), sum(map(len, texts.values())) / len(texts)
    weight = lambda t: math.log(1 + (n - (d := sum(t in x for x in texts.values())) + 0.5) / (d + 0.5))
    out = {}
    for c in clauses:
        for i, x in texts.items():
            tf = sum(x[a : a + len(c)] == c for a in range(len(x)))
            if tf:
                out[i] = out.get(i, 0) + sum(map(weight, c)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(x) / avg))
    return out


def scores(df):
    return {r.id: pytest.approx(r.score, abs=1e-9) for r in df.collect()}


def test_scores_and_order(corpus):
    idx = corpus(TREES)
    want = bm25(TREES, [["oak"], ["ash"]])
    assert scores(S.search(idx, "oak ash", 10)) == want
    best = sorted(want, key=lambda i: (-want[i], i))
    assert ids(S.search(idx, "oak ash", 2)) == best[:2]
    assert ids(S.search(idx, "birch", 5)) == [] and ids(S.search(idx, "Oak", 5)) == []


def test_cjk_words_are_phrases(corpus):
    idx = corpus([("1", "k", "春の山道を歩く"), ("2", "k", "山の道"), ("3", "k", "겨울 바다 여행")])
    assert ids(S.search(idx, "山道", 5)) == ["1"]
    assert sorted(ids(S.search(idx, "山", 5))) == ["1", "2"] and ids(S.search(idx, "바다", 5)) == ["3"]


def test_phrases(corpus):
    docs = [("1", "a", "go go go slow"), ("2", "a", "go   slow"), ("3", "a", "slow go")]
    idx = corpus(docs)
    assert scores(S.search_phrase(idx, "go slow", 5)) == bm25(docs, [["go", "slow"]])
    assert {r.id: r.occurrences for r in S.phrase_hits(idx, "go go").collect()} == {"1": 2}


def test_blank_queries_have_the_schema(corpus):
    idx = corpus(TREES)
    for q in ("", " \n "):
        df = S.search(idx, q, 5)
        assert df.columns == ["rank", "id", "score"] and df.count() == 0
    assert S.search_phrase(idx, "", 5).count() == 0 and FZ.search_fuzzy(idx, "", 1, 5).count() == 0


def test_argument_checks(corpus):
    idx = corpus(TREES)
    for call in (lambda: S.search(idx, "oak", 0), lambda: FZ.search_fuzzy(idx, "oak", 3), lambda: FZ.search_fuzzy(idx, "oak", -1)):
        with pytest.raises(ValueError):
            call()


def distance(a, b):
    """Edit distance with swaps of neighbours, by memoised recursion."""
    from functools import cache

    @cache
    def d(i, j):
        if not i or not j:
            return i + j
        best = min(d(i - 1, j) + 1, d(i, j - 1) + 1, d(i - 1, j - 1) + (a[i - 1] != b[j - 1]))
        if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
            best = min(best, d(i - 2, j - 2) + 1)
        return best

    return d(len(a), len(b))


@pytest.mark.parametrize("most", [0, 1, 2])
def test_fuzzy_against_all_pairs(corpus, most):
    import random

    rng = random.Random(most)
    make = lambda: "".join(rng.choices("abé", k=rng.randint(1, 9)))
    docs = [(f"{i:03}", "k", " ".join(make() for _ in range(4))) for i in range(60)]
    idx = corpus(docs)
    query = " ".join(make() for _ in range(5))
    want = {}
    for i, _, text in docs:
        n = sum(any(distance(q, t) <= most for t in text.split()) for q in query.split())
        if n:
            want[i] = n
    assert {r.id: r.score for r in FZ.search_fuzzy(idx, query, most, 100).collect()} == want


def test_fuzzy_batch(corpus, spark):
    idx = corpus([("1", "a", "garden table lamp"), ("2", "a", "gardens wall")])
    qs = spark.createDataFrame([("x", "gardne"), ("y", "lmap tabel")], "query_id string, query string")
    got = {(r.query_id, r.id, r.score) for r in FZ.search_fuzzy_batch(idx, qs, 1, 5).collect()}
    assert got == {("x", "1", 1.0), ("y", "1", 2.0)}
    assert ids(FZ.search_fuzzy(idx, "gardne", 2, 5)) == ["1", "2"]


def test_facets_count_every_match(corpus):
    idx = corpus(TREES)
    r = FC.search_with_facets(idx, "ash oak", 1)
    assert len(ids(r.results)) == 1 and dict(rows(r.facets)) == {"leaf": 2, "pine": 2}
    r.release()


def test_copies_and_ties(corpus):
    idx = corpus([("b", "k", "same words"), ("b", "k", "same words"), ("a", "k", "same words")])
    r = S.search(idx, "same", 5).collect()
    assert [x.id for x in r] == ["a", "b", "b"] and len({x.score for x in r}) == 1


def test_batch_equals_single_searches(corpus, spark):
    """Also where the score bounds leave pairs out."""
    import random

    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(60)]
    docs = [(f"{i:03}", "k", " ".join(["the"] * rng.randint(0, 3) + rng.choices(vocabulary, k=rng.randint(1, 12), weights=[60 // (j + 1) + 1 for j in range(60)]))) for i in range(150)]
    idx = corpus(docs)
    queries = [(f"q{i}", " ".join(["the", *rng.choices(vocabulary, k=5), "w59"])) for i in range(8)] + [("blank", " "), ("none", "zzz")]
    got = S.search_batch(idx, spark.createDataFrame(queries, "query_id string, query string"), 3).collect()
    for qid, q in queries:
        want = [(r.id, pytest.approx(r.score, abs=1e-9)) for r in S.search(idx, q, 3).collect()]
        assert [(r.id, r.score) for r in sorted((r for r in got if r.query_id == qid), key=lambda r: r.rank)] == want


def test_batch_with_phrases(corpus, spark):
    idx = corpus([("1", "k", "山道 oak"), ("2", "k", "山 道 oak")])
    qs = spark.createDataFrame([("x", "山道"), ("y", "oak")], "query_id string, query string")
    assert sorted((r.query_id, r.id) for r in S.search_batch(idx, qs, 5).collect()) == [("x", "1"), ("y", "1"), ("y", "2")]
    phrases = S.phrase_search_batch(idx, spark.createDataFrame([("p", "山 道")], "query_id string, query string"), 5)
    assert [r.id for r in phrases.collect()] == ["2"]  # in the other the pair 山道 stands between


def test_large_k(corpus, spark):
    idx = corpus([(f"{i:04}", "k", "word " * (i % 7 + 1)) for i in range(1500)])
    one = ids(S.search(idx, "word", 1200))
    assert len(one) == 1200 and len(set(one)) == 1200
    many = S.search_batch(idx, spark.createDataFrame([("x", "word")], "query_id string, query string"), 1200)
    assert [r.id for r in many.orderBy("rank").collect()] == one


def test_long_queries_take_the_table_form(corpus):
    idx = corpus(TREES)
    filler = " ".join(f"n{i}" for i in range(3000))
    assert len(filler) > S.LONGEST_LITERAL
    assert scores(S.search(idx, f"oak {filler} ash", 10)) == bm25(TREES, [["oak"], ["ash"]])


def test_repeated_words_count_twice(corpus):
    idx = corpus(TREES)
    assert scores(S.search(idx, "oak elm oak", 5)) == bm25(TREES, [["oak"], ["elm"], ["oak"]])


def test_result_map_and_restriction(corpus, spark):
    idx = corpus(TREES)
    m = S.as_map(S.search(idx, "oak", 5).withColumn("query_id", F.lit("q"))).first().results
    assert set(m) == {"t1", "t4"}
    allowed = spark.createDataFrame([("t4",), ("t3",)], "id string")
    assert ids(S.top_k(S.restrict(S.search_hits(idx, "oak"), allowed), 5)) == ["t4"]


def test_fuzzy_batch_like_single_queries(spark, corpus, monkeypatch):
    docs = [(str(i), "h", t) for i, t in enumerate(["oak ash oka", "aok elm", "ash ahs oaks", "oak ash oka", "elm", "larch oak oak"])]
    idx = corpus([*docs, docs[0]])  # an exact copy counts by itself
    asked = [("a", "oak ash"), ("b", "oak oak elm"), ("c", "zzzzzz"), ("d", ""), ("e", "larhc")]
    table = spark.createDataFrame(asked, "query_id string, query string")
    for most in (S.MOST_SENT, 2):  # sent at once, and in slices of the queries
        monkeypatch.setattr(S, "MOST_SENT", most)
        for d in (0, 1, 2):
            got = sorted((r.query_id, r["rank"], r.id, r.score) for r in FZ.search_fuzzy_batch(idx, table, d, 3).collect())
            assert got == sorted((q, r["rank"], r.id, r.score) for q, t in asked for r in FZ.search_fuzzy(idx, t, d, 3).collect())


def test_fuzzy_batch_shuffles_no_matches(spark, corpus):
    """Only postings (by document) and each task's best are shuffled."""
    from .test_plans import plan

    idx = corpus([(str(i), "h", "oak ash elm") for i in range(20)])
    p = plan(FZ.search_fuzzy_batch(idx, spark.createDataFrame([("a", "oak elm")], "query_id string, query string"), 1, 3))
    assert "hashpartitioning(query_id" in p and not re.search(r"hashpartitioning\(query_id#\d+, doc_key", p)


def test_phrase_batch_like_single_phrases(spark, corpus, monkeypatch):
    docs = [(str(i), "h", t) for i, t in enumerate(["a b a c d", "a c d a b", "a b a b a c", "b a c d a", "d", "a b a c d"])]
    idx = corpus([*docs, docs[2]])
    asked = [("p", "a b a c"), ("q", "b a"), ("r", "a c d a b"), ("s", "d"), ("t", "a z"), ("u", "a a"), ("v", "")]
    table = spark.createDataFrame(asked, "query_id string, query string")
    for most in (S.MOST_SENT, 1):  # the look-up sent, and by Spark's own rule
        monkeypatch.setattr(S, "MOST_SENT", most)
        got = sorted((r.query_id, r["rank"], r.id, round(r.score, 9)) for r in S.phrase_search_batch(idx, table, 4).collect())
        assert got == sorted((q, r["rank"], r.id, round(r.score, 9)) for q, t in asked for r in S.search_phrase(idx, t, 4).collect())


def test_phrase_batch_joins_only_rare_tokens(spark, corpus, monkeypatch):
    """Of a phrase's postings, those of the two rarest tokens are grouped by
    (clause, document); the others are looked up for what these have left."""
    idx = corpus([(str(i), "h", "the of " + ("rare one" if i < 2 else "x y")) for i in range(50)])
    seen, real = [], S.known
    monkeypatch.setattr(S, "known", lambda s, df: seen.append(real(s, df)) or seen[-1])
    got = S.phrase_search_batch(idx, spark.createDataFrame([("p", "the of rare one")], "query_id string, query string"), 5)
    assert got.count() == 2
    found = [df for df in seen if "starts" in df.columns]
    assert len(found) == 1 and found[0].count() == 2


def test_batch_of_terms_like_single_queries(spark, corpus, monkeypatch):
    docs = [*TREES, TREES[0], ("t6", "pine", "fir fir yew oak ash")]
    idx = corpus(docs)
    asked = [("a", "oak ash oak"), ("b", "fir"), ("c", "none"), ("d", " "), ("e", "elm yew date fir")]
    table = spark.createDataFrame(asked, "query_id string, query string")
    for most in (S.MOST_SENT, 2):
        monkeypatch.setattr(S, "MOST_SENT", most)
        got = sorted((r.query_id, r["rank"], r.id, round(r.score, 9)) for r in S.search_batch(idx, table, 3).collect())
        assert got == sorted((q, r["rank"], r.id, round(r.score, 9)) for q, t in asked for r in S.search(idx, t, 3).collect())
