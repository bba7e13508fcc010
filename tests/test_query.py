"""F1-F12 composed queries on a small fixture, checked against a brute-force
Python evaluation of the same definitions."""

import math

import pytest

from lexispark.plans import query as Q

DOCS = [
    ("1", "user", "alpha beta gamma"),
    ("2", "user", "alpha delta"),
    ("3", "project", "beta gamma alpha beta"),
    ("4", "note", "gamma x y beta"),
    ("5", "project", "delta epsilon"),
]


def toks(t):
    return t.split()


N = len(DOCS)
AVGDL = sum(len(toks(t)) for _, _, t in DOCS) / N


def idf(df):
    return math.log(1 + (N - df + 0.5) / (df + 0.5))


def tfn(tf, dl):
    return tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / AVGDL))


def term_scores(term):
    df = sum(1 for _, _, t in DOCS if term in toks(t))
    return {i: idf(df) * tfn(toks(t).count(term), len(toks(t))) for i, _, t in DOCS if term in toks(t)}


def got(idx, q):
    return {r.id: round(r.score, 6) for r in Q.run(idx, q, k=None).collect()}


def rnd(d):
    return {k: round(v, 6) for k, v in d.items()}


@pytest.fixture(scope="module")
def idx(spark):
    from lexispark.operators.indexing import build_index

    return build_index(spark.createDataFrame(DOCS, "id string, header_key string, text string"))


def test_must_should_mustnot(idx):
    a, b, d = term_scores("alpha"), term_scores("beta"), term_scores("delta")
    exp = {i: a[i] + b[i] + d.get(i, 0) for i in a if i in b}
    assert got(idx, Q.Bool(must=(Q.Match("alpha"), Q.Match("beta")), should=(Q.Match("delta"),))) == rnd(exp)
    exp2 = {i: v for i, v in a.items() if i not in b}
    assert got(idx, Q.Bool(should=(Q.Match("alpha"),), must_not=(Q.Match("beta"),))) == rnd(exp2)
    with pytest.raises(ValueError):
        Q.run(idx, Q.Bool(must_not=(Q.Match("alpha"),)))


def test_nested_and_boost(idx):
    a, g = term_scores("alpha"), term_scores("gamma")
    inner = Q.Bool(should=(Q.Match("alpha"), Q.Match("gamma")))
    exp = {i: a.get(i, 0) * 2 + g.get(i, 0) * 2 for i in set(a) | set(g)}
    assert got(idx, Q.Boost(inner, 2.0)) == rnd(exp)


def test_field_range_set_all(idx):
    assert got(idx, Q.Field("header_key", "project")) == rnd({"3": idf(2), "5": idf(2)})
    assert got(idx, Q.Range("header_key", "note", "user", True, False)) == {"4": 1.0, "3": 1.0, "5": 1.0}
    assert got(idx, Q.Range("id", lower="4")) == {"4": 1.0, "5": 1.0}
    assert got(idx, Q.InSet("header_key", ("note",))) == {"4": 1.0}
    assert got(idx, Q.InSet("text", ("epsilon", "x"))) == {"4": 1.0, "5": 1.0}
    assert got(idx, Q.Range("text", "d", "e")) == {"2": 1.0, "5": 1.0}
    assert len(got(idx, Q.MatchAll())) == N


def test_phrase_variants(idx):
    # exact
    assert set(got(idx, Q.Phrase("beta gamma"))) == {"1", "3"}
    # prefix: "gamma al*" -> doc 3 ("gamma alpha")
    assert set(got(idx, Q.Phrase("gamma al", prefix=True))) == {"3"}
    # slop: "gamma beta" in order within 2 extra positions -> doc 4, doc 3 (gamma alpha beta)
    assert set(got(idx, Q.Phrase("gamma beta", slop=2))) == {"3", "4"}
    assert set(got(idx, Q.Phrase("gamma beta", slop=1))) == {"3"}


def sloppy(positions, slop):
    """The definition: from each first position the nearest next ones."""
    n, found = len(positions), 0
    for p in positions[0]:
        at = p
        for own in positions[1:]:
            at = min((x for x in own if x > at), default=None) if at is not None else None
        found += at is not None and at - p - (n - 1) <= slop
    return found


def test_sloppy_starts_against_the_definition(spark):
    import random

    from pyspark.sql import functions as F

    rng = random.Random(2)
    for n in (1, 2, 3, 4):
        rows = []
        for _ in range(60):
            own = [sorted(rng.sample(range(40), rng.randint(1, 12))) for _ in range(n)]
            if n > 2 and rng.random() < 0.5:
                own[-1] = own[0]  # a token that the phrase repeats
            rows.append(own)
        df = spark.createDataFrame([(i, [(j, p) for j, p in enumerate(r)]) for i, r in enumerate(rows)], "i int, pl array<struct<off:int,positions:array<int>>>")
        for slop in (0, 2, 7):
            out = {r.i: r.n for r in df.select("i", Q.sloppy_starts(F.col("pl"), n, slop).alias("n")).collect()}
            assert out == {i: sloppy(r, slop) for i, r in enumerate(rows)}


def test_sloppy_starts_are_linear_in_the_positions(spark):
    import time

    from pyspark.sql import functions as F

    pl = F.array(*[F.struct(F.lit(j).alias("off"), F.sequence(F.lit(j), F.lit(60_000), F.lit(3)).alias("positions")) for j in range(3)])
    t = time.time()
    assert spark.range(1).select(Q.sloppy_starts(pl, 3, 5).alias("n")).first().n == 20_000
    assert time.time() - t < 20
