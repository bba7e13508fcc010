"""The grouped postings of a text: against a walk over its characters."""

import random
import re

import pyarrow as pa
from pyspark.sql import functions as F

from lexispark.functions.terms import cut, grouped
from lexispark.functions.tokenize import CJK_CLASS, WS_CHARS, lowercase_tokens, ranges, tokens
from lexispark.operators.indexing import build_index, with_terms
from lexispark.session import fresh_path
from lexispark.sources.corpus import Corpus

CJK = re.compile("[" + "".join(f"{chr(lo)}-{chr(hi)}" for lo, hi in ranges(CJK_CLASS)) + "]")
ALPHABETS = [
    ["山", "川", "나", "ー", "々", "é", "q", "\U00020003", "\U0001f600", " ", "　", "\n", "​", "\x1c", "\0", "\x85", "\xa0", " "],
    [" ", "a", "b", "\n"],
    ["é", "ß", "a", " ", "b", " "],
]


def walk(text):
    """The tokens of a text, one character after the other."""
    out, i = [], 0
    while i < len(text):
        j = i + 1
        if CJK.match(text[i]):
            out.append(text[i])
            if j < len(text) and CJK.match(text[j]):
                out.append(text[i:j + 1])
        elif text[i] not in WS_CHARS:
            while j < len(text) and text[j] not in WS_CHARS and not CJK.match(text[j]):
                j += 1
            out.append(text[i:j])
        i = j
    return out


def by_term(toks):
    found = {}
    for i, w in enumerate(toks):
        found.setdefault(w, []).append(i)
    return sorted(found.items(), key=lambda x: x[0].encode())


def texts(n, seed=5):
    rng = random.Random(seed)
    return [t for a in ALPHABETS for t in ["".join(rng.choices(a, k=rng.randint(0, 14))) for _ in range(n)]] + ["", " ", "b a b" * 3000]


def test_cut_and_grouped_are_the_walk():
    own = texts(2000)
    toks, counts = cut(pa.array(["before", "", *own]).slice(2))
    want = [walk(t) for t in own]
    assert counts.tolist() == [len(w) for w in want]
    assert toks.to_pylist() == [x for w in want for x in w]
    assert [[(x["term"], x["positions"]) for x in g] for g in grouped(toks, counts).to_pylist()] == [by_term(w) for w in want]
    assert [len(x) for x in grouped(*cut(pa.array(["", None], pa.string()))).to_pylist()] == [0, 0]


def test_terms_of_rows_are_the_walk_with_any_analyzer(spark):
    own = texts(150)
    df = spark.createDataFrame([*enumerate(own), (-1, None)], "n int, text string")
    assert {r.n: list(r.t) for r in df.select("n", tokens("text").alias("t")).collect()} == {-1: [], **{i: walk(t) for i, t in enumerate(own)}}
    for analyzer, change in ((tokens, str), (lowercase_tokens, str.lower), (lambda c: F.split(c, "b"), None)):
        got = {r.n: (r.dl, [(x.term, list(x.positions)) for x in r.terms or ()]) for r in with_terms(df, analyzer).collect()}
        for i, t in enumerate(own):
            want = walk(change(t)) if change else t.split("b")
            assert got[i] == (len(want), by_term(want)), (analyzer, t)
        assert got[-1][1] == []


def exchanges(df):
    shown = df._jdf.queryExecution().executedPlan().toString()
    return [ln for ln in shown.splitlines() if "hashpartitioning" in ln]


def test_all_postings_shuffle_texts_only(spark):
    docs = spark.createDataFrame([("1", "x", "v w v"), ("1", "x", "v w v"), ("2", "x", "w")], "id string, header_key string, text string")
    own = build_index(docs).postings
    shuffled = exchanges(own)
    assert len(shuffled) == 1 and "text#" in shuffled[0] and "term#" not in shuffled[0]
    got = {(r.term, r.id): (r.tf, r.copies, list(r.positions), r.dl) for r in own.collect()}
    assert got == {("v", "1"): (2, 2, [0, 2], 3), ("w", "1"): (1, 2, [1], 3), ("w", "2"): (1, 1, [0], 1)}


def test_frequencies_of_cjk_texts_shuffle_texts_and_sums(spark):
    docs = spark.createDataFrame([("1", "x", "山川山川"), ("1", "x", "山川山川"), ("2", "x", "山 川")], "id string, header_key string, text string")
    own = build_index(docs).term_stats
    assert not any("term#" in ln and "doc_key#" in ln for ln in exchanges(own))
    assert {r.term: (r.df, r.cf) for r in own.collect()} == {"山": (3, 5), "山川": (2, 4), "川": (3, 5), "川山": (2, 2)}


def test_stored_documents_hold_no_second_copy_of_their_terms(spark):
    c = Corpus(spark, fresh_path(spark, "terms"), create=True)
    c.rebuild([("1", "x", "v w v"), ("1", "x", "v w v"), ("2", "y", "w")])
    assert "terms" not in spark.read.parquet(f"{c.path}/docs").columns
    assert {(r.term, r.id): (r.tf, r.copies) for r in c.index().postings.collect()} == {("v", "1"): (2, 2), ("w", "1"): (1, 2), ("w", "2"): (1, 1)}
    c.remove_by_header("x")  # the frequencies that go come from the stored texts
    assert [(r.term, r.df, r.cf) for r in c.index().term_stats.collect()] == [("w", 1, 1)]


def test_variants_are_spelled_out(spark):
    """A prefix without any 0, 1 or 2 of its first seven characters, each
    once, by column expressions that call nothing for each element."""
    from itertools import combinations

    from lexispark.operators.indexing import PREFIX, variant_rows

    words = ["", "a", "ab", "aab", "aaaaaaa", "abcabca", "abcdefghij", "山é\U00020003q山山x川y", "mississippi"]
    df = spark.createDataFrame([(w,) for w in [*words, "abcdefgXYZ"]], "term string")
    out = variant_rows(df, "term", 2, 8)
    want = {(w[:PREFIX], k, "".join(c for i, c in enumerate(w[:PREFIX]) if i not in gone)) for w in words for k in (0, 1, 2) for gone in combinations(range(len(w[:PREFIX])), k)}
    said = spark.createDataFrame(sorted(want), "prefix string, deleted int, v string").selectExpr("prefix", "deleted", "xxhash64(v) variant")
    got = sorted((r.prefix, r.deleted, r.variant) for r in out.collect())
    assert got == sorted((r.prefix, r.deleted, r.variant) for r in said.collect())
    assert all(r.bucket == r.variant % 8 for r in out.collect())
    assert "lambda" not in out._jdf.queryExecution().optimizedPlan().toString()
