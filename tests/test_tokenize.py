"""Tokens as properties of the runs of a text."""

import random
import re
from itertools import accumulate

from pyspark.sql import functions as F

from lexispark.functions.tokenize import is_cjk, prefix_sums, runs, token_table_with_offsets, tokens

SAMPLES = {
    "山川草木": ["山", "山川", "川", "川草", "草", "草木", "木"],
    "see 海辺 now": ["see", "海", "海辺", "辺", "now"],
    "雨": ["雨"],
    " \t ": [],
    "나무": ["나", "나무", "무"],
    "x　y zw": ["x", "y", "zw"],
    "\U00020003\U00020007z": ["\U00020003", "\U00020003\U00020007", "\U00020007", "z"],
    "naïve, Naïve": ["naïve,", "Naïve"],
}


def test_samples(spark):
    df = spark.createDataFrame([(k,) for k in SAMPLES], "text string")
    assert {r.text: list(r.t) for r in df.select("text", tokens("text").alias("t")).collect()} == SAMPLES


def test_runs_and_is_cjk(spark):
    df = spark.createDataFrame([("see 海辺 now",)], "text string")
    assert df.select(runs("text")).first()[0] == ["see", "海辺", "now"]
    chars = spark.createDataFrame([("雨",), ("z",), ("나",), ("々",), ("ー",)], "c string")
    assert [r[0] for r in chars.select(is_cjk(F.col("c"))).collect()] == [True, False, True, False, True]


PIECES = ["山", "川", "나", "ー", "々", "é", "q", "\U00020003", " ", "\u3000", "\n", "\u200b"]


def offsets(spark, texts):
    """text number -> (pos, term, pos_len, off_from, off_to) of its tokens"""
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    out = {i: [] for i in range(len(texts))}
    for r in token_table_with_offsets(df, ["id"]).collect():
        out[r.id].append((r.pos, r.term, r.pos_len, r.off_from, r.off_to))
    return {i: sorted(rows) for i, rows in out.items()}


def test_tokens_tile_the_text(spark):
    """Words and single characters, in order, are the text without white
    space; a run of n CJK characters has n - 1 pairs; offsets cut the text's
    bytes into the terms."""
    rng = random.Random(6)
    texts = ["".join(rng.choices(PIECES, k=rng.randint(0, 14))) for _ in range(400)] + ["q" * 5000 + " 山川" * 4000]
    for i, got in offsets(spark, texts).items():
        raw = texts[i].encode()
        assert [g[0] for g in got] == list(range(len(got)))
        assert all(raw[lo:hi].decode() == term for _, term, _, lo, hi in got)
        single = [g for g in got if g[2] == 1]
        assert "".join(g[1] for g in single) == re.sub("[ \u3000\n]+", "", texts[i])
        pairs = [g[1] for g in got if g[2] == 2]
        glued = [a[1] + b[1] for a, b in zip(single, single[1:], strict=False) if a[4] == b[3] and len(a[1]) == len(b[1]) == 1 and not set(a[1] + b[1]) & set("々éq\u200b")]
        assert pairs == glued


def test_running_sums(spark):
    rows = [(n, [(i * 7) % 5 for i in range(n)]) for n in (0, 1, 2, 3, 4, 5, 8, 9, 31, 1000)]
    df = spark.createDataFrame(rows, "n int, a array<int>").select("n", "a", prefix_sums(F.col("a")).alias("s"))
    assert all(r.s == list(accumulate(r.a)) for r in df.collect())


def test_token_table_has_the_tokens(spark):
    texts = [*SAMPLES, "", "é 山 川x나무", "a" * 3000 + "山川" * 500]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "id string, text string")
    table = token_table_with_offsets(df, ["id"]).groupBy("id").agg(F.sort_array(F.collect_list(F.struct("pos", "term"))).alias("l"))
    got = {r.id: [x.term for x in r.l] for r in table.collect()}
    want = {r.id: list(r.t) for r in df.select("id", tokens("text").alias("t")).collect()}
    assert got == {k: v for k, v in want.items() if v}


def test_repeated_rows_each_have_tokens_and_nothing_is_shuffled(spark):
    df = spark.createDataFrame([("1", "v w"), ("1", "v w"), ("2", None)], "id string, text string")
    out = token_table_with_offsets(df, ["id"])
    assert out.count() == 4
    p = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in p and "Python" not in p and "Arrow" not in p


def test_token_table_sums_up_pieces_not_tiles(spark):
    """Pieces end anywhere in a run, at white space of one to three bytes, at
    several in a row; only one pass cuts the text, into pieces."""
    rng = random.Random(8)
    texts = ["".join(rng.choices([*PIECES, " ", "\u0085", "  ", "q山", "\t"], k=n)) for n in (15, 16, 17, 31, 32, 33, 200, 900) for _ in range(12)]
    for i, got in offsets(spark, texts).items():
        raw, flat = texts[i].encode(), spark_free_tokens(texts[i])
        assert [(g[0], g[1], g[2]) for g in got] == [(k, t, n) for k, (t, n) in enumerate(flat)]
        assert all(raw[lo:hi].decode() == term for _, term, _, lo, hi in got)
        singles = [g for g in got if g[2] == 1]
        assert all(a[4] <= b[3] for a, b in zip(singles, singles[1:], strict=False))
    out = token_table_with_offsets(spark.createDataFrame([("1", "v w")], "id string, text string"), ["id"])
    assert out._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all") == 1


def spark_free_tokens(text):
    """(term, number of tiles) by the rules."""
    out = []
    for run in re.findall("[山川나ー\U00020003]+|[^山川나ー\U00020003 　\n\t \u0085]+", text):
        if run[0] in "山川나ー\U00020003":
            for i, c in enumerate(run):
                out += [(c, 1)] + ([(run[i : i + 2], 2)] if i + 1 < len(run) else [])
        else:
            out.append((run, 1))
    return out
