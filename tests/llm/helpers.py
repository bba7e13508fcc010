"""Small awkward inputs for the tests of the llm operators."""

from __future__ import annotations

import random

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: names that operators use for their own results or in between
CLASHES = "size string, shard string, slot string, bucket string, score string, lang_pred string, keep string, perplexity string, tid string, h string, ids string, comp string, label string, key string"


def prose(seed: int, n: int, lang: str = "en") -> str:
    """Reproducible words of an invented language."""
    parts = {"en": ["the", "er", "on", "th", "ing"], "de": ["sch", "ung", "ein", "ich", "ver"], "es": ["ción", "mos", "ado", "la", "que"]}[lang]
    rng = random.Random(f"{seed}{lang}")
    return " ".join("".join(rng.choices(parts, k=rng.randint(1, 3))) for _ in range(n))


def awkward() -> list[tuple]:
    """Nulls, empty and very long texts, copies, repeated rows."""
    long = prose(99, 30_000)
    base = [(i, prose(i, 60, lang), lang, f"s{i % 2}", 1) for i, lang in enumerate(["en", "de", "es"] * 8)]
    odd = [
        (100, None, "en", None, None),
        (101, "", "en", "s", 0),
        (102, "!!! ### 123", "de", "s", 3),
        (103, long, "en", "s", len(long)),
        (104, base[0][1], None, "s", 1),
        (104, base[0][1], None, "s", 1),
        (None, base[1][1], "de", "s", 1),
        (None, None, None, None, None),
        (105, "x" * 5000, "en", "s", 1),
        (106, "a\0b 日本語 \n\n  ▁ é\U0001f600", "es", "s", 1),
    ]
    return base + odd


def frame(spark, rows=None):
    return spark.createDataFrame(awkward() if rows is None else rows, DOCS)


def with_clashes(df):
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit("x").alias(c.split()[0]) for c in CLASHES.split(", ")])
