"""Batches of words, added up block by block, against sums over all pairs."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lexispark.functions import blocks
from lexispark.operators import search as S
from lexispark.operators.indexing import build_index


@pytest.mark.parametrize(("held", "common", "k"), [(2_000_000, 0.007, 5), (300, 0.5, 3), (300, 0.0, 200)])
def test_a_block_is_the_sum_of_all_pairs(monkeypatch, held, common, k):
    monkeypatch.setattr(blocks, "HELD_SCORES", held)
    monkeypatch.setattr(blocks, "COMMON", common)
    rng = random.Random(3)
    docs = {(f"d{rng.randrange(500)}", rng.randrange(-9, 9)): {t: rng.choice([0.5, 1.25, rng.random()]) for t in {min(40, int(rng.expovariate(0.2))) * 7 for _ in range(6)}} for _ in range(700)}
    asked = {f"q{i}": {min(45, int(rng.expovariate(0.2))) * 7: rng.choice([1.0, 2.0, rng.random()]) for _ in range(4)} for i in range(60)}
    rows = [(t, x, i, key, 1) for (i, key), own in docs.items() for t, x in own.items()] + [(t, w, q, None, None) for q, own in asked.items() for t, w in own.items()]
    rng.shuffle(rows)
    kinds = {"t": pa.int64(), "x": pa.float64(), "id": pa.string(), "doc_key": pa.int64(), "copies": pa.int32()}
    batch = pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds.values())], names=list(kinds))
    got: dict = {}
    for b in blocks.best_of_block(iter([batch.slice(0, 1000), batch.slice(1000)]), k):
        for r in b.to_pylist():
            got.setdefault(r["query_id"], {})[(r["id"], r["doc_key"])] = round(r["score"], 9)
    for q, own in asked.items():
        sums = {d: sum(w * parts.get(t, 0) for t, w in own.items()) for d, parts in docs.items()}
        best = sorted(((d, round(s, 9)) for d, s in sums.items() if s > 0), key=lambda x: (-x[1], x[0]))[:k]
        assert got.get(q, {}) == dict(best)


def test_batches_are_the_single_searches_whatever_the_blocks(spark, monkeypatch):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(30)]
    rows = [(f"{i}", "x", " ".join(rng.choice(words[: rng.randint(2, 30)]) for _ in range(rng.randint(1, 9)))) for i in range(120)]
    index = build_index(spark.createDataFrame([*rows, *rows[:20], *[("same", "x", "w1 w2")] * 7], "id string, header_key string, text string"))
    asked = spark.createDataFrame([(f"q{i}", " ".join(rng.choices(words, k=4)) + " none") for i in range(6)] + [("b", " "), ("n", "none")], "query_id string, query string")
    for name, n in (("BLOCK_POSTINGS", 60), ("BLOCK_CLAUSES", 9), ("FEW_POSTINGS", 10)):
        monkeypatch.setattr(S, name, n)
    got = {(r.query_id, r["rank"], r.id): round(r.score, 9) for r in S.search_batch(index, asked, 4).collect()}
    want = {(q.query_id, r["rank"], r.id): round(r.score, 9) for q in asked.collect() for r in S.search(index, q.query, 4).collect()}
    assert got == want


def test_matches_are_not_rows(spark):
    """A batch's (clause, document) matches are no rows of a join: postings
    and clauses are dealt to blocks, and only the best of a block come out."""
    index = build_index(spark.createDataFrame([("1", "x", "v w"), ("2", "x", "w")], "id string, header_key string, text string"))
    found = S.search_batch(index, spark.createDataFrame([("q", "v w")], "query_id string, query string"), 3)
    shown = found._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in shown and "Aggregate [query_id" not in shown
    assert [r.id for r in found.orderBy(F.col("rank")).collect()] == ["1", "2"]
