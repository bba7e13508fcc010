"""op13 against numpy's eigenvectors of the exact covariance."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from lexispark.llm import queries
from lexispark.llm import whiten as W
from tests.llm.helpers import SF

TABLE = "vec_id long, embedding array<float>"


def exact(rows):
    """(kept rows, n, sums, eigenvalues, components) by eigh."""
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    size = max(Counter(len(v) for _, v in kept).items(), key=lambda x: (x[1], x[0]))[0]
    kept = [(i, np.array([math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v], np.int64)) for i, v in kept if len(v) == size]
    x = np.unique(np.array([v for _, v in kept]), axis=0)
    n, sums = len(x), x.sum(axis=0)
    e, w = np.linalg.eigh((y := (n * x - sums) / n).T @ y / n)
    return kept, n, sums, e[::-1], w[:, ::-1]


def check(got, rows, components=16, rank=None):
    kept, n, sums, e, w = exact(rows)
    q = min(components, rank or len(e))
    assert len(got) == q * len(kept)
    by = {}
    for r in got:
        by.setdefault((r.vec_id, r.deviation), {}).setdefault(r.component, []).append(r)
        assert r.n == n and r.identity_error < 1e-9
        assert abs(r.explained - e[r.component - 1] / e.sum()) < 1e-10 * r.explained
    signs = {}
    for i, x in kept:
        apart = [n * int(a) - int(s) for a, s in zip(x, sums, strict=True)]
        own = by[(i, sum(a * a for a in apart))]
        assert sorted(own) == list(range(1, q + 1))
        for c, found in own.items():
            want = np.array(apart) / n @ w[:, c - 1] / math.sqrt(e[c - 1])
            for r in found:
                assert abs(abs(r.whitened) - abs(want)) < 1e-7, (i, c, r.whitened, want)
                if abs(want) > 1e-3:
                    signs.setdefault(c, set()).add(r.whitened * want > 0)
    assert all(len(s) == 1 for s in signs.values())


def vectors(n, d, seed=3):
    rng = np.random.default_rng(seed)
    return [(i, [float(c) for c in v]) for i, v in enumerate((rng.normal(size=(n, d)) * np.linspace(3, 1, d)).astype(np.float32))]


def test_awkward_rows(spark):
    rows = vectors(120, 9)
    rows += [(500 + i, rows[0][1]) for i in range(90)] + [(3, rows[3][1])]  # a hot vector, a repeated row
    rows += [(300, None), (301, [math.nan] * 9), (302, [None] * 9), (303, [math.inf] + [0.0] * 8), (304, []), (305, [1.0, 2.0]), (None, [0.5] * 9)]
    df = spark.createDataFrame(rows, TABLE).withColumns({"component": F.lit("x"), "n": F.lit(1), "x": F.lit(2)}).repartition(5)
    check(W.whiten(df).collect(), rows)
    check(W.whiten(df, 4).collect(), rows, 4)


def test_rank_below_the_length(spark):
    rng = np.random.default_rng(8)
    few = rng.normal(size=(60, 3))
    rows = [(i, [*map(float, v), float(v[0]), 0.25]) for i, v in enumerate(few.astype(np.float32))]
    check(W.whiten(spark.createDataFrame(rows, TABLE)).collect(), rows, rank=3)


def test_repeated_eigenvalues(spark):
    """A symmetric list: every direction has the same eigenvalue."""
    rows = [(2 * k + (s > 0), [float(s) if i == k else 0.0 for i in range(6)]) for k in range(6) for s in (-1, 1)]
    got = W.whiten(spark.createDataFrame(rows, TABLE)).collect()
    assert len(got) == 12 * 6 and max(r.identity_error for r in got) < 1e-9
    assert all(abs(r.explained - 1 / 6) < 1e-12 for r in got)


def test_nothing_to_whiten(spark):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(5)], [(1, [])]):
        out = W.whiten(spark.createDataFrame(rows, TABLE))
        assert out.count() == 0 and out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_query_equals_eigh(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    check(queries.op13_embedding_whitening(spark, SF).collect(), rows)
