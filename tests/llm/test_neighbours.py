import numpy as np
from pyspark.sql import functions as F

from lexispark.llm import neighbours

SCHEMA = "vec_id long, embedding array<float>"


def vectors(n, dim=16, seed=0):
    rng = np.random.default_rng(seed)
    return [(i, rng.normal(size=dim).astype(np.float32).tolist()) for i in range(n)]


def brute(rows, queries, k):
    ids = np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows], dtype=np.float32).astype(float)
    out = {}
    for q, v in queries:
        s = (x * np.array(v, dtype=np.float32).astype(float)).sum(axis=1)
        order = [i for i in np.lexsort((ids, -s)) if ids[i] != q][:k]
        out[q] = [(int(ids[i]), float(s[i])) for i in order]
    return out


def test_recall_order_and_exact_scores(spark):
    rows = vectors(3000)
    queries = [r for r in rows if r[0] % 20 == 0]
    df = spark.createDataFrame(rows, SCHEMA)
    got = neighbours.nearest(df, df.where("vec_id % 20 = 0"), k=20, depth=4, visits=40, block=100).collect()
    want = brute(rows, queries, 20)
    by = {q: [(r.vec_id, r.score) for r in sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)] for q, _ in queries}
    recall = np.mean([len({v for v, _ in by[q]} & {v for v, _ in want[q]}) / 20 for q in by])
    assert recall >= 0.9
    x = dict(rows)
    for q, found in by.items():
        assert found == sorted(found, key=lambda f: (-f[1], f[0])) and len(found) == 20 and q not in dict(found)
        for v, s in found[:3]:
            assert abs(s - np.dot(np.array(x[q], np.float32).astype(float), np.array(x[v], np.float32).astype(float))) < 1e-12


def test_all_leaves_give_the_exact_answer_with_ties_and_copies(spark):
    rows = vectors(60, 4)
    rows += [(100 + i, rows[3][1]) for i in range(300)] + [(500, [0.0] * 4), (501, None), (502, [1.0, None, 0.0, 0.0]), (503, [float("nan"), 0.0, 0.0, 0.0]), (504, [float("inf"), 0.0, 0.0, 0.0]), (505, [1.0, 2.0]), (506, [])]
    df = spark.createDataFrame([*rows, (None, [1.0] * 4)], SCHEMA).select("*", F.lit("x").alias("leaf"), F.lit("y").alias("v"))
    good = [r for r in rows if r[0] < 500]
    got = neighbours.nearest(df, df.where("vec_id % 20 = 0 or vec_id is null or vec_id > 499"), k=20, block=16).collect()
    want = brute(good, [r for r in good if r[0] % 20 == 0], 20)
    assert {r.query_id for r in got} == set(want)
    for q, rest in want.items():
        assert [r.vec_id for r in sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)] == [v for v, _ in rest]


def test_fewer_candidates_than_k_and_empty_tables(spark):
    df = spark.createDataFrame(vectors(5), SCHEMA)
    assert neighbours.nearest(df, df.where("vec_id = 0"), k=20).count() == 4
    assert neighbours.nearest(df.limit(0), df).count() == 0 and neighbours.nearest(df, df.limit(0)).count() == 0


def test_queue_reads_leaves_by_rising_cost():
    points = np.random.default_rng(3).normal(size=(2000, 8))
    forest = neighbours.Forest(points, 3, 5, 1)
    m = forest.margins(points[:5])
    home = forest.leaves(points[:5])
    for one, own in zip(m, home, strict=True):
        found = forest.search(one, 1000)
        assert len(found) == len(set(found)) == 3 << 5  # every leaf, once
        assert set(found[:3]) == set(enumerate(own.tolist()))


def test_queries_of_one_id_or_another_length(spark):
    rows = vectors(200, 6)
    df = spark.createDataFrame(rows, SCHEMA)
    asked = spark.createDataFrame([(900, rows[5][1]), (900, rows[9][1]), *[(901 + i, [1.0, 2.0]) for i in range(5)]], SCHEMA)
    got = sorted(neighbours.nearest(df, asked, k=3).collect(), key=lambda r: r.rank)
    smallest = min(rows[5][1], rows[9][1])
    assert {r.query_id for r in got} == {900} and [r.vec_id for r in got] == [v for v, _ in brute(rows, [(900, smallest)], 3)[900]]


def test_recall_of_the_registered_parameters(spark):
    from lexispark.llm import queries

    sf = "/root/testdata/sf0.1"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = brute(rows, [r for r in rows if r[0] % 20 == 0], 20)
    got = {}
    for r in queries.op10_nearest_neighbours(spark, sf).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert np.mean([len(got[q] & {v for v, _ in near}) / len(near) for q, near in want.items()]) >= 0.9
