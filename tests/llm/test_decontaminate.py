import hashlib

import pytest

from lexispark.llm import decontaminate
from lexispark.llm.common import words

from .helpers import DOCS, awkward, frame, prose, with_clashes


def brute(rows, items, window=10):
    out = []
    for doc, text, *_ in rows:
        w, hit, ids = words(text), set(), set()
        for item, t in items:
            v = words(t)
            n = min(window, len(v))
            for i in range(len(v) - n + 1) if v else ():
                for at in range(len(w) - n + 1):
                    if w[at : at + n] == v[i : i + n]:
                        hit.update(range(at, at + n))
                        ids.add(str(item) if item is not None else "")
        out.append((doc, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def inputs():
    a, b = prose(1, 40), prose(2, 25)
    items = [(1, a), (2, b), (10, "Short item"), (3, None), (4, "..."), (5, "the"), (None, prose(3, 12)), (2, b)]
    w = a.split()
    rows = [
        *awkward(),
        (300, f"x {a.upper()} y", "en", "s", 1),
        (301, " ".join(w[:9]), "en", "s", 1),
        (302, " ".join([*w[3:13], "q", *w[20:35], *w[5:16]]), "en", "s", 1),
        (303, "a SHORT, item! short item", "en", "s", 1),
        (304, f"{b} {prose(3, 12)} {b}", "en", "s", 1),
        (304, f"{b} {prose(3, 12)} {b}", "en", "s", 1),
        (305, "É" + b, "en", "s", 1),
    ]
    return rows, items


@pytest.mark.parametrize("block_bytes", [1 << 20, 150])
def test_report_against_brute_force(spark, block_bytes):
    rows, items = inputs()
    docs = with_clashes(spark.createDataFrame(rows, DOCS))
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = decontaminate.report(docs, bench, block_bytes=block_bytes).drop("spans")
    assert sorted((tuple(r) for r in out.collect()), key=str) == brute(rows, items)


def test_contaminated_rows_go(spark):
    rows, items = inputs()
    docs, bench = with_clashes(spark.createDataFrame(rows, DOCS)), spark.createDataFrame(items[:2], "item_id long, text string")
    kept = decontaminate.keep_clean(docs, bench)
    assert kept.columns == docs.columns
    assert kept.count() == sum(not r[5] for r in brute(rows, items[:2])) < len(rows)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    out = decontaminate.report(frame(spark), none).collect()
    assert len(out) == len(awkward()) and not any(r.contaminated or r.n_items for r in out)
    assert decontaminate.report(frame(spark, []), spark.createDataFrame([(1, "a b")], none.schema)).count() == 0
    assert decontaminate.keep_clean(frame(spark), none).count() == len(awkward())


def test_anchors_are_the_rarest_words():
    import numpy as np

    counts = np.array([5, 1, 9, 2, 0])
    assert decontaminate.anchors([0, 1, 2, 3], counts, 3) == [[0, 1], [1, 3]]
    assert decontaminate.anchors([0, 4, 2], counts, 3) == [] and decontaminate.anchors([2], counts, 10) == [[0]]


def test_proximity(spark):
    docs = frame(spark, [(1, "red x y blue z z z z red", "en", "s", 1), (2, "blue x x x x red", "en", "s", 1), (3, None, "en", "s", 1)])
    got = lambda span: sorted((r.doc_id, r.lo) for r in decontaminate.near_matches(docs, "red BLUE", span).collect())
    assert got(4) == [(1, 0)] and got(6) == [(1, 0), (1, 3), (2, 0)] and got(3) == []
    assert decontaminate.near_matches(docs, " ... ", 4).count() == 0
