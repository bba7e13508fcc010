"""op11 against a brute force over the sorted rows."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from lexispark.llm import multihash as M
from lexispark.llm import queries
from tests.llm.helpers import DOCS, SF, awkward, frame, prose, with_clashes


def brute(rows):
    """doc_id -> the rows' n_chars, edited digest, shared sentence shares."""
    order = sorted(((r[0], r[1] or "") for r in rows), key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for i, (doc_id, text) in enumerate(order):
        after = order[(i + 1) % len(order)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), M.fingerprint(text), M.fingerprint(edited), share(text, edited), share(text, after)))
    return out


def share(a, b):
    """2ab / (aa + bb) of the exact counts of sentences."""
    from collections import Counter

    x, y = (Counter(s for p in M.paragraphs(t) for s in M.sentences(p.encode())) for t in (a, b))
    both = sum(n * n for n in x.values()) + sum(n * n for n in y.values())
    return 2 * sum(n * y[s] for s, n in x.items()) / both if both else float(a == b)


def key(r):
    return tuple((x is None, x) for x in r[:5])


@pytest.mark.parametrize("block_bytes", [400, 1 << 20])
def test_rows_equal_brute_force(spark, block_bytes):
    rows = [r for r in awkward() if r[0] != 103] + [(i, prose(i, 80).replace(" ", ". ", 40).replace(". ", ".\n", 5), "en", "s", 1) for i in range(200, 260)]
    got = M.compare_with_next(with_clashes(frame(spark, rows)).repartition(5), block_bytes=block_bytes).collect()
    want = brute([r for r in rows if r[0] is not None and r[0] != 104])
    alone = {r.doc_id: r for r in got if r.doc_id is not None and r.doc_id != 104}
    assert len(got) == len(rows) and len(alone) == len(want)
    for w in want:
        g = alone[w[0]]
        assert (g.n_chars, g.fingerprint) == (w[1], w[3])
        if w[0] not in (105, 0):  # those follow or precede rows whose order ties decide
            assert (g.edited_sha256, g.edited_fingerprint) == (w[2], w[4]), w[0]
            assert abs(g.near_edited - w[5]) < 0.2 and abs(g.near_next - w[6]) < 0.2


def test_ties_and_repeated_rows(spark):
    rows = [(1, "a. b", None, None, None)] * 50 + [(1, "c", None, None, None), (0, "xyz", None, None, None), (None, "lost", None, None, None)]
    got = M.compare_with_next(frame(spark, rows).repartition(7), block_bytes=8).collect()
    assert len(got) == 53
    copies = sorted(r.near_next for r in got if r.n_chars == 4 and r.doc_id == 1)
    assert len(copies) == 50 and copies[1:] == [1.0] * 49 and copies[0] < 0.2
    own = {r.edited_sha256 for r in got if r.doc_id == 0}
    assert own == {hashlib.sha256(b"xyl").hexdigest()}


def test_one_row_and_no_rows(spark):
    one = M.compare_with_next(frame(spark, [(7, None, None, None, None)])).collect()
    assert [(r.doc_id, r.n_chars, r.near_edited, r.near_next) for r in one] == [(7, 0, 1.0, 1.0)]
    assert one[0].fingerprint == M.fingerprint("") == M.fingerprint(None)
    none = M.compare_with_next(frame(spark, []))
    assert none.count() == 0 and none.columns[0] == "doc_id"


def test_order_insertion_and_deletion():
    rng = random.Random(5)
    lines = [prose(i, 12) for i in range(40)] + ["", "", "same. same.", "。日本。"]
    whole = M.fingerprint("\n".join(lines))
    rng.shuffle(lines)
    assert M.fingerprint("\n".join(lines)) == whole
    less = M.deleted(whole, lines[3], lines[9])
    rest = [x for i, x in enumerate(lines) if i not in (3, 9)]
    assert less == M.fingerprint("\n".join(rest)) != whole
    assert M.inserted(less, lines[9], lines[3]) == whole
    assert M.fingerprint("a\n\nb") != M.fingerprint("a\nb")


def test_likeness_estimates_the_share_of_sentences():
    rng = random.Random(9)
    errors = []
    for i in range(200):
        a = [prose(1000 * i + k, 8) for k in range(rng.randint(4, 40))]
        b = [x if rng.random() < i / 200 else prose(7 + 1000 * i + k, 9) for k, x in enumerate(a)]
        errors.append(M.likeness(M.fingerprint(". ".join(a)), M.fingerprint("\n".join(b))) - share(". ".join(a), "\n".join(b)))
    assert max(map(abs, errors)) < 0.2 and sum(e * e for e in errors) / len(errors) < 0.045**2
    assert M.likeness(M.fingerprint("..."), M.fingerprint("!")) == 0.0


def test_long_sentences_are_cut_where_their_words_say():
    words = prose(3, 4000).split()
    a, b = " ".join(words), " ".join(words[:2000] + ["new"] + words[2000:])
    assert M.likeness(M.fingerprint(a), M.fingerprint(b)) > 0.9
    assert M.fingerprint("x" * 100_000) != M.fingerprint("x" * 100_001)


def test_fingerprints_column(spark):
    df = M.fingerprints(frame(spark).withColumn("fingerprint", F.lit(1)))
    for r in df.collect():
        assert r.fingerprint == M.fingerprint(r.text)
    assert df.columns == [*[c.split()[0] for c in DOCS.split(", ")], "fingerprint"]


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(tuple(r)[:5] for r in queries.op11_document_fingerprints(spark, SF).collect())
    assert got == sorted(w[:5] for w in brute(rows))
    near = queries.op11_document_fingerprints(spark, SF).agg(F.avg("near_edited"), F.avg("near_next")).first()
    assert near[0] > near[1] + 0.2
