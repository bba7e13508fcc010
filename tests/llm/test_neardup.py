import random
from collections import defaultdict

import numpy as np
import pytest

from lexispark.llm import neardup
from lexispark.llm.common import words

from .helpers import DOCS, awkward, frame, prose, with_clashes


def edited(text: str, n: int, seed: int) -> str:
    rng, w = random.Random(seed), text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = "zz"
    return " ".join(w)


def brute(rows):
    """(class_id, n_links, n_copies) by doc_id, from all pairs of texts."""
    by = defaultdict(list)
    for doc, text, *_ in rows:
        by[text if text is not None else ("null", doc)].append(doc)
    texts = list(by)
    sets = []
    for t in texts:
        w = words(t) if isinstance(t, str) else []
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(texts)))
    find = lambda x: x if root[x] == x else find(root[x])
    links = [0] * len(texts)
    for a in range(len(texts)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and both >= 0.8 * len(sets[a] | sets[b]):
                links[a] += 1
                links[b] += 1
                root[find(a)] = find(b)
    ids = defaultdict(list)
    for i, t in enumerate(texts):
        ids[find(i)] += [d for d in by[t] if d is not None]
    return {d: (min(ids[find(i)]), links[i], len(by[t])) for i, t in enumerate(texts) for d in by[t] if d is not None}


def near_rows():
    rows = list(awkward())
    for g in range(5):
        base = prose(500 + g, 80)
        rows += [(1000 + 40 * g + i, edited(base, i % 4, g * 100 + i), "en", "s", 1) for i in range(20)]
    rows += [(2000, "just four words here", "en", "s", 1), (2001, "Just FOUR words, here", "en", "s", 1), (2002, "???", "en", "s", 1), (2003, "!", "en", "s", 1), (2004, "", "en", "s", 1)]
    return rows


@pytest.mark.parametrize("block", [512, 7])
def test_classes_and_links_against_brute_force(spark, block):
    rows = near_rows()
    out = neardup.document_classes(spark.createDataFrame(rows, DOCS), block=block).collect()
    assert len(out) == len(rows)
    want = brute(rows)
    for r in out:
        if r.doc_id is not None:
            assert (r.class_id, r.n_links, r.n_copies) == want[r.doc_id], r


def test_one_document_of_each_class_stays(spark):
    rows = near_rows()
    docs = with_clashes(spark.createDataFrame(rows, DOCS))
    kept = neardup.keep_one(docs)
    assert kept.columns == docs.columns
    got = sorted(r.doc_id for r in kept.where("text is not null").select("doc_id").collect())
    assert got == sorted({c for d, (c, _, _) in brute(rows).items() if d != 100})
    assert kept.where("text is null").count() == 2


def test_prefix_is_shortened_to_the_recall():
    assert neardup.prefix_length(20, 0.8, 0.9999) == 4
    assert neardup.prefix_length(20, 0.8, 0.5) > neardup.prefix_length(20, 0.8, 0.99) > 1


def test_common_counts_both_ways():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 9000, 6000, dtype=np.uint64)) for _ in range(12)]
    x, y = np.triu_indices(12, 1)
    want = [len(set(sets[a].tolist()) & set(sets[b].tolist())) for a, b in zip(x, y, strict=True)]
    assert neardup.common_counts(sets, x, y).tolist() == want
    assert neardup.common_counts(sets, x[:5], y[:5]).tolist() == want[:5]


def test_shingles_do_not_depend_on_the_neighbours():
    texts = ["a b c d e f", None, "", "x y", "a b c d e f"]
    h, n = neardup.shingles(texts)
    assert n.tolist() == [2, 0, 0, 1, 2] and h[:2].tolist() == h[3:].tolist()
    assert neardup.shingles(["x y"])[0].tolist() == h[2:3].tolist()


def test_chain_of_links_is_one_class(spark):
    edges = spark.createDataFrame([(bytes([i]), bytes([i + 1])) for i in range(40)] + [(b"\xf0", b"\xf0")], "tid binary, root binary")
    comp = {bytes(r.tid): bytes(r.comp) for r in neardup.components(edges).collect()}
    assert len(comp) == 41 and set(comp.values()) == {bytes([0])}


def test_empty_table(spark):
    assert neardup.document_classes(frame(spark, [])).count() == 0
    assert neardup.keep_one(frame(spark, [])).count() == 0
