import itertools
from collections import Counter

import numpy as np
import pytest
import sentencepiece

from lexispark.llm import pieces

from .helpers import awkward, frame, with_clashes


@pytest.fixture(scope="module")
def vocabulary():
    with open(pieces.MODEL, "rb") as f:
        return pieces.Vocabulary(f.read(), 0.25)


def all_paths(lattice, unit, v):
    """Every segmentation of one unit with its exact probability."""

    def walk(node):
        if lattice.code[node] == 0:
            yield (), 0.0
            return
        for m in range(lattice.piece.shape[1]):
            if lattice.piece[node, m] != -1:
                p = float(lattice.chance(np.array([node]), np.array([m]))[0])
                for rest, logp in walk(node + m + 1):
                    yield ((node, m), *rest), logp + np.log(p)

    return dict(walk(int(lattice.start[unit])))


def test_lattice_sums_over_all_segmentations(vocabulary):
    lattice = pieces.Lattice([pieces.spelled(u) for u in pieces.units_of("then")], vocabulary)
    found = all_paths(lattice, 0, vocabulary)
    weights = {}
    for path in found:
        ids = [int(lattice.piece[n, m]) for n, m in path]
        sp = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
        weights[path] = np.prod([(10 - sp.get_score(i)) ** -0.25 for i in ids])
    total = sum(weights.values())
    assert sum(np.exp(x) for x in found.values()) == pytest.approx(1, abs=1e-6)
    for path, logp in found.items():
        assert np.exp(logp) == pytest.approx(weights[path] / total, rel=1e-3, abs=1e-7)


def test_samples_are_distinct_and_follow_sampling_without_replacement(vocabulary):
    lattice = pieces.Lattice(["▁the", "▁on"], vocabulary)
    units = np.array([0, 1])
    joint = {a + b: x + y for (a, x), (b, y) in itertools.product(all_paths(lattice, 0, vocabulary).items(), all_paths(lattice, 1, vocabulary).items())}
    p = {k: np.exp(x) for k, x in joint.items()}
    n, first, either, inverse = 6000, Counter(), Counter(), Counter()
    for paths, kappa in pieces.top_k(lattice, [units] * n, np.arange(n, dtype=np.uint64), 2):
        keys = [tuple(zip(x.nodes.tolist(), x.edges.tolist(), strict=True)) for x in paths]
        assert len(set(keys)) == 2 and paths[0].value > paths[1].value > kappa
        first[keys[0]] += 1
        for k, x in zip(keys, paths, strict=True):
            assert x.logp == pytest.approx(joint[k], abs=1e-9)
            either[k] += 1
            inverse[k] += 1 / -np.expm1(-np.exp(x.logp - kappa))
    for k in sorted(p, key=p.get)[-3:]:
        assert first[k] / n == pytest.approx(p[k], abs=0.03)
        assert either[k] / n == pytest.approx(p[k] + sum(q * p[k] / (1 - q) for o, q in p.items() if o != k), abs=0.03)
        assert inverse[k] / n == pytest.approx(1, abs=0.15)  # inclusion scores are unbiased


def test_results_do_not_depend_on_the_kept_lattices(vocabulary, monkeypatch):
    texts = [f"some words {i} and the other ones " + "longword" * 40 * (i % 2) for i in range(6)] + [None, ""]
    one = [(r[0], r[1], r[2].tolist(), r[3]) for r in pieces.Segmenter(vocabulary, 2).segment(texts, list(range(8)))]
    monkeypatch.setattr(pieces, "MOST_NODES", 60)
    other = pieces.Segmenter(vocabulary, 2)
    parts = []
    for lo in (0, 2, 4, 6):
        parts += [(r[0] + lo, r[1], r[2].tolist(), r[3]) for r in other.segment(texts[lo : lo + 2], list(range(lo, lo + 2)))]
    assert parts == [(a, b, c, pytest.approx(d, abs=1e-9)) for a, b, c, d in one]


def test_k_beyond_the_number_of_paths(vocabulary):
    lattice = pieces.Lattice(["▁on"], vocabulary)
    [(found, kappa)] = pieces.top_k(lattice, [np.array([0])], np.array([1], np.uint64), 50)
    paths = {tuple(x.edges.tolist()) for x in found}
    assert len(paths) == len(found) == len(all_paths(lattice, 0, vocabulary)) and kappa == -np.inf
    assert [x.value for x in found] == sorted((x.value for x in found), reverse=True)


def test_awkward_rows_decode(spark):
    rows = pieces.sample_segmentations(with_clashes(frame(spark))).collect()
    by = Counter((r.doc_id, tuple(r.ids)) for r in rows)
    assert all(r.decoded and r.logp <= 1e-6 and r.log_inclusion <= 1e-6 for r in rows)
    texts = {d[0]: d[1] for d in awkward()}
    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    for r in rows:
        if r.doc_id is not None and texts[r.doc_id]:
            assert sp.decode(list(r.ids)) == texts[r.doc_id].replace("▁", " ") or "\0" in texts[r.doc_id]
            assert by[(r.doc_id, tuple(r.ids))] == (2 if r.doc_id == 104 else 1)  # repeated rows, equal samples
        elif r.doc_id is not None:
            assert (r.sample, r.ids, r.logp) == (0, [], 0.0)
    assert {r.doc_id for r in rows} == {d[0] for d in awkward()}


def test_seed_and_empty_table(spark):
    docs = frame(spark).where("doc_id < 6")
    get = lambda **k: {(r.doc_id, r.sample): r.ids for r in pieces.sample_segmentations(docs.repartition(3), **k).collect()}
    one = get()
    assert one == get() and one != get(seed=5)
    assert len(get(k=4)) == 24
    assert pieces.sample_segmentations(frame(spark, [])).count() == 0


def test_samples_do_not_depend_on_slices_or_on_what_is_kept(spark):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").limit(300).collect()]
    keys = [i * 7919 for i in range(len(texts))]
    with open(pieces.MODEL, "rb") as f:
        v = pieces.Vocabulary(f.read(), 0.25)
    every = []
    for step in (7, 300):
        own, out = pieces.Segmenter(v, 2), []
        for lo in range(0, len(texts), step):
            out += [(lo + r[0], r[1], r[2].tolist(), round(r[3], 6), r[5]) for r in own.segment(texts[lo : lo + step], keys[lo : lo + step])]
        every.append(out)
    assert every[0] == every[1] and all(r[4] for r in every[0])


def test_four_distinct_samples_by_default(spark):
    rows = pieces.sample_segmentations(frame(spark).where("doc_id < 6")).collect()
    by = Counter(r.doc_id for r in rows if r.ids)
    assert set(by.values()) == {4} and len({(r.doc_id, tuple(r.ids)) for r in rows if r.ids}) == 4 * len(by)


def test_a_lattice_holds_its_edges_alone(vocabulary):
    lattice = pieces.Lattice(["▁other", "▁x", "▁北"], vocabulary)
    assert len(lattice.p) == (lattice.piece != -1).sum() == lattice.first[-1]
    for node in np.flatnonzero(lattice.code):
        own = slice(lattice.first[node], lattice.first[node + 1])
        assert lattice.p[own].sum() == pytest.approx(1) and lattice.bound[own][-1] == 2
        assert (lattice.size[own] - 1).tolist() == np.flatnonzero(lattice.piece[node] != -1).tolist()
