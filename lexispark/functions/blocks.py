"""Scores of a block of queries against a block of documents, added up by
array operations inside one task: Arrow batches in, Arrow batches out."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: scores of a block that are held at once, and matches that are spelled out at once
HELD_SCORES = 2_000_000
#: a term goes by a product of matrices if at least this share of the block's
#: (query, document) pairs has it; others are added match by match
COMMON = 0.007
#: documents whose best score stands for them when the k-th score is bounded
GROUP = 64
#: order_key compares scores rounded to so many digits
DIGITS = 9


def _runs(sorted_keys: np.ndarray) -> np.ndarray:
    """Begins of the runs of equal keys, and the end."""
    return np.append(np.flatnonzero(np.append(True, sorted_keys[1:] != sorted_keys[:-1])), len(sorted_keys))


def _documents(rows: pa.Table) -> tuple[pa.Table, np.ndarray]:
    """The documents (id, doc_key, copies) in the order that ties have in
    results, and of each row, sorted like them, its document."""
    ids, keys = rows["id"].combine_chunks().dictionary_encode().indices.to_numpy(), rows["doc_key"].to_numpy()
    new = np.append(True, (ids[1:] != ids[:-1]) | (keys[1:] != keys[:-1]))
    return rows.select(["id", "doc_key", "copies"]).take(pa.array(np.flatnonzero(new))), np.cumsum(new) - 1


def _best(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the best ``k`` of each row that are above zero; of
    equal ones the first columns. The k-th of the groups' best scores is not
    above the k-th score, so few are looked at."""
    m, n = scores.shape
    floor = np.zeros(m)
    whole = n // GROUP
    if whole > k:
        groups = scores[:, : whole * GROUP].reshape(m, whole, GROUP).max(axis=2)
        floor = np.maximum(0, np.partition(groups, whole - k, axis=1)[:, whole - k] - 2 * 10.0**-DIGITS)
    row, col = np.nonzero((scores > 0) & (scores >= floor[:, None]))
    shown = np.round(scores[row, col], DIGITS)
    by = np.lexsort((col, -shown, row))
    row, col = row[by], col[by]
    first = np.searchsorted(row, np.arange(m))
    kept = np.arange(len(row)) - first[row] < k
    return row[kept], col[kept]


def best_of_block(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Batches of one block, ``t, x, id, doc_key, copies``: a document's
    postings (x: its part of the score), and the clauses of queries (x: their
    weight; no doc_key). Gives ``query_id, doc_key, id, copies, score`` of the
    best ``k`` documents of each query in this block."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    table = pa.Table.from_batches(held)
    is_query = pc.is_null(table["doc_key"])
    asked, rows = table.filter(is_query), table.filter(pc.invert(is_query))
    if not asked.num_rows or not rows.num_rows:
        return
    rows = rows.sort_by([("id", "ascending"), ("doc_key", "ascending")])
    documents, doc = _documents(rows)
    n = documents.num_rows
    # postings by term
    by = np.argsort(rows["t"].to_numpy(), kind="stable")
    part, doc, t = rows["x"].to_numpy()[by], doc[by], rows["t"].to_numpy()[by]
    begins = _runs(t)
    terms, begins, df = t[begins[:-1]], begins[:-1], np.diff(begins)
    # clauses by query, without those of terms that no document here has
    names = asked["id"].combine_chunks().dictionary_encode()
    query, wanted, weight = names.indices.to_numpy(), asked["t"].to_numpy(), asked["x"].to_numpy()
    place = np.minimum(np.searchsorted(terms, wanted), len(terms) - 1)
    met = np.flatnonzero(terms[place] == wanted)
    met = met[np.argsort(query[met], kind="stable")]
    query, place, weight = query[met], place[met], weight[met]
    if not len(query):
        return
    qf = np.bincount(place, minlength=len(terms))
    common = np.flatnonzero(df * qf > COMMON * n * len(names.dictionary))
    column = np.full(len(terms), -1)
    column[common] = np.arange(len(common))
    parts = np.zeros((len(common), n))
    for i, x in enumerate(common):
        own = slice(begins[x], begins[x] + df[x])
        parts[i, doc[own]] = part[own]
    starts = _runs(query)
    at_once = max(1, HELD_SCORES // n)
    for lo in range(0, len(starts) - 1, at_once):
        own = slice(starts[lo], starts[min(lo + at_once, len(starts) - 1)])
        q = np.cumsum(np.append(0, query[own][1:] != query[own][:-1]))
        p, w = place[own], weight[own]
        dense = column[p] >= 0
        weights = np.zeros((q[-1] + 1, len(common)))
        weights[q[dense], column[p[dense]]] = w[dense]
        scores = weights @ parts
        q_, p, w = q[~dense], p[~dense], w[~dense]
        upto = np.cumsum(df[p])
        cuts = np.flatnonzero(np.diff(upto // HELD_SCORES)) + 1 if len(p) else []
        for a, b in zip([0, *cuts], [*cuts, len(p)], strict=True):
            size = df[p[a:b]]
            to = np.cumsum(size) - size
            at = np.arange(size.sum()) + np.repeat(begins[p[a:b]] - to, size)
            np.add.at(scores.reshape(-1), np.repeat(q_[a:b] * n, size) + doc[at], np.repeat(w[a:b], size) * part[at])
        row, col = _best(scores, k)
        found = documents.take(pa.array(col))
        shown = names.dictionary.take(pa.array(query[own][_runs(query[own])[:-1]][row]))
        yield from pa.table(
            {"query_id": shown, "doc_key": found["doc_key"], "id": found["id"], "copies": found["copies"], "score": pa.array(scores[row, col])}
        ).to_batches(max_chunksize=10_000)
