"""Postings of each text, made inside its own row: Arrow batches in, Arrow
batches out. Whole slices of texts are cut and grouped by array operations;
the rules are those of ``tokenize.tokens``, which queries go through."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .tokenize import CJK_CLASS, WS_CLASS, ranges

#: characters of text (or tokens) that are grouped together
SLICE = 1_000_000
WORD, SPACE, CJK = 0, 1, 2
TERMS = pa.list_(pa.struct([("term", pa.string()), ("positions", pa.list_(pa.int32()))]))


@cache
def classes() -> np.ndarray:
    """Class of each code point."""
    out = np.zeros(0x200000, dtype=np.uint8)
    for kind, shown in ((SPACE, WS_CLASS), (CJK, CJK_CLASS)):
        for lo, hi in ranges(shown):
            out[lo : hi + 1] = kind
    return out


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of the texts and each text's begin in them (and the end)."""
    wide = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    offsets = np.frombuffer(texts.buffers()[1], wide)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _code_points(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The code points of the characters that begin at ``at``."""
    out = data[at].astype(np.uint32)
    wide = np.flatnonzero(out >= 0xC0)
    lead, place = out[wide], at[wide]
    more = 1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
    value = lead & (0x3F >> more).astype(np.uint32)
    for i in range(1, 4):
        own = more >= i
        value[own] = (value[own] << 6) | (data[np.minimum(place[own] + i, len(data) - 1)] & 0x3F)
    out[wide] = value
    return out


def cut(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All tokens of the texts, in order, and how many each text has."""
    data, offsets = _bytes_of(texts)
    if not len(data):
        return pa.array([], pa.string()), np.zeros(len(texts), np.int64)
    begins = np.zeros(len(data) + 1, dtype=bool)  # of a text
    begins[offsets] = True
    at = np.flatnonzero(((data & 0xC0) != 0x80) | begins[:-1])
    kind = classes()[data if len(at) == len(data) else _code_points(data, at)]
    first = begins[at]
    ends = np.append(at[1:], len(data))
    word = kind == WORD
    # is it a token with the character before it?
    inner = np.zeros(len(at), dtype=bool)
    inner[1:] = word[1:] & word[:-1] & ~first[1:]
    head = np.flatnonzero((kind != SPACE) & ~inner)
    # a word ends where the next character is not inside it
    last = np.append(~inner[1:], True) & word
    stop = ends[head]
    words = word[head]
    stop[words] = ends[last]
    pairs = np.zeros(len(at), dtype=bool)
    pairs[:-1] = (kind[1:] == CJK) & (kind[:-1] == CJK) & ~first[1:]
    bounds = np.searchsorted(at[head], offsets)
    if pairs.any():
        n = 1 + pairs[head]
        begin, stop = np.repeat(at[head], n), np.repeat(stop, n)
        held = np.concatenate([[0], np.cumsum(n)])
        second = held[1:][n == 2] - 1
        stop[second] = ends[head[n == 2] + 1]
        counts = np.diff(held[bounds])
        size = stop - begin
        to = np.concatenate([[0], np.cumsum(size)])
        said = data[np.arange(to[-1]) + np.repeat(begin - to[:-1], size)]
    else:
        counts = np.diff(bounds)
        to = np.concatenate([[0], np.cumsum(stop - at[head])])
        kept = kind != SPACE
        said = data[kept if len(at) == len(data) else np.repeat(kept, ends - at)]
    return pa.StringArray.from_buffers(len(to) - 1, pa.py_buffer(to.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(said))), counts


def grouped(toks: pa.Array, counts: np.ndarray) -> pa.Array:
    """For each text the list of its (term, positions), by term."""
    coded = toks.dictionary_encode()
    order = pc.sort_indices(coded.dictionary)
    rank = np.empty(len(order), np.int64)
    rank[order.to_numpy()] = np.arange(len(order))
    doc = np.repeat(np.arange(len(counts)), counts)
    first = np.cumsum(counts) - counts
    key = doc * max(1, len(rank)) + rank[coded.indices.to_numpy()]
    by = np.argsort(key, kind="stable")
    key = key[by]
    new = np.flatnonzero(np.diff(key, prepend=-1))
    positions = (by - np.repeat(first, counts)).astype(np.int32)  # ``by`` keeps each text's tokens together
    lists = pa.ListArray.from_arrays(pa.array(np.append(new, len(by)).astype(np.int32)), pa.array(positions))
    terms = toks.take(pa.array(by[new]))
    upto = np.searchsorted(doc[by[new]], np.arange(len(counts) + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(upto), pa.StructArray.from_arrays([terms, lists], names=["term", "positions"]))


def slices(batch: pa.RecordBatch, sizes: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` of about SLICE (a larger row stands alone)."""
    part = np.cumsum(sizes) // SLICE
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        if hi > lo:
            yield batch.slice(lo, hi - lo)


def postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches whose last column is a text, or a list of tokens: in its place
    ``dl`` and ``terms``."""
    for batch in batches:
        own = batch.column(batch.num_columns - 1)
        listed = pa.types.is_list(own.type)
        sizes = pc.list_value_length(own) if listed else pc.binary_length(own)
        for part in slices(batch, pc.fill_null(sizes, 0).to_numpy(zero_copy_only=False)):
            last = part.column(part.num_columns - 1)
            if listed:
                toks, counts = last.flatten(), pc.fill_null(pc.list_value_length(last), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            else:
                toks, counts = cut(last)
            names = [*part.schema.names[:-1], "dl", "terms"]
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(counts.astype(np.int32)), grouped(toks, counts).cast(TERMS)], names=names)
