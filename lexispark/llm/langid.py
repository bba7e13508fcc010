"""Language ID by multilingual mixture inference.

A language's model gives the probability of a letter after the two before it
(letters of any script, lower-cased; all else bounds words), each order
interpolated with the next lower one. Its counts are kept by language and
hashed n-gram, of each order and of each history, so no alphabet is chosen
and a rare script has its own n-grams beside a frequent one. Labels may be
any number: the table (n-gram, language, count) is counted, and the hash is
as wide as keeps it below ``MOST_ENTRIES`` rows (2^18 slots an order for a
hundred languages and more), so what is sent to the tasks has a proven size.

For a document, the likelihood of each word under each language is the
product of its letters' probabilities; expectation-maximisation estimates the
proportions of languages among its words. The language set is chosen by
penalised likelihood: from all languages, the weakest is dropped as long as
log likelihood less 0.5 ln(words + 1) + 3 for each further language does not
fall. ``lang_pred`` is the language with the largest proportion, ``score``
that proportion, ``langs`` the chosen set.

``fit`` is the mean natural logarithm of the probability of a letter under
the best language of its word. ``keep_identified`` rejects what is not
identified: rows without a letter, and those whose letters fit worse than a
uniform guess among the letters that training saw. How many languages a text
mixes, and in what shares, is no ground to reject it.

``und`` and 0 where the text is null or has no letter, or where training saw
no labelled text. Ties go to the label that sorts first. Copies get equal
results; an empty table gives no rows; input columns named like a result
column go, others stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_columns, chunks, stored

EM_STEPS = 12
UNKNOWN = "und"
#: n-gram counts (16 bytes each) that a model sent to every task may have
MOST_ENTRIES = 16_000_000
#: slots of a hashed order, as a power of two: at most, and at least
WIDEST, NARROWEST = 18, 8
#: dense counts of so many languages are held by a task at once
HELD = 12
FLOOR = 1e-30
#: a language with a smaller proportion is out of a document's set at once
LEAST = 1e-3
#: the counts of a model: letters and histories of one letter, pairs and
#: histories of two, triples
UNI, AFTER_1, PAIR, AFTER_2, TRIPLE = range(5)
_U = np.uint64


def _points(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased code points of the texts, each followed by a zero, and
    the end of each text."""
    low = [t.lower() if t else "" for t in texts]
    points = np.frombuffer(("\0".join(low) + "\0").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return points, np.cumsum([len(t) + 1 for t in low])


_LETTER_TABLE = None


def _is_letter(points: np.ndarray) -> np.ndarray:
    global _LETTER_TABLE
    if _LETTER_TABLE is None:
        _LETTER_TABLE = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)
    return _LETTER_TABLE[points]


def _triples(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The letter triples that end at each place of a word (its letters and
    the boundary after it) as numbers, these places, and the texts' ends."""
    points, ends = _points(texts)
    letters = np.where(_is_letter(points), points, 0).astype(np.int64)
    before = np.concatenate(([0], letters[:-1]))
    third = np.where(before == 0, 0, np.concatenate(([0, 0], letters[:-2])))
    at = np.flatnonzero((letters > 0) | (before > 0))
    return (third[at] << 42) | (before[at] << 21) | letters[at], at, ends


def _types(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct triples, and which one each is."""
    found = pa.array(codes).dictionary_encode()
    return found.dictionary.to_numpy(zero_copy_only=False), found.indices.to_numpy(zero_copy_only=False)


def _slots(codes: np.ndarray, width: int) -> list[np.ndarray]:
    """The slot of each triple in each of the five counts, one behind the
    other."""
    third, before, cur = codes >> 42, codes >> 21 & 0x1FFFFF, codes & 0x1FFFFF
    out = []
    for kind, parts in ((UNI, (cur,)), (AFTER_1, (before,)), (PAIR, (before, cur)), (AFTER_2, (third, before)), (TRIPLE, (third, before, cur))):
        h = np.full(len(codes), kind + 1, dtype=_U)
        with np.errstate(over="ignore"):
            for p in parts:
                h = (h ^ (p.astype(_U) + _U(0x9E3779B97F4A7C15))) * _U(0xBF58476D1CE4E5B9)
                h ^= h >> _U(29)
        out.append((kind << width) + (h >> _U(64 - width)).astype(np.int64))
    return out


def ngram_counts(docs: DataFrame, width: int = WIDEST) -> DataFrame:
    """(lang, slot, n) of ``docs`` (text, lang), added up in each partition
    first."""
    size = 5 << width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}

        def rows():
            for lang, total in totals.items():
                at = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], names=["lang", "slot", "n"])

        for batch in batches:
            for part in chunks(batch, 1, 2_000_000):
                by: dict[str, list[str]] = {}
                for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    by.setdefault(lang, []).append(text)
                for lang, own in by.items():
                    types, which = _types(_triples(own)[0])
                    if lang not in totals and len(totals) >= HELD:
                        yield from rows()
                        totals.clear()
                    total = totals.setdefault(lang, np.zeros(size, dtype=np.int64))
                    n = np.bincount(which, minlength=len(types))
                    for slots in _slots(types, width):
                        np.add.at(total, slots, n)
        yield from rows()

    counted = docs.select("lang", "text").mapInArrow(run, "lang string, slot int, n long")
    return counted.groupBy("lang", "slot").agg(F.sum("n").alias("n"))


@dataclass
class Model:
    """Counts by slot: those of ``slots[i]`` are ``lang`` and ``n`` from
    ``first[i]`` to ``first[i + 1]``."""

    langs: list[str]
    width: int
    slots: np.ndarray
    first: np.ndarray
    lang: np.ndarray
    n: np.ndarray

    @property
    def letters(self) -> int:
        """Distinct letters (slots of them) that training saw."""
        return max(2, int((self.slots < 1 << self.width).sum()))

    def counts(self, slots: np.ndarray) -> np.ndarray:
        """(slots, languages)"""
        out = np.zeros((len(slots), len(self.langs)))
        if not len(self.slots):
            return out
        at = np.minimum(np.searchsorted(self.slots, slots), len(self.slots) - 1)
        known = np.flatnonzero(self.slots[at] == slots)
        sizes = self.first[at[known] + 1] - self.first[at[known]]
        entry = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(self.first[at[known]], sizes)
        out[np.repeat(known, sizes), self.lang[entry]] = self.n[entry]
        return out

    def log_probabilities(self, types: np.ndarray, k: float = 8.0) -> np.ndarray:
        """log p(letter | the two before it) of triples, by language."""
        uni, after_1, pair, after_2, triple = (self.counts(s) for s in _slots(types, self.width))
        total = np.zeros(len(self.langs))
        own = slice(0, self.first[np.searchsorted(self.slots, 1 << self.width)])
        np.add.at(total, self.lang[own], self.n[own])
        p = (uni + 0.5) / (total + 0.5 * self.letters)
        p = (pair + k * p) / (after_1 + k)
        p = (triple + k * p) / (after_2 + k)
        return np.log(p).astype(np.float32)


def train(docs: DataFrame, most_entries: int = MOST_ENTRIES) -> Model:
    """Fit on the rows of ``docs`` (text, lang) with neither null."""
    labelled = docs.select("text", "lang").where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    counted = stored(ngram_counts(labelled), "ngrams")
    width, one = WIDEST, 1 << WIDEST
    narrow = counted
    while width > NARROWEST and narrow.count() > most_entries:  # fold neighbouring slots
        width -= 1
        slot = F.shiftright(F.pmod("slot", F.lit(one)), WIDEST - width) + F.shiftleft(F.floor(F.col("slot") / one).cast("int"), width)
        narrow = counted.groupBy("lang", slot.alias("slot")).agg(F.sum("n").alias("n"))
    # at most most_entries rows, or 5 << NARROWEST of each language
    rows = narrow.toArrow()
    names = rows["lang"].combine_chunks().dictionary_encode() if rows.num_rows else None
    langs = sorted(names.dictionary.to_pylist()) if names is not None else []
    if not langs:
        return Model([], width, np.zeros(0, np.int64), np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0))
    place = {lang: i for i, lang in enumerate(langs)}
    lang = np.array([place[x] for x in names.dictionary.to_pylist()])[names.indices.to_numpy()]
    slot = rows["slot"].to_numpy().astype(np.int64)
    order = np.lexsort((lang, slot))
    slots, first = np.unique(slot[order], return_index=True)
    return Model(langs, width, slots, np.append(first, len(order)), lang[order].astype(np.int32), rows["n"].to_numpy()[order].astype(np.float32))


def _em(like: np.ndarray, starts: np.ndarray, sizes: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proportions and log likelihood of documents whose words' likelihoods
    are the rows of ``like`` (scaled to a maximum of 1), over the languages
    ``allowed`` for each document."""
    share = allowed / allowed.sum(axis=1, keepdims=True)
    for _ in range(EM_STEPS):
        part = like * np.repeat(share, sizes, axis=0)
        part /= np.maximum(part.sum(axis=1, keepdims=True), FLOOR)
        share = np.add.reduceat(part, starts, axis=0) / sizes[:, None]
    mixed = np.einsum("ij,ij->i", like, np.repeat(share, sizes, axis=0))
    return share, np.add.reduceat(np.log(np.maximum(mixed, FLOOR)), starts)


def _pick(like: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Proportions (documents, languages) of the selected language sets."""
    n, k = len(sizes), like.shape[1]
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    single = np.add.reduceat(np.log(np.maximum(like, FLOOR)), starts, axis=0)
    best = single.argmax(axis=1)
    out = np.zeros((n, k))
    out[np.arange(n), best] = 1.0
    if k == 1:
        return out
    price = 0.5 * np.log(sizes + 1.0) + 3.0  # of one more language
    share, full = _em(like, starts, sizes, np.ones((n, k)))
    left = np.flatnonzero(full - single[np.arange(n), best] > price)  # no set can beat the single one elsewhere
    if not len(left):
        return out
    rows = np.repeat(np.isin(np.arange(n), left), sizes)
    like, sizes, share, price = like[rows], sizes[left], share[left], price[left]
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    allowed = ((share > LEAST) | (share == share.max(axis=1, keepdims=True))).astype(float)  # the others add nothing
    count = allowed.sum(axis=1)
    share, ll = _em(like, starts, sizes, allowed)
    held, chosen, open_ = ll - price * (count - 1), share.copy(), np.ones(len(left), dtype=bool)
    for _ in range(int(count.max()) - 1):
        go = np.flatnonzero(count > 1)
        weakest = np.where(allowed > 0, share, np.inf).argmin(axis=1)
        allowed[go, weakest[go]] = 0
        count[go] -= 1
        share, ll = _em(like, starts, sizes, allowed)
        value = ll - price * (count - 1)
        better = open_ & (value >= held)
        better[count < 1] = False
        chosen[better], held[better] = share[better], value[better]
        open_ &= better
    lone = single[left, best[left]] >= held
    out[left[~lone]] = chosen[~lone]
    return out


def shares(texts: list[str | None], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Language proportions of each text (rows of zeros without a letter),
    and the mean log probability of its letters."""
    out, fit = np.zeros((len(texts), len(model.langs))), np.zeros(len(texts))
    codes, at, ends = _triples(texts)
    if not len(at) or not model.langs:
        return out, fit
    types, which = _types(codes)
    first = np.flatnonzero(np.concatenate(([True], (codes >> 21 & 0x1FFFFF)[1:] == 0)))  # of each word
    word_like = np.add.reduceat(model.log_probabilities(types)[which], first, axis=0)
    word_doc = np.searchsorted(ends, at[first], side="right")
    best = word_like.max(axis=1)
    like = np.exp(word_like - best[:, None]).astype(np.float64)
    docs, starts, sizes = np.unique(word_doc, return_index=True, return_counts=True)
    out[docs] = _pick(like, sizes)
    fit[docs] = np.add.reduceat(best, starts, dtype=np.float64) / np.add.reduceat(np.diff(np.append(first, len(codes))), starts)
    return out, fit


def predict(docs: DataFrame, model: Model, prefix: str = "") -> DataFrame:
    """``docs`` with lang_pred, score, langs and fit (after ``prefix``)."""
    send = docs.sparkSession.sparkContext.broadcast(model)
    kinds = {"lang_pred": T.StringType(), "score": T.DoubleType(), "langs": T.ArrayType(T.StringType()), "fit": T.DoubleType()}

    def fn(texts: list[str | None]):
        m = send.value
        found, fit = shares(texts, m)
        known = found.any(axis=1) if m.langs else np.zeros(len(texts), dtype=bool)
        best = found.argmax(axis=1) if m.langs else np.zeros(len(texts), dtype=int)
        top = [m.langs[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
        score = np.minimum(found.max(axis=1), 1.0) if m.langs else np.zeros(len(texts))
        sets = [[m.langs[i] for i in np.flatnonzero(row > 0.005)] for row in found]
        return [pa.array(top, pa.string()), pa.array(score, pa.float64()), pa.array(sets, pa.list_(pa.string())), pa.array(fit, pa.float64(), mask=~known)], None

    # a slice's tables have a column for each language
    most = max(2_000, 4_000_000 // max(4, len(model.langs)))
    return add_columns(docs, "text", [T.StructField(f"{prefix}{n}", k) for n, k in kinds.items()], fn, most_chars=most)


def held_out(doc_id: Column) -> Column:
    """Rows that training leaves out: crc32 of the id's text, mod 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame) -> DataFrame:
    return docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))


def keep_identified(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, whose languages are identified
    (see above); trained on ``training_rows``."""
    model = train(training_rows(docs))
    found = predict(docs, model, "_lx_")
    return found.where((F.col("_lx_lang_pred") != UNKNOWN) & (F.col("_lx_fit") >= -float(np.log(model.letters)))).select(*[f"`{c}`" for c in docs.columns])
