"""SentencePiece encoding and decoding: distinct sampled segmentations by
Gumbel top-k over the lattice.

The lattice of a text has a node before each character and an edge for each
vocabulary piece that stands there; a character without a piece has an edge
of its byte pieces. A space opens a unit (written U+2581, as is the text's
start); no edge crosses the start of a unit, nor a cut every ``MOST_UNIT``
characters inside a longer one. The vocabulary's merge ranks weigh the
pieces by 1 / (rank + 10) to the power ``alpha``; a path's probability is
the product of its weights over the sum for all paths.

Units that occur often share one lattice: the distinct units of a slice of
texts are matched and summed backwards (from the end) together. A node holds
its edges alone, with their probabilities, not a place for every length.

Sampling without replacement is a best-first search over sets of paths. The
largest of the Gumbel-perturbed log probabilities in a set is itself Gumbel
distributed around the set's log mass: the root's is drawn, its path drawn
forwards, and the other paths fall into disjoint sets, by the first edge
that differs; their maxima are drawn below the popped one's. The queue
yields the k largest in order, so the segmentations are distinct. The
next value kappa gives the inclusion score 1 - exp(-exp(logp - kappa)), as
its logarithm. All draws are hashes of the row's key and of the draw's place.

Result: one row for each sample (0 to k - 1; fewer if the lattice has fewer
paths). Null and empty texts have one sample without ids (logp and
log_inclusion 0; ``decoded`` true). ``decoded``: the ids give the text back,
a U+2581 in it read as a space. Equal rows (key and text) get equal
samples. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chunks

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MOST_UNIT = 256
MOST_NODES = 600_000
#: characters of texts whose units are looked up together
SLICE_CHARS = 1_000_000
#: units of texts whose draws are made together: these stay in a core's cache
DRAWN_UNITS = 15_000
#: new units that are matched and summed together
MOST_NEW = 5000
SPACE = "▁"
BYTES = -2  # the piece number of a byte edge
_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)


class Vocabulary:
    """Pieces by length, as sorted hashes of their code points."""

    def __init__(self, model: bytes, alpha: float):
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = sp.get_piece_size()
        self.raw = [b""] * n
        self.byte = [0] * 256
        by: dict[int, list[tuple[int, int, float]]] = {}
        self.prefix = np.zeros(1 << 22, dtype=bool)  # by the hash's upper bits: can a piece begin so?
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte[int(piece[3:5], 16)] = i
                self.raw[i] = bytes([int(piece[3:5], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)) and SPACE not in piece[1:]:
                h = _U(0)
                with np.errstate(over="ignore"):
                    for c in piece:
                        h = h * _BASE + _U(ord(c) + 1)
                        self.prefix[int(h) >> 42] = True
                self.raw[i] = piece.encode()
                by.setdefault(len(piece), []).append((int(h), i, -alpha * np.log(10.0 - sp.get_score(i))))
        self.longest = max(by, default=1)
        self.tables = {}
        self.maybe = np.zeros(1 << 20, dtype=bool)  # by the hash's upper bits: can there be a piece?
        for m, rows in by.items():
            rows.sort()
            self.maybe[[r[0] >> 44 for r in rows]] = True
            self.tables[m] = (np.array([r[0] for r in rows], np.uint64), np.array([r[1] for r in rows], np.int32), np.array([r[2] for r in rows], np.float32))
        # what a piece says, with spaces
        self.said = pa.array([r.replace(SPACE.encode(), b" ") for r in self.raw], pa.large_binary())
        self.ascii = np.array(self.byte[:0x80], dtype=np.int32)
        self.byte_weight = -alpha * np.log(10.0 + n)

    def decode(self, ids: np.ndarray) -> bytes:
        """What the ids say, as UTF-8."""
        text = b"".join(self.said.take(pa.array(ids)).buffers()[2:3] if len(ids) else [])
        return text[1:]

    def says(self, ids: np.ndarray, text: bytes) -> bool:
        """Do the ids give the text back, a U+2581 read as a space?"""
        said = self.decode(ids)
        return said == text or said.replace(SPACE.encode(), b" ") == text


class Lattice:
    """The lattices of some units, one behind the other, each with an end."""

    def __init__(self, units: list[str], v: Vocabulary):
        size = np.fromiter(map(len, units), dtype=np.int64, count=len(units))
        self.start = np.cumsum(size + 1) - (size + 1)
        self.code = np.zeros(int(size.sum()) + len(units), dtype=np.uint64)
        inner = np.arange(int(size.sum())) + np.repeat(np.arange(len(units)), size)
        self.code[inner] = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64) + _U(1)
        n = len(self.code)
        left = np.repeat(self.start + size, size + 1) - np.arange(n)  # characters to the end
        at, h, hits = np.flatnonzero(left > 0), np.zeros(n, dtype=np.uint64), []
        for m in range(1, v.longest + 1):
            if m > 1:
                at = at[left[at] >= m]
            grown = h[at] * _BASE + self.code[at + (m - 1)]
            some = np.flatnonzero(v.prefix[grown >> _U(42)])
            at, grown = at[some], grown[some]
            if not len(at):
                break
            h[at] = grown
            if m in v.tables:
                hashes, ids, w = v.tables[m]
                real = np.flatnonzero(v.maybe[grown >> _U(44)])
                own, key = at[real], grown[real]
                to = np.minimum(np.searchsorted(hashes, key), len(hashes) - 1)
                hit = np.flatnonzero(hashes[to] == key)
                if len(hit):
                    hits.append((m, own[hit], ids[to[hit]], w[to[hit]]))
        most = hits[-1][0] if hits else 1
        self.piece = np.full((n, most), -1, dtype=np.int32)
        for m, to, ids, _ in hits:
            self.piece[to, m - 1] = ids
        bare = np.flatnonzero((self.piece[:, 0] < 0) & (left > 0))
        points = self.code[bare]
        n_bytes = 1 + (points > 0x80).astype(int) + (points > 0x800) + (points > 0x10000)
        self.piece[bare, 0] = BYTES
        # the edges: a node's together, by length
        owns, ways = [own for _, own, _, _ in hits], np.zeros(n + 1, dtype=np.int64)
        for own in (bare, *owns):
            ways[own] += 1
        self.first = np.cumsum(ways) - ways
        total, free = int(self.first[-1]), self.first.copy()
        node, self.size, weight = np.empty(total, np.int64), np.empty(total, np.uint16), np.empty(total)
        self.token = np.empty(total, np.int32)
        for m, own, ids, w in [(1, bare, BYTES, n_bytes * v.byte_weight), *hits]:
            to = free[own]
            node[to], self.size[to], self.token[to], weight[to] = own, m, ids, w
            free[own] += 1
        # sums from the units' ends backwards: all nodes with so many characters to the end at once
        end, back = node + self.size, np.zeros(n)
        order = np.argsort(left.astype(np.uint16), kind="stable")
        held = ways[order]
        begin = np.cumsum(held) - held
        by = np.repeat(self.first[order] - begin, held) + np.arange(total)
        to, value = end[by], weight[by]
        level = np.searchsorted(left[order], np.arange(1, int(left.max(initial=0)) + 2))
        begin = np.append(begin, total)
        for lo, hi in zip(level[:-1].tolist(), level[1:].tolist(), strict=True):
            if lo < hi:
                a, b = begin[lo], begin[hi]
                own, first = value[a:b] + back[to[a:b]], begin[lo:hi] - a
                top = np.maximum.reduceat(own, first)
                own -= np.repeat(top, held[lo:hi])
                back[order[lo:hi]] = top + np.log(np.add.reduceat(np.exp(own, out=own), first))
        weight += back[end]
        weight -= back[node]
        self.p = np.exp(weight, out=weight)
        self.bound = self.p.copy()
        self.bound[self.first[1:][ways[:-1] > 0] - 1] = 2.0  # a node's last edge takes what is left

    def put(self, nodes: int, units: int, made: Lattice) -> None:
        """The units of ``made`` behind the first ``nodes`` nodes and
        ``units`` units of these arrays, which grow where they are short."""
        n, most, edges = len(made.code), made.piece.shape[1], int(self.first[nodes])
        width = max(most, self.piece.shape[1])
        for name, upto, room in (("code", nodes, n), ("first", nodes, n + 1), ("size", edges, len(made.p)), ("p", edges, len(made.p)), ("bound", edges, len(made.p)), ("token", edges, len(made.p))):
            old = getattr(self, name)
            if upto + room > len(old):
                grown = np.empty((upto + room) * 5 // 4, old.dtype)
                grown[:upto] = old[:upto]
                setattr(self, name, grown)
            getattr(self, name)[upto : upto + room] = getattr(made, name)
        self.first[nodes : nodes + n + 1] += edges
        if len(self.code) > len(self.piece) or width > self.piece.shape[1]:
            grown = np.full((len(self.code), width), -1, dtype=np.int32)
            grown[:nodes, : self.piece.shape[1]] = self.piece[:nodes]
            self.piece = grown
        self.piece[nodes : nodes + n, :most], self.piece[nodes : nodes + n, most:] = made.piece, -1
        self.start = np.concatenate([self.start[:units], made.start + nodes])

    def chance(self, node: np.ndarray, edge: np.ndarray) -> np.ndarray:
        at = self.first[node]
        off = np.flatnonzero(self.size[at] != edge + 1)
        while len(off):
            at[off] += 1
            off = off[self.size[at[off]] != edge[off] + 1]
        return self.p[at]

    def draw(self, nodes: np.ndarray, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """A path from each of the nodes to its unit's end, one behind the
        other: (nodes, edges, their chances and pieces, number of edges of each)."""
        active = np.flatnonzero(self.code[nodes])
        at, seeds = nodes[active], seeds[active]
        steps: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        count = np.zeros(len(nodes), dtype=np.int64)
        while len(active):
            way, left = self.first[at], uniform(seeds, len(steps))
            bound = self.bound[way]
            on = np.flatnonzero(left >= bound)
            left, bound = left[on], bound[on]
            while len(on):  # to the next edge
                left -= bound
                way[on] = own = way[on] + 1
                bound = self.bound[own]
                still = np.flatnonzero(left >= bound)
                on, left, bound = on[still], left[still], bound[still]
            steps.append((active, at, way))
            to = at + self.size[way]
            on = self.code[to] > 0
            count[active[~on]] = len(steps)
            at, seeds, active = to[on], seeds[on], active[on]
        first = np.cumsum(count) - count
        n = int(count.sum())
        node, ways = np.empty(n, np.int64), np.empty(n, np.int64)
        for i, (who, at, way) in enumerate(steps):
            to = first[who] + i
            node[to], ways[to] = at, way
        return node, self.size[ways].astype(np.int64) - 1, self.p[ways], self.token[ways], count

    def redraw(self, node: int, banned: tuple[int, ...], u: float) -> tuple[int, float, int]:
        """Another edge from ``node`` than the banned ones, its chance among
        all and its piece."""
        own = slice(self.first[node], self.first[node + 1])
        edges = self.size[own].astype(np.int64) - 1
        p = self.p[own].copy()
        for edge in banned:
            p[edges == edge] = 0.0
        to = min(np.searchsorted(np.cumsum(p), u * p.sum(), side="right"), np.flatnonzero(p)[-1])
        return int(edges[to]), float(p[to]), int(self.token[own][to])


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def uniform(seeds: np.ndarray, step: int | np.ndarray) -> np.ndarray:
    """Draws in (0, 1) that depend on seed and step alone."""
    with np.errstate(over="ignore"):
        return ((mix(seeds + np.asarray(step, dtype=np.uint64) * _BASE + _BASE) >> _U(12)).astype(np.float64) + 0.5) * 2.0**-52


class _Path:
    """One found path, and the maxima of the sets that leave it at each edge,
    as drawn: below the path's value, and in the same order, by ``most``."""

    __slots__ = ("value", "nodes", "edges", "logs", "pieces", "logp", "since", "banned", "maxima")

    def __init__(self, value, nodes, edges, logs, pieces, logp, since, banned, maxima):
        self.value, self.nodes, self.edges, self.logs, self.pieces, self.logp = value, nodes, edges, logs, pieces, logp
        self.since, self.banned, self.maxima = since, banned, maxima

    def most(self) -> float:
        """The largest of the maxima, drawn below the path's value."""
        return -float(np.logaddexp(-self.value, -self.maxima.max(initial=-np.inf)))


#: of a path that begins anew: nodes, edges, logs of the chances and pieces before its own
_NONE = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int32))


def _paths(lattice: Lattice, value: np.ndarray, heads: list[tuple], nodes: np.ndarray, edges: np.ndarray, p: np.ndarray, tokens: np.ndarray, size: np.ndarray, banned: list[tuple[int, ...]], seeds: np.ndarray) -> list[_Path]:
    """The paths of many texts: what each has of its set (``heads``), then its
    own edges (one text behind the other, ``size`` each), with the draws for
    the sets that leave it there."""
    first = np.cumsum(size) - size
    logs = np.log(p)
    total = np.cumsum(logs)
    since = np.array([len(h[0]) for h in heads])
    before = np.array([h[2].sum() for h in heads])
    place = np.arange(len(p)) - np.repeat(first - since, size)
    prefix = total - logs - np.repeat(total[first] - logs[first] - before, size)
    rest = np.where(p == 1.0, 0.0, 1.0 - p)
    also = [(f, e) for f, b in zip(first.tolist(), banned, strict=True) for e in b]
    if also:
        at = np.array([a for a, _ in also])
        np.subtract.at(rest, at, lattice.chance(nodes[at], np.array([e for _, e in also])))
    open_ = np.flatnonzero(rest >= 1e-13)  # less is rounding of the sums
    maxima = np.full(len(p), -np.inf)
    # a Gumbel draw around the set's log mass
    maxima[open_] = prefix[open_] + np.log(rest[open_] / -np.log(uniform(np.repeat(seeds, size)[open_], place[open_])))
    logp = before + np.add.reduceat(logs, first)
    out = []
    for a, b, v, h, x, s, g in zip(first.tolist(), (first + size).tolist(), value.tolist(), heads, logp.tolist(), since.tolist(), banned, strict=True):
        whole = [np.concatenate((o, t[a:b])) if s else t[a:b] for o, t in zip(h, (nodes, edges, logs, tokens), strict=True)]
        out.append(_Path(v, *whole, x, s, g, maxima[a:b]))
    return out


def top_k(lattice: Lattice, texts: list[np.ndarray], keys: np.ndarray, k: int) -> list[tuple[list[_Path], float]]:
    """For each text (its units) the k paths with the largest perturbed log
    probabilities, and the next value. Each text has its own queue; what
    the queues ask for in one round is drawn for all texts together."""
    n_units = np.array([len(t) for t in texts])
    begin = np.cumsum(n_units) - n_units
    own = [lattice.start[t] for t in texts]
    base = mix(keys)
    seed_of = lambda keys, unit, sample: mix(keys + (unit.astype(np.uint64) << _U(20)) + _U(sample + 1))
    unit = np.arange(int(n_units.sum())) - np.repeat(begin, n_units)
    *drawn, count = lattice.draw(np.concatenate(own), seed_of(np.repeat(base, n_units), unit, 0))
    value = -np.log(-np.log(uniform(base, 0)))
    new = _paths(lattice, value, [_NONE] * len(texts), *drawn, np.add.reduceat(count, begin), [()] * len(texts), mix(base + _U(7)))
    found: list[list[_Path]] = [[x] for x in new]
    queues: list[list[tuple[float, int, _Path]]] = [[] for _ in texts]  # ties: the earlier draw

    def push(i: int, number: int, path: _Path) -> None:
        if np.isfinite(top := path.most()):
            heapq.heappush(queues[i], (-top, number, path))

    for i, x in enumerate(new):
        push(i, 0, x)
    for sample in range(1, k):
        who = [i for i, q in enumerate(queues) if q]
        if not who:
            break
        asked, heads, turns, gone, values = [], [], [], [], []
        u = uniform(mix(base[who] + _U(1000 + sample)), 0).tolist()
        for i, draw in zip(who, u, strict=True):
            low, number, path = heapq.heappop(queues[i])
            turn = int(path.maxima.argmax())
            path.maxima[turn] = -np.inf
            push(i, number, path)
            at = path.since + turn
            gone.append((*(path.banned if turn == 0 else ()), int(path.edges[at])))
            edge, chance, piece = lattice.redraw(int(path.nodes[at]), gone[-1], draw)
            seen = path.nodes[: at + 1]
            begun = int(((seen == 0) | (lattice.code[seen - 1] == 0)).sum())  # units up to here
            asked.append(np.concatenate(([path.nodes[at] + edge + 1], own[i][begun:])))
            heads.append((path.nodes[:at], path.edges[:at], path.logs[:at], path.pieces[:at]))
            turns.append((path.nodes[at], edge, chance, piece))
            values.append(-low)
        n = np.array([len(a) for a in asked])
        begin = np.cumsum(n) - n
        unit = np.arange(int(n.sum())) - np.repeat(begin, n)
        *drawn, count = lattice.draw(np.concatenate(asked), seed_of(np.repeat(base[who], n), unit, sample))
        tail = np.add.reduceat(count, begin)
        # the edge that turns off stands before those drawn behind it
        cut = np.cumsum(tail) - tail
        whole = [np.insert(drawn[c], cut, [t[c] for t in turns]) for c in range(4)]
        new = _paths(lattice, np.array(values), heads, *whole, tail + 1, gone, mix(base[who] + _U(2000 + sample)))
        for i, x in zip(who, new, strict=True):
            found[i].append(x)
            push(i, sample, x)
    return [(f, -q[0][0] if q else -np.inf) for f, q in zip(found, queues, strict=True)]


def units_of(text: str) -> list[str | tuple[str]]:
    """The names of a text's lattice units: a word stands for itself after
    U+2581; the parts of a very long one are 1-tuples."""
    words = text.replace(SPACE, " ").split(" ")
    if len(text) < MOST_UNIT or max(map(len, words)) < MOST_UNIT:
        return words
    out: list[str | tuple[str]] = []
    for word in words:
        unit = SPACE + word
        out += [word] if len(unit) <= MOST_UNIT else [(unit[i : i + MOST_UNIT],) for i in range(0, len(unit), MOST_UNIT)]
    return out


def spelled(name: str | tuple[str]) -> str:
    return SPACE + name if isinstance(name, str) else name[0]


class Segmenter:
    """Segments slices of texts, keeping the lattices of the units of the
    first slices (up to ``MOST_NODES`` nodes): these are mostly the frequent
    ones. Results don't depend on what is kept."""

    def __init__(self, v: Vocabulary, k: int):
        self.v, self.k = v, k
        self.number: dict[str | tuple[str], int] = {}
        self.kept: Lattice | None = None
        self.nodes = 0

    def _coded(self, texts: list[str]) -> tuple[list[np.ndarray], Lattice]:
        """Each text's units by number, and their lattices."""
        plain = [t.replace(SPACE, " ") if SPACE in t else t for t in texts]
        split = pc.split_pattern(pa.array(plain, pa.large_string()), " ")
        found = split.flatten().dictionary_encode()
        names, at, cuts = found.dictionary.to_numpy(zero_copy_only=False).tolist(), found.indices.to_numpy(), split.offsets.to_numpy()[1:-1]
        if pc.max(pc.utf8_length(found.dictionary)).as_py() >= MOST_UNIT:
            units = [units_of(t) for t in texts]
            order: dict[str | tuple[str], int] = {}
            at = np.array([order.setdefault(u, len(order)) for own in units for u in own], dtype=np.int64)
            names, cuts = list(order), np.cumsum([len(own) for own in units])[:-1]
        held = len(self.number)
        numbers = np.fromiter(map(self.number.get, names, repeat(-1)), np.int64, len(names))
        new = np.flatnonzero(numbers < 0)
        numbers[new] = np.arange(held, held + len(new))
        fresh = [names[i] for i in new.tolist()]
        nodes = self.nodes
        for lo in range(0, len(fresh), MOST_NEW):
            made = Lattice([spelled(u) for u in fresh[lo : lo + MOST_NEW]], self.v)
            if self.kept is None:
                self.kept = made
            else:
                self.kept.put(nodes, held + lo, made)
            nodes += len(made.code)
        if nodes <= MOST_NODES:  # if not, the next slice overwrites them
            self.nodes = nodes
            self.number.update(zip(fresh, range(held, held + len(fresh)), strict=True))
        return np.split(numbers[at], cuts), self.kept

    def segment(self, texts: list[str | None], keys: list[int]) -> Iterator[tuple[int, int, np.ndarray, float, float, bool]]:
        """(text number, sample, ids, logp, log_inclusion, decoded)."""
        real = [i for i, t in enumerate(texts) if t]
        found: dict[int, tuple[list[_Path], float]] = {}
        if real:
            coded, lattice = self._coded([texts[i] for i in real])
            seeds = np.array([keys[i] & (2**64 - 1) for i in real], dtype=np.uint64)
            part = np.cumsum([len(c) for c in coded]) // DRAWN_UNITS
            cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(real)]
        for i, text in enumerate(texts):
            if not text:
                yield i, 0, np.zeros(0, np.int32), 0.0, 0.0, True
                continue
            if not found:
                lo, hi = cuts[:2]
                del cuts[0]
                found = dict(zip(real[lo:hi], top_k(lattice, coded[lo:hi], seeds[lo:hi], self.k), strict=True))
            paths, kappa = found.pop(i)
            said = text.encode("utf-8", "surrogatepass").replace(SPACE.encode(), b" ")
            for s, path in enumerate(paths):
                ids = path_ids(lattice, self.v, path)
                x = path.logp - kappa
                inclusion = 0.0 if x > 30 else x if x < -30 else float(np.log(-np.expm1(-np.exp(x))))
                yield i, s, ids, path.logp, inclusion, self.v.says(ids, said)


#: the segmenter of this process's tasks so far, by its parameters
_SEGMENTERS: dict[tuple, Segmenter] = {}


def segmenter(model: bytes, alpha: float, k: int) -> Segmenter:
    """One for all tasks that a worker process runs with these parameters."""
    key = (hash(model), alpha, k)
    if key not in _SEGMENTERS:
        _SEGMENTERS.clear()
        _SEGMENTERS[key] = Segmenter(Vocabulary(model, alpha), k)
    return _SEGMENTERS[key]


def path_ids(lattice: Lattice, v: Vocabulary, path: _Path) -> np.ndarray:
    got = path.pieces
    special = np.flatnonzero(got == BYTES)
    if not len(special):
        return got
    got = got.copy()
    points = lattice.code[path.nodes[special]].astype(np.int64) - 1
    short = points < 0x80
    got[special[short]] = v.ascii[points[short]]
    out, last = [], 0
    for at, point in zip(special[~short].tolist(), points[~short].tolist(), strict=True):
        out.append(got[last:at])
        out.append(np.array([v.byte[b] for b in chr(point).encode("utf-8", "surrogatepass")], dtype=np.int32))
        last = at + 1
    return np.concatenate([*out, got[last:]]) if out else got


def sample_segmentations(docs: DataFrame, key: Column | None = None, k: int = 4, alpha: float = 0.25, seed: int = 23, model: str = MODEL) -> DataFrame:
    """(doc_id, sample, ids, logp, log_inclusion, decoded) for ``docs``
    (doc_id, text); rows are seeded by ``key`` (the doc_id) and ``seed``."""
    with open(model, "rb") as f:  # on the driver; a vocabulary's size is fixed
        send = docs.sparkSession.sparkContext.broadcast(f.read())
    names = ["doc_id", "sample", "ids", "logp", "log_inclusion", "decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = segmenter(send.value, alpha, k)
        for batch in batches:
            for part in chunks(batch, 2, SLICE_CHARS):
                rows = list(own.segment(part.column(2).to_pylist(), part.column(1).to_pylist()))
                doc = part.column(0).take(pa.array([r[0] for r in rows], pa.int32()))
                cut = np.cumsum([0, *(len(r[2]) for r in rows)])
                ids = pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(np.concatenate([r[2] for r in rows] or [np.zeros(0, np.int32)]), pa.int32()))
                rest = [pa.array([r[c] for r in rows], kind) for c, kind in ((1, pa.int32()), (3, pa.float64()), (4, pa.float64()), (5, pa.bool_()))]
                yield pa.RecordBatch.from_arrays([doc, rest[0], ids, *rest[1:]], names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    seeded = docs.select("doc_id", F.xxhash64(F.lit(seed), F.col("doc_id") if key is None else key).alias("key"), "text")
    return seeded.mapInArrow(run, f"doc_id {kind}, sample int, ids array<int>, logp double, log_inclusion double, decoded boolean")
