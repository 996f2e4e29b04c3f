"""SentencePiece encoding, decoding and sampling of segmentations without replacement.

A text is cut before each run of word marks; no piece reaches across such a
cut, so the lattice of a text is a chain of small lattices, one for each unit.
The whole lattice of a unit is kept: for each place its edges with their
probabilities (weight times the summed weight of all ways from their end).

Sampling is Gumbel top-k by perturbed A-star search.  A node of the search is
a prefix with a set of ways on that are taken already; its bound is the largest
perturbed log probability among all its other completions, which is the log
probability they hold together plus Gumbel noise, cut off at the bound of its
parent.  The best node of the queue is popped, one of its ways on is drawn by
probability and followed to the end of the text, and what is left at each unit
beside that path enters the queue.  So the first k pops are the k largest of
all perturbed leaves, which are distinct samples without replacement, and the
queue's next bound is the threshold of their inclusion scores
``1 - exp(-exp(log_prob - threshold))``.  Bounds are kept as logs of arrival
times (exp of their negative): what holds the mass m arrives an exponential
time over m after its parent.  Noise comes from a hash of the row's key, the
path and the place, so a retried task samples the same.
"""

from __future__ import annotations

import random
import re
import zlib
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .blocks import release
from .shared import read_table

SAMPLES = 2
#: Texts handled side by side, in characters (a longer text is handled alone).
GROUP_CHARS = 1_500_000
#: Characters whose lattices are built side by side (a longer unit alone).
BLOCK_CHARS = 40_000
#: Lattice edges that a Python worker remembers; beyond that it keeps half of them, of the units met most often.
CACHE_EDGES = 4_000_000
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
#: log weight of a piece: -PIECE_COST - its rank / RANK_SCALE; of a byte piece -BYTE_COST.
PIECE_COST, RANK_SCALE, BYTE_COST = 1.0, 8000.0, 6.0
_UNIT = re.compile("▁+[^▁]*")
SCHEMA = "doc_id long, ids binary, samples array<struct<ids: binary, log_prob: double, inclusion: double>>, decoded string"


class _Numbers(dict):
    """Words get numbers as they are asked for."""

    def __missing__(self, key):
        n = self[key] = len(self)
        return n


def _gather(flat: np.ndarray, start: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The stretches ``flat[start : start + len]``, one after the other."""
    past = np.cumsum(lens)
    return flat[np.repeat(start - past + lens, lens) + np.arange(past[-1] if len(past) else 0)]


def _uniform(keys: np.ndarray, step: int) -> np.ndarray:
    """Numbers in (0, 1) from a hash of keys and step."""
    x = keys + np.uint64((step + 1) * 0xD1342543DE82EF95 % 2**64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(31)
    x >>= np.uint64(11)
    return (x + 0.5) * 2.0**-53


class Codec:
    """Units of text, their BPE ids and lattices, remembered.  A unit is known by what follows its first word mark."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = m = sentencepiece.SentencePieceProcessor(model_file=path)
        n = m.get_piece_size()
        self.pieces = {m.id_to_piece(k): k for k in range(n) if not (m.is_byte(k) or m.is_control(k) or m.is_unknown(k))}
        self.bytes = np.array([m.piece_to_id(f"<0x{k:02X}>") for k in range(256)], np.uint32)
        byte_of = {int(k): bytes([b]) for b, k in enumerate(self.bytes)}
        text = [byte_of[k] if m.is_byte(k) else b"" if m.is_control(k) or m.is_unknown(k) else m.id_to_piece(k).replace("▁", " ").encode() for k in range(n)]
        self.text, self.text_len = np.frombuffer(b"".join(text), np.uint8), np.array([len(t) for t in text])
        self.text_start = np.cumsum(self.text_len) - self.text_len
        # ranks: the library's scores count merges; runs of word marks have none, and cost as the last
        self.weight = np.full(n, -BYTE_COST)
        for k in self.pieces.values():
            self.weight[k] = -PIECE_COST - min(-min(m.get_score(k), 0.0), float(n)) / RANK_SCALE
        self.id_type = np.uint16 if n <= 1 << 16 else np.uint32
        self.longest = max(map(len, self.pieces))
        self.tables, self.seen = {}, {}
        for size in sorted({len(p) for p in self.pieces}):
            names = [p for p in self.pieces if len(p) == size]
            h = np.zeros(len(names), np.uint64)
            for k in range(size):
                h = h * MULTIPLIER + np.array([ord(p[k]) for p in names], np.uint64)
            order = np.argsort(h)
            self.tables[size] = (h[order], np.array([self.pieces[p] for p in names], np.uint32)[order])
            self.seen[size] = np.zeros(1 << 18, bool)
            self.seen[size][h >> np.uint64(46)] = True
        # Units get numbers as they are seen.  Of a unit: ``hits``, how often it was met; ``best_*`` its BPE ids,
        # ``start`` and ``stop`` its first and last state, ``log_sum`` of its lattice.
        # Of a state: ``first``, its first edge; of an edge: piece, states it moves on, and probability summed up to it.
        self.index = _Numbers()
        self.best_ids, self.best_start, self.best_len = np.zeros(0, self.id_type), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.hits, self.start, self.stop, self.log_sum = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        self.first, self.ids, self.width, self.upto = np.zeros(0, np.int64), np.zeros(0, self.id_type), np.zeros(0, np.uint8), np.zeros(0)

    def forget(self, edges: int):
        """Of all units those met most often stay, with so many edges at most, and have new numbers."""
        size, states = self.first[self.stop] - self.first[self.start], self.stop - self.start + 1
        by = np.argsort(-self.hits, kind="stable")
        keep = np.sort(by[np.cumsum(size[by]) <= edges])
        names, size, states = list(self.index), size[keep], states[keep]
        self.index = _Numbers(zip(map(names.__getitem__, keep.tolist()), range(len(keep)), strict=True))
        self.best_ids, self.best_len = _gather(self.best_ids, self.best_start[keep], self.best_len[keep]), self.best_len[keep]
        self.best_start = np.cumsum(self.best_len) - self.best_len
        start, begin = self.start[keep], self.first[self.start[keep]]
        self.first = _gather(self.first, start, states) - np.repeat(begin - np.cumsum(size) + size, states)
        self.ids, self.width, self.upto = (_gather(a, begin, size) for a in (self.ids, self.width, self.upto))
        self.stop = np.cumsum(states) - 1
        self.hits, self.start, self.log_sum = self.hits[keep] // 2, self.stop - states + 1, self.log_sum[keep]

    def chain(self, text: str) -> np.ndarray:
        """The text as numbers of units; ``learn`` must follow before they are used."""
        units = self.units(text)
        return np.fromiter(map(self.index.__getitem__, units), np.int64, len(units))

    def units(self, text: str) -> list[str]:
        return [u[1:] for u in _UNIT.findall("▁" + text.replace(" ", "▁"))] if text else []

    def chains(self, texts: pa.Array) -> list[np.ndarray]:
        """``chain`` of each text; where spaces stand alone, Arrow splits and only distinct units are looked up."""
        texts = pc.fill_null(texts, "")
        odd = pc.or_(pc.or_(pc.equal(texts, ""), pc.starts_with(texts, " ")), pc.or_(pc.match_substring(texts, "  "), pc.match_substring(texts, "▁")))
        odd = odd.to_numpy(zero_copy_only=False)
        out: list = [None] * len(texts)
        plain = np.flatnonzero(~odd)
        split = pc.split_pattern(texts.take(pa.array(plain)), " ")
        lens = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = pc.dictionary_encode(split.flatten())
        names = coded.dictionary.to_pylist()
        number = np.fromiter(map(self.index.__getitem__, names), np.int64, len(names))
        units = number[coded.indices.to_numpy(zero_copy_only=False)] if len(names) else number
        for k, part in zip(plain.tolist(), np.split(units, np.cumsum(lens)[:-1]) if len(plain) else [], strict=True):
            out[k] = part
        for k in np.flatnonzero(odd).tolist():
            out[k] = self.chain(texts[k].as_py())
        hits = np.bincount(np.concatenate(out), minlength=len(self.index)) if out else np.zeros(len(self.index), np.int64)
        hits[: len(self.hits)] += self.hits
        self.hits = hits
        return out

    def learn(self):
        """BPE ids and lattices of the units that have a number but none yet."""
        new = list(islice(self.index, len(self.start), None))
        if not new:
            return
        # the library returns nothing for a lone word mark, which its prefix would double
        lens, flat = [self.best_len], [self.best_ids]
        for at in range(0, len(new), 20_000):
            part = new[at : at + 20_000]
            found = [ids if u else [self.pieces["▁"]] for u, ids in zip(part, self.model.encode([u.replace("▁", " ") for u in part], num_threads=1), strict=True)]
            lens.append(np.fromiter(map(len, found), np.int64, len(found)))
            flat.append(np.fromiter(chain.from_iterable(found), self.id_type, int(lens[-1].sum())))
        self.best_len, self.best_ids = np.concatenate(lens), np.concatenate(flat)
        self.best_start = np.cumsum(self.best_len) - self.best_len
        sizes = np.fromiter(map(len, new), np.int64, len(new))
        # units of like length side by side: few steps from their ends are for a few long ones
        order = np.argsort(sizes, kind="stable")
        block = np.cumsum(sizes[order] + 2) // BLOCK_CHARS
        parts, n = [], len(self.start)
        self.start, self.stop, self.log_sum = (np.concatenate([a, np.zeros(len(new), a.dtype)]) for a in (self.start, self.stop, self.log_sum))
        states, edges = len(self.first), len(self.ids)
        for rows in np.split(order, np.flatnonzero(np.diff(block)) + 1):
            start, stop, log_sum, first, *of_edges = self._lattice(["▁" + new[k] for k in rows.tolist()])
            self.start[n + rows], self.stop[n + rows], self.log_sum[n + rows] = start + states, stop + states, log_sum
            parts.append((first + edges, *of_edges))
            states, edges = states + len(first), edges + len(of_edges[0])
        self.first, self.ids, self.width, self.upto = (np.concatenate([a, *p]) for a, p in zip((self.first, self.ids, self.width, self.upto), zip(*parts, strict=True), strict=True))

    def _lattice(self, us: list[str]):
        """start, stop and log sum of each unit, first edge of each state; ids, widths and summed probabilities of the edges.

        A state is a place in a unit or its end, or one between the bytes of a character that is no piece.
        """
        codes = np.frombuffer(("\0".join(us) + "\0").encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        n = len(codes)
        sizes = np.fromiter(map(len, us), np.int64, len(us))
        ends = np.cumsum(sizes + 1) - 1
        left = np.repeat(ends, sizes + 1) - np.arange(n)
        found = {}  # places and ids of the pieces of each size
        live, h = np.arange(n), np.zeros(n, np.uint64)
        for size in range(1, min(int(sizes.max()), self.longest) + 1):
            on = np.flatnonzero(left[live] >= size)
            live = live[on]
            h = h[on] * MULTIPLIER + codes[live + (size - 1)]
            if size in self.tables:
                table, ids = self.tables[size]
                i = np.flatnonzero(self.seen[size][h >> np.uint64(46)])  # few strings pass that are no pieces
                own = h[i]
                at = np.minimum(np.searchsorted(table, own), len(table) - 1)
                is_piece = np.flatnonzero(table[at] == own)
                found[size] = live[i[is_piece]], ids[at[is_piece]]
        no_piece = left > 0
        no_piece[found[1][0]] = False
        spelt = np.flatnonzero(no_piece)
        n_bytes = _utf8_len(codes[spelt])
        count = np.bincount(np.concatenate([spelt, *(i for i, _ in found.values())]), minlength=n)
        first = np.cumsum(count) - count
        row = np.repeat(np.arange(n), count)
        ids, width, weight = np.zeros(len(row), np.uint32), np.ones(len(row), np.int64), np.empty(len(row))
        free = first.copy()
        for size in sorted(found, reverse=True):  # the longest piece first
            i, own = found[size]
            at = free[i]
            ids[at], width[at], weight[at] = own, size, self.weight[own]
            free[i] += 1
        one = free[spelt]
        weight[one] = -BYTE_COST * n_bytes
        # sums over all ways from each place to its unit's end, places next to their ends first
        past = np.zeros(n + self.longest)
        p = np.empty(len(row))
        order = np.argsort(left.astype(np.uint16) if len(left) and left.max() < 2**16 else left, kind="stable")
        cut = np.searchsorted(left[order], np.arange(1, int(left.max()) + 2))
        order, cut = order[cut[0] :], cut - cut[0]
        many = count[order]
        begin = np.cumsum(many) - many
        edges = _gather(np.arange(len(row)), first[order], many)
        w, to = weight[edges], (row + width)[edges]
        edge_cut = np.append(begin, len(edges))[cut]
        for a, b, x, y in zip(cut[:-1].tolist(), cut[1:].tolist(), edge_cut[:-1].tolist(), edge_cut[1:].tolist(), strict=True):
            at, of = begin[a:b] - x, many[a:b]
            t = w[x:y] + past[to[x:y]]
            top = np.maximum.reduceat(t, at)
            t = np.exp(t - np.repeat(top, of))
            total = np.add.reduceat(t, at)
            past[order[a:b]] = top + np.log(total)
            p[edges[x:y]] = t / np.repeat(total, of)
        upto = p
        on, k = np.flatnonzero(count > 1), 1
        while len(on):
            upto[first[on] + k] += upto[first[on] + k - 1]
            k += 1
            on = on[count[on] > k]
        upto[(first + count - 1)[count > 0]] = 1.0
        state = row
        place = np.arange(n + 1)
        if len(spelt):
            extra = np.zeros(n + 1, np.int64)
            extra[spelt + 1] = n_bytes - 1
            place = place + np.cumsum(extra)
            state, width = place[row], place[row + width] - place[row]
            raw = [chr(c).encode("utf-8", "surrogatepass") for c in codes[spelt].tolist()]
            ids[one], width[one] = self.bytes[[b[0] for b in raw]], 1
            more = [(place[i] + k, b[k]) for i, b in zip(spelt.tolist(), raw, strict=True) for k in range(1, len(b))]
            if more:
                at, b = (np.array(x, np.int64) for x in zip(*more, strict=True))
                state = np.concatenate([state, at])
                by = np.argsort(state, kind="stable")
                state, ids, width, upto = state[by], np.concatenate([ids, self.bytes[b]])[by], np.concatenate([width, np.ones(len(at), np.int64)])[by], np.concatenate([upto, np.ones(len(at))])[by]
        count = np.bincount(state, minlength=place[n])
        return place[ends - sizes], place[ends], past[ends - sizes], np.cumsum(count) - count, ids.astype(self.id_type), width.astype(np.uint8), upto

    def best(self, units: np.ndarray) -> bytes:
        return _gather(self.best_ids, self.best_start[units], self.best_len[units]).astype("<u4").tobytes()

    def walk(self, units: np.ndarray, keys: np.ndarray):
        """A segmentation of each unit, drawn by probability: edges one after the other, their number for each unit, log probability, and the share of all others."""
        state, stop = self.start[units], self.stop[units]
        n = len(units)
        steps, log_p, share, rest = np.zeros(n, np.int64), -self.log_sum[units], np.ones(n), np.zeros(n)
        live, found = np.arange(n), []
        while len(live):
            u = _uniform(keys, len(found))
            first = self.first[state]
            e = first.copy()
            on = np.flatnonzero(u >= self.upto[e])
            while len(on):
                e[on] += 1
                on = on[u[on] >= self.upto[e[on]]]
            p = self.upto[e]
            on = np.flatnonzero(e > first)
            p[on] -= self.upto[e[on] - 1]
            rest[live] += share[live] * (1 - p)
            share[live] *= p
            log_p[live] += self.weight[self.ids[e]]
            found.append((live, e))
            state = state + self.width[e]
            go = np.flatnonzero(state < stop)
            steps[live] += 1
            live, state, stop, keys = live[go], state[go], stop[go], keys[go]
        begin = np.cumsum(steps) - steps
        edges = np.empty(int(steps.sum()), np.int64)
        for k, (live, e) in enumerate(found):
            edges[begin[live] + k] = e
        return edges, steps, log_p, rest

    def other(self, unit: int, taken: list[tuple], seed: int):
        """Another segmentation of a unit than those ``taken`` (edges each), drawn by probability: (edges, log probability, share of those still left); None if all are taken."""
        stop, noise = int(self.stop[unit]), random.Random(seed).random
        begin = int(self.start[unit])

        def edges_of(state: int):
            a, out, before = int(self.first[state]), [], 0.0
            for e, upto, width in zip(range(a, a + self.longest), self.upto[a : a + self.longest].tolist(), self.width[a : a + self.longest].tolist(), strict=False):
                out.append((e, upto - before, state + width))
                before = upto
                if upto == 1.0:
                    return out
            return out

        def left_of(taken: list[tuple]):
            """A tree of the taken ways: (child by edge, edges, share left) of each node."""
            tree: list[tuple[dict, list]] = [({}, edges_of(begin))]
            for way in taken:
                node, state = 0, begin
                for e in way:
                    state += int(self.width[e])
                    if e not in tree[node][0]:
                        tree[node][0][e] = len(tree)
                        tree.append(({}, edges_of(state) if state < stop else []))
                    node = tree[node][0][e]
            left = [0.0] * len(tree)
            for k in range(len(tree) - 1, -1, -1):
                child, edges = tree[k]
                left[k] = sum(p * (left[child[e]] if e in child else 1.0) for e, p, _ in edges)
            return tree, left

        tree, left = left_of(taken)
        if left[0] <= 0:
            return None
        node, state, way = 0, begin, []
        while state < stop:
            edges = tree[node][1] if node is not None else edges_of(state)
            free = [p * (left[tree[node][0][e]] if node is not None and e in tree[node][0] else 1.0) for e, p, _ in edges]
            u = noise() * sum(free)
            k = max(j for j, f in enumerate(free) if f > 0)
            for j, f in enumerate(free):
                u -= f
                if u < 0 and f > 0:
                    k = j
                    break
            e, _, to = edges[k]
            way.append(e)
            node, state = tree[node][0].get(e) if node is not None else None, to
        way_ = tuple(way)
        return way_, float(self.weight[self.ids[list(way)]].sum() - self.log_sum[unit]), left_of([*taken, way_])[1][0]

    def decode(self, ids: np.ndarray) -> str:
        return _gather(self.text, self.text_start[ids], self.text_len[ids])[1:].tobytes().decode("utf-8", "replace")


def _utf8_len(codes: np.ndarray) -> np.ndarray:
    return 1 + (codes >= 0x80).astype(int) + (codes >= 0x800) + (codes >= 0x10000)


class _Path:
    """A way through a text: from unit ``at`` on its own edges (``begin``: of each unit, and their end); before that its parent's."""

    def __init__(self, parent, at, head, edges, steps, log_p, rest, before, arrival, noise):
        """``head``: (edges, log probability) of unit ``at`` where it leaves its parent; ``rest``, ``log_p``, ``steps`` of the units behind."""
        self.parent, self.at, self.arrival = parent, at, arrival
        self.edges = np.concatenate([np.array(head[0], np.int64), edges]) if head else edges
        self.begin = np.concatenate([[0], np.cumsum(np.concatenate([[len(head[0])], steps]) if head else steps)])
        self.log_p = before + np.concatenate([[0.0], np.cumsum(np.concatenate([[head[1]], log_p]) if head else log_p)])
        self.shift = 1 if head else 0
        with np.errstate(divide="ignore"):
            mass = np.log(rest) + self.log_p[self.shift : -1]
            self.queue = np.logaddexp(arrival, np.log(noise) - mass) if len(mass) else np.zeros(0)
        self.taken: dict[int, list[tuple]] = {}
        self.next()

    def next(self):
        k = int(np.argmin(self.queue)) if len(self.queue) else -1
        self.soonest = (float(self.queue[k]), k) if k >= 0 else (np.inf, -1)

    def way(self, k: int) -> tuple:
        k += self.shift
        return tuple(self.edges[self.begin[k] : self.begin[k + 1]].tolist())

    def whole(self) -> np.ndarray:
        if self.parent is None:
            return self.edges
        head = self.parent.whole()
        return np.concatenate([head[: self.parent.upto(self.at)], self.edges])

    def upto(self, at: int) -> int:
        """Number of edges before unit ``at``."""
        if at <= self.at:
            return self.parent.upto(at) if self.parent is not None else 0
        return (self.parent.upto(self.at) if self.parent is not None else 0) + int(self.begin[at - self.at])


def _mixed(*numbers: int) -> int:
    x = 0
    for n in numbers:
        x = (x + n + 1) * 0x9E3779B97F4A7C15 % 2**64
        x ^= x >> 29
    return x * 0xBF58476D1CE4E5B9 % 2**64


def sample_top_k(codec: Codec, chains: list[np.ndarray], seeds: list[int], k: int):
    """For each chain of unit numbers: its k samples as (edges, log_prob, inclusion), in the order of the search.

    All paths of one turn are walked side by side; a text with fewer
    segmentations than ``k`` gives them all.
    """
    paths: list[list[_Path]] = [[] for _ in chains]
    for turn in range(k):
        todo = []  # (text, unit from which to walk, how the path leaves its parent)
        for d, units in enumerate(chains):
            if not turn:
                arrival = float(np.log(-np.log((_mixed(seeds[d]) + 0.5) / 2**64)))
                todo.append((d, 0, (None, 0, None, 0.0, arrival)))
            elif len(paths[d]) == turn:
                p = min(paths[d], key=lambda p: p.soonest[0])
                arrival, at = p.soonest
                if arrival == np.inf:
                    continue
                unit = p.at + p.shift + at
                taken = p.taken.setdefault(at, [p.way(at)])
                found = codec.other(int(units[unit]), taken, _mixed(seeds[d], turn, unit))
                before = float(p.log_p[p.shift + at])
                if found is None:  # rounding held a share that is none
                    p.queue[at] = np.inf
                    p.next()
                    continue
                way, log_p, left = found
                taken.append(way)
                wait = -np.log(random.Random(_mixed(seeds[d], turn, unit, 1)).random() or 2.0**-54)
                p.queue[at] = np.logaddexp(arrival, np.log(wait) - np.log(left) - before) if left > 0 else np.inf
                p.next()
                todo.append((d, unit + 1, (p, unit, (way, log_p), before, arrival)))
        if not todo:
            break
        lens = np.array([len(chains[d]) - at for d, at, _ in todo])
        flat = np.concatenate([chains[d][at:] for d, at, _ in todo])
        seed = np.array([_mixed(seeds[d], turn) for d, _, _ in todo], np.uint64)
        place = np.arange(len(flat)) + np.repeat(np.array([at for _, at, _ in todo]) - np.cumsum(lens) + lens, lens)
        keys = np.repeat(seed, lens) + place.astype(np.uint64) * MULTIPLIER
        edges, steps, log_p, rest = codec.walk(flat, keys)
        noise = -np.log(_uniform(keys, -2))
        unit_cut = np.concatenate([[0], np.cumsum(lens)])
        edge_cut = np.concatenate([[0], np.cumsum(steps)])[unit_cut].tolist()
        unit_cut = unit_cut.tolist()
        for j, (d, _, (parent, at, head, before, arrival)) in enumerate(todo):
            a, b = unit_cut[j], unit_cut[j + 1]
            paths[d].append(_Path(parent, at, head, edges[edge_cut[j] : edge_cut[j + 1]], steps[a:b], log_p[a:b], rest[a:b], before, arrival, noise[a:b]))
    out = []
    for found in paths:
        limit = min(p.soonest[0] for p in found)
        out.append([(p.whole(), float(p.log_p[-1]), float(-np.expm1(-np.exp(np.clip(p.log_p[-1] + limit, -700, 700)))) if limit < np.inf else 1.0) for p in found])
    return out


def _encode(batches, path: str, samples: int):
    release()  # what an earlier task of the worker has left
    codec = Codec(path)
    for batch in batches:
        chars = pc.fill_null(pc.utf8_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        for rows in np.split(np.arange(batch.num_rows), np.flatnonzero(np.diff((np.cumsum(chars) - chars) // GROUP_CHARS)) + 1):
            if not len(rows):
                continue
            part = batch.slice(int(rows[0]), len(rows))
            keys = part.column(0)
            if len(codec.ids) > CACHE_EDGES:
                codec.forget(CACHE_EDGES // 2)
            chains = codec.chains(part.column(1))
            codec.learn()
            seeds = [zlib.crc32(str(key).encode()) * 0x9E3779B97F4A7C15 % 2**64 for key in keys.to_pylist()]
            found = [[{"ids": codec.ids[e].astype("<u4").tobytes(), "log_prob": p, "inclusion": q} for e, p, q in top] for top in sample_top_k(codec, chains, seeds, samples)]
            best = [codec.best(units) for units in chains]
            yield pa.RecordBatch.from_arrays(
                [keys, pa.array(best, pa.binary()), pa.array(found, pa.list_(pa.struct([("ids", pa.binary()), ("log_prob", pa.float64()), ("inclusion", pa.float64())]))), pa.array([codec.decode(np.frombuffer(b, "<u4")) for b in best], pa.string())],
                ["doc_id", "ids", "samples", "decoded"],
            )


def encode(docs: DataFrame, path: str, samples: int = SAMPLES) -> DataFrame:
    """doc_id, BPE ids, sampled segmentations (ids are little-endian unsigned 32-bit) and the decoded ids of each whole text.

    Null and empty texts have no ids and one sample, the empty one.  Rows with
    equal doc_id and text get equal samples; a null doc_id is a key like others.
    """

    def run(batches):
        yield from _encode(batches, path, samples)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, SCHEMA)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and the text of its ids; exact but that a word mark character in a text comes back as a space."""

    def run(batches):
        codec = Codec(path)
        for batch in batches:
            texts = [codec.decode(np.frombuffer(b or b"", "<u4")) for b in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def digest(encoded: DataFrame) -> DataFrame:
    """Counts and checksums in place of the ids and the decoded text."""
    n = lambda c: (F.octet_length(c) / 4).cast("long")
    return encoded.select("doc_id", n(F.col("ids")).alias("n_tokens"), F.crc32("ids").alias("ids_crc32"), F.sha1(F.encode("decoded", "UTF-8")).alias("decoded_sha1"),
                          F.transform("samples", lambda s: F.struct(n(s["ids"]).alias("n_tokens"), F.crc32(s["ids"]).alias("ids_crc32"), s["log_prob"].alias("log_prob"), s["inclusion"].alias("inclusion"))).alias("samples"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digest(encode(read_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model")))
