"""Scoring of texts by logistic mixing of hashed-context bit predictors.

A text is its lower-cased bytes and an end.  Each bit of a byte is predicted
from what the training documents hold after the same context: the last 0 to 5
bytes, and the word so far (up to 13 bytes, its far part hashed).  The
predictors' log odds are combined by weights which three gates choose (the
longest context that is known and how well, the bit and how certain order 5
is, the kind of the last byte), a second layer combines the three, and a table
of hit rates refines what comes out.  These numbers are learned from every byte
of the training documents, each judged without itself: a range of keys learns
weights online from its own keys, as often as they occur, and the ranges'
weights are averaged, each by how many bits it had for them; hit rates are
summed.  Within each document three temperatures of the prediction are
weighed by how well they have done so far; summed over a document that is a
mixture of three products, so it needs no order of bits.  ``score`` is the
log10 probability of the whole text.

Counts cover every training document.  A context and the byte after it is one
64-bit key; a block of texts sends each of its keys once with its count, keys
are summed by range of their mixed last three bytes (so orders 3 and up meet in
one range), and the answer to a key is its cost in bits.  Orders 0 to 2, at
most 2**24 numbers whatever the input, are summed and broadcast.  Tokens of the
base score travel beside the keys, as bytes.

Nulls: a null text is empty (its end is still scored), a null doc_id counts as
an empty text in the split.  Rows with one id and text have one score.  Empty
tables give no rows; without training documents every bit costs one bit.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .blocks import NULL_ID, Bucketed, join_blobs, pack_array, ranges, release, split_blobs, unpack_array, write_blocks, write_bucketed
from .shared import materialize, read_table

END = 255  # never in UTF-8
PAD = 13
ORDERS = 7  # 0 to 5, and the word
SHORT = 3  # orders below come from the broadcast table
TEMPERATURES = (0.8, 1.0, 1.4)
#: Bits that are predicted before they move the weights, at least; and steps of a range, unless its keys are few or a step had over CHUNK.
STEP_BITS, STEPS = 256, 64
#: Averages of weights are taken in whole numbers of this fraction, so that sums do not depend on their order.
UNIT = 1 << 16
PRIOR = 0.3
CHUNK = 1 << 14
STRETCH = 1 << 14

RESULT_SCHEMA = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, n_bytes long, bits_per_byte double"
M24 = np.uint64(2**24 - 1)
_ODD, _ODD_INVERSE = np.uint64(0x9E3779), np.uint64(pow(0x9E3779, -1, 2**24))

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_KIND = np.full(256, 7, np.uint8)  # of the last byte: space, vowel, letter, digit, mark, not ASCII, begin, other
_KIND[[9, 10, 11, 12, 13, 32]] = 0
_KIND[97:123] = 2
_KIND[list(b"aeiou")] = 1
_KIND[48:58] = 3
_KIND[[c for c in range(33, 127) if not chr(c).isalnum()]] = 4
_KIND[128:] = 5
_KIND[END] = 6


def held_out(doc_id: int | None) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 7 == 2


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x * _ODD & M24
    return (x ^ x >> np.uint64(12)) * _ODD & M24


def _unmixed(x: np.ndarray) -> np.ndarray:
    x = x * _ODD_INVERSE & M24
    return (x ^ x >> np.uint64(12)) * _ODD_INVERSE & M24


# Contexts ---------------------------------------------------------------------


def keys_of(lens: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A key for each byte of each text and its end, in order; and how many each text has.

    Bits: 24 of the three last bytes, mixed; the fourth and fifth last; 16 of
    the word before those; the byte itself.
    """
    n = len(lens)
    s = np.full(len(data) + n * (PAD + 1) + 8, END, np.uint8)
    begins = np.cumsum(lens) - lens
    starts = begins + np.arange(n) * (PAD + 1)
    own = np.ones(len(s) - PAD - 8, bool)  # places behind the first PAD
    for at, to, k in zip(begins.tolist(), starts.tolist(), lens.tolist(), strict=True):
        s[to + PAD : to + PAD + k] = _LOWER[data[at : at + k]]
        own[max(to - PAD, 0) : to] = False
    words = np.ndarray((len(s) - 7,), "<u8", buffer=s, strides=(1,)).copy()
    place = np.arange(len(own) + PAD - 1, dtype=np.int32)
    last = s[: len(place)]
    word = np.where((last > 32) & (last != END), np.int32(0), place)
    np.maximum.accumulate(word, out=word)
    np.subtract(place, word, out=word)
    word = word[PAD - 1 :]  # bytes of the word before each place
    key = np.empty(len(own), np.uint64)
    for a in range(0, len(own), STRETCH):  # stretches that stay in the processor's cache
        z = min(a + STRETCH, len(own))
        _keys(words[a:z], words[a + 8 : z + 8], word[a:z], key[a:z])
    return key[own], lens + 1


def _keys(far: np.ndarray, near: np.ndarray, word: np.ndarray, key: np.ndarray) -> None:
    """Keys from the 8 bytes from the 13th last and from the 5th last on, and the length of the word so far."""
    c = np.uint64
    far = far >> (c(8) * (c(8) - np.clip(word - 5, 1, 8).astype(np.uint64)))
    far[word == 5] = 0
    far *= c(0x9E3779B97F4A7C15)
    far >>= c(48)
    np.minimum(far, c(65533), out=far)
    far += c(1)
    far[word < 5] = 0
    key[:] = _mixed(near >> c(16) & M24)
    for bits, part in ((8, near >> c(8) & c(255)), (8, near & c(255)), (16, far), (8, near >> c(40) & c(255))):
        key <<= c(bits)
        key |= part


def _of_order(keys: np.ndarray, order: int) -> np.ndarray:
    """The keys with less context: what is left of it above, the byte in the last 8 bits."""
    if order == 6:
        return keys
    byte = keys & np.uint64(255)
    if order >= 3:
        return keys >> np.uint64(64 - 8 * order) << np.uint64(8) | byte
    last = _unmixed(keys >> np.uint64(40))  # the third last byte is the lowest
    return (last >> np.uint64(8 * (3 - order))) << np.uint64(8) | byte


class Counts(NamedTuple):
    """Sorted keys of one order, and the running sum of their counts."""

    keys: np.ndarray
    sums: np.ndarray

    @classmethod
    def of(cls, keys: np.ndarray, counts: np.ndarray) -> Counts:
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        new = np.ones(len(keys), bool)
        new[1:] = keys[1:] != keys[:-1]
        first = np.flatnonzero(new)
        return cls(keys[first], np.concatenate([[0], np.cumsum(np.add.reduceat(counts, first) if len(first) else counts)]))

    def levels(self, asked: np.ndarray) -> np.ndarray:
        """(9, n): how often the context was followed by a byte with the same first 0 to 8 bits."""
        out = np.empty((9, len(asked)), np.int64)
        low, high = np.searchsorted(self.keys, asked & ~np.uint64(255)), np.searchsorted(self.keys, asked | np.uint64(255), "right")
        out[0] = self.sums[high] - self.sums[low]
        for j in range(1, 9):  # each bit leaves one half of the keys, so one bound stays
            half = np.uint64(1 << (8 - j))
            middle = np.searchsorted(self.keys, asked & ~(half - np.uint64(1)) | half)
            one = (asked & half) != 0
            low, high = np.where(one, middle, low), np.where(one, high, middle)
            out[j] = self.sums[high] - self.sums[low]
        return out


# Mixing -----------------------------------------------------------------------


def evidence(n: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """From levels (ORDERS, 9, keys): log odds of the true bits (keys * 8, ORDERS), the three gates, and the bits' places."""
    total, true = n[:, :8], n[:, 1:]
    odds = np.log((true + PRIOR) / (total - true + PRIOR)).astype(np.float32)
    seen = total > 0
    top = np.where(seen.any(axis=0), ORDERS - 1 - np.argmax(seen[::-1], axis=0), 0)
    much = np.take_along_axis(total, top[None], 0)[0]
    known = top * 4 + (much > 1) + (much > 3) + (much > 15)
    one_sided = np.minimum(true[5], total[5] - true[5]) == 0
    certain = np.where(total[5] == 0, 0, np.where(one_sided, np.where(total[5] == 1, 1, 2), 3))
    bit = np.arange(8)[:, None]
    gates = np.stack([known, bit * 4 + certain, kind[None].astype(np.int64) * 8 + bit])
    flat = lambda a: a.swapaxes(-1, -2).reshape(*a.shape[:-2], -1)
    return np.ascontiguousarray(flat(odds).T), flat(gates), np.tile(np.arange(8), n.shape[2])


class Mixer:
    """Weights chosen by gates, a layer above them, and hit rates; learned online."""

    SIZES = (4 * ORDERS, 32, 64)
    STRENGTHS = 32

    def __init__(self):
        self.weights = [np.full((k, ORDERS), 0.2, np.float32) for k in self.SIZES]
        self.upper = np.full((8, 3), 1 / 3, np.float32)
        centre = 1 / (1 + np.exp(-(np.arange(self.STRENGTHS) + 0.5) / 2))
        self.hits = np.tile(centre * 16, (self.SIZES[0], 1))
        self.tries = np.full((self.SIZES[0], self.STRENGTHS), 16.0)
        self.seen = [np.zeros(len(w), np.int64) for w in (*self.weights, self.upper)]  # bits that each row has learned from
        self._squares = [np.full(w.shape, 1e-3, np.float32) for w in (*self.weights, self.upper)]

    def sums(self) -> np.ndarray:
        """What of this mixer adds up with others: weights times the bits they have learned from, those bits, hits (twice) and tries."""
        first = Mixer()
        layers = [np.rint(w.astype(float) * UNIT).astype(np.int64) * n[:, None] for w, n in zip((*self.weights, self.upper), self.seen, strict=True)]
        rates = [np.rint(2 * (self.hits - first.hits)).astype(np.int64), np.rint(self.tries - first.tries).astype(np.int64)]
        return np.concatenate([a.ravel() for a in (*layers, *self.seen, *rates)])

    @classmethod
    def of_sums(cls, sums: np.ndarray) -> Mixer:
        """The average of mixers from what ``sums`` add up to; rows that have learned nothing are as at first."""
        out, at = cls(), 0

        def take(like: np.ndarray) -> np.ndarray:
            nonlocal at
            at += like.size
            return sums[at - like.size : at].reshape(like.shape)

        layers = (*out.weights, out.upper)
        totals = [take(w) for w in layers]
        out.seen = [take(n) for n in out.seen]
        for w, total, n in zip(layers, totals, out.seen, strict=True):
            w[n > 0] = (total[n > 0] / n[n > 0][:, None] / UNIT).astype(np.float32)
        out.hits += take(out.hits) / 2
        out.tries += take(out.tries)
        return out

    def layers(self, odds: np.ndarray, gates: np.ndarray, bit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first = np.stack([np.einsum("ij,ij->i", w[g], odds) for w, g in zip(self.weights, gates, strict=True)], axis=1)
        first = np.clip(first, -16, 16)
        return first, np.clip(np.einsum("ij,ij->i", self.upper[bit], first), -16, 16)

    def _place(self, s: np.ndarray) -> np.ndarray:
        return np.minimum((2 * np.abs(s)).astype(np.int64), self.STRENGTHS - 1)

    def refined(self, odds: np.ndarray, gates: np.ndarray, bit: np.ndarray) -> np.ndarray:
        """Log odds of the true bits; a bit and its opposite have opposite ones."""
        _, s = self.layers(odds, gates, bit)
        place = self._place(s)
        rate = self.hits[gates[0], place] / self.tries[gates[0], place]
        return (s + np.sign(s) * np.log(rate / (1 - rate))) / 2

    def learn(self, odds: np.ndarray, gates: np.ndarray, bit: np.ndarray, times: np.ndarray | None = None, step: int = STEP_BITS) -> None:
        """Online: ``step`` bits are predicted, then they move weights and hit rates, each as many ``times`` as it occurs."""
        times = np.ones(len(bit), np.int64) if times is None else times
        for a in range(0, len(bit), step):
            o, g, b, n = odds[a : a + step], gates[:, a : a + step], bit[a : a + step], times[a : a + step]
            first, s = self.layers(o, g, b)
            place = g[0] * self.STRENGTHS + self._place(s)
            self.hits += np.bincount(place, n * np.where(s > 0, 1.0, np.where(s < 0, 0.0, 0.5)), self.hits.size).reshape(self.hits.shape)
            self.tries += np.bincount(place, n, self.tries.size).reshape(self.tries.shape)
            share = n / n.mean()
            steps = [(w, at, o, share / (1 + np.exp(f))) for w, at, f in zip(self.weights, g, first.T, strict=True)]
            steps.append((self.upper, b, first, share / (1 + np.exp(s))))
            for (w, at, x, error), q, seen in zip(steps, self._squares, self.seen, strict=True):
                move = np.stack([np.bincount(at, error * x[:, k], len(w)) for k in range(w.shape[1])], axis=1).astype(np.float32)
                q += move * move
                w += 0.1 * move / np.sqrt(q)
                seen += np.rint(np.bincount(at, n, len(w))).astype(np.int64)

    def bits(self, n: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """(temperatures, keys): the cost of each key's byte, from its levels."""
        s = self.refined(*evidence(n, _kind_before(keys)))
        return np.stack([(np.logaddexp(0, -t * s) / math.log(2)).reshape(-1, 8).sum(axis=1) for t in TEMPERATURES])


def mixture(bits: np.ndarray) -> np.ndarray:
    """Bits of texts from their bits under each temperature (temperatures, texts): each has weighed a third at first."""
    least = bits.min(axis=0)
    return least - np.log2(np.mean(np.exp2(least - bits), axis=0))


# What a block sends ---------------------------------------------------------------


def _texts(ids: np.ndarray, lens: np.ndarray, data: np.ndarray) -> Iterator[tuple[int | None, bytes]]:
    raw, at = data.tobytes(), 0
    for i, n in zip(ids.tolist(), lens.tolist(), strict=True):
        yield None if i == NULL_ID else i, raw[at : at + n]
        at += n


def _distinct(sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    new = np.ones(len(sorted_keys), bool)
    new[1:] = sorted_keys[1:] != sorted_keys[:-1]
    first = np.flatnonzero(new)
    return sorted_keys[first], np.diff(np.append(first, len(sorted_keys)))


def _places(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Place of each key in the sorted table, which has it: a hash first, a search for keys that share one."""
    bits = max(8, len(table).bit_length() + 2)
    spread = lambda k: k * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - bits)
    slots = np.zeros(1 << bits, np.int32)
    slots[spread(table)] = np.arange(len(table))
    place = slots[spread(keys)]
    shared = np.flatnonzero(table[place] != keys)
    place[shared] = np.searchsorted(table, keys[shared])
    return place


def _union(parts: list[np.ndarray]) -> np.ndarray:
    return _distinct(np.sort(np.concatenate(parts)))[0] if parts else np.zeros(0, np.uint64)


def gathered(pieces) -> tuple[np.ndarray, np.ndarray, Counter]:
    """A block's keys, sorted, how often training documents have each, and the same of its tokens; b"" counts the training documents."""
    parts, tokens = [], Counter()
    for ids, lens, data in pieces:
        keys, sizes = keys_of(lens, data)
        train = np.array([not held_out(None if i == NULL_ID else i) for i in ids.tolist()], bool)
        mask = np.repeat(train, sizes)
        parts += [_distinct(np.sort(keys[mask])), (_distinct(np.sort(keys[~mask]))[0], None)]
        for (_, text), learn in zip(_texts(ids, lens, data), train.tolist(), strict=True):
            words = text.lower().split()
            words.append(b"")
            tokens.update(words if learn else dict.fromkeys(words, 0))
    union = _union([k for k, _ in parts])
    counts = np.zeros(len(union), np.int64)
    for keys, n in parts:
        if n is not None:
            counts[np.searchsorted(union, keys)] += n
    release()
    return union, counts, tokens


def _words_by_bucket(tokens: Counter, n: int) -> dict[int, list[bytes]]:
    """Tokens by range of their hash, each range in a fixed order."""
    step, out = (2**64 - 1) // n + 1, {}
    for w in tokens:
        out.setdefault(xxhash.xxh64_intdigest(w) // step, []).append(w)
    for words in out.values():
        words.sort()
    return out


def _small(b: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(b)


def _large(b: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompressobj().decompress(b)


def _send(pieces, n: int) -> Iterator[tuple[int, bytes]]:
    keys, counts, tokens = gathered(pieces)
    words = _words_by_bucket(tokens, n)
    found = {bucket: (a, b) for bucket, a, b in ranges(keys, n)}
    for bucket in sorted(found.keys() | words.keys()):
        a, b = found.get(bucket, (0, 0))
        own = words.get(bucket, [])
        yield bucket, join_blobs([pack_array(keys[a:b], is_sorted=True), pack_array(counts[a:b]), _small(b"\n".join(own)), pack_array(np.array([tokens[w] for w in own], np.int64))])


class Range(NamedTuple):
    """All blocks' messages of a range: keys and counts of each, and of all; tokens likewise."""

    each: list[np.ndarray]
    keys: np.ndarray
    counts: np.ndarray
    words: list[list[bytes]]
    tokens: Counter

    @classmethod
    def of(cls, blobs: list[bytes]) -> Range:
        each, numbers, words, tokens = [], [], [], Counter()
        for blob in blobs:
            k, c, w, m = split_blobs(blob)
            each.append(unpack_array(k, is_sorted=True))
            numbers.append(unpack_array(c).astype(np.int64))
            own = unpack_array(m).tolist()
            words.append(_large(w).split(b"\n") if own else [])
            tokens.update(dict(zip(words[-1], own, strict=True)))
        keys = _distinct(np.sort(np.concatenate(each)))[0]
        counts = np.zeros(len(keys), np.int64)
        for k, c in zip(each, numbers, strict=True):
            counts[np.searchsorted(keys, k)] += c
        return cls(each, keys, counts, words, tokens)


def _per_range(messages: Bucketed, of: Callable[[int, Range], pa.Table], schema: str) -> DataFrame:
    def body(table: pa.Table) -> pa.Table:
        out = of(table["bucket"][0].as_py(), Range.of(table["blob"].to_pylist()))
        release()
        return out

    return messages.frame().groupBy("bucket").applyInArrow(body, schema)


def _sums(messages: Bucketed) -> tuple[Counts, int, int]:
    """The broadcast table (order 2, from which 1 and 0 follow), training tokens and distinct ones."""

    def of(_, r: Range) -> pa.Table:
        known = r.counts > 0
        c = Counts.of(_of_order(r.keys[known], 2), r.counts[known])
        found = [v for v in r.tokens.values() if v]
        return pa.table({"k": pa.array([*c.keys.tolist(), -1, -2], pa.int64()), "n": pa.array([*np.diff(c.sums).tolist(), sum(found), len(found)], pa.int64())})

    got = _per_range(messages, of, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).toPandas().sort_values("k")
    k, n = got["k"].to_numpy(), got["n"].to_numpy()
    both = dict(zip(k[k < 0].tolist(), n[k < 0].tolist(), strict=True))
    return Counts.of(k[k >= 0].astype(np.uint64), n[k >= 0].astype(np.int64)), both.get(-1, 0), both.get(-2, 0)


def _short_counts(table: Counts) -> list[Counts]:
    """Counts of orders 0 to 2 from the broadcast table."""
    counts = np.diff(table.sums)
    less = lambda k, o: (k >> np.uint64(8)) >> np.uint64(8 * (2 - o)) << np.uint64(8) | k & np.uint64(255)
    return [Counts.of(less(table.keys, o), counts) for o in range(SHORT)]


def _counted(r: Range, table: Counts) -> tuple[np.ndarray, np.ndarray, Callable[[np.ndarray], np.ndarray]]:
    """Keys of a range that training documents have, how often, and a function that gives the levels of keys in all orders."""
    known = r.counts > 0
    keys, counts = r.keys[known], r.counts[known]
    by_order = [*_short_counts(table), *(Counts.of(_of_order(keys, o), counts) for o in range(SHORT, ORDERS))]
    return keys, counts, lambda asked: np.stack([c.levels(_of_order(asked, o)) for o, c in enumerate(by_order)])


def _kind_before(keys: np.ndarray) -> np.ndarray:
    return _KIND[(_unmixed(keys >> np.uint64(40)) >> np.uint64(16)).astype(np.int64)]


def learned_from(r: Range, table: Counts) -> Mixer:
    """A mixer from all keys of a range; a step has keys from all over it, and an occurrence is judged by all the others."""
    keys, counts, levels_of = _counted(r, table)
    mixer = Mixer()
    steps = max(-(-len(keys) // CHUNK), min(STEPS, len(keys) * 8 // STEP_BITS), 1)
    for k in range(steps if len(keys) else 0):
        asked = keys[k::steps]
        odds, gates, bit = evidence(levels_of(asked) - 1, _kind_before(asked))
        mixer.learn(odds, gates, bit, np.repeat(counts[k::steps], 8), len(bit))
    return mixer


def fit_mixer(messages: Bucketed, table: Counts) -> Mixer:
    """The average of what each range of keys has learned."""

    def of(_, r: Range) -> pa.Table:
        sums = learned_from(r, table).sums()
        at = np.flatnonzero(sums)
        return pa.table({"at": pa.array(at, pa.int64()), "n": pa.array(sums[at], pa.int64())})

    sums = np.zeros(len(Mixer().sums()), np.int64)
    for r in _per_range(messages, of, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():  # some thousand numbers, whatever the input
        sums[r["at"]] = r["n"]
    return Mixer.of_sums(sums)


def _costs(r: Range, table: Counts, mixer: Mixer) -> np.ndarray:
    """(temperatures, keys) in bits; half precision has three digits, and errors of many keys cancel."""
    _, _, levels_of = _counted(r, table)
    out = np.empty((len(TEMPERATURES), len(r.keys)), np.float16)
    for a in range(0, len(r.keys), CHUNK):
        asked = r.keys[a : a + CHUNK]
        out[:, a : a + CHUNK] = mixer.bits(levels_of(asked), asked)
    return out


def score_texts(docs: DataFrame, mixer: Mixer | None = None) -> DataFrame:
    """RESULT_SCHEMA and ``train_tokens`` of every row of ``docs`` (doc_id, text); without a mixer one is learned."""
    blocks = write_blocks(docs)
    n = 1 << (blocks.n_ranges - 1).bit_length()  # a power of two, so that no range cuts through the last three bytes
    messages = write_bucketed(blocks.scatter(lambda pieces, _: _send(pieces, n)).repartition(n, "bucket"), n, "bucket")
    table, n_tokens, distinct = _sums(messages)
    mixer = mixer or fit_mixer(messages, table)

    def answers(t: pa.Table) -> pa.Table:
        r = Range.of(t["blob"].to_pylist())
        costs = _costs(r, table, mixer)
        blobs = []
        for keys, words in zip(r.each, r.words, strict=True):
            planes = np.take(costs, np.searchsorted(r.keys, keys), axis=1).view(np.uint8).reshape(len(TEMPERATURES), len(keys), 2).transpose(0, 2, 1)
            blobs.append(join_blobs([_small(planes.tobytes()), _small(b"\n".join(words)), pack_array(np.array([r.tokens[w] for w in words], np.int64))]))
        release()
        return pa.table({"bid": t["bid"], "bucket": t["bucket"], "blob": pa.chunked_array([pa.array(blobs, pa.binary())])})

    replies = messages.frame().groupBy("bucket").applyInArrow(answers, "bid int, bucket int, blob binary")
    out = blocks.per_block(lambda _, pieces, got: _scored(pieces, got[0], n, n_tokens, distinct), RESULT_SCHEMA, replies)
    out = materialize(out.withColumn("train_tokens", F.lit(n_tokens).cast("long")), "scores")
    messages.drop()
    blocks.drop()
    return out


def _scored(pieces, replies: dict[int, bytes], n: int, n_tokens: int, distinct: int) -> pa.Table:
    own = []  # of each piece: its keys, and which of them each byte has
    for _, lens, data in pieces:
        every, sizes = keys_of(lens, data)
        mine = _distinct(np.sort(every))[0]
        own.append((mine, _places(mine, every), sizes))
    keys = _union([mine for mine, _, _ in own])
    release()
    cost, logs = np.zeros((len(TEMPERATURES), len(keys)), np.float16), {}
    found = {bucket: (a, b) for bucket, a, b in ranges(keys, n)}
    for bucket, blob in replies.items():
        planes, words, counts = split_blobs(blob)
        a, b = found.get(bucket, (0, 0))
        if b > a:
            cost[:, a:b] = np.frombuffer(_large(planes), np.uint8).reshape(len(TEMPERATURES), 2, b - a).transpose(0, 2, 1).copy().view(np.float16)[:, :, 0]
        numbers = unpack_array(counts).tolist()
        logs.update(zip(_large(words).split(b"\n"), (math.log10(c + 1) for c in numbers), strict=True) if numbers else ())
    unit = math.log10(n_tokens + distinct + 1)
    rows = []
    for (ids, lens, data), (mine, place, sizes) in zip(pieces, own, strict=True):
        at, begin = np.searchsorted(keys, mine), np.cumsum(sizes) - sizes
        bits = mixture(np.stack([np.add.reduceat(cost[k, at].astype(float)[place], begin) for k in range(len(TEMPERATURES))]))
        for (i, text), b in zip(_texts(ids, lens, data), bits.tolist(), strict=True):
            got = [logs[w] for w in text.lower().split()]
            got.append(logs[b""])
            rows.append((i, held_out(i), len(got), len(got) - got.count(0.0), math.fsum(got) - len(got) * unit, -b * math.log10(2), len(text), b / (len(text) + 1)))
    kinds = {"long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}
    columns = list(zip(*rows, strict=True)) or [()] * 8
    return pa.table({f.split()[0]: pa.array(c, kinds[f.split()[1]]) for f, c in zip(RESULT_SCHEMA.split(", "), columns, strict=True)})


def op13_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
