"""Suffix-array dedup by depth-limited most-significant-digit radix passes.

A suffix is looked at only through its first ``depth`` bytes (50), so a group
of suffixes that are still equal after the last pass *is* a repeated window,
and no full suffix array is built.  Passes narrow the set of suffixes, each
sorts by the next digit and lets go what stands alone:

1. *leading digit*: suffixes are keyed by the smallest 24-byte string hash
   inside their window (equal windows have equal keys, whatever surrounds
   them).  Neighbouring suffixes share the key, so one entry stands for up to
   27 of them.  Keys that only one document has are dropped.
2. *run digit*: all bytes under a run of suffixes with one key.  A run that a
   smaller document also has is decided here; runs that differ from all others
   of their key go on.
3. *full depth*: the 50 bytes of each suffix still open (128-bit hash).

Pass 1 compares 40 bits of a hash, where a false match only keeps a suffix for
the next pass.  The digits of passes 2 and 3 decide, as 128 bits each: four
multilinear hashes of 32 bits with keys drawn anew for every run, so two
different strings, whatever they hold, agree with probability 2**-128.  Over
10**14 windows (2**93 pairs) that is a chance of 2**-35 of any false match.
See ``blocks`` for how digits travel.
"""

from __future__ import annotations

import hashlib
import secrets
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .blocks import NULL, NULL_ID, answer, join_blobs, mix, pack_array, ranges, release, split_blobs, unpack_array, write_blocks
from .shared import materialize, read_table

DEPTH = 50
KEY = 24
RUN = DEPTH - KEY + 1
LOW24 = np.uint64(2**24 - 1)

RESULT_SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _words(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from every position on, as a number."""
    if len(data) < 8:
        return np.zeros(0, np.uint64)
    return np.ndarray((len(data) - 7,), "<u8", buffer=data, strides=(1,)).copy()


#: Keys of one window: a row for each 32 bits of its words, a column for each hash.
LANES, KEYS = 4, 14


class Keys(NamedTuple):
    """Random 64-bit numbers: for windows, for a run's first and last window, its length, and what is added."""

    window: np.ndarray
    head: np.ndarray
    tail: np.ndarray
    count: np.ndarray
    plus: np.ndarray

    @classmethod
    def draw(cls) -> Keys:
        raw = np.frombuffer(secrets.token_bytes(8 * LANES * (3 * KEYS + 2)), np.uint64).reshape(-1, LANES)
        return cls(raw[:KEYS], raw[KEYS : 2 * KEYS], raw[2 * KEYS : 3 * KEYS], raw[-2], raw[-1])


def _window(words: np.ndarray, at: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Multilinear sums (LANES, n) over the 50 bytes from each position on."""
    sums = np.zeros((LANES, len(at)), np.uint64)
    for j, k in enumerate((0, 8, 16, 24, 32, 40, DEPTH - 8)):
        word = words[at + k]
        for half, x in enumerate((word & np.uint64(0xFFFFFFFF), word >> np.uint64(32))):
            for lane in range(LANES):
                sums[lane] += x * keys[2 * j + half, lane]
    return sums


def _digits(sums: np.ndarray, plus: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The upper halves, which are what is evenly spread, as two numbers."""
    sums += plus[:, None]
    sums >>= np.uint64(32)
    return sums[0] << np.uint64(32) | sums[1], sums[2] << np.uint64(32) | sums[3]


def runs(lens: np.ndarray, data: np.ndarray):
    """(start, count, doc, key) of the runs of window starts with one key; count is at most RUN."""
    none = np.zeros(0, np.int64)
    ends = np.cumsum(lens)
    starts = ends - lens
    if len(data) < DEPTH:
        return (none, none, none, none.astype(np.uint64)), np.zeros(0, np.uint64)
    w = _words(data)
    n = len(data) - DEPTH + 1
    h = w[: len(data) - KEY + 1] * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(32)
    h += w[8 : 8 + len(h)]
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    h += w[16 : 16 + len(h)]
    h = mix(h)
    m = np.minimum(h[:-1], h[1:])
    for step in (2, 4, 8):
        m = np.minimum(m[:-step], m[step:])
    key = np.minimum(m[:n], m[RUN - 16 : RUN - 16 + n])
    edge = np.zeros(len(data) + 1, np.int8)
    long = lens >= DEPTH
    edge[starts[long]] += 1
    edge[ends[long] - DEPTH + 1] -= 1
    valid = np.cumsum(edge, dtype=np.int8)[:n].astype(bool)
    new = np.empty(n, bool)
    new[0] = True
    np.not_equal(key[1:], key[:-1], out=new[1:])
    new[1:] |= ~valid[:-1]
    first = np.flatnonzero(new & valid)
    if not len(first):
        return (none, none, none, none.astype(np.uint64)), w
    last = np.empty(n, bool)
    last[-1] = True
    last[:-1] = new[1:] | ~valid[1:]
    count = np.flatnonzero(last & valid) - first + 1
    if (parts := (count + RUN - 1) // RUN).max() > 1:  # periodic text: cut long runs at fixed steps
        nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        whole = np.repeat(count, parts)
        first = np.repeat(first, parts) + nth * RUN
        count = np.minimum(RUN, whole - nth * RUN)
    doc = np.searchsorted(starts[long], first, "right") - 1
    return (first, count, np.flatnonzero(long)[doc], mix(key[first])), w  # mixed: minima crowd at the low end, and keys are dealt out by range


def _local_min(ids: np.ndarray, *keys: np.ndarray):
    """Smallest id by key: (keys of each group..., id), sorted by keys, and for each row its group."""
    order = np.lexsort((ids, *keys[::-1]))
    new = np.zeros(len(order), bool)
    new[:1] = True
    for k in keys:
        s = k[order]
        new[1:] |= s[1:] != s[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    rep = order[new]
    return tuple(k[rep] for k in keys), ids[rep], group


def _send(keys: tuple[np.ndarray, ...], ids: np.ndarray, n: int):
    for bucket, a, b in ranges(keys[0], n):
        yield bucket, join_blobs([pack_array(keys[0][a:b], is_sorted=True), *(pack_array(k[a:b]) for k in keys[1:]), pack_array(ids[a:b])])


def _receive(replies: dict, keys: np.ndarray, n: int, bits: int) -> list[np.ndarray]:
    """The reply's flags, in the order of the sent (sorted) keys."""
    out = [np.zeros(len(keys), bool) for _ in range(bits)]
    for bucket, a, b in ranges(keys, n):
        for flag, raw in zip(out, split_blobs(replies[bucket]), strict=True):
            flag[a:b] = np.unpackbits(np.frombuffer(raw, np.uint8), count=b - a).astype(bool)
    return out


# The three passes' answers -----------------------------------------------------


def _in_many(blobs: list[bytes]) -> list[bytes]:
    """Pass 1: is the key in several blocks?"""
    got = [unpack_array(b, is_sorted=True) for b in blobs]
    every = np.sort(np.concatenate(got))
    twice = np.unique(every[1:][every[1:] == every[:-1]])
    return [join_blobs([np.packbits(_member(twice, a)).tobytes()]) for a in got]


def _member(table: np.ndarray, a: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(len(a), bool)
    at = np.minimum(np.searchsorted(table, a), len(table) - 1)
    return table[at] == a


def _before(blobs: list[bytes], *, split_keys: bool) -> list[bytes]:
    """Passes 2 and 3: does a smaller document have all digits alike; and, in pass 2, has the first digit several others?"""
    rows = [split_blobs(b) for b in blobs]
    n = [0, *np.cumsum([int.from_bytes(r[0][:8], "little") for r in rows])]
    first = np.concatenate([unpack_array(r[0], is_sorted=True) for r in rows])
    digits = [first, *(np.concatenate([unpack_array(r[k]) for r in rows]) for k in range(1, len(rows[0]) - 1))]
    ids = np.concatenate([unpack_array(r[-1]) for r in rows]).view(np.int64)
    kinds, least, group = _local_min(ids, *digits)
    flags = [least[group] < ids]
    if split_keys:
        same = kinds[0][1:] == kinds[0][:-1]
        several = np.zeros(len(least), bool)
        several[1:] |= same
        several[:-1] |= same
        flags.append(several[group])
    return [join_blobs([np.packbits(f[x:y]).tobytes() for f in flags]) for x, y in zip(n[:-1], n[1:], strict=True)]


# What a block knows after each pass ----------------------------------------------


class _State:
    """Runs of a block, and which of their windows are known to repeat in a smaller document."""

    def __init__(self, pieces):
        cols: list[list] = [[], [], [], []]
        self.pieces = []
        base = 0
        for ids, lens, data in pieces:
            (first, count, doc, key), _ = runs(lens, data)
            for c, v in zip(cols, (first + base, count, ids[doc], key), strict=True):
                c.append(v)
            self.pieces.append((base, ids, lens, data))
            base += len(data)
        self.size = base
        joined = []
        for c, t in zip(cols, (np.int64, np.int64, np.int64, np.uint64), strict=True):
            joined.append(np.concatenate(c) if c else np.zeros(0, t))
            c.clear()
        self.first, self.count, self.doc, self.key = joined
        release()

    def windows(self, at: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Window sums at sorted or unsorted positions of the block."""
        out = np.empty((LANES, len(at)), np.uint64)
        order = np.argsort(at, kind="stable")
        s = at[order]
        for base, _, _, data in self.pieces:
            x, y = np.searchsorted(s, (base, base + len(data)))
            if x < y:
                out[:, order[x:y]] = _window(_words(data), s[x:y] - base, keys)
        return out


def _short(key: np.ndarray) -> np.ndarray:
    """40 bits are enough to let go most of what stands alone."""
    return key & ~LOW24


def _pass1(st: _State) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    short, inverse = np.unique(_short(st.key), return_inverse=True)
    low, high = np.full(len(short), NULL_ID), np.full(len(short), np.int64(-(2**63)))
    np.minimum.at(low, inverse, st.doc)
    np.maximum.at(high, inverse, st.doc)
    return short, inverse, low != high


def _pass2(st: _State, draw: Keys, reply: dict, n: int):
    short, inverse, local = _pass1(st)
    (many,) = _receive(reply, short, n, 1)
    live = np.flatnonzero((many | local)[inverse])
    sums = st.windows(st.first[live], draw.head)
    sums += st.windows(st.first[live] + st.count[live] - 1, draw.tail)
    sums += st.count[live].astype(np.uint64) * draw.count[:, None]
    keys, least, group = _local_min(st.doc[live], st.key[live], *_digits(sums, draw.plus))
    release()
    return live, keys, least, group


def _pass3(st: _State, draw: Keys, reply1: dict, reply2: dict, n: int):
    live, keys, least, group = _pass2(st, draw, reply1, n)
    before, several = _receive(reply2, keys[0], n, 2)
    gone = (st.doc[live] > least[group]) | before[group]
    still = live[~gone & several[group]]
    nth = st.count[still]
    at = np.repeat(st.first[still] - np.cumsum(nth) + nth, nth) + np.arange(nth.sum())
    doc = np.repeat(st.doc[still], nth)
    keys3, least3, group3 = _local_min(doc, *_digits(st.windows(at, draw.window), draw.plus))
    release()
    return live[gone], at, doc, keys3, least3, group3


def covered(st: _State, draw: Keys, reply1: dict, reply2: dict, reply3: dict, n: int):
    """(ids, lens, bytes, mask) of each piece; the mask marks bytes under a window that a smaller document has."""
    gone, at, doc, keys3, least3, group3 = _pass3(st, draw, reply1, reply2, n)
    (before,) = _receive(reply3, keys3[0], n, 1)
    hit = np.sort(at[(doc > least3[group3]) | before[group3]])
    first, end = st.first[gone], st.first[gone] + st.count[gone] - 1 + DEPTH
    for base, ids, lens, data in st.pieces:
        edge = np.zeros(len(data) + 1, np.int16)
        for begin, past in ((first, end), (hit, hit + DEPTH)):
            x, y = np.searchsorted(begin, (base, base + len(data)))
            np.add.at(edge, begin[x:y] - base, 1)
            np.add.at(edge, past[x:y] - base, -1)
        yield ids, lens, data, np.cumsum(edge[:-1], dtype=np.int16) > 0


def repeated_bytes(docs: DataFrame, rows_of, schema: str, carried: list[str] | None = None) -> DataFrame:
    """Run the passes over ``docs`` (doc_id, text); ``rows_of(carried columns, ids, lens, bytes, mask) -> pa.Table`` makes the rows of a piece.

    Nulls: a null text is empty, a null doc_id counts as the largest.  Rows
    with equal doc_id never remove each other's bytes.  Texts under 50 bytes
    keep everything; an empty table gives an empty result.
    """
    blocks = write_blocks(docs, carried)
    n, draw = blocks.n_ranges, Keys.draw()

    def send1(pieces, _):
        short, _, _ = _pass1(_State(pieces))
        for bucket, a, b in ranges(short, n):
            yield bucket, pack_array(short[a:b], is_sorted=True)

    def send2(pieces, got):
        _, keys, least, _ = _pass2(_State(pieces), draw, got[0], n)
        yield from _send(keys, least, n)

    def send3(pieces, got):
        _, _, _, keys, least, _ = _pass3(_State(pieces), draw, got[0], got[1], n)
        yield from _send(keys, least, n)

    r1 = materialize(answer(blocks.scatter(send1), n, _in_many), "suffix-1")
    r2 = materialize(answer(blocks.scatter(send2, r1), n, lambda b: _before(b, split_keys=True)), "suffix-2")
    r3 = materialize(answer(blocks.scatter(send3, r1, r2), n, lambda b: _before(b, split_keys=False)), "suffix-3")

    def finish(bid, pieces, got):
        return pa.concat_tables([rows_of(pieces.rest(k) if carried is not None else None, *piece) for k, piece in enumerate(covered(_State(pieces), draw, *got, n))])

    return blocks.per_block(finish, schema, r1, r2, r3)


def _each(lens: np.ndarray, data: np.ndarray, mask: np.ndarray):
    at = 0
    for length in lens.tolist():
        yield data[at : at + length], mask[at : at + length]
        at += length


def _digests(_, ids, lens, data, mask) -> pa.Table:
    rows = []
    for i, (d, m) in zip(ids.tolist(), _each(lens, data, mask), strict=True):
        removed = int(m.sum())
        spans = int(m[0]) + int((m[1:] & ~m[:-1]).sum()) if removed else 0
        rows.append((None if i == NULL_ID else i, len(d), removed, spans, hashlib.sha256((d[~m] if removed else d).tobytes()).hexdigest()))
    kinds = {"long": pa.int64(), "string": pa.string()}
    return pa.table({f.split()[0]: pa.array(c, kinds[f.split()[1]]) for f, c in zip(RESULT_SCHEMA.split(", "), zip(*rows, strict=True), strict=True)})


def dedup_digests(docs: DataFrame) -> DataFrame:
    """Per document: bytes, removed bytes, removed runs and SHA-256 of what is left."""
    return repeated_bytes(docs, _digests, RESULT_SCHEMA)


def cut_repeats(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, without the passages that a smaller doc_id has; null texts stay null.

    Bytes of a character cut in half are dropped with it.  Whole rows travel
    with their texts, so rows with one or no doc_id are not mixed up.
    """
    others = [c for c in docs.columns if c != "text"]

    def rows_of(rest: pa.Table, _, lens, data, mask) -> pa.Table:
        texts = [(d[~m] if m.any() else d).tobytes().decode("utf-8", "ignore") for d, m in _each(lens, data, mask)]
        texts = [None if none else t for t, none in zip(texts, rest[NULL].to_pylist(), strict=True)]
        return rest.drop_columns([NULL]).append_column("text", pa.array(texts, pa.string()))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text")
    return repeated_bytes(docs, rows_of, f"{schema}, text string", others).select(docs.columns)


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_digests(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


ORACLE_SQL = """
WITH b AS (SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS h FROM documents),
w AS (SELECT doc_id, p, substr(h, 2 * p + 1, 100) AS s
      FROM b, unnest(range(CASE WHEN length(h) >= 100 THEN length(h) // 2 - 49 ELSE 0 END)) AS t(p)),
first AS (SELECT s, min(doc_id) AS d FROM w GROUP BY s),
gone AS (SELECT w.doc_id, w.p FROM w JOIN first USING (s) WHERE first.d < w.doc_id),
edge AS (SELECT doc_id, p, p - coalesce(max(p) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1000) AS step FROM gone),
isle AS (SELECT doc_id, p, sum(CASE WHEN step > 50 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY p) AS k FROM edge),
span AS (SELECT doc_id, k, min(p) AS a, max(p) + 50 AS z FROM isle GROUP BY doc_id, k),
nxt AS (SELECT doc_id, a, z, coalesce(lead(a) OVER (PARTITION BY doc_id ORDER BY a), 1000000000) AS b,
        row_number() OVER (PARTITION BY doc_id ORDER BY a) AS k FROM span),
parts AS (SELECT n.doc_id, string_agg(CASE WHEN k = 1 THEN substr(h, 1, 2 * a) ELSE '' END || substr(h, 2 * z + 1, 2 * (b - z)), '' ORDER BY k) AS kept,
          sum(z - a) AS removed, count(*) AS spans FROM nxt n JOIN b USING (doc_id) GROUP BY n.doc_id)
SELECT b.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM b LEFT JOIN parts USING (doc_id)
"""
