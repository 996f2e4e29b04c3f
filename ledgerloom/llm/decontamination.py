"""Benchmark decontamination with a broadcast hash set of normalised test n-grams.

The benchmark's windows are kept as sorted 64-bit hashes with one place of
each in the benchmark's words, and the items that have it.  Documents are cut
into words and all their windows hashed in arrays; hashes found in the set are
verified on the words' bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .blocks import mix
from .shared import ROW, materialize, read_table, row_key

N = 13
#: Benchmark text in one broadcast (about six times as much memory); a larger benchmark is scanned slice by slice.
SLICE_BYTES = 16 << 20
BATCH_BYTES = 1 << 20

_SPANS = "spans array<struct<begin: long, end: long>>, items array<string>"
_BASE = np.uint64(0x9E3779B97F4A7C15)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.zeros(256, bool)
_IN_WORD[list(b"0123456789abcdefghijklmnopqrstuvwxyz")] = True
_IN_WORD[128:] = True


class Words(NamedTuple):
    """Words of some texts: their bytes one after the other, where each begins there (and the end), their hashes, where each text's words begin (and the end), and their places in the texts' bytes."""

    data: np.ndarray
    at: np.ndarray
    hashes: np.ndarray
    texts: np.ndarray
    begin: np.ndarray
    end: np.ndarray


def _powers(base: np.uint64, n: int) -> np.ndarray:
    p = np.full(n, base, np.uint64)
    p[:1] = 1
    return np.multiply.accumulate(p)


_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))


def words_of(column: pa.Array) -> Words:
    """Lower-case A-Z, then runs of digits, a-z and whatever is not ASCII; a null has no words."""
    text = column.cast(pa.large_binary())
    off = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1] if len(text) else np.zeros(1, np.int64)
    raw = np.frombuffer(text.buffers()[2] or b"", np.uint8)[off[0] : off[-1]] if len(text) else np.zeros(0, np.uint8)
    off = off - off[0]
    data = _LOWER[raw]
    inside = _IN_WORD[data]
    edge = np.zeros(len(data) + 1, bool)  # a text begins or ends here
    edge[off] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:-1]
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    data = data[inside]
    at = np.concatenate([[0], np.cumsum(end - begin)])
    if len(begin):
        value = (data.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(data))
        hashes = mix(np.add.reduceat(value, at[:-1]) * _powers(_INVERSE, len(data))[at[:-1]] + np.diff(at).astype(np.uint64))
    else:
        hashes = np.zeros(0, np.uint64)
    return Words(data, at, hashes, np.searchsorted(begin, off), begin, end)


def _windows(w: Words, length: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, hash) of the windows of a length, none across texts."""
    n = len(w.hashes) - length + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(w.hashes * _powers(_BASE, len(w.hashes)), dtype=np.uint64)])
    h = mix((sums[length:] - sums[:-length]) * _powers(_INVERSE, n) + np.uint64(length + 64 * seed))
    edge = np.zeros(n + 1, np.int64)  # windows that begin less than ``length`` before a text's first word
    cuts = np.unique(w.texts)
    cuts = cuts[(cuts > 0) & (cuts < len(w.hashes))]
    np.add.at(edge, np.clip(cuts - length + 1, 0, n), 1)
    np.add.at(edge, np.minimum(cuts, n), -1)
    at = np.flatnonzero(np.cumsum(edge)[:n] == 0)
    return at, h[at]


def _equal(a: Words, x: np.ndarray, b: Words, y: np.ndarray, length: int) -> np.ndarray:
    """Whether the ``length`` words from x on in ``a`` are those from y on in ``b``, by their bytes."""
    same = np.ones(len(x), bool)
    sizes_a, sizes_b = np.diff(a.at), np.diff(b.at)
    for k in range(length):
        same &= sizes_a[x + k] == sizes_b[y + k]
    ok = np.flatnonzero(same)
    if len(ok):
        size = a.at[x[ok] + length] - a.at[x[ok]]
        past = np.cumsum(size)
        step = np.arange(past[-1]) - np.repeat(past - size, size)
        differ = a.data[np.repeat(a.at[x[ok]], size) + step] != b.data[np.repeat(b.at[y[ok]], size) + step]
        same[ok] = ~np.logical_or.reduceat(differ, past - size)
    return same


class Grams(NamedTuple):
    """One slice of the benchmark.  For each length: sorted hashes, a filter of their leading bits, first word of one occurrence, and (where each hash's items begin, items)."""

    seed: int
    words: Words
    ids: list[str | None]
    by_length: dict[int, tuple[np.ndarray, ...]]


def grams_of(items: pa.Table) -> Grams:
    """Windows of a slice (item_id, text).  Items without an id count as one item, named null."""
    table = items.combine_chunks()
    texts = table["text"].combine_chunks() if table.num_rows else pa.array([], pa.string())
    w = words_of(texts)
    names = table["item_id"].to_pylist()
    ids = [None] * (None in names) + sorted({n for n in names if n is not None})
    number = {n: k for k, n in enumerate(ids)}
    item = np.array([number[n] for n in names], np.int32)
    sizes = np.diff(w.texts)
    for seed in count():
        by_length = {}
        for length in sorted({min(N, int(n)) for n in sizes if n}):
            at, h = _windows(w, length, seed)
            text = np.searchsorted(w.texts, at, "right") - 1
            own = sizes[text] == length if length < N else np.ones(len(at), bool)
            at, h, of = at[own], h[own], item[text[own]]
            order = np.lexsort((of, h))
            at, h, of = at[order], h[order], of[order]
            new = np.ones(len(h), bool)
            new[1:] = h[1:] != h[:-1]
            group = np.cumsum(new) - 1
            if not _equal(w, at, w, at[new][group], length).all():
                break  # two windows under one hash: take another one
            pair = new.copy()
            pair[1:] |= of[1:] != of[:-1]
            begins = np.concatenate([[0], np.cumsum(np.bincount(group[pair]))])
            bits = max(10, min(24, int(h.size).bit_length() + 4))
            some = np.zeros(1 << bits, bool)
            some[h >> np.uint64(64 - bits)] = True
            by_length[length] = (h[new], some, at[new], begins, of[pair])
        else:
            return Grams(seed, w, ids, by_length)


def hits(w: Words, g: Grams) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, first words, numbers of windows) of all verified windows in some texts."""
    for length, (known, some, place, _, _) in g.by_length.items():
        at, h = _windows(w, length, g.seed)
        may = np.flatnonzero(some[h >> np.uint64(64 - int(len(some)).bit_length() + 1)])
        at, h = at[may], h[may]
        k = np.minimum(np.searchsorted(known, h), len(known) - 1)
        hit = np.flatnonzero(known[k] == h)
        at, k = at[hit], k[hit]
        same = _equal(w, at, g.words, place[k], length)
        yield length, at[same], k[same]


def _slices(texts: pa.Array) -> list[tuple[int, int]]:
    """Stretches of about BATCH_BYTES of text; one longer text stands alone."""
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    cut = np.flatnonzero(np.diff((np.cumsum(size) - size) // BATCH_BYTES)) + 1
    edges = [0, *cut.tolist(), len(texts)]
    return [(a, b) for a, b in zip(edges, edges[1:], strict=False) if a < b]


def _scan(df: DataFrame, grams, carried: list[str]) -> DataFrame:
    """The carried columns, n_words, spans and items of each row of ``df`` (the carried columns, then text)."""
    def step(batches):
        g = grams.value
        for batch in batches:
            texts = batch.column(len(carried))
            for a, b in _slices(texts):
                w = words_of(texts.slice(a, b - a))
                n = b - a
                edge = np.zeros(len(w.hashes) + 1, np.int32)
                doc, item = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
                for length, at, k in hits(w, g):
                    np.add.at(edge, at, 1)
                    np.add.at(edge, at + length, -1)
                    _, _, _, begins, of = g.by_length[length]
                    many = begins[k + 1] - begins[k]
                    past = np.cumsum(many)
                    doc.append(np.repeat(np.searchsorted(w.texts, at, "right") - 1, many))
                    item.append(of[np.repeat(begins[k], many) + np.arange(past[-1] if len(past) else 0) - np.repeat(past - many, many)])
                covered = np.cumsum(edge[:-1]) > 0
                start = np.zeros(len(covered) + 1, bool)
                start[w.texts] = True
                first = np.flatnonzero(covered & (start[:-1] | ~np.concatenate([[False], covered[:-1]])))
                last = np.flatnonzero(covered & (start[1:] | ~np.concatenate([covered[1:], [False]])))
                at = np.searchsorted(w.texts, first, "right") - 1
                spans = pa.StructArray.from_arrays([pa.array(first - w.texts[at], pa.int64()), pa.array(last + 1 - w.texts[at], pa.int64())], ["begin", "end"])
                pairs = np.unique(np.concatenate(doc) * (len(g.ids) + 1) + np.concatenate(item))
                names = pa.array(g.ids, pa.string()).take(pa.array(pairs % (len(g.ids) + 1), pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(a, n) for c in range(len(carried))), pa.array(np.diff(w.texts), pa.int64()),
                     pa.ListArray.from_arrays(pa.array(np.searchsorted(at, np.arange(n + 1)), pa.int32()), spans),
                     pa.ListArray.from_arrays(pa.array(np.searchsorted(pairs // (len(g.ids) + 1), np.arange(n + 1)), pa.int32()), names)],
                    [*carried, "n_words", "spans", "items"],
                )

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema if f.name in carried)
    return df.mapInArrow(step, f"{kinds}, n_words long, {_SPANS}")


def _merged(rows: DataFrame, carried: list[str]) -> DataFrame:
    """One row's spans and items from several slices (more_spans, more_items) put together."""
    def step(batches):
        for batch in batches:
            cols = batch.to_pydict()
            for k, (spans, items) in enumerate(zip(cols.pop("more_spans"), cols.pop("more_items"), strict=True)):
                if spans:
                    out: list[dict] = []
                    for s in sorted([*cols["spans"][k], *(s for more in spans for s in more)], key=lambda s: s["begin"]):
                        if out and s["begin"] <= out[-1]["end"]:
                            out[-1]["end"] = max(out[-1]["end"], s["end"])
                        else:
                            out.append(dict(s))
                    cols["spans"][k] = out
                    every = {i for more in [cols["items"][k], *items] for i in more}
                    cols["items"][k] = [None] * (None in every) + sorted(every - {None})
            yield pa.RecordBatch.from_pydict(cols, pa.schema([f for f in batch.schema if not f.name.startswith("more_")]))

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name in carried)
    return rows.mapInArrow(step, f"{kinds}, n_words long, {_SPANS}")


def scan(docs: DataFrame, benchmark: DataFrame, carried: list[str]) -> DataFrame:
    """Per row: the carried columns, n_words, spans (word positions under a benchmark window), items (item_ids, as strings, sorted).

    The benchmark's size is summed first; over SLICE_BYTES of text it is dealt
    to slices of about that much, each broadcast in turn, and only rows with
    hits are written between.  Null and empty texts have no words; items
    without words have no windows; repeated item_ids count once, and all items
    without an id as one, which has no name.
    """
    spark = docs.sparkSession
    bench = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    size = bench.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-size // SLICE_BYTES))
    text = F.col("text").cast("string").alias("text")

    def part(k: int) -> DataFrame:
        held = bench.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k) if n > 1 else bench
        grams = spark.sparkContext.broadcast(grams_of(held.toArrow()))  # about SLICE_BYTES, or one item of more
        return _scan(docs.select(*carried, *(["_key"] if n > 1 else []), text), grams, [*carried, *(["_key"] if n > 1 else [])])

    if n == 1:
        return part(0)
    docs = docs.withColumn("_key", row_key())
    first = part(0)
    more = [materialize(part(k).where(F.size("spans") > 0).select("_key", "spans", "items").dropDuplicates(["_key"]), "decontaminate") for k in range(1, n)]
    hit = more[0]
    for m in more[1:]:
        hit = hit.unionByName(m)
    hit = hit.groupBy("_key").agg(F.collect_list("spans").alias("more_spans"), F.collect_list("items").alias("more_items"))  # at most a list a slice
    return _merged(first.join(hit, "_key", "left").select(*carried, "n_words", "spans", "items", "more_spans", "more_items"), carried)


def verdicts(docs: DataFrame, benchmark: DataFrame, carried: list[str] | None = None) -> DataFrame:
    """``scan`` with n_hit, n_items, items_sha256 and contaminated (hit words are at least a twentieth of all)."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    if carried is None:
        docs, carried = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), ["doc_id"]
    return scan(docs, benchmark, carried).withColumns({
        "n_hit": hit, "n_items": F.size("items").cast("long"), "items_sha256": F.sha2(F.array_join("items", ","), 256),
        "contaminated": (hit > 0) & (20 * hit >= F.col("n_words")),
    })


def decontaminate(docs: DataFrame, benchmark: DataFrame, how: str = "documents") -> DataFrame:
    """Remove contaminated documents, or (``how="spans"``) every hit span from the text of all.

    ``documents`` keeps all columns of ``docs``; a row goes by its own text,
    whatever its doc_id, null ones too.  ``spans`` returns doc_id and text.
    """
    if how == "documents":
        keyed = docs.withColumn(ROW, row_key())
        bad = verdicts(keyed.select(ROW, "doc_id", "text"), benchmark, [ROW]).where("contaminated").select(ROW).distinct()
        return keyed.join(bad, ROW, "left_anti").drop(ROW)

    def cut(batches):
        for batch in batches:
            texts = []
            for k, (text, spans) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                if spans:
                    raw, w = text.encode(), words_of(batch.column(1).slice(k, 1))
                    for s in reversed(spans):
                        raw = raw[: w.begin[s["begin"]]] + raw[w.end[s["end"] - 1] :]
                    text = raw.decode()
                texts.append(text or "")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("whole"), F.col("text").cast("string").alias("text"))
    return scan(plain, benchmark, ["doc_id", "whole"]).select("doc_id", "whole", "spans").mapInArrow(cut, "doc_id long, text string")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdicts(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
ORACLE_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS s
       FROM b, unnest(range(1, greatest(len(w) - 11, 2))) AS t(i) WHERE len(w) > 0),
dw AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS s
       FROM d, (SELECT DISTINCT n FROM bw) AS lens, unnest(range(1, len(w) - n + 2)) AS t(i)),
hit AS (SELECT doc_id, i, dw.n AS n, item_id FROM dw JOIN bw ON dw.s = bw.s AND dw.n = bw.n),
pos AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(k, ',' ORDER BY k) AS ks FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS k FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ks, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""
