"""Jaccard self-join of word n-grams with adaptive multi-match prefixes, and its components.

Two sets of similarity t share ``l`` of their first ``n - ceil(t n) + l``
tokens under any one order of tokens.  The order here is by document frequency
(exact, from all documents), so prefixes hold the rarest shingles.  Each
document picks its own ``l``: a longer prefix costs more list entries but a
candidate must then match more often before it is verified; the pick has the
least estimated cost.  Tokens that no other document has match nothing, so a
document with too few others is out before any join.

Equal sets are joined by their hash.  Candidates are first verified against
one representative for each token (the one with the fewest tokens of its own:
the likely original of a group of near copies), and linked ones merged; only
pairs across the groups thus found are verified then.  So a group of near
copies costs a pair for each member, not for each two.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .blocks import NULL, NULL_ID, Blocks, answer, combine, join_blobs, mix, pack_array, ranges, split_blobs, unpack_array, write_blocks
from .components import connected_components, join_hot
from .shared import discard, materialize, read_table

WORDS = 5
#: Similarity as a percentage.
PERCENT = 80
MAX_MATCHES = 6
#: Members of a group in one block.
BLOCK = 256
#: Sets that one call compares.
SHARE_BYTES = 16 << 20
LOW24 = np.uint64(2**24 - 1)

SETS_SCHEMA = "bid int, nth long, doc_id long, n long, fp string, core binary, n_core long, prefix array<long>, lead int, matches int"

_P = np.uint64(0x9E3779B97F4A7C15)
_PINV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    p = np.full(n, base, np.uint64)
    p[:1] = 1
    return np.multiply.accumulate(p)


def shingle_sets(lens: np.ndarray, data: np.ndarray, words: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text (A-Z lower-cased; words are split at ASCII white space)."""
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    codes = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    ends = np.cumsum(lens)
    starts = ends - lens
    none = np.zeros(0, np.uint64)
    if not len(data):
        return [none] * len(lens)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    first = ~space
    first[1:] &= space[:-1]
    begin = starts[lens > 0]
    first[begin] = ~space[begin]
    at = np.flatnonzero(first)
    if not len(at):
        return [none] * len(lens)
    value = codes[lower[data]]
    value *= _powers(_P, len(data))
    value[space] = 0
    word = np.add.reduceat(value, at) * _powers(_PINV, len(data))[at]
    word = mix(word)
    cut = np.searchsorted(at, np.concatenate([starts, [len(data)]]))
    out = []
    whole = combine(*(word[k : len(word) - words + 1 + k] for k in range(words)), seed=words) if len(word) >= words else none
    for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
        k = b - a
        out.append(none if not k else np.unique(whole[a : b - words + 1]) if k >= words else combine(*(word[a + j : a + j + 1] for j in range(k)), seed=k))
    return out


def _key(s: np.ndarray) -> str:
    """Name of a set: its size and 128 bits of its members."""
    a = int(mix(s.copy()).sum(dtype=np.uint64))
    b = int(mix(s * np.uint64(0xC2B2AE3D27D4EB4F)).sum(dtype=np.uint64))
    return f"{len(s):x}.{a:016x}{b:016x}"


class _Sets:
    """Sets of a block, each distinct one once."""

    def __init__(self, pieces):
        self.ids: list[int] = []
        self.keys: list[str] = []
        self.sets: dict[str, np.ndarray] = {}
        for ids, lens, data in pieces:
            for i, s in zip(ids.tolist(), shingle_sets(lens, data), strict=True):
                key = _key(s)
                self.ids.append(i)
                self.keys.append(key)
                self.sets.setdefault(key, s)
        every = np.concatenate([np.zeros(0, np.uint64), *self.sets.values()])
        self.tokens, self.where, self.count = np.unique(every & ~LOW24, return_inverse=True, return_counts=True)


def _frequency_class(df: np.ndarray) -> np.ndarray:
    """0: in one document; else 1 and more, eight classes for each doubling."""
    return np.where(df <= 1, 0, np.minimum(255, 1 + 8 * np.log2(np.maximum(df, 2) / 2))).astype(np.uint8)


def _frequencies(blobs: list[bytes]) -> list[bytes]:
    rows = [split_blobs(b) for b in blobs]
    tokens = [unpack_array(r[0], is_sorted=True) for r in rows]
    every, where = np.unique(np.concatenate(tokens), return_inverse=True)
    df = np.bincount(where, np.concatenate([unpack_array(r[1]) for r in rows]).astype(float), len(every))
    cls = _frequency_class(df)[where]
    n = np.cumsum([0, *map(len, tokens)])
    return [pack_array(cls[a:b].astype(np.uint64)) for a, b in zip(n[:-1], n[1:], strict=True)]


def _prefix(s: np.ndarray, cls: np.ndarray, percent: int):
    """(prefix tokens that others have, how many of them are in the prefix for l = 1, l) of a set with the frequency class of each token."""
    order = np.lexsort((s, cls))
    c = cls[order]
    base = len(s) - (percent * len(s) + 99) // 100
    df = np.where(c == 0, 0, 2 * 2.0 ** ((c.astype(float) - 1) / 8))
    cost = np.cumsum(df)
    most = min(MAX_MATCHES, len(s) - base)
    picks = [cost[base + m - 1] * (1 + 8 / m) for m in range(1, most + 1)]
    m = int(np.argmin(picks)) + 1
    kept = order[: base + m]
    return s[kept[cls[kept] > 0]], int((c[: base + 1] > 0).sum()), m


def candidate_sets(blocks: Blocks, percent: int = PERCENT) -> DataFrame:
    """A row for each document, known by its block and place there, written; core (tokens that others have too), prefix and matches only where a link to another set is possible, once a block."""
    n = blocks.n_ranges

    def send(pieces, _):
        st = _Sets(pieces)
        for bucket, a, b in ranges(st.tokens, n):
            yield bucket, join_blobs([pack_array(st.tokens[a:b], is_sorted=True), pack_array(st.count[a:b].astype(np.uint64))])

    replies = materialize(answer(blocks.scatter(send), n, _frequencies), "ngram-df")

    def rows(bid, pieces, got):
        st = _Sets(pieces)
        cls = np.zeros(len(st.tokens), np.uint8)
        for bucket, a, b in ranges(st.tokens, n):
            cls[a:b] = unpack_array(got[0][bucket])
        cls = cls[st.where]
        info, at = {}, 0
        for key, s in st.sets.items():
            c = cls[at : at + len(s)]
            at += len(s)
            core = s[c > 0]
            if len(s) and 100 * len(core) >= percent * len(s):
                prefix, lead, m = _prefix(s, c, percent)
                if lead:
                    info[key] = (core.tobytes(), len(core), prefix.view(np.int64).tolist(), lead, m)
        # a set's tokens go with its smallest id
        out = [(bid, nth, i if i != NULL_ID else None, int(k.split(".")[0], 16), k, *info.pop(k, (None,) * 5)) for i, k, nth in sorted(zip(st.ids, st.keys, range(len(st.ids)), strict=True))]
        types = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.int32())
        cols = zip(*out, strict=True) if out else [()] * len(types)
        return pa.table({f.split()[0]: pa.array(c, t) for f, c, t in zip(SETS_SCHEMA.split(", "), cols, types, strict=True)})

    out = materialize(blocks.per_block(rows, SETS_SCHEMA, replies), "ngram-sets")
    discard(replies)
    return out


def _possible(percent: int):
    """Exact bound: no more can be shared than the smaller core."""
    return (100 + percent) * F.least("a_core", "b_core") >= percent * (F.col("a_n") + F.col("b_n"))


def verify(pairs: DataFrame, nodes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Pairs (a, b) whose sets are similar enough, with the number of shared shingles."""
    sets = nodes.select("v", "n", "core")
    both = pairs.select("a", "b").join(sets.toDF("a", "a_n", "a_core"), "a").join(sets.toDF("b", "b_n", "b_core"), "b").select("a", "b", "a_n", "b_n", "a_core", "b_core")

    def run(batches):
        for batch in batches:
            n = [batch.column(k).to_pylist() for k in (2, 3)]
            x, y = batch.column(4), batch.column(5)
            shared = []
            for k in range(batch.num_rows):
                a, b = (np.frombuffer(c[k].as_buffer(), np.uint64) for c in (x, y))
                at = np.minimum(np.searchsorted(b, a), len(b) - 1)
                shared.append(int((b[at] == a).sum()))
            keep = [k for k, s in enumerate(shared) if 100 * s >= percent * (n[0][k] + n[1][k] - s)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep, pa.int64())), batch.column(1).take(pa.array(keep, pa.int64())), pa.array([shared[k] for k in keep], pa.int64())], ["a", "b", "shared"])

    return both.mapInArrow(run, "a string, b string, shared long")


def _linked(blocks: Blocks, percent: int) -> tuple[DataFrame, DataFrame]:
    """``candidate_sets`` of all rows, and (fp, comp): the component of each set that has links."""
    sets = candidate_sets(blocks, percent)
    named = sets.where("core is not null")
    one = named.groupBy("fp").agg(F.min(F.struct(F.coalesce("doc_id", F.lit(int(NULL_ID))).alias("k"), F.length("core").alias("l"))).alias("m")).select("fp", F.col("m.k").alias("k"))
    nodes = named.withColumn("k", F.coalesce("doc_id", F.lit(int(NULL_ID)))).join(one, ["fp", "k"]).dropDuplicates(["fp"])
    nodes = materialize(nodes.select(F.col("fp").alias("v"), "n", "core", "n_core", "prefix", "lead", "matches"), "ngram-nodes")

    tokens = nodes.select(F.explode(F.slice("prefix", 1, F.col("lead"))).alias("token"), "v", "n", "n_core")
    head = tokens.groupBy("token").agg(F.min(F.struct((F.col("n") - F.col("n_core")).alias("own"), "v", "n", "n_core")).alias("h"), F.count("*").alias("many")).where("many > 1")
    star = tokens.join(head, "token").select(F.col("h.v").alias("a"), F.col("h.n").alias("a_n"), F.col("h.n_core").alias("a_core"), F.col("v").alias("b"), F.col("n").alias("b_n"), F.col("n_core").alias("b_core"))
    star = star.where((F.col("a") != F.col("b")) & _possible(percent)).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    links = materialize(verify(star, nodes, percent).select("a", "b"), "ngram-links")
    groups = connected_components(links)
    across, read = _across(nodes, groups, percent)
    more = materialize(across, "ngram-more")
    discard(nodes, groups, *read)
    whole = connected_components(links.union(more))
    discard(links, more)
    return sets, whole.select(F.col("v").alias("fp"), "comp")


def link_components(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links) for every row of ``docs``.

    Null and empty texts have no shingles and are linked with nothing.  Equal
    sets are linked.  A null doc_id counts as the largest.
    """
    blocks = write_blocks(docs)
    sets, groups = _linked(blocks, percent)
    blocks.drop()
    least = F.min(F.coalesce("doc_id", F.lit(int(NULL_ID)))).alias("k")
    members = sets.where("n > 0").groupBy("fp").agg(least).join(groups, "fp", "left").withColumn("comp", F.coalesce("comp", "fp"))
    members = materialize(members, "ngram-members")
    several = members.groupBy("comp").agg(F.min("k").alias("first"), F.count("*").alias("many")).where("many > 1").drop("many")
    of = join_hot(members, several, "comp", "fp").select("fp", F.coalesce("first", "k").alias("component_id"))
    found = sets.select("doc_id", F.col("n").alias("n_shingles"), "fp").join(of, "fp", "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return found.select("doc_id", "n_shingles", F.nullif("component_id", F.lit(int(NULL_ID))).alias("component_id"))


def _across(nodes: DataFrame, groups: DataFrame, percent: int) -> tuple[DataFrame, list[DataFrame]]:
    """Links between different groups, one for each document and group it is linked with; and the written tables that they are read from.

    A pair that shares l tokens of its l-prefixes shares one of the prefixes
    for l = 1, so those tell which documents may be linked with which groups;
    for each token the largest group is only probed by members of the others.
    A group's members are then met in blocks, where pairs are first held to
    their l common prefix tokens and the rest verified; no pair is a row.
    """
    cols = ["v", "n", "n_core", "comp"]
    member = materialize(nodes.join(groups, "v", "left").withColumn("comp", F.coalesce("comp", "v")), "ngram-grouped")
    tokens = member.select(F.explode(F.slice("prefix", 1, F.col("lead"))).alias("token"), *cols)
    sizes = tokens.groupBy("token", "comp").agg(F.count("*").alias("k"), F.max("n_core").alias("most_core"), F.min("n").alias("least_n"))
    mixed = sizes.groupBy("token").agg(F.max(F.struct("k", "comp")).alias("t"), F.count("*").alias("groups")).where("groups > 1").select("token", F.col("t.comp").alias("top"))
    a = tokens.join(mixed, "token").where("comp <> top")
    b = sizes.select("token", F.col("comp").alias("to"), "most_core", "least_n")
    possible = (100 + percent) * F.least("n_core", "most_core") >= percent * (F.col("n") + F.col("least_n"))
    probes = a.join(b, "token").where((F.col("comp") != F.col("to")) & ((F.col("to") == F.col("top")) | (F.col("comp") < F.col("to"))) & possible).select("v", "to").distinct()
    blocks = member.groupBy("comp").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")).where("blocks > 1")
    held = join_hot(member, blocks, "comp", "v").withColumn("block", F.pmod(F.xxhash64("v"), F.coalesce("blocks", F.lit(1))).cast("int"))
    sets = ["v", "n", "core", "prefix", "matches"]
    asked = join_hot(probes, blocks.withColumnRenamed("comp", "to"), "to", "v").withColumn("block", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)))
    asked = materialize(asked.join(member.select(*sets), "v").select(F.col("to").alias("comp"), "block", *sets), "ngram-probes")
    # shares grow with the sets on both sides
    size = asked.agg(F.coalesce(F.sum(F.octet_length("core")), F.lit(0))).first()[0] + nodes.agg(F.coalesce(F.sum(F.octet_length("core")), F.lit(0))).first()[0]
    shares = max(64, size // SHARE_BYTES)
    share = F.pmod(F.hash("comp", "block"), F.lit(shares)).alias("share")

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple[str, str]] = []
        members: dict[tuple, list[int]] = {}
        for k, key in enumerate(zip(left["comp"].to_pylist(), left["block"].to_pylist(), strict=True)):
            members.setdefault(key, []).append(k)
        asks: dict[tuple, list[int]] = {}
        for k, key in enumerate(zip(right["comp"].to_pylist(), right["block"].to_pylist(), strict=True)):
            asks.setdefault(key, []).append(k)
        lc, rc = ({c: t[c].combine_chunks() if t.num_rows else [] for c in sets} for t in (left, right))
        for key, rows in asks.items():
            own = members.get(key, [])
            if not own:
                continue
            n = np.array([lc["n"][k].as_py() for k in own])
            most = np.array([lc["matches"][k].as_py() for k in own])
            stacks = []
            for c in ("prefix", "core"):
                parts = [np.frombuffer(lc[c][k].as_buffer(), np.uint64) if c == "core" else np.array(lc[c][k].as_py(), np.int64).view(np.uint64) for k in own]
                stacks.append((np.concatenate(parts), np.repeat(np.arange(len(own)), [len(x) for x in parts])))
            for k in rows:
                ok = np.ones(len(own), bool)
                for c, (flat, owner) in zip(("prefix", "core"), stacks, strict=True):
                    mine = np.frombuffer(rc[c][k].as_buffer(), np.uint64) if c == "core" else np.sort(np.array(rc[c][k].as_py(), np.int64).view(np.uint64))
                    hit = mine[np.minimum(np.searchsorted(mine, flat), len(mine) - 1)] == flat
                    both = np.bincount(owner[hit], minlength=len(own))
                    ok &= both >= np.minimum(most, rc["matches"][k].as_py()) if c == "prefix" else 100 * both >= percent * (n + rc["n"][k].as_py() - both)
                    if not ok.any():
                        break
                if ok.any():
                    found.append((rc["v"][k].as_py(), lc["v"][own[int(np.argmax(ok))]].as_py()))
        return pa.table({"a": pa.array([f[0] for f in found], pa.string()), "b": pa.array([f[1] for f in found], pa.string())})

    left = held.select(share, "comp", "block", *sets).join(asked.select("comp", "block").distinct(), ["comp", "block"], "left_semi").select("share", "comp", "block", *sets)
    right = asked.select(share, "comp", "block", *sets)
    left, right = (d.repartition(shares // 2, "share").groupBy("share") for d in (left, right))  # partitions grow with the shares
    return left.cogroup(right).applyInArrow(meet, "a string, b string"), [member, asked]


def keep_one(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs``, all columns, one of each group of near duplicates: that with the smallest doc_id (a null is the largest).

    Rows are known by their place, so those that share a doc_id, or have none,
    are not mixed up; of copies under one id the first in the first block
    stays.  Texts without words are in no group: all stay.
    """
    blocks = write_blocks(docs, [c for c in docs.columns if c != "text"])
    sets, groups = _linked(blocks, percent)
    place = F.struct(F.coalesce("doc_id", F.lit(int(NULL_ID))).alias("id"), "bid", "nth")
    named = sets.where("n > 0").select("fp", place.alias("at"))
    of_set = materialize(named.groupBy("fp").agg(F.min("at").alias("first")).join(groups, "fp", "left").select("fp", F.coalesce("comp", "fp").alias("comp"), "first"), "ngram-firsts")
    several = of_set.groupBy("comp").agg(F.min("first").alias("least"), F.count("*").alias("many")).where("many > 1").drop("many")
    first = join_hot(of_set, several, "comp", "fp").select("fp", F.coalesce("least", "first").alias("first"))
    gone = named.join(first, "fp").where(F.col("at") != F.col("first")).groupBy(F.col("at.bid").alias("bid")).agg(F.collect_list("at.nth").alias("gone"))  # places of one block
    gone = gone.select("bid", F.lit(0).alias("bucket"), F.encode(F.array_join(F.col("gone").cast("array<string>"), ","), "UTF-8").alias("blob"))
    gone = materialize(gone, "ngram-gone")
    discard(sets, groups, of_set)

    def rest(bid, pieces, got):
        blob = got[0].get(0)
        out = np.array(bytes(blob).split(b","), np.int64) if blob else np.zeros(0, np.int64)
        parts, at = [], 0
        for k, (ids, lens, data) in enumerate(pieces):
            others = pieces.rest(k)
            text = pa.StringArray.from_buffers(len(ids), pa.py_buffer(np.concatenate([[0], np.cumsum(lens)]).astype(np.int32)), pa.py_buffer(data))
            whole = others.drop_columns([NULL]).append_column("text", pc.if_else(others[NULL], pa.scalar(None, pa.string()), text))
            parts.append(whole.filter(pa.array(~np.isin(np.arange(at, at + len(ids)), out))))
            at += len(ids)
        return pa.concat_tables(parts)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text")
    return blocks.per_block(rest, f"{schema}, text string", gone).select(docs.columns)


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_components(read_table(spark, sf_dir, "documents"))


ORACLE_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM d, unnest(range(1, greatest(len(w) - 3, 2))) AS t(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 80 * (x.n + y.n - i)),
r(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(m, d.doc_id)) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS m FROM r GROUP BY a) USING (doc_id)
"""
