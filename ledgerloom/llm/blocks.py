"""Texts in blocks that stay in place while small sorted digests travel.

Operators that compare every text window with the whole corpus would move
many times the corpus if each window were a row.  Here the texts are written
once as a bucketed table (an input partition becomes as many buckets as its
bytes ask for, so writing moves nothing and no block is larger than a worker
can hold, however the input is cut).  Each round then

1. reads a block, computes sorted arrays of hashes and *scatters* them, cut by
   hash range into buckets (``bid, bucket, blob``),
2. joins equal buckets of all blocks (the only shuffle) and
3. sends each block a reply aligned with what it sent.

As the table is bucketed by ``bid``, giving a reply to its block shuffles the
replies only.  A key that occurs in every document is sent once per block, so
a hot key costs one entry per block and never one per occurrence.
"""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import remove, shared_dir, when_done

#: Stands for a null id inside blocks; it sorts after all others.
NULL_ID = np.int64(2**63 - 1)
PIECE_BYTES = 1 << 20
#: Text of a block; a worker holds about twenty times as much in a round.
BLOCK_BYTES = 32 << 20

BLOCK_SCHEMA = "bid int, ids binary, lens binary, data binary, rest binary"
NULL = "__text_is_null"
MESSAGE_SCHEMA = "bid int, bucket int, blob binary"


def release() -> None:
    """Give freed memory back to the system, so that a worker that is used again holds what its present block needs."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


class Bucketed(NamedTuple):
    """A table dealt into buckets, in the folder that the driver and all executors share."""

    spark: SparkSession
    table: str
    path: str

    def frame(self) -> DataFrame:
        return self.spark.table(self.table)

    def drop(self) -> None:
        """Delete the table; nothing that is still to be computed may read it."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
        remove(self.spark, self.path)


def write_bucketed(rows: DataFrame, n: int, key: str) -> Bucketed:
    spark = rows.sparkSession
    if n > int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets")):
        spark.conf.set("spark.sql.sources.bucketing.maxBuckets", str(n))
    table = f"blocks_{uuid.uuid4().hex}"
    path = f"{shared_dir(spark)}/{table}"
    rows.write.format("parquet").option("compression", "none").option("path", path).bucketBy(n, key).saveAsTable(table)
    out = Bucketed(spark, table, path)
    when_done(out.drop)
    return out


class Blocks:
    """The bucketed table, its number of buckets, and the number of hash ranges used in rounds."""

    def __init__(self, bucketed: Bucketed, n_blocks: int):
        self.bucketed, self.n_blocks = bucketed, n_blocks
        self.n_ranges = max(64, 2 * n_blocks)

    def frame(self) -> DataFrame:
        return self.bucketed.frame()

    def drop(self) -> None:
        """Delete the table; nothing that is still to be computed may read it."""
        self.bucketed.drop()

    def scatter(self, fn: Callable, *replies: DataFrame) -> DataFrame:
        """``fn(pieces, replies) -> iterable of (bucket, blob)`` for each block."""

        def body(bid, pieces, got):
            rows = list(fn(pieces, got))
            return pa.table({
                "bid": pa.array([bid] * len(rows), pa.int32()),
                "bucket": pa.array([r[0] for r in rows], pa.int32()),
                "blob": pa.array([r[1] for r in rows], pa.binary()),
            })

        return self.per_block(body, MESSAGE_SCHEMA, *replies)

    def per_block(self, body: Callable, schema: str, *replies: DataFrame) -> DataFrame:
        """Run ``body(bid, pieces, replies) -> pa.Table`` on every block.

        ``replies`` are tables of MESSAGE_SCHEMA; a block gets its own as one
        ``{bucket: blob}`` for each table.
        """
        if not replies:
            def alone(table: pa.Table) -> pa.Table:
                out = body(table["bid"][0].as_py(), Pieces(table), ())
                release()
                return out

            return self.frame().groupBy("bid").applyInArrow(alone, schema)
        tagged = None
        for k, r in enumerate(replies):
            r = r.select("bid", "bucket", "blob", F.lit(k).alias("round"))
            tagged = r if tagged is None else tagged.unionByName(r)
        n = len(replies)

        def with_replies(left: pa.Table, right: pa.Table) -> pa.Table:
            got = tuple({} for _ in range(n))
            for rnd, bucket, blob in zip(right["round"].to_pylist(), right["bucket"].to_pylist(), right["blob"].to_pylist(), strict=True):
                got[rnd][bucket] = blob
            bid = (left if left.num_rows else right)["bid"][0].as_py()
            out = body(bid, Pieces(left), got)
            got = ()
            release()
            return out

        return self.frame().groupBy("bid").cogroup(tagged.groupBy("bid")).applyInArrow(with_replies, schema)


class Pieces:
    """(ids, lens, bytes) of each piece of a block, one piece in memory at a time; ``rest(k)``: the carried columns of the k-th."""

    def __init__(self, table: pa.Table):
        self.cols = {c: table[c].combine_chunks() if table.num_rows else [] for c in ("ids", "lens", "data", "rest")}

    def __iter__(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        d = zstandard.ZstdDecompressor()
        for ids, lens, data in zip(*(self.cols[c] for c in ("ids", "lens", "data")), strict=True):
            yield (np.frombuffer(ids.as_buffer(), np.int64), np.frombuffer(lens.as_buffer(), np.int64), np.frombuffer(d.decompress(data.as_buffer()), np.uint8))

    def rest(self, k: int) -> pa.Table:
        """The carried columns, and NULL: whether a text was null."""
        return pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(self.cols["rest"][k].as_buffer())).read_all()


def write_blocks(docs: DataFrame, carried: list[str] | None = None) -> Blocks:
    """Write ``docs`` (doc_id, text and the carried columns) as a bucketed table of packed pieces of about 1 MB of text; no shuffle.

    Texts are measured first: a partition is cut into equal blocks of at most
    about BLOCK_BYTES, so blocks and hash ranges grow with the text and not
    with the session's partitions.
    Null texts are empty; null ids become NULL_ID.  ``rest`` holds the carried
    columns of a piece's rows, so whole rows can come out again without a join.
    """
    spark = docs.sparkSession
    others = [F.col(c) for c in carried] + [F.col("text").isNull().alias(NULL)] if carried is not None else []
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(int(NULL_ID))).alias("__id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("__text"), *others)
    sizes = dict(rows.groupBy(F.spark_partition_id().alias("p")).agg(F.sum(F.octet_length("__text"))).collect())
    sizes = [sizes.get(p) or 0 for p in range(max(1, rows.rdd.getNumPartitions()))]
    shares = [max(1, -(-size // BLOCK_BYTES)) for size in sizes]
    firsts = np.cumsum([0, *shares]).tolist()
    n = firsts.pop()
    # an id for each bucket, such that ids of different partitions meet in different buckets
    found = spark.range(32 * n).select(F.col("id").cast("int").alias("b")).groupBy(F.expr(f"pmod(hash(b), {n})").alias("k")).agg(F.min("b").alias("b")).orderBy("k").collect()
    bids = [r["b"] for r in found]

    def pack(batches):
        from pyspark import TaskContext

        p = TaskContext.get().partitionId()
        own_bids, whole, before = bids[firsts[p] : firsts[p] + shares[p]], max(1, sizes[p]), 0
        c = zstandard.ZstdCompressor(level=3)
        ids, lens, data, rest, size = [], [], [], [], 0

        def others() -> bytes:
            if not rest:
                return b""
            sink = pa.BufferOutputStream()
            whole = pa.Table.from_batches(rest).combine_chunks()
            with pa.ipc.new_stream(sink, whole.schema) as out:
                out.write_table(whole)
            return c.compress(sink.getvalue())

        def flush():
            bid = own_bids[min(len(own_bids) - 1, before * len(own_bids) // whole)]
            return pa.RecordBatch.from_pydict({
                "bid": pa.array([bid], pa.int32()), "ids": pa.array([np.concatenate(ids).astype(np.int64).tobytes()], pa.binary()),
                "lens": pa.array([np.concatenate(lens).astype(np.int64).tobytes()], pa.binary()), "data": pa.array([c.compress(b"".join(data))], pa.binary()),
                "rest": pa.array([others()], pa.binary()),
            })

        for batch in batches:
            own = batch.column(0).to_numpy(zero_copy_only=False)
            text = batch.column(1).cast(pa.large_binary())
            off = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
            raw = memoryview(text.buffers()[2] or b"")
            at = 0
            while at < len(own):
                upto = max(at + 1, int(np.searchsorted(off, off[at] + PIECE_BYTES - size, "right")) - 1)
                upto = min(upto, len(own))
                ids.append(own[at:upto])
                lens.append(np.diff(off[at : upto + 1]))
                data.append(bytes(raw[off[at] : off[upto]]))
                if carried is not None:
                    rest.append(batch.slice(at, upto - at).select([*carried, NULL]))
                size += int(off[upto] - off[at])
                at = upto
                if size >= PIECE_BYTES * 3 // 4:
                    yield flush()
                    before += size
                    ids, lens, data, rest, size = [], [], [], [], 0
        if ids:
            yield flush()

    return Blocks(write_bucketed(rows.mapInArrow(pack, BLOCK_SCHEMA), n, "bid"), n)


# Sorted arrays as bytes ------------------------------------------------------


def pack_array(a: np.ndarray, *, is_sorted: bool = False) -> bytes:
    """Byte planes of a 64-bit array, differences first if sorted, compressed; small for dense sorted hashes."""
    a = np.ascontiguousarray(a).view(np.uint64)
    if is_sorted and len(a):
        a = np.concatenate([a[:1], np.diff(a)])
    return len(a).to_bytes(8, "little") + zstandard.ZstdCompressor(level=1).compress(a.view(np.uint8).reshape(-1, 8).T.tobytes())


def unpack_array(b: bytes, *, is_sorted: bool = False) -> np.ndarray:
    n = int.from_bytes(b[:8], "little")
    if not n:
        return np.zeros(0, np.uint64)
    a = np.frombuffer(zstandard.ZstdDecompressor().decompress(b[8:]), np.uint8).reshape(8, n).T.copy().view(np.uint64).ravel()
    return np.cumsum(a, dtype=np.uint64) if is_sorted else a


def join_blobs(parts: list[bytes]) -> bytes:
    return b"".join(len(p).to_bytes(8, "little") + p for p in parts)


def split_blobs(b: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(b):
        n = int.from_bytes(b[at : at + 8], "little")
        out.append(b[at + 8 : at + 8 + n])
        at += 8 + n
    return out


def ranges(sorted_hashes: np.ndarray, n: int) -> list[tuple[int, int, int]]:
    """(bucket, from, to) of the non-empty hash ranges of a sorted array of 64-bit hashes."""
    if not len(sorted_hashes):
        return []
    step = np.uint64((2**64 - 1) // n + 1)
    bucket = (sorted_hashes // step).astype(np.int64)
    cut = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]])
    return [(int(bucket[a]), int(a), int(b)) for a, b in zip(cut[:-1], cut[1:], strict=True)]


def answer(messages: DataFrame, n_ranges: int, fn: Callable) -> DataFrame:
    """For each bucket: ``fn([blob, ...]) -> [reply, ...]`` in the same order, one for each block that sent.

    Partitions grow with the ranges, whatever the session's number is.
    """

    def body(table: pa.Table) -> pa.Table:
        replies = fn(table["blob"].to_pylist())
        release()
        return pa.table({"bid": table["bid"], "bucket": table["bucket"], "blob": pa.chunked_array([pa.array(replies, pa.binary())])})

    return messages.repartition(max(1, n_ranges // 2), "bucket").groupBy("bucket").applyInArrow(body, MESSAGE_SCHEMA)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (in place)."""
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def combine(*xs: np.ndarray, seed: int = 0) -> np.ndarray:
    """One 64-bit hash of several equally long arrays, in order."""
    h = np.full(len(xs[0]), (seed * 0x2545F4914F6CDD1D + 0x1234567) % 2**64, np.uint64)
    for x in xs:
        h ^= x
        h *= np.uint64(0x9FB21C651E98DF25)
        h ^= h >> np.uint64(32)
    return mix(h)
