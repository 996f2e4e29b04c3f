"""WARC archives from a chunked record table.

Spark cuts each payload into chunk rows (record identifier, chunk number, the
bytes) before anything else looks at it, and the SHA-1 so far is carried from
row to row, so nothing larger than a chunk is formatted, written or parsed at
once.  Each row is one record of the archive: the first chunk a ``response``,
the others its ``continuation`` segments.  Spark's text writer and reader move
the archives, so any store that Spark reaches will do.
"""

from __future__ import annotations

import hashlib
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import read_table, shared_dir

CHUNK_BYTES = 64 << 10
MIN_REVISIT = 1000
DATE = "1970-01-01T00:00:00Z"

CHUNK_SCHEMA = "page_id long, chunk int, sha1_so_far string, value binary"
RECORD_SCHEMA = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, n_chunks int, intact boolean"


#: A hot payload's rows are dealt to so many keys.
SALTS = 16


def roles(pages: DataFrame) -> DataFrame:
    """page_id, url, payload (null: empty), digest, n_bytes, refers_to: of equal payloads of at least 1000 bytes the largest page_id is stored, the rest refer to it.

    Roles are found on (page_id, digest) alone, and the payloads then joined by
    both, so pages with one payload do not meet in one task.  A null page_id
    is a revisit if its payload is stored under another; pages with equal ids
    are told apart by their payloads.
    """
    raw = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), raw.alias("payload"))
    p = p.withColumns({"digest": F.sha1("payload"), "n_bytes": F.octet_length("payload").cast("long")})
    named = p.where(F.col("n_bytes") >= MIN_REVISIT).select("page_id", "digest", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int").alias("salt"))
    stored = named.groupBy("digest").agg(F.max("page_id").alias("stored"), F.count("*").alias("n")).where("n > 1 and stored is not null")
    stored = stored.select("digest", "stored", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    key = F.concat(F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit("/"), "digest").alias("_key")
    others = named.join(stored, ["digest", "salt"]).where("page_id is null or page_id <> stored").groupBy(key).agg(F.max("stored").alias("refers_to"))
    return p.withColumn("_key", key).join(others, "_key", "left").drop("_key")


def chunk_records(with_roles: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The chunked record table; ``value`` is the chunk with its WARC header.  A revisit has one row, without payload."""
    stored = F.col("refers_to").isNull()
    last = F.when(stored, F.greatest(F.floor((F.col("n_bytes") - 1) / chunk_bytes), F.lit(0))).otherwise(0).cast("int")
    rows = with_roles.select("page_id", "url", "n_bytes", "digest", "refers_to", "payload", F.explode(F.sequence(F.lit(0), last)).alias("chunk"))
    part = F.when(stored, F.substring(F.col("payload"), F.col("chunk") * chunk_bytes + 1, F.lit(chunk_bytes)))
    rows = rows.select("page_id", "url", "n_bytes", "digest", "refers_to", "chunk", part.alias("part"))

    def header(page_id, url, n_bytes, digest, refers_to, chunk, size, so_far) -> bytes:
        name = f"urn:x-page:{'' if page_id is None else page_id}"
        uri = [f"WARC-Target-URI: {' '.join(url.split())}"] if url else []
        if refers_to is not None:
            head = ["WARC/1.1", "WARC-Type: revisit", f"WARC-Record-ID: <{name}>", f"WARC-Date: {DATE}", *uri, f"WARC-Refers-To: <urn:x-page:{refers_to}>",
                    f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {n_bytes}", "Content-Length: 0", "", ""]
        else:
            head = ["WARC/1.1", f"WARC-Type: {'continuation' if chunk else 'response'}", f"WARC-Record-ID: <{name}{f':{chunk}' if chunk else ''}>", f"WARC-Date: {DATE}", *uri,
                    f"WARC-Segment-Number: {chunk + 1}", *([f"WARC-Segment-Origin-ID: <{name}>"] if chunk else []), f"X-Digest-So-Far: sha1:{so_far}", f"Content-Length: {size}", "", ""]
        return "\r\n".join(head).encode()

    def run(batches):
        whole = hashlib.sha1()
        for batch in batches:
            parts, out, size = batch.column(6), [], 0
            for k, row in enumerate(zip(*(batch.column(c).to_pylist() for c in range(6)), strict=True)):
                part = parts[k].as_py() or b""
                if not row[5]:
                    whole = hashlib.sha1()
                whole.update(part)
                so_far = row[3] if row[4] is not None else whole.hexdigest()
                out.append((row[0], row[5], so_far, header(*row, len(part), so_far) + part))
                size += len(part)
                if size > 4 << 20:
                    yield _batch(out)
                    out, size = [], 0
            if out:
                yield _batch(out)

    return rows.mapInArrow(run, CHUNK_SCHEMA)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int32(), pa.string(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], ["page_id", "chunk", "sha1_so_far", "value"])


def write_archives(pages: DataFrame, path: str, chunk_bytes: int = CHUNK_BYTES) -> None:
    """One gzip WARC file for each partition.  A record ends with two line breaks, which the writer sets between rows."""
    chunk_records(roles(pages), chunk_bytes).select(F.col("value").cast("string").alias("value")).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(path)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row for each record, its segments joined; ``intact``: every running digest was right.

    A gzip file is read by one task from its start, line by line; only a
    record's header and the line in hand are in memory.
    """

    def run(batches):
        out: list[tuple] = []
        now, header, left, digest = None, None, 0, None

        def close():
            nonlocal now
            if now:
                out.append((now["id"], now["n"], now["sha"], now["type"], now["refers"], now["chunks"], now["ok"]))
            now = None

        def page(ref: str):
            number = ref.strip("<>").split(":")[2]
            return int(number) if number else None

        def opened(h: dict):
            nonlocal now, digest, left
            left = int(h["content-length"])
            if h["warc-type"] == "continuation":
                now["chunks"] += 1
            else:
                close()
                digest = hashlib.sha1()
                revisit = h["warc-type"] == "revisit"
                now = {"id": page(h["warc-record-id"]), "type": h["warc-type"], "refers": page(h["warc-refers-to"]) if revisit else None, "chunks": 1, "ok": True,
                       "n": int(h["x-payload-length"]) if revisit else 0, "sha": h["warc-payload-digest"][5:] if revisit else digest.hexdigest()}
            now["so_far"] = h.get("x-digest-so-far", "sha1:")[5:]
            if not left:
                check()

        def check():
            if now["type"] == "response":
                now["sha"] = digest.hexdigest()
                now["ok"] &= now["sha"] == now["so_far"]

        for batch in batches:
            for value in batch.column(0).cast(pa.large_binary()):
                line = value.as_buffer().to_pybytes() if value.is_valid else b""
                if left:
                    part = (line + b"\n")[:left]
                    digest.update(part)
                    now["n"] += len(part)
                    left -= len(part)
                    if not left:
                        check()
                elif header is not None:
                    text = line.decode().rstrip("\r")
                    if text:
                        key, _, v = text.partition(":")
                        header[key.lower()] = v.strip()
                    else:
                        h, header = header, None
                        opened(h)
                elif line.startswith(b"WARC/1.1"):
                    header = {}
            if len(out) > 5000:
                yield _records(out)
                out.clear()
        close()
        if out:
            yield _records(out)

    return spark.read.option("lineSep", "\n").text(path).mapInArrow(run, RECORD_SCHEMA)


def _records(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int32(), pa.bool_())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], [f.split()[0] for f in RECORD_SCHEMA.split(", ")])


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(read_table(spark, sf_dir, "pages"), path)
    return read_archives(spark, path)


ORACLE_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS stored FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> stored THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> stored THEN stored END AS refers_to,
       CAST(CASE WHEN payload_bytes >= 1000 AND page_id <> stored THEN 1 ELSE greatest(1, ceil(payload_bytes / 65536.0)) END AS INTEGER) AS n_chunks, true AS intact
FROM g
"""
