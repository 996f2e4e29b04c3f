"""Table readers: manifests of any age, shards, snapshots, sections, dumps, key lists."""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .sinks import exists

#: The manifest's columns.
MANIFEST = (
    "orgnr string, year int, version int, download_timestamp string, file_hash string, pdf_hash string, json_path string, pdf_path string, "
    "file_size_bytes long, is_correction boolean, journalnr string, source_url string, status string, error_detail string"
)
QUEUE = "orgnr string, year int, create_time long, processing_priority long, source string, shard string"


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The manifest with today's columns: missing ones are null (``version`` 1), others are not read; no file is an empty table."""
    if not exists(spark, path):
        return spark.createDataFrame([], MANIFEST)
    df = spark.read.schema(MANIFEST).parquet(path)
    return df.withColumn("version", F.coalesce("version", F.lit(1)))


def read_shards(spark: SparkSession, pattern: str) -> DataFrame:
    """Files that match a pattern, their columns united by name."""
    return spark.read.option("mergeSchema", True).parquet(pattern)


def read_queue_shard(spark: SparkSession, path: str, digit: int) -> DataFrame:
    """One shard; only its folder is listed."""
    if not exists(spark, path):
        return spark.createDataFrame([], QUEUE)
    return spark.read.schema(QUEUE).parquet(path).where(F.col("shard") == str(digit))


def latest_snapshot(spark: SparkSession, pattern: str, columns: list[str]) -> DataFrame:
    """Some columns of the file or folder whose path is the last of those that match; the others are not read."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(pattern)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    paths = sorted(s.getPath().toString() for s in found or [])
    if not paths:
        raise FileNotFoundError(pattern)
    return spark.read.parquet(paths[-1]).select(*columns)


def read_section(spark: SparkSession, store: str, section: str) -> DataFrame:
    """All runs of a section; the folders' date and time are read as strings, with their leading zeros."""
    path, folders = f"{store}/{section}", ("collection_date", "collection_time")
    fields = [f for f in spark.read.parquet(path).schema if f.name not in folders]
    return spark.read.schema(StructType([*fields, *(StructField(c, StringType()) for c in folders)])).parquet(path)


def latest_collection(section: DataFrame, keys: list[str]) -> DataFrame:
    """Of each content the rows of its last run; a run may hold several."""
    w = Window.partitionBy(*keys).orderBy(F.desc("collection_date"), F.desc("collection_time"))
    return section.withColumn("_r", F.rank().over(w)).where("_r = 1").drop("_r")


#: Bytes that a dump is unpacked by, and the longest element.
PART, LONGEST = 1 << 20, 256 << 20
_TOKEN = re.compile(rb'"(?:[^"\\]|\\.)*(?:"|\\?$)|[][{},]', re.DOTALL)


def unpacked(f) -> Iterator[bytes]:
    """Parts of a gzip file, with all its members; a file cut short ends there."""
    d = zlib.decompressobj(31)
    while raw := d.unconsumed_tail or f.read(PART):
        yield d.decompress(raw, PART)
        while d.eof and (rest := d.unused_data or f.read(PART)):
            d = zlib.decompressobj(31)
            yield d.decompress(rest, PART)


def elements(parts: Iterator[bytes]) -> Iterator[bytes]:
    """Raw elements of a JSON array that comes in parts, one in memory at a time.

    Brackets outside strings tell where an element ends, so a broken element
    ends where its brackets do and the next one is read as usual.
    """
    held, depth, begin, at = b"", 0, 0, 0
    for part in _growing(parts, lambda: len(held)):
        held += part
        done = False
        while not done:
            m = _TOKEN.search(held, at)
            if m is None or (m.end() == len(held) and held[m.start()] == 34 and not _closed(m[0])):
                at = m.start() if m else len(held)  # a string that goes on in the next part
                break
            at, c = m.end(), held[m.start()]
            if c in b"[{":
                depth += 1
                if depth == 1:
                    begin = at
            elif (c == 44 and depth == 1) or c in b"]}":
                depth -= c != 44
                if depth == 0 or c == 44:
                    if raw := held[begin : m.start()].strip():
                        yield raw
                    begin, done = at, depth == 0
        held, at, begin = held[begin:], at - begin, 0
        if len(held) > LONGEST:
            raise ValueError(f"an element of a dump is longer than {LONGEST} bytes")
        if done:
            return
    if rest := held[begin:].strip():
        yield rest


def _closed(string: bytes) -> bool:
    return len(string) > 1 and string.endswith(b'"') and (len(string) - len(string[:-1].rstrip(b"\\"))) % 2 == 1


def _growing(parts: Iterator[bytes], held: Callable[[], int]) -> Iterator[bytes]:
    """Parts, joined to at least half of what is held, so that a long element is not copied for each part."""
    some: list[bytes] = []
    for p in parts:
        some.append(p)
        if sum(map(len, some)) * 2 >= held():
            yield b"".join(some)
            some = []
    if some:
        yield b"".join(some)


def read_dump(spark: SparkSession, path: str, schema: str, partitions: int = 64, bad: str | None = None) -> DataFrame:
    """Entities of gzip files that hold a JSON array each.

    A file is unpacked part by part and cut into elements, one of which is in
    memory at a time; then rows are dealt out.  An element that does not parse
    is left out, or with ``bad`` kept as text in a column of that name, its
    other columns null.
    """

    def run(batches):
        from .files import open_ranged

        for batch in batches:
            for name in batch["path"].to_pylist():
                with open_ranged(name) as f:
                    some, size = [], 0
                    for e in elements(unpacked(f)):
                        some.append(e.decode("utf-8", "replace"))
                        size += len(e)
                        if size >= PART:
                            yield pa.RecordBatch.from_pydict({"value": pa.array(some)})
                            some, size = [], 0
                    if some:
                        yield pa.RecordBatch.from_pydict({"value": pa.array(some)})

    files = spark.read.format("binaryFile").load(path).select("path")
    rows = files.mapInArrow(run, "value string").repartition(partitions)
    parsed = rows.select(F.from_json("value", f"{schema}, __bad string", {"columnNameOfCorruptRecord": "__bad"}).alias("r"), "value")
    broken = F.col("r").isNull() | F.col("r.__bad").isNotNull()
    names = StructType.fromDDL(schema).fieldNames()
    if bad is None:
        return parsed.where(~broken).select(*[F.col(f"r.`{c}`") for c in names])
    return parsed.select(*[F.when(~broken, F.col(f"r.`{c}`")).alias(c) for c in names], F.when(broken, F.col("value")).alias(bad))


def key_list(spark: SparkSession, path: str) -> DataFrame:
    """Keys one a line, or several with commas between; blanks and repeats are dropped."""
    words = spark.read.text(path).select(F.explode(F.split("value", ",")).alias("k"))
    return words.select(F.trim("k").alias("orgnr")).where("orgnr <> ''").distinct()
