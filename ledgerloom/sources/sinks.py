"""Writers: published tables, partitioned sections, objects."""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def rename(spark: SparkSession, old: str, new: str) -> None:
    fs, p = _fs(spark, old)
    if not fs.rename(p, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(new)):
        raise OSError(f"cannot rename {old}")


def copy(spark: SparkSession, old: str, new: str) -> None:
    """Copy an object; nothing happens if there is none."""
    fs, p = _fs(spark, old)
    if fs.exists(p):
        to, q = _fs(spark, new)
        spark.sparkContext._jvm.org.apache.hadoop.fs.FileUtil.copy(fs, p, to, q, False, spark.sparkContext._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    """Delete a path; nothing happens if there is none."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def claim(spark: SparkSession, path: str, content: str = "") -> bool:
    """Create a small file unless there is one, in one step: of any number of writers one gets True.

    On a local disk the written file is linked to its name, which fails where
    the name is taken; elsewhere the store's own create without overwriting
    decides (atomic on HDFS, conditional on object stores that have it).
    """
    fs, p = _fs(spark, path)
    if fs.getUri().getScheme() == "file":
        local = Path(p.toUri().getPath())
        local.parent.mkdir(parents=True, exist_ok=True)
        own = local.with_name(f".{local.name}.{uuid.uuid4().hex}")
        own.write_text(content)
        try:
            os.link(own, local)
            return True
        except FileExistsError:
            return False
        finally:
            own.unlink()
    try:
        out = fs.create(p, False)
    except Py4JJavaError as e:
        if "AlreadyExists" in e.java_exception.getClass().getName() or fs.exists(p):
            return False
        raise
    out.write(bytearray(content.encode()))
    out.close()
    return True


def _numbers(spark: SparkSession, path: str, prefix: str = "") -> list[int]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n[len(prefix) :]) for n in names if n.startswith(prefix) and n[len(prefix) :].isdigit())


def publish(df: DataFrame, table: str, base: int | None = None) -> str:
    """Write a new snapshot beside the old ones, then name it: readers see the old or the new, never half of one.

    The snapshot is whole when its number is claimed, and the claim says where
    it lies: of several writers one gets the number, the others
    FileExistsError.  A writer that has read version ``base`` (0: none) and
    says so also gets the error if a later one is there, and can begin again
    from that.  Should a writer die between claim and name, the next one names
    the snapshot for it.  The name is the largest ``v=`` folder; the last but
    one stays for readers that have begun.
    """
    spark = df.sparkSession
    staged = f"{table}/_staging-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(staged)
    last = _settle(spark, table)
    path = f"{table}/v={last + 1:010d}"
    if (base is not None and base != last) or not claim(spark, f"{table}/_commits/{last + 1:010d}", staged):
        remove(spark, staged)
        raise FileExistsError(f"{table}: another writer has published since version {last if base is None else base}")
    _name(spark, staged, path)
    for old in versions(spark, table)[:-2]:
        remove(spark, f"{table}/v={old:010d}")
    return path


def _name(spark: SparkSession, staged: str, path: str) -> None:
    """Give a claimed snapshot its name, unless another writer has just done so."""
    try:
        rename(spark, staged, path)
    except (OSError, Py4JJavaError):
        if not exists(spark, path):
            raise


def _settle(spark: SparkSession, table: str) -> int:
    """The last number claimed; the snapshot of one that lacks its name gets it."""
    have, claimed = versions(spark, table), _numbers(spark, f"{table}/_commits")
    last = have[-1] if have else 0
    for number in claimed:
        if number > last:
            staged = _text(spark, f"{table}/_commits/{number:010d}")
            if exists(spark, staged):
                _name(spark, staged, f"{table}/v={number:010d}")
    return max([last, *claimed])


def versions(spark: SparkSession, table: str) -> list[int]:
    return _numbers(spark, table, "v=")


def current(spark: SparkSession, table: str) -> DataFrame | None:
    """The snapshot published last; None before the first."""
    have = versions(spark, table)
    return spark.read.parquet(f"{table}/v={have[-1]:010d}") if have else None


def coerce(df: DataFrame, schema: dict[str, str]) -> DataFrame:
    """Exactly the columns of a section: unknown ones go, missing ones are null, values that do not fit are null."""
    kinds = dict(df.dtypes)

    def column(name: str, kind: str):
        if name not in kinds:
            return F.lit(None).cast(kind)
        c = F.col(name)
        if kind == "string" and kinds[name].startswith(("array", "struct", "map")):
            return F.to_json(c, {"ignoreNullFields": "false"})
        if kind in ("bigint", "long", "int"):
            return c.cast("string").try_cast("double").try_cast(kind)
        return c.cast("string").try_cast(kind) if kind == "double" else c.try_cast(kind)

    return df.select(*(column(n, k).alias(n) for n, k in schema.items()))


def append_section(df: DataFrame, store: str, section: str, schema: dict[str, str], collection_date: str, collection_time: str) -> None:
    """Append records to a section, partitioned by the run's date and time (strings: leading zeros stay)."""
    out = coerce(df, schema).withColumns({"collection_date": F.lit(collection_date), "collection_time": F.lit(collection_time)})
    out.write.mode("append").option("compression", "zstd").partitionBy("collection_date", "collection_time").parquet(f"{store}/{section}")


def write_by_shard(queue: DataFrame, path: str) -> None:
    """The queue by shard; only the shards that ``queue`` holds are rewritten.  Each shard is dealt to several files."""
    parted = queue.repartition("shard", F.pmod(F.xxhash64("orgnr"), F.lit(8)))
    parted.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy("shard").parquet(path)


def lines_of(df: DataFrame) -> DataFrame:
    """Rows as JSON."""
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"))


@contextmanager
def lease(spark: SparkSession, folder: str, holder: str, now: float, max_age: float) -> Iterator[bool]:
    """Whether this run holds the lease (``now`` and ``max_age`` in seconds); given back at the end, come what may.

    Each holder claims the next number, so of runs that find no lease, or a
    stale one, one gets it.  A lease is open until its ``.done`` file is there
    or it is ``max_age`` old.
    """
    held = _numbers(spark, folder)
    mine = None
    if not held or exists(spark, f"{folder}/{held[-1]:010d}.done") or now - json.loads(_text(spark, f"{folder}/{held[-1]:010d}"))["acquired_at"] >= max_age:
        mine = (held[-1] if held else 0) + 1
        if not claim(spark, f"{folder}/{mine:010d}", json.dumps({"holder": holder, "acquired_at": now})):
            mine = None
    try:
        yield mine is not None
    finally:
        if mine is not None:
            claim(spark, f"{folder}/{mine:010d}.done")


def _text(spark: SparkSession, path: str) -> str:
    """A small file."""
    return spark.read.text(path, wholetext=True).first()["value"]
