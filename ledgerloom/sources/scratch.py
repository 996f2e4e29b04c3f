"""Intermediate tables in the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from .sinks import remove


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where the session names none, a temporary folder is taken and set on a
    single machine; on a cluster, whose machines do not share such folders,
    it is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="ledgerloom-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    when_done(lambda: discard(out))
    return out


def discard(*tables: DataFrame) -> None:
    """Delete what ``materialize`` wrote; nothing that is still to be computed may read it."""
    for t in tables:
        if path := t.__dict__.pop("scratch_path", None):
            remove(t.sparkSession, path)


_scopes: list[list[Callable[[], None]]] = []


def when_done(delete: Callable[[], None]) -> None:
    """Have something deleted at the end of the innermost ``temporary``, if there is one."""
    if _scopes:
        _scopes[-1].append(delete)


@contextmanager
def temporary() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Tables written inside are deleted at its end, but for a written table that is given to the function it yields."""
    kept: list[tuple[DataFrame, str]] = []

    def keep(table: DataFrame) -> DataFrame:
        kept.append((table, table.__dict__.pop("scratch_path")))  # without its path nothing deletes it
        return table

    _scopes.append([])
    try:
        yield keep
    finally:
        for delete in _scopes.pop():
            delete()
        for table, path in kept:
            table.scratch_path = path
