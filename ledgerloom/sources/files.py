"""Stored objects: listings, archive members, pages from recognition services."""

from __future__ import annotations

import re
import zipfile
import zlib
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import holding_name, parse_file_name
from .scratch import materialize


def listing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Paths, sizes and times of the objects under a path; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)
    return files.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def holding(spark: SparkSession, path: str) -> DataFrame:
    """(orgnr, year, path) of collected PDFs; other names are left out."""
    d = listing(spark, path, "*.pdf").withColumn("_f", holding_name(F.col("path")))
    return d.select("_f.*", "path").where("orgnr is not null and year is not null")


def archived(spark: SparkSession, path: str) -> DataFrame:
    """The same of files with either of the archives' names."""
    d = listing(spark, path, "*.pdf").withColumn("_f", parse_file_name(F.col("path")))
    return d.select("_f.*", "path").where("orgnr is not null and year is not null")


def years_of(spark: SparkSession, path: str) -> DataFrame:
    """(orgnr, years): the years each entity has a file for, sorted."""
    return archived(spark, path).groupBy("orgnr").agg(F.array_sort(F.collect_set("year")).alias("years"))


def open_ranged(path: str):
    """A file that can be read in parts, from any store that Arrow reaches."""
    from pyarrow import fs

    store, name = fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path) if path.startswith("file:") else path)
    return store.open_input_file(name)


#: Bytes of packed members that one task reads.
MEMBER_BYTES = 64 << 20
MEMBER_SCHEMA = "archive string, member string, at long, packed long, size long, method int, crc long"


def zip_entries(spark: SparkSession, path: str, suffix: str = ".pdf") -> DataFrame:
    """Members of ZIP archives and where they lie, from the central directories alone; broken archives give nothing."""

    def run(batches):
        for batch in batches:
            for name in batch["path"]:
                try:
                    with open_ranged(name) as f, zipfile.ZipFile(f) as z:
                        found = [(name, m.filename, m.header_offset, m.compress_size, m.file_size, m.compress_type, m.CRC) for m in z.infolist() if m.filename.lower().endswith(suffix) and not m.flag_bits & 1]
                except (zipfile.BadZipFile, OSError, ValueError):
                    continue
                yield pd.DataFrame(found, columns=[c.split()[0] for c in MEMBER_SCHEMA.split(", ")])

    return listing(spark, path, "*.zip").select("path").mapInPandas(run, MEMBER_SCHEMA)


def read_member(f, at: int, packed: int, size: int, method: int, crc: int) -> bytes | None:
    """A member's content by one ranged read; None if it is broken or packed in an unknown way."""
    f.seek(at)
    head = f.read(30)
    if len(head) < 30 or head[:4] != b"PK\3\4":
        return None
    f.seek(at + 30 + int.from_bytes(head[26:28], "little") + int.from_bytes(head[28:30], "little"))
    raw = f.read(packed)
    try:
        content = raw if method == zipfile.ZIP_STORED else zlib.decompressobj(-15).decompress(raw, size + 1) if method == zipfile.ZIP_DEFLATED else None
    except zlib.error:
        return None
    return content if content is not None and len(content) == size and zlib.crc32(content) == crc else None


def zip_members(spark: SparkSession, path: str, suffix: str = ".pdf") -> DataFrame:
    """(archive, member, content) of ZIP archives of any size.

    The entries are written first and dealt out by size, so an archive is read
    by many tasks, each by ranges and one member in memory at a time; broken
    archives and members, encrypted ones and other packings give nothing.
    """
    entries = materialize(zip_entries(spark, path, suffix), "members")
    total = entries.agg(F.sum("packed")).first()[0] or 0

    def run(batches):
        for batch in batches:
            for name, rows in batch.groupby("archive", sort=False):
                with open_ranged(name) as f:
                    for m in rows.itertuples(index=False):
                        content = read_member(f, m.at, m.packed, m.size, m.method, m.crc)
                        if content is not None:
                            yield pd.DataFrame({"archive": [name], "member": [m.member], "content": [content]})

    return entries.repartition(max(1, min(entries.count(), -(-total // MEMBER_BYTES))), "archive", "at").mapInPandas(run, "archive string, member string, content binary")


def recognise(pdfs: DataFrame, make_client: Callable[[], Callable[[bytes], list[str]]], single_over: int = 0) -> DataFrame:
    """(path, page, text) from a recognition client; what it cannot read has no pages.

    ``make_client`` is called once for each partition, where it runs.  A text
    that is alone counts only if it is longer than ``single_over`` characters.
    """

    def run(batches):
        client = make_client()
        for batch in batches:
            for path, raw in zip(batch["path"], batch["content"], strict=True):
                pages = client(raw)
                if pages and len(pages) == 1 and len(pages[0]) <= single_over:
                    continue
                if pages:
                    yield pd.DataFrame({"path": path, "page": range(1, len(pages) + 1), "text": pages})

    return pdfs.select("path", "content").mapInPandas(run, "path string, page int, text string")


def recognise_images(images: DataFrame, make_client: Callable[[], Callable[[list[bytes]], list[str]]], size: int = 16) -> DataFrame:
    """(path, page, text) of page images (path, page, image), sent ``size`` at a time; a page without an image has an empty text."""

    def run(batches):
        client = make_client()
        for batch in batches:
            some = batch["image"].notna()
            texts = pd.Series("", index=batch.index)
            rows = list(batch.index[some])
            for at in range(0, len(rows), size):
                part = rows[at : at + size]
                texts[part] = client([batch["image"][k] for k in part])
            yield pd.DataFrame({"path": batch["path"], "page": batch["page"], "text": texts})

    return images.select("path", "page", "image").mapInPandas(run, "path string, page int, text string")


def put_objects(objects: DataFrame, root: str) -> DataFrame:
    """Write (path, content) under a root that all executors reach, each object beside its place first and then named; gives (path, size).

    A task that runs again writes the same objects again.
    """
    def run(batches):
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(root)
        for batch in batches:
            for path, raw in zip(batch["path"], batch["content"], strict=True):
                to = f"{base}/{path}"
                store.create_dir(to.rsplit("/", 1)[0], recursive=True)
                with store.open_output_stream(f"{to}.part") as out:
                    out.write(raw)
                store.move(f"{to}.part", to)
            yield pd.DataFrame({"path": batch["path"], "size": batch["content"].map(len)})

    return objects.select("path", "content").mapInPandas(run, "path string, size long")


def truncated(finish_reason: Column) -> Column:
    """Whether a model stopped because its answer was too long."""
    return F.coalesce(finish_reason == "MAX_TOKENS", F.lit(False))


def split_pages(answers: DataFrame, keep: list[str], text: str = "text", mark: str = "---PAGE BREAK---") -> DataFrame:
    """Pages of an answer that holds them all, numbered from 1."""
    d = answers.select(*keep, F.posexplode(F.split(text, mark)).alias("page", "text"))
    return d.withColumns({"page": F.col("page") + 1, "text": F.trim("text")})
