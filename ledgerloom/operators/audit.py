"""Audits: what is missing, unchanged, corrected, orphaned, or repeated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .keys import FILING, keep_first, without


def missing(wanted: DataFrame, manifest: DataFrame) -> DataFrame:
    """Rows of ``wanted`` without a filing; an ordinal it carries keeps their order."""
    return without(wanted, manifest, FILING)


def unchanged(new: DataFrame, manifest: DataFrame) -> DataFrame:
    """Rows of ``new`` whose file or PDF hash its filing already has; null and empty hashes match nothing."""
    def clean(c: str) -> Column:
        return F.nullif(F.col(c), F.lit(""))

    m = manifest.select(F.col("orgnr").alias("_o"), F.col("year").alias("_y"), clean("file_hash").alias("_f"), clean("pdf_hash").alias("_p"))
    hit = (clean("file_hash") == F.col("_f")) | (clean("pdf_hash") == F.col("_p"))
    return new.join(m, (new["orgnr"] == m["_o"]) & (new["year"] == m["_y"]) & hit, "left_semi")


def corrections(new: DataFrame, manifest: DataFrame) -> DataFrame:
    """``corrected``: some row of the filing has another journal number."""
    known = manifest.where("journalnr is not null and journalnr <> ''").groupBy(*FILING).agg(F.min("journalnr").alias("_lo"), F.max("journalnr").alias("_hi"))
    differs = (F.col("_lo") != F.col("journalnr")) | (F.col("_hi") != F.col("journalnr"))
    return new.join(known, FILING, "left").withColumn("corrected", F.coalesce(differs, F.lit(False))).drop("_lo", "_hi")


def lost_paths(manifest: DataFrame, listing: DataFrame) -> DataFrame:
    """Rows not marked failed, one for each path (pdf or json) that the listing lacks."""
    kept = manifest.where("status is null or status <> 'failed'")
    paths = kept.select(*FILING, F.inline(F.array(*(F.struct(F.lit(k).alias("kind"), F.col(f"{k}_path").alias("path")) for k in ("pdf", "json")))))
    return paths.where("path is not null and path <> ''").join(listing.select("path"), "path", "left_anti")


def orphans(listing: DataFrame, manifest: DataFrame, parse: Column) -> DataFrame:
    """Listed objects that no row points to, with a version that follows the largest of their filing; ``parse``: struct(orgnr, year) of the path."""
    known = manifest.select(F.col("pdf_path").alias("path")).where("path is not null")
    found = listing.join(known, "path", "left_anti").withColumn("_f", parse).select("path", "_f.*").where("orgnr is not null and year is not null")
    top = manifest.groupBy(*FILING).agg(F.max("version").alias("_top"))
    nth = F.row_number().over(Window.partitionBy(*FILING).orderBy("path"))
    return found.join(top, FILING, "left").withColumn("version", F.coalesce("_top", F.lit(0)) + nth).drop("_top")


def not_extracted(manifest: DataFrame, done: DataFrame) -> DataFrame:
    """Rows whose content (first 16 characters of the hash) no extraction has."""
    d = done.select(F.col("pdf_sha256_prefix").alias("_done")).distinct()
    return manifest.join(d, F.substring("pdf_hash", 1, 16) == d["_done"], "left_anti")


def pair_accounts(pdfs: DataFrame, accounts: DataFrame) -> DataFrame:
    """PDFs with the accounts of their orgnr, if these are of the same year; else null and ``mismatch``."""
    a = keep_first(accounts.where("json_year is not null"), ["orgnr", "json_year"], [F.col("journalnr").asc_nulls_last()])
    any_ = accounts.groupBy("orgnr").agg(F.lit(True).alias("_any"))
    paired = pdfs.join(a, (pdfs["orgnr"] == a["orgnr"]) & (pdfs["year"] == a["json_year"]), "left").drop(a["orgnr"]).join(any_, "orgnr", "left")
    return paired.withColumn("mismatch", F.coalesce("_any", F.lit(False)) & F.col("json_year").isNull()).drop("_any")


def version_by_content(rows: DataFrame, order: list[Column], content: str = "pdf_hash") -> DataFrame:
    """Distinct contents of a filing get versions in order of first sight; ``repeat`` marks later rows with one."""
    first = F.row_number().over(Window.partitionBy(*FILING, content).orderBy(*order)) == 1
    marked = rows.withColumn("repeat", ~first)
    v = F.sum(F.when(~F.col("repeat"), 1).otherwise(0)).over(Window.partitionBy(*FILING).orderBy(*order))
    return marked.withColumn("version", F.when(~F.col("repeat"), v.cast("int")))


def targets(manifest: DataFrame, entities: DataFrame, year: int, segments: list[str]) -> DataFrame:
    """Successful filings of a year of entities in some segments; entities that occur twice count twice."""
    from .queue import is_success

    e = entities.where(F.col("segment").isin(segments)).select(F.col("orgnr").alias("_e"), "segment")
    m = manifest.where((F.col("year") == year) & is_success())
    return m.join(e, m["orgnr"] == e["_e"]).drop("_e")


def grid(orgnrs: DataFrame, years: list[int]) -> DataFrame:
    """Every orgnr with every year of a short list; the list travels with the expression, so nothing is joined."""
    return orgnrs.select("orgnr", F.explode(F.array(*map(F.lit, years))).alias("year"))


def status_histogram(manifest: DataFrame, statuses: list[str]) -> DataFrame:
    """Counts of the given statuses that occur."""
    return manifest.where(F.col("status").isin(statuses)).groupBy("status").agg(F.count("*").alias("n"))


def download_outcomes(fetched: DataFrame, manifest: DataFrame) -> DataFrame:
    """What to record of each fetched filing: failed, missing, unchanged, new or correction; with its version where one is written."""
    same = unchanged(fetched, manifest).select(*FILING).distinct().withColumn("_same", F.lit(True))
    top = manifest.groupBy(*FILING).agg(F.max("version").alias("_top"))
    d = fetched.join(same, FILING, "left").join(top, FILING, "left")
    outcome = F.when(F.col("error").isNotNull(), "failed").when(F.col("pdf_hash").isNull(), "missing").when(F.col("_same"), "unchanged").when(F.col("_top") > 0, "correction").otherwise("new")
    d = d.withColumn("outcome", outcome)
    return d.withColumn("version", F.when(F.col("outcome").isin("new", "correction"), F.coalesce("_top", F.lit(0)) + 1)).drop("_same", "_top")


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", longer_than: int = 50) -> DataFrame:
    """Lines over a length, and how many repeat an earlier line of their text."""
    lines = F.filter(F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), lambda s: F.trim(s)), lambda s: F.length(s) > longer_than)
    keys = F.transform(lines, lambda s: F.substring(F.md5(s), 1, 16))
    return docs.select(id_col, F.size(keys).cast("long").alias("n_lines"), (F.size(keys) - F.size(F.array_distinct(keys))).cast("long").alias("n_repeated"))
