"""What a user asks for: each command reads tables, applies operators and publishes the result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import audit, keys, queue, statements
from ..operators.changes import entities_with_accounts, relevant_updates
from ..sources import files
from ..sources.sinks import current, publish
from ..sources.tables import MANIFEST


def seed(entities: DataFrame, years: DataFrame, now: Column) -> tuple[DataFrame, DataFrame]:
    """First queue of a register: (fast rows for the latest accounts of each entity, stubs for the rest of their years)."""
    e = entities_with_accounts(entities).withColumnRenamed("organisasjonsnummer", "orgnr")
    latest = e.select("orgnr", F.col("sisteInnsendteAarsregnskap").try_cast("int").alias("year")).where("year is not null")
    fast = latest.withColumns({"create_time": now.cast("long"), "processing_priority": now.cast("long")})
    return fast, queue.new_stubs(years, e)


def patch(old_queue: DataFrame, updates: DataFrame, now: Column) -> DataFrame:
    """The queue after a change feed: updates with a year enter the fast lane."""
    u = relevant_updates(updates).where("year is not null").select("orgnr", "year", F.col("oppdateringsid").alias("ordinal"))
    return queue.enqueue_fast(old_queue, u, now)


def drain(spark: SparkSession, holding: str, manifest: DataFrame, accounts: DataFrame, now: str) -> DataFrame:
    """The manifest with what lies in the holding area; draining twice changes nothing."""
    found = audit.pair_accounts(files.holding(spark, holding), accounts)
    new = found.select("orgnr", "year", F.lit(1).alias("version"), F.lit(now).alias("download_timestamp"), F.col("path").alias("pdf_path"), "journalnr", F.lit("success").alias("status"))
    return keys.upsert(manifest, new)


def coordinate(spark: SparkSession, table: str, waiting: DataFrame, holding: str, accounts: DataFrame, now: str) -> DataFrame:
    """Drain, publish the manifest (the first one where there is none), and give the prioritised work list of the fast lane.

    ``now`` is ISO text, as the manifest keeps it.
    """
    old = current(spark, table)
    publish(drain(spark, holding, old if old is not None else spark.createDataFrame([], MANIFEST), accounts, now), table)
    return queue.prioritised(queue.work_list(waiting, current(spark, table), "fast"))


def next_work(waiting: DataFrame, manifest: DataFrame, *, discovery: DataFrame | None = None) -> tuple[str, DataFrame]:
    """The lane whose turn it is and its rows: fast; stubs when no fast row is open; then slow."""
    lanes = queue.with_lane(queue.pending(waiting, manifest))
    fast = lanes.where("lane = 'fast'")
    if not fast.isEmpty():
        return "fast", fast
    stubs = discovery if discovery is not None else waiting.where("year is null")
    if not stubs.isEmpty():
        return "stub", stubs
    return "slow", lanes.where("lane = 'slow'")


def collect(ranked: DataFrame, index: int, count: int, cursor: int = 0, batch: int = 0) -> DataFrame:
    """A collector's share of the work list from its cursor on."""
    own = queue.slice_of(ranked, index, count).withColumn("position", F.floor(F.col("position") / count))
    return queue.resume(own, cursor, batch)


def accounts_to_fetch(collected: DataFrame) -> DataFrame:
    """The JSON side pass: each entity of collected filings once, in order."""
    return collected.select("orgnr").distinct().orderBy("orgnr")


def counted(results: DataFrame) -> tuple[DataFrame, Observation]:
    """Results of a run (kind: pdf or json; outcome: success, failed or skipped), counted as they pass; the counts are there once a job has run."""
    run = Observation("run")
    ok = F.col("outcome") == "success"
    return results.observe(
        run, F.count(F.lit(1)).alias("processed"), F.count_if(ok).alias("success"), F.count_if(F.col("outcome") == "failed").alias("failed"), F.count_if(F.col("outcome") == "skipped").alias("skipped"),
        F.count_if(ok & (F.col("kind") == "pdf")).alias("pdfs"), F.count_if(ok & (F.col("kind") == "json")).alias("jsons"),
    ), run


def merge_manifests(spark: SparkSession, shards: list[DataFrame], table: str) -> DataFrame:
    publish(keys.merge_shards(shards, [F.col("status").asc(), F.col("pdf_path").asc_nulls_last()]), table)
    return current(spark, table)


def compact(spark: SparkSession, table: str, manifest: DataFrame) -> int:
    """Drop done rows of the published queue; returns how many went.  Rows are counted as they are written."""
    old = current(spark, table)
    if old is None:
        return 0
    had, kept = Observation(), Observation()
    publish(queue.compact(old.observe(had, F.count(F.lit(1)).alias("n")), manifest).observe(kept, F.count(F.lit(1)).alias("n")), table)
    return had.get["n"] - kept.get["n"]


def status(manifest: DataFrame, waiting: DataFrame) -> tuple[DataFrame, DataFrame]:
    return audit.status_histogram(manifest, ["success", "failed", "pending", "not_found"]), queue.shard_stats(waiting, manifest)


def verify(manifest: DataFrame, listing: DataFrame) -> DataFrame:
    return audit.lost_paths(manifest, listing).groupBy("kind").agg(F.count("*").alias("n_lost"))


def extract_text(pages: DataFrame, doc_keys: list[str], page: str = "page") -> DataFrame:
    """Notes, wide line items and labels of filings from their recognised pages, one row each."""
    docs = statements.join_pages(pages, doc_keys, page)
    items = statements.line_items(docs, doc_keys)
    known = list(dict.fromkeys(statements.LINE_ITEM_MAP.values()))
    wide = statements.wide_items(items, doc_keys, known)
    return statements.extracted(docs, wide, doc_keys)


def consolidate(old: DataFrame, new: DataFrame) -> DataFrame:
    """Extracted rows by filing, new ones in place of old, all columns of both, in order."""
    return keys.upsert(old, new, keys.FILING).orderBy(*keys.FILING)


def extraction_targets(manifest: DataFrame, entities: DataFrame, done: DataFrame, year: int, segments: list[str], limit: int = 0) -> DataFrame:
    """Filings to send to the model: of the year and segments, not extracted before; a batch of them in stable order if limited."""
    t = audit.not_extracted(audit.targets(manifest, entities, year, segments), done)
    return t.orderBy("orgnr", "version").limit(limit) if limit else t
