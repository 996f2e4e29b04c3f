"""The work queue: what is pending, in which lane, and who does it.

A queue row is ``orgnr, year, create_time, processing_priority`` with times in
whole seconds; ``year`` is null in a stub, whose years are not known yet.  The
manifest's ``download_timestamp`` is ISO text; ``download_seconds`` is the one
place that turns it into seconds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import unix_or_zero, year_start
from .keys import FILING, keep_last, upsert, without
from .ranking import global_rank, running


def is_success(status: str = "status", path: str = "pdf_path") -> Column:
    return (F.col(status) == "success") & F.col(path).isNotNull() & (F.col(path) != "")


def download_seconds(time: str = "download_timestamp") -> Column:
    """Seconds of the manifest's time; text that is no time counts as 0, long ago."""
    return unix_or_zero(F.col(time))


def latest_success(manifest: DataFrame, time: str = "download_timestamp") -> DataFrame:
    """Seconds of the latest success of each (orgnr, year)."""
    return manifest.where(is_success()).groupBy(*FILING).agg(F.max(download_seconds(time)).alias("latest"))


def merge_times(times: DataFrame, new: DataFrame) -> DataFrame:
    """Fold the times of newly written rows into those known."""
    return times.unionByName(new).groupBy(*FILING).agg(F.max("latest").alias("latest"))


def shard_of(orgnr: Column, shards: int = 10) -> Column:
    return F.pmod(orgnr.cast("bigint"), F.lit(shards))


def with_lane(queue: DataFrame) -> DataFrame:
    """``lane``: stub without a year, fast if the priority is the time of creation, else slow."""
    return queue.withColumn("lane", F.when(F.col("year").isNull(), "stub").when(F.col("processing_priority") == F.col("create_time"), "fast").otherwise("slow"))


def _with_latest(queue: DataFrame, manifest: DataFrame) -> DataFrame:
    return queue.join(latest_success(manifest), FILING, "left")


def pending(queue: DataFrame, manifest: DataFrame) -> DataFrame:
    """Rows with a year that have no success, or none since they were queued."""
    open_ = F.col("latest").isNull() | (F.col("create_time") > F.col("latest"))
    return _with_latest(queue.where(F.col("year").isNotNull()), manifest).where(open_).drop("latest")


def compact(queue: DataFrame, manifest: DataFrame) -> DataFrame:
    """The queue without what is done; stubs stay."""
    keep = F.col("year").isNull() | F.col("latest").isNull() | (F.col("create_time") > F.col("latest"))
    return _with_latest(queue, manifest).where(keep).drop("latest")


def work_list(queue: DataFrame, manifest: DataFrame, lane: str | None = None) -> DataFrame:
    """Pending rows, of one lane if given, by an anti join whose residual compares times; nothing is aggregated first."""
    m = manifest.where(is_success()).select(F.col("orgnr").alias("_o"), F.col("year").alias("_y"), download_seconds().alias("_t"))
    done = (queue["orgnr"] == m["_o"]) & (queue["year"] == m["_y"]) & (m["_t"] >= queue["create_time"])
    open_ = queue.where(F.col("year").isNotNull()).join(m, done, "left_anti")
    return with_lane(open_).where(F.col("lane") == lane).drop("lane") if lane else open_


def prioritised(work: DataFrame) -> DataFrame:
    """``position`` in the order of falling priority, then orgnr, then year."""
    return global_rank(work, [F.col("processing_priority").desc_nulls_last(), F.col("orgnr").asc_nulls_last(), F.col("year").asc_nulls_last()])


def free_shards(changed: DataFrame, now: Column, hours: int = 2, shards: int = 10) -> DataFrame:
    """Shards that no file is known of in ``changed`` (shard, modified), or none changed within the hours; a worker picks any of them."""
    held = changed.where(F.col("modified") >= now - F.make_interval(hours=F.lit(hours))).select(F.col("shard").cast("int").alias("shard")).distinct()
    return changed.sparkSession.range(shards).select(F.col("id").cast("int").alias("shard")).join(held, "shard", "left_anti")


def slice_of(ranked: DataFrame, index: int, count: int) -> DataFrame:
    """Every ``count``-th row from ``index`` on: the slices of all indexes are disjoint and complete."""
    return ranked.where(F.pmod("position", F.lit(count)) == index)


def resume(ranked: DataFrame, cursor: int, batch: int = 0) -> DataFrame:
    """Rows from ``cursor`` on, at most ``batch`` of them (0: all)."""
    rest = ranked.where(F.col("position") >= cursor)
    return rest.where(F.col("position") < cursor + batch) if batch else rest


#: Seconds of a run that are kept back for its end.
RESERVE = 120


def budgeted(work: DataFrame, cost: Column, budget: float, reserve: float = RESERVE) -> DataFrame:
    """The first rows of the prioritised order that a run has time for: a row starts while what the rows before it cost leaves ``reserve`` of the budget.

    ``spent`` is the cost of the rows before.  The order is cut once, so no
    cheap row jumps the queue; null and negative costs count as nothing.  Costs
    are summed range by range, never in one task.
    """
    order = [F.col("processing_priority").desc_nulls_last(), F.col("orgnr").asc_nulls_last(), F.col("year").asc_nulls_last()]
    own = F.greatest(F.coalesce(cost, F.lit(0)), F.lit(0))
    return running(work.withColumn("_cost", own), order, F.col("_cost"), "_through").withColumn("spent", F.col("_through") - F.col("_cost")).drop("_cost", "_through").where(F.col("spent") <= budget - reserve)


def enqueue_fast(queue: DataFrame, entries: DataFrame, now: Column) -> DataFrame:
    """``entries`` (orgnr, year, ordinal) enter again with ``now`` (seconds) as time and priority; the last of equal keys counts."""
    new = keep_last(entries, FILING, "ordinal").select(*FILING, now.alias("create_time"), now.alias("processing_priority"))
    return upsert(queue, new, FILING)


def enqueue_slow(queue: DataFrame, candidates: DataFrame, manifest: DataFrame, now: Column) -> DataFrame:
    """New rows for years neither queued nor downloaded, made ``now`` (seconds); their priority is the start of their year."""
    new = without(without(candidates.select(*FILING).distinct(), queue, FILING), manifest.where(is_success()), FILING)
    return new.withColumns({"create_time": now.cast("long"), "processing_priority": year_start(F.col("year")).cast("long")})


def new_stubs(queue: DataFrame, entities: DataFrame) -> DataFrame:
    """Entities that have no stub yet."""
    return without(entities.select("orgnr").distinct(), queue.where("year is null"), ["orgnr"]).withColumn("year", F.lit(None).cast("int"))


def drop_stubs(queue: DataFrame, resolved: DataFrame) -> DataFrame:
    """The queue without the stubs of ``resolved`` entities; rows with a year stay."""
    stub = F.col("year").isNull()
    return queue.where(~stub).unionByName(without(queue.where(stub), resolved, ["orgnr"]))


def shard_stats(queue: DataFrame, manifest: DataFrame, shards: int = 10) -> DataFrame:
    """Counts by shard, and over all shards (shard null)."""
    q = with_lane(_with_latest(queue, manifest)).withColumn("shard", shard_of(F.col("orgnr"), shards))
    is_open = F.col("year").isNotNull() & (F.col("latest").isNull() | (F.col("create_time") > F.col("latest")))
    return q.rollup("shard").agg(
        F.count("*").alias("total"), F.count_if(F.col("lane") == "stub").alias("stubs"), F.count_if(is_open).alias("pending"),
        F.count_if(is_open & (F.col("lane") == "fast")).alias("fast"), F.count_if(is_open & (F.col("lane") == "slow")).alias("slow"),
    )
