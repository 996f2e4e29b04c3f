"""A cursor over work that ends out of order.

Items are numbered; several are under way at once and end in any order.  What
has ended is kept as disjoint intervals, folded batch by batch into a published
table.  The cursor is the end of the interval that starts at the first item:
everything up to it has ended, so a restart from there loses nothing, and the
other intervals say what beyond it need not run again.  Folding a batch twice
changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.ranking import merged
from ..sources.sinks import current, publish


def fold(ended: DataFrame | None, batch: DataFrame, position: str = "position") -> DataFrame:
    """Intervals (lo, hi) of all that has ended: those known and the positions of a batch."""
    new = batch.where(F.col(position).isNotNull()).select(F.col(position).cast("long").alias("lo")).distinct().withColumn("hi", F.col("lo"))
    return merged(new if ended is None else ended.select("lo", "hi").unionByName(new))


def cursor(ended: DataFrame | None, first: int = 0) -> int:
    """The last position up to which all from ``first`` on have ended; ``first`` - 1 if none."""
    row = ended.where((F.col("lo") <= first) & (F.col("hi") >= first)).agg(F.max("hi").alias("hi")).first() if ended is not None else None
    return first - 1 if row is None or row["hi"] is None else row["hi"]


def startable(ranked: DataFrame, ended: DataFrame | None, size: int, first: int = 0, position: str = "position") -> DataFrame:
    """The next items, so that at most ``size`` lie between the cursor and the last one started: none ended, none beyond the window."""
    at = cursor(ended, first)
    window = ranked.where((F.col(position) > at) & (F.col(position) <= at + size))
    if ended is None:
        return window
    inside = ended.where((F.col("hi") > at) & (F.col("lo") <= at + size))
    done = inside.select(F.explode(F.sequence(F.greatest("lo", F.lit(at + 1)), F.least("hi", F.lit(at + size)))).alias(position))  # at most ``size`` rows
    return window.join(done, position, "left_anti").select(*ranked.columns)


def track(stream: DataFrame, table: str, checkpoint: str, position: str = "position") -> StreamingQuery:
    """Fold a stream of ended items into the published table of intervals, batch by batch; resumes from the checkpoint."""
    spark = stream.sparkSession

    def body(batch: DataFrame, _: int) -> None:
        publish(fold(current(spark, table), batch, position), table)

    return stream.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def tracked(spark: SparkSession, table: str, first: int = 0) -> int:
    """The cursor of a published table."""
    return cursor(current(spark, table), first)
