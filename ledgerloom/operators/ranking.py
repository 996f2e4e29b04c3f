"""Positions, running totals and intervals in a total order, without bringing all rows to one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..sources.scratch import materialize

#: Rows of a partition are numbered from its number shifted by so many bits.
PART_BITS = 33


def _inside() -> WindowSpec:
    """A range's rows up to the present one."""
    return Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _earlier() -> WindowSpec:
    """The ranges before the present one, a row each."""
    return Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)


def _dealt(df: DataFrame, order: list[Column]) -> DataFrame:
    """``df`` in written ranges of the whole order, so a hot leading value is split by those that follow it; ``_part`` and ``_at`` give each row's place."""
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    return materialize(ordered, "ranked").withColumn("_part", F.shiftright("_at", PART_BITS))


def global_rank(df: DataFrame, order: list[Column], name: str = "position") -> DataFrame:
    """Add the 0-based position in the order of any columns (which should end in tie-breakers); only the sizes of the ranges are summed in one place."""
    d = _dealt(df, order)
    offsets = d.groupBy("_part").count().select("_part", (F.coalesce(F.sum("count").over(_earlier()), F.lit(0)) - F.shiftleft("_part", PART_BITS)).alias("_before"))  # a row for each range
    return d.join(F.broadcast(offsets), "_part").withColumn(name, F.col("_before") + F.col("_at")).drop("_at", "_part", "_before")


def _scan(d: DataFrame, value: Column, fold, name: str) -> DataFrame:
    """Running ``fold`` (F.sum or F.max) over dealt rows: inside each range, with what the ranges before it come to."""
    d = d.withColumn("_v", value)
    whole = d.groupBy("_part").agg(fold("_v").alias("_whole")).select("_part", fold("_whole").over(_earlier()).alias("_before"))  # a row for each range
    inside = fold("_v").over(_inside())
    both = F.greatest(inside, "_before") if fold is F.max else F.coalesce(inside, F.lit(0)) + F.coalesce("_before", F.lit(0))
    return d.join(F.broadcast(whole), "_part").withColumn(name, both).drop("_v", "_before")


def running(df: DataFrame, order: list[Column], value: Column, name: str, fold=F.sum) -> DataFrame:
    """Add the running sum (or F.max) of ``value`` in a total order; nulls add nothing."""
    return _scan(_dealt(df, order), value, fold, name).drop("_at", "_part")


def merged(intervals: DataFrame) -> DataFrame:
    """Disjoint intervals (lo, hi) of whole numbers that cover the same numbers; neighbours become one."""
    d = _scan(_dealt(intervals.select("lo", "hi").where("lo <= hi"), [F.col("lo"), F.col("hi")]), F.col("hi"), F.max, "_reach")
    before = F.lag("_reach").over(Window.partitionBy("_part").orderBy("_at"))
    ends = d.groupBy("_part").agg(F.max("_reach").alias("_end")).select("_part", F.max("_end").over(_earlier()).alias("_left"))
    d = d.join(F.broadcast(ends), "_part").withColumn("_old", F.coalesce(before, "_left"))
    d = _scan(d, F.when(F.col("_old").isNull() | (F.col("lo") > F.col("_old") + 1), 1).otherwise(0), F.sum, "_isle")
    return d.groupBy("_isle").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("_isle")
