"""Keyed tables: upsert, keep-latest, versions, set differences.

Keys compare null-safe: a null key column is a value like others.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FILING = ["orgnr", "year"]
VERSIONED = [*FILING, "version"]


def same(left: DataFrame, right: DataFrame, keys: list[str], prefix: str = "_k_") -> Column:
    """Null-safe equality of ``keys`` with their renamed copies in ``right``."""
    return reduce(lambda a, b: a & b, (left[k].eqNullSafe(right[prefix + k]) for k in keys))


def only_keys(df: DataFrame, keys: list[str], prefix: str = "_k_") -> DataFrame:
    return df.select(*(F.col(k).alias(prefix + k) for k in keys)).distinct()


def without(base: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``base`` whose key ``gone`` lacks."""
    k = only_keys(gone, keys)
    return base.join(k, same(base, k, keys), "left_anti")


def within(base: DataFrame, kept: DataFrame, keys: list[str]) -> DataFrame:
    k = only_keys(kept, keys)
    return base.join(k, same(base, k, keys), "left_semi")


def upsert(base: DataFrame, new: DataFrame, keys: list[str] = VERSIONED) -> DataFrame:
    """``new`` replaces the rows of ``base`` with its keys; columns are matched by name, missing ones are null.

    Rows of ``new`` with one key are all kept; put ``keep_last`` before to have one.
    """
    return without(base, new, keys).unionByName(new, allowMissingColumns=True)


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row for each key, the first by ``order`` (which should end in tie-breakers)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_nth", F.row_number().over(w)).where("_nth = 1").drop("_nth")


def keep_latest(df: DataFrame, keys: list[str] = VERSIONED, time: str = "download_timestamp", ties: list[Column] = ()) -> DataFrame:
    return keep_first(df, keys, [F.col(time).desc_nulls_last(), *ties])


def keep_last(batch: DataFrame, keys: list[str], ordinal: str) -> DataFrame:
    """Of rows with one key in a batch, that with the largest ordinal."""
    return keep_first(batch, keys, [F.col(ordinal).desc_nulls_last()])


def max_versions(manifest: DataFrame) -> DataFrame:
    return manifest.groupBy(*FILING).agg(F.coalesce(F.max("version"), F.lit(0)).alias("max_version"))


def next_versions(manifest: DataFrame, new: DataFrame, order: list[Column]) -> DataFrame:
    """``new`` with ``version`` (following the largest of its key) and ``is_correction``."""
    top = max_versions(manifest)
    joined = new.drop("version", "is_correction").join(top, FILING, "left")
    nth = F.row_number().over(Window.partitionBy(*FILING).orderBy(*order))
    return joined.withColumn("version", F.coalesce("max_version", F.lit(0)) + nth).withColumn("is_correction", F.col("version") > 1).drop("max_version")


def merge_shards(shards: list[DataFrame], ties: list[Column] = ()) -> DataFrame:
    """Shards of any column sets, by name, and of each key the latest row."""
    return keep_latest(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), shards), ties=ties)
