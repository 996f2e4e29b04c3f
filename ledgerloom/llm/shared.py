"""Places that the driver and all executors share, and tables written there."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import discard, materialize, shared_dir, temporary, when_done
from ..sources.sinks import remove

__all__ = ["ROW", "discard", "materialize", "read_table", "remove", "row_key", "sample_by_hash", "shared_dir", "temporary", "when_done"]

#: Name of a column with ``row_key``.
ROW = "__row_key"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """Names a row by its doc_id and whole text (a null doc_id is a value of its own, a null text is empty); rows that agree in both are copies."""
    return F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("null")), F.lit("/"), F.md5(F.coalesce(F.col(text).cast("string"), F.lit(""))))


def sample_by_hash(df: DataFrame, key: str, rows: int) -> DataFrame:
    """``rows`` rows, those with the smallest hash of their key.

    The table is counted first and only hashes below a threshold that leaves
    a few more are sorted, so tasks send about ``rows`` in all, not each.
    """
    n = df.count()
    place = F.xxhash64(key)
    if n > rows:
        share = min(1.0, (rows + 6 * rows**0.5 + 50) / n)
        df = df.where(place < F.lit(int(-(2**63) + share * 2**64) if share < 1 else 2**63 - 1))
    return df.orderBy(place, key).limit(rows)
