"""Incremental jobs: files that land, keyed upserts of each batch, windows with late data, resumable cursors."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.keys import keep_last
from ..sources.sinks import current, publish


def landed_json(spark: SparkSession, path: str, schema: str, files: int = 1000) -> DataFrame:
    """JSON lines that land in a folder, some files a batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).json(path)


def upsert_stream(stream: DataFrame, table: str, keys: list[str], order: str, checkpoint: str) -> StreamingQuery:
    """Fold each batch into a published table: the row of a key with the largest ``order``, of the table and the batch, stays.

    A late batch with older rows changes nothing, nor does one that runs twice
    after a failure.
    """
    spark = stream.sparkSession

    def fold(batch: DataFrame, _: int) -> None:
        old = current(spark, table)
        publish(keep_last(batch if old is None else old.unionByName(batch, allowMissingColumns=True), keys, order), table)

    return stream.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def unique_updates(stream: DataFrame, id_col: str, time: str, late: str = "1 hour") -> DataFrame:
    """Each id once; ids are forgotten when the watermark has passed them."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark([id_col])


def windowed_counts(stream: DataFrame, time: str, kind: str, window: str = "10 minutes", late: str = "5 minutes") -> DataFrame:
    """Events by window and kind; later ones than the watermark are left out."""
    return stream.withWatermark(time, late).groupBy(F.window(time, window).alias("w"), kind).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), kind, "n")


CURSOR_SCHEMA = "last_id long, last_date string, position long, finished boolean"


def load_cursor(spark: SparkSession, table: str) -> dict:
    """State of a resumable job; fields that are not known are ignored, missing ones null."""
    df = current(spark, table)
    row = df.select("state").first() if df is not None else None
    known = [f.split()[0] for f in CURSOR_SCHEMA.split(", ")]
    found = json.loads(row["state"]) if row else {}
    return {k: found.get(k) for k in known}


def save_cursor(spark: SparkSession, table: str, **state) -> None:
    publish(spark.range(1).select(F.lit(json.dumps(state)).alias("state")), table)
