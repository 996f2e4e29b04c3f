"""Session settings that the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Time is UTC throughout; leading zeros of partition values are kept; rewritten partitions leave the others alone.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    return spark
