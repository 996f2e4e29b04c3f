"""Connected components on Spark: smallest label of the neighbours, then the label's own label, until nothing changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import discard, materialize


SALTS = 16


def join_hot(left: DataFrame, right: DataFrame, key: str, spread: str) -> DataFrame:
    """Left join by ``key``, unique in ``right``; rows of a hot key are dealt to SALTS tasks by their ``spread``."""
    dealt = left.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int"))
    return dealt.join(right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), [key, "_salt"], "left").drop("_salt")


def connected_components(edges: DataFrame) -> DataFrame:
    """(v, comp) of every end of an edge (a, b); comp is the smallest v of the component."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = materialize(both, "edges")
    labels = materialize(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("v"), F.least("a", "m").alias("comp")), "labels")
    while True:  # the last labels are dropped once the new ones are written
        near = both.join(labels.select(F.col("v").alias("b"), "comp"), "b").groupBy("a").agg(F.min("comp").alias("near"))
        low = labels.join(near, labels["v"] == near["a"]).select("v", F.col("comp").alias("old"), F.least("comp", "near").alias("comp"))
        up = labels.select(F.col("v").alias("comp"), F.col("comp").alias("up"))
        step = materialize(low.join(up, "comp", "left").select("v", "old", F.least("comp", F.coalesce("up", "comp")).alias("comp")), "labels")
        discard(labels)
        labels = step
        if step.where("comp <> old").isEmpty():
            discard(both)
            return labels
