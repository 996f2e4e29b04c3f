"""Running totals, intervals, budgets and cursors over work that ends out of order."""

import random

import pytest
from conftest import DATA
from pyspark.sql import functions as F

from ledgerloom import catalog
from ledgerloom.operators import queue, ranking
from ledgerloom.streaming import inflight


def test_running(spark):
    r = random.Random(1)
    rows = [(k, r.choice([None, -3, 0, 2, 5])) for k in range(300)]
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "k long, v long").repartition(5)
    total, top = {}, {}
    s, m = 0, None
    for k, v in sorted(rows):
        s += v or 0
        m = v if m is None else m if v is None else max(m, v)
        total[k], top[k] = s, m
    assert {x["k"]: x["s"] for x in ranking.running(df, [F.col("k")], F.col("v"), "s").collect()} == total
    assert {x["k"]: x["s"] for x in ranking.running(df, [F.col("k")], F.col("v"), "s", F.max).collect()} == top
    assert ranking.running(df.limit(0), [F.col("k")], F.col("v"), "s").count() == 0


def test_merged(spark):
    r = random.Random(2)
    for n in (0, 1, 7, 60):
        got = [(a := r.randint(0, 200), a + r.randint(-2, 9)) for _ in range(n)]
        numbers = sorted({x for a, b in got for x in range(a, b + 1)})
        want = [(x, next(y for y in range(x, 999) if y + 1 not in numbers)) for x in numbers if x - 1 not in numbers]
        assert sorted(map(tuple, ranking.merged(spark.createDataFrame(got, "lo long, hi long").repartition(4)).collect())) == want


def test_budget(spark):
    rows = [(str(k), 2020, 0, 100 - k // 3, c) for k, c in enumerate([50, None, 30, -5, 100, 1, 1, 400, 1])]
    df = spark.createDataFrame(rows, "orgnr string, year int, create_time long, processing_priority long, c long")
    got = queue.budgeted(df, F.col("c"), 300).orderBy("spent", "orgnr").collect()
    assert [(x["orgnr"], x["spent"]) for x in got] == [("0", 0), ("1", 50), ("2", 50), ("3", 80), ("4", 80), ("5", 180)]
    assert queue.budgeted(df, F.col("c"), 100).count() == 0  # less than what is kept back


def batches(spark):
    """The events' positions by the batch in which they end, and the cursors that the query gives."""
    e = spark.read.parquet(f"{DATA}/events.parquet").select("event_id")
    last = e.agg(F.max("event_id")).first()[0]
    ended = {}
    for row in e.collect():
        k = row["event_id"]
        ended.setdefault(k // (1 + last // 10) + k * 7919 % 101 // 40, []).append(k)
    return ended, {row["batch"]: row["position"] for row in catalog.queries()["inflight_cursor"](spark, DATA).collect()}


def test_cursor_survives_a_stop(spark, tmp_path):
    """A stream that stops between batches and one that fails before its state is written both go on without loss or skip."""
    ended, want = batches(spark)
    first = min(k for ks in ended.values() for k in ks)
    landing, table = tmp_path / "in", str(tmp_path / "ended")
    stream = lambda: inflight.track(spark.readStream.schema("position long").option("maxFilesPerTrigger", 3).json(str(landing)), table, str(tmp_path / "checkpoint"))
    published = inflight.publish
    for b in sorted(ended):
        spark.createDataFrame([(k,) for k in ended[b]] + [(None,)], "position long").coalesce(1).write.mode("append").json(str(landing))
        if b % 3 < 2 and b < max(ended):
            continue
        if b == 5:  # fails after the batch was read, before it is published

            def broken(*_):
                raise OSError("stopped")

            inflight.publish = broken
            with pytest.raises(Exception, match="stopped"):
                stream().awaitTermination()
            inflight.publish = published
        stream().awaitTermination()
        assert inflight.tracked(spark, table, first) == want[b]
    done = inflight.current(spark, table)
    assert done.count() == 1
    inflight.publish(inflight.fold(done, spark.createDataFrame([(k,) for k in ended[0]], "position long")), table)  # a batch once more
    assert inflight.tracked(spark, table, first) == max(want.values())


def test_startable(spark):
    ranked = spark.range(50).select(F.col("id").alias("position"), F.lit("x").alias("orgnr"))
    ended = inflight.fold(None, spark.createDataFrame([(k,) for k in (0, 1, 2, 4, 5, 9, 30)], "position long"))
    assert inflight.cursor(ended) == 2 and inflight.cursor(None) == -1
    assert sorted(r["position"] for r in inflight.startable(ranked, ended, 8).collect()) == [3, 6, 7, 8, 10]
    assert sorted(r["position"] for r in inflight.startable(ranked, None, 3).collect()) == [0, 1, 2]
