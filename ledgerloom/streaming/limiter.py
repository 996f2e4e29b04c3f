"""Throttling decisions over ordered events: circuit breaker, rates, adaptive rate."""

from __future__ import annotations

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WINDOW_SECONDS, THRESHOLD = 90, 18


def _recent(events: DataFrame, key: str, hit: Column, micros: int) -> DataFrame:
    """``recent``: hits of a key within the last microseconds up to ``_t``, both ends included.

    Time is cut in stretches of that length; a stretch sees its own events and
    the hits of the one before, so no task needs more of a hot key than two.
    Hits of the stretch before count from this one's start on and are taken
    off again when they are too old, so one running sum gives every count.
    """
    start = F.col("_t") - F.pmod(F.col("_t"), F.lit(micros))
    d = events.withColumns({"_hit": F.coalesce(hit, F.lit(False)), "_own": F.lit(True), "_slot": start})
    # the hits of the stretch before, counted by time
    seen = d.where("_hit").groupBy(key, "_slot", "_t").agg(F.count("*").alias("_n"))
    steps = F.inline(F.array(F.struct((F.col("_slot") + micros).alias("_at"), F.col("_n").alias("_step")), F.struct((F.col("_t") + micros + 1).alias("_at"), (-F.col("_n")).alias("_step"))))
    before = seen.select(key, (F.col("_slot") + micros).alias("_slot"), steps).select(key, "_slot", F.col("_at").alias("_t"), F.col("_step").alias("_n"), F.lit(False).alias("_own"))
    names = [c for c in d.columns if c not in (key, "_slot", "_t", "_own")]
    both = d.withColumn("_n", F.col("_hit").cast("long")).unionByName(before.select("*", *(F.lit(None).cast(dict(d.dtypes)[c]).alias(c) for c in names)))
    w = Window.partitionBy(key, "_slot").orderBy("_t").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return both.withColumn("recent", F.coalesce(F.sum("_n").over(w), F.lit(0))).where("_own").drop("_own", "_n", "_hit")


def breaker(events: DataFrame, key: str, time: str, throttled: Column, seconds: int = WINDOW_SECONDS, threshold: int = THRESHOLD) -> DataFrame:
    """``recent``: throttles in the last seconds, both ends included; ``open``: the threshold was reached here or before."""
    d = _recent(events.withColumn("_t", F.unix_micros(F.col(time).cast("timestamp"))), key, throttled, seconds * 1_000_000)
    tripped = d.where(F.col("recent") >= threshold).groupBy(key).agg(F.min("_t").alias("_trip"))
    return d.join(tripped, key, "left").withColumn("open", F.coalesce(F.col("_t") >= F.col("_trip"), F.lit(False))).drop("_t", "_trip", "_slot")


def rates(events: DataFrame, key: str, time: str, success: Column, seconds: int = 60) -> DataFrame:
    """``run_rate`` since a key's first event and ``recent_rate`` over the last seconds (or since the first)."""
    d = _recent(events.withColumns({"_t": F.unix_micros(F.col(time).cast("timestamp")), "_ok": F.coalesce(success, F.lit(False)).cast("long")}), key, success, seconds * 1_000_000)
    # a key's sums by stretch, carried over the stretches before
    slots = d.groupBy(key, "_slot").agg(F.sum("_ok").alias("_sum"), F.min("_t").alias("_from"))
    past = Window.partitionBy(key).orderBy("_slot")
    slots = slots.select(key, "_slot", F.coalesce(F.sum("_sum").over(past.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"), F.min("_from").over(Window.partitionBy(key)).alias("_first"))
    inside = Window.partitionBy(key, "_slot").orderBy("_t").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    d = d.withColumn("_sum", F.sum("_ok").over(inside)).join(slots, [key, "_slot"])
    elapsed = F.greatest((F.col("_t") - F.col("_first")) / 1e6, F.lit(1e-3))
    d = d.withColumns({"run_rate": (F.col("_before") + F.col("_sum")) / elapsed, "recent_rate": F.col("recent") / F.least(F.lit(float(seconds)), elapsed)})
    return d.drop("_t", "_ok", "_slot", "_sum", "_before", "_first", "recent")


# The pacing of the collectors.
MIN_RATE, CUT, STEP, CLEAN, COOLDOWN = 0.5, 0.7, 0.1, 120, 45.0


def next_rate(state: tuple[float, int, float], seconds: float, throttled: bool, max_rate: float, clean: int = CLEAN) -> tuple[float, int, float]:
    """(rate, clean answers in a row, time of the last throttle) after one answer."""
    rate, streak, last = state
    if throttled:
        return max(MIN_RATE, rate * CUT), 0, seconds
    streak += 1
    if rate < max_rate and streak >= clean and seconds - last >= COOLDOWN:
        return min(max_rate, rate + STEP), 0, last
    return rate, streak, last


def adaptive_rate(events: DataFrame, key: str, time: str, throttled: Column, max_rate: float, clean: int = CLEAN, ties: list[str] = ()) -> DataFrame:
    """(key, rate, streak) after all events of each key, folded in the order of time (then of ``ties``).

    Keys are dealt out and sorted by Spark; a task folds its rows one after the
    other with the state of one key in hand, however many events that has.
    """
    t = (F.unix_micros(F.col(time).cast("timestamp")) / 1e6).alias("t")
    ordered = events.select(F.col(key).alias("key"), t, F.coalesce(throttled, F.lit(False)).alias("bad"), *ties).repartition("key").sortWithinPartitions("key", "t", *ties).select("key", "t", "bad")
    kind = dict(events.dtypes)[key]

    def run(batches):
        now, state = None, None
        for batch in batches:
            out = []
            for k, seconds, bad in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                if state is None or k != now:
                    if state is not None:
                        out.append((now, state[0], state[1]))
                    now, state = k, (float(max_rate), 0, -1e18)
                state = next_rate(state, seconds, bad, max_rate, clean)
            if out:
                yield _rates(out, batch.schema.field(0).type, key)
        if state is not None:
            yield _rates([(now, state[0], state[1])], batch.schema.field(0).type, key)

    return ordered.mapInArrow(run, f"{key} {kind}, rate double, streak long")


def _rates(rows: list[tuple], kind: pa.DataType, key: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (kind, pa.float64(), pa.int64()), strict=True)], [key, "rate", "streak"])


def adaptive_rate_stream(events: DataFrame, key: str, time: str, bad: str, max_rate: float, clean: int = CLEAN) -> DataFrame:
    """The same fold on a stream (or a table): state is kept for each key, a row is given for each key and batch."""

    def step(k, frames, state):
        now = state.get if state.exists else (float(max_rate), 0, -1e18)
        if frames := list(frames):  # a key's rows of one batch may come in several pieces
            f = pd.concat(frames).sort_values(time, kind="stable")
            for t, b in zip(f[time].astype("int64") / 1e9 if str(f[time].dtype).endswith("[ns]") else f[time].astype("datetime64[ns]").astype("int64") / 1e9, f[bad], strict=True):
                now = next_rate(now, float(t), bool(b), max_rate, clean)
        state.update(now)
        yield pd.DataFrame({key: [k[0]], "rate": [now[0]], "streak": [now[1]]})

    kind = dict(events.dtypes)[key]
    return events.groupBy(key).applyInPandasWithState(step, f"{key} {kind}, rate double, streak long", "rate double, streak long, last double", "update", "NoTimeout")
