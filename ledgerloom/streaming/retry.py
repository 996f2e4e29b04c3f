"""When to try again: a schedule of attempts with growing pauses, over a table of outcomes or a stream of them.

Outcomes are rows (key, at, seq, outcome): milliseconds, an order among equal
times, and ``success``, ``failed`` (worth another attempt) or anything else
(not worth one).  The n-th failure in a row waits 2**(n - 1) seconds and a
jitter of up to two more, 60 at most; after ATTEMPTS failures the key is given
up, and a later failure counts anew, as it does after a success or an outcome
that is not worth another attempt.  The jitter is a hash of the key and n, so
a job that runs again gives the same times.

Rows of the schedule: (key, at, attempt, state, due): ``waiting`` with the time
of the next attempt, or ``given_up``; the stream also tells when an attempt is
``due``.  A null key is a key of its own; rows without a time are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

# Attempts, first and longest pause and jitter, in milliseconds.
ATTEMPTS, FIRST, LONGEST, JITTER = 5, 1000, 60_000, 2000
#: A key that nothing is heard of is forgotten so long after its attempt was due.
FORGET = 24 * 3600 * 1000

SCHEMA = "key string, at long, attempt int, state string, due long"


def pause(key: str | None, attempt: int) -> int:
    jitter = int(hashlib.md5(f"{'' if key is None else key}:{attempt}".encode()).hexdigest()[:6], 16) % JITTER
    return min(LONGEST, FIRST * 2 ** (attempt - 1) + jitter)


def schedule(outcomes: DataFrame) -> DataFrame:
    """The schedule of a whole table, in the order of (at, seq) within a key."""
    d = outcomes.where("at is not null")
    w = Window.partitionBy("key").orderBy("at", "seq")
    failed = F.coalesce(F.col("outcome") == "failed", F.lit(False))
    d = d.select("key", "at", "seq", failed.alias("_failed")).withColumn("_streak", F.count_if(~F.col("_failed")).over(w))
    nth = F.row_number().over(Window.partitionBy("key", "_streak").orderBy("at", "seq"))
    d = d.where("_failed").withColumn("attempt", ((nth - 1) % ATTEMPTS + 1).cast("int"))
    jitter = F.conv(F.substring(F.md5(F.concat_ws(":", F.coalesce("key", F.lit("")), F.col("attempt").cast("string"))), 1, 6), 16, 10).cast("long") % JITTER
    wait = F.least(F.lit(LONGEST).cast("long"), FIRST * F.expr("shiftleft(1L, attempt - 1)") + jitter)
    over = F.col("attempt") == ATTEMPTS
    return d.select("key", "at", "attempt", F.when(over, "given_up").otherwise("waiting").alias("state"), F.when(~over, F.col("at") + wait).alias("due"))


class _Retries(StatefulProcessor):
    """State of a key: failures in a row, and the time of its next attempt (0: none)."""

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("retries", "attempt int, due long")

    def _clear(self) -> None:
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        (name,) = key
        attempt, due = self.state.get() if self.state.exists() else (0, 0)
        out = []
        for r in pd.concat(list(rows)).sort_values(["at", "seq"], kind="stable").itertuples(index=False):
            if due and due <= r.at:
                out.append((name, due, attempt, "due", due))
            due = 0
            if r.outcome != "failed":
                attempt = 0
                continue
            attempt += 1
            if attempt == ATTEMPTS:
                out.append((name, int(r.at), attempt, "given_up", None))
                attempt = 0
            else:
                due = int(r.at) + pause(name, attempt)
                out.append((name, int(r.at), attempt, "waiting", due))
        self._clear()
        if attempt:
            self.state.update((attempt, due))
            self.handle.registerTimer(due)
        else:
            self.state.clear()
        yield pd.DataFrame(out, columns=["key", "at", "attempt", "state", "due"]).astype({"due": "Int64"})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        attempt, due = self.state.get() if self.state.exists() else (0, 0)
        if due:  # the attempt is due; without another word the key is forgotten later
            self.state.update((attempt, 0))
            self.handle.registerTimer(due + FORGET)
            yield pd.DataFrame([(key[0], due, attempt, "due", due)], columns=["key", "at", "attempt", "state", "due"])
        else:
            self.state.clear()

    def close(self) -> None:
        pass


def schedule_stream(outcomes: DataFrame, late: str = "0 seconds") -> DataFrame:
    """The schedule of a stream.  Within a batch outcomes are taken in order; timers follow the watermark of ``at``."""
    spark = outcomes.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    timed = outcomes.where("at is not null").withColumn("_time", F.timestamp_millis("at")).withWatermark("_time", late)
    return timed.groupBy("key").transformWithStateInPandas(_Retries(), SCHEMA, "Append", "EventTime")
