"""The schedule of attempts: table, stream, and a stream that stops in between."""

import random

from conftest import rows_of

from ledgerloom.streaming import retry

OUTCOMES = "key string, at long, seq long, outcome string"


def plain(rows, until=None):
    state, out = {}, []
    for key, at, _, outcome in sorted((r for r in rows if r[1] is not None), key=lambda r: (r[1], r[2])):
        n, due = state.get(key, (0, 0))
        if due and due <= at and until is not None:
            out.append((key, due, n, "due", due))
        n, due = (n + 1 if outcome == "failed" else 0), 0
        if n == retry.ATTEMPTS:
            out.append((key, at, n, "given_up", None))
            n = 0
        elif n:
            due = at + retry.pause(key, n)
            out.append((key, at, n, "waiting", due))
        state[key] = (n, due)
    out += [(k, due, n, "due", due) for k, (n, due) in state.items() if until is not None and due and due <= until]
    return sorted(out, key=str)


def outcomes(seed, n, keys="abc"):
    r, at, rows = random.Random(seed), 1_000_000, []
    for k in range(n):
        at += r.choice([0, 300, 900, 2500, 9000, 40_000])
        rows.append((r.choice([*keys, None]), at, k, r.choice(["failed"] * 5 + ["success", "refused", None])))
    return rows


def test_pause_grows_to_a_bound():
    pauses = [retry.pause("x", n) for n in range(1, 12)]
    assert all(1000 * 2 ** (n - 1) <= p < 1000 * 2 ** (n - 1) + 2000 for n, p in enumerate(pauses[:5], 1)) and pauses[-1] == 60_000


def test_schedule_of_a_table(spark):
    rows = [*outcomes(3, 300), ("a", None, 999, "failed")]
    assert sorted(map(tuple, retry.schedule(spark.createDataFrame(rows, OUTCOMES)).collect()), key=str) == plain(rows)
    assert retry.schedule(spark.createDataFrame([], OUTCOMES)).count() == 0


def test_schedule_of_a_stream_that_stops(spark, tmp_path):
    """Three runs over one checkpoint, with state and timers carried over, give what one pass over the table gives."""
    rows = outcomes(5, 90)
    landing = tmp_path / "in"

    def run():
        stream = spark.readStream.schema(OUTCOMES).option("maxFilesPerTrigger", 1).json(str(landing))
        out = retry.schedule_stream(stream).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "at")).outputMode("append").trigger(availableNow=True).start()
        out.awaitTermination()

    for a in (0, 30, 60):
        spark.createDataFrame(rows[a : a + 30], OUTCOMES).coalesce(1).write.mode("append").json(str(landing))
        run()
    got = sorted((tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()), key=str)
    last = max(r[1] for r in rows)
    assert [r for r in got if r[3] != "due"] == plain(rows)
    due = [r for r in plain(rows, last - 1) if r[3] == "due"]
    assert [r for r in got if r[3] == "due" and r[1] < last] == due and len(due) > 5
