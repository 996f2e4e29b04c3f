"""Several writers of one table, and leases."""

import threading

import pytest

from ledgerloom.sources import sinks


def test_claim_is_given_once(spark, tmp_path):
    got = []
    threads = [threading.Thread(target=lambda: got.append(sinks.claim(spark, f"file://{tmp_path}/c/1", "x"))) for _ in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(got) == [False] * 7 + [True] and (tmp_path / "c" / "1").read_text() == "x"
    assert [p.name for p in (tmp_path / "c").iterdir()] == ["1"]


def test_two_writers_one_gets_the_error(spark, tmp_path, monkeypatch):
    """Both have staged their snapshots before either claims the number."""
    table, both, outcome = str(tmp_path / "t"), threading.Barrier(2), {}
    sinks.publish(spark.range(1), table)
    real = sinks.claim

    def together(*args):
        both.wait(60)
        return real(*args)

    monkeypatch.setattr(sinks, "claim", together)

    def write(n):
        try:
            outcome[n] = sinks.publish(spark.range(n), table, base=1)
        except FileExistsError:
            outcome[n] = None

    threads = [threading.Thread(target=write, args=(n,)) for n in (10, 20)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    (won,) = [n for n, path in outcome.items() if path]
    assert sinks.current(spark, table).count() == won and sinks.versions(spark, table) == [1, 2]
    assert not [p for p in (tmp_path / "t").iterdir() if p.name.startswith("_staging")]


def test_no_update_is_lost(spark, tmp_path):
    """Writers that add to what they have read, and begin again on an error, all count."""
    table = str(tmp_path / "t")
    sinks.publish(spark.range(1).selectExpr("0L as n"), table)

    def add():
        for _ in range(2):
            while True:
                base = sinks.versions(spark, table)[-1]
                n = spark.read.parquet(f"{table}/v={base:010d}").first()["n"]
                try:
                    sinks.publish(spark.range(1).selectExpr(f"{n + 1}L as n"), table, base=base)
                    break
                except FileExistsError:
                    continue

    threads = [threading.Thread(target=add) for _ in range(3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sinks.current(spark, table).first()["n"] == 6


def test_a_dead_writers_snapshot_is_named(spark, tmp_path):
    table = str(tmp_path / "t")
    sinks.publish(spark.range(1), table)
    staged = f"{table}/_staging-x"
    spark.range(7).write.parquet(staged)
    assert sinks.claim(spark, f"{table}/_commits/{2:010d}", staged)  # and then nothing: its writer died
    with pytest.raises(FileExistsError):
        sinks.publish(spark.range(3), table, base=1)
    assert sinks.versions(spark, table) == [1, 2] and sinks.current(spark, table).count() == 7
    sinks.publish(spark.range(3), table, base=2)
    sinks.publish(spark.range(4), table)
    assert sinks.versions(spark, table) == [3, 4] and sinks.current(spark, table).count() == 4


def test_lease(spark, tmp_path):
    folder = str(tmp_path / "lease")
    with sinks.lease(spark, folder, "a", now=1000, max_age=600) as a:
        assert a
        with sinks.lease(spark, folder, "b", now=1500, max_age=600) as b:
            assert not b
        with sinks.lease(spark, folder, "c", now=1600, max_age=600) as c:  # a's is stale
            assert c
            with sinks.lease(spark, folder, "d", now=1700, max_age=600) as d:
                assert not d
    with pytest.raises(ValueError), sinks.lease(spark, folder, "e", now=1700, max_age=600) as e:
        assert e
        raise ValueError
    with sinks.lease(spark, folder, "f", now=1701, max_age=600) as f:
        assert f


def test_temporary_tables(spark):
    from pathlib import Path

    from ledgerloom.sources import scratch

    folder = Path(scratch.shared_dir(spark).removeprefix("file://"))
    before = set(folder.iterdir()) if folder.exists() else set()
    with scratch.temporary() as keep:
        one = scratch.materialize(spark.range(3), "one")
        with pytest.raises(ValueError), scratch.temporary():
            scratch.materialize(spark.range(4), "two")
            raise ValueError
        kept = keep(scratch.materialize(one.selectExpr("id + 1 as id"), "kept"))
    assert [p.name.split("-")[0] for p in set(folder.iterdir()) - before] == ["kept"] and kept.count() == 3
    scratch.discard(kept)
    assert set(folder.iterdir()) == before
    outside = scratch.materialize(spark.range(2), "outside")
    assert outside.count() == 2
    scratch.discard(outside)
