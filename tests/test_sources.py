"""Archives, dumps and the change feed as they are read on Spark."""

import gzip
import io
import json
import random
import time
import zipfile
from pathlib import Path

import pytest
from conftest import rows_of

from ledgerloom.sources import feed, files, tables


def archive(members, method=zipfile.ZIP_DEFLATED):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", method) as z:
        for name, content in members:
            z.writestr(name, content)
    return out.getvalue()


def test_archives_are_read_by_ranges(spark, tmp_path):
    r = random.Random(1)
    a = [(f"{k}_2020.pdf", r.randbytes(r.randint(0, 3000))) for k in range(20)] + [("x.txt", b"no")]
    b = [("B.PDF", b"stored"), ("empty.pdf", b"")]
    (tmp_path / "a.zip").write_bytes(archive(a))
    (tmp_path / "b.zip").write_bytes(archive(b, zipfile.ZIP_STORED))
    (tmp_path / "lzma.zip").write_bytes(archive([("l.pdf", b"x" * 99)], zipfile.ZIP_LZMA))
    (tmp_path / "broken.zip").write_bytes(b"PK no archive")
    raw = bytearray(archive([("good.pdf", b"g" * 500), ("bad.pdf", r.randbytes(500))], zipfile.ZIP_STORED))
    raw[raw.find(b"bad.pdf") + 20] ^= 1
    (tmp_path / "half.zip").write_bytes(raw)
    with (tmp_path / "large.zip").open("wb") as f:  # 3 GB before the archive's own bytes, which take no room on disk
        f.truncate(3 << 30)
        f.seek(0, 2)
        f.write(archive([("far.pdf", b"far away")]))
    got = {(row["archive"].rsplit("/", 1)[1], row["member"]): bytes(row["content"]) for row in files.zip_members(spark, str(tmp_path)).collect()}
    want = {("a.zip", n): c for n, c in a if n.endswith(".pdf")} | {("b.zip", n): c for n, c in b} | {("half.zip", "good.pdf"): b"g" * 500, ("large.zip", "far.pdf"): b"far away"}
    assert got == want


def test_members_read_no_more_than_they_need():
    class Counting(io.BytesIO):
        n = 0

        def read(self, size=-1):
            out = super().read(size)
            Counting.n += len(out)
            return out

    raw = archive([("big.pdf", random.Random(2).randbytes(500_000)), ("small.pdf", b"small")])
    with zipfile.ZipFile(io.BytesIO(raw)) as z:
        m = z.getinfo("small.pdf")
    assert files.read_member(Counting(raw), m.header_offset, m.compress_size, m.file_size, m.compress_type, m.CRC) == b"small"
    assert Counting.n < 100


def cut(raw, size):
    return [raw[k : k + size] for k in range(0, len(raw), size)]


def test_elements_of_an_array(monkeypatch):
    values = [{"a": 'q"[{,\\', "b": [1, {"c": "]}"}]}, 7, "x,y", None, [], {}, {"t": "Æ" * 50, "e": "\\\\"}, "", "\\", {"n": [[[]]]}]
    for indent in (None, 1):
        raw = json.dumps(values, ensure_ascii=False, indent=indent).encode()
        for size in (1, 2, 3, 7, 64, 10_000):
            assert [json.loads(e) for e in tables.elements(iter(cut(raw, size)))] == values
    assert list(tables.elements(iter([b" [ ] "]))) == [] and list(tables.elements(iter([]))) == []
    assert [e for e in tables.elements(iter([b'[{"a": nope}, {"b": 2}, {"c"', b": 3"]))] == [b'{"a": nope}', b'{"b": 2}', b'{"c": 3']
    monkeypatch.setattr(tables, "LONGEST", 100)
    with pytest.raises(ValueError):
        list(tables.elements(iter([b'["' + b"x" * 80] * 3)))


def test_dump(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "PART", 1000)
    one = [{"organisasjonsnummer": str(k), "navn": 'A "[' + "x" * (k % 50), "n": k} for k in range(500)]
    raw = json.dumps(one).encode()
    (tmp_path / "a.json.gz").write_bytes(gzip.compress(raw[:9000]) + gzip.compress(raw[9000:]))  # two gzip members
    (tmp_path / "b.json.gz").write_bytes(gzip.compress(b'[{"organisasjonsnummer": "x", "navn": nope}, {"organisasjonsnummer": "y", "navn": "ok", "n": 1}]'))
    schema = "organisasjonsnummer string, navn string, n long"
    good = tables.read_dump(spark, str(tmp_path), schema, 3)
    assert sorted(map(tuple, good.collect())) == sorted([(e["organisasjonsnummer"], e["navn"], e["n"]) for e in one] + [("y", "ok", 1)])
    (bad,) = tables.read_dump(spark, str(tmp_path), schema, 3, bad="raw").where("raw is not null").collect()
    assert tuple(bad) == (None, None, None, '{"organisasjonsnummer": "x", "navn": nope}')


def test_feed_as_a_stream_that_stops(spark, tmp_path):
    """The source on Spark, killed on its way and resumed from its checkpoint, gives what the batch read gives."""
    spark.dataSource.register(feed.UpdatesSource)
    options = {"client": "feed_client:page", "since": "0", "path": str(Path(__file__).parent)}
    whole = spark.read.format("updates").options(**options).load()
    n = whole.count()
    assert n > 600
    seen, out = [], str(tmp_path / "out")

    def keep(batch, nth):
        seen.append(nth)
        batch.write.mode("overwrite").parquet(f"{out}/batch={nth}")
        if len(seen) == 2:
            raise RuntimeError("killed after its rows were written")

    def start(body):
        return spark.readStream.format("updates").options(**options).load().writeStream.foreachBatch(body).option("checkpointLocation", str(tmp_path / "at")).trigger(processingTime="0 seconds").start()

    q = start(keep)
    with pytest.raises(Exception, match="killed"):
        q.awaitTermination(120)
    q, began = start(keep), time.time()
    while spark.read.schema(whole.schema).option("recursiveFileLookup", True).parquet(out).count() < n and time.time() - began < 120:
        time.sleep(1)
    q.stop()
    assert rows_of(spark.read.parquet(out).drop("batch"), sorted(whole.columns)) == rows_of(whole)
    assert len(set(seen)) >= 3 and len(seen) == len(set(seen)) + 1  # the batch that was killed ran twice
