"""Commands, readers and writers that no query goes through."""

import json
from pathlib import Path

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from ledgerloom.operators import pages, statements
from ledgerloom.plans import commands
from ledgerloom.sources import files, sinks, tables
from ledgerloom.streaming import flows

QUEUE = "orgnr string, year int, create_time long, processing_priority long"
MANIFEST = "orgnr string, year int, version int, download_timestamp string, status string, pdf_path string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_queue_shards(spark, tmp_path):
    path = str(tmp_path / "queue")
    assert tables.read_queue_shard(spark, path, 3).count() == 0
    q = spark.createDataFrame([(str(k), 2020, k, 1, "x", str(k % 10)) for k in range(60)], tables.QUEUE)
    sinks.write_by_shard(q, path)
    three = tables.read_queue_shard(spark, path, 3)
    assert sorted(r["orgnr"] for r in three.collect()) == sorted(str(k) for k in range(3, 60, 10))
    assert "PartitionFilters: [isnotnull(shard" in three._jdf.queryExecution().executedPlan().toString()
    sinks.write_by_shard(q.where("shard = '3' and orgnr = '13'"), path)  # only that shard is rewritten
    assert spark.read.schema(tables.QUEUE).parquet(path).count() == 55
    spark.createDataFrame([("1", "new")], "orgnr string, extra string").write.parquet(f"{tmp_path}/shards/a")
    spark.createDataFrame([("2", 5)], "orgnr string, year int").write.parquet(f"{tmp_path}/shards/b")
    assert rows_of(tables.read_shards(spark, f"{tmp_path}/shards/*"), ["extra", "orgnr", "year"]) == {("new", "1", None): 1, (None, "2", 5): 1}


def test_latest_snapshot_and_key_list(spark, tmp_path):
    for day in ("2024-01-02", "2024-11-01", "2023-12-31"):
        spark.createDataFrame([(day, 1)], "day string, other int").write.parquet(f"{tmp_path}/snap_{day}")
    last = tables.latest_snapshot(spark, f"{tmp_path}/snap_*", ["day"])
    assert rows(last) == [("2024-11-01",)] and "other" not in last._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(FileNotFoundError):
        tables.latest_snapshot(spark, f"{tmp_path}/none_*", ["day"])
    (tmp_path / "keys.txt").write_text("1, 2,\n\n3\n 2 ,")
    assert rows(tables.key_list(spark, str(tmp_path / "keys.txt"))) == [("1",), ("2",), ("3",)]


def test_archived_files(spark, tmp_path):
    for n in ("aarsregnskap_2019_111222333.pdf", "KopiAvAarsregnskap_111222333_2021.pdf", "kopiavaarsregnskap_999888777_2020.pdf", "aarsregnskap_19_1.pdf", "aarsregnskap_2018_111222333.txt", "odd.pdf"):
        (tmp_path / n).write_bytes(b"x")
    got = {(r["orgnr"], r["year"]): r["path"].rsplit("/", 1)[1] for r in files.archived(spark, str(tmp_path)).collect()}
    assert got == {("111222333", 2019): "aarsregnskap_2019_111222333.pdf", ("111222333", 2021): "KopiAvAarsregnskap_111222333_2021.pdf", ("999888777", 2020): "kopiavaarsregnskap_999888777_2020.pdf"}
    assert rows(files.years_of(spark, str(tmp_path))) == [("111222333", [2019, 2021]), ("999888777", [2020])]


def test_answers(spark):
    a = spark.createDataFrame([(1, "one ---PAGE BREAK--- two", "STOP"), (2, "", "MAX_TOKENS"), (3, None, None)], "doc int, text string, reason string")
    assert rows(files.split_pages(a, ["doc"])) == [(1, 1, "one"), (1, 2, "two"), (2, 1, "")]
    assert [r[0] for r in a.orderBy("doc").select(files.truncated(F.col("reason"))).collect()] == [False, True, False]
    cached = spark.createDataFrame([("1", json.dumps({"note_excerpts": "a\n---\n \n---\nb"})), ("2", "{}"), ("3", "no json")], "orgnr string, value string")
    assert rows(statements.loaded_excerpts(cached, ["orgnr"])) == [("1", ["a", "b"]), ("2", []), ("3", [])]
    v = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 5, "z")], "name string, version int, at string")
    assert rows(pages.last_per_name(v, ["name"])) == [("a", 1, "y"), ("b", 5, "z")] and rows(pages.last_per_name(v, ["name"], oldest=False)) == [("a", 2, "x"), ("b", 5, "z")]
    assert json.loads(sinks.lines_of(spark.createDataFrame([(1, None)], "a int, b string")).first()["value"]) == {"a": 1, "b": None}


def test_seed_and_patch(spark):
    entities = spark.createDataFrame([("1", "2022"), ("2", None), ("3", ""), ("4", "x")], "organisasjonsnummer string, sisteInnsendteAarsregnskap string")
    years = spark.createDataFrame([("1", 2021, 5, 5)], QUEUE)
    fast, stubs = commands.seed(entities, years, F.lit(1000))
    assert rows(fast.select("orgnr", "year", "create_time", "processing_priority")) == [("1", 2022, 1000, 1000)]
    assert rows(stubs.select("orgnr", "year")) == [("1", None), ("4", None)]
    kind = "oppdateringsid long, organisasjonsnummer string, endringstype string, endringer array<struct<path: string, value: string>>"
    field = "/sisteInnsendteAarsregnskap"
    updates = spark.createDataFrame([(1, "1", "Endring", [(field, "2023")]), (2, "1", "Endring", [(field, "2023")]), (2, "1", "Endring", [(field, "2023")]), (3, "5", "Endring", [("/navn", "x")]), (4, "6", "Ny", []), (5, "7", "Endring", [(field, "n/a")])], kind)
    old = spark.createDataFrame([("1", 2023, 1, 1), ("9", 2020, 2, 2), ("1", None, 3, 3)], QUEUE)
    assert rows(commands.patch(old, updates, F.lit(50).cast("long"))) == [("1", 2023, 50, 50), ("1", None, 3, 3), ("9", 2020, 2, 2)]


def test_lanes_take_turns(spark):
    none = spark.createDataFrame([], MANIFEST)
    done = lambda *pairs: spark.createDataFrame([(o, y, 1, "2024-01-01T00:00:00Z", "success", "p") for o, y in pairs], MANIFEST)
    q = spark.createDataFrame([("1", 2020, 100, 100), ("2", None, 100, 50), ("3", 2019, 100, 7)], QUEUE)
    for manifest, lane, keys in ((none, "fast", ["1"]), (done(("1", 2020)), "stub", ["2"])):
        got, work = commands.next_work(q, manifest)
        assert (got, [r["orgnr"] for r in work.collect()]) == (lane, keys)
    lane, work = commands.next_work(q.where("year is not null"), done(("1", 2020)))
    assert (lane, [r["orgnr"] for r in work.collect()]) == ("slow", ["3"])
    lane, work = commands.next_work(q, done(("1", 2020)), discovery=q.limit(0))  # discovery has nothing left
    assert lane == "slow"


def test_merge_verify_consolidate(spark, tmp_path):
    a = spark.createDataFrame([("1", 2020, 1, "2024-01-01T00:00:00Z", "failed", None), ("2", 2020, 1, "2024-01-01T00:00:00Z", "success", "pdf/2")], MANIFEST)
    b = spark.createDataFrame([("1", 2020, 1, "2024-02-01T00:00:00Z", "success", "pdf/1")], MANIFEST)
    merged = commands.merge_manifests(spark, [a, b], str(tmp_path / "m"))
    assert rows(merged.select("orgnr", "status", "pdf_path")) == [("1", "success", "pdf/1"), ("2", "success", "pdf/2")]
    manifest = merged.withColumn("json_path", F.lit(None).cast("string"))
    lost = commands.verify(manifest, spark.createDataFrame([("pdf/2",)], "path string"))
    assert rows(lost) == [("pdf", 1)]
    old = spark.createDataFrame([("1", 2020, "old"), ("0", 2020, "kept")], "orgnr string, year int, x string")
    new = spark.createDataFrame([("1", 2020, "new", 5)], "orgnr string, year int, x string, y int")
    assert [tuple(r) for r in commands.consolidate(old, new).select("orgnr", "year", "x", "y").collect()] == [("0", 2020, "kept", None), ("1", 2020, "new", 5)]


def test_streams_of_updates(spark, tmp_path):
    """Repeated ids pass once, windows are counted, and what comes after the watermark is left out."""
    landing = Path(tmp_path / "in")
    landing.mkdir()
    schema = "id long, at timestamp, kind string"

    def land(name, some):
        (landing / name).write_text("\n".join(json.dumps({"id": i, "at": f"2024-01-01T{t}:00Z", "kind": k}) for i, t, k in some))

    def run(make, out, mode="append"):
        q = make(flows.landed_json(spark, str(landing), schema, 1)).writeStream.format("parquet").option("path", str(tmp_path / out)).option("checkpointLocation", str(tmp_path / f"{out}-at")).outputMode(mode).trigger(availableNow=True).start()
        q.awaitTermination()
        return spark.read.parquet(str(tmp_path / out))

    for name, some in (("1.json", [(1, "10:00", "a"), (2, "10:04", "b"), (1, "10:05", "a")]), ("2.json", [(2, "10:06", "b"), (3, "10:30", "a")]), ("3.json", [(4, "10:01", "late"), (5, "11:30", "a")])):
        land(name, some)
        unique = run(lambda s: flows.unique_updates(s, "id", "at", "20 minutes"), "unique")
        counts = run(lambda s: flows.windowed_counts(s, "at", "kind"), "counts")
    assert sorted(r["id"] for r in unique.collect()) == [1, 2, 3, 5]
    assert sorted((r["start"].strftime("%H:%M"), r["kind"], r["n"]) for r in counts.collect()) == [("10:00", "a", 2), ("10:00", "b", 2), ("10:30", "a", 1)]
