import datetime as dt
import json
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import amounts, scalars
from ledgerloom.operators import keys, pages, queue, ranking, statements, validation
from ledgerloom.plans import commands
from ledgerloom.sources import feed, files, sections, sinks, tables
from ledgerloom.streaming import flows, limiter


def one(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column(F.col("v")).alias("x")).first()["x"]


@pytest.mark.parametrize(("raw", "value"), [("1 230 450", 1230450.0), ("267.202,39", 267202.39), ("1 000,0", 1000.0), ("(161 356)", -161356.0), ("-7 666", -7666.0), ("1102.00", 1102.0), ("11,1%", 11.1), ("-", 0.0), ("0", 0.0), ("", None), ("ukjent", None), (None, None)])
def test_number_formats(spark, raw, value):
    assert one(spark, raw, amounts.strict_amount) == value


@pytest.mark.parametrize(("raw", "value"), [("12 345", 12345.0), ("-7 666", -7666.0), ("2021", None), ("12", None), ("x 5 000 y", 5000.0), (None, None)])
def test_cell_amount(spark, raw, value):
    assert one(spark, raw, amounts.cell_amount) == value


def test_coercions(spark):
    assert one(spark, "-3.9", scalars.to_int) == -3
    assert one(spark, "nan", scalars.to_int) is None
    assert one(spark, "2025-01-01T00:00:00Z", scalars.unix_or_zero) == 1735689600
    assert one(spark, "x", scalars.unix_or_zero) == 0
    assert one(spark, "```json\n{}\n```", scalars.unfence) == "{}"
    assert one(spark, "a/KOPIAVaarsregnskap_964118191_2020.PDF", scalars.parse_file_name) == ("964118191", 2020)


def test_line_items(spark):
    text = "RESULTATREGNSKAP\n| | Note | 2021 | 2020 |\n|---|---|---|---|\n| Sum driftsinntekter | 1 | 10 000 | 9 000 |\n| Lønnskostnad | 2 | -4 000 | -3 500 |\n| Sum driftsinntekter | | 77 777 | 1 111 |\nBALANSE - EIENDELER\n| Sum eiendeler | | 50 000 | 40 000 |\nNoter til\n| Varekostnad | | 123 456 | 1 |"
    docs = spark.createDataFrame([("1", text), ("2", None), ("3", "")], "orgnr string, text string")
    got = {(r["orgnr"], r["item"]): (r["current"], r["prior"]) for r in statements.line_items(docs, ["orgnr"]).collect()}
    assert got == {("1", "sum_driftsinntekter"): (10000.0, 9000.0), ("1", "lonnskostnad"): (4000.0, 3500.0), ("1", "sum_eiendeler"): (50000.0, 40000.0)}
    wide = commands.extract_text(spark.createDataFrame([("1", 2021, 2, "| Sum eiendeler | | 9 000 | |"), ("1", 2021, 1, text + " bundne bankinnskudd 12345 kr")], "orgnr string, year int, page int, text string"), ["orgnr", "year"]).first()
    assert wide["sum_driftsinntekter"] == 10000.0 and wide["has_bundne_midler"] and wide["bundne_midler_amount"] == 12345.0 and wide["sections_found"] == "pnl,assets,notes"


def test_zones():
    page = np.full((400, 1000), 255, np.uint8)
    page[20:60, 100:900] = 0
    page[200:300, 100:300] = 0
    page[200:300, 450:600] = 0
    page[200:300, 750:900] = 0
    assert [(z[2], z[3]) for z in pages.zones_of(page)] == [("title", 0), ("table", 2)]
    assert pages.zones_of(np.full((50, 50), 255, np.uint8)) == []


def test_signals(spark):
    d = spark.createDataFrame([(1, 5.0, 10.0, None), (2, 50.0, 10.0, 3.0)], "doc int, pantstillelse double, sum_eiendeler double, bundne_midler double")
    got = {(r["doc"], r["signal"]): r["passed"] for r in validation.signals(d, ["doc"]).collect()}
    assert got == {(1, "pledged_assets"): True, (2, "pledged_assets"): False}


def test_upsert_is_idempotent_and_null_safe(spark):
    base = spark.createDataFrame([("1", None, "a"), ("2", 2020, "b")], "orgnr string, year int, x string")
    new = spark.createDataFrame([("1", None, 5)], "orgnr string, year int, z int")
    once = keys.upsert(base, new, keys.FILING)
    assert once.count() == 2 and keys.upsert(once, new, keys.FILING).exceptAll(once).count() == 0


def test_slices_are_disjoint_and_complete(spark):
    q = spark.range(1000).select(F.col("id").alias("orgnr"), F.lit(2020).alias("year"), (F.col("id") % 3).alias("processing_priority"))
    ranked = queue.prioritised(q).cache()
    assert sorted(r[0] for r in ranked.select("position").collect()) == list(range(1000))
    assert sum(commands.collect(ranked, k, 3).count() for k in range(3)) == 1000


def test_rank_keeps_the_columns_own_order(spark):
    """Ties that doubles cannot tell apart, names with leading zeros and letters, nulls last, one hot value."""
    rows = [(1, 2**60 + k, n) for k in (5, 4, 3, 1) for n in ("010", "01", "x", None)] + [(None, 1, "a")]
    d = spark.createDataFrame(rows, "p int, k long, n string").repartition(5)
    got = {(r["p"], r["k"], r["n"]): r["position"] for r in ranking.global_rank(d, [F.col("p").desc_nulls_last(), F.col("k").asc(), F.col("n").asc_nulls_last()]).collect()}
    want = sorted(rows, key=lambda r: (r[0] is None, r[1], r[2] is None, r[2] or ""))
    assert got == {r: k for k, r in enumerate(want)}
    assert ranking.global_rank(d.limit(0), [F.col("k").asc()]).count() == 0


QUEUED = [("1", 2020, 100, 100, None, "1"), ("2", 2020, 2_000_000_000, 2_000_000_000, None, "2"), ("3", 2020, 100, 50, None, "3"), ("4", None, 100, 100, None, "4"), ("5", 2021, 100, 7, None, "5"), ("6", 2021, 300, 300, None, "6")]


def filed(spark, rows):
    return spark.createDataFrame([(o, y, v, t, None, None, None, p, None, None, None, None, s, None) for o, y, v, t, p, s in rows], tables.MANIFEST)


def test_queue_on_its_own_schemas(spark):
    """ISO text in the manifest, seconds in the queue, text that is no time."""
    q = spark.createDataFrame(QUEUED, tables.QUEUE)
    m = filed(spark, [("1", 2020, 1, "2024-01-01T00:00:00Z", "a.pdf", "success"), ("2", 2020, 1, "2024-01-01T00:00:00Z", "b.pdf", "success"), ("3", 2020, 1, "2024-01-01T00:00:00Z", None, "success"), ("5", 2021, 1, "ukjent", "c.pdf", "success"), ("6", 2021, 1, None, "d.pdf", "success")])
    assert sorted(r["orgnr"] for r in queue.work_list(q, m).collect()) == ["2", "3", "5", "6"]
    assert sorted(r["orgnr"] for r in queue.pending(q, m).collect()) == ["2", "3", "5", "6"]
    assert sorted(r["orgnr"] for r in queue.compact(q, m).collect()) == ["2", "3", "4", "5", "6"]
    assert {r["orgnr"]: r["position"] for r in queue.prioritised(queue.work_list(q, m, "fast")).collect()} == {"2": 0, "6": 1}
    assert dict(queue.latest_success(m).dtypes)["latest"] == "bigint"
    slow = queue.enqueue_slow(q, spark.createDataFrame([("1", 2020), ("9", 2021)], "orgnr string, year int"), m, F.lit(77))
    assert [(r["orgnr"], r["create_time"], r["processing_priority"]) for r in slow.collect()] == [("9", 77, 1609459200)]
    both = q.unionByName(slow, allowMissingColumns=True)
    assert dict(both.dtypes) == dict(q.dtypes)
    fast = queue.enqueue_fast(q, spark.createDataFrame([("3", 2020, 1)], "orgnr string, year int, ordinal int"), F.lit(400).cast("long"))
    assert {r["orgnr"]: r["processing_priority"] for r in fast.collect()}["3"] == 400 and dict(fast.dtypes) == dict(q.dtypes)
    stats = {r["shard"]: (r["total"], r["stubs"], r["pending"], r["fast"], r["slow"]) for r in queue.shard_stats(q, m).collect()}
    assert stats[None] == (6, 1, 4, 2, 2)


def test_coordinate_from_nothing(spark, tmp_path):
    """First run, a run with a holding area, and again: the second changes nothing."""
    (tmp_path / "pdf").mkdir()
    q = spark.createDataFrame(QUEUED, tables.QUEUE)
    accounts = spark.createDataFrame([("6", 2021, "2021/7")], "orgnr string, json_year int, journalnr string")
    t = f"file://{tmp_path}/manifest"
    run = lambda: [r["orgnr"] for r in commands.coordinate(spark, t, q, f"file://{tmp_path}/pdf", accounts, "2024-05-01T00:00:00Z").orderBy("position").collect()]
    assert run() == ["2", "6", "1"]
    for n in ("6_2021.pdf", "2_2020.pdf"):
        (tmp_path / "pdf" / n).write_bytes(b"x")
    for _ in range(2):
        assert run() == ["2", "1"]  # 2 was queued after the download
        assert {(r["orgnr"], r["journalnr"]) for r in sinks.current(spark, t).collect()} == {("6", "2021/7"), ("2", None)}
    sinks.publish(q, f"file://{tmp_path}/queue")
    assert commands.compact(spark, f"file://{tmp_path}/queue", sinks.current(spark, t)) == 1
    assert sinks.current(spark, f"file://{tmp_path}/queue").count() == 5


def test_publish_and_sections(spark, tmp_path):
    t = f"file://{tmp_path}/t"
    assert sinks.current(spark, t) is None
    for n in (3, 4, 5):
        sinks.publish(spark.range(n), t)
    assert sinks.current(spark, t).count() == 5 and len(sinks.versions(spark, t)) == 2
    flows.save_cursor(spark, f"{t}2", last_id=7, unknown=1)
    assert flows.load_cursor(spark, f"{t}2") == {"last_id": 7, "last_date": None, "position": None, "finished": None}
    rows = spark.createDataFrame([("1", "2.7", "x")], "orgnr string, n string, extra string")
    sinks.append_section(rows, f"{t}3", "noter", {"orgnr": "string", "n": "bigint", "missing": "double"}, "2025-01-02", "000102")
    sinks.append_section(rows, f"{t}3", "noter", {"orgnr": "string", "n": "bigint", "missing": "double"}, "2025-01-02", "000103")
    got = tables.latest_collection(tables.read_section(spark, f"{t}3", "noter"), ["orgnr"]).collect()
    assert [(r["n"], r["missing"], r["collection_time"]) for r in got] == [(2, None, "000103")]
    assert tables.read_manifest(spark, f"{t}4").count() == 0


def test_manifest_schema_evolution(spark, tmp_path):
    spark.createDataFrame([("1", 2020, "x")], "orgnr string, year int, old string").write.parquet(f"{tmp_path}/m")
    r = tables.read_manifest(spark, f"{tmp_path}/m").first()
    assert r["version"] == 1 and r["pdf_hash"] is None and "old" not in r.asDict()


def test_files(spark, tmp_path):
    (tmp_path / "pdf").mkdir()
    for n in ("964118191_2020.pdf", "bad.pdf"):
        (tmp_path / "pdf" / n).write_bytes(b"x")
    assert [(r["orgnr"], r["year"]) for r in files.holding(spark, f"{tmp_path}/pdf").collect()] == [("964118191", 2020)]
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("aarsregnskap_2020_964118191.pdf", b"abc")
        z.writestr("x.txt", b"abc")
    (tmp_path / "b.zip").write_bytes(b"broken")
    assert [(r["member"], bytes(r["content"])) for r in files.zip_members(spark, str(tmp_path)).collect()] == [("aarsregnskap_2020_964118191.pdf", b"abc")]


UPDATES = [{"oppdateringsid": k, "organisasjonsnummer": str(k), "endringstype": "Ny"} for k in range(1, 8)]


def client(since):
    return [u for u in UPDATES if u["oppdateringsid"] >= since][:3]


def test_feed_ends_on_inclusive_pages(spark):
    assert [u["oppdateringsid"] for u in feed.pages(client, 2)] == [3, 4, 5, 6, 7]
    assert list(feed.pages(client, 7)) == []


def test_streams_agree_with_batch(spark, tmp_path):
    start = dt.datetime(2024, 1, 1)
    rows = [(k % 3, start + dt.timedelta(seconds=20 * k), k % 11 == 0, k) for k in range(300)]
    d = spark.createDataFrame(rows, "k long, ts timestamp, bad boolean, n long")
    batch = {r["k"]: round(r["rate"], 9) for r in limiter.adaptive_rate(d, "k", "ts", F.col("bad"), 3.0, clean=3).collect()}
    plain = {}
    for k in range(3):
        s = (3.0, 0, -1e18)
        for key, ts, bad, _ in rows:
            if key == k:
                s = limiter.next_rate(s, ts.replace(tzinfo=dt.UTC).timestamp(), bad, 3.0, clean=3)
        plain[k] = round(s[0], 9)
    assert batch == plain
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("".join(json.dumps({"k": r[0], "ts": r[1].isoformat(), "bad": r[2], "n": r[3]}) + "\n" for r in rows))
    stream = flows.landed_json(spark, f"file://{tmp_path}/in", "k long, ts timestamp, bad boolean, n long")
    q = flows.upsert_stream(stream, f"file://{tmp_path}/out", ["k"], "n", f"file://{tmp_path}/cp")
    q.awaitTermination(60)
    assert sorted((r["k"], r["n"]) for r in sinks.current(spark, f"file://{tmp_path}/out").collect()) == [(0, 297), (1, 298), (2, 299)]
    live = limiter.adaptive_rate_stream(stream, "k", "ts", "bad", 3.0, clean=3).writeStream.outputMode("update").format("memory").queryName("live").trigger(availableNow=True).start()
    live.awaitTermination(60)
    assert {r["k"]: round(r["rate"], 9) for r in spark.table("live").collect()} == plain


def test_notes_amount_sign(spark):
    """A minus among the first two characters makes an amount negative, one further on makes it none."""
    sign = lambda c: amounts._plain(c)
    assert [one(spark, t, sign) for t in ("-5 000", "- 5 000", "5-000", "5 0-0", "--7000")] == [-5000.0, -5000.0, None, None, -7000.0]


def test_strict_time(spark):
    assert one(spark, "2025-01-01T00:00:00Z", scalars.unix_strict) == 1735689600 and one(spark, None, scalars.unix_strict) is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|CANNOT_PARSE_TIMESTAMP"):
        one(spark, "ukjent", scalars.unix_strict)


def test_cover_fields(spark):
    text = "REGNSKAPSÅRET 2021\nJournalnr 2022 123456\n01.01.2021 - 31.12.2021\nRegnskapslovens alminnelige regler\nDato for fastsettelse av\nregnskapet 30.06.2022. Skal ikke skal revideres"
    r = one(spark, text, scalars.cover_fields)
    assert (r["regnskapsaar"], r["periode_start"], r["periode_slutt"], r["regnskapsregler"], r["fravalgt_revisjon"], r["dato_fastsettelse"]) == (2021, "01.01.2021", "31.12.2021", "Regnskapslovens alminnelige regler", True, "30.06.2022")
    assert one(spark, None, scalars.cover_fields)["fravalgt_revisjon"] is False


def test_redaction_spares_amounts(spark):
    assert one(spark, "id 01017012345 og 010170 12345, konto 1234.56.78901, orgnr 964118191, sum 123456789012, a.b@c.no", scalars.redact) == "id <number> og <number>, konto <number>, orgnr 964118191, sum 123456789012, <mail>"


def test_footer_hash(spark):
    page = np.full((100, 80), 255, np.uint8)
    page[88:, :40] = 0
    assert pages.footer_bits(page) & (2**64 - 1) == 0x0F0F0F0F0F0F0F0F
    d = spark.createDataFrame([("a", 1, 80, 100, page.tobytes())], "doc string, page int, w int, h int, grey binary")
    assert pages.footer_hashes(d).first()["hash"] == 0x0F0F0F0F0F0F0F0F


def test_every_section_is_written_and_read(spark, tmp_path):
    for name, columns in sections.SECTIONS.items():
        rows = spark.createDataFrame([("0a", "1", "2020", {"x": 1})], "pdf_sha256_prefix string, orgnr string, year string, other map<string, int>")
        sections.write_section(rows, f"file://{tmp_path}/store", name, "2025-01-02", "000102")
        got = tables.read_section(spark, f"file://{tmp_path}/store", name)
        assert got.columns == [*columns, "collection_date", "collection_time"] and got.first()["year"] == 2020 and got.first()["collection_time"] == "000102"


def test_two_writers_do_not_mix(spark, tmp_path, monkeypatch):
    t = f"file://{tmp_path}/t"
    sinks.publish(spark.range(1), t)
    monkeypatch.setattr(sinks, "_numbers", lambda *_: [])  # sees the table as it was before the other writer
    with pytest.raises(FileExistsError):
        sinks.publish(spark.range(2), t)
    monkeypatch.undo()
    assert sinks.current(spark, t).count() == 1
    sinks.copy(spark, f"{t}/v=0000000001", f"{t}2")
    sinks.copy(spark, f"{t}/none", f"{t}3")
    assert spark.read.parquet(f"{t}2").count() == 1 and not sinks.exists(spark, f"{t}3")


def test_late_rows_do_not_replace_newer_ones(spark, tmp_path):
    (tmp_path / "in").mkdir()
    stream = flows.landed_json(spark, f"file://{tmp_path}/in", "k long, n long, x string", files=1)
    for name, n, x in (("a", 5, "new"), ("b", 3, "old"), ("c", 5, "new")):
        (tmp_path / "in" / f"{name}.json").write_text(json.dumps({"k": 1, "n": n, "x": x}) + "\n")
        flows.upsert_stream(stream, f"file://{tmp_path}/out", ["k"], "n", f"file://{tmp_path}/cp").awaitTermination(60)
        assert [(r["n"], r["x"]) for r in sinks.current(spark, f"file://{tmp_path}/out").collect()] == [(5, "new")]


def test_recognition_and_objects(spark, tmp_path):
    pdfs = spark.createDataFrame([("a", b"12"), ("b", b"1"), ("c", b"")], "path string, content binary")
    got = files.recognise(pdfs, lambda: lambda raw: ["x" * 10] * len(raw), single_over=200).collect()
    assert [(r["path"], r["page"]) for r in got] == [("a", 1), ("a", 2)]
    images = spark.createDataFrame([("a", k, None if k == 3 else b"i") for k in range(1, 41)], "path string, page int, image binary").coalesce(1)
    texts = {r["page"]: r["text"] for r in files.recognise_images(images, lambda: lambda batch: [str(len(batch))] * len(batch)).collect()}
    assert texts[3] == "" and texts[1] == "16" and texts[40] == "7"
    objects = spark.createDataFrame([("pdf/1_2020.pdf", b"abc"), ("json/1.json", b"{}")], "path string, content binary")
    for _ in range(2):
        assert {r["path"]: r["size"] for r in files.put_objects(objects, f"file://{tmp_path}/holding").collect()} == {"pdf/1_2020.pdf": 3, "json/1.json": 2}
    assert (tmp_path / "holding/pdf/1_2020.pdf").read_bytes() == b"abc"


def test_run_counters(spark):
    rows = [("pdf", "success"), ("pdf", "failed"), ("json", "success"), ("pdf", "skipped")]
    d, run = commands.counted(spark.createDataFrame(rows, "kind string, outcome string"))
    assert d.count() == 4 and run.get == {"processed": 4, "success": 2, "failed": 1, "skipped": 1, "pdfs": 1, "jsons": 1}


def test_throttle_windows_of_a_hot_key(spark):
    """Against plain counting, with events at the edges of the stretches, ties and stretches without events."""
    start = dt.datetime(2024, 1, 1)
    rows = [("hot", start + dt.timedelta(seconds=s), s % 3 == 0, n) for n, s in enumerate([0, 5, 5, 9, 10, 19, 20, 20, 30, 45, 46, 90, 99, 100, 110])]
    d = spark.createDataFrame(rows, "k string, ts timestamp, bad boolean, n int")
    got = {r["n"]: (r["recent"], r["open"]) for r in limiter.breaker(d, "k", "ts", F.col("bad"), seconds=10, threshold=3).collect()}
    recent = {n: sum(b for _, u, b, _ in rows if t - dt.timedelta(seconds=10) <= u <= t) for _, t, _, n in rows}
    opened = {n: any(recent[m] >= 3 for _, u, _, m in rows if u <= t) for _, t, _, n in rows}
    assert got == {n: (recent[n], opened[n]) for n in recent}
