"""Queries on keys and tables that the test data is too small to have."""

import random
import time
from collections import Counter
from datetime import datetime, timedelta

import duckdb
import numpy as np
import pytest
from conftest import DATA, _plain, rows_of
from pyspark.sql import functions as F

from ledgerloom.llm import blocks, ngram_join, suffix_dedup
from ledgerloom.operators import pages
from ledgerloom.plans import commands, queries
from ledgerloom.streaming import limiter


@pytest.fixture
def sql_on(tmp_path):
    """Compare a query with its SQL over tables of the test data, changed by a select list each."""

    def check(spark, name, **changed):
        con = duckdb.connect()
        con.execute("SET TimeZone='UTC'")
        for t, select in changed.items():
            con.execute(f"COPY (SELECT {select} FROM '{DATA}/{t}.parquet') TO '{tmp_path}/{t}.parquet' (FORMAT parquet)")
            con.execute(f"CREATE VIEW {t} AS FROM '{tmp_path}/{t}.parquet'")
        df = queries.QUERIES[name](spark, str(tmp_path))
        r = con.execute(f"SELECT {', '.join(sorted(df.columns))} FROM ({queries.ORACLES[name]})")
        want = Counter(tuple(_plain(x) for x in row) for row in r.fetchall())
        assert rows_of(df) == want

    return check


def test_small_functions_with_keys_of_more_seconds_than_a_day(spark, sql_on):
    sql_on(spark, "small_functions", orders="* REPLACE (o_custkey + 86_400 AS o_custkey)")


def test_breaker_counts_as_its_definition_around_the_edges_of_stretches(spark):
    rng = random.Random(5)
    zero = datetime(1969, 12, 31, 23, 0)
    rows = [(k, zero + timedelta(microseconds=rng.choice([0, 1, 59_999_999, 60_000_000, 60_000_001, rng.randrange(300_000_000)])), rng.random() < 0.5) for k in (1, 2, None) for _ in range(200)]
    events = spark.createDataFrame([(n, *r) for n, r in enumerate(rows)], "id int, k int, t timestamp_ntz, bad boolean")
    got = {r["id"]: r["recent"] for r in limiter.breaker(events, "k", "t", F.col("bad"), seconds=60).collect()}
    minute = timedelta(seconds=60)
    assert got == {n: sum(b for j, s, b in rows if j == k and t - minute <= s <= t) for n, (k, t, _) in enumerate(rows)}


def test_breaker_takes_time_in_proportion_to_a_crowded_stretch(spark):
    """400,000 events of one key in one stretch; a frame added up for each of them would take hours."""
    events = spark.range(400_000).select(F.lit(1).alias("k"), F.timestamp_micros(F.col("id") * 1000 + 86_400_000_000).alias("t"), (F.col("id") % 2 == 0).alias("bad"))
    began = time.time()
    assert limiter.breaker(events, "k", "t", F.col("bad"), seconds=86_400).agg(F.max("recent")).first()[0] == 200_000
    assert time.time() - began < 60


def test_blocks_are_bounded_by_bytes_however_the_input_is_cut(spark, monkeypatch):
    text = F.concat(F.lit("a passage that many of the documents have in common, longer than a window of bytes "), F.array_join(F.transform(F.sequence(F.lit(1), F.lit(4000)), lambda k: F.hex(F.xxhash64(k, F.col("id") % 50))), " "))
    docs = spark.range(120).select(F.col("id").alias("doc_id"), text.alias("text")).coalesce(1)  # 8 MB in one partition
    want = [rows_of(f(docs)) for f in (suffix_dedup.dedup_digests, ngram_join.link_components)]
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 2 << 20)
    written = blocks.write_blocks(docs)
    held = Counter()
    for r in written.frame().select("bid", "lens").collect():
        held[r["bid"]] += int(np.frombuffer(r["lens"], np.int64).sum())
    assert sum(held.values()) == docs.agg(F.sum(F.octet_length("text"))).first()[0]
    assert len(held) == written.n_blocks >= 4 and max(held.values()) <= blocks.BLOCK_BYTES + blocks.PIECE_BYTES
    assert [rows_of(f(docs)) for f in (suffix_dedup.dedup_digests, ngram_join.link_components)] == want


def test_extraction_reads_items_once_and_works_amounts_out_once(spark):
    recognised = spark.createDataFrame([("a", 1, "RESULTATREGNSKAP\n| Salgsinntekt | 1 | 10 000 | 2 000 |")], "doc string, page int, text string")
    df = commands.extract_text(recognised, ["doc"])
    r = df.first()
    assert (r["salgsinntekt"], r["revenue_label"], r["sections_found"]) == (10_000, "salgsinntekt", "pnl")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate posexplode(") == 1
    items = commands.statements.line_items(recognised.select("doc", "text"), ["doc"])._jdf.queryExecution().optimizedPlan().toString()
    assert items.count("translate(") == 2


def test_hits_of_words_in_boxes_are_not_shuffled_and_rounds_give_the_same(spark, monkeypatch):
    df = queries.words_in_boxes(spark, DATA)
    want = rows_of(df)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(") == 1
    monkeypatch.setattr(pages, "BOX_ROUND", 70)
    assert rows_of(queries.words_in_boxes(spark, DATA)) == want


def test_words_in_boxes_makes_a_value_once_for_fields_that_have_the_same_boxes(spark):
    """20,000 fields of one box and 500 documents of 40 words in it: 400 million hits if each field met the words by itself, 20,000 when a list of fields does."""
    words = spark.range(20_000).selectExpr("id % 500 as doc", "1 as layout", "id % 700 as x0", "20 as y0", "lpad(id, 5, '0') as text")
    boxes = spark.range(20_000).selectExpr("1 as layout", "concat('f', id) as field", "20 as y", "0 as x_from", "700 as x_to")
    began = time.time()
    got = pages.words_in_boxes(words, boxes, "doc").agg(F.count("*"), F.sum(F.length("value")), F.countDistinct("field"), F.countDistinct("value")).first()
    assert tuple(got) == (10_000_000, 10_000_000 * (40 * 6 - 1), 20_000, 500)
    assert time.time() - began < 60


def test_fields_with_several_or_the_same_boxes_in_lists_and_rounds(spark, monkeypatch):
    rng = random.Random(8)
    words = [(rng.choice([1, 2, 3, None]), rng.randint(0, 1), rng.randint(0, 300), rng.randint(0, 60), f"w{k}") for k in range(300)]
    kinds = [[(0, 20, 0, 200)], [(0, 20, 0, 200), (1, 40, 50, 300)], [(1, 40, 50, 300), (0, 20, 0, 200)], [(0, 20, 0, 200), (0, 20, 0, 200)], [(1, 5, 100, 250), (1, 10, 0, 150)], [(0, 20, 9, 8)], [(None, 20, 0, 200)]]
    boxes = [(layout, f"f{k}" if k else None, *place) for k in range(70) for layout, *place in kinds[k % len(kinds)]]
    rng.shuffle(boxes)
    want = {}
    for layout, field, y, a, b in boxes:
        for doc, lay, x0, y0, text in words:
            if lay == layout and abs(y0 - y) < 15 and a <= x0 <= b:
                want.setdefault((doc, field), []).append((x0, text))
    want = Counter((doc, field, " ".join(t for _, t in sorted(v))) for (doc, field), v in want.items())
    w, b = spark.createDataFrame(words, "doc int, layout int, x0 int, y0 int, text string"), spark.createDataFrame(boxes, "layout int, field string, y int, x_from int, x_to int")
    assert rows_of(pages.words_in_boxes(w, b, "doc"), ["doc", "field", "value"]) == want
    monkeypatch.setattr(pages, "FIELD_LIST", 3)
    monkeypatch.setattr(pages, "FIELD_ROUND", 25)
    monkeypatch.setattr(pages, "BOX_ROUND", 10)
    lists = pages.fields_alike(b).collect()
    assert sum(len(r["fields"]) for r in lists) == 50 and max(len(r["fields"]) for r in lists) == 3 and len({r["_list"] for r in lists}) == len(lists)
    assert rows_of(pages.words_in_boxes(w, b, "doc"), ["doc", "field", "value"]) == want
    assert pages.words_in_boxes(w, b.limit(0), "doc").count() == 0
