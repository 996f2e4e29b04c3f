"""Page zones, rule tables, template tables and boxes against plain versions."""

import random
from collections import Counter

import numpy as np
import pytest
from conftest import DATA, rows_of

from ledgerloom import catalog
from ledgerloom.operators import pages, statements


def plain_zones(grey, max_gap=40, min_block=15, min_column_gap=40):
    """Row by row and column by column."""
    h, w = grey.shape
    dark = [y for y in range(h) if grey[y].mean() < 245]
    blocks = []
    for y in dark:
        if blocks and y - blocks[-1][1] - 1 <= max_gap:
            blocks[-1][1] = y
        else:
            blocks.append([y, y])
    if blocks and h - 1 - blocks[-1][1] <= max_gap:
        blocks[-1][1] = h - 1
    out = []
    for y0, y1 in blocks:
        if y1 - y0 < max(min_block, 10):
            continue
        a, b = int(w * 0.05), int(w * 0.95)
        white = [grey[y0:y1, x].mean() > 248 for x in range(a, b)]
        gaps, begin = [], None
        for x, v in enumerate(white):
            if v and begin is None:
                begin = x
            elif not v and begin is not None:
                if x - begin >= min_column_gap and 0.1 < (begin + x) / 2 / len(white) < 0.9:
                    gaps.append(x - begin)
                begin = None
        ink = [grey[y].mean() < 240 for y in range(y0, y1)]
        lines = sum(q and not p for p, q in zip(ink, ink[1:]))
        table = len(gaps) >= 2 or (len(gaps) == 1 and gaps[0] > 100)
        out.append((y0, y1, "table" if table else "title" if y1 - y0 < 50 and not gaps and lines <= 2 else "text", len(gaps), lines))
    return out


def columns(gap):
    """A page whose block has two white columns of ``gap`` pixels."""
    page = np.full((200, 400), 255, np.uint8)
    page[20:120] = 0
    for x in (100, 250):
        page[20:120, x : x + gap] = 255
    return page


def test_zones_thresholds():
    assert [(z[2], z[3]) for z in pages.zones_of(columns(35))] == [("text", 0)]
    assert [(z[2], z[3]) for z in pages.zones_of(columns(45))] == [("table", 2)]
    open_ = columns(45)[:150]  # 30 white rows below: the block is open where the page ends
    assert pages.zones_of(open_)[0][:2] == (20, 149) and pages.zones_of(columns(45))[0][:2] == (20, 119)


def test_zones_of_arrays_and_pixels_agree(spark):
    r = np.random.default_rng(7)
    images = [columns(35), columns(45), columns(45)[:150], np.full((60, 60), 255, np.uint8), np.zeros((12, 30), np.uint8), np.zeros((1, 1), np.uint8)]
    for _ in range(12):
        cells = r.choice([255, 250, 246, 242, 90], (r.integers(3, 9), r.integers(3, 9)), p=[0.6, 0.1, 0.1, 0.1, 0.1])
        images.append(np.repeat(np.repeat(cells, r.integers(9, 55), axis=0), r.integers(9, 55), axis=1).astype(np.uint8))
    frame = spark.createDataFrame([(k, i.tolist()) for k, i in enumerate(images)] + [(99, None), (98, [])], "doc int, rows array<array<int>>")
    got = {}
    for z in pages.array_zones(frame, ["doc"], "rows").orderBy("doc", "nth").collect():
        got.setdefault(z["doc"], []).append(tuple(z)[2:])
    pixels = spark.createDataFrame([(str(k), 1, *reversed(i.shape), bytearray(i.tobytes())) for k, i in enumerate(images)], "doc string, page int, w int, h int, grey binary")
    by_pixels = {}
    for z in pages.page_zones(pixels).orderBy("y0").collect():
        by_pixels.setdefault(int(z["doc"]), []).append(tuple(z)[2:])
    want = {k: z for k, i in enumerate(images) if (z := plain_zones(i))}
    assert got == want and by_pixels == want and any(z[2] == "table" for zs in want.values() for z in zs)


def test_first_rules(spark, monkeypatch):
    r = random.Random(4)
    texts = ["".join(r.choice("abcÆ ") for _ in range(r.randint(0, 60))) for _ in range(80)] + [None, ""]
    rules = [(k, "".join(r.choice("abcÆ ") for _ in range(r.randint(1, 4))), f"k{k}") for k in range(300)] + [(400, "", "none"), (401, None, "none"), (402, "ab", "late")]
    frame = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], "doc long, text string, pattern string")
    table = spark.createDataFrame(rules, "ord long, pattern string, key string")
    want = {k: min(((o, key) for o, p, key in rules if p and t and p in t), default=(None, None)) for k, t in enumerate(texts)}
    for chars in (1 << 20, 200):  # at once, and in several rounds
        monkeypatch.setattr(statements, "RULE_CHARS", chars)
        got = {row["doc"]: (row["ord"], row["key"]) for row in statements.first_rules(frame, "text", table).collect()}
        assert got == want
    assert {row["ord"] for row in statements.first_rules(frame, "text", table.limit(0)).collect()} == {None}


def test_rarest_pairs(spark, monkeypatch):
    """Few pairs are counted where the first heads hold enough of the least count, all where they do not; the rows are those of a plain count."""
    r = random.Random(8)
    words = ["", "a", "ab", "abc", "abcd", "ab\n", "ab\t", "\n", "~", "Æ", "abÆ", "😀", "\uffff", *(f"{c}{k}" for c in "bcdz" for k in range(60))]
    texts = [" ".join(r.choices(words, [9] * 13 + [1] * 240, k=r.randint(0, 40))) for _ in range(300)] + [None, "", "a", " "]
    counted, first = [], statements._first_pairs
    monkeypatch.setattr(statements, "_first_pairs", lambda pairs, *a: (counted.append(pairs.count()), first(pairs, *a))[1])
    for copies in (1, 2):
        frame = spark.createDataFrame([(t,) for t in texts * copies], "text string")
        seen = Counter(f"{a} {b}" for t in texts * copies for a, b in zip((t or "").split(" "), (t or "").split(" ")[1:]))
        for heads, most in ((1, 4), (500, 20), (2000, 20), (1000, 10**6), (10**9, 20)):
            monkeypatch.setattr(statements, "PAIRS_FIRST", heads)
            counted.clear()
            got = [(row["count"], row["pattern"]) for row in statements.rarest_pairs(frame, "text", 3, most).collect()]
            assert sorted(got) == sorted((n, p) for p, n in seen.items() if n >= 3)[:most]
            if copies == 1 and most == 20 and heads == 2000:
                assert len(counted) == 1 and counted[0] < seen.total()
            if copies == 2 or most == 10**6 or heads == 10**9:  # copies: no pair is met three times
                assert counted[-1] == seen.total()


def test_nearest_templates(spark):
    r = random.Random(5)
    known = [r.getrandbits(64) for _ in range(60)] + [0, 2**64 - 1]
    near = [h ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 8))) for h in known for _ in range(4)] + [0] * 500
    signed = lambda h: h - 2**64 if h >= 2**63 else h
    templates = spark.createDataFrame([(signed(h), k, f"t{k}") for k, h in enumerate(known)] + [(signed(known[3]), 1000, "later"), (None, 0, "null")], "hash long, ord int, template string")
    pages_ = spark.createDataFrame([(k, signed(h)) for k, h in enumerate(near)] + [(-1, None)], "page int, hash long")
    out = pages.nearest_templates(pages_, templates)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    for row in out.collect():
        h = None if row["page"] < 0 else near[row["page"]]
        want = None if h is None else next((f"t{k}" for k, t in enumerate(known) if (h ^ t).bit_count() <= 5), f"unknown_{h:016x}")
        assert row["template"] == want


def test_words_in_boxes(spark):
    r = random.Random(6)
    words = [(r.randint(0, 3), r.randint(0, 2), r.randint(-50, 900), r.randint(-30, 100), f"w{k}") for k in range(600)] + [(1, 1, None, 5, "x"), (1, 1, 5, None, "y"), (1, None, 5, 5, "z")]
    boxes = [(r.randint(0, 2), f"f{k}", r.randint(-20, 90), (a := r.randint(-60, 800)), a + r.randint(-50, 500)) for k in range(25)] + [(1, "g", None, 0, 9), (1, "h", 5, None, 9)]
    out = pages.words_in_boxes(spark.createDataFrame(words, "doc int, layout int, x0 int, y0 int, text string"), spark.createDataFrame(boxes, "layout int, field string, y int, x_from int, x_to int"), "doc")
    want = {}
    for layout, field, y, a, b in boxes:
        for doc, lay, x0, y0, text in words:
            if lay == layout and None not in (x0, y0, y, a) and abs(y0 - y) < 15 and a <= x0 <= b:
                want.setdefault((doc, field), []).append((x0, text))
    assert {(row["doc"], row["field"]): row["value"] for row in out.collect()} == {k: " ".join(t for _, t in sorted(v)) for k, v in want.items()}


@pytest.mark.parametrize("name", ["template_table", "words_in_boxes"])
def test_plans_have_no_nested_loops(spark, name):
    plan = catalog.queries()[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def plain_shrunk(line, cells):
    """One line of greys by the formula of the Lanczos window, in floating point."""
    scale = len(line) / cells
    out = []
    for k in range(cells):
        centre, total, norm = (k + 0.5) * scale, 0.0, 0.0
        for x, v in enumerate(line):
            t = (x + 0.5 - centre) / max(scale, 1.0)
            if abs(t) < 3:
                w = 1.0 if t == 0 else 3 * np.sin(np.pi * t) * np.sin(np.pi * t / 3) / (np.pi * t) ** 2
                total, norm = total + w * float(v), norm + w
        out.append(min(255, max(0, total / norm)))
    return out


def test_footer_is_shrunk_by_the_formula():
    r = np.random.default_rng(3)
    for h, w in ((40, 100), (23, 8), (9, 300), (5, 5)):
        grey = r.integers(0, 256, (h, w), np.uint8)
        got = pages._shrunk(grey, 8)
        assert np.abs(got - np.array([plain_shrunk(row, 8) for row in grey])).max() <= 1
    page = np.full((2312, 1728), 255, np.uint8)
    assert pages.footer_bits(page) == 0  # nothing is above the mean of an even footer
    page[2200:, 864:] = 0
    assert pages.footer_bits(page) & 0xFF == 0b11110000


def test_interrupted_landing(spark, tmp_path):
    """A task that died while writing leaves a part that no listing names; running it again puts all objects in place, and draining twice changes nothing."""
    from ledgerloom.plans import commands
    from ledgerloom.sources import files, tables

    holding = tmp_path / "holding"
    holding.mkdir()
    (holding / "1_2020.pdf").write_bytes(b"old")
    (holding / "2_2020.pdf.part").write_bytes(b"ha")
    assert [r["orgnr"] for r in files.holding(spark, str(holding)).collect()] == ["1"]
    objects = spark.createDataFrame([("1_2020.pdf", b"new"), ("2_2020.pdf", b"half no more")], "path string, content binary")
    for _ in range(2):
        assert files.put_objects(objects, f"file://{holding}").count() == 2
    assert (holding / "1_2020.pdf").read_bytes() == b"new" and (holding / "2_2020.pdf").read_bytes() == b"half no more" and len(list(holding.glob("*.part"))) == 0
    none, accounts = spark.createDataFrame([], tables.MANIFEST), spark.createDataFrame([("1", 2020, "j")], "orgnr string, json_year int, journalnr string")
    once = commands.drain(spark, str(holding), none, accounts, "2024-01-01T00:00:00Z")
    twice = commands.drain(spark, str(holding), once, accounts, "2024-01-01T00:00:00Z")
    assert rows_of(once) == rows_of(twice) and once.count() == 2
