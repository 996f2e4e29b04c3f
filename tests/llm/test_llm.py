"""Every operator against a brute-force version, with nulls, empty and long texts, ties, repeats and clashing columns."""

import hashlib
import itertools
import random
import re
import time
import unicodedata
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest import DATA, rows_of
from pyspark.sql import functions as F

from ledgerloom.llm import decontamination, fingerprints, html_text, ngram_join, quality, registry, sentencepiece_codec, suffix_dedup, token_output, toxicity, warc

public_tokenizers = pytest.importorskip("public_tokenizers")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, sets string, v string, bid int"


def docs_of(spark, texts):
    return spark.createDataFrame([(k if k >= 0 else None, t, None, None, None, "a", "b", 3) for k, t in texts], DOCS)


def corpus(seed, n=60):
    r = random.Random(seed)
    words = [f"w{k}" for k in range(40)] + ["Ærlig", "b|c", "tion."]
    base = [" ".join(r.choice(words) for _ in range(r.randint(0, 90))) for _ in range(n // 3)]
    out = list(base)
    for _ in range(n - len(base) - 4):
        w = r.choice(base).split(" ")
        for _ in range(r.randint(0, 2)):
            w[r.randrange(len(w))] = r.choice(words)
        out.append(r.choice([" ", "  "]).join(w))
    out += [None, "", "   ", "x" * 3000]
    return list(enumerate(out))


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_same_as_sql(spark, same_as_sql, name):
    same_as_sql(registry.queries()[name](spark, DATA), registry.oracle_sql()[name])


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_empty_tables(spark, tmp_path, name):
    for t in ("documents", "pages", "benchmark", "labels", "embeddings"):
        spark.read.parquet(f"{DATA}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert registry.queries()[name](spark, str(tmp_path)).count() == 0


def test_op1_brute_force(spark):
    texts = corpus(1)
    items = [(1, texts[3][1]), (2, "w1"), (2, "w1"), (3, None), (4, ""), (5, " ".join(f"q{k}" for k in range(30)))]
    texts += [(100, "a b " + items[-1][1].upper() + " c"), (-1, "w1 w2")]
    got = {r["doc_id"]: r for r in decontamination.verdicts(docs_of(spark, texts), spark.createDataFrame(items, "item_id int, text string")).collect()}
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    grams = [(str(i), tuple(words(t)[k : k + min(13, len(words(t)))])) for i, t in items for k in range(max(0, len(words(t)) - min(13, len(words(t))) + 1)) if words(t)]
    for i, t in texts:
        w = words(t)
        hit, found = set(), set()
        for item, g in grams:
            for k in range(len(w) - len(g) + 1):
                if tuple(w[k : k + len(g)]) == g:
                    hit |= set(range(k, k + len(g)))
                    found.add(item)
        r = got[i if i >= 0 else None]
        assert (r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) == (len(w), len(hit), len(found), bool(hit) and 20 * len(hit) >= len(w))
        assert r["items_sha256"] == hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    kept = decontamination.decontaminate(docs_of(spark, texts), spark.createDataFrame(items, "item_id int, text string"))
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in kept.collect()) == sorted((i < 0, max(i, 0), t or "") for i, t in texts if not got[i if i >= 0 else None]["contaminated"])
    spans = {r["doc_id"]: r["text"] for r in decontamination.decontaminate(docs_of(spark, texts), spark.createDataFrame(items[-1:], "item_id int, text string"), "spans").collect()}
    assert spans[100] == "a b  c" and spans[3] == texts[3][1]


def test_op1_rows_go_by_their_text(spark):
    """Null and repeated doc_ids, items without an id, copies."""
    item = " ".join(f"q{k}" for k in range(20))
    docs = docs_of(spark, [(-1, item), (-1, "clean one"), (7, "x " + item.upper()), (7, "clean two"), (7, "clean two"), (8, None), (8, "")])
    bench = spark.createDataFrame([(None, item), (3, "clean three and more")], "item_id int, text string")
    kept = decontamination.decontaminate(docs, bench)
    assert sorted((r["doc_id"], r["text"]) for r in kept.where("text <> ''").collect() if r["doc_id"]) == [(7, "clean two")] * 2
    assert kept.count() == 5 and kept.where("doc_id is null").first()["text"] == "clean one" and kept.columns == docs.columns
    hit = decontamination.verdicts(docs, bench).where("contaminated").collect()
    assert [(r["n_hit"], r["n_items"], r["items_sha256"]) for r in hit] == [(20, 1, hashlib.sha256(b"").hexdigest())] * 2


def test_op1_slices(spark, monkeypatch):
    texts, items = corpus(2), [(k, t) for k, t in corpus(2)[:9] if t]
    b = spark.createDataFrame(items, "item_id int, text string")
    whole = rows_of(decontamination.verdicts(docs_of(spark, texts), b).select("doc_id", "n_hit", "items_sha256"))
    monkeypatch.setattr(decontamination, "SLICE_BYTES", 200)
    assert rows_of(decontamination.verdicts(docs_of(spark, texts), b).select("doc_id", "n_hit", "items_sha256")) == whole


def test_op2_round_trip(spark, tmp_path):
    big = "æ" * 100_000
    rows = [(1, "u", big), (2, None, big), (3, "u\nx", None), (4, "u", ""), (5, "u", "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n" * 50), (6, "u", "\n\n" + "x" * 999), (7, "u", "\n\n" + "x" * 999), (8, "u", "short"), (9, "u", "short")]
    warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string"), f"file://{tmp_path}/w", 1000)
    got = {r["page_id"]: r for r in warc.read_archives(spark, f"file://{tmp_path}/w").collect()}
    assert len(got) == len(rows) and all(r["intact"] for r in got.values())
    for i, _, h in rows:
        raw = (h or "").encode()
        assert (got[i]["payload_bytes"], got[i]["payload_digest"]) == (len(raw), hashlib.sha1(raw).hexdigest())
    assert {i: r["refers_to"] for i, r in got.items() if r["record_type"] == "revisit"} == {1: 2, 6: 7}


def test_op2_rows(spark, tmp_path):
    """Null and equal page_ids, equal payloads under them, chunks cut inside characters, clashing columns, one hot payload."""
    same, other = "æøå" * 700, "z" * 1000
    rows = [(None, "u", same, 1, "x"), (5, "u", same, 1, "x"), (5, "u", other, 1, "x"), (5, "u", other, 1, "x"), (9, "u", other, 1, "x"), (7, "u", "", 1, "x"), (7, None, None, 1, "x"), *((k, "u", "hot" * 500, 1, "x") for k in range(100, 160))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, chunk int, value string").repartition(4)
    warc.write_archives(pages, f"file://{tmp_path}/w", 1000)
    got = Counter((r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"], r["intact"], r["n_chunks"]) for r in warc.read_archives(spark, f"file://{tmp_path}/w").collect())
    want = Counter({(None, 4200, "revisit", 5, True, 1): 1, (5, 4200, "response", None, True, 5): 1, (5, 1000, "revisit", 9, True, 1): 2, (9, 1000, "response", None, True, 1): 1, (7, 0, "response", None, True, 1): 2, (159, 1500, "response", None, True, 2): 1})
    want.update({(k, 1500, "revisit", 159, True, 1): 1 for k in range(100, 159)})
    assert got == want


def test_op3_digits_tell_strings_apart(spark):
    """Strings that differ in a few bits anywhere never have one digit, though hashes without secret keys can be made to agree."""
    r = np.random.default_rng(1)
    base = r.integers(97, 123, (10_000, 50), np.uint8)
    other = base.copy()
    other[:4000, [7, 11, 15]] ^= 0x40
    for row in other[4000:]:
        row[r.choice(50, r.integers(1, 4), replace=False)] ^= np.uint8(r.integers(1, 256))
    draw = suffix_dedup.Keys.draw()
    at = np.arange(10_000) * 50
    one, two = (suffix_dedup._digits(suffix_dedup._window(suffix_dedup._words(np.concatenate([x.ravel(), np.zeros(8, np.uint8)])), at, draw.window), draw.plus) for x in (base, other))
    for a, b in zip(one, two, strict=True):
        assert not (a == b).any() and len(np.unique(a)) == len(a)
    texts = [(k, base[k].tobytes().decode()) for k in range(300)] + [(1000 + k, other[k].tobytes().decode()) for k in range(300)]
    texts += [(5000, "sszhldableteqnilzyhyfuirqvjywacdqjdcxpagrgthqcvtoq"), (5001, 'sszhlda"let%qni,zyhyfuirqvjywacdqjdcxpagrgthqcvtoq')]
    assert {row["n_removed"] for row in suffix_dedup.dedup_digests(docs_of(spark, texts)).collect()} == {0}


def test_op3_brute_force(spark):
    texts = corpus(3) + [(200, "ab" * 300), (201, "ab" * 40 + "c" + "ab" * 40), (202, "é" * 60), (203, "x" + "é" * 60)]
    random.Random(3).shuffle(texts)
    got = {r["doc_id"]: r for r in suffix_dedup.dedup_digests(docs_of(spark, texts).repartition(7)).collect()}
    first = {}
    for i, t in texts:
        raw = (t or "").encode()
        for k in range(len(raw) - 49):
            first[raw[k : k + 50]] = min(i, first.get(raw[k : k + 50], i))
    for i, t in texts:
        raw = (t or "").encode()
        gone = set()
        for k in range(len(raw) - 49):
            if first[raw[k : k + 50]] < i:
                gone |= set(range(k, k + 50))
        kept = bytes(b for k, b in enumerate(raw) if k not in gone)
        spans = sum(k - 1 not in gone for k in gone)
        assert (got[i]["n_bytes"], got[i]["n_removed"], got[i]["n_spans"], got[i]["kept_sha256"]) == (len(raw), len(gone), spans, hashlib.sha256(kept).hexdigest())


def test_op4_article_only():
    page = """<html><head><title>t</title><style>p{}</style></head><body><header><h2>Site</h2></header><nav><a>Home</a></nav><div class="ad">Buy.</div>
    <article><h1>Head &amp; more</h1><p>One  two,
    three.</p><p>Four<b>ty</b> words, and more of them here.</p></article><div id="comments"><p>I like this very much, indeed.</p></div><script>var a="<p>no</p>";</script><footer>&copy; x</footer></body></html>"""
    assert html_text.extract(page) == "Head & more One two, three. Fourty words, and more of them here."
    assert html_text.extract(None) == html_text.extract("") == html_text.extract("<nav>x</nav>") == ""


ARTICLE = "<h1>Head</h1><p>One long, whole sentence of the article, with some commas.</p><p>Another one, as long as that; and it ends here.</p>"
PLAIN = "Head One long, whole sentence of the article, with some commas. Another one, as long as that; and it ends here."


@pytest.mark.parametrize("wrapper", ['<div class="layout with-sidebar">', '<div id="content-side" class="side">', '<div class="search-page">', '<form id="aspnetForm">'])
def test_op4_wrappers_keep_the_article(wrapper):
    end = "</" + wrapper[1:].split(" ")[0] + ">"
    other = '<div class="sidebar"><p>Buy this, and that, and all the others too.</p></div>'
    assert html_text.extract(f"<body>{wrapper}<article>{ARTICLE}</article>{other}{end}</body>") == PLAIN
    assert html_text.extract(f"<body>{wrapper}<div>{ARTICLE * 2}</div>{end}</body>") == PLAIN + " " + PLAIN


def test_op4_leads_and_parts():
    page = f'<body><article><h1>Title</h1><div class="lead">A short lead, before it.</div><div class="body">{ARTICLE * 3}</div></article></body>'
    assert html_text.extract(page) == " ".join(["Title A short lead, before it.", *[PLAIN] * 3])
    parts = f'<body><div class="one">{ARTICLE * 4}</div><div class="two">{ARTICLE}</div></body>'
    assert html_text.extract(parts) == " ".join([PLAIN] * 5)


def test_op4_paths_choose():
    links = "<div>" + "".join(f"<p><a>Go {k}</a></p>" for k in range(6)) + "</div>"
    page = f'<body>{links}<div class="text">{ARTICLE}<p>Short.</p></div>{links}</body>'
    assert html_text.extract(page) == PLAIN + " Short."


def test_op4_side_effects_are_text():
    page = f'<body><article>{ARTICLE}<div class="side effects"><p>It may cause sleep, and some headache, as others do.</p></div></article><div class="side"><p>Buy it, now.</p></div></body>'
    assert html_text.extract(page) == PLAIN + " It may cause sleep, and some headache, as others do."


@pytest.mark.parametrize("page", [
    "<div>" * 10_000 + f"<p>{PLAIN}</p>" + "</div>" * 10_000, "<p>x, y.</p><span>" * 20_000, "<p><div>" + "<h1>" * 20_000, "<a href=\"x>" * 20_000, "<a title='it\"s>" * 20_000 + PLAIN, "<![CDATA[ x " * 50_000,
    "<!-- " * 50_000, "<" * 200_000, "<b </c " * 50_000, "<td>" * 20_000 + "</table>" * 20_000, "<p>" + "&amp;" * 50_000, "<x a='1' " * 30_000 + ">",
])
def test_op4_odd_pages_take_little_time(page):
    began = time.process_time()
    html_text.extract(page)
    assert time.process_time() - began < 5


def test_op4_deep_and_broken_pages():
    assert html_text.extract("<div>" * 10_000 + f"<article>{ARTICLE}</article>") == PLAIN
    assert html_text.extract(f"<body><article><p title=it's>One, two.</p>{ARTICLE}") == "One, two. " + PLAIN
    assert html_text.extract(f'<body><article><p title="a > b">One, two.</p>{ARTICLE}</article>') == "One, two. " + PLAIN
    assert html_text.extract(f"<article>{ARTICLE}<p>3 < 4, and 5 > 4.</p></article>") == PLAIN + " 3 < 4, and 5 > 4."
    assert html_text.extract(f"<!-- {ARTICLE} --><article>{ARTICLE}<!-- x") == PLAIN


def test_op4_rows(spark):
    rows = [(1, None, None, 0), (None, "u", f"<article>{ARTICLE}</article>", 1), (1, "u", "", 2), (1, "u", f"<article>{ARTICLE}</article>", 3)]
    got = html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int"))
    assert sorted((r["page_id"] or 0, r["text"], r["n_chars"]) for r in got.collect()) == [(0, PLAIN, len(PLAIN)), (1, "", 0), (1, "", 0), (1, PLAIN, len(PLAIN))]


def test_op5_fingerprints(spark):
    texts = corpus(5) + [(70, "a. b. c\nd. e."), (71, "a. b. c\nd. e.")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    n = fingerprints.with_next(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), "doc_id", ["text"]).collect()
    by = {i: t or "" for i, t in texts}
    order = sorted(by, reverse=True)
    assert {r["doc_id"]: r["next_text"] for r in n} == {a: by[b] for a, b in zip(order, order[1:] + order[:1], strict=True)}
    d = docs.select("doc_id", "text", fingerprints.fingerprint(F.col("text")).alias("f"))
    f = {r["doc_id"]: r["f"] for r in d.collect()}
    assert all((f[a] == f[b]) == (by[a] == by[b]) for a, b in itertools.combinations(by, 2))
    edited = spark.createDataFrame([("a. b. c\nd. e.", "a. b. c\nd. x.")], "a string, b string").select(*(fingerprints.fingerprint(F.col(c)).alias(c) for c in "ab"))
    r = edited.select(fingerprints.changed_sections(F.col("a"), F.col("b")).alias("s"), fingerprints.likeness(F.col("a"), F.col("b")).alias("l")).first()
    assert r["s"] == [1] and 0 < r["l"] < 1


def test_op5_query_against_brute_force(spark, tmp_path):
    """Edited texts and likenesses, with null texts, null and equal ids, and extra columns."""
    rows = [(None, None), (3, "a, b. c d e f"), (3, "a, b. c d e f g"), (9, ""), (12, "one two. three four. five six, seven eight.\nnine ten."), (11, "one two. three four. five six."), (-4, "x\U0001f600y" * 40)]
    spark.createDataFrame([(i, t, "e", 1) for i, t in rows], "doc_id long, text string, edited string, next_text int").write.parquet(f"{tmp_path}/documents.parquet")
    got = fingerprints.op5_fingerprints(spark, str(tmp_path)).collect()
    order = sorted(((i is None, -(i or 0), t or "") for i, t in rows))
    want = Counter()
    for (none, i, t), (_, _, u) in zip(order, order[1:] + order[:1], strict=True):
        cut = len(t) // 3
        want[None if none else -i, len(t), hashlib.sha256((t[: len(t) - cut] + u[:cut]).encode()).hexdigest()] += 1
    assert Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got) == want

    def likeness(a, b):
        x, y = (set(re.findall("(?<=[:,])[0-9a-f]{32}", f)) for f in (a, b))
        return 1.0 if a[:64] == b[:64] else len(x & y) / max(1, len(x | y))

    by = {(r["doc_id"], r["n_chars"]): r for r in got}
    for (none, i, t), (none2, j, u) in zip(order, order[1:] + order[:1], strict=True):
        r, n = by[None if none else -i, len(t)], by[None if none2 else -j, len(u)]
        assert abs(r["near_next"] - likeness(r["fingerprint"], n["fingerprint"])) < 1e-12
        assert abs(r["near_edited"] - likeness(r["fingerprint"], r["edited_fingerprint"])) < 1e-12
    assert by[12, 53]["near_next"] > 0.2


def test_op5_tree_and_bounded_leaves(spark):
    r = random.Random(5)
    texts = ["".join(chr(r.randrange(0x4E00, 0x9FA5)) for _ in range(3000)), "これは文です。" * 3 + "つぎの文、です。", "x" * 3000, " ".join("".join(r.choice("abcdfgh") for _ in range(6)) for _ in range(400)), "a\x01" * 200, "", "p. q\n\n r\U0001f600"]
    for t in texts:
        edited = t[: len(t) // 3 * 2] + "".join(chr(r.randrange(0x3041, 0x3090)) for _ in range(len(t) // 3))
        d = spark.createDataFrame([(t, edited)], "a string, b string")
        f = d.select("*", fingerprints.fingerprint(F.col("a")).alias("f"), fingerprints.fingerprint(F.col("b")).alias("g")).select("*", F.transform(F.split("a", "\n"), fingerprints.leaves_of).alias("leaves"), fingerprints.likeness(F.col("f"), F.col("g")).alias("near")).first()
        md5 = lambda x: hashlib.md5(x.encode()).hexdigest()
        if "\x01" not in t:
            assert "\n".join("".join(x) for x in f["leaves"]).replace("\x01", "") == t
        assert all(len(x) <= 2 * fingerprints.MOST for s in f["leaves"] for x in s)
        sections = [",".join(map(md5, s)) for s in f["leaves"]]
        root = hashlib.sha256(",".join(map(md5, sections)).encode()).hexdigest()
        assert f["f"] == root + "|" + "|".join(md5(s) + ":" + s for s in sections)
        if len(t) > 1000 and "x" not in t:
            assert len(f["leaves"][0]) > 20 and f["near"] > 0.3


def test_op6_brute_force(spark):
    texts = corpus(6, 120)
    w = {i: re.findall(r"[^ \t-\r]+", (t or "").lower()) for i, t in texts}
    sets = {i: {tuple(x[k : k + 5]) for k in range(max(1, len(x) - 4))} if x else set() for i, x in w.items()}
    comp = {i: i for i in sets}
    changed = True
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            if comp[a] != comp[b]:
                comp[a] = comp[b] = min(comp[a], comp[b])
                changed = True
    docs = docs_of(spark, texts).repartition(5)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.link_components(docs).collect()}
    assert got == {i: (len(s), comp[i]) for i, s in sets.items()}
    assert {r["doc_id"] for r in ngram_join.keep_one(docs).collect()} == {i for i in comp if comp[i] == i}


def key(r):
    return (r["doc_id"] is None, r["doc_id"] or 0, r["text"] is not None, r["text"] or "")


def test_rows_with_null_or_equal_ids_stay_unless_copies(spark):
    """Four unlike texts under no or one id, copies of one row, near copies, texts without words; extra and clashing columns."""
    long_ = " ".join(f"n{k}" for k in range(200))
    rows = [(-1, "a b c d e f"), (-1, "g h i j k l"), (7, "m n o p q r"), (7, "s t u v w x"), (7, "s t u v w x"), (9, long_ + " y"), (8, long_), (-1, long_ + " z"), (-1, None), (3, ""), (3, "")]
    docs = docs_of(spark, rows).repartition(3)
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    want = [(None, "a b c d e f"), (None, "g h i j k l"), (7, "m n o p q r"), (7, "s t u v w x"), (8, long_), (None, None), (3, ""), (3, "")]
    assert sorted(map(key, kept.collect())) == sorted(key({"doc_id": i, "text": t}) for i, t in want)
    none = suffix_dedup.cut_repeats(docs)
    first = {}
    for i, t in sorted(((2**63 if i < 0 else i), t or "") for i, t in rows):
        for k in range(len(t) - 49):
            first.setdefault(t[k : k + 50], i)
    want = []
    for i, t in rows:
        gone = {j for k in range(len(t or "") - 49) if first[t[k : k + 50]] < (2**63 if i < 0 else i) for j in range(k, k + 50)}
        want.append({"doc_id": i if i >= 0 else None, "text": t if t is None else "".join(c for k, c in enumerate(t) if k not in gone)})
    assert sorted(map(key, none.collect())) == sorted(map(key, want)) and none.columns == docs.columns


def test_quality_goes_by_row(spark):
    r = random.Random(4)
    good = lambda: " ".join(r.choice(["some", "plain", "words", "of", "a", "text", "that", "reads", "well"]) + str(r.randrange(50)) for _ in range(60)) + "."
    bad = lambda: "".join(r.choice("#$%&*@ |") for _ in range(300))
    rows = [(k, good() if k % 2 else bad()) for k in range(200)] + [(-1, good()), (-1, bad()), (500, good()), (500, bad()), (501, None)]
    docs = docs_of(spark, rows)
    labels = spark.createDataFrame([(k, k % 2, "x") for k in range(0, 120)] + [(None, 1, "x"), (3, 1, "x")], "doc_id long, quality int, text string")
    kept = quality.keep_good(docs, labels)
    got = Counter((x["doc_id"], x["text"]) for x in kept.collect())
    want = Counter((i if i >= 0 else None, t) for i, t in rows if t and "#" not in t)
    assert kept.columns == docs.columns and not want - got and all(t is None for _, t in got - want)


def test_op7_files(spark, tmp_path):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    texts = corpus(7) + [(300, "a b c ́d <|endoftext|> x\n\ny it's I'LL 12345 !!?? 中文 é"), (301, "\t lead and trail \r\n")]
    out = f"file://{tmp_path}/tok"
    token_output.write_token_files(docs_of(spark, texts).repartition(4), out, path)
    got = {r["doc_id"]: r for r in token_output.read_token_files(spark, out).collect()}
    start = 0
    for i, t in sorted(texts):
        ids = [*plain.encode(t or "", add_special_tokens=False).ids, 1]
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())), (i, t)
        start += len(ids)
    assert token_output.lookup(spark, out, [301])[301][-1] == 1
    some = {i: [*plain.encode(dict(texts)[i] or "", add_special_tokens=False).ids, 1] for i in (0, 7, 300)}
    assert token_output.lookup(spark, out, [*some, -5, 999]) == some and token_output.lookup(spark, out, []) == {}


def test_op7_every_letter():
    """Every assigned character before and after letters and marks has the ids that the tokenizer gives."""
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    encode, plain = token_output.Encoder(path).encode, Tokenizer.from_file(path)
    letters = [chr(c) for c in range(0x110000) if unicodedata.category(chr(c)) not in ("Cs", "Co", "Cn")]
    for at in range(0, len(letters), 50_000):
        words = [w for c in letters[at : at + 50_000] for w in (f"AB{c}.", f"!{c}ab", f"{c},")]
        want = [np.array(e.ids, "<u4").tobytes() for e in plain.encode_batch_fast(words, add_special_tokens=False)]
        wrong = [w for w, a, b in zip(words, encode(pa.array(words)), want, strict=True) if a != b]
        assert not wrong, wrong[:5]


def test_op7_rows(spark, tmp_path):
    """Null and equal ids, a long text, an empty table, clashing columns, and a tokenizer of another kind."""
    path = public_tokenizers.path("word_bpe_49k.json")
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(path)
    texts = [(-1, "no id"), (5, "five"), (5, "also five"), (6, "long words and more " * 20_000), (-1, None)]
    out = f"file://{tmp_path}/tok"
    token_output.write_token_files(docs_of(spark, texts).repartition(3), out, path)
    got = [(r["doc_id"], r["n_tokens"], r["start"]) for r in token_output.read_token_files(spark, out).orderBy("start").collect()]
    sizes = {t: len(plain.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in texts}
    assert sorted((i, n) for i, n, _ in got if i) == sorted((i, sizes[t]) for i, t in texts if i >= 0)
    assert [i for i, _, _ in got] == [None, None, 5, 5, 6] and [s for _, _, s in got] == [sum(n for _, n, _ in got[:k]) for k in range(5)]
    with pytest.raises(Exception, match="put together"):
        token_output.train_dictionary(docs_of(spark, [(1, "Some words  with spaces, it's.")]), public_tokenizers.path("byte_bpe_50k.json"))


def test_op8_round_trip_and_samples(spark):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    m = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = [*corpus(8), (400, " lead  two   three "), (401, "日本語 \U0001f600 zz"), (402, "a\nb\tc"), (403, "q" * 100), (404, "中" * 5000), (405, "word " * 50_000)]
    enc = sentencepiece_codec.encode(docs_of(spark, texts), path).cache()
    back = {r["doc_id"]: r["text"] for r in sentencepiece_codec.decode(enc, path).collect()}
    assert back == {r["doc_id"]: r["decoded"] for r in enc.collect()}
    codec = sentencepiece_codec.Codec(path)
    for r in enc.collect():
        t = dict(texts)[r["doc_id"]] or ""
        assert np.frombuffer(r["ids"], "<u4").tolist() == m.encode(t), t
        assert back[r["doc_id"]] == t
        samples = [bytes(s["ids"]) for s in r["samples"]]
        assert len(set(samples)) == len(samples) and all(codec.decode(np.frombuffer(s, "<u4")) == t for s in samples)
        assert all(0 < s["inclusion"] <= 1 for s in r["samples"])
    assert rows_of(sentencepiece_codec.digest(enc).select("doc_id", "n_tokens")) == rows_of(sentencepiece_codec.digest(sentencepiece_codec.encode(docs_of(spark, texts).repartition(3), path)).select("doc_id", "n_tokens"))


@pytest.fixture(scope="module")
def codec():
    return sentencepiece_codec.Codec(public_tokenizers.path("piece_bpe_32k.model"))


def segmentations(codec, text):
    """Every segmentation of a text with its probability, by enumeration."""
    def every(u):
        if not u:
            yield (), 0.0
        for j in range(1, len(u) + 1):
            if u[:j] in codec.pieces:
                head, w = (codec.pieces[u[:j]],), codec.weight[codec.pieces[u[:j]]]
            elif j == 1:
                head, w = tuple(codec.bytes[list(u[0].encode())].tolist()), -sentencepiece_codec.BYTE_COST * len(u[0].encode())
            else:
                continue
            for tail, x in every(u[j:]):
                yield head + tail, w + x

    p = dict(every("▁" + text.replace(" ", "▁")))
    total = sum(map(np.exp, p.values()))
    return {ids: float(np.exp(w)) / total for ids, w in p.items()}


@pytest.mark.parametrize(("text", "k"), [("thanedble", 2), ("anedb the", 2), ("é" * 3 + "ing", 3), ("\U0001f600a", 3), ("of", 4)])
def test_op8_whole_lattice(codec, text, k):
    p = segmentations(codec, text)
    n = 6000
    units = codec.chain(text)
    codec.learn()
    found = sentencepiece_codec.sample_top_k(codec, [units] * n, [s * 0x9E3779B97F4A7C15 % 2**64 for s in range(1, n + 1)], k)
    first, drawn, mass = dict.fromkeys(p, 0), dict.fromkeys(p, 0), 0.0
    for f in found:
        names = [tuple(codec.ids[e].tolist()) for e, _, _ in f]
        assert len(set(names)) == len(names) == min(k, len(p))
        first[names[0]] += 1
        for name, (_, log_p, inclusion) in zip(names, f, strict=True):
            drawn[name] += 1
            assert abs(log_p - np.log(p[name])) < 1e-9
            mass += p[name] / inclusion / n
    assert abs(mass - 1) < 0.05  # what the inclusion scores are for: weights that add up to all
    for name, q in p.items():
        assert abs(first[name] / n - q) < 5 * (q / n) ** 0.5 + 1e-3
    if k == 2:
        once = sum(q / (1 - q) for q in p.values())
        for name, q in p.items():
            assert abs(drawn[name] / n - (q + q * (once - q / (1 - q)))) < 5 * (2 * q / n) ** 0.5 + 1e-3
    rare = sorted(p, key=p.get)[: len(p) // 2]
    assert abs(sum(first[name] for name in rare) / n - sum(p[name] for name in rare)) < 5 * (sum(p[name] for name in rare) / n) ** 0.5 + 1e-3


def test_op8_every_segmentation_once(codec):
    p = segmentations(codec, "aned")
    units = codec.chain("aned")
    codec.learn()
    (found,) = sentencepiece_codec.sample_top_k(codec, [units], [5], len(p) + 3)
    assert {tuple(codec.ids[e].tolist()) for e, _, _ in found} == set(p) and len(found) == len(p)
    assert all(q == 1.0 for _, _, q in found)


def test_op8_long_units_are_whole(codec):
    u = "internationalization" * 3
    units = codec.chain(u)
    codec.learn()
    names, crossed = set(), False
    for f in sentencepiece_codec.sample_top_k(codec, [units] * 50, list(range(1, 51)), 2):
        for e, _, _ in f:
            ids = codec.ids[e]
            assert codec.decode(ids) == u
            crossed |= 32 not in np.cumsum(codec.text_len[ids])
            names.add(ids.tobytes())
    assert crossed and len(names) == 100


def test_op8_common_units_stay(codec, monkeypatch):
    """A full cache keeps the units met most often, and what is remembered does not change a result."""
    own = sentencepiece_codec.Codec(public_tokenizers.path("piece_bpe_32k.model"))
    texts = [f"the the of é\U0001f600 rare{k} word{k * k}" for k in range(60)]
    chains = own.chains(pa.array(texts))
    own.learn()
    before = {u: [own.ids[own.first[s] : own.first[s + 1]].tolist() for s in range(own.start[k], own.stop[k])] for u, k in own.index.items()}
    own.forget(len(own.ids) // 4)
    assert {"the", "of"} <= own.index.keys() and len(own.index) < len(before) // 2 and len(own.index) == len(own.start) == len(own.best_len)
    for u, k in own.index.items():
        assert [own.ids[own.first[s] : own.first[s + 1]].tolist() for s in range(own.start[k], own.stop[k])] == before[u]
    got = own.chains(pa.array(texts))
    own.learn()
    assert [own.best(units) for units in got] == [np.array(codec.model.encode(t), "<u4").tobytes() for t in texts] and len(chains) == len(got)
    batches = [pa.RecordBatch.from_arrays([pa.array(range(60)), pa.array(texts)], ["doc_id", "text"])]
    path = public_tokenizers.path("piece_bpe_32k.model")
    whole = [r for b in sentencepiece_codec._encode(batches, path, 2) for r in b.to_pylist()]
    monkeypatch.setattr(sentencepiece_codec, "CACHE_EDGES", 300)
    monkeypatch.setattr(sentencepiece_codec, "GROUP_CHARS", 100)
    assert [r for b in sentencepiece_codec._encode(batches, path, 2) for r in b.to_pylist()] == whole


def test_op9_held_out(spark):
    d = "/root/testdata/sf0.1"
    s = toxicity.op9_toxicity(spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").where("held_out").select("score", "toxic").toPandas()
    rank, pos = s["score"].rank(), s["toxic"] == 1
    auc = (rank[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())
    assert auc > 0.9
    assert s["score"].between(0, 1).all()


def test_op10_held_out(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    held = "crc32(cast(doc_id as string)) % 4 = 2"
    s = quality.score(docs, labels.where(f"not {held}"))
    assert s.count() == docs.count() and s.where("score is null").count() == 0
    s = s.join(labels.where(held), "doc_id").select("rejected", "quality").toPandas()
    assert s[s["quality"] == 1]["rejected"].mean() < 0.02 and s[s["quality"] == 0]["rejected"].mean() > 0.9


def test_op10_record_view_never_sees_the_text(spark):
    rows = [(1, "some text", "en", "s", 9), (1, "#### other |||", "en", "s", 9)]
    f = quality.features(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), ["doc_id"]).collect()
    assert f[0][quality.META] == f[1][quality.META] and f[0][quality.TEXT] != f[1][quality.TEXT]


def test_trained_operators_take_nulls(spark):
    docs = docs_of(spark, [*corpus(9), (-1, None)])
    labels = spark.createDataFrame([(k, k % 2, k % 3 == 0) for k in range(40)], "doc_id long, quality int, t boolean").selectExpr("doc_id", "quality", "cast(t as int) as toxic")
    assert toxicity.score(docs, labels).where("score between 0 and 1").count() == docs.count()
    assert quality.score(docs, labels).count() == docs.count()


def plain_links(sets):
    """component (smallest id) of each id whose set is not empty, by comparing all pairs."""
    comp = {i: i for i in sets}
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            if comp[a] != comp[b]:
                comp[a] = comp[b] = min(comp[a], comp[b])
                changed = True
    return comp


def plain_words(pattern, text):
    return re.findall(pattern, "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def test_pipeline(spark):
    """The last three filters and the tokens by brute force, from what the classifier keeps."""
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    import sentencepiece

    got = {r["doc_id"]: (r["n_tokens"], r["ids_crc32"]) for r in corpus_pipeline.run(spark, DATA).collect()}
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    texts = {r["doc_id"]: r["text"] or "" for r in quality.keep_good(docs, labels).collect()}
    w = {i: plain_words("[^ \t-\r]+", t) for i, t in texts.items()}
    comp = plain_links({i: {tuple(x[k : k + 5]) for k in range(max(1, len(x) - 4))} if x else set() for i, x in w.items()})
    one = {i: t.encode() for i, t in texts.items() if comp[i] == i}
    first = {}
    for i in sorted(one):
        for k in range(len(one[i]) - 49):
            first.setdefault(one[i][k : k + 50], i)
    cut = {}
    for i, raw in one.items():
        gone = np.zeros(len(raw), bool)
        for k in range(len(raw) - 49):
            if first[raw[k : k + 50]] < i:
                gone[k : k + 50] = True
        text = np.frombuffer(raw, np.uint8)[~gone].tobytes().decode("utf-8", "ignore")
        if text or not raw:
            cut[i] = text
    grams = set()
    for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect():
        x = plain_words(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", r["text"])
        grams |= {tuple(x[k : k + min(13, len(x))]) for k in range(max(1, len(x) - 12)) if x}
    m = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = {}
    for i, text in cut.items():
        x, hit = plain_words(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text), set()
        for n in {len(g) for g in grams}:
            for k in range(len(x) - n + 1):
                if tuple(x[k : k + n]) in grams:
                    hit |= set(range(k, k + n))
        if not (hit and 20 * len(hit) >= len(x)):
            ids = m.encode(text)
            want[i] = (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
    assert len(want) < len(texts) and got == want


def test_stages_take_odd_rows(spark, tmp_path):
    """Null and equal ids, null, empty and repeated texts, and columns of other names in every stage."""
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    item = " ".join(f"q{k}" for k in range(30))
    rows = [(-1, "one text of its own, number one"), (-1, "another text, and not the same"), (7, "a third text under seven"), (7, "a fourth text under seven"), (7, "a fourth text under seven"), (-1, item), (8, item + " " + item), (9, None), (9, ""), (10, "x" * 100), (11, "x" * 100 + " tail of its own")]
    docs = docs_of(spark, rows).repartition(3)
    spark.createDataFrame([(None, 1), (7, 0)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, str(tmp_path))
        assert kept.columns == corpus_pipeline.COLUMNS
    got = Counter((r["doc_id"], r["text"]) for r in kept.collect())
    assert got == Counter([(None, rows[0][1]), (None, rows[1][1]), (7, rows[2][1]), (7, rows[3][1]), (9, None), (9, ""), (10, "x" * 100), (11, " tail of its own")])
    assert corpus_pipeline.STAGES[-1][1](spark, kept, str(tmp_path)).count() == 8
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0


@pytest.mark.parametrize("inner, kept", [
    ('<div class="ad-hoc"><p>WORD it is, fine.</p></div>', True), ('<div class="nav-theory"><p>WORD it is.</p></div>', True), ('<div class="editor-comment"><p>WORD it is.</p></div>', True),
    ('<section id="copyright-law"><p>WORD it is.</p></section>', True), ("<p>so <math><mi>WORD</mi></math> is</p>", True), ("<p " + " ".join(f'a{k}="v>{k}"' for k in range(1200)) + ">WORD</p>", True),
    ('<div class="ad"><p>WORD it is.</p></div>', False), ('<div class="comment-list"><p>WORD it is.</p></div>', False), ('<div id="comments-3" class="x">WORD it is.</div>', False), ("<form><p>WORD it is.</p></form>", False),
])
def test_op4_names_inside_articles(inner, kept):
    p = "<p>" + "Some words of an article, with marks. " * 8 + "</p>"
    out = html_text.extract(f"<html><body><nav><a href=x>Home</a></nav><article><h1>T</h1>{p}{inner}{p}</article></body></html>")
    assert ("WORD" in out) is kept and ">" not in out and out.count("Some words") == 16


def test_op4_broken_quotes_are_linear():
    began = time.time()
    assert html_text.extract("<p>a</p>" + "<a b='" * 200_000) is not None
    assert html_text.extract("<a b=\"c'd>" * 100_000) is not None
    assert time.time() - began < 10


def test_clashing_columns_of_other_tables(spark):
    """Columns of benchmark and labels with the operators' own names, and repeated labels, change nothing."""
    docs = docs_of(spark, [*corpus(4), (-1, "w1 w2")])
    items = [(1, corpus(4)[3][1]), (2, "w1 w2"), (3, None)]
    plain = spark.createDataFrame(items, "item_id int, text string")
    odd = plain.selectExpr("item_id", "text", "item_id as doc_id", "'x' as spans", "2 as items", "true as contaminated", "text as `_key`", "5 as n_words", "'z' as lang")
    assert rows_of(decontamination.verdicts(docs, odd)) == rows_of(decontamination.verdicts(docs, plain))
    assert rows_of(decontamination.decontaminate(docs, odd)) == rows_of(decontamination.decontaminate(docs, plain))
    known = spark.createDataFrame([(k, k % 2, k % 3 == 0) for k in range(40)], "doc_id long, quality int, t boolean").selectExpr("doc_id", "quality", "cast(t as int) as toxic")
    more = known.union(known).selectExpr("*", "'a' as text", "1.5 as score", "7 as votes", "'t' as terms", "9 as n_chars", "true as held_out")
    one, two = toxicity.score(docs, known), toxicity.score(docs, more)
    assert two.count() == docs.count() and rows_of(two) == rows_of(one)
    assert rows_of(quality.score(docs, more)) == rows_of(quality.score(docs, known))


def test_pipeline_leaves_its_last_table_only(spark):
    from pathlib import Path

    import corpus_pipeline
    from ledgerloom.llm.shared import shared_dir

    folder = Path(shared_dir(spark).removeprefix("file://"))
    before = set(folder.iterdir())
    out = corpus_pipeline.run(spark, DATA)
    assert [p.name.rsplit("-", 1)[0] for p in set(folder.iterdir()) - before] == ["benchmark-decontamination"]
    assert out.count() > 0
