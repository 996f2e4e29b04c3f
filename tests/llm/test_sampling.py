"""Importance resampling against a plain version."""

import hashlib
import math
import re
import zlib
from collections import Counter

from test_llm import corpus, docs_of

from ledgerloom.llm import importance


def features(text, n):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return [" ".join(words[k : k + m]) for m in range(1, n + 1) for k in range(len(words) - m + 1)], len(words)


def plain(texts, target, n, buckets, percent, min_words):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(bucket(f) for _, t in texts for f in features(t, n)[0])
    t = Counter(bucket(f) for x in target for f in features(x, n)[0])
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1.0) * (s.total() + buckets) / ((s[b] + 1.0) * (t.total() + buckets))))
    rows = []
    for i, x in texts:
        f, words = features(x, n)
        weight = sum(map(gain, map(bucket, f))) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'null' if i < 0 else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(f), words, weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    best = sorted((r for r in rows if r[2] >= min_words), key=lambda r: (-r[4], r[0] < 0, r[0]))
    ranks = {id(r): k + 1 for k, r in enumerate(best[: len(best) * percent // 100])}
    return Counter((*r, ranks.get(id(r))) for r in rows)


def test_op11_brute_force(spark):
    texts = [*corpus(5, 90), (90, "É" * 50 + " x\0y Z9"), (91, "word " * 30_000), (92, "word"), (-1, "one w3 w4 " * 9), (93, "b|c " * 25), (93, "b|c " * 25)]
    target = ["w1 w2 w3 W4", None, "", "tion. tion."]
    for n, percent in ((1, 10), (3, 50)):
        out = importance.ranked(docs_of(spark, texts), spark.createDataFrame([(k, x, 1) for k, x in enumerate(target)], "item_id long, text string, row int"), ["doc_id", "v", "bid"], n_gram=n, buckets=97, percent=percent, min_words=5)
        got = Counter((-1 if r["row"]["doc_id"] is None else r["row"]["doc_id"], r["n_features"], r["n_words"], r["weight"], r["score"], r["rank"]) for r in out.collect())
        want = plain(texts, target, n, 97, percent, 5)
        # the two rows 93 are alike: their ranks follow each other
        assert got == want, (got - want, want - got)


def test_op11_rows_come_out_whole(spark):
    docs = docs_of(spark, corpus(6, 40))
    drawn = importance.resample(docs, spark.createDataFrame([(1, "w1 w2")], "item_id long, text string"), percent=100, min_words=0)
    assert drawn.schema == docs.schema and Counter(map(tuple, drawn.collect())) == Counter(map(tuple, docs.collect()))
    none = spark.createDataFrame([], "item_id long, text string")
    assert importance.resample(docs, none, min_words=1).count() == sum(bool(features(t, 1)[1]) for _, t in corpus(6, 40)) // 10
