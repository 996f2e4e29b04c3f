"""Context mixing against plain counts of plain contexts."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import DATA
from test_llm import corpus, docs_of

from ledgerloom.llm import context_mixing as cm
from ledgerloom.llm import registry


def contexts(text):
    """(byte, its contexts of orders 0 to 5 and the word) of a text and its end, and the byte before."""
    raw = b"\xff" * 13 + (text or "").encode().lower() + b"\xff"
    for p in range(13, len(raw)):
        word = 0
        while word < 13 and raw[p - 1 - word] > 32 and raw[p - 1 - word] != 255:
            word += 1
        own = [raw[p - o : p] for o in range(6)]
        own.append(own[5] if word < 5 else (own[5], "." if word == 5 else raw[p - min(word, 13) : p - 5]))
        yield raw[p], own, raw[p - 1]


def plain(texts, mixer):
    followed, tokens = [defaultdict(Counter) for _ in range(cm.ORDERS)], Counter()
    for i, t in texts:
        if not cm.held_out(i):
            tokens.update([*(t or "").encode().lower().split(), b""])
            for byte, own, _ in contexts(t):
                for f, c in zip(followed, own, strict=True):
                    f[c][byte] += 1
    base = math.log10(tokens.total() + len(tokens) + 1)
    for i, t in texts:
        n, kinds = [], []
        for byte, own, last in contexts(t):
            n.append([[sum(v for b, v in f[c].items() if b >> (8 - j) == byte >> (8 - j)) for j in range(9)] for f, c in zip(followed, own, strict=True)])
            kinds.append(cm._KIND[last])
        s = mixer.refined(*cm.evidence(np.array(n).transpose(1, 2, 0), np.array(kinds)))
        bits = cm.mixture(np.array([[np.logaddexp(0, -x * s).sum() / math.log(2)] for x in cm.TEMPERATURES]))[0]
        words = [*(t or "").encode().lower().split(), b""]
        known = [tokens[w] for w in words]
        yield i, cm.held_out(i), len(words), sum(c > 0 for c in known), tokens.total(), sum(math.log10(c + 1) - base for c in known), -bits * math.log10(2)


@pytest.fixture(scope="module")
def texts():
    return [*[(i, t) for i, t in corpus(8, 40) if i not in (9, 10)], (90, "Ærlig\0x 漢字仮名 " * 8), (91, "aB" * 2000), (92, "supercalifragilistic superb SUPERCALI"), (92, "supercalifragilistic superb SUPERCALI"), (93, "\t\x0b\x0c\r\n")]


def test_op13_brute_force(spark, texts):
    rows = [(i, t) for i, t in texts] + [(-1, "w1 w2")]
    frame = docs_of(spark, rows).repartition(3)
    mixer = cm.Mixer()
    r = np.random.default_rng(1)
    for w in (*mixer.weights, mixer.upper):
        w += r.normal(0, 0.1, w.shape).astype(w.dtype)
    got = {(r["doc_id"], r["n_bytes"]): r for r in cm.score_texts(frame, mixer).collect()}
    for i, held, n, known, train, base, score in plain([(None if i < 0 else i, t) for i, t in rows], mixer):
        r = got[i, len((dict(rows)[-1 if i is None else i] or "").encode())]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held, n, known, train)
        assert r["base_score"] == pytest.approx(base, rel=1e-9) and r["score"] == pytest.approx(score, rel=1e-3)


def test_op13_is_a_distribution():
    """The bytes that can follow a context have probabilities that add up to one, whatever the weights and counts."""
    r = np.random.default_rng(2)
    mixer = cm.Mixer()
    counts = np.where(r.random((cm.ORDERS, 256)) < 0.1, r.integers(1, 50, (cm.ORDERS, 256)), 0)
    n = np.array([[[c[b >> (8 - j) << (8 - j) : ((b >> (8 - j)) + 1) << (8 - j)].sum() for b in range(256)] for j in range(9)] for c in counts])
    odds, gates, bit = cm.evidence(n, np.full(256, 3))
    mixer.learn(odds, gates, bit)
    s = mixer.refined(odds, gates, bit)
    for t in cm.TEMPERATURES:
        assert np.exp2(-(np.logaddexp(0, -t * s) / math.log(2)).reshape(-1, 8).sum(axis=1)).sum() == pytest.approx(1, rel=1e-4)


def test_op13_learns(spark, texts):
    """Learned weights beat the first ones on documents that were not learned from, and knowing the corpus beats knowing nothing."""
    frame = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text")
    total = lambda rows: sum(r["score"] for r in rows if r["held_out"])
    learned, first = cm.score_texts(frame).collect(), cm.score_texts(frame, cm.Mixer()).collect()
    size = sum(r["n_bytes"] + 1 for r in learned if r["held_out"])
    assert total(learned) > total(first) and -total(learned) / size / math.log10(2) < 3.2
    assert all(r["score"] == pytest.approx(-math.log10(2) * r["bits_per_byte"] * (r["n_bytes"] + 1)) for r in learned)


def test_op13_odd_tables(spark):
    assert cm.score_texts(docs_of(spark, [])).count() == 0
    (row,) = cm.score_texts(docs_of(spark, [(i, "a b") for i in range(40) if cm.held_out(i)][:1])).collect()
    assert (row["train_tokens"], row["n_known"], row["base_score"]) == (0, 0, 0) and row["score"] == pytest.approx(-32 * math.log10(2))
    assert registry.queries()["op13_context_mixing"](spark, DATA).count() == spark.read.parquet(f"{DATA}/documents.parquet").count()


def test_op13_weights_are_of_all_training_bytes(spark, monkeypatch):
    """Every byte and end of every training document moves the weights, in long documents and beyond 128 of them too."""
    found = []
    fit = cm.fit_mixer
    monkeypatch.setattr(cm, "fit_mixer", lambda *a: found.append(fit(*a)) or found[0])
    rows = [(k, f"text {k} of its own") for k in range(300)] + [(300 + k, "long words " * 2000) for k in range(3)]
    cm.score_texts(docs_of(spark, rows).repartition(3)).collect()
    bits = 8 * sum(len(t) + 1 for i, t in rows if not cm.held_out(i))
    first = cm.Mixer()
    assert (found[0].tries - first.tries).sum() == bits and [n.sum() for n in found[0].seen] == [bits] * 4
    again = cm.Mixer.of_sums(found[0].sums())
    assert np.allclose(again.hits, found[0].hits) and all(np.allclose(a, b, atol=1e-4) for a, b in zip(again.weights, found[0].weights, strict=True))
