"""Toxicity by weak supervision.

Many weak voters look at a text, each in its own way: a list of insults that
is fixed beforehand, lexicons of whole words and of word beginnings, and
patterns.  A generative label model over the counts of all documents' vote
patterns estimates by expectation maximisation how often each voter speaks on
toxic and on other texts, and how voters correlate within a class (correlated
voters share their weight); it never sees a label.  Its posterior labels train
a linear classifier on the lexicons' terms, which scores every document.

Labels are used only from rows outside the held-out quarter, and from a sample
of at most LABELLED of them: to find the terms of the lexicons and to
calibrate the score.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import discard, materialize, read_table, sample_by_hash

#: Bounds of the fit: labelled rows (smallest hash of doc_id), which also train the classifier, and lexicon terms.
LABELLED, TERMS = 12_000, 400
#: Rows of the whole table that the classifier is trained on, by the posteriors of their votes.
FITTED = 12_000
#: Word beginnings of so many letters are terms.
BEGINNINGS = (4, 5, 7)
# Common insults.
INSULTS = frozenset(
    "idiot idiots moron morons imbecile stupid dumb dumbass fool scum loser losers trash garbage filth filthy vermin worthless pathetic disgusting "
    "clown jerk creep coward liar bastard asshole bitch crap shit fuck fucking retard retarded pig swine freak ugly hateful despicable".split()
)
#: Voters: fixed list; lexicon of strong words, of other words, of each kind of beginnings; many hits; hits in a hundred words; exclamations; nothing found.
FIXED, STRONG, OTHER, BEGIN, MANY, DENSE, LOUD, NONE = 0, 1, 2, 3, 6, 7, 8, 9
N_VOTERS = 10
STRONG_ODDS = 3.5
THRESHOLD = 0.3
CACHE_WORDS = 300_000
_WORD = re.compile(r"[^\W\d_]+")
FEATURE_SCHEMA = "doc_id long, terms array<int>, counts array<int>, extra array<double>, votes int"


def held_out() -> F.Column:
    return F.crc32(F.col("doc_id").cast("string")) % 4 == 2


def _terms(word: str) -> tuple[str, ...]:
    return (word, *(f"{word[:n]}-" for n in BEGINNINGS if len(word) > n))


def _voter(term: str, odds: float) -> int:
    return BEGIN + BEGINNINGS.index(len(term) - 1) if term.endswith("-") else STRONG if odds > STRONG_ODDS else OTHER


def build_lexicon(train: DataFrame) -> list[tuple[str, float]]:
    """Terms that lean to toxic texts, with their log odds; at most TERMS."""

    def run(batches):
        for batch in batches:
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = set(_WORD.findall((text or "").lower()))
                terms = sorted({t for w in words for t in _terms(w)})
                yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array([toxic] * len(terms), pa.int32())], ["term", "toxic"])

    counts = train.select("toxic", "text").mapInArrow(run, "term string, toxic int").groupBy("term").agg(F.sum("toxic").alias("t"), F.count("*").alias("n"))
    total = train.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.count("*")).first()
    if not total[0] or total[0] == total[1]:
        return []
    odds = F.log((F.col("t") + 0.5) / (total[0] + 1)) - F.log((F.col("n") - F.col("t") + 0.5) / (total[1] - total[0] + 1))
    strong = counts.where("t >= 4").withColumn("odds", odds).where("odds > 1.5")
    return [(r["term"], r["odds"]) for r in strong.orderBy(F.desc(F.col("odds") * F.sqrt("t")), "term").limit(TERMS).collect()]


def features(docs: DataFrame, lexicon: list[tuple[str, float]]) -> DataFrame:
    """Lexicon terms of each whole text with their counts, a few pattern measures, and the votes as bits."""
    index = {t: k for k, (t, _) in enumerate(lexicon)}
    voter = [_voter(t, odds) for t, odds in lexicon]

    def run(batches):
        known: dict[str, tuple] = {}
        for batch in batches:
            rows: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                text = text or ""
                found: dict[int, int] = {}
                words = _WORD.findall(text.lower())
                for w in words:
                    ks = known.get(w)
                    if ks is None:
                        if len(known) >= CACHE_WORDS:
                            known.clear()
                        ks = known[w] = tuple(index[t] for t in _terms(w) if t in index)
                    for k in ks:
                        found[k] = found.get(k, 0) + 1
                n = max(1, len(words))
                marks = text.count("!") / n
                votes = (not INSULTS.isdisjoint(words)) << FIXED
                for k in found:
                    votes |= 1 << voter[k]
                hits = sum(found.values())
                votes |= (hits >= 3) << MANY | (hits / n > 0.01) << DENSE | (marks > 0.05) << LOUD | (not votes) << NONE
                ks = sorted(found)
                rows.append((doc, ks, [found[k] for k in ks], [marks, float(np.log1p(hits)), hits / n], votes))
            types = (pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.float64()), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)] if rows else [pa.array([], t) for t in types], ["doc_id", "terms", "counts", "extra", "votes"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, FEATURE_SCHEMA)


#: First guess of the label model: how often a voter speaks on other and on toxic texts (NONE the other way round), and the share of these.
GUESS, PRIOR = (0.03, 0.5), 0.1


def label_model(patterns: np.ndarray, counts: np.ndarray, prior: float = PRIOR, rounds: int = 30) -> np.ndarray:
    """Posterior of each vote pattern (bits)."""
    start = np.repeat(np.array(GUESS)[:, None], N_VOTERS, 1)
    start[:, NONE] = 1 - start[:, NONE]
    v = (patterns[:, None] >> np.arange(N_VOTERS)) & 1
    p = np.clip(start, 0.01, 0.99)
    weight = np.ones(N_VOTERS)
    post = np.full(len(v), prior)
    for _ in range(rounds):
        ratio = np.where(v == 1, np.log(p[1] / p[0]), np.log((1 - p[1]) / (1 - p[0])))
        post = 1 / (1 + np.exp(-np.clip(ratio @ weight + np.log(prior / (1 - prior)), -30, 30)))
        for c, w in ((0, counts * (1 - post)), (1, counts * post)):
            p[c] = np.clip((w @ v + 1) / (w.sum() + 2), 0.001, 0.999)
        prior = float(np.clip((counts @ post) / counts.sum(), 0.005, 0.6))
        corr = np.zeros((N_VOTERS, N_VOTERS))
        for c, w in ((0, counts * (1 - post)), (1, counts * post)):
            r = (v - p[c]) / np.sqrt(p[c] * (1 - p[c]))
            corr += (r * w[:, None]).T @ r / max(w.sum(), 1) / 2
        np.fill_diagonal(corr, 0)
        weight = 1 / (1 + np.clip(corr, 0, 1).sum(1))
    return post


def _dense(rows, n_terms: int) -> np.ndarray:
    x = np.zeros((len(rows), n_terms + 4), np.float32)
    for k, r in enumerate(rows):
        x[k, r["terms"]] = 1 + np.log(r["counts"]) if len(r["terms"]) else 0
        x[k, n_terms : n_terms + 3] = r["extra"]
    x[:, -1] = 1
    return x


def logistic(x: np.ndarray, y: np.ndarray, l2: float = 1e-3, steps: int = 300) -> np.ndarray:
    """Weights by gradient descent with momentum; y may be soft."""
    w = np.zeros(x.shape[1], np.float64)
    m = np.zeros_like(w)
    scale = 4 / max(1e-9, float((x**2).sum(1).mean()))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        m = 0.9 * m + x.T @ (p - y) / len(y) + l2 * w
        w -= 0.3 * scale * m
    return w


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``.

    Null texts are empty; repeated doc_ids are scored row by row.  Without
    labels of both kinds outside the held-out quarter every score is 0.
    """
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    chosen = labels.where(~held_out() & F.col("toxic").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = materialize(sample_by_hash(chosen, "doc_id", LABELLED), "toxic-labels")  # at most LABELLED rows
    lexicon = build_lexicon(d.join(F.broadcast(chosen), "doc_id"))
    table = materialize(features(d, lexicon), "toxic-features")
    n_terms = len(lexicon)
    weights, scale, shift = _fit(table, chosen, n_terms)
    discard(chosen)

    def run(batches):
        for batch in batches:
            rows = batch.to_pylist()
            s = 1 / (1 + np.exp(-np.clip(scale * (_dense(rows, n_terms) @ weights) + shift, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s, pa.float64())], ["doc_id", "score"])

    scored = table.mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def _fit(table: DataFrame, chosen: DataFrame, n_terms: int):
    """Weights of the classifier, fitted to posteriors, and the scale and shift that labels calibrate."""
    names = ("terms", "counts", "extra", "votes")
    known = table.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min(F.struct(*names)).alias("f"))  # one row of each doc_id
    known = known.select("doc_id", "toxic", "f.*").orderBy("doc_id").collect()  # at most LABELLED rows
    y = np.array([r["toxic"] for r in known], float)
    if not len(y) or y.min() == y.max():
        return np.zeros(n_terms + 4), 1.0, -30.0
    found = table.groupBy("votes").count().orderBy("votes").collect()  # at most 2 ** N_VOTERS rows
    patterns, counts = np.array([r["votes"] for r in found]), np.array([r["count"] for r in found], float)
    post = dict(zip(patterns.tolist(), label_model(patterns, counts), strict=True))
    sample = sample_by_hash(table.select("doc_id", *names), "doc_id", FITTED).collect()  # at most FITTED rows, labelled or not: posteriors need no labels
    w = logistic(_dense(sample, n_terms), np.array([post[r["votes"]] for r in sample]))
    z = (_dense(known, n_terms) @ w)[:, None]
    scale, shift = logistic(np.hstack([z, np.ones_like(z)]), y, l2=1e-4, steps=500)
    return w, float(max(scale, 1e-3)), float(shift)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
