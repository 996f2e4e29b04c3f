"""Quality classifier by co-training.

Two views of a document: its text (repetition, symbols, capitals, word
shapes) and its page's record (language, source, recorded length), which never
looks at the text.  Each view has a logistic classifier, first fitted to
labelled rows.  In each round a view gives the other the unlabelled rows, of
the whole corpus, that it is surest of, a share that grows with the rounds and
only where it is CONFIDENT; both are then fitted again by Newton steps whose
sums Spark gathers.  At the end both scores are calibrated on labelled rows
kept aside and combined.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import discard, materialize, read_table, sample_by_hash
from .toxicity import logistic

#: Bound of the fit: labelled rows (smallest hash of doc_id).
LABELLED = 6_000
#: Rounds, share of all unlabelled rows that a view gives more in each, Newton steps a round.
ROUNDS, GIVEN, STEPS = 4, 0.02, 2
CONFIDENT = 0.95
#: What all given rows weigh against all labelled ones, at most.
GIVEN_WEIGHT = 0.5
LANGS, SOURCES = 16, 64
THRESHOLD = 0.5
BINS, SPAN = 2000, 12.0

# Bytes by kind.
_UPPER = bytes(range(65, 91))
_LETTER = bytes(range(97, 123)) + _UPPER + bytes(range(128, 256))
_DIGIT = b"0123456789"
_SYMBOL = b"#$%&*@^~<>{}[]\\=+_|/`"
_MARK = b".,;:!?'\"()-"
_SPACE = b" \t\n\r\x0b\x0c"


def text_view(text: str | None) -> list[float]:
    raw = (text or "").encode()
    n = max(1, len(raw))

    def share(kind: bytes) -> float:
        return (len(raw) - len(raw.translate(None, kind))) / n

    words = raw.lower().split()
    k = max(1, len(words))
    pairs = set(zip(words, words[1:], strict=False))
    tails = raw.translate(None, _LETTER + _DIGIT + b".,")
    lines = [s for s in raw.split(b"\n") if s]
    return [share(_UPPER), share(_LETTER), share(_DIGIT), 10 * share(_SYMBOL), 10 * share(_MARK), 10 * share(b"!"), 10 * share(b"|"), len(set(words)) / k, len(pairs) / max(1, k - 1), len(tails.translate(None, _SPACE)) / k,
            sum(map(len, words)) / k / 10, np.log1p(k) / 10, len(set(lines)) / max(1, len(lines)), (len(set(words)) / k) * np.log1p(k) / 5, float(k < 5), 1.0]


N_TEXT, N_META = 16, LANGS + SOURCES + 4
TEXT, META = "__by_text", "__by_meta"


def features(docs: DataFrame, carried: list[str]) -> DataFrame:
    """The carried columns, the text view, and the record's (bucket of lang, bucket of source, n_chars), a row each."""
    rest = [F.col("text").cast("string"), F.col("lang").cast("string"), F.col("source").cast("string"), F.col("n_chars").cast("double")]
    inputs = docs.select(*carried, *(c.alias(f"__in{k}") for k, c in enumerate(rest)))
    n = len(carried)

    def bucket(value: str | None, buckets: int) -> float:
        return 0.0 if value is None else float(1 + zlib.crc32(value.encode()) % (buckets - 1))

    def run(batches):
        for batch in batches:
            for at in range(0, max(1, batch.num_rows), 500):
                p = batch.slice(at, 500)
                text = np.array([text_view(t) for t in p.column(n).to_pylist()], np.float32).reshape(-1)
                record = zip(*(p.column(n + k).to_pylist() for k in (1, 2, 3)), strict=True)
                meta = np.array([(bucket(lang, LANGS), bucket(source, SOURCES), -1.0 if size is None else size) for lang, source, size in record], np.float32).reshape(-1)
                yield pa.RecordBatch.from_arrays([*(p.column(k) for k in range(n)), _lists(text, N_TEXT), _lists(meta, 3)], [*carried, TEXT, META])

    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in inputs.schema[:n])
    return inputs.mapInArrow(run, f"{kinds}{TEXT} array<float>, {META} array<float>")


def _lists(flat: np.ndarray, width: int) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, width), pa.int32()), pa.array(flat, pa.float32()))


def _views(text, meta) -> tuple[np.ndarray, np.ndarray]:
    """Both views as matrices, from lists of all rows one after the other."""
    x = np.asarray(text, np.float64).reshape(-1, N_TEXT)
    raw = np.asarray(meta, np.float64).reshape(-1, 3)
    m = np.zeros((len(raw), N_META))
    rows = np.arange(len(raw))
    m[rows, raw[:, 0].astype(int)] = 0.5
    m[rows, LANGS + raw[:, 1].astype(int)] = 0.5
    size = np.log1p(np.maximum(raw[:, 2], 0)) / 10
    m[:, -4:] = np.stack([size, size**2, raw[:, 2] < 0, np.ones(len(raw))], 1)
    return x, m


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _newton_sums(x: np.ndarray, y: np.ndarray, w: np.ndarray, weight: float) -> np.ndarray:
    """Gradient, then Hessian, of the weighted log loss."""
    p = _sigmoid(x @ w)
    return weight * np.concatenate([x.T @ (p - y), ((x * (p * (1 - p))[:, None]).T @ x).ravel()])


def _summed(table: DataFrame, fn, width: int) -> np.ndarray:
    """The sum over all rows of ``fn(views) -> array``, added up in Spark."""
    def run(batches):
        total = np.zeros(width)
        for batch in batches:
            total += fn(_views(batch.column(0).flatten().to_numpy(), batch.column(1).flatten().to_numpy()))
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["sums"])

    parts = table.select(TEXT, META).mapInArrow(run, "sums array<double>").select(F.posexplode("sums"))
    out = np.zeros(width)
    for r in parts.groupBy("pos").agg(F.sum("col").alias("s")).collect():  # ``width`` rows
        out[r["pos"]] = r["s"]
    return out


def _cuts(hist: np.ndarray, share: float, prior: float) -> tuple[float, float]:
    """Log odds below and above which a view gives rows: its surest, by class in proportion to the prior, and CONFIDENT."""
    edges = np.linspace(-SPAN, SPAN, BINS + 1)
    total = hist.sum()
    low = edges[int(np.searchsorted(np.cumsum(hist), share * (1 - prior) * total, "right"))]
    high = edges[BINS - int(np.searchsorted(np.cumsum(hist[::-1]), share * prior * total, "right"))]
    sure = np.log(CONFIDENT / (1 - CONFIDENT))
    return min(low, -sure), max(high, sure)


def co_train(free: DataFrame, views: tuple[np.ndarray, np.ndarray], y: np.ndarray):
    """Weights of both views, and (scale of each, shift) of the combination.  ``free``: features of all unlabelled rows."""
    aside = np.arange(len(y)) % 4 == 3
    own, target = [v[~aside] for v in views], y[~aside]
    prior, n = float(target.mean()), (N_TEXT, N_META)
    weights = [logistic(x, target, l2=1e-4) for x in own]
    size = [k + k * k for k in n]
    for r in range(1, ROUNDS + 1):
        given_by = [w.copy() for w in weights]

        def histograms(v, given_by=given_by):
            return np.concatenate([np.histogram(np.clip(x @ w, -SPAN, SPAN), BINS, (-SPAN, SPAN))[0] for x, w in zip(v, given_by, strict=True)])

        hist = _summed(free, histograms, 2 * BINS).reshape(2, BINS)
        if not hist.sum():
            break
        cuts = [_cuts(h, GIVEN * r, prior) for h in hist]
        for _ in range(STEPS):
            def sums(v, given_by=given_by, cuts=cuts, now=tuple(weights)):
                out = []
                for k in (0, 1):  # what view 1 - k is sure of teaches view k
                    z = v[1 - k] @ given_by[1 - k]
                    sure = (z <= cuts[1 - k][0]) | (z >= cuts[1 - k][1])
                    out += [_newton_sums(v[k][sure], (z[sure] > 0).astype(float), now[k], 1.0), [sure.sum()]]
                return np.concatenate(out)

            found = _summed(free, sums, sum(size) + 2)
            at = 0
            for k in (0, 1):
                part, many = found[at : at + size[k]], found[at + size[k]]
                at += size[k] + 1
                total = _newton_sums(own[k], target, weights[k], 1.0) + part * min(1.0, GIVEN_WEIGHT * len(target) / max(many, 1.0))
                g, h = total[: n[k]] + 1e-4 * len(target) * weights[k], total[n[k] :].reshape(n[k], n[k]) + 1e-4 * len(target) * np.eye(n[k])
                step = np.linalg.solve(h, g)
                weights[k] = weights[k] - step * min(1.0, 5.0 / max(1e-9, float(np.abs(step).max())))
    z = np.stack([np.clip(v[aside] @ w, -8, 8) for v, w in zip(views, weights, strict=True)] + [np.ones(aside.sum())], 1)
    return weights, logistic(z, y[aside], l2=1e-3, steps=500)


def _fit(table: DataFrame, labels: DataFrame):
    """``table``: doc_id and features.  None where labels of one kind only, or too few, are known."""
    chosen = labels.where("quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").alias("quality")).where("doc_id is not null")
    chosen = materialize(sample_by_hash(chosen, "doc_id", LABELLED), "quality-labels")  # at most LABELLED rows
    known = table.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.max("quality").alias("quality"), F.min(F.struct(TEXT, META)).alias("f"))
    known = sorted(known.collect(), key=lambda r: zlib.crc32(str(r["doc_id"]).encode()))  # at most LABELLED rows
    y = np.array([r["quality"] for r in known], float)
    if len(y) < 8 or y.min() == y.max() or len(set(y[3::4].tolist())) < 2:
        return None
    views = _views([r["f"][TEXT] for r in known], [r["f"][META] for r in known])
    out = co_train(table.join(F.broadcast(chosen), "doc_id", "left_anti"), views, y)
    discard(chosen)
    return out


def _scored(docs: DataFrame, labels: DataFrame, carried: list[str]) -> DataFrame:
    """The carried columns (doc_id among them) and score, text_score, meta_score of each row."""
    table = materialize(features(docs, carried), "quality-features")
    model = _fit(table.select(F.col("doc_id").cast("long").alias("doc_id"), TEXT, META), labels)
    n = len(carried)

    def run(batches):
        for batch in batches:
            rows = batch.num_rows
            if model:
                zs = [v @ w for v, w in zip(_views(batch.column(n).flatten().to_numpy(), batch.column(n + 1).flatten().to_numpy()), model[0], strict=True)]
                s = _sigmoid(np.clip(zs[0], -8, 8) * model[1][0] + np.clip(zs[1], -8, 8) * model[1][1] + model[1][2])
            else:
                zs, s = [np.full(rows, 30.0)] * 2, np.ones(rows)
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(n)), *(pa.array(v.astype(float), pa.float64()) for v in (s, _sigmoid(zs[0]), _sigmoid(zs[1])))], [*carried, *SCORES])

    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in table.schema[:n])
    return table.select(*carried, TEXT, META).mapInArrow(run, f"{kinds}{', '.join(f'{c} double' for c in SCORES)}")


SCORES = ["__score", "__text_score", "__meta_score"]


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, score (0 to 1: good), text_score, meta_score, rejected for every row.

    Nulls: a null text is empty, null metadata is a kind of its own.  A label
    counts for all rows with its doc_id, of which one is fitted.  Without
    labels of both kinds nothing is rejected (scores 1).
    """
    out = _scored(docs.withColumn("doc_id", F.col("doc_id").cast("long")), labels, ["doc_id"])
    return out.select("doc_id", *(F.col(c).alias(c[2:]) for c in SCORES), (F.col(SCORES[0]) < THRESHOLD).alias("rejected"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that the classifier does not reject; each row goes by its own text and record."""
    return _scored(docs, labels, docs.columns).where(F.col(SCORES[0]) >= THRESHOLD).select(docs.columns)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
