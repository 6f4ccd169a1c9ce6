"""Operator 1 - quality by Bradley-Terry pairwise ranking.

Training rows of label 1 are preferred to those of label 0.  Each preference pair contributes a logistic loss on the
difference of the two documents' features, so the model learns a ranking score ``w . f(text)``.  The decision cuts
that score at a quantile of the labelled scores: the share of label 0 among the training rows.  All training rows count: their
features are a table, dealt out to tasks, in which every row is paired with PAIRS_PER_ROW rows of the other class; only sums of
gradients and curvatures (features x features) leave a task in each step of Newton's method.  An id counts once, however many rows
have it: of several texts the one of the least hash is taken, and an id with both labels has none.  The published score
is a logistic map of the ranking score that puts the cut at 0.7.

Features are text statistics only, computed over whole texts in Arrow batches (bounded pieces of a batch at a time).
Null and empty texts have all-zero statistics and are scored like any other row.  Repeated rows are scored each.
With no labels of one class, every document gets score 0.5.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm import _text as t
from stratum.llm._spark import held, labelled, settle, settle_table

TASK_ROWS = 1000  # of the smaller class in a task
PAIRED_ROWS = 4096  # at once
PAIRS_PER_ROW = 20
STEPS, ENOUGH = 30, 1e-6
RIDGE = 1e-4
CUT = 0.7


def _flags(members: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for c in members]] = True
    return out


_SYMBOL = _flags("#*$%&|<>")
_SHOUT = _flags("!")
_STOP = _flags(".,;:?")
_DIGIT = _flags("0123456789")
_UPPER = _flags("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LINE = _flags("\n")
_HEAD = (np.arange(256) & 0xC0) != 0x80  # first byte of a code point


def features(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """One row of text statistics per document."""
    starts, ends, bounds = t.words(buf, off)
    n_words = np.diff(bounds).astype(float)
    chars = t.per_doc(_HEAD[buf], off) + 1e-9
    share = [t.per_doc(table[buf], off) / np.maximum(chars, 1) for table in (_SYMBOL, _SHOUT, _STOP, _DIGIT, _UPPER, _LINE)]
    h = t.Spans(t.LOWER[buf]).hash(starts, ends)
    known, firsts = t.distinct(h, bounds)
    variety = np.diff(firsts) / np.maximum(n_words, 1)
    windows, at = t.shingles(h, bounds, 8)
    seen, first_at = t.distinct(windows, at)
    repeated = 1 - np.diff(first_at) / np.maximum(np.diff(at), 1)
    repeated[np.diff(at) == 0] = 0
    length = t.per_doc((ends - starts), bounds) / np.maximum(n_words, 1)
    closing = _SYMBOL | _SHOUT
    odd_end = t.per_doc(closing[buf[ends - 1]], bounds) / np.maximum(n_words, 1)
    lone = t.per_doc((ends - starts == 1) & _SYMBOL[buf[starts]], bounds) / np.maximum(n_words, 1)
    big = t.per_doc(_UPPER[buf[starts]] & _UPPER[buf[ends - 1 - (_SHOUT[buf[ends - 1]] & (ends - starts > 1))]] & (ends - starts > 3), bounds) / np.maximum(n_words, 1)
    base = np.stack([np.log1p(n_words), *share, variety, repeated, length / 10, odd_end, lone, big], 1)
    return np.concatenate([base, np.sqrt(np.maximum(base[:, 1:], 0)), np.minimum(n_words, 20)[:, None] / 20], 1)


def pairs(x: np.ndarray, y: np.ndarray, seed: int) -> Iterator[np.ndarray]:
    """Differences good - bad, PAIRS_PER_ROW for each row, of as many rows at a time as memory should hold."""
    good, bad = x[y == 1], x[y == 0]
    rng = np.random.default_rng(seed)
    if len(good) and len(bad):
        for i in range(0, len(x), PAIRED_ROWS):
            some, other = np.repeat(x[i : i + PAIRED_ROWS], PAIRS_PER_ROW, 0), np.repeat(y[i : i + PAIRED_ROWS], PAIRS_PER_ROW) == 1
            yield np.where(other[:, None], some - bad[rng.integers(len(bad), size=len(some))], good[rng.integers(len(good), size=len(some))] - some)


def sums(x: np.ndarray, y: np.ndarray, w: np.ndarray, seed: int) -> np.ndarray:
    """Number of pairs, loss, gradient and curvature at ``w``, summed over the pairs, in one row."""
    n, loss, gradient, curve = 0, 0.0, np.zeros(len(w)), np.zeros((len(w), len(w)))
    for d in pairs(x, y, seed):
        z = np.clip(d @ w, -50, 50)
        p = 1 / (1 + np.exp(z))
        n, loss, gradient, curve = n + len(d), loss + np.log1p(np.exp(-z)).sum(), gradient - p @ d, curve + (d * (p * (1 - p))[:, None]).T @ d
    return np.concatenate([[n, loss], gradient, curve.ravel()])


def weights(summed: Callable[[np.ndarray], np.ndarray], features: int) -> np.ndarray:
    """The least mean loss by Newton's method with steps cut until the loss falls; ``summed(w)`` is ``sums`` over all pairs."""

    def at(w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        got = summed(w)
        n = max(got[0], 1)
        return got[1] / n + RIDGE / 2 * w @ w, got[2 : 2 + features] / n + RIDGE * w, got[2 + features :].reshape(features, features) / n + RIDGE * np.eye(features)

    w = np.zeros(features)
    loss, gradient, curve = at(w)
    for _ in range(STEPS):
        if np.abs(gradient).max() < ENOUGH:
            break
        step = -np.linalg.solve(curve, gradient)
        new = at(w + step)
        while new[0] > loss and np.abs(step).max() > 1e-9:
            step = step / 4
            new = at(w + step)
        w, (loss, gradient, curve) = w + step, new
    return w


def _none(features: int) -> dict:
    return {"w": np.zeros(features), "scale": np.ones(features), "cut": 0.0, "slope": 0.0}


def _near(share: float) -> list[float]:
    return [max(share - 0.005, 0.0), share, min(share + 0.005, 1.0)]


def fit(x: np.ndarray, y: np.ndarray, seed: int = 1) -> dict:
    """Bradley-Terry weights, feature scale and the score at the label-0 quantile, of rows at hand."""
    if (y == 1).all() or (y == 0).all():
        return _none(x.shape[1])
    scale = x.std(0) + 1e-3
    w = weights(lambda w: sums(x / scale, y, w, seed), x.shape[1])
    return {"w": w, "scale": scale, "cut": float(np.quantile((x / scale) @ w, _near((y == 0).mean())).mean()), "slope": 1.0}


def learn(rows: DataFrame, features: int, seed: int = 1) -> dict:
    """``fit`` of a table ``rows(doc_id, y, x)``; a task pairs the rows that are dealt to it."""
    number = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}  # two rows
    if len(number) < 2:
        return _none(features)
    scale = np.array(rows.agg(*(F.stddev_pop(F.col("x")[k]) for k in range(features))).first()) + 1e-3
    dealt = settle(rows.repartition(max(1, min(number.values()) // TASK_ROWS), F.xxhash64(F.lit(seed), "doc_id")).sortWithinPartitions("doc_id"))

    def summed(w: np.ndarray) -> np.ndarray:
        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            parts = [(np.array(b.column("x").flatten()).reshape(-1, features) / scale, b.column("y").to_numpy()) for b in batches]
            if parts:
                out = sums(np.concatenate([x for x, _ in parts]), np.concatenate([y for _, y in parts]), w, seed)
                yield pa.record_batch([pa.array(range(len(out)), pa.int32()), pa.array(out)], ["k", "v"])

        return dealt.mapInArrow(each, "k int, v double").groupBy("k").agg(F.sum("v").alias("v")).toPandas().sort_values("k")["v"].to_numpy()  # features squared

    w = weights(summed, features)
    score = sum((F.col("x")[k] * float(w[k] / scale[k]) for k in range(features)), F.lit(0.0))
    cut = dealt.agg(F.percentile_approx(score, F.array(*map(F.lit, _near(number[0] / (number[0] + number[1])))), F.lit(100_000))).first()[0]
    return {"w": w, "scale": scale, "cut": float(sum(cut) / 3), "slope": 1.0}


def apply(model: dict, x: np.ndarray) -> np.ndarray:
    if not model["slope"]:
        return np.full(len(x), 0.5)
    z = (x / model["scale"]) @ model["w"] - model["cut"]
    return 1 / (1 + np.exp(-np.clip(z + np.log(CUT / (1 - CUT)), -40, 40)))


def quality_scores(docs: DataFrame, labels: DataFrame, folds: int = 4, out_fold: int = 2, seed: int = 1) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs(doc_id, text)``; labels of the held-out fold are not used."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, buf, off in t.chunks(b.column("text")):
                part = b.slice(i, j - i)
                yield pa.record_batch([part.column("doc_id"), part.column("held_out"), part.column("h"), pa.array(list(features(buf, off)), pa.list_(pa.float64()))], ["doc_id", "held_out", "h", "x"])

    rows = docs.select("doc_id", held(F.col("doc_id"), folds, out_fold).alias("held_out"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"), "text")
    every = settle_table(rows.mapInArrow(stats, f"doc_id {kind}, held_out boolean, h long, x array<double>"))
    known = labelled(labels, "quality", (folds, out_fold))
    train = every.where("NOT held_out").join(known, "doc_id").groupBy("doc_id", "y").agg(F.min_by("x", "h").alias("x"))
    model = learn(settle(train), features(np.zeros(0, np.uint8), np.zeros(2, np.int64)).shape[1], seed)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array(b.column("x").flatten()).reshape(b.num_rows, -1)
            yield pa.record_batch([b.column("doc_id"), b.column("held_out"), pa.array(apply(model, x))], ["doc_id", "held_out", "score"])

    scored = every.select("doc_id", "held_out", "x").mapInArrow(score, f"doc_id {kind}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= CUT).cast("int"))
