"""Operator 3 - quality rules: base counts, then a calibrated hashed n-gram logistic regression.

Base counts are exact (words are runs of ``[^\\x20\\x09-\\x0D]``).  The model averages hashed weights of lower-cased words
and of character 3- and 5-grams over the whole text, is trained by logistic regression on labelled quality rows and
calibrated to a probability on rows left out of the fit (Platt scaling).  A document is kept if the base rules pass
and the probability reaches KEEP.

Null text counts as empty: it has no words and fails the base rules.  Repeated rows are judged each.  With no labels
of one class the model abstains (probability 0.5 = kept by it).  Labelled texts beyond _spark.FIT_BYTES bytes are judged, but not learnt from.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm import _text as t
from stratum.llm._spark import labelled_sample

FIT_ROWS = 1500  # labelled rows of each class at most
BUCKETS = 1 << 18
KEEP = 0.5
CHUNK_BYTES = 1 << 20
MIN_WORDS, WINDOW, MOST_REPEATED = 20, 8, 30

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_HEAD = (np.arange(256) & 0xC0) != 0x80


def base_counts(buf: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    starts, ends, bounds = t.words(buf, off)
    out = {"n_words": np.diff(bounds), "word_chars": t.per_doc(_HEAD[buf] & ~t.IS_SPACE[buf], off), "n_symbols": t.per_doc(_SYMBOL[buf], off)}
    span = t.Spans(buf)
    line_end = np.zeros(len(buf) + 1, bool)
    line_end[off[1:]] = True
    line_end[:-1] |= buf == 10
    cut = np.flatnonzero(line_end)
    begin = np.zeros(len(cut), np.int64)
    begin[1:] = cut[:-1] + (buf[np.minimum(cut[:-1], len(buf) - 1)] == 10) if len(buf) else 0
    # a newline that ends a document leaves an empty last line; it has no word and never counts
    spoken = np.searchsorted(starts, cut) > np.searchsorted(starts, begin)
    begin, cut = begin[spoken], cut[spoken]
    at = np.searchsorted(begin, off)
    firsts = t.distinct(span.hash(begin, cut), at)[1]
    out["n_dup_lines"] = np.diff(at) - np.diff(firsts)
    h = span.hash(starts, ends)
    count = np.diff(bounds)
    number = np.maximum(count - WINDOW + 1, 0)
    at = np.zeros(len(count) + 1, np.int64)
    np.cumsum(number, out=at[1:])
    first = bounds[:-1].repeat(number) + np.arange(at[-1]) - at[:-1].repeat(number)
    windows, doc = t.Spans(h).hash(first, first + WINDOW), t.owners(at)
    order = np.lexsort((windows, doc))
    same = (windows[order][1:] == windows[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    twice = np.zeros(len(order), bool)
    twice[1:] |= same
    twice[:-1] |= same
    hit = first[order[twice]]
    depth = np.zeros(len(h) + 1, np.int64)
    np.add.at(depth, hit, 1)
    np.add.at(depth, hit + WINDOW, -1)
    out["n_repeat_words"] = t.per_doc(np.cumsum(depth[:-1]) > 0, bounds)
    return out


def _grams(buf: np.ndarray, off: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(bucket ids, document bounds) for words, character 3-grams and character 5-grams."""
    low = t.LOWER[buf]
    starts, ends, bounds = t.words(low, off)
    mask = np.uint64(BUCKETS - 1)
    out = [((t.Spans(low).hash(starts, ends) & mask).astype(np.int32), bounds)]
    wide = low.astype(np.uint32)
    for k, salt in ((3, 0x9E3779B1), (5, 0x85EBCA77)):
        if len(low) < k:
            out.append((np.zeros(0, np.int32), np.zeros(len(off), np.int64)))
            continue
        h = np.zeros(len(low) - k + 1, np.uint32)
        for i in range(k):
            h = h * np.uint32(0x01000193) + wide[i : len(low) - k + 1 + i]
        h = (h ^ (h >> np.uint32(15))) * np.uint32(salt)
        ok = np.ones(len(h), bool)
        for edge in off[1:-1]:
            ok[max(edge - k + 1, 0) : edge] = False
        out.append(((h >> np.uint32(14))[ok].astype(np.int32), np.concatenate([[0], np.cumsum(ok)])[np.minimum(off, len(ok))]))
    return out


def _mean_weight(weights: np.ndarray, grams: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    return sum(t.per_doc(w[ids], at) / np.maximum(np.diff(at), 1) for w, (ids, at) in zip(weights, grams, strict=True))


def fit(texts: list[str], y: np.ndarray, seed: int = 3, rounds: int = 60) -> dict:
    """Weights (3 x BUCKETS), bias and the two numbers of Platt scaling."""
    n = len(y)
    if not n or y.min() == y.max():
        return {"w": np.zeros((3, BUCKETS), np.float32), "bias": 0.0, "platt": (0.0, 0.0)}
    parts: list[list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = [[], [], []]  # kept in chunks, so that a round needs little besides
    for first, _, buf, off in t.chunks(pa.array(texts, pa.large_string()), CHUNK_BYTES):
        for k, (ids, at) in enumerate(_grams(buf, off)):
            size = np.diff(at)
            key, number = np.unique(t.owners(at) * BUCKETS + ids, return_counts=True)  # one entry for each (document, bucket)
            doc = key // BUCKETS
            parts[k].append(((first + doc).astype(np.uint16), (key % BUCKETS).astype(np.int32), (number / np.maximum(size, 1)[doc]).astype(np.float32)))

    def decision() -> np.ndarray:
        return bias + sum(np.bincount(d, v * w[k][i], n) for k, p in enumerate(parts) for d, i, v in p)

    fitted = np.random.default_rng(seed).random(n) < 0.8
    weight = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9)) * fitted
    w, g2, bias, gb = np.zeros((3, BUCKETS), np.float64), np.full((3, BUCKETS), 1e-10), 0.0, 1e-10
    for _ in range(rounds):
        e = weight * (1 / (1 + np.exp(-np.clip(decision(), -40, 40))) - y) / fitted.sum()
        for k, p in enumerate(parts):
            g = sum(np.bincount(i, v * e[d], BUCKETS) for d, i, v in p)
            g2[k] += g * g
            w[k] -= 1.0 * g / np.sqrt(g2[k])
        gb += e.sum() ** 2
        bias -= 0.3 * e.sum() / np.sqrt(gb)
    z = decision()
    rest = ~fitted if 0 < y[~fitted].mean() < 1 else fitted
    a, c = 1.0, 0.0
    zs, mu, sd, target = z[rest], z[rest].mean(), z[rest].std() + 1e-9, np.where(y[rest] == 1, 1 - 1 / (2 + (y[rest] == 1).sum()), 1 / (2 + (y[rest] == 0).sum()))
    for _ in range(2000):
        e = 1 / (1 + np.exp(-np.clip(a * (zs - mu) / sd + c, -40, 40))) - target
        a -= 0.5 * (e * (zs - mu) / sd).mean()
        c -= 0.5 * e.mean()
    return {"w": w.astype(np.float32), "bias": float(bias), "platt": (float(a / sd), float(c - a * mu / sd))}


def probability(model: dict, buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    z = model["bias"] + _mean_weight(model["w"], _grams(buf, off))
    return 1 / (1 + np.exp(-np.clip(model["platt"][0] * z + model["platt"][1], -40, 40)))


def quality_rules(docs: DataFrame, labels: DataFrame, seed: int = 3) -> DataFrame:
    """Every row of ``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, probability, kept.

    All columns of ``docs`` are kept in front; a clashing one gives way to the new column."""
    sample = labelled_sample(docs, labels, "quality", FIT_ROWS, None, seed).orderBy("doc_id", "text").toPandas()
    model = docs.sparkSession.sparkContext.broadcast(fit(list(sample["text"]), sample["y"].to_numpy(), seed))
    new = {"n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long", "n_repeat_words": "long", "base_failed": "boolean", "probability": "double", "kept": "boolean"}
    old = docs.drop(*new)
    names = old.columns

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, buf, off in t.chunks(b.column("text")):
                c = base_counts(buf, off)
                failed = (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > MOST_REPEATED * c["n_words"])
                p = probability(model.value, buf, off)
                yield pa.record_batch([*(b.column(n)[i:j] for n in names), *(pa.array(c[n]) for n in list(new)[:5]), pa.array(failed), pa.array(p), pa.array(~failed & (p >= KEEP))], [*names, *new])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in old.schema), *(f"{k} {v}" for k, v in new.items())])
    return old.mapInArrow(judge, schema)
