"""Operator 5 - toxicity by averaged subword embeddings and a linear softmax, trained jointly in numpy.

A word is a run of letters, digits and non-ASCII bytes, lower-cased; its vector is the mean of the embeddings of its
padded character 3- to 5-grams and of itself (hashed buckets), so misspellings share most of their vectors.  A window
of WINDOW words is the mean of its words; a softmax over two classes reads it.  A document's score is that of its
highest window (windows overlap by half and cover the whole text), so a few toxic words count in a long text.  Windows
are short, as a toxic word among many others hardly moves their mean.
Embeddings and softmax are learnt together by gradient descent: first all windows carry the document's label, then,
in rounds, only the highest windows of toxic documents stay positive.

For scoring, the softmax difference is multiplied into the embedding table once, which leaves one number per bucket.
Null and empty texts are an empty window: their score is the model's bias.  Repeated rows are scored each.
With no labels of one class every score is 0.  Labelled texts beyond _spark.FIT_BYTES
bytes are scored, but not learnt from.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm import _text as t
from stratum.llm._spark import held, labelled_sample

FIT_ROWS = 2500  # training rows of each class at most
BITS, DIM = 19, 6
BUCKETS = 1 << BITS
FALSE_ALARM = 5  # a clean training document above the cut weighs as much as so many toxic ones below it
WINDOW, STRIDE = 4, 2
BATCH = 1000  # windows of a step
GRAMS = (3, 4, 5)

_INSIDE = np.zeros(256, bool)
_INSIDE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_PLAIN = np.where(_INSIDE, t.LOWER, 32).astype(np.uint8)
_GAP = _PLAIN == 32


def _layout(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased buffer with a blank before every document and at both ends; word starts, ends and document bounds in it."""
    n = len(off) - 1
    out = np.full(len(buf) + n + 2, 32, np.uint8)
    shift = np.repeat(np.arange(n) + 1, np.diff(off))
    out[np.arange(len(buf)) + shift] = _PLAIN[buf]
    starts, ends, bounds = t.words(out, np.append(off[:-1] + np.arange(n), [len(out)]) if n else np.array([0]), _GAP)
    return out, starts, ends, bounds


def _gram_ids(text: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of the k-gram at each position, and whether it lies in one padded word (its inner bytes are no blanks)."""
    wide, n = text.astype(np.uint32), len(text) - k + 1
    h = np.full(n, k, np.uint32)
    for i in range(k):
        h = h * np.uint32(0x01000193) + wide[i : n + i]
    h = (h ^ (h >> np.uint32(16))) * np.uint32(0x7FEB352D)
    ok = np.ones(n, bool)
    for i in range(1, k - 1):
        ok &= text[i : n + i] != 32
    return (h >> np.uint32(32 - BITS)).astype(np.int32), ok


def _word_ids(text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return (t.Spans(text).hash(starts, ends) & np.uint64(BUCKETS - 1)).astype(np.int32)


def word_means(table: np.ndarray, text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For a table of one number per bucket: the mean over each word's subwords."""
    total = table[_word_ids(text, starts, ends)].astype(np.float64)
    count = np.ones(len(starts))
    for k in GRAMS:
        if len(text) < k:
            continue
        ids, ok = _gram_ids(text, k)
        value, number = np.zeros(len(ids) + 1), np.zeros(len(ids) + 1, np.int32)
        np.cumsum(np.where(ok, table[ids], 0), out=value[1:])
        np.cumsum(ok, out=number[1:])
        low, high = np.minimum(starts - 1, len(ids)), np.minimum(ends - 1, len(ids))
        total += value[high] - value[low]
        count += number[high] - number[low]
    return total / count


def windows(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, past word, document bounds of the windows): every document has one window at least."""
    count = np.diff(bounds)
    number = 1 + np.maximum(0, -(-(count - WINDOW) // STRIDE))
    at = np.zeros(len(count) + 1, np.int64)
    np.cumsum(number, out=at[1:])
    first = bounds[:-1].repeat(number) + STRIDE * (np.arange(at[-1]) - at[:-1].repeat(number))
    return first, np.minimum(first + WINDOW, bounds[1:].repeat(number)), at


def _window_means(values: np.ndarray, first: np.ndarray, past: np.ndarray) -> np.ndarray:
    total = np.zeros((len(values) + 1, *values.shape[1:]))
    np.cumsum(values, axis=0, out=total[1:])
    return (total[past] - total[first]) / np.maximum(past - first, 1).reshape(-1, *[1] * (values.ndim - 1))


def fit(texts: list[str], y: np.ndarray, seed: int = 5, rounds: int = 6) -> dict:
    """{"table": softmax difference of each bucket, "bias": of the softmax}."""
    if not len(y) or y.min() == y.max():
        return {"table": np.zeros(BUCKETS, np.float32), "bias": -40.0}
    rng = np.random.default_rng(seed)
    word_of, doc_first, sub_ids, sub_sizes, known = [], [], [], [], {}
    for _, _, buf, off in t.chunks(pa.array(texts, pa.large_string())):
        text, starts, ends, bounds = _layout(buf, off)
        unique, one, back = np.unique(t.Spans(text).hash(starts, ends), return_index=True, return_inverse=True)
        ids, fresh = np.empty(len(unique), np.int32), []
        for n, u in enumerate(unique.tolist()):
            if (w := known.get(u)) is None:
                known[u] = w = len(known)
                fresh.append(n)
            ids[n] = w
        s, e = starts[one[fresh]], ends[one[fresh]]
        own, grams = [np.arange(len(s), dtype=np.int32)], [_word_ids(text, s, e)]
        for k in GRAMS:
            if len(text) < k:
                continue
            gram, ok = _gram_ids(text, k)
            size = np.maximum(e - s + 3 - k, 0)
            pos = np.repeat(s - 1 - (np.cumsum(size) - size), size) + np.arange(size.sum())
            good = (pos < len(gram)) & ok[np.minimum(pos, len(gram) - 1)]
            own.append(np.repeat(own[0], size)[good]), grams.append(gram[pos[good]])
        own = np.concatenate(own)
        sub_ids.append(np.concatenate(grams)[np.argsort(own, kind="stable")])
        sub_sizes.append(np.bincount(own, minlength=len(s)))
        word_of.append(ids[back]), doc_first.append(np.diff(bounds))
    del known
    words = np.concatenate(word_of)
    bounds = np.concatenate([[0], np.cumsum(np.concatenate(doc_first))])
    sub_id, sub_count = np.concatenate(sub_ids), np.concatenate(sub_sizes)
    sub_at = np.concatenate([[0], np.cumsum(sub_count)])
    used, sub_id = np.unique(sub_id, return_inverse=True)  # only these learn; a bucket not met in training says nothing
    sub_id = sub_id.astype(np.int32)
    del word_of, doc_first, sub_ids, sub_sizes
    first, past, at = windows(bounds)
    first, past, owner = first.astype(np.int32), past.astype(np.int32), t.owners(at).astype(np.int32)
    table, softmax, bias = rng.normal(0, 0.1, (len(used), DIM)).astype(np.float32), rng.normal(0, 0.5, DIM), 0.0
    g_table, g_soft, g_bias = np.full((len(used), DIM), 1e-8, np.float32), np.full(DIM, 1e-8), 1e-8

    def logits() -> np.ndarray:
        each = np.add.reduceat((table @ softmax)[sub_id], sub_at[:-1]) / sub_count
        return _window_means(each[words], first, past) + bias

    target, weight = y[owner].astype(np.float32), np.ones(len(owner), np.float32)
    for turn in range(rounds):
        if turn >= 2:  # the highest windows of toxic documents, all of the others
            z = logits()
            top = np.maximum.reduceat(z, at[:-1])[owner]
            target = ((y[owner] == 1) & (z >= top - 0.5)).astype(np.float32)
            weight = np.where(y[owner] == 0, np.float32(1), target)
            hard = (y[owner] == 0) & (z < np.quantile(z, 0.6)) & (rng.random(len(z)) < 0.9)
            weight[hard] = 0
        live = rng.permutation(np.flatnonzero(weight > 0))
        for batch in np.array_split(live, max(1, len(live) // BATCH)):
            size = past[batch] - first[batch]
            pos = np.repeat(first[batch] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
            local, back = np.unique(words[pos], return_inverse=True)
            number = sub_count[local]
            subs = sub_id[np.repeat(sub_at[local] - np.concatenate([[0], np.cumsum(number)[:-1]]), number) + np.arange(number.sum())]
            cut = np.concatenate([[0], np.cumsum(number)[:-1]])
            vec = np.add.reduceat(table[subs], cut, axis=0) / number[:, None]
            part = 1 / np.maximum(size, 1)
            row = np.repeat(np.arange(len(batch)), size)
            mean = np.stack([np.bincount(row, vec[back, d], len(batch)) for d in range(DIM)], 1) * part[:, None]
            e = weight[batch] * (1 / (1 + np.exp(-np.clip(mean @ softmax + bias, -40, 40))) - target[batch]) / weight[batch].sum()
            coef = np.bincount(back, (e * part)[row], len(local)) / number  # gradient of each word's mean, along the softmax
            hit = np.bincount(subs, np.repeat(coef, number), len(used))
            at_once = np.flatnonzero(hit)
            g = hit[at_once, None] * softmax
            soft = mean.T @ e
            g_table[at_once] += g * g
            table[at_once] -= 0.5 * g / np.sqrt(g_table[at_once])
            g_soft += soft * soft
            softmax -= 0.2 * soft / np.sqrt(g_soft)
            g_bias += e.sum() ** 2
            bias -= 0.2 * e.sum() / np.sqrt(g_bias)
    model = {"table": np.zeros(BUCKETS, np.float32), "bias": float(bias)}
    model["table"][used] = table @ softmax
    top = np.maximum.reduceat(logits(), at[:-1])  # the cut between the classes' highest windows goes to 0.5
    cuts = np.quantile(top, np.linspace(0, 1, 2001))
    wrong = [(FALSE_ALARM * ((top >= c) & (y == 0)) + ((top < c) & (y == 1))).mean() for c in cuts]
    best = np.flatnonzero(np.isclose(wrong, min(wrong)))
    model["bias"] -= float(cuts[best].mean()) if len(best) else 0.0
    return model


def score_texts(model: dict, buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    text, starts, ends, bounds = _layout(buf, off)
    first, past, at = windows(bounds)
    z = _window_means(word_means(model["table"], text, starts, ends), first, past) + model["bias"]
    return 1 / (1 + np.exp(-np.clip(np.maximum.reduceat(z, at[:-1]), -40, 40))) if len(z) else z


def toxicity_scores(docs: DataFrame, labels: DataFrame, folds: int = 5, out_fold: int = 0, seed: int = 5) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs(doc_id, text)``; labels of the held-out fold are not used."""
    sample = labelled_sample(docs, labels, "toxic", FIT_ROWS, (folds, out_fold), seed).orderBy("doc_id", "text").toPandas()
    model = docs.sparkSession.sparkContext.broadcast(fit(list(sample["text"]), sample["y"].to_numpy(), seed))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, buf, off in t.chunks(b.column("text")):
                yield pa.record_batch([b.column("doc_id")[i:j], b.column("held_out")[i:j], pa.array(score_texts(model.value, buf, off), pa.float64())], ["doc_id", "held_out", "score"])

    scored = docs.select("doc_id", held(F.col("doc_id"), folds, out_fold).alias("held_out"), "text").mapInArrow(score, f"doc_id {kind}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
