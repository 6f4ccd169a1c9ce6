"""Operator 9 - language identification by cross-parsing entropy.

For each language a suffix automaton recognises every substring of a bounded sample of labelled text.  A text is
parsed greedily into the longest phrases that occur in the sample; a language costs phrases * log2(sample size) bits
per character, and the cheapest language wins.  Texts are lower-cased, runs of non-letters become one blank, and the
whole text is parsed, in segments of SEGMENT symbols that run side by side in numpy (a segment starts a new phrase in
every language alike).  The score is the winner's share of exp(-bits) over the languages, on a scale of at most
EVIDENCE characters.

Fitting: of the LANGUAGES languages with the most documents (ties: the first in code-point order), DOCS documents each, fewer where
ROWS doesn't allow so many but one at least, by the least seeded hash of the id, and SYMBOLS symbols in all languages
together (never more than PER_LANGUAGE each, a quarter of that of one document).  So the sample, which is cut on the executors,
and the broadcast tables are bounded.  Null texts and texts without a letter are `und` with score 0, and so is everything if
there is no labelled row.  Ties go to the language first in code-point order; repeated rows are predicted each; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm import _text as t
from stratum.llm._spark import held

LANGUAGES, ROWS, DOCS, PER_LANGUAGE, SYMBOLS = 2000, 12_000, 64, 24_000, 1_200_000
SEGMENT = 1024
EVIDENCE = 64


def _letter_bytes() -> np.ndarray:
    out = np.zeros(256, bool)
    out[[*range(97, 123), *range(128, 256)]] = True
    return out


_LETTER = _letter_bytes()


def symbols(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased letters' bytes with one blank (32) for every run of other bytes but a leading one, and document bounds."""
    plain = np.where(_LETTER[buf], buf, 32).astype(np.uint8)
    keep = plain != 32
    after = np.zeros(len(buf) + 1, bool)
    after[1:] = keep
    after[off] = False  # a document begins anew: what stands before it in the batch has no part in it
    keep |= after[:-1]
    return plain[keep], np.concatenate([[0], np.cumsum(keep)])[off]


def automaton(text: bytes) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of ``text``; state 0 is the root."""
    step: list[dict[int, int]] = [{}]
    link, size, last = [-1], [0], 0
    for c in text:
        now = len(step)
        step.append({}), link.append(0), size.append(size[last] + 1)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = now
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if size[p] + 1 == size[q]:
                link[now] = q
            else:
                copy = len(step)
                step.append(dict(step[q])), link.append(link[q]), size.append(size[p] + 1)
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = copy
                    p = link[p]
                link[q] = link[now] = copy
        last = now
    return step


def fit(rows: list[tuple[str, bytes]]) -> dict:
    """From (language, symbols): languages, class of each byte, one transition table for all, and bits a phrase."""
    by: dict[str, list[bytes]] = {}
    for lang, text in rows:
        by.setdefault(lang, []).append(bytes(text))
    names = sorted(by, key=lambda x: x.encode())
    most = min(PER_LANGUAGE, SYMBOLS // max(len(names), 1))
    samples = [b" ".join(sorted(by[name], key=len))[:most] + b" " for name in names]
    classes = np.zeros(256, np.uint8)  # 0: a symbol no sample has
    seen = sorted(set(b"".join(samples)))
    classes[seen] = np.arange(1, len(seen) + 1)
    tables, base = [], []
    for sample in samples:
        states = automaton(sample)
        at = sum(len(x) for x in tables)
        table = np.zeros((len(states), len(seen) + 1), np.int32)
        for s, row in enumerate(states):
            for c, to in row.items():
                table[s, classes[c]] = at + to
        tables.append(table)
        base.append(at)
    return {"names": names, "classes": classes, "table": np.concatenate(tables) if tables else np.zeros((1, 1), np.int32), "base": np.array(base, np.int32), "bits": np.log2([max(len(s), 2) for s in samples])}


def phrases(model: dict, sym: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Number of phrases of each document in each language."""
    number = -(-np.diff(at) // SEGMENT)
    doc = np.repeat(np.arange(len(number)), number)
    first = at[:-1].repeat(number) + SEGMENT * (np.arange(len(doc)) - np.repeat(np.cumsum(number) - number, number))
    size = np.minimum(first + SEGMENT, at[1:].repeat(number)) - first
    order = np.argsort(-size, kind="stable")
    first, size, doc = first[order], size[order], doc[order]
    cls, flat, base, n = model["classes"][sym].astype(np.int32), model["table"].ravel(), model["base"], model["table"].shape[1]
    langs = len(base)
    count = np.ones((langs, len(first)), np.int32)
    state = np.repeat(base[:, None], len(first), 1)
    active = np.searchsorted(-size, -np.arange(size[0] if len(size) else 0), "left")
    for i, live in enumerate(active):  # the lanes still running come first
        c = cls[first[:live] + i]
        to = flat[state[:, :live] * n + c]
        ended = to == 0
        restart = flat[base[:, None] * n + c]
        restart += (restart == 0) * base[:, None]
        np.copyto(to, restart, where=ended)
        count[:, :live] += ended
        state[:, :live] = to
    return np.stack([np.bincount(doc, count[k], len(number)) for k in range(langs)], 1)


def predict(model: dict, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the language, score) of each lower-cased document."""
    sym, at = symbols(buf, off)
    bits = phrases(model, sym, at) * model["bits"] / np.maximum(np.diff(at), 1)[:, None]
    best = bits.argmin(1)
    gap = (bits - bits.min(1, keepdims=True)) * np.minimum(np.diff(at), EVIDENCE)[:, None]
    return best, 1 / np.exp(-np.minimum(gap, 60)).sum(1)


def languages(docs: DataFrame, folds: int = 4, out_fold: int = 2, seed: int = 9) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row of ``docs(doc_id, text, lang)``; the held-out fold is not learnt from."""
    out = held(F.col("doc_id"), folds, out_fold)
    h = F.xxhash64(F.lit(seed), "doc_id")
    known = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull() & ~out)
    learnt = known.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES).select("lang")
    number = max(1, learnt.count())
    each, most = max(1, min(DOCS, ROWS // number)), min(PER_LANGUAGE, SYMBOLS // number)
    slots = known.join(F.broadcast(learnt), "lang").groupBy("lang", F.pmod(h, F.lit(each)).alias("slot"))  # at most ROWS of them, or one for each language
    ids = slots.agg(F.min(F.struct(h.alias("h"), "doc_id")).alias("pick")).select("lang", F.col("pick.doc_id").alias("doc_id"))

    def cut_symbols(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, buf, off in t.chunks(b.column("text")):
                sym, at = symbols(buf, off)
                yield pa.record_batch([b.column("lang")[i:j], pa.array([sym[x : min(y, x + max(most // 4, 1))].tobytes() for x, y in zip(at[:-1], at[1:], strict=True)], pa.binary())], ["lang", "symbols"])

    sample = docs.select("doc_id", "lang", F.lower("text").alias("text")).join(F.broadcast(ids), ["doc_id", "lang"], "left_semi")
    sample = sample.groupBy("doc_id", "lang").agg(F.min_by("text", F.xxhash64("text")).alias("text"))  # of rows with one id, one
    rows = sample.select("lang", "text").mapInArrow(cut_symbols, "lang string, symbols binary").orderBy("lang", "symbols").toPandas()
    model = docs.sparkSession.sparkContext.broadcast(fit(list(rows.itertuples(index=False, name=None))))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for b in batches:
            for i, j, buf, off in t.chunks(b.column("text"), 2 * t.CHUNK_BYTES):
                spoken = np.asarray(b.column("spoken")[i:j].to_numpy(zero_copy_only=False), bool) & bool(m["names"])
                best, score = predict(m, buf, off) if m["names"] else (np.zeros(j - i, int), np.zeros(j - i))
                names = pa.array([*m["names"], "und"]).take(pa.array(np.where(spoken, best, len(m["names"]))))
                yield pa.record_batch([b.column("doc_id")[i:j], b.column("held_out")[i:j], names, pa.array(np.where(spoken, score, 0.0))], ["doc_id", "held_out", "lang_pred", "score"])

    cut = docs.select("doc_id", out.alias("held_out"), F.lower("text").alias("text"), F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("spoken"))
    return cut.mapInArrow(tell, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
