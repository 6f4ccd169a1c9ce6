"""Operator 10 - benchmark decontamination by size-partitioned MinHash containment search.

Words are ``[^\\x20\\x09-\\x0D]+`` runs, A-Z lower-cased; an item and a document are sets of five-word shingles.  An item with
1 to 4 words is one shingle of its whole length, looked for as a word sequence of that length.  A document leaks an
item if it contains at least THRESHOLD of the item's distinct shingles.

Items are partitioned by their number of words per shingle and by size, in classes of q up to 2, 4, 8, ... shingles.  A class has its
own index: the signatures of its items and the least number of shingles that a document needs to leak any of them; documents
with fewer are skipped before their hashes are looked up.  The signature of an item of q shingles is its bottom-k MinHash,
the k least shingle hashes, with k = q - ceil(THRESHOLD * q) + 1: a document that holds enough of the item must hold one of
them, however long the document is, so the search misses nothing.  Documents whose shingles meet a signature are candidates;
for these the shared shingles are counted exactly.

The benchmark's hashes are broadcast if there are at most BROADCAST_HASHES of them (80 MB with their tables); beyond that the
documents' hashed shingles are joined to them by a shuffle, salted SALTS times as a shingle may stand in a third of all documents.
Both ways give the same rows.  Shingles are 62-bit hashes.  Items without words match nothing.  Null texts count as empty.
Repeated items and repeated documents are reported each; there are no ties.  Empty tables give an empty result; extra columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm import _text as t
from stratum.llm._spark import fresh, settle_table

THRESHOLD = Fraction(8, 10)
WORDS = 5
BROADCAST_HASHES = 1_000_000
TABLE_BITS = 23  # of the largest bit table of a class
SALTS = 8


def need(q: np.ndarray) -> np.ndarray:
    """Shingles of an item of q that make it leak: ceil(THRESHOLD * q)."""
    return -(-(q * THRESHOLD.numerator) // THRESHOLD.denominator)


def doc_shingles(buf: np.ndarray, off: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of runs of exactly k words, by document.  The word count is part of the hash."""
    low = t.LOWER[buf]
    starts, ends, bounds = t.words(low, off)
    h, at = t.shingles(t.Spans(low).hash(starts, ends), bounds, k)
    if (short := np.diff(bounds) < k).any():
        keep = ~short[t.owners(at)]
        h, at = h[keep], np.concatenate([[0], np.cumsum(np.where(short, 0, np.diff(at)))])
    return h, at


def size_class(q: np.ndarray) -> np.ndarray:
    """0 for one shingle, 1 for two, 2 up to four, 3 up to eight, ..."""
    return np.ceil(np.log2(np.maximum(q, 1))).astype(np.int64)


def item_rows(items: DataFrame) -> DataFrame:
    """(h, k, q, need, signature, item_id, item) of each distinct shingle of each item; ``item`` numbers the rows of ``items``.

    The numbers are stored with the rows, so they stay what they are however often they are read."""
    kind = items.schema["item_id"].dataType.simpleString()
    numbered = settle_table(items.select("item_id", "text", F.monotonically_increasing_id().alias("item")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, buf, off in t.chunks(b.column("text")):
                low = t.LOWER[buf]
                starts, ends, bounds = t.words(low, off)
                number = np.minimum(np.diff(bounds), WORDS)
                h, at = t.distinct(*t.shingles(t.Spans(low).hash(starts, ends), bounds, WORDS))
                own, q = t.owners(at), np.diff(at)
                place = np.arange(len(h)) - at[own]  # hashes are sorted: the place is the MinHash rank
                some = pa.array(own)
                yield pa.record_batch([pa.array(h.view(np.int64)), pa.array(number[own].astype(np.int32)), pa.array(q[own].astype(np.int64)), pa.array(need(q)[own].astype(np.int64)), pa.array(place <= (q - need(q))[own]), b.column("item_id")[i:j].take(some), b.column("item")[i:j].take(some)], ["h", "k", "q", "need", "signature", "item_id", "item"])

    return numbered.mapInArrow(cut, f"h long, k int, q long, need long, signature boolean, item_id {kind}, item long")


def _index(rows: DataFrame, broadcast_hashes: int) -> tuple | None:
    """The search tables of each (words, size class), or None if the benchmark has more hashes than may be broadcast."""
    if rows.select("h").limit(broadcast_hashes + 1).count() > broadcast_hashes:
        return None
    found = rows.select("h", "k", "signature", "item").toPandas()
    every = rows.select("item", "item_id", "q", "need").distinct().orderBy("item").toArrow()
    q, least = (every.column(c).to_numpy().astype(np.int64) for c in ("q", "need"))
    item = np.searchsorted(every.column("item").to_numpy(), found["item"].to_numpy(np.int64))
    hashes, k, signature = found["h"].to_numpy(np.int64).view(np.uint64), found["k"].to_numpy(np.int64), found["signature"].to_numpy(bool)
    part = k * 64 + size_class(q[item])
    tables = [(int(p) // 64, int(least[item[part == p]].min()), _table(hashes[part == p], item[part == p], signature[part == p])) for p in np.unique(part)]
    return tables, q, least, every.column("item_id").combine_chunks()


def _search(index: tuple, buf: np.ndarray, off: np.ndarray) -> list[np.ndarray]:
    """[document, item, shared shingles] of the leaks in a chunk."""
    tables, _, least, _ = index
    found, shingles = [], {}
    for words, needed, table in tables:
        if words not in shingles:
            shingles[words] = doc_shingles(buf, off, words)
        h, at = shingles[words]
        if (small := np.diff(at) < needed).any():  # too short for every item of the class
            keep = ~small[t.owners(at)]
            h, at = h[keep], np.concatenate([[0], np.cumsum(np.where(small, 0, np.diff(at)))])
        found.append(_shared(table, least, h, at))
    return [np.concatenate([p[x] for p in found]) if found else np.zeros(0, np.int64) for x in range(3)]


def leaks(docs: DataFrame, items: DataFrame, broadcast_hashes: int = BROADCAST_HASHES) -> DataFrame:
    """(doc_id, item_id, n_item, n_shared, containment) of each document and item that it leaks."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = item_rows(items)
    found = _index(rows, broadcast_hashes)
    if found is None:
        numbered = settle_table(docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row")))
        return numbered.select("row", "doc_id").join(_by_shuffle(numbered, rows), "row").drop("row")
    index = docs.sparkSession.sparkContext.broadcast(found)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, q, _, ids = index.value
        for b in batches:
            for i, _, buf, off in t.chunks(b.column("text")):
                doc, item, shared = _search(index.value, buf, off)
                yield pa.record_batch([b.column("doc_id").take(pa.array(i + doc)), ids.take(pa.array(item)), pa.array(q[item]), pa.array(shared), pa.array(shared / np.maximum(q[item], 1))], ["doc_id", "item_id", "n_item", "n_shared", "containment"])

    return docs.select("doc_id", "text").mapInArrow(search, f"doc_id {kind}, item_id {items.schema['item_id'].dataType.simpleString()}, n_item long, n_shared long, containment double")


def clean(docs: DataFrame, items: DataFrame, broadcast_hashes: int = BROADCAST_HASHES) -> DataFrame:
    """The rows of ``docs`` that leak no item, with all their columns."""
    rows = item_rows(items)
    found = _index(rows, broadcast_hashes)
    if found is None:
        (mark,) = fresh(docs, "leak_row")
        marked = settle_table(docs.withColumn(mark, F.monotonically_increasing_id()))
        leaky = _by_shuffle(marked.select(F.col(mark).alias("row"), "text"), rows).select(F.col("row").alias(mark)).distinct()
        return marked.join(leaky, mark, "left_anti").drop(mark)
    index = docs.sparkSession.sparkContext.broadcast(found)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            leaky = np.zeros(b.num_rows, bool)
            for i, _, buf, off in t.chunks(b.column("text")):
                leaky[i + _search(index.value, buf, off)[0]] = True
            yield b.filter(pa.array(~leaky))

    return docs.mapInArrow(search, docs.schema)


def _table(hashes: np.ndarray, item: np.ndarray, signature: np.ndarray) -> tuple:
    """Sorted hashes with their items, the signature hashes, and a bit table that passes few foreign hashes."""
    order = np.argsort(hashes, kind="stable")
    bits = min(max(16, int(len(hashes) * 64).bit_length()), TABLE_BITS)
    seen = np.zeros(1 << bits, bool)
    marked = np.unique(hashes[signature])
    seen[marked >> np.uint64(64 - bits)] = True
    return hashes[order], item[order], marked, seen, bits


def _shared(table: tuple, least: np.ndarray, h: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, item, shared shingles) of the leaks in a chunk of documents."""
    hashes, item, marked, seen, bits = table
    own = t.owners(at)
    hit = np.flatnonzero(seen[h >> np.uint64(64 - bits)])
    place = np.minimum(np.searchsorted(marked, h[hit]), len(marked) - 1)
    candidates = np.zeros(len(at) - 1, bool)
    candidates[own[hit[marked[place] == h[hit]]]] = True  # these documents hold a MinHash of some item
    rest = np.flatnonzero(candidates[own])
    h, at2 = t.distinct(h[rest], np.searchsorted(own[rest], np.arange(len(at))))
    own = t.owners(at2)
    low, high = np.searchsorted(hashes, h), np.searchsorted(hashes, h, "right")
    number = high - low
    doc = np.repeat(own, number)
    which = item[np.repeat(low - np.concatenate([[0], np.cumsum(number)[:-1]]), number) + np.arange(number.sum())] if number.sum() else np.zeros(0, np.int64)
    key, shared = np.unique(doc * len(least) + which, return_counts=True) if len(doc) else (np.zeros(0, np.int64),) * 2
    doc, which = key // max(len(least), 1), key % max(len(least), 1)
    enough = shared >= least[which] if len(which) else np.zeros(0, bool)
    return doc[enough], which[enough], shared[enough]


def _by_shuffle(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """(row, item_id, n_item, n_shared, containment) for a benchmark of any size and stored ``docs(row, text)``: documents' hashes meet the
    signatures, then those of the candidates alone the items."""
    lengths = tuple(r["k"] for r in rows.select("k").distinct().collect())  # at most WORDS values

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, buf, off in t.chunks(b.column("text")):
                for n in lengths:
                    h, at = t.distinct(*doc_shingles(buf, off, n))
                    own = t.owners(at)
                    yield pa.record_batch([b.column("row")[i:j].take(pa.array(own)), pa.array(h.view(np.int64)), pa.array(np.full(len(h), n, np.int32)), pa.array(np.diff(at)[own])], ["row", "h", "k", "n"])

    def met(texts: DataFrame, items: DataFrame) -> DataFrame:
        """Shingles of both, those of a document with too few for the item left out; salted, as one may stand in very many documents."""
        cuts = texts.select("row", "text").mapInArrow(cut, "row long, h long, k int, n long").withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)))
        salts = F.explode(F.expr(f"sequence(0L, {SALTS - 1}L)")).alias("salt")
        return cuts.join(items.select("*", salts), ["h", "k", "salt"]).where("n >= need")

    pairs = settle_table(met(docs, rows.where("signature").select("h", "k", "need", "item")).select("row", "item").distinct())
    candidates = docs.join(pairs.select("row").distinct(), "row", "left_semi")
    shared = met(candidates, rows.drop("signature")).join(pairs, ["row", "item"])
    found = shared.groupBy("row", "item", "item_id", "q", "need").agg(F.count("*").alias("n_shared")).where("n_shared >= need")
    return found.select("row", "item_id", F.col("q").alias("n_item"), "n_shared", (F.col("n_shared") / F.col("q")).alias("containment"))
