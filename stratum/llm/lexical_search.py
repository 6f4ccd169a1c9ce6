"""Operator 11 - ranked lexical search: document-at-a-time merges over compressed postings of shards, then one global merge.

A term is a maximal run of ASCII letters, digits and other characters beyond ASCII, A-Z lower-cased.  ``index`` turns documents
into shards of about SHARD_BYTES of text, wherever the rows lie: no text is shuffled.  A shard has its documents in the order
of doc_id, its terms, and for each term the gaps of its documents and the term's count in each as variable-length bytes.  Every row of
the table is in the index.

``search`` ranks all documents for every item.  Sums over the shards give the number of documents and terms; the documents of each query
term are counted by an aggregation over the shards' term lists.  A shard decodes the lists of the query terms that it has; for an item, a
heap holds the lists by the document that each stands at.  The merge takes the least, and with it all lists that stand within the next WINDOW
documents; when the heap has passed a window, the scores of its documents are whole and those that beat the worst of the item's best k
enter a heap keyed by score and doc_id.  This heap goes along through all shards of a task, so a task returns k rows an item at most, and
one ranking of these by item gives the result.

Query terms are sent to the tasks in blocks of about BLOCK_TERMS entries, one after another; an item is never split.  Scores are integers
but for the term's weight, so results do not depend on how rows lie in shards.  Terms of a shard are compared byte by byte.

Ties go to the smaller doc_id; null ids come last.  Repeated rows are documents of their own; repeated items are ranked each.  Null and empty
texts hold no term: such documents are in no list, such items have no rows.  Very long texts are shards of their own.  Extra columns are not
read; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratum.llm import _text as t
from stratum.llm._spark import settle_table

TOP = 20
SHARD_BYTES = 4 << 20
WINDOW = 1024  # documents
BLOCK_TERMS = 500_000
NOT_TERM = np.zeros(256, bool)
for _low, _high in ((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)):
    NOT_TERM[_low : _high + 1] = True

SHARD = "ids array<bigint>, sizes array<bigint>, n_docs bigint, n_terms bigint, terms array<string>, df array<int>, ends array<bigint>, postings binary"


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, past byte of each): seven bits a byte, the top bit says that more follow."""
    v = values.astype(np.uint64)
    number = np.ones(len(v), np.int64)
    for k in range(1, 10):
        number += v >= np.uint64(1 << 7 * k)
    ends = np.cumsum(number)
    out = np.zeros(int(ends[-1]) if len(v) else 0, np.uint8)
    for k in range(int(number.max()) if len(v) else 0):
        who = np.flatnonzero(number > k)
        more = np.where(number[who] > k + 1, 128, 0).astype(np.uint8)
        out[ends[who] - number[who] + k] = ((v[who] >> np.uint64(7 * k)) & np.uint64(127)).astype(np.uint8) | more
    return out, ends


def unpack(data: np.ndarray) -> np.ndarray:
    """What ``pack`` packed."""
    if not len(data):
        return np.zeros(0, np.int64)
    last = np.flatnonzero(data < 128)
    first = np.concatenate([[0], last[:-1] + 1])
    place = np.arange(len(data)) - np.repeat(first, last - first + 1)
    return np.add.reduceat((data & 127).astype(np.int64) << (7 * place), first)


def groups(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of each span's text, a span of each text): spans with equal bytes have one number.

    Spans are grouped by hash and each is compared with the first of its group; a clash makes all be compared as they are."""
    _, first, number = np.unique(t.Spans(buf).hash(start, end), return_index=True, return_inverse=True)
    size, other = end - start, first[number]
    if (size == size[other]).all():
        step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        if (buf[np.repeat(start, size) + step] == buf[np.repeat(start[other], size) + step]).all():
            return number, first
    known: dict[bytes, int] = {}
    number = np.array([known.setdefault(buf[a:b].tobytes(), len(known)) for a, b in zip(start, end, strict=True)])
    return number, np.unique(number, return_index=True)[1]


def terms_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(lower-cased bytes, starts, ends, bounds by text) of the terms."""
    buf, off = t.raw(column)
    low = t.LOWER[buf]
    return low, *t.words(low, off, NOT_TERM)


def make_shard(rows: pa.Table) -> pa.RecordBatch:
    """One row of SHARD for ``rows(doc_id, text)``."""
    rows = rows.take(pc.sort_indices(rows.column("doc_id"), null_placement="at_end")).combine_chunks()
    low, start, end, bounds = terms_of(rows.column("text"))
    number, first = groups(low, start, end)
    size = np.diff(bounds)
    order = np.argsort(number, kind="stable")  # documents stay in order within a term
    term, doc = number[order], t.owners(bounds)[order]
    head = np.ones(len(order), bool)
    head[1:] = (term[1:] != term[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(head)
    tf = np.diff(np.append(at, len(order)))
    term, doc = term[at], doc[at]
    gap = doc.copy()
    gap[1:] -= np.where(term[1:] == term[:-1], doc[:-1], 0)
    data, ends = pack(np.stack([gap, tf], 1).ravel())
    df = np.bincount(term, minlength=len(first))
    text = t.strings(*t.take_spans(low, start[first], end[first]))
    past = ends[2 * np.cumsum(df) - 1] if len(df) else np.zeros(0, np.int64)
    one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
    ids = rows.column("doc_id").combine_chunks() if isinstance(rows.column("doc_id"), pa.ChunkedArray) else rows.column("doc_id")
    return pa.record_batch([one(ids), one(pa.array(size)), pa.array([int((size > 0).sum())]), pa.array([int(size.sum())]), one(text), one(pa.array(df.astype(np.int32))), one(pa.array(past)), pa.array([data.tobytes()])], ["ids", "sizes", "n_docs", "n_terms", "terms", "df", "ends", "postings"])


def index(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Shards of all rows of ``docs(doc_id, text)``, not yet stored."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            for i, j, buf, _ in t.chunks(b.column("text"), shard_bytes // 4):
                if held and size + len(buf) > shard_bytes:
                    yield make_shard(pa.Table.from_batches(held))
                    held, size = [], 0
                held.append(b.slice(i, j - i))
                size += len(buf)
        if held:
            yield make_shard(pa.Table.from_batches(held))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(build, SHARD)


def item_terms(items: DataFrame) -> DataFrame:
    """(item, item_id, term, times) of every row of ``items``, numbered; the numbers are stored with the rows."""
    kind = items.schema["item_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            low, start, end, bounds = terms_of(b.column("text"))
            number, first = groups(low, start, end)
            key, times = np.unique(t.owners(bounds) * max(len(first), 1) + number, return_counts=True)
            row, term = pa.array(key // max(len(first), 1)), pa.array(key % max(len(first), 1))
            yield pa.record_batch([b.column("item").take(row), b.column("item_id").take(row), t.strings(*t.take_spans(low, start[first], end[first])).take(term), pa.array(times)], ["item", "item_id", "term", "times"])

    numbered = items.select(F.monotonically_increasing_id().alias("item"), "item_id", "text")
    return settle_table(numbered.mapInArrow(cut, f"item long, item_id {kind}, term string, times long"))


def best_of(lists: list[tuple[np.ndarray, np.ndarray]], ids: np.ndarray, known: np.ndarray, best: list, top: int) -> None:
    """Enter the documents of the ``lists`` of (documents, gains) into ``best``, a heap of at most ``top`` (score, has an id, -id)."""
    heads = [(int(docs[0]), i) for i, (docs, _) in enumerate(lists)]
    heapq.heapify(heads)
    at = [0] * len(lists)
    while heads:
        low = heads[0][0]
        score = np.zeros(WINDOW, np.int64)
        while heads and heads[0][0] < low + WINDOW:
            _, i = heapq.heappop(heads)
            docs, gain = lists[i]
            past = at[i] + int(np.searchsorted(docs[at[i] :], low + WINDOW))
            score[docs[at[i] : past] - low] += gain[at[i] : past]
            at[i] = past
            if past < len(docs):
                heapq.heappush(heads, (int(docs[past]), i))
        hits = np.flatnonzero(score >= (best[0][0] if len(best) == top else 1))
        if len(hits) > top:  # documents are in the order of ids: of equal ones the first
            hits = hits[np.argsort(-score[hits], kind="stable")[:top]]
        for d in hits:
            key = (int(score[d]), bool(known[low + d]), -int(ids[low + d]))
            if len(best) < top:
                heapq.heappush(best, key)
            else:
                heapq.heappushpop(best, key)


def _gains(shard: pa.RecordBatch, vocabulary: pa.Array, n_docs: int, n_terms: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For each term of ``vocabulary`` that the shard (one row) has: its documents and what a weight of one gains in each."""
    size = shard.column("sizes").flatten().to_numpy()
    m = 75 + 25 * size * n_docs // max(n_terms, 1)
    place = pc.index_in(vocabulary, shard.column("terms").flatten())
    ends, data = shard.column("ends").flatten().to_numpy(), np.frombuffer(shard.column("postings")[0].as_buffer(), np.uint8)
    out = {}
    for q in np.flatnonzero(pc.is_valid(place).to_numpy(zero_copy_only=False)):
        k = place[int(q)].as_py()
        pairs = unpack(data[ends[k - 1] if k else 0 : ends[k]])
        docs, tf = np.cumsum(pairs[::2]), pairs[1::2]
        out[int(q)] = docs, 1_000_000_000 * tf // (1000 * tf + 12 * m[docs])
    return out


def _ranked(shards: DataFrame, weighted: DataFrame, top: int, n_docs: int, n_terms: int) -> DataFrame:
    """(item, item_id, doc_id, score): the best of each task for the items of ``weighted(item, item_id, term, weight)``, which goes to all tasks."""
    q = weighted.orderBy("item").toArrow().combine_chunks()  # of one block
    coded = pc.dictionary_encode(q.column("term")).combine_chunks() if q.num_rows else pa.array([], pa.string()).dictionary_encode()
    item = q.column("item").to_numpy()
    first = np.flatnonzero(np.concatenate([[True], item[1:] != item[:-1]])) if len(item) else np.zeros(0, np.int64)
    sent = shards.sparkSession.sparkContext.broadcast((coded.dictionary, coded.indices.to_numpy(), q.column("weight").to_numpy(), np.append(first, len(item)), item[first], q.column("item_id").take(pa.array(first)).combine_chunks()))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, term, weight, edge, number, names = sent.value
        best: list[list] = [[] for _ in number]
        for b in batches:
            for r in range(b.num_rows):
                shard = b.slice(r, 1)
                gains = _gains(shard, vocabulary, n_docs, n_terms)
                ids = shard.column("ids").flatten()
                known, ids = pc.is_valid(ids).to_numpy(zero_copy_only=False), pc.fill_null(ids, 0).to_numpy()
                for i in range(len(number)):
                    lists = [(gains[k][0], weight[e] * gains[k][1]) for e in range(edge[i], edge[i + 1]) if (k := int(term[e])) in gains]
                    best_of(lists, ids, known, best[i], top)
        for i, heap in enumerate(best):
            if heap:
                some = pa.array(np.full(len(heap), i))
                yield pa.record_batch([pa.array(number).take(some), names.take(some), pa.array([-d if has else None for _, has, d in heap], pa.int64()), pa.array([s for s, _, _ in heap], pa.int64())], ["item", "item_id", "doc_id", "score"])

    kind = weighted.schema["item_id"].dataType.simpleString()
    return shards.mapInArrow(merge, f"item long, item_id {kind}, doc_id long, score long")


def search(shards: DataFrame, items: DataFrame, top: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score) of the ``top`` documents of every item over the stored ``shards``."""
    query = item_terms(items)
    n_docs, n_terms = (x or 0 for x in shards.agg(F.sum("n_docs"), F.sum("n_terms")).first())
    listed = shards.select(F.explode(F.arrays_zip("terms", "df")).alias("x")).select(F.col("x.terms").alias("term"), F.col("x.df").alias("df"))
    df = listed.join(query.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(F.lit(1000.0) * F.log(F.lit(float(2 * n_docs + 2)) / (2 * F.col("df") + 1)))
    weighted = query.join(df, "term").select("item", "item_id", "term", (F.col("times") * weight).alias("weight"))
    blocks = max(1, -(-query.count() // block_terms))
    if blocks == 1:
        found = _ranked(shards, weighted, top, n_docs, n_terms)
    else:
        dealt = settle_table(weighted.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks))))
        parts = [settle_table(_ranked(shards, dealt.where(F.col("block") == k).drop("block"), top, n_docs, n_terms)) for k in range(blocks)]
        found = reduce(DataFrame.unionByName, parts)
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")


def ranked(docs: DataFrame, items: DataFrame, top: int = TOP, shard_bytes: int = SHARD_BYTES, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """Index ``docs``, store the index in the shared folder, and search it."""
    return search(settle_table(index(docs, shard_bytes)), items, top, block_terms)
