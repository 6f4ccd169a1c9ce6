"""Operator 12 - substring deduplication by difference-cover anchors.

A word goes if a window of WINDOW consecutive words that covers it also starts in a document with a smaller doc_id.  Words are
``[^\\x20\\x09-\\x0D]+`` runs, unchanged; windows stay inside documents and are judged on the input.

1. COVER is a difference cover modulo PERIOD: for any two places there is a shift below PERIOD that takes both to places whose rest is in
   COVER.  So of two equal windows some ANCHOR words, at the same place in both, start at cover places in both documents, as
   PERIOD + ANCHOR - 1 <= WINDOW.  Only the ANCHOR words at cover places (6 of 31) are hashed and compared across documents.
2. An anchor that stands in two documents or more extends: the windows that hold it are hashed, no others, and compared likewise.
3. A window whose least holder is a smaller document than its own covers its words; covered words are cut out.

Comparing (``holders``) never gathers what one key holds: a task groups its own hashes first and asks once for each
different one, with the least document it has seen; the ranges of the hashes answer each asking task with the least of all, and a
third shuffle brings the answers back to the documents.  A passage in a third of all rows costs one question a task, not one a row,
and no pairs of documents are made.  What tasks exchange is packed in arrays.

Hashes are of two polynomials modulo a prime with 62 bits (``_text.Spans``), of words by their bytes and of windows by the words' hashes.
Ties: windows of one document, or of rows with one doc_id, don't remove each other.  Repeated rows are treated alike.  A row without
doc_id is compared with nothing and kept.  Null and empty texts have no words; texts with fewer than WINDOW words stay as they are.  Very
long texts are cut whole.  Extra columns are kept, clashing ones give way; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm import _text as t
from stratum.llm._blocks import deal, runs, unpack
from stratum.llm._spark import ranges

WINDOW = 50
PERIOD, COVER = 31, (0, 1, 3, 8, 12, 18)  # every difference of two members modulo 31 occurs once
ANCHOR = WINDOW - PERIOD + 1
ASKED = 1 << 19  # hashes that a task groups before it asks
RANGE_BYTES = 8 << 20  # of text for each range of hashes

Batches = Iterator[pa.RecordBatch]
_DEALT = {"hash": np.uint64, "doc": np.int64, "several": np.bool_, "entry": np.int32}


def steps(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Each value less the one before, from 0 at each bound: small numbers, which a shuffle packs well."""
    out = np.diff(values, prepend=0)
    first = bounds[:-1][np.diff(bounds) > 0]
    out[first] = values[first]
    return out.astype(np.int32)


def _packed(k1: np.ndarray, k2: np.ndarray, doc: np.ndarray, bounds: np.ndarray, hashes: np.ndarray, at: np.ndarray) -> pa.RecordBatch:
    """(k1, k2, doc, hashes, at in steps): the rows of the documents that have hashes."""
    some, moved = np.flatnonzero(np.diff(bounds)), steps(at, bounds)
    cut = lambda x: pa.array([x[bounds[d] : bounds[d + 1]].tobytes() for d in some], pa.binary())
    return pa.record_batch([pa.array(k1[some]), pa.array(k2[some]), pa.array(doc[some]), cut(hashes), cut(moved)], ["k1", "k2", "doc", "hashes", "at"])


def holders(texts: DataFrame, spans: Callable[[Batches], Batches], parts: int) -> DataFrame:
    """(k1, k2, at, least): of each row that ``spans`` makes of ``texts`` the places whose hash stands in several documents (in steps), and the
    least of these.

    Rows of one document count as one holder, and each gets its answer."""
    schema = "part int, home long, hash binary, doc binary, several binary, entry binary, k1 binary, k2 binary, n binary, at binary"
    names = [c.split()[0] for c in schema.split(", ")]

    def rows(home: int, dealt: list[tuple[int, dict[str, bytes]]]) -> pa.RecordBatch:
        columns = [pa.array([x.get(c) for _, x in dealt], pa.binary()) for c in names[2:]]
        return pa.record_batch([pa.array([p for p, _ in dealt], pa.int32()), pa.array([home] * len(dealt), pa.int64()), *columns], names)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, number, task = [], 0, 0, TaskContext.get().partitionId()
        for b in spans(batches):
            for i in range(b.num_rows):
                one = b.slice(i, 1)
                held.append(one)
                size += len(one.column("hashes")[0].as_buffer()) // 8
                if size >= ASKED:
                    yield questions(pa.Table.from_batches(held), task << 32 | number)
                    held, size, number = [], 0, number + 1
        if held:
            yield questions(pa.Table.from_batches(held), task << 32 | number)

    def questions(some: pa.Table, home: int) -> pa.RecordBatch:
        """For each different hash its least document, and whether others hold it; beside these what the answers are read with."""
        buffers = some.column("hashes").to_pylist()
        h = np.frombuffer(b"".join(buffers), np.uint64)
        n = np.array([len(x) // 8 for x in buffers])
        doc = np.repeat(some.column("doc").to_numpy(), n)
        order = np.lexsort((doc, h))
        new = np.ones(len(h), bool)
        new[1:] = h[order[1:]] != h[order[:-1]]
        head = np.flatnonzero(new)
        least = doc[order[head]]
        several = np.maximum.reduceat(doc[order], head) != least
        group = np.empty(len(h), np.int64)
        group[order] = np.cumsum(new) - 1
        first = np.full(len(head), len(h))
        np.minimum.at(first, group, np.arange(len(h)))
        by = np.argsort(first, kind="stable")  # numbers in the order in which the documents first show them
        rank = np.empty(len(head), np.int64)
        rank[by] = np.arange(len(head))
        asked = h[order[head]][by]
        part = (asked >> np.uint64(32)).astype(np.int64) * parts >> 32
        dealt = list(deal(part, parts, hash=asked, doc=least[by], several=several[by], entry=np.arange(len(by), dtype=np.int32)))
        home_row = {"entry": np.diff(rank[group], prepend=0).astype(np.int32).tobytes(), "k1": some.column("k1").to_numpy().tobytes(), "k2": some.column("k2").to_numpy().tobytes(), "n": n.astype(np.int32).tobytes(), "at": b"".join(some.column("at").to_pylist())}
        return rows(home, [*dealt, (home % parts, home_row)])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The least document of each hash that several hold, to all that asked."""
        asked: list[pa.RecordBatch] = []
        for b in batches:
            own = b.column("k1").is_valid()
            if (home := b.filter(own)).num_rows:
                yield home
            asked.append(b.filter(own.to_numpy(zero_copy_only=False) == False))  # noqa: E712
        if not sum(b.num_rows for b in asked):
            return
        homes = np.concatenate([b.column("home").to_numpy() for b in asked])
        each = np.concatenate([[len(x) // 8 for x in b.column("hash").to_pylist()] for b in asked]).astype(np.int64)
        q = unpack(iter(asked), **_DEALT)
        order = np.argsort(q["hash"], kind="stable")
        h = q["hash"][order]
        new = np.ones(len(h), bool)
        new[1:] = h[1:] != h[:-1]
        head = np.flatnonzero(new)
        least = np.minimum.reduceat(q["doc"][order], head)
        several = (np.maximum.reduceat(q["doc"][order], head) != least) | np.maximum.reduceat(q["several"][order], head)
        many = np.diff(np.append(head, len(h)))
        back, yes = np.empty(len(h), np.int64), np.empty(len(h), bool)
        back[order], yes[order] = np.repeat(least, many), np.repeat(several, many)
        bounds = np.concatenate([[0], np.cumsum(each)])
        for i in range(0, len(homes), 256):
            made = []
            for k in range(i, min(i + 256, len(homes))):
                hit = bounds[k] + np.flatnonzero(yes[bounds[k] : bounds[k + 1]])
                if len(hit):
                    made.append((int(homes[k]), {"doc": back[hit].tobytes(), "entry": q["entry"][hit].tobytes()}))
            if made:
                columns = [pa.array([x.get(c) for _, x in made], pa.binary()) for c in names[2:]]
                yield pa.record_batch([pa.nulls(len(made), pa.int32()), pa.array([p for p, _ in made], pa.int64()), *columns], names)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, "home"):
            own = group.filter(group.column("k1").is_valid()).to_pylist()[0]
            answers = group.filter(group.column("k1").is_null())
            if not answers.num_rows:
                continue
            a = unpack(iter(answers.to_batches()), doc=np.int64, entry=np.int32)
            entry = np.cumsum(np.frombuffer(own["entry"], np.int32))
            n = np.frombuffer(own["n"], np.int32).astype(np.int64)
            bounds = np.concatenate([[0], np.cumsum(n)])
            moved = np.cumsum(np.frombuffer(own["at"], np.int32).astype(np.int64))
            at = moved - np.repeat(np.concatenate([[0], moved])[bounds[:-1]], n)
            least, yes = np.zeros(int(entry.max()) + 1, np.int64), np.zeros(int(entry.max()) + 1, bool)
            least[a["entry"]], yes[a["entry"]] = a["doc"], True
            hit = np.flatnonzero(yes[entry])
            edge = np.searchsorted(hit, bounds)
            some = np.flatnonzero(np.diff(edge))
            k1, k2 = (np.frombuffer(own[k], np.int64)[some] for k in ("k1", "k2"))
            place, holder = steps(at[hit], edge), least[entry[hit]]
            cut = lambda x: pa.array([x[edge[d] : edge[d + 1]].tobytes() for d in some], pa.binary())
            yield pa.record_batch([pa.array(k1), pa.array(k2), cut(place), cut(holder)], ["k1", "k2", "at", "least"])

    asked = texts.mapInArrow(ask, schema).repartition(parts, "part").mapInArrow(answer, schema)
    return asked.repartition(parts, "home").sortWithinPartitions("home").mapInArrow(read, "k1 long, k2 long, at binary, least binary")


def _words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    buf, off = t.raw(column)
    return buf, *t.words(buf, off)


def anchors(window: int = WINDOW) -> Callable[[Batches], Batches]:
    """Spans of the ANCHOR words at cover places of each text of ``window`` words or more that has a doc_id."""
    anchor, member = window - PERIOD + 1, np.isin(np.arange(PERIOD), COVER)

    def cut(batches: Batches) -> Batches:
        for b in batches:
            for i, j, buf, off in t.chunks(b.column("text")):
                start, end, bounds = t.words(buf, off)
                n = np.where(b.column("doc")[i:j].is_valid(), np.diff(bounds), 0)
                own = t.owners(bounds)
                place = np.arange(len(start)) - bounds[own]
                w = np.flatnonzero(member[place % PERIOD] & (place + anchor <= n[own]) & (n[own] >= window))
                h = t.Spans(t.Spans(buf).hash(start, end)).hash(w, w + anchor)
                k1, k2, doc = _numbers(b, i, j)
                yield _packed(k1, k2, doc, np.searchsorted(own[w], np.arange(j - i + 1)), h, place[w])

    return cut


def windows(window: int = WINDOW) -> Callable[[Batches], Batches]:
    """Spans of the windows that hold one of the anchors ``at`` of their text (of ``holders``)."""

    def cut(batches: Batches) -> Batches:
        for b in batches:
            for i, j, buf, off in t.chunks(b.column("text")):
                start, end, bounds = t.words(buf, off)
                change = np.zeros(len(start) + 1, np.int64)
                for d, moved in enumerate(b.column("at")[i:j].to_pylist()):
                    at = bounds[d] + np.cumsum(np.frombuffer(moved, np.int32).astype(np.int64))
                    np.add.at(change, np.maximum(at - PERIOD + 1, bounds[d]), 1)
                    np.add.at(change, np.minimum(at, bounds[d + 1] - window) + 1, -1)
                w = np.flatnonzero(np.cumsum(change)[:-1] > 0)
                own = t.owners(bounds)
                h = t.Spans(t.Spans(buf).hash(start, end)).hash(w, w + window)
                k1, k2, doc = _numbers(b, i, j)
                yield _packed(k1, k2, doc, np.searchsorted(own[w], np.arange(j - i + 1)), h, w - bounds[own[w]])

    return cut


def _numbers(b: pa.RecordBatch, i: int, j: int) -> tuple[np.ndarray, ...]:
    return tuple(b.column(c)[i:j].fill_null(0).to_numpy() for c in ("k1", "k2", "doc"))


def remove_shared(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Every row of ``docs`` with n_words, n_removed, spans (array of start, end: maximal runs of removed words) and kept_text
    (the words kept, joined by one space).  ``window`` is PERIOD at least."""
    if window < PERIOD:
        raise ValueError(f"windows have {PERIOD} words at least")
    new = {"n_words": "long", "n_removed": "long", "spans": "array<struct<start:int,end:int>>", "kept_text": "string"}
    old = docs.drop(*new)
    parts = ranges(docs, RANGE_BYTES)
    text, number = F.coalesce("text", F.lit("")), F.col("doc_id").cast("long")
    # both joins below read one shuffle of this frame
    keyed = old.select(F.xxhash64(F.lit(1), number, text).alias("k1"), F.xxhash64(F.lit(2), number, text).alias("k2"), number.alias("doc"), "text", *(F.col(f"`{c}`").alias(f"c{n}") for n, c in enumerate(old.columns) if c.lower() != "text"))
    narrow = keyed.select("k1", "k2", "doc", "text")
    shared = holders(narrow, anchors(window), parts).groupBy("k1", "k2").agg(F.first("at").alias("at"))  # rows of a repeated document are alike
    found = holders(keyed.join(shared, ["k1", "k2"]), windows(window), parts)
    one = found.groupBy("k1", "k2").agg(F.first("at").alias("at"), F.first("least").alias("least"))

    names = old.columns
    column = {c: "text" if c.lower() == "text" else f"c{n}" for n, c in enumerate(names)}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, buf, off in t.chunks(b.column("text")):
                start, end, bounds = t.words(buf, off)
                change = np.zeros(len(start) + 1, np.int64)
                for d, (moved, who, me) in enumerate(zip(*(b.column(c)[i:j].to_pylist() for c in ("at", "least", "doc")), strict=True)):
                    if moved is not None:
                        w = bounds[d] + np.cumsum(np.frombuffer(moved, np.int32).astype(np.int64))[np.frombuffer(who, np.int64) < me]
                        change[w] += 1  # the places of one text differ
                        change[w + window] -= 1
                gone = np.cumsum(change)[:-1] > 0
                yield pa.record_batch([*(b.column(column[c])[i:j] for c in names), *_kept(buf, start, end, bounds, gone)], [*names, *new])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in old.schema), *(f"{k} {v}" for k, v in new.items())])
    return keyed.join(one, ["k1", "k2"], "left").mapInArrow(cut, schema)


def _kept(buf: np.ndarray, start: np.ndarray, end: np.ndarray, bounds: np.ndarray, gone: np.ndarray) -> list[pa.Array]:
    """The columns that ``remove_shared`` adds, of a chunk."""
    own, size = t.owners(bounds), np.diff(bounds)
    edge = np.zeros(len(gone) + 1, bool)
    edge[bounds] = True
    first = gone & np.concatenate([[True], ~gone[:-1]]) if len(gone) else gone
    first |= gone & edge[:-1]
    last = gone & np.concatenate([~gone[1:], [True]]) if len(gone) else gone
    last |= gone & edge[1:]
    a, z = np.flatnonzero(first), np.flatnonzero(last) + 1
    spans = pa.StructArray.from_arrays([pa.array((a - bounds[own[a]]).astype(np.int32)), pa.array((z - bounds[own[a]]).astype(np.int32))], ["start", "end"])
    listed = pa.ListArray.from_arrays(pa.array(np.searchsorted(own[a], np.arange(len(size) + 1)).astype(np.int32)), spans)
    stay = np.flatnonzero(~gone)
    text, off = t.take_spans(np.append(buf, np.uint8(32)), start[stay], end[stay] + 1)
    text[off[1:] - 1] = 32
    place = np.searchsorted(own[stay], np.arange(len(size) + 1))
    some = np.diff(place) > 0
    text = np.delete(text, off[place[1:][some]] - 1)  # the space after the last word of a text
    past = off[place] - np.concatenate([[0], np.cumsum(some)])
    return [pa.array(size), pa.array(t.per_doc(gone, bounds)), listed, t.strings(text, past)]


def digest(removed: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256)."""
    return removed.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
