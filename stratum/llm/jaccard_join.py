"""Operator 8 - exact n-gram Jaccard join with set-relation skipping, and its connected components.

A document's set is its distinct k-word shingles (words ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased; fewer than k words: the
whole sequence; none: the empty set, linked with nothing).  Documents with equal sets form one class, so copies cost one
set.  Two classes link if 100 * intersection >= percent * union.

1. Tokens have one order for all sets: by hash, then the most frequent ones (at most HOT_TOKENS, counted over all documents), so
   passages that many documents share come last.  The least common token of two linking sets lies among the first
   n - ceil(percent * n / 100) + 1 of each, its prefix.  Any such order finds every link; this one finds few others.
2. Prefix tokens are dealt by hash and sorted into index lists by size.  A list falls into runs wherever two neighbouring sizes
   can't link; an entry without a partner that its size and position allow goes.  Each run is led by its least set,
   and a set is sent once to each of its leaders, with the places of the tokens that they share, never to each partner.
3. A leader's list drops sets without a partner that their sketches allow: parities of the numbers of tokens in as many cells as a
   set has tokens, which differ in no more cells than the sets in tokens, so no link is lost.
4. A leader's sets are compared in one task (beyond BLOCK sets in one for each pair of blocks).  Index lists are ordered by
   token, size and position, and blocks of one size are skipped from the first position that can't reach the threshold.
   The overlaps of a set with all others are derived from those of the set before it where that is similar: only lists of
   the tokens in which the two differ are read.  A pair counts in the task that leads its least common token, so once.
   Links feed a union-find; only its forest and the number of links of each set leave, so components join true links alone.

Tokens are 62-bit hashes, sent as 48 bits where a clash only makes a list longer; sets are known by the 128 bits of a digest of their tokens.
Null text is empty; repeated rows are separate documents of one class; ties between classes go to the least id, then the
least digest; a null doc_id counts in links, but a component's id is the least non-null id (null if there is none); extra
columns are ignored; empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm import _text as t
from stratum.llm._blocks import deal, runs, unpack
from stratum.llm._spark import components, fresh, id_filter, most_frequent, ranges, settle, settle_table

NAME = 16  # bytes of a digest
BLOCK = 4096
PRUNE = 8192  # a longer list is compared without looking at sketches first
FLUSH_KEYS = 600_000
HOT_TOKENS, HOT_PER_TASK, HOT_LEAST = 1 << 18, 1 << 15, 4  # in the order, sent by a task, least number of documents in a task's chunk
RANGE_BYTES = 16 << 20  # of text for each range of tokens


def sets(buf: np.ndarray, off: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each document and their bounds."""
    low = t.LOWER[buf]
    starts, ends, bounds = t.words(low, off)
    return t.distinct(*t.shingles(t.Spans(low).hash(starts, ends), bounds, k))


def digests(h: np.ndarray, at: np.ndarray) -> list[bytes | None]:
    return [hashlib.md5(h[i:j].tobytes(), usedforsecurity=False).digest() if j > i else None for i, j in zip(at[:-1], at[1:], strict=True)]


def short(digest: bytes) -> int:
    """48 bits of a digest, for a filter that may pass too much."""
    return int.from_bytes(digest[:6], "little")


def numbered(names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(different names in order, number of each): rows of NAME bytes, so that a task works with numbers in the names' order."""
    high, low = (np.ascontiguousarray(names[:, i : i + 8]).view(">u8").ravel() for i in (0, 8))
    order = np.lexsort((low, high))
    new = np.ones(len(order), bool)
    new[1:] = (high[order[1:]] != high[order[:-1]]) | (low[order[1:]] != low[order[:-1]])
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    return names[order[new]], number


def _six(x: np.ndarray) -> np.ndarray:
    """The low six bytes of each number, one row each."""
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].copy()


def _eight(raw: np.ndarray) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = raw.reshape(-1, 6)
    return out.ravel().view("<u8").astype(np.int64)


def prefix_size(n: np.ndarray, percent: int) -> np.ndarray:
    return np.where(n > 0, n + 1 + (-n * percent) // 100, 0)


def ordered(h: np.ndarray, at: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """The tokens of each set in the common order: by hash, then those of ``hot`` (sorted by hash)."""
    if not len(hot):
        return h
    late = hot[np.minimum(np.searchsorted(hot, h), len(hot) - 1)] == h
    return h[np.lexsort((late, t.owners(at)))] if late.any() else h


def parity_sketch(h: np.ndarray) -> bytes:
    """For each of 2^m >= n cells, 64 at least, whether the cell has an odd number of tokens.  Two sketches differ in no more cells than their sets in tokens."""
    cells = 1 << max(6, int(len(h) - 1).bit_length())
    return np.packbits(np.bincount((h & np.uint64(cells - 1)).astype(np.int64), minlength=cells) & 1, bitorder="little").tobytes()


def document_sets(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, n_shingles, digest, sketch, often, times) of every row; the last rows of a task have its frequent tokens and their counts alone."""
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_shingles long, digest binary, sketch binary, often long, times long"

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_shingles", "digest", "sketch", "often", "times"]
        tokens, number, ids = np.zeros(0, np.uint64), np.zeros(0, np.int64), None
        for b in batches:
            ids = b.column("doc_id")
            for i, j, buf, off in t.chunks(b.column("text")):
                h, at = sets(buf, off, k)
                sketches = [parity_sketch(h[x:y]) if y > x else None for x, y in zip(at[:-1], at[1:], strict=True)]
                yield pa.record_batch([ids[i:j], pa.array(np.diff(at)), pa.array(digests(h, at), pa.binary()), pa.array(sketches, pa.binary()), *[pa.nulls(j - i, pa.int64())] * 2], names)
                seen, n = np.unique(h, return_counts=True)
                often = n >= HOT_LEAST
                tokens, place = np.unique(np.concatenate([tokens, seen[often]]), return_inverse=True)
                number = np.bincount(place, np.concatenate([number, n[often]]), len(tokens)).astype(np.int64)
                if len(tokens) > 4 * HOT_PER_TASK:
                    most = np.sort(np.argsort(-number, kind="stable")[: 2 * HOT_PER_TASK])
                    tokens, number = tokens[most], number[most]
        if len(tokens):
            most = np.argsort(-number, kind="stable")[:HOT_PER_TASK]
            m = len(most)
            yield pa.record_batch([pa.nulls(m, ids.type), pa.nulls(m, pa.int64()), *[pa.nulls(m, pa.binary())] * 2, pa.array(tokens[most].view(np.int64)), pa.array(number[most])], names)

    return docs.select("doc_id", "text").mapInArrow(measure, schema)


def frequent_tokens(rows: DataFrame) -> np.ndarray:
    """Sorted hashes of the most frequent tokens.  They only order tokens, so a count may miss occurrences spread thinly over tasks."""

    found = rows.where("often IS NOT NULL").groupBy(F.col("often").alias("h")).agg(F.sum("times").alias("n"))
    return np.sort(most_frequent(found, "n", HOT_TOKENS).toPandas()["h"].to_numpy(np.int64).view(np.uint64))


def _kept_entries(token: np.ndarray, size: np.ndarray, place: np.ndarray, percent: int) -> np.ndarray:
    """Entries (sorted by token, size) that have another one in their list whose size their size and position allow."""
    rank = np.concatenate([[0], np.cumsum(token[1:] != token[:-1])]).astype(np.int64) << 32
    key = rank | size
    low, high = -(-percent * size // 100), (size - place) * (100 + percent) // percent - size
    n = np.searchsorted(key, rank | np.clip(high, 0, (1 << 32) - 1), "right") - np.searchsorted(key, rank | low)
    return n - ((low <= size) & (size <= high)) > 0


def led(token: np.ndarray, own: np.ndarray, size: np.ndarray, place: np.ndarray, percent: int) -> tuple[np.ndarray, ...]:
    """(leader, member, place) of the entries of index lists that have partners."""
    order = np.lexsort((own, size, token))
    token, own, size, place = token[order], own[order], size[order], place[order]
    keep = np.ones(len(token), bool)
    keep[1:] = (token[1:] != token[:-1]) | (own[1:] != own[:-1])
    for _ in range(2):  # what goes may leave others without a partner
        token, own, size, place = token[keep], own[keep], size[keep], place[keep]
        if not len(token):
            return own, own, place
        keep = _kept_entries(token, size, place, percent)
    token, own, size, place = token[keep], own[keep], size[keep], place[keep]
    if not len(token):
        return own, own, place
    head = np.flatnonzero(np.concatenate([[True], (token[1:] != token[:-1]) | (size[1:] * percent > size[:-1] * 100)]))
    number = np.diff(np.append(head, len(token)))
    leader = np.repeat(np.minimum.reduceat(own, head), number)
    many = np.repeat(number > 1, number)
    return leader[many], own[many], place[many]


def shared_leaders(docs: DataFrame, k: int, percent: int, hot: np.ndarray) -> DataFrame:
    """(leader, member, places): each set with the sets that lead index lists of its prefix tokens, and the places of these tokens."""
    parts = ranges(docs, RANGE_BYTES)
    model = docs.sparkSession.sparkContext.broadcast(hot)
    columns = ("token", "own", "size", "place")

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[np.ndarray, ...]] = []
        waiting, seen = 0, set()

        def flush() -> pa.RecordBatch:
            token, own, size, place = (np.concatenate(x) for x in zip(*found, strict=True))
            part = (t.mix(token) % np.uint64(parts)).astype(np.int64)
            dealt = list(deal(part, parts, token=_six(token), own=own, size=size.astype(np.uint32), place=place.astype(np.uint32)))
            return pa.record_batch([pa.array([p for p, _ in dealt], pa.int32()), *(pa.array([x[c] for _, x in dealt], pa.binary()) for c in columns)], ["part", *columns])

        for b in batches:
            for _, _, buf, off in t.chunks(b.column("text")):
                h, at = sets(buf, off, k)
                made = digests(h, at)
                name = np.frombuffer(b"".join(d or bytes(NAME) for d in made), np.uint8).reshape(-1, NAME)
                new = np.zeros(len(name), bool)
                for i, x in enumerate(made):  # copies in a task count once
                    if x is not None and x not in seen:
                        seen.add(x)
                        new[i] = True
                h = ordered(h, at, model.value)
                n = np.where(new, prefix_size(np.diff(at), percent), 0)
                own = np.repeat(np.arange(len(n)), n)
                place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                found.append((h[at[own] + place], name[own], np.diff(at)[own], place))
                waiting += len(own)
                if waiting >= FLUSH_KEYS:
                    yield flush()
                    found, waiting = [], 0
        if waiting:
            yield flush()

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = unpack(batches, token=np.uint8, own=np.uint8, size=np.uint32, place=np.uint32)
        names, own = numbered(x["own"].reshape(-1, NAME))
        leader, member, place = led(_eight(x["token"]), own, x["size"].astype(np.int64), x["place"].astype(np.int64), percent)
        order = np.lexsort((place, member, leader))
        leader, member, place = leader[order], member[order], place[order].astype(np.uint32)
        head = np.flatnonzero(np.concatenate([[True], (leader[1:] != leader[:-1]) | (member[1:] != member[:-1])])) if len(leader) else np.zeros(0, np.int64)
        at = np.append(head, len(leader))
        for i in range(0, len(head), 1 << 15):
            some = head[i : i + (1 << 15)]
            packed = [place[a:b].tobytes() for a, b in zip(some.tolist(), at[i + 1 : i + 1 + len(some)].tolist(), strict=True)]
            who = [pa.array([r.tobytes() for r in names[of[some]]], pa.binary()) for of in (leader, member)]
            yield pa.record_batch([*who, pa.array(packed, pa.binary())], ["leader", "member", "places"])

    dealt = docs.select("text").mapInArrow(emit, "part int, " + ", ".join(f"{c} binary" for c in columns)).repartition(parts, "part")
    return dealt.mapInArrow(link, "leader binary, member binary, places binary")


def with_partner(size: np.ndarray, sketches: list[bytes], percent: int) -> np.ndarray:
    """Whether each set has another one that by sizes and sketches it may link to; none that links is missed."""
    order = np.argsort(size, kind="stable")
    size = size[order]
    words = [np.frombuffer(sketches[i], np.uint64) for i in order.tolist()]
    kinds = {n: np.flatnonzero([len(w) == n for w in words]) for n in {len(w) for w in words}}
    rows = {n: np.stack([words[i] for i in at]) for n, at in kinds.items()}
    out = np.zeros(len(size), bool)
    for i, w in enumerate(words):
        first = int(np.searchsorted(size, -(-percent * size[i] // 100)))
        while len(w) >= 1:  # partners of at most the same size; the longer sketch is folded to the shorter
            at = kinds.get(len(w), np.zeros(0, np.int64))
            low, high = np.searchsorted(at, [first, i])
            if high > low:
                some = at[low:high]
                both = size[some] + size[i]
                near = np.bitwise_count(rows[len(w)][low:high] ^ w).sum(1) <= both - 2 * -(-percent * both // (100 + percent))
                out[some[near]] = True
                out[i] |= near.any()
            if len(w) == 1 or 64 * len(w) <= size[first]:  # all partners have been seen
                break
            w = w[: len(w) // 2] ^ w[len(w) // 2 :]
    back = np.empty(len(out), bool)
    back[order] = out
    return back


class Sets:
    """The sets of a task with their index lists.  ``h``: tokens in the common order, ``led``: for each prefix token whether this task leads its list."""

    def __init__(self, h: np.ndarray, at: np.ndarray, led: np.ndarray, percent: int):
        self.at, self.size, self.percent = at, np.diff(at), percent
        self.prefix = prefix_size(self.size, percent)
        self.prefix_at = np.concatenate([[0], np.cumsum(self.prefix)])
        self.led = led
        ids, self.token = np.unique(h, return_inverse=True)
        own = t.owners(at)
        by = np.argsort(self.token, kind="stable")
        self.lists, self.list_at = own[by], np.searchsorted(self.token[by], np.arange(len(ids) + 1))
        # prefix tokens: (token, size, position), in blocks of one token and size
        own = np.repeat(np.arange(len(self.size)), self.prefix)
        place = np.arange(self.prefix_at[-1]) - self.prefix_at[own]
        token = self.token[at[own] + place]
        by = np.lexsort((place, self.size[own], token))
        self.entries, self.places, token, size = own[by], place[by], token[by], self.size[own][by]
        self.block = np.flatnonzero(np.concatenate([[True], (token[1:] != token[:-1]) | (size[1:] != size[:-1])])) if len(by) else np.zeros(0, np.int64)
        self.block_size = size[self.block]
        self.block_key = token[self.block].astype(np.int64) << 32 | self.block_size
        number = np.diff(np.append(self.block, len(by)))
        self.by_place = np.repeat(np.arange(len(self.block)), number) << 32 | self.places
        self.entry_at = np.searchsorted(token, np.arange(len(ids) + 1))

    def tokens(self, s: int) -> np.ndarray:
        return self.token[self.at[s] : self.at[s + 1]]

    def has_candidates(self, s: int) -> bool:
        """Whether another set stands in a block that size and position don't skip."""
        n, p = self.size[s], self.percent
        token = self.tokens(s)[: self.prefix[s]].astype(np.int64)
        low = np.searchsorted(self.block_key, token << 32 | -(-p * n // 100))
        high = np.searchsorted(self.block_key, token << 32 | 100 * n // p, "right")
        number = high - low
        block = np.repeat(low - (np.cumsum(number) - number), number) + np.arange(number.sum())
        place = np.repeat(np.arange(len(token)), number)
        least = -(-p * (n + self.block_size[block]) // (100 + p))  # overlap that a link needs
        live = n - place >= least
        block, least = block[live], least[live]
        end = np.searchsorted(self.by_place, block << 32 | np.maximum(self.block_size[block] - least + 1, 0))
        return bool((end - self.block[block]).sum() > (self.size[s] > 0) * np.count_nonzero(n - np.arange(len(token)) >= -(-p * 2 * n // (100 + p))))

    def read(self, tokens: np.ndarray) -> np.ndarray:
        """How many of the tokens each set has."""
        low, number = self.list_at[tokens], self.list_at[tokens + 1] - self.list_at[tokens]
        return np.bincount(self.lists[np.repeat(low - (np.cumsum(number) - number), number) + np.arange(number.sum())], minlength=len(self.size)).astype(np.int32)

    def own_pairs(self, s: int, hit: np.ndarray) -> np.ndarray:
        """Of the sets linked to ``s``, those whose least common token with it is led here."""
        token, mine = self.tokens(s)[: self.prefix[s]], self.led[self.prefix_at[s] : self.prefix_at[s + 1]]
        if mine.all() or not len(hit):
            return hit
        waits = np.zeros(len(self.size), bool)
        waits[hit] = True
        left, out = len(hit), []
        for place, here in zip(token.tolist(), mine.tolist(), strict=True):
            low, high = self.entry_at[place], self.entry_at[place + 1]
            if high - low == 1:
                continue
            some = self.entries[low:high]
            some = some[waits[some]]
            if here:
                out.append(some)
            waits[some] = False
            left -= len(some)
            if not left:
                break
        return np.sort(np.concatenate(out)) if out else hit[:0]


def link_sets(x: Sets, block: np.ndarray, copies: np.ndarray, both: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(label of each set: the least set it is linked to in this task, documents in other sets that it links to).

    ``both``: the task is for pairs across its two blocks."""
    n = len(x.size)
    label, links = np.arange(n), np.zeros(n, np.int64)
    first = np.array([x.tokens(s)[0] for s in range(n)])
    order = np.lexsort((x.size, first))  # similar sets mostly share their first token
    before: np.ndarray | None = None
    overlap = np.zeros(n, np.int32)
    for s in order.tolist():
        mine = np.sort(x.tokens(s))
        derived = False
        if before is not None:
            new, gone = np.setdiff1d(mine, before, assume_unique=True), np.setdiff1d(before, mine, assume_unique=True)
            if derived := len(new) + len(gone) < len(mine):
                if len(new):
                    overlap += x.read(new)
                if len(gone):
                    overlap -= x.read(gone)
        if not derived:
            if not x.has_candidates(s):
                continue
            overlap = x.read(mine)
        before = mine
        size = x.size[s]
        hit = np.flatnonzero(100 * overlap.astype(np.int64) >= x.percent * (x.size + size - overlap))
        hit = hit[(hit != s) & ((block[hit] != block[s]) | (not both))]
        hit = x.own_pairs(s, hit)
        links[s] = copies[hit].sum()
        names = np.unique(label[np.append(hit, s)])
        if len(names) > 1:
            label[np.isin(label, names)] = names[0]
    return label, links


def near_classes(docs: DataFrame, k: int = 3, percent: int = 90) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links, digest, keeps) of every row of ``docs(doc_id, text)``.

    ``keeps`` marks the rows of one class and id in each component: the class with the least id, then the least digest."""
    docs = docs.select("doc_id", "text")
    made = settle_table(document_sets(docs, k))
    rows = made.where("often IS NULL").select("doc_id", "n_shingles", "digest")
    classes = rows.where("digest IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies"))
    hot = docs.sparkSession.sparkContext.broadcast(frequent_tokens(made))
    described = made.where("digest IS NOT NULL").groupBy(F.col("digest").alias("member")).agg(F.count("*").alias("copies"), F.first("n_shingles").alias("size"), F.first("sketch").alias("sketch"))
    parts = ranges(docs, RANGE_BYTES)

    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, "leader"):
            if run.num_rows <= PRUNE:
                run = run.filter(pa.array(with_partner(run.column("size").to_numpy(), run.column("sketch").to_pylist(), percent)))
            yield from run.select(["leader", "member", "places", "copies"]).to_batches()

    led_sets = shared_leaders(docs, k, percent, hot.value).groupBy("member", "leader").agg(F.collect_list("places").alias("places")).join(described, "member").select("leader", "member", "places", "copies", "size", "sketch")
    pairs = settle_table(led_sets.repartition(parts, "leader").sortWithinPartitions("leader").mapInArrow(prune, "leader binary, member binary, places array<binary>, copies long"))
    crowds = pairs.groupBy("leader").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")).where("blocks > 1")
    low = F.conv(F.concat(*(F.substring(F.hex("member"), i, 2) for i in range(11, 0, -2))), 16, 10).cast("long")
    wanted = id_filter(pairs.select(low.alias("member")), "member")

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for b in batches:
            for i, j, buf, off in t.chunks(b.column("text")):
                made = digests(*sets(buf, off, k))
                number = np.array([short(d) if d else -1 for d in made], np.int64)
                live = []
                for x in np.flatnonzero(wanted(number)).tolist():
                    if made[x] is not None and made[x] not in seen:  # copies in a task are sent once
                        seen.add(made[x])
                        live.append(x)
                some = pa.array(live, pa.int64())
                yield pa.record_batch([pa.array([made[x] for x in live], pa.binary()), b.column("text")[i:j].take(some)], ["member", "text"])

    texts = docs.select("text").mapInArrow(name, "member binary, text string")
    placed = texts.join(pairs.join(crowds, "leader", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1))), "member").withColumn("digest", F.col("member"))
    placed = placed.withColumn("block", F.pmod(F.xxhash64("digest"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    placed = placed.withColumn("task", F.concat_ws("-", F.hex("leader"), F.least("block", "other"), F.greatest("block", "other"))).select("task", "block", "copies", "places", "digest", "text")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, "task"):
            found: dict[bytes, tuple[np.ndarray, np.ndarray, int, int]] = {}
            for b in run.to_batches():
                for i, j, buf, off in t.chunks(b.column("text")):
                    h, at = sets(buf, off, k)
                    prefix, h = prefix_size(np.diff(at), percent), ordered(h, at, hot.value)
                    part = b.slice(i, j - i)
                    for n, (d, places, block, number) in enumerate(zip(*(part.column(c).to_pylist() for c in ("digest", "places", "block", "copies")), strict=True)):
                        led = np.zeros(prefix[n], bool)
                        led[np.concatenate([np.frombuffer(x, np.uint32) for x in places])] = True
                        found[d] = (h[at[n] : at[n + 1]], led, block, number)
            names = sorted(found)
            if len(names) < 2:
                continue
            h, led, block, number = zip(*(found[d] for d in names), strict=True)
            x = Sets(np.concatenate(h), np.concatenate([[0], np.cumsum([len(v) for v in h])]), np.concatenate(led), percent)
            label, links = link_sets(x, np.array(block), np.array(number), len(set(run.column("task")[0].as_py().split("-")[1:])) > 1)
            live = np.flatnonzero((links > 0) | (label != np.arange(len(label))))
            yield pa.record_batch([pa.array([names[i] for i in live], pa.binary()), pa.array([names[label[i]] for i in live], pa.binary()), pa.array(links[live])], ["a", "b", "links"])

    linked = settle(placed.repartition(parts, "task").sortWithinPartitions("task").mapInArrow(verify, "a binary, b binary, links long"))
    found = components(linked.select("a", "b"))
    links = linked.groupBy("a").agg(F.sum("links").alias("links"))
    named = classes.join(found.withColumnRenamed("id", "digest"), "digest", "left").join(links.withColumnRenamed("a", "digest"), "digest", "left").withColumn("root", F.coalesce("root", "digest"))
    first = F.min(F.struct(F.col("least").isNull(), "least", "digest"))
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"), first["digest"].alias("chosen"))
    named = named.join(ids, "root").select("digest", "component_id", "least", (F.col("digest") == F.col("chosen")).alias("chosen"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    empty = F.col("digest").isNull()
    keeps = F.when(empty, True).otherwise(F.col("chosen") & F.col("doc_id").eqNullSafe(F.col("least")))
    return rows.join(named, "digest", "left").select("doc_id", "n_shingles", F.when(empty, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "digest", keeps.alias("keeps"))


def keep_one(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each component (that of the least id), and every document without words."""
    names = docs.columns
    set_digest, key_1, key_2 = fresh(docs, "set_digest", "key_1", "key_2")

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, buf, off in t.chunks(b.column("text")):
                yield pa.record_batch([*(b.column(n)[i:j] for n in names), pa.array(digests(*sets(buf, off, k)), pa.binary())], [*names, set_digest])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), f"{set_digest} binary"])
    named = docs.mapInArrow(name, schema)

    def keys(digest: str) -> dict:
        parts = [F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.col("doc_id").isNull(), F.col(digest)]
        return {key_1: F.xxhash64(F.lit(1), *parts), key_2: F.xxhash64(F.lit(2), *parts)}

    chosen = near_classes(docs, k, percent).where("keeps AND digest IS NOT NULL").withColumns(keys("digest")).select(key_1, key_2).distinct()
    kept = named.where(F.col(set_digest).isNotNull()).withColumns(keys(set_digest)).join(chosen, [key_1, key_2], "left_semi").dropDuplicates([key_1, key_2])
    return kept.select(*(f"`{n}`" for n in names)).unionByName(named.where(F.col(set_digest).isNull()).select(*(f"`{n}`" for n in names)))
