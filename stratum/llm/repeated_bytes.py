"""Operator 6 - suffix-array deduplication: removal of bytes covered by repeated strings.

A byte goes if a LENGTH-byte string that covers it also starts anywhere else in the table.  Strings are judged on the
input, byte by byte, over whole texts, and never cross documents.

Sorting every suffix of the corpus to LENGTH bytes would shuffle hundreds of times the input, so suffixes are sampled
consistently: each LENGTH-byte string is represented by its anchor, the GRAM-byte substring with the least hash in it
(leftmost if equal).  Equal strings have equal anchors at the same place, so only suffixes at anchors take part and no
repeat is missed.

1. Anchors (about 2 of LENGTH - GRAM bytes) are counted by the hash of their gram; those that occur once are dropped.
2. The suffixes at the others, with the bytes before them, are range-partitioned by their leading bytes.  Splitters are sampled
   quantiles of the leading bytes; where one value spans several ranges, its grams are dealt out among these.
3. A bucket sorts the suffixes of each gram, and the reversed texts before them, by multikey quicksort on 8-byte characters.  Bytes
   that neighbours in the two orders share tell which strings around an anchor are equal, byte by byte and without hashes.
4. An anchor found more than HOT times (a passage in a great many documents) has no bucket of its own: a task first settles
   among its own strings what repeats there, and one witness for each distinct string is compared across the
   boundaries of tasks, dealt by the 62-bit hash of the string.
5. Covered runs are gathered per text and cut out.

Rows with equal texts count once in all this (their texts repeat as a whole), so copies cost one text for each task.

``remove_repeats(words=n)`` (the pipeline's passages) cuts repeated runs of n words too, whatever their bytes and the blanks
between them.  The steps are the same over the sequence of a document's word hashes, which are its characters.
Where a script has no blanks (Thai to Tibetan, Myanmar, Khmer, kana, Chinese) each character counts as a word, so no repeat
of n words of any length is missed.

With ``passage`` the repeated runs of so many words, which 400 bytes may miss, are found beside the bytes and counted, not removed.

Texts are identified by 128 bits of hash; there are no ties.  Null and empty texts have nothing to remove; texts
shorter than LENGTH neither; extra columns are kept; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm import _text as t
from stratum.llm._blocks import deal, unpack
from stratum.llm._spark import fresh, ranges, settle_table

LENGTH, GRAM = 400, 64
WORD_GRAM = 12  # words
PASSAGE = 51  # words: every repeat of more than 50 words holds a repeated run of so many
HOT = 1000
SLICE = 4000  # suffixes that a bucket sorts at a time, whole grams
SPREAD = 2_000_000  # (suffix, place) pairs that it compares at a time
PIECE = 1 << 19  # bytes of text that a task works on at a time
RANGE_BYTES = 8 << 20  # of text for each range
_KEYS = ("k1", "k2")
_SOLO = ((0xE0B8, 0xE0BF), (0xE180, 0xE182), (0xE19E, 0xE19F), (0xE2BA, 0xE9BF), (0xEFA4, 0xEFAB), (0xF0A0, 0xF0B3))  # leading two bytes
_SEED = np.uint64(0xA0761D6478BD642F)


def word_units(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, bounds) as ``t.words``; each character of a script without blanks is a word of its own."""
    starts, ends, bounds = t.words(buf, off)
    p = np.flatnonzero(buf[:-2] >= 0xE0)
    lead = buf[p].astype(np.int64) << 8 | buf[p + 1]
    p = p[sum(((lead >= a) & (lead <= b) for a, b in _SOLO), np.zeros(len(p), bool))]
    if not len(p):
        return starts, ends, bounds
    first, last = np.zeros(len(buf) + 1, bool), np.zeros(len(buf) + 1, bool)
    first[starts], last[ends] = True, True
    past = p + 3 + (buf[p] >= 0xF0)
    inner, new = p[~first[p]], past[~last[past]]
    first[p], last[past] = True, True
    first[new], last[inner] = True, True
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last), np.searchsorted(starts, off)


def _word_values(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words of a chunk, and their document bounds."""
    starts, ends, bounds = word_units(buf, off)
    return t.Spans(buf).hash(starts, ends), bounds


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values, by prefix and suffix minima of blocks."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    grid = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(grid, 1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def anchors(buf: np.ndarray, off: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> dict[str, np.ndarray]:
    """doc, kh (hash of the anchor's gram), at, low, high: the strings that start in [low, high] have the anchor ``at``."""
    size = np.diff(off)
    number = np.maximum(size - length + 1, 0)
    if not number.sum():
        return {"doc": np.zeros(0, np.int64), "kh": np.zeros(0, np.uint64), **{k: np.zeros(0, np.int32) for k in ("at", "low", "high")}}
    start = np.arange(len(buf) - gram + 1)
    h = t.Spans(buf).hash(start, start + gram)
    bits = np.uint64(max(24, len(h).bit_length()))
    least = sliding_least((h >> bits << bits) | start.astype(np.uint64), length - gram + 1)
    doc = np.repeat(np.arange(len(size)), number)
    p = np.repeat(off[:-1] - (np.cumsum(number) - number), number) + np.arange(number.sum())
    at = (least[p] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    head = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    tail = np.concatenate([head[1:], [len(at)]]) - 1
    base = off[doc[head]]
    return {"doc": doc[head], "kh": h[at[head]], "at": (at[head] - base).astype(np.int32), "low": (p[head] - base).astype(np.int32), "high": (p[tail] - base).astype(np.int32)}


def _range(h: np.ndarray, parts: int) -> np.ndarray:
    """The range of each hash among ``parts`` even ones; hashes are mixed again, as those of anchors are the least of many."""
    return ((t.mix(h ^ _SEED) >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _equal_neighbours(h: np.ndarray) -> np.ndarray:
    """Whether each value occurs more than once."""
    order = np.argsort(h, kind="stable")
    same = h[order][1:] == h[order][:-1]
    out = np.zeros(len(h), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def _heads(*columns: np.ndarray) -> np.ndarray:
    """Where runs of rows with equal columns begin."""
    if not len(columns[0]):
        return np.zeros(0, np.int64)
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.any([c[1:] != c[:-1] for c in columns], 0)
    return np.flatnonzero(new)


def _covered(owner: np.ndarray, p: np.ndarray, hit: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, start, end) of the runs covered by the hit strings; strings of an owner are in order."""
    owner, p = owner[hit], p[hit]
    if not len(p):
        return owner, p, p
    head = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (p[1:] != p[:-1] + 1)]))
    return owner[head], p[head], p[np.concatenate([head[1:], [len(p)]]) - 1] + length


def characters(units: np.ndarray, first: np.ndarray, step: int, size: np.ndarray, width: int) -> np.ndarray:
    """(strings, characters): ``size`` units from ``first`` on, forward or backward; bytes in big-endian words of eight, zeros behind."""
    i = np.arange(width)
    inside = i < size[:, None]
    out = np.where(inside, units[np.where(inside, first[:, None] + step * i, 0)] if len(units) else 0, 0)
    if units.dtype != np.uint8:
        return out
    padded = np.zeros((len(out), -(-width // 8) * 8), np.uint8)
    padded[:, :width] = out
    return padded.view(">u8").astype(np.uint64)


def multikey_sort(chars: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Order of strings within their (contiguous) groups by multikey quicksort.

    All open segments of a pass are split at once into less, equal and greater by their pivot's character; equal strings go on to
    the next character, the others stay at theirs, until segments have one string or no character is left."""
    order = np.arange(len(chars))
    place, seg = order.copy(), group - (group[0] if len(group) else 0)
    depth = np.zeros(len(order), np.int64)
    while len(place):
        head = _heads(seg)
        number = np.diff(np.append(head, len(seg)))
        open_ = np.repeat((number > 1) & (depth[head] < chars.shape[1]), number)
        place, seg, depth = place[open_], seg[open_], depth[open_]
        if not len(place):
            break
        head = _heads(seg)
        number = np.diff(np.append(head, len(seg)))
        c = chars[order[place], depth]
        pivot = np.repeat(c[head + number // 2], number)
        side = (c > pivot).astype(np.int64) - (c < pivot)
        key = np.repeat(np.arange(len(head)), number) * 3 + side + 1
        by = np.argsort(key, kind="stable")
        order[place] = order[place[by]]
        seg, depth = key[by], depth + (side[by] == 0)
    return order


def shared_units(chars: np.ndarray, order: np.ndarray, group: np.ndarray, wide: bool) -> np.ndarray:
    """Leading units that each string of the order shares with the one before it, -1 for the first of a group."""
    out = np.full(len(order), -1, np.int64)
    if len(order) < 2:
        return out
    a, b = chars[order[1:]], chars[order[:-1]]
    differ = a != b
    first = np.where(differ.any(1), differ.argmax(1), chars.shape[1])
    if wide:
        at = np.minimum(first, chars.shape[1] - 1)
        x = (a ^ b)[np.arange(len(a)), at]
        first = 8 * first + np.where(first < chars.shape[1], sum((x < np.uint64(1 << 8 * k)).astype(np.int64) for k in range(1, 8)), 0)
    out[1:] = np.where(group[order[1:]] == group[order[:-1]], first, -1)
    return out


def equal_strings(units: np.ndarray, first: np.ndarray, before: np.ndarray, behind: np.ndarray, group: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(suffix, least, most): the strings that start ``least`` to ``most`` units before the suffix and are equal to another of its group.

    Suffixes start at ``first`` in ``units``, with ``before`` units in front that count and ``behind`` from the start on; ``group`` is
    contiguous.  Between the places where the runs of equal texts in front or of equal suffixes change, nothing changes, so
    one comparison of the two runs serves all strings between."""
    wide = units.dtype == np.uint8
    right, left = characters(units, first, 1, behind, length), characters(units, first - 1, -1, before, max(length - gram, 1))
    r_order, l_order = multikey_sort(right, group), multikey_sort(left, group)
    r, l = shared_units(right, r_order, group, wide), shared_units(left, l_order, group, wide)
    most = length - gram
    at = np.concatenate([l + 1, length - r, length - behind, before + 1, np.zeros(len(group), np.int64)])
    who = np.concatenate([group[l_order], group[r_order], group, group, group])
    inside = (at >= 0) & (at <= most)
    events = np.unique(who[inside] << 20 | at[inside])
    if not len(events):
        return (np.zeros(0, np.int64),) * 3
    ev_group, ev_at = events >> 20, events & ((1 << 20) - 1)
    ev_end = np.where(np.append(ev_group[1:], -1) == ev_group, np.append(ev_at[1:], 0) - 1, most)
    heads = _heads(group)
    base, size = heads[np.searchsorted(group[heads], ev_group)], np.diff(np.append(heads, len(group)))[np.searchsorted(group[heads], ev_group)]
    total = np.concatenate([[0], np.cumsum(size)])
    found: list[tuple[np.ndarray, ...]] = []
    e = 0
    while e < len(events):
        end = max(e + 1, int(np.searchsorted(total, total[e] + SPREAD, "right")) - 1)
        n, low = size[e:end], base[e:end]
        start = np.cumsum(n) - n
        ev = np.repeat(np.arange(end - e), n)
        i = np.arange(n.sum()) - start[ev] + low[ev]
        o = ev_at[e:end][ev]
        l_run, r_run = np.empty(len(i), np.int64), np.empty(len(i), np.int64)
        l_run[start[ev] + l_order[i] - low[ev]] = np.cumsum(l[i] < o)
        r_run[start[ev] + r_order[i] - low[ev]] = np.cumsum(r[i] < length - o)
        fits = np.flatnonzero((o <= before[i]) & (length - o <= behind[i]))
        fits = fits[_equal_neighbours(l_run[fits] << 32 | r_run[fits])]
        found.append((i[fits], o[fits], ev_end[e:end][ev[fits]]))
        e = end
    who, low, high = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((low, who))
    who, low, high = who[order], low[order], high[order]
    head = np.flatnonzero(np.concatenate([[True], (who[1:] != who[:-1]) | (low[1:] != high[:-1] + 1)])) if len(who) else np.zeros(0, np.int64)
    return who[head], low[head], high[np.append(head[1:], len(who)) - 1] if len(who) else high


def _text_of(b: pa.RecordBatch, seen: set[tuple[int, int]]) -> pa.RecordBatch:
    """The rows with a text that isn't among ``seen`` yet."""
    new = []
    for i, key in enumerate(zip(*(b.column(k).to_pylist() for k in _KEYS), strict=True)):
        if key not in seen:
            seen.add(key)
            new.append(i)
    return b if len(new) == b.num_rows else b.take(pa.array(new, pa.int64()))


def repeated_anchors(keyed: DataFrame, parts: int, length: int, gram: int, words: bool = False) -> DataFrame:
    """(k1, k2, kh, at, low, high, lead, n) of the anchors whose gram occurs at n >= 2 places of different texts; units are bytes or ``words``."""
    kinds = {"kh": np.uint64, "k1": np.int64, "k2": np.int64, "at": np.int32, "low": np.uint16, "high": np.uint16, "lead": np.uint32}

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for b in batches:
            b = _text_of(b, seen)
            keys = [b.column(k).to_numpy() for k in _KEYS]
            found = []
            for i, _, buf, off in t.chunks(b.column("text"), PIECE):
                units, off = _word_values(buf, off) if words else (buf, off)
                a = anchors(units, off, length, gram)
                doc = a.pop("doc")
                a |= {"low": (a["at"] - a["low"]).astype(np.uint16), "high": (a["high"] - a["at"] + length).astype(np.uint16), "lead": leading(units, off[doc] + a["at"])}
                found.append(a | {k: v[doc + i] for k, v in zip(_KEYS, keys, strict=True)})
            a = {k: np.concatenate([x[k] for x in found]) for k in kinds} if found else {}
            if a and len(a["kh"]):
                dealt = list(deal(_range(a["kh"], parts), parts, **a))
                yield pa.record_batch([pa.array([p for p, _ in dealt], pa.int32()), *(pa.array([x[k] for _, x in dealt], pa.binary()) for k in kinds)], ["part", *kinds])

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = unpack(batches, **kinds)
        order = np.lexsort((a["at"], a["k2"], a["k1"], a["kh"]))
        order = order[_heads(*(a[k][order] for k in ("kh", "k1", "k2", "at")))]  # a text of several tasks counts once
        head = _heads(a["kh"][order])
        n = np.repeat(np.diff(np.append(head, len(order))), np.diff(np.append(head, len(order))))
        order, n = order[n > 1], n[n > 1]
        for i in range(0, len(order), 1 << 17):
            x = {k: v[order[i : i + (1 << 17)]] for k, v in a.items()}
            yield pa.record_batch([pa.array(x["k1"]), pa.array(x["k2"]), pa.array(x["kh"].view(np.int64)), pa.array(x["at"]), *(pa.array(x[k].astype(np.int32)) for k in ("low", "high")), pa.array(x["lead"].astype(np.int64)), pa.array(n[i : i + (1 << 17)])], ["k1", "k2", "kh", "at", "low", "high", "lead", "n"])

    packed = keyed.select("k1", "k2", "text").mapInArrow(emit, "part int, " + ", ".join(f"{k} binary" for k in kinds))
    return packed.repartition(parts, "part").mapInArrow(keep, "k1 long, k2 long, kh long, at int, low int, high int, lead long, n long")


def leading(units: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The first 32 bits of suffixes, whose order is that of the suffixes."""
    if units.dtype != np.uint8:
        return (units[at] >> np.uint64(32)).astype(np.uint32)
    return sum(units[at + k].astype(np.uint32) << np.uint32(24 - 8 * k) for k in range(4)) if len(at) else np.zeros(0, np.uint32)


def _bucket(lead: np.ndarray, kh: np.ndarray, splitters: np.ndarray) -> np.ndarray:
    """The range of each suffix; where splitters repeat a value, its grams are dealt over the ranges between."""
    low, high = np.searchsorted(splitters, lead, "left"), np.searchsorted(splitters, lead, "right")
    return low + (t.mix(kh ^ _SEED) % (high - low + 1).astype(np.uint64)).astype(np.int64)


def covered_runs(keyed: DataFrame, parts: int, length: int = LENGTH, gram: int = GRAM, hot: int = HOT, words: bool = False, passage: int | None = None) -> DataFrame:
    """(k1, k2, start, end, by_word): runs of bytes (or ``words``) of texts that strings of other places cover; runs may touch or overlap.

    With ``passage``, runs of words that repeated runs of so many words cover come as well, from the same reading of the texts.  Their
    windows are compared by 64-bit hashes, a task having all windows around the anchors of one gram."""
    found = settle_table(repeated_anchors(keyed, parts, length, gram, words))
    share = [(i + 1) / parts for i in range(parts - 1)]
    sampled = found.where(F.pmod("kh", F.lit(4)) == 0).agg(F.percentile_approx("lead", share, 20 * parts)).first()[0] if share else None
    splitters = np.array(sampled or [], np.int64)
    every = found.withColumn("by_word", F.lit(False))
    if passage:
        every = every.unionByName(settle_table(repeated_anchors(keyed, parts, passage, min(WORD_GRAM, passage), True)).withColumn("by_word", F.lit(True)))
    lists = every.groupBy("k1", "k2").agg(F.collect_list(F.struct("kh", "at", "low", "high", "n", "by_word")).alias("anchors"))  # of one text
    members = {"kh": np.uint64, "k1": np.int64, "k2": np.int64, "at": np.int32, "low": np.int32, "high": np.int32}
    singles = {"wh": np.uint64, "many": np.bool_, "wk1": np.int64, "wk2": np.int64, "p": np.int32}
    settled = {"dk1": np.int64, "dk2": np.int64, "start": np.int32, "end": np.int32}
    columns = [*members, "units", *singles, *settled]
    schema = "part int, by_word boolean, " + ", ".join(f"{c} binary" for c in columns)

    def distinct_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for b in batches:
            yield _text_of(b, seen)

    def rows(dealt: list[tuple[int, dict[str, bytes]]], by_word: bool) -> pa.RecordBatch:
        return pa.record_batch([pa.array([p for p, _ in dealt], pa.int32()), pa.array([by_word] * len(dealt), pa.bool_()), *(pa.array([x.get(c, b"") for _, x in dealt], pa.binary()) for c in columns)], ["part", "by_word", *columns])

    def windows(units: np.ndarray, off: np.ndarray, doc: np.ndarray, at: np.ndarray, low: np.ndarray, high: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
        """(number of each anchor's strings, and of each string its document, place and hash)."""
        number = (low + high - length + 1).astype(np.int64)
        own = np.repeat(doc, number)
        p = np.repeat(at - low - (np.cumsum(number) - number), number) + np.arange(number.sum())
        return number, own, p, t.Spans(units).hash(off[own] + p, off[own] + p + length)

    def witnesses(own: np.ndarray, p: np.ndarray, wh: np.ndarray, k1: np.ndarray, k2: np.ndarray, length: int) -> list[tuple[int, dict[str, bytes]]]:
        """What repeats within the task, and one witness of each string."""
        many = _equal_neighbours(wh)
        who, start, end = _covered(own, p, many, length)
        dealt = list(deal(_range(k1[who].view(np.uint64), parts), parts, dk1=k1[who], dk2=k2[who], start=start.astype(np.int32), end=end.astype(np.int32)))
        _, one = np.unique(wh, return_index=True)
        return dealt + list(deal(_range(wh[one], parts), parts, wh=wh[one], many=many[one], wk1=k1[own[one]], wk2=k2[own[one]], p=p[one].astype(np.int32)))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()  # a text of several tasks comes as often
        for b in batches:
            b = _text_of(b, seen)
            k1, k2 = (b.column(k).to_numpy() for k in _KEYS)
            lists = b.column("anchors")
            for i, j, buf, off in t.chunks(b.column("text"), PIECE):
                if words:
                    buf, off = _word_values(buf, off)
                part = lists[i:j]
                doc = np.repeat(np.arange(j - i), part.value_lengths().to_numpy())
                a = {k: part.flatten().field(k).to_numpy(zero_copy_only=k != "by_word") for k in ("kh", "at", "low", "high", "n", "by_word")}
                kh, at, low, high = a["kh"].view(np.uint64), a["at"], a["low"], a["high"]
                cold = a["n"] <= hot
                own1, own2 = k1[i:j], k2[i:j]
                c = np.flatnonzero(cold & ~a["by_word"])
                if len(c):
                    where = _bucket(leading(buf, off[doc[c]] + at[c]).astype(np.int64), kh[c], splitters)
                    by = np.argsort(where, kind="stable")
                    c, where = c[by], where[by]
                    dealt = []
                    edges = np.searchsorted(where, np.arange(parts + 1))
                    for p in np.flatnonzero(np.diff(edges)):
                        m = c[edges[p] : edges[p + 1]]
                        here = off[doc[m]] + at[m]
                        text, _ = t.take_spans(buf, here - low[m], here + high[m])
                        dealt.append((int(p), {"kh": kh[m].tobytes(), "k1": own1[doc[m]].tobytes(), "k2": own2[doc[m]].tobytes(), "at": at[m].tobytes(), "low": low[m].tobytes(), "high": high[m].tobytes(), "units": text.tobytes()}))
                    yield rows(dealt, False)
                m = np.flatnonzero(~cold & ~a["by_word"])
                if len(m):
                    m = m[np.lexsort((at[m], doc[m]))]
                    _, own, p, wh = windows(buf, off, doc[m], at[m], low[m], high[m], length)
                    yield rows(witnesses(own, p, wh, own1, own2, length), False)
                if not a["by_word"].any():
                    continue
                units, off = _word_values(buf, off)
                m = np.flatnonzero(~cold & a["by_word"])
                if len(m):
                    m = m[np.lexsort((at[m], doc[m]))]
                    _, own, p, wh = windows(units, off, doc[m], at[m], low[m], high[m], passage)
                    yield rows(witnesses(own, p, wh, own1, own2, passage), True)
                m = np.flatnonzero(cold & a["by_word"])
                if len(m):
                    where = _range(kh[m], parts)
                    m = m[np.argsort(where, kind="stable")]
                    edges = np.searchsorted(np.sort(where), np.arange(parts + 1))
                    number, _, _, wh = windows(units, off, doc[m], at[m], low[m], high[m], passage)
                    past = np.append(0, np.cumsum(number))
                    dealt = []
                    for p in np.flatnonzero(np.diff(edges)):
                        x = m[edges[p] : edges[p + 1]]
                        dealt.append((int(p), {"k1": own1[doc[x]].tobytes(), "k2": own2[doc[x]].tobytes(), "at": at[x].tobytes(), "low": low[x].tobytes(), "high": high[x].tobytes(), "units": wh[past[edges[p]] : past[edges[p + 1]]].tobytes()}))
                    yield rows(dealt, True)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(k1: np.ndarray, k2: np.ndarray, start: np.ndarray, end: np.ndarray, by_word: bool = words) -> pa.RecordBatch:
            return pa.record_batch([pa.array(k1), pa.array(k2), pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32)), pa.array([by_word] * len(k1), pa.bool_())], ["k1", "k2", "start", "end", "by_word"])

        def repeated(w: dict[str, np.ndarray], length: int) -> tuple[np.ndarray, ...]:
            """Runs that strings with witnesses elsewhere cover."""
            order = np.lexsort((w["p"], w["wk2"], w["wk1"], w["wh"]))
            again = np.ones(len(order), bool)
            again[_heads(*(w[k][order] for k in ("wh", "wk1", "wk2", "p")))] = False
            wh, many = w["wh"][order], w["many"][order]
            head = _heads(wh)
            count = np.diff(np.append(head, len(wh)))
            different = np.add.reduceat((~again).astype(np.int64), head)
            hit = np.repeat((different > 1) | np.maximum.reduceat(many, head), count) & ~many & ~again
            order = order[hit]
            order = order[np.lexsort((w["p"][order], w["wk2"][order], w["wk1"][order]))]
            k1, k2, p = w["wk1"][order], w["wk2"][order], w["p"][order]
            if not len(order):
                return k1, k2, p, p
            first = np.flatnonzero(np.concatenate([[True], (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1]) | (p[1:] != p[:-1] + 1)]))
            return k1[first], k2[first], p[first], p[np.append(first[1:], len(p)) - 1] + length

        kept, worded = [], []
        for b in batches:
            kept.append(b.filter(pc.invert(b.column("by_word"))) if passage else b)
            worded += [b.filter(b.column("by_word"))] if passage else []
        for some, by_word, size in ((kept, words, length), (worded, True, passage)):
            s = unpack(some, **settled)
            if len(s["start"]):
                yield out(s["dk1"], s["dk2"], s["start"], s["end"], by_word)
            w = unpack(some, **singles)
            if len(w["wh"]):
                yield out(*repeated(w, size), by_word)
        m = unpack(worded, **members, units=np.uint64)
        if len(m["units"]):
            number = (m["low"] + m["high"] - passage + 1).astype(np.int64)
            place = np.repeat(m["at"] - m["low"] - (np.cumsum(number) - number), number) + np.arange(number.sum())
            w = {"wh": m["units"], "many": np.zeros(len(place), bool), "wk1": np.repeat(m["k1"], number), "wk2": np.repeat(m["k2"], number), "p": place}
            yield out(*repeated(w, passage), True)
        del worded, some, s, w
        m = unpack(kept, **members, units=np.uint64 if words else np.uint8)
        del kept
        size = (m["low"] + m["high"]).astype(np.int64)
        first = np.cumsum(size) - size + m["low"]
        order = np.lexsort((m["at"], m["k2"], m["k1"], m["kh"]))
        order = order[_heads(*(m[k][order] for k in ("kh", "k1", "k2", "at")))]
        kh = m["kh"][order]
        edge = np.append(_heads(kh), len(kh))
        e = 0
        while e < len(edge) - 1:  # whole groups of equal grams, about SLICE suffixes at a time
            end = max(e + 1, int(np.searchsorted(edge, edge[e] + SLICE, "right")) - 1)
            some = order[edge[e] : edge[end]]
            group = np.repeat(np.arange(end - e), np.diff(edge[e : end + 1]))
            who, low, high = equal_strings(m["units"], first[some], m["low"][some].astype(np.int64), m["high"][some].astype(np.int64), group, length, gram)
            if len(who):
                row = some[who]
                yield out(m["k1"][row], m["k2"][row], m["at"][row] - high, m["at"][row] - low + length)
            e = end

    texts = keyed.select("k1", "k2", "text").mapInArrow(distinct_texts, keyed.select("k1", "k2", "text").schema)
    joined = texts.join(lists, [*_KEYS]).select("k1", "k2", "text", "anchors")
    return joined.mapInArrow(cut, schema).repartition(parts, "part").mapInArrow(compare, "k1 long, k2 long, start int, end int, by_word boolean")


def merge(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(runs):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT, words: int | None = None, passage: int | None = None) -> DataFrame:
    """Every row of ``docs`` with n_bytes, n_removed, n_spans, spans (array of start, end) and kept (the remaining bytes).

    With ``words``, repeated runs of so many words go as well, from the first byte of their first word to the last of their last.

    With ``passage``, n_passage_words counts the words of repeated runs of so many words at least; they are not removed for that.

    A run may cut a code point in two; ``kept_text`` is ``kept`` without the bytes of such broken code points.

    All columns of ``docs`` are kept in front; a clashing one gives way to the new column."""
    new = {"n_bytes": "long", "n_removed": "long", "n_spans": "long", "spans": "array<struct<start:int,end:int>>", "kept": "binary", "kept_text": "string"}
    if passage:
        new["n_passage_words"] = "long"
    old = docs.drop(*new)
    parts = ranges(docs, RANGE_BYTES)
    k1, k2, found_runs = fresh(old, "k1", "k2", "runs")
    text = F.coalesce("text", F.lit(""))
    keyed = old.withColumns({k1: F.xxhash64(F.lit(1), text), k2: F.xxhash64(F.lit(2), text)})
    texts = keyed.select(F.col(k1).alias("k1"), F.col(k2).alias("k2"), "text")
    copied = texts.groupBy("k1", "k2").agg(F.count("*").alias("n")).where("n > 1").select("k1", "k2", F.lit(0).alias("start"), F.lit(-1).alias("end"), F.lit(False).alias("by_word"))
    runs = copied.unionByName(covered_runs(texts, parts, length, gram, hot, passage=passage))
    if words:
        runs = runs.unionByName(covered_runs(texts, parts, words, min(WORD_GRAM, words), hot, words=True))
    runs = runs.groupBy(F.col("k1").alias(k1), F.col("k2").alias(k2)).agg(F.collect_list(F.struct("start", "end", "by_word")).alias(found_runs))
    names = old.columns

    def in_bytes(data: bytes, found: list[dict]) -> list[tuple[int, int]]:
        copied = any(r["end"] < 0 for r in found)  # another row has the same text
        if copied and len(data) >= length:
            return [(0, len(data))]
        runs = [(r["start"], r["end"]) for r in found if r["end"] >= 0 and not r["by_word"]]
        if words and (copied or any(r["by_word"] for r in found)):
            starts, ends, _ = word_units(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
            runs += [(int(starts[r["start"]]), int(ends[r["end"] - 1])) for r in found if r["by_word"]]
            if copied and len(starts) >= words:
                runs.append((int(starts[0]), int(ends[-1])))
        return runs

    def passage_words(data: bytes, found: list[dict]) -> int:
        if any(r["end"] < 0 for r in found):
            number = len(word_units(np.frombuffer(data, np.uint8), np.array([0, len(data)]))[0])
            if number >= passage:
                return number
        return sum(e - s for s, e in merge([(r["start"], r["end"]) for r in found if r["by_word"]]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 500):
                part = b.slice(i, 500)
                rows = []
                for text, found in zip(part.column("text").to_pylist(), part.column(found_runs).to_pylist(), strict=True):
                    data = (text or "").encode()
                    spans = merge(in_bytes(data, found or []))
                    kept, at = [], 0
                    for start, end in spans:
                        kept.append(data[at:start])
                        at = end
                    left = b"".join([*kept, data[at:]])
                    rows.append((len(data), sum(e - s for s, e in spans), len(spans), [{"start": s, "end": e} for s, e in spans], left, left.decode(errors="ignore") if spans else text, passage_words(data, found or []) if passage else 0))
                made = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])), pa.binary(), pa.string(), pa.int64())[: len(new)])]
                yield pa.record_batch([*(part.column(n) for n in names), *made], [*names, *new])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in old.schema), *(f"{k} {v}" for k, v in new.items())])
    return keyed.join(runs, [k1, k2], "left").select(*(f"`{n}`" for n in names), found_runs).mapInArrow(cut, schema)


def digest(removed: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256), and n_passage_words if it was counted."""
    more = [c for c in removed.columns if c == "n_passage_words"]
    return removed.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), *more)
