"""Operator 7 - language-model scoring by online logistic context mixing.

A text is its tokens (words ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased) and one end token, and is coded bit by bit in its order.  The WORDS most
frequent training tokens that occur twice at least have a prefix code by their counts, of which the first DEPTH bits are predicted and
the rest is shared out by counts; any other token is an escape and its bytes with a
closing newline, five bits each or thirteen, so words seen once teach what new ones look like.  A bit has three predictors, each with counts of zeros and ones in a hashed context of all training
documents: for a bit of a word code its node alone, with the word before, and with the two words before; for a bit of a byte its
node with the last two bytes of the word, the last four, and all of them.

The predictors' stretched probabilities are mixed by weights gated by the kind and place of the bit and by how sure the longest
context is.  Weights are learnt online: each training task codes its documents in order with the counts so far, and corrects
the weights after each BLOCK tokens; their mean over tasks, by bits, starts the scoring.  In scoring a text corrects
weights of its own after each BLOCK tokens, so its score depends on no other text.  An adaptive table (SSE) refines the mixed
probability by gate.  The sum over bits is the score; ``bits_per_byte`` is it per byte of the tokens and their ends.

Everything gathered covers all training documents: token counts are a grouped sum over distinct words of tasks, context counts are sums of
a table of fixed size from each task, weights are learnt from all bits.  Bounded are the code
(WORDS words at most, whole classes of like counts) and the contexts (SLOTS slots each, without a check), so in a very large corpus rare contexts share slots.

Tokens are compared by 62-bit hashes.  Null text is empty: it has the end token only.  Repeated rows are scored (and counted) each;
there are no ties but those of code lengths (least hash first); extra columns are ignored; an empty table gives an empty result.
Without training tokens the counts are 0, and the base score is that of V = 0, N = 0: all mass on unknown tokens.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm import _text as t
from stratum.llm._spark import held, most_frequent, ranges, settle_table

WORDS, DEPTH = 1 << 19, 12
SLOT_BITS = 20
SLOTS = 1 << SLOT_BITS
CONTEXTS, LEVELS = 3, 5
GATES = 12 * LEVELS * LEVELS  # kind and place of the bit, and how sure the second and the third context are
BLOCK = 64
CHUNK = 1 << 19  # bytes of text coded at a time
AHEAD = 1 << 15  # bits looked up at a time
RANGES, RANGE_BYTES = 64, 16 << 20
PRIOR = 0.3
RATE, OWN = 0.05, 0.02  # steps of the weights and of those of a text
END, ESCAPE = np.uint64(1), np.uint64(2)  # in place of hashes of words
_MUL32 = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))
_MUL = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9), np.uint64(0xD6E8FEB86659FD93))


@dataclass
class Code:
    """Sorted hashes of the words that have a code, their counts, codes, code lengths and the log2 probability of a word among those of
    one code; the escape's code, length and log2 probability apart."""

    words: np.ndarray
    counts: np.ndarray
    codes: np.ndarray
    sizes: np.ndarray
    tails: np.ndarray
    escape: tuple[int, int, float]


def prefix_code(words: np.ndarray, counts: np.ndarray, rest: int) -> Code:
    """Canonical Huffman code of the words and the escape, which stands for ``rest`` tokens.

    Codes are cut to DEPTH bits, whose predictors are mixed; words that share a cut code are told apart by their counts."""
    order = np.argsort(words)
    words, counts = words[order], counts[order]
    weights = np.append(counts, max(rest, 1))
    n = len(weights)
    leaves = np.argsort(weights, kind="stable")
    light, made, up = weights[leaves].tolist(), [], np.zeros(2 * n, np.int64)  # nodes are made in order of weight: two queues
    i = j = 0
    for k in range(n - 1):
        total = 0
        for _ in range(2):
            if i < n and (j >= len(made) or light[i] <= made[j]):
                total, up[i], i = total + light[i], n + k, i + 1
            else:
                total, up[n + j], j = total + made[j], n + k, j + 1
        made.append(total)
    depth = np.zeros(2 * n, np.int64)
    for k in range(2 * n - 3, -1, -1):  # parents have higher numbers
        depth[k] = depth[up[k]] + 1
    size = np.ones(n, np.int64)
    size[leaves] = np.maximum(depth[:n], 1)
    codes, at, last = np.zeros(len(weights), np.uint64), 0, 0
    for i in np.lexsort((np.arange(len(size)), size)).tolist():
        at <<= int(size[i]) - last
        codes[i], at, last = at, at + 1, int(size[i])
    codes >>= np.maximum(size - DEPTH, 0).astype(np.uint64)
    size = np.minimum(size, DEPTH)
    _, same = np.unique(codes | (size.astype(np.uint64) << np.uint64(32)), return_inverse=True)
    tails = np.log2(weights / np.bincount(same, weights)[same])
    return Code(words, counts, codes[:-1], size[:-1], tails[:-1], (int(codes[-1]), int(size[-1]), float(tails[-1])))


def tail_scores(code: Code, x: "Tokens", at: np.ndarray, known: np.ndarray) -> np.ndarray:
    """log2 probability of each document's tokens among those of their cut codes."""
    each = np.where(known, code.tails[at] if len(code.tails) else 0.0, code.escape[2])
    return np.bincount(x.doc, each, x.docs)


@dataclass
class Tokens:
    """The tokens of a chunk with the end tokens: hashes, document of each, place in it, and bytes of the words."""

    h: np.ndarray
    doc: np.ndarray
    place: np.ndarray
    start: np.ndarray
    size: np.ndarray
    docs: int
    buf: np.ndarray


def tokens(buf: np.ndarray, off: np.ndarray) -> Tokens:
    low = t.LOWER[buf]
    starts, ends, bounds = t.words(low, off)
    number = np.diff(bounds) + 1
    at = np.concatenate([[0], np.cumsum(number)])
    doc = np.repeat(np.arange(len(number)), number)
    place = np.arange(at[-1]) - at[doc]
    word = np.ones(at[-1], bool)
    word[at[1:] - 1] = False
    h, start, size = np.full(at[-1], END, np.uint64), np.zeros(at[-1], np.int64), np.zeros(at[-1], np.int64)
    h[word], start[word], size[word] = t.Spans(low).hash(starts, ends), starts, ends - starts
    return Tokens(h, doc, place, start, size, len(number), low)


@dataclass
class Bits:
    """Bits by blocks of BLOCK tokens: slots of each context, value, gate without sureness; runs of bits of one document, and the blocks' bounds."""

    slots: list[np.ndarray]
    value: np.ndarray
    gate: np.ndarray
    run_doc: np.ndarray
    run_size: np.ndarray
    blocks: np.ndarray  # first run of each block, and the end


# fixed values: bytes with a code of five bits; the last code is followed by eight bits
SHORT = b"abcdefghijklmnopqrstuvwxyz\n.,!-"
_SHORT_CODE = np.full(256, 31, np.uint8)
_SHORT_CODE[list(SHORT)] = np.arange(31)


def _slots(context: np.ndarray, size: np.ndarray, node: np.ndarray, k: int) -> np.ndarray:
    """Slot of each bit: of the upper half of its unit's context hash, and its node."""
    h = np.repeat((context >> np.uint64(32)).astype(np.uint32), size)
    h += node
    h *= _MUL32[k]
    h >>= np.uint32(32 - SLOT_BITS)
    return h.view(np.int32)


def _runs(doc: np.ndarray, block: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, bits, first run of each block and the end) of runs of units of ``size`` bits, which are sorted by block and document."""
    doc, block, size = doc[size > 0], block[size > 0], size[size > 0]
    if not len(doc):
        return doc, size, np.zeros(1, np.int64)
    head = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (block[1:] != block[:-1])]))
    return doc[head], np.add.reduceat(size, head), np.append(np.flatnonzero(np.concatenate([[True], block[head][1:] != block[head][:-1]])), len(head))


def bits(code: Code, x: Tokens) -> tuple[Bits, Bits, np.ndarray, np.ndarray]:
    """(bits of the word codes, of the other words' bytes, place of each token in the code, whether it has one)."""
    at, order = np.empty(len(x.h), np.int64), np.argsort(x.h)  # in order of the hashes look-ups stay close together
    at[order] = np.minimum(np.searchsorted(code.words, x.h[order]), max(len(code.words) - 1, 0))
    known = code.words[at] == x.h if len(code.words) else np.zeros(len(x.h), bool)
    one, two = np.roll(x.h, 1), np.roll(x.h, 2)
    one[x.place < 1], two[x.place < 2] = 3, 3
    block = x.place // BLOCK
    some = np.arange(len(x.h))
    if len(some) and block[some].max():
        some = some[np.argsort(block[some].astype(np.uint16) if block.max() < 1 << 16 else block[some], kind="stable")]
    size, value = np.full(len(some), code.escape[1]), np.full(len(some), code.escape[0], np.uint64)
    if len(code.words):
        size, value = np.where(known[some], code.sizes[at[some]], size), np.where(known[some], code.codes[at[some]], value)
    ends = np.cumsum(size)
    i = np.arange(size.sum(), dtype=np.uint32) - np.repeat((ends - size).astype(np.uint32), size)
    rest = np.repeat(ends.astype(np.uint32), size)
    rest -= np.arange(1, len(rest) + 1, dtype=np.uint32)  # bits of the code after this one
    path = np.repeat(value, size)
    path >>= rest  # the code up to this bit
    node = (path >> np.uint64(1)).astype(np.uint32)
    node *= _MUL32[0]
    node += i * _MUL32[1]
    contexts = (np.zeros(len(some), np.uint64), t.mix(one[some]), t.mix(one[some] * _MUL[2] + two[some]))
    slots = [_slots(c, size, node, k) for k, c in enumerate(contexts)]
    path &= np.uint64(1)
    np.minimum(i, np.uint32(17), out=i)
    i //= np.uint32(3)
    words = Bits(slots, path.astype(np.uint8), i.view(np.int32), *_runs(x.doc[some], block[some], size))
    # bytes of the other words, the closing newline included
    rare = some[~known[some] & (x.h[some] != END)]
    length = x.size[rare] + 1
    own = np.repeat(np.arange(len(rare)), length)
    place = np.arange(len(own)) - np.repeat(np.cumsum(length) - length, length)
    last = place == length[own] - 1
    byte = np.where(last, 10, x.buf[np.where(last, 0, x.start[rare][own] + place)] if len(x.buf) else 10).astype(np.uint8)
    span, here, first = t.Spans(byte), np.arange(len(byte)), np.arange(len(byte)) - place
    contexts = (span.hash(np.maximum(here - 2, first), here), span.hash(np.maximum(here - 4, first), here), span.hash(first, here) ^ _MUL[3])
    short = _SHORT_CODE[byte]
    size = np.where(short < 31, 5, 13)
    i = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    path = np.repeat(np.where(short < 31, short, np.uint32(31 << 8) | byte.astype(np.uint32)).astype(np.uint32), size) >> (np.repeat(size, size) - 1 - i).astype(np.uint32)
    node = ((path >> np.uint32(1)) + (i * 8192).astype(np.uint32) + np.uint32(1 << 30)) * _MUL32[0]
    slots = [_slots(c, size, node, k) for k, c in enumerate(contexts)]
    per = np.add.reduceat(size, np.cumsum(length) - length) if len(rare) else length
    spelt = Bits(slots, (path & np.uint32(1)).astype(np.uint8), np.repeat((6 + np.minimum(place, 5)).astype(np.int32), size), *_runs(x.doc[rare], block[rare], per))
    return words, spelt, at, known


SURE = np.int32(7)  # last bits of a stretched probability that are kept free for the sureness


def stretched(zero: np.ndarray, one: np.ndarray) -> np.ndarray:
    x = np.clip(np.log((one + np.float32(PRIOR)) / (zero + np.float32(PRIOR))), -8, 8).astype(np.float32)
    return (x.view(np.int32) & ~SURE).view(np.float32)


def sureness(seen: np.ndarray) -> np.ndarray:
    """Level of a context by its count."""
    return sum((seen > n).astype(np.int8) for n in (0, 2, 9, 49))


def paired(pull: np.ndarray, sure: np.ndarray) -> np.ndarray:
    """Stretched probability and sureness of each slot in four bytes, so that one look-up in a small table finds both."""
    return (pull.astype(np.float32).view(np.int32) & ~SURE) | sure


def looked_up(seen: np.ndarray, slots: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """(stretched probability by each context, how sure the second and the third are) of bits."""
    pairs = [seen[k].take(slots[k].astype(np.intp), mode="clip") for k in range(CONTEXTS)]
    return [(p & ~SURE).view(np.float32) for p in pairs], (pairs[1] & SURE) * np.int32(LEVELS) + (pairs[2] & SURE)


def count(table: np.ndarray, places: list[np.ndarray]) -> None:
    """Adds the bits of ``places`` (twice the slot, and the bit) to the ``table`` of (slot, bit), in place: a second table of its size would be read and written as often."""
    for at in places:
        np.add.at(table.reshape(-1), at.astype(np.intp), np.uint32(1))


class Mixer:
    """Weights by gate, and the counts of the refining table (gate, stretched probability in steps of 1/2)."""

    def __init__(self, weights: np.ndarray | None = None, refine: np.ndarray | None = None):
        self.weights = np.tile(np.array([0.6, 0.3, 0.3], np.float32), (GATES, 1)) if weights is None else weights.astype(np.float32)
        self.refine = np.zeros((GATES, 33, 2)) if refine is None else refine
        self.slope = np.full((GATES, CONTEXTS), 1.0)
        self.bits = 0

    def code(self, b: Bits, docs: int, inputs: Callable, learn: bool) -> np.ndarray | None:
        """log2 probability of each document; ``inputs(slots)`` gives stretched probabilities and how sure the contexts are.  ``learn``: the weights follow
        instead, and no probability is asked for."""
        total = np.zeros(docs)
        own = np.zeros((CONTEXTS, docs), np.float32)  # what a document's past adds to the weights
        centre = 1 / (1 + np.exp(-(np.arange(33) - 16) / 2))
        refined = ((self.refine[..., 1] + 30 * centre) / (self.refine.sum(-1) + 30)).astype(np.float32).ravel()
        begin = np.concatenate([[0], np.cumsum(b.run_size)])
        root = np.sqrt(b.run_size + 1.0)
        weights, slope = (np.ascontiguousarray(x.T) for x in (self.weights, self.slope))
        edge = begin[b.blocks]  # first bit of each block, and the end
        at = 0
        while at < len(edge) - 1:  # what no block changes is worked out for as many blocks at a time as have AHEAD bits
            past = max(at + 1, int(np.searchsorted(edge, edge[at] + AHEAD, "right")) - 1)
            base, end = edge[at], edge[past]
            pulls, sure = inputs([s[base:end] for s in b.slots])
            pulls = np.stack(pulls)
            gates = b.gate[base:end] * np.intp(LEVELS * LEVELS) + sure
            places = gates * 33 + 16
            values = b.value[base:end].astype(np.float32)
            for i in range(at, past):
                low, high = edge[i] - base, edge[i + 1] - base
                runs = slice(b.blocks[i], b.blocks[i + 1])
                doc, size, start = b.run_doc[runs], b.run_size[runs], begin[runs] - edge[i]
                x, gate, value, step = pulls[:, low:high], gates[low:high], values[low:high], places[low:high]
                w = weights.take(gate, 1, mode="clip")
                past_own = own[:, doc]
                w += past_own.repeat(size, 1)
                w *= x
                z = w[0]
                for k in range(1, CONTEXTS):
                    z += w[k]
                np.maximum(z, -18, out=z)
                np.minimum(z, 18, out=z)
                p = np.negative(z)
                np.exp(p, out=p)
                p += 1
                np.divide(1, p, out=p)
                z += z
                np.rint(z, out=z)
                np.maximum(z, -16, out=z)
                np.minimum(z, 16, out=z)
                step += z.astype(np.intp)
                error = value - p
                if not learn:
                    p += refined.take(step, mode="clip")
                    p *= np.float32(0.5)
                    value -= 1
                    p += value
                    np.abs(p, out=p)  # of the bit that came
                    np.maximum(p, 1e-7, out=p)
                    np.log2(p, out=p)
                    total[doc] += np.add.reduceat(p, start)
                x *= error
                own[:, doc] = np.clip(past_own + OWN * np.add.reduceat(x, start, 1) / root[runs], -0.5, 0.5)
                if learn:
                    g = np.stack([np.bincount(gate, e, GATES) for e in x])
                    slope += g * g
                    weights += RATE * g / np.sqrt(slope)
            if learn:
                places *= 2
                places += b.value[base:end]
                self.refine += np.bincount(places, minlength=GATES * 66).reshape(GATES, 33, 2)
            at = past
        if not learn:
            return total
        self.bits += len(b.value)
        self.weights, self.slope = np.ascontiguousarray(weights.T), np.ascontiguousarray(slope.T)
        return None


def word_counts(texts: DataFrame) -> DataFrame:
    """(h, c) of each distinct token of ``texts(text)``, c its count."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h, c = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        waiting: list[np.ndarray] = []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            new, number = np.unique(np.concatenate(waiting), return_counts=True) if waiting else (h[:0], c[:0])
            every = np.concatenate([h, new])
            order = np.argsort(every, kind="stable")
            every, number = every[order], np.concatenate([c, number])[order]
            head = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]])) if len(every) else np.zeros(0, np.int64)
            return every[head], np.add.reduceat(number, head) if len(head) else number

        for b in batches:
            for _, _, buf, off in t.chunks(b.column("text")):
                waiting.append(tokens(buf, off).h)
            if sum(map(len, waiting)) > 2_000_000:
                h, c = merged()
                waiting = []
            if len(h) > 4_000_000:
                yield pa.record_batch([pa.array(h.view(np.int64)), pa.array(c)], ["h", "c"])
                h, c = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        h, c = merged()
        for i in range(0, len(h), 1 << 16):
            yield pa.record_batch([pa.array(h[i : i + (1 << 16)].view(np.int64)), pa.array(c[i : i + (1 << 16)])], ["h", "c"])

    return texts.select("text").mapInArrow(count, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))


def learn(rows: DataFrame, code: Code) -> tuple[np.ndarray, np.ndarray, Mixer]:
    """(stretched probabilities and sureness of each context's slots, mixer) from all training documents (text).

    A task sends its table of counts in RANGES pieces, of the same size for any input; so does the driver get one."""
    shared = rows.sparkSession.sparkContext.broadcast(code)
    size = CONTEXTS * SLOTS // RANGES
    columns = ["part", "numbers", "mixer"]

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((CONTEXTS, SLOTS, 2), np.uint32)
        waiting: list[list[np.ndarray]] = [[] for _ in range(CONTEXTS)]
        mixer = Mixer()

        seen = paired(np.zeros((CONTEXTS, SLOTS), np.float32), np.zeros((CONTEXTS, SLOTS), np.int8))

        def settle(more: bool) -> None:
            for k, places in enumerate(waiting):
                count(table[k], places)
                places.clear()
                if more:
                    zero, one = table[k].T.astype(np.float32)  # counts stand until the next settling, and so does what follows from them
                    seen[k] = paired(stretched(zero, one), sureness(zero + one))

        def inputs(slots: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
            return looked_up(seen, slots)

        for b in batches:
            for _, _, buf, off in t.chunks(b.column("text"), CHUNK):
                x = tokens(buf, off)
                for part in bits(shared.value, x)[:2]:
                    mixer.code(part, x.docs, inputs, learn=True)
                    for k in range(CONTEXTS):
                        waiting[k].append(part.slots[k] * 2 + part.value)
                if sum(map(len, waiting[0])) > 4_000_000:
                    settle(True)
        settle(False)
        if table.any():
            flat = table.reshape(RANGES, size, 2)
            packed = np.concatenate([mixer.weights.ravel().astype(float) * mixer.bits, mixer.refine.ravel(), [mixer.bits]])
            yield pa.record_batch([pa.array(range(RANGES), pa.int32()), pa.array([x.tobytes() for x in flat], pa.binary()), pa.array([packed.tobytes(), *[b""] * (RANGES - 1)], pa.binary())], columns)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        mixers: dict[int, np.ndarray] = {}
        for b in batches:
            for p, x, m in zip(*(b.column(c).to_pylist() for c in columns), strict=True):
                sums[p] = sums.get(p, 0) + np.frombuffer(x, np.uint32).astype(np.float32)
                if m:
                    mixers[p] = mixers.get(p, 0) + np.frombuffer(m)
        for p, x in sums.items():
            zero, one = x.reshape(size, 2).T
            made = stretched(zero, one).astype(np.float16).tobytes() + sureness(zero + one).tobytes()
            yield pa.record_batch([pa.array([p], pa.int32()), pa.array([made], pa.binary()), pa.array([mixers[p].tobytes() if p in mixers else b""], pa.binary())], columns)

    schema = "part int, numbers binary, mixer binary"
    table, sure, mixed = np.zeros((RANGES, size), np.float32), np.zeros((RANGES, size), np.int8), np.zeros(GATES * (CONTEXTS + 66) + 1)
    parts = min(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), RANGES)
    for row in rows.select("text").mapInArrow(train, schema).repartition(parts, "part").mapInArrow(add, schema).collect():  # RANGES rows
        table[row["part"]] = np.frombuffer(row["numbers"], np.float16, size)
        sure[row["part"]] = np.frombuffer(row["numbers"], np.int8, size, 2 * size)
        if row["mixer"]:
            mixed += np.frombuffer(bytes(row["mixer"]))
    weights = mixed[: GATES * CONTEXTS].reshape(GATES, CONTEXTS) / mixed[-1] if mixed[-1] else None
    return table.reshape(CONTEXTS, SLOTS), sure.reshape(CONTEXTS, SLOTS), Mixer(weights, mixed[GATES * CONTEXTS : -1].reshape(GATES, 33, 2))


def token_scores(docs: DataFrame, folds: int = 10, out_fold: int = 0) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte) of every row of ``docs(doc_id, text)``."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", (~held(F.col("doc_id"), folds, out_fold)).alias("train"), "text")
    vocabulary = settle_table(word_counts(rows.where("train")))
    n_total, v_total = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    top = most_frequent(vocabulary.where("c > 1"), "c", WORDS).toPandas()
    counts = top["c"].to_numpy(np.int64)
    code = prefix_code(top["h"].to_numpy(np.int64).view(np.uint64), counts, n_total - int(counts.sum()))
    table, sure, mixer = learn(rows.where("train"), code)
    model = docs.sparkSession.sparkContext.broadcast((code, table, sure, mixer.weights, mixer.refine))
    mass = n_total + 0.1 * (v_total + 1)
    names = ["row", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "bits_per_byte", "rare", "uses"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, table, sure, weights, refine = model.value
        mixer = Mixer(weights, refine)
        seen = paired(table, sure)

        def inputs(slots: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
            return looked_up(seen, slots)

        base = np.log10((code.counts + 0.1) / mass)
        for b in batches:
            for i, j, buf, off in t.chunks(b.column("text"), CHUNK):
                x = tokens(buf, off)
                *parts, at, known = bits(code, x)
                total = sum(mixer.code(part, x.docs, inputs, learn=False) for part in parts) + tail_scores(code, x, at, known)
                n = np.bincount(x.doc, minlength=x.docs)
                sizes = np.bincount(x.doc, x.size + 1, x.docs)
                under = np.bincount(x.doc[known], base[at[known]], x.docs)
                rare = np.flatnonzero(~known)
                rare = rare[np.lexsort((x.h[rare], x.doc[rare]))]
                head = np.flatnonzero(np.concatenate([[True], (x.h[rare][1:] != x.h[rare][:-1]) | (x.doc[rare][1:] != x.doc[rare][:-1])])) if len(rare) else rare
                uses = np.diff(np.append(head, len(rare))).astype(np.int32)
                offsets = pa.array(np.searchsorted(x.doc[rare[head]], np.arange(x.docs + 1)).astype(np.int32))
                part = b.slice(i, j - i)
                yield pa.record_batch([part.column("row"), part.column("doc_id"), pa.array(~part.column("train").to_numpy(zero_copy_only=False).astype(bool)), pa.array(n), pa.array(np.bincount(x.doc[known], minlength=x.docs)), pa.array(under), pa.array(total * np.log10(2)), pa.array(-total / sizes), pa.ListArray.from_arrays(offsets, pa.array(x.h[rare[head]].view(np.int64))), pa.ListArray.from_arrays(offsets, pa.array(uses))], names)

    scored = settle_table(rows.mapInArrow(score, f"row long, doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double, bits_per_byte double, rare array<long>, uses array<int>"))
    # tokens without a code: their counts come by a join on the token, one row for each document and token
    parts = ranges(docs, RANGE_BYTES)
    each = scored.where(F.size("rare") > 0).select("row", F.explode(F.arrays_zip("rare", "uses")).alias("x")).select("row", F.col("x.rare").alias("h"), F.col("x.uses").alias("uses"))
    found = each.repartition(parts, "h").join(vocabulary, "h", "left").groupBy("row").agg(F.sum(F.when(F.col("c").isNotNull(), F.col("uses")).otherwise(0)).alias("more_known"), F.sum(F.col("uses") * F.log10((F.coalesce("c", F.lit(0)) + 0.1) / F.lit(float(mass)))).alias("more_base"))
    whole = scored.drop("rare", "uses").join(found, "row", "left")
    return whole.select("doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).cast("long").alias("n_known"), F.lit(int(n_total)).cast("long").alias("train_tokens"), (F.col("base_score") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"), "score", "bits_per_byte")
