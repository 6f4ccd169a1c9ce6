"""Models against plain re-implementations, hard inputs of the hashing and of the joins, and edge rows of the pipeline's stages."""

import collections
import math
import re
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_operators import DOCS, WORD, brute_classes, brute_cut, brute_words, rows

import corpus_pipeline
from stratum.llm import _text as t
from stratum.llm import context_mixing, html_text, jaccard_join, language, quality_pairs, quality_rules, repeated_bytes, toxicity


def chunk(texts):
    return t.raw(pa.array(texts, pa.large_string()))


def thue_morse(n):
    word = "a"
    for _ in range(n):
        word += word.translate(str.maketrans("ab", "ba"))
    return word


def test_no_certain_collisions(spark):
    a = thue_morse(10)
    b = a.translate(str.maketrans("ab", "ba"))
    frame = spark.createDataFrame([(1, a), (2, b), (3, f"{a}\n{b}\n{a}")], "doc_id long, text string")
    got = {r["doc_id"]: (r["component_id"], r["n_links"]) for r in jaccard_join.near_classes(frame).collect()}
    assert got == {1: (1, 0), 2: (2, 0), 3: (3, 0)}
    assert quality_rules.base_counts(*chunk([f"{a}\n{b}", f"{a}\n{a}"]))["n_dup_lines"].tolist() == [0, 1]


def test_spans_equal_plain_polynomials():
    for values in (np.frombuffer(b"some bytes \x00\xff and more", np.uint8), np.array([0, 1 << 63, (1 << 64) - 1, 5], np.uint64)):
        lanes = (values, values) if values.dtype.itemsize < 4 else (values & np.uint64(t.PRIME), values >> np.uint64(33))
        for i in range(len(values)):
            for j in range(i, len(values) + 1):
                want = 0
                for base, lane in zip(t._BASES, lanes, strict=True):
                    want = want << 31 | sum((int(v) + 1) * pow(base, k, t.PRIME) for k, v in enumerate(lane[i:j])) % t.PRIME
                assert t.Spans(values).hash(np.array([i]), np.array([j]))[0] == t.mix(np.array([want], np.uint64))[0]


TEXTS = ["Good words, well put. And more of them!", "## bad *** $$ text", "", "the the the", "Füße! café\n\nline line", "x" * 30 + " " + "y" * 30]


def test_pairwise_features():
    for text, got in zip(TEXTS, quality_pairs.features(*chunk(TEXTS)), strict=True):
        w = WORD.findall(text)
        n, chars = max(len(w), 1), max(len(text), 1)
        share = [sum(c in marks for c in text) / chars for marks in ("#*$%&|<>", "!", ".,;:?", "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "\n")]
        assert got[0] == pytest.approx(math.log1p(len(w))) and got[1:7] == pytest.approx(share, abs=1e-6)
        assert got[7] == pytest.approx(len({x.lower() for x in w}) / n) and got[9] == pytest.approx(sum(len(x.encode()) for x in w) / n / 10)


def test_pairs_prefer_what_they_learn():
    rng = np.random.default_rng(0)
    good, bad = rng.normal(1, 1, (300, 3)), rng.normal(-1, 1, (300, 3))
    x, y = np.concatenate([good, bad]), np.repeat([1, 0], 300)
    model = quality_pairs.fit(x, y)
    z = (x / model["scale"]) @ model["w"]
    assert (z[:300, None] > z[None, 300:]).mean() > 0.95 and (model["w"] > 0).all()
    assert model["cut"] == pytest.approx(np.quantile(z, 0.5), abs=0.2)
    assert ((quality_pairs.apply(model, x) >= quality_pairs.CUT) == (z >= model["cut"])).mean() > 0.999


def test_quality_probability_equals_plain_sum():
    rng = np.random.default_rng(1)
    model = {"w": rng.normal(0, 1, (3, quality_rules.BUCKETS)).astype(np.float32), "bias": 0.3, "platt": (1.2, -0.4)}
    got = quality_rules.probability(model, *chunk(TEXTS))
    for text, p in zip(TEXTS, got, strict=True):
        low = bytes(c + 32 if 65 <= c <= 90 else c for c in text.encode())
        z = model["bias"]
        grams = [[int(t.Spans(np.frombuffer(w, np.uint8)).hash(np.array([0]), np.array([len(w)]))[0]) & quality_rules.BUCKETS - 1 for w in re.findall(rb"[^\x20\x09-\x0D]+", low)]]
        for k, salt in ((3, 0x9E3779B1), (5, 0x85EBCA77)):
            out = []
            for i in range(len(low) - k + 1):
                h = 0
                for c in low[i : i + k]:
                    h = (h * 0x01000193 + c) & 0xFFFFFFFF
                out.append((((h ^ h >> 15) * salt) & 0xFFFFFFFF) >> 14)
            grams.append(out)
        for w, ids in zip(model["w"], grams, strict=True):
            z += float(sum(w[i] for i in ids)) / max(len(ids), 1)
        assert p == pytest.approx(1 / (1 + math.exp(-(1.2 * z - 0.4))), abs=1e-5)


def test_toxicity_score_equals_plain_windows():
    rng = np.random.default_rng(2)
    model = {"table": rng.normal(0, 1, toxicity.BUCKETS).astype(np.float32), "bias": -0.2}
    texts = [*TEXTS, " ".join(f"word{i}" for i in range(70))]

    def bucket(gram):
        h = len(gram)
        for c in gram:
            h = (h * 0x01000193 + c) & 0xFFFFFFFF
        return (((h ^ h >> 16) * 0x7FEB352D) & 0xFFFFFFFF) >> 32 - toxicity.BITS

    for text, p in zip(texts, toxicity.score_texts(model, *chunk(texts)), strict=True):
        means = []
        for w in re.findall(rb"[0-9a-z\x80-\xff]+", bytes(c + 32 if 65 <= c <= 90 else c for c in text.encode())):
            ids = [int(t.Spans(np.frombuffer(w, np.uint8)).hash(np.array([0]), np.array([len(w)]))[0]) & toxicity.BUCKETS - 1]
            padded = b" " + w + b" "
            ids += [bucket(padded[i : i + k]) for k in toxicity.GRAMS for i in range(len(padded) - k + 1)]
            means.append(np.mean([model["table"][i] for i in ids]))
        windows = [means[i : i + toxicity.WINDOW] for i in range(0, max(len(means) - toxicity.WINDOW + toxicity.STRIDE, 1), toxicity.STRIDE)]
        best = max((np.mean(w) if w else 0.0) for w in windows)
        assert p == pytest.approx(1 / (1 + math.exp(-(best - 0.2))), abs=1e-5)


def test_cross_parsing_equals_plain_parsing():
    samples = {"aa": b"der hund und die katze und der vogel ", "bb": b"the dog and the cat and the bird "}
    model = language.fit([(k, v.strip()) for k, v in samples.items()])  # the fit adds the blank at the end
    texts = ["the dog und die katze", "zzz", "a the dog, and!", "und und und", "x" * 50]
    sym, at = language.symbols(*chunk(texts))
    got = language.phrases(model, sym, at)
    for i in range(len(texts)):
        plain = sym[at[i] : at[i + 1]].tobytes()
        for k, sample in enumerate(samples.values()):
            n, phrase = 1, b""
            for c in (plain[p : p + 1] for p in range(len(plain))):  # a phrase ends where it can't go on
                if phrase + c in sample:
                    phrase += c
                else:
                    n, phrase = n + 1, c if c in sample else b""
            assert got[i, k] == n


def test_language_of_a_text_depends_on_no_other(spark):
    learnt = [(i, x, lang) for i, (x, lang) in enumerate([("der hund und die katze gehen", "de"), ("the dog and the cat go", "en")] * 30)]
    asked = ["the dog goes", "1. der hund geht", "?the cat", "katze", "a b c the"]
    both = []
    for order in (asked, asked[::-1], [x for a in asked for x in (a, f"{a}.", "zz")]):
        frame = spark.createDataFrame([*learnt, *((1000 + i, x, None) for i, x in enumerate(order))], "doc_id long, text string, lang string").coalesce(1)
        found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.languages(frame).collect()}
        both.append({x: found[1000 + i] for i, x in enumerate(order) if x in asked})
    assert both[0] == both[1] == both[2]


def test_languages_beyond_the_rows(spark, monkeypatch):
    monkeypatch.setattr(language, "ROWS", 6)
    frame = spark.createDataFrame([(i, f"{chr(97 + i % 9) * 3} {chr(98 + i % 9) * 4}", f"l{i % 9}") for i in range(90)], "doc_id long, text string, lang string")
    found = language.languages(frame).collect()
    assert {r["lang_pred"] for r in found} == {f"l{i}" for i in range(9)}  # each keeps a row


def test_mixed_bits_equal_a_plain_model():
    """Code, contexts, slots, mixing and its corrections, bit by bit."""
    texts = ["the cat and the dog the cat", "a rare wordé the dog", "", "the " * 200]
    x = context_mixing.tokens(*chunk(texts))
    known, count = np.unique(x.h, return_counts=True)
    code = context_mixing.prefix_code(known[count > 1], count[count > 1], int(count[count == 1].sum()))
    assert sum(2.0 ** (-int(s) + float(tail)) for s, tail in zip([*code.sizes, code.escape[1]], [*code.tails, code.escape[2]], strict=True)) <= 1 + 1e-9
    rng = np.random.default_rng(0)
    table = rng.normal(0, 1, (context_mixing.CONTEXTS, context_mixing.SLOTS)).astype(np.float32)
    sure = rng.integers(0, context_mixing.LEVELS, (context_mixing.CONTEXTS, context_mixing.SLOTS)).astype(np.int8)
    weights = rng.normal(0.4, 0.1, (context_mixing.GATES, context_mixing.CONTEXTS)).astype(np.float32)
    refine = rng.integers(0, 50, (context_mixing.GATES, 33, 2)).astype(float)
    inputs = lambda slots: ([table[k].take(slots[k]) for k in range(context_mixing.CONTEXTS)], sure[1].take(slots[1]) * context_mixing.LEVELS + sure[2].take(slots[2]))
    *parts, at, found = context_mixing.bits(code, x)
    got = [context_mixing.Mixer(weights, refine).code(p, x.docs, inputs, False) for p in parts]
    centre = [1 / (1 + math.exp(-(i - 16) / 2)) for i in range(33)]
    for part, total in zip(parts, got, strict=True):
        begin = np.concatenate([[0], np.cumsum(part.run_size)])
        for doc in range(x.docs):
            own, want = np.zeros(context_mixing.CONTEXTS), 0.0
            for r in np.flatnonzero(part.run_doc == doc):
                grad = np.zeros(context_mixing.CONTEXTS)
                for b in range(begin[r], begin[r + 1]):
                    v = np.array([table[k, part.slots[k][b]] for k in range(context_mixing.CONTEXTS)])
                    gate = part.gate[b] * 25 + sure[1, part.slots[1][b]] * 5 + sure[2, part.slots[2][b]]
                    z = float(np.clip((weights[gate] + own) @ v, -18, 18))
                    p = 1 / (1 + math.exp(-z))
                    step = int(np.clip(np.rint(np.float32(2 * z)), -16, 16)) + 16
                    q = 0.5 * (p + (refine[gate, step, 1] + 30 * centre[step]) / (refine[gate, step].sum() + 30))
                    want += math.log2(max(q if part.value[b] else 1 - q, 1e-7))
                    grad += (part.value[b] - p) * v
                own = np.clip(own + context_mixing.OWN * grad / math.sqrt(part.run_size[r] + 1), -0.5, 0.5)
            assert total[doc] == pytest.approx(want, abs=0.02 + 1e-3 * abs(want))
    # the word codes' bits spell the code of each token
    whole = parts[0]
    for doc in range(x.docs):
        mine = np.concatenate([whole.value[b : b + n] for b, n, d in zip(np.concatenate([[0], np.cumsum(whole.run_size)[:-1]]), whole.run_size, whole.run_doc, strict=True) if d == doc])
        spelt = "".join(f"{int(code.codes[at[i]]) if found[i] else code.escape[0]:0{int(code.sizes[at[i]]) if found[i] else code.escape[1]}b}" for i in np.flatnonzero(x.doc == doc))
        assert "".join(map(str, mine)) == spelt


def test_context_mixing_sees_order_and_neighbours(spark, tmp_path):
    base = ["red fox jumps over lazy dogs near old mills", "cold rain falls on quiet green hills today"]
    texts = [base[i % 2] for i in range(400)]
    shuffled = " ".join(sorted(base[0].split()))
    frame = spark.createDataFrame([*enumerate(texts), (900, base[0]), (901, shuffled)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in context_mixing.token_scores(frame).collect()}
    assert got[900]["score"] > got[901]["score"] and got[900]["base_score"] == pytest.approx(got[901]["base_score"])
    assert got[0]["score"] == pytest.approx(got[2]["score"], abs=1e-4)
    assert got[0]["bits_per_byte"] == pytest.approx(-got[0]["score"] / math.log10(2) / (len(base[0]) + 2), rel=1e-6)


def test_equal_rows_take_no_longer(spark):
    text = " ".join(f"w{i}" for i in range(200))
    frame = spark.range(10_000).select(F.col("id").alias("doc_id"), F.lit(text).alias("text"))
    began = time.perf_counter()
    got = repeated_bytes.digest(repeated_bytes.remove_repeats(frame)).groupBy("n_bytes", "n_removed", "n_spans").count().collect()
    assert [tuple(r) for r in got] == [(len(text), len(text), 1, 10_000)] and time.perf_counter() - began < 180


@pytest.mark.parametrize("hot", [1000, 3])
def test_repeats_in_hard_texts(spark, hot):
    """Runs of one byte, periods, long texts, passages at edges, equal rows."""
    rng = np.random.default_rng(5)
    letters = lambda n: "".join(chr(97 + x) for x in rng.integers(0, 26, n))
    passage, long = letters(150), letters(12_000)
    texts = ["a" * 300, "ab" * 200, "a" * 59, letters(3000) + passage, passage + letters(500), passage + "b" * 70 + passage, long, letters(40) + long[5000:5100], long[:100] + letters(2000), long[:60], long[:59], passage, passage, None, ""]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = sorted(tuple(r) for r in repeated_bytes.digest(repeated_bytes.remove_repeats(frame, 60, 16, hot)).collect())
    assert got == [(i, *x) for i, x in enumerate(brute_cut(texts, 60))]


def test_repeated_words_in_long_texts(spark):
    rng = np.random.default_rng(6)
    long = [f"w{x}" for x in rng.integers(0, 10_000, 6000)]
    texts = [" ".join(long), "start " + "\n".join(long[3000:3040]) + " end", " ".join(f"z{i}" for i in range(100)), "one two"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [bytes(r["kept"]) for r in repeated_bytes.remove_repeats(frame, 400, 64, words=20).orderBy("doc_id").collect()]
    assert got == brute_words(texts, 400, 20)


@pytest.mark.parametrize(("k", "percent"), [(3, 90), (5, 80)])
def test_links_of_long_and_crowded_texts(spark, k, percent, monkeypatch):
    """Long texts, a crowd of near copies in several blocks, and passages that most texts share."""
    monkeypatch.setattr(jaccard_join, "BLOCK", 16)
    rng = np.random.default_rng(7)
    long = [f"w{x}" for x in rng.integers(0, 3000, 12_000)]
    crowd = [f"c{i}" for i in range(150)]
    shared = [f"s{i}" for i in range(60)]
    texts = [" ".join(long), " ".join([*long[:-200], *(f"q{i}" for i in range(200))]), " ".join(long[: 11_000 if percent == 90 else 9700])]
    for i in range(45):
        mine = list(crowd)
        for _ in range(rng.integers(0, 6)):
            mine[rng.integers(150)] = f"x{rng.integers(1e6)}"
        texts.append(" ".join(mine))
    texts += [" ".join([*shared, *(f"o{i}_{j}" for j in range(int(rng.integers(5, 300))))]) for i in range(40)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = jaccard_join.near_classes(frame, k, percent).toPandas()
    have = sorted((str(float(a)), b, int(c), d) for a, b, c, d in got[["doc_id", "n_shingles", "component_id", "n_links"]].itertuples(index=False))
    frame = frame.toPandas()
    frame["doc_id"] = frame["doc_id"].astype(float)
    assert have == brute_classes(frame, k, percent)


def test_sketches_lose_no_partner():
    rng = np.random.default_rng(8)
    for percent in (80, 90):
        for n in (1, 5, 70, 400):
            base = rng.integers(0, 1 << 62, n).astype(np.uint64)
            sets = [np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))]
            for _ in range(8):
                x = base[: n - int(rng.integers(0, 1 + n // 8))].copy()
                x[rng.integers(0, len(x), int(rng.integers(0, 1 + n // 6)))] = rng.integers(0, 1 << 62)
                sets.append(np.unique(x))
            links = [any(100 * len(np.intersect1d(a, b)) >= percent * len(np.union1d(a, b)) for j, b in enumerate(sets) if j != i) for i, a in enumerate(sets)]
            kept = jaccard_join.with_partner(np.array([len(x) for x in sets]), [jaccard_join.parity_sketch(x) for x in sets], percent)
            assert all(k or not link for k, link in zip(kept, links, strict=True))


def test_many_null_ids(spark):
    frame = spark.createDataFrame([(None, f"some words of text {i % 3} here") for i in range(30)], "doc_id long, text string")
    got = jaccard_join.near_classes(frame).toPandas()
    assert len(got) == 30 and (got["n_links"] == 9).all() and got["component_id"].isna().all()


def test_nested_and_long_pages(spark):
    deep, long = "<div>a" * 20_000, "<article>" + "<p>Some words, and more of them here.</p>" * 5000 + "</article>"
    pages = spark.createDataFrame([(1, "u", deep, "x"), (2, "v", long, "y")], "page_id long, url string, html string, text string")
    began = time.perf_counter()
    got = {r["page_id"]: r for r in html_text.extract_text(pages).collect()}
    assert time.perf_counter() - began < 180 and len(got) == 2
    assert got[2]["text"].count("Some words") == 5000


def brute_blocks(html):
    """Texts of flat markup by regular expressions."""
    inner = re.sub(r"<(script|style).*?</\1>", "", html, flags=re.S)
    return [x for x in (" ".join(html_text.html.unescape(re.sub(r"<[^>]*>", "", p)).split()) for p in re.split(r"</?(?:p|div|h1|li|ul|body|nav|br)\b[^>]*>", inner)) if x]


def test_blocks_of_flat_markup():
    pages = ["<body><p>a &amp; b</p><div>c <b>d</b>\n e</div></body>", "<ul><li>x<li>y</ul>z", "<p>1<script>if (a<b) {}</script>2</p>", "no tags", "<nav><p>q</nav><h1> t </h1>"]
    for page in pages:
        assert [text for _, text, _ in html_text.blocks(page)] == brute_blocks(page)


@pytest.mark.parametrize("stage", range(5))
def test_stages_on_edge_rows(spark, sf, stage, tmp_path):
    """Nulls in every column, empty and very long texts, repeated rows and columns with clashing names; then no rows."""
    f = corpus_pipeline.STAGES[stage][1]
    for name, data in (("some", rows()), ("none", [])):
        spark.createDataFrame(data, DOCS).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        out = f(spark, docs, sf)
        got = out.collect()
        assert stage == 4 or out.columns == docs.columns
        if name == "none":
            assert not got
        elif stage in (2, 4):
            assert len(got) == len(data)
        elif stage == 1:
            texts = collections.Counter(r["text"] for r in got)
            assert texts["one"] == 1 and texts[None] == 2
        elif stage == 3:
            assert len(got) == len(data)  # no row holds a benchmark item



def test_context_mixing_learns_from_all_bits(spark):
    """Weights follow every bit of a task, also after millions of them."""
    rng = np.random.default_rng(2)
    texts = [" ".join(f"w{k}" for k in rng.integers(0, 4000, 10_000)) for _ in range(40)]
    x = context_mixing.tokens(*chunk(texts))
    known, count = np.unique(x.h, return_counts=True)
    code = context_mixing.prefix_code(known, count, 0)
    every = sum(len(part.value) for part in context_mixing.bits(code, x)[:2])
    assert every > 3_000_000
    mixer = context_mixing.learn(spark.createDataFrame([(v,) for v in texts], "text string").coalesce(1), code)[2]
    assert mixer.refine.sum() == every


def brute_passages(texts, n):
    """Words of each text that a run of n words covers which starts elsewhere too."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", x or "") for x in texts]
    seen = collections.Counter(tuple(w[p : p + n]) for w in words for p in range(len(w) - n + 1))
    return [len({p + i for p in range(len(w) - n + 1) if seen[tuple(w[p : p + n])] > 1 for i in range(n)}) for w in words]


@pytest.mark.parametrize("hot", [1000, 2])
def test_passages_shorter_than_the_bytes_are_counted(spark, hot):
    """A repeated run of 51 words that has fewer than 400 bytes is counted, and nothing else is removed for it."""
    rng = np.random.default_rng(8)
    some = lambda n: " ".join(f"{x:x}" for x in rng.integers(0, 60_000, n))
    short, other, long = some(51), some(50), some(5000)
    assert len(short) < 400
    texts = [some(70) + " " + short, short + "\n" + some(300), f"{some(9)} {other} {some(4)}", f"{some(90)} {other} {some(3)}", long, some(20) + " " + " ".join(long.split()[2000:2080]), short + " q " + short, *[some(60)] * 2, *[some(30)] * 2, *(f"{some(3)} {short} {some(5)}" for _ in range(4)), None, "", "a"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    made = repeated_bytes.digest(repeated_bytes.remove_repeats(frame, hot=hot, passage=51)).orderBy("doc_id").collect()
    assert [r["n_passage_words"] for r in made] == brute_passages(texts, 51)
    assert [tuple(r)[:-1] for r in made] == [(i, *x) for i, x in enumerate(brute_cut(texts, 400))]
    assert made[0]["n_passage_words"] == 51 and made[0]["n_removed"] == 0 and made[2]["n_passage_words"] == 0
