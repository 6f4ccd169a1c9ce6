"""Operators against brute force, held-out accuracy and edge cases."""

import collections
import hashlib
import math
import re
import time
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratum.llm import context_mixing, decontaminate, html_text, jaccard_join, language, mixing, quality_pairs, quality_rules, repeated_bytes, toxicity
from stratum.llm._spark import components, labelled_sample

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, k1 string, row string, n_words string, digest string"
PASSAGE = " ".join(f"passage{i} é" for i in range(60))


def rows():
    """Nulls, empty and blank texts, ties, repeated rows, null keys and a very long text."""
    long = " ".join(f"w{i * i % 977}" for i in range(30_000))
    texts = [None, "", "  \n\t ", "one", "one", "two words", f"start {PASSAGE} end", f"other {PASSAGE} tail", f"other {PASSAGE} tail", PASSAGE, long, "ein Wort und noch eins " * 12, "le mot et la phrase " * 12, "!!! ### 12", "Straße ÉCOLE ñandú " * 30]
    out = [(i, x, ["en", "de", None][i % 3], ["a", "b", None, "B"][i % 4], 1, "x", "y", "z", "q", "d") for i, x in enumerate(texts)]
    return [*out, out[7], (None, "one", None, None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, (i // 2) % 2) for i in range(14)] + [(3, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def table(spark, sf):
    big = sf.replace("sf0.001", "sf0.01")
    return lambda name: spark.read.parquet(f"{big}/{name}.parquet")


def words(text):
    return WORD.findall((text or "").translate(LOW))


def union_find(n, pairs):
    up = list(range(n))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def test_components(spark):
    edges = [(1, 2), (2, 3), (10, 11), (11, 12), (12, 13), (13, 14), (5, 5), (20, 1)]
    got = {r["id"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 20: 1, 10: 10, 11: 10, 12: 10, 13: 10, 14: 10}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def held_out_accuracy(scored, labels, label):
    joined = scored.where("held_out").join(labels, "doc_id").toPandas()
    return (joined["predicted"] == joined[label]).mean(), joined


def test_quality_pairs(table):
    scored = quality_pairs.quality_scores(table("documents"), table("labels"))
    accuracy, joined = held_out_accuracy(scored, table("labels"), "quality")
    assert accuracy > 0.93
    assert all((zlib.crc32(str(d).encode()) % 4 == 2) for d in joined["doc_id"])
    assert scored.where("score NOT BETWEEN 0 AND 1 OR predicted <> CAST(score >= 0.7 AS INT)").count() == 0


def test_toxicity(table):
    scored = toxicity.toxicity_scores(table("documents"), table("labels"))
    accuracy, joined = held_out_accuracy(scored, table("labels"), "toxic")
    assert accuracy > 0.9
    assert all(zlib.crc32(str(d).encode()) % 5 == 0 for d in joined["doc_id"])


def test_samples_are_bounded_where_ids_repeat(spark):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 0), (3, 1), (3, 0), (4, None)], "doc_id long, quality int")
    docs = spark.range(70_000).selectExpr("1L AS doc_id", "concat('text ', id) AS text").unionByName(spark.createDataFrame([(2, "b"), (2, "b"), (3, "c"), (4, "d")], "doc_id long, text string"))
    got = labelled_sample(docs, labels, "quality", 100, None, 1).collect()
    assert sorted((r["doc_id"], r["y"]) for r in got) == [(1, 1), (2, 0)]
    again = labelled_sample(docs.repartition(7), labels, "quality", 100, None, 1).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))
    spoken = docs.withColumn("lang", F.when(F.col("doc_id") == 1, "en").otherwise("de"))
    assert language.languages(spoken).where("lang_pred = 'und'").count() == 0


def test_toxicity_finds_toxic_texts(spark):
    """On held-out rows: recall and precision, which no constant has, and the order of the scores."""
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = toxicity.toxicity_scores(spark.read.parquet(f"{folder}/documents.parquet"), labels).where("held_out").join(labels.where("toxic IS NOT NULL"), "doc_id").toPandas()
    hit, toxic = rows["predicted"] == 1, rows["toxic"] == 1
    assert (hit & toxic).sum() >= 0.8 * toxic.sum() and (hit & toxic).sum() >= 0.8 * hit.sum()
    ranks = rows["score"].rank()
    assert (ranks[toxic].sum() - toxic.sum() * (toxic.sum() + 1) / 2) / (toxic.sum() * (~toxic).sum()) > 0.95


def test_misspelt_words_share_subwords():
    texts = [f"alpha beta gamma {w} delta" for w in ["worthless", "worthlessly", "disgusting"] * 20] + ["alpha beta gamma delta epsilon"] * 60
    model = toxicity.fit(texts, np.array([1] * 60 + [0] * 60))
    from stratum.llm import _text as t
    import pyarrow as pa

    score = toxicity.score_texts(model, *t.raw(pa.array(["beta gamma worthlesss delta", "beta gamma delta", ""])))
    assert score[0] > 0.5 > score[1]


def test_language(table):
    found = language.languages(table("documents")).join(table("documents").select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (found["lang_pred"] == found["lang"]).mean() > 0.95


def brute_base(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    hit, windows = set(), collections.defaultdict(list)
    for i in range(len(w) - 7):
        windows[tuple(w[i : i + 8])].append(i)
    for places in windows.values():
        if len(places) > 1:
            hit |= {i + k for i in places for k in range(8)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit)


def test_quality_rules(table, docs, labels):
    for frame, marks in ((table("documents"), table("labels")), (docs, labels)):
        for r in quality_rules.quality_rules(frame, marks).collect():
            n, chars, symbols, dup, repeated = brute_base(r["text"])
            assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (n, chars, symbols, dup, repeated)
            assert r["base_failed"] == (n < 20 or 100 * repeated > 30 * n)
            assert not (r["kept"] and r["base_failed"])
    kept = quality_rules.quality_rules(table("documents"), table("labels")).join(table("labels"), "doc_id").where("NOT base_failed").toPandas()
    assert (kept["kept"] == (kept["quality"] == 1)).mean() > 0.97


def test_mixing(table, docs):
    got = mixing.mix_sources(table("documents")).join(table("documents").select("doc_id", "source"), "doc_id").toPandas()
    again = mixing.mix_sources(table("documents").repartition(5)).toPandas().set_index("doc_id")["taken"]
    assert (got.set_index("doc_id")["taken"].sort_index() == again.sort_index()).all()
    per = got.groupby("source").agg(size=("size", "sum"), target=("target", "first"), taken=("taken", "sum"))
    assert abs(per["target"].sum() - per["size"].sum()) < 1e-3
    assert (abs(per["taken"] - per["target"]) <= 0.01 * per["target"] + 2).all()
    assert (got["taken"] <= 3 * got["size"]).all()
    weights = {s: i % 3 + 1 for i, s in enumerate(sorted(per.index, key=str.encode))}
    capped = per["target"] >= 3 * per["size"] - 1e-6
    ratio = {s: per["target"][s] / weights[s] for s in per.index if not capped[s]}
    assert max(ratio.values()) - min(ratio.values()) < 1e-6 * max(ratio.values())
    edge = mixing.mix_sources(docs).collect()
    assert len(edge) == docs.count() and all(0 <= r["taken"] <= 3 * r["size"] for r in edge)


def test_water_filling(spark):
    small = spark.createDataFrame([(0, "a", 10), (0, "b", 1000), (1, "", 1), (0, "c", 5)], "no_source int, source string, source_size long")
    got = {(r["no_source"], r["source"]): r for r in mixing.quotas(mixing.targets(small)).collect()}
    # caps: a 30, null 3, c 15; the rest goes to b
    assert [got[k]["target"] for k in ((0, "a"), (1, ""), (0, "c"))] == [30, 3, 15]
    assert got[0, "b"]["target"] == pytest.approx(1016 - 48)
    assert sum(r["won"] for r in got.values()) == 1016
    shards = mixing.shard_quotas(mixing.quotas(mixing.targets(small))).groupBy("source").agg(F.sum("quota").alias("q"), F.sum("length").alias("n"), F.max(F.col("quota") - F.col("length")).alias("over")).collect()
    assert {r["source"]: (r["q"], r["n"]) for r in shards} == {"a": (0, 10), "b": (968, 1000), "c": (0, 5), None: (0, 1)}  # beyond whole epochs
    assert all(r["over"] <= 0 for r in shards)


def brute_quotas(target, seats):
    """Seats one by one to the highest quotient."""
    won = [0] * len(target)
    for _ in range(seats):
        won[max(range(len(target)), key=lambda i: (Fraction(target[i]) / (2 * won[i] + 1), -i))] += 1
    return won


def test_quotas_by_highest_quotients(spark, monkeypatch):
    rng = np.random.default_rng(2)
    for blocks in (40, 333):
        monkeypatch.setattr(mixing, "BLOCKS", blocks)
        size = [int(x) for x in rng.integers(1, 400, 23)]
        goal = [(0, f"s{i:02}", n, float(3 * n if i % 5 == 0 else rng.integers(1, 3 * n)), sum(size)) for i, n in enumerate(size)]
        got = mixing.quotas(spark.createDataFrame(goal, "no_source int, source string, source_size long, target double, total long")).orderBy("source").collect()
        block = -(-sum(size) // blocks)
        want = brute_quotas([g[3] for g in goal], -(-sum(size) // block))
        assert [r["won"] for r in got] == [min(w, 3 * -(-n // block)) for w, n in zip(want, size, strict=True)]
        for r in mixing.shard_quotas(mixing.quotas(spark.createDataFrame(goal, "no_source int, source string, source_size long, target double, total long"))).groupBy("source").agg(F.collect_list(F.struct("shard", "length", "quota")).alias("s")).collect():
            parts = sorted(r["s"])
            assert [p["quota"] for p in parts] == brute_quotas([p["length"] for p in parts], sum(p["quota"] for p in parts))


def test_mixing_without_words(spark):
    got = mixing.mix_sources(spark.createDataFrame([(1, None, None), (2, "", "a")], "doc_id long, text string, source string")).collect()
    assert sorted(tuple(r) for r in got) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]


PAGE = """<html><head><title>T</title><script>if (a < b) document.write("<p>no</p>")</script></head><body><nav><ul><li><a href="/">Home</a></li><li><a href="/x">News</a></li></ul></nav>
<div class="ad">Buy now</div><article><h1>Big &amp; bold</h1><p>First   part<br>of text &#233;t&eacute;.</p><p>Second, with <b>bold</b> and <a href="z">a link</a>, quite some text in it.</div></article>
<section class="comments"><h2>comments</h2><p>I disagree with it all.</p></section><footer>&copy; me &middot; contact</footer></body></html>"""


def test_html(spark, table):
    pages = spark.createDataFrame([(1, "u", PAGE), (2, "v", None), (3, None, ""), (4, "w", "<p"), (1, "u", PAGE)], "page_id long, url string, html string")
    got = sorted((r["page_id"], r["text"], r["n_chars"]) for r in html_text.extract_text(pages).collect())
    text = "Big & bold\nFirst part of text été.\nSecond, with bold and a link, quite some text in it."
    assert got[0] == got[1] == (1, text, len(text))
    assert got[2][1:] == got[3][1:] == ("", 0)
    assert html_text.extract_text(pages.limit(0)).count() == 0
    for r in html_text.extract_text(table("pages")).join(table("pages").select("page_id", "html"), "page_id").limit(150).collect():
        inside = re.search(r"<article>(.*)</article>", r["html"], re.S)[1]
        parts = (" ".join(html_text.html.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", inside))
        assert r["text"] == "\n".join(x for x in parts if x)


def test_html_blocks_are_read_whole():
    front = " ".join(f"word{i}" for i in range(24))
    for before in (front, f"{front} {'x' * 4000}"):
        made = [html_text.vectors([(("p",), f"{before} {last}", 0)])[0] for last in ("cookies", "privacy")]
        assert (made[0] != made[1]).any()
    many = [f"word{i % 700}," for i in range(5000)]
    mean = np.mean([html_text.vectors([(("p",), w, 0)])[0][html_text.PATH : html_text.PATH + html_text.WORDS] for w in many], 0)
    whole = html_text.vectors([(("p",), " ".join(many), 0)])[0][html_text.PATH : html_text.PATH + html_text.WORDS]
    assert whole == pytest.approx(mean, abs=1e-5)


def brute_cut(texts, length):
    data = [(x or "").encode() for x in texts]
    seen = collections.Counter(d[p : p + length] for d in data for p in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 1, bool)
        for p in range(len(d) - length + 1):
            if seen[d[p : p + length]] > 1:
                gone[p : p + length] = True
        runs = int((gone[:-1] & ~np.concatenate([[False], gone[:-2]])).sum()) if len(d) else 0
        out.append((len(d), int(gone.sum()), runs, hashlib.sha256(bytes(b for b, g in zip(d, gone, strict=False) if not g)).hexdigest()))
    return out


@pytest.mark.parametrize("hot", [1000, 2])
def test_repeated_bytes(spark, sf, docs, hot):
    for frame, length, gram in ((spark.read.parquet(f"{sf}/documents.parquet").limit(120), 400, 64), (docs.where("length(text) < 10000 OR text IS NULL"), 60, 16)):
        data = frame.collect()
        want = sorted((str(r["doc_id"]), *x) for r, x in zip(data, brute_cut([r["text"] for r in data], length), strict=True))
        got = repeated_bytes.digest(repeated_bytes.remove_repeats(spark.createDataFrame(data, frame.schema), length, gram, hot)).collect()
        assert sorted((str(r[0]), *r[1:]) for r in got) == want


def brute_words(texts, length, n):
    """Byte masks of the repeated byte strings and of the repeated runs of n words."""
    data = [(x or "").encode() for x in texts]
    spans = [[m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", d)] for d in data]
    runs = [[tuple(d[a:b] for a, b in s[p : p + n]) for p in range(len(s) - n + 1)] for d, s in zip(data, spans, strict=True)]
    seen, strings = collections.Counter(x for r in runs for x in r), collections.Counter(d[p : p + length] for d in data for p in range(len(d) - length + 1))
    out = []
    for d, s, r in zip(data, spans, runs, strict=True):
        gone = np.zeros(len(d), bool)
        for p in range(len(d) - length + 1):
            gone[p : p + length] |= strings[d[p : p + length]] > 1
        for p, x in enumerate(r):
            gone[s[p][0] : s[p + n - 1][1]] |= seen[x] > 1
        out.append(bytes(b for b, g in zip(d, gone, strict=True) if not g))
    return out


@pytest.mark.parametrize("hot", [1000, 2])
def test_repeated_words(spark, sf, docs, hot):
    for frame, n, length in ((spark.read.parquet(f"{sf}/documents.parquet").limit(120), 20, 400), (docs.where("length(text) < 10000 OR text IS NULL"), 5, 60)):
        data = frame.collect()
        want = sorted((str(r["doc_id"]), x) for r, x in zip(data, brute_words([r["text"] for r in data], length, n), strict=True))
        got = repeated_bytes.remove_repeats(spark.createDataFrame(data, frame.schema), length, 16, hot, words=n).select("doc_id", "kept").collect()
        assert sorted((str(a), bytes(b)) for a, b in got) == want


def test_repeated_bytes_keeps_columns(docs, none):
    out = repeated_bytes.remove_repeats(docs)
    assert out.columns[: len(docs.columns)] == docs.columns and out.count() == docs.count()
    assert repeated_bytes.remove_repeats(none).count() == 0


def test_context_mixing(table, none, docs, tmp_path):
    frame = table("documents")
    got = context_mixing.token_scores(frame).toPandas().set_index("doc_id")
    tokens = {r["doc_id"]: [*words(r["text"]), "\n"] for r in frame.collect()}
    out = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in tokens}
    count = collections.Counter(w for i, ws in tokens.items() if not out[i] for w in ws)
    total, kinds = sum(count.values()), len(count)
    for i, ws in tokens.items():
        r = got.loc[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"]) == (len(ws), sum(w in count for w in ws), total, out[i])
        assert r["base_score"] == pytest.approx(sum(math.log10((count[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in ws))
    unseen = got[got["held_out"]]
    assert unseen["score"].sum() > unseen["base_score"].sum() and (got["score"] < 0).all()
    docs.write.parquet(str(tmp_path / "d"))
    edge = context_mixing.token_scores(docs.sparkSession.read.parquet(str(tmp_path / "d"))).collect()
    assert len(edge) == docs.count() and all(math.isfinite(r["score"]) for r in edge)
    assert context_mixing.token_scores(none).count() == 0


def brute_classes(data, k, percent):
    sets = []
    for x in data["text"]:
        w = words(x)
        sets.append({tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    pairs = [(a, b) for a in range(len(sets)) for b in range(a) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    root = union_find(len(sets), pairs)
    links = collections.Counter(x for p in pairs for x in p)
    least = collections.defaultdict(list)
    for i, r in enumerate(root):
        if not np.isnan(data["doc_id"].iloc[i]):
            least[r].append(int(data["doc_id"].iloc[i]))
    return sorted((str(data["doc_id"].iloc[i]), len(s), min(least[root[i]], default=None), links[i]) for i, s in enumerate(sets))


def variants(n, size, seed):
    """Families of texts around the threshold, with chains and subsets."""
    rng = np.random.default_rng(seed)
    out = []
    for f in range(n):
        base = [f"f{f}w{i}" for i in range(int(rng.integers(1, size)))]
        for _ in range(6):
            base = list(base)
            for _ in range(rng.integers(0, 3)):
                base[rng.integers(len(base))] = f"x{rng.integers(1e6)}"
            out.append(" ".join(base[: len(base) - int(rng.integers(0, 1 + len(base) // 15))]))
    return out


@pytest.mark.parametrize(("k", "percent", "block"), [(3, 90, 2048), (5, 80, 2048), (3, 90, 2)])
def test_jaccard_join(spark, docs, k, percent, block, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    extra = [(100 + i, x, *[None] * 8) for i, x in enumerate(variants(12, 60, k))]
    frame = spark.createDataFrame([r for r in rows() if not r[1] or len(r[1]) < 10_000] + extra, DOCS)
    got = jaccard_join.near_classes(frame, k, percent).toPandas()
    clean = lambda x: None if x is None or np.isnan(x) else int(x)
    assert sorted((str(a), b, clean(c), d) for a, b, c, d in got[["doc_id", "n_shingles", "component_id", "n_links"]].itertuples(index=False)) == brute_classes(frame.toPandas(), k, percent)


def test_keep_one(docs, none):
    kept = jaccard_join.keep_one(docs)
    assert kept.columns == docs.columns
    texts = collections.Counter(r["text"] for r in kept.collect())
    assert texts["one"] == 1 and texts[f"other {PASSAGE} tail"] + texts[f"start {PASSAGE} end"] + texts[PASSAGE] == 1 and texts[None] == 2 and texts[""] == 1
    assert jaccard_join.keep_one(none).count() == 0


def test_decontaminate(spark, docs, none, sf):
    items = spark.createDataFrame([(1, " ".join(PASSAGE.split()[10:50])), (2, "ONE"), (3, None), (4, "  "), (5, "two words"), (6, "nowhere to be found in here at all"), (1, "ein wort UND noch eins ein"), (7, " ".join([*PASSAGE.split()[:18], "broken", "x"]))], "item_id long, text string")
    for frame, bench in ((docs, items), (spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet"))):
        want = []
        for i in bench.collect():
            w = words(i["text"])
            n = min(len(w), 5)
            q = {tuple(w[p : p + n]) for p in range(len(w) - n + 1)} if w else set()
            for d in frame.collect():
                x = words(d["text"])
                shared = len(q & {tuple(x[p : p + n]) for p in range(len(x) - n + 1)})
                if q and 10 * shared >= 8 * len(q):
                    want.append((str(d["doc_id"]), i["item_id"], len(q), shared))
        for most in (decontaminate.BROADCAST_HASHES, 3):
            got = decontaminate.leaks(frame, bench, most).collect()
            assert sorted((str(r["doc_id"]), *r[1:4]) for r in got) == sorted(want)
            left = decontaminate.clean(frame, bench, most)
            assert left.columns == frame.columns and left.where("doc_id IS NOT NULL").select("doc_id").distinct().count() == frame.where("doc_id IS NOT NULL").select("doc_id").distinct().count() - len({w[0] for w in want if w[0] != "None"})
    assert decontaminate.leaks(none, items).count() == decontaminate.leaks(docs, items.limit(0)).count() == 0


@pytest.mark.parametrize("most", [decontaminate.BROADCAST_HASHES, 3])
def test_benchmark_of_many_batches(spark, most):
    """Items of one split in three Arrow batches, short ones at the places of long ones, with equal ids too."""
    rng = np.random.default_rng(10)
    texts = [" ".join(f"v{x}" for x in rng.integers(0, 400, n)) for n in [*([30] * 20), *rng.integers(1, 12, 20), *([30] * 10)]]
    bench = spark.createDataFrame([(i % 20, x) for i, x in enumerate(texts)], "item_id long, text string").coalesce(1)
    frame = spark.createDataFrame([(d, f"q{d} {' '.join(texts[d * 3 : d * 3 + 2])} r{d}") for d in range(17)] + [(90, "no item here at all"), (91, f"{texts[0]} z {texts[40]}")], "doc_id long, text string")
    want = []
    for i in bench.collect():
        w = words(i["text"])
        n = min(len(w), 5)
        q = {tuple(w[p : p + n]) for p in range(len(w) - n + 1)}
        for d in frame.collect():
            x = words(d["text"])
            shared = len(q & {tuple(x[p : p + n]) for p in range(len(x) - n + 1)})
            if 10 * shared >= 8 * len(q):
                want.append((d["doc_id"], i["item_id"], len(q), shared))
    rows_before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20")
    try:
        got = decontaminate.leaks(frame, bench, most).collect()
        left = decontaminate.clean(frame, bench, most).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows_before)
    assert sorted(tuple(r[:4]) for r in got) == sorted(want)
    assert {r["doc_id"] for r in left} == {r["doc_id"] for r in frame.collect()} - {w[0] for w in want}


def test_edge_rows_are_scored(docs, none, labels):
    n = docs.count()
    for made in (quality_pairs.quality_scores, toxicity.toxicity_scores):
        out = made(docs, labels).collect()
        assert len(out) == n and all(0 <= r["score"] <= 1 for r in out)
        assert made(none, labels).count() == 0 and made(docs, labels.limit(0)).count() == n
    assert quality_rules.quality_rules(none, labels).count() == 0
    assert quality_rules.quality_rules(docs, labels.limit(0)).count() == n
    found = language.languages(docs).collect()
    assert len(found) == n and {r["lang_pred"] for r in found if r["doc_id"] in (0, 1, 2, 13)} == {"und"}
    assert language.languages(none).count() == 0
    assert mixing.mix_sources(none).count() == 0
    assert jaccard_join.near_classes(none).count() == 0


def test_unclosed_hidden_tags_take_linear_time():
    took = []
    for n in (30_000, 120_000):
        began = time.perf_counter()
        html_text.blocks("<script " * n)
        html_text.blocks("<p>text</p>" + "<style a='1' " * n + "<p>more</p>")
        took.append(time.perf_counter() - began)
    assert took[1] < 12 * took[0] + 1
    kept = [b[1] for b in html_text.blocks("<p>one</p><script type='a' x=1 < 2>hidden</script><script>var a = '<p>no</p>';</script><p>two</p>")]
    assert kept == ["one", "two"]


def test_quality_learns_from_every_labelled_row(spark, monkeypatch):
    """The table's fit is that of all its rows, long texts included; two tasks' pairs are as good as one's."""
    rng = np.random.default_rng(5)
    x = rng.normal(0, 1, (3000, 26))
    y = (x[:, 0] + x[:, 1] > rng.normal(0, 1, 3000)).astype(int)
    rows = spark.createDataFrame([(i, int(b), [float(v) for v in a]) for i, (a, b) in enumerate(zip(x, y, strict=True))], "doc_id long, y int, x array<double>")
    one = quality_pairs.fit(x, y)
    monkeypatch.setattr(quality_pairs, "TASK_ROWS", 700)
    got = quality_pairs.learn(rows, 26)
    assert np.corrcoef(got["w"], one["w"])[0, 1] > 0.99 and abs(got["cut"] - one["cut"]) < 0.2
    docs = spark.createDataFrame([(i, ("# | " if i % 2 else "plain words here. ") * (20_000 if i < 40 else 3)) for i in range(80)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(40)], "doc_id long, quality int")  # all beyond 64 KB
    scored = {r["doc_id"]: r["score"] for r in quality_pairs.quality_scores(docs, labels).collect()}
    assert scored[0] > 0.7 > scored[1]


def test_context_mixing_looks_up_pairs():
    """One look-up finds what a slot's counts say, as the formula does bit by bit."""
    from stratum.llm import context_mixing as C

    rng = np.random.default_rng(3)
    zero, one = rng.integers(0, 90, (2, C.CONTEXTS, 50)).astype(np.float32)
    slots = [rng.integers(0, 50, 400).astype(np.int32) for _ in range(C.CONTEXTS)]
    pull, sure = C.looked_up(C.paired(C.stretched(zero, one), C.sureness(zero + one)), slots)
    for k in range(C.CONTEXTS):
        assert (pull[k] == C.stretched(zero[k][slots[k]], one[k][slots[k]])).all()
    level = [C.sureness((zero + one)[k][slots[k]]).astype(int) for k in range(C.CONTEXTS)]
    assert (sure == level[1] * C.LEVELS + level[2]).all()


def test_context_mixing_blocks_ahead(monkeypatch):
    """However many blocks are looked up at a time, scores, weights and counts are the same to the last bit; a slot takes four bytes."""
    from stratum.llm import context_mixing as C

    rng = np.random.default_rng(4)
    texts = [" ".join(f"w{i}" for i in rng.zipf(1.3, n) % 900) for n in (0, 1, 40, 700, 3000)]
    data = [s.encode() for s in texts]
    x = C.tokens(np.frombuffer(b"".join(data), np.uint8), np.concatenate([[0], np.cumsum([len(d) for d in data])]))
    words, number = np.unique(x.h, return_counts=True)
    parts = C.bits(C.prefix_code(words[number > 1], number[number > 1], int(number[number == 1].sum())), x)[:2]
    zero, one = rng.integers(0, 90, (2, C.CONTEXTS, C.SLOTS)).astype(np.float32)
    seen = C.paired(C.stretched(zero, one), C.sureness(zero + one))
    assert seen.itemsize == 4
    made = []
    for ahead in (1, 5000, 1 << 20):
        monkeypatch.setattr(C, "AHEAD", ahead)
        mixer = C.Mixer()
        for part in parts:
            mixer.code(part, x.docs, lambda slots: C.looked_up(seen, slots), learn=True)
        scores = [C.Mixer(mixer.weights, mixer.refine).code(part, x.docs, lambda slots: C.looked_up(seen, slots), learn=False) for part in parts]
        made.append([mixer.weights, mixer.slope, mixer.refine, *scores])
        assert mixer.refine.sum() == mixer.bits == sum(len(part.value) for part in parts)
    assert all((a == b).all() for other in made[1:] for a, b in zip(made[0], other, strict=True))
    table = np.zeros((C.SLOTS, 2), np.uint32)
    C.count(table, [part.slots[1] * 2 + part.value for part in parts])
    assert (table.ravel() == np.bincount(np.concatenate([part.slots[1] * 2 + part.value for part in parts]), minlength=2 * C.SLOTS)).all()
