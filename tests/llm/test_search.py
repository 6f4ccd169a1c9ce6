"""Lexical search, shared windows and fill-in-middle against brute force, and their edge rows."""

import collections
import hashlib
import math
import re

import numpy as np
import pytest

from stratum.llm import fill_middle, lexical_search, registry, shared_windows

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
WORD = re.compile("[^\x20\x09-\x0d]+")
UPPER = {k: k + 32 for k in range(65, 91)}
ODD = [
    (1, "Alpha beta, BETA gamma-delta 12 ÄÖ äö"), (2, None), (3, ""), (4, "... --- !!!"), (5, "alpha"), (6, "alpha"), (6, "alpha"), (7, "beta " * 3000 + "omega"),
    (None, "alpha"), (8, "x" * 70000), (9, "日本語 alpha\x00beta"), (10, "alpha beta gamma delta 12"), (11, "omega\nomega\tomega"),
]
ITEMS = [(1, "alpha"), (2, "Beta beta omega 12"), (3, None), (4, "unseen words"), (5, "äö 日本語 " + "x" * 70000), (2, "gamma")]


def ids(i):
    return (i is None, i or 0)


def brute_search(docs, items, top):
    cut = [(i, TERM.findall((s or "").translate(UPPER))) for i, s in docs]
    big_n, total = sum(bool(w) for _, w in cut), sum(len(w) for _, w in cut)
    df = collections.Counter(x for _, w in cut for x in set(w))
    out = []
    for item, text in items:
        found = []
        for i, w in cut:
            tf, m = collections.Counter(w), 75 + 25 * len(w) * big_n // max(total, 1)
            score = sum(math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[x] + 1))) * (1000000000 * tf[x] // (1000 * tf[x] + 12 * m)) for x in TERM.findall((text or "").translate(UPPER)) if tf[x])
            if score > 0:
                found.append((-score, ids(i), i))
        out += [(item, k + 1, i, -s) for k, (s, _, i) in enumerate(sorted(found, key=lambda f: f[:2])[:top])]
    return sorted(out, key=str)


def frame(spark, docs, parts=3):
    return spark.createDataFrame(docs, "doc_id long, text string").repartition(parts)


def items_of(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize(("shard", "block"), [(lexical_search.SHARD_BYTES, 500_000), (40, 2)])
def test_search_equals_brute_force(spark, shard, block):
    got = lexical_search.ranked(frame(spark, ODD), items_of(spark, ITEMS), 4, shard, block)
    assert sorted(map(tuple, got.collect()), key=str) == brute_search(ODD, ITEMS, 4)


def test_search_ties_over_windows_and_shards(spark):
    docs = [(k * 7919 % 5000, "same words" if k % 3 else "other same") for k in range(5000)]
    items = [(1, "same"), (2, "same words"), (3, "other other same")]
    got = lexical_search.ranked(frame(spark, docs, 5), items_of(spark, items), 20, 20_000)
    assert sorted(map(tuple, got.collect()), key=str) == brute_search(docs, items, 20)


def test_search_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert lexical_search.ranked(none, items_of(spark, ITEMS)).count() == 0
    assert lexical_search.ranked(frame(spark, ODD), spark.createDataFrame([], "item_id long, text string")).count() == 0
    extra = frame(spark, ODD).selectExpr("*", "doc_id AS item", "text AS terms")
    assert lexical_search.ranked(extra, items_of(spark, ITEMS[:1])).count() == 7


def test_posting_bytes():
    values = np.array([0, 1, 127, 128, 16383, 16384, 2**31, 2**40])
    data, ends = lexical_search.pack(values)
    assert lexical_search.unpack(data).tolist() == values.tolist() and np.diff(ends).tolist() == [1, 1, 2, 2, 3, 5, 6]
    assert lexical_search.unpack(lexical_search.pack(values[:0])[0]).tolist() == []


def test_terms_with_equal_hashes_stay_apart(monkeypatch):
    buf = np.frombuffer(b"ab cd ab ef", np.uint8)
    start, end = np.array([0, 3, 6, 9]), np.array([2, 5, 8, 11])
    monkeypatch.setattr(lexical_search.t.Spans, "hash", lambda self, a, b: np.zeros(len(a), np.uint64))
    number, first = lexical_search.groups(buf, start, end)
    assert number.tolist() == [0, 1, 0, 2] and first.tolist() == [0, 1, 3]


def brute_windows(docs, size):
    cut = [(i, WORD.findall(s or "")) for i, s in docs]
    least = {}
    for i, w in cut:
        for p in range(len(w) - size + 1) if i is not None else ():
            key = tuple(w[p : p + size])
            least[key] = min(i, least.get(key, i))
    out = []
    for i, w in cut:
        gone = set()
        for p in range(len(w) - size + 1) if i is not None else ():
            if least[tuple(w[p : p + size])] < i:
                gone |= set(range(p, p + size))
        out.append((i, len(w), len(gone), hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in gone).encode()).hexdigest()))
    return sorted(out, key=str)


def passages(rng):
    """Documents that share passages around the size of a window at all shifts, with repeats inside and over many documents."""
    pool = [[f"w{rng.integers(400)}" for _ in range(n)] for n in (49, 50, 51, 81, 140, 300)]
    docs = []
    for i in range(120):
        words = []
        for _ in range(rng.integers(1, 5)):
            words += [f"u{rng.integers(10**6)}é" for _ in range(rng.integers(0, 70))] + pool[rng.integers(len(pool))][: int(rng.integers(40, 400))]
        docs.append((int(rng.integers(0, 100)), rng.choice([" ", "\n", "\t \r\n"]).join(words)))
    return docs


def test_windows_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    docs = [*passages(rng), (2, None), (3, ""), (None, "a " * 90), (4, "a " * 90), (5, "a " * 49), (6, "a " * 50), (7, " ".join("abcdefghij" * 5)), (8, "\n".join("abcdefghij" * 5)), (9, "b" * 70000)]
    docs += docs[:3] + docs[-3:]
    got = shared_windows.digest(shared_windows.remove_shared(frame(spark, docs, 5)))
    assert sorted(map(tuple, got.collect()), key=str) == brute_windows(docs, 50)


def test_windows_asked_in_small_lots(spark, monkeypatch):
    docs = passages(np.random.default_rng(6))
    monkeypatch.setattr(shared_windows, "ASKED", 200)  # local tasks are forked from this process, closures take their globals along
    got = shared_windows.digest(shared_windows.remove_shared(frame(spark, docs, 2), 31))
    assert sorted(map(tuple, got.collect()), key=str) == brute_windows(docs, 31)


def test_windows_spans_and_columns(spark):
    docs = frame(spark, [(1, " ".join(f"w{k}" for k in range(60))), (2, "x y " + " ".join(f"w{k}" for k in range(5, 58)) + " z")]).selectExpr("*", "doc_id AS k1", "'v' AS at", "7L AS n_words")
    got = {r["doc_id"]: r for r in shared_windows.remove_shared(docs).collect()}
    assert [tuple(s) for s in got[2]["spans"]] == [(2, 55)] and got[2]["kept_text"] == "x y z" and got[2]["n_words"] == 56 and got[2]["k1"] == 2 and got[2]["at"] == "v"
    assert got[1]["spans"] == [] and got[1]["n_removed"] == 0
    assert shared_windows.remove_shared(docs.limit(0)).count() == 0
    with pytest.raises(ValueError, match="31"):
        shared_windows.remove_shared(docs, 30)


def test_cover_has_every_difference():
    for a in range(shared_windows.PERIOD):
        assert any((a + s) % shared_windows.PERIOD in shared_windows.COVER and s in shared_windows.COVER for s in range(shared_windows.PERIOD))


def brute_middle(i, s, seed=1):
    s = s or ""
    digest = hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted(x % (len(s) + 1) for x in h[:2])
    form = "plain" if not s or any(m in s for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90 else "spm" if h[3] % 100 < 20 else "psm"
    out = {"plain": s, "psm": f"<P>{s[:a]}<S>{s[b:]}<M>{s[a:b]}", "spm": f"<S>{s[b:]}<P>{s[:a]}<M>{s[a:b]}"}[form]
    return (i, len(s), form, None if form == "plain" else a, None if form == "plain" else b - a, out)


MIDDLE = [
    (1, None), (2, ""), (3, "a"), (None, "xyz"), (4, "<P"), (5, "<S>"), (6, "é\n日本\x00x" * 700), (7, "a<" * 5000), (8, "😀" * 3001), (9, "<M>" * 9), (10, "P><S" * 40),
    *[(k, "x" * (k - 100)) for k in range(163, 170)], *[(k, "ab\r\né" * (k % 400)) for k in range(1000, 1200)], (12, "é👨‍👩‍👧" * 50), (13, "<" * 200), (13, "<" * 200),
]


def test_fill_in_middle_equals_brute_force(spark):
    docs = frame(spark, MIDDLE)
    made = fill_middle.fill_in_middle(docs)
    assert sorted(map(tuple, made.collect()), key=str) == sorted((brute_middle(*d) for d in MIDDLE), key=str)
    back = sorted((tuple(r) for r in fill_middle.restore(made).collect()), key=str)
    assert back == sorted(((i, s or "") for i, s in MIDDLE), key=str)
    hexed = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = sorted(((*brute_middle(i, s)[:5], hexed(brute_middle(i, s)[5]), hexed(s or "")) for i, s in MIDDLE), key=str)
    assert sorted(map(tuple, fill_middle.digest(docs).collect()), key=str) == want


def test_fill_in_middle_parameters_and_columns(spark):
    docs = frame(spark, MIDDLE).selectExpr("*", "text AS output", "1 AS form")
    got = fill_middle.fill_in_middle(docs, seed=7, plain_from=100, spm_below=100)
    assert {r["form"] for r in got.collect()} == {"plain", "spm"} and got.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    assert fill_middle.digest(docs.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["op11_lexical_search", "op12_shared_windows", "op13_fill_in_middle"])
def test_new_operators_equal_sql(spark, sf, name):
    import duckdb

    db = duckdb.connect()
    for table in ("documents", "benchmark"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    want = db.execute(registry.ORACLE_SQL[name])
    columns = [c[0] for c in want.description]
    assert sorted(map(tuple, registry.QUERIES[name](spark, sf).select(*columns).collect()), key=str) == sorted(want.fetchall(), key=str)
