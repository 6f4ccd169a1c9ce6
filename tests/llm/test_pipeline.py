"""The corpus pipeline over a small table."""

import re

import pytest

import corpus_pipeline
from stratum.llm import registry


def test_stages(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names, before, counts = docs.columns, docs.count(), []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf).write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        counts.append(docs.count())
        assert i == 4 or docs.columns == names
    assert before > counts[0] > counts[1] == counts[2] >= counts[3] == counts[4] > 0
    bench = {r["text"] for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    left = spark.read.parquet(str(tmp_path / "3")).collect()
    assert not any(b in r["text"] for r in left for b in bench)
    assert docs.where("taken > 3 * size").count() == 0
    assert corpus_pipeline.run(spark, sf).count() == counts[4]


def test_names():
    assert sorted(int(re.match(r"op(\d+)_", q)[1]) for q in registry.QUERIES) == list(range(1, 14))


def planted(n):
    """(passage, texts): two documents share n words of fewer than 400 bytes, with other blanks; the rest is their own."""
    passage = [f"p{i}" for i in range(n)]
    own = [[f"d{d}w{i}" for i in range(90)] for d in range(3)]
    return passage, [" ".join([*own[0][:40], *passage, *own[0][40:]]), "\n".join([*own[1], *passage]), " ".join(own[2])]


@pytest.mark.parametrize("n", [50, 51, 55, 65])
def test_passages_by_words(spark, n):
    passage, texts = planted(n)
    assert len(" ".join(passage)) < 400
    frame = spark.createDataFrame([(i, x, len(x)) for i, x in enumerate(texts)], "doc_id long, text string, n_chars long")
    left = {r["doc_id"]: r["text"].split() for r in corpus_pipeline.repeated_passages(spark, frame, "").collect()}
    assert left == {i: [w for w in x.split() if n < 51 or w not in passage] for i, x in enumerate(texts)}


def test_passages_of_scripts_without_blanks(spark):
    passage = "".join(chr(0x4E00 + 7 * i) for i in range(80))  # 240 bytes
    own = ["".join(chr(0x6000 + 80 * d + i) for i in range(70)) for d in range(2)]
    frame = spark.createDataFrame([(d, f"{own[d]}{passage}x{d}{own[d][:20]}", 172) for d in range(2)], "doc_id long, text string, n_chars long")
    left = {r["doc_id"]: (r["text"], r["n_chars"]) for r in corpus_pipeline.repeated_passages(spark, frame, "").collect()}
    assert left == {d: (f"{own[d]}x{d}{own[d][:20]}", 92) for d in range(2)}
