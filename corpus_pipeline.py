"""Corpus cleaning as five stages over the documents table.

Quality rules drop rejected documents; the n-gram Jaccard join keeps one document of each near-duplicate group; repeated
passages (more than 50 words, or 400 bytes) are cut out of the texts; documents that leak benchmark items go; the rest is mixed to target weights.
Each stage takes the whole output of the one before, written as Parquet.  Nulls, empty texts, repeated rows and extra
columns are handled as the operators state.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm import decontaminate, jaccard_join, mixing, quality_rules, repeated_bytes
from stratum.llm._spark import shared, table


PASSAGE_WORDS = 51  # every repeat of more than 50 words holds a repeated run of so many


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: the rows that the quality rules keep.  Null and empty texts have no words and go; repeated rows are judged alike;
    an empty table stays empty."""
    judged = quality_rules.quality_rules(docs, table(spark, sf_dir, "labels"))
    return judged.where("kept").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8 on shingles of five words at 80 %: of each group of linked documents the one of the least id stays (ties: the least
    digest), of repeated rows one.  Documents without a word (null, empty, blank) are linked with nothing and all stay."""
    return jaccard_join.keep_one(docs, k=5, percent=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: every row, its text without the strings of 400 bytes and the runs of 51 words that stand elsewhere too, and n_chars
    counted again.  A null text stays null; a repeated text goes as a whole, where it is long enough."""
    cut = repeated_bytes.remove_repeats(docs, words=PASSAGE_WORDS).withColumn("text", F.col("kept_text"))
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: the rows that hold no benchmark item to 80 %.  Null and empty texts hold none."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: every row with its text, its size in words, and how many of its words the mix takes (0: none of it; above the size: in
    several epochs).  Null sources are one source; null and empty texts have size 0."""
    return mixing.mix_sources(docs, columns=("source", "text"))


STAGES = [("quality rules", quality), ("near duplicates", near_duplicates), ("repeated passages", repeated_passages), ("benchmark leaks", benchmark_leaks), ("mix", mix)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written to the shared checkpoint folder and read again."""
    shared(spark)
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        path = f"{spark.sparkContext.getCheckpointDir()}/stage-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
