"""Session helpers: shared checkpoint folder, table access, bounded training samples, components."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def lean(spark: SparkSession) -> None:
    """Arrow batches of 2,000 rows where the session has the default of 10,000: whole texts are long rows."""
    if spark.conf.get(ARROW_ROWS) == "10000":
        spark.conf.set(ARROW_ROWS, "2000")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    lean(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared(spark: SparkSession) -> None:
    """Make checkpoints go to the folder that the cluster shares, as ``spark.checkpoint.dir`` names it; a session on one machine
    (tests) without that setting gets a temporary folder, on a cluster it is an error."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir is not set: it must name a folder that driver and executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoint-"))


def settle(df: DataFrame) -> DataFrame:
    """Cut lineage: the rows are written to the shared folder once and survive lost executors."""
    shared(df.sparkSession)
    return df.checkpoint()


def fresh(df: DataFrame, *wanted: str) -> list[str]:
    """Column names that ``df`` doesn't have in any case: the wanted ones, with underscores where they clash."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def settle_table(df: DataFrame) -> DataFrame:
    """The same as ``settle``, as a compressed Parquet table in the shared folder: for rows by the million."""
    shared(df.sparkSession)
    path = f"{df.sparkSession.sparkContext.getCheckpointDir()}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lower(text: Column) -> Column:
    """A-Z only."""
    return F.translate(text, LETTERS, LETTERS.lower())


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def held(doc_id: Column, folds: int, out: int) -> Column:
    return F.coalesce(fold(doc_id, folds) == out, F.lit(False))


FIT_BYTES = 64 << 10  # labelled texts beyond so many bytes are scored, but not learnt from: what the driver gets stays bounded


def labelled(labels: DataFrame, label: str, fold_out: tuple[int, int] | None) -> DataFrame:
    """(doc_id, y) of all training rows: an id counts once, and one with both labels has none."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1)).select("doc_id", F.col(label).cast("int").alias("y"))
    if fold_out:
        known = known.where(~held(F.col("doc_id"), *fold_out))
    return known.groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("most")).where("y = most").drop("most")


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most_per_class: int, fold_out: tuple[int, int] | None, seed: int) -> DataFrame:
    """(doc_id, text, y): at most ``most_per_class`` training rows of each class, by seeded hash of the id, of at most FIT_BYTES each.

    An id counts once, however many rows have it: of several texts the one of the least hash is taken, and an id with both labels has none.
    The sample is taken on the narrow label table, so its broadcast is bounded by 2 * most_per_class rows of 12 bytes;
    the text of the chosen documents alone is read in full."""
    known = labelled(labels, label, fold_out)
    parts = [known.where(F.col("y") == y).orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(most_per_class) for y in (0, 1)]
    chosen = parts[0].unionByName(parts[1])
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).where(F.octet_length("text") <= FIT_BYTES)
    return texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text")).select("doc_id", "text", "y")


def ranges(docs: DataFrame, size: int) -> int:
    """Ranges to deal out what ``docs(text)`` holds: one for each ``size`` bytes of text, as many as shuffle partitions at least."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // size))


FILTER_BITS = 1 << 24
SALTS = 8
SHARES = 16  # classes of counts between a power of two and the next


def most_frequent(rows: DataFrame, count: str, most: int) -> DataFrame:
    """The rows of the largest counts, whole classes of like counts, ``most`` at most: the driver sees one number for each class, and what
    is taken needs no sort of all rows."""
    kind = F.floor(F.log2(count) * SHARES).alias("kind")
    number = rows.where(F.col(count) > 0).groupBy(kind).agg(F.count("*").alias("n")).collect()  # 64 * SHARES classes at most
    taken, least = 0, None
    for r in sorted(number, reverse=True):
        taken += r["n"]
        if taken > most:
            break
        least = r["kind"]
    return rows.where((F.col(count) > 0) & (kind >= least)) if least is not None else rows.limit(0)


def id_filter(rows: DataFrame, column: str) -> Callable[[np.ndarray], np.ndarray]:
    """A test that passes all ids of ``rows`` (48 bits of a hash each) and few others: a broadcast table of FILTER_BITS bits, of one size for any input."""
    bit = F.pmod(F.col(column), F.lit(FILTER_BITS))
    words = rows.select(F.shiftright(bit, 6).alias("word"), F.expr(f"shiftleft(1L, cast(pmod({column}, 64) as int))").alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas()
    table = np.zeros(FILTER_BITS // 64, np.int64)
    table[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64)
    shared_table = rows.sparkSession.sparkContext.broadcast(table)

    def passes(ids: np.ndarray) -> np.ndarray:
        at = ids % FILTER_BITS
        return (shared_table.value[at // 64] >> (at % 64)) & 1 == 1

    return passes


def components(edges: DataFrame) -> DataFrame:
    """(id, root): the least id that each id of ``edges(a, b)`` reaches, by alternating large and small stars.

    Every round is two aggregations on the shuffled edge list, cut by a checkpoint; the driver only sees whether
    the list still changes, and the rounds end when it doesn't (their number grows as the logarithm of a chain's length).
    The edges of a centre are spread over SALTS tasks.  Ids without an edge to another id are not returned."""
    e = settle(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    salt, every = F.pmod(F.xxhash64("v"), F.lit(SALTS)).alias("salt"), F.explode(F.expr(f"sequence(0L, {SALTS - 1}L)")).alias("salt")
    before, now = None, e.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long"))).first()
    while now != before:
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"), every)
        large = both.select("u", "v", salt).join(low, ["u", "salt"]).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        star = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        e = settle(star.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        before, now = now, e.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long"))).first()
    return e.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "id").unionByName(e.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct())
