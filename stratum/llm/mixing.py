"""Operator 2 - mixing sources to target weights by Sainte-Lague apportionment.

Sources in code-point order (null last) weigh 1, 2, 3, repeating.  Targets share the total size by weight, but stop at
EPOCHS times a source's size; the excess is shared again by weight until no target is above its cap.

The total is cut into about BLOCKS equal-token blocks.  Each goes to the source with the highest quotient
target / (2 * won + 1).  A source wins as many as it has quotients above the last winning one, which a search narrows down by
grouped sums; the few quotients left at the end are ranked, ties by source.  The blocks that a source wins beyond whole
epochs are apportioned in the same way to its shards, runs of blocks of almost equal length in its stream of documents in
seeded order.  A shard takes as many of its blocks as its integer quota says, those of the least ranks in a seeded permutation.
``taken`` counts a document's words in taken blocks, times the epochs.

Only narrow rows (id, source, size) are shuffled.  Prefix sums run in two levels, over seeded buckets of a source and
within a bucket, so a source with a third of all rows is spread over BUCKETS groups.  No task sees all sources: their ranks come
from range partitions and the counts of the ranges before.  Null text has size 0 and takes 0; null sources form a source of
their own; without any word every target and ``taken`` is 0; an empty table gives an empty result; repeated rows are
separate documents with ties in the seeded order broken by id and size; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratum.llm._spark import WORD, settle, settle_table

EPOCHS = 3
BLOCKS = 1_000_000
BUCKETS = 1024
SHARDS = 64
GRID, STEPS = 64, 8  # divisors tried at once, and how often
_NAME = ("no_source", "source")


def sizes(docs: DataFrame, seed: int, columns: tuple[str, ...] = ()) -> DataFrame:
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    h = F.xxhash64(F.lit(seed), "doc_id", "text")
    return docs.select("doc_id", F.col("source").isNull().cast("int").alias("no_source"), F.coalesce("source", F.lit("")).alias("source"), size.alias("size"), h.alias("h"), F.pmod(h, F.lit(BUCKETS)).cast("int").alias("bucket"), *(F.col(c).alias(f"_{c}") for c in columns))


def weighted(by_source: DataFrame) -> DataFrame:
    """Adds weight to (no_source, source, source_size): the place of the source in code-point order, modulo 3."""
    placed = settle(by_source.repartitionByRange(*_NAME).sortWithinPartitions(*_NAME).withColumn("part", F.spark_partition_id()))
    before = {r["part"]: r["n"] for r in placed.groupBy("part").agg(F.count("*").alias("n")).collect()}  # one row for each range
    starts = [(p, sum(n for q, n in before.items() if q < p)) for p in before]
    placed = placed.join(F.broadcast(placed.sparkSession.createDataFrame(starts, "part int, start long")), "part")  # a row for each range
    rank = F.row_number().over(Window.partitionBy("part").orderBy(*_NAME)) - 1 + F.col("start")
    return placed.select(*_NAME, "source_size", (rank % 3 + 1).cast("double").alias("weight"))


def targets(by_source: DataFrame) -> DataFrame:
    """Adds weight, total and target to (no_source, source, source_size)."""
    each = settle(weighted(by_source))
    total = each.agg(F.sum("source_size")).first()[0] or 0
    cap, level, n = F.col("source_size") * float(EPOCHS), 0.0, -1
    while True:  # sources above their cap at the last level keep it; a level only rises, so this ends
        full = F.col("weight") * level >= cap
        got = each.agg(F.coalesce(F.sum(F.when(full, cap)), F.lit(0.0)), F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)), F.coalesce(F.sum(full.cast("long")), F.lit(0))).first()
        if got[2] == n or not got[1]:
            break
        n, level = got[2], (total - got[0]) / got[1]
    return each.withColumn("total", F.lit(total).cast("long")).withColumn("target", F.when(F.col("weight") * level >= cap, cap).otherwise(F.col("weight") * level))


def quotas(goal: DataFrame) -> DataFrame:
    """Adds block (tokens), blocks (of the source) and won (blocks won) by Sainte-Lague over ceil(total / block) blocks."""
    goal = settle(goal)
    total = goal.agg(F.max("total")).first()[0] or 0
    block = max(1, -(-total // BLOCKS))
    seats = -(-total // block)

    def seats_at(divisor: float) -> Column:
        return F.floor(F.col("target") / divisor + 0.5)

    low, high = block / 4, 4.0 * block  # of the divisor: more seats than wanted, fewer
    while seats and goal.agg(F.sum(seats_at(high))).first()[0] > seats:
        high *= 4
    while seats and goal.agg(F.sum(seats_at(low))).first()[0] < seats:
        low /= 4
    for _ in range(STEPS if seats else 0):
        grid = [low * (high / low) ** (i / GRID) for i in range(GRID + 1)]
        won = goal.agg(*(F.sum(seats_at(d)) for d in grid)).first()
        enough = max(i for i, x in enumerate(won) if x >= seats)
        low, high = grid[enough], grid[min(enough + 1, GRID)]
    sure = F.least(seats_at(high), seats_at(low)) if seats else F.lit(0)
    every = settle(goal.withColumn("sure", sure.cast("long")).withColumn("most", (seats_at(low) if seats else F.lit(0)).cast("long")))
    left = seats - (every.agg(F.sum("sure")).first()[0] or 0)
    last = every.where("most > sure").select(*_NAME, "target", F.explode(F.sequence("sure", F.col("most") - 1)).alias("seat"))
    winners = last.orderBy((F.col("target") / (2 * F.col("seat") + 1)).desc(), *_NAME, "seat").limit(max(left, 0)).groupBy(*_NAME).agg(F.count("*").alias("more"))
    blocks = F.ceil(F.col("source_size") / F.lit(block)).cast("long")
    won = F.least(F.col("sure") + F.coalesce("more", F.lit(0)), EPOCHS * F.col("blocks"))  # a document comes EPOCHS times at most
    return every.join(winners, [*_NAME], "left").withColumn("block", F.lit(block).cast("long")).withColumn("blocks", blocks).select(*_NAME, "source_size", "target", "block", "blocks", won.cast("long").alias("won"))


# Of the ``rest`` blocks beyond whole epochs: ``big`` shards have one block more than the others and stand first, in the stream and
# among equal quotients, so the highest quotients give each shard rest div shards, and one more to the first rest % shards
_SHARDS = {
    "whole": "won div greatest(blocks, 1)", "rest": "won % greatest(blocks, 1)", "shards": f"least({SHARDS}L, greatest(blocks, 1L))",
    "big": "blocks % shards", "length": "blocks div shards", "each": "rest div shards", "more": "rest % shards",
}


def sharded(goal: DataFrame) -> DataFrame:
    for name, how in _SHARDS.items():
        goal = goal.withColumn(name, F.expr(how))
    return goal


def shard_quotas(goal: DataFrame) -> DataFrame:
    """(source, shard, length, quota): blocks of each shard in the source's stream, and those that it takes besides whole epochs, of ``quotas``."""
    each = sharded(goal).withColumn("shard", F.explode(F.expr("sequence(0L, shards - 1)")))
    return each.select(F.when(F.col("no_source") == 0, F.col("source")).alias("source"), "shard", F.expr("length + if(shard < big, 1, 0)").alias("length"), F.expr("each + if(shard < more, 1, 0)").alias("quota"))


def _coprime(n: str) -> str:
    """A step through n blocks that meets each once."""
    return f"case {' '.join(f'when {n} % {p} <> 0 then {p}L' for p in (999983, 999979, 999961, 999959, 999953, 999931))} else 1L end"


def mix_sources(docs: DataFrame, seed: int = 2, columns: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, size, source_size, target, taken, columns) of every row of ``docs(doc_id, text, source)``; ``columns`` of it travel along."""
    rows = settle_table(sizes(docs, seed, columns))
    per_bucket = settle(rows.groupBy(*_NAME, "bucket").agg(F.sum("size").alias("bucket_size")))
    goal = sharded(quotas(targets(per_bucket.groupBy(*_NAME).agg(F.sum("bucket_size").alias("source_size")))))
    goal = goal.withColumns({"step_big": F.expr(_coprime("(length + 1)")), "step": F.expr(_coprime("length")), "shift": F.pmod(F.xxhash64(F.lit(seed), *_NAME), F.lit(1 << 40))})
    before = Window.partitionBy(*_NAME).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_bucket.withColumn("bucket_start", F.coalesce(F.sum("bucket_size").over(before), F.lit(0))).drop("bucket_size").join(goal, [*_NAME])
    inside = Window.partitionBy(*_NAME, "bucket").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("ahead", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(starts, [*_NAME, "bucket"])
    low = (F.col("bucket_start") + F.col("ahead")).cast("long")
    placed = placed.withColumn("low", low).withColumn("high", (F.col("low") + F.col("size")).cast("long"))
    # block j of the stream lies in shard s at place j - first; it goes if its rank in the shard's permutation is below the quota
    extra = F.expr("""
        aggregate(transform(if(size = 0 or rest = 0, cast(array() as array<bigint>), sequence(low div block, (high - 1) div block)), j -> named_struct('j', j, 's',
            if(j < big * (length + 1), j div (length + 1), big + (j - big * (length + 1)) div greatest(length, 1)))), 0L,
          (sum, x) -> sum + if(
            if(x.s < big, pmod((x.j - x.s * (length + 1)) * step_big + shift, length + 1), pmod((x.j - big - x.s * length) * step + shift, greatest(length, 1))) < each + if(x.s < more, 1, 0),
            least(high, (x.j + 1) * block) - greatest(low, x.j * block), 0L))
    """)
    return placed.select("doc_id", "size", F.col("source_size").cast("long"), "target", (F.col("whole") * F.col("size") + extra).cast("long").alias("taken"), *(F.col(f"_{c}").alias(c) for c in columns))
