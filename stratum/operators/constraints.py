"""Invariants published exactly, bounds derived from them, and checks of estimates against them."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratum.operators.hierarchy import Hierarchy

TOLERANCE = 0.001
# fixed values: most persons in a unit, for level 0 (households) and for the others
CAPS = (99, 99999)


def unit_table(units: DataFrame, levels: int, *keys: str) -> DataFrame:
    """Dense (keys, hhgq, n) of unit counts, vacant units (level = ``levels``) left out."""
    every = units.select(*keys).distinct().withColumn("hhgq", F.explode(F.sequence(F.lit(0), F.lit(levels - 1))))
    return every.join(units, [*keys, "hhgq"], "left").select(*keys, "hhgq", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def invariants(hist: DataFrame, units: DataFrame, levels: int, *keys: str) -> DataFrame:
    """(keys, name, idx, value): tot, gqhh_vect, gqhh_tot and gq_vect of every unit."""
    dense = unit_table(units, levels, *keys)
    tot = hist.groupBy(*keys).agg(F.sum("n").cast("long").alias("value")).select(*keys, F.lit("tot").alias("name"), F.lit(0).alias("idx"), "value")
    vect = dense.select(*keys, F.lit("gqhh_vect").alias("name"), F.col("hhgq").alias("idx"), F.col("n").alias("value"))
    gq = dense.where("hhgq > 0").select(*keys, F.lit("gq_vect").alias("name"), (F.col("hhgq") - 1).alias("idx"), F.col("n").alias("value"))
    total = dense.groupBy(*keys).agg(F.sum("n").cast("long").alias("value")).select(*keys, F.lit("gqhh_tot").alias("name"), F.lit(0).alias("idx"), "value")
    return reduce(DataFrame.unionByName, [tot, vect, gq, total])


def _with_totals(hist: DataFrame, units: DataFrame, levels: int, *keys: str) -> DataFrame:
    tot = hist.groupBy(*keys).agg(F.sum("n").cast("long").alias("tot"))
    dense = unit_table(units, levels, *keys).withColumn("units", F.sum("n").over(Window.partitionBy(*keys)))
    return dense.join(tot, list(keys), "left").withColumn("tot", F.coalesce("tot", F.lit(0).cast("long")))


def lower(v: Column, units: Column, tot: Column) -> Column:
    """Persons in a category are as many as its units at least, and all persons if no other unit exists."""
    return F.when(units - v > 0, v).otherwise(tot)


def upper(v: Column, units: Column, tot: Column) -> Column:
    """All persons but one for every other unit, or none without a unit of the category."""
    return F.when(v > 0, tot - (units - v)).otherwise(0)


def bounds(hist: DataFrame, units: DataFrame, levels: int, *keys: str) -> DataFrame:
    """(keys, cons, row, sign, rhs) of the bounds on the marginal over quarters, with known totals."""
    base = _with_totals(hist, units, levels, *keys)
    sides = F.explode(F.array(*(F.struct(F.lit(c).alias("cons"), F.lit(s).alias("sign"), f(F.col("n"), F.col("units"), F.col("tot")).cast("long").alias("rhs")) for c, s, f in (("hhgq_total_lb", "ge", lower), ("hhgq_total_ub", "le", upper)))))
    return base.select(*keys, F.col("hhgq").alias("row"), sides.alias("side")).select(*keys, "side.cons", "row", "side.sign", "side.rhs")


def bounds_without_total(units: DataFrame, levels: int, *keys: str) -> DataFrame:
    """Upper bounds by capacity where the total isn't known."""
    cap = F.when(F.col("hhgq") == 0, CAPS[0]).otherwise(CAPS[1])
    return unit_table(units, levels, *keys).select(*keys, F.lit("hhgq_total_ub").alias("cons"), F.col("hhgq").alias("row"), F.lit("le").alias("sign"), (F.col("n") * cap).cast("long").alias("rhs"))


def union_bounds(hist: DataFrame, units: DataFrame, levels: int, sizes: range, *keys: str) -> DataFrame:
    """The same bounds for every union of categories of the given sizes; ``row`` numbers the unions in order of size."""
    base = _with_totals(hist, units, levels, *keys)
    sets = [c for s in sizes for c in combinations(range(levels), s)]
    which = F.explode(F.array(*(F.struct(F.lit(i).alias("row"), F.array(*map(F.lit, c)).alias("set")) for i, c in enumerate(sets))))
    per = base.groupBy(*keys, "units", "tot").agg(F.map_from_entries(F.collect_list(F.struct("hhgq", "n"))).alias("by")).withColumn("u", which)  # ``levels`` entries
    v = F.aggregate(F.col("u.set"), F.lit(0).cast("long"), lambda a, x: a + F.element_at(F.col("by"), x))
    low = F.when(F.col("units") - v > 0, v).otherwise(F.col("tot"))
    high = F.when(v > 0, F.col("tot") - (F.col("units") - v)).otherwise(0)
    return per.select(*keys, F.col("u.row").alias("row"), low.cast("long").alias("lb"), high.cast("long").alias("ub"))


def carry_up(h: Hierarchy, bounded: DataFrame, level: str, to: str) -> DataFrame:
    """Bounds of an upper level that has none of its own: the sums of those below."""
    rows = bounded.where(F.col("geolevel") == level)
    return rows.groupBy(F.lit(to).alias("geolevel"), h.code(to, F.col("geocode")).alias("geocode"), "cons", "row", "sign").agg(F.sum("rhs").cast("long").alias("rhs"))


def check(answers: DataFrame, rhs: DataFrame, *keys: str) -> DataFrame:
    """(keys, cons, row, sign, rhs, n, ok); an answer that is absent is 0."""
    both = rhs.join(answers, [*keys, "row"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    gap = F.col("n") - F.col("rhs")
    ok = F.when(F.col("sign") == "=", F.abs(gap) < TOLERANCE).when(F.col("sign") == "ge", gap > -TOLERANCE).otherwise(gap < TOLERANCE)
    return both.select(*keys, "cons", "row", "sign", "rhs", "n", ok.alias("ok"))
