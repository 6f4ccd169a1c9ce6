"""Error metrics of an estimate against the truth, by unit and by cell, and their summaries over units."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratum.operators.estimate import settle
from stratum.operators.histogram import Domain


def paired(true: DataFrame, estimate: DataFrame, *keys: str) -> DataFrame:
    """(keys, cell, c1, c2) by full outer join; an absent cell is 0."""
    a, b = true.withColumnRenamed("n", "c1"), estimate.withColumnRenamed("n", "c2")
    return a.join(b, [*keys, "cell"], "full_outer").select(*keys, "cell", F.coalesce("c1", F.lit(0)).alias("c1"), F.coalesce("c2", F.lit(0)).alias("c2"))


def cells(pairs: DataFrame, *keys: str) -> DataFrame:
    d = F.abs(F.col("c2") - F.col("c1"))
    return pairs.select(*keys, "cell", d.alias("L1_cell"), (d / (10 + F.col("c1"))).alias("relL1_cell"))


def geounits(pairs: DataFrame, domain: Domain, *keys: str) -> DataFrame:
    """One column per metric of each unit; ratios are null where they divide by 0."""
    d = F.col("c2") - F.col("c1")
    l1, l2, inf = F.sum(F.abs(d)), F.sqrt(F.sum(d * d)), F.max(F.abs(d))
    t1, t2 = F.sum("c1"), F.sum("c2")
    over = lambda x, y: x / F.when(y != 0, y)
    nonzero = lambda c: F.lit(domain.size) - F.count(F.when(F.col(c) != 0, 1))
    return pairs.groupBy(*keys).agg(
        F.lit(1).alias("geoCount"), l1.alias("L1_geounit"), over(l1, t2).alias("avgL1_geounit"), l2.alias("L2_geounit"), over(l2, t2).alias("avgL2_geounit"),
        F.sum(F.abs(d) / (10 + F.col("c1"))).alias("relL1_geounit"), F.sum(d * d / (10 + F.col("c1"))).alias("relL2_geounit"), inf.alias("LInf_geounit"),
        F.max(d).alias("LInf_signed"), over(inf, t2).alias("avgLInf_geounit"), (0.5 * over(l1, t1)).alias("tvd_geounit"), t1.alias("tot_pop_geounit"),
        nonzero("c2").alias("sparsity_geounit"), nonzero("c1").alias("true_sparsity_geounit"),
    )


def marginals(pairs: DataFrame, domain: Domain, axes: list[str], *keys: str) -> DataFrame:
    """(keys, axes..., c1, c2, L1): true and estimated marginal counts and their distance."""
    level = [domain.axis(domain.names.index(a)).alias(a) for a in axes]
    sums = pairs.select(*keys, *level, "c1", "c2").groupBy(*keys, *axes).agg(F.sum("c1").alias("c1"), F.sum("c2").alias("c2"))
    return sums.withColumn("L1", F.abs(F.col("c2") - F.col("c1")))


def long(wide: DataFrame, names: list[str], *keys: str) -> DataFrame:
    """(keys, metric, value)."""
    pairs = F.explode(F.array(*(F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in names)))
    return wide.select(*keys, pairs.alias("m")).select(*keys, "m.*")


def summary(values: DataFrame, how: str, *keys: str) -> DataFrame:
    """(keys, metric, aggtype, value): the sum or average over units."""
    f = {"sum": F.sum, "avg": F.avg}[how]
    return values.groupBy(*keys, "metric").agg(f("value").alias("value")).withColumn("aggtype", F.lit(how))


EXACT_UNITS = 25_000  # that one group may hold
SPLITS = 1000  # ranges that more values are ranked in


def quantiles(values: DataFrame, at: list[float], units: int, *keys: str) -> DataFrame:
    """(keys, metric, quantile, value): interpolated quantiles, exact however many ``units`` there are."""
    if units > EXACT_UNITS:
        return _ranked_quantiles(values, at, *keys)
    points = F.array(*map(F.lit, at))
    f = F.percentile("value", points)
    return values.groupBy(*keys, "metric").agg(f.alias("q")).select(*keys, "metric", F.posexplode("q").alias("i", "value")).select(*keys, "metric", F.element_at(points, F.col("i") + 1).alias("quantile"), "value")


def _ranked_quantiles(values: DataFrame, at: list[float], *keys: str) -> DataFrame:
    """(keys, metric, quantile, value) without a group or window that holds all values of a metric.

    Equal values are one row with their number.  Approximate quantiles cut the values into ranges; counts of ranges say which of them hold the ranks
    asked for, and only these are put in order."""
    by = [*keys, "metric"]
    same = settle(values.where("value IS NOT NULL").groupBy(*by, "value").agg(F.count("*").alias("many")))
    cuts = same.groupBy(*by).agg(F.array_distinct(F.percentile_approx("value", F.array(*(F.lit(i / SPLITS) for i in range(1, SPLITS))), 10 * SPLITS)).alias("cuts"))
    dealt = same.join(F.broadcast(cuts), by).withColumn("range", F.size(F.filter("cuts", lambda c: c < F.col("value")))).drop("cuts")
    upto = Window.partitionBy(*by).orderBy("range")
    sizes = dealt.groupBy(*by, "range").agg(F.sum("many").alias("size"))
    sizes = sizes.withColumn("end", F.sum("size").over(upto)).withColumn("all", F.sum("size").over(Window.partitionBy(*by)))
    place = F.col("quantile") * (F.col("all") - 1)
    asked = sizes.withColumn("quantile", F.explode(F.array(*map(F.lit, at)))).withColumns({"low": F.floor(place), "high": F.ceil(place), "part": place - F.floor(place), "begin": F.col("end") - F.col("size")})
    asked = asked.where((F.col("low") < F.col("end")) & (F.col("high") >= F.col("begin"))).select(*by, "range", "begin", "quantile", "low", "high", "part")
    wanted = dealt.join(F.broadcast(asked.select(*by, "range", "begin").distinct()), [*by, "range"])
    ranked = wanted.withColumn("last", F.col("begin") + F.sum("many").over(Window.partitionBy(*by, "range").orderBy("value"))).withColumn("first", F.col("last") - F.col("many"))
    holds = lambda rank: (F.col("first") <= F.col(rank)) & (F.col(rank) < F.col("last"))
    found = ranked.join(F.broadcast(asked.drop("begin")), [*by, "range"]).where(holds("low") | holds("high"))
    ends = found.groupBy(*by, "quantile", "part").agg(*(F.max(F.when(holds(r), F.col("value"))).alias(f"{r}_value") for r in ("low", "high")))
    return ends.select(*by, "quantile", (F.col("low_value") + F.col("part") * (F.col("high_value") - F.col("low_value"))).alias("value"))


def collected(values: DataFrame, *keys: str) -> DataFrame:
    """(keys, metric, units): sorted (geocode, value) of each metric; for levels of few units."""
    return values.groupBy(*keys, "metric").agg(F.sort_array(F.collect_list(F.struct("geocode", "value"))).alias("units"))


def total_l1(pairs: DataFrame) -> DataFrame:
    return pairs.agg(F.sum(F.abs(F.col("c2") - F.col("c1"))).cast("long").alias("l1"), F.sum("c1").cast("long").alias("n"))


def subset(cube: DataFrame, **only: list[str]) -> DataFrame:
    """Slice of the metric cube (geolevel, aggtype, metric, value)."""
    return reduce(lambda df, kv: df.where(F.col(kv[0]).isin(kv[1])), only.items(), cube)


def linspace(n: int) -> list[float]:
    return [i / (n - 1) for i in range(n)]


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, to compare results of different engines."""
    return df.select(*(_round(f.name, digits) if f.dataType.simpleString() == "double" else F.col(f.name) for f in df.schema))


def _round(name: str, digits: int) -> Column:
    return F.round(name, digits).alias(name)
