"""Noisy measurements and the top-down estimate that agrees with them and adds up along the hierarchy.

Measurements are settled (written once) before use: evaluating them again would draw other noise in secure mode, and spend
the budget twice.  Per parent and cell the least-squares estimate under "children add up to the parent, none negative" is the
projection on a simplex, and controlled rounding is a top-k of fractions: both are window functions over the children of one
parent.  With more queries per unit the problem couples cells: ``couple`` multiplies each unit's answers by a fixed matrix.  Estimates under bounds
are in ``constrained``."""

from __future__ import annotations

import re
import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratum.functions.noise import Budget, geometric_by, geometric_p, hash_uniform, secure_uniform
from stratum.operators.hierarchy import Hierarchy
from stratum.operators.histogram import Domain
from stratum.operators.linear import LinearQuery


def settle(df: DataFrame) -> DataFrame:
    """Rows written once to the shared checkpoint folder, of unknown size.

    A checkpoint inherits the plan's estimate of bytes, which joins multiply: where rounds join settled tables, its digits grow as a power of their number, and fill the driver."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not folder and not re.fullmatch(r"local(\[.*\])?", sc.master):  # a temporary folder is for sessions on one machine only
            raise ValueError("spark.checkpoint.dir is not set: it must name a folder that driver and executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoint-"))
    jdf = df.checkpoint()._jdf
    return DataFrame(df.sparkSession._jsparkSession.internalCreateDataFrame(jdf.queryExecution().toRdd(), jdf.schema(), False), df.sparkSession)


def tasks(settled: DataFrame) -> int:
    """Tasks for what is made of a settled table: as many as it has parts, and as shuffles have, so that a task's share doesn't grow with the table."""
    return max(int(settled.sparkSession.conf.get("spark.sql.shuffle.partitions")), settled.rdd.getNumPartitions())


def answers_of(domain: Domain, queries: dict[str, LinearQuery], names: list[str]) -> tuple[list[tuple[str, int, int]], list[tuple[int, int, float]]]:
    """(name, first index, number of answers) of each query, and (cell, index, coefficient) of all; "detailed" is the histogram itself."""
    spans, cells, at = [], [], 0
    for name in names:
        if name == "detailed":
            spans.append((name, at, domain.size))
            cells += [(c, at + c, 1.0) for c in range(domain.size)]
        else:
            m = queries[name].matrix()
            spans.append((name, at, len(m)))
            cells += [(int(c), at + int(r), float(m[r, c])) for r, c in zip(*m.nonzero(), strict=True)]
        at += spans[-1][2]
    return spans, cells


def measure(hist: DataFrame, units: DataFrame, domain: Domain, budget: Budget, queries: dict[str, LinearQuery], secure: bool = False) -> DataFrame:
    """(geolevel, geocode, query, row, noisy, epsilon, var) of every unit: zeros are measured too, the true count is not kept.

    All queries of all levels are one aggregation: cells go to their answers by a broadcast table (as large as the domain and its
    queries) and are combined before the shuffle.  A unit's answers are then one row, which lists its zeros too: zeros are neither aggregated nor moved."""
    keys = ("geolevel", "geocode")
    spans, cells = answers_of(domain, queries, list(dict.fromkeys(q for _, q, _, _ in budget.rows())))
    table = hist.sparkSession.createDataFrame(cells, "cell int, answer int, coef double")
    some = hist.join(F.broadcast(table), "cell").select(*keys, "answer", (F.col("n") * F.col("coef")).alias("n"))
    counted = some.groupBy(*keys, "answer").agg(F.sum("n").cast("long").alias("n"))
    packed = counted.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("answer", "n"))).alias("counts"))  # as many as answers
    every = units.select(*keys).distinct().join(packed, list(keys), "full")
    listed = every.select(*keys, "counts", F.explode(F.sequence(F.lit(0), F.lit(spans[-1][1] + spans[-1][2] - 1))).alias("answer"))
    true = listed.select(*keys, "answer", F.coalesce(F.element_at("counts", F.col("answer")), F.lit(0)).cast("long").alias("n"))
    name, first = F.lit(spans[-1][0]), F.lit(spans[-1][1])
    for q, start, size in spans[-2::-1]:
        name, first = F.when(F.col("answer") < start + size, q).otherwise(name), F.when(F.col("answer") < start + size, start).otherwise(first)
    named = true.withColumn("query", name).withColumn("row", F.col("answer") - first)
    spent = hist.sparkSession.createDataFrame([(level, q, e, v, float(np.log(1 - geometric_p(e, budget.sensitivity)))) for level, q, e, v in budget.rows()], "geolevel string, query string, epsilon double, var double, scale double")
    rows = named.join(F.broadcast(spent), ["geolevel", "query"])
    key = [F.col("geolevel"), F.col("geocode"), F.col("query"), F.col("row").cast("string")]
    draw = (lambda part: secure_uniform(F.col("n"))) if secure else (lambda part: hash_uniform(*key, F.lit(part)))
    value = F.col("n") + geometric_by(draw("a"), draw("b"), F.col("scale"))
    return rows.select(*keys, "query", "row", value.cast("long").alias("noisy"), "epsilon", "var")


def project(rows: DataFrame, group: list[str], order: list[str], value: str = "noisy", total: str = "total") -> DataFrame:
    """Adds l2: the nearest non-negative values of each group that add up to its ``total``."""
    ranked = Window.partitionBy(*group).orderBy(F.col(value).desc(), *order)
    so_far = ranked.rowsBetween(Window.unboundedPreceding, 0)
    shift = (F.sum(value).over(so_far) - F.col(total)) / F.row_number().over(ranked)
    marked = rows.withColumn("_shift", shift).withColumn("_theta", F.when(F.col(value) - F.col("_shift") > 0, F.col("_shift")))
    last = F.last("_theta", ignorenulls=True).over(ranked.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    l2 = F.when(F.col(total) <= 0, 0.0).otherwise(F.greatest(F.col(value) - last, F.lit(0.0)))
    return marked.withColumn("l2", l2).drop("_shift", "_theta")


def rounded_to(rows: DataFrame, group: list[str], order: list[str], total: str = "total") -> DataFrame:
    """Adds syn: l2 rounded down, and one more where the fraction is among the largest, so that each group adds up to ``total``."""
    # fractions are compared at nine digits, so that engines agree on ties
    whole = F.floor(F.col("l2") + 1e-9)
    frac = F.round(F.col("l2") - whole, 9)
    left = F.col(total) - F.sum(whole).over(Window.partitionBy(*group))
    place = F.row_number().over(Window.partitionBy(*group).orderBy(F.col("_frac").desc(), *order))
    return rows.withColumn("_frac", frac).withColumn("_left", left).withColumn("syn", (whole + F.when(place <= F.col("_left"), 1).otherwise(0)).cast("long")).drop("_frac", "_left")


def top_down(measured: DataFrame, totals: DataFrame, h: Hierarchy, domain: Domain, queries: dict[str, LinearQuery] | None = None) -> DataFrame:
    """(geolevel, geocode, cell, l2, syn): the root projected to its exact total, then every level to its parents' values.

    Each level is settled before the next, as parents feed all their children.  With ``queries`` the noisy answers of these pull the
    estimate before it is projected (``couple``)."""
    measured = settle(measured)
    parts = tasks(measured)

    def detail(level: str) -> DataFrame:
        """A level's cells; units of other levels are left out before ``couple``, not after."""
        own = measured.where(F.col("geolevel") == level)
        return couple(own, domain, queries) if queries else own.where("query = 'detailed'").select("geolevel", "geocode", F.col("row").alias("cell"), "noisy", "var")

    out, above = None, None
    for level in reversed(h.levels):
        rows = detail(level)
        if above is None:
            rows = rows.join(totals.where(F.col("geolevel") == level).select("geocode", F.col("n").alias("total")), "geocode")
            group, order = ["geocode"], ["cell"]
        else:
            rows = rows.withColumn("parent", h.parent(level, F.col("geocode"))).join(above, ["parent", "cell"])
            group, order = ["parent", "cell"], ["geocode"]
        if level == h.levels[0]:  # the level whose groups are as large as the input; there are as many of them as cells and parents
            rows = rows.repartition(parts, *group)
        done = rounded_to(project(rows, group, order), group, order).select("geolevel", "geocode", "cell", "l2", "syn")
        done = settle(done)
        above = done.select(F.col("geocode").alias("parent"), "cell", F.col("syn").alias("total"))
        out = done if out is None else out.unionByName(done)
    return out


def couple(measured: DataFrame, domain: Domain, queries: dict[str, LinearQuery]) -> DataFrame:
    """(geolevel, geocode, cell, noisy, var): weighted least squares of each unit's cells under its detailed and query answers.

    The solution is one fixed matrix for each pattern of variances (one for each level), so units are rows of arrays that tasks multiply
    in batches; a row has domain.size + answers numbers."""
    spans, cells = answers_of(domain, queries, ["detailed", *queries])
    number = spans[-1][1] + spans[-1][2]
    design = np.zeros((number, domain.size))
    for c, r, x in cells:
        design[r, c] = x
    first = F.coalesce(*(F.when(F.col("query") == q, F.lit(at)) for q, at, _ in spans))
    answer = F.struct((first + F.col("row")).alias("i"), F.col("noisy").cast("double").alias("noisy"), "var")
    wanted = measured.where(F.col("query").isin([q for q, _, _ in spans]))
    units = wanted.groupBy("geolevel", "geocode").agg(F.array_sort(F.collect_list(answer)).alias("a"))  # ``number`` entries
    units = units.select("geolevel", "geocode", F.transform("a", lambda x: x["noisy"]).alias("noisy"), F.transform("a", lambda x: x["var"]).alias("var"))

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        inverse: dict[tuple[float, ...], np.ndarray] = {}
        for rows in batches:
            out = []
            for noisy, var in zip(rows["noisy"], rows["var"], strict=True):
                key = tuple(var)
                if key not in inverse:
                    weighted = design.T / np.array(key)
                    inverse[key] = np.linalg.solve(weighted @ design, weighted)
                out.append(inverse[key] @ np.asarray(noisy))
            yield pd.DataFrame({"geolevel": rows["geolevel"], "geocode": rows["geocode"], "x": out, "var": [v[0] for v in rows["var"]]})

    solved = units.mapInPandas(solve, "geolevel string, geocode string, x array<double>, var double")
    return solved.select("geolevel", "geocode", F.posexplode("x").alias("cell", "noisy"), "var")


def two_phase(measured: DataFrame, totals: DataFrame, h: Hierarchy, domain: Domain, kept: LinearQuery) -> DataFrame:
    """First a marginal top-down, then the full histogram with every unit's marginal held at the first phase's estimate.

    In phase two each cell group of a unit (the cells of one marginal row) is projected to that row's value."""
    measured = settle(measured)
    parts = tasks(measured)
    first = measured.where(F.col("query") == kept.name).select("geolevel", "geocode", F.lit("detailed").alias("query"), "row", "noisy", "epsilon", "var")
    marginal = settle(top_down(first, totals, h, domain))
    fixed = marginal.select("geolevel", "geocode", F.col("cell").alias("row"), F.col("syn").alias("total"))
    m = kept.matrix()
    row_of = F.element_at(F.array(*(F.lit(int(m[:, c].argmax())) for c in range(domain.size))), F.col("cell") + 1)
    leaf = h.levels[0]
    rows = measured.where((F.col("query") == "detailed") & (F.col("geolevel") == leaf)).select("geolevel", "geocode", F.col("row").alias("cell"), "noisy").withColumn("row", row_of).repartition(parts, "geolevel", "geocode", "row").join(fixed.repartition(parts, "geolevel", "geocode", "row"), ["geolevel", "geocode", "row"])
    group = ["geocode", "row"]
    rows = rows.repartition(parts, "geocode")
    leaves = rounded_to(project(rows, group, ["cell"]), group, ["cell"]).select("geocode", "cell", F.col("syn").alias("n"))
    return h.rollup(leaves, "cell").withColumnRenamed("n", "syn")


def backup_needed(children: DataFrame, parents: DataFrame, h: Hierarchy, level: str) -> DataFrame:
    """(geolevel, parents, backups): parents whose children's lower bounds exceed, or upper bounds miss, the parent's value."""
    low = children.where(F.col("geolevel") == level).groupBy(h.parent(level, F.col("geocode")).alias("geocode"), "row").agg(F.sum(F.when(F.col("sign") == "ge", F.col("rhs")).otherwise(0)).alias("low"), F.sum(F.when(F.col("sign") == "le", F.col("rhs")).otherwise(0)).alias("high"))
    both = low.join(parents.select("geocode", "row", "n"), ["geocode", "row"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    per = both.groupBy("geocode").agg(F.max(((F.col("low") > F.col("n")) | (F.col("high") < F.col("n"))).cast("int")).alias("bad"))
    return per.agg(F.lit(level).alias("geolevel"), F.count("*").alias("parents"), F.coalesce(F.sum("bad"), F.lit(0)).cast("long").alias("backups"))
