"""Linear queries over histograms: subset, groups of levels, sums over axes, weights.  ``row`` indexes the answer row-major."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.operators.histogram import Domain


@dataclass(frozen=True)
class LinearQuery:
    """``subset``: axis -> kept levels; ``groups``: axis -> lists of levels (a level may be in several); ``over``: summed axes;
    ``weights``: axis -> factor of each level.  A subset on a summed axis is fine, one on a grouped axis is not."""

    domain: Domain
    name: str = ""
    subset: dict[int, list[int]] = field(default_factory=dict)
    groups: dict[int, list[list[int]]] = field(default_factory=dict)
    over: tuple[int, ...] = ()
    weights: dict[int, list[float]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        axes = range(len(self.domain.dims))
        for k in [*self.subset, *self.groups, *self.over, *self.weights]:
            if k not in axes:
                raise ValueError(f"axis {k} is not in the domain")
        if len(set(self.over)) != len(self.over):
            raise ValueError("an axis is summed twice")
        if set(self.groups) & (set(self.over) | set(self.subset)):
            raise ValueError("a grouped axis can be neither summed nor cut to a subset")
        for k, levels in [*self.subset.items(), *((k, [x for g in gs for x in g]) for k, gs in self.groups.items())]:
            if not set(levels) <= set(range(self.domain.dims[k])):
                raise ValueError(f"axis {k} has no such level")
        for k, w in self.weights.items():
            if len(w) != self.domain.dims[k]:
                raise ValueError(f"axis {k} needs {self.domain.dims[k]} weights")

    @property
    def kept(self) -> list[int]:
        return [k for k in range(len(self.domain.dims)) if k not in self.over]

    @property
    def shape(self) -> tuple[int, ...]:
        return tuple(len(self.groups.get(k) or self.subset.get(k) or range(self.domain.dims[k])) for k in self.kept)

    @property
    def n_answers(self) -> int:
        return int(np.prod(self.shape, dtype=int))

    def factor(self, k: int) -> np.ndarray:
        """The query's matrix on one axis; the whole matrix is the Kronecker product of all."""
        n = self.domain.dims[k]
        if k in self.groups:
            m = np.array([[float(x in g) for x in range(n)] for g in self.groups[k]])
        else:
            keep = self.subset.get(k, list(range(n)))
            m = np.eye(n)[keep] if k not in self.over else np.isin(np.arange(n), keep).astype(float)[None]
        return m * np.array(self.weights.get(k, [1.0] * n))

    def matrix(self) -> np.ndarray:
        return reduce(np.kron, (self.factor(k) for k in range(len(self.domain.dims))), np.ones((1, 1)))

    def sensitivity(self) -> float:
        """Largest column sum of absolute values, as the product over axes."""
        return float(np.prod([np.abs(self.factor(k)).sum(0).max() for k in range(len(self.domain.dims))]))

    def counting(self) -> bool:
        return all(np.abs(f - f.round()).max() < 1e-9 for f in map(self.factor, range(len(self.domain.dims))))

    def answer(self, hist: DataFrame, *keys: str) -> DataFrame:
        """(keys, row, n): answers that are not zero by default; one aggregation, no join."""
        df = hist
        for k, keep in self.subset.items():
            df = df.where(self.domain.axis(k).isin(keep))
        row: Column = F.lit(0)
        columns = {}
        for k, size in zip(self.kept, self.shape, strict=True):
            level = self.domain.axis(k)
            if k in self.groups:
                inside = F.array_compact(F.array(*(F.when(level.isin(g), F.lit(i)) for i, g in enumerate(self.groups[k]))))
                df = df.withColumn(f"_g{k}", F.explode(inside))
                place = F.col(f"_g{k}")
            else:
                place = level if k not in self.subset else (F.array_position(F.array(*map(F.lit, self.subset[k])), level) - 1)
            row = row * size + place
        columns["row"] = row.cast("int")
        value: Column = F.col("n")
        for k, w in self.weights.items():
            value = value * F.element_at(F.array(*map(F.lit, w)), self.domain.axis(k) + 1)
        return df.withColumns(columns).groupBy(*keys, "row").agg(F.sum(value).alias("n"))


@dataclass(frozen=True)
class KroneckerQuery:
    """A query given by one matrix for each axis; its matrix is their Kronecker product.  Rows are numbered row-major over the factors' rows."""

    domain: Domain
    factors: tuple[tuple[tuple[float, ...], ...], ...]
    name: str = ""

    def __post_init__(self) -> None:
        if len(self.factors) != len(self.domain.dims):
            raise ValueError(f"{len(self.factors)} factors for {len(self.domain.dims)} axes")
        for k, (f, n) in enumerate(zip(self.factors, self.domain.dims, strict=True)):
            if not f or any(len(r) != n for r in f):
                raise ValueError(f"the factor of axis {k} needs rows of {n} numbers")

    @property
    def n_answers(self) -> int:
        return int(np.prod([len(f) for f in self.factors], dtype=int))

    def matrix(self) -> np.ndarray:
        return reduce(np.kron, (np.array(f, float) for f in self.factors), np.ones((1, 1)))

    def answer(self, hist: DataFrame, *keys: str) -> DataFrame:
        """(keys, row, n): for each axis a level is exploded to the rows of its factor that use it; answers are numbers with fractions."""
        df, row, coef = hist, F.lit(0), F.lit(1.0)
        for k, f in enumerate(self.factors):
            uses = [[(r, x[c]) for r, x in enumerate(f) if x[c]] for c in range(self.domain.dims[k])]
            entry = F.array(*(F.array(*(F.struct(F.lit(r).alias("r"), F.lit(float(v)).alias("v")) for r, v in u)) if u else F.expr("cast(array() as array<struct<r:int,v:double>>)") for u in uses))
            df = df.withColumn(f"_f{k}", F.explode(F.element_at(entry, self.domain.axis(k) + 1)))
            row, coef = row * len(f) + F.col(f"_f{k}.r"), coef * F.col(f"_f{k}.v")
        return df.withColumn("row", row.cast("int")).groupBy(*keys, "row").agg(F.sum(F.col("n") * coef).alias("n"))


def answers(queries: dict[str, LinearQuery | KroneckerQuery], hist: DataFrame, *keys: str) -> DataFrame:
    """(keys, query, row, n) of all queries in one aggregation; whole numbers where all queries count.

    Cells go to their answers by a broadcast table with an entry for each cell and answer that uses it, as large as the queries, not the data."""
    entries = []
    for name, q in queries.items():
        m = q.matrix()
        entries += [(int(c), name, int(r), float(m[r, c])) for r, c in zip(*m.nonzero(), strict=True)]
    table = hist.sparkSession.createDataFrame(entries, "cell int, query string, row int, coef double")
    total = F.sum(F.col("n") * F.col("coef"))
    whole = all(coef.is_integer() for *_, coef in entries)
    return hist.join(F.broadcast(table), "cell").groupBy(*keys, "query", "row").agg((total.cast("long") if whole else total).alias("n"))


def weighted_cells(hist: DataFrame, weights: DataFrame, query: LinearQuery, *keys: str) -> DataFrame:
    """Answers of a query over counts times ``weights(cell, weight)``, one number for each cell of the domain; absent ones are 1."""
    rows = hist.join(F.broadcast(weights), "cell", "left")  # a row for each cell at most
    return query.answer(rows.withColumn("n", F.col("n") * F.coalesce("weight", F.lit(1.0))), *keys)


def stacked(queries: list[LinearQuery | KroneckerQuery], hist: DataFrame, *keys: str, domain_subset: list[int] | None = None) -> DataFrame:
    """Answers of several queries under one another: rows of later queries are shifted.  Cells outside ``domain_subset`` don't count."""
    if len({q.domain for q in queries}) > 1:
        raise ValueError("stacked queries need one domain")
    if domain_subset is not None:
        if not set(domain_subset) <= set(range(queries[0].domain.size)):
            raise ValueError("the subset has cells outside the domain")
        hist = hist.where(F.col("cell").isin(domain_subset))
    parts, start = [], 0
    for q in queries:
        parts.append(q.answer(hist, *keys).withColumn("row", F.col("row") + start))
        start += q.n_answers
    return reduce(DataFrame.unionByName, parts)


def check_shape(query: LinearQuery | KroneckerQuery, rhs: DataFrame, *keys: str) -> DataFrame:
    """``rhs(keys, row, ...)`` if every unit has one right side for each answer of the query; else an error names the unit's number of rows."""
    per = rhs.groupBy(*keys).agg(F.count("*").alias("_n"), F.countDistinct("row").alias("_d"), F.min("row").alias("_low"), F.max("row").alias("_high"))
    fits = (F.col("_n") == query.n_answers) & (F.col("_d") == query.n_answers) & (F.col("_low") == 0) & (F.col("_high") == query.n_answers - 1)
    bad = F.raise_error(F.concat(F.lit(f"{query.name or 'query'} has {query.n_answers} answers, a unit has "), F.col("_n").cast("string")))
    return rhs.join(per.select(*keys, F.when(fits, True).otherwise(bad.cast("boolean")).alias("_ok")), list(keys)).where("_ok").drop("_ok")


def reduced(query: LinearQuery, kept: tuple[str, ...]) -> LinearQuery:
    """The query over the histogram summed to the axes ``kept``: what it does on other axes must be to sum them whole."""
    d = query.domain
    gone = [k for k, n in enumerate(d.names) if n not in kept]
    for k in gone:
        if k not in query.over or k in query.subset or k in query.weights:
            raise ValueError(f"axis {d.names[k]} isn't summed whole")
    left = [k for k in range(len(d.names)) if k not in gone]
    place = {k: i for i, k in enumerate(left)}
    move = lambda x: {place[k]: v for k, v in x.items()}
    return LinearQuery(Domain(tuple(d.names[k] for k in left), tuple(d.dims[k] for k in left)), query.name, move(query.subset), move(query.groups), tuple(place[k] for k in query.over if k in place), move(query.weights))


def marginal(domain: Domain, *axes: str, name: str = "") -> LinearQuery:
    """Sum over all axes but the named."""
    return LinearQuery(domain, name or "_".join(axes) or "total", over=tuple(k for k, n in enumerate(domain.names) if n not in axes))


def marginal_family(domain: Domain, hist: DataFrame, sizes: list[int], *keys: str) -> DataFrame:
    """All marginals of the given numbers of axes in one pass: (keys, marginal, axes..., n); an axis that is summed is null.

    A row is listed once for each marginal; its keys stay, so rows that come dealt out by keys are summed where they are."""
    from itertools import combinations

    sets = [c for s in sizes for c in combinations(domain.names, s)]
    level = {n: domain.axis(k) for k, n in enumerate(domain.names)}
    place = lambda s: F.struct(F.lit("_".join(s)).alias("marginal"), *((level[n] if n in s else F.lit(None).cast("int")).alias(n) for n in domain.names))
    listed = hist.select(*keys, "n", F.explode(F.array(*map(place, sets))).alias("_m")).select(*keys, "n", "_m.*")
    return listed.groupBy(*keys, "marginal", *domain.names).agg(F.sum("n").cast("long").alias("n"))
