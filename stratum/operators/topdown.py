"""Top-down estimates from all measured queries under constraints that are named level by level.

A level's rule names the invariants that are counted there and the constraints made from these.  On the way up right sides are summed; a
level whose rule names a constraint makes it anew from its own counts.  A constraint that no rule names is nowhere, so totals are free
where the total is not invariant.  Right sides are rows (geolevel, geocode, cons, row, sign, rhs); units without a row of a constraint are
free of it, so children of one parent may have different constraints.

Per parent one grouped function (``solve.solve``) estimates all children together from every measured answer, weighed by its variance, and
rounds them.  A parent of very many children goes to ``crowded``, which splits the children over tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratum.functions.noise import Budget
from stratum.operators import constraints as C
from stratum.operators import solve as S
from stratum.operators.crowded import BLOCK, crowded
from stratum.operators.estimate import answers_of, settle
from stratum.operators.hierarchy import Hierarchy
from stratum.operators.histogram import Domain
from stratum.operators.linear import LinearQuery, marginal

KEYS = ("geolevel", "geocode")
CROWD = 20_000  # children of one parent that a task may hold
INVARIANTS = ("tot", "gqhh_vect", "gqhh_tot")


@dataclass(frozen=True)
class Rule:
    """What a level's own entry names."""

    invariants: tuple[str, ...] = ()
    constraints: tuple[str, ...] = ()


def constraint_queries(domain: Domain, axis: str = "hhgq", zeros: dict[str, LinearQuery] | None = None) -> dict[str, LinearQuery]:
    """The query that each constraint bounds; ``zeros`` are queries whose answers are 0 everywhere."""
    by = marginal(domain, axis)
    return {"total": marginal(domain, name="total"), "hhgq_total_lb": by, "hhgq_total_ub": by, **(zeros or {})}


@dataclass(frozen=True)
class Constrained:
    """The sets of cells behind named constraints: ``place[(name, row)]`` numbers the set, 0 being all cells."""

    queries: dict[str, LinearQuery]
    sets: S.Sets
    place: dict[tuple[str, int], int] = field(default_factory=dict)

    @staticmethod
    def of(domain: Domain, queries: dict[str, LinearQuery]) -> Constrained:
        """Queries must count: a cell is in an answer or not.  Answers whose cells overlap without being nested are an error."""
        seen: dict[bytes, int] = {np.ones(domain.size, bool).tobytes(): 0}
        place = {}
        for name, q in queries.items():
            m = q.matrix()
            if not np.isin(m, (0, 1)).all():
                raise ValueError(f"{name} does not count cells")
            for row, cells in enumerate(m.astype(bool)):
                place[name, row] = seen.setdefault(cells.tobytes(), len(seen))
        return Constrained(queries, S.Sets.of(np.array([np.frombuffer(b, bool) for b in seen])), place)


def level_constraints(hist: DataFrame, units: DataFrame, h: Hierarchy, levels: int, rules: dict[str, Rule], zeros: tuple[str, ...] = ()) -> DataFrame:
    """(geolevel, geocode, cons, row, sign, rhs) of every level, from ``hist(geolevel, geocode, n)`` and ``units(geolevel, geocode, hhgq, n)``.

    The rows of the level that names a constraint are spread up to the next that names it, and summed: one aggregation for all levels."""
    known: set[str] = set()
    parts = []
    for i, level in enumerate(h.levels):
        rule = rules.get(level, Rule())
        for x in rule.invariants:
            if x not in INVARIANTS:
                raise ValueError(f"no invariant {x}")
        known |= set(rule.invariants)
        for name in rule.constraints:
            if name in ("hhgq_total_lb", "hhgq_total_ub") and not {"gqhh_vect", "gqhh_tot"} <= known or name == "total" and "tot" not in known:
                raise ValueError(f"{name} of {level} needs invariants that no rule names")
            until = next((k for k in range(i + 1, len(h.levels)) if name in rules.get(h.levels[k], Rule()).constraints), len(h.levels))
            own = _own(hist.where(F.col("geolevel") == level), units.where(F.col("geolevel") == level), levels, name, "tot" in known, zeros)
            to = F.explode(F.array(*(F.struct(F.lit(x).alias("geolevel"), h.code(x, F.col("geocode")).alias("geocode")) for x in h.levels[i:until])))
            parts.append(own.select(to.alias("u"), "cons", "row", "sign", "rhs").select("u.*", "cons", "row", "sign", "rhs"))
    if not parts:
        return hist.sparkSession.createDataFrame([], "geolevel string, geocode string, cons string, row int, sign string, rhs long")
    return reduce(DataFrame.unionByName, parts).groupBy(*KEYS, "cons", "row", "sign").agg(F.sum("rhs").cast("long").alias("rhs"))


def _own(hist: DataFrame, units: DataFrame, levels: int, name: str, with_total: bool, zeros: tuple[str, ...]) -> DataFrame:
    """(geocode, cons, row, sign, rhs) of one constraint from the counts of its own level."""
    row: Column
    if name == "total":
        every = units.select("geocode").distinct().join(hist.groupBy("geocode").agg(F.sum("n").alias("tot")), "geocode", "left")
        row, sign, rhs, base = F.lit(0), "=", F.coalesce("tot", F.lit(0)), every
    elif name in zeros:
        row, sign, rhs, base = F.lit(0), "=", F.lit(0), units.select("geocode").distinct()
    elif name in ("hhgq_total_lb", "hhgq_total_ub"):
        base = C.unit_table(units, levels, "geocode").withColumn("units", F.sum("n").over(Window.partitionBy("geocode")))
        row, sign, v = F.col("hhgq"), "ge" if name.endswith("lb") else "le", F.col("n")
        if with_total:
            base = base.join(hist.groupBy("geocode").agg(F.sum("n").alias("tot")), "geocode", "left")
            bound = C.lower if sign == "ge" else C.upper
            rhs = bound(v, F.col("units"), F.coalesce("tot", F.lit(0)))
        else:
            rhs = v if sign == "ge" else v * F.when(F.col("hhgq") == 0, C.CAPS[0]).otherwise(C.CAPS[1])
    else:
        raise ValueError(f"no constraint {name}")
    return base.select("geocode", F.lit(name).alias("cons"), row.cast("int").alias("row"), F.lit(sign).alias("sign"), rhs.cast("long").alias("rhs"))


def weights(domain: Domain, budget: Budget, queries: dict[str, LinearQuery], h: Hierarchy) -> tuple[list[tuple[str, int, int]], dict[str, tuple[np.ndarray, list]]]:
    """(spans of the answers, by level the matrix H and for each query its weighted matrix with the answers' span)."""
    names = ["detailed", *budget.queries]
    spans, _ = answers_of(domain, queries, names)
    var = {(level, q): v for level, q, _, v in budget.rows()}
    by_level = {}
    for level in h.levels:
        hess, parts = np.zeros((domain.size, domain.size)), []
        for name, at, size in spans:
            m = np.eye(domain.size) if name == "detailed" else queries[name].matrix()
            hess += m.T @ m / var[level, name]
            parts.append((at, at + size, None if name == "detailed" else m, 1 / var[level, name]))
        by_level[level] = hess, parts
    return spans, by_level


def linear(answers: np.ndarray, parts: list) -> np.ndarray:
    """h of each child from its answers."""
    return sum(w * (answers[:, a:b] if m is None else answers[:, a:b] @ m) for a, b, m, w in parts)


def packed(measured: DataFrame, spans: list[tuple[str, int, int]]) -> DataFrame:
    """(geolevel, geocode, answers): one array with all answers of a unit, as long as the queries are."""
    first = F.coalesce(*(F.when(F.col("query") == q, F.lit(at)) for q, at, _ in spans))
    wanted = measured.where(F.col("query").isin([q for q, _, _ in spans]))
    rows = wanted.groupBy(*KEYS).agg(F.array_sort(F.collect_list(F.struct((first + F.col("row")).alias("i"), F.col("noisy").cast("double").alias("v")))).alias("a"))
    return rows.select(*KEYS, F.transform("a", lambda x: x["v"]).alias("answers"))


def listed(rhs: DataFrame, constrained: Constrained) -> DataFrame:
    """(geolevel, geocode, cons): the right sides of a unit as one list of (set, sign, rhs), as long as the constraints are."""
    table = rhs.sparkSession.createDataFrame([(n, r, s) for (n, r), s in constrained.place.items()], "cons string, row int, `set` int")
    return rhs.join(F.broadcast(table), ["cons", "row"]).groupBy(*KEYS).agg(F.collect_list(F.struct("set", "sign", "rhs")).alias("cons"))


def bounds_of(cons: list, number: int) -> tuple[np.ndarray, np.ndarray]:
    """(low, high) of sets for each child; infinite where a child has no constraint."""
    low, high = np.full((len(cons), number), -np.inf), np.full((len(cons), number), np.inf)
    for j, rows in enumerate(cons):
        for r in rows if rows is not None else ():
            s, v = r["set"], r["rhs"]
            if r["sign"] in ("ge", "="):
                low[j, s] = max(low[j, s], v)
            if r["sign"] in ("le", "="):
                high[j, s] = min(high[j, s], v)
    return low, high


ANSWER = "geolevel string, geocode string, x array<long>, slack long, primal double, dual double"


def _solver(constrained: Constrained, hess: np.ndarray, parts: list, kept: np.ndarray | None, with_parent: bool) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("geocode")
        low, high = bounds_of(list(frame["cons"]), len(constrained.sets.above))
        goal = np.array(frame["above"].iloc[0]) if with_parent else None
        made = S.solve(hess, linear(np.stack(frame["answers"]), parts), low, high, constrained.sets, goal, kept)
        return pd.DataFrame({"geolevel": frame["geolevel"], "geocode": frame["geocode"], "x": list(made.whole), "slack": made.slack, "primal": made.primal, "dual": made.dual})

    return run


def _solved(children: DataFrame, above: DataFrame, constrained: Constrained, hess: np.ndarray, parts: list, kept: np.ndarray | None, crowd: int) -> DataFrame:
    """Parents of up to ``crowd`` children in one group each, the others split.

    Children of the others, whose parents are few, get these sent and stay where they are: a shuffle by parent would gather them in as many tasks."""
    many = settle(children.groupBy("parent").agg(F.count("*").alias("n")).where(F.col("n") > crowd).select("parent"))
    few = children.join(F.broadcast(many), "parent", "left_anti").join(above, "parent").groupBy("parent").applyInPandas(_solver(constrained, hess, parts, kept, True), ANSWER)
    if many.isEmpty():
        return few
    split = crowded(children.join(F.broadcast(many.join(above, "parent")), "parent"), hess, lambda a: linear(a, parts), bounds_of, constrained.sets, min(BLOCK, crowd))
    return few.unionByName(split.drop("estimate"))


def top_down(measured: DataFrame, rhs: DataFrame, h: Hierarchy, domain: Domain, budget: Budget, queries: dict[str, LinearQuery], constrained: Constrained, kept: str | None = None, crowd: int = CROWD) -> tuple[DataFrame, DataFrame]:
    """((geolevel, geocode, cell, syn), (geolevel, geocode, slack, primal, dual) of each unit's solve).

    A unit's slack is how far, at least, the sums of it and its siblings are from their parent's cells; where it isn't 0, upper levels follow the leaves.
    ``kept`` names a constraint whose answers hold the parent's even then.  Parents of more than ``crowd`` children are solved by ``crowded``, which has the
    same estimate; there the parent's cells give way to the nearest in reach, and nothing is ``kept``."""
    spans, by_level = weights(domain, budget, queries, h)
    held = None if kept is None else np.array(sorted({s for (name, _), s in constrained.place.items() if name == kept}))
    rows = settle(packed(measured, spans).join(listed(rhs, constrained), list(KEYS), "left"))
    top = h.levels[-1]
    done = settle(rows.where(F.col("geolevel") == top).groupBy("geocode").applyInPandas(_solver(constrained, *by_level[top], held, False), ANSWER))
    flags = done.drop("x")
    for level in reversed(h.levels[:-1]):
        above = done.select(F.col("geocode").alias("parent"), F.col("x").alias("above"))
        below = rows.where(F.col("geolevel") == level).withColumn("parent", h.parent(level, F.col("geocode")))
        done = settle(_solved(below, above, constrained, *by_level[level], held, crowd))
        flags = flags.unionByName(done.drop("x"))
    leaves = done.select("geocode", F.posexplode("x").alias("cell", "n")).where("n > 0")
    return h.rollup(leaves, "cell").withColumnRenamed("n", "syn"), flags


def below(measured: DataFrame, rhs: DataFrame, above: DataFrame, level: str, h: Hierarchy, domain: Domain, budget: Budget, queries: dict[str, LinearQuery], constrained: Constrained) -> DataFrame:
    """(geolevel, geocode, x, slack, primal, dual) of one level under given parents ``above(geocode, cell, n)``."""
    spans, by_level = weights(domain, budget, queries, h)
    cells = above.groupBy(F.col("geocode").alias("parent")).agg(F.map_from_entries(F.collect_list(F.struct("cell", "n"))).alias("m"))  # as many as the domain has
    dense = cells.select("parent", F.transform(F.sequence(F.lit(0), F.lit(domain.size - 1)), lambda c: F.coalesce(F.element_at("m", c), F.lit(0)).cast("long")).alias("above"))
    rows = settle(packed(measured.where(F.col("geolevel") == level), spans).join(listed(rhs, constrained), list(KEYS), "left"))
    children = rows.withColumn("parent", h.parent(level, F.col("geocode"))).join(dense, "parent")
    return settle(children.groupBy("parent").applyInPandas(_solver(constrained, *by_level[level], None, True), ANSWER))


def least_slacks(parents: DataFrame, rhs: DataFrame, level: str, h: Hierarchy, constrained: Constrained) -> DataFrame:
    """(geocode, slack) of every parent above ``level``: how far its cells ``parents(geocode, cell, n)`` are, at least, from what the bounds of its
    children allow together.  One row of arrays a child, summed before anything is gathered: a parent of any number of children is one row."""
    number = len(constrained.sets.above)

    def drawn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            low, high = S.tight(*bounds_of(list(frame["cons"]), number), constrained.sets)
            if (low > high).any():
                raise ValueError("a child's bounds contradict each other")
            yield pd.DataFrame({"parent": frame["parent"], "low": list(low), "high": list(high)})

    children = listed(rhs.where(F.col("geolevel") == level), constrained).select(h.parent(level, F.col("geocode")).alias("parent"), "cons")
    each = children.mapInPandas(drawn, "parent string, low array<double>, high array<double>")
    sums = each.groupBy("parent").agg(F.array(*(F.sum(F.col("low")[s]) for s in range(number))).alias("low"), F.array(*(F.sum(F.col("high")[s]) for s in range(number))).alias("high"))
    cells = parents.groupBy("geocode").agg(F.collect_list(F.struct("cell", "n")).alias("cells"))  # as many as the domain has

    def least(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            out = []
            for low, high, rows in zip(frame["low"], frame["high"], frame["cells"], strict=True):
                goal = np.zeros(constrained.sets.member.shape[1], np.int64)
                for r in rows if rows is not None else ():
                    goal[r["cell"]] = r["n"]
                out.append(S.least_slack(goal, np.array(low)[None], np.array(high)[None], constrained.sets))
            yield pd.DataFrame({"geocode": frame["geocode"], "slack": out})

    both = sums.withColumnRenamed("parent", "geocode").join(cells, "geocode", "left")
    return both.mapInPandas(least, "geocode string, slack long")


def marginal_rows(estimates: DataFrame, query: LinearQuery, units: DataFrame, name: str = "minSchema") -> DataFrame:
    """The answers of a first phase's ``estimates`` as equality rows for the second, of every unit and level."""
    rows = query.answer(estimates.withColumnRenamed("syn", "n"), *KEYS)
    every = units.select(*KEYS).distinct().withColumn("row", F.explode(F.sequence(F.lit(0), F.lit(query.n_answers - 1))))
    return every.join(rows, [*KEYS, "row"], "left").select(*KEYS, F.lit(name).alias("cons"), "row", F.lit("=").alias("sign"), F.coalesce("n", F.lit(0)).cast("long").alias("rhs"))


def checked(estimates: DataFrame, rhs: DataFrame, constrained: Constrained) -> DataFrame:
    """(geolevel, cons, checked, failures): how many right sides the estimates break."""
    cells = [(name, row, int(c)) for (name, row), s in constrained.place.items() for c in np.flatnonzero(constrained.sets.member[s])]
    table = rhs.sparkSession.createDataFrame(cells, "cons string, row int, cell int")
    answers = estimates.join(F.broadcast(table), "cell").groupBy(*KEYS, "cons", "row").agg(F.sum("syn").alias("n"))
    ok = C.check(answers, rhs, *KEYS, "cons")
    return ok.groupBy("geolevel", "cons").agg(F.count("*").alias("checked"), F.sum((~F.col("ok")).cast("long")).alias("failures"))
