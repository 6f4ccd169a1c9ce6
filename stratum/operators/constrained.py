"""Top-down estimates that keep the invariants: exact totals, bounds on every union of quarters categories, structural zeros.

The bounds of a unit follow from its leaves: persons of the leaf in a set S of categories are at most its total less one for each of
its units outside S, and none if it has no unit in S.  Their sums over leaves bound every unit above, so a parent's value
that keeps its own bounds always has children that keep theirs (the sets' bounds are submodular, and so are their sums).

Per parent one grouped function estimates and rounds all children together, as they share the parent's cells: ``solve.estimate`` of every
measured query, whole numbers by exchanges along shortest paths between categories, and cells
within a category likewise.  Constraints that are named level by level, with totals free elsewhere, are in ``topdown``.  A group has children x cells numbers.  Of leaves the bounds of
single categories imply those of all sets, which are nested then: a parent of more than CROWD such children goes to ``crowded``, which splits them over tasks, has the same estimate and
rounds it by flows.  Where a parent's value can't be reached (bounds that aren't its own, given from outside), the least total slack on
the parent's categories is taken instead, flagged, and upper levels are added up again from the leaves."""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.functions.noise import Budget
from stratum.operators import solve as S
from stratum.operators.crowded import BLOCK, crowded
from stratum.operators.estimate import settle
from stratum.operators.hierarchy import Hierarchy
from stratum.operators.histogram import Domain
from stratum.operators.linear import LinearQuery
from stratum.operators.topdown import linear, packed, weights

CROWD = 200  # children of one parent that a group may hold if they can be split


def set_bounds(hist: DataFrame, units: DataFrame, levels: int, h: Hierarchy) -> DataFrame:
    """(geolevel, geocode, tot, most): for every unit the most persons in each set of categories; ``most[S]`` with S a bit mask.

    ``hist(geocode, n)`` and ``units(geocode, hhgq, n)`` are of the leaves; a category from ``levels`` on is vacant."""
    tot = hist.groupBy("geocode").agg(F.sum("n").cast("long").alias("tot"))
    by = units.where(F.col("hhgq") < levels).groupBy("geocode").agg(*(F.coalesce(F.sum(F.when(F.col("hhgq") == r, F.col("n"))), F.lit(0)).cast("long").alias(f"u{r}") for r in range(levels)))
    both = by.join(tot, "geocode", "left").withColumn("tot", F.coalesce("tot", F.lit(0).cast("long")))
    every = sum((F.col(f"u{r}") for r in range(levels)), F.lit(0))

    def most(s: int):
        inside = sum((F.col(f"u{r}") for r in range(levels) if s >> r & 1), F.lit(0))
        return F.when(inside > 0, F.greatest(F.col("tot") - (every - inside), F.lit(0))).otherwise(0).cast("long")

    sets = both.select("geocode", "tot", *(most(s).alias(f"s{s}") for s in range(1 << levels)))
    sums = h.spread(sets).groupBy("geolevel", "geocode").agg(F.sum("tot").cast("long").alias("tot"), *(F.sum(f"s{s}").cast("long").alias(f"s{s}") for s in range(1 << levels)))
    return sums.select("geolevel", "geocode", "tot", F.array(*(F.col(f"s{s}") for s in range(1 << levels))).alias("most"))


def _exchanges(n: int) -> dict[tuple[int, int], np.ndarray]:
    """For each (from, to) the sets that a move between the two fills up."""
    sets = np.arange(1 << n)
    return {(r, s): sets[(sets >> s & 1 == 1) & (sets >> r & 1 == 0)] for r in range(n) for s in range(n) if r != s}


def _sums(y: np.ndarray) -> np.ndarray:
    """(children, sets): persons in each set of categories."""
    members = np.arange(1 << y.shape[1])[None] >> np.arange(y.shape[1])[:, None] & 1
    return y @ members


def whole_categories(target: np.ndarray, most: np.ndarray, columns: np.ndarray | None = None) -> tuple[np.ndarray, int]:
    """(whole numbers near ``target`` (children, categories) within the children's set bounds, slack).

    Children keep their totals ``most[:, -1]`` and bounds exactly; the sums over children reach ``columns``, or come as near as the
    bounds allow: ``slack`` is what is missing.  Without ``columns`` the sums are free."""
    n, m = target.shape
    moves = _exchanges(m)
    y, done = np.zeros((n, m), np.int64), 0
    for r in range(m):  # a vertex of each child's bounds
        now = done | 1 << r
        y[:, r] = most[:, now] - most[:, done]
        done = now

    def room(r: int, s: int, sums: np.ndarray) -> np.ndarray:
        return np.minimum(y[:, r], (most[:, moves[r, s]] - sums[:, moves[r, s]]).min(1))

    for _ in range(4 * m):  # towards the target, as far at once as bounds allow
        moved = False
        for r, s in moves:
            gain = np.floor(np.minimum(y[:, r] - target[:, r], target[:, s] - y[:, s]) + 0.5).astype(np.int64)
            step = np.minimum(np.maximum(gain, 0), room(r, s, _sums(y)))
            if step.any():
                y[:, r] -= step
                y[:, s] += step
                moved = True
        if not moved:
            break
    columns = y.sum(0) if columns is None else columns
    while (gap := columns - y.sum(0)).any():
        sums = _sums(y)
        free = {k: np.flatnonzero(room(*k, sums) > 0) for k in moves}
        # shortest path from a category with too many to one with too few
        came, queue = {r: None for r in range(m) if gap[r] < 0}, deque(r for r in range(m) if gap[r] < 0)
        end = None
        while queue and end is None:
            r = queue.popleft()
            for s in range(m):
                if s != r and s not in came and len(free[r, s]):
                    came[s] = r
                    queue.append(s)
                    if gap[s] > 0:
                        end = s
                        break
        if end is None:
            break
        path = [end]
        while came[path[-1]] is not None:
            path.append(came[path[-1]])
        path.reverse()
        direct = len(path) == 2
        many = int(min(-gap[path[0]], gap[end])) if direct else 1
        for r, s in zip(path[:-1], path[1:], strict=True):  # the children that lose least by it, one unit each
            who = np.flatnonzero(room(r, s, _sums(y)) > 0)
            loss = (target[who, r] - y[who, r]) + (y[who, s] - target[who, s])
            who = who[np.argsort(loss, kind="stable")[:many]]
            y[who, r] -= 1
            y[who, s] += 1
    return y, int(np.abs(columns - y.sum(0)).sum()) // 2


def whole_cells(target: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Whole non-negative numbers near ``target`` with exact sums ``rows`` of children and ``columns`` of cells (both have one total)."""
    n, m = target.shape
    share = np.maximum(target, 0)
    total = share.sum(1, keepdims=True)
    share = np.where(total > 0, share, 1.0) / np.where(total > 0, total, m) * rows[:, None]
    x = np.floor(share + 1e-9).astype(np.int64)
    frac, left = share - x, rows - x.sum(1)
    place = np.argsort(np.argsort(-frac, 1, kind="stable"), 1)
    x += place < left[:, None]
    while (gap := columns - x.sum(0)).any():
        r, s = int(np.argmin(gap)), int(np.argmax(gap))
        many = int(min(-gap[r], gap[s]))
        who = np.flatnonzero(x[:, r] > 0)
        loss = (share[who, r] - x[who, r]) + (x[who, s] - share[who, s])
        who = who[np.argsort(loss, kind="stable")[:many]]
        x[who, r] -= 1
        x[who, s] += 1
    return x


def least_squares(noisy: np.ndarray, parent: np.ndarray, tot: np.ndarray, category: np.ndarray, low: np.ndarray, high: np.ndarray, rounds: int = S.ROUNDS) -> np.ndarray:
    """Nearest (children, cells) numbers that are not negative, add up to the parent's cells and the children's totals, with categories in
    [low, high]."""
    member = np.vstack([np.ones(len(category), bool), np.arange(low.shape[1])[:, None] == category])
    total = np.asarray(tot, float)[:, None]
    return S.estimate(np.eye(len(category)), noisy.astype(float), member, np.hstack([total, low]), np.hstack([total, high]), parent, rounds=rounds).x


def solve_children(noisy: np.ndarray, parent: np.ndarray, most: np.ndarray, category: np.ndarray, hess: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, int]:
    """(least squares, whole numbers, slack) of the children of one parent; ``most[:, -1]`` are their exact totals.

    Least squares is over ``noisy`` cells, or with ``hess`` of x'Hx/2 - h'x with ``noisy`` as h, under the bounds of all sets of categories.  Short cuts: a
    parent without persons gives zeros; a single child is its parent."""
    m = int(category.max()) + 1
    tot = most[:, -1]
    if not parent.sum() and not tot.sum():
        zero = np.zeros(noisy.shape)
        return zero, zero.astype(np.int64), 0
    every = most.shape[1] - 1
    high = most[:, [1 << r for r in range(m)]]
    low = tot[:, None] - most[:, [every ^ 1 << r for r in range(m)]]
    have = np.bincount(category, parent, m)
    if len(noisy) == 1 and parent.sum() == tot[0]:
        if (have >= low[0]).all() and (have <= high[0]).all():
            return parent[None].astype(float), parent[None].astype(np.int64), 0
    inside = np.arange(1 << m)[:, None] >> np.arange(m) & 1
    reach = (inside @ have <= most.sum(0)).all() and have.sum() == tot.sum()  # the sets' bounds are submodular, and so are their sums
    top = most.astype(float)
    bottom = np.where(np.arange(1 << m) == every, top, -np.inf)
    live = np.flatnonzero(parent > 0) if reach else np.arange(len(category))
    member = (inside[1:] @ (np.arange(m)[:, None] == category)).astype(bool)
    x = np.zeros(noisy.shape)
    matrix = np.eye(len(category)) if hess is None else hess
    x[:, live] = S.estimate(matrix[np.ix_(live, live)], noisy[:, live].astype(float), member[:, live], bottom[:, 1:], top[:, 1:], parent[live] if reach else None).x
    columns = have.astype(np.int64)
    y, slack = whole_categories(x @ np.eye(m)[category], most, columns)
    out = np.zeros(noisy.shape, np.int64)
    for r in range(m):
        cells = np.flatnonzero(category == r)
        goal = parent[cells].astype(np.int64)
        if goal.sum() != y[:, r].sum():  # slack: the parent's cells in proportion to what the children can hold
            goal = _apportion(goal, int(y[:, r].sum()))
        out[:, cells] = whole_cells(x[:, cells], y[:, r], goal)
    return x, out, slack


def _apportion(goal: np.ndarray, total: int) -> np.ndarray:
    """``total`` in proportion to ``goal`` by largest remainders."""
    share = goal / goal.sum() * total if goal.sum() else np.full(len(goal), total / len(goal))
    out = np.floor(share + 1e-9).astype(np.int64)
    out[np.argsort(out - share, kind="stable")[: total - out.sum()]] += 1
    return out


def solve_root(noisy: np.ndarray, most: np.ndarray, category: np.ndarray, zeros: list[int]) -> np.ndarray:
    """Whole numbers for the topmost unit; cells in ``zeros`` are 0 here and so in every unit below."""
    m = int(category.max()) + 1
    live = np.setdiff1d(np.arange(len(noisy)), zeros)
    target = np.zeros(len(noisy))
    target[live] = np.maximum(noisy[live], 0)
    want = np.bincount(category, target, m)
    y = whole_categories(want[None] * most[-1] / max(want.sum(), 1e-9), most[None])[0][0]
    out = np.zeros(len(noisy), np.int64)
    for r in range(m):
        cells = live[category[live] == r]
        if y[r] and not len(cells):
            raise ValueError(f"category {r} has persons, but all its cells are structural zeros")
        if len(cells):
            out[cells] = _apportion(target[cells], int(y[r]))
    return out


def constrained_top_down(measured: DataFrame, bounds: DataFrame, h: Hierarchy, domain: Domain, budget: Budget, queries: dict[str, LinearQuery], axis: str = "hhgq", zeros: list[int] | None = None, crowd: int = CROWD, block: int = BLOCK) -> DataFrame:
    """(geolevel, geocode, cell, syn, slack): estimates from all measured queries, made whole, consistent and true to totals and bounds.

    ``measured(geolevel, geocode, query, row, noisy)`` has the answers of every unit to the queries of ``budget``; ``bounds`` is of ``set_bounds``."""
    size, k = domain.size, domain.names.index(axis)
    category = np.array([c // domain.strides[k] % domain.dims[k] for c in range(size)])
    zeros = zeros or []
    nested = S.Sets.of(np.vstack([np.ones(size, bool), np.arange(domain.dims[k])[:, None] == category]))
    spans, by_level = weights(domain, budget, queries, h)
    rows = settle(packed(measured, spans).join(bounds, ["geolevel", "geocode"]))
    top = h.levels[-1]
    root_hess, root_parts = by_level[top]

    def root(frame: pd.DataFrame) -> pd.DataFrame:
        cells = np.linalg.solve(root_hess, linear(np.stack(frame["answers"]), root_parts).T).T
        return pd.DataFrame({"geolevel": top, "geocode": frame["geocode"], "x": [solve_root(n, np.array(b), category, zeros) for n, b in zip(cells, frame["most"], strict=True)], "slack": 0})

    def children(hess: np.ndarray, parts: list) -> Callable[[pd.DataFrame], pd.DataFrame]:
        def run(frame: pd.DataFrame) -> pd.DataFrame:
            frame = frame.sort_values("geocode")
            _, whole, slack = solve_children(linear(np.stack(frame["answers"]), parts), np.array(frame["above"].iloc[0]), np.stack(frame["most"]), category, hess)
            return pd.DataFrame({"geolevel": frame["geolevel"], "geocode": frame["geocode"], "x": list(whole), "slack": slack})

        return run

    schema = "geolevel string, geocode string, x array<long>, slack long"
    done = settle(rows.where(F.col("geolevel") == top).groupBy("geocode").applyInPandas(root, schema))
    flags = done.select("geolevel", "geocode", "slack")
    for level in reversed(h.levels[:-1]):
        above = done.select(F.col("geocode").alias("parent"), F.col("x").alias("above"))
        below = rows.where(F.col("geolevel") == level).withColumn("parent", h.parent(level, F.col("geocode")))
        marked = below.select("parent", "most").mapInPandas(_marked, "parent string, single boolean")
        many = settle(marked.groupBy("parent").agg(F.count("*").alias("n"), F.min("single").alias("single")).where((F.col("n") > crowd) & F.col("single")).select("parent"))
        few = below.join(F.broadcast(many), "parent", "left_anti").join(above, "parent").groupBy("parent").applyInPandas(children(*by_level[level]), schema)
        if not many.isEmpty():
            hess, parts = by_level[level]
            wide = below.withColumnRenamed("most", "cons").join(F.broadcast(many.join(above, "parent")), "parent")
            split = crowded(wide, hess, lambda a, parts=parts: linear(a, parts), lambda most, _: single_bounds(np.stack(most))[:2], nested, block)
            few = few.unionByName(split.select("geolevel", "geocode", "x", "slack"))
        done = settle(few)
        flags = flags.unionByName(done.select("geolevel", "geocode", "slack"))
    leaves = done.select("geocode", F.posexplode("x").alias("cell", "n"))
    return h.rollup(leaves, "cell").withColumnRenamed("n", "syn").join(flags, ["geolevel", "geocode"])


def single_bounds(most: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(low, high, whether they imply the bounds of all sets) of each child; ``low`` and ``high`` are of all cells and of each category."""
    m = most.shape[1].bit_length() - 1
    tot, every = most[:, -1:], most.shape[1] - 1
    high = most[:, [1 << r for r in range(m)]]
    low = tot - most[:, [every ^ 1 << r for r in range(m)]]
    inside = np.arange(1 << m)[:, None] >> np.arange(m) & 1
    implied = np.minimum(high @ inside.T, tot - low @ (1 - inside).T)
    return np.hstack([tot, low]).astype(float), np.hstack([tot, high]).astype(float), (implied <= most).all(1)


def _marked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in batches:
        if len(frame):
            yield pd.DataFrame({"parent": frame["parent"], "single": single_bounds(np.stack(frame["most"]))[2]})


def slack_by_level(estimates: DataFrame) -> DataFrame:
    """(geolevel, slack): the largest slack that a parent of the level's units needed."""
    return estimates.groupBy("geolevel").agg(F.max("slack").cast("long").alias("slack"))


def kept(estimates: DataFrame, bounds: DataFrame, domain: Domain, axis: str = "hhgq") -> DataFrame:
    """(geolevel, cons, checked, failures): exact totals and the bounds of all sets of categories, lower ones as the rest of upper ones."""
    k = domain.names.index(axis)
    n = domain.dims[k]
    per = estimates.groupBy("geolevel", "geocode").agg(*(F.coalesce(F.sum(F.when(domain.axis(k) == r, F.col("syn"))), F.lit(0)).alias(f"y{r}") for r in range(n)))
    both = bounds.join(per, ["geolevel", "geocode"], "left").na.fill(0)
    total = sum((F.col(f"y{r}") for r in range(n)), F.lit(0))
    fails = []
    for s in range(1, 1 << n):
        inside = sum((F.col(f"y{r}") for r in range(n) if s >> r & 1), F.lit(0))
        cons = "total" if s == (1 << n) - 1 else "ub" if s.bit_count() == 1 else "lb" if s.bit_count() == n - 1 else "union"
        bad = (total != F.col("tot")) if cons == "total" else inside > F.element_at("most", s + 1)
        fails.append(F.struct(F.lit(cons).alias("cons"), bad.cast("int").alias("bad")))
    each = both.select("geolevel", F.explode(F.array(*fails)).alias("f"))
    return each.groupBy("geolevel", F.col("f.cons").alias("cons")).agg(F.count("*").alias("checked"), F.sum("f.bad").cast("long").alias("failures"))
