"""Quadratic estimates, whole numbers by flows, constraints by level, crowded parents: against conditions of optimality and brute force."""

from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratum.functions.noise import Budget
from stratum.operators import solve as S
from stratum.operators import topdown as T
from stratum.operators.crowded import crowded
from stratum.operators.estimate import measure
from stratum.operators.hierarchy import Hierarchy
from stratum.operators.histogram import Domain
from stratum.operators.linear import LinearQuery, marginal

N = 60
CATEGORY = np.arange(N) // 12
MEMBER = np.vstack([np.ones(N, bool), *[CATEGORY == r for r in range(5)]])
SETS = S.Sets.of(MEMBER)
BY_CATEGORY = MEMBER[1:].astype(float)
BY_REST = np.array([np.arange(N) % 12 == r for r in range(12)], float)


def problem(children, seed=1):
    """(H, h, low, high, true): noisy answers of three queries; every other child has its total held, all have bounds on categories."""
    rng = np.random.default_rng(seed)
    true = rng.poisson(rng.exponential(2, size=(children, N)) * (rng.random((children, N)) < 0.4))
    hess = np.eye(N) / 50 + BY_CATEGORY.T @ BY_CATEGORY / 20 + BY_REST.T @ BY_REST / 8
    noise = lambda k, b: rng.laplace(0, b, size=(children, k))
    lin = (true + noise(N, 5)) / 50 + (true @ BY_CATEGORY.T + noise(5, 3)) @ BY_CATEGORY / 20 + (true @ BY_REST.T + noise(12, 2)) @ BY_REST / 8
    low, high = np.full((children, 6), -np.inf), np.full((children, 6), np.inf)
    low[:, 1:], high[:, 1:] = np.floor((true @ BY_CATEGORY.T) * 0.8), np.ceil((true @ BY_CATEGORY.T) * 1.2)
    low[::2, 0] = high[::2, 0] = true[::2].sum(1)
    return hess, lin, low, high, true


def improvement(hess, lin, low, high, goal, x, tries, seed=0):
    """The largest gain of the objective along random exchanges between two children that keep every constraint."""
    rng = np.random.default_rng(seed)
    gradient = x @ hess - lin
    best = 0.0
    for _ in range(tries):
        a, b = rng.choice(len(x), 2, replace=False)
        i, j = rng.choice(N, 2, replace=False)
        step = np.zeros_like(x)  # child a gives i and takes j, child b the other way round: the parent's cells stay
        step[a, i], step[a, j], step[b, i], step[b, j] = -1, 1, 1, -1
        slope = (gradient * step).sum()
        if slope >= 0:
            continue
        room = min(x[a, i], x[b, j])
        at, move = x @ MEMBER.T, step @ MEMBER.T
        with np.errstate(divide="ignore", invalid="ignore"):
            room = min(room, np.nanmin(np.where(move > 0, (high - at) / move, np.where(move < 0, (low - at) / move, np.inf))))
        curve = np.einsum("ij,jk,ik->", step, hess, step)
        by = min(max(room, 0), -slope / curve)
        best = max(best, -(slope * by + curve * by * by / 2))
    return best


@pytest.mark.parametrize("children", [2, 5, 50, 500])
def test_estimate_converges(children):
    hess, lin, low, high, true = problem(children)
    made = S.estimate(hess, lin, MEMBER, low, high, true.sum(0))
    assert made.primal < 1e-6 and made.dual < 1e-6 and made.rounds < 5000
    assert np.abs(made.x.sum(0) - true.sum(0)).max() < 1e-5 and made.x.min() >= 0
    at = made.x @ MEMBER.T
    assert (at >= low - 1e-6).all() and (at <= high + 1e-6).all()
    assert improvement(hess, lin, low, high, true.sum(0), made.x, 3000) < 1e-4


def plain(hess, lin, rows, rhs, equal, sweeps=60_000):
    """Least of x'Hx/2 - h'x under rows @ x >= rhs (= where ``equal``), by ascent on one multiplier after the other."""
    inverse = np.linalg.inv(hess)
    q = rows @ inverse @ rows.T
    off = rhs - rows @ inverse @ lin
    u = np.zeros(len(rhs))
    for _ in range(sweeps):
        before = u.copy()
        for k in range(len(u)):
            new = u[k] + (off[k] - q[k] @ u) / q[k, k]
            u[k] = new if equal[k] else max(new, 0)
        if np.abs(u - before).max() < 1e-12:
            break
    return inverse @ (lin + rows.T @ u)


@pytest.mark.parametrize("seed", range(6))
def test_estimate_equals_plain_solver(seed):
    """Three children of four cells, with different sets of constraints."""
    rng = np.random.default_rng(seed)
    n, children = 4, 3
    member = np.array([[1, 1, 1, 1], [1, 1, 0, 0], [0, 0, 1, 1]], bool)
    root = rng.normal(size=(n, n))
    hess, lin, true = root @ root.T + np.eye(n), rng.normal(size=(children, n)) * 10, rng.integers(0, 6, (children, n))
    low, high = np.full((children, 3), -np.inf), np.full((children, 3), np.inf)
    low[0, 0] = high[0, 0] = true[0].sum()
    low[1, 1], high[2, 2] = true[1, :2].sum(), true[2, 2:].sum()
    got = S.estimate(hess, lin, member, low, high, true.sum(0)).x
    rows, rhs, equal = [], [], []
    cell = lambda j, what: np.concatenate([what if k == j else np.zeros(n) for k in range(children)])
    for j in range(children):
        for i in range(n):
            rows, rhs, equal = [*rows, cell(j, np.eye(n)[i])], [*rhs, 0], [*equal, False]
        for s in range(3):
            if low[j, s] == high[j, s]:
                rows, rhs, equal = [*rows, cell(j, member[s].astype(float))], [*rhs, low[j, s]], [*equal, True]
            elif np.isfinite(low[j, s]):
                rows, rhs, equal = [*rows, cell(j, member[s].astype(float))], [*rhs, low[j, s]], [*equal, False]
            elif np.isfinite(high[j, s]):
                rows, rhs, equal = [*rows, -cell(j, member[s].astype(float))], [*rhs, -high[j, s]], [*equal, False]
    for i in range(n):
        rows, rhs, equal = [*rows, np.tile(np.eye(n)[i], children)], [*rhs, true[:, i].sum()], [*equal, True]
    want = plain(np.kron(np.eye(children), hess), lin.ravel(), np.array(rows, float), np.array(rhs, float), equal).reshape(children, n)
    assert np.abs(got - want).max() < 1e-5


def brute_whole(t, low, high, m, goal, most=4):
    """Least sum of |X - t| over whole numbers below ``most`` under the constraints."""
    children, n = t.shape
    best = {(0,) * n: 0.0}
    for j in range(children):
        allowed = [np.array(c) for c in product(range(most), repeat=n) if all(low[j, s] <= np.array(c) @ m[s] <= high[j, s] for s in range(len(m)))]
        new = {}
        for k, v in best.items():
            for c in allowed:
                key = tuple(np.array(k) + c)
                if goal is None or (np.array(key) <= goal).all():
                    new[key] = min(new.get(key, np.inf), v + np.abs(c - t[j]).sum())
        best = new
    return min(best.values()) if goal is None else best[tuple(int(x) for x in goal)]


@pytest.mark.parametrize("seed", range(40))
def test_whole_numbers_cost_the_least(seed):
    rng = np.random.default_rng(seed)
    m = np.array([[1, 1, 1, 1], [1, 1, 0, 0], [0, 0, 1, 1], [1, 0, 0, 0]], bool)
    children = int(rng.integers(1, 4))
    t = rng.random((children, 4)) * 2.2 if children < 3 else rng.random((children, 4)) * 1.6
    true = np.floor(t + rng.random((children, 4)))
    low, high = np.full((children, 4), -np.inf), np.full((children, 4), np.inf)
    for j, s in product(range(children), range(4)):
        if rng.random() < 0.5:
            low[j, s] = true[j] @ m[s] - rng.integers(0, 2)
        if rng.random() < 0.5:
            high[j, s] = true[j] @ m[s] + rng.integers(0, 2)
    goal = true.sum(0) if rng.random() < 0.7 else None
    got = S.whole(t, low, high, S.Sets.of(m), goal)
    at = got @ m.T
    assert (at >= low).all() and (at <= high).all() and (goal is None or (got.sum(0) == goal).all())
    assert np.abs(got - t).sum() == pytest.approx(brute_whole(t, low, high, m, goal), abs=1e-9)


def test_whole_numbers_of_many_children():
    hess, lin, low, high, true = problem(300)
    made = S.estimate(hess, lin, MEMBER, low, high, true.sum(0))
    got = S.whole(made.x, low, high, SETS, true.sum(0))
    at = got @ MEMBER.T
    assert (got.sum(0) == true.sum(0)).all() and (at >= low).all() and (at <= high).all() and np.abs(got - made.x).max() <= 1.5


def test_least_slack_and_fallback():
    m = np.array([[1, 1, 1, 1], [1, 1, 0, 0], [0, 0, 1, 1], [0, 0, 0, 1]], bool)
    sets = S.Sets.of(m)
    for seed in range(25):
        rng = np.random.default_rng(seed)
        children = int(rng.integers(1, 4))
        goal = rng.integers(0, 5, 4)
        low, high = np.full((children, 4), -np.inf), np.full((children, 4), np.inf)
        for j, s in product(range(children), range(4)):
            a, b = sorted(rng.integers(0, 4, 2))
            if rng.random() < 0.4:
                low[j, s] = a if s in (1, 2) else -np.inf
            if rng.random() < 0.4:
                high[j, s] = b + (3 if s == 0 else 0)
        reach = {(0,) * 4}
        for j in range(children):
            one = [c for c in product(range(6), repeat=4) if all(low[j, s] <= np.array(c) @ m[s] <= high[j, s] for s in range(4))]
            reach = {tuple(np.add(k, c)) for k in reach for c in one}
        want = min((int(np.abs(np.array(k) - goal).sum()) for k in reach), default=None)
        if want is None:
            with pytest.raises(ValueError, match="contradict"):
                S.least_slack(goal, low, high, sets)
            continue
        assert S.least_slack(goal, low, high, sets) == want
        made = S.solve(np.eye(4), rng.normal(size=(children, 4)) * 3, low, high, sets, goal)
        at = made.whole @ m.T
        assert made.slack == want and (at >= low).all() and (at <= high).all()
        assert np.abs(made.whole.sum(0) - goal).sum() <= want + 1 and np.abs(made.x.sum(0) - goal).sum() <= want + 1 + 1e-4


def test_fallback_keeps_a_marginal():
    """Cells that no child may fill, in a category whose sum is kept."""
    m = np.array([[1, 1, 1, 1], [1, 1, 0, 0], [0, 0, 1, 1], [1, 0, 0, 0]], bool)
    sets = S.Sets.of(m)
    low, high = np.full((3, 4), -np.inf), np.full((3, 4), np.inf)
    high[:, 3] = 0
    goal = np.array([4, 6, 2, 1])
    made = S.solve(np.eye(4), np.array([[1.0, 5, 2, 0], [2, 1, 0, 1], [0, 0, 1, 1]]), low, high, sets, goal, np.array([1, 2]))
    sums = made.whole.sum(0)
    assert made.slack == 8 and sums[0] == 0 and sums[:2].sum() == 10 and sums[2:].sum() == 3 and np.abs(sums - goal).sum() <= 9
    high[:, 1] = 1
    with pytest.raises(ValueError, match="kept"):
        S.solve(np.eye(4), np.zeros((3, 4)), low, high, sets, goal, np.array([1, 2]))


def test_short_cuts():
    free = np.full((2, 6), -np.inf), np.full((2, 6), np.inf)
    assert not S.solve(np.eye(N), np.ones((2, N)), *free, SETS, np.zeros(N, int)).whole.any()
    goal = np.arange(N)
    assert (S.solve(np.eye(N), np.ones((1, N)), free[0][:1], free[1][:1], SETS, goal).whole[0] == goal).all()


def test_more_answers_lower_the_error():
    """Marginals of the estimate come nearer to the truth as their noisy answers enter, which they don't by the detailed answers alone."""
    errors = []
    for with_queries in (False, True):
        total = 0.0
        for seed in range(8):
            hess, lin, low, high, true = problem(20, seed)
            if not with_queries:
                rng = np.random.default_rng(seed)
                hess, lin = np.eye(N) / 50, (true + rng.laplace(0, 5, true.shape)) / 50
            x = S.estimate(hess, lin, MEMBER, np.full_like(low, -np.inf), np.full_like(high, np.inf), true.sum(0)).x
            total += np.abs((x - true) @ BY_REST.T).sum()
        errors.append(total)
    assert errors[1] < 0.75 * errors[0]


def test_sets_must_nest():
    with pytest.raises(ValueError, match="overlap"):
        S.Sets.of(np.array([[1, 1, 1], [1, 1, 0], [0, 1, 1]]))
    with pytest.raises(ValueError, match="all"):
        S.Sets.of(np.array([[1, 1, 0]]))


DOMAIN = Domain(("hhgq", "va"), (3, 2))
GEO = Hierarchy(("leaf", "mid", "root"), (4, 2, 1))
SPLIT = Budget(2.0, {"root": 0.3, "mid": 0.3, "leaf": 0.4}, 0.5, {"hhgq": 0.5})
QUERIES = {"hhgq": marginal(DOMAIN, "hhgq")}
ZEROS = {"no_minors": LinearQuery(DOMAIN, "no_minors", subset={0: [2], 1: [0]}, over=(0, 1))}


def tables(spark, leaves=24):
    rng = np.random.default_rng(3)
    code = [f"{i % 3:02d}{i:02d}" for i in range(leaves)]
    units = [(g, r, int(n)) for g in code for r, n in enumerate(rng.integers(0, 3, 3)) if n]
    have = {}
    for g, r, n in units:
        have[g, r] = n
    people = [(g, r * 2 + v, int(rng.integers(1, 6)) + have[g, r]) for g in code for r in range(3) for v in range(2) if (g, r) in have and not (r == 2 and v == 0)]
    hist = GEO.rollup(spark.createDataFrame(people, "geocode string, cell int, n long"), "cell")
    return hist, GEO.rollup(spark.createDataFrame(units, "geocode string, hhgq int, n long"), "hhgq"), people, have


def test_levels_sum_and_overwrite(spark):
    hist, units, people, have = tables(spark)
    rules = {"leaf": T.Rule(("gqhh_vect", "gqhh_tot"), ("hhgq_total_lb", "hhgq_total_ub", "no_minors")), "mid": T.Rule(("tot",), ("total", "hhgq_total_ub"))}
    got = {(r["geolevel"], r["geocode"], r["cons"], r["row"]): (r["sign"], r["rhs"]) for r in T.level_constraints(hist, units, GEO, 3, rules, ("no_minors",)).collect()}
    assert not [k for k in got if k[2] == "total" and k[0] == "leaf"]  # a leaf's total is nowhere
    tot = {p: sum(n for g, _, n in people if g[:2] == p) for p in ("00", "01", "02")}
    have2 = {(p, r): sum(n for (g, q), n in have.items() if g[:2] == p and q == r) for p in tot for r in range(3)}
    for g in {g for g, _ in have}:
        for r in range(3):
            assert got["leaf", g, "hhgq_total_lb", r] == ("ge", have.get((g, r), 0)) and got["leaf", g, "hhgq_total_ub", r] == ("le", have.get((g, r), 0) * (99 if r == 0 else 99999))
    for p in tot:
        assert got["mid", p, "total", 0] == ("=", tot[p]) and got["mid", p, "no_minors", 0] == ("=", 0)
        for r in range(3):
            others = sum(have2[p, q] for q in range(3)) - have2[p, r]
            assert got["mid", p, "hhgq_total_lb", r] == ("ge", have2[p, r])  # summed
            assert got["mid", p, "hhgq_total_ub", r] == ("le", tot[p] - others if have2[p, r] else 0)  # made anew
            assert got["root", "0", "hhgq_total_ub", r][1] == sum(got["mid", q, "hhgq_total_ub", r][1] for q in tot)
    assert got["root", "0", "total", 0] == ("=", sum(tot.values()))
    with pytest.raises(ValueError, match="needs invariants"):
        T.level_constraints(hist, units, GEO, 3, {"leaf": T.Rule((), ("total",))})
    assert T.level_constraints(hist, units, GEO, 3, {}).count() == 0


def run(spark, crowd=T.CROWD, drop=None):
    hist, units, *_ = tables(spark)
    rules = {"leaf": T.Rule(("gqhh_vect", "gqhh_tot"), ("hhgq_total_lb", "hhgq_total_ub", "no_minors")), "mid": T.Rule(("tot",), ("total", "hhgq_total_lb", "hhgq_total_ub"))}
    sets = T.Constrained.of(DOMAIN, T.constraint_queries(DOMAIN, zeros=ZEROS))
    rhs = T.level_constraints(hist, units, GEO, 3, rules, tuple(ZEROS))
    rhs = rhs.where(drop) if drop is not None else rhs
    noisy = measure(hist, units, DOMAIN, SPLIT, QUERIES)
    estimates, flags = T.top_down(noisy, rhs, GEO, DOMAIN, SPLIT, QUERIES, sets, crowd=crowd)
    return estimates, flags, rhs, sets


def test_unequal_constraints_and_zeros(spark):
    """A third of the leaves without any constraint, a third without upper bounds."""
    drop = (F.col("geolevel") != "leaf") | (F.substring("geocode", 1, 2) != "00") & ((F.substring("geocode", 1, 2) != "01") | ~F.col("cons").isin("hhgq_total_ub", "no_minors"))
    estimates, flags, rhs, sets = run(spark, drop=drop)
    assert all(r["failures"] == 0 for r in T.checked(estimates, rhs, sets).collect())
    assert flags.where("slack > 0 OR primal > 1e-6 OR dual > 1e-6").count() == 0
    cells = {(r["geocode"], r["cell"]): r["syn"] for r in estimates.where("geolevel = 'leaf'").collect()}
    assert all(v == 0 for (g, c), v in cells.items() if c == 4)  # the parents' zero cells are the children's, constrained or not
    sums = {r["geocode"]: r["n"] for r in estimates.where("geolevel = 'mid'").groupBy("geocode").agg(F.sum("syn").alias("n")).collect()}
    assert sums == {r["geocode"]: r["rhs"] for r in rhs.where("geolevel = 'mid' AND cons = 'total'").collect()}


def test_crowded_parents_equal_the_single_solve(spark):
    children, block = 60, 7
    hess, lin, low, high, true = problem(children)
    single = S.solve(hess, lin, low, high, SETS, true.sum(0))
    kind = "parent string, geolevel string, geocode string, above array<long>, answers array<double>, cons array<struct<`set`:int,sign:string,rhs:long>>"
    rows = []
    for j in range(children):
        cons = [(s, sign, int(v)) for s in range(6) for sign, v in (("ge", low[j, s]), ("le", high[j, s])) if np.isfinite(v)]
        rows.append(("p", "leaf", f"{j:03d}", [int(v) for v in true.sum(0)], [float(v) for v in lin[j]], cons))
    frame = spark.createDataFrame(rows, kind).repartition(3)
    got = {r["geocode"]: r for r in crowded(frame, hess, lambda a: a, T.bounds_of, SETS, block).collect()}
    y = np.array([got[f"{j:03d}"]["x"] for j in range(children)])
    at = y @ MEMBER.T
    assert (y.sum(0) == true.sum(0)).all() and (at >= low).all() and (at <= high).all() and all(r["primal"] < 1e-5 for r in got.values())
    assert np.abs(np.array([got[f"{j:03d}"]["estimate"] for j in range(children)]) - single.x).max() < 1e-4
    assert np.abs(y - single.x).max() < 2.5 and np.abs(y - single.x).sum() <= 1.5 * np.abs(single.whole - single.x).sum()


def test_crowded_level_in_a_run(spark):
    estimates, flags, rhs, sets = run(spark, crowd=5)
    assert all(r["failures"] == 0 for r in T.checked(estimates, rhs, sets).collect())
    assert flags.where("slack > 0").count() == 0 and flags.count() == 27  # a leaf without units is none


def test_whole_numbers_carry_many_steps_at_once():
    """Millions of persons out of reach: as many searches as for few, and the least slack."""
    goal = np.full((1, N), 500_000)
    low, high = np.zeros((1, 6)), np.full((1, 6), np.inf)
    high[0, 1], low[0, 2] = 3_000_000, 7_000_000
    assert S.least_slack(goal[0], low, high, SETS) == 3_000_000 + 1_000_000
    got = S.whole(goal.astype(float), low, high, SETS, goal[0], slack=True)
    assert got[0, :12].sum() == 3_000_000 and got[0, 12:24].sum() == 7_000_000 and (got[0, 24:] == 500_000).all()


def test_residuals_of_large_counts():
    """A unit of hundreds of millions of persons converges as far as a small one."""
    hess, lin, low, high, _ = problem(4)
    many = 100_000_000
    made = S.estimate(hess, lin + many * np.ones(N) @ hess, MEMBER, low + many * MEMBER.sum(1), high + many * MEMBER.sum(1))
    assert made.primal < 1e-6 and made.dual < 1e-6


def test_zeros_are_not_aggregated(spark):
    """A unit's zeros are listed after the counts are combined, and a unit without persons has them all."""
    domain = Domain(("a",), (3,))
    hist = spark.createDataFrame([("root", "0", 1, 5)], "geolevel string, geocode string, cell int, n long")
    units = spark.createDataFrame([("root", "0"), ("root", "1")], "geolevel string, geocode string")
    got = measure(hist, units, domain, Budget(1.0, {"root": 1.0}, 1.0, {}), {})
    assert [(r["geocode"], r["row"]) for r in got.orderBy("geocode", "row").collect()] == [(g, k) for g in "01" for k in range(3)]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode") < plan.index("Aggregate")


def test_children_that_share_nothing_stand_alone():
    """From right, wrong or no guesses the solves of single children are those of the rounds, and few are left to these."""
    hess, lin, low, high, _ = problem(60)
    low[5, 2] = high[5, 2] = 0
    want = S.estimate(hess, lin, MEMBER, low, high).x
    cold = S.standing(hess, lin, MEMBER, low, high)
    assert np.abs(cold.x - want).max() < 1e-5 and cold.primal < 1e-6 and cold.dual < 1e-6
    for guess in ((cold.free, cold.side), (~cold.free, np.ones_like(cold.side)), (np.zeros_like(cold.free), -cold.side)):
        assert np.abs(S.standing(hess, lin, MEMBER, low, high, *guess).x - want).max() < 1e-5
    price = np.full(N, 1e-6)  # the response is how cells fall as prices rise
    fall = cold.x.sum(0) - S.standing(hess, lin - price, MEMBER, low, high, cold.free, cold.side).x.sum(0)
    assert np.abs(fall - cold.response @ price).max() < 1e-3 * np.abs(fall).max() + 1e-6


def test_children_are_rounded_within_their_own_bounds_first():
    """The flow is left with the parent's cells only, however many children there are."""
    hess, lin, low, high, true = problem(300)
    target = S.estimate(hess, lin, MEMBER, low, high, true.sum(0)).x
    x = np.floor(target + 0.5).astype(np.int64)
    assert ((x @ MEMBER.T < low) | (x @ MEMBER.T > high)).any()
    S._within(x, target, low, high, SETS, np.ones(N, bool))
    at = x @ MEMBER.T
    assert (at >= low).all() and (at <= high).all() and np.abs(x - target).max() < 2
