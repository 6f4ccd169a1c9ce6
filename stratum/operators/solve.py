"""The two problems of one parent and its children: a quadratic estimate under linear constraints, and whole numbers near it.

The children's cells x (children, cells) are not negative, add up to the parent's cells, and keep bounds low <= set @ x <= high of each
child on sets of cells.  A child without a constraint has infinite bounds there, so children may have different constraints.

``estimate`` minimises sum of x'Hx/2 - h'x over the children, where H and h hold every measured answer by its variance, by the
alternating direction method of multipliers: all children share one matrix, the parent's sums are kept exactly in every round,
and it ends when both the primal and the dual residual are small.  ``whole`` minimises the sum of |X - x| over whole numbers under the same
constraints, as a flow of least cost: sets that are nested or disjoint form a tree in each child, whose bounds are capacities.  ``least_slack``
is how far the parent's cells are from what the children's bounds allow together; where that is not 0, the estimate and the whole numbers keep
the parent's cells as nearly as can be."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

RELAX = 1.6  # over-relaxation
ROUNDS = 20_000
TOLERANCE, RELATIVE = 1e-7, 1e-12
BIG = 1e6  # cost of one unit of slack


@dataclass(frozen=True)
class Sets:
    """Sets of cells that are nested or disjoint; the first holds all cells.  ``above``: the least set around each; ``owner``: of each cell."""

    member: np.ndarray
    above: np.ndarray
    owner: np.ndarray

    @staticmethod
    def of(member: np.ndarray) -> Sets:
        m = np.asarray(member, bool)
        if not len(m) or not m[0].all():
            raise ValueError("the first set holds all cells")
        size, common = m.sum(1), m.astype(int) @ m.T.astype(int)
        nested = (common == 0) | (common == np.minimum(size[:, None], size[None]))
        if not nested.all():
            a, b = np.argwhere(~nested)[0]
            raise ValueError(f"sets {a} and {b} overlap")
        order = np.argsort(size, kind="stable")
        above = np.full(len(m), -1)
        for k, s in enumerate(order):
            around = [b for b in order[k + 1 :] if common[s, b] == size[s]]
            above[s] = around[0] if around else -1
        above[0] = -1
        owner = np.zeros(m.shape[1], int)
        for s in order[::-1]:
            owner[m[s]] = s
        return Sets(m, above, owner)

    @property
    def inner_first(self) -> np.ndarray:
        depth = np.zeros(len(self.above), int)
        for s in range(len(depth)):
            b = s
            while self.above[b] >= 0:
                b, depth[s] = self.above[b], depth[s] + 1
        return np.argsort(-depth, kind="stable")

    def cut(self, cells: np.ndarray) -> Sets:
        """The same sets over some of the cells."""
        return Sets(self.member[:, cells], self.above, self.owner[cells])


def tight(low: np.ndarray, high: np.ndarray, sets: Sets) -> tuple[np.ndarray, np.ndarray]:
    """(low, high) that every member of a child's bounds can reach: what they say about sets inside and around each is drawn in."""
    low, high = np.maximum(low, 0).astype(float), high.astype(float)
    own = np.array([(sets.owner == s).any() for s in range(len(sets.above))])
    inside = [np.flatnonzero(sets.above == s) for s in range(len(sets.above))]
    for s in sets.inner_first:
        low[:, s] = np.maximum(low[:, s], low[:, inside[s]].sum(1))
        if not own[s]:
            high[:, s] = np.minimum(high[:, s], high[:, inside[s]].sum(1))
    for s in sets.inner_first[::-1]:
        for c in inside[s]:
            rest = inside[s][inside[s] != c]
            high[:, c] = np.minimum(high[:, c], high[:, s] - low[:, rest].sum(1))
            if not own[s]:
                most = high[:, rest].sum(1)
                low[:, c] = np.maximum(low[:, c], np.where(np.isfinite(most), low[:, s] - np.where(np.isfinite(most), most, 0), 0))
    return low, high


def near_goal(d: np.ndarray, radius: float, kept: np.ndarray) -> np.ndarray:
    """Nearest to ``d`` with a sum of sizes of ``radius`` at most and a sum of 0 in each group ``kept`` (a number for each; -1: no group)."""

    def shrunk(by: float) -> np.ndarray:
        out = np.sign(d) * np.maximum(np.abs(d) - by, 0)
        for g in np.unique(kept[kept >= 0]):
            v = d[kept == g]
            a, b = v.min() - by, v.max() + by
            for _ in range(60):
                mid = (a + b) / 2
                w = v - mid
                a, b = (mid, b) if (np.sign(w) * np.maximum(np.abs(w) - by, 0)).sum() > 0 else (a, mid)
            w = v - (a + b) / 2
            out[kept == g] = np.sign(w) * np.maximum(np.abs(w) - by, 0)
        return out

    if np.abs(out := shrunk(0.0)).sum() <= radius:
        return out
    a, b = 0.0, float(np.abs(d).max() + np.ptp(d))
    for _ in range(60):
        mid = (a + b) / 2
        a, b = (mid, b) if np.abs(shrunk(mid)).sum() > radius else (a, mid)
    return shrunk(b)


@dataclass
class Estimate:
    x: np.ndarray
    rounds: int
    primal: float
    dual: float


def estimate(hess: np.ndarray, lin: np.ndarray, member: np.ndarray, low: np.ndarray, high: np.ndarray, goal: np.ndarray | None = None, radius: float | None = None, kept: np.ndarray | None = None, rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> Estimate:
    """Least of sum x'Hx/2 - h'x, h a row of ``lin`` for each child, under x >= 0, the bounds of sets and, with ``goal``, the parent's cells.

    With ``radius`` the sums of the children may differ from ``goal`` by so much in all, but not in the groups ``kept``.  Numbers are counted from
    whole ones near the estimate without constraints, so that residuals don't lose digits to large counts."""
    children, n = lin.shape
    unit = np.trace(hess) / n
    hess, lin = hess / unit, lin / unit
    start = np.maximum(lin @ np.linalg.inv(hess), 0)
    base = np.floor(start)
    lin = lin - base @ hess
    goal = None if goal is None else goal - base.sum(0)
    some = np.isfinite(low).any(0) | np.isfinite(high).any(0)
    rows = member[some].astype(float)
    low, high = low[:, some] - base @ rows.T, high[:, some] - base @ rows.T
    soft = goal is not None and radius is not None
    kept = np.full(n, -1) if kept is None else kept
    rho, inverse = 1.0, None
    z = start - base
    v, s = np.clip(z @ rows.T, low, high), None if goal is None else goal.astype(float)
    uz, uv, us = np.zeros_like(z), np.zeros_like(v), np.zeros(n)
    primal = dual = np.inf
    for done in range(1, rounds + 1):
        if inverse is None:
            inverse = np.linalg.inv(hess + rho * (np.eye(n) + rows.T @ rows))
            inner = np.linalg.inv(children * inverse + np.eye(n) / rho) if soft else None
        x = (lin + rho * (z - uz) + rho * (v - uv) @ rows) @ inverse
        if soft:
            x -= ((x.sum(0) - (s - us)) @ inner) @ inverse
        elif goal is not None:
            x -= (x.sum(0) - goal) / children
        at, total = x @ rows.T, x.sum(0)
        zr, vr = RELAX * x + (1 - RELAX) * z, RELAX * at + (1 - RELAX) * v
        z1, v1 = np.maximum(zr + uz, -base), np.clip(vr + uv, low, high)
        uz, uv = uz + zr - z1, uv + vr - v1
        moved = (z1 - z) + (v1 - v) @ rows
        primal = max(np.abs(x - z1).max(), np.abs(at - v1).max(initial=0))
        if soft:
            sr = RELAX * total + (1 - RELAX) * s
            s1 = goal + near_goal(sr + us - goal, radius, kept)
            us = us + sr - s1
            moved = moved + (s1 - s)[None]
            primal = max(primal, np.abs(total - s1).max())
            s = s1
        z, v = z1, v1
        dual = rho * np.abs(moved).max()
        wide, steep = max(1.0, np.abs(x).max(), np.abs(at).max(initial=0)), max(1.0, np.abs(lin).max(), np.abs(x @ hess).max())
        if primal <= tolerance + RELATIVE * wide and dual <= tolerance + RELATIVE * steep:
            break
        if done % 40 == 0:
            factor = np.sqrt(max(primal / wide, 1e-14) / max(dual / steep, 1e-14))
            if factor > 3 or factor < 1 / 3:
                new = float(np.clip(rho * factor, 1e-5, 1e5))
                uz, uv, us = uz * rho / new, uv * rho / new, us * rho / new
                rho, inverse = new, None
    return Estimate(z + base, done, float(primal), float(dual) * unit)


PIVOTS = 12
FINE = 1e-11  # of the few children whose cells and bounds stay in doubt
SURE = 1e-9


def _parted(member: np.ndarray) -> list[tuple[int, list[int]]]:
    """Sets that the sets next inside them cover, with these."""
    size = member.sum(1)
    within = np.array([[k != a and size[k] > 0 and bool((m <= w).all()) and (size[k] < size[a] or k > a) for k, m in enumerate(member)] for a, w in enumerate(member)])
    out = []
    for a in range(len(member)):
        inside = [int(k) for k in np.flatnonzero(within[a]) if not any(within[a, b] and within[b, k] for b in range(len(member)))]
        if inside and member[inside].any(0)[member[a]].all():
            out.append((a, inside))
    return out


@dataclass
class Standing:
    """Children that each have the least of their own problem: cells, which of them are free, which bounds hold, and their response to prices."""

    x: np.ndarray
    free: np.ndarray
    side: np.ndarray  # of each set: -1 at its low bound, 1 at its high one, 0 between
    response: np.ndarray
    primal: float
    dual: float


def standing(hess: np.ndarray, lin: np.ndarray, member: np.ndarray, low: np.ndarray, high: np.ndarray, free: np.ndarray | None = None, side: np.ndarray | None = None) -> Standing:
    """``estimate`` of children that share nothing, from a guess of the cells above 0 and the bounds that hold.

    Given these a child's cells are a linear solve, whose signs say whether the guess was right and what to change; children that are not settled after PIVOTS
    changes begin anew without the guess, and then are left to ``estimate``, and settled from where that ends.  Where a set and all sets inside it hold at once, a price may be
    passed from it to these: it is passed so that their signs are right, if any is.  H is a multiple of the unit matrix and few more directions (the queries), so a solve is as small as their number.
    ``response`` is the sum over the children of how their cells fall as prices rise."""
    children, n = lin.shape
    w, v = np.linalg.eigh(hess)
    d, more = w[0], w > w[0] * (1 + 1e-9)
    u = v[:, more] * np.sqrt(w[more] - d)
    rows = member.astype(float)
    equal = low == high
    wide = 1 + np.abs(lin).max(1, keepdims=True)
    x = np.zeros((children, n))
    cold = free is None and side is None
    fresh = lin @ np.linalg.inv(hess) > 0
    if free is None:
        free = fresh
    if side is None:
        side = np.zeros(low.shape, np.int8)
    never = ((high <= 0) @ rows) > 0  # cells that a bound holds at 0
    free, side = free & ~never, np.where(equal, -1, np.where((side < 0) & np.isfinite(low) | (side > 0) & np.isfinite(high), side, 0)).astype(np.int8)
    total, primal, dual = np.zeros((n, n)), 0.0, 0.0
    parted = _parted(member)

    def pivots(open_: np.ndarray) -> np.ndarray:
        """Settles children, and returns those that it could not."""
        nonlocal total, primal, dual
        for _ in range(PIVOTS):
            if not len(open_):
                break
            f, h, g_ = free[open_].astype(float), side[open_], lin[open_]
            uf = u.T[None] * f[:, None, :]
            k = np.linalg.inv(np.eye(u.shape[1]) + uf @ u / d)
            ku = k @ uf
            y = f * g_ / d - ((ku @ g_[:, :, None]).transpose(0, 2, 1) @ uf)[:, 0] / d**2
            bound = np.where(h < 0, low[open_], np.where(h > 0, high[open_], 0))
            c = rows[None] * (h != 0)[:, :, None] * f[:, None, :]
            ci = c / d - (c @ uf.transpose(0, 2, 1)) @ ku / d**2
            inner = np.linalg.pinv(ci @ c.transpose(0, 2, 1), hermitian=True, rcond=1e-10)
            miss = np.where(h != 0, bound - y @ rows.T, 0)
            price = (inner @ miss[:, :, None])[:, :, 0]
            for a, inside in parted:
                who = np.flatnonzero((h[:, [a, *inside]] != 0).all(1))
                if len(who):
                    p, at_low, sure = price[np.ix_(who, inside)], h[np.ix_(who, inside)] < 0, equal[np.ix_(open_[who], inside)]
                    most, least = np.where(at_low & ~sure, p, np.inf).min(1), np.where(~at_low & ~sure, p, -np.inf).max(1)
                    own, loose = -price[who, a], ~equal[open_[who], a]
                    least = np.where(loose & (h[who, a] < 0), np.maximum(least, own), least)
                    most = np.where(loose & (h[who, a] > 0), np.minimum(most, own), most)
                    by = np.where(least <= most, np.clip(0, least, most), 0)
                    price[who, a] += by
                    price[np.ix_(who, inside)] -= by[:, None]
            z = y + (price[:, None] @ ci)[:, 0]
            slope = z @ hess - g_ - price @ rows
            at = z @ rows.T
            out = (f > 0) & (z < -SURE)
            slope[never[open_]] = 0
            into = (f == 0) & (slope < -SURE * wide[open_])
            stuck = (h != 0) & (bound > 0) & (f @ rows.T == 0)  # a bound that holds without a free cell has no price: its cheapest cell goes first
            for k in np.flatnonzero(stuck.any(0)):
                who, cells = np.flatnonzero(stuck[:, k]), np.flatnonzero(member[k])
                into[who, cells[np.where(never[open_[who]][:, cells], np.inf, slope[who][:, cells]).argmin(1)]] = True
            under, over = (low[open_] > 0) & (at < low[open_] - SURE * (1 + np.abs(at))), at > high[open_] + SURE * (1 + np.abs(at))
            loose = (h < 0) & (price < -SURE * wide[open_]) | (h > 0) & (price > SURE * wide[open_])
            loose &= ~equal[open_]
            right = ~(out.any(1) | into.any(1) | under.any(1) | over.any(1) | loose.any(1))
            done = open_[right]
            x[done] = np.maximum(z[right], 0)
            if right.any():
                total += np.diag(f[right].sum(0)) / d - uf[right].reshape(-1, n).T @ ku[right].reshape(-1, n) / d**2 - ci[right].reshape(-1, n).T @ (inner[right] @ ci[right]).reshape(-1, n)
                primal = max(primal, float(np.abs(z[right] - x[done]).max()), float(np.maximum(low[done] - at[right], at[right] - high[done]).max(initial=0)))
                dual = max(dual, float(np.maximum(-np.where(f[right] == 0, slope[right], 0), np.abs(slope[right]) * f[right]).max()))
            wrong = ~right
            open_ = open_[wrong]
            free[open_] = (free[open_] & ~out[wrong]) | into[wrong]
            side[open_] = np.where(under[wrong], -1, np.where(over[wrong], 1, np.where(loose[wrong], 0, side[open_])))
        return open_

    open_ = pivots(np.arange(children))
    if not cold and len(open_):
        free[open_], side[open_] = fresh[open_] & ~never[open_], np.where(equal[open_], -1, 0)
        open_ = pivots(open_)
    rough = {}
    for tolerance in (TOLERANCE, FINE):  # the digits that are missing would add up over the children
        for i in range(0, len(open_), 256):
            some = open_[i : i + 256]
            made = estimate(hess, lin[some], member, low[some], high[some], tolerance=tolerance)
            at = made.x @ rows.T
            x[some], free[some] = made.x, made.x > 1e-7
            side[some] = np.where(np.abs(at - low[some]) < 1e-6, -1, np.where(np.abs(at - high[some]) < 1e-6, 1, 0))
            rough |= {int(j): (made.x[k], free[j].copy(), side[j].copy(), made.primal, made.dual) for k, j in enumerate(some)}
        open_ = pivots(open_)
    for i in range(0, len(open_), 256):
        some = open_[i : i + 256]
        for j in some:
            x[j], free[j], side[j], a, b = rough[int(j)]
            primal, dual = max(primal, a), max(dual, b)
        f = free[some].astype(float)
        uf = u.T[None] * f[:, None, :]
        ku = np.linalg.inv(np.eye(u.shape[1]) + uf @ u / d) @ uf
        c = rows[None] * (side[some] != 0)[:, :, None] * f[:, None, :]
        ci = c / d - (c @ uf.transpose(0, 2, 1)) @ ku / d**2
        inner = np.linalg.pinv(ci @ c.transpose(0, 2, 1), hermitian=True, rcond=1e-10)
        total += np.diag(f.sum(0)) / d - uf.reshape(-1, n).T @ ku.reshape(-1, n) / d**2 - ci.reshape(-1, n).T @ (inner @ ci).reshape(-1, n)
    return Standing(x, free, side, total, primal, dual)


def whole(target: np.ndarray, low: np.ndarray, high: np.ndarray, sets: Sets, goal: np.ndarray | None = None, slack: bool = False, free: np.ndarray | None = None) -> np.ndarray:
    """Whole numbers X >= 0 with the least sum of |X - target| that keep the bounds of sets and the sums ``goal``.

    A flow of least cost: a root feeds the children, a child its sets and cells, the children's cells the parent's.  It begins with the
    nearest whole numbers, whose steps up and down cost nothing less than 0, and carries what is too much at some nodes along shortest paths to
    where it lacks, as many at once as the path's steps cost the same; every path of one search keeps the flow the cheapest.  With ``slack`` the sums may miss ``goal`` at a cost that comes
    before all others; without ``goal`` they are free.  ``free`` are cells that may be above 0 (all, if not given)."""
    children, n = target.shape
    s_n = len(sets.above)
    free = np.ones(n, bool) if free is None else free
    target = np.where(free, target, 0.0)
    x = np.maximum(np.floor(target + 0.5), 0).astype(np.int64)
    _within(x, target, low, high, sets, free)
    root, first = n + children * s_n, n
    owned = [np.flatnonzero(sets.owner == s) for s in range(s_n)]
    inside = [np.flatnonzero(sets.above == s) for s in range(s_n)]
    g = np.zeros((children, s_n))
    excess = np.zeros(root + 1)
    spare = excess[first:root].reshape(children, s_n)
    for s in sets.inner_first:
        need = x[:, owned[s]].sum(1) + g[:, inside[s]].sum(1)
        g[:, s] = np.clip(need, low[:, s], high[:, s])
        spare[:, s] = g[:, s] - need
    given = x.sum(0).astype(float) if goal is None else goal.astype(float)
    excess[:n] = x.sum(0) - given
    excess[root] = given.sum() - g[:, 0].sum()
    number = first + np.arange(children)[:, None] * s_n + np.arange(s_n)[None]
    out_of = given.copy()
    while (excess > 0).any():
        up = np.where(free, np.abs(x + 1 - target) - np.abs(x - target), np.inf)
        down = np.where(x > 0, np.abs(x - 1 - target) - np.abs(x - target), np.inf)
        if goal is None:
            give = take = np.zeros(n)
        elif slack:
            give, take = np.where(out_of >= given, BIG, -BIG), np.where(out_of <= given, BIG, -BIG)
        else:
            give = take = np.full(n, np.inf)
        more, less = np.where(g < high, 0.0, np.inf), np.where(g > low, 0.0, np.inf)
        dist = np.where(excess > 0, 0.0, np.inf)
        came = np.full(root + 1, -1)
        cell, node = dist[:n], dist[first:root].reshape(children, s_n)
        came_cell, came_node = came[:n], came[first:root].reshape(children, s_n)
        changed = True

        def better(old: np.ndarray, new: np.ndarray, frm: np.ndarray, who: np.ndarray) -> bool:
            win = new < old - 1e-9
            old[win], who[win] = new[win], frm[win]
            return bool(win.any())

        while changed:
            changed = False
            reach = node[:, sets.owner] + up
            j = reach.argmin(0)
            changed |= better(cell, reach[j, np.arange(n)], number[j, sets.owner], came_cell)
            back = cell[None] + down
            for s in range(s_n):
                if len(owned[s]):
                    i = back[:, owned[s]].argmin(1)
                    changed |= better(node[:, s], back[np.arange(children), owned[s][i]], owned[s][i], came_node[:, s])
            for s in sets.inner_first[::-1]:
                a = sets.above[s]
                if a < 0:
                    changed |= better(node[:, s], dist[root] + more[:, s], np.full(children, root), came_node[:, s])
                else:
                    changed |= better(node[:, s], node[:, a] + more[:, s], number[:, a], came_node[:, s])
            for s in sets.inner_first:
                a = sets.above[s]
                if a >= 0:
                    changed |= better(node[:, a], node[:, s] + less[:, s], number[:, s], came_node[:, a])
            for values, frm in ((node[:, 0] + less[:, 0], number[:, 0]), (cell + give, np.arange(n))):
                k = int(values.argmin())
                if values[k] < dist[root] - 1e-9:
                    dist[root], came[root], changed = values[k], frm[k], True
            changed |= better(cell, dist[root] + take, np.full(n, root), came_cell)
        sinks = np.flatnonzero((excess < 0) & np.isfinite(dist))
        if not len(sinks):
            raise ValueError("no whole numbers keep the bounds")
        left: dict[tuple[int, int], float] = {}  # of arcs that this search has used: steps that still cost the same
        for sink in sinks[np.argsort(dist[sinks], kind="stable")]:
            path = [int(sink)]
            while came[path[-1]] >= 0:
                path.append(int(came[path[-1]]))
            path.reverse()
            steps = list(zip(path[:-1], path[1:], strict=True))
            arcs = [_arc(a, b, n, s_n, root, first, sets) for a, b in steps]
            many = min(excess[path[0]], -excess[sink], *(left[p] if p in left else _room(arc, x, g, target, low, high, out_of, given) for p, arc in zip(steps, arcs, strict=True)))
            if many < 1:
                continue
            for (a, b), arc in zip(steps, arcs, strict=True):
                if arc[0] != "set":
                    left[a, b] = (left[a, b] if (a, b) in left else _room(arc, x, g, target, low, high, out_of, given)) - many
                    left[b, a] = 0  # costs otherwise until the next search
                _push(arc, int(many), x, g, out_of)
            excess[path[0]] -= many
            excess[sink] += many
    return x


STEPS = 16  # of a child on its own; the flow carries what is left


def _within(x: np.ndarray, target: np.ndarray, low: np.ndarray, high: np.ndarray, sets: Sets, free: np.ndarray) -> None:
    """Moves each child's nearest whole numbers into its own bounds, from inner sets to outer, by the cheapest steps.

    The numbers stay the cheapest for what each set holds, so the flow may begin with them and is left with the parent's cells only."""
    m = sets.member
    have = x @ m.T
    for s in sets.inner_first:
        cells = np.flatnonzero(m[s] & free)
        inside = [t for t in range(len(m)) if t != s and (m[t] <= m[s]).all() and (m[t].sum() < m[s].sum())]
        for way, bound in ((1, low), (-1, high)):
            who = np.flatnonzero((bound[:, s] - have[:, s]) * way > 0)
            for _ in range(STEPS):
                if not len(who) or not len(cells):
                    break
                at, goal = x[np.ix_(who, cells)], target[np.ix_(who, cells)]
                cost = np.abs(at + way - goal) - np.abs(at - goal)
                if way < 0:
                    cost[at <= 0] = np.inf
                for t in inside:
                    full = have[who, t] >= high[who, t] if way > 0 else have[who, t] <= low[who, t]
                    cost[np.ix_(full, m[t][cells])] = np.inf
                best = cost.argmin(1)
                can = np.isfinite(cost[np.arange(len(who)), best])
                who, best = who[can], cells[best[can]]
                x[who, best] += way
                have[who] += way * m[:, best].T
                who = who[(bound[who, s] - have[who, s]) * way > 0]


def _arc(a: int, b: int, n: int, s_n: int, root: int, first: int, sets: Sets) -> tuple[str, int, int, int]:
    """(kind, child, set or cell, direction) of the arc between two nodes."""
    if a < n or b < n:
        i, other, way = (b, a, 1) if b < n else (a, b, -1)
        return ("slack", 0, i, -way) if other == root else ("cell", (other - first) // s_n, i, way)
    if root in (a, b):
        return "set", (min(a, b) - first) // s_n, 0, 1 if a == root else -1
    ca, cb = (a - first) % s_n, (b - first) % s_n
    return ("set", (a - first) // s_n, cb, 1) if sets.above[cb] == ca else ("set", (a - first) // s_n, ca, -1)


def _room(arc: tuple[str, int, int, int], x: np.ndarray, g: np.ndarray, target: np.ndarray, low: np.ndarray, high: np.ndarray, out_of: np.ndarray, given: np.ndarray) -> float:
    """How many steps an arc can take that cost what the first one does."""
    kind, j, k, way = arc
    if kind == "set":
        return high[j, k] - g[j, k] if way > 0 else g[j, k] - low[j, k]
    if kind == "slack":
        back = (given[k] - out_of[k]) * way
        return back if back > 0 else np.inf
    off = (target[j, k] - x[j, k]) * way  # above 0: towards the target
    same = np.inf if off <= 0 else max(np.floor(off), 1.0)
    return same if way > 0 else min(same, x[j, k])


def _push(arc: tuple[str, int, int, int], many: int, x: np.ndarray, g: np.ndarray, out_of: np.ndarray) -> None:
    kind, j, k, way = arc
    if kind == "set":
        g[j, k] += way * many
    elif kind == "cell":
        x[j, k] += way * many
    else:
        out_of[k] += way * many


def least_slack(goal: np.ndarray, low: np.ndarray, high: np.ndarray, sets: Sets, kept: np.ndarray | None = None) -> int:
    """Least sum over cells by which the children's sums miss ``goal``; ``kept`` are sets whose sum over the children is held.

    The children's bounds over nested sets add up: whatever keeps the sums of their tight bounds can be shared out among them."""
    low, high = tight(low, high, sets)
    if (low > high).any():
        raise ValueError("a child's bounds contradict each other")
    low, high = low.sum(0), high.sum(0)
    if kept is not None:
        have = sets.member[kept] @ goal
        if (have < low[kept]).any() or (have > high[kept]).any():
            raise ValueError("the kept marginal is out of the children's bounds")
        low[kept] = high[kept] = have
    return int(np.abs(whole(goal[None].astype(float), low[None], high[None], sets)[0] - goal).sum())


@dataclass
class Solved:
    """Of one parent: ``x`` before and ``whole`` after rounding, both (children, cells); ``slack`` of the least kind; residuals of the estimate."""

    x: np.ndarray
    whole: np.ndarray
    slack: int
    primal: float
    dual: float


def solve(hess: np.ndarray, lin: np.ndarray, low: np.ndarray, high: np.ndarray, sets: Sets, goal: np.ndarray | None = None, kept: np.ndarray | None = None) -> Solved:
    """Estimate and whole numbers of the children of a parent with cells ``goal``; without ``goal`` of a unit that has no parent.

    Short cuts: a parent without persons gives zeros, as far as bounds allow; a single child whose bounds allow it is its parent.  Cells that the parent has none
    of are left out.  ``kept``: numbers of disjoint sets whose sums are held if the parent's cells can't all be."""
    children, n = lin.shape
    slack = 0 if goal is None else least_slack(goal, low, high, sets)
    if goal is not None and not slack:
        if not goal.sum() or children == 1:
            same = np.broadcast_to(goal, (children, n)).astype(np.int64) if children == 1 else np.zeros((children, n), np.int64)
            return Solved(same.astype(float), same, 0, 0.0, 0.0)
        live = np.flatnonzero(goal > 0)
        part = sets.cut(live)
        made = estimate(hess[np.ix_(live, live)], lin[:, live], part.member, low, high, goal[live])
        x, y = np.zeros((children, n)), np.zeros((children, n), np.int64)
        x[:, live], y[:, live] = made.x, whole(made.x, low, high, part, goal[live])
        return Solved(x, y, 0, made.primal, made.dual)
    if goal is None:
        made = estimate(hess, lin, sets.member, low, high)
        return Solved(made.x, whole(made.x, low, high, sets), 0, made.primal, made.dual)
    group = np.full(n, -1)
    if kept is not None:
        slack = least_slack(goal, low, high, sets, kept)
        for s in kept:
            group[sets.member[s]] = s
    made = estimate(hess, lin, sets.member, low, high, goal, slack + 1.0, group)
    if kept is None:
        y = whole(made.x, low, high, sets, goal, slack=True)
    else:  # sums over the children near the estimate's, in the marginal and as near to the parent as can be
        a, b = (x.sum(0) for x in tight(low, high, sets))
        a[kept] = b[kept] = sets.member[kept] @ goal
        y = whole(made.x, low, high, sets, whole(goal[None].astype(float), a[None], b[None], sets)[0])
    return Solved(made.x, y, slack, made.primal, made.dual)
