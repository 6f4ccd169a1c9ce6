"""One parent with more children than a task should hold: the estimate of ``solve`` with the children split over tasks.

Given a price for each of the parent's cells, every child's best estimate is a problem of its own.  The sums of these are the parent's
cells at the right prices, which Newton's method finds in a few rounds: a round solves all children at the present prices, block by
block, and only the sums of their cells and of their responses to prices (cells x cells) leave a task.  A block keeps which cells are above 0 and
which bounds hold, where the next round begins (``solve.standing``).  The prices maximise a concave
function; steps are damped, more after one that lowers it and less after one that raises it.  So the answer is that of solving all children together, up to the residual.

Whole numbers: blocks are rounded first, as units whose bounds are the sums of their children's tight bounds, to the parent's cells; then every
block's children to the block's.  Sums of tight bounds over nested sets are all that a block can reach, so every block can be shared out.
A parent out of reach of its children's bounds is replaced by the nearest sums in reach, which miss it by the least slack.

The table of blocks is settled once, prices after every round (one row a parent); reading a settled table again is all that a lost executor costs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.operators import solve as S
from stratum.operators.estimate import settle

BLOCK = 1000  # children
ROUNDS = 60
DAMP = 1e-2  # of the largest response, to begin with
GAP = 1e-6  # of the children's sums to the parent's cells
TASK = 8  # blocks
ANSWERS = "parent string, block long, sums array<double>, bend array<double>, value double, free binary, side binary"
BLOCKS = "parent string, block long, geolevel string, geocodes array<string>, lin binary, low binary, high binary, sums array<double>"
STATE = "parent string, goal array<double>, base array<double>, step array<double>, damp double, value double, gap double, off array<double>, slope binary, slack long"


def _arrays(row: pd.Series, n: int, s: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return tuple(np.frombuffer(row[c]).reshape(-1, k) for c, k in (("lin", n), ("low", s), ("high", s)))


def crowded(children: DataFrame, hess: np.ndarray, linear, bounds_of, sets: S.Sets, block: int = BLOCK) -> DataFrame:
    """(geolevel, geocode, x, estimate, slack, primal, dual) of ``children(geolevel, geocode, parent, above, answers, cons)``.

    ``linear`` and ``bounds_of`` make the linear terms of answers and the bounds of lists of right sides."""
    n, s = sets.member.shape[1], len(sets.above)
    number = F.greatest(F.ceil(F.col("children") / block), F.lit(1))
    sizes = settle(children.groupBy("parent").agg(F.count("*").alias("children"), F.first("above").alias("above")))

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("geocode")
        low, high = S.tight(*bounds_of(list(frame["cons"]), s), sets)
        if (low > high).any():
            raise ValueError("a child's bounds contradict each other")
        lin = np.ascontiguousarray(linear(np.stack(frame["answers"])))
        return pd.DataFrame({"parent": frame["parent"].iloc[:1], "block": frame["block"].iloc[:1], "geolevel": frame["geolevel"].iloc[:1], "geocodes": [list(frame["geocode"])], "lin": [lin.tobytes()], "low": [low.tobytes()], "high": [high.tobytes()], "sums": [[*low.sum(0), *high.sum(0)]]})

    dealt = children.drop("above").join(F.broadcast(sizes.select("parent", number.alias("blocks"))), "parent").withColumn("block", F.pmod(F.xxhash64("geocode"), F.col("blocks")))
    every = sizes.agg(F.sum(number)).first()[0] or 0
    parts = max(int(children.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-int(every) // TASK))
    blocks = settle(dealt.drop("blocks").repartition(parts, "parent", "block").groupBy("parent", "block").applyInPandas(pack, BLOCKS))

    def begin(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            out = []
            for above, sums in zip(frame["above"], frame["sums"], strict=True):
                goal, low, high = np.array(above, float), np.array(sums[:s])[None], np.array(sums[s:])[None]
                slack = S.least_slack(goal, low, high, sets)
                out.append((S.whole(goal[None], low, high, sets)[0].astype(float) if slack else goal, slack))
            zero = [np.zeros(n)] * len(out)
            yield pd.DataFrame({"parent": frame["parent"], "goal": [g for g, _ in out], "base": zero, "step": zero, "damp": DAMP, "value": -np.inf, "gap": np.inf, "off": zero, "slope": b"", "slack": [k for _, k in out]})

    total = blocks.groupBy("parent").agg(F.array(*(F.sum(F.col("sums")[k]) for k in range(2 * s))).alias("sums"))
    state = settle(total.join(sizes.select("parent", "above"), "parent").mapInPandas(begin, STATE))

    def solved(row: pd.Series) -> tuple[np.ndarray, np.ndarray, np.ndarray, S.Standing]:
        """(cells that the parent has, their prices, linear terms, estimate) of a block."""
        live = np.flatnonzero(np.array(row["goal"]) > 0)
        price = (np.array(row["base"]) + np.array(row["step"]))[live]
        lin, low, high = _arrays(row, n, s)
        guess = (None, None) if row["free"] is None else (np.frombuffer(row["free"], bool).reshape(len(lin), -1), np.frombuffer(row["side"], np.int8).reshape(len(lin), -1))
        return live, price, lin[:, live], S.standing(hess[np.ix_(live, live)], lin[:, live] - price, sets.cut(live).member, low, high, *guess)

    def respond(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for _, row in frame.iterrows():
                live, price, lin, made = solved(row)
                sums, slope = np.zeros(n), np.zeros((n, n))
                sums[live] = made.x.sum(0)
                slope[np.ix_(live, live)] = made.response
                value = float(0.5 * ((made.x @ hess[np.ix_(live, live)]) * made.x).sum() - ((lin - price) * made.x).sum())
                yield pd.DataFrame({"parent": [row["parent"]], "block": [row["block"]], "sums": [sums], "bend": [np.ravel(slope)], "value": [value], "free": [made.free.tobytes()], "side": [made.side.tobytes()]})

    def step(frame: pd.DataFrame) -> pd.DataFrame:
        """The next prices of one parent from its tasks' sums."""
        first = frame.iloc[0]
        goal, base, damp = np.array(first["goal"]), np.array(first["base"]), float(first["damp"])
        price = base + np.array(first["step"])
        off, slope = np.sum(np.stack(frame["sums"]), 0) - goal, np.sum(np.stack(frame["bend"]), 0).reshape(n, n)
        value, gap = float(frame["part"].sum() - price @ goal), float(np.abs(off).max())
        if value < first["value"] - 1e-9 * (1 + abs(first["value"])) and gap > GAP:
            damp, value, off, slope = damp * 8, float(first["value"]), np.array(first["off"]), np.frombuffer(first["slope"]).reshape(n, n)
        else:
            base, damp = price, max(damp / 6, 1e-9) if np.isfinite(first["value"]) else damp
        live, delta = np.flatnonzero(goal > 0), np.zeros(n)
        if gap > GAP:
            most = first["children"] * n / np.trace(hess)
            delta[live] = np.linalg.solve(slope[np.ix_(live, live)] + damp * most * np.eye(len(live)), off[live])
        return pd.DataFrame({"parent": [first["parent"]], "goal": [goal], "base": [base], "step": [delta], "damp": [damp], "value": [value], "gap": [gap], "off": [off], "slope": [slope.tobytes()], "slack": [first["slack"]]})

    def dealt_out(rows: DataFrame) -> DataFrame:
        """One part for each TASK blocks, however few bytes they are: solving takes the time."""
        return rows.repartition(parts, "parent", "block")

    stands = blocks.select("parent", "block", F.lit(None).cast("binary").alias("free"), F.lit(None).cast("binary").alias("side"))
    for _ in range(ROUNDS):
        open_ = state.where(F.col("gap") > GAP)
        answers = settle(dealt_out(blocks).join(F.broadcast(open_.drop("slope", "off")), "parent").join(dealt_out(stands), ["parent", "block"]).mapInPandas(respond, ANSWERS))
        stands = answers.select("parent", "block", "free", "side")
        moved = answers.select("parent", "sums", "bend", F.col("value").alias("part")).join(open_, "parent").join(sizes.select("parent", "children"), "parent").groupBy("parent").applyInPandas(step, STATE)
        state = settle(moved.unionByName(state.where(F.col("gap") <= GAP)))
        if (state.agg(F.max("gap")).first()[0] or 0.0) <= GAP:
            break

    def shared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            out = []
            for _, row in frame.iterrows():
                live, _, _, made = solved(row)
                x = np.zeros((made.x.shape[0], n))
                x[:, live] = made.x
                out.append((x.tobytes(), x.sum(0), made.primal, made.dual))
            yield frame[["parent", "block", "geolevel", "geocodes", "low", "high", "sums", "goal", "slack", "gap"]].assign(x=[o[0] for o in out], part=[o[1] for o in out], primal=[o[2] for o in out], dual=[o[3] for o in out])

    schema = "parent string, block long, geolevel string, geocodes array<string>, low binary, high binary, sums array<double>, goal array<double>, slack long, gap double, x binary, part array<double>, primal double, dual double"
    estimated = settle(dealt_out(blocks).join(F.broadcast(state.drop("slope", "off")), "parent").join(dealt_out(stands), ["parent", "block"], "left").mapInPandas(shared, schema))

    def goals(frame: pd.DataFrame) -> pd.DataFrame:
        goal = np.array(frame["goal"].iloc[0])
        live = np.flatnonzero(goal > 0)
        sums = np.stack(frame["sums"])
        out = np.zeros((len(frame), n), np.int64)
        out[:, live] = S.whole(np.stack(frame["part"])[:, live], sums[:, :s], sums[:, s:], sets.cut(live), goal[live])
        return pd.DataFrame({"parent": frame["parent"], "block": frame["block"], "own": list(out)})

    own = estimated.select("parent", "block", "sums", "goal", "part").groupBy("parent").applyInPandas(goals, "parent string, block long, own array<long>")

    def rounded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for _, row in frame.iterrows():
                goal = np.array(row["own"])
                live = np.flatnonzero(goal > 0)
                low, high = (np.frombuffer(row[c]).reshape(-1, s) for c in ("low", "high"))
                x = np.frombuffer(row["x"]).reshape(-1, n)
                y = np.zeros(x.shape, np.int64)
                y[:, live] = S.whole(x[:, live], low, high, sets.cut(live), goal[live])
                yield pd.DataFrame({"geolevel": row["geolevel"], "geocode": row["geocodes"], "x": list(y), "estimate": list(x), "slack": row["slack"], "primal": max(row["primal"], row["gap"]), "dual": row["dual"]})

    return dealt_out(estimated.drop("sums", "goal", "part")).join(dealt_out(own), ["parent", "block"]).mapInPandas(rounded, "geolevel string, geocode string, x array<long>, estimate array<double>, slack long, primal double, dual double")
