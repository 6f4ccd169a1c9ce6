"""Noise mechanisms of differential privacy as Column expressions, and the accounting of budgets.

Uniforms come from a keyed hash (reproducible, for tests and audits) or from the operating system (``secure_uniform``).
Noisy values are written once and read back by the callers: evaluating a mechanism twice would spend its budget twice."""

from __future__ import annotations

import math
import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TWO52 = 4503599627370496.0
_CUBE = math.sqrt(2) / math.pi


def hash_uniform(*key: Column) -> Column:
    """Uniform in [0, 1): the first 52 bits of the md5 of the key parts joined by '|'."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *key)), 1, 13), 16, 10).cast("long") / F.lit(_TWO52)


@F.pandas_udf(T.DoubleType())
def _secure(batch: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for x in batch:
        yield pd.Series((np.frombuffer(os.urandom(8 * len(x)), np.uint64) >> np.uint64(11)) / 2.0**53)


def secure_uniform(any_column: Column) -> Column:
    """Uniform in [0, 1) from the operating system's entropy; never the same twice."""
    return _secure.asNondeterministic()(any_column)


def _inside(u: Column) -> Column:
    return F.least(F.greatest(u, F.lit(2.0**-53)), F.lit(1 - 2.0**-53))


def geometric_p(epsilon: float, sensitivity: float) -> float:
    return 1 - math.exp(-epsilon / sensitivity)


def geometric_variance(epsilon: float, sensitivity: float) -> float:
    p = geometric_p(epsilon, sensitivity)
    return 2 * (1 - p) / p**2


def geometric(u1: Column, u2: Column, epsilon: float, sensitivity: float) -> Column:
    """Two-sided geometric noise: the difference of two geometric draws."""
    scale = F.lit(math.log(1 - geometric_p(epsilon, sensitivity)))
    draw = lambda u: F.floor(F.log(1 - u) / scale)
    return (draw(_inside(u1)) - draw(_inside(u2))).cast("long")


def geometric_pmf(k: Column, p: float) -> Column:
    """Probability of k; 0 off the integers."""
    whole = F.abs(k - F.round(k)) < 1e-5
    return F.when(whole, F.lit(p / (2 - p)) * F.pow(F.lit(1 - p), F.abs(F.round(k)))).otherwise(0.0)


def geometric_quantile(q: Column, p: float, centre: int = 0) -> Column:
    """Inverse distribution function of the two-sided geometric mechanism around ``centre``."""
    tail = F.when(q > 0.5, 1 - q).otherwise(q)
    a = F.ceil(F.log(tail * (2 - p)) / math.log(1 - p)) - 1
    return F.when(q < 0.5, centre - a + 1).otherwise(centre + a + 1).cast("long")


def laplace(u: Column, scale: float | Column) -> Column:
    """Laplace noise from a uniform."""
    b = scale if isinstance(scale, Column) else F.lit(float(scale))
    return F.when(u < 0.5, b * F.log(2 * _inside(u))).otherwise(-b * F.log(2 - 2 * _inside(u)))


def laplace_variance(scale: float) -> float:
    return 2 * scale**2


HALVINGS = 100  # of the SQL that the quantile is compared with
STEPS = 7


def heavy_tail_share(z: Column) -> Column:
    """Distribution function of the density sqrt(2) / (pi (1 + z^4))."""
    r = z * math.sqrt(2)
    return 0.5 + (F.log1p(2 * r / (z * z - r + 1)) / 2 + F.atan(r + 1) + F.atan(r - 1)) / (2 * math.pi)


def heavy_tail(u: Column) -> Column:
    """Quantile of that density, by a fixed number of Newton steps in one fold inside the JVM; ``u`` is computed once.

    The first value lies between 0 and the quantile, on the side where steps can't overshoot: the greater of what the density's peak and its tail allow.
    Tails of less than 1e-12 have their closed form, which is nearer than the distribution's last digits are."""
    start = lambda q, t: F.struct(q.alias("q"), t.alias("tail"))
    share = F.transform(F.array(u.cast("double")), lambda q: start(q, F.least(q, 1 - q)))
    cube = F.transform(share, lambda s: F.struct(s["q"].alias("q"), s["tail"].alias("tail"), F.least(F.cbrt(_CUBE / 3 / F.greatest(s["tail"], F.lit(1e-300))), F.lit(1e6)).alias("c")))
    first = lambda s: F.greatest((0.5 - s["tail"]) / _CUBE, s["c"] - 0.2 / (s["c"] * s["c"] * s["c"]))
    signed = F.transform(cube, lambda s: F.struct(s["q"].alias("q"), (s["tail"] < 1e-12).alias("far"), (F.when(s["q"] < 0.5, -1.0).otherwise(1.0) * F.when(s["tail"] < 1e-12, s["c"]).otherwise(first(s))).alias("z")))

    def step(s: Column, _: Column) -> Column:
        z, square = s["z"], s["z"] * s["z"]
        return F.struct(s["q"].alias("q"), s["far"].alias("far"), F.when(s["far"], z).otherwise(z + (s["q"] - heavy_tail_share(z)) * (1 + square * square) / _CUBE).alias("z"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), F.element_at(signed, 1), step, lambda s: s["z"])


def smooth_laplace(value: Column, largest: Column, u: Column, alpha: float, delta: float, epsilon: float, ignore: bool = False) -> Column:
    """Noise in proportion to the largest contributor; NaN where the parameters can't give the guarantee."""
    if not ignore and 2 * math.log(1 / delta) * math.log(1 + alpha) > epsilon:
        return F.lit(float("nan"))
    return value + F.greatest(largest * alpha, F.lit(1.0)) * (2 / epsilon) * laplace(u, 1.0)


def smooth_gamma(value: Column, largest: Column, u: Column, alpha: float, epsilon: float, ignore: bool = False) -> Column:
    left = epsilon - 5 * math.log(1 + alpha)
    if not ignore and left < 0:
        return F.lit(float("nan"))
    return value + F.greatest(largest * alpha, F.lit(1.0)) * (5 / left) * heavy_tail(u)


def log_laplace(value: Column, u: Column, alpha: float, epsilon: float) -> Column:
    gamma = 1 / alpha
    return F.exp(F.log(value + gamma) + laplace(u, 2 * math.log(1 + alpha) / epsilon)) - gamma


def laplace_dp(value: Column, u: Column, epsilon: float, sensitivity: float = 1.0) -> Column:
    return value + laplace(u, sensitivity / epsilon)


# fixed values: least number of contributors that may be published, by level
LEAST_CONTRIBUTORS = {"national": 5, "state": 10, "metro": 20}


def suppressed(value: Column, contributors: Column, total: Column, first: Column, second: Column, level: str, p: float) -> Column:
    """0 for cells with too few contributors or where the rest hides the largest too little (the p-percent rule)."""
    return F.when((contributors < LEAST_CONTRIBUTORS[level]) | (total - first - second < p * first), F.lit(0)).otherwise(value)


@dataclass(frozen=True)
class Budget:
    """epsilon split over levels (from the top) and, within each, over the detailed histogram and named queries."""

    epsilon: float
    levels: dict[str, float]
    detailed: float
    queries: dict[str, float]
    sensitivity: float = 2.0

    def __post_init__(self) -> None:
        for what, parts in (("levels", self.levels.values()), ("queries", [self.detailed, *self.queries.values()])):
            if abs(sum(parts) - 1) > 1e-9:
                raise ValueError(f"budget proportions of {what} add up to {sum(parts)}, not 1")

    def rows(self) -> list[tuple[str, str, float, float]]:
        """(level, query, epsilon, variance)."""
        parts = {"detailed": self.detailed, **self.queries}
        return [(level, q, e := self.epsilon * a * b, geometric_variance(e, self.sensitivity)) for level, a in self.levels.items() for q, b in parts.items()]


def composed(groups: list[list[float]]) -> float:
    """Budget of a table: the largest of each group of variables over disjoint cells, added over groups."""
    return sum(max(g) for g in groups)


def no_noise(value: Column) -> Column:
    """The mechanism without noise: the value as a number."""
    return value.cast("double")


def geometric_by(u1: Column, u2: Column, scale: Column) -> Column:
    """Two-sided geometric noise where the budget differs by row; ``scale`` is log(1 - p) of ``geometric_p``."""
    return (F.floor(F.log(1 - _inside(u1)) / scale) - F.floor(F.log(1 - _inside(u2)) / scale)).cast("long")


def parameter(settings: dict[str, dict[str, str]], engine: str, table: str, column: str, name: str) -> str:
    """A mechanism's parameter: that of section ``table_column`` if it has one, else that of the engine's section."""
    for section in (f"{table}_{column}", engine):
        if name in settings.get(section, {}):
            return settings[section][name]
    raise KeyError(f"no {name} for {column} of {table}, nor in {engine}")


def column_epsilon(settings: dict[str, dict[str, str]], engine: str, table: str, column: str, master: float) -> float:
    """A column's epsilon: its fraction of the master budget."""
    return float(parameter(settings, engine, table, column, "epsilon_fraction")) * master


def phases(budget: Budget, first: float) -> tuple[list[tuple[str, str, float, float]], list[tuple[str, str, float, float]]]:
    """(level, query, epsilon, variance) of the two phases of a two-phase estimate, of which the first has a share of every budget."""
    if not 0 < first < 1:
        raise ValueError(f"the first phase's share {first} isn't between 0 and 1")
    return tuple([(level, q, e * share, geometric_variance(e * share, budget.sensitivity)) for level, q, e, _ in budget.rows()] for share in (first, 1 - first))
