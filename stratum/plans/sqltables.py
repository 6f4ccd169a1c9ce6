"""Tables by SQL with noise: queries over input views, noise on their measure columns, and output queries over noisy views."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.functions.noise import composed, hash_uniform, secure_uniform
from stratum.operators.estimate import settle


@dataclass(frozen=True)
class Noise:
    """Noise on one measure column: (frame columns, uniform) -> new value, and the budget it spends."""

    column: str
    apply: Callable[[Column, Column], Column]
    epsilon: float = 0.0


@dataclass
class NoisyTables:
    """``pre``: name -> SQL in order, each result a view for the later ones; ``noise``: table -> groups of measures (a group's
    cells are disjoint); ``out``: name -> SQL that reads the noisy tables under their own names.  ``before`` and ``after``: functions of whole
tables, applied in order to a table of ``pre`` before its noise, and to a table of ``out`` on both sides."""

    pre: dict[str, str]
    noise: dict[str, list[list[Noise]]]
    out: dict[str, str]
    cells: dict[str, list[str]]
    master_epsilon: float
    secure: bool = False
    before: dict[str, list[Callable[[DataFrame], DataFrame]]] = field(default_factory=dict)
    after: dict[str, list[Callable[[DataFrame], DataFrame]]] = field(default_factory=dict)
    warnings: list[str] = field(default_factory=list)

    def spent(self) -> dict[str, float]:
        return {t: composed([[n.epsilon for n in g] for g in groups]) for t, groups in self.noise.items()}

    def run(self, spark: SparkSession, inputs: dict[str, DataFrame]) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
        """(true, noisy) output tables.  Two sessions hold views of the same names, so the same SQL reads true or noisy tables."""
        if abs(sum(self.spent().values()) - self.master_epsilon) > 1e-5:
            self.warnings.append(f"budgets add up to {sum(self.spent().values())}, not {self.master_epsilon}")
        true_side, noisy_side = spark.newSession(), spark.newSession()
        before = {}
        for name, df in inputs.items():
            self._view(df, true_side, name)
        for name, sql in self.pre.items():
            before[name] = self._through(true_side.sql(sql), self.before.get(name, []))
            before[name].createOrReplaceTempView(name)
        for name in set(self.pre) - set(self.noise):
            self.warnings.append(f"table {name} has no noise and isn't published")
        for name, groups in self.noise.items():
            self._view(settle(self.noised(before[name], name, groups)), noisy_side, name)
        return tuple({n: self._through(side.sql(q), self.after.get(n, [])) for n, q in self.out.items()} for side in (true_side, noisy_side))

    @staticmethod
    def _through(df: DataFrame, functions: list[Callable[[DataFrame], DataFrame]]) -> DataFrame:
        for f in functions:
            df = df.transform(f)
        return df

    @staticmethod
    def _view(df: DataFrame, session: SparkSession, name: str) -> None:
        """A view of a frame of another session: a global temp view lends it its plan."""
        df.createOrReplaceGlobalTempView(f"{name}_{id(df):x}")
        session.table(f"global_temp.{name}_{id(df):x}").createOrReplaceTempView(name)

    def noised(self, df: DataFrame, name: str, groups: list[list[Noise]]) -> DataFrame:
        made = {}
        for g in groups:
            for n in g:
                key = [F.lit(name), F.lit(n.column), *(F.coalesce(F.col(c).cast("string"), F.lit("NA")) for c in self.cells[name])]
                u = secure_uniform(F.col(n.column)) if self.secure else hash_uniform(*key)
                made[n.column] = n.apply(F.col(n.column), u)
        return df.withColumns(made)


def regrouped(df: DataFrame, drop: list[str], how: dict[str, str], keys: list[str]) -> DataFrame:
    """Aggregates over the cell columns that stay; null cells count as 'NA', no column left means a grand total."""
    left = [k for k in keys if k not in drop]
    filled = df.withColumns({k: F.coalesce(F.col(k).cast("string"), F.lit("NA")) for k in left})
    measures = [getattr(F, f)(c).alias(c) for c, f in how.items()]
    return filled.groupBy(*left).agg(*measures) if left else filled.agg(*measures)


def register_functions(spark: SparkSession) -> None:
    """Job-flow rates as SQL functions."""
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION denom(a DOUBLE, b DOUBLE) RETURNS DOUBLE RETURN 0.5 * (a + b)")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION rate(a DOUBLE, b DOUBLE) RETURNS DOUBLE RETURN CASE WHEN b <> 0 THEN a / b END")
