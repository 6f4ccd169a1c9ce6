"""Nested geography: codes whose prefixes are the parents' codes, and roll-ups over it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROOT = "0"


@dataclass(frozen=True)
class Hierarchy:
    """Level names from the leaves up with the lengths of their codes; length 1 is the root, coded '0'."""

    levels: tuple[str, ...]
    lengths: tuple[int, ...]

    def code(self, level: str, leaf: Column) -> Column:
        n = self.lengths[self.levels.index(level)]
        return F.lit(ROOT) if n == 1 else F.substring(leaf, 1, n)

    def above(self, level: str) -> str | None:
        i = self.levels.index(level) + 1
        return self.levels[i] if i < len(self.levels) else None

    def parent(self, level: str, code: Column) -> Column:
        up = self.above(level)
        return F.lit(None).cast("string") if up is None else self.code(up, code)

    def spread(self, leaf_rows: DataFrame, leaf: str = "geocode") -> DataFrame:
        """Each leaf row once for every level, as (geolevel, geocode, ...)."""
        units = F.array(*(F.struct(F.lit(x).alias("geolevel"), self.code(x, F.col(leaf)).alias("geocode")) for x in self.levels))
        rest = [c for c in leaf_rows.columns if c != leaf]
        return leaf_rows.select(F.explode(units).alias("unit"), *rest).select("unit.*", *rest)

    def rollup(self, leaf_rows: DataFrame, *keys: str, value: str = "n") -> DataFrame:
        """Sums of ``value`` by (geolevel, geocode, keys) for all levels.

        Leaves, which are nearly all of the rows, keep the partitioning they come in; upper levels combine before the shuffle."""
        total = F.sum(value).cast("long").alias(value)
        leaves = leaf_rows.groupBy("geocode", *keys).agg(total)
        own = leaves.select(F.lit(self.levels[0]).alias("geolevel"), "geocode", *keys, value)
        if len(self.levels) == 1:
            return own
        upper = Hierarchy(self.levels[1:], self.lengths[1:]).spread(leaves).groupBy("geolevel", "geocode", *keys).agg(total)
        return own.unionByName(upper)
