"""Sparse multi-dimensional histograms: long rows (keys, cell, n), ``cell`` being the row-major index over the axes."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


RUN = 10_000  # copies made at once


@dataclass(frozen=True)
class Domain:
    """Named axes and their sizes."""

    names: tuple[str, ...]
    dims: tuple[int, ...]

    @property
    def size(self) -> int:
        return reduce(lambda a, b: a * b, self.dims, 1)

    @property
    def strides(self) -> tuple[int, ...]:
        out = [1]
        for d in reversed(self.dims[1:]):
            out.insert(0, out[0] * d)
        return tuple(out)

    def cell(self) -> Column:
        """Index of the axis columns of a record."""
        return reduce(lambda a, b: a + b, (F.col(n) * s for n, s in zip(self.names, self.strides, strict=True))).cast("int")

    def axis(self, k: int, cell: Column | None = None) -> Column:
        """Level of axis ``k`` of a cell."""
        cell = F.col("cell") if cell is None else cell
        return (F.floor(cell / self.strides[k]) % self.dims[k]).cast("int")

    def decode(self, hist: DataFrame) -> DataFrame:
        return hist.withColumns({n: self.axis(k) for k, n in enumerate(self.names)})

    def out_of_bounds(self) -> Column:
        """Whether a record's axis columns are null or outside the domain."""
        return reduce(lambda a, b: a | b, (F.col(n).isNull() | ~F.col(n).between(0, d - 1) for n, d in zip(self.names, self.dims, strict=True)))

    def histogram(self, records: DataFrame, *keys: str) -> DataFrame:
        """Counts of records by keys and cell; a record outside the domain is an error."""
        bad = F.raise_error(F.concat(F.lit("record outside the histogram: "), *(F.coalesce(F.col(n).cast("string"), F.lit("null")) for n in self.names)))
        cell = F.when(self.out_of_bounds(), bad.cast("int")).otherwise(self.cell())
        return records.select(*keys, cell.alias("cell")).groupBy(*keys, "cell").agg(F.count("*").alias("n"))

    def dense(self, hist: DataFrame, units: DataFrame, *keys: str) -> DataFrame:
        """One row per unit and cell, zeros included; the cells are exploded from a literal, not joined."""
        every = units.select(*keys).distinct().withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(self.size - 1))))
        return every.join(hist, [*keys, "cell"], "left").select(*keys, "cell", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def distinct_units(records: DataFrame, unit: list[str], *keys: str) -> DataFrame:
    """Number of distinct units by keys."""
    return records.select(*unit, *keys).distinct().groupBy(*keys).agg(F.count("*").alias("n"))


def expand(hist: DataFrame) -> DataFrame:
    """One row per counted record; in two steps, so that no array is longer than RUN however large a count is."""
    runs = hist.where("n > 0").withColumn("_run", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {RUN}"))))
    first = F.col("_run") * RUN + 1
    return runs.withColumn("copy", F.explode(F.sequence(first, F.least(F.col("n"), first + (RUN - 1))))).drop("n", "_run")
