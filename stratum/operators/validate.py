"""Checks of records and releases: legal values, key integrity, invariants kept, and the protected total error."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.functions.noise import geometric, geometric_p, geometric_quantile


def intervals(text: str) -> list[tuple[str, str]]:
    """Closed intervals of a legal list such as "3-8,4,5,9-12"."""
    out = []
    for part in text.split(","):
        low, dash, high = part.strip().partition("-")
        out.append((low, high if dash else low))
    return out


def cardinality(text: str) -> int:
    """Number of legal values: of code points for single letters, else of integers."""
    size = lambda a, b: (ord(b) - ord(a) if len(a) == len(b) == 1 and not (a + b).isdigit() else int(b) - int(a)) + 1
    return sum(size(a, b) for a, b in intervals(text))


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Integer ranges with touching and overlapping ones joined."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def legal(value: Column, text: str, kind: str = "int") -> Column:
    """Whether a value is in the legal list; strings must also have a length between those of the ends."""
    parts = []
    for a, b in intervals(text):
        if kind == "int":
            parts.append(value.try_cast("long").between(int(a), int(b)))
        else:
            parts.append(value.between(a, b) & F.length(value).between(len(a), len(b)))
    return F.coalesce(reduce(lambda x, y: x | y, parts), F.lit(False))


def padded_between(value: Column, low: str, high: str, width: int) -> Column:
    """String range check after left-padding to the field width."""
    pad = lambda s: s.rjust(width)
    return F.lpad(value, width, " ").between(pad(low), pad(high))


def in_ranges(value: Column, ranges: list[tuple[str, str]], kind: str, width: int = 0) -> Column:
    """Whether a text field is in one of its ranges: NULL is a blank field, N/A any value; numbers compare as numbers, touching ranges of
    integers as one; strings after padding on the left to the field's width."""
    blank = F.trim(F.coalesce(value, F.lit(""))) == ""
    plain = [r for r in ranges if r[0].upper() not in ("NULL", "N/A")]
    parts = [blank] * any(r[0].upper() == "NULL" for r in ranges)
    if any(r[0].upper() == "N/A" for r in ranges):
        return F.lit(True)
    if kind == "int":
        parts += [F.trim(value).try_cast("long").between(a, b) for a, b in merged([(int(a), int(b)) for a, b in plain])]
    elif kind == "float":
        parts += [F.trim(value).try_cast("double").between(float(a), float(b)) for a, b in plain]
    else:
        parts += [padded_between(value, a, b, width) for a, b in plain]
    return F.coalesce(reduce(lambda x, y: x | y, (F.coalesce(p, F.lit(False)) for p in parts)), F.lit(False)) if parts else F.lit(False)


def reasons(checks: dict[str, Column]) -> Column:
    """'VAR (value) out of range' of every failed check of a record, joined by ', '."""
    said = [F.when(~ok, F.concat(F.lit(f"{n} ("), F.coalesce(F.col(n).cast("string"), F.lit("null")), F.lit(") out of range"))) for n, ok in checks.items()]
    return F.concat_ws(", ", *said)


def violations(records: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Number of failed records of each variable, in one pass."""
    counts = records.agg(*(F.count(F.when(~ok, 1)).alias(n) for n, ok in checks.items()))
    pairs = F.explode(F.array(*(F.struct(F.lit(n).alias("variable"), F.col(n).alias("failures")) for n in checks)))
    return counts.select(pairs.alias("v")).select("v.*")


def lines_valid(lines: DataFrame, fields: int, most_errors: int) -> DataFrame:
    """Up to ``most_errors`` lines that don't have the right number of '|' fields; '#' lines are comments."""
    return lines.where(~F.col("value").startswith("#") & (F.size(F.split("value", r"\|")) != fields)).limit(most_errors)


def key_integrity(children: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """(children, matched, orphans) of a reference by semi join."""
    total = children.agg(F.count("*").alias("children"))
    return total.join(children.join(parents.select(key).distinct(), key, "left_semi").agg(F.count("*").alias("matched")), how="full").select("children", "matched", (F.col("children") - F.col("matched")).alias("orphans"))


def same_counts(a: DataFrame, b: DataFrame, check: str, *keys: str) -> DataFrame:
    """(check, expected, actual, failures): totals of two count tables and the number of keys that differ, by full outer join."""
    both = a.withColumnRenamed("n", "x").join(b.withColumnRenamed("n", "y"), list(keys), "full_outer").select(F.coalesce("x", F.lit(0)).alias("x"), F.coalesce("y", F.lit(0)).alias("y"))
    return both.agg(F.lit(check).alias("check"), F.coalesce(F.sum("x"), F.lit(0)).cast("long").alias("expected"), F.coalesce(F.sum("y"), F.lit(0)).cast("long").alias("actual"), F.count(F.when(F.col("x") != F.col("y"), 1)).alias("failures"))


def protected_l1(totals: DataFrame, u1: Column, u2: Column, epsilon: float, sensitivity: float, quantile: float) -> DataFrame:
    """(noisy_l1, upper, relative): total error with noise, its one-sided confidence bound, and over twice the population."""
    p = geometric_p(epsilon, sensitivity)
    noisy = totals.withColumn("noisy_l1", F.col("l1") + geometric(u1, u2, epsilon, sensitivity))
    return noisy.select("noisy_l1", (F.col("noisy_l1") + geometric_quantile(F.lit(quantile), p)).alias("upper"), (F.col("noisy_l1") / (2 * F.col("n"))).alias("relative"))


def parse_range(text: str) -> tuple[str, str, str]:
    """('1', '2', 'hello') of "1-2 = hello"."""
    m = re.fullmatch(r"\s*([^-=\s]+)\s*(?:-\s*([^=\s]+))?\s*(?:=\s*(.*?))?\s*", text)
    if not m:
        raise ValueError(f"no range: {text}")
    return m[1], m[2] or m[1], m[3] or ""
