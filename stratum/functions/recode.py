"""Recodes of raw person and unit fields to histogram axes, as Column expressions.

Every recode stays inside code generation; a value outside its legal range raises an error that names the field."""

from __future__ import annotations

import re
from itertools import combinations
from math import comb

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def strict_int(value: Column, name: str) -> Column:
    """The integer in a text field; anything else is an error that names the field."""
    number = F.trim(value).try_cast("long")
    return F.when(number.isNull(), F.raise_error(F.concat(F.lit(f"{name}: invalid literal "), F.coalesce(value, F.lit("null")))).cast("long")).otherwise(number)


def in_range(value: Column, low: int, high: int, name: str) -> Column:
    """``value``, or an error if it lies outside [low, high]."""
    bad = F.raise_error(F.concat(F.lit(f"{name} out of range: "), F.coalesce(value.cast("string"), F.lit("null"))))
    return F.when(value.between(low, high), value).otherwise(bad.cast("long"))


def quarters_1940(gqtype: Column) -> Column:
    """Group-quarters type of 1940: 2-4 institutional (-1), 6-9 other (-2), the rest unchanged."""
    return F.when(gqtype.between(2, 4), -1).when(gqtype.between(6, 9), -2).otherwise(gqtype)


def quarters_2018(code: Column) -> Column:
    """Three-character group-quarters code: blank 0, below 700 its hundreds, else 7; null or another text is an error."""
    number = F.trim(code).try_cast("int")
    bad = F.raise_error(F.concat(F.lit("invalid group-quarters code "), F.coalesce(code, F.lit("null")))).cast("int")
    return F.when(F.trim(code) == "", 0).when(number.isNull(), bad).when(number < 700, F.floor(number / 100).cast("int")).otherwise(7)


def voting_age(age: Column) -> Column:
    return (age >= 18).cast("int")


def hispanic_1940(hispan: Column) -> Column:
    return (hispan > 0).cast("int")


def hispanic_2018(cenhisp: Column) -> Column:
    return in_range(cenhisp - 1, 0, 1, "CENHISP").cast("int")


def race_index(race: Column, levels: int) -> Column:
    return in_range(race - 1, 0, levels - 1, "RACE").cast("int")


def occupied(tenure: Column, most: int) -> Column:
    return (in_range(tenure, 0, most, "TEN") != 0).cast("int")


def geocode(*parts: Column) -> Column:
    return F.concat(*parts)


def race_combinations(flags: int = 6) -> list[frozenset[int]]:
    """The sets of races by their index: by number of races, then by their places."""
    return [frozenset(c) for k in range(1, flags + 1) for c in combinations(range(flags), k)]


def race_combination(flags: list[Column]) -> Column:
    """Index of a combination of race flags (each 0 or 1); null if none is set.

    Combinations of fewer races come first; among those of as many, each race that a combination lacks puts those that have it
    there in front of it."""
    m = len(flags)
    number = sum((f.cast("int") for f in flags), F.lit(0))
    index = F.element_at(F.array(*(F.lit(sum(comb(m, j) for j in range(1, k))) for k in range(1, m + 1))), F.greatest(number, F.lit(1)))
    left = number
    for place, flag in enumerate(flags):
        ahead = F.array(*(F.lit(comb(m - place - 1, r - 1)) for r in range(1, m + 1)))
        index = index + F.when((flag.cast("int") == 0) & (left > 0), F.element_at(ahead, F.greatest(left, F.lit(1)))).otherwise(0)
        left = left - flag.cast("int")
    return F.when(number > 0, index)


def relation_quarters(relation: Column) -> Column:
    return F.when(relation == 16, 2).when(relation == 15, 1).otherwise(0)


# fixed values: group-quarters types of 1940 and their histogram levels
QUARTERS_LEVELS = {0: 0, 2: 1, 3: 2, 4: 3, 6: 4, 7: 5, 8: 6, 9: 7}


def quarters_level(gqtype: Column) -> Column:
    table = F.create_map(*(F.lit(x) for pair in QUARTERS_LEVELS.items() for x in pair))
    found = F.try_element_at(table, gqtype)
    return F.when(found.isNull(), F.raise_error(F.concat(F.lit("unknown group-quarters type "), F.coalesce(gqtype.cast("string"), F.lit("null")))).cast("int")).otherwise(found)


def quarters_type(level: Column) -> Column:
    """Inverse of ``quarters_level`` for the published unit lines."""
    return F.when(level.between(1, 3), level + 1).when(level.between(4, 7), level + 2).otherwise(0)


def number_or_blank(value: Column) -> Column:
    """Number text without a needless fraction; NaN and null become the empty string."""
    whole = (value == F.floor(value)) & (F.abs(value) < 1e18)
    return F.when(value.isNull() | F.isnan(value), "").when(whole, value.cast("long").cast("string")).otherwise(value.cast("string"))


def unquoted(value: Column) -> Column:
    """Text without one pair of quotation marks around it."""
    return F.regexp_replace(value, r"^(['\"])(.*)\1$", "$2")


def clean_int(value: Column) -> Column:
    """The integer of a text with blanks, quotation marks, thousands separators or a zero fraction; null for anything else."""
    plain = F.regexp_replace(F.trim(unquoted(F.trim(value))), ",", "")
    return F.regexp_replace(plain, r"\.0*$", "").try_cast("long")


# recodes that a configuration may name, by the columns that they take
BY_NAME = {
    "int": lambda c: strict_int(c, "field"), "clean_int": clean_int, "quarters_1940": quarters_1940, "quarters_2018": quarters_2018, "quarters_level": quarters_level, "voting_age": voting_age, "hispanic_1940": hispanic_1940,
    "hispanic_2018": hispanic_2018, "race_index": lambda c: race_index(c, 6), "race_index_63": lambda c: race_index(c, 63), "relation_quarters": relation_quarters, "geocode": geocode, "race_combination": lambda *flags: race_combination(list(flags)),
}

_STEP = re.compile(r"\s*(\w+)\s*\(([^()]*)\)\s*")


def recoded(records: DataFrame, steps: dict[str, str]) -> DataFrame:
    """Columns added in order, each by a named recode of others, as a configuration lists them: {"va": "voting_age(age)"}."""
    for name, text in steps.items():
        m = _STEP.fullmatch(text)
        if not m or m[1] not in BY_NAME:
            raise ValueError(f"{name}: no recode {text}")
        records = records.withColumn(name, BY_NAME[m[1]](*(F.col(c.strip()) for c in m[2].split(",") if c.strip())))
    return records
