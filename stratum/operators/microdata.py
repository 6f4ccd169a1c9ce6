"""Synthetic records from histograms: units and persons, their numbering, and the published lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratum.functions.recode import in_range, quarters_type
from stratum.operators.histogram import Domain, expand

BUILD = "3.1.4"


def units(unit_hist: DataFrame, group: int = 4) -> DataFrame:
    """(geocode, hhgq, unit, euid): units of a block in order of type; ``unit`` counts within the block, ``euid`` over all.

    Numbers over all come from running sums in two steps, over the first ``group`` characters of the code (few rows) and over
    the blocks that share them, so no task sees all blocks."""
    rows = expand(unit_hist)
    per = unit_hist.where("n > 0").groupBy("geocode").agg(F.sum("n").alias("size")).withColumn("g", F.substring("geocode", 1, group))
    w = lambda *by: (Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))).rowsBetween(Window.unboundedPreceding, -1)
    sums = per.groupBy("g").agg(F.sum("size").alias("all")).select("g", F.coalesce(F.sum("all").over(w().orderBy("g")), F.lit(0)).alias("base"))
    starts = per.withColumn("ahead", F.coalesce(F.sum("size").over(w("g").orderBy("geocode")), F.lit(0))).join(sums, "g")
    starts = starts.select("geocode", (F.col("base") + F.col("ahead")).cast("long").alias("start"))
    inside = Window.partitionBy("geocode").orderBy("hhgq", "copy")
    return rows.withColumn("unit", (F.row_number().over(inside) - 1).cast("long")).join(starts, "geocode").select("geocode", "hhgq", "unit", (F.col("start") + F.col("unit")).alias("euid"))


def starts(unit_hist: DataFrame) -> DataFrame:
    """(geocode, hhgq, start, size): the first unit of each type in its block."""
    w = Window.partitionBy("geocode").orderBy("hhgq").rowsBetween(Window.unboundedPreceding, -1)
    return unit_hist.where("n > 0").select("geocode", "hhgq", F.coalesce(F.sum("n").over(w), F.lit(0)).cast("long").alias("start"), F.col("n").alias("size"))


def persons(hist: DataFrame, unit_hist: DataFrame, domain: Domain) -> DataFrame:
    """(geocode, hhgq, cell, unit, person): persons dealt in turn to the units of their type, in cell order."""
    before = Window.partitionBy("geocode", "hhgq").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = domain.decode(hist.groupBy("geocode", "cell").agg(F.sum("n").alias("n"))).withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
    # the cells of a block and type are numbered, not its persons: these count on within their cell, in whatever task they are
    placed = expand(cells).withColumn("k", (F.col("base") + F.col("copy") - 1).cast("long")).join(starts(unit_hist), ["geocode", "hhgq"])
    return placed.select("geocode", "hhgq", "cell", (F.col("start") + F.col("k") % F.col("size")).alias("unit"), F.floor(F.col("k") / F.col("size")).alias("person"))


def final_population(unit_rows: DataFrame, person_rows: DataFrame) -> DataFrame:
    """Units with their number of persons; empty ones have 0."""
    count = person_rows.groupBy("geocode", "unit").agg(F.count("*").alias("pop"))
    return unit_rows.join(count, ["geocode", "unit"], "left").withColumn("pop", F.coalesce("pop", F.lit(0)))


def _line(*fields: Column | str) -> Column:
    return F.concat_ws("|", *(F.lit(f) if isinstance(f, str) else f.cast("string") for f in fields))


def person_line_1940(state: Column, county: Column, district: Column, euid: Column, person: Column, hhgq: Column, va: Column, hisp: Column, race: Column) -> Column:
    """23 fields of a published person."""
    return _line("MPD1940", BUILD, state, county, district, euid, person + 1, F.when(hhgq == 0, "3").otherwise("5"), "99", "9", F.when(va == 1, "18").otherwise("17"), in_range(hisp, 0, 1, "hispanic") + 1, in_range(race, 0, 5, "race") + 1, *["9999"] * 9, "9")


def unit_line_1940(state: Column, county: Column, district: Column, euid: Column, hhgq: Column, pop: Column) -> Column:
    """25 fields of a published unit."""
    kind = F.when(hhgq.isin(0, 8), "2").otherwise("4")
    ten = F.when((kind == "2") & (pop > 0), "9").otherwise("0")
    vacancy = F.when((kind == "2") & (pop == 0), "9").otherwise("0")
    # fixed values of fields that aren't modelled, in the order of the published layout
    rest = ["9", "99", "99", "9", "9", "9", "999", "9", "99", "9", "99", "99", "99", "99"]
    return _line("MUD1940", BUILD, state, county, district, euid, kind, quarters_type(hhgq), ten, vacancy, pop, *rest)


def _block(geocode: Column) -> list[Column]:
    """State, county, tract, block group and block of a 16-digit code; any other length is an error."""
    whole = F.when(F.length(geocode) == 16, geocode).otherwise(F.raise_error(F.concat(F.lit("no 16-digit code: "), F.coalesce(geocode, F.lit("null")))))
    return [F.substring(whole, a, n) for a, n in ((1, 2), (3, 3), (6, 6), (12, 1), (13, 4))]


def person_line_2018(geocode: Column, euid: Column, person: Column, hhgq: Column, va: Column, hisp: Column, race: Column) -> Column:
    """25 fields of a published person."""
    kind = F.when(hhgq == 0, "3").otherwise("5")
    age = F.when(va == 0, "17").otherwise("18")
    combination = F.lpad((in_range(race, 0, 62, "CENRACE") + 1).cast("string"), 2, "0")
    return _line("MPD", BUILD, *_block(geocode), euid, person + 1, kind, "99", "9", age, in_range(hisp, 0, 1, "CENHISP") + 1, combination, *["9999"] * 9, "9")


def unit_line_2018(geocode: Column, euid: Column, hhgq: Column, pop: Column) -> Column:
    """27 fields of a published unit; quarters 0 are households, 8 vacant ones."""
    kind = F.when(hhgq.isin(0, 8), "2").otherwise("4")
    quarters = F.when(kind == "2", "000").otherwise((hhgq * 100 + 1).cast("string"))
    ten = F.when((kind == "2") & (pop > 0), "9").otherwise("0")
    vacancy = F.when((kind == "2") & (pop == 0), "9").otherwise("0")
    # fixed values of fields that aren't modelled, in the order of the published layout
    rest = ["9", "99", "99", "9", "9", "9", "999", "9", "99", "9", "99", "99", "99", "99"]
    return _line("MUD", BUILD, *_block(geocode), euid, kind, quarters, ten, vacancy, pop, *rest)


def plain_line(domain: Domain, separator: str = "|") -> Column:
    """geocode and axis levels of one person."""
    return F.concat_ws(separator, "geocode", *(domain.axis(k).cast("string") for k in range(len(domain.dims))))
