"""One run from record files to a release: read, recode, tabulate, measure, estimate, expand to records, write and report.

The configuration names the files, the budget and the folder; every step is a DataFrame of the one before.  Only measurements,
estimates and the tabulated histogram are stored in between, the first because reading them again would spend the budget twice."""

from __future__ import annotations

import configparser
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.functions import recode as R
from stratum.functions.noise import Budget
from stratum.operators import microdata as D
from stratum.operators import topdown as T
from stratum.operators.estimate import measure, settle
from stratum.operators.hierarchy import Hierarchy
from stratum.operators.histogram import Domain
from stratum.operators.linear import LinearQuery
from stratum.operators.workload import workload
from stratum.plans.experiment import setting
from stratum.sources.layout import save_levels, write_lines, write_metrics
from stratum.sources.records import read_records

DOMAIN = Domain(("hhgq", "va", "hisp", "race"), (8, 2, 2, 6))
GEOGRAPHY = Hierarchy(("district", "county", "state", "root"), (10, 6, 2, 1))
# structural zeros by name: no minors in nursing homes
ZEROS = {"nurse_nva_0": LinearQuery(DOMAIN, "nurse_nva_0", subset={0: [3], 1: [0]}, over=(0, 1, 2, 3))}
# quarters are bounded by units at the district, totals are exact at the state
RULES = {"district": T.Rule(("gqhh_vect", "gqhh_tot"), ("hhgq_total_lb", "hhgq_total_ub")), "state": T.Rule(("tot",), ("total", "hhgq_total_lb", "hhgq_total_ub"))}


def recoded_1940(households: DataFrame, persons: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(persons with geocode and axes, units with geocode and hhgq) of the household and person records; a field outside its range is an error."""
    number = lambda c: R.strict_int(F.col(c), c)
    place = R.geocode(F.lpad("statefip", 2, "0"), F.lpad("county", 4, "0"), F.lpad("enumdist", 4, "0"))
    units = households.select("serial", place.alias("geocode"), R.quarters_level(number("gqtype").cast("int")).alias("hhgq"))
    axes = persons.select("serial", R.voting_age(number("age")).alias("va"), R.hispanic_1940(number("hispan")).alias("hisp"), R.race_index(number("race"), 6).cast("int").alias("race"))
    return axes.join(units, "serial").select("geocode", *DOMAIN.names), units.select("geocode", "hhgq")


def budget(config: configparser.ConfigParser) -> Budget:
    """[budget] epsilon, levels (shares from the top), queries (names) and their shares, detailed first."""
    levels = [float(x) for x in setting(config, "budget", "levels", list)]
    names, shares = setting(config, "budget", "queries", list, []), [float(x) for x in setting(config, "budget", "shares", list)]
    if len(shares) != len(names) + 1 or len(levels) != len(GEOGRAPHY.levels):
        raise ValueError("[budget] needs a share for each level, for the detailed histogram and for each query")
    return Budget(setting(config, "budget", "epsilon", float), dict(zip(reversed(GEOGRAPHY.levels), levels, strict=True)), shares[0], dict(zip(names, shares[1:], strict=True)))


def rules(config: configparser.ConfigParser) -> dict[str, T.Rule]:
    """[constraints] invariants.<level> and constraints.<level>: what is counted there and bounded by it; RULES without that section."""
    if not config.has_section("constraints"):
        return RULES
    named = {key: setting(config, "constraints", key, list) for key in config.options("constraints")}
    bad = [k for k in named if k.partition(".")[0] not in ("invariants", "constraints") or k.partition(".")[2] not in GEOGRAPHY.levels]
    if bad:
        raise ValueError(f"[constraints] has {bad[0]}, which is no level of the geography")
    return {level: T.Rule(tuple(named.get(f"invariants.{level}", ())), tuple(named.get(f"constraints.{level}", ()))) for level in GEOGRAPHY.levels}


@dataclass
class Release:
    """The frames of a release."""

    truth: DataFrame
    units: DataFrame
    estimates: DataFrame
    person_lines: DataFrame
    unit_lines: DataFrame
    checks: DataFrame


def release(persons: DataFrame, units: DataFrame, split: Budget, secure: bool = True, by_level: dict[str, T.Rule] | None = None) -> Release:
    """Of recoded records (geocode, axes) and units (geocode, hhgq).  Only what ``by_level`` names is exact; unless a rule names a level's totals, they are
    estimates."""
    truth = settle(DOMAIN.histogram(persons, "geocode"))
    unit_hist = settle(units.groupBy("geocode", "hhgq").agg(F.count("*").alias("n")))
    every, every_unit = GEOGRAPHY.rollup(truth, "cell"), GEOGRAPHY.rollup(unit_hist, "hhgq")
    by_level = RULES if by_level is None else by_level
    zeros = {k: q for k, q in ZEROS.items() if any(k in r.constraints for r in by_level.values())}
    sets = T.Constrained.of(DOMAIN, T.constraint_queries(DOMAIN, zeros=zeros))
    rhs = settle(T.level_constraints(every, every_unit, GEOGRAPHY, DOMAIN.dims[0], by_level, tuple(zeros)))
    measured = settle(measure(every, every_unit.select("geolevel", "geocode"), DOMAIN, split, workload(DOMAIN), secure))
    made, _ = T.top_down(measured, rhs, GEOGRAPHY, DOMAIN, split, workload(DOMAIN), sets)
    estimates = settle(made)
    leaf = estimates.where(F.col("geolevel") == GEOGRAPHY.levels[0]).select("geocode", "cell", F.col("syn").alias("n"))
    homes = D.units(unit_hist)
    people = D.persons(leaf, unit_hist, DOMAIN).join(homes.select("geocode", "unit", "euid"), ["geocode", "unit"])
    people = DOMAIN.decode(people.drop("hhgq"))
    part = [F.substring("geocode", a, n) for a, n in ((1, 2), (3, 4), (7, 4))]
    person_lines = people.select(D.person_line_1940(*part, F.col("euid"), F.col("person"), *(F.col(c) for c in DOMAIN.names)).alias("value"))
    with_pop = D.final_population(homes, people)
    unit_lines = with_pop.select(D.unit_line_1940(*part, F.col("euid"), F.col("hhgq"), F.col("pop")).alias("value"))
    return Release(truth, unit_hist, estimates, person_lines, unit_lines, T.checked(estimates, rhs, sets))


def run(spark: SparkSession, config: configparser.ConfigParser) -> Release:
    """[reader] household, person: files of fixed-width lines; [budget]; [constraints]; [writer] folder; [noise] secure (true unless said otherwise)."""
    households = read_records(spark, config.get("reader", "household"), "household_1940")
    persons = read_records(spark, config.get("reader", "person"), "person_1940")
    made = release(*recoded_1940(households, persons), budget(config), setting(config, "noise", "secure", bool, True), rules(config))
    folder = config.get("writer", "folder")
    write_lines(made.person_lines, f"{folder}/persons")
    write_lines(made.unit_lines, f"{folder}/units")
    save_levels(made.estimates, f"{folder}/estimates")
    write_metrics(made.checks, f"{folder}/checks")
    return made
