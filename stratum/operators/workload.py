"""Named queries over person histograms (quarters, voting age, hispanic, race) and bundles of them."""

from __future__ import annotations

from itertools import combinations

from stratum.functions.recode import race_combinations
from stratum.operators.histogram import Domain
from stratum.operators.linear import LinearQuery, marginal


def race_groups(levels: int) -> list[list[int]]:
    """Levels of a race-combination axis by number of races."""
    flags = (levels + 1).bit_length() - 1
    if 2**flags - 1 != levels:
        return [[i] for i in range(levels)]
    sets = race_combinations(flags)
    return [[i for i, s in enumerate(sets) if len(s) == k] for k in range(1, flags + 1)]


def in_combination(levels: int, flag: int) -> list[list[int]]:
    """Levels with the flag, and those without."""
    has = [i for i, s in enumerate(race_combinations((levels + 1).bit_length() - 1)) if flag in s]
    return [has, [i for i in range(levels) if i not in has]]


def workload(domain: Domain) -> dict[str, LinearQuery]:
    """All named queries that the domain's axes allow; unknown names are a KeyError of the dictionary."""
    out = {"total_pop": marginal(domain, name="total_pop")}
    for size in range(1, len(domain.names)):
        for axes in combinations(domain.names, size):
            out["_".join(axes)] = marginal(domain, *axes)
    where = {n: k for k, n in enumerate(domain.names)}
    if "hhgq" in where and domain.dims[where["hhgq"]] == 8:
        k = where["hhgq"]
        out["inst_noninst"] = LinearQuery(domain, "inst_noninst", groups={k: [[1, 2, 3, 4], [5, 6, 7]]}, over=tuple(x for x in range(len(domain.dims)) if x != k))
    if "race" in where:
        k, levels = where["race"], domain.dims[where["race"]]
        rest = tuple(x for x in range(len(domain.dims)) if x != k)
        groups = race_groups(levels)
        out["number_of_races"] = LinearQuery(domain, "number_of_races", groups={k: groups}, over=rest)
        if levels == 6:  # six single races in two groups, as in 1940
            out["racecomb"] = LinearQuery(domain, "racecomb", groups={k: [[0, 1, 2], [3, 4, 5]]}, over=rest)
        if len(groups) > 1 and len(groups[0]) < levels:
            more = [x for g in groups[1:] for x in g]
            out["two_or_more_races"] = LinearQuery(domain, "two_or_more_races", subset={k: more}, over=tuple(range(len(domain.dims))))
            for flag in range((levels + 1).bit_length() - 1):
                out[f"race{flag}_in_combination"] = LinearQuery(domain, f"race{flag}_in_combination", groups={k: in_combination(levels, flag)}, over=rest)
    out["weight_test"] = LinearQuery(domain, "weight_test", over=tuple(k for k in range(len(domain.dims)) if k != 1), weights={0: [1.5] * domain.dims[0]})
    return out


def table(domain: Domain, name: str) -> dict[str, LinearQuery]:
    """The redistricting tables: total, hispanic and race counts of a subset of the population."""
    where = {n: k for k, n in enumerate(domain.names)}
    # fixed values: the subsets of the tables
    cuts = {
        "p1": {},
        "p2": {"hisp": [0]},
        "p3": {"va": [1]},
        "p4": {"va": [1], "hisp": [0]},
        "p42": {"hhgq": list(range(1, domain.dims[where["hhgq"]]))},
    }
    subset = {where[n]: levels for n, levels in cuts[name].items()}
    every = tuple(range(len(domain.dims)))
    out = {f"{name}_total": LinearQuery(domain, f"{name}_total", subset=subset, over=every)}
    if name == "p42":
        k = where["hhgq"]
        rest = tuple(x for x in every if x != k)
        out[f"{name}_hhgq"] = LinearQuery(domain, f"{name}_hhgq", subset=subset, over=rest)
        if domain.dims[k] == 8:
            out[f"{name}_inst_noninst"] = LinearQuery(domain, f"{name}_inst_noninst", groups={k: [[1, 2, 3, 4], [5, 6, 7]]}, over=rest)
        return out
    race = where["race"]
    groups = race_groups(domain.dims[race])
    if len(groups) > 1 and len(groups[0]) < domain.dims[race]:  # an axis of combinations
        out[f"{name}_number_of_races"] = LinearQuery(domain, f"{name}_number_of_races", subset=subset, groups={race: groups}, over=tuple(x for x in every if x != race))
        out[f"{name}_two_or_more_races"] = LinearQuery(domain, f"{name}_two_or_more_races", subset=subset | {race: [x for g in groups[1:] for x in g]}, over=every)
    out[f"{name}_race"] = LinearQuery(domain, f"{name}_race", subset=subset, over=tuple(x for x in every if x != race))
    if "hisp" not in cuts[name]:
        out[f"{name}_hisp"] = LinearQuery(domain, f"{name}_hisp", subset=subset, over=tuple(x for x in every if x != where["hisp"]))
    return out


def pl94(domain: Domain) -> dict[str, LinearQuery]:
    """All redistricting tables together."""
    return {q: made for name in ("p1", "p2", "p3", "p4", "p42") for q, made in table(domain, name).items()}
