"""Every operator bound to the standard tables: persons are line items, units are orders, the geography is
customer < nation < region < root, with quarters from order priority.  ``ORACLE_SQL`` has DuckDB SQL of the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratum.functions import noise as N
from stratum.functions import recode as R
from stratum.operators import constrained as K
from stratum.operators import constraints as C
from stratum.operators import estimate as E
from stratum.operators import metrics as M
from stratum.operators import microdata as D
from stratum.operators import topdown as T
from stratum.operators import validate as V
from stratum.operators.hierarchy import Hierarchy
from stratum.operators.histogram import Domain, distinct_units, expand
from stratum.operators.linear import KroneckerQuery, LinearQuery, answers, check_shape, marginal, marginal_family, reduced, stacked, weighted_cells
from stratum.operators.workload import pl94, workload
from stratum.operators.workload import table as redistricting
from stratum.plans import etl
from stratum.plans.sqltables import Noise, NoisyTables, regrouped
from stratum.sources import layout

DOMAIN = Domain(("hhgq", "va", "hisp", "race"), (5, 2, 2, 3))
RACES = Domain(("hhgq", "race"), (5, 7))
H = Hierarchy(("customer", "nation", "region", "root"), (11, 4, 2, 1))
KEYS = ("geolevel", "geocode")
BUDGET = N.Budget(1.0, {"root": 0.25, "region": 0.25, "nation": 0.25, "customer": 0.25}, 0.5, {"hhgq": 0.2, "va_hisp_race": 0.3})

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name or f.__name__] = f
        if sql is not None:
            ORACLE_SQL[name or f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


ORDERS = 100_000  # that a task has persons and cells of


def tasks(spark: SparkSession, sf: str) -> int:
    """Tasks that persons and their cells are dealt out to: more for larger tables, so that none holds more than it does now."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-read(spark, sf, "orders").count() // ORDERS))


# ---- the model's tables ---------------------------------------------------------------------------------------------


def geography(spark: SparkSession, sf: str) -> DataFrame:
    code = lambda c, n: F.lpad(F.col(c).cast("string"), n, "0")
    c, n = read(spark, sf, "customer"), read(spark, sf, "nation")
    joined = c.select("c_custkey", "c_nationkey").join(n.select("n_nationkey", "n_regionkey"), F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.select("c_custkey", R.geocode(code("n_regionkey", 2), code("n_nationkey", 2), code("c_custkey", 7)).alias("geocode"))


def units(spark: SparkSession, sf: str) -> DataFrame:
    o = read(spark, sf, "orders").select("o_orderkey", "o_custkey", (F.substring("o_orderpriority", 1, 1).cast("int") - 1).alias("hhgq"))
    n = tasks(spark, sf)
    return o.repartition(n, "o_custkey").join(geography(spark, sf).repartition(n, "c_custkey"), F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "geocode", "hhgq")


def persons(spark: SparkSession, sf: str) -> DataFrame:
    race = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).when(F.col("l_returnflag") == "R", 2)
    p = read(spark, sf, "lineitem").select("l_orderkey", (F.col("l_quantity") >= 18).cast("int").alias("va"), (F.col("l_linestatus") == "F").cast("int").alias("hisp"), race.alias("race"), (F.col("l_linenumber") - 1).alias("race7"))
    n = tasks(spark, sf)
    both = p.repartition(n, "l_orderkey").join(units(spark, sf).repartition(n, "o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    return both.select("geocode", "hhgq", "va", "hisp", "race", "race7")


def leaf(spark: SparkSession, sf: str) -> DataFrame:
    return DOMAIN.histogram(persons(spark, sf).repartition(tasks(spark, sf), "geocode"), "geocode")


def hist(spark: SparkSession, sf: str) -> DataFrame:
    """Units of all levels, each in one task with all its cells."""
    return H.rollup(leaf(spark, sf), "cell").repartition(tasks(spark, sf), *KEYS)


def unit_hist(spark: SparkSession, sf: str) -> DataFrame:
    """(geocode, hhgq, n): level 5 is vacant."""
    n = tasks(spark, sf)
    used = read(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")).repartition(n, "o_orderkey").distinct()
    occupied = units(spark, sf).repartition(n, "o_orderkey").join(used.withColumn("used", F.lit(1)), "o_orderkey", "left")
    level = F.when(F.col("used").isNull(), 5).otherwise(F.col("hhgq"))
    return occupied.select("geocode", level.alias("hhgq")).repartition(n, "geocode").groupBy("geocode", "hhgq").agg(F.count("*").alias("n"))


def unit_levels(spark: SparkSession, sf: str) -> DataFrame:
    return H.rollup(unit_hist(spark, sf), "hhgq")


def counted(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """(hist, unit_levels) of a query that reads them many times: line items and orders are read once, and each unit's counts settled as one row.

    Units of all levels are in one task with all their counts."""
    packed = lambda rows, name, *keys: rows.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct(name, "n"))).alias(name))
    leaves = E.settle(packed(unit_hist(spark, sf), "hhgq", "geocode").join(packed(leaf(spark, sf), "cell", "geocode"), "geocode", "left"))
    upper = Hierarchy(H.levels[1:], H.lengths[1:])
    sums = lambda name: packed(upper.spread(leaves.select("geocode", F.explode(name).alias(name, "n"))).groupBy(*KEYS, name).agg(F.sum("n").alias("n")), name, *KEYS)
    above = E.settle(sums("hhgq").join(sums("cell"), list(KEYS), "left"))
    every = leaves.select(F.lit(H.levels[0]).alias("geolevel"), "geocode", "hhgq", "cell").unionByName(above).repartition(E.tasks(leaves), *KEYS)
    return tuple(every.select(*KEYS, F.explode(name).alias(name, "n")) for name in ("cell", "hhgq"))


def estimate(rows: DataFrame, *keys: str) -> DataFrame:
    """Deterministic stand-in for an estimate: counts shifted by hash noise, kept non-negative."""
    u = N.hash_uniform(*(F.col(k) for k in keys), F.col("cell").cast("string"))
    return rows.withColumn("n", F.greatest(F.lit(0), F.col("n") + F.floor(u * 5).cast("long") - 2).cast("long"))


_P2 = lambda c, n: f"lpad(CAST({c} AS VARCHAR), {n}, '0')"
BASE = f"""
WITH geo AS (SELECT c_custkey, {_P2("n_regionkey", 2)} || {_P2("n_nationkey", 2)} || {_P2("c_custkey", 7)} AS geocode FROM customer JOIN nation ON c_nationkey = n_nationkey),
unit AS (SELECT o_orderkey, geocode, CAST(substring(o_orderpriority, 1, 1) AS INTEGER) - 1 AS hhgq FROM orders JOIN geo ON o_custkey = c_custkey),
person AS (SELECT geocode, hhgq, CAST(l_quantity >= 18 AS INTEGER) AS va, CAST(l_linestatus = 'F' AS INTEGER) AS hisp,
  CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 WHEN 'R' THEN 2 END AS race, l_linenumber - 1 AS race7 FROM lineitem JOIN unit ON l_orderkey = o_orderkey),
leaf AS (SELECT geocode, hhgq * 12 + va * 6 + hisp * 3 + race AS cell, count(*) AS n FROM person GROUP BY ALL),
levels AS (SELECT * FROM (VALUES ('customer', 11), ('nation', 4), ('region', 2), ('root', 1)) AS t(geolevel, len)),
hist AS (SELECT geolevel, CASE WHEN len = 1 THEN '0' ELSE substring(geocode, 1, len) END AS geocode, cell, CAST(sum(n) AS BIGINT) AS n FROM leaf, levels GROUP BY ALL),
axes AS (SELECT *, cell // 12 AS hhgq, cell // 6 % 2 AS va, cell // 3 % 2 AS hisp, cell % 3 AS race FROM hist),
uhist AS (SELECT geocode, CASE WHEN l_orderkey IS NULL THEN 5 ELSE hhgq END AS hhgq, count(*) AS n FROM unit LEFT JOIN (SELECT DISTINCT l_orderkey FROM lineitem) ON o_orderkey = l_orderkey GROUP BY ALL),
ulevel AS (SELECT geolevel, CASE WHEN len = 1 THEN '0' ELSE substring(geocode, 1, len) END AS geocode, hhgq, CAST(sum(n) AS BIGINT) AS n FROM uhist, levels GROUP BY ALL),
ugeo AS (SELECT DISTINCT geolevel, geocode FROM ulevel),
udense AS (SELECT u.geolevel, u.geocode, h.hhgq, coalesce(n, 0) AS n FROM ugeo u CROSS JOIN (SELECT unnest(range(5)) AS hhgq) h LEFT JOIN ulevel USING (geolevel, geocode, hhgq)),
tots AS (SELECT geolevel, geocode, CAST(sum(n) AS BIGINT) AS tot FROM hist GROUP BY ALL),
ut AS (SELECT geolevel, geocode, hhgq, n AS v, sum(n) OVER (PARTITION BY geolevel, geocode) AS units, coalesce(tot, 0) AS tot FROM udense LEFT JOIN tots USING (geolevel, geocode))
"""
_U = lambda key: f"CAST(('0x' || substr(md5({key}), 1, 13)) AS BIGINT) / 4503599627370496.0"


# ---- histograms and roll-ups ---------------------------------------------------------------------------------------


@query(BASE + "SELECT geolevel, geocode, CAST(va * 6 + hisp * 3 + race AS INTEGER) AS row, CAST(sum(n) AS BIGINT) AS n FROM axes GROUP BY ALL")
def entry_population_rollup(spark, sf):
    return workload(DOMAIN)["va_hisp_race"].answer(hist(spark, sf), *KEYS)


@query(BASE + "SELECT geocode, CAST(cell AS INTEGER) AS cell, n FROM leaf")
def leaf_histogram(spark, sf):
    return leaf(spark, sf)


@query(BASE + "SELECT geocode, CAST(hhgq AS INTEGER) AS hhgq, n FROM uhist")
def unit_histogram_vacant(spark, sf):
    return unit_hist(spark, sf)


@query(BASE + "SELECT u.geocode, coalesce(p.persons, 0) AS persons, CAST(u.units AS BIGINT) AS units FROM (SELECT geocode, CAST(sum(n) AS BIGINT) AS persons FROM leaf GROUP BY 1) p RIGHT JOIN (SELECT geocode, sum(n) AS units FROM uhist GROUP BY 1) u USING (geocode)")
def block_right_outer(spark, sf):
    p = leaf(spark, sf).groupBy("geocode").agg(F.sum("n").alias("persons"))
    u = unit_hist(spark, sf).groupBy("geocode").agg(F.sum("n").alias("units"))
    return p.join(u, "geocode", "right").select("geocode", F.coalesce("persons", F.lit(0)).alias("persons"), "units")


@query(BASE + "SELECT geolevel, geocode, CAST(cell AS INTEGER) AS cell, n FROM hist")
def geo_rollup_all_levels(spark, sf):
    return hist(spark, sf)


@query(BASE + "SELECT geolevel, geocode, CAST(c AS INTEGER) AS cell, coalesce(n, 0) AS n FROM (SELECT DISTINCT geolevel, geocode FROM hist) CROSS JOIN (SELECT unnest(range(60)) AS c) LEFT JOIN (SELECT geolevel, geocode, cell AS c, n FROM hist) USING (geolevel, geocode, c)")
def dense_zero_cells(spark, sf):
    every = hist(spark, sf)
    return DOMAIN.dense(every, every, *KEYS)


@query(BASE + "SELECT substring(geocode, 1, 4) AS nation, hhgq, count(DISTINCT o_orderkey) AS n FROM unit GROUP BY ALL")
def distinct_unit_count(spark, sf):
    u = units(spark, sf).withColumn("nation", F.substring("geocode", 1, 4))
    return distinct_units(u, ["o_orderkey"], "nation", "hhgq")


@query(BASE + "SELECT geocode, cell, i AS copy FROM (SELECT geocode, CAST(cell AS INTEGER) AS cell, unnest(range(1, n + 1)) AS i FROM leaf)")
def expand_counts(spark, sf):
    return expand(leaf(spark, sf))


# ---- linear queries ---------------------------------------------------------------------------------------------------


def _named(name: str, row: str, where: str = "true", q: LinearQuery | None = None, value: str = "n", kind: str = "BIGINT", key: str | None = None) -> None:
    sql = BASE + f"SELECT geolevel, geocode, CAST({row} AS INTEGER) AS row, CAST(sum({value}) AS {kind}) AS n FROM axes WHERE {where} GROUP BY ALL"
    query(sql, key or f"query_{name}")(lambda spark, sf: (q or workload(DOMAIN)[name]).answer(hist(spark, sf), *KEYS))


for _axis in DOMAIN.names:
    _named(_axis, _axis, key=f"marginal_1way_{_axis}")
_named("total_pop", "0", key="total_pop")
for _a, _b, _r in (("hhgq", "va", "hhgq * 2 + va"), ("hhgq", "hisp", "hhgq * 2 + hisp"), ("hhgq", "race", "hhgq * 3 + race"), ("va", "hisp", "va * 2 + hisp"), ("va", "race", "va * 3 + race"), ("hisp", "race", "hisp * 3 + race")):
    _named(f"{_a}_{_b}", _r, key=f"marginal_2way_{_a}_{_b}")
for _s, _r in (("hhgq_va_hisp", "(hhgq * 2 + va) * 2 + hisp"), ("hhgq_va_race", "(hhgq * 2 + va) * 3 + race"), ("hhgq_hisp_race", "(hhgq * 2 + hisp) * 3 + race")):
    _named(_s, _r, key=f"marginal_3way_{_s}")
_named("subset", "(hhgq - 1) * 2 + CASE race WHEN 2 THEN 0 ELSE 1 END", "hhgq IN (1, 2, 3) AND va = 1 AND race IN (0, 2)", LinearQuery(DOMAIN, subset={0: [1, 2, 3], 1: [1], 3: [2, 0]}, over=(1, 2)))
_named("axis_grouping", "CASE WHEN hhgq IN (0, 1) THEN 0 ELSE 1 END", "hhgq <> 2", LinearQuery(DOMAIN, groups={0: [[0, 1], [3, 4]]}, over=(1, 2, 3)))
_named("weighted", "va", q=LinearQuery(DOMAIN, over=(0, 2, 3), weights={0: [1.5] * 5}), value="n * 1.5", kind="DOUBLE")
_named("inst_noninst_analogue", "CASE WHEN hhgq IN (1, 2) THEN 0 ELSE 1 END", "hhgq > 0", LinearQuery(DOMAIN, groups={0: [[1, 2], [3, 4]]}, over=(1, 2, 3)))


@query(BASE + "SELECT geolevel, geocode, CAST(g.g AS INTEGER) AS row, CAST(sum(n) AS BIGINT) AS n FROM axes JOIN (VALUES (0, 0), (1, 0), (1, 1), (2, 1), (2, 2), (0, 2)) g(level, g) ON race = level GROUP BY ALL")
def query_overlapping_groups(spark, sf):
    return LinearQuery(DOMAIN, groups={3: [[0, 1], [1, 2], [0, 2]]}, over=(0, 1, 2)).answer(hist(spark, sf), *KEYS)


@query(BASE + "SELECT geolevel, geocode, CAST(hhgq AS INTEGER) AS row, CAST(sum(n) AS BIGINT) AS n FROM axes GROUP BY ALL UNION ALL SELECT geolevel, geocode, CAST(5 + race AS INTEGER), CAST(sum(n) AS BIGINT) FROM axes GROUP BY ALL")
def query_stacked(spark, sf):
    return stacked([marginal(DOMAIN, "hhgq"), marginal(DOMAIN, "race")], hist(spark, sf), *KEYS)


@query(BASE + "SELECT geolevel, geocode, CAST(hhgq * 2 + hisp AS INTEGER) AS row, CAST(sum(n) AS DOUBLE) AS n FROM axes GROUP BY ALL")
def query_matrix_rows(spark, sf):
    m = marginal(DOMAIN, "hhgq", "hisp").matrix()
    rows = [(int(r), int(c), float(m[r, c])) for r, c in zip(*m.nonzero(), strict=True)]  # at most one a cell
    coef = spark.createDataFrame(rows, "row int, cell int, coef double")
    return hist(spark, sf).join(F.broadcast(coef), "cell").groupBy(*KEYS, "row").agg(F.sum(F.col("n") * F.col("coef")).alias("n"))


@query(BASE + "SELECT geolevel, geocode, CAST(g.r * 2 + va AS INTEGER) AS row, CAST(sum(n * g.v) AS DOUBLE) AS n FROM axes JOIN (VALUES (0, 0, 1.0), (1, 0, 0.5), (1, 1, 0.5), (2, 1, 1.0), (4, 1, -1.0)) g(level, r, v) ON hhgq = level WHERE race <> 1 GROUP BY ALL")
def query_kronecker_factors(spark, sf):
    q = KroneckerQuery(DOMAIN, (((1.0, 0.5, 0, 0, 0), (0, 0.5, 1.0, 0, -1.0)), ((1.0, 0), (0, 1.0)), ((1.0, 1.0),), ((1.0, 0, 1.0),)), "factors")
    return q.answer(hist(spark, sf), *KEYS)


@query(BASE + "SELECT geolevel, geocode, CAST(hhgq AS INTEGER) AS row, CAST(sum(n) AS BIGINT) AS n FROM axes WHERE cell % 2 = 0 GROUP BY ALL UNION ALL SELECT geolevel, geocode, CAST(5 + race AS INTEGER), CAST(sum(n) AS BIGINT) FROM axes WHERE cell % 2 = 0 GROUP BY ALL")
def query_stacked_subset(spark, sf):
    return stacked([marginal(DOMAIN, "hhgq"), marginal(DOMAIN, "race")], hist(spark, sf), *KEYS, domain_subset=list(range(0, 60, 2)))


@query(BASE + "SELECT geolevel, geocode, CAST(race AS INTEGER) AS row, CAST(sum(n * (1 + (cell % 7) / 10.0)) AS DOUBLE) AS n FROM axes GROUP BY ALL")
def query_weight_array(spark, sf):
    weights = spark.range(DOMAIN.size).select(F.col("id").cast("int").alias("cell"), (1 + F.col("id") % 7 / 10).alias("weight"))
    return weighted_cells(hist(spark, sf), weights, marginal(DOMAIN, "race"), *KEYS)


@query(BASE + "SELECT geolevel, geocode, CAST(hhgq AS INTEGER) AS row, CAST(n AS BIGINT) AS rhs FROM udense")
def query_shape_checked(spark, sf):
    rhs = C.unit_table(unit_levels(spark, sf), 5, *KEYS).select(*KEYS, F.col("hhgq").alias("row"), F.col("n").alias("rhs"))
    return check_shape(marginal(DOMAIN, "hhgq"), rhs, *KEYS)


@query(BASE + "SELECT geolevel, geocode, CAST(va AS INTEGER) AS row, CAST(sum(n) AS BIGINT) AS n FROM axes WHERE hhgq IN (0, 2) GROUP BY ALL")
def query_reduced_schema(spark, sf):
    """A query over all axes, answered on the histogram that keeps two of them."""
    small = Domain(("hhgq", "va"), (5, 2))
    rows = marginal(DOMAIN, *small.names).answer(hist(spark, sf), *KEYS).withColumnRenamed("row", "cell")
    return reduced(LinearQuery(DOMAIN, subset={0: [0, 2]}, over=(0, 2, 3)), small.names).answer(rows, *KEYS)


_SETS = {1: "(hhgq), (va), (hisp), (race)", 2: "(hhgq, va), (hhgq, hisp), (hhgq, race), (va, hisp), (va, race), (hisp, race)", 3: "(hhgq, va, hisp), (hhgq, va, race), (hhgq, hisp, race), (va, hisp, race)"}
_LABEL = "concat_ws('_', CASE grouping(hhgq) WHEN 0 THEN 'hhgq' END, CASE grouping(va) WHEN 0 THEN 'va' END, CASE grouping(hisp) WHEN 0 THEN 'hisp' END, CASE grouping(race) WHEN 0 THEN 'race' END)"


def _family(name: str, sizes: list[int]) -> None:
    sets = ", ".join("(geolevel, geocode, " + s.strip("()") + ")" for k in sizes for s in _SETS[k].replace("), (", ")|(").split("|"))
    sql = BASE + f"SELECT geolevel, geocode, {_LABEL} AS marginal, CAST(coalesce(hhgq, -1) AS INTEGER) AS hhgq, CAST(coalesce(va, -1) AS INTEGER) AS va, CAST(coalesce(hisp, -1) AS INTEGER) AS hisp, CAST(coalesce(race, -1) AS INTEGER) AS race, CAST(sum(n) AS BIGINT) AS n FROM axes GROUP BY GROUPING SETS ({sets})"
    query(sql, name)(lambda spark, sf: marginal_family(DOMAIN, hist(spark, sf), sizes, *KEYS).fillna(-1, list(DOMAIN.names)))


_family("marginal_1way_all", [1])
_family("marginal_2way_all", [2])
_family("marginal_3way_all", [3])
_family("marginal_all", [1, 2, 3])


@query(BASE + "SELECT geolevel, geocode, CAST(coalesce(hhgq, -1) AS INTEGER) AS hhgq, CAST(coalesce(va, -1) AS INTEGER) AS va, CAST(coalesce(race, -1) AS INTEGER) AS race, CAST(grouping(hhgq) * 4 + grouping(va) * 2 + grouping(race) AS BIGINT) AS gid, CAST(sum(n) AS BIGINT) AS n FROM axes GROUP BY GROUPING SETS ((geolevel, geocode, hhgq, va, race), (geolevel, geocode, hhgq, va), (geolevel, geocode, hhgq, race), (geolevel, geocode, va, race), (geolevel, geocode, hhgq), (geolevel, geocode, va), (geolevel, geocode, race), (geolevel, geocode))")
def marginal_cube(spark, sf):
    rows = DOMAIN.decode(hist(spark, sf))
    axes = [F.col(c) for c in ("hhgq", "va", "race")]
    sets = [[F.col("geolevel"), F.col("geocode"), *(a for i, a in enumerate(axes) if not m >> (2 - i) & 1)] for m in range(8)]
    gid = sum(F.grouping(a).cast("long") * 2 ** (2 - i) for i, a in enumerate(axes))
    return rows.groupingSets(sets, *KEYS, *axes).agg(gid.alias("gid"), F.sum("n").cast("long").alias("n")).fillna(-1, ["hhgq", "va", "race"]).select(*KEYS, "hhgq", "va", "race", "gid", "n")


def _race_table(name: str, groups: str, make: Callable[[], LinearQuery]) -> None:
    sql = BASE + f"SELECT nation, CAST(g AS INTEGER) AS row, CAST(count(*) AS BIGINT) AS n FROM (SELECT substring(geocode, 1, 4) AS nation, {groups} AS g FROM person) WHERE g IS NOT NULL GROUP BY ALL"

    def run(spark, sf):
        rows = persons(spark, sf).select(F.substring("geocode", 1, 4).alias("nation"), "hhgq", F.col("race7").alias("race"))
        return make().answer(RACES.histogram(rows, "nation"), "nation")

    query(sql, name)(run)


_race_table("number_of_races_analogue", "CASE WHEN race7 < 3 THEN 0 WHEN race7 < 6 THEN 1 ELSE 2 END", lambda: workload(RACES)["number_of_races"])
_race_table("two_or_more_races_analogue", "CASE WHEN race7 >= 3 THEN 0 END", lambda: workload(RACES)["two_or_more_races"])
_race_table("race_in_combination_analogue", "CASE WHEN race7 IN (0, 3, 4, 6) THEN 0 ELSE 1 END", lambda: workload(RACES)["race0_in_combination"])

_CUTS = {"p1": "true", "p2": "hisp = 0", "p3": "va = 1", "p4": "va = 1 AND hisp = 0", "p42": "hhgq > 0"}
_ROWS = {"total": "0", "race": "race", "hisp": "hisp", "hhgq": "hhgq - 1", "number_of_races": "CASE WHEN race < 2 THEN 0 ELSE 1 END", "two_or_more_races": "0"}


def _table(name: str) -> None:
    parts = redistricting(DOMAIN, name)
    each = [f"SELECT geolevel, geocode, '{q}' AS query, CAST({_ROWS[q.partition('_')[2]]} AS INTEGER) AS row, CAST(sum(n) AS BIGINT) AS n FROM axes WHERE {_CUTS[name]}{' AND race = 2' * q.endswith('two_or_more_races')} GROUP BY ALL" for q in parts]

    query(BASE + " UNION ALL ".join(each), f"table_{name}")(lambda spark, sf: answers(parts, hist(spark, sf), *KEYS))


for _name in _CUTS:
    _table(_name)


@query(" UNION ALL ".join(f"SELECT * FROM ({ORACLE_SQL[f'table_{n}']})" for n in _CUTS))
def table_pl94(spark, sf):
    return answers(pl94(DOMAIN), hist(spark, sf), *KEYS)


_SIX = Domain(("hhgq", "race"), (5, 6))
_EIGHT = Domain(("hhgq", "race"), (8, 7))


@query(BASE + "SELECT substring(geocode, 1, 4) AS nation, CAST(CASE WHEN race7 < 3 THEN 0 ELSE 1 END AS INTEGER) AS row, CAST(count(*) AS BIGINT) AS n FROM person WHERE race7 < 6 GROUP BY ALL")
def racecomb(spark, sf):
    rows = persons(spark, sf).where("race7 < 6").select(F.substring("geocode", 1, 4).alias("nation"), "hhgq", F.col("race7").alias("race"))
    return workload(_SIX)["racecomb"].answer(_SIX.histogram(rows, "nation"), "nation")


_EIGHT_SQL = BASE + ", e AS (SELECT substring(geocode, 1, 4) AS nation, (hhgq + race7) % 8 AS h, race7 FROM person) "


def _eight(spark: SparkSession, sf: str) -> DataFrame:
    rows = persons(spark, sf).select(F.substring("geocode", 1, 4).alias("nation"), ((F.col("hhgq") + F.col("race7")) % 8).cast("int").alias("hhgq"), F.col("race7").alias("race"))
    return _EIGHT.histogram(rows, "nation")


@query(_EIGHT_SQL + "SELECT nation, CAST(CASE WHEN h <= 4 THEN 0 ELSE 1 END AS INTEGER) AS row, CAST(count(*) AS BIGINT) AS n FROM e WHERE h > 0 GROUP BY ALL")
def inst_noninst(spark, sf):
    return workload(_EIGHT)["inst_noninst"].answer(_eight(spark, sf), "nation")


@query(_EIGHT_SQL + """SELECT nation, 'p1_number_of_races' AS query, CAST(CASE WHEN race7 < 3 THEN 0 WHEN race7 < 6 THEN 1 ELSE 2 END AS INTEGER) AS row, CAST(count(*) AS BIGINT) AS n FROM e GROUP BY ALL
UNION ALL SELECT nation, 'p1_two_or_more_races', 0, CAST(count(*) AS BIGINT) FROM e WHERE race7 >= 3 GROUP BY ALL""")
def table_p1_races(spark, sf):
    """The parts of the tables that need an axis of race combinations."""
    combos = Domain(("hhgq", "va", "hisp", "race"), (1, 1, 1, 7))
    parts = redistricting(combos, "p1")
    rows = persons(spark, sf).select(F.substring("geocode", 1, 4).alias("nation"), *(F.lit(0).alias(c) for c in ("hhgq", "va", "hisp")), F.col("race7").alias("race"))
    tall = combos.histogram(rows, "nation")
    names = ("p1_number_of_races", "p1_two_or_more_races")
    made = [parts[n].answer(tall, "nation").withColumn("query", F.lit(n)) for n in names]
    return made[0].unionByName(made[1])


# ---- invariants and constraints --------------------------------------------------------------------------------------


@query(BASE + """SELECT geolevel, geocode, 'tot' AS name, 0 AS idx, tot AS value FROM tots
UNION ALL SELECT geolevel, geocode, 'gqhh_vect', CAST(hhgq AS INTEGER), CAST(n AS BIGINT) FROM udense
UNION ALL SELECT geolevel, geocode, 'gq_vect', CAST(hhgq - 1 AS INTEGER), CAST(n AS BIGINT) FROM udense WHERE hhgq > 0
UNION ALL SELECT geolevel, geocode, 'gqhh_tot', 0, CAST(sum(n) AS BIGINT) FROM udense GROUP BY ALL""")
def invariants_tot_vect(spark, sf):
    return C.invariants(hist(spark, sf), unit_levels(spark, sf), 5, *KEYS)


_LB, _UB = "CASE WHEN units - v > 0 THEN v ELSE tot END", "CASE WHEN v > 0 THEN tot - (units - v) ELSE 0 END"
_BOUNDS = f"SELECT geolevel, geocode, CAST(hhgq AS INTEGER) AS row, 'hhgq_total_lb' AS cons, 'ge' AS sign, CAST({_LB} AS BIGINT) AS rhs FROM ut UNION ALL SELECT geolevel, geocode, CAST(hhgq AS INTEGER), 'hhgq_total_ub', 'le', CAST({_UB} AS BIGINT) FROM ut"


def all_bounds(spark: SparkSession, sf: str) -> DataFrame:
    return C.bounds(hist(spark, sf), unit_levels(spark, sf), 5, *KEYS)


@query(BASE + f"SELECT * FROM ({_BOUNDS}) WHERE sign = 'ge'")
def constraint_lb(spark, sf):
    return all_bounds(spark, sf).where("sign = 'ge'")


@query(BASE + f"SELECT * FROM ({_BOUNDS}) WHERE sign = 'le'")
def constraint_ub(spark, sf):
    return all_bounds(spark, sf).where("sign = 'le'")


@query(BASE + "SELECT geolevel, geocode, 'hhgq_total_ub' AS cons, CAST(hhgq AS INTEGER) AS row, 'le' AS sign, CAST(n * CASE hhgq WHEN 0 THEN 99 ELSE 99999 END AS BIGINT) AS rhs FROM udense")
def constraint_ub_capacity(spark, sf):
    return C.bounds_without_total(unit_levels(spark, sf), 5, *KEYS)


@query(BASE + f"SELECT 'root' AS geolevel, '0' AS geocode, cons, row, sign, CAST(sum(rhs) AS BIGINT) AS rhs FROM ({_BOUNDS}) WHERE geolevel = 'region' GROUP BY cons, row, sign")
def constraint_propagation(spark, sf):
    return C.carry_up(H, all_bounds(spark, sf), "region", "root")


@query(BASE + f"SELECT b.geolevel, b.geocode, cons, b.row, sign, rhs, coalesce(a.n, 0) AS n, CASE sign WHEN 'ge' THEN coalesce(a.n, 0) >= rhs ELSE coalesce(a.n, 0) <= rhs END AS ok FROM ({_BOUNDS}) b LEFT JOIN (SELECT geolevel, geocode, hhgq AS row, CAST(sum(n) AS BIGINT) AS n FROM axes GROUP BY ALL) a USING (geolevel, geocode, row)")
def constraint_check(spark, sf):
    return C.check(marginal(DOMAIN, "hhgq").answer(hist(spark, sf), *KEYS), all_bounds(spark, sf), *KEYS)


_UNION = """, sets AS (SELECT row_number() OVER (ORDER BY len(s), s) - 1 AS row, s FROM (SELECT list_sort([x FOR x IN [0, 1, 2, 3, 4] IF (m >> x) & 1 = 1]) AS s FROM (SELECT unnest(range(32)) AS m)) WHERE len(s) IN (2, 3, 4)),
uv AS (SELECT geolevel, geocode, row, sum(v) AS v, any_value(units) AS units, any_value(tot) AS tot FROM ut JOIN sets ON list_contains(s, hhgq) GROUP BY ALL)
"""


@query(BASE + _UNION + f"SELECT geolevel, geocode, CAST(row AS INTEGER) AS row, CAST({_LB} AS BIGINT) AS lb, CAST({_UB} AS BIGINT) AS ub FROM uv")
def union_constraint_bounds(spark, sf):
    return C.union_bounds(hist(spark, sf), unit_levels(spark, sf), 5, range(2, 5), *KEYS)


@query(BASE + f"""SELECT 'nation' AS geolevel, count(*) AS parents, CAST(coalesce(sum(bad), 0) AS BIGINT) AS backups FROM (
SELECT substring(b.geocode, 1, 2) AS g, max(0) AS z FROM ({_BOUNDS}) b WHERE geolevel = 'nation' GROUP BY 1) p JOIN (
SELECT g, max(CASE WHEN low > coalesce(n, 0) OR high < coalesce(n, 0) THEN 1 ELSE 0 END) AS bad FROM (
SELECT substring(geocode, 1, 2) AS g, row, sum(CASE sign WHEN 'ge' THEN rhs ELSE 0 END) AS low, sum(CASE sign WHEN 'le' THEN rhs ELSE 0 END) AS high FROM ({_BOUNDS}) WHERE geolevel = 'nation' GROUP BY ALL
) LEFT JOIN (SELECT geocode AS g, hhgq AS row, sum(n) AS n FROM axes WHERE geolevel = 'region' GROUP BY ALL) USING (g, row) GROUP BY g) USING (g)""")
def backup_solve_flags(spark, sf):
    parents = marginal(DOMAIN, "hhgq").answer(hist(spark, sf).where("geolevel = 'region'"), *KEYS)
    return E.backup_needed(all_bounds(spark, sf), parents, H, "nation")


# ---- noise and measurement -------------------------------------------------------------------------------------------

_GEO = lambda u, e, s=2.0: f"floor(ln(1 - greatest({u}, 2.0 ** -53)) / {N.math.log(1 - N.geometric_p(e, s))!r})"


@query(BASE + f"SELECT geolevel, geocode, CAST(cell AS INTEGER) AS cell, CAST({_GEO(_U("geolevel || '|' || geocode || '|' || cell || '|a'"), 0.5)} - {_GEO(_U("geolevel || '|' || geocode || '|' || cell || '|b'"), 0.5)} AS BIGINT) AS noise FROM hist")
def geometric_noise_hash(spark, sf):
    key = [F.col("geolevel"), F.col("geocode"), F.col("cell").cast("string")]
    u = [N.hash_uniform(*key, F.lit(x)) for x in "ab"]
    return hist(spark, sf).select(*KEYS, "cell", N.geometric(*u, 0.5, 2.0).alias("noise"))


_LAP = lambda u, b: f"CASE WHEN {u} < 0.5 THEN {b} * ln(2 * greatest({u}, 2.0 ** -53)) ELSE -({b}) * ln(2 - 2 * {u}) END"
_UH = _U("geocode || '|' || cell")


def _noise(sf_hist: DataFrame):
    return sf_hist, N.hash_uniform(F.col("geocode"), F.col("cell").cast("string"))


@query(BASE + f"SELECT geolevel, geocode, CAST(cell AS INTEGER) AS cell, round({_LAP(_UH, '2.0')}, 6) AS noise FROM hist")
def laplace_noise_hash(spark, sf):
    df, u = _noise(hist(spark, sf))
    return df.select(*KEYS, "cell", F.round(N.laplace(u, 2.0), 6).alias("noise"))


@query(BASE + f"SELECT geolevel, geocode, CAST(cell AS INTEGER) AS cell, round(n + greatest(n * 0.05, 1.0) * (2 / 0.4) * ({_LAP(_UH, '1.0')}), 6) AS v FROM hist")
def smooth_laplace(spark, sf):
    df, u = _noise(hist(spark, sf))
    return df.select(*KEYS, "cell", F.round(N.smooth_laplace(F.col("n"), F.col("n"), u, 0.05, 0.05, 0.4), 6).alias("v"))


@query(BASE + f"SELECT geolevel, geocode, CAST(cell AS INTEGER) AS cell, round(exp(ln(n + 20.0) + ({_LAP(_UH, repr(2 * N.math.log(1.05) / 0.4))})) - 20.0, 6) AS v FROM hist")
def log_laplace(spark, sf):
    df, u = _noise(hist(spark, sf))
    return df.select(*KEYS, "cell", F.round(N.log_laplace(F.col("n"), u, 0.05, 0.4), 6).alias("v"))


@query(BASE + f"SELECT geolevel, geocode, CAST(cell AS INTEGER) AS cell, round(n + ({_LAP(_UH, '1.0')}), 6) AS v FROM hist")
def laplace_dp(spark, sf):
    df, u = _noise(hist(spark, sf))
    return df.select(*KEYS, "cell", F.round(N.laplace_dp(F.col("n"), u, 2.0, 2.0), 6).alias("v"))


_TAIL = f"0.5 + (ln(1 + 2 * z * {N.math.sqrt(2)!r} / (z * z - z * {N.math.sqrt(2)!r} + 1)) / 2 + atan(z * {N.math.sqrt(2)!r} + 1) + atan(z * {N.math.sqrt(2)!r} - 1)) / {2 * N.math.pi!r}"


@query(BASE.replace("WITH geo", "WITH RECURSIVE geo", 1) + f""", half AS (SELECT geolevel, geocode, cell, n, {_UH} AS q, CAST(-1e6 AS DOUBLE) AS low, CAST(1e6 AS DOUBLE) AS high, 0 AS k FROM hist
UNION ALL SELECT geolevel, geocode, cell, n, q, CASE WHEN f < q THEN z ELSE low END, CASE WHEN f < q THEN high ELSE z END, k + 1 FROM (SELECT *, {_TAIL} AS f FROM (SELECT *, (low + high) / 2 AS z FROM half WHERE k < {N.HALVINGS})))
SELECT geolevel, geocode, CAST(cell AS INTEGER) AS cell, round(n + greatest(n * 0.05, 1.0) * {5 / (0.4 - 5 * N.math.log(1.05))!r} * (low + high) / 2, 6) AS v FROM half WHERE k = {N.HALVINGS}""")
def smooth_gamma(spark, sf):
    df, u = _noise(hist(spark, sf))
    return df.select(*KEYS, "cell", F.round(N.smooth_gamma(F.col("n"), F.col("n"), u, 0.05, 0.4), 6).alias("v"))


@query("SELECT o_custkey, CASE WHEN count(*) < 10 OR sum(o_totalprice) - max(o_totalprice) - coalesce(list_sort(list(o_totalprice), 'DESC')[2], 0) < 0.9 * max(o_totalprice) THEN 0 ELSE count(*) END AS v FROM orders GROUP BY 1")
def pub1075_suppression(spark, sf):
    top = F.row_number().over(Window.partitionBy("o_custkey").orderBy(F.col("o_totalprice").desc()))
    per = read(spark, sf, "orders").withColumn("r", top).groupBy("o_custkey").agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("total"), F.max("o_totalprice").alias("first"), F.coalesce(F.max(F.when(F.col("r") == 2, F.col("o_totalprice"))), F.lit(0.0)).alias("second"))
    return per.select("o_custkey", N.suppressed(F.col("n"), F.col("n"), F.col("total"), F.col("first"), F.col("second"), "state", 0.9).cast("long").alias("v"))


_P = N.geometric_p(0.5, 1.0)


@query(f"SELECT CAST(l_quantity - 25 AS BIGINT) AS k, count(*) AS n, round({_P / (2 - _P)!r} * pow({1 - _P!r}, abs(CAST(l_quantity - 25 AS BIGINT))), 9) AS p FROM lineitem GROUP BY 1")
def geometric_pmf_grid(spark, sf):
    """How likely the mechanism is to add what each quantity differs from 25."""
    k = (F.col("l_quantity") - 25).cast("long")
    return read(spark, sf, "lineitem").groupBy(k.alias("k")).agg(F.count("*").alias("n")).withColumn("p", F.round(N.geometric_pmf(F.col("k"), _P), 9))


@query(f"SELECT o_orderkey, CAST(CASE WHEN q < 0.5 THEN -a + 1 ELSE a + 1 END AS BIGINT) AS x FROM (SELECT o_orderkey, q, ceil(ln((CASE WHEN q > 0.5 THEN 1 - q ELSE q END) * {2 - _P!r}) / {N.math.log(1 - _P)!r}) - 1 AS a FROM (SELECT o_orderkey, (o_orderkey % 99 + 1) / 100.0 AS q FROM orders))")
def geometric_quantile_grid(spark, sf):
    """The mechanism's quantile at a share that each order's key gives."""
    return read(spark, sf, "orders").select("o_orderkey", N.geometric_quantile((F.col("o_orderkey") % 99 + 1) / 100, _P).alias("x"))


def _spent(spark: SparkSession, sf: str, rows: list[tuple], columns: str) -> DataFrame:
    """Budget rows of the levels with the number of units that each level's budget is spent on."""
    number = unit_levels(spark, sf).select(*KEYS).distinct().groupBy("geolevel").agg(F.count("*").alias("units"))
    return spark.createDataFrame(rows, columns).join(number, "geolevel")


_UNIT_COUNT = "(SELECT geolevel, count(*) AS units FROM ugeo GROUP BY 1)"


@query(BASE + "SELECT geolevel, query, epsilon, var, units FROM (" + " UNION ALL ".join(f"SELECT '{a}' AS geolevel, '{b}' AS query, round(CAST({e!r} AS DOUBLE), 9) AS epsilon, round(CAST({v!r} AS DOUBLE), 6) AS var" for a, b, e, v in BUDGET.rows()) + f") JOIN {_UNIT_COUNT} USING (geolevel)")
def budget_table(spark, sf):
    return _spent(spark, sf, BUDGET.rows(), "geolevel string, query string, epsilon double, var double").select("geolevel", "query", F.round("epsilon", 9).alias("epsilon"), F.round("var", 6).alias("var"), "units")


def _measured_sql() -> str:
    parts = []
    for level, name, epsilon, var in BUDGET.rows():
        size, row = {"detailed": (60, "cell"), "hhgq": (5, "hhgq"), "va_hisp_race": (12, "va * 6 + hisp * 3 + race")}[name]
        key = f"'{level}|' || geocode || '|{name}|' || row || '|"
        value = f"coalesce(n, 0) + {_GEO(_U(key + 'a' + chr(39)), epsilon)} - {_GEO(_U(key + 'b' + chr(39)), epsilon)}"
        parts.append(f"SELECT '{level}' AS geolevel, geocode, '{name}' AS query, CAST(row AS INTEGER) AS row, CAST({value} AS BIGINT) AS noisy, CAST({epsilon!r} AS DOUBLE) AS epsilon, CAST({var!r} AS DOUBLE) AS var FROM (SELECT geocode FROM ugeo WHERE geolevel = '{level}') CROSS JOIN (SELECT unnest(range({size})) AS row) LEFT JOIN (SELECT geocode, {row} AS row, CAST(sum(n) AS BIGINT) AS n FROM axes WHERE geolevel = '{level}' GROUP BY ALL) USING (geocode, row)")
    return " UNION ALL ".join(parts)


def measured(spark: SparkSession, sf: str) -> DataFrame:
    return E.measure(hist(spark, sf), unit_levels(spark, sf), DOMAIN, BUDGET, workload(DOMAIN))


@query(BASE + f"SELECT geolevel, geocode, query, row, noisy, round(epsilon, 9) AS epsilon, round(var, 6) AS var FROM ({_measured_sql()})")
def measurement_table(spark, sf):
    return measured(spark, sf).withColumns({"epsilon": F.round("epsilon", 9), "var": F.round("var", 6)})


# ---- estimates -------------------------------------------------------------------------------------------------------


def _pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Noisy nations with the exact values of their regions as totals."""
    noisy = measured(spark, sf).where("query = 'detailed' AND geolevel = 'nation'").select("geocode", F.col("row").alias("cell"), "noisy")
    above = hist(spark, sf).where("geolevel = 'region'").select(F.col("geocode").alias("parent"), "cell", F.col("n").alias("total"))
    return noisy.withColumn("parent", F.substring("geocode", 1, 2)).join(above, ["parent", "cell"])


def _project_sql(source: str, group: str, order: str) -> str:
    return f"""(SELECT * EXCLUDE (shift, theta), CASE WHEN total <= 0 THEN 0.0 ELSE greatest(noisy - last_value(theta IGNORE NULLS) OVER (PARTITION BY {group} ORDER BY noisy DESC, {order} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), 0.0) END AS l2
FROM (SELECT *, CASE WHEN noisy - shift > 0 THEN shift END AS theta FROM (SELECT *, (sum(noisy) OVER w - total) / row_number() OVER w AS shift FROM {source} WINDOW w AS (PARTITION BY {group} ORDER BY noisy DESC, {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))))"""


def _round_sql(source: str, group: str, order: str) -> str:
    return f"""(SELECT * EXCLUDE (whole, frac), CAST(whole + CASE WHEN row_number() OVER (PARTITION BY {group} ORDER BY frac DESC, {order}) <= total - sum(whole) OVER (PARTITION BY {group}) THEN 1 ELSE 0 END AS BIGINT) AS syn
FROM (SELECT *, floor(l2 + 1e-9) AS whole, round(l2 - floor(l2 + 1e-9), 9) AS frac FROM {source}))"""


_MEAS = BASE + f", measured AS ({_measured_sql()}), detail AS (SELECT geolevel, geocode, row AS cell, noisy FROM measured WHERE query = 'detailed')"
_PAIRS = ", pairs AS (SELECT p.geocode AS parent, d.geocode, d.cell, noisy, p.n AS total FROM detail d JOIN hist p ON p.geolevel = 'region' AND d.geolevel = 'nation' AND substring(d.geocode, 1, 2) = p.geocode AND d.cell = p.cell)"
_PROJECTED = _project_sql("pairs", "parent, cell", "geocode")


@query(_MEAS + _PAIRS + f"SELECT geocode, cell, round(l2, 6) AS l2 FROM {_PROJECTED}")
def simplex_projection(spark, sf):
    return E.project(_pairs(spark, sf), ["parent", "cell"], ["geocode"]).select("geocode", "cell", F.round("l2", 6).alias("l2"))


@query(_MEAS + _PAIRS + f"SELECT geocode, cell, syn FROM {_round_sql(_PROJECTED, 'parent, cell', 'geocode')}")
def parent_rounding_topk(spark, sf):
    return E.rounded_to(E.project(_pairs(spark, sf), ["parent", "cell"], ["geocode"]), ["parent", "cell"], ["geocode"]).select("geocode", "cell", "syn")


def _totals(spark: SparkSession, sf: str) -> DataFrame:
    return hist(spark, sf).where("geolevel = 'root'").groupBy(*KEYS).agg(F.sum("n").alias("n"))


def _top_down_sql() -> str:
    out = _MEAS + ", in_root AS (SELECT d.geolevel, d.geocode, d.cell, noisy, tot AS total FROM detail d JOIN tots t ON d.geolevel = 'root' AND t.geolevel = 'root')"
    out += f", at_root AS (SELECT geolevel, geocode, cell, l2, syn FROM {_round_sql(_project_sql('in_root', 'geocode', 'cell'), 'geocode', 'cell')})"
    for up, level, cut in (("root", "region", "'0'"), ("region", "nation", "substring(d.geocode, 1, 2)"), ("nation", "customer", "substring(d.geocode, 1, 4)")):
        out += f", in_{level} AS (SELECT d.geolevel, d.geocode, a.geocode AS parent, d.cell, noisy, a.syn AS total FROM detail d JOIN at_{up} a ON d.geolevel = '{level}' AND {cut} = a.geocode AND d.cell = a.cell)"
        out += f", at_{level} AS (SELECT geolevel, geocode, cell, l2, syn FROM {_round_sql(_project_sql(f'in_{level}', 'parent, cell', 'geocode'), 'parent, cell', 'geocode')})"
    return out


@query(_top_down_sql() + " UNION ALL ".join(f"SELECT geolevel, geocode, cell, syn FROM at_{x}" for x in H.levels))
def topdown_estimate(spark, sf):
    return E.top_down(measured(spark, sf), _totals(spark, sf), H, DOMAIN).drop("l2")


@query()
def topdown_estimate_queries(spark, sf):
    names = {q: workload(DOMAIN)[q] for q in BUDGET.queries}
    return E.top_down(measured(spark, sf), _totals(spark, sf), H, DOMAIN, names).withColumn("l2", F.round("l2", 6))


def _two_phase_sql() -> str:
    first = _top_down_sql().replace("FROM measured WHERE query = 'detailed'", "FROM measured WHERE query = 'hhgq'")
    held = "SELECT m.geocode, m.row AS cell, m.row // 12 AS hrow, noisy, a.syn AS total FROM measured m JOIN at_customer a ON m.query = 'detailed' AND m.geolevel = 'customer' AND a.geocode = m.geocode AND a.cell = m.row // 12"
    done = _round_sql(_project_sql("held", "geocode, hrow", "cell"), "geocode, hrow", "cell")
    return first + f", held AS ({held}), done AS (SELECT geocode, cell, syn FROM {done}) SELECT geolevel, CASE WHEN len = 1 THEN '0' ELSE substring(geocode, 1, len) END AS geocode, CAST(cell AS INTEGER) AS cell, CAST(sum(syn) AS BIGINT) AS syn FROM done, levels GROUP BY ALL"


@query(_two_phase_sql())
def two_phase_estimate(spark, sf):
    return E.two_phase(measured(spark, sf), _totals(spark, sf), H, DOMAIN, workload(DOMAIN)["hhgq"])


def set_bounds(spark: SparkSession, sf: str) -> DataFrame:
    return K.set_bounds(leaf(spark, sf), unit_hist(spark, sf), 5, H)


def constrained(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """(estimates, bounds)."""
    true, at = counted(spark, sf)
    own = lambda rows: rows.where(F.col("geolevel") == H.levels[0]).drop("geolevel")
    bounds = E.settle(K.set_bounds(own(true), own(at), 5, H))
    noisy = E.measure(true, bounds.select(*KEYS), DOMAIN, BUDGET, workload(DOMAIN))
    return K.constrained_top_down(noisy, bounds, H, DOMAIN, BUDGET, workload(DOMAIN)), bounds


_SET_V = " + ".join(f"CASE WHEN s >> {r} & 1 = 1 THEN u{r} ELSE 0 END" for r in range(5))
_SETS_SQL = f""", lu AS (SELECT geocode, {", ".join(f"CAST(sum(CASE WHEN hhgq = {r} THEN n ELSE 0 END) AS BIGINT) AS u{r}" for r in range(5))} FROM uhist WHERE hhgq < 5 GROUP BY 1),
ls AS (SELECT geocode, s, {_SET_V} AS v, u0 + u1 + u2 + u3 + u4 AS units, coalesce(tot, 0) AS tot FROM lu LEFT JOIN (SELECT geocode, tot FROM tots WHERE geolevel = 'customer') USING (geocode), (SELECT unnest(range(32)) AS s)),
sb AS (SELECT geolevel, CASE WHEN len = 1 THEN '0' ELSE substring(geocode, 1, len) END AS geocode, s, CAST(sum(CASE WHEN v > 0 THEN greatest(tot - (units - v), 0) ELSE 0 END) AS BIGINT) AS most FROM ls, levels GROUP BY ALL)
"""


@query(BASE + _SETS_SQL + "SELECT geolevel, geocode, CAST(s AS INTEGER) AS s, most FROM sb")
def constraint_set_bounds(spark, sf):
    return set_bounds(spark, sf).select(*KEYS, F.posexplode("most").alias("s", "most"))


@query()
def topdown_constrained(spark, sf):
    return constrained(spark, sf)[0]


_KINDS = "CASE len WHEN 5 THEN 'total' WHEN 1 THEN 'ub' WHEN 4 THEN 'lb' ELSE 'union' END"


@query(BASE + _SETS_SQL + f"SELECT geolevel, {_KINDS} AS cons, count(*) AS checked, CAST(0 AS BIGINT) AS failures FROM (SELECT geolevel, geocode, s, bit_count(s) AS len FROM sb WHERE s > 0) GROUP BY ALL")
def topdown_constrained_check(spark, sf):
    """The estimates break none of the totals and bounds that SQL counts."""
    return K.kept(*constrained(spark, sf), DOMAIN)


@query(BASE + "SELECT geolevel, CAST(0 AS BIGINT) AS slack FROM levels")
def topdown_constrained_slack(spark, sf):
    """No parent needs slack, as its bounds are the sums of its children's."""
    return K.slack_by_level(constrained(spark, sf)[0])


@query(BASE + "SELECT geolevel, geocode, CAST(sum(n) AS BIGINT) AS n FROM hist GROUP BY ALL")
def topdown_constrained_totals(spark, sf):
    """The estimates keep every unit's exact total."""
    return constrained(spark, sf)[0].groupBy(*KEYS).agg(F.sum("syn").cast("long").alias("n")).where("n > 0")


# the rules of two published configurations: quarters bounded at the leaves, totals exact at one upper level; the second has a structural zero
ZEROS = {"nurse_nva_0": LinearQuery(DOMAIN, "nurse_nva_0", subset={0: [3], 1: [0]}, over=(0, 1, 2, 3))}
_LEAF, _BOUNDED = ("gqhh_vect", "gqhh_tot"), ("hhgq_total_lb", "hhgq_total_ub")
RULES = {
    "1940": {"customer": T.Rule(_LEAF, _BOUNDED), "region": T.Rule(("tot",), ("total", *_BOUNDED))},
    "2018": {"customer": T.Rule(_LEAF, (*_BOUNDED, "nurse_nva_0")), "nation": T.Rule(("tot",), ("total", *_BOUNDED))},
}


def level_constraints(spark: SparkSession, sf: str, year: str) -> DataFrame:
    return T.level_constraints(hist(spark, sf), unit_levels(spark, sf), H, 5, RULES[year], tuple(ZEROS))


def _level_sql(year: str) -> str:
    """(geolevel, geocode, cons, row, sign, rhs): of each level's own counts, summed to the levels above up to the next that names the constraint."""
    upper, parts = {"1940": "region", "2018": "nation"}[year], []
    below = H.levels[: H.levels.index(upper)]
    spread = lambda source, levels: f"SELECT x.geolevel, CASE WHEN len = 1 THEN '0' ELSE substring(s.geocode, 1, len) END AS geocode, cons, row, sign, CAST(sum(rhs) AS BIGINT) AS rhs FROM ({source}) s, levels x WHERE x.geolevel IN ({', '.join(repr(v) for v in levels)}) GROUP BY ALL"
    free = "SELECT geocode, 'hhgq_total_lb' AS cons, CAST(hhgq AS INTEGER) AS row, 'ge' AS sign, v AS rhs FROM ut WHERE geolevel = 'customer' UNION ALL SELECT geocode, 'hhgq_total_ub', CAST(hhgq AS INTEGER), 'le', v * CASE hhgq WHEN 0 THEN 99 ELSE 99999 END FROM ut WHERE geolevel = 'customer'"
    parts.append(spread(free, below))
    parts.append(spread(f"SELECT geocode, cons, row, sign, rhs FROM ({_BOUNDS}) WHERE geolevel = '{upper}'", H.levels[len(below) :]))
    parts.append(spread(f"SELECT geocode, 'total' AS cons, 0 AS row, '=' AS sign, coalesce(tot, 0) AS rhs FROM ugeo LEFT JOIN tots USING (geolevel, geocode) WHERE geolevel = '{upper}'", H.levels[len(below) :]))
    if year == "2018":
        parts.append(spread("SELECT geocode, 'nurse_nva_0' AS cons, 0 AS row, '=' AS sign, 0 AS rhs FROM ugeo WHERE geolevel = 'customer'", H.levels))
    return " UNION ALL ".join(parts)


for _year in RULES:
    query(BASE + _level_sql(_year), f"level_constraints_{_year}")(lambda spark, sf, year=_year: level_constraints(spark, sf, year))


def by_levels(spark: SparkSession, sf: str, year: str) -> tuple[DataFrame, DataFrame, DataFrame, T.Constrained]:
    """(estimates, flags, right sides, constraints)."""
    queries = T.constraint_queries(DOMAIN, zeros=ZEROS if year == "2018" else None)
    sets = T.Constrained.of(DOMAIN, queries)
    rhs = E.settle(level_constraints(spark, sf, year))
    estimates, flags = T.top_down(measured(spark, sf), rhs, H, DOMAIN, BUDGET, workload(DOMAIN), sets)
    return estimates, flags, rhs, sets


_RHS_COUNT = "SELECT geolevel, cons, count(*) AS checked, CAST(0 AS BIGINT) AS failures FROM ({}) GROUP BY ALL"

for _year in RULES:
    query(BASE + _RHS_COUNT.format(_level_sql(_year)), f"topdown_levels_{_year}_check")(lambda spark, sf, year=_year: (lambda e, f, r, c: T.checked(e, r, c))(*by_levels(spark, sf, year)))


@query(BASE + "SELECT geolevel, geocode, tot AS n FROM tots WHERE geolevel IN ('region', 'root')")
def topdown_levels_totals(spark, sf):
    """Totals are exact from the level whose rule names them upwards."""
    return by_levels(spark, sf, "1940")[0].where("geolevel IN ('region', 'root')").groupBy(*KEYS).agg(F.sum("syn").cast("long").alias("n"))


@query(BASE + "SELECT geolevel, count(*) AS units, count(*) AS converged, CAST(0 AS BIGINT) AS slack FROM ugeo GROUP BY ALL")
def topdown_levels_residuals(spark, sf):
    """Both residuals of every unit's solve are below 1e-6, and no parent needs slack."""
    flags = by_levels(spark, sf, "1940")[1]
    return flags.groupBy("geolevel").agg(F.count("*").alias("units"), F.sum(((F.col("primal") < 1e-6) & (F.col("dual") < 1e-6)).cast("long")).alias("converged"), F.max("slack").alias("slack"))


@query()
def topdown_levels(spark, sf):
    return by_levels(spark, sf, "2018")[0]


def _clashing(spark: SparkSession, sf: str) -> DataFrame:
    """Bounds of nations that their regions can't keep: each has three quarters of its first category's persons at most, a ninth more of its second's at
    least, and customers none."""
    n = marginal(DOMAIN, "hhgq").answer(hist(spark, sf).where("geolevel = 'nation'"), *KEYS)
    most = n.where("row = 0").select(*KEYS, F.lit("hhgq_total_ub").alias("cons"), "row", F.lit("le").alias("sign"), F.expr("n * 3 div 4").alias("rhs"))
    least = n.where("row = 1").select(*KEYS, F.lit("hhgq_total_lb").alias("cons"), "row", F.lit("ge").alias("sign"), F.expr("n * 10 div 9").alias("rhs"))
    return most.unionByName(least)


_CLASH_SQL = """, cn AS (SELECT geolevel, geocode, hhgq AS row, CAST(sum(n) AS BIGINT) AS n FROM axes WHERE geolevel = 'nation' AND hhgq < 2 GROUP BY ALL),
cb AS (SELECT substring(geocode, 1, 2) AS geocode, sum(CASE row WHEN 0 THEN n - n * 3 // 4 ELSE 0 END) AS over, sum(CASE row WHEN 1 THEN n * 10 // 9 - n ELSE 0 END) AS short FROM cn GROUP BY 1)
SELECT geocode, CAST(over + short AS BIGINT) AS slack, over + short > 0 AS fallback"""


@query(BASE + _CLASH_SQL + " FROM cb")
def least_slack_of_regions(spark, sf):
    """Regions as they are under their nations' clashing bounds: what is over in one category and short in another."""
    sets = T.Constrained.of(DOMAIN, T.constraint_queries(DOMAIN))
    found = T.least_slacks(hist(spark, sf).where("geolevel = 'region'").drop("geolevel"), _clashing(spark, sf), "nation", H, sets)
    return found.select("geocode", "slack", (F.col("slack") > 0).alias("fallback"))


@query(BASE + _CLASH_SQL + ", TRUE AS near, TRUE AS bounded FROM cb")
def fallback_solve(spark, sf):
    """Nations estimated under regions as they are: the slack is the least, the whole numbers miss the regions by one more at most, and keep every bound."""
    sets = T.Constrained.of(DOMAIN, T.constraint_queries(DOMAIN))
    rhs = _clashing(spark, sf)
    above = hist(spark, sf).where("geolevel = 'region'").drop("geolevel")
    made = T.below(measured(spark, sf), rhs, above, "nation", H, DOMAIN, BUDGET, workload(DOMAIN), sets)
    cells = made.select("geocode", F.posexplode("x").alias("cell", "n")).groupBy(F.substring("geocode", 1, 2).alias("geocode"), "cell").agg(F.sum("n").alias("n"))
    miss = cells.join(above.withColumnRenamed("n", "goal"), ["geocode", "cell"], "full").groupBy("geocode").agg(F.sum(F.abs(F.coalesce("n", F.lit(0)) - F.coalesce("goal", F.lit(0)))).alias("miss"))
    kept = T.checked(made.select(*KEYS, F.posexplode("x").alias("cell", "syn")), rhs, sets).agg(F.sum("failures").alias("failures"))
    slack = made.groupBy(F.substring("geocode", 1, 2).alias("geocode")).agg(F.max("slack").alias("slack"))
    return slack.join(miss, "geocode").crossJoin(F.broadcast(kept)).select("geocode", "slack", (F.col("slack") > 0).alias("fallback"), (F.col("miss") <= F.col("slack") + 1).alias("near"), (F.col("failures") == 0).alias("bounded"))


HHGQ = Domain(("hhgq",), (5,))
MARGINAL = N.Budget(0.3, BUDGET.levels, 1.0, {})


def two_phases(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame, T.Constrained]:
    """(second phase's estimates, their flags, equality rows of the first phase, constraints): quarters alone under the rules of 1940, then all
    cells with every unit's quarters held at all levels."""
    true, at = counted(spark, sf)
    first = T.Constrained.of(HHGQ, T.constraint_queries(HHGQ))
    marginals = marginal(DOMAIN, "hhgq").answer(true, *KEYS).select(*KEYS, F.col("row").alias("cell"), F.col("n").cast("long").alias("n"))
    rules = T.level_constraints(true, at, H, 5, RULES["1940"])
    quarters, _ = T.top_down(E.measure(marginals, at, HHGQ, MARGINAL, {}), rules, H, HHGQ, MARGINAL, {}, first)
    held = E.settle(T.marginal_rows(quarters, marginal(HHGQ, "hhgq"), at))
    second = T.Constrained.of(DOMAIN, {"minSchema": marginal(DOMAIN, "hhgq")})
    noisy = E.measure(true, at, DOMAIN, BUDGET, workload(DOMAIN))
    estimates, flags = T.top_down(noisy, held, H, DOMAIN, BUDGET, workload(DOMAIN), second, kept="minSchema")
    return estimates, flags, held, second


@query(BASE + "SELECT geolevel, 'minSchema' AS cons, CAST(count(*) * 5 AS BIGINT) AS checked, CAST(0 AS BIGINT) AS failures FROM ugeo GROUP BY ALL")
def two_phase_levels_check(spark, sf):
    """The first phase's quarters hold in the second at every level."""
    estimates, _, held, sets = two_phases(spark, sf)
    return T.checked(estimates, held, sets)


@query(BASE + "SELECT geolevel, geocode, tot AS n FROM tots WHERE geolevel IN ('region', 'root')")
def two_phase_levels_totals(spark, sf):
    """The first phase's exact totals are the second's."""
    return two_phases(spark, sf)[0].where("geolevel IN ('region', 'root')").groupBy(*KEYS).agg(F.sum("syn").cast("long").alias("n"))


@query(BASE + "SELECT phase, geolevel, query, epsilon, var, units FROM (" + " UNION ALL ".join(f"SELECT {i + 1} AS phase, '{a}' AS geolevel, '{b}' AS query, round(CAST({e!r} AS DOUBLE), 9) AS epsilon, round(CAST({v!r} AS DOUBLE), 6) AS var" for i, rows in enumerate(N.phases(BUDGET, 0.3)) for a, b, e, v in rows) + f") JOIN {_UNIT_COUNT} USING (geolevel)")
def budget_phases(spark, sf):
    rows = [(i + 1, *r) for i, part in enumerate(N.phases(BUDGET, 0.3)) for r in part]
    return _spent(spark, sf, rows, "phase int, geolevel string, query string, epsilon double, var double").select("phase", "geolevel", "query", F.round("epsilon", 9).alias("epsilon"), F.round("var", 6).alias("var"), "units")


@query(BASE + "SELECT geolevel, geocode, CAST(cell AS INTEGER) AS cell, CAST(n AS DOUBLE) AS v FROM hist")
def noise_none(spark, sf):
    return hist(spark, sf).select(*KEYS, "cell", N.no_noise(F.col("n")).alias("v"))


# ---- synthetic records ------------------------------------------------------------------------------------------------

_UNITS = ", eu AS (SELECT geocode, hhgq, row_number() OVER (PARTITION BY geocode ORDER BY hhgq, i) - 1 AS unit, row_number() OVER (ORDER BY geocode, hhgq, i) - 1 AS euid FROM (SELECT geocode, hhgq, unnest(range(1, n + 1)) AS i FROM uhist))"
_PLACED = _UNITS + """, st AS (SELECT geocode, hhgq, n AS size, coalesce(sum(n) OVER (PARTITION BY geocode ORDER BY hhgq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM uhist),
pp AS (SELECT geocode, hhgq, cell, row_number() OVER (PARTITION BY geocode, hhgq ORDER BY cell, i) - 1 AS k FROM (SELECT geocode, cell // 12 AS hhgq, cell, unnest(range(1, n + 1)) AS i FROM leaf)),
placed AS (SELECT p.geocode, p.hhgq, cell, start + k % size AS unit, k // size AS person FROM pp p JOIN st USING (geocode, hhgq))"""


@query(BASE + _UNITS + "SELECT geocode, CAST(hhgq AS INTEGER) AS hhgq, unit, euid FROM eu")
def microdata_units(spark, sf):
    return D.units(unit_hist(spark, sf))


@query(BASE + _PLACED + "SELECT geocode, CAST(hhgq AS INTEGER) AS hhgq, CAST(cell AS INTEGER) AS cell, CAST(unit AS BIGINT) AS unit, CAST(person AS BIGINT) AS person FROM placed")
def microdata_persons(spark, sf):
    return D.persons(leaf(spark, sf), unit_hist(spark, sf), DOMAIN)


@query(BASE + _PLACED + """SELECT concat_ws('|', 'MPD1940', '3.1.4', substring(geocode, 1, 2), substring(geocode, 3, 4), substring(geocode, 7, 4), euid, person + 1, CASE WHEN p.hhgq = 0 THEN '3' ELSE '5' END, '99', '9',
CASE WHEN cell // 6 % 2 = 1 THEN '18' ELSE '17' END, cell // 3 % 2 + 1, cell % 3 + 1, '9999', '9999', '9999', '9999', '9999', '9999', '9999', '9999', '9999', '9') AS line FROM placed p JOIN eu USING (geocode, unit)""")
def person_lines(spark, sf):
    rows = D.persons(leaf(spark, sf), unit_hist(spark, sf), DOMAIN).join(D.units(unit_hist(spark, sf)).select("geocode", "unit", "euid"), ["geocode", "unit"])
    part = lambda a, n: F.substring("geocode", a, n)
    return rows.select(D.person_line_1940(part(1, 2), part(3, 4), part(7, 4), F.col("euid"), F.col("person"), F.col("hhgq"), DOMAIN.axis(1), DOMAIN.axis(2), DOMAIN.axis(3)).alias("line"))


@query(BASE + _PLACED + """SELECT concat_ws('|', 'MUD1940', '3.1.4', substring(geocode, 1, 2), substring(geocode, 3, 4), substring(geocode, 7, 4), euid, CASE WHEN h IN (0, 8) THEN '2' ELSE '4' END,
CASE WHEN h BETWEEN 1 AND 3 THEN h + 1 WHEN h BETWEEN 4 AND 7 THEN h + 2 ELSE 0 END, CASE WHEN h IN (0, 8) AND pop > 0 THEN '9' ELSE '0' END, CASE WHEN h IN (0, 8) AND pop = 0 THEN '9' ELSE '0' END, pop,
'9', '99', '99', '9', '9', '9', '999', '9', '99', '9', '99', '99', '99', '99') AS line
FROM (SELECT e.geocode, e.unit, euid, CASE WHEN e.hhgq = 5 THEN 8 ELSE e.hhgq END AS h, count(p.unit) AS pop FROM eu e LEFT JOIN placed p ON e.geocode = p.geocode AND e.unit = p.unit GROUP BY ALL)""")
def unit_lines(spark, sf):
    people = D.persons(leaf(spark, sf), unit_hist(spark, sf), DOMAIN)
    rows = D.final_population(D.units(unit_hist(spark, sf)), people).withColumn("h", F.when(F.col("hhgq") == 5, 8).otherwise(F.col("hhgq")))
    part = lambda a, n: F.substring("geocode", a, n)
    return rows.select(D.unit_line_1940(part(1, 2), part(3, 4), part(7, 4), F.col("euid"), F.col("h"), F.col("pop")).alias("line"))


@query(BASE + "SELECT concat_ws('|', geocode, hhgq, va, hisp, race) AS line FROM (SELECT *, unnest(range(n)) FROM axes WHERE geolevel = 'customer')")
def plain_microdata(spark, sf):
    return expand(leaf(spark, sf)).select(D.plain_line(DOMAIN).alias("line"))


# ---- metrics and validation -------------------------------------------------------------------------------------------

_EST = BASE + f", est AS (SELECT geolevel, geocode, cell, n AS c1, greatest(0, n + CAST(floor({_U("geolevel || '|' || geocode || '|' || cell")} * 5) AS BIGINT) - 2) AS c2 FROM hist)"
_D = "c2 - c1"


def paired(spark: SparkSession, sf: str) -> DataFrame:
    true, n = hist(spark, sf), tasks(spark, sf)
    both = M.paired(*(x.repartition(n, *KEYS, "cell") for x in (true, estimate(true, *KEYS))), *KEYS)
    return both.repartition(n, *KEYS)


_UNIT_METRICS = f"""SELECT geolevel, geocode, 1 AS geoCount, CAST(sum(abs({_D})) AS BIGINT) AS L1_geounit, round(sum(abs({_D})) / nullif(sum(c2), 0), 6) AS avgL1_geounit, round(sqrt(sum(({_D}) * ({_D}))), 6) AS L2_geounit,
round(sqrt(sum(({_D}) * ({_D}))) / nullif(sum(c2), 0), 6) AS avgL2_geounit, round(sum(abs({_D}) / (10 + c1)), 6) AS relL1_geounit, round(sum(({_D}) * ({_D}) / (10 + c1)), 6) AS relL2_geounit, CAST(max(abs({_D})) AS BIGINT) AS LInf_geounit,
CAST(max({_D}) AS BIGINT) AS LInf_signed, round(max(abs({_D})) / nullif(sum(c2), 0), 6) AS avgLInf_geounit, round(0.5 * sum(abs({_D})) / nullif(sum(c1), 0), 6) AS tvd_geounit, CAST(sum(c1) AS BIGINT) AS tot_pop_geounit,
60 - count(*) FILTER (c2 <> 0) AS sparsity_geounit, 60 - count(*) FILTER (c1 <> 0) AS true_sparsity_geounit FROM est GROUP BY ALL"""


@query(_EST + _UNIT_METRICS)
def error_metrics_geounit(spark, sf):
    return M.rounded(M.geounits(paired(spark, sf), DOMAIN, *KEYS))


@query(_EST + f"SELECT geolevel, geocode, CAST(cell AS INTEGER) AS cell, abs({_D}) AS L1_cell, round(abs({_D}) / (10 + c1), 6) AS relL1_cell FROM est")
def error_metrics_cell(spark, sf):
    return M.rounded(M.cells(paired(spark, sf), *KEYS))


@query(_EST + f"SELECT geolevel, geocode, CAST(cell // 12 AS INTEGER) AS hhgq, CAST(cell // 6 % 2 AS INTEGER) AS va, CAST(sum(c1) AS BIGINT) AS c1, CAST(sum(c2) AS BIGINT) AS c2, CAST(abs(sum(c2) - sum(c1)) AS BIGINT) AS L1 FROM est GROUP BY ALL")
def error_metrics_marg(spark, sf):
    return M.marginals(paired(spark, sf), DOMAIN, ["hhgq", "va"], *KEYS)


_LONG = f", um AS ({_UNIT_METRICS}), lm AS (SELECT geolevel, geocode, unnest(['L1_geounit', 'tvd_geounit', 'LInf_geounit']) AS metric, unnest([CAST(L1_geounit AS DOUBLE), tvd_geounit, CAST(LInf_geounit AS DOUBLE)]) AS value FROM um)"


def metric_rows(spark: SparkSession, sf: str) -> DataFrame:
    return M.long(M.rounded(M.geounits(paired(spark, sf), DOMAIN, *KEYS)), ["L1_geounit", "tvd_geounit", "LInf_geounit"], *KEYS)


@query(_EST + _LONG + "SELECT geolevel, metric, 'sum' AS aggtype, round(sum(value), 4) AS value FROM lm GROUP BY ALL UNION ALL SELECT geolevel, metric, 'avg', round(avg(value), 4) FROM lm GROUP BY ALL")
def metrics_sum_avg(spark, sf):
    rows = metric_rows(spark, sf)
    return M.rounded(M.summary(rows, "sum", "geolevel").unionByName(M.summary(rows, "avg", "geolevel")), 4)


@query(_EST + _LONG + ", q AS (SELECT geolevel, metric, quantile_cont(value, [0.1, 0.5, 0.9]) AS v FROM lm GROUP BY ALL) SELECT geolevel, metric, CAST(unnest([0.1, 0.5, 0.9]) AS DOUBLE) AS quantile, round(unnest(v), 6) AS value FROM q")
def metrics_quantiles(spark, sf):
    return M.rounded(M.quantiles(metric_rows(spark, sf), [0.1, 0.5, 0.9], read(spark, sf, "customer").count(), "geolevel"))


@query(_EST + _LONG + "SELECT geolevel, metric, string_agg(geocode || '=' || CAST(CAST(value AS BIGINT) AS VARCHAR), ',' ORDER BY geocode) AS units FROM lm WHERE metric <> 'tvd_geounit' GROUP BY ALL")
def metrics_collect(spark, sf):
    rows = M.collected(metric_rows(spark, sf).where("metric <> 'tvd_geounit'"), "geolevel")
    line = F.array_join(F.transform("units", lambda u: F.concat(u["geocode"], F.lit("="), u["value"].cast("long").cast("string"))), ",")
    return rows.select("geolevel", "metric", line.alias("units"))


@query(_EST + f"SELECT CAST(sum(abs({_D})) AS BIGINT) AS l1, CAST(sum(c1) AS BIGINT) AS n FROM est WHERE geolevel = 'customer'")
def total_l1(spark, sf):
    return M.total_l1(paired(spark, sf).where("geolevel = 'customer'"))


@query(_EST + f", t AS (SELECT sum(abs({_D})) AS l1, sum(c1) AS n FROM est WHERE geolevel = 'customer'), z AS (SELECT CAST(l1 + {_GEO(_U("'l1|a'"), 0.1)} - {_GEO(_U("'l1|b'"), 0.1)} AS BIGINT) AS noisy_l1, n FROM t) SELECT noisy_l1, CAST(noisy_l1 + ceil(ln(0.1 * {2 - N.geometric_p(0.1, 2.0)!r}) / {N.math.log(1 - N.geometric_p(0.1, 2.0))!r}) AS BIGINT) AS upper, round(noisy_l1 / (2 * n), 6) AS relative FROM z")
def protected_total_l1(spark, sf):
    u = [N.hash_uniform(F.lit("l1"), F.lit(x)) for x in "ab"]
    return M.rounded(V.protected_l1(M.total_l1(paired(spark, sf).where("geolevel = 'customer'")), *u, 0.1, 2.0, 0.9))


@query(BASE + """SELECT 'c1' AS "check", CAST((SELECT count(*) FROM lineitem) AS BIGINT) AS expected, CAST((SELECT sum(n) FROM leaf) AS BIGINT) AS actual, CAST((SELECT count(*) FROM lineitem) <> (SELECT sum(n) FROM leaf) AS BIGINT) AS failures
UNION ALL SELECT 'c3', (SELECT count(*) FROM orders), (SELECT CAST(sum(n) AS BIGINT) FROM uhist), 0
UNION ALL SELECT 'c4', (SELECT count(DISTINCT l_orderkey) FROM lineitem), (SELECT CAST(sum(n) AS BIGINT) FROM uhist WHERE hhgq < 5), 0
UNION ALL SELECT 'c5', (SELECT count(*) FROM unit WHERE hhgq > 0 AND o_orderkey IN (SELECT l_orderkey FROM lineitem)), (SELECT CAST(sum(n) AS BIGINT) FROM uhist WHERE hhgq BETWEEN 1 AND 4), 0""")
def invariants_c1_c5(spark, sf):
    u, made = units(spark, sf), D.units(unit_hist(spark, sf))
    used = read(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    lived = u.join(used, "o_orderkey", "left_semi")
    count = lambda df, *k: df.groupBy(*k).agg(F.count("*").alias("n"))
    one = F.lit("all").alias("k")
    parts = [
        V.same_counts(count(read(spark, sf, "lineitem").select(one), "k"), expand(leaf(spark, sf)).select(one).groupBy("k").agg(F.count("*").alias("n")), "c1", "k"),
        V.same_counts(count(u, "geocode"), count(made, "geocode"), "c3", "geocode"),
        V.same_counts(count(lived, "geocode"), count(made.where("hhgq < 5"), "geocode"), "c4", "geocode"),
        V.same_counts(count(lived.where("hhgq > 0"), "geocode", "hhgq"), count(made.where("hhgq BETWEEN 1 AND 4"), "geocode", "hhgq"), "c5", "geocode", "hhgq"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("SELECT count(*) AS children, count(*) FILTER (l_orderkey IN (SELECT o_orderkey FROM orders)) AS matched, count(*) FILTER (l_orderkey NOT IN (SELECT o_orderkey FROM orders)) AS orphans FROM lineitem")
def key_integrity(spark, sf):
    return V.key_integrity(read(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k")), read(spark, sf, "orders").select(F.col("o_orderkey").alias("k")), "k")


@query("SELECT 'l_quantity' AS variable, count(*) FILTER (NOT (CAST(l_quantity AS BIGINT) BETWEEN 1 AND 10 OR CAST(l_quantity AS BIGINT) BETWEEN 20 AND 50)) AS failures FROM lineitem UNION ALL SELECT 'l_returnflag', count(*) FILTER (NOT (l_returnflag BETWEEN 'A' AND 'N' AND length(l_returnflag) = 1)) FROM lineitem")
def legal_value_violations(spark, sf):
    checks = {"l_quantity": V.legal(F.col("l_quantity"), "1-10,20-50"), "l_returnflag": V.legal(F.col("l_returnflag"), "A-N", "str")}
    return V.violations(read(spark, sf, "lineitem").select("l_quantity", "l_returnflag"), checks)


@query("SELECT p_size, lpad(CAST(p_size AS VARCHAR), 3, ' ') BETWEEN '  5' AND ' 30' AS ok, count(*) AS n FROM part GROUP BY ALL")
def left_padded_range_check(spark, sf):
    p = read(spark, sf, "part").select("p_size").withColumn("ok", V.padded_between(F.col("p_size").cast("string"), "5", "30", 3))
    return p.groupBy("p_size", "ok").agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, concat_ws(', ', CASE WHEN NOT o_orderstatus IN ('F', 'O') THEN 'o_orderstatus (' || o_orderstatus || ') out of range' END, CASE WHEN NOT substring(o_orderpriority, 1, 1) BETWEEN '1' AND '4' THEN 'o_orderpriority (' || o_orderpriority || ') out of range' END) AS reason FROM orders")
def validate_reasons(spark, sf):
    checks = {"o_orderstatus": F.col("o_orderstatus").isin("F", "O"), "o_orderpriority": F.substring("o_orderpriority", 1, 1).between("1", "4")}
    return read(spark, sf, "orders").select("o_orderkey", V.reasons(checks).alias("reason"))


_CODE16 = "('00000' || geocode)"
_PL18 = "concat_ws('|', 'MPD', '3.1.4', substring({g}, 1, 2), substring({g}, 3, 3), substring({g}, 6, 6), substring({g}, 12, 1), substring({g}, 13, 4), euid, person + 1, CASE WHEN p.hhgq = 0 THEN '3' ELSE '5' END, '99', '9', CASE WHEN cell // 6 % 2 = 0 THEN '17' ELSE '18' END, cell // 3 % 2 + 1, lpad(CAST(cell % 3 + 1 AS VARCHAR), 2, '0'), '9999', '9999', '9999', '9999', '9999', '9999', '9999', '9999', '9999', '9')".format(g=_CODE16)


@query(BASE + _PLACED + f"SELECT {_PL18} AS value FROM placed p JOIN eu USING (geocode, unit)")
def person_lines_2018(spark, sf):
    made = D.units(unit_hist(spark, sf)).select("geocode", "unit", "euid")
    rows = D.persons(leaf(spark, sf), unit_hist(spark, sf), DOMAIN).join(made, ["geocode", "unit"])
    axes = [DOMAIN.axis(k) for k in (1, 2, 3)]
    return rows.select(D.person_line_2018(F.concat(F.lit("00000"), "geocode"), F.col("euid"), F.col("person"), F.col("hhgq"), *axes).alias("value"))


_UL18 = "concat_ws('|', 'MUD', '3.1.4', substring({g}, 1, 2), substring({g}, 3, 3), substring({g}, 6, 6), substring({g}, 12, 1), substring({g}, 13, 4), euid, CASE WHEN hhgq IN (0, 8) THEN '2' ELSE '4' END, CASE WHEN hhgq IN (0, 8) THEN '000' ELSE CAST(hhgq * 100 + 1 AS VARCHAR) END, CASE WHEN hhgq IN (0, 8) AND pop > 0 THEN '9' ELSE '0' END, CASE WHEN hhgq IN (0, 8) AND pop = 0 THEN '9' ELSE '0' END, pop, '9', '99', '99', '9', '9', '9', '999', '9', '99', '9', '99', '99', '99', '99')".format(g=_CODE16)


@query(BASE + _PLACED + f", pops AS (SELECT geocode, unit, count(*) AS pop FROM placed GROUP BY ALL) SELECT {_UL18} AS value FROM (SELECT geocode, CASE WHEN hhgq = 5 THEN 8 ELSE hhgq END AS hhgq, euid, coalesce(pop, 0) AS pop FROM eu LEFT JOIN pops USING (geocode, unit))")
def unit_lines_2018(spark, sf):
    made = D.units(unit_hist(spark, sf))
    rows = D.final_population(made, D.persons(leaf(spark, sf), unit_hist(spark, sf), DOMAIN))
    kind = F.when(F.col("hhgq") == 5, 8).otherwise(F.col("hhgq"))
    return rows.select(D.unit_line_2018(F.concat(F.lit("00000"), "geocode"), F.col("euid"), kind, F.col("pop")).alias("value"))


# ---- recodes, sources, migration ---------------------------------------------------------------------------------------


@query("SELECT l_orderkey, l_linenumber, CASE (CAST(l_quantity > 25 AS INTEGER) * 4 + CAST(l_discount > 0.05 AS INTEGER) * 2 + CAST(l_tax > 0.04 AS INTEGER)) WHEN 4 THEN 0 WHEN 2 THEN 1 WHEN 1 THEN 2 WHEN 6 THEN 3 WHEN 5 THEN 4 WHEN 3 THEN 5 WHEN 7 THEN 6 ELSE -1 END AS combo FROM lineitem")
def race_combination_recode(spark, sf):
    flags = [(F.col("l_quantity") > 25).cast("int"), (F.col("l_discount") > 0.05).cast("int"), (F.col("l_tax") > 0.04).cast("int")]
    return read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.coalesce(R.race_combination(flags), F.lit(-1)).alias("combo"))


@query("SELECT p_partkey, CASE WHEN p_size % 10 < 7 THEN p_size % 10 ELSE 7 END AS gq18, CASE WHEN p_size % 10 BETWEEN 2 AND 4 THEN -1 WHEN p_size % 10 BETWEEN 6 AND 9 THEN -2 ELSE p_size % 10 END AS gq40, CASE p_size % 17 WHEN 16 THEN 2 WHEN 15 THEN 1 ELSE 0 END AS rel, CAST(p_size >= 18 AS INTEGER) AS va FROM part")
def scalar_recodes(spark, sf):
    size = F.col("p_size")
    return read(spark, sf, "part").select("p_partkey", R.quarters_2018(F.lpad((size % 10 * 100).cast("string"), 3, "0")).alias("gq18"), R.quarters_1940(size % 10).alias("gq40"), R.relation_quarters(size % 17).alias("rel"), R.voting_age(size).alias("va"))


@query("SELECT o_orderkey, CASE WHEN CAST(substring(o_orderpriority, 1, 1) AS INTEGER) BETWEEN 2 AND 4 THEN -1 ELSE CAST(substring(o_orderpriority, 1, 1) AS INTEGER) END AS gq, CAST(floor(o_totalprice) AS BIGINT) AS price, CAST(o_orderstatus || o_orderpriority AS VARCHAR) AS code FROM orders")
def recode_steps(spark, sf):
    rows = read(spark, sf, "orders").withColumn("digit", F.substring("o_orderpriority", 1, 1)).withColumn("text", F.concat(F.lit(" '"), F.floor("o_totalprice").cast("string"), F.lit(".00' ")))
    made = R.recoded(rows, {"number": "int(digit)", "gq": "quarters_1940(number)", "price": "clean_int(text)", "code": "geocode(o_orderstatus, o_orderpriority)"})
    return made.select("o_orderkey", F.col("gq").cast("int").alias("gq"), "price", "code")


@query("""SELECT p_partkey, p_size BETWEEN 1 AND 20 OR p_size BETWEEN 41 AND 50 AS ints, p_retailprice BETWEEN 900.5 AND 1500.25 AS floats, lpad(CAST(p_size AS VARCHAR), 3, ' ') BETWEEN '  5' AND ' 30' AS strings,
  p_size % 7 = 0 AS blanks, true AS whatever FROM part""")
def validate_ranges(spark, sf):
    size = F.col("p_size").cast("string")
    blank = F.when(F.col("p_size") % 7 == 0, F.lit("  ")).otherwise(size)
    return read(spark, sf, "part").select(
        "p_partkey", V.in_ranges(size, [("1", "10"), ("11", "20"), ("41", "50")], "int").alias("ints"), V.in_ranges(F.col("p_retailprice").cast("string"), [("900.5", "1500.25")], "float").alias("floats"),
        V.in_ranges(size, [("5", "30")], "string", 3).alias("strings"), V.in_ranges(blank, [("NULL", "")], "int").alias("blanks"), V.in_ranges(size, [("N/A", "")], "int").alias("whatever"),
    )


FIELDS = [layout.Field("c_custkey", 1, 9, "long"), layout.Field("c_name", 9, 29), layout.Field("c_nationkey", 30, 33, "long"), layout.Field("c_mktsegment", 33, 43)]


@query("SELECT CAST(c_custkey AS BIGINT) AS c_custkey, rpad(c_name, 20, ' ') AS c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, rpad(c_mktsegment, 10, ' ') AS c_mktsegment FROM customer")
def fixed_width_roundtrip(spark, sf):
    lines = read(spark, sf, "customer").select(F.concat(F.lit("C"), F.substring(layout.join_fixed(FIELDS), 2, 42)).alias("value"))
    return layout.cut(lines, FIELDS, "C")


@query("SELECT 'H' AS tag, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS s FROM orders UNION ALL SELECT 'P', count(*), CAST(sum(l_orderkey) AS BIGINT) FROM lineitem")
def hierarchical_records(spark, sf):
    key = lambda c: F.lpad(F.col(c).cast("string"), 10, "0")
    lines = read(spark, sf, "orders").select(F.concat(F.lit("H"), key("o_orderkey")).alias("value")).unionByName(read(spark, sf, "lineitem").select(F.concat(F.lit("P"), key("l_orderkey")).alias("value")))
    cut = [layout.Field("tag", 0, 1), layout.Field("serial", 1, 11, "long")]
    return layout.cut(lines, cut).groupBy("tag").agg(F.count("*").alias("n"), F.sum("serial").alias("s"))


@query("SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name AS name, CAST(s_nationkey AS VARCHAR) AS nation FROM supplier")
def pipe_parse(spark, sf):
    lines = read(spark, sf, "supplier").select(F.concat_ws("|", F.col("s_suppkey").cast("string"), "s_name", F.col("s_nationkey").cast("string")).alias("value"))
    return layout.delimited(lines.unionByName(spark.createDataFrame([("# comment",)], "value string")), ["id", "name", "nation"])


@query("""SELECT 'o_orderkey' AS variable, count(*) AS n, count(DISTINCT o_orderkey) AS uniques, CAST(min(o_orderkey) AS VARCHAR) AS low, CAST(max(o_orderkey) AS VARCHAR) AS high, CAST(sum(o_orderkey) AS DOUBLE) AS total, CAST(sum(o_orderkey * o_orderkey) AS DOUBLE) AS squares, round(avg(o_orderkey), 4) AS mean FROM orders
UNION ALL SELECT 'o_orderstatus', count(*), count(DISTINCT o_orderstatus), min(o_orderstatus), max(o_orderstatus), NULL, NULL, NULL FROM orders""")
def single_variable_stats(spark, sf):
    return M.rounded(etl.statistics(read(spark, sf, "orders").select("o_orderkey", "o_orderstatus")), 4)


@query("SELECT CAST(sum(1995 + 3 * l_linenumber + 5 * l_suppkey + 7 * (l_partkey % 2) + 11 * CAST(l_quantity AS BIGINT) + 13 * (l_orderkey % 6)) AS BIGINT) AS checksum FROM lineitem")
def record_checksum(spark, sf):
    rows = read(spark, sf, "lineitem").select(F.lit(1995).alias("y"), "l_linenumber", "l_suppkey", (F.col("l_partkey") % 2).alias("sex"), F.col("l_quantity").cast("long").alias("age"), (F.col("l_orderkey") % 6).alias("race"))
    return etl.checksum(rows, {"YEAR": "y", "PERNUM": "l_linenumber", "RELATE": "l_suppkey", "SEX": "sex", "AGE": "age", "RACE": "race"})


@query("SELECT s_suppkey, s_nationkey AS n_nationkey, n_name, n_regionkey FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey")
def lookup_join(spark, sf):
    s = read(spark, sf, "supplier").select("s_suppkey", F.col("s_nationkey").alias("n_nationkey"))
    return etl.lookup(s, read(spark, sf, "nation"), "n_nationkey", ["n_name", "n_regionkey"])


@query("SELECT 'MIG' AS tag, o_orderkey * 2 AS id, upper(o_orderstatus) AS status, 7 AS version FROM orders WHERE o_totalprice > 100000")
def migrate_records(spark, sf):
    return etl.migrate(read(spark, sf, "orders"), {"id": "o_orderkey * 2", "status": "upper(o_orderstatus)"}, {"tag": "MIG", "version": 1}, {"version": 7}, "o_totalprice > 100000").select("tag", "id", "status", "version")


# ---- tables by SQL ------------------------------------------------------------------------------------------------------

_PRE = {
    "byflag": "SELECT l_returnflag AS flag, l_linestatus AS status, count(*) AS cnt, CAST(sum(l_quantity) AS BIGINT) AS qty, CAST(max(l_quantity) AS BIGINT) AS ssmax FROM inputtable GROUP BY l_returnflag, l_linestatus",
    "byline": "SELECT l_linenumber AS line, count(*) AS cnt FROM inputtable GROUP BY l_linenumber",
}
_OUT = {"rates": "SELECT flag, sum(qty) / sum(cnt) AS rate, sum(cnt) AS cnt FROM byflag GROUP BY flag", "lines": "SELECT line, cnt FROM byline WHERE line <= 4"}


def noisy_tables(spark: SparkSession, sf: str) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    lap = lambda e: lambda v, u: N.laplace_dp(v, u, e)
    plan = NoisyTables(_PRE, {"byflag": [[Noise("cnt", lap(0.4), 0.4)], [Noise("qty", lap(0.4), 0.4)]], "byline": [[Noise("cnt", lap(0.4), 0.4)]]}, _OUT, {"byflag": ["flag", "status"], "byline": ["line"]}, 1.2)
    return plan.run(spark, {"inputtable": read(spark, sf, "lineitem")})


_SQL_PRE = ", ".join(f"{k} AS ({v})" for k, v in _PRE.items()).replace("inputtable", "lineitem")
_SQL_NOISY = f"""WITH byflag0 AS ({_PRE["byflag"]}), byline0 AS ({_PRE["byline"]}),
byflag AS (SELECT flag, status, cnt + ({_LAP(_U("'byflag|cnt|' || flag || '|' || status"), "2.5")}) AS cnt, qty + ({_LAP(_U("'byflag|qty|' || flag || '|' || status"), "2.5")}) AS qty FROM byflag0),
byline AS (SELECT line, cnt + ({_LAP(_U("'byline|cnt|' || line"), "2.5")}) AS cnt FROM byline0) """.replace("inputtable", "lineitem")


@query(_PRE["byflag"].replace("inputtable", "lineitem"))
def sql_prenoise_tables(spark, sf):
    read(spark, sf, "lineitem").createOrReplaceTempView("inputtable")
    return spark.sql(_PRE["byflag"])


@query(f"WITH {_SQL_PRE} SELECT flag, round(rate, 6) AS rate, CAST(cnt AS BIGINT) AS cnt FROM ({_OUT['rates']})")
def sql_output_tables(spark, sf):
    return M.rounded(noisy_tables(spark, sf)[0]["rates"])


@query(_SQL_NOISY + f"SELECT flag, round(rate, 6) AS rate, round(cnt, 6) AS cnt FROM ({_OUT['rates']})")
def sql_noisy_output(spark, sf):
    return M.rounded(noisy_tables(spark, sf)[1]["rates"])


@query(_SQL_NOISY + f"SELECT line, round(cnt, 6) AS cnt FROM ({_OUT['lines']})")
def sql_noisy_filtered(spark, sf):
    return M.rounded(noisy_tables(spark, sf)[1]["lines"])


@query("SELECT o_orderstatus AS status, round(0.5 * (sum(o_totalprice) + max(o_totalprice)), 2) AS denom, round(sum(o_totalprice) / nullif(count(*), 0), 6) AS rate FROM orders GROUP BY 1")
def sql_derived_rates(spark, sf):
    from stratum.plans.sqltables import register_functions

    register_functions(spark)
    per = read(spark, sf, "orders").groupBy(F.col("o_orderstatus").alias("status")).agg(F.sum("o_totalprice").alias("s"), F.max("o_totalprice").alias("m"), F.count("*").cast("double").alias("n"))
    return per.select("status", F.expr("round(denom(s, m), 2)").alias("denom"), F.expr("round(rate(s, n), 6)").alias("rate"))


@query("SELECT coalesce(CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END, 'NA') AS status, round(max(o_totalprice), 2) AS price, count(o_orderkey) AS orders FROM orders GROUP BY 1")
def na_fill_group_total(spark, sf):
    rows = read(spark, sf, "orders").select(F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status"), "o_orderpriority", F.col("o_totalprice").alias("price"), F.col("o_orderkey").alias("orders"))
    return regrouped(rows, ["o_orderpriority"], {"price": "max", "orders": "count"}, ["status", "o_orderpriority"]).withColumn("price", F.round("price", 2))


# ---- random records ---------------------------------------------------------------------------------------------------

LEGAL = {"AGE": "0-99,999", "SEX": "1-2,9", "GRADE": "A-F,P"}


@query(f"SELECT o_orderkey, CASE WHEN a < 100 THEN a ELSE 999 END AS AGE, CASE WHEN x < 2 THEN x + 1 ELSE 9 END AS SEX, substring('ABCDEFP', g + 1, 1) AS GRADE FROM (SELECT o_orderkey, {', '.join(f"""CAST(floor({_U(f"'1|{v}|' || o_orderkey")} * {n}) AS BIGINT) AS {c}""" for v, n, c in (("AGE", 101, "a"), ("SEX", 3, "x"), ("GRADE", 7, "g")))} FROM orders)")
def random_records(spark, sf):
    """A record of legal values for every order."""
    return etl.random_records(read(spark, sf, "orders"), LEGAL, key="o_orderkey")
