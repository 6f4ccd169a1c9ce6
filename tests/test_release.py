"""Record layouts, recodes that refuse bad fields, linear queries by factors, constrained estimates and a whole release."""

import configparser
import itertools
import json
import math
import sqlite3

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from stratum.functions import noise as N
from stratum.functions import recode as R
from stratum.operators import constrained as K
from stratum.operators import microdata as D
from stratum.operators import validate as V
from stratum.operators.estimate import couple, measure
from stratum.operators.hierarchy import Hierarchy
from stratum.operators.histogram import Domain, expand
from stratum.operators.linear import KroneckerQuery, LinearQuery, check_shape, marginal, reduced, stacked
from stratum.operators.workload import pl94, table, workload
from stratum.plans import etl, experiment, release
from stratum.sources import layout, records


def one(spark, column, *values, kind="string"):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], f"x {kind}").select(column(F.col("x"))).collect()]


def test_quarters_refuse_other_codes(spark):
    assert one(spark, R.quarters_2018, "   ", "101", "501", "701", "999") == [0, 1, 5, 7, 7]
    for bad in ("abc", None):
        with pytest.raises(PySparkException):
            one(spark, R.quarters_2018, bad)


def test_recodes(spark):
    assert one(spark, lambda c: R.strict_int(c, "X"), " 12", "-3") == [12, -3]
    assert one(spark, R.hispanic_1940, 0, 3, kind="int") == [0, 1]
    assert one(spark, R.hispanic_2018, 1, 2, kind="int") == [0, 1]
    assert one(spark, lambda c: R.race_index(c, 6), 1, 6, kind="int") == [0, 5]
    assert one(spark, R.quarters_level, 0, 2, 9, kind="int") == [0, 1, 7]
    assert one(spark, R.number_or_blank, 2.0, 2.5, float("nan"), None, kind="double") == ["2", "2.5", "", ""]
    for f, bad in ((lambda c: R.strict_int(c, "X"), "a"), (lambda c: R.hispanic_2018(c.cast("int")), "3"), (lambda c: R.race_index(c.cast("int"), 6), "7"), (lambda c: R.quarters_level(c.cast("int")), "5")):
        with pytest.raises(PySparkException):
            one(spark, f, bad)


def test_race_combinations(spark):
    """Fewer races first, then the flag strings in descending order."""
    for m in (1, 3, 6):
        flags = sorted(itertools.product((1, 0), repeat=m), key=sum)[1:]
        frame = spark.createDataFrame([*flags, (0,) * m], [f"f{i}" for i in range(m)])
        got = {tuple(r)[:-1]: r["i"] for r in frame.withColumn("i", R.race_combination([F.col(f"f{i}") for i in range(m)])).collect()}
        assert got == {f: i for i, f in enumerate(flags)} | {(0,) * m: None}
        assert [tuple(int(i in s) for i in range(m)) for s in R.race_combinations(m)] == flags


def test_legal_values(spark):
    assert one(spark, lambda c: V.legal(c, "3-8,4,5,9-12"), "3", "12", "13", "abc", None) == [True, True, False, False, False]
    assert V.cardinality("1-3,5") == 4 and V.merged([(1, 2), (3, 4), (8, 9), (4, 5)]) == [(1, 5), (8, 9)]
    assert V.parse_range("1-2 = hello") == ("1", "2", "hello") and V.parse_range("4") == ("4", "4", "")
    lines = spark.createDataFrame([("a|b",), ("a",), ("# x",)], "value string")
    assert [r["value"] for r in V.lines_valid(lines, 2, 5).collect()] == ["a"]


def test_layouts():
    for name, n, width in (("household_1940", 53, 159), ("person_1940", 102, 273), ("unit_2018", 10, 47), ("person_2018", 34, 114)):
        made = records.fields(name)
        assert (len(made), made[-1].end) == (n, width) and all(a.end == b.start for a, b in itertools.pairwise(made))
    by = {f.name: (f.start, f.end) for f in records.fields("household_1940")}
    assert (by["statefip"], by["county"], by["gqtype"], by["enumdist"]) == ((53, 55), (55, 59), (94, 95), (124, 128))
    by = {f.name: (f.start, f.end) for f in records.fields("person_1940")}
    assert (by["age"], by["race"], by["hispan"], by["histid"]) == ((73, 76), (84, 85), (88, 89), (234, 270))


def test_lines_2018(spark):
    row = spark.createDataFrame([("4400700010011234", 7, 0, 3, 0, 1, 62)], "g string, e long, p long, h int, va int, hi int, r int")
    (line,) = row.select(D.person_line_2018(*(F.col(c) for c in row.columns))).first()
    assert line.split("|") == ["MPD", "3.1.4", "44", "007", "000100", "1", "1234", "7", "1", "5", "99", "9", "17", "2", "63", *["9999"] * 9, "9"]
    (line,) = row.select(D.unit_line_2018(F.col("g"), F.col("e"), F.col("h"), F.lit(4))).first()
    assert line.split("|")[7:13] == ["7", "4", "301", "0", "0", "4"] and len(line.split("|")) == 27
    with pytest.raises(PySparkException):
        row.select(D.unit_line_2018(F.lit("44"), F.col("e"), F.col("h"), F.lit(4))).collect()


def test_states(spark):
    assert len(records.states()) == 51
    got = records.with_state(spark.createDataFrame([("RI",), ("zz",)], "x string"), "x", "abbr").collect()
    assert {(r["x"], r["state_code"]) for r in got} == {("RI", "44"), ("zz", None)}


SMALL = Domain(("a", "b"), (3, 2))


def small_hist(spark):
    return spark.createDataFrame([("u", c, c + 1) for c in range(6)] + [("v", 2, 5)], "g string, cell int, n long")


def answers(frame, n):
    out = {g: np.zeros(n) for g in "uv"}
    for r in frame.collect():
        out[r["g"]][r["row"]] += r["n"]
    return out


def test_kronecker_equals_matrix(spark):
    q = KroneckerQuery(SMALL, (((1.0, 2.0, 0.0), (0.0, -1.0, 1.0)), ((1.0, 1.0), (0.0, 0.5))))
    counts = {"u": np.arange(1.0, 7), "v": np.array([0, 0, 5.0, 0, 0, 0])}
    got = answers(q.answer(small_hist(spark), "g"), 4)
    for g, x in counts.items():
        assert got[g] == pytest.approx(q.matrix() @ x)
    with pytest.raises(ValueError, match="axes"):
        KroneckerQuery(SMALL, (((1.0, 1.0, 1.0),),))
    cut = answers(stacked([marginal(SMALL, "a"), q], small_hist(spark), "g", domain_subset=[0, 2, 3]), 7)
    keep = np.isin(np.arange(6), [0, 2, 3])
    for g, x in counts.items():
        assert cut[g] == pytest.approx(np.concatenate([marginal(SMALL, "a").matrix() @ (x * keep), q.matrix() @ (x * keep)]))


def test_shapes_and_reduction(spark):
    rhs = spark.createDataFrame([("u", i, i) for i in range(3)], "g string, row int, rhs int")
    assert check_shape(marginal(SMALL, "a"), rhs, "g").count() == 3
    with pytest.raises(PySparkException):
        check_shape(marginal(SMALL, "a"), rhs.where("row < 2"), "g").collect()
    assert reduced(marginal(SMALL, "a"), ("a",)).matrix().tolist() == np.eye(3).tolist()
    with pytest.raises(ValueError, match="whole"):
        reduced(marginal(SMALL, "a", "b"), ("a",))


def test_tables():
    full = Domain(("hhgq", "va", "hisp", "race"), (8, 2, 2, 63))
    assert {"p1_number_of_races", "p1_two_or_more_races", "p42_inst_noninst"} <= set(pl94(full))
    assert table(full, "p2")["p2_number_of_races"].shape == (6,)
    assert workload(full)["inst_noninst"].shape == (2,)
    assert workload(Domain(("race",), (6,)))["racecomb"].matrix().tolist() == [[1, 1, 1, 0, 0, 0], [0, 0, 0, 1, 1, 1]]


def test_budgets():
    b = N.Budget(1.0, {"x": 1.0}, 0.5, {"q": 0.5})
    first, second = N.phases(b, 0.25)
    assert [r[2] for r in first] == [0.125, 0.125] and [r[2] for r in second] == [0.375, 0.375]
    settings = {"engine": {"epsilon_fraction": "0.5", "m": "1"}, "t_c": {"epsilon_fraction": "0.25"}}
    assert N.column_epsilon(settings, "engine", "t", "c", 2.0) == 0.5 and N.column_epsilon(settings, "engine", "t", "d", 2.0) == 1.0
    assert N.parameter(settings, "engine", "t", "c", "m") == "1"
    with pytest.raises(KeyError):
        N.parameter(settings, "engine", "t", "c", "none")


def test_secure_uniforms_differ(spark):
    rows = spark.range(500).select(N.secure_uniform(F.col("id")).alias("u")).collect()
    values = {r["u"] for r in rows}
    assert len(values) == 500 and all(0 <= v < 1 for v in values)


def test_expand_large_counts(spark, monkeypatch):
    from stratum.operators import histogram

    monkeypatch.setattr(histogram, "RUN", 7)
    rows = expand(spark.createDataFrame([("a", 23), ("b", 7), ("c", 0), ("d", 1)], "k string, n long")).collect()
    assert sorted(tuple(r) for r in rows) == [*(("a", i) for i in range(1, 24)), *(("b", i) for i in range(1, 8)), ("d", 1)]


def test_measure_of_large_budget_is_the_truth(spark):
    h = Hierarchy(("leaf", "root"), (2, 1))
    hist = h.rollup(small_hist(spark).select(F.concat("g", F.lit("1")).alias("geocode"), "cell", "n"), "cell")
    b = N.Budget(100.0, {"root": 0.5, "leaf": 0.5}, 0.5, {"a": 0.5})
    rows = measure(hist, hist, SMALL, b, {"a": marginal(SMALL, "a")})
    got = {(r["geocode"], r["query"], r["row"]): r["noisy"] for r in rows.collect()}
    assert len(got) == 3 * 9
    assert [got["u1", "a", i] for i in range(3)] == [3, 7, 11] and [got["v1", "detailed", i] for i in range(6)] == [0, 0, 5, 0, 0, 0]
    solved = {(r["geocode"], r["cell"]): r["noisy"] for r in couple(rows, SMALL, {"a": marginal(SMALL, "a")}).collect()}
    assert solved["u1", 3] == pytest.approx(4, abs=1e-3)


def bounds_of(units, tot):
    out, every = np.zeros((len(units), 1 << units.shape[1]), np.int64), units.sum(1)
    for s in range(out.shape[1]):
        inside = sum((units[:, r] for r in range(units.shape[1]) if s >> r & 1), np.zeros(len(units), np.int64))
        out[:, s] = np.where(inside > 0, np.maximum(tot - (every - inside), 0), 0)
    return out


def in_bounds(x, category, most):
    sums = np.stack([np.bincount(category, r, most.shape[1].bit_length() - 1) for r in x]).astype(np.int64)
    return all((sums[:, [r for r in range(sums.shape[1]) if s >> r & 1]].sum(1) <= most[:, s]).all() for s in range(most.shape[1]))


def test_children_keep_totals_and_bounds():
    rng, category = np.random.default_rng(0), np.repeat(np.arange(4), 3)
    for n in (1, 2, 7, 40):
        units = rng.poisson(0.8, (n, 4))
        units[units.sum(1) == 0, 0] = 1
        truth = np.zeros((n, 12), np.int64)
        for i, r in itertools.product(range(n), range(4)):
            for _ in range(units[i, r]):
                truth[i, 3 * r + rng.integers(3)] += 1 + rng.poisson(2)
        most = bounds_of(units, truth.sum(1))
        noisy = truth + rng.geometric(0.2, truth.shape) - rng.geometric(0.2, truth.shape)
        root = K.solve_root(noisy.sum(0).astype(float), most.sum(0), category, [])
        assert root.sum() == truth.sum() and in_bounds(root[None], category, most.sum(0)[None])
        _, whole, slack = K.solve_children(noisy.astype(float), root, most, category)
        assert slack == 0 and (whole >= 0).all() and (whole.sum(0) == root).all() and (whole.sum(1) == truth.sum(1)).all() and in_bounds(whole, category, most)
        # a parent out of reach: the least slack is what the children can't hold in its category
        far = np.zeros(12, np.int64)
        far[0] = truth.sum()
        _, whole, slack = K.solve_children(noisy.astype(float), far, most, category)
        assert slack == truth.sum() - most[:, 1].sum() and (whole.sum(1) == truth.sum(1)).all() and in_bounds(whole, category, most)


def test_least_squares_projects():
    rng = np.random.default_rng(1)
    category = np.array([0, 0, 1, 1])
    x = K.least_squares(rng.normal(3, 2, (3, 4)), np.array([9, 6, 3, 12]), np.array([10, 8, 12]), category, np.zeros((3, 2)), np.full((3, 2), 30), 400)
    assert x.sum(1) == pytest.approx([10, 8, 12], abs=0.05) and x.sum(0) == pytest.approx([9, 6, 3, 12], abs=0.05) and (x > -0.05).all()


def test_structural_zeros_stay_zero():
    category = np.repeat(np.arange(2), 2)
    most = bounds_of(np.array([[2, 1]]), np.array([9]))[0]
    root = K.solve_root(np.array([1.0, 9, 4, 4]), most, category, [1])
    assert root[1] == 0 and root.sum() == 9
    _, whole, _ = K.solve_children(np.array([[5.0, 9, 1, 1], [1, 1, 1, 1]]), root, bounds_of(np.array([[1, 1], [1, 0]]), np.array([5, 4])), category)
    assert (whole[:, 1] == 0).all()
    with pytest.raises(ValueError, match="structural"):
        K.solve_root(np.array([1.0, 9, 4, 4]), most, category, [0, 1])


def household(serial, district, gqtype):
    values = {"rectype": "H", "serial": f"{serial:08}", "statefip": "44", "county": "0070", "enumdist": district, "gqtype": str(gqtype)}
    return "".join(values.get(f.name, "").ljust(f.end - f.start) for f in records.fields("household_1940"))


def person(serial, age, race, hispan):
    values = {"rectype": "P", "serial": f"{serial:08}", "age": f"{age:03}", "race": str(race), "hispan": str(hispan)}
    return "".join(values.get(f.name, "").ljust(f.end - f.start) for f in records.fields("person_1940"))


def test_release_from_files(spark, tmp_path):
    rng = np.random.default_rng(3)
    homes = [(i, f"{int(rng.integers(1, 6)):04}", int(rng.choice([0, 0, 0, 2, 6]))) for i in range(60)]
    people = [(i, int(rng.integers(0, 90)), int(rng.integers(1, 7)), int(rng.integers(0, 2))) for i, _, _ in homes for _ in range(int(rng.integers(1, 6)))]
    (tmp_path / "h.txt").write_text("\n".join(household(*h) for h in homes))
    (tmp_path / "p.txt").write_text("\n".join(person(*p) for p in people))
    config = configparser.ConfigParser()
    config.read_dict({"reader": {"household": str(tmp_path / "h.txt"), "person": str(tmp_path / "p.txt")}, "budget": {"epsilon": "2.0", "levels": "0.25,0.25,0.25,0.25", "queries": "hhgq, va_hisp_race", "shares": "0.5,0.2,0.3"}, "writer": {"folder": str(tmp_path / "out")}})
    made = release.run(spark, config)
    lines = [r["value"].split("|") for r in spark.read.text(str(tmp_path / "out" / "persons")).collect()]
    units = [r["value"].split("|") for r in spark.read.text(str(tmp_path / "out" / "units")).collect()]
    assert len(lines) == len(people) and {len(x) for x in lines} == {23} and len(units) == len(homes) and {len(x) for x in units} == {25}
    assert sum(int(x[10]) for x in units) == len(people)
    checks = [json.loads(r["value"]) for r in spark.read.text(str(tmp_path / "out" / "checks")).collect()]
    assert {c["cons"] for c in checks} == {"total", "hhgq_total_ub", "hhgq_total_lb"} and all(c["failures"] == 0 for c in checks)
    assert {c["geolevel"] for c in checks if c["cons"] == "total"} == {"state", "root"}  # no district's or county's total is published
    # every occupied unit has a person, as the bounds say
    assert all(int(x[10]) > 0 for x in units)
    # a configuration whose rules name the districts' totals has them exact, and a structural zero holds at every level
    config.read_dict({"constraints": {"invariants.district": "tot, gqhh_vect, gqhh_tot", "constraints.district": "total, hhgq_total_lb, hhgq_total_ub, nurse_nva_0"}, "writer": {"folder": str(tmp_path / "exact")}})
    made = release.run(spark, config)
    per = {r["geocode"]: r["n"] for r in made.truth.groupBy("geocode").agg(F.sum("n").alias("n")).collect()}
    saved = spark.read.parquet(str(tmp_path / "exact" / "estimates"))
    assert {r["geocode"]: r["n"] for r in saved.where("geolevel = 'district'").groupBy("geocode").agg(F.sum("syn").alias("n")).where("n > 0").collect()} == per
    assert made.checks.where("cons = 'nurse_nva_0' AND failures = 0").count() == 4 and saved.where(F.col("cell").between(3 * 24, 3 * 24 + 11) & (F.col("syn") > 0)).count() == 0
    config.read_dict({"constraints": {"constraints.planet": "total"}})
    with pytest.raises(ValueError, match="planet"):
        release.run(spark, config)
    (tmp_path / "bad.txt").write_text(household(1, "0001", 5))
    with pytest.raises(PySparkException):
        release.recoded_1940(records.read_records(spark, str(tmp_path / "bad.txt"), "household_1940"), records.read_records(spark, str(tmp_path / "p.txt"), "person_1940"))[1].collect()


def test_migration_commands(spark, tmp_path):
    (tmp_path / "in.csv").write_text("AGE,SEX\n10,\n20,2\n")
    ranges = {"SEX": [("1", "male"), ("9", "not reported")]}
    frames = etl.Steps(etl.named_commands(spark, ranges)).run({
        "1": f"A=BULK_LOAD(file={tmp_path}/in.csv)", "2": "B=APPLY_DEFAULTS(of=A,text=not reported)", "3": "C=PROCESS(of=B,where=AGE > 5)", "4": f"OUTPUT_RECORDS(of=C,file={tmp_path}/out)", "5": "D=TABLE_STATS(of=C)", "6": "E=OVERRIDE(of=C,text=male)", "7": "F=COLLECT(of=C+E)",
    })
    assert sorted(r["SEX"] for r in spark.read.parquet(f"{tmp_path}/out").collect()) == ["2", "9"]
    assert sorted(r["SEX"] for r in frames["F"].collect()) == ["1", "1", "2", "9"] and frames["D"].count() == 2


def test_sqlite_without_rows_and_with_nulls(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(layout, "SLICE_ROWS", 2)
    with sqlite3.connect(tmp_path / "d.db") as db:
        db.execute("CREATE TABLE t (a INTEGER, b TEXT, c REAL)")
        db.executemany("INSERT INTO t VALUES (?, NULL, ?)", [(i, None if i % 2 else i / 2) for i in range(5)])
        db.execute("CREATE TABLE empty (a INTEGER)")
    assert layout.sqlite_tables(spark, str(tmp_path / "d.db"), str(tmp_path / "out")) == ["empty", "t"]
    rows = spark.read.parquet(str(tmp_path / "out" / "t")).orderBy("a").collect()
    assert [tuple(r) for r in rows] == [(0, None, 0.0), (1, None, None), (2, None, 1.0), (3, None, None), (4, None, 2.0)]
    assert spark.read.parquet(str(tmp_path / "out" / "empty")).count() == 0


def test_writers(spark, tmp_path):
    rows = spark.createDataFrame([("root", "0", 0, 3), ("leaf", "44a", 0, 3)], "geolevel string, geocode string, cell int, syn long")
    flags = spark.createDataFrame([("root", 0)], "geolevel string, slack long")
    layout.save_units(rows, str(tmp_path / "u"), {"budget": {"epsilon": "1"}}, flags, ["geocode", "syn"], "json", 2)
    assert sorted(r["geocode"] for r in spark.read.json(str(tmp_path / "u" / "units")).collect()) == ["0", "44a"]
    assert spark.read.json(str(tmp_path / "u" / "config")).first()["value"] == "1"
    layout.write_plain(spark.createDataFrame([("44a|1",), ("45b|0",)], "value string"), str(tmp_path / "p"), split_by_state=True)
    assert {p.name for p in (tmp_path / "p").iterdir() if p.is_dir()} == {"state=44", "state=45"}
    layout.write_plain(spark.createDataFrame([("44a|1",)], "value string"), str(tmp_path / "q"))
    assert spark.read.text(str(tmp_path / "q")).count() == 1
    records.read_registered(spark, "plain_lines", str(tmp_path / "q"), [layout.Field("state", 0, 2)], "44")
    assert spark.table("plain_lines").first()["state"] == "44"
    spark.catalog.dropTempView("plain_lines")


def test_registry_and_settings():
    known = experiment.Registry()
    known.add("geometric")(N.geometric)
    config = configparser.ConfigParser()
    config.read_dict({"noise": {"mechanism": "geometric", "n": "3", "on": "yes", "names": "a, b"}})
    assert known.of(config, "noise", "mechanism") is N.geometric
    assert [experiment.setting(config, "noise", *x) for x in (("n", int), ("on", bool), ("names", list), ("none", str, "z"))] == [3, True, ["a", "b"], "z"]
    with pytest.raises(KeyError):
        experiment.setting(config, "noise", "none", int)
    with pytest.raises(ValueError, match="geometric"):
        known.add("geometric")(math.log)
    assert experiment.substitute(config, {("noise", "n"): "4"})["noise"]["n"] == "4" and config["noise"]["n"] == "3"
    assert LinearQuery(SMALL, over=(0,)).n_answers == 2


def test_functions_of_whole_tables(spark):
    from stratum.plans.sqltables import NoisyTables

    tables = NoisyTables(
        pre={"t": "SELECT k, count(*) AS n FROM rows GROUP BY k"}, noise={"t": [[]]}, out={"o": "SELECT k, n FROM t"}, cells={"t": ["k"]}, master_epsilon=0.0,
        before={"t": [lambda df: df.where("k < 2")]}, after={"o": [lambda df: df.withColumn("n", F.col("n") * 10), lambda df: df.withColumn("n", F.col("n") + 1)]},
    )
    tables.noise["t"] = []
    rows = spark.createDataFrame([(i % 3,) for i in range(9)], "k int")
    for side in tables.run(spark, {"rows": rows}):
        assert sorted(tuple(r) for r in side["o"].collect()) == [(0, 31), (1, 31)]


def test_layout_values(spark):
    got = spark.createDataFrame([(7, "ab")], "n long, s string").select(layout.formatted("n", "INTEGER", 4), layout.formatted("s", "CHAR", 4)).first()
    assert tuple(got) == ("0007", "  ab")
    assert spark.range(1).select(layout.formatted("id", "INTEGER", 2, "zz")).first()[0] == "zz"
    assert N.laplace_variance(3.0) == 18.0


def test_recode_steps_and_ranges(spark):
    rows = spark.createDataFrame([(" '1,234.0' ", "2"), ("x", "7"), (None, " ")], "a string, b string")
    assert [r["n"] for r in R.recoded(rows, {"n": "clean_int(a)"}).collect()] == [1234, None, None]
    with pytest.raises(ValueError, match="no recode"):
        R.recoded(rows, {"n": "nothing(a)"})
    ok = lambda *a: [r[0] for r in rows.select(V.in_ranges(F.col("b"), *a)).collect()]
    assert ok([("1", "3"), ("4", "7")], "int") == [True, True, False]
    assert ok([("NULL", ""), ("6.5", "8")], "float") == [False, True, True]
    assert ok([("1", "3")], "string", 2) == [True, False, False] and ok([("N/A", "")], "string", 2) == [True] * 3 and ok([], "int") == [False] * 3
