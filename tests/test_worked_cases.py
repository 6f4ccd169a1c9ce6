"""Worked cases with known answers: queries on small arrays, mechanisms at given uniforms, tables, lines and statistics."""

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from stratum.functions import noise as N
from stratum.functions import recode as R
from stratum.operators import metrics as M
from stratum.operators import microdata as D
from stratum.operators import validate as V
from stratum.operators.histogram import Domain
from stratum.operators.linear import KroneckerQuery, LinearQuery
from stratum.plans import etl
from stratum.plans.sqltables import Noise, NoisyTables, regrouped


def as_hist(spark, data):
    return spark.createDataFrame([(i, float(x)) for i, x in enumerate(data.ravel())], "cell int, n double")


def answered(query, hist):
    out = np.zeros(query.n_answers)
    for r in query.answer(hist).collect():
        out[r["row"]] = r["n"]
    return out


@pytest.mark.parametrize("over", [(), (1,), (0, 2), (0, 1, 2)])
def test_subset_and_sums(spark, over):
    data = np.arange(1, 121).reshape(6, 4, 5) + 0.3
    domain = Domain(("a", "b", "c"), data.shape)
    q = LinearQuery(domain, subset={0: [1, 2], 1: [0, 1], 2: [2, 3]}, over=over)
    want = data[1:3, 0:2, 2:4].sum(axis=over) if over else data[1:3, 0:2, 2:4]
    assert answered(q, as_hist(spark, data)) == pytest.approx(np.ravel(want))
    assert q.matrix() @ data.ravel() == pytest.approx(np.ravel(want))
    assert (q.sensitivity(), q.counting()) == (1, True)


def test_queries_of_an_arange(spark):
    data = np.arange(60).reshape(3, 4, 5)
    domain, hist = Domain(("a", "b", "c"), data.shape), as_hist(spark, data)
    for over in ((0, 1, 2), (), (1,)):
        q = LinearQuery(domain, over=over)
        assert answered(q, hist) == pytest.approx(np.ravel(data.sum(axis=over) if over else data))
    q = LinearQuery(domain, subset={0: [0, 2], 1: [0, 2], 2: [0, 4]}, over=(1,))
    assert answered(q, hist) == pytest.approx(data[np.ix_([0, 2], [0, 2], [0, 4])].sum(1).ravel())
    assert q.matrix().shape == (q.n_answers, data.size)
    ends = KroneckerQuery(domain, (((1.0,) * 3,), tuple(map(tuple, np.eye(4).tolist())), ((1.0,) * 5,)))
    assert answered(ends, hist) == pytest.approx(data.sum((0, 2)))


def test_mechanisms_at_given_uniforms(spark):
    v, most = F.lit(100.0), F.lit(200.0)
    u = lambda x: F.lit(x)
    row = spark.range(1).select(
        N.no_noise(F.lit(100)), N.smooth_laplace(v, most, u(0.816062), 0.05, 0.05, 0.4, ignore=True), N.smooth_gamma(v, most, u(0.10972505), 0.1, 0.4, ignore=True), N.log_laplace(v, u(0.75), 0.05, 0.4), N.laplace_dp(v, u(0.816062), 2.0, 2.0),
        N.suppressed(v, F.lit(50), v, F.lit(200), F.lit(150), "state", 0.9), N.suppressed(F.lit(1000.0), F.lit(50), F.lit(1000.0), F.lit(20), F.lit(15), "state", 0.9), N.smooth_gamma(v, most, u(0.10972505), 0.1, 0.4),
    ).first()
    assert list(row)[:7] == pytest.approx([100, 150, 1406.3203865411335, 122.10774911533412, 101, 0, 1000], abs=1e-3)
    assert np.isnan(row[7])  # these parameters give no guarantee


def test_tables_by_sql(spark):
    rows = spark.createDataFrame([(chr(97 + i), x, 100) for i, x in enumerate("aaaaaaaaabbbbbbbbccccccccd")], "name string, location string, count long")
    tables = NoisyTables(
        pre={"t": "SELECT location, SUM(count) AS count FROM inputtable GROUP BY location", "t2": "SELECT location, COUNT(*) AS count FROM inputtable GROUP BY location"},
        noise={"t": [[Noise("count", lambda c, u: c, 0.5)]], "t2": [[Noise("count", lambda c, u: c, 0.5)]]}, out={"both": "SELECT t.location, t.count AS a, t2.count AS b FROM t LEFT JOIN t2 ON t.location = t2.location"},
        cells={"t": ["location"], "t2": ["location"]}, master_epsilon=1.0, after={"both": [lambda df: df.withColumn("squared", F.col("a") * F.col("a"))]},
    )
    true, noisy = tables.run(spark, {"inputtable": rows})
    want = [("a", 900, 9, 810_000), ("b", 800, 8, 640_000), ("c", 800, 8, 640_000), ("d", 100, 1, 10_000)]
    assert sorted(map(tuple, true["both"].collect())) == want == sorted(map(tuple, noisy["both"].collect())) and not tables.warnings
    total = regrouped(rows, ["name", "location"], {"count": "sum"}, ["name", "location"]).first()
    assert total["count"] == 2600


def test_total_error(spark):
    cells = [(1, 1), (2, 1), (3, 0), (4, 7), (3, 2), (4, 2), (2, 1), (1, 0)]
    row = M.total_l1(spark.createDataFrame(cells, "c1 long, c2 long")).first()
    assert (row["l1"], row["n"]) == (12, 20)


def test_person_line(spark):
    row = spark.createDataFrame([("0123456789abcdef", "2", 3, 4, 5, 0, 7)], "g string, e string, p int, h int, va int, hi int, r int")
    (line,) = row.select(D.person_line_2018(*(F.col(c) for c in row.columns))).first()
    assert line.startswith("MPD|3.1.4|01|234|56789a|b|cdef|2|4|5|99|9|18|1|08|9999|")


def test_person_recodes(spark):
    rows = spark.createDataFrame([("067", "2", "23"), ("017", "1", "01")], "age string, hisp string, race string")
    made = rows.select(R.voting_age(R.strict_int(F.col("age"), "QAGE")), R.hispanic_2018(R.strict_int(F.col("hisp"), "CENHISP")), R.race_index(R.strict_int(F.col("race"), "CENRACE"), 63))
    assert [tuple(r) for r in made.collect()] == [(1, 1, 22), (0, 0, 0)]
    for column, text, message in (("age", "YY", "invalid literal"), ("hisp", "8", "CENHISP"), ("race", "99", "RACE")):
        bad = rows.withColumn(column, F.lit(text)).select(R.voting_age(R.strict_int(F.col("age"), "QAGE")), R.hispanic_2018(R.strict_int(F.col("hisp"), "CENHISP")), R.race_index(R.strict_int(F.col("race"), "CENRACE"), 63))
        with pytest.raises(PySparkException, match=message):
            bad.collect()


def test_statistics_and_ranges(spark):
    row = etl.statistics(spark.createDataFrame([(1,), (3,), (5,)], "x int")).first()
    assert (row["n"], row["total"], row["squares"], row["mean"]) == (3, 9, 35, 3)
    assert V.merged([(1, 2), (2, 4), (10, 12)]) == [(1, 4), (10, 12)]
    assert etl.parse_step("A=B(C)") == ("A", "B", {"C": ""}) and etl.parse_step("B()") == (None, "B", {})
    bad = Domain(("a",), (2,)).histogram(spark.createDataFrame([(2,)], "a int"))
    with pytest.raises(PySparkException):
        bad.collect()
