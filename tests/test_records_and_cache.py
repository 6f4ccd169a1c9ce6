"""Random records, the cache of computed tables, the heavy-tailed quantile, persons numbered by cells."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratum.functions import noise as N
from stratum.operators import microdata as D
from stratum.operators import validate as V
from stratum.operators.histogram import Domain
from stratum.plans import etl, experiment

LEGAL = {"AGE": "0-99,999", "SEX": "1-2,9", "GRADE": "A-F,P", "CODE": "5-7,6-9,10"}


def test_random_records(spark):
    keys = spark.range(20_000)
    one, many = (etl.random_records(keys.repartition(n), LEGAL, seed=4) for n in (1, 8))
    assert one.exceptAll(many).count() == 0 and many.exceptAll(one).count() == 0 and one.count() == 20_000
    assert one.where(~V.legal(F.col("AGE"), LEGAL["AGE"]) | ~V.legal(F.col("SEX"), LEGAL["SEX"]) | ~V.legal(F.col("GRADE"), LEGAL["GRADE"], "str")).count() == 0
    for name, size in (("AGE", 101), ("SEX", 3), ("GRADE", 7), ("CODE", 6)):
        counts = [r["count"] for r in one.groupBy(name).count().collect()]
        expected = 20_000 / size
        assert len(counts) == size and all(abs(c - expected) < 6 * math.sqrt(expected) for c in counts)
    assert one.exceptAll(etl.random_records(keys, LEGAL, seed=5)).count() > 19_000
    assert etl.random_records(keys.limit(0), LEGAL).count() == 0


def test_cache_reads_no_source_again(spark, tmp_path):
    source, folder = str(tmp_path / "in"), str(tmp_path / "cache")
    spark.range(100).withColumn("v", F.col("id") % 7).write.parquet(source)
    made = lambda: spark.read.parquet(source).groupBy("v").agg(F.sum("id").alias("n"))
    want = sorted(map(tuple, made().collect()))
    first = experiment.cached(made(), folder)
    assert sorted(map(tuple, first.collect())) == want
    second = experiment.cached(made(), folder)
    assert sorted(map(tuple, second.collect())) == want
    assert sorted(second.inputFiles()) == sorted(first.inputFiles()) and all("cache" in f for f in second.inputFiles())
    # another plan, or other rows in the source, is another table
    assert set(experiment.cached(made().where("v > 3"), folder).inputFiles()).isdisjoint(first.inputFiles())
    spark.range(100, 150).withColumn("v", F.col("id") % 7).write.mode("append").parquet(source)
    assert sorted(map(tuple, experiment.cached(made(), folder).collect())) == sorted(map(tuple, made().collect())) != want
    # an entry without its rows, as a lost run may leave one, is made again
    (tmp_path / "cache" / experiment.fingerprint(made().where("v = 1"))).mkdir()
    assert experiment.cached(made().where("v = 1"), folder).count() == 1


def test_heavy_tail_inverts_its_distribution(spark):
    shares = [1e-12, 1e-6, 0.01, 0.25, 0.5, 0.75, 0.9, 1 - 1e-6]
    rows = spark.createDataFrame([(q,) for q in shares], "q double").withColumn("z", N.heavy_tail(F.col("q"))).withColumn("back", N.heavy_tail_share(F.col("z"))).collect()
    assert [r["back"] for r in rows] == pytest.approx(shares, abs=1e-13)
    z = [r["z"] for r in rows]
    assert z == sorted(z) and abs(z[4]) < 1e-9 and z[3] == pytest.approx(-z[5])
    steps, width = 200_000, 60 / 200_000  # the density's integral up to the quantile of 0.9
    area = sum(math.sqrt(2) / math.pi / (1 + (z[6] - k * width) ** 4) * width for k in range(steps))
    assert area == pytest.approx(0.9, abs=1e-3)
    assert "Python" not in spark.range(3).select(N.heavy_tail(F.col("id") / 4))._jdf.queryExecution().executedPlan().toString()


def test_persons_are_numbered_by_cells(spark):
    """A third of all persons in one block and type: the window sees cells, and units are filled in turn as before."""
    domain = Domain(("hhgq", "va"), (2, 3))
    hist = spark.createDataFrame([("a", 0, 30_000), ("a", 1, 5), ("a", 4, 3), ("b", 2, 4), ("b", 2, 2)], "geocode string, cell int, n long")
    units = spark.createDataFrame([("a", 0, 4), ("a", 1, 2), ("b", 0, 5)], "geocode string, hhgq int, n long")
    got = [tuple(r) for r in D.persons(hist, units, domain).select("geocode", "hhgq", "cell", "unit", "person").collect()]
    want, start = [], {("a", 0): (0, 4), ("a", 1): (4, 2), ("b", 0): (0, 5)}
    for key, cells in {("a", 0): [0] * 30_000 + [1] * 5, ("a", 1): [4] * 3, ("b", 0): [2] * 6}.items():
        first, size = start[key]
        want += [(*key, c, first + k % size, k // size) for k, c in enumerate(cells)]
    assert sorted(got) == sorted(want)


def test_heavy_tail_takes_few_steps(spark):
    """The same numbers as 100 bisections, in a plan that counts to less than ten."""
    frame = spark.range(1, 4000).select((F.col("id") / 4000).alias("q")).unionByName(spark.createDataFrame([(1e-9,), (1e-5,), (1 - 1e-5,), (None,)], "q double")).withColumn("z", N.heavy_tail(F.col("q"))).toPandas()
    rest = frame.dropna()
    assert len(rest) == len(frame) - 1
    q, low, high = rest["q"].to_numpy(), np.full(len(rest), -1e6), np.full(len(rest), 1e6)
    for _ in range(100):
        z = (low + high) / 2
        r = z * math.sqrt(2)
        below = 0.5 + (np.log1p(2 * r / (z * z - r + 1)) / 2 + np.arctan(r + 1) + np.arctan(r - 1)) / (2 * math.pi) < q
        low, high = np.where(below, z, low), np.where(below, high, z)
    assert np.abs(rest["z"] - low).max() < 1e-4 and (np.abs(rest["z"] - low) <= 1e-12 * (1 + low**4)).all()
    assert N.STEPS < 10
