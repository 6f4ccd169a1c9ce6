"""What a task holds doesn't grow with the tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratum import queries as Q
from stratum.operators import constrained as K
from stratum.operators import estimate as E
from stratum.operators import solve as S
from stratum.operators.hierarchy import Hierarchy


@pytest.mark.parametrize("name", ["measurement_table", "marginal_1way_all", "marginal_2way_all", "marginal_all", "table_pl94", "error_metrics_marg", "error_metrics_geounit"])
def test_as_many_tasks_as_the_tables_need(name, spark, sf, monkeypatch):
    """The rows come out of the tasks they were dealt to, which are more for more orders; no later step gathers them in fewer."""
    monkeypatch.setattr(Q, "ORDERS", 100)
    want = -(-Q.read(spark, sf, "orders").count() // 100)
    assert want > 10
    assert Q.QUERIES[name](spark, sf).rdd.getNumPartitions() == want


def test_constrained_children_are_split(spark, sf, monkeypatch):
    """Leaves of one parent go to several blocks; their totals, all bounds of sets and the parent's cells are kept as in one group."""
    h = Hierarchy(("customer", "root"), (11, 1))
    bounds = E.settle(K.set_bounds(Q.leaf(spark, sf), Q.unit_hist(spark, sf), 5, h))
    noisy = E.measure(Q.hist(spark, sf), bounds.select(*Q.KEYS), Q.DOMAIN, Q.BUDGET, Q.workload(Q.DOMAIN))
    split = []
    crowded = K.crowded
    monkeypatch.setattr(K, "crowded", lambda children, *a: split.append(children.groupBy("parent").count().count()) or crowded(children, *a))
    made = E.settle(K.constrained_top_down(noisy, bounds, h, Q.DOMAIN, Q.BUDGET, Q.workload(Q.DOMAIN), crowd=50, block=40))
    assert split == [1]
    assert all(r["failures"] == 0 for r in K.kept(made, bounds, Q.DOMAIN).collect())
    assert all(r["slack"] == 0 for r in K.slack_by_level(made).collect())
    own = {r["geocode"]: r["n"] for r in made.where("geolevel = 'customer'").groupBy("geocode").agg(F.sum("syn").alias("n")).collect()}
    assert own == {r["geocode"]: r["tot"] for r in bounds.where("geolevel = 'customer'").collect()}


def test_bounds_of_single_categories():
    """Those of a leaf imply the bounds of all sets; others need not."""
    units, tot = np.array([[2, 0, 1], [0, 0, 3], [1, 1, 1]]), np.array([5, 4, 9])
    inside = np.arange(8)[:, None] >> np.arange(3) & 1
    v = units @ inside.T
    most = np.where(v > 0, np.maximum(tot[:, None] - (units.sum(1, keepdims=True) - v), 0), 0)
    low, high, single = K.single_bounds(most)
    assert single.all() and (low[:, 0] == tot).all() and (low[0, 1:] == [2, 0, 1]).all() and high[0, 2] == 0 and low[1, 3] == 4
    assert not K.single_bounds(np.array([[[0, 5, 6, 9, 10][s.bit_count()] for s in range(16)]]))[2].any()


def test_bound_without_a_free_cell_is_settled(monkeypatch):
    """A category that must have a person, but whose cells all want to be below 0, needs no rounds of ``estimate``."""
    monkeypatch.setattr(S, "estimate", lambda *a, **k: pytest.fail("left to the rounds"))
    member = np.vstack([np.ones(6, bool), np.arange(2)[:, None] == np.arange(6) // 3])
    low, high = np.array([[9.0, 1, 1]]), np.array([[9.0, 8, 8]])
    made = S.standing(np.eye(6) + 0.5 * member[1:].T.astype(float) @ member[1:], np.array([[5.0, 4, 6, -7, -9, -6]]), member, low, high)
    assert made.x.sum() == pytest.approx(9) and made.x[0, 3:] == pytest.approx([0, 0, 1])


def test_units_are_dealt_out(spark, sf, monkeypatch):
    """Occupied and vacant units come from as many tasks as orders need, not from the session's shuffle partitions."""
    want = -(-Q.read(spark, sf, "orders").count() // 100)
    monkeypatch.setattr(Q, "ORDERS", 100)
    assert Q.unit_hist(spark, sf).rdd.getNumPartitions() == want
    assert Q.units(spark, sf).rdd.getNumPartitions() == want


def test_levels_are_coupled_once(spark, sf, monkeypatch):
    """Each level's units are multiplied for that level only, not those of all levels for each."""
    seen = []
    couple = E.couple
    monkeypatch.setattr(E, "couple", lambda rows, *a: seen.append({r["geolevel"] for r in rows.select("geolevel").distinct().collect()}) or couple(rows, *a))
    Q.topdown_estimate_queries(spark, sf)
    assert seen == [{x} for x in reversed(Q.H.levels)]


def test_settled_tables_inherit_no_estimate(spark):
    """Rounds that join settled tables: the estimate of bytes, a product of all tables joined, would double its digits each time."""
    rows = E.settle(spark.range(5).select(F.col("id").alias("k"), F.array("id").alias("v")))
    for _ in range(8):
        rows = E.settle(rows.join(rows.select("k", F.col("v").alias("w")), "k").select("k", F.concat("v", F.slice("w", 1, 1)).alias("v")))
    size = rows.join(rows.select("k"), "k")._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    assert size.bit_length() < 1000
    assert sorted((r["k"], r["v"]) for r in rows.collect()) == [(k, [k] * 9) for k in range(5)]


def test_two_phases_count_once(spark, sf, monkeypatch):
    """Both phases' counts come from one reading of the line items for persons and one for occupied units, and are those of ``hist`` and ``unit_levels``."""
    seen = []
    read = Q.read
    monkeypatch.setattr(Q, "read", lambda spark, sf, name: seen.append(name) or read(spark, sf, name))
    Q.two_phases(spark, sf)
    assert seen.count("lineitem") == 2
    true, at = Q.counted(spark, sf)
    for got, want in ((true, Q.hist(spark, sf)), (at, Q.unit_levels(spark, sf))):
        rows = [sorted(tuple(r) for r in d.select(*want.columns).collect()) for d in (got, want)]
        assert rows[0] == rows[1]


def _four_categories() -> tuple[np.ndarray, np.ndarray]:
    member = np.vstack([np.ones(8, bool), np.arange(4)[:, None] == np.arange(8) // 2])
    return np.eye(8) + 0.5 * member[1:].T.astype(float) @ member[1:], member


def test_bounds_that_imply_each_other_are_settled(monkeypatch):
    """Where the total and all categories are at a bound, one price is free; it is chosen so that the others' signs are right."""
    monkeypatch.setattr(S, "estimate", lambda *a, **k: pytest.fail("left to the rounds"))
    hess, member = _four_categories()
    low, high = np.array([[7.0, 2, 1, 2, 1]]), np.array([[7.0, 3, 2, 3, 2]])
    made = S.standing(hess, np.array([[19.0, -7, -4, 18, 8, 23, 7, 29]]), member, low, high)
    assert made.x @ member.T == pytest.approx(np.array([[7, 2, 1, 2, 2]])) and made.primal < 1e-9 and made.dual < 1e-9


def test_no_digits_are_left_to_add_up():
    """Prices of a crowded parent settle on the sum of its children: those that stay in doubt are as exact as the others."""
    rng = np.random.default_rng(3)
    hess, member = _four_categories()
    units = rng.integers(1, 3, (4000, 4))
    total = units.sum(1, keepdims=True) + rng.integers(0, 12, (4000, 1))
    low, high = np.hstack([total, units]).astype(float), np.hstack([total, total - (units.sum(1, keepdims=True) - units)]).astype(float)
    made = S.standing(hess, rng.integers(-9, 30, (4000, 8)).astype(float), member, low, high)
    at = made.x @ member.T
    assert made.primal < 1e-9 and made.dual < 1e-9
    assert (at > low - 1e-9).all() and (at < high + 1e-9).all()
