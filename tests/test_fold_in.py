"""New users folded into a fitted model, against plain solves and the model's own user factors."""

from __future__ import annotations

import numpy as np
import pytest

from cellar.operators import factor, fold_in
from cellar.recommenders import CollabRecommender

RANK = 5
SCHEMA = "uid bigint, item_id bigint, score double"


def tables(spark, seed=3, users=20, items=30):
    r = np.random.default_rng(seed)
    q = r.normal(size=(items, RANK))
    rows = [(u, int(i), float(r.integers(1, 6))) for u in range(users) for i in r.choice(items, r.integers(1, 12), replace=False)]
    factors = spark.createDataFrame([(i, q[i].tolist()) for i in range(items)], "id bigint, features array<double>")
    return q, rows, factors


@pytest.mark.parametrize("heavy", [fold_in.HEAVY, 3])
def test_factors_equal_a_plain_solve(spark, monkeypatch, heavy):
    """With ``heavy`` 3 most users are summed in parts."""
    monkeypatch.setattr(fold_in, "HEAVY", heavy)
    q, rows, factors = tables(spark)
    odd = [(50, 999, 3.0), (51, None, 2.0), (None, 1, 2.0), (0, 2, None), (0, 3, float("nan"))]  # nothing of these counts
    got = {r["id"]: (r["n"], np.array(r["features"])) for r in fold_in.fold_in(factors, spark.createDataFrame(rows + odd, SCHEMA), 0.1).collect()}
    assert got.keys() == {u for u, _, _ in rows}
    for u, (n, p) in got.items():
        a = np.array([q[i] for v, i, _ in rows if v == u])
        y = np.array([s for v, _, s in rows if v == u])
        assert n == len(y)
        assert np.abs(p - np.linalg.solve(a.T @ a + 0.1 * n * np.eye(RANK), a.T @ y)).max() < 1e-9


def test_nonnegative_factors_meet_the_optimality_conditions(spark):
    q, rows, factors = tables(spark)
    for r in fold_in.fold_in(factors, spark.createDataFrame(rows, SCHEMA), 0.1, nonnegative=True).collect():
        a = np.array([q[i] for v, i, _ in rows if v == r["id"]])
        y = np.array([s for v, _, s in rows if v == r["id"]])
        p = np.array(r["features"])
        slope = (a.T @ a + 0.1 * len(y) * np.eye(RANK)) @ p - a.T @ y
        assert p.min() >= 0 and slope.min() > -1e-6 and np.abs(slope * p).max() < 1e-6


def test_empty_frames(spark):
    _, rows, factors = tables(spark)
    assert fold_in.fold_in(factors, spark.createDataFrame([], SCHEMA), 0.1).count() == 0
    assert fold_in.fold_in(factors.limit(0), spark.createDataFrame(rows, SCHEMA), 0.1).count() == 0


def test_many_new_users_get_lists_without_their_own_items(spark):
    _, rows, _ = tables(spark)
    ratings = spark.createDataFrame(rows, SCHEMA)
    known = CollabRecommender(ratings, factor.als(rank=3, max_iter=3, nonnegative=False)).fit()
    new = [(100, 1, 5.0), (100, 2, 1.0), (101, 3, 4.0), (102, 4, 2.0), (102, 5, 2.0), (102, 6, 5.0)]
    profiles = spark.createDataFrame(new, SCHEMA)
    lists = known.recommend_new_users(profiles, 4).collect()
    items = {r["id"]: np.array(r["features"]) for r in known.model.itemFactors.collect()}
    users = {r["id"]: np.array(r["features"]) for r in known.fold_in(profiles).collect()}
    for u in (100, 101, 102):
        own = {i for v, i, _ in new if v == u}
        want = sorted(((-round(float(users[u] @ f), 6), i) for i, f in items.items() if i not in own))[:4]
        got = sorted((r for r in lists if r["uid"] == u), key=lambda r: r["rank"])
        assert [r["rank"] for r in got] == [1, 2, 3, 4]
        assert [r["item_id"] for r in got] == [i for _, i in want]
    est = {(r["uid"], r["item_id"]): r["est"] for r in fold_in.estimates(known.fold_in(profiles), known.model.itemFactors, profiles).collect()}
    assert all(abs(e - users[u] @ items[i]) < 1e-9 for (u, i), e in est.items()) and len(est) == sum(i in items for _, i, _ in new)
