"""Jointly fitted factor models against plain loops, and the exact inner product search against all products."""

from __future__ import annotations

import numpy as np
import pytest

from cellar.operators import evaluate, factor, inner_product, sgd
from cellar.sources.tables import Tables, train_test

SCHEMA = "uid bigint, item_id bigint, score double"


def ratings(seed=1, users=40, items=25, n=400):
    r = np.random.default_rng(seed)
    pairs = {(int(u), int(i)) for u, i in zip(r.zipf(1.4, 4 * n) % users, r.integers(0, items, 4 * n))}
    return [(u, i, float(r.integers(1, 6))) for u, i in sorted(pairs)[:n]]


def state_of(model):
    return {(r["side"], r["id"]): (r["bias"], np.array(r["factors"])) for r in model.state.collect()}


@pytest.mark.parametrize("blocks", (3, 1))
def test_gradient_steps_equal_a_plain_loop_in_the_same_order(spark, blocks):
    rank, epochs, seed = 7, 3, 42
    frame = spark.createDataFrame(ratings(), SCHEMA)
    model = sgd.fit_svd(frame, rank=rank, epochs=epochs, rate=0.05, seed=seed, blocks=blocks)
    dealt, _ = sgd._dealt(frame, blocks)
    rows = dealt.selectExpr("uid", "item_id", "score", f"pmod(ib - ub, {blocks}) AS s", "ub", f"xxhash64(uid, item_id, {seed}) AS o").collect()
    rows.sort(key=lambda r: (r["s"], r["ub"], r["o"], r["uid"], r["item_id"]))
    mu = np.mean([r["score"] for r in rows])
    bias, f = {}, {}
    for r in rows:
        for key in ((0, r["uid"]), (1, r["item_id"])):
            bias[key], f[key] = 0.0, np.random.default_rng([seed, key[0], key[1], 0]).normal(0.0, 0.1, rank)
    for _ in range(epochs):
        for r in rows:
            u, i = (0, r["uid"]), (1, r["item_id"])
            e = r["score"] - (mu + bias[u] + bias[i] + f[u] @ f[i])
            bias[u] += 0.05 * (e - 0.02 * bias[u])
            bias[i] += 0.05 * (e - 0.02 * bias[i])
            f[u], f[i] = f[u] + 0.05 * (e * f[i] - 0.02 * f[u]), f[i] + 0.05 * (e * f[u] - 0.02 * f[i])
    got = state_of(model)
    assert got.keys() == f.keys() and abs(model.mu - mu) < 1e-12
    assert all(abs(got[k][0] - bias[k]) < 1e-9 and np.abs(got[k][1] - f[k]).max() < 1e-9 for k in f)
    est = {(r["uid"], r["item_id"]): r["est"] for r in sgd.predict(model, frame, -99, 99).collect()}
    assert all(abs(est[r["uid"], r["item_id"]] - (mu + bias[0, r["uid"]] + bias[1, r["item_id"]] + f[0, r["uid"]] @ f[1, r["item_id"]])) < 2e-6 for r in rows)


@pytest.mark.parametrize("blocks", (2, 1))
def test_multiplicative_updates_equal_dense_ones_and_never_raise_the_loss(spark, blocks):
    rows = ratings(2)
    frame = spark.createDataFrame(rows, SCHEMA)
    rank, reg = 4, 0.06
    users, items = sorted({r[0] for r in rows}), sorted({r[1] for r in rows})
    p, q = (np.stack([np.random.default_rng([42, s, i, 0]).uniform(0, 1, rank) for i in ids]) for s, ids in ((0, users), (1, items)))
    m, r = np.zeros((len(users), len(items))), np.zeros((len(users), len(items)))
    for u, i, score in rows:
        m[users.index(u), items.index(i)], r[users.index(u), items.index(i)] = 1, score
    losses = []
    for epochs in range(4):
        model = sgd.fit_nmf(frame, rank=rank, epochs=epochs, blocks=blocks)
        got = state_of(model)
        assert np.allclose(np.stack([got[0, u][1] for u in users]), p) and np.allclose(np.stack([got[1, i][1] for i in items]), q) and p.min() >= 0
        losses.append(sgd.nmf_loss(model, frame))
        e = m * (r - p @ q.T)
        assert abs(losses[-1] - ((e * e).sum() + reg * (m.sum(axis=1) @ (p * p).sum(axis=1) + m.sum(axis=0) @ (q * q).sum(axis=1)))) < 1e-6
        p = p * (r @ q) / ((m * (p @ q.T)) @ q + reg * m.sum(axis=1)[:, None] * p)
        q = q * (r.T @ p) / ((m * (p @ q.T)).T @ p + reg * m.sum(axis=0)[:, None] * q)
    assert losses == sorted(losses, reverse=True)


def test_models_learn_structure_that_biases_cannot_express(spark):
    r = np.random.default_rng(8)
    p, q = r.normal(size=(150, 2)), r.normal(size=(60, 2))
    rows = [(u, i, float(np.clip(3 + p[u] @ q[i] + r.normal(0, 0.1), 1, 5))) for u in range(150) for i in range(60) if r.random() < 0.5]
    train, test = train_test(spark.createDataFrame(rows, SCHEMA))
    rmse = lambda pred: evaluate.rmse_mae(pred).first()["rmse"]
    base = rmse(factor.prediction_rows(factor.predict_baseline(factor.fit_baseline(train), test)))
    assert rmse(sgd.predict(sgd.fit_svd(train, rank=10, epochs=40, rate=0.03), test)) < 0.6 * base
    assert rmse(sgd.predict(sgd.fit_nmf(train, rank=8, epochs=40), test, known_only=True)) < 0.8 * base


def test_empty_missing_and_unseen(spark):
    empty = spark.createDataFrame([], SCHEMA)
    for fit in (sgd.fit_svd, sgd.fit_nmf):
        assert fit(empty, rank=2, epochs=1).state.count() == 0
    some = spark.createDataFrame([(1, 1, 4.0), (2, 1, None), (None, 1, 3.0), (3, 2, float("nan")), (1, 2, 2.0)], SCHEMA)
    model = sgd.fit_svd(some, rank=2, epochs=2)
    assert {k for k in state_of(model)} == {(0, 1), (1, 1), (1, 2)}
    assert sgd.predict(model, spark.createDataFrame([(9, 9, 1.0)], SCHEMA)).first()["est"] == 3.0


def vectors(spark, x):
    return spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "id bigint, features array<double>")


@pytest.mark.parametrize("kind", ("spread", "alike", "few"))
def test_bounded_search_equals_all_products(spark, kind, monkeypatch):
    monkeypatch.setattr(inner_product, "USERS", 50)  # users of a block in several chunks
    r = np.random.default_rng(6)
    n_items = 7 if kind == "few" else 900
    x = r.normal(size=(n_items, 8)) * r.pareto(1.5, n_items)[:, None] if kind != "alike" else np.abs(r.normal(size=(n_items, 8))) + 3
    u = np.abs(r.normal(size=(130, 8)))
    x[n_items // 2] = x[n_items // 3]  # equal products go by item id
    got, products = inner_product.search(vectors(spark, u), vectors(spark, x), 10, block_size=64)
    want = factor.recommend_all(vectors(spark, u), vectors(spark, x), 10)
    rows = lambda df: {(r["uid"], r["rank"], r["item_id"]): r["est"] for r in df.collect()}
    a, b = rows(got), rows(want)
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 2e-6 for k in a)
    assert products.all == 130 * n_items and products.formed <= products.all
    if kind == "spread":
        assert products.skipped > 0.5
    assert inner_product.search(vectors(spark, u), vectors(spark, x).limit(0), 10)[0].count() == 0


def test_recommendations_of_the_joint_model_are_its_predictions(spark):
    train, _ = train_test(Tables(spark, "/root/testdata/sf0.001").ratings_table())
    model = sgd.fit_svd(train, rank=5, epochs=2)
    best, _ = sgd.recommend_all(model, 3, block_size=32)
    est = {(r["uid"], r["item_id"]): r["est"] for r in sgd.predict(model, best.select("uid", "item_id", best["est"].alias("score"))).collect()}
    assert all(abs(est[r["uid"], r["item_id"]] - r["est"]) < 2e-6 for r in best.collect())


@pytest.mark.parametrize("fit", (sgd.fit_svd, sgd.fit_nmf))
def test_fits_keep_one_state_and_no_shuffle_of_it(spark, fit, monkeypatch):
    """Every epoch's state stayed on disk, and the steps between two states shuffled all factors."""
    from cellar.session import scratch_path

    monkeypatch.setattr(sgd, "ROW", 64)  # several rows a block
    folders, plans, path = [], [], sgd.scratch_path
    monkeypatch.setattr(sgd, "scratch_path", lambda s, name: folders.append((name, path(s, name))) or folders[-1][1])
    stored = sgd._stored
    monkeypatch.setattr(sgd, "_stored", lambda df, *a: plans.append((a[0], df._jdf.queryExecution().executedPlan().toString())) or stored(df, *a))
    frame = spark.createDataFrame(ratings(4), SCHEMA)
    model = fit(frame, rank=3, epochs=3, blocks=3)
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch_path(spark, "x")).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    left = lambda p: [f.getPath().getName() for f in fs.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{p}/at=*")) or []]
    states = [x for name, p in folders if name == "factor-state" for x in left(p)]
    assert sorted(states) == [f"at={side}-{block}" for side in (0, 1) for block in range(3)]
    assert not [x for name, p in folders if name == "factor-ratings" for x in left(p)]
    steps = [p for name, p in plans if name == "factor-state"][1:]
    assert len(steps) >= 6 and not any("Exchange" in p or "Sort" in p for p in steps)
    parted = {(r["uid"], r["item_id"]): r["est"] for r in sgd.predict(model, frame, -99, 99).collect()}
    joined = {(r["uid"], r["item_id"]): r["est"] for r in sgd.predict(sgd.Factors(model.mu, model.state), frame, -99, 99).collect()}
    assert len(parted) == 400 and all(abs(parted[k] - joined[k]) < 2e-6 for k in joined)


def test_pairs_of_unseen_missing_and_repeated_ids_are_estimated_by_blocks(spark):
    train = spark.createDataFrame(ratings(5), SCHEMA)
    pairs = spark.createDataFrame([(0, 0, 1.0), (0, 0, 1.0), (0, 0, None), (0, 999, 2.0), (999, 0, 3.0), (None, 0, 4.0), (0, None, 5.0), (None, None, None), (999, 999, 1.0), (1, 1, 2.0)], SCHEMA)
    for fit, known in ((sgd.fit_svd, False), (sgd.fit_nmf, True)):
        model = fit(train, rank=3, epochs=2, blocks=3)
        got, want = (sorted(map(tuple, sgd.predict(m, pairs, -99, 99, known).collect()), key=str) for m in (model, sgd.Factors(model.mu, model.state)))
        assert [r[:3] for r in got] == [r[:3] for r in want] and all(abs(a[3] - b[3]) < 2e-6 for a, b in zip(got, want))
        assert sgd.predict(model, pairs.limit(0)).count() == 0
