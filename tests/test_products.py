"""The k best products of every query: few groups and few rows out, whatever the products are."""

from __future__ import annotations

import numpy as np

from cellar.operators import products


def test_equal_products_give_no_more_than_k_rows_a_query():
    u, v = np.zeros((700, 4)), np.ones((20_000, 4))
    u[5] = 1.0
    row, col, est = products.best(u, v, 3)
    assert len(row) == 2100 and (col.reshape(700, 3) == [0, 1, 2]).all() and (est[row == 5] == 4.0).all()


def test_single_precision_loses_nothing():
    r = np.random.default_rng(4)
    u, v = r.normal(size=(600, 30)) * 50, 1 + r.normal(size=(9000, 30)) * 1e-4
    row, col, est = products.best(u, v, 7)
    want = np.argsort(-np.round(u @ v.T, 6), axis=1, kind="stable")[:, :7]
    assert (col.reshape(600, 7) == want).mean() > 0.999  # knife edges of the rounding
    assert np.abs(est - np.einsum("ij,ij->i", u[row], v[col])).max() < 1e-9


def test_many_rows_are_copied_seldom():
    nu, ni = products.blocks(900_000, 1_200_000, 2048, 12)
    assert nu <= 14 and ni <= 20 and nu * ni >= 12
    assert products.blocks(23, 31, 5, 8) == (5, 7)


def test_shuffles_of_large_fits_are_kept_for_few_iterations(spark, monkeypatch):
    from cellar.operators import factor

    frame = spark.createDataFrame([(u, i, float(1 + (u * i) % 5)) for u in range(12) for i in range(9)], "uid long, item_id long, score double")
    kept, als = [], factor.als
    monkeypatch.setattr(factor, "als", lambda **params: kept.append(params["checkpoint"]) or als(**params))
    got = []
    for size in (1 << 30, 0):
        monkeypatch.setattr(factor, "KEPT_BYTES", size)
        base, model = factor.fit_biased_mf(frame, rank=3, max_iter=5)
        got.append(sorted(map(tuple, factor.predict_biased_mf(base, model, frame).collect())))
    assert kept == [10, 2] and got[0] == got[1]
