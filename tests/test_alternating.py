"""The least-squares grid against Spark's own fits, point by point."""

from __future__ import annotations

import numpy as np
import pytest

import __spark_entry__ as E
from cellar.operators import alternating, evaluate, factor
from tests.conftest import SF_SMALL

SCHEMA = "uid bigint, item_id bigint, score double"


@pytest.mark.parametrize("blocks", (1, 3))
def test_a_grid_gives_what_single_fits_give(spark, blocks, monkeypatch):
    monkeypatch.setattr(alternating, "VALUES", 40)  # many ratings of one id come in parts
    r = np.random.default_rng(3)
    pairs = sorted({(int(u), int(i)) for u, i in zip(r.zipf(1.3, 1500) % 50, r.integers(0, 30, 1500))})
    rows = [(u, i, float(r.integers(1, 6))) for u, i in pairs]
    train = spark.createDataFrame(rows[::2] + rows[1::4], SCHEMA)
    # unseen users and items, and a row without a score, are predicted too
    test = spark.createDataFrame([*rows[3::4], (900, 1, 2.0), (1, 900, 3.0), (901, 901, 5.0), (2, 3, None)], SCHEMA)
    grid = [(1, 0.05), (4, 0.5)]
    got = alternating.biased_mf_grid(train, test, grid, rank=6, blocks=blocks)
    assert list(got) == grid
    key = lambda x: (x["true_r"] is None, x["true_r"], x["est"])
    for n, reg in grid:
        base, model = factor.fit_biased_mf(train, rank=6, reg=reg, max_iter=n)
        want = factor.predict_biased_mf(base, model, test).select("true_r", "est")
        a, b = (sorted(x.collect(), key=key) for x in (got[n, reg], want))
        assert [x["true_r"] for x in a] == [x["true_r"] for x in b]
        assert max(abs(x["est"] - y["est"]) for x, y in zip(a, b)) < 2e-4  # the fit works in single precision
        assert abs(evaluate.rmse_mae(got[n, reg]).first()["rmse"] - evaluate.rmse_mae(want).first()["rmse"]) < 1e-5


def test_the_residual_grid_fits_no_point_alone(spark, monkeypatch):
    fitted, als = [], factor.als
    monkeypatch.setattr(factor, "als", lambda **params: fitted.append(params["max_iter"]) or als(**params))
    rows = E.queries()["residual_grid_search"](spark, SF_SMALL).collect()
    assert len(rows) == 6 and sorted(r["rank"] for r in rows) == [1, 2, 3, 4, 5, 6]
    assert fitted == [0, 0, 0]  # a fold's first factors; 18 fits of 10 and 20 iterations before
