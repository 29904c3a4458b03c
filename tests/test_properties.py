"""Property checks (hypothesis) of the exact custom operators against numpy."""

from __future__ import annotations

import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cellar.functions.quantiles import exact_quantiles
from cellar.operators import similarity

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(
    vals=st.lists(st.integers(min_value=-20, max_value=20), min_size=1, max_size=200),
    q=st.sampled_from([0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]),
    size=st.sampled_from([1, 3, 10, 1000]),
)
def test_exact_quantile_equals_numpy(spark, vals, q, size):
    df = spark.createDataFrame([(float(v),) for v in vals], "v double")
    got = exact_quantiles(df, "v", [q], names=["x"], rows_per_range=size).first()["x"]
    assert np.isclose(got, np.quantile(np.array(vals, dtype=float), q))


@settings(max_examples=50, deadline=None)
@given(
    rows=st.lists(
        st.tuples(st.integers(0, 6), st.integers(0, 12), st.integers(1, 5)), min_size=1, max_size=80, unique_by=lambda r: (r[0], r[1])
    )
)
def test_moment_sums_equal_pairwise_brute_force(rows):
    lt = pd.DataFrame({"a": [r[0] for r in rows], "d": [r[1] for r in rows], "x": [float(r[2]) for r in rows]})
    rt = lt.rename(columns={"a": "b", "x": "y"})
    got = similarity._moment_sums(lt, rt, True).set_index(["a", "b"])
    by = {}
    for a, d, x in rows:
        by.setdefault(a, {})[d] = float(x)
    for a in by:
        for b in by:
            if a >= b:
                continue
            common = set(by[a]) & set(by[b])
            if not common:
                assert (a, b) not in got.index
                continue
            r = got.loc[(a, b)]
            assert r["n"] == len(common)
            assert r["sxy"] == sum(by[a][d] * by[b][d] for d in common)
            assert r["sx"] == sum(by[a][d] for d in common) and r["sy"] == sum(by[b][d] for d in common)
