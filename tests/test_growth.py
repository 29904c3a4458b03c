"""Steps whose time or shuffles grew faster than their input: the same results by the cheaper way."""

from __future__ import annotations

import numpy as np
import pytest

from cellar.operators import factor, fold_in, inner_product, lsh, products, similarity, stats


@pytest.mark.parametrize("heavy", [stats.HEAVY_KEY, 6])
def test_averages_and_medians_of_light_and_heavy_keys(spark, monkeypatch, heavy):
    r = np.random.default_rng(2)
    data = [(None if k == 0 else int(k), *(None if x == 0 else float("nan") if x == 1 else float(x) / 4 for x in r.integers(0, 9, 2))) for k in r.integers(0, 20, 120)]
    data.append((99, None, None))
    df = spark.createDataFrame(data, "k long, x double, y double")
    monkeypatch.setattr(stats, "HEAVY_KEY", heavy)
    if heavy > 6:  # no key is heavy: nothing goes by value counts
        monkeypatch.setattr(stats, "value_counts", None)
    for decimals in (None, 2):
        got = {row["k"]: row for row in stats.avg_median(df, "k", ["x", "y"], decimals).collect()}
        assert got.keys() == {d[0] for d in data} - {None}
        for k, row in got.items():
            for c, at in (("x", 1), ("y", 2)):
                v = [d[at] for d in data if d[0] == k and d[at] is not None and d[at] == d[at]]
                want = (np.mean(v), np.median(v)) if v else (None, None)
                assert (row[f"{c}_avg"], row[f"{c}_med"]) == (pytest.approx(want[0], abs=1e-6), want[1])


def test_products_under_bounds_and_floors_are_those_of_all_items():
    r = np.random.default_rng(7)
    u, v = np.abs(r.normal(size=(90, 6))), np.abs(r.normal(size=(1500, 6))) * r.pareto(2, 1500)[:, None]
    v[700] = v[3]
    v = v[np.argsort(-np.linalg.norm(v, axis=1), kind="stable")]
    ids = r.permutation(1500)
    s = np.round(u @ v.T, 6)
    want = [np.lexsort((ids, -s[q]))[:8].tolist() for q in range(90)]
    floor = np.sort(s[:, :64], axis=1)[:, -8]
    for given in (None, floor):
        row, col, _ = products.best(u, v, 8, ids=ids, floor=given, bounds=products.Bounds(v, 64))
        assert [col[row == q].tolist() for q in range(90)] == want


def test_a_user_is_shuffled_once_for_a_run_of_blocks(spark, monkeypatch):
    """Blocks that no bound leaves out: a user met every one of them in a row of its own before."""
    r = np.random.default_rng(9)
    frame = lambda x: spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], "id long, features array<double>")
    u, v = r.normal(size=(40, 4)), r.normal(size=(2000, 4))
    v /= np.linalg.norm(v, axis=1)[:, None]
    met, written = [], inner_product.materialize
    monkeypatch.setattr(inner_product, "materialize", lambda df, name: met.append((name, written(df, name))) or met[-1][1])
    got = inner_product.search(frame(u), frame(v), 5, block_size=16)[0].collect()
    begun = dict(met)["mips-first"]
    assert begun.selectExpr("max(size(runs))").first()[0] <= products.blocks(40, 2000, 2048, 8)[1]
    s = np.round(u @ v.T, 6)
    assert {(x["uid"], x["rank"], x["item_id"]) for x in got} == {(q, p + 1, int(i)) for q in range(40) for p, i in enumerate(np.lexsort((np.arange(2000), -s[q]))[:5])}


def test_vectors_travel_by_pairs_of_blocks_not_by_cell(spark, monkeypatch):
    """64 cells in 3 tables, all within reach: a vector was copied to each of them, on both sides."""
    r = np.random.default_rng(1)
    x = r.normal(size=(300, 8))
    x[40:60] = x[40]
    df = spark.createDataFrame([(i, [float(f) for f in row]) for i, row in enumerate(x)], "vec_id long, embedding array<float>")
    copies, pairs = [], products.pairs_of_blocks
    monkeypatch.setattr(products, "pairs_of_blocks", lambda *a: copies.append(pairs(*a)) or copies[-1])
    got = lsh.cosine_topk_lsh(df, "vec_id", "embedding", 4, tables=3, recall=1.0, sample=300, cell_rows=8).collect()
    assert sum(c.count() for c in copies) <= 2 * 281  # distinct vectors
    want = similarity.cosine_topk_dense(df, "vec_id", "embedding", 4).collect()
    rows = lambda f: {(a["vec_id"], a["sim_vec_id"], a["rank"]) for a in f}
    assert len(rows(got) & rows(want)) >= 0.99 * len(want)


def test_ratings_are_not_shuffled_for_heavy_users_where_there_are_none(spark, monkeypatch):
    factors = spark.createDataFrame([(i, [1.0 + i, 2.0]) for i in range(4)], "id int, features array<float>")
    ratings = spark.createDataFrame([(u, i, float(1 + (u + i) % 5)) for u in range(5) for i in range(4)], "uid long, item_id long, score double")
    plans, written = [], fold_in.materialize
    monkeypatch.setattr(fold_in, "materialize", lambda df, name: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or written(df, name))
    got = {r["id"]: r["features"] for r in fold_in.fold_in(factors, ratings, 0.1).collect()}
    monkeypatch.setattr(fold_in, "HEAVY", 2)  # now every user is heavy, and summed in parts
    parts = {r["id"]: r["features"] for r in fold_in.fold_in(factors, ratings, 0.1).collect()}
    assert [p.count("Join ") for p in plans] == [1, 2]
    assert got.keys() == parts.keys() and all(np.allclose(got[u], parts[u]) for u in got)


def test_nonnegative_solutions_do_not_depend_on_who_is_solved_beside():
    """A slow user kept the whole batch in its sweeps, and moved the others' last digits."""
    r = np.random.default_rng(5)
    q = np.abs(r.normal(size=(40, 12, 6))) + np.where(np.arange(40) % 8 == 0, 3.0, 0.0)[:, None, None]  # some are slow
    a, b, n = np.einsum("nij,nik->njk", q, q), np.einsum("nij,ni->nj", q, r.integers(1, 6, (40, 12))), np.full(40, 12.0)
    all_ = fold_in._solve(a, b, n, 0.01, True)
    one = np.concatenate([fold_in._solve(a[i : i + 1], b[i : i + 1], n[i : i + 1], 0.01, True) for i in range(40)])
    assert np.abs(all_ - one).max() < 1e-6
    grad = np.einsum("njk,nk->nj", a + 0.12 * np.eye(6), all_) - b
    assert (all_ >= 0).all() and grad.min() > -1e-4 and np.abs(grad * all_).max() < 1e-3


@pytest.mark.parametrize("block_size", (10, 1000))
def test_text_neighbours_leave_the_matrix_trimmed(spark, monkeypatch, block_size):
    """Every pair shares a term: all products of a group became rows before they were trimmed."""
    r = np.random.default_rng(11)
    x = np.where(r.random((70, 12)) < 0.4, r.random((70, 12)), 0.0)
    x[:, 0] = 0.2
    x[20:26] = x[20]  # equal items
    x /= np.linalg.norm(x, axis=1)[:, None]
    left = similarity.pd.DataFrame([(i, f"t{d}", x[i, d]) for i, d in zip(*np.nonzero(x))], columns=["e", "d", "v"])
    assert len(similarity._dense_dot(left, left, "e", "d", "v", True, 3)) <= 70 * 3 + 6 * 6
    df = spark.createDataFrame(left, "e long, d string, v double")
    got = {(p["e"], p["rank"]): (p["sim_e"], p["sim"]) for p in similarity.cosine_topk_long(df, "e", "d", "v", 3, block_size).collect()}
    s = np.round(x @ x.T, 6)
    np.fill_diagonal(s, -1)
    want = {(e, p + 1): (int(j), s[e, j]) for e in range(70) for p, j in enumerate(np.lexsort((np.arange(70), -s[e]))[:3])}
    assert got.keys() == want.keys() and all(got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) < 2e-6 for k in want)


def test_a_short_fit_solves_no_item_again_for_a_checkpoint(spark):
    """The items of the first iteration were solved twice, to write them; the factors are the same without."""
    assert [factor.als(max_iter=n).getCheckpointInterval() for n in (0, 10, 11)] == [-1, -1, 10]
    assert factor.als(checkpoint=2).getCheckpointInterval() == 2
    ratings = spark.createDataFrame([(u, i, float(1 + (u * i) % 5)) for u in range(12) for i in range(9) if (u + i) % 3], "uid long, item_id long, score double")
    a, b = ({r["id"]: r["features"] for r in factor.als(checkpoint=c).fit(ratings).itemFactors.collect()} for c in (None, 10))
    assert a.keys() == b.keys() == set(range(9)) and all(np.allclose(a[k], b[k], atol=1e-5) for k in a)
