"""Queries for predictors and their evaluation (baseline, ALS, metrics, CV, grid search)."""

from __future__ import annotations

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Window
from pyspark.sql import functions as F

from cellar.functions.exprs import rnd
from cellar.operators import alternating, evaluate, factor, fold_in, inner_product, sgd
from cellar.plans.registry import query, sql
from cellar.session import materialize, scratch_path
from cellar.sources.tables import Tables, fold_of, train_test

K_TOP = 10
PR_K = 5
PR_THRESHOLD = 3.0  # the fixture's scores are uniform on 1..5 (mean 3)
GRID = [(5.0, 10.0), (5.0, 25.0), (10.0, 15.0), (25.0, 10.0), (25.0, 25.0)]

_BASE = """
, mu AS (SELECT avg(score) AS mu FROM train),
bi AS (SELECT item_id, sum(score - (SELECT mu FROM mu)) / (10.0::DOUBLE + count(*)) AS b_i, count(*) AS n_i
       FROM train GROUP BY item_id),
bu AS (SELECT t.uid, sum(t.score - (SELECT mu FROM mu) - bi.b_i) / (15.0::DOUBLE + count(*)) AS b_u, count(*) AS n_u
       FROM train t JOIN bi ON bi.item_id = t.item_id GROUP BY t.uid),
pred AS (SELECT t.uid, t.item_id, t.score AS true_r,
                round(least(greatest((SELECT mu FROM mu) + coalesce(bu.b_u, 0) + coalesce(bi.b_i, 0), 1.0), 5.0), 6) AS est
         FROM test t LEFT JOIN bi ON bi.item_id = t.item_id LEFT JOIN bu ON bu.uid = t.uid)
"""


def baseline_preds(t: Tables):
    train, test = train_test(t.ratings_table())
    model = factor.fit_baseline(train)
    return factor.prediction_rows(factor.predict_baseline(model, test)), train, model


@query("split_counts", sql("""
SELECT CASE WHEN (uid * 31 + item_id) % 5 = 0 THEN 'test' ELSE 'train' END AS split, count(*) AS n
FROM ratings GROUP BY 1
"""))
def split_counts(t: Tables):
    """M1: deterministic 80/20 split by key arithmetic."""
    key = F.pmod(F.col("uid") * 31 + F.col("item_id"), F.lit(5))
    s = F.when(key == 0, "test").otherwise("train")
    return t.ratings().groupBy(s.alias("split")).agg(F.count(F.lit(1)).alias("n"))


@query("baseline_biases", sql(_BASE + """
SELECT 'item' AS kind, item_id AS id, round(b_i, 6) AS bias, n_i AS n FROM bi
UNION ALL SELECT 'user', uid, round(b_u, 6), n_u FROM bu
"""))
def baseline_biases(t: Tables):
    """M9 + M4: the fitted item and user biases."""
    train, _ = train_test(t.ratings_table())
    m = factor.fit_baseline(train)
    i = m.item_bias.select(F.lit("item").alias("kind"), F.col("item_id").alias("id"), rnd("b_i").alias("bias"), F.col("n_i").alias("n"))
    u = m.user_bias.select(F.lit("user").alias("kind"), F.col("uid").alias("id"), rnd("b_u").alias("bias"), F.col("n_u").alias("n"))
    return i.unionByName(u)


@query("baseline_predictions", sql(_BASE + "SELECT * FROM pred"))
def baseline_predictions(t: Tables):
    """M3 + P13: held-out predictions of the baseline, clamped to 1..5."""
    return baseline_preds(t)[0]


@query("prediction_errors", sql(_BASE + "SELECT *, round(abs(est - true_r), 6) AS err FROM pred"))
def prediction_errors(t: Tables):
    return evaluate.with_error(baseline_preds(t)[0])


@query("prediction_support", sql(_BASE + """
, nu AS (SELECT uid, count(*) AS n_u FROM train GROUP BY uid),
ni AS (SELECT item_id, count(*) AS n_i FROM train GROUP BY item_id)
SELECT p.*, coalesce(nu.n_u, 0) AS n_u, coalesce(ni.n_i, 0) AS n_i
FROM pred p LEFT JOIN nu ON nu.uid = p.uid LEFT JOIN ni ON ni.item_id = p.item_id
"""))
def prediction_support(t: Tables):
    """Training support of each prediction's user and item."""
    pred, train, _ = baseline_preds(t)
    return evaluate.with_support(pred, train)


@query("best_worst_predictions", sql(_BASE + """
, e AS (SELECT *, round(abs(est - true_r), 6) AS err FROM pred)
(SELECT *, 'best' AS tag FROM e ORDER BY err, uid, item_id LIMIT 10)
UNION ALL (SELECT *, 'worst' AS tag FROM e ORDER BY err DESC, uid, item_id LIMIT 10)
"""))
def best_worst_predictions(t: Tables):
    """T5: the 10 best and 10 worst predictions by absolute error."""
    from cellar.operators.stats import best_worst

    return best_worst(evaluate.with_error(baseline_preds(t)[0]), "err", 10, ["uid", "item_id"])


@query("best_item_per_user", sql(_BASE + """
SELECT uid, arg_max(item_id, (est, -item_id)) AS item_id, max(est) AS est FROM pred GROUP BY uid
"""))
def best_item_per_user(t: Tables):
    """Each user's arg-max item by estimate (ties: smaller item id)."""
    from cellar.operators.stats import best_per_key

    return best_per_key(baseline_preds(t)[0], "uid", "item_id", "est")


@query("top_n_per_user", sql(_BASE + f"""
, r AS (SELECT *, CAST(row_number() OVER (PARTITION BY uid ORDER BY est DESC, item_id) AS BIGINT) AS rank FROM pred)
SELECT * FROM r WHERE rank <= {K_TOP}
"""))
def top_n_per_user(t: Tables):
    """The 10 best held-out predictions per user."""
    return evaluate.top_n(baseline_preds(t)[0], K_TOP)


@query("topn_as_array", sql(_BASE + f"""
, r AS (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY est DESC, item_id) AS rank FROM pred)
SELECT uid, string_agg(CAST(item_id AS VARCHAR) || ':' || CAST(est AS VARCHAR), ',' ORDER BY rank) AS recs
FROM r WHERE rank <= {K_TOP} GROUP BY uid
"""))
def topn_as_array(t: Tables):
    """each user's top-10 list as one ordered value."""
    return evaluate.top_n_as_text(baseline_preds(t)[0], K_TOP)


@query("rmse_mae", sql(_BASE + """
SELECT round(sqrt(avg((true_r - est) * (true_r - est))), 6) AS rmse, round(avg(abs(true_r - est)), 6) AS mae,
       count(*) AS n FROM pred
"""))
def rmse_mae(t: Tables):
    return evaluate.rmse_mae(baseline_preds(t)[0])


_PR = _BASE + f"""
, r AS (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY est DESC, item_id) AS rank FROM pred),
g AS (SELECT uid, CAST(count_if(true_r >= {PR_THRESHOLD}) AS BIGINT) AS n_rel,
             CAST(count_if(rank <= {PR_K} AND est >= {PR_THRESHOLD}) AS BIGINT) AS n_rec_k,
             CAST(count_if(true_r >= {PR_THRESHOLD} AND rank <= {PR_K} AND est >= {PR_THRESHOLD}) AS BIGINT) AS n_rel_rec_k
      FROM r GROUP BY uid),
pu AS (SELECT uid, n_rel, n_rec_k, n_rel_rec_k,
              round(CASE WHEN n_rec_k <> 0 THEN n_rel_rec_k / n_rec_k ELSE 0 END, 6) AS precision,
              round(CASE WHEN n_rel <> 0 THEN n_rel_rec_k / n_rel ELSE 0 END, 6) AS recall FROM g)
"""


@query("precision_recall_per_user", sql(_PR + "SELECT * FROM pu"))
def precision_recall_per_user(t: Tables):
    """Precision and recall at k per user."""
    return evaluate.precision_recall_per_user(baseline_preds(t)[0], PR_K, PR_THRESHOLD)


@query("precision_recall_at_k", sql(_PR + """
SELECT round(avg(precision), 6) AS precision_at_k, round(avg(recall), 6) AS recall_at_k, count(*) AS n_users FROM pu
"""))
def precision_recall_at_k(t: Tables):
    """M16 + A17: mean precision and recall at k over users."""
    return evaluate.precision_recall_at_k(baseline_preds(t)[0], PR_K, PR_THRESHOLD)


def _cv_sql(grid, k):
    g = ", ".join(f"({a}::DOUBLE, {b}::DOUBLE)" for a, b in grid)
    return f"""
, f AS (SELECT r.*, (r.uid * 31 + r.item_id) % {k} AS own, fo.fold FROM ratings r, range({k}) fo(fold)),
tr AS (SELECT * FROM f WHERE own <> fold), te AS (SELECT * FROM f WHERE own = fold),
g AS (SELECT * FROM (VALUES {g}) v(reg_i, reg_u)),
mu AS (SELECT fold, avg(score) AS mu FROM tr GROUP BY fold),
isum AS (SELECT tr.fold, item_id, sum(score - mu.mu) AS si, count(*) AS ni FROM tr JOIN mu ON mu.fold = tr.fold
         GROUP BY tr.fold, item_id),
bi AS (SELECT fold, item_id, ri.reg_i, si / (ri.reg_i + ni) AS b_i FROM isum, (SELECT DISTINCT reg_i FROM g) ri),
usum AS (SELECT tr.fold, bi.reg_i, tr.uid, sum(tr.score - mu.mu - bi.b_i) AS su, count(*) AS nu
         FROM tr JOIN mu ON mu.fold = tr.fold JOIN bi ON bi.fold = tr.fold AND bi.item_id = tr.item_id
         GROUP BY tr.fold, bi.reg_i, tr.uid),
bu AS (SELECT usum.fold, usum.reg_i, g.reg_u, usum.uid, su / (g.reg_u + nu) AS b_u FROM usum JOIN g ON g.reg_i = usum.reg_i),
p AS (SELECT te.fold, g.reg_i, g.reg_u, te.score,
             round(least(greatest(mu.mu + coalesce(bu.b_u, 0) + coalesce(bi.b_i, 0), 1.0), 5.0), 6) AS est
      FROM te JOIN mu ON mu.fold = te.fold CROSS JOIN g
      LEFT JOIN bi ON bi.fold = te.fold AND bi.item_id = te.item_id AND bi.reg_i = g.reg_i
      LEFT JOIN bu ON bu.fold = te.fold AND bu.reg_i = g.reg_i AND bu.reg_u = g.reg_u AND bu.uid = te.uid),
pf AS (SELECT reg_i, reg_u, fold, sqrt(avg((score - est) * (score - est))) AS rmse, avg(abs(score - est)) AS mae,
              count(*) AS n FROM p GROUP BY reg_i, reg_u, fold)
"""


@query("baseline_cv_rmse", sql(_cv_sql([(factor.REG_ITEM, factor.REG_USER)], 3) + """
SELECT CAST(fold AS INTEGER) AS fold, round(rmse, 6) AS rmse, round(mae, 6) AS mae, n FROM pf
"""))
def baseline_cv_rmse(t: Tables):
    """3-fold cross-validated RMSE and MAE of the baseline, one plan for all folds."""
    pf = evaluate.baseline_cv(t.ratings_table(), 3)
    return pf.select(F.col("fold").cast("int").alias("fold"), rnd("rmse").alias("rmse"), rnd("mae").alias("mae"), "n")


@query("baseline_grid_search", sql(_cv_sql(GRID, 3) + """
, m AS (SELECT reg_i, reg_u, avg(rmse) AS rmse, avg(mae) AS mae FROM pf GROUP BY reg_i, reg_u)
SELECT reg_i, reg_u, round(rmse, 6) AS rmse, round(mae, 6) AS mae,
       CAST(row_number() OVER (ORDER BY round(rmse, 6), reg_i, reg_u) AS BIGINT) AS rank FROM m
"""))
def baseline_grid_search(t: Tables):
    """Grid over the two damping terms, 3-fold mean RMSE and MAE, ranked (best first)."""
    pf = evaluate.baseline_cv(t.ratings_table(), 3, GRID)
    m = pf.groupBy("reg_i", "reg_u").agg(rnd(F.avg("rmse")).alias("rmse"), rnd(F.avg("mae")).alias("mae"))
    # one row per grid point: a window over the grid, bounded by its size
    w = Window.orderBy("rmse", "reg_i", "reg_u")
    return m.withColumn("rank", F.row_number().over(w).cast("long"))


@query("baseline_score_all", sql(_BASE + f"""
, u AS (SELECT DISTINCT uid FROM train),
s AS (SELECT u.uid, bi.item_id, (SELECT mu FROM mu) + coalesce(bu.b_u, 0) + bi.b_i AS raw
      FROM u LEFT JOIN bu ON bu.uid = u.uid CROSS JOIN bi),
r AS (SELECT uid, item_id, round(least(greatest(raw, 1.0), 5.0), 6) AS est,
             CAST(row_number() OVER (PARTITION BY uid ORDER BY raw DESC, item_id) AS BIGINT) AS rank FROM s)
SELECT * FROM r WHERE rank <= {K_TOP}
"""))
def baseline_score_all(t: Tables):
    """M6 + J10 + T12: every training user's 10 best items over all items (no user x item product)."""
    train, _ = train_test(t.ratings_table())
    m = factor.fit_baseline(train)
    return factor.score_all_top(m, train.select("uid").distinct(), K_TOP)


@query("top_n_unseen_per_user", sql(_BASE + f"""
, u AS (SELECT DISTINCT uid FROM train),
s AS (SELECT u.uid, bi.item_id, bi.b_i, (SELECT mu FROM mu) + coalesce(bu.b_u, 0) + bi.b_i AS raw
      FROM u LEFT JOIN bu ON bu.uid = u.uid CROSS JOIN bi
      WHERE NOT EXISTS (SELECT 1 FROM train x WHERE x.uid = u.uid AND x.item_id = bi.item_id)),
r AS (SELECT uid, item_id, round(least(greatest(raw, 1.0), 5.0), 6) AS est,
             CAST(row_number() OVER (PARTITION BY uid ORDER BY b_i DESC, item_id) AS BIGINT) AS rank FROM s)
SELECT * FROM r WHERE rank <= {K_TOP}
"""))
def top_n_unseen_per_user(t: Tables):
    """T2 with D15b: every training user's 10 best items among those not rated in training."""
    train, _ = train_test(t.ratings_table())
    return factor.top_n_unseen(factor.fit_baseline(train), train, train, K_TOP)


@query("normal_predictor", sql("""
, g AS (SELECT avg(score) AS mu, stddev_pop(score) AS sd FROM train),
h AS (SELECT uid, item_id, score, md5('42a/' || uid || '/' || item_id) AS a, md5('42b/' || uid || '/' || item_id) AS b FROM test),
d AS (SELECT uid, item_id, score, (('0x' || a[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296.0::DOUBLE AS p,
             (('0x' || b[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296.0::DOUBLE AS q FROM h)
SELECT uid, item_id, score AS true_r, round(least(greatest(g.mu + g.sd * (sqrt(-2 * ln(p)) * cos(2 * pi() * q)), 1.0), 5.0), 6) AS est FROM d, g
"""))
def normal_predictor(t: Tables):
    """Random N(mu, sigma) predictions, clamped; the draw is a hash of the pair."""
    train, test = train_test(t.ratings_table())
    return factor.normal_predictor(train, test)


# ---- learned models: values have no oracle; companion keys check rows, ranges and ranks ----


def _als_fit(t: Tables, **params):
    train, test = train_test(t.ratings_table())
    model = factor.als(**params).fit(train)
    return model, train, test


@query("als_predictions")
def als_predictions(t: Tables):
    """M7 + M3: non-negative explicit ALS, held-out predictions clamped to 1..5."""
    model, _, test = _als_fit(t)
    return factor.als_predict(model, test)


def _in_range(c: str = "est"):
    return F.col(c).between(1.0, 5.0).alias("in_range")


@query("als_prediction_rows", sql("""
SELECT uid, item_id, score AS true_r, true AS in_range FROM test
WHERE uid IN (SELECT uid FROM train) AND item_id IN (SELECT item_id FROM train)
"""))
def als_prediction_rows(t: Tables):
    """M7: the rows of the held-out predictions: all whose user and item are known, none else (cold rows are dropped)."""
    return als_predictions(t).select("uid", "item_id", "true_r", _in_range())


@query("als_item_factors")
def als_item_factors(t: Tables):
    """M4: the item factor table of a fitted ALS model."""
    model, _, _ = _als_fit(t)
    return model.itemFactors.select(F.col("id").alias("item_id"), F.size("features").alias("rank"), "features")


@query("als_factor_rows", sql("""
SELECT 'item' AS side, item_id AS id, 10 AS rank, true AS nonnegative FROM (SELECT DISTINCT item_id FROM train)
UNION ALL SELECT 'user', uid, 10, true FROM (SELECT DISTINCT uid FROM train)
"""))
def als_factor_rows(t: Tables):
    """M4: one factor row per training user and item, of the model's rank, without a negative value."""
    model, _, _ = _als_fit(t)
    sides = {"item": model.itemFactors, "user": model.userFactors}
    out = [f.select(F.lit(k).alias("side"), F.col("id").cast("long").alias("id"), F.size("features").alias("rank"), F.forall("features", lambda x: x >= 0).alias("nonnegative")) for k, f in sides.items()]
    return out[0].unionByName(out[1])


@query("als_recommend_all")
def als_recommend_all(t: Tables):
    """M5 + J10: top-10 items per user by the factor product, scored block pair by block pair."""
    model, _, _ = _als_fit(t)
    return factor.recommend_all(model.userFactors, model.itemFactors, K_TOP)


_RANKS = f"SELECT uid, CAST(r.r AS BIGINT) AS rank, true AS in_order FROM (SELECT DISTINCT uid FROM train) CROSS JOIN range(1, {K_TOP + 1}) r(r)"


def _rank_rows(recs):
    """(uid, rank, in_order): that a list has each rank once, no item twice and falling estimates."""
    w = Window.partitionBy("uid").orderBy("rank")
    same = F.count(F.lit(1)).over(Window.partitionBy("uid", "item_id"))
    falls = F.coalesce(F.lag("est").over(w) >= F.col("est"), F.lit(True))
    return recs.select("uid", "rank", (falls & (same == 1)).alias("in_order"))


@query("als_recommend_all_ranks", sql(_RANKS))
def als_recommend_all_ranks(t: Tables):
    """M5: every training user has ranks 1 to 10, different items, estimates that do not rise."""
    return _rank_rows(als_recommend_all(t))


@query("als_persist_reload")
def als_persist_reload(t: Tables):
    """Save a fitted model to the shared folder, load it back and predict."""
    model, path, test = _saved_model(t)
    return factor.als_predict(model.load(path), test)


def _saved_model(t: Tables):
    model, _, test = _als_fit(t)
    path = scratch_path(t.spark, "als-model")
    model.write().overwrite().save(path)
    return model, path, test


@query("als_reload_agrees", sql("""
SELECT count(*) AS n, 0 AS n_different FROM test WHERE uid IN (SELECT uid FROM train) AND item_id IN (SELECT item_id FROM train)
"""))
def als_reload_agrees(t: Tables):
    """A reloaded model gives the predictions of the model that was saved."""
    model, path, test = _saved_model(t)
    a = factor.als_predict(model, test)
    b = factor.als_predict(model.load(path), test).select("uid", "item_id", F.col("est").alias("again"))
    both = a.join(b, ["uid", "item_id"], "full")
    return both.agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("est").eqNullSafe(F.col("again"))).cast("int").alias("n_different"))


@query("biased_mf_predictions")
def biased_mf_predictions(t: Tables):
    """M2 re-aimed: baseline biases + signed ALS factors on the residuals, a row for every test row."""
    train, test = train_test(t.ratings_table())
    base, model = factor.fit_biased_mf(train)
    return factor.predict_biased_mf(base, model, test)


@query("biased_mf_prediction_rows", sql("SELECT uid, item_id, score AS true_r, true AS in_range FROM test"))
def biased_mf_prediction_rows(t: Tables):
    """M2: every test row is predicted within the scale, unseen users and items too."""
    return biased_mf_predictions(t).select("uid", "item_id", "true_r", _in_range())


@query("biased_mf_recommend_all")
def biased_mf_recommend_all(t: Tables):
    """M6 + J10 + T12: every training user's 10 best items by mean, biases and factors."""
    train, _ = train_test(t.ratings_table())
    base, model = factor.fit_biased_mf(train)
    return factor.biased_mf_recommend_all(base, model, K_TOP)


@query("biased_mf_recommend_all_ranks", sql(_RANKS))
def biased_mf_recommend_all_ranks(t: Tables):
    """M6: every training user has ranks 1 to 10, different items, estimates that do not rise."""
    return _rank_rows(biased_mf_recommend_all(t))


@query("als_max_inner_product")
def als_max_inner_product(t: Tables):
    """M5 + J10: the lists of ``als_recommend_all`` from a search that leaves out blocks of items by their bounds."""
    model, _, _ = _als_fit(t)
    return inner_product.search(model.userFactors, model.itemFactors, K_TOP)[0]


@query("als_max_inner_product_agrees", sql(f"SELECT DISTINCT uid, {K_TOP} AS n, true AS agrees FROM train"))
def als_max_inner_product_agrees(t: Tables):
    """M5: for every training user, the bounded search gives the list that all products give."""
    model, _, _ = _als_fit(t)
    a = inner_product.search(model.userFactors, model.itemFactors, K_TOP)[0]
    b = factor.recommend_all(model.userFactors, model.itemFactors, K_TOP)
    both = a.join(b.select("uid", "rank", F.col("item_id").alias("other"), F.col("est").alias("other_est")), ["uid", "rank"], "full")
    same = F.col("item_id").eqNullSafe(F.col("other")) & F.col("est").eqNullSafe(F.col("other_est"))
    return both.groupBy("uid").agg(F.count(F.lit(1)).cast("int").alias("n"), F.bool_and(same).alias("agrees"))


@query("als_fold_in_agrees", sql("SELECT uid, count(*) AS n, true AS agrees FROM train GROUP BY uid"))
def als_fold_in_agrees(t: Tables):
    """M20 + U1: every training user, folded into the model as a new one, gets the factors that the fit gave it."""
    model, train, _ = _als_fit(t)
    est = factor.als()
    folded = fold_in.fold_in(model.itemFactors, train, est.getRegParam(), est.getNonnegative())
    both = folded.join(model.userFactors.select("id", F.col("features").alias("own")), "id", "left")
    # the fit works in single precision
    same = F.forall(F.zip_with("features", F.col("own").cast("array<double>"), lambda x, y: F.abs(x - y) < FOLD_IN_AGREES), lambda x: x)
    return both.select(F.col("id").alias("uid"), "n", F.coalesce(same, F.lit(False)).alias("agrees"))


@query("svd_predictions")
def svd_predictions(t: Tables):
    """M2 + M3: biases and factors fitted jointly by stochastic gradient (100 factors, 20 epochs), a row for every test row."""
    train, test = train_test(t.ratings_table())
    return sgd.predict(sgd.fit_svd(train), test)


@query("svd_prediction_rows", sql("SELECT uid, item_id, score AS true_r, true AS in_range FROM test"))
def svd_prediction_rows(t: Tables):
    """M2: every test row is predicted within the scale, unseen users and items too."""
    return svd_predictions(t).select("uid", "item_id", "true_r", _in_range())


@query("svd_recommend_all")
def svd_recommend_all(t: Tables):
    """M6 + J10: every training user's 10 best items by the jointly fitted model."""
    train, _ = train_test(t.ratings_table())
    return sgd.recommend_all(sgd.fit_svd(train), K_TOP)[0]


@query("svd_recommend_all_ranks", sql(_RANKS))
def svd_recommend_all_ranks(t: Tables):
    """M6: every training user has ranks 1 to 10, different items, estimates that do not rise."""
    return _rank_rows(svd_recommend_all(t))


@query("nmf_predictions")
def nmf_predictions(t: Tables):
    """M8 + M3: non-negative factors by multiplicative updates, test rows of known users and items."""
    train, test = train_test(t.ratings_table())
    return sgd.predict(sgd.fit_nmf(train), test, known_only=True)


@query("nmf_factor_rows", sql(f"""
SELECT 0 AS side, uid AS id, {sgd.NMF_RANK} AS rank, true AS nonnegative, count(*) AS n FROM train GROUP BY uid
UNION ALL SELECT 1, item_id, {sgd.NMF_RANK}, true, count(*) FROM train GROUP BY item_id
"""))
def nmf_factor_rows(t: Tables):
    """M8 + M4: one factor row per training user and item, with its ratings counted and no negative value."""
    train, _ = train_test(t.ratings_table())
    state = sgd.fit_nmf(train).state
    return state.select("side", "id", F.size("factors").alias("rank"), F.forall("factors", lambda x: x >= 0).alias("nonnegative"), "n")


FOLDS = 3
FOLD_IN_AGREES = 1e-4
ALS_GRID = [(r, reg) for r in (10, 50, 100) for reg in (0.01, 0.05, 0.1)]
RESIDUAL_GRID = [(n, reg) for n in (10, 20) for reg in (0.4, 0.5, 0.6)]


@query("als_grid_points", sql(" UNION ALL ".join(f"SELECT {r} AS rank, CAST({x} AS DOUBLE) AS reg, true AS in_range, true AS one_best" for r, x in ALS_GRID)))
def als_grid_points(t: Tables):
    """A row per grid point, errors within the width of the scale, one test error of the one best point."""
    rows = materialize(als_grid_search(t), "als-grid")
    best = rows.select(F.min("best_test_rmse") == F.max("best_test_rmse")).scalar()
    return rows.select("rank", "reg", F.col("cv_rmse").between(0.0, 4.0).alias("in_range"), best.alias("one_best"))


@query("als_grid_search")
def als_grid_search(t: Tables):
    """3 x 3 grid over rank and regParam with 3-fold CrossValidator on the library's own folds; mean RMSE per grid point."""
    train, test = train_test(t.ratings_table())
    est = factor.als()
    grid = ParamGridBuilder().addGrid(est.rank, sorted({r for r, _ in ALS_GRID})).addGrid(est.regParam, sorted({x for _, x in ALS_GRID})).build()
    ev = RegressionEvaluator(metricName="rmse", labelCol="score", predictionCol="prediction")
    cv = CrossValidator(estimator=est, estimatorParamMaps=grid, evaluator=ev, numFolds=FOLDS, parallelism=4, seed=42, foldCol="fold")
    cvm = cv.fit(train.withColumn("fold", fold_of(FOLDS).cast("int")))
    rows = [
        (int(pm[est.rank]), float(pm[est.regParam]), float(m)) for pm, m in zip(grid, cvm.avgMetrics)
    ]
    pts = t.spark.createDataFrame(rows, "rank int, reg double, cv_rmse double")
    best = factor.als_predict(cvm.bestModel, test)
    test_rmse = best.select(F.sqrt(F.avg((F.col("true_r") - F.col("est")) ** 2))).scalar()
    return pts.select("rank", "reg", rnd("cv_rmse").alias("cv_rmse"), rnd(test_rmse).alias("best_test_rmse"))


def _residual_model(**params):
    def predict(train, test):
        base, model = factor.fit_biased_mf(train, **params)
        return factor.predict_biased_mf(base, model, test)

    return predict


@query("residual_grid_search")
def residual_grid_search(t: Tables):
    """Grid over iterations and regularisation of the biased factor model, 3-fold mean RMSE and MAE, ranked."""

    def points(train, test):
        return {f"{n}/{reg}": rows for (n, reg), rows in alternating.biased_mf_grid(train, test, RESIDUAL_GRID).items()}

    table = evaluate.cross_validate({"biased_mf": points}, t.ratings_table(), FOLDS)
    part = F.split("model", "/")
    m = table.groupBy("model").agg(rnd(F.avg("rmse")).alias("rmse"), rnd(F.avg("mae")).alias("mae"))
    m = m.select(part[0].cast("int").alias("iterations"), part[1].cast("double").alias("reg"), "rmse", "mae")
    return m.withColumn("rank", F.row_number().over(Window.orderBy("rmse", "iterations", "reg")).cast("long"))


@query("model_comparison")
def model_comparison(t: Tables):
    """M11 (model table) + H4 + F9: 3-fold mean RMSE and MAE of every predictor, 3 decimals."""

    def baseline(train, test):
        return factor.prediction_rows(factor.predict_baseline(factor.fit_baseline(train), test))

    models = {"baseline": baseline, "normal": factor.normal_predictor, "biased_mf": _residual_model(), "als_nonneg": evaluate.by_estimator(factor.als())}
    models["svd"] = lambda train, test: sgd.predict(sgd.fit_svd(train), test)
    models["nmf"] = lambda train, test: sgd.predict(sgd.fit_nmf(train), test, known_only=True)
    table = evaluate.cross_validate(models, t.ratings_table(), FOLDS)
    return table.groupBy("model").agg(rnd(F.avg("rmse"), 3).alias("rmse"), rnd(F.avg("mae"), 3).alias("mae"))


_CV_NORMAL = """
, fo AS (SELECT CAST(r.fold AS INTEGER) AS fold FROM range(3) r(fold)),
g AS (SELECT fold, avg(score) AS mu, stddev_pop(score) AS sd FROM ratings, fo WHERE (uid * 31 + item_id) % 3 <> fold GROUP BY fold),
h AS (SELECT (uid * 31 + item_id) % 3 AS fold, score, md5('42a/' || uid || '/' || item_id) AS a, md5('42b/' || uid || '/' || item_id) AS b FROM ratings),
d AS (SELECT fold, score, (('0x' || a[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296.0::DOUBLE AS p, (('0x' || b[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296.0::DOUBLE AS q FROM h),
e AS (SELECT d.fold, d.score - round(least(greatest(g.mu + g.sd * (sqrt(-2 * ln(p)) * cos(2 * pi() * q)), 1.0), 5.0), 6) AS e FROM d JOIN g ON g.fold = d.fold),
nf AS (SELECT 'normal' AS model, fold, round(sqrt(avg(e * e)), 6) AS rmse, round(avg(abs(e)), 6) AS mae, count(*) AS n FROM e GROUP BY fold)
"""


@query("model_comparison_folds", sql(_cv_sql([(factor.REG_ITEM, factor.REG_USER)], 3) + _CV_NORMAL.replace(", g AS", ", g2 AS").replace("JOIN g ON g.fold", "JOIN g2 g ON g.fold").replace("\ng AS", "\ng2 AS") + """
SELECT 'baseline' AS model, CAST(fold AS INTEGER) AS fold, round(rmse, 6) AS rmse, round(mae, 6) AS mae, n FROM pf
UNION ALL SELECT model, CAST(fold AS INTEGER), rmse, mae, n FROM nf
"""))
def model_comparison_folds(t: Tables):
    """M11 + H4: the fold rows of the table for the predictors that SQL can express."""

    def baseline(train, test):
        return factor.prediction_rows(factor.predict_baseline(factor.fit_baseline(train), test))

    return evaluate.cross_validate({"baseline": baseline, "normal": factor.normal_predictor}, t.ratings_table(), FOLDS)
