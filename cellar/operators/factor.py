"""Rating predictors: damped baseline, ALS, biased factorisation, random normal."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellar.functions.exprs import clamp, nan_to_null, rnd
from cellar.operators import products
from cellar.operators.stats import row_positions

# The damping terms of a baseline predictor's item and user
# biases by default (regularisation 10 for items, 15 for users).
REG_ITEM = 10.0
REG_USER = 15.0
KEPT_BYTES = 8 << 30  # of shuffled factors an iteration, from which on few iterations' are kept on disk


@dataclass
class Baseline:
    """mu + b_u + b_i; ``mu`` is a scalar-subquery column, biases are small tables."""

    mu: Column
    item_bias: DataFrame  # (item_id, b_i, n_i)
    user_bias: DataFrame  # (uid, b_u, n_u)


def fit_baseline(train: DataFrame, reg_i: float = REG_ITEM, reg_u: float = REG_USER) -> Baseline:
    """M9: damped means, b_i = sum(r - mu) / (reg_i + n_i), then b_u = sum(r - mu - b_i) / (reg_u + n_u).

    Two grouped aggregations and one join; the global mean is a scalar subquery
    (computed once, not joined).
    """
    mu = train.select(F.avg("score")).scalar()
    bi = train.groupBy("item_id").agg(
        (F.sum(F.col("score") - mu) / (F.lit(reg_i) + F.count(F.lit(1)))).alias("b_i"),
        F.count(F.lit(1)).alias("n_i"),
    )
    bu = (
        train.join(bi.select("item_id", "b_i"), "item_id")
        .groupBy("uid")
        .agg(
            (F.sum(F.col("score") - mu - F.col("b_i")) / (F.lit(reg_u) + F.count(F.lit(1)))).alias("b_u"),
            F.count(F.lit(1)).alias("n_u"),
        )
    )
    return Baseline(mu, bi, bu)


def predict_baseline(model: Baseline, pairs: DataFrame, lo: float = 1.0, hi: float = 5.0) -> DataFrame:
    """M3 + P13: est = clamp(mu + b_u + b_i) with unknown biases as 0; keeps the pair columns."""
    j = pairs.join(model.item_bias.select("item_id", "b_i"), "item_id", "left").join(
        model.user_bias.select("uid", "b_u"), "uid", "left"
    )
    raw = model.mu + F.coalesce(F.col("b_u"), F.lit(0.0)) + F.coalesce(F.col("b_i"), F.lit(0.0))
    return j.withColumn("est", rnd(clamp(raw, lo, hi))).drop("b_i", "b_u")


def prediction_rows(pred: DataFrame) -> DataFrame:
    """The prediction contract of every evaluation operator: (uid, item_id, true_r, est)."""
    return pred.select("uid", "item_id", F.col("score").alias("true_r"), "est")


def score_all_top(model: Baseline, users: DataFrame, n: int = 10, lo: float = 1.0, hi: float = 5.0) -> DataFrame:
    """M6 + J10 + T12: every user's n best items by mu + b_u + b_i.

    Within one user the order of mu + b_u + b_i is the order of b_i, so the n
    best items are the same for all users: they are taken once as an n-element
    array (a scalar subquery, bounded by n) and exploded per user. Ties in the
    clamped estimate are broken by the unclamped one, then by item id. No
    user x item product is formed.
    """
    top = (
        model.item_bias.orderBy(F.desc("b_i"), F.asc("item_id"))
        .limit(n)
        .agg(F.sort_array(F.collect_list(F.struct((-F.col("b_i")).alias("nb"), F.col("item_id"))), True).alias("a"))
    )
    arr = top.select("a").scalar()
    u = users.join(model.user_bias.select("uid", "b_u"), "uid", "left")
    x = u.select("uid", "b_u", F.posexplode(arr).alias("pos", "it"))
    raw = model.mu + F.coalesce(F.col("b_u"), F.lit(0.0)) - F.col("it.nb")
    return x.select(
        "uid",
        F.col("it.item_id").alias("item_id"),
        rnd(clamp(raw, lo, hi)).alias("est"),
        (F.col("pos") + 1).cast("long").alias("rank"),
    )


# ---- ALS family --------------------------------------------------------------


def als(rank: int = 10, reg: float = 0.1, nonnegative: bool = True, max_iter: int = 10, seed: int = 42, cold: str = "drop", checkpoint: int | None = None) -> ALS:
    """M7: explicit ALS on (uid, item_id, score); ``cold`` "drop" leaves out rows of unseen users or items, "nan" keeps them.

    Every ``checkpoint`` iterations, beginning with the first, the item factors are written and the shuffles before
    them deleted; to write them Spark solves for them again. If not given it is 10, and up to 10 iterations none:
    that of the first alone would cut off next to nothing.
    """
    if checkpoint is None:
        checkpoint = 10 if max_iter > 10 else -1
    return ALS(
        userCol="uid",
        itemCol="item_id",
        ratingCol="score",
        rank=rank,
        regParam=reg,
        maxIter=max_iter,
        nonnegative=nonnegative,
        implicitPrefs=False,
        coldStartStrategy=cold,
        checkpointInterval=checkpoint,
        seed=seed,
    )


def als_predict(model: ALSModel, test: DataFrame, lo: float = 1.0, hi: float = 5.0) -> DataFrame:
    p = model.transform(test)
    return p.select("uid", "item_id", F.col("score").alias("true_r"), rnd(clamp(F.col("prediction"), lo, hi)).alias("est"))


def fit_biased_mf(train: DataFrame, rank: int = 100, reg: float = 0.05, max_iter: int = 20, seed: int = 42):
    """M2 re-aimed: baseline biases, then signed ALS on the residuals r - mu - b_u - b_i.

    Runs a job for the number of ratings: an iteration shuffles up to two vectors a rating, and where these are
    many they are kept for few iterations. That costs time (a checkpoint solves for the items again), not results.
    """
    base = fit_baseline(train)
    resid = predict_baseline(base, train, lo=-1e9, hi=1e9).select(
        "uid", "item_id", (F.col("score") - F.col("est")).alias("score")
    )
    checkpoint = 2 if 8 * rank * train.count() > KEPT_BYTES else 10
    model = als(rank=rank, reg=reg, nonnegative=False, max_iter=max_iter, seed=seed, cold="nan", checkpoint=checkpoint).fit(resid)
    return base, model


def predict_biased_mf(base: Baseline, model: ALSModel, test: DataFrame, lo: float = 1.0, hi: float = 5.0) -> DataFrame:
    """Every test row: mu + b_u + b_i + p_u . q_i; an unseen user or item has no factors, so the baseline remains."""
    b = predict_baseline(base, test, lo=-1e9, hi=1e9).withColumnRenamed("est", "_b")
    p = model.transform(b)
    dot = F.coalesce(nan_to_null(F.col("prediction").cast("double")), F.lit(0.0))
    return p.select("uid", "item_id", F.col("score").alias("true_r"), rnd(clamp(F.col("_b") + dot, lo, hi)).alias("est"))


def biased_mf_recommend_all(base: Baseline, model: ALSModel, k: int = 10, lo: float = 1.0, hi: float = 5.0, block_size: int = 2048) -> DataFrame:
    """M6 + J10 + T12: every training user's k best items by mu + b_u + b_i + p_u . q_i, clamped.

    The biases are appended to the factors as (b_u, 1) and (1, b_i), so the
    block products of ``recommend_all`` give the whole formula. Lists are
    ranked before clamping.
    """
    none = F.array_repeat(F.lit(0.0), model.rank)

    def widened(biases: DataFrame, key: str, factors: DataFrame, extra) -> DataFrame:
        f = factors.select(F.col("id").cast("long").alias(key), F.col("features").cast("array<double>").alias("_f"))
        return biases.join(f, key, "left").select(F.col(key).alias("id"), F.concat(F.coalesce("_f", none), extra).alias("features"))

    users = widened(base.user_bias, "uid", model.userFactors, F.array("b_u", F.lit(1.0)))
    items = widened(base.item_bias, "item_id", model.itemFactors, F.array(F.lit(1.0), "b_i"))
    best = recommend_all(users, items, k, block_size)
    return best.withColumn("est", rnd(clamp(base.mu + F.col("est"), lo, hi)))


def _uniform(seed: int, salt: str):
    """A repeatable draw from (0, 1) for a (uid, item_id) pair: 32 bits of a hash of the pair and the seed."""
    key = F.concat_ws("/", F.lit(f"{seed}{salt}"), F.col("uid").cast("string"), F.col("item_id").cast("string"))
    return (F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 32))


def normal_predictor(train: DataFrame, test: DataFrame, seed: int = 42, lo: float = 1.0, hi: float = 5.0) -> DataFrame:
    """Est ~ N(mu, sigma) of the training scores (sigma over all of them), clamped.

    The draw is a hash of the pair (Box-Muller), so it does not depend on the
    partition layout or on a task's retry.
    """
    mu = train.select(F.avg("score")).scalar()
    sd = train.select(F.stddev_pop("score")).scalar()
    z = F.sqrt(-2 * F.log(_uniform(seed, "a"))) * F.cos(2 * math.pi * _uniform(seed, "b"))
    return test.select("uid", "item_id", F.col("score").alias("true_r"), rnd(clamp(mu + sd * z, lo, hi)).alias("est"))


def top_n_unseen(model: Baseline, seen: DataFrame, users: DataFrame, n: int = 10, lo: float = 1.0, hi: float = 5.0) -> DataFrame:
    """T2 with unseen candidates (D15b): each user's n best items by the baseline among those not in ``seen``.

    For one user the order of the estimates is the order of b_i, so items get
    one global position (no global window). A user's seen item stands before the
    n-th unseen one when its position less its place among the user's seen
    positions is below n; with c such items, the answer is positions 0 to
    n + c - 1 without them. Rows stay in proportion to users and ratings; no
    user x item product is formed. Runs a job for the positions.
    """
    placed = row_positions(model.item_bias.select((-F.col("b_i")).alias("_nb"), "item_id"), ["_nb", "item_id"], "_pos")
    placed = placed.select("item_id", (-F.col("_nb")).alias("b_i"), "_pos")
    mine = seen.select("uid", "item_id").distinct().join(placed.select("item_id", "_pos"), "item_id")
    order = Window.partitionBy("uid").orderBy("_pos")
    before = mine.withColumn("_j", F.row_number().over(order) - 1).where(F.col("_pos") - F.col("_j") < n).select("uid", "_pos")
    c = before.groupBy("uid").agg(F.count(F.lit(1)).alias("_c"))
    all_users = users.select("uid").distinct().join(c, "uid", "left").join(model.user_bias.select("uid", "b_u"), "uid", "left")
    slots = all_users.select("uid", "b_u", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("_c", F.lit(0)) + (n - 1))).alias("_pos"))
    free = slots.join(before, ["uid", "_pos"], "left_anti").join(placed, "_pos")
    raw = model.mu + F.coalesce(F.col("b_u"), F.lit(0.0)) + F.col("b_i")
    out = free.select("uid", "item_id", rnd(clamp(raw, lo, hi)).alias("est"), "_pos")
    return out.withColumn("rank", F.row_number().over(order).cast("long")).drop("_pos")


def recommend_all(user_factors: DataFrame, item_factors: DataFrame, k: int = 10, block_size: int = 2048) -> DataFrame:
    """M5 + J10: every user's k best items by the factor product p_u . q_i (D17 ranking).

    Every product of a user and an item is formed, tile by tile inside pairs of
    large blocks (``products.lists``); a group gives k rows per user, so neither
    the score matrix nor a cross join is ever formed. Runs a job for the sizes.
    Returns (uid, item_id, est, rank).
    """
    users, items = (f.select(F.col("id").cast("long").alias("id"), "features") for f in (user_factors, item_factors))
    return products.lists(users, items, k, block_size).select(F.col("query").alias("uid"), F.col("item").alias("item_id"), "est", "rank")
