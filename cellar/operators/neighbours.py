"""Look-ups, user neighbours and neighbour-based recommendations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellar.functions.exprs import pearson_from_moments, rnd, small_side
from cellar.operators import factor


def lookup_items(requests: DataFrame, items: DataFrame, keys: list[str]) -> DataFrame:
    """Resolve requests by equality on ``keys`` to none / ok / ambiguous.

    The items side is reduced to one row per key value first (count, smallest
    id), so the join never multiplies a request.
    """
    m = items.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("item_id").alias("_id"))
    j = requests.join(m, keys, "left")
    n = F.coalesce(F.col("n"), F.lit(0)).cast("long")
    return j.select(
        *keys,
        n.alias("n_matches"),
        F.when(F.col("n") == 1, F.col("_id")).alias("item_id"),
        F.when(F.col("n").isNull(), "none").when(F.col("n") == 1, "ok").otherwise("ambiguous").alias("status"),
    )


def _pearson_against(ratings: DataFrame, profile: DataFrame, user: str, item: str, value: str) -> DataFrame:
    """Moment sums of every user against one profile over the items both rated.

    One-against-all: the profile joins the ratings on the item (its size is
    checked at run time by AQE), producing one row per co-rating, never pairs
    of users.
    """
    p = profile.select(F.col(item), F.col(value).alias("_y"))
    j = ratings.select(user, item, F.col(value).alias("_x")).join(p, item)
    return j.groupBy(user).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("_x").alias("sx"),
        F.sum("_y").alias("sy"),
        F.sum(F.col("_x") * F.col("_x")).alias("sxx"),
        F.sum(F.col("_y") * F.col("_y")).alias("syy"),
        F.sum(F.col("_x") * F.col("_y")).alias("sxy"),
    )


def similar_users(
    ratings: DataFrame,
    target: int | Column,
    n: int = 5,
    mode: str = "pairwise",
    min_overlap: int = 3,
    user: str = "uid",
    item: str = "item_id",
    value: str = "score",
) -> DataFrame:
    """M21 + J7 + A15 + T7: the n users most correlated with ``target``.

    ``strict``: only users who rated every item of the target (full overlap).
    ``pairwise``: Pearson over common items, at least ``min_overlap`` of them.
    Undefined correlations (constant sides, D10) are dropped; the target is
    excluded by id; ties by user id.
    """
    profile = ratings.where(F.col(user) == F.lit(target)).select(item, value)
    m = _pearson_against(ratings.where(F.col(user) != F.lit(target)), profile, user, item, value)
    if mode == "strict":
        need = profile.select(F.count(F.lit(1))).scalar()
        m = m.where(F.col("n") == need)
    else:
        m = m.where(F.col("n") >= min_overlap)
    r = rnd(pearson_from_moments("n", "sx", "sy", "sxx", "syy", "sxy"))
    out = m.select(user, F.col("n").alias("n_common"), r.alias("r")).where(F.col("r").isNotNull())
    return out.orderBy(F.desc("r"), F.asc(user)).limit(n).withColumn(
        "rank", F.row_number().over(Window.orderBy(F.desc("r"), F.asc(user))).cast("long")
    )


def pooled_recommendations(predictions: DataFrame, neighbours: DataFrame, n: int = 5, per_user: int = 10, exclude: DataFrame | None = None) -> DataFrame:
    """T8 + M22: pool the top-N lists of the neighbours; for an item rated by
    several neighbours the most similar neighbour's estimate wins (D15); the
    n best items overall, exactly n rows when enough exist. Items of
    ``exclude`` (e.g. those the target has rated) are left out before the lists
    are cut.

    ``neighbours`` is a top-n result; Spark sees its limit and picks the join.
    """
    w = Window.partitionBy("uid").orderBy(F.desc("est"), F.asc("item_id"))
    nb = neighbours.select("uid", F.col("rank").alias("nb_rank"))
    if exclude is not None:
        predictions = predictions.join(exclude.select("item_id"), "item_id", "left_anti")
    lists = predictions.join(nb, "uid").withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= per_user)
    pooled = lists.groupBy("item_id").agg(
        F.min_by(F.col("est"), F.col("nb_rank")).alias("est"),
        F.min("nb_rank").alias("from_rank"),
    )
    return pooled.orderBy(F.desc("est"), F.asc("item_id")).limit(n)


def append_user(ratings: DataFrame, profile: DataFrame) -> tuple[DataFrame, Column]:
    """The ratings with a new user's (item_id, score) rows, and the new uid, max(uid) + 1, as a scalar subquery."""
    uid = F.coalesce(ratings.select(F.max("uid") + 1).scalar(), F.lit(0)).cast(ratings.schema["uid"].dataType)
    return ratings.select("uid", "item_id", "score").unionByName(profile.select(uid.alias("uid"), "item_id", F.col("score").cast("double").alias("score"))), uid


def recommend_new_user(
    ratings: DataFrame, profile: DataFrame, model: factor.Baseline, attributes: DataFrame, n: int = 5, neighbours_n: int = 5, min_overlap: int = 2, per_user: int = 10,
    candidates: str = "unseen", heldout: DataFrame | None = None,
) -> DataFrame:
    """M20 + M21 + M22 + J6: from a new user's profile (item_id, score) to a decorated list.

    The profile is appended as a new user, the users most correlated with it are
    found, their top lists of items outside the profile are pooled, and the n
    best are decorated. ``candidates`` (D15b): "unseen", items a neighbour has
    not rated, or "heldout", the pairs of ``heldout``. Only the neighbours'
    candidates are scored.
    """
    extended, uid = append_user(ratings, profile)
    nb = similar_users(extended, uid, neighbours_n, mode="pairwise", min_overlap=min_overlap)
    few = small_side(nb.select("uid"), neighbours_n)
    if candidates == "unseen":
        # the profile's items are seen for every neighbour (one user's items: one array)
        known = profile.agg(F.collect_set("item_id")).scalar()
        seen = ratings.join(few, "uid", "left_semi").select("uid", "item_id").unionByName(nb.select("uid", F.explode(known).alias("item_id")))
        lists = factor.top_n_unseen(model, seen, nb, per_user)
    elif candidates == "heldout" and heldout is not None:
        lists = factor.predict_baseline(model, heldout.join(few, "uid", "left_semi"))
    else:
        raise ValueError('candidates must be "unseen", or "heldout" with a frame of pairs')
    top = pooled_recommendations(lists.select("uid", "item_id", "est"), nb, n, per_user, exclude=profile)
    return decorate(top, attributes)


def decorate(recommended: DataFrame, attributes: DataFrame) -> DataFrame:
    """A short list with the attributes of its items; items without attributes stay."""
    found = attributes.join(recommended.select("item_id"), "item_id", "left_semi")
    return recommended.withColumn("from_rank", F.col("from_rank").cast("long")).join(found, "item_id", "left")
