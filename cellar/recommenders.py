"""User-facing recommenders built from the operators.

``ContentRecommender``: TF-IDF over review texts -> top-k similar items, stored
as a table in the shared folder; ``recommend(name, producer, n)`` is a look-up
plus two joins. ``CollabRecommender``: any Spark ML estimator that outputs a
``prediction`` column (H4; the damped baseline when none is given), top-n lists
per user, and recommendations for a new user from the lists of the users most
correlated with the new profile. Every method returns a lazy DataFrame.
"""

from __future__ import annotations

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellar.functions.exprs import clamp, rnd
from cellar.operators import evaluate, factor, fold_in, inner_product, neighbours, similarity, text
from cellar.session import materialize


class ContentRecommender:
    """Item neighbours by text similarity (``measure`` "cosine" only, H3)."""

    def __init__(self, reviews: DataFrame, items: DataFrame, measure: str = "cosine", k: int = 10):
        if measure != "cosine":
            raise ValueError("text similarity supports measure='cosine'")
        self.reviews, self.items, self.k = reviews, items, k
        self.similarities: DataFrame | None = None

    def fit(self, max_features: int = 10000) -> ContentRecommender:
        w = text.tfidf(self.reviews, max_features=max_features)
        edges = similarity.cosine_topk_long(w, "item_id", "term", "weight", self.k)
        self.similarities = materialize(edges, "similarities")
        return self

    def recommend(self, name: str, producer_name: str, n: int = 5) -> DataFrame:
        """Items similar to the one item called ``name`` by ``producer_name``;
        empty when that look-up finds no item or several (D21)."""
        if self.similarities is None:
            raise RuntimeError("call fit() first")
        req = self.items.sparkSession.createDataFrame([(name, producer_name)], "name string, producer_name string")
        hit = neighbours.lookup_items(req, self.items, ["name", "producer_name"]).where(F.col("status") == "ok")
        recs = self.similarities.join(F.broadcast(hit.select("item_id")), "item_id").where(F.col("rank") <= n)
        attrs = self.items.withColumnRenamed("item_id", "sim_item_id")
        return recs.join(attrs, "sim_item_id", "left").orderBy("rank")


class CollabRecommender:
    """Rating predictions and neighbour-based recommendations."""

    def __init__(self, ratings: DataFrame, estimator=None, lo: float = 1.0, hi: float = 5.0):
        self.ratings, self.estimator, self.lo, self.hi = ratings, estimator, lo, hi
        self.model = None

    def fit(self, train: DataFrame | None = None) -> CollabRecommender:
        train = self.ratings if train is None else train
        self.model = factor.fit_baseline(train) if self.estimator is None else self.estimator.fit(train)
        return self

    def predict(self, pairs: DataFrame) -> DataFrame:
        """(uid, item_id, true_r, est) for the given pairs, clamped to the rating scale."""
        if self.model is None:
            raise RuntimeError("call fit() first")
        if isinstance(self.model, factor.Baseline):
            return factor.prediction_rows(factor.predict_baseline(self.model, pairs, self.lo, self.hi))
        p = self.model.transform(pairs)
        return p.select("uid", "item_id", F.col("score").alias("true_r"), rnd(clamp(F.col("prediction"), self.lo, self.hi)).alias("est"))

    def top_n(self, pairs: DataFrame, n: int = 10) -> DataFrame:
        return evaluate.top_n(self.predict(pairs), n)

    def add_user(self, profile: dict[int, float]) -> tuple[int, CollabRecommender]:
        """A recommender that knows a new user's ratings too, and the new uid, max(uid) + 1.

        The fitted model is kept: a new user has no bias or factors in it, but
        ``recommend_for`` works through the users most correlated with the profile.
        """
        rows = self.ratings.sparkSession.createDataFrame([(int(i), float(s)) for i, s in profile.items()], "item_id long, score double")
        uid = int(self.ratings.select(F.coalesce(F.max("uid") + 1, F.lit(0))).first()[0])
        known = CollabRecommender(self.ratings.select("uid", "item_id", "score").unionByName(rows.select(F.lit(uid).cast("long").alias("uid"), "item_id", "score")), self.estimator, self.lo, self.hi)
        known.model = self.model
        return uid, known

    def fold_in(self, profiles: DataFrame) -> DataFrame:
        """(id, n, features) for any number of new users, whose (uid, item_id, score) rows are ``profiles``, in a fitted ALS model."""
        if not isinstance(self.model, ALSModel):
            raise ValueError("new users can be folded into a fitted ALS model only")
        reg, nonnegative = (self.estimator.getOrDefault(x) for x in ("regParam", "nonnegative"))
        return fold_in.fold_in(self.model.itemFactors, profiles, reg, nonnegative)

    def recommend_new_users(self, profiles: DataFrame, n: int = 5) -> DataFrame:
        """(uid, item_id, est, rank): each new user's n best items outside its profile, from its folded factors.

        The search keeps n items and as many more as the longest profile has, since a user's own items may lead its list.
        """
        users = materialize(self.fold_in(profiles), "folded-users")
        longest = users.select(F.max("n")).first()[0] or 0
        lists = inner_product.search(users.select("id", "features"), self.model.itemFactors, n + longest)[0]
        others = lists.join(profiles.select("uid", "item_id").distinct(), ["uid", "item_id"], "left_anti")
        order = Window.partitionBy("uid").orderBy("rank")
        return others.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)

    def recommend_for(self, uid: int, candidates: DataFrame | str = "unseen", n: int = 5, neighbours_n: int = 5, min_overlap: int = 3) -> DataFrame:
        """M21 + M22: pool the top lists of the users most correlated with ``uid``, without the items ``uid`` has rated.

        ``candidates`` (D15b): a frame of (uid, item_id, score) pairs to predict,
        or "unseen": every item that a neighbour has not rated.
        """
        nb = neighbours.similar_users(self.ratings, uid, neighbours_n, mode="pairwise", min_overlap=min_overlap)
        mine = self.ratings.where(F.col("uid") == uid)
        if isinstance(candidates, str):
            if candidates != "unseen":
                raise ValueError('candidates must be a frame or "unseen"')
            ids = [r["uid"] for r in nb.select("uid").collect()]  # neighbours_n rows
            items = self.ratings.select("item_id").distinct()
            pairs = items.select(F.explode(F.array(*[F.lit(i).cast("long") for i in ids])).alias("uid") if ids else F.lit(None).cast("long").alias("uid"), "item_id", F.lit(None).cast("double").alias("score"))
            seen = self.ratings.where(F.col("uid").isin(ids)).select("uid", "item_id")
            candidates = pairs.where(F.col("uid").isNotNull()).join(seen, ["uid", "item_id"], "left_anti")
        else:
            candidates = candidates.join(F.broadcast(nb.select("uid")), "uid", "left_semi")
        return neighbours.pooled_recommendations(self.predict(candidates), nb, n, exclude=mine)
