"""New users in a fitted factor model (M20, U1): their factors from their ratings and the items' fixed factors.

A user's factors solve the normal equations of its ratings, (Q'Q + reg n I) p = Q'r,
n ratings with item factors Q: the step that alternating least squares itself
takes, so training users get their own factors back. Ratings are shuffled by user and
streamed; a task holds the sums of the users at hand, rank squared values each.
A user with more than ``HEAVY`` ratings is summed in parts, and the parts added up.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellar.functions.exprs import nan_to_null, small_side
from cellar.session import materialize

HEAVY = 100_000
SOLVED = 1 << 22  # values of the users' sums that are solved at once: many users, if their factors are few
SWEEPS = 2_000


def _solve(a: np.ndarray, b: np.ndarray, n: np.ndarray, reg: float, nonnegative: bool) -> np.ndarray:
    """The solutions of a batch of systems; a system without a single one (``reg`` 0) gets the shortest."""
    rank = b.shape[1]
    a = a + (reg * n)[:, None, None] * np.eye(rank)
    if not nonnegative:
        return (np.linalg.pinv(a, hermitian=True) @ b[:, :, None])[:, :, 0] if reg == 0 else np.linalg.solve(a, b[:, :, None])[:, :, 0]
    # coordinate descent: every sweep lowers the convex loss; users whose factors stand still leave the batch
    p, left = np.zeros_like(b), np.arange(len(b))
    rows, y, x = np.ascontiguousarray(a.transpose(1, 0, 2)), b, np.zeros_like(b)
    diagonal = np.maximum(np.einsum("ijj->ij", a), 1e-300)
    for _ in range(SWEEPS):
        before = x.copy()
        for j in range(rank):
            x[:, j] = np.maximum(0.0, x[:, j] - (np.einsum("ij,ij->i", rows[j], x) - y[:, j]) / diagonal[:, j])
        stays = np.abs(x - before).max(axis=1, initial=0.0) > 1e-9 * np.maximum(1.0, np.abs(x).max(axis=1, initial=0.0))
        if 5 * stays.sum() <= 4 * len(left):
            p[left] = x
            if not stays.any():
                break
            left, rows, y, x, diagonal = left[stays], rows[:, stays], y[stays], x[stays], diagonal[stays]
    p[left] = x
    return p


def _sums(rank: int, reg: float, nonnegative: bool, ratings: bool):
    """mapInArrow function over rows sorted by (id, part): a row per (id, part), its factors or, for one of several parts, its sums.

    ``ratings``: rows are (id, part, parts, score, features); else parts' sums (id, part, parts, n, sums).
    """
    size = rank * rank + rank + 1  # Q'Q, Q'r, n

    def emit(rows: list[tuple[int, int, np.ndarray]]) -> pa.RecordBatch:
        total = np.stack([s for _, _, s in rows])
        a, b, n = total[:, : rank * rank].reshape(-1, rank, rank), total[:, rank * rank : -1], total[:, -1]
        whole = np.array([parts <= 1 or not ratings for _, parts, _ in rows])
        factors = [None] * len(rows)
        if whole.any():
            for k, p in zip(np.flatnonzero(whole).tolist(), _solve(a[whole], b[whole], n[whole], reg, nonnegative)):
                factors[k] = p
        sums = [None if w else s for w, s in zip(whole.tolist(), total)]
        kind = pa.list_(pa.float64())
        return pa.RecordBatch.from_arrays([pa.array([u for u, _, _ in rows], pa.int64()), pa.array(n.astype(np.int64)), pa.array(factors, kind), pa.array(sums, kind)], names=["id", "n", "features", "sums"])

    def of(b: pa.RecordBatch, lo: int, hi: int) -> np.ndarray:
        if not ratings:
            return np.stack(b.column("sums").slice(lo, hi - lo).to_numpy(zero_copy_only=False)).sum(axis=0)
        q = np.stack(b.column("features").slice(lo, hi - lo).to_numpy(zero_copy_only=False)).astype(float)
        return np.concatenate(((q.T @ q).ravel(), b.column("score").slice(lo, hi - lo).to_numpy() @ q, [hi - lo]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, key, held = [], None, np.zeros(size)
        for b in batches:
            ids, part, parts = (b.column(c).to_numpy() for c in ("id", "part", "parts"))
            edge = np.flatnonzero(np.concatenate(([True], (ids[1:] != ids[:-1]) | (part[1:] != part[:-1])))) if len(ids) else []
            for lo, hi in zip(edge, [*edge[1:], len(ids)]):
                here = (int(ids[lo]), int(part[lo]), int(parts[lo]))
                if key is not None and here != key:
                    done.append((key[0], key[2], held))
                    held = np.zeros(size)
                key, held = here, held + of(b, lo, hi)
                if len(done) * size >= SOLVED:
                    yield emit(done)
                    done = []
        if key is not None:
            yield emit([*done, (key[0], key[2], held)])

    return run


def fold_in(item_factors: DataFrame, profiles: DataFrame, reg: float, nonnegative: bool = False) -> DataFrame:
    """(id, n, features): factors of every user of ``profiles`` (uid, item_id, score) who rated an item with factors.

    ``item_factors`` is (id, features), as a fitted model gives it; ``n`` counts the ratings used. Ratings without a
    score, a user or a known item are left out, repeated ones count as often as they stand there. Runs jobs: one
    looks for the rank, one for heavy users, one writes the result.
    """
    first = item_factors.select(F.size("features")).first()
    if first is None:
        return profiles.sparkSession.createDataFrame([], "id bigint, n bigint, features array<double>")
    rank = first[0]
    rows = profiles.select(F.col("uid").cast("long").alias("id"), F.col("item_id").cast("long").alias("_item"), nan_to_null(F.col("score").cast("double")).alias("score")).dropna()
    heavy = rows.groupBy("id").count().where(F.col("count") > HEAVY).select("id", F.ceil(F.col("count") / HEAVY).alias("_parts"))
    n_heavy = heavy.count()  # at most ratings / HEAVY; without any, no rating is shuffled for them
    rows = rows.join(small_side(heavy, n_heavy), "id", "left") if n_heavy else rows.withColumn("_parts", F.lit(None).cast("long"))
    rows = rows.withColumn("parts", F.coalesce("_parts", F.lit(1)).cast("long"))
    # factors of single precision travel as such; the sums are in double precision
    items = item_factors.select(F.col("id").cast("long").alias("_item"), "features")
    rows = rows.join(items, "_item").select("id", F.pmod(F.xxhash64("_item"), F.col("parts")).alias("part"), "parts", "score", "features")
    kind = "id bigint, n bigint, features array<double>, sums array<double>"
    summed = rows.repartition("id", "part").sortWithinPartitions("id", "part").mapInArrow(_sums(rank, reg, nonnegative, True), kind)
    summed = materialize(summed, "fold-in")
    parts = summed.where("sums IS NOT NULL").select("id", F.lit(0).cast("long").alias("part"), F.lit(1).cast("long").alias("parts"), "sums")
    added = parts.repartition("id").sortWithinPartitions("id").mapInArrow(_sums(rank, reg, nonnegative, False), kind)
    return summed.where("sums IS NULL").unionByName(added).select("id", "n", "features")


def estimates(user_factors: DataFrame, item_factors: DataFrame, pairs: DataFrame) -> DataFrame:
    """(uid, item_id, est): the unclamped product for each of ``pairs`` whose user and item have factors."""
    users = user_factors.select(F.col("id").cast("long").alias("uid"), F.col("features").cast("array<double>").alias("_p"))
    items = item_factors.select(F.col("id").cast("long").alias("item_id"), F.col("features").cast("array<double>").alias("_q"))
    dot = F.aggregate(F.zip_with("_p", "_q", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    both = pairs.select(F.col("uid").cast("long").alias("uid"), F.col("item_id").cast("long").alias("item_id")).join(users, "uid").join(items, "item_id")
    return both.select("uid", "item_id", dot.alias("est"))
