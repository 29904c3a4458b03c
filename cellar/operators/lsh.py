"""Approximate nearest neighbours by random projections (J9): cells, probing, exact re-ranking.

A table is a set of random hyperplanes; the signs of a vector's projections are
its code. Codes of a table are cut into cells as a binary tree: a cell that
holds more than ``cell_rows`` vectors is split by the next bit, and where bits
do not help any more, into chunks by hash. A vector looks for neighbours in its
own cell and in every cell that it could reach by flipping signs whose squared
projections sum up to no more than ``radius``: signs close to a hyperplane flip
first. What a vector meets there is compared exactly. Vectors travel in pairs of
large blocks, not once for every cell; a group walks through the cells of its
pair and gives no more than k rows per vector.

The radius is not guessed: the exact neighbours of ``sample`` vectors are found
in one pass, and the radius is the smallest one that reaches the wanted share
of them. Clustered vectors need few cells; vectors without any structure need
many, and then the blocks of ``similarity.cosine_topk_dense`` cost no more.

Equal vectors are compared once: one of them stands for all, with the ids that
its lists can need, so a vector that a third of all rows share is one vector.
Vectors of length 0 and null vectors have no neighbours. Ids must be unique.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellar.functions.exprs import rnd
from cellar.operators import products
from cellar.operators.similarity import top_k
from cellar.operators.stats import slots
from cellar.session import materialize

MAX_BITS = 14  # so at most 2 ** 14 cells a table
MAX_QUERIES = 2048  # of a group, before its block is made larger
PIECE = 256  # vectors whose cells are looked up at a time
LOOKERS = 8192  # whose lists a task holds at a time


def _unit(vectors: pd.Series) -> np.ndarray:
    x = np.stack(vectors.to_numpy()).astype("float64")
    return x / np.linalg.norm(x, axis=1)[:, None]


@dataclass
class Cells:
    """The fitted index: per table, planes (dimension x bits) and the cells' bits (0, 1, or -1 beyond their depth)."""

    planes: list[np.ndarray]
    bits: list[np.ndarray]
    radius: float = math.inf
    pairs: int = 0  # products formed by a search, copies of a pair in several tables included
    vectors: int = 0

    def codes(self, x: np.ndarray, t: int) -> np.ndarray:
        return (x @ self.planes[t] > 0) @ (1 << np.arange(self.planes[t].shape[1])[::-1])

    def reach(self, x: np.ndarray, t: int) -> np.ndarray:
        """What flipping costs: vectors x cells; 0 for a vector's own cell."""
        p = x @ self.planes[t]
        square = p * p
        up = np.where(p > 0, square, 0.0)
        return up @ (self.bits[t] == 0).T + (square - up) @ (self.bits[t] == 1).T

    def own(self, x: np.ndarray, t: int) -> np.ndarray:
        """The cell of every vector."""
        return (self.reach(x, t) <= 0).argmax(axis=1)


def _tree(counts: np.ndarray, n_bits: int, cell_rows: int) -> np.ndarray:
    """Bits of the cells of a table, from the number of vectors by code."""
    out, todo = [], [(0, 0, len(counts))]
    while todo:
        depth, lo, hi = todo.pop()
        if depth == n_bits or counts[lo:hi].sum() <= cell_rows:
            prefix = [lo >> (n_bits - 1 - b) & 1 for b in range(depth)]
            out.append(prefix + [-1] * (n_bits - depth))
        else:
            mid = (lo + hi) // 2
            todo += [(depth + 1, mid, hi), (depth + 1, lo, mid)]
    return np.array(out, np.int8).reshape(len(out), n_bits)


def fit_cells(reps: DataFrame, vec: str, id: str, k: int, tables: int = 4, recall: float = 0.96, sample: int = 400, seed: int = 17, cell_rows: int | None = None) -> Cells:
    """Planes, cells and radius for distinct, non-zero vectors. Three passes over them; what is collected is bounded by
    ``tables``, ``MAX_BITS`` and ``sample``."""
    n = reps.count()
    first = reps.select(F.size(vec)).first()
    if first is None:
        return Cells([], [])
    cell_rows = cell_rows or max(64, min(4096, round(4 * math.sqrt(n))))
    n_bits = max(1, min(MAX_BITS, first[0], math.ceil(math.log2(max(n / cell_rows, 1))) + 3))
    r = np.random.default_rng(seed)
    cells = Cells([np.linalg.qr(r.normal(size=(first[0], first[0])))[0][:, :n_bits] for _ in range(tables)], [], vectors=n)

    def coded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x = _unit(b[vec])
            for t in range(tables):
                code, times = np.unique(cells.codes(x, t), return_counts=True)
                yield pd.DataFrame({"t": t, "code": code, "n": times})

    counts = np.zeros((tables, 1 << n_bits), np.int64)
    for row in reps.select(vec).mapInPandas(coded, "t int, code long, n long").groupBy("t", "code").agg(F.sum("n").alias("n")).collect():
        counts[row["t"], row["code"]] = row["n"]
    cells.bits = [_tree(c, n_bits, cell_rows) for c in counts]
    cells.radius = _radius(reps, cells, vec, id, k, recall, sample)
    return cells


def _radius(reps: DataFrame, cells: Cells, vec: str, id: str, k: int, recall: float, sample: int) -> float:
    asked = reps.orderBy(F.xxhash64(id), id).limit(sample).select(id, vec).toPandas()
    q, ids, tables = _unit(asked[vec]), asked[id].to_numpy(), len(cells.planes)

    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        costs = [cells.reach(q, t) for t in range(tables)]
        for b in batches:
            x = _unit(b[vec])
            s = np.where(ids[:, None] == b[id].to_numpy()[None, :], -np.inf, q @ x.T)
            best = np.argpartition(-s, min(k, s.shape[1]) - 1, axis=1)[:, :k]
            cost = np.min([np.take_along_axis(costs[t], cells.own(x, t)[best], 1) for t in range(tables)], axis=0)
            yield pd.DataFrame({"q": np.repeat(np.arange(len(q)), best.shape[1]), "sim": np.take_along_axis(s, best, 1).ravel(), "cost": cost.ravel()})

    found = reps.select(id, vec).mapInPandas(nearest, "q int, sim double, cost double").where(F.col("sim") > F.lit(-2.0))
    w = Window.partitionBy("q").orderBy(F.desc("sim"))
    costs = np.sort([r[0] for r in found.withColumn("r", F.row_number().over(w)).where(F.col("r") <= k).select("cost").collect()])  # k * sample rows
    return float(costs[min(len(costs) - 1, math.ceil(recall * len(costs)))]) + 1e-9 if len(costs) else 0.0


def _met(reps: DataFrame, cells: Cells, vec: str) -> int:
    """Pairs of one that looks into a cell and one that lives there, over all tables and cells."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in (whole.iloc[i : i + PIECE] for whole in batches for i in range(0, len(whole), PIECE)):
            x = _unit(b[vec])
            for t in range(len(cells.planes)):
                cost = cells.reach(x, t)
                lives = np.bincount((cost <= 0).argmax(axis=1), minlength=cost.shape[1])
                yield pd.DataFrame({"t": t, "cell": np.arange(cost.shape[1]), "look": (cost <= cells.radius).sum(axis=0), "live": lives})

    sums = reps.select(vec).mapInPandas(count, "t int, cell int, look long, live long").groupBy("t", "cell").agg(F.sum("look").alias("look"), F.sum("live").alias("live"))
    return int(sums.agg(F.sum(F.col("look").cast("decimal(38,0)") * F.col("live"))).first()[0] or 0)


def _nearest(x: np.ndarray, y: np.ndarray, own: np.ndarray, ids: np.ndarray, cells: Cells, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, item, product): of the items in the cells that a query reaches, its k best ones; equal rounded products by position."""
    lives = []
    for t in range(len(cells.planes)):
        home = np.concatenate([cells.own(y[i : i + PIECE], t) for i in range(0, len(y), PIECE)])
        order = np.argsort(home, kind="stable")
        lives.append((order, np.searchsorted(home[order], np.arange(len(cells.bits[t]) + 1))))
    out = []
    for lo in range(0, len(x), LOOKERS):
        q = x[lo : lo + LOOKERS]
        unit, est, col = np.full((len(q), k), -np.inf), np.full((len(q), k), -np.inf), np.full((len(q), k), -1)
        for t, (order, edge) in enumerate(lives):
            looks = np.concatenate([cells.reach(q[i : i + PIECE], t) <= cells.radius for i in range(0, len(q), PIECE)])
            for c in np.flatnonzero(np.diff(edge)).tolist():
                who, items = np.flatnonzero(looks[:, c]), order[edge[c] : edge[c + 1]]
                if not len(who):
                    continue
                i, j, s = products.best(q[who], y[items], k, own[lo + who], ids[items], floor=est[who, -1])
                if len(i):
                    _enter(unit, est, col, who[i], items[j], s)
        i, place = np.nonzero(col >= 0)
        out.append((i + lo, col[i, place], est[i, place]))
    return tuple(np.concatenate(p) for p in zip(*out))


def _enter(unit: np.ndarray, est: np.ndarray, col: np.ndarray, i: np.ndarray, j: np.ndarray, s: np.ndarray) -> None:
    """Candidates, ordered by their list ``i``, join the lists in place: the best first, no item twice."""
    k = unit.shape[1]
    rows, first = np.unique(i, return_index=True)
    at = np.repeat(np.arange(len(rows)), np.diff(np.append(first, len(i))))
    place = np.arange(len(i)) - first[at]
    new_s, new_j = np.full((len(rows), k), -np.inf), np.full((len(rows), k), -1)
    new_s[at, place], new_j[at, place] = s, j
    new_s[(new_j[:, :, None] == col[rows][:, None, :]).any(axis=2)] = -np.inf  # met in another table
    new_j[np.isneginf(new_s)] = -1
    both_s, both_j = np.hstack((est[rows], new_s)), np.hstack((col[rows], new_j))
    both_u = np.where(both_j >= 0, products.rounded(np.where(both_j >= 0, both_s, 0.0)), -np.inf)
    order = np.lexsort((both_j, -both_u), axis=1)[:, :k]
    unit[rows], est[rows], col[rows] = (np.take_along_axis(m, order, 1) for m in (both_u, both_s, both_j))


def cosine_topk_lsh(vectors: DataFrame, entity: str, vec: str, k: int = 10, tables: int = 4, recall: float = 0.96, sample: int = 400, cell_rows: int | None = None) -> DataFrame:
    """J9 + T3, approximate: (entity, sim_entity, sim, rank), as ``similarity.cosine_topk_dense`` gives it, with about ``recall`` of its rows or more.

    Every row that comes out has its exact similarity. Runs jobs: distinct
    vectors, the passes of ``fit_cells`` and one that counts products.
    """
    return search(vectors, entity, vec, k, tables, recall, sample, cell_rows)[0]


def search(vectors: DataFrame, entity: str, vec: str, k: int = 10, tables: int = 4, recall: float = 0.96, sample: int = 400, cell_rows: int | None = None) -> tuple[DataFrame, Cells]:
    """``cosine_topk_lsh`` and the index with the number of products that it forms."""
    some = vectors.select(F.col(entity).alias("id"), vec).where(F.col(vec).isNotNull() & F.exists(vec, lambda x: x != 0))
    # of equal vectors the k + 1 smallest ids: one of them and k others are all that a list can name
    nth = F.row_number().over(Window.partitionBy(vec).orderBy("id"))
    reps = some.withColumn("_n", nth).where(F.col("_n") <= k + 1).groupBy(vec).agg(F.sort_array(F.collect_list("id")).alias("ids"))
    reps = materialize(reps.select(F.col("ids")[0].alias("id"), "ids", vec), "lsh-vectors")
    cells = fit_cells(reps, vec, "id", k, tables, recall, sample, cell_rows=cell_rows)
    names = F.col("a").alias(entity), F.col("b").alias(f"sim_{entity}"), "sim", "rank"
    if not cells.planes:
        none = some.select(F.col("id").alias("a"), F.col("id").alias("b"), F.lit(0.0).alias("sim"), F.lit(0).cast("long").alias("rank"))
        return none.limit(0).select(*names), cells
    cells.pairs = _met(reps, cells, vec)
    id_type = reps.schema["id"].dataType
    schema = T.StructType([T.StructField("a", id_type), T.StructField("b", id_type), T.StructField("sim", T.DoubleType())])
    lookers, residents = products.blocks(cells.vectors, cells.vectors, MAX_QUERIES, slots(reps.sparkSession))

    def compared(t: pa.Table) -> pa.Table:
        side = t.column("side").to_numpy()
        q, r = t.filter(pa.array(side == 0)), t.filter(pa.array(side == 1)).sort_by("id")
        if not len(q) or not len(r):
            return pa.table({"a": q.column("id").slice(0, 0), "b": r.column("id").slice(0, 0), "sim": pa.array([], pa.float64())})
        x, y = (m / np.linalg.norm(m, axis=1)[:, None] for m in (products.matrix(p.column(vec)) for p in (q, r)))
        i, j, sim = _nearest(x, y, q.column("id").to_numpy(), r.column("id").to_numpy(), cells, k)
        return pa.table({"a": q.column("id").take(pa.array(i)), "b": r.column("id").take(pa.array(j)), "sim": pa.array(sim)})

    rows = products.pairs_of_blocks(reps.select("id", vec), 0, lookers, residents).unionByName(products.pairs_of_blocks(reps.select("id", vec), 1, residents, lookers))
    met = rows.withColumnRenamed("_side", "side").groupBy("_bu", "_bi").applyInArrow(compared, schema)
    near = top_k(met.select("a", "b", rnd("sim").alias("sim")), "sim", k)
    # every id of a and of b, and the copies of a itself
    groups = reps.select(F.col("id").alias("b"), F.col("ids"))
    others = near.join(groups, "b").select("a", F.explode("ids").alias("b"), "sim")
    copies = reps.where(F.size("ids") > 1).select(F.col("id").alias("a"), F.explode("ids").alias("b"), F.lit(1.0).alias("sim"))
    lists = top_k(others.unionByName(copies), "sim", k + 1).drop("rank")  # one of them may be the one that asks
    own = some.join(reps.select(F.col("id").alias("a"), vec), vec).select("id", "a")
    pairs = own.join(lists, "a").where(F.col("id") != F.col("b")).select(F.col("id").alias("a"), "b", "sim")
    return top_k(pairs, "sim", k).select(*names), cells
