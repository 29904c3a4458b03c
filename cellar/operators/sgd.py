"""Jointly fitted factor models (M2, M8): biased factorisation by stochastic gradient, non-negative factorisation.

Users and items are dealt to ``blocks`` blocks each by a hash of the id, ratings
to the cells of that grid. The state is a table: a row per user and item with
its bias and its factors.

Gradient steps: an epoch has as many steps as there are blocks. In step s, user
block g meets item block (g + s) mod blocks, so the cells of one step share no
user and no item and run side by side, each as one task.
Inside a cell the ratings are taken in a fixed order. A rating depends on the
ones before it only through its user and its item; ratings that wait for
equally many others are independent, and one vector operation does them all.
The result is that of a loop over the ratings in the same order.

Multiplicative updates: a block of users (or items) has all its ratings in one task, which the
blocks of the other side stream through; numerators and denominators are complete at its end.

Between tasks rows are packed: the arrays of some users or items, or of the ratings of a cell, are bytes of one row. The state
is a folder per block in the shared folder, and a task reads the folders it needs (``_task``): nothing is shuffled between steps. A step's
cells run in waves of as many as the cluster has cores; what a wave has written replaces what it has read, which is
deleted. So the disk holds the ratings, one state and the blocks of a wave, and a lost executor costs a wave. A grid of one
cell does all its epochs in one task. A task holds the ratings of a cell and the factors of two blocks, or the ratings and factors of one block
and of a block of the other side; ``blocks`` grows with the ratings. A pair must be rated once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellar.functions.exprs import clamp, rnd
from cellar.operators import inner_product
from cellar.operators.stats import slots
from cellar.session import forget, materialize, scratch_path, shuffles_end, written

# Fixed values of the source's model: factors, epochs, learning rate, regularisation, spread of the first factors.
RANK, EPOCHS, RATE, REG, SPREAD = 100, 20, 0.005, 0.02, 0.1
# and of its non-negative model
NMF_RANK, NMF_EPOCHS, NMF_REG = 15, 50, 0.06
CELL_RATINGS = 250_000
STATE = "side int, block int, id long, n long, bias double, factors array<double>"


@dataclass
class Factors:
    """mu + b_u + b_i + p_u . q_i (biases are 0 in a non-negative model)."""

    mu: float
    state: DataFrame
    grid: Grid | None = None  # of a model of several blocks

    def side(self, side: int, key: str) -> DataFrame:
        return self.state.where(F.col("side") == side).select(F.col("id").alias(key), "bias", "factors")


def _dealt(train: DataFrame, blocks: int | None) -> tuple[DataFrame, int]:
    """Ratings with their cell, and the number of blocks."""
    r = train.select(F.col("uid").cast("long").alias("uid"), F.col("item_id").cast("long").alias("item_id"), F.col("score").cast("double").alias("score")).where("uid IS NOT NULL AND item_id IS NOT NULL AND score IS NOT NULL AND NOT isnan(score)")
    n = r.count()
    blocks = blocks or max(1, math.ceil(math.sqrt(n / CELL_RATINGS)))
    cell = lambda c: F.pmod(F.xxhash64(c), F.lit(blocks)).cast("int")
    return r.withColumn("ub", cell("uid")).withColumn("ib", cell("item_id")), blocks


def _normal(r: np.random.Generator, rank: int) -> np.ndarray:
    return r.normal(0.0, SPREAD, rank)


def _uniform(r: np.random.Generator, rank: int) -> np.ndarray:
    return r.uniform(0.0, 1.0, rank)


# While a model is fitted, entities and ratings travel packed: a row holds many of them as bytes of arrays.
ROW = 1 << 18  # bytes of factors of a row
CHUNK = 1 << 16  # values of factors at once: what a vector operation makes stays in the cache
#: kind 0, 1: users, items; kind 2: the ratings of the cell (block, part)
PACKED = "kind int, block int, part int, ids binary, n binary, bias binary, factors binary"
STORED = f"{PACKED}, at string"
BATCH = 4 << 20  # bytes that executor and worker hold at once
_LARGE_ROWS = {"spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH), "spark.sql.maxConcurrentOutputFileWriters": "4"}
_COLUMNS = [c.split()[0] for c in PACKED.split(", ")]


@dataclass
class Grid:
    """The packed state of a model: the folder of each (side, block) and the number of its rows."""

    blocks: int
    folders: dict[tuple[int, int], str]
    parts: dict[tuple[int, int], int]

    def side(self, side: int) -> list[str]:
        return [path for (s, _), path in sorted(self.folders.items()) if s == side]


@contextmanager
def _large_rows(spark: SparkSession) -> Iterator[None]:
    """Settings under which packed rows are not held many at once: small batches for the workers, no sort before a write."""
    before = {k: spark.conf.get(k, None) for k in _LARGE_ROWS}
    for k, v in _LARGE_ROWS.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _stored(df: DataFrame, name: str, group: int = 4) -> str:
    """A folder at=... for each value of ``at``, in a new folder whose path is returned; ``group`` packed rows are read at once."""
    path = scratch_path(df.sparkSession, name)
    with _large_rows(df.sparkSession), shuffles_end(df.sparkSession):
        df.write.partitionBy("at").options(**{"parquet.block.row.count.limit": str(group), "parquet.enable.dictionary": "false"}).parquet(path)
    return path


def _part(rank: int) -> int:
    """Users or items of a row."""
    return max(1, ROW // (8 * rank))


def _read(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.schema(PACKED).parquet(*paths)


def _task(*frames: DataFrame) -> DataFrame:
    """The rows of the frames as one task, in this order (but for the first row, if Spark prefers places)."""
    return reduce(DataFrame.union, frames).coalesce(1)


def _tasks(spark: SparkSession, frames: list[DataFrame]) -> DataFrame:
    """What the tasks give; they run side by side. Spark's union would zip frames of one partition each to one partition, if there
    were not one of another kind: without rows, in a way that the optimiser cannot see."""
    fields = frames[0].schema.fields
    other = spark.range(0, 2, 1, 2).where(F.spark_partition_id() < 0).select(*[F.lit(None).cast(x.dataType).alias(x.name) for x in fields])
    return reduce(DataFrame.union, [*frames, other])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(kind, block, part, ids, n, bias, factors), the last four as buffers or None."""
    for b in batches:
        head = [b.column(c).to_pylist() for c in _COLUMNS[:3]]
        data = [b.column(c) for c in _COLUMNS[3:]]
        for j in range(b.num_rows):
            yield (*(h[j] for h in head), *(d[j].as_buffer() for d in data))


def _pack(block: int, side: int, ids: np.ndarray, n: np.ndarray, bias: np.ndarray, f: np.ndarray) -> Iterator[tuple]:
    n_row = _part(f.shape[1])
    for at in range(0, len(ids), n_row):
        yield (side, block, at // n_row, *(np.ascontiguousarray(x[at : at + n_row]).tobytes() for x in (ids, n, bias, f)), f"{side}-{block}")


def _batch(row: tuple) -> pa.RecordBatch:
    kinds = [pa.int32()] * 3 + [pa.binary()] * 4 + [pa.string()]
    return pa.RecordBatch.from_arrays([pa.array([x], kind) for x, kind in zip(row, kinds)], names=[*_COLUMNS, "at"])


def _unpack(rows: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(ids, n, bias, factors) of one side of one block, in order of the ids."""
    rows = sorted(rows, key=lambda r: r[2])
    ids, n, bias, f = (np.concatenate([np.frombuffer(r[c], kind) for r in rows]) for c, kind in ((3, np.int64), (4, np.int64), (5, np.float64), (6, np.float64)))
    return ids, n, bias, f.reshape(len(ids), -1)


def _first_state(dealt: DataFrame, blocks: int, rank: int, seed: int, draw) -> Grid:
    """Every user and item once; the factors depend on seed, side and id alone."""
    sides = (dealt.groupBy(F.lit(s).alias("side"), F.col(b).alias("block"), F.col(c).alias("id")).agg(F.count(F.lit(1)).alias("n")) for s, b, c in ((0, "ub", "uid"), (1, "ib", "item_id")))

    def start(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id")
        ids = pdf["id"].to_numpy()
        f = np.empty((len(ids), rank))
        for j, i in enumerate(ids.tolist()):
            f[j] = draw(np.random.default_rng([seed, key[0], i & 0xFFFFFFFF, i >> 32 & 0xFFFFFFFF]), rank)
        return pd.DataFrame(_pack(key[1], key[0], ids, pdf["n"].to_numpy(), np.zeros(len(ids)), f), columns=[*_COLUMNS, "at"])

    path = _stored(next(sides).unionByName(next(sides)).groupBy("side", "block").applyInPandas(start, STORED), "factor-state", BATCH // ROW)
    rows = dealt.sparkSession.read.schema(STORED).parquet(path).groupBy("kind", "block").count().collect()  # two a block
    parts = {(r["kind"], r["block"]): r["count"] for r in rows}
    return Grid(blocks, {k: f"{path}/at={k[0]}-{k[1]}" for k in parts}, parts)


def _replace(spark: SparkSession, grid: Grid, keys: list[tuple[int, int]], path: str) -> None:
    """The blocks ``keys`` are now those below ``path``; what they were is deleted."""
    for k in keys:
        forget(spark, grid.folders[k])
        grid.folders[k] = f"{path}/at={k[0]}-{k[1]}"


def _unpacked(spark: SparkSession, grid: Grid) -> DataFrame:
    """The state as a row per user and item; lazy."""

    def fn(batches):
        for kind, block, _, *rest in _rows(batches):
            ids, n, bias, f = _unpack([(kind, block, 0, *rest)])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), kind, np.int32)), pa.array(np.full(len(ids), block, np.int32)), pa.array(ids), pa.array(n), pa.array(bias), pa.ListArray.from_arrays(pa.array(np.arange(0, f.size + 1, f.shape[1], dtype=np.int32)), pa.array(f.ravel()))], names=["side", "block", "id", "n", "bias", "factors"])

    if not grid.folders:
        return spark.createDataFrame([], STATE)
    return _read(spark, *grid.side(0), *grid.side(1)).mapInArrow(fn, STATE)


def _levels(key, pdf: pd.DataFrame) -> pd.DataFrame:
    """Ratings of a cell in order of the vector operation that does them, and where each operation ends."""
    pdf = pdf.sort_values(["order", "uid", "item_id"], kind="stable")
    u, i = pd.factorize(pdf["uid"])[0], pd.factorize(pdf["item_id"])[0]
    at_u, at_i, level = [0] * (u.max() + 1), [0] * (i.max() + 1), []
    for a, b in zip(u.tolist(), i.tolist()):
        now = max(at_u[a], at_i[b])
        level.append(now)
        at_u[a] = at_i[b] = now + 1
    order = np.argsort(level, kind="stable")
    edge = np.cumsum(np.bincount(level))
    return pd.DataFrame([(2, key[0], key[1], *(pdf[c].to_numpy()[order].tobytes() for c in ("uid", "item_id", "score")), edge.tobytes(), f"{key[0]}-{key[1]}")], columns=[*_COLUMNS, "at"])


def _step(mu: float, rate: float, reg: float, epochs: int, rank: int, parts: tuple[int, int]):
    """One cell: all its ratings, level by level. ``parts``: the rows of its users and of its items."""

    def fn(batches):
        n_row = _part(rank)
        size = [x * n_row for x in parts]
        blocks, bias, f = [0, 0], np.zeros(sum(size)), np.empty((sum(size), rank))
        known, count = [{}, {}], [{}, {}]
        for kind, block, part, *data in _rows(batches):
            if kind == 2:
                cell = data
                continue
            blocks[kind], known[kind][part], count[kind][part] = block, np.frombuffer(data[0], np.int64).copy(), np.frombuffer(data[1], np.int64).copy()
            at = kind * size[0] + part * n_row
            bias[at : at + len(known[kind][part])] = np.frombuffer(data[2])
            f[at : at + len(known[kind][part])] = np.frombuffer(data[3]).reshape(-1, rank)
        sides = [[np.concatenate([x[k] for k in sorted(x)]) for x in (known[s], count[s])] for s in (0, 1)]
        u = np.searchsorted(sides[0][0], np.frombuffer(cell[0], np.int64))
        i = np.searchsorted(sides[1][0], np.frombuffer(cell[1], np.int64)) + size[0]
        score, edge = np.frombuffer(cell[2]), np.frombuffer(cell[3], np.int64).tolist()
        chunk = max(1, CHUNK // rank)
        cuts = [(at, min(at + chunk, hi)) for lo, hi in zip([0, *edge], edge) for at in range(lo, hi, chunk)]
        keep = 1 - rate * reg
        for _ in range(epochs):
            for lo, hi in cuts:
                a, b = u[lo:hi], i[lo:hi]
                p, q = f.take(a, axis=0), f.take(b, axis=0)
                bu, bi = bias[a], bias[b]
                e = score[lo:hi] - (mu + bu + bi + np.einsum("ij,ij->i", p, q))
                bias[a] = bu + rate * (e - reg * bu)
                bias[b] = bi + rate * (e - reg * bi)
                move = (rate * e)[:, None]
                to_p, to_q = move * q, move * p
                p *= keep
                q *= keep
                p += to_p
                q += to_q
                f[a], f[b] = p, q
        for side, at in ((0, 0), (1, size[0])):
            own = slice(at, at + len(sides[side][0]))
            yield from map(_batch, _pack(blocks[side], side, *sides[side], bias[own], f[own]))

    return fn


def fit_svd(train: DataFrame, rank: int = RANK, epochs: int = EPOCHS, rate: float = RATE, reg: float = REG, seed: int = 42, blocks: int | None = None) -> Factors:
    """M2: biases and factors fitted jointly to (uid, item_id, score) by stochastic gradient. Runs a job a wave of cells."""
    spark = train.sparkSession
    dealt, blocks = _dealt(train, blocks)
    path = written(dealt, "factor-dealt")
    dealt = spark.read.parquet(path)
    mu = dealt.agg(F.avg("score")).first()[0]
    grid = _first_state(dealt, blocks, rank, seed, _normal)
    if mu is None:
        return Factors(0.0, _unpacked(spark, grid))
    ordered = dealt.withColumn("order", F.xxhash64("uid", "item_id", F.lit(seed)))
    cells = _stored(ordered.groupBy("ub", "ib").applyInPandas(_levels, STORED), "factor-ratings")
    have = {(r["block"], r["part"]) for r in spark.read.schema(STORED).parquet(cells).select("block", "part").collect()}  # a row per cell
    forget(spark, path)
    inner = epochs if blocks == 1 else 1
    for _ in range(epochs // max(inner, 1)):
        for s in range(blocks):
            todo = [(g, (g + s) % blocks) for g in range(blocks) if (g, (g + s) % blocks) in have]
            waves = math.ceil(len(todo) / max(1, slots(spark)))
            for w in range(waves):
                wave = todo[w::waves]
                new = []
                for g, h in wave:
                    step = _step(mu, rate, reg, inner, rank, (grid.parts[0, g], grid.parts[1, h]))
                    new.append(_task(_read(spark, grid.folders[0, g], grid.folders[1, h], f"{cells}/at={g}-{h}")).mapInArrow(step, STORED))
                path = _stored(_tasks(spark, new), "factor-state", BATCH // ROW)
                _replace(spark, grid, [k for g, h in wave for k in ((0, g), (1, h))], path)
    forget(spark, cells)
    return _model(spark, mu, grid)


def _model(spark: SparkSession, mu: float, grid: Grid) -> Factors:
    if grid.blocks == 1:
        return Factors(mu, materialize(_unpacked(spark, grid), "factor-state"))
    return Factors(mu, _unpacked(spark, grid), grid)


# ---- non-negative factorisation -------------------------------------------------------


def _located(key, ratings: pd.DataFrame, ids: pd.DataFrame) -> pd.DataFrame:
    """Ratings of a cell in order of the users, as places in the two blocks, and their order by items."""
    where = []
    for side, c in ((0, "uid"), (1, "item_id")):
        own = ids[ids["kind"] == side].sort_values("part")
        where.append(np.searchsorted(np.frombuffer(b"".join(own["ids"]), np.int64), ratings[c].to_numpy()).astype(np.int32))
    order = np.lexsort(where[::-1])
    u, i, score = (x[order] for x in (*where, ratings["score"].to_numpy()))
    by_item = np.argsort(i, kind="stable").astype(np.int32)
    return pd.DataFrame([(2, *key, *(x.tobytes() for x in (u, i, score, by_item)), f"{key[0]}-{key[1]}")], columns=[*_COLUMNS, "at"])


def _sum_up(sums: np.ndarray, f: np.ndarray, q: np.ndarray, own: np.ndarray, other: np.ndarray, score: np.ndarray) -> None:
    """Adds the numerators and denominators, side by side, of the ratings that ``own`` (in order) gave to a block ``q``."""
    rank = f.shape[1]
    chunk = max(1, CHUNK // (2 * rank))
    for c in range(0, len(own), chunk):
        a = own[c : c + chunk]
        x = q.take(other[c : c + chunk], axis=0)
        est = np.einsum("ij,ij->i", f.take(a, axis=0), x)
        w = np.empty((len(a), 2 * rank))
        np.multiply(x, score[c : c + chunk, None], out=w[:, :rank])
        np.multiply(x, est[:, None], out=w[:, rank:])
        begin = np.flatnonzero(np.append(True, a[1:] != a[:-1]))
        sums[a[begin]] += np.add.reduceat(w, begin, axis=0)


def _turn(side: int, reg: float, parts: dict[tuple[int, int], int], cells: set[tuple[int, int]]):
    """A block's state after the ratings of its users (side 0) or items, while the other side streams through block by block."""

    def fn(batches):
        own, rated, other, whole, state = [], {}, {}, {}, None
        for r in _rows(batches):
            if r[0] == side:
                own.append(r)
                if len(own) == parts[side, r[1]]:
                    state, block, own = _unpack(own), r[1], []
                    f, rank = state[3], state[3].shape[1]
                    sums = np.zeros((len(f), 2 * rank))
            elif r[0] == 2:
                rated[r[2 - side]] = r
            else:
                got = other.setdefault(r[1], [])
                got.append(r)
                if len(got) == parts[1 - side, r[1]]:
                    got = other.pop(r[1])
                    whole[r[1]] = np.concatenate([np.frombuffer(x[6]) for x in sorted(got, key=lambda x: x[2])])
            if state is None:
                continue
            for k in [k for k in whole if k in rated or (block, k)[:: 1 - 2 * side] not in cells]:
                q, x = whole.pop(k).reshape(-1, rank), rated.pop(k, None)
                if x is None:
                    continue
                places, score = [np.frombuffer(x[c], np.int32) for c in (3, 4)], np.frombuffer(x[5])
                if side == 1:
                    order = np.frombuffer(x[6], np.int32)
                    places, score = [y[order] for y in places[::-1]], score[order]
                _sum_up(sums, f, q, *(y.astype(np.intp) for y in places), score)
        ids, n, bias, _ = state
        top, bottom = sums[:, :rank], sums[:, rank:]
        f = f * top / np.maximum(bottom + reg * n[:, None] * f, 1e-12)
        yield from map(_batch, _pack(block, side, ids, n, bias, f))

    return fn


def _whole_grid(state: DataFrame, ratings: DataFrame, epochs: int, reg: float) -> DataFrame:
    """All epochs of a grid of one cell."""

    def fn(key, old: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        f, side, n = np.stack(old["factors"].to_numpy()), old["side"].to_numpy(), old["n"].to_numpy()[:, None]
        at = [np.flatnonzero(side == s) for s in (0, 1)]
        who = [at[s][pd.Index(old["id"].to_numpy()[at[s]]).get_indexer(r[c])] for s, c in ((0, "uid"), (1, "item_id"))]
        score = r["score"].to_numpy()[:, None]
        for _ in range(epochs):
            for own, other in (who, who[::-1]):
                order = np.argsort(own, kind="stable")
                ids, begin = np.unique(own[order], return_index=True)
                q = f[other[order]]
                est = (f[own[order]] * q).sum(axis=1)[:, None]
                top, bottom = np.add.reduceat(score[order] * q, begin, axis=0), np.add.reduceat(est * q, begin, axis=0)
                f[ids] *= top / np.maximum(bottom + reg * n[ids] * f[ids], 1e-12)
        return old.assign(factors=list(f))

    one = F.lit(0).alias("g")
    return state.groupBy(one).cogroup(ratings.groupBy(one)).applyInPandas(fn, STATE)


def fit_nmf(train: DataFrame, rank: int = NMF_RANK, epochs: int = NMF_EPOCHS, reg: float = NMF_REG, seed: int = 42, blocks: int | None = None) -> Factors:
    """M8: non-negative factors by multiplicative updates over the observed ratings; runs two jobs an epoch.

    Users and items take turns, and no turn raises ``nmf_loss``. Scores must not be negative.
    """
    spark = train.sparkSession
    dealt, blocks = _dealt(train, blocks)
    path = written(dealt, "factor-ratings")
    ratings = spark.read.parquet(path)
    grid = _first_state(ratings, blocks, rank, seed, _uniform)
    if blocks == 1:
        return Factors(0.0, materialize(_whole_grid(_unpacked(spark, grid), ratings, epochs, reg), "factor-state"))
    if not grid.folders:
        return Factors(0.0, _unpacked(spark, grid))
    all_ids = _read(spark, *grid.side(0), *grid.side(1)).select("kind", "block", "part", "ids", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("other"))
    ids = all_ids.select("kind", "part", "ids", *(F.when(F.col("kind") == s, F.col("block")).otherwise(F.col("other")).alias(c) for s, c in ((0, "ub"), (1, "ib"))))
    cells = {tuple(r) for r in ratings.select("ub", "ib").distinct().collect()}
    ids = ids.join(ratings.select("ub", "ib").distinct(), ["ub", "ib"], "left_semi")
    places = _stored(ratings.groupBy("ub", "ib").cogroup(ids.groupBy("ub", "ib")).applyInPandas(_located, STORED), "factor-ratings")
    forget(spark, path)
    rated = {k: _read(spark, *(f"{places}/at={c[0]}-{c[1]}" for c in sorted(cells) if c[k[0]] == k[1])) for k in grid.folders}
    for _ in range(epochs):
        for side in (0, 1):
            own = [k for k in grid.folders if k[0] == side]
            none = F.lit(None).cast("binary")
            others = _read(spark, *grid.side(1 - side)).select("kind", "block", "part", none.alias("ids"), none.alias("n"), none.alias("bias"), "factors")
            turn = _turn(side, reg, grid.parts, cells)
            new = [_task(_read(spark, grid.folders[k]), rated[k], others).mapInArrow(turn, STORED) for k in own]
            path = _stored(_tasks(spark, new), "factor-state", BATCH // ROW)
            _replace(spark, grid, own, path)
    forget(spark, places)
    return _model(spark, 0.0, grid)


def nmf_loss(model: Factors, train: DataFrame, reg: float = NMF_REG) -> float:
    """What the updates lower: squared errors, and per rating the squared lengths of its factors times ``reg``."""
    j = _joined(model, train)
    square = lambda c: F.aggregate(c, F.lit(0.0), lambda s, x: s + x * x)
    return j.agg(F.sum((F.col("score") - _dot()) ** 2 + reg * (square("_p") + square("_q")))).first()[0]


# ---- what a model gives -----------------------------------------------------------------


def _joined(model: Factors, pairs: DataFrame) -> DataFrame:
    p = model.side(0, "uid").select("uid", F.col("bias").alias("_bu"), F.col("factors").alias("_p"))
    q = model.side(1, "item_id").select("item_id", F.col("bias").alias("_bi"), F.col("factors").alias("_q"))
    return pairs.join(p, "uid", "left").join(q, "item_id", "left")


def _dot() -> Column:
    return F.aggregate(F.zip_with("_p", "_q", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def _estimated(model: Factors, pairs: DataFrame) -> DataFrame:
    """(uid, item_id, true_r, raw, known): the whole formula for every pair, a task a block of users, items streaming through.

    Runs a job that deals the pairs to blocks, and writes what it returns.
    """
    spark, grid = pairs.sparkSession, model.grid
    rows = pairs.select("uid", "item_id", F.col("score").alias("true_r"))
    block = F.pmod(F.xxhash64(F.col("uid").cast("long")), F.lit(grid.blocks)).cast("string")
    path = _stored(rows.withColumn("at", block).repartition(grid.blocks, "at"), "factor-pairs", 1 << 20)
    kinds = T.StructType([*rows.schema.fields, T.StructField("at", T.IntegerType())])
    dealt = {r["at"]: r["count"] for r in spark.read.schema(kinds).parquet(path).groupBy("at").count().collect()}  # a row per block
    out = T.StructType([*rows.schema.fields, T.StructField("raw", T.DoubleType()), T.StructField("known", T.BooleanType())])
    packed = T._parse_datatype_string(PACKED).fields
    none = lambda fields: [F.lit(None).cast(x.dataType).alias(x.name) for x in fields]
    mu = model.mu

    def fn(g: int):
        n, n_own = dealt[g], grid_parts.get((0, g), 0)

        def estimate(batches):
            tables, own, waiting, ready = [], [], [], None

            def meet(r) -> None:
                ids, _, bias, q = _unpack([r])
                lo, hi = (np.searchsorted(items, ids, side) for side in ("left", "right"))
                which = np.repeat(np.arange(len(ids)), hi - lo)
                at = order[np.arange(len(which)) + np.repeat(lo - np.append(0, np.cumsum(hi - lo)[:-1]), hi - lo)]
                raw[at] += bias[which]
                both = mine[at] >= 0
                at, which = at[both], which[both]
                known[at] = True
                for c in range(0, len(at), chunk := max(1, CHUNK // q.shape[1])):
                    x = at[c : c + chunk]
                    raw[x] += np.einsum("ij,ij->i", f[mine[x]], q[which[c : c + chunk]])

            for b in batches:
                is_pair = b.column("kind").is_null()
                if len(pairs_here := b.filter(is_pair)):
                    tables.append(pairs_here.select(names))
                for r in _rows([b.filter(b.column("kind").is_valid())]):
                    if r[0] == 0:
                        own.append(r)
                    elif ready:
                        meet(r)
                    else:
                        waiting.append(r)
                if not ready and len(own) == n_own and sum(map(len, tables)) == n:
                    t = pa.Table.from_batches(tables)
                    uid, item = (t.column(c).combine_chunks().cast(pa.int64()) for c in ("uid", "item_id"))
                    raw, known, mine = np.full(n, mu), np.zeros(n, bool), np.full(n, -1)
                    if own:
                        ids, _, bias, f = _unpack(own)
                        has = np.flatnonzero(uid.is_valid().to_numpy(zero_copy_only=False))
                        at = np.minimum(np.searchsorted(ids, u := uid.drop_null().to_numpy()), len(ids) - 1)
                        found = ids[at] == u
                        mine[has[found]] = at[found]
                        raw[has[found]] += bias[at[found]]
                    order = np.flatnonzero(item.is_valid().to_numpy(zero_copy_only=False))
                    items = item.drop_null().to_numpy()
                    by = np.argsort(items, kind="stable")
                    order, items, ready, own = order[by], items[by], True, []
                    for r in waiting:
                        meet(r)
                    waiting = []
            yield from t.append_column("raw", pa.array(raw)).append_column("known", pa.array(known)).to_batches()

        return estimate

    names, grid_parts = rows.columns, grid.parts
    items = _read(spark, *grid.side(1)).select(*_COLUMNS, *none(rows.schema.fields))
    tasks = []
    for g in sorted(dealt):
        mine = spark.read.schema(rows.schema).parquet(f"{path}/at={g}").select(*none(packed), *names)
        users = [_read(spark, grid.folders[0, g]).select(*_COLUMNS, *none(rows.schema.fields))] if (0, g) in grid.folders else []
        tasks.append(_task(mine, *users, items).mapInArrow(fn(g), out))
    if not tasks:
        return spark.createDataFrame([], out)
    with _large_rows(spark):
        return materialize(_tasks(spark, tasks), "factor-estimates")


def predict(model: Factors, test: DataFrame, lo: float = 1.0, hi: float = 5.0, known_only: bool = False) -> DataFrame:
    """M3: (uid, item_id, true_r, est) of every test row; what an unseen user or item lacks counts as 0.

    ``known_only`` leaves out rows of unseen users or items, as a model without a mean must.
    """
    if model.grid:
        j = _estimated(model, test)
        j = j.where("known") if known_only else j
        return j.select("uid", "item_id", "true_r", rnd(clamp(F.col("raw"), lo, hi)).alias("est"))
    j = _joined(model, test)
    j = j.where("_p IS NOT NULL AND _q IS NOT NULL") if known_only else j
    zero = F.lit(0.0)
    raw = F.lit(model.mu) + F.coalesce("_bu", zero) + F.coalesce("_bi", zero) + F.coalesce(_dot(), zero)
    return j.select("uid", "item_id", F.col("score").alias("true_r"), rnd(clamp(raw, lo, hi)).alias("est"))


def recommend_all(model: Factors, k: int = 10, lo: float = 1.0, hi: float = 5.0, block_size: int = 512) -> tuple[DataFrame, inner_product.Products]:
    """M6: every user's k best items by the whole formula, exact; lists are ranked before clamping."""
    one = F.array(F.lit(1.0))
    users = model.side(0, "id").select("id", F.concat("factors", F.array("bias"), one).alias("features"))
    items = model.side(1, "id").select("id", F.concat("factors", one, F.array("bias")).alias("features"))
    best, products = inner_product.search(users, items, k, block_size)
    return best.withColumn("est", rnd(clamp(F.lit(model.mu) + F.col("est"), lo, hi))), products
