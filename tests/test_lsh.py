"""Approximate neighbours: recall against the exact lists, exact similarities, bounded groups, growth of the work."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellar.operators import lsh, similarity
from cellar.sources.tables import Tables

SCHEMA = "vec_id bigint, embedding array<float>"


def rows(df):
    return {(r["vec_id"], r["sim_vec_id"]): r["sim"] for r in df.collect()}


def frame(spark, x):
    return spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], SCHEMA)


@pytest.mark.parametrize("sf", ("sf0.01", "sf0.1"))
def test_recall_and_exact_similarities(spark, sf):
    v = Tables(spark, f"/root/testdata/{sf}").embeddings
    near, cells = lsh.search(v, "vec_id", "embedding", 10)
    got, want = rows(near), rows(similarity.cosine_topk_dense(v, "vec_id", "embedding", 10))
    assert len(got.keys() & want.keys()) >= 0.9 * len(want)
    assert all(abs(s - want[p]) < 2e-6 for p, s in got.items() if p in want)
    assert len(cells.bits[0]) > 1 and max(np.bincount(cells.own(np.stack([np.array(r[0]) / np.linalg.norm(r[0]) for r in v.select("embedding").collect()]), 0))) <= 2 * 4 * len(got) ** 0.5


def test_work_grows_less_than_the_square(spark):
    """Clustered vectors: each looks at few cells; vectors without structure: still below the square."""
    r = np.random.default_rng(3)
    work = {}
    for n in (1000, 4000):
        centres = r.normal(size=(n // 20, 32))
        x = np.repeat(centres, 20, axis=0) + 0.2 * r.normal(size=(n, 32))
        near, cells = lsh.search(frame(spark, x), "vec_id", "embedding", 5)
        want = rows(similarity.cosine_topk_dense(frame(spark, x), "vec_id", "embedding", 5))
        assert len(rows(near).keys() & want.keys()) >= 0.9 * len(want)
        work[n] = cells.pairs
    assert work[4000] < 0.2 * 4000**2 and work[4000] < 9 * work[1000]  # the square would be 16 times
    a, b = (lsh.search(Tables(spark, f"/root/testdata/{s}").embeddings, "vec_id", "embedding", 10)[1] for s in ("sf0.01", "sf0.1"))
    assert b.pairs / a.pairs < (b.vectors / a.vectors) ** 2


def test_a_vector_that_a_third_shares(spark, monkeypatch):
    r = np.random.default_rng(5)
    x = r.normal(size=(600, 16))
    x[100:300] = x[100]
    x[300:320] = 0
    monkeypatch.setattr(lsh, "MAX_QUERIES", 40)  # both sides of a cell are dealt to chunks
    got, want = rows(lsh.cosine_topk_lsh(frame(spark, x), "vec_id", "embedding", 5, recall=1.0)), rows(similarity.cosine_topk_dense(frame(spark, x), "vec_id", "embedding", 5))
    assert len(got.keys() & want.keys()) >= 0.97 * len(want)
    assert {p for p in got if 100 <= p[0] < 300} == {p for p in want if 100 <= p[0] < 300}
    assert not any(300 <= a < 320 or 300 <= b < 320 for a, b in got)


def test_few_null_and_no_vectors(spark):
    none = lsh.cosine_topk_lsh(spark.createDataFrame([(1, None), (2, [0.0, 0.0])], SCHEMA), "vec_id", "embedding")
    assert none.count() == 0 and none.columns == ["vec_id", "sim_vec_id", "sim", "rank"]
    two = lsh.cosine_topk_lsh(frame(spark, [[1, 0], [1, 1], [0, 0]]), "vec_id", "embedding")
    assert rows(two) == {(0, 1): 0.707107, (1, 0): 0.707107}
    assert lsh.cosine_topk_lsh(frame(spark, [[1, 0]]), "vec_id", "embedding").count() == 0
    assert two.where(F.col("rank") != 1).count() == 0
