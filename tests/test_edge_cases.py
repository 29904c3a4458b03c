"""Hand-made edge frames (FIXTURES.md part C) and brute-force checks of the custom operators."""

from __future__ import annotations

import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellar.functions.quantiles import exact_quantiles
from cellar.functions.text import ENGLISH_STOP_WORDS
from cellar.operators import clean, evaluate, neighbours, pages, similarity, stats


def srt(tuples):
    return sorted(tuples, key=lambda t: tuple((v is None, v if v is not None else 0) for v in t))


def rows(df, *cols):
    return srt(tuple(r[c] for c in cols) for r in df.collect())


def test_stop_words_are_sparks_default(spark):
    from pyspark.ml.feature import StopWordsRemover

    assert ENGLISH_STOP_WORDS == StopWordsRemover.loadDefaultStopWords("english")


def test_dirty_ratings_cap_and_dropna(spark):
    df = spark.createDataFrame(
        [(1, 1, 7.0), (2, 2, None), (3, 3, float("nan")), (4, 4, 5.0), (None, 5, 3.0), (6, None, 2.0)],
        "uid long, item_id long, score double",
    )
    capped = rows(clean.cap_filter(df), "uid", "score")
    assert (1, 7.0) not in capped and (4, 5.0) in capped
    assert (2, None) in capped and (3, None) in capped  # missing is kept (D3)
    clean_rows = rows(clean.drop_incomplete(df), "uid", "item_id", "score")
    assert clean_rows == [(1, 1, 7.0), (4, 4, 5.0)]


def test_placeholder_text_and_inner_semantics(spark):
    from cellar.operators import enrich

    nb = "  "
    df = spark.createDataFrame(
        [("only", 1, nb, 4.0), ("mixed", 1, nb, 1.0), ("mixed", 2, "b", 3.0), ("mixed", 3, "a", None)],
        "item_id string, ord long, text string, score double",
    )
    out = {r["item_id"]: (r["score"], r["text"]) for r in enrich.text_and_mean(df).collect()}
    assert "only" not in out  # only placeholder text -> no row (D4)
    assert out["mixed"] == (2.0, "b,a")  # mean over all rows, text in ord order


def test_text_concat_chunks_a_hot_key(spark):
    from cellar.operators import enrich

    df = spark.createDataFrame([("hot", i, f"t{i}") for i in range(25)] + [("cold", 0, "x")], "item_id string, ord long, text string")
    df = df.union(spark.createDataFrame([("hot", 3, None)], df.schema))
    parts = rows(enrich.text_concat(df, chunk=10), "item_id", "part", "text")
    hot = [p for p in parts if p[0] == "hot"]
    assert [p[1] for p in hot] == [0, 1, 2]
    assert ",".join(p[2] for p in hot) == ",".join(f"t{i}" for i in range(25))  # whole text, in order
    assert [p for p in parts if p[0] == "cold"] == [("cold", 0, "x")]


def test_tie_at_n_broken_by_key(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (2,), (3,)], "item_id long")
    top = rows(stats.top_n_by_count(df, "item_id", 1, "n"), "item_id", "n")
    assert top == [(1, 2)]


def test_duplicate_pair_policy(spark):
    from cellar.sources.tables import dedupe_ratings

    df = spark.createDataFrame([(1, 1, 2.0, 1), (1, 1, 4.0, 0)], "uid long, item_id long, score double, ts long")
    assert rows(dedupe_ratings(df, "max"), "score") == [(4.0,)]
    assert rows(dedupe_ratings(df, "mean"), "score") == [(3.0,)]
    assert rows(dedupe_ratings(df, "latest"), "score") == [(2.0,)]


def test_constant_user_pearson_is_null(spark):
    # target rates everything 5 -> Pearson undefined for everybody
    r = [(0, i, 5.0) for i in range(4)] + [(1, i, float(i + 1)) for i in range(4)] + [(2, 0, 3.0)]
    df = spark.createDataFrame(r, "uid long, item_id long, score double")
    assert neighbours.similar_users(df, 0, 5, mode="pairwise", min_overlap=1).count() == 0
    # neighbour constant -> NULL, neighbour with one common item -> NULL
    r2 = [(0, i, float(i + 1)) for i in range(4)] + [(1, i, 2.0) for i in range(4)] + [(2, 0, 3.0)]
    df2 = spark.createDataFrame(r2, "uid long, item_id long, score double")
    assert neighbours.similar_users(df2, 0, 5, mode="pairwise", min_overlap=1).count() == 0


def test_overlap_strict_vs_pairwise(spark):
    base = [(0, i, float(s)) for i, s in enumerate([1, 2, 3, 5])]
    others = [(1, 0, 2.0), (1, 1, 1.0), (1, 2, 3.0), (1, 3, 5.0),  # 4 of 4
              (2, 0, 1.0), (2, 1, 3.0), (2, 2, 2.0),  # 3 of 4
              (3, 0, 4.0),  # 1 of 4
              (4, 9, 1.0)]  # 0 of 4
    df = spark.createDataFrame(base + others, "uid long, item_id long, score double")
    strict = rows(neighbours.similar_users(df, 0, 5, mode="strict"), "uid")
    pair = rows(neighbours.similar_users(df, 0, 5, mode="pairwise", min_overlap=3), "uid")
    assert strict == [(1,)]
    assert pair == [(1,), (2,)]
    # numbers agree with numpy
    r1 = [r for r in neighbours.similar_users(df, 0, 5, mode="strict").collect()][0]["r"]
    assert abs(r1 - np.corrcoef([1, 2, 3, 5], [2, 1, 3, 5])[0, 1]) < 1e-6


def test_neighbour_clash_most_similar_wins(spark):
    preds = spark.createDataFrame(
        [(10, 1, 3.0, 4.0), (11, 1, 3.0, 2.0), (11, 2, 3.0, 3.5), (12, 3, 1.0, 1.0)],
        "uid long, item_id long, true_r double, est double",
    )
    nb = spark.createDataFrame([(10, 1), (11, 2), (13, 3)], "uid long, rank long")
    out = {r["item_id"]: r["est"] for r in neighbours.pooled_recommendations(preds, nb, n=5).collect()}
    assert out == {1: 4.0, 2: 3.5}  # item 1 from the rank-1 neighbour; neighbour 13 has none


def test_lookup_statuses(spark):
    items = spark.createDataFrame([(0, "a", "x"), (1, "b", "x"), (2, "b", "x")], "item_id long, name string, brand string")
    req = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "x")], "name string, brand string")
    out = {r["name"]: (r["status"], r["item_id"]) for r in neighbours.lookup_items(req, items, ["name", "brand"]).collect()}
    assert out == {"a": ("ok", 0), "b": ("ambiguous", None), "c": ("none", None)}  # id 0 is found (D21)


def test_precision_recall_edges(spark):
    p = spark.createDataFrame(
        [(1, 1, 2.0, 2.0), (1, 2, 1.0, 1.0),  # no relevant, none recommended
         (2, 1, 5.0, 4.0), (2, 2, 5.0, 4.0), (2, 3, 1.0, 4.0)],  # tie on est at k=2 -> item id decides
        "uid long, item_id long, true_r double, est double",
    )
    out = {r["uid"]: (r["precision"], r["recall"]) for r in evaluate.precision_recall_per_user(p, 2, 3.5).collect()}
    assert out[1] == (0.0, 0.0)
    assert out[2] == (1.0, 1.0)


def test_missing_page_elements(spark):
    html = '<html lang="en"><body><a href="/x">x</a><a href="/the">t</a><a href="/y,">y</a></body></html>'
    df = spark.createDataFrame([(1, "http://h.example.com/en/12?page=3", html)], "page_id long, url string, html string")
    c = pages.page_cards(df).first()
    assert c["title"] is None and c["lang"] == "en" and c["host"] == "h.example.com"
    assert c["path_no"] == 12 and c["page_no"] == 3 and c["n_links"] == 3
    links = rows(pages.page_links(df, r"[.,]$"), "pos", "link")
    assert links == [(0, "/x"), (1, "/the")]
    assert rows(pages.links_from(df, "/the"), "pos", "link") == [(1, "/the"), (2, "/y,")]
    assert pages.links_from(df, "/none").count() == 0
    s = spark.createDataFrame([("7/10",), ("x/10",), ("",), ("3/5",)], "t string")
    assert rows(s.select(pages.parse_fraction(F.col("t")).alias("v")), "v") == srt([(7,), (None,), (None,), (3,)])


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(1)
    vals = np.concatenate([rng.integers(0, 50, 3000), np.full(2000, 7)]).astype(float)  # a hot value
    g = np.where(np.arange(len(vals)) % 3 == 0, "a", "b")
    df = spark.createDataFrame([(str(k), float(v)) for k, v in zip(g, vals)], "g string, v double")
    out = {r["g"]: r for r in exact_quantiles(df, "v", [0.1, 0.5, 0.9], by=["g"], rows_per_range=7).collect()}
    for k in ("a", "b"):
        exp = np.quantile(vals[g == k], [0.1, 0.5, 0.9])
        assert np.allclose([out[k]["q10"], out[k]["q50"], out[k]["q90"]], exp)


def test_dense_ids_sorted_and_dense(spark):
    df = spark.createDataFrame([(n,) for n in ["d", "b", "a", "b", "c", None]], "name string")
    out = rows(stats.dense_ids(df, "name", "uid"), "name", "uid")
    assert out == [("a", 0), ("b", 1), ("c", 2), ("d", 3)]


def _brute_pairs(long):
    by_e = {}
    for e, d, v in long:
        by_e.setdefault(e, {})[d] = v
    out = {}
    for a in by_e:
        for b in by_e:
            if a == b:
                continue
            common = set(by_e[a]) & set(by_e[b])
            if common:
                xs = [by_e[a][d] for d in common]
                ys = [by_e[b][d] for d in common]
                out[(a, b)] = (len(common), sum(xs), sum(ys), sum(x * y for x, y in zip(xs, ys)))
    return out


def test_moment_sums_in_dimension_batches(monkeypatch):
    import pandas as pd

    rng = np.random.default_rng(17)
    lt = pd.DataFrame({"a": rng.integers(0, 30, 400), "d": rng.integers(0, 20, 400), "x": rng.random(400)}).drop_duplicates(["a", "d"])
    rt = lt.rename(columns={"a": "b", "x": "y"})
    whole = similarity._moment_sums(lt, rt, True).set_index(["a", "b"]).sort_index()
    monkeypatch.setattr(similarity, "PAIR_ROWS_PER_BATCH", 7)  # many small batches
    batched = similarity._moment_sums(lt, rt, True).set_index(["a", "b"]).sort_index()
    pd.testing.assert_frame_equal(whole, batched, check_exact=False, rtol=1e-12)
    assert len(whole) > 100


def test_pair_sums_blocks_and_heavy_entities_match_brute_force(spark):
    rng = np.random.default_rng(3)
    long = [(int(e), int(d), float(rng.integers(1, 6))) for e in range(40) for d in range(30) if rng.random() < 0.3]
    long += [(int(e), 99, 1.0) for e in range(40)]  # one dimension shared by every entity
    df = spark.createDataFrame(long, "e long, d long, v double")
    exp = _brute_pairs(long)
    # small blocks and tiny groups force several blocks and a separate path for heavy entities
    got = similarity.pair_sums(df, "e", "d", "v", moments=True, block_size=7, rows_per_group=50).collect()
    assert len(got) == len(exp)
    for r in got:
        n, sx, sy, sxy = exp[(r["a"], r["b"])]
        assert (r["n"], r["sx"], r["sy"], r["sxy"]) == (n, sx, sy, sxy)


def test_cosine_topk_trimming_is_exact(spark):
    rng = np.random.default_rng(5)
    long = [(int(e), int(d), float(rng.random())) for e in range(60) for d in range(12) if rng.random() < 0.5]
    long += [(60, 0, 1.0), (61, 0, 1.0)]  # twins
    df = spark.createDataFrame(long, "e long, d long, v double")
    got = similarity.cosine_topk_long(df, "e", "d", "v", k=3, block_size=9).cache()
    res = got.collect()
    sums = {k: v[3] for k, v in _brute_pairs(long).items() if v[3] > 0}
    for a in {k[0] for k in sums}:
        cand = sorted(((-round(s, 6), b) for (x, b), s in sums.items() if x == a))[:3]
        mine = sorted((-r["sim"], r["sim_e"]) for r in res if r["e"] == a)
        assert [b for _, b in mine] == [b for _, b in cand]
    # twins find each other, not themselves
    twin = got.where((F.col("e") == 60) & (F.col("rank") == 1)).first()
    assert twin["sim_e"] == 61 and got.where(F.col("e") == F.col("sim_e")).count() == 0


def test_dense_cosine_matches_numpy(spark):
    rng = np.random.default_rng(7)
    vecs = rng.normal(size=(30, 5))
    vecs[3] = 0.0  # zero vector: no edges
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vecs)], "id long, v array<double>")
    got = similarity.cosine_topk_dense(df, "id", "v", k=2, block_size=4)
    assert got.where((F.col("id") == 3) | (F.col("sim_id") == 3)).count() == 0
    u = vecs / np.where(np.linalg.norm(vecs, axis=1, keepdims=True) > 0, np.linalg.norm(vecs, axis=1, keepdims=True), np.nan)
    s = u @ u.T
    best = int(np.nanargmax(np.where(np.eye(30, dtype=bool), np.nan, s)[0]))
    assert got.where((F.col("id") == 0) & (F.col("rank") == 1)).first()["sim_id"] == best


def test_planted_factors_als_beats_mean(spark):
    from cellar.operators import factor

    rng = np.random.default_rng(11)
    P, Q = rng.random((60, 2)), rng.random((40, 2))
    R = 1 + 4 * (P @ Q.T) / (P @ Q.T).max() + rng.normal(scale=0.05, size=(60, 40))
    data = [(u, i, float(R[u, i])) for u in range(60) for i in range(40)]
    df = spark.createDataFrame(data, "uid long, item_id long, score double")
    key = F.pmod(F.col("uid") * 31 + F.col("item_id"), F.lit(5))
    train, test = df.where(key != 0), df.where(key == 0)
    model = factor.als(rank=2, reg=0.01, max_iter=15).fit(train)
    rmse = evaluate.rmse_mae(factor.als_predict(model, test)).first()["rmse"]
    sd = float(np.std(R))
    assert rmse < 0.5 * sd


def test_streaming_restart_appends_each_url_once(spark, tmp_path):
    from cellar.streaming.pages import read_sink, run_incremental

    schema = "page_id long, url string, html string"
    a = spark.createDataFrame([(1, "u1", "x"), (2, "u2", "y")], schema)
    b = spark.createDataFrame([(3, "u3", "z"), (1, "u1", "x")], schema)
    inbox, sink, ck = (os.path.join(str(tmp_path), d) for d in ("in", "out", "ck"))
    a.write.parquet(inbox, mode="append")
    run_incremental(spark, a.schema, inbox, sink, ck)
    run_incremental(spark, a.schema, inbox, sink, ck)  # nothing new: no duplicates
    b.write.parquet(inbox, mode="append")
    run_incremental(spark, a.schema, inbox, sink, ck)
    assert rows(read_sink(spark, sink), "url") == [("u1",), ("u2",), ("u3",)]


def test_histogram_bins(spark):
    df = spark.createDataFrame([(float(x),) for x in [0, 1, 2, 9, 10]], "x double")
    out = rows(stats.histogram(df, "x", 10), "bin", "count")
    # every bin has a row; the max falls in the last one
    assert out == [(0, 1), (1, 1), (2, 1), *[(i, 0) for i in range(3, 9)], (9, 2)]
    none = spark.createDataFrame([(None,), (float("nan"),)], "x double")
    assert stats.histogram(none, "x", 10).count() == 0


@pytest.mark.parametrize("v,expected", [(0.1234565, 0.123457), (2.5e-7, 0.0), (-0.0000015, -0.000002)])
def test_rounding_half_away_from_zero(spark, v, expected):
    from cellar.functions.exprs import rnd

    got = spark.range(1).select(rnd(F.lit(v)).alias("r")).first()["r"]
    assert math.isclose(got, round(v * 1e6) / 1e6) or math.isclose(got, expected)


def test_recommender_api(spark):
    from cellar.recommenders import CollabRecommender, ContentRecommender
    from cellar.sources.tables import Tables, train_test

    t = Tables(spark, "/root/testdata/sf0.001")
    items = t.items().join(t.producers(), "producer_id", "left")
    cr = ContentRecommender(t.reviews(), items).fit()
    one = items.groupBy("name", "producer_name").count().where("count = 1").join(
        cr.similarities.select(F.col("item_id").alias("iid")).distinct(), how="inner",
        on=F.lit(True)).first()
    row = items.where((F.col("name") == one["name"]) & (F.col("producer_name") == one["producer_name"])).first()
    recs = cr.recommend(row["name"], row["producer_name"], 3)
    assert recs.count() <= 3
    train, test = train_test(t.ratings())
    col = CollabRecommender(train).fit()
    assert col.top_n(test, 2).groupBy("uid").count().where("count > 2").count() == 0
    profile = {r["item_id"]: float(r["score"]) for r in train.where("uid = 7").limit(8).collect()}
    uid, added = col.add_user(profile)
    assert uid == train.agg({"uid": "max"}).first()[0] + 1
    assert added.ratings.where(F.col("uid") == uid).count() == len(profile)
    unseen = added.recommend_for(uid, "unseen", n=5)
    assert unseen.count() == 5 and not {r["item_id"] for r in unseen.collect()} & set(profile)
    held = added.recommend_for(uid, test, n=3)
    assert 0 < held.count() <= 3
    nobody = CollabRecommender(train).fit().add_user({})[1]
    assert nobody.recommend_for(uid, "unseen").count() == 0


@pytest.mark.parametrize("rows_per_group", [10**9, 40])  # all in blocks / some entities heavy
def test_pearson_topk_matches_brute_force(spark, rows_per_group, monkeypatch):
    rng = np.random.default_rng(13)
    data = [(int(i), int(u), float(rng.integers(1, 6))) for i in range(25) for u in range(20) if rng.random() < 0.5]
    df = spark.createDataFrame(data, "item_id long, uid long, score double")
    orig = similarity.pair_sums
    monkeypatch.setattr(similarity, "pair_sums", lambda *a, **k: orig(*a, **{**k, "rows_per_group": rows_per_group, "block_size": 6}))
    got = similarity.pearson_topk(df, "item_id", "uid", "score", k=3, min_overlap=3).collect()
    by = {}
    for i, u, s in data:
        by.setdefault(i, {})[u] = s
    for a in by:
        cand = []
        for b in by:
            common = sorted(set(by[a]) & set(by[b]))
            if a == b or len(common) < 3:
                continue
            x, y = [by[a][u] for u in common], [by[b][u] for u in common]
            if np.std(x) == 0 or np.std(y) == 0:
                continue
            cand.append((-round(float(np.corrcoef(x, y)[0, 1]), 6), b))
        mine = sorted((-r["r"], r["b"]) for r in got if r["a"] == a)
        assert [b for _, b in mine] == [b for _, b in sorted(cand)[:3]]


def test_streaming_dedupe_within_watermark(spark, tmp_path):
    import datetime as dt

    from cellar.streaming.pages import read_sink, run_incremental

    schema = "page_id long, url string, html string, ts timestamp"
    t0 = dt.datetime(2024, 1, 1)
    a = spark.createDataFrame([(1, "u1", "x", t0), (2, "u2", "y", t0)], schema)
    b = spark.createDataFrame([(3, "u1", "x", t0 + dt.timedelta(hours=1)), (4, "u3", "z", t0)], schema)
    inbox, sink, ck = (os.path.join(str(tmp_path), d) for d in ("in", "out", "ck"))
    a.write.parquet(inbox, mode="append")
    run_incremental(spark, a.schema, inbox, sink, ck, event_time="ts", delay="1 day")
    b.write.parquet(inbox, mode="append")
    run_incremental(spark, a.schema, inbox, sink, ck, event_time="ts", delay="1 day")
    assert rows(read_sink(spark, sink), "url") == [("u1",), ("u2",), ("u3",)]


def test_recommend_all_matches_numpy(spark):
    from cellar.operators import factor

    rng = np.random.default_rng(19)
    P, Q = rng.normal(size=(23, 3)), rng.normal(size=(31, 3))
    uf = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(P)], "id int, features array<float>")
    itf = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(Q)], "id int, features array<float>")
    got = factor.recommend_all(uf, itf, k=4, block_size=5).collect()
    P32, Q32 = P.astype("float32").astype("float64"), Q.astype("float32").astype("float64")
    S = P32 @ Q32.T
    for u in range(23):
        mine = [r["item_id"] for r in sorted((r for r in got if r["uid"] == u), key=lambda r: r["rank"])]
        assert mine == list(np.argsort(-S[u], kind="stable")[:4])


def test_distinct_counts_exact_and_approx(spark):
    df = spark.createDataFrame([(u, i) for u in range(50) for i in range(u % 7 + 1)], "uid long, item_id long")
    ex = stats.distinct_counts(df).first()
    ap = stats.distinct_counts(df, approx=0.01).first()
    assert (ex["n_users"], ex["n_items"]) == (50, 7)
    assert abs(ap["n_users"] - 50) <= 2 and ap["n_items"] == 7


def test_nan_is_missing_everywhere(spark):
    nan = float("nan")
    df = spark.createDataFrame([("a", 5.0), ("a", nan), ("a", None), ("a", 3.0), ("b", nan)], "k string, x double")
    assert rows(stats.null_counts(df), "column", "n_null") == [("k", 0), ("x", 3)]
    assert rows(stats.mean_per_key(df, "k", ["x"]), "k", "x_mean") == [("a", 4.0), ("b", None)]
    assert rows(stats.means_sorted(df, "k", "x"), "k", "mean") == [("a", 4.0), ("b", None)]
    d = stats.numeric_describe(df, ["x"]).first()
    assert (d["count"], d["mean"], d["min"], d["q50"], d["max"]) == (2, 4.0, 3.0, 4.0, 5.0)
    assert rows(stats.per_key_count_stats(df, "k", "x"), "n_keys", "max_n") == [(1, 2)]
    assert rows(stats.avg_median(df, "k", ["x"]), "k", "x_avg", "x_med") == [("a", 4.0, 4.0), ("b", None, None)]
    assert rows(stats.global_stats(df, "x"), "mean", "n") == [(4.0, 2)]
    assert sum(r["count"] for r in stats.histogram(df, "x", 4).collect()) == 2


def test_pivot_takes_its_columns_from_the_data(spark):
    df = spark.createDataFrame([(1, "new", 2.0), (1, "old", 1.0), (2, "new", 3.0)], "uid long, item string, score double")
    out = stats.pivot_wide(df, "uid", "item", "score")
    assert out.columns == ["uid", "new", "old"] and rows(out, "uid", "new", "old") == [(1, 2.0, 1.0), (2, 3.0, None)]
    with pytest.raises(ValueError):
        stats.pivot_wide(df, "uid", "item", "score", ["old"])


def test_positions_split_a_hot_key(spark):
    data = [("hot", f"2024-01-{i % 28 + 1:02d}", f"u{i % 7}", i) for i in range(500)] + [("cold", "2024-01-01", "u", 0)]
    df = spark.createDataFrame(data, "k string, d string, u string, i int").selectExpr("k", "CAST(d AS DATE) AS d", "u", "i")
    got = stats.positions_per_key(df, "k", ["d", "u", "i"]).collect()
    want = {x: n for n, x in enumerate(sorted((d, u, i) for k, d, u, i in data if k == "hot"))}
    assert {(str(r["d"]), r["u"], r["i"]): r["pos"] for r in got if r["k"] == "hot"} == want
    assert [r["pos"] for r in got if r["k"] == "cold"] == [0]


def _counted(spark, fn):
    """``fn`` for applyInPandas with a count of its calls and of the most rows in one."""
    from pyspark.accumulators import AccumulatorParam

    class Most(AccumulatorParam):
        def zero(self, v):
            return 0

        def addInPlace(self, a, b):
            return max(a, b)

    calls, most = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0, Most())

    def counted(key, pdf):
        calls.add(1)
        most.add(len(pdf))
        return fn(key, pdf)

    return counted, calls, most


def test_each_block_pair_is_computed_once(spark, monkeypatch):
    rng = np.random.default_rng(23)
    data = [(int(i), int(u), float(rng.integers(1, 6))) for i in range(60) for u in range(30) if rng.random() < 0.4]
    df = spark.createDataFrame(data, "item_id long, uid long, score double")
    monkeypatch.setattr(similarity, "_layout", lambda *a: 3)
    made = {}
    orig = similarity._pair_sums_group

    def group(*a):
        fn, made["calls"], made["most"] = _counted(spark, orig(*a))
        return fn

    monkeypatch.setattr(similarity, "_pair_sums_group", group)
    similarity.pearson_topk(df, "item_id", "uid", "score", k=3).collect()
    assert made["calls"].value == 6  # 3 blocks, 6 pairs of blocks
    similarity.cosine_topk_long(df, "item_id", "uid", "score", k=3).collect()
    assert made["calls"].value == 6


def test_hot_item_stays_out_of_the_groups(spark, monkeypatch):
    rng = np.random.default_rng(29)
    data = [(int(i), int(u), float(rng.integers(1, 6))) for i in range(40) for u in rng.choice(600, 15, replace=False)]
    data += [(99, u, float(rng.integers(1, 6))) for u in range(300)]  # a third of all rows
    df = spark.createDataFrame(data, "item_id long, uid long, score double")
    made, orig, sums = {}, similarity._pair_sums_group, similarity.pair_sums

    def group(*a):
        fn, made["calls"], made["most"] = _counted(spark, orig(*a))
        return fn

    monkeypatch.setattr(similarity, "_pair_sums_group", group)
    monkeypatch.setattr(similarity, "pair_sums", lambda *a, **k: sums(*a, **{**k, "rows_per_group": 400}))
    got = {(r["a"], r["b"]): (r["n_common"], r["r"]) for r in similarity.pearson_topk(df, "item_id", "uid", "score", k=100).collect()}
    assert made["most"].value < 600
    by = {}
    for i, u, s in data:
        by.setdefault(i, {})[u] = s
    for b in range(40):
        common = sorted(set(by[99]) & set(by[b]))
        x, y = [by[99][u] for u in common], [by[b][u] for u in common]
        if len(common) >= 3 and np.std(x) > 0 and np.std(y) > 0:
            n, r = got[99, b]
            assert n == len(common) and abs(r - np.corrcoef(x, y)[0, 1]) < 1e-5 and got[b, 99] == (n, r)


def test_texts_in_date_and_name_order_with_equal_order_values(spark):
    from cellar.operators import enrich

    data = [("i", f"2024-01-{d:02d}", u, f"t{d}{u}{k}") for d in (2, 1) for u in "ba" for k in (1, 0)]
    df = spark.createDataFrame(data, "item_id string, date string, username string, text string").selectExpr("item_id", "CAST(date AS DATE) AS date", "username", "text")
    parts = rows(enrich.text_concat(df, order=["date", "username"], chunk=3), "part", "text")
    assert [len(p[1].split(",")) for p in parts] == [3, 3, 2]
    assert ",".join(p[1] for p in parts) == ",".join(x[3] for x in sorted(data, key=lambda x: (x[1], x[2], x[3])))


def test_bigrams_span_reviews_as_in_the_joined_text(spark):
    from cellar.operators import text

    nb = "\u00a0\u00a0"
    df = spark.createDataFrame([("i", 1, "red apple"), ("i", 2, "the"), ("i", 3, nb), ("i", 4, None), ("i", 5, "green"), ("i", 6, "pear tree"), ("j", 1, nb)], "item_id string, ord long, text string")
    got = {r["term"]: r["tf"] for r in text.term_frequencies(df).where("item_id = 'i'").collect()}
    assert got == {"red": 1, "apple": 1, "green": 1, "pear": 1, "tree": 1, "red apple": 1, "apple green": 1, "green pear": 1, "pear tree": 1}
    # an item with placeholder text only is no document: with one document every idf is 1
    w = {r["term"]: r["weight"] for r in text.tfidf(df, ngram=1).collect()}
    assert len(w) == 5 and all(abs(x - 5**-0.5) < 1e-9 for x in w.values())


def test_biased_factors_keep_every_row_and_give_different_lists(spark):
    from cellar.operators import factor

    rng = np.random.default_rng(31)
    P, Q = rng.choice([-1.0, 1.0], size=(40, 1)), rng.choice([-1.0, 1.0], size=(30, 1))
    R = 3 + 1.5 * P @ Q.T
    data = [(u, i, float(R[u, i])) for u in range(40) for i in range(30) if rng.random() < 0.7]
    train = spark.createDataFrame(data, "uid long, item_id long, score double")
    base, model = factor.fit_biased_mf(train, rank=2, reg=0.05, max_iter=10)
    test = spark.createDataFrame([(0, 0, 3.0), (99, 0, 2.0), (0, 99, 4.0), (99, 99, 1.0)], train.schema)
    got = {(r["uid"], r["item_id"]): r["est"] for r in factor.predict_biased_mf(base, model, test).collect()}
    plain = {(r["uid"], r["item_id"]): r["est"] for r in factor.predict_baseline(base, test).collect()}
    assert len(got) == 4 and all(got[k] == plain[k] for k in got if 99 in k)
    recs = factor.biased_mf_recommend_all(base, model, 3, block_size=7).collect()
    lists = {u: [r["item_id"] for r in sorted(recs, key=lambda r: r["rank"]) if r["uid"] == u] for u in range(40)}
    assert len({tuple(x) for x in lists.values()}) > 1
    mu = train.agg({"score": "avg"}).first()[0]
    uf = {r["id"]: np.array(r["features"]) for r in model.userFactors.collect()}
    itf = {r["id"]: np.array(r["features"]) for r in model.itemFactors.collect()}
    bu = {r["uid"]: r["b_u"] for r in base.user_bias.collect()}
    bi = {r["item_id"]: r["b_i"] for r in base.item_bias.collect()}
    for u in range(40):
        score = {i: round(bu[u] + bi[i] + float(uf[u] @ itf[i]), 6) for i in bi}
        best = sorted(score, key=lambda i: (-score[i], i))[:3]
        assert [round(mu + score[i], 4) for i in best] == [round(mu + score[i], 4) for i in lists[u]]


def test_unseen_lists_match_brute_force(spark):
    from cellar.operators import factor

    rng = np.random.default_rng(37)
    data = [(u, i, float(rng.integers(1, 6))) for u in range(12) for i in range(20) if rng.random() < (0.9 if u == 3 else 0.4)]
    df = spark.createDataFrame(data, "uid long, item_id long, score double")
    model = factor.fit_baseline(df)
    got = factor.top_n_unseen(model, df, df.select("uid").union(spark.createDataFrame([(77,)], "uid long")), 4).collect()
    bi = {r["item_id"]: r["b_i"] for r in model.item_bias.collect()}
    for u in [*range(12), 77]:
        seen = {i for x, i, _ in data if x == u}
        want = sorted((i for i in bi if i not in seen), key=lambda i: (-bi[i], i))[:4]
        assert [r["item_id"] for r in sorted(got, key=lambda r: r["rank"]) if r["uid"] == u] == want


def test_baseline_cv_matches_a_fit_per_fold(spark):
    from cellar.operators import factor
    from cellar.sources.tables import fold_of

    rng = np.random.default_rng(41)
    data = [(u, i, float(rng.integers(1, 6))) for u in range(25) for i in range(15) if rng.random() < 0.3] + [(999, 3, 5.0), (4, 888, 1.0)]
    df = spark.createDataFrame(data, "uid long, item_id long, score double")
    got = {(r["reg_i"], r["reg_u"], r["fold"]): (r["rmse"], r["mae"], r["n"]) for r in evaluate.baseline_cv(df, 3, [(10.0, 15.0), (2.0, 5.0)]).collect()}
    for reg_i, reg_u in [(10.0, 15.0), (2.0, 5.0)]:
        for f in range(3):
            train, test = df.where(fold_of(3) != f), df.where(fold_of(3) == f)
            m = evaluate.rmse_mae(factor.prediction_rows(factor.predict_baseline(factor.fit_baseline(train, reg_i, reg_u), test))).first()
            rmse, mae, n = got[reg_i, reg_u, f]
            assert n == m["n"] and abs(rmse - m["rmse"]) < 1e-5 and abs(mae - m["mae"]) < 1e-5


def test_scratch_is_removed_and_cluster_folders_are_asked_for(spark, monkeypatch):
    from cellar import session

    assert session.scratch_path(spark, "x").startswith("file:")  # the full URI is kept
    kept = session._scratch_folder
    monkeypatch.setattr(session, "_scratch_folder", lambda s: kept(s) + "-test")
    df = session.materialize(spark.range(3), "y")
    path = df.inputFiles()[0].removeprefix("file://").removeprefix("file:")
    assert os.path.exists(path) and session.clean_scratch(spark) and not os.path.exists(path)

    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError):
        session.ensure_checkpoint_dir(Session())


def test_package_works_from_another_folder(tmp_path):
    import subprocess
    import sys

    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = f"""
import sys; sys.path.insert(0, {repo!r})
from cellar.session import local_session
import __spark_entry__ as E
s = local_session(2, 4)
print("ROWS", E.queries()["embedding_cosine_topk"](s, "/root/testdata/sf0.001").count())
s.stop()
"""
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "SPARK_HOME")}
    out = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS 5000" in out.stdout, out.stderr[-2000:]


def test_own_items_leave_the_lists_before_they_are_cut(spark):
    """The neighbours' ten best items are all in the target's profile; the n best others come out."""
    from cellar.operators import factor
    from cellar.recommenders import CollabRecommender

    rated = [(100 + u, i, 5.0 if i < 15 else 2.0 + (i % 3)) for u in range(8) for i in range(30)]
    profile = [(i, float(1 + i % 5)) for i in range(15)]
    near = [(u, i, float(1 + i % 5)) for u in range(1, 6) for i in range(3)]
    df = spark.createDataFrame(rated + near, "uid long, item_id long, score double")
    mine = spark.createDataFrame(profile, "item_id long, score double")
    model = factor.fit_baseline(df)
    bias = {r["item_id"]: r["b_i"] for r in model.item_bias.collect()}
    best = sorted(set(range(15, 30)), key=lambda i: (-bias[i], i))[:5]
    attributes = df.select("item_id").distinct()
    out = neighbours.recommend_new_user(df, mine, model, attributes, n=5).collect()
    assert sorted(r["item_id"] for r in out) == sorted(best)
    preds = spark.createDataFrame([(u, i, 0.0, 5.0 - i / 100) for u in (1, 2) for i in range(30)], "uid long, item_id long, true_r double, est double")
    nb = spark.createDataFrame([(1, 1), (2, 2)], "uid long, rank long")
    pooled = neighbours.pooled_recommendations(preds, nb, n=5, exclude=mine).collect()
    assert sorted(r["item_id"] for r in pooled) == list(range(15, 20))
    known = CollabRecommender(df.unionByName(mine.selectExpr("200L AS uid", "item_id", "score")))
    known.model = model
    assert known.recommend_for(200, n=5).count() == 5
