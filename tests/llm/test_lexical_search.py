from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest

from cellar.llm import lexical_search as L
from cellar.llm import queries
from tests.llm.helpers import NASTY, SMALL, clashing, docs

ITEMS = "item_id bigint, text string"


def terms(text):
    return L.TERM.findall((text or "").translate(L.TO_LOWER))


def brute(doc_rows, item_rows, k=20):
    counts = [(i, Counter(terms(t))) for i, t in doc_rows]
    counts = [(i, c) for i, c in counts if c]
    n_docs, length = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    wanted = {}
    for i, t in item_rows:
        wanted.setdefault(i, Counter()).update(terms(t))
    out = set()
    for item, q in wanted.items():
        rows = []
        for doc, c in counts:
            m = 75 + (25 * sum(c.values()) * n_docs) // length
            s = sum(times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 12 * m)) for t, times in q.items() if c[t])
            if s > 0:
                rows.append((-s, doc is not None, doc or 0, doc))
        rows.sort()
        out |= {(item, r + 1, doc, -s) for r, (s, _, _, doc) in enumerate(rows[:k])}
    return out


def got(df):
    return {tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()}


def test_whole_tables_equal_brute_force(spark):
    t = {n: spark.read.parquet(f"{SMALL}/{n}.parquet").collect() for n in ("documents", "benchmark")}
    assert got(queries.op13_lexical_search(spark, SMALL)) == brute([(r["doc_id"], r["text"]) for r in t["documents"]], [(r["item_id"], r["text"]) for r in t["benchmark"]])


def test_edge_rows_ties_repeats_and_extra_columns(spark):
    rows = [*NASTY, (20, "Tie here"), (21, "tie HERE"), (21, "tie here"), (22, "ÀÉ àé a1b2_c"), (23, "w1 w1 w1 x1")]
    items = [(1, "TIE here tie"), (2, None), (3, "!!"), (None, "null item words"), (5, "àé B2"), (5, "w1 x1"), (6, "absent"), (7, "a1b2 a1b2 c"), (-1, "The same row of a few words")]
    asked = spark.createDataFrame(items, ITEMS)
    have = got(L.search(clashing(docs(spark, rows)), asked.selectExpr("*", "'x' AS doc_id", "1 AS score", "2 AS rank"), k=3))
    assert have == brute([r[:2] for r in rows], items, 3)
    assert got(L.search(docs(spark, []), asked)) == set() == got(L.search(docs(spark, rows), asked.limit(0)))


def test_blocks_of_items_give_the_same_rows(spark, monkeypatch):
    r = random.Random(5)
    words = [f"w{int(r.paretovariate(0.6))}" for _ in range(4000)]
    rows = [(i, " ".join(r.choices(words, k=r.randint(1, 60)))) for i in range(300)]
    items = [(i, " ".join(r.choices(words, k=r.randint(0, 40)))) for i in range(40)]
    want = brute(rows, items, 5)
    asked = spark.createDataFrame(items, ITEMS)
    assert got(L.search(docs(spark, rows), asked, 5)) == want
    monkeypatch.setattr(L, "BLOCK_TERMS", 100)
    assert got(L.search(docs(spark, rows), asked, 5)) == want


@pytest.mark.parametrize("seed", range(4))
def test_shared_sums_are_the_items(seed):
    r = random.Random(seed)
    items = [dict(Counter(r.choices(range(30), k=r.randint(1, 25)))) for _ in range(25)]
    sharing = L.Sharing(items)
    values = np.array([r.randint(1, 99) for _ in range(30)])
    sums = [values[t] * n for t, n in sharing.leaves]
    for a, b in sharing.nodes:
        sums.append(sums[a] + sums[b])
    assert [sum(sums[p] for p in parts) for parts in sharing.items] == [sum(values[t] * n for t, n in i.items()) for i in items]
    assert sharing.sums() < sum(len(i) - 1 for i in items)
    pairs = Counter(frozenset((a, b)) for parts in sharing.items for a in parts for b in parts if a < b)
    assert max(pairs.values()) == 1  # nothing more to share


def test_terms_of_one_hash_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(L, "span_hashes", lambda data, a, b: np.full(len(a), 7, np.uint64))
    monkeypatch.setattr(L.Words, "hashes", lambda w: np.full(len(w.starts), 7, np.uint64))
    text = "alpha beta alphab al beta"
    import pyarrow as pa

    vocabulary = L.Vocabulary(["alpha", "beta", "alph", "gamma"])
    (_, _, offsets, data), = L.slices(pa.array([text]))
    word, term = vocabulary.find(L.Words(offsets, data, L.ALNUM))
    assert sorted(zip(word.tolist(), term.tolist())) == [(0, 0), (1, 1), (4, 1)]
