from __future__ import annotations

import random
from collections import Counter

import pytest

from cellar.llm import jaccard_join as J
from cellar.llm import queries
from cellar.llm.components import connected_components
from tests.llm.helpers import NASTY, SMALL, WORD, by_id, clashing, docs, texts


def brute(source):
    words = {k: tuple(WORD.findall(t or "")) for k, t in source.items()}
    sets = {k: {w[i : i + 5] for i in range(len(w) - 4)} or {w} for k, w in words.items()}
    parent, links = {k: k for k in source}, Counter()

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = [k for k in source if words[k]]
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            x, y = sets[a], sets[b]
            if min(len(x), len(y)) * 10 >= max(len(x), len(y)) * 8 and 10 * len(x & y) >= 8 * len(x | y):
                links[a] += 1
                links[b] += 1
                u, v = root(a), root(b)
                parent[max(u, v)] = min(u, v)
    return {k: (root(k), links[k]) for k in source}


def near_copies(n, rng, size=60, changes=1):
    base = [f"w{rng.randrange(10_000)}" for _ in range(size)]
    out = []
    for _ in range(n):
        w = list(base)
        for i in rng.sample(range(size), rng.randint(0, changes)):
            w[i] = f"c{rng.randrange(10_000)}"
        out.append(" ".join(w))
    return out


def test_query_matches_brute_force(spark):
    got = by_id(queries.op6_jaccard_join(spark, SMALL))
    assert {k: (r["class_id"], r["n_links"]) for k, r in got.items()} == brute(texts())


@pytest.mark.parametrize("unit", [J.UNIT_BYTES, 6000, 900])
def test_large_groups_in_units_bands_and_blocks(spark, monkeypatch, unit):
    monkeypatch.setattr(J, "UNIT_BYTES", unit)
    rng = random.Random(1)
    rows = [t for g in range(6) for t in near_copies(12, rng, rng.choice([30, 60, 90]), 1 + g % 2)]
    rows += near_copies(40, rng) + [rows[0]] * 5 + ["short copy"] * 3 + ["short one"]
    rng.shuffle(rows)
    source = dict(enumerate(rows))
    got = by_id(J.near_duplicates(docs(spark, list(source.items()))))
    assert {k: (r["class_id"], r["n_links"]) for k, r in got.items()} == brute(source)


@pytest.mark.parametrize("unit_docs", [7])
def test_units_are_bounded_by_documents(spark, monkeypatch, unit_docs):
    """A cluster of near copies is cut as a whole, a chain of sliding texts by bands; both into blocks of few documents."""
    monkeypatch.setattr(J, "UNIT_DOCS", unit_docs)
    rng = random.Random(4)
    stream = [f"s{i}" for i in range(1300)]
    rows = near_copies(70, rng) + [" ".join(stream[i : i + 60]) for i in range(0, 1200, 4)] + ["a b c d e f"] * 3
    rng.shuffle(rows)
    source = dict(enumerate(rows))
    got = by_id(J.near_duplicates(docs(spark, list(source.items()))))
    assert {k: (r["class_id"], r["n_links"]) for k, r in got.items()} == brute(source)
    signed = J._signatures(docs(spark, list(source.items())).selectExpr("doc_id AS _k", "text AS _text"))
    units = J._units(signed.where("size(bands) > 0").dropDuplicates(["s1", "s2"])).collect()
    per_unit = Counter((u["unit"], u["band"], u["i"], u["j"], u["block"]) for u in units)
    assert max(per_unit.values()) <= 3 * unit_docs
    assert any(u["band"] == -1 and u["j"] > 0 for u in units) and any(u["band"] >= 0 for u in units)


def test_edge_rows(spark):
    frame = clashing(docs(spark, NASTY))
    got = J.near_duplicates(frame).collect()
    assert len(got) == len(NASTY)
    for r in got:
        if r["doc_id"] == 5:  # a repeated row counts as a document
            assert (r["class_id"], r["n_links"], r["n_copies"]) == (5, 1, 2)
        else:
            assert (r["class_id"], r["n_links"], r["copy_of"]) == (r["doc_id"], 0, r["doc_id"])
    assert J.near_duplicates(docs(spark, [])).count() == 0
    spaces = by_id(J.near_duplicates(docs(spark, [(1, "a b c d e f"), (2, " a\tb c\nd e f "), (3, "a b c d e g")])))
    assert [(spaces[k]["class_id"], spaces[k]["n_links"]) for k in (1, 2, 3)] == [(1, 1), (1, 1), (3, 0)]


def test_threshold_is_inclusive(spark):
    a = " ".join(f"w{i}" for i in range(12))  # 8 shingles
    b = " ".join(f"w{i}" for i in range(14))  # 10 shingles: exactly 0.8
    got = by_id(J.near_duplicates(docs(spark, [(1, a), (2, b), (3, a + " z")])))
    assert got[1]["class_id"] == got[2]["class_id"] == 1 and got[1]["n_links"] == 2


def test_pruning_bound_is_the_posterior():
    """P(Beta(k + 1, n - k + 1) >= t) by numerical integration."""
    for n, k in zip(range(J.STEP, J.HASHES + 1, J.STEP), J._least_equal(0.8, 1e-6)):
        def tail(k):
            m = 20_000
            grid = [(i + 0.5) / m for i in range(m)]
            mass = [x**k * (1 - x) ** (n - k) for x in grid]
            return sum(y for x, y in zip(grid, mass) if x >= 0.8) / sum(mass)

        assert tail(k) >= 0.99e-6 and (k == 0 or tail(k - 1) < 1.01e-6)


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5), (None, 3)]
    parent = {x: x for e in edges if None not in e and e[0] != e[1] for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            u, v = root(a), root(b)
            parent[max(u, v)] = min(u, v)
    got = connected_components(spark.createDataFrame(edges, "a bigint, b bigint"))
    assert sorted(map(tuple, got.collect())) == sorted((x, root(x)) for x in parent)
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
