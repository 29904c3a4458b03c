from __future__ import annotations

import math
import random
from itertools import combinations

import pytest

from cellar.llm import decontam as D
from cellar.llm import queries
from cellar.llm.licenses import words_of
from tests.llm.helpers import NASTY, SMALL, clashing, docs, texts


def grams(text, k=12):
    w = words_of(text)
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def bench(spark, rows):
    return spark.createDataFrame(rows, "item_id bigint, text string")


def test_exact_passages_are_all_found_and_clean_documents_left(spark):
    t = spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()
    items = {r["item_id"]: grams(r["text"]) for r in t}
    want = {(d, k) for d, text in texts().items() for k, g in items.items() if g & grams(text)}
    got = queries.op1_decontamination(spark, SMALL).collect()
    assert want <= {(r["doc_id"], r["item_id"]) for r in got}
    whole = {r["item_id"]: words_of(r["text"]) for r in t}
    source = texts()
    for r in got:  # every row is a real overlap
        doc = words_of(source[r["doc_id"]])[r["first_word"] : r["first_word"] + r["n_aligned"]]
        item = whole[r["item_id"]][r["item_first_word"] : r["item_first_word"] + r["n_aligned"]]
        same = sum(a == b for a, b in zip(doc, item))
        assert same == r["n_matched"] and 4 * same >= 3 * r["n_aligned"]


def test_substituted_passages(spark):
    rng = random.Random(8)
    vocabulary = [f"{a}{b}" for a in "bcdfgk" for b in "aeiou"]
    line = lambda n: [rng.choice(vocabulary) + rng.choice(vocabulary) for _ in range(n)]
    items = [line(rng.randint(15, 50)) for _ in range(60)]
    rows, want = [], set()
    for k, item in enumerate(items):
        w = list(item)
        for i in rng.sample(range(len(w)), len(w) // 6):
            w[i] = "CHANGED"
        rows.append((k, ", ".join(line(200) + w + line(100)).upper()))
        want.add((k, k))
    rows += [(1000 + k, " ".join(line(400))) for k in range(200)]
    got = D.overlaps(docs(spark, rows), bench(spark, [(k, " ".join(x)) for k, x in enumerate(items)]))
    found = {(r["doc_id"], r["item_id"]) for r in got.collect()}
    assert not found - want and len(found) >= 0.98 * len(want)
    left = D.drop_leaks(docs(spark, rows), bench(spark, [(k, " ".join(x)) for k, x in enumerate(items)]))
    assert {r["doc_id"] for r in left.collect()} == {r[0] for r in rows} - {d for d, _ in found}


def test_edge_rows(spark):
    items = bench(spark, [(1, None), (2, ""), (3, "too short"), (4, "Seven words are enough to be found"), (4, "Seven words are enough to be found"), (None, "a null item with " + " ".join(f"t{i}" for i in range(20)))])
    rows = [*NASTY, (50, "x seven-words, are ENOUGH to be found y"), (51, "seven words are not enough to be found"), (52, " ".join(f"t{i}" for i in range(20))), (52, " ".join(f"t{i}" for i in range(20)))]
    frame = clashing(docs(spark, rows))
    got = sorted((r["doc_id"], r["item_id"] or 0, r["n_matched"]) for r in D.overlaps(frame, items).collect())
    assert got == [(50, 4, 7), (50, 4, 7), (52, 0, 20), (52, 0, 20)]
    left = D.drop_leaks(frame, items)
    assert left.columns == frame.columns and left.count() == len(rows) - 3
    nothing = bench(spark, [])
    assert D.overlaps(frame, nothing).count() == 0 and D.drop_leaks(frame, nothing).count() == len(rows)
    assert D.overlaps(docs(spark, []), items).count() == 0


@pytest.mark.parametrize("size", [5, 40])
def test_blocks_of_the_benchmark_together_find_all(spark, monkeypatch, size):
    monkeypatch.setattr(D, "BLOCK_WORDS", size)
    items = [(k, " ".join(f"i{k}w{j}" for j in range(15))) for k in range(10)]
    rows = [(k, "before " + t + " after") for k, t in items] + [(99, "clean text")]
    assert {(r["doc_id"], r["item_id"]) for r in D.overlaps(docs(spark, rows), bench(spark, items)).collect()} == {(k, k) for k in range(10)}
    assert [r["doc_id"] for r in D.drop_leaks(docs(spark, rows), bench(spark, items)).collect()] == [99]


def brute_short(rows, items):
    """(document, item) where on some diagonal MIN_SHARE of a short item's words match."""
    out = set()
    for d, text in rows:
        w = words_of(text)
        for k, item in items:
            q = words_of(item)
            need = math.ceil(D.MIN_SHARE * len(q))
            if any(sum(0 <= s + i < len(w) and w[s + i] == x for i, x in enumerate(q)) >= need for s in range(-len(q), len(w))):
                out.add((d, k))
    return out


def substituted_short_items():
    """Items of 5 to 14 words, and documents with each set of up to two of an item's words (and some sets of three) substituted."""
    rng = random.Random(3)
    words = [f"{a}{b}" for a in "bcdfgk" for b in "aeiou"]
    line = lambda n: [rng.choice(words) + rng.choice(words) for _ in range(n)]
    items = [(n, line(n)) for n in range(5, 15)]
    items += [(20 + n, items[n - 5][1][:-2] + line(2)) for n in range(7, 15)]  # much alike
    rows = []
    for _, item in items:
        three = list(combinations(range(len(item)), 3))
        for places in [(), *((i,) for i in range(len(item))), *combinations(range(len(item)), 2), *rng.sample(three, min(12, len(three)))]:
            w = ["other" if i in places else x for i, x in enumerate(item)]
            rows.append((len(rows), " ".join([*line(rng.choice([0, 0, 3])), *w, *line(rng.choice([0, 0, 3]))])))
        rows += [(len(rows), " ".join(item[2:])), (len(rows) + 1, " ".join(item[:-2])), (len(rows) + 2, " ".join(item[1:-1]))]
    return rows, [(k, " ".join(x)) for k, x in items]


def test_substitutions_in_short_items_match_brute_force(spark):
    rows, items = substituted_short_items()
    want = brute_short(rows, items)
    got = D.overlaps(docs(spark, rows), bench(spark, items)).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == want
    assert all(sum(k == n for _, k in want) > n for n in range(5, 15))
    left = D.drop_leaks(docs(spark, rows), bench(spark, items))
    assert sorted(r["doc_id"] for r in left.collect()) == sorted({d for d, _ in rows} - {d for d, _ in want})


def test_short_masks_avoid_all_allowed_substitutions():
    for n in range(D.MIN_ITEM, D.SHORT_ITEM + 1):
        masks = [set(m) for m in D.short_masks(n)]
        assert all(any(not m & set(gone) for m in masks) for gone in combinations(range(n), n - math.ceil(D.MIN_SHARE * n)))


def test_items_that_are_not_searched_are_given_back(spark):
    items = spark.createDataFrame([(1, "Four words are few"), (2, "five words are just enough"), (3, None), (4, "")], "item_id bigint, text string")
    assert {(r["item_id"], r["n_words"]) for r in D.not_searched(items).collect()} == {(1, 4), (3, 0), (4, 0)}
