"""Texts made so that sums of powers modulo a power of two cancel: equal hashes would make them equal."""

from __future__ import annotations

import time

import numpy as np
import pyarrow as pa
import pytest

from cellar.llm import html_crf, jaccard_join, quality_rules, substring_dedup
from cellar.llm.words import NOT_SPACE, Words, run_hashes, slices, span_hashes
from tests.llm.helpers import by_id, docs


def pattern(n: int) -> list[int]:
    """0 and 1 by the parity of the binary digits: differences of such patterns cancel modulo 2**64 for every odd base."""
    return [bin(i).count("1") % 2 for i in range(n)]


@pytest.mark.parametrize("n", (1024, 2048, 4096))
def test_hashes_of_cancelling_patterns_differ(n):
    a, b = ("".join("ab"[x ^ f] for x in pattern(n)) for f in (0, 1))
    data = np.frombuffer((a + b).encode(), np.uint8)
    x, y = span_hashes(data, np.array([0, n]), np.array([n, 2 * n]))
    assert x != y
    h = span_hashes(np.frombuffer(b"ab", np.uint8), np.array([0, 1]), np.array([1, 2]))
    words = np.concatenate([h[[v ^ f for v in pattern(n)]] for f in (0, 1)])
    for other in (False, True):
        x, y = run_hashes(words, np.array([0, n]), np.array([n, 2 * n]), other)
        assert x != y


@pytest.mark.parametrize("n", (1024, 4096))
def test_operators_keep_such_texts_apart(spark, n):
    words = [" ".join(("alpha", "beta")[x ^ f] for x in pattern(n)) for f in (0, 1)]
    lines = ["".join("ab"[x ^ f] for x in pattern(n)) for f in (0, 1)]
    frame = docs(spark, [(1, words[0]), (2, words[1]), (3, words[0].replace(" ", "\n")), (4, "\n".join([*lines, lines[0]]))])
    near = by_id(jaccard_join.near_duplicates(frame))
    assert [near[i]["copy_of"] for i in (1, 2, 3)] == [1, 2, 1] and near[1]["n_copies"] == 2
    m = by_id(quality_rules.measure(frame))
    assert m[4]["m"]["n_dup_lines"] == 1
    got = {r["doc_id"]: r["n_removed"] for r in substring_dedup.digest(frame).collect()}
    seen, want = set(), {}
    for i, t in ((1, words[0]), (2, words[1]), (3, words[0])):
        w = t.split()
        gone = set()
        for at in range(len(w) - 19):
            key = tuple(w[at : at + 20])
            if key in seen:
                gone.update(range(at, at + 20))
            seen.add(key)
        want[i] = len(gone)
    assert {i: got[i] for i in want} == want


def test_hash_of_a_range_does_not_depend_on_its_place():
    (_, _, offsets, data), = slices(pa.array(["one two one", "two one  two one two"]))
    w = Words(offsets, data, NOT_SPACE)
    h = w.hashes()
    assert len(set(h.tolist())) == 2 and h[0] == h[2] == h[4]
    at, g = w.ngrams(h, 2)
    assert len(set(g.tolist())) == 2


def test_a_column_name_with_a_dot_passes_the_rules(spark):
    frame = docs(spark, [(1, "a b c d e f g h i j k l"), (2, "x")]).withColumnRenamed("source", "meta.url")
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    kept = quality_rules.keep(frame, labels)
    assert kept.columns == frame.columns and [r["doc_id"] for r in kept.collect()] == [1]


def test_end_tags_without_a_partner_cost_nothing():
    page = "<article><p>" + "<font>x</b> " * 80_000 + "</p></article>"
    begin = time.time()
    blocks = html_crf.leaf_blocks(page)
    assert time.time() - begin < 10 and sum(len(b.text) for b in blocks) >= 80_000
