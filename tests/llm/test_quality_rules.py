from __future__ import annotations

import math
import re
from collections import Counter
from fractions import Fraction

import pytest

from cellar.llm import quality_rules as Q
from cellar.llm import queries
from cellar.sources.tables import Tables
from tests.llm.helpers import NASTY, SMALL, WORD, by_id, clashing, docs, texts


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    grams = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    cover = [any(grams[tuple(w[j : j + 5])] > 1 for j in range(max(0, i - 4), min(i, len(w) - 5) + 1)) for i in range(len(w))]
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), sum(cover)


def check(rows, source):
    for r, text in zip(rows, source):
        want = brute(text)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 10 or 100 * want[4] > 20 * want[0])


def test_base_rules_match_brute_force(spark):
    got = by_id(queries.op5_quality_rules(spark, SMALL))
    source = texts()
    assert set(got) == set(source)
    check([got[k] for k in source], source.values())
    assert all(not (r["base_failed"] and r["kept"]) for r in got.values())


def test_edge_rows(spark):
    labels = spark.createDataFrame([(2, None, 0), (4, 1, 0), (4, 1, 0), (5, 0, 1), (5, 1, 1), (None, 1, 0)], "doc_id bigint, quality int, toxic int")
    frame = clashing(docs(spark, NASTY))
    rows = Q.judge(frame, labels).select("doc_id", "m.*", "base_failed", "kept").collect()
    assert len(rows) == len(NASTY)
    key = lambda x: (x[0] is None, x[0] or 0)
    rows = sorted(rows, key=lambda r: key((r["doc_id"],)))
    check(rows, [r[1] for r in sorted(NASTY, key=key)])
    kept = Q.keep(frame, labels)
    assert kept.columns == frame.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == sorted(r["doc_id"] or 0 for r in rows if r["kept"])


def test_dup_lines_and_windows_at_borders(spark):
    cases = ["a\na\n \n\n a\na", "x y\r\nx y\nx y", "q " * 40, "a b c d e f a b c d e", "a b c d\na b c d", "\n\n\n", "t\x0bu\nt\x0bu"]
    got = Q.measure(docs(spark, [(i, t) for i, t in enumerate(cases)])).select("doc_id", "m.*", Q.base_failed().alias("base_failed")).orderBy("doc_id").collect()
    check(got, cases)


def test_empty_tables(spark):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert Q.judge(docs(spark, []), labels).count() == 0
    some = Q.keep(docs(spark, [(1, " ".join(f"w{i}" for i in range(30)))]), labels)
    assert some.count() == 1  # nothing is certified without labels


@pytest.mark.parametrize("n,p", [(10, 0.3), (57, 0.05), (400, 0.005)])
def test_binomial_cdf_is_exact(n, p):
    f = Fraction(p)
    for k in range(0, int(n * p) + 1):
        want = float(sum(math.comb(n, i) * f**i * (1 - f) ** (n - i) for i in range(k + 1)))
        got = Q.binomial_cdf(k, n, p)
        assert got == 1.0 if k >= n * p else abs(got - want) < 1e-12 + 1e-9 * want


def test_certified_cutoffs_hold_their_bound(spark):
    t = Tables(spark, "/root/testdata/sf0.1")
    judged = Q.judge(t.documents, t.labels).where("NOT base_failed").join(t.labels, "doc_id").where("quality = 1").join(t.documents.select("doc_id", "lang"), "doc_id")
    rows = judged.groupBy("lang").agg({"kept": "count"}).collect()
    assert rows
    for r in judged.selectExpr("lang", "CAST(NOT kept AS INT) AS gone").groupBy("lang").avg("gone").collect():
        assert r["avg(gone)"] <= 0.03


def test_too_few_labels_certify_nothing(spark):
    rows = [(i, f"### %%% {i} " + " ".join(f"w{i}x{j}" for j in range(20)), "en") for i in range(30)]
    labels = spark.createDataFrame([(i, int(i > 20), 0) for i in range(30)], "doc_id bigint, quality int, toxic int")
    assert all(r["kept"] for r in Q.judge(docs(spark, rows), labels).collect())
