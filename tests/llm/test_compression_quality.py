from __future__ import annotations

import zlib

from cellar.llm import compression_quality as C
from cellar.llm import queries
from cellar.sources.tables import Tables
from tests.llm.helpers import NASTY, by_id, clashing, docs

FAR = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    got = by_id(queries.op4_compression_quality(spark, FAR))
    assert len(got) == Tables(spark, FAR).documents.count()
    assert all(r["held_out"] == (zlib.crc32(str(k).encode()) % 3 == 1) for k, r in got.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got.values())
    held = [(r["quality"], got[r["doc_id"]]) for r in Tables(spark, FAR).labels.collect() if got[r["doc_id"]]["held_out"]]
    right = sum(q == r["predicted"] for q, r in held) / len(held)
    good = [r["predicted"] for q, r in held if q == 1]
    assert right > 0.97 and sum(good) / len(good) > 0.98
    sure = [q for q, r in held if r["score"] > 0.9]  # calibrated: what scores high is good
    assert sum(sure) / len(sure) > 0.95


def test_scores_do_not_depend_on_labels_held_out_or_on_other_columns(spark):
    t = Tables(spark, "/root/testdata/sf0.01")
    flipped = t.labels.selectExpr("doc_id", "IF(pmod(crc32(CAST(CAST(doc_id AS STRING) AS BINARY)), 3) = 1, 1 - quality, quality) AS quality")
    blind = t.documents.selectExpr("doc_id", "text", "'zz' AS lang", "doc_id % 2 AS source")
    a, b = by_id(C.score(t.documents, t.labels)), by_id(C.score(blind, flipped))
    assert {k: r["score"] for k, r in a.items()} == {k: r["score"] for k, r in b.items()}


def test_edge_rows(spark):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(0, 60)] + [(3, 0, 0), (None, 1, 1), (7, None, 0)], "doc_id bigint, quality int, toxic int")
    rows = NASTY + [(i, ("good plain words here " if i % 2 else "### bad $$$ ") * (i % 7 + 1)) for i in range(10, 60)]
    got = C.score(clashing(docs(spark, rows)), labels).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    by = {r["doc_id"]: r["score"] for r in got}
    assert by[1] == by[2]  # null reads as empty
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert [r["score"] for r in C.score(docs(spark, rows[:2]), none).collect()] == [0.5, 0.5]
    assert C.score(docs(spark, []), labels).count() == 0
