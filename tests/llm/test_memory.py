"""What a worker and its executor hold at once: few whole texts, each of them once, and small arrays beside them."""

from __future__ import annotations

import tracemalloc

import pyarrow as pa

from cellar.llm import common, quality_rules, words
from tests.llm.helpers import LONG, NASTY, docs


def test_small_batches_reach_the_worker(spark):
    before = spark.conf.get(common.RECORDS)
    try:
        for given, kept in ((10_000, common.BATCH_ROWS), (0, common.BATCH_ROWS), (7, 7)):
            spark.conf.set(common.RECORDS, str(given))
            n = quality_rules.measure(spark.range(9000, numPartitions=1).selectExpr("id doc_id", "'a b' text")).where("m.n_words = 2").count()
            assert n == 9000 and int(spark.conf.get(common.RECORDS)) == kept
    finally:
        spark.conf.set(common.RECORDS, before)


def test_a_text_goes_to_the_worker_once(spark, monkeypatch):
    frame, labels = docs(spark, NASTY), spark.createDataFrame([(6, 1), (7, 0)], "doc_id bigint, quality int")
    sent, measure = [], quality_rules.measure
    monkeypatch.setattr(quality_rules, "measure", lambda df, *a, **k: sent.append(df) or measure(df, *a, **k))
    kept = quality_rules.keep(frame, labels)
    flat = [f for df in sent for f in df.schema.simpleString().replace("<", ",").split(",")]
    assert sum("text:" in f for f in flat) == len(sent) == 2
    assert kept.columns == frame.columns and kept.schema.simpleString() == frame.schema.simpleString()
    want = {r["doc_id"] for r in quality_rules.judge(frame, labels).where("kept").collect()}
    rows = {r["doc_id"]: r["text"] for r in kept.collect()}
    assert set(rows) == want and all(rows[k] == dict((n[0], n[1]) for n in NASTY)[k] for k in rows)
    # a column that is no string comes back as it was
    raw = frame.withColumn("text", frame["text"].cast("binary"))
    assert {(r["doc_id"], bytes(r["text"])) for r in quality_rules.keep(raw, labels).collect()} == {(k, x.encode()) for k, x in rows.items()}


def test_measures_hold_a_small_multiple_of_a_slice():
    texts = pa.array([LONG[i : i + 5000] for i in range(0, len(LONG), 5000)] * 40)
    words._powers.cache_clear()
    tracemalloc.start()
    try:
        quality_rules.measure_texts(texts)
        assert tracemalloc.get_traced_memory()[1] < 64 << 20
    finally:
        tracemalloc.stop()
