from __future__ import annotations

import pytest
import sentencepiece

import __spark_entry__ as E
import corpus_pipeline as P
from cellar.llm import quality_rules
from cellar.llm.common import materialize
from cellar.llm.licenses import words_of
from tests.llm.helpers import NASTY, WORD, clashing, docs
from tests.llm.test_jaccard_join import brute as near
from tests.llm.test_spiece import MODEL
from tests.llm.test_substring_dedup import brute as cut

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage got and gave."""
    out, now = [], spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in P.STAGES:
        then, now = now, materialize(stage(spark, now, SF), "test-stage")
        out.append((then, now))
    return out


def rows(df):
    return {r["doc_id"]: r for r in df.orderBy("doc_id").collect()}


def test_registered():
    assert E.queries()["pipeline"] is P.run
    assert [n for n in E.queries() if n.startswith("op")] and set(E.oracle_sql()) <= set(E.queries())
    assert len(P.STAGES) == 5


def test_columns(stages):
    for then, now in stages[:-1]:
        assert now.columns == then.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_quality_stage(spark, stages):
    then, now = stages[0]
    judged = quality_rules.judge(then, spark.read.parquet(f"{SF}/labels.parquet"))
    assert set(rows(now)) == {r["doc_id"] for r in judged.where("kept").collect()} and 0 < len(rows(now)) < then.count()


def test_near_duplicate_stage(stages):
    then, now = rows(stages[1][0]), rows(stages[1][1])
    classes = near({k: r["text"] for k, r in then.items()})
    assert set(now) == {c for c, _ in classes.values()}


def test_substring_stage(stages):
    then, now = rows(stages[2][0]), rows(stages[2][1])
    want = cut({k: r["text"] for k, r in then.items()})
    assert set(now) == set(then)
    for k, (n, removed, _) in want.items():
        assert len(WORD.findall(now[k]["text"])) == n - removed and now[k]["n_chars"] == len(now[k]["text"])


def test_decontamination_stage(spark, stages):
    then, now = rows(stages[3][0]), rows(stages[3][1])
    grams = {tuple(w[i : i + 12]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect() for w in [words_of(r["text"])] for i in range(len(w) - 11)}
    leaks = {k for k, r in then.items() for w in [words_of(r["text"])] if any(tuple(w[i : i + 12]) in grams for i in range(len(w) - 11))}
    assert leaks <= set(then) - set(now) and len(set(then) - set(now)) <= len(leaks) + 1


def test_encoding_stage(stages):
    then, now = rows(stages[4][0]), rows(stages[4][1])
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    assert set(now) == set(then)
    for k, r in then.items():
        assert now[k]["ids"] == library.encode(r["text"]) and now[k]["decodes"] and now[k]["n_tokens"] == len(now[k]["ids"])


def test_run_is_the_stages(spark, stages):
    assert rows(P.run(spark, SF)) == rows(stages[4][1])


def test_edge_rows_pass_every_stage(spark):
    frame = clashing(docs(spark, NASTY))
    for k, (name, stage) in enumerate(P.STAGES):
        out = stage(spark, frame, SF)
        n = out.count()
        assert out.columns == frame.columns if k < 4 else "ids" in out.columns
        assert {1: n == len(NASTY), 2: n == len(NASTY), 3: n == len(NASTY), 4: n == len(NASTY)}.get(k, n > 0), name
        assert stage(spark, docs(spark, []), SF).count() == 0
