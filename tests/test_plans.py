"""Physical-plan properties the scale design relies on."""

from __future__ import annotations

import __spark_entry__ as E
from tests.conftest import SF_SMALL

Q = E.queries()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_scans_are_pruned_and_top_n_is_take_ordered(spark):
    p = plan(Q["top_n_items"](spark, SF_SMALL))
    # counting ratings needs only the keys: even the unused score is pruned away
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in p
    assert "TakeOrderedAndProject" in p


def test_target_user_filter_reaches_the_scan(spark):
    p = plan(Q["similar_users_pairwise"](spark, SF_SMALL))
    assert "EqualTo(o_custkey,7)" in p


def test_per_user_top_n_is_trimmed_before_ranking(spark):
    p = plan(Q["top_n_per_user"](spark, SF_SMALL))
    assert "WindowGroupLimit" in p


def test_no_python_row_udf_in_hot_paths(spark):
    for key in ("enriched_items", "tfidf_weights", "baseline_predictions", "page_cards"):
        p = plan(Q[key](spark, SF_SMALL))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_describe_scans_its_input_once(spark, monkeypatch):
    """Only the plan that makes the value counts reads the input; the rest reads the counts."""
    from cellar.functions import quantiles
    from cellar.operators import stats
    from cellar.sources.tables import Tables

    plans = []
    write = quantiles.materialize
    monkeypatch.setattr(quantiles, "materialize", lambda df, name: plans.append(plan(df)) or write(df, name))
    li = Tables(spark, SF_SMALL).lineitem
    out = stats.numeric_describe(li, ["l_quantity", "l_tax"], decimals=2)
    assert sum(p.count("lineitem.parquet") for p in plans) == 1 and "lineitem.parquet" not in plan(out)
    assert "ReadSchema: struct<l_quantity:double,l_tax:double>" in plans[0]
