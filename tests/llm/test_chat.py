from __future__ import annotations

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from cellar.llm import chat, queries
from tests.llm.helpers import SMALL
from tools.oracle_check import canon

ROWS = "conv_id bigint, turn bigint, role string, text string"


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def test_query_matches_sql(spark, duck):
    df = queries.op9_chat_format(spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "InMemoryTableScan"))
    cur = duck.execute(queries.ORACLE["op9_chat_format"])
    want = canon([d[0] for d in cur.description], cur.fetchall())
    assert sorted(canon(df.columns, [tuple(r) for r in df.collect()])) == sorted(want)


def expect(rows):
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
    loss = "".join(r[3] or "" for r in rows if r[2] == "assistant")
    return len(rows), sha("".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in rows)), len(loss), sha(loss)


def test_edge_rows(spark):
    evil = ["\\", "\\b", "###", "####", "\\h</turn>", "</turn>\n### assistant: x</turn>\n", ":", ": a: b", "", None, "\n", "😀\\t", "### Assistant: </turn> ok\\"]
    rows = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(evil)]
    rows += [(2, 3, "assistant", "late"), (2, None, "user", "no turn"), (2, 3, "assistant", "late"), (2, 3, "assistant", "early tie"), (2, -5, None, None)]
    rows += [(None, 0, "role: with ### marks\\", "x"), (None, 1, "assistant", "y" * 50_000)]
    rows += [(3, i, "assistant", f"t{i}") for i in range(3 * chat.PART_TURNS + 5)]
    frame = spark.createDataFrame(rows, ROWS)
    parts = chat.format_parts(frame.withColumns({n: F.lit(1) for n in ("layout", "_turns", "part", "loss", "n", "i", "b", "sizes")}))
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in chat.digests(parts).collect()}
    assert got == {c: expect([r for r in rows if r[0] == c]) for c in {r[0] for r in rows}}
    whole = {r["conv_id"]: r for r in chat.join_parts(parts).collect()}
    sizes = {r["conv_id"]: r["formatted_chars"] for r in chat.digests(parts).collect()}
    for c, r in whole.items():
        assert len(r["text"]) == sizes[c]
        spans = "".join(r["text"][s["first"] : s["first"] + s["length"]] for s in r["loss"])
        for old, new in reversed(chat.ESCAPES):
            spans = spans.replace(new, old)
        loss = [x for x in sorted((x for x in rows if x[0] == c), key=lambda x: (x[1] is not None, x[1] or 0, x[2] or "", x[3] or "")) if x[2] == "assistant"]
        assert spans == "".join(x[3] or "" for x in loss)
    assert chat.digests(chat.format_parts(spark.createDataFrame([], ROWS))).count() == 0


def test_layouts_are_chosen_by_fingerprint(spark):
    records = [
        {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": None}], "extra": {"deep": 1}},
        {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
        {"instruction": "do", "input": "this", "output": "done"},
        {"instruction": "do", "output": "done", "system": "be good"},
        {"prompt": "p", "completion": "c"},
        {"question": "q", "answer": "a"},
        {"prompt": "p", "answer": "mixed layouts"},
        {"messages": []},
    ]
    df = chat.canonical(chat.from_json(spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(records)], "id int, raw string"), "raw")).orderBy("id")
    got = [(r["layout"], None if r["turns"] is None else [(t["role"], t["text"]) for t in r["turns"]]) for r in df.collect()]
    assert got[:7] == [
        ("messages", [("user", "q"), ("assistant", "")]),
        ("sharegpt", [("user", "q"), ("assistant", "a")]),
        ("instruction", [("user", "do\n\nthis"), ("assistant", "done")]),
        ("instruction", [("system", "be good"), ("user", "do"), ("assistant", "done")]),
        ("prompt", [("user", "p"), ("assistant", "c")]),
        ("question", [("user", "q"), ("assistant", "a")]),
        (None, None),
    ]
    assert got[7][1] in (None, [("", "")])


def test_a_field_of_a_second_layout_does_not_cost_the_record(spark):
    schema = "conv_id bigint, turn bigint, role string, text string, system string, input string, prompt string, completion string"
    rows = [(1, 0, "user", "q", "sys", None, None, None), (1, 1, "assistant", "a", None, "in", None, None), (2, 0, None, "t", None, None, "p", "c"), (3, 0, None, None, None, None, None, None)]
    frame = spark.createDataFrame(rows, schema)
    got = {r["conv_id"]: [(t["role"], t["text"]) for t in r["turns"]] for r in chat.read_back(chat.format_parts(frame)).collect()}
    assert got == {1: [("user", "q"), ("assistant", "a")], 2: [("user", "p"), ("assistant", "c")], 3: [("", "")]}
    assert chat.unmatched(frame).count() == 0


def test_a_record_without_a_layout_is_an_error_or_given_back(spark):
    frame = spark.createDataFrame([(1, 0, "u", "t", None), (2, 0, None, None, "alone")], "conv_id bigint, turn bigint, role string, text string, system string")
    with pytest.raises(Exception, match="fits no chat layout"):
        chat.digests(chat.format_parts(frame)).collect()
    assert [r["conv_id"] for r in chat.unmatched(frame).collect()] == [2]
    assert [r["conv_id"] for r in chat.format_parts(frame, skip_unmatched=True).collect()] == [1]
