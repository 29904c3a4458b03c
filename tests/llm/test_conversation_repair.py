from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib

import pytest

from cellar.llm import conversation_repair as C
from cellar.llm import queries

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
LEGAL = re.compile(r"(s?(ua)+)?")
BLANK = re.compile(r"[\x20\x09-\x0D]*")


def faults(rows):
    out, seen = [], set()
    for role, text in rows:
        if BLANK.fullmatch(text):
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        elif text.rstrip("\t\n\x0b\x0c\r ")[-1] not in ".!?":
            out.append("truncated")
        else:
            out.append("")
        seen.add((role, text))
    return out


def brute(rows):
    """(cost, audit, lines) by best-first search over all edits, legality judged by the pattern alone."""
    marks, heap = faults(rows), [(0, "", 0, "", ())]
    done = set()
    while heap:
        cost, audit, i, roles, lines = heapq.heappop(heap)
        if i == len(rows) and LEGAL.fullmatch(roles):
            return cost, audit, lines
        if (i, roles[-2:], roles[:1] == "s", audit) in done or not any(LEGAL.fullmatch(roles + x) for x in ("", "a", "ua")):
            continue
        done.add((i, roles[-2:], roles[:1] == "s", audit))
        for r in ("user", "assistant"):
            if len(audit) - i < 2 * len(rows) + 3:
                heapq.heappush(heap, (cost + 5, audit + "I", i, roles + r[0], (*lines, f"{r}:")))
        if i < len(rows):
            role, text = rows[i]
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, roles, lines))
            if marks[i] not in ("blank", "duplicate"):
                more = 5 * (marks[i] == "truncated")
                heapq.heappush(heap, (cost + more, audit + "K", i + 1, roles + (role[:1] or "?"), (*lines, f"{role}:{text}")))
                for r in ("user", "assistant"):
                    heapq.heappush(heap, (cost + 1 + more, audit + "R", i + 1, roles + r[0], (*lines, f"{r}:{text}")))
    raise AssertionError


def report(conv, rows):
    """The row that ``digests`` should give for (turn, role, text) rows."""
    rows = sorted([(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows], key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    marks = faults([r[1:] for r in rows])
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit, lines = brute([r[1:] for r in rows])
    return conv, gaps, marks.count("blank"), marks.count("duplicate"), marks.count("truncated"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def random_rows(seed, n=60, most=7):
    r = random.Random(seed)
    out = []
    for conv in range(n):
        t = r.choice((0, 0, 5, -3))
        for _ in range(r.randint(0, most)):
            t += r.choice((0, 1, 1, 1, 1, 2))
            out.append((conv if conv else None, t if r.random() < 0.95 else None, r.choice(("user", "assistant", "user", "assistant", "system", "tool", "", None)), r.choice(("Yes.", "No!", "Why?", "cut off", "", " \n", None, "ok. \t", "é"))))
    return out


def grouped(rows):
    out = {}
    for c, *rest in rows:
        out.setdefault(c, []).append(tuple(rest))
    return out


def got(df):
    names = "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256".split()
    return {tuple(r) for r in df.select(*names).collect()}


@pytest.mark.parametrize("held", (C.HELD_ROWS, 3, 0))
def test_random_conversations_equal_a_search_over_all_edits(spark, monkeypatch, held):
    rows = random_rows(held)
    want = {report(c, r) for c, r in grouped(rows).items()}
    monkeypatch.setattr(C, "HELD_ROWS", held)  # fewer: back pointers are written and read back
    monkeypatch.setattr(C, "CHUNK", 4 if held else 1)
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS conv", "1 AS fault", "'y' AS chunk", "0 AS nth", "'z' AS report")
    assert got(C.digests(frame)) == want


@pytest.mark.parametrize("held", (C.HELD_ROWS, 2))
def test_repaired_turns_are_legal_and_edits_are_the_audit(spark, monkeypatch, held):
    rows = random_rows(77, 40)
    monkeypatch.setattr(C, "HELD_ROWS", held)
    monkeypatch.setattr(C, "CHUNK", 3)
    audits = {r["conv_id"]: r["audit"] for r in C.digests(spark.createDataFrame(rows, SCHEMA)).collect()}
    out = {}
    for r in sorted(C.repair(spark.createDataFrame(rows, SCHEMA)).collect(), key=lambda r: r["position"]):
        out.setdefault(r["conv_id"], []).append(r)
    assert {c: a for c, a in audits.items() if a} == {c: "".join(r["edit"] for r in rs) for c, rs in out.items()}
    for rs in out.values():
        assert LEGAL.fullmatch("".join(r["role"][:1] for r in rs if r["edit"] != "D"))
        assert all((r["text"], r["turn"]) == ("", None) for r in rs if r["edit"] == "I")


def test_damage_and_conversations_that_lose_all_rows(spark):
    rows = random_rows(3, 300, 3) + [(5000 + i, None, None, "one. two.") for i in range(200)]
    want = {}
    for c, t, role, text in rows:
        out = want.setdefault(c, [])
        h = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        role, text = "user" if h == 4 else role, "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        out += [(t, role, text)] * (0 if h == 0 else 2 if h == 3 else 1)
    have = got(C.digests(C.damage(spark.createDataFrame(rows, SCHEMA)), gone="gone"))
    assert have == {report(c, r) for c, r in want.items()}
    assert (want and min(len(r) for r in want.values())) == 0
    empty = next(r for r in have if not want[r[0]])
    assert empty[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_empty_table_and_one_long_conversation(spark, monkeypatch):
    assert C.digests(spark.createDataFrame([], SCHEMA)).count() == 0 == C.repair(spark.createDataFrame([], SCHEMA)).count()
    n = 30_000
    rows = [(1, i, ("user", "assistant")[i % 2], f"turn {i}" + "." * (i % 101 > 0)) for i in range(n)]
    frame = spark.createDataFrame(rows, SCHEMA)
    whole = got(C.digests(frame))
    monkeypatch.setattr(C, "HELD_BYTES", 5000)
    monkeypatch.setattr(C, "CHUNK", 1000)
    seen = []
    edits = C._edits
    monkeypatch.setattr(C, "_edits", lambda spilled: seen.append(spilled.count()) or edits(spilled))
    assert got(C.digests(frame)) == whole
    assert seen == [31]  # 30 chunks and the report
    assert next(iter(whole))[4] == (n + 100) // 101


def test_query_equals_the_search(spark):
    t = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    damaged = grouped([(r["conv_id"], r["turn"], r["role"], r["text"]) for r in C.damage(t).where("NOT gone").collect()])
    want = {report(c, damaged.get(c, [])) for (c,) in t.select("conv_id").distinct().collect()}
    assert got(queries.op11_conversation_repair(spark, "/root/testdata/sf0.001")) == want
