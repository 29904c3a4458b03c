from __future__ import annotations

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cellar.llm import queries
from cellar.llm import substring_dedup as S
from tests.llm.helpers import NASTY, SMALL, WORD, by_id, clashing, docs, texts


def brute(source):
    """{id: (words, removed, digest)} for ids in order."""
    seen, out = set(), {}
    for k, t in source.items():
        w = WORD.findall(t or "")
        gone = [False] * len(w)
        for i in range(len(w) - 19):
            g = tuple(w[i : i + 20])
            if g in seen:
                gone[i : i + 20] = [True] * 20
            seen.add(g)
        kept = " ".join(x for x, y in zip(w, gone) if not y)
        out[k] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def values(df):
    return {k: (r["n_words"], r["n_removed"], r["kept_sha256"]) for k, r in by_id(df).items()}


def passages(rng, n_docs=60):
    vocabulary = [f"v{i}" for i in range(40)]
    line = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    shared = [line(rng.randint(19, 70)) for _ in range(6)]
    out = {}
    for k in range(n_docs):
        w = line(rng.randint(0, 40))
        for _ in range(rng.randint(0, 3)):
            w += rng.choice(shared)[rng.randint(0, 3) :] + line(rng.randint(0, 25))
        if rng.random() < 0.2:
            w += [rng.choice(vocabulary)] * rng.randint(15, 120)  # one word over and over
        if rng.random() < 0.2:
            w += line(rng.randint(2, 30)) * rng.randint(2, 6)  # a period
        out[k * 3] = rng.choice([" ", "\n", "\t"]).join(w)
    return out


def test_query_matches_brute_force(spark):
    assert values(queries.op10_substring_dedup(spark, SMALL)) == brute(texts())


@pytest.mark.parametrize("common", [False, True])
def test_planted_passages(spark, monkeypatch, common):
    if common:  # nearly every run is treated as a common one
        monkeypatch.setattr(S, "SAMPLE", 1.0)
        monkeypatch.setattr(S, "HOT_LEAST", 2)
    source = passages(random.Random(5))
    rows = list(source.items())
    random.Random(6).shuffle(rows)
    frame = docs(spark, rows).repartition(7)
    assert values(S.digest(frame)) == brute(source)


def test_removal_from_texts(spark):
    source = passages(random.Random(9), 40)
    rows = [(k, t, "en", None, len(t)) for k, t in source.items()] + [(-1, None, None, "s", None)]
    frame = clashing(docs(spark, rows))
    out = S.remove(frame)
    assert out.columns == frame.columns and out.dtypes == frame.dtypes
    got, want = by_id(out), brute(dict(sorted(source.items())))
    for k, (_, removed, digest) in want.items():
        words = WORD.findall(got[k]["text"])
        assert hashlib.sha256(" ".join(words).encode()).hexdigest() == digest
        assert got[k]["n_chars"] == len(got[k]["text"]) and got[k]["_k"] == "x"
        if not removed:
            assert got[k]["text"] == source[k]
    assert got[-1]["text"] is None and got[-1]["source"] == "s"


def test_edge_rows(spark):
    got = S.digest(clashing(docs(spark, NASTY))).collect()
    assert len(got) == len(NASTY)
    for r in got:
        text = next(x[1] for x in NASTY if x[0] == r["doc_id"])
        assert (r["n_words"], r["n_removed"]) == (len(WORD.findall(text or "")), 0)
    assert S.digest(docs(spark, [])).count() == 0
    same = " ".join(f"q{i}" for i in range(30))
    rows = S.digest(docs(spark, [(9, same), (9, same), (None, same), (10, same)])).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_removed"]) for r in rows) == [(False, 9, 30), (False, 9, 30), (False, 10, 30), (True, 0, 0)]
    twice = S.digest(docs(spark, [(9, same), (9, same)])).collect()  # neither row starts earlier than the other
    assert [r["n_removed"] for r in twice] == [0, 0]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=14), min_size=1, max_size=5), st.integers(1, 4))
def test_automaton_names_equal_runs_alike(sequences, size):
    a = S.SuffixAutomaton()
    for s in sequences[:-1] or sequences:
        a.add(s)
    held = {tuple(s[i : i + size]) for s in sequences[:-1] or sequences for i in range(len(s) - size + 1)}
    names = {}
    for s in sequences:
        got = dict(a.matches(s, size))
        for i in range(len(s) - size + 1):
            run = tuple(s[i : i + size])
            assert (i in got) == (run in held)
            if i in got:
                assert names.setdefault(got[i], run) == run
    assert len(set(names.values())) == len(names)


@pytest.mark.parametrize("most", [1, 2, 100])
def test_a_shard_cut_into_several_automata_gives_the_same(most):
    rng = random.Random(3)
    words = [str(rng.randrange(2)) for _ in range(200)]
    shard = [(d, d * 7, " ".join(words[d * 5 : d * 5 + 40]).encode()) for d in range(12)]
    first, want = {}, set()
    for d, f, text in sorted(shard):
        w = text.split()
        for i in range(len(w) - 5):
            key = tuple(w[i : i + 6])
            first[key] = min(first.get(key, (d, f + i)), (d, f + i))
    for d, f, text in shard:
        w = text.split()
        want |= {(d, f + i) for i in range(len(w) - 5) if first[tuple(w[i : i + 6])] < (d, f + i)}
    got = {(d, f + k) for d, f, n in S.repeated_windows(shard, 6, most) for k in range(n)}
    assert got == want
