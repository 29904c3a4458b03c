from __future__ import annotations

import itertools
import random
import zlib
from collections import Counter

import numpy as np

from cellar.llm import queries
from cellar.llm import toxicity as X
from cellar.sources.tables import Tables
from tests.llm.helpers import LONG, NASTY, by_id, clashing, docs

FAR = "/root/testdata/sf0.1"


def brute_kernel(a: str, b: str) -> float:
    """Shared subsequences of 4 characters within REACH, weighted by their spans, over the norms of strings without repeats."""

    def weights(s):
        out = Counter()
        for at in itertools.combinations(range(len(s)), 4):
            if at[3] - at[0] < X.REACH:
                out["".join(s[i] for i in at)] += X.DECAY ** (at[3] - at[0] + 1)
        return out

    def norm(n):
        return sum(v * v for v in weights([chr(1000 + i) for i in range(n)]).values()) ** 0.5 if n >= 4 else 1.0

    x, y = weights(a), weights(b)
    return sum(v * y[u] for u, v in x.items()) / norm(len(a)) / norm(len(b))


def test_kernel_equals_brute_force_and_the_machine_its_landmarks():
    r = random.Random(2)
    words = sorted({"".join(r.choices("abcdé", k=r.randint(2, 9))) for _ in range(40)})
    landmarks, s = X.Landmarks(words[:12]), X.Strings(words)
    z = landmarks._mapped(s)
    own = [f" {w} " for w in words]
    want = np.array([[brute_kernel(a, b) for b in own[:12]] for a in own])
    assert np.allclose(z[:12] @ z[:12].T, want[:12], atol=1e-5)  # the map gives the kernel back among landmarks
    w = np.array([r.uniform(-1, 1) for _ in range(z.shape[1])])
    machine = X.Machine(*landmarks.weights(w), 0.25)
    assert np.allclose(machine.margins(s), z @ w + 0.25, atol=1e-5)
    assert np.allclose(z @ w, want @ landmarks.whiten @ w, atol=1e-5)


def test_strings_of_texts():
    s = X.Strings(["Hello, I.D.I.O.T! i d - i\no t x yz", "", "ÀÉ  " + "a" * 70, "b"])
    assert list(zip(s.words(), s.doc.tolist())) == [(" hello ", 0), (" idiot ", 0), (" idiotx ", 0), (" yz ", 0), (" àé ", 2), (f" {'a' * 32} ", 2), (f" {'a' * 32} ", 2), (f" {'a' * 6} ", 2), (" b ", 3)]


def test_held_out_accuracy(spark):
    got = by_id(queries.op12_toxicity(spark, FAR))
    assert len(got) == Tables(spark, FAR).documents.count()
    assert all(r["held_out"] == (zlib.crc32(str(k).encode()) % 5 == 0) for k, r in got.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got.values())
    held = [(r["toxic"], got[r["doc_id"]]["predicted"]) for r in Tables(spark, FAR).labels.collect() if got[r["doc_id"]]["held_out"]]
    assert sum(t == p for t, p in held) / len(held) > 0.98
    assert sum(p for t, p in held if t) / sum(t for t, _ in held) > 0.9
    assert sum(p for t, p in held if not t) / sum(1 - t for t, _ in held) < 0.01


def test_gaps_and_inserted_letters_weaken_a_match_only():
    r = random.Random(4)
    clean = [" ".join("".join(r.choices(("the", "er", "on", "in", "at", "or", "ed"), k=r.randint(1, 3))) for _ in range(40)) for _ in range(300)]
    bad = [f"{t} {r.choice(('moron', 'stupid', 'pathetic'))} {r.choice(('moron', 'stupid', 'pathetic'))}" for t in clean[:100]]
    machine = X.fit_machine(bad, clean[100:])
    plain, gap, spaced, inserted, none = (machine.features([clean[0] + " " + x])[0, 0] for x in ("stupid", "s.t.u.p.i.d", "s t u p i d", "stuxpid", "stoned"))
    assert plain == gap == spaced and plain > 0.9 and inserted > 0 > none


def test_scores_do_not_depend_on_labels_held_out_or_on_other_columns(spark):
    t = Tables(spark, "/root/testdata/sf0.01")
    flipped = t.labels.selectExpr("doc_id", "IF(pmod(crc32(CAST(CAST(doc_id AS STRING) AS BINARY)), 5) = 0, 1 - toxic, toxic) AS toxic")
    blind = t.documents.selectExpr("doc_id", "text", "'zz' AS lang", "doc_id % 2 AS source")
    a, b = by_id(X.score(t.documents, t.labels)), by_id(X.score(blind, flipped))
    assert {k: r["score"] for k, r in a.items()} == {k: r["score"] for k, r in b.items()}


def test_edge_rows(spark):
    labels = spark.createDataFrame([(i, 0, i % 2) for i in range(10, 60)] + [(13, 0, 0), (None, 1, 1), (7, 0, None)], "doc_id bigint, quality int, toxic int")
    rows = NASTY + [(i, ("you moron " if i % 2 else "kind words here ") * (i % 7 + 1)) for i in range(10, 60)] + [(70, LONG * 3)]
    got = X.score(clashing(docs(spark, rows)), labels).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    by = {r["doc_id"]: r for r in got}
    assert by[1]["score"] == by[2]["score"] and by[None]["held_out"] is False
    assert all(by[i]["predicted"] == i % 2 for i in range(10, 60))
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert [r["score"] for r in X.score(docs(spark, rows[:2]), none).collect()] == [0.5, 0.5]
    assert X.score(docs(spark, []), labels).count() == 0
